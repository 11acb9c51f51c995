"""Secret scans: pattern matches plus a randomness test battery.

Patterns find assignments, access keys and long hex strings. Every other
long token of letters and digits is a candidate for the battery: an encoding
(hex, base32, base36, base62, base64, base64url) is inferred from its characters and
its symbols must look like independent uniform draws from that alphabet:

* chi-squared test of uniform symbol counts,
* runs tests: of the upper against the lower half of the alphabet
  (Wald-Wolfowitz), and of lower case, upper case, digits and signs (the same for
  several kinds), which tells names of joined words from keys,
* lag-one serial correlation.

A candidate's p-value is ``TESTS`` times its least one (Bonferroni). Dismissing
a candidate as "not random" is the discovery that can be false, so these
dismissals are controlled per document by Benjamini-Hochberg with weights in
proportion to token length (longer tokens have more power and get more of
the error budget). What is not dismissed is a secret.

Everything is DataFrame functions on whole texts; there is no shuffle.
Positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and the least number of characters of a match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
CANDIDATE_MIN = 20
FALSE_DISMISSALS = 0.03
TESTS = 4
CASES = ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")
REPLACEMENT = "[SECRET]"
KINDS = ("assign", "access", "hex", "random")

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encodings in the order they are tried: characters a token may have, its alphabet in order.
ENCODINGS = (
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
    ("^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
)
MIXED = UPPER + LOWER + DIGITS + "+/-_"

SPAN = "array<struct<start:int,rank:int,end:int>>"


def _zip(**arrays: Column) -> Column:
    """Elements of arrays of equal length side by side, as structs."""
    first = next(iter(arrays.values()))
    return F.transform(first, lambda _, i: F.struct(*[F.get(a, i).alias(n) for n, a in arrays.items()]))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often body uses
    it, and stays one expression when a filter is moved below."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _located(text: Column, pattern: str, rank: int, matches: Column, keep: Column) -> Column:
    """Spans of the matches of ``pattern``: the pieces between matches and the
    matches add up to the positions. A match that is not kept still uses up
    its text."""
    state = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["keep"], F.concat(acc["found"], span))
                        .otherwise(acc["found"]).alias("found"))

    located = _let(F.split(text, F.lit(pattern), -1), lambda pieces: F.aggregate(
        _zip(match=matches, piece=pieces, keep=keep), state, step, lambda acc: acc["found"]))
    return F.when(F.size(matches) > 0, located).otherwise(F.array().cast(SPAN))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal (Abramowitz and Stegun 26.2.17)."""
    a = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * a)
    # Coefficients of the approximation.
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    poly = t * (F.lit(b[0]) + t * (F.lit(b[1]) + t * (F.lit(b[2]) + t * (F.lit(b[3]) + t * F.lit(b[4])))))
    tail = F.exp(-a * a / 2.0) / F.lit(2.5066282746310002) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def _alphabet(token: Column) -> Column:
    out = F.lit(MIXED)
    for pattern, letters in reversed(ENCODINGS):
        out = F.when(token.rlike(pattern), F.lit(letters)).otherwise(out)
    return out


def _sum(values: Column, f=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + f(x).cast("double"))


def _p_value(token: Column) -> Column:
    """Bonferroni-combined p-value of the three tests for one token."""

    def tests(s: Column) -> Column:
        x, counts, n, k = s["x"], s["counts"], s["n"], s["k"]
        chi = k / n * _sum(counts, lambda c: c * c) - n
        spread = F.lit(2.0) / (F.lit(9.0) * (k - 1.0))
        z_chi = ((F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1.0), F.lit(1.0 / 3.0)) - (1.0 - spread))
                 / F.sqrt(spread))

        both = 2.0 * s["high"] * (n - s["high"])
        var_runs = both * (both - n) / (n * n * (n - 1.0))
        runs = 1.0 + _sum(s["pairs"], lambda q: F.when(
            (q["a"] >= k / 2.0) != (q["b"] >= k / 2.0), 1.0).otherwise(0.0))
        z_runs = F.when(var_runs > 0, F.abs(runs - both / n - 1.0) / F.sqrt(var_runs)).otherwise(F.lit(40.0))

        top = _sum(s["pairs"], lambda q: (q["a"] - s["mean"]) * (q["b"] - s["mean"]))
        square = _sum(x, lambda v: (v - s["mean"]) * (v - s["mean"]))
        z_serial = F.when(square > 0, F.abs(top / square) * F.sqrt(n)).otherwise(F.lit(40.0))
        # Runs of several kinds: mean and variance of their number in a random order.
        squares, cubes = _sum(s["cases"], lambda c: c * c), _sum(s["cases"], lambda c: c * c * c)
        mean_cases = 1.0 + n - squares / n
        var_cases = (squares * (squares + n * (n + 1.0)) - 2.0 * n * cubes - n * n * n) / (n * n * (n - 1.0))
        z_cases = F.when(var_cases > 0, (mean_cases - s["case_runs"]) / F.sqrt(var_cases)).otherwise(F.lit(0.0))

        p_chi = _let(z_chi, _upper_tail)
        p_runs = 2.0 * _let(z_runs, _upper_tail)
        p_serial = 2.0 * _let(z_serial, _upper_tail)
        p_cases = _let(z_cases, _upper_tail)  # too few runs only: that is what words give
        return F.least(F.lit(1.0), TESTS * F.least(p_chi, p_runs, p_serial, p_cases))

    def sums(s: Column) -> Column:
        x, k = s["x"], s["k"]
        n = F.size(x).cast("double")
        return F.struct(
            x.alias("x"), s["counts"].alias("counts"), k.alias("k"), n.alias("n"),
            s["cases"].alias("cases"), s["case_runs"].alias("case_runs"),
            F.transform(F.slice(x, F.lit(2), F.size(x) - 1),
                        lambda v, i: F.struct(F.get(x, i).alias("a"), v.alias("b"))).alias("pairs"),
            (_sum(x) / n).alias("mean"),
            _sum(x, lambda v: F.when(v >= k / 2.0, 1.0).otherwise(0.0)).alias("high"))

    def symbols(s: Column) -> Column:
        return _let(F.split(s["body"], ""), lambda chars: F.struct(
            F.transform(chars, lambda c: F.instr(s["letters"], c) - 1).alias("x"),
            F.transform(F.array_distinct(chars),
                        lambda c: (F.length(s["body"]) - F.length(F.replace(s["body"], c, F.lit(""))))
                        .cast("double")).alias("counts"),
            F.length(s["letters"]).cast("double").alias("k"),
            F.array(*[F.regexp_count(s["body"], F.lit(c)).cast("double") for c in CASES]).alias("cases"),
            F.regexp_count(s["body"], F.lit("|".join(f"{c}+" for c in CASES))).cast("double").alias("case_runs")))

    named = _let(F.rtrim(token, F.lit("=")),
                 lambda b: F.struct(b.alias("body"), _alphabet(b).alias("letters")))
    return _let(_let(_let(named, symbols), sums), tests)


def _scan(text: Column, dismissals: float) -> Column:
    """Struct of ``base`` and ``spans`` for a non-null text."""
    none = F.array().cast("array<string>")
    long_hex = f"[0-9a-f]{{{HEX_MIN},}}"  # runs are maximal, so this finds the long ones

    def all_of(pattern: str, group: int = 0) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    matches = F.struct(
        all_of(ASSIGN).alias("assign"),
        F.when(text.contains("AKIA"), all_of(ACCESS)).otherwise(none).alias("access"),
        all_of(long_hex).alias("hex"),
        all_of(CANDIDATE).alias("candidate"))

    def locate(m: Column) -> Column:
        keys = F.when(F.size(m["assign"]) > 0, all_of(ASSIGN, 2)).otherwise(none)
        maybe = F.exists(m["candidate"], _mixed)
        return F.struct(
            F.array_sort(F.concat(
                _let(keys, lambda g: _located(text, ASSIGN, 0, m["assign"], F.transform(
                    g, lambda v: F.length(v) >= ASSIGN_MIN))),
                _located(text, ACCESS, 1, m["access"], F.transform(
                    m["access"], lambda v: F.length(v) >= ACCESS_MIN)),
                _located(text, long_hex, 2, m["hex"], F.transform(m["hex"], lambda v: F.lit(True)))
            )).alias("base"),
            m["candidate"].alias("tokens"),
            F.when(maybe, _located(text, CANDIDATE, 3, m["candidate"], F.transform(
                m["candidate"], lambda v: F.lit(True)))).otherwise(F.array().cast(SPAN)).alias("where"))

    def test(f: Column) -> Column:
        paired = F.transform(f["where"], lambda w, i: F.struct(F.get(f["tokens"], i).alias("token"),
                                                               w.alias("span")))
        open_ = F.filter(paired, lambda z: _mixed(z["token"]) & ~F.exists(
            f["base"], lambda b: (b["start"] <= z["span"]["start"]) & (b["end"] >= z["span"]["end"])))
        return F.struct(f["base"].alias("base"), F.transform(open_, lambda z: F.struct(
            z["span"].alias("span"), F.length(z["token"]).cast("double").alias("n"),
            _p_value(z["token"]).alias("p"))).alias("tests"))

    def weigh(f: Column) -> Column:
        mean = _sum(f["tests"], lambda t: t["n"]) / F.greatest(F.size(f["tests"]), F.lit(1))
        return F.struct(f["base"].alias("base"), _let(mean, lambda m: F.transform(
            f["tests"], lambda t: F.struct((t["p"] * m / t["n"]).alias("p"), t["span"].alias("span"))))
            .alias("tests"))

    def limit(f: Column) -> Column:
        ordered = F.array_sort(F.transform(f["tests"], lambda t: t["p"]))
        dismissed = F.transform(ordered, lambda p, i: F.when(
            p <= (i + 1) * F.lit(dismissals) / F.size(f["tests"]), p).otherwise(F.lit(-1.0)))
        return F.struct(f["base"].alias("base"), f["tests"].alias("tests"), F.aggregate(
            dismissed, F.lit(-1.0), lambda acc, p: F.greatest(acc, p)).alias("limit"))

    def join(f: Column) -> Column:
        random = F.transform(F.filter(f["tests"], lambda t: t["p"] > f["limit"]), lambda t: t["span"])
        return F.struct(f["base"].alias("base"), F.array_sort(F.concat(f["base"], random)).alias("spans"))

    return _let(_let(_let(_let(_let(matches, locate), test), weigh), limit), join)


def _mixed(token: Column) -> Column:
    """Digits and letters, and long enough without padding."""
    return (token.rlike("[0-9]") & token.rlike("[A-Za-z]")
            & (F.length(F.rtrim(token, F.lit("="))) >= CANDIDATE_MIN))


def scan_secrets(docs: DataFrame, dismissals: float = FALSE_DISMISSALS) -> DataFrame:
    """Adds to every row ``base_spans`` and ``spans``: arrays of (start, rank,
    end), rank being the place of the kind in ``KINDS``, in order.

    Null and empty texts have no spans; repeated rows are scanned each; an
    empty table stays empty. Other columns pass through, but columns named
    ``base_spans`` or ``spans`` give way to the result."""
    found = _let(F.coalesce(F.col("text"), F.lit("")), lambda t: _scan(t, dismissals))
    scanned = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"),
                          found.alias("found"))
    return scanned.select(*[F.col("row")[n].alias(n) for n in docs.columns if n not in ("base_spans", "spans")],
                          F.col("found.base").alias("base_spans"), F.col("found.spans").alias("spans"))


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base matches by kind, their checksum, and all
    spans of every row. Null and empty texts have none; rows with a null doc_id
    and repeated rows are scanned each; other columns are ignored."""
    scanned = scan_secrets(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["rank"] == KINDS.index(kind))).cast("long")

    return scanned.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                          F.sha2(_joined("base_spans"), 256).alias("base_sha256"),
                          _joined("spans").alias("spans"))


def redact_secrets(docs: DataFrame, replacement: str = REPLACEMENT) -> DataFrame:
    """The same rows and columns with every span replaced; overlapping spans
    are replaced once, a column ``n_chars`` follows. Null text stays null."""
    names = docs.columns
    scanned = scan_secrets(docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("text").alias("text")))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(replacement)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), gap.otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", state, step, lambda acc: F.concat(
        acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    done = scanned.withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    cols = []
    for n in names:
        if n == "text":
            cols.append(F.col("clean").alias(n))
        elif n == "n_chars":
            kind = docs.schema[n].dataType
            cols.append(F.when(F.size("spans") > 0, F.length("clean").cast(kind))
                        .otherwise(F.col("row")[n]).alias(n))
        else:
            cols.append(F.col("row")[n].alias(n))
    return done.select(*cols)
