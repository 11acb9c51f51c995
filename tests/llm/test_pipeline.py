"""The pipeline's stages on small tables, each against its own input."""

import sys
import os

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as C  # noqa: E402
from linkloom.llm.decontaminate import normalise  # noqa: E402
from linkloom.llm.toxicity import sample_and_train, score_toxicity  # noqa: E402
from test_neardup import brute as near_brute  # noqa: E402
from test_secrets import base  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    """Input and output rows of every stage, as ``run`` chains them."""
    from linkloom.session import new_work_dir

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in C.STAGES:
        path = new_work_dir(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_order_and_columns(spark, staged):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").dtypes
    for name, _ in C.STAGES[:-1]:
        assert staged[name][1].dtypes == columns


def test_toxicity_stage(spark, staged):
    before, after = staged["toxicity"]
    model = sample_and_train(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(score_toxicity(before, model).where("score < 0.5"))


def test_near_duplicate_stage(staged):
    before, after = staged["near_duplicates"]
    found = near_brute([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted(d for d, (_, c) in found.items() if d == c)


def test_decontamination_stage(spark, staged):
    before, after = staged["decontamination"]
    items = [normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids(after) == sorted(r.doc_id for r in before.collect()
                                if not any(i in normalise(r.text) for i in items))


def test_secrets_stage(staged):
    before, after = staged["secrets"]
    assert ids(before) == ids(after)
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert (r.text == old[r.doc_id]) == (not base(old[r.doc_id])) or "[SECRET]" in r.text
        assert not base(r.text.replace("[SECRET]", " "))
        assert r.n_chars == len(r.text) or r.text == old[r.doc_id]


def test_packing_stage_and_run(spark, staged):
    before, after = staged["packing"]
    assert sorted({r.doc_id for r in after.collect()}) == ids(before)
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, after.collect()))


def test_stages_on_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and clashing column names."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, None, None, None, 1, "a", 5), (2, "", "en", "s", 0, 2, "b", 5),
            (3, long, "en", "s", 7, 3, None, 5), (3, long, "en", "s", 7, 3, None, 5),
            (4, long, None, "s", 7, 4, "d", 5), (None, "token=abcdef12 x", "en", "s", 16, 5, "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "rep long, gone_id string, spans int")
    for empty in (False, True):
        at = docs.limit(0) if empty else docs
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, at, SF)
            assert out.dtypes == docs.dtypes
            at = out
        got = sorted((tuple(r) for r in at.collect()), key=str)
        want = [] if empty else [*rows[:4], (None, "[SECRET] x", "en", "s", 10, 5, "e", 5)]
        assert got == sorted(want, key=str)
        packed = C.STAGES[-1][1](spark, at, SF).collect()
        assert sorted({r.doc_id for r in packed}, key=str) == sorted({r[0] for r in want}, key=str)


def test_entry_registers_everything():
    import __spark_entry__ as E

    names = E.queries()
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
