"""HTML extraction: tree scoring.

A page is tokenised once into a tree of elements. Block elements cut the text
into blocks. Only what is never text for a reader (scripts, controls, players,
hidden by style) takes no part at all. Elements that a page's furniture is made
of, by tag (navigation, footer, aside, form), role, ``aria-hidden``, class or id
(an advert, a sidebar, comments, ...), take no part unless they turn out to hold
the page's text (``_released``): a form around a whole page, a wrapper named
after its sidebar. Readers' comments never come while any other text is left.

Every block of some length passes points to its ancestors: one, plus one per
comma, plus one per hundred characters up to three; the parent gets all of
them, the grandparent half, further ancestors a third divided by the
distance. An element's points are discounted by its link density. Where the
page has an article with text, the best container is the best article. It is
kept together with the siblings that score well, are named like it or are long
paragraphs with few links, and with everything that stands between these and
is no menu: headings, lists, short blocks. In an article every block is kept.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship

LEAST_SCORED = 25
SIBLING_SHARE = 0.2
LONG_SIBLING = 80

# Elements of HTML by the part they play here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "title", "select")
FOREIGN = ("svg", "math")  # of RAW, those that may close themselves
DROPPED = frozenset("head button menu object canvas audio video map label".split())
# Parts of a page around its text; all but FRAMES (of a control, a dialog) even where it is long.
FRAMES = frozenset("form fieldset dialog".split())
FURNITURE = FRAMES | frozenset("nav footer aside".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul menu dialog hgroup caption".split())
# An open paragraph ends where one of these begins.
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
SAME_ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tbody thead tfoot div article section main body blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu "
                  "menubar form toolbar".split())
UNLIKELY = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar sidebars comment comments disqus cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup share sharing social related recommended "
    "breadcrumb breadcrumbs menu nav navbar navigation pagination pager footer masthead toolbar "
    "widget paywall login replies respond skip outbrain taboola".split())
# Of UNLIKELY, what readers write: often longer than the article itself.
READERS = frozenset("comment comments disqus replies respond".split())
# Words that may stand beside one of UNLIKELY in an id that names a part of the page. With
# another word the id is taken for a heading's ("related-work", "social-impact").
# Words of UNLIKELY that say little inside an article, or beside a word that is none of these.
WEAK = frozenset("alert skip notice notices banner widget overlay".split())
PART_WORDS = frozenset(
    "area article articles aside bar block body bottom box btn button buttons center container content count "
    "div element feed float form frame google group header holder home icons in inner item items layer leaderboard "
    "left link links list main media message module new next outer page panel post posts pre prev previous "
    "primary right row secondary section site skyscraper slot small square sticky stories story tab tag text "
    "thread title to top unit up video view wrap wrapper".split())
MODIFIERS = frozenset("has with without no".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LEAST_LEFT = 140  # characters of paragraphs that make a page of their own
MUCH_MORE = 20  # times the paragraphs beside it that an unlikely element holds if it is the page
OUTSIDE_ARTICLE = frozenset(("header", "topbar", "site-header", "page-header"))
CONTAINERS = ("article", "main", "body", "html")

RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
HIDDEN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|(?:content-)?visibility\s*:\s*hidden)", re.I)
WORD_PARTS = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")


class Node:
    """``under``: the nearest element, itself included, that is unlikely to
    hold the text; ``last``: one that does only if nothing else is left."""

    __slots__ = ("tag", "parent", "depth", "dropped", "under", "words", "readers", "last", "named", "in_article",
                 "points", "chars", "links", "order")

    def __init__(self, tag: str, parent: "Node | None", attributes: str, order: int):
        self.tag, self.parent, self.order = tag, parent, order
        self.depth = parent.depth + 1 if parent else 0
        within = bool(parent and parent.in_article)
        self.in_article = tag in ("article", "main") or within
        pairs = _attributes(attributes) if attributes else []
        self.named = " ".join(sorted(v for name, v in pairs if name == "class"))
        self.dropped = bool(parent and parent.dropped) or _never(tag, pairs)
        self.under, self.words, self.readers, self.last = parent and parent.under, set(), False, False
        if not self.dropped and tag not in CONTAINERS and tag not in HEADINGS:
            words = _unlikely(pairs, within) | _furniture(tag, pairs, within)
            if words:
                self.under, self.words, self.readers = self, words, not READERS.isdisjoint(words)
                self.last = tag in FURNITURE - FRAMES or tag == "header"
        self.points, self.chars, self.links = 0.0, 0, 0


class Block:
    __slots__ = ("node", "text", "chars", "links")

    def __init__(self, node: Node, text: str, links: int):
        self.node, self.text, self.chars, self.links = node, text, len(text), links


# A run of text between two block tags: its element, and its pieces with the unlikely element
# that holds them and whether they are in a link.
Run = tuple[Node, list[tuple[str, "Node | None", bool]]]


def _attributes(attributes: str) -> list[tuple[str, str]]:
    return [(name.lower(), (a or b or c).lower()) for name, a, b, c in ATTRIBUTE.findall(attributes)]


def _never(tag: str, pairs: list[tuple[str, str]]) -> bool:
    """Whether an element never holds text for a reader."""
    return tag in DROPPED or any(name == "hidden" or name == "style" and HIDDEN.search(value) for name, value in pairs)


def _furniture(tag: str, pairs: list[tuple[str, str]], in_article: bool) -> set[str]:
    """What in an element's tag, role and state speaks against article text."""
    found = {tag} if tag in FURNITURE or tag == "header" and not in_article else set()
    for name, value in pairs:
        if name == "role" and value in ROLES:
            found.add(value)
        elif name == "aria-hidden" and value == "true":
            found.add(name)
    return found


def _unlikely(pairs: list[tuple[str, str]], in_article: bool) -> set[str]:
    """What in an element's class and id speaks against article text."""
    found: set[str] = set()
    for name, value in pairs:
        if name not in ("class", "id"):
            continue
        for item in value.split():
            if not in_article and item in OUTSIDE_ARTICLE:
                found.add(item)
            parts = WORD_PARTS.split(item)
            words = {w for i, w in enumerate(parts) if w in UNLIKELY and MODIFIERS.isdisjoint(parts[:i])}
            plain = all(w in UNLIKELY or w in PART_WORDS or not w.isalpha() for w in parts)
            if not plain and name == "id":
                continue
            if not plain or in_article and words <= {"alert", "skip"}:
                words -= WEAK
            found |= words
    return found


def _block(run: Run, released: set[Node] | None) -> Block | None:
    """The text of a run that no unlikely element holds back; None: all of it."""
    node, pieces = run
    left = [(p, link) for p, under, link in pieces if released is None or under is None or under in released]
    joined = SPACE.sub(" ", unescape("".join(p for p, _ in left))).strip()
    if not joined:
        return None
    links = sum(len(SPACE.sub(" ", unescape(p))) for p, link in left if link)
    return Block(node, joined, min(links, len(joined)))


def _released(runs: list[Run]) -> set[Node]:
    """The unlikely elements that take part after all, each with the unlikely
    elements around it. From the outermost inwards these are released:

    an element with more than half of the paragraph text and every h1; where
    nothing is left beside the unlikely elements, or one holds ``MUCH_MORE``
    times the paragraphs beside it, one with more than half of the paragraph
    text and those beside it that are named like it, else all; one with the
    page's only article. Navigation, footers, headers and asides go after
    these, readers' comments last of all, both only where nothing else is left.
    """
    own: dict[Node | None, list[int]] = {None: [0, 0, 0, 0]}  # characters: paragraphs, article, all; h1
    for node, pieces in runs:
        whole = _block((node, pieces), None)
        if not whole:
            continue
        paragraph = whole.chars >= LEAST_SCORED and 2 * whole.links <= whole.chars
        for piece, under, _ in pieces:
            up = under
            while up not in own:
                own[up] = [0, 0, 0, 0]
                up = up.parent.under
            n = len(piece.strip())
            for k, much in enumerate((n * paragraph, n * node.in_article, n, int(n and node.tag == "h1"))):
                own[under][k] += much
    if len(own) == 1:
        return set()
    total = {u: list(v) for u, v in own.items()}
    inner: dict[Node | None, list[Node]] = {u: [] for u in own}
    for u in sorted((u for u in own if u), key=lambda u: -u.order):
        inner[u.parent.under].append(u)
        total[u.parent.under] = [x + y for x, y in zip(total[u.parent.under], total[u])]
    page, left, held = total[None], [0, 0, 0, 0], 0
    released: set[Node | None] = set()
    by_text: list[tuple[int, int, Node]] = []
    by_article: list[tuple[int, int, Node]] = []
    readers: list[Node] = []
    last: list[Node] = []

    def release(nodes: list[Node | None]) -> None:
        nonlocal left, held
        while nodes:
            u = nodes.pop()
            released.add(u)
            left = [x + y for x, y in zip(left, own[u])]
            if u and not u.readers and not u.last:
                held -= total[u][0]
            for v in inner[u]:
                chars, article, _, h1 = total[v]
                if not v.readers and not v.last:
                    held += chars
                if 2 * chars > page[0] and 0 < page[3] == h1 and (not v.last or article):
                    nodes.append(v)
                elif v.readers:
                    readers.append(v)
                elif v.last and not article:
                    last.append(v)
                else:
                    heappush(by_text, (-chars, v.order, v))
                    if article and not v.in_article:
                        heappush(by_article, (-article, v.order, v))

    release([None])
    while True:
        for heap in (by_text, by_article):
            while heap and heap[0][2] in released:
                heappop(heap)
        most = by_text[0] if by_text else (0, 0, None)
        if by_text and (not left[2] or held >= LEAST_LEFT and not left[1] and -most[0] > MUCH_MORE * left[0]):
            group = [u for _, _, u in by_text if u not in released
                     and (-2 * most[0] <= page[0] or not u.words.isdisjoint(most[2].words))]
            release(group)
        elif by_article and not left[1] and -by_article[0][0] > left[0]:
            release([heappop(by_article)[2]])
        elif last and not left[2]:
            group, last = last, []
            release(group)
        elif readers and not left[2]:
            group, readers = readers, []
            release(group)
        else:
            return released - {None}


def parse(html: str) -> list[Block]:
    """Blocks of text outside dropped and unlikely elements, in page order.
    Ancestors of a block carry its points, characters and link characters."""
    root = Node("", None, "", 0)
    node, order = root, 0
    runs: list[Run] = []
    text: list[tuple[str, Node | None, bool]] = []
    link_depth = 0
    owner = root
    unended: set[str] = set()  # tags of RAW without an end tag in the rest of the page

    def flush() -> None:
        nonlocal text
        if text:
            runs.append((owner, text))
            text = []

    def add(piece: str) -> None:
        nonlocal owner
        if node.dropped or not piece:
            return
        if not text:
            owner = node
            while owner.parent and owner.tag not in BLOCK:
                owner = owner.parent
        text.append((piece, node.under, link_depth > 0))

    def close(upto: Node) -> None:
        """Leave ``upto`` and everything open inside it."""
        nonlocal node, link_depth
        while True:
            left, node = node, node.parent
            if left.tag == "a":
                link_depth -= 1
            if left.tag in BLOCK:
                flush()
            if left is upto:
                return

    at, end = 0, len(html)
    while at < end:
        token = TOKEN.search(html, at)
        if not token:
            add(html[at:])
            break
        add(html[at:token.start()])
        at = token.end()
        closing, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if not tag:
            continue  # comment, doctype
        tag = tag.lower()
        if closing:
            open_ = node
            while open_.parent and open_.tag != tag:
                if tag not in BLOCK and open_.tag in BLOCK:
                    break  # a stray inline end tag closes no block
                open_ = open_.parent
            if open_.parent and open_.tag == tag:
                close(open_)
            continue
        if tag in RAW:
            if tag in FOREIGN and attributes.endswith("/"):
                continue
            stop = None if tag in unended else RAW_END[tag].search(html, at)
            if stop:
                at = stop.end()
            elif tag == "script":
                at = end
            else:  # no end tag: only the tag itself and a style's rules are skipped
                unended.add(tag)
                if tag == "style":
                    at = html.find("<", at)
                    at = end if at < 0 else at
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            if tag in BLOCK:
                flush()
            elif tag == "br":
                add(" ")
            continue
        if tag in ENDS_P or tag in SAME_ENDS:
            ends = SAME_ENDS.get(tag, ())
            open_ = node
            while open_.parent:
                if (open_.tag == "p" and tag in ENDS_P) or open_.tag in ends:
                    close(open_)
                    if open_.tag == "p":
                        open_ = node
                        continue
                    break
                if open_.tag in SCOPES:
                    break
                open_ = open_.parent
        if tag in BLOCK:
            flush()
        order += 1
        node = Node(tag, node, attributes, order)
        link_depth += tag == "a"
    flush()
    released = _released(runs)
    return [b for run in runs if (b := _block(run, released))]


def score(blocks: list[Block]) -> dict[Node, float]:
    """Points of every container, discounted by its link density."""
    nodes: dict[Node, None] = {}
    for b in blocks:
        points = 0.0
        if b.chars >= LEAST_SCORED:
            points = 1.0 + b.text.count(",") + min(b.chars // 100, 3)
        holder = b.node if b.node.tag not in ("p", "pre", "li", "td", "blockquote", "h1", "h2", "h3",
                                              "h4", "h5", "h6") else b.node.parent
        up, level = b.node, 0
        while up is not None:
            up.chars += b.chars
            up.links += b.links
            nodes[up] = None
            up = up.parent
        while holder is not None and holder.parent is not None:
            holder.points += points if level == 0 else points / 2 if level == 1 else points / (3 * level)
            holder, level = holder.parent, level + 1
    return {n: n.points * (1.0 - n.links / n.chars) for n in nodes if n.chars}


def _inside(node: Node | None, tops: set[Node]) -> bool:
    while node is not None:
        if node in tops:
            return True
        node = node.parent
    return False


def _menu(b: Block) -> bool:
    """Whether a block is an entry of a list of links."""
    return 2 * b.links > b.chars and b.node.tag not in ("p", *HEADINGS)


def _article(scores: dict[Node, float], best: Node) -> Node | None:
    """The article (else main) that holds the page's text, if any: of the
    outermost ones that are no teasers (mostly links), the best."""
    for tag in ("article", "main"):
        named = {n for n in scores if n.tag == tag}
        found = [n for n in named if 2 * n.links <= n.chars and not _inside(n.parent, named)]
        if found:
            top = max(found, key=lambda n: (scores[n], n.chars, -n.order))
            # Several articles beside a much longer text are teasers too.
            if len(found) == 1 or _inside(best, set(found)) or 3 * sum(n.chars for n in found) >= best.chars:
                return top
    return None


def _tops(blocks: list[Block], scores: dict[Node, float]) -> set[Node]:
    """The elements whose blocks are kept."""
    best = max(scores, key=lambda n: (scores[n], -n.order))
    article = _article(scores, best)
    if article is None and scores[best] <= 0:  # nothing long enough
        return {n for n in scores if n.parent is None}
    best = article or best
    tops = {best}
    if best.tag in ("body", "html", "main") or best.parent is None:
        return tops
    children: dict[Node, None] = {}  # the best container and its siblings, in page order
    own: dict[Node, Block] = {}
    for b in blocks:
        up = b.node
        while up.parent is not None and up.parent is not best.parent:
            up = up.parent
        if up.parent is best.parent:
            children[up] = None
            if up is b.node:
                own[up] = b
    rows = list(children)
    least = max(10.0, SIBLING_SHARE * scores[best])
    within = best.parent.tag not in ("body", "html", "")
    for n in rows:
        if 4 * n.links >= n.chars or best.tag == "article" and n.tag != "article":
            continue
        alike = n.tag == best.tag and n.named == best.named and (within or bool(n.named)) and best.tag != "article"
        if scores[n] >= least or alike or n.tag == "p" and n.chars > LONG_SIBLING:
            tops.add(n)
    places = [i for i, n in enumerate(rows) if n in tops]
    low, high = places[0], places[-1]
    while low and rows[low - 1].tag in HEADINGS:  # headings in front
        low -= 1
    tops |= {n for n in rows[low:high + 1] if 2 * n.links <= n.chars}
    # The page's headline, wherever it stands in front.
    return tops | {n for n in rows[:low] if n.tag == "h1"}


def main_text(html: str) -> str:
    """Text of the best container and what belongs to it, blocks joined by an
    empty line."""
    blocks = parse(html)
    if not blocks:
        return ""
    tops = _tops(blocks, score(blocks))
    whole = {n for n in tops if n.tag in ("article", "main") or n.in_article}
    return "\n\n".join(b.text for b in blocks
                       if _inside(b.node, tops) and (not _menu(b) or _inside(b.node, whole)))


def _extractor(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    Null and empty html give an empty text; null ids and urls pass through;
    repeated rows are extracted each; of containers that score alike the first
    is taken; other columns are ignored; an empty table gives no rows. The
    whole page is read, however long."""
    ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extractor, "page_id long, url string, text string, n_chars long")
