"""Main text of web pages by nearest-URL page differencing.

Each page is read into text lines (one per block). Pages of a host are put in the order of their URL
paths, and each is paired with the neighbour that shares the longer path prefix. A neighbour that is a copy
(equal lines hold nine tenths of both texts) says nothing of what the site adds, so the next one that is no
copy takes its place. The pair's lines are aligned by a longest common subsequence and shared lines are
deleted, inside ``article`` and ``main`` too.
Markup adds to that: text in navigation, adverts, forms and the like always goes, and where half or more of
the text that is left stands in an ``article`` or ``main``, what is left outside them goes too.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.common import arrow_schema, chunks, col
from mediasift.llm.urls import split_url
from mediasift.session import materialize
from mediasift.sources.tables import table

#: Elements that begin and end a block (fixed values of the HTML standard's flow layout).
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; it is never text of the article.
RAW = frozenset("script style iframe noembed noframes xmp textarea title template".split())
#: Elements, roles and whole tokens of class or id that hold no article text; tokens say nothing of ``KEPT_TAGS``.
DROP_TAGS = frozenset("nav footer aside form menu dialog button select noscript svg math canvas object audio video head".split())
KEPT_TAGS = frozenset("html body main article".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
DROP_WORDS = frozenset("""ad ads advert adverts advertisement banner promo sponsor sponsored cookie cookies consent
notice sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies share sharing
social related newsletter subscribe popup modal pagination login signup advertising respond disqus""".split())

#: Elements that hold running text: what an article has in them is its own.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th figcaption caption".split())
#: A class or id token also counts by its first part (``comment-list``), or by its last after one of these (``site-footer``).
WHOLE_PAGE = frozenset("site page global".split())
#: Bits of a line's length in its signature; a line of over a million characters counts as one of a million.
LENGTH_BITS = 20
#: Share of the text of the longer body from which on two pages are copies; pages that a chain remembers.
COPY_SHARE, CHAIN = 0.9, 4
_BODY = np.uint64(1)
_LOW = LENGTH_BITS + 1

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def _drop_token(token: str) -> bool:
    parts = re.split("[-_]", token)
    return token in DROP_WORDS or parts[0] in DROP_WORDS or parts[0] in WHOLE_PAGE and parts[-1] in DROP_WORDS


def _dropped(tag: str, attrs: str, inside: bool) -> int:
    """2: a dropped element by its tag or role, 1: by a token of its class or id, 0: none."""
    if tag in DROP_TAGS or tag == "header" and not inside:
        return 2
    if not attrs.strip():
        return 0
    found = 0
    for name, a, b, c in _ATTR.findall(attrs):
        value = html.unescape(a or b or c).lower()
        if name.lower() in ("class", "id") and tag not in KEPT_TAGS and any(map(_drop_token, value.split())):
            found = 1
        if name.lower() == "role" and value.strip() in DROP_ROLES:
            return 2
    return found


class _Open:
    """An open element: what it starts, and what to restore at its end."""

    __slots__ = ("tag", "article", "drop", "outer", "parts")

    def __init__(self, tag, article, drop, outer, parts):
        self.tag, self.article, self.drop, self.outer, self.parts = tag, article, drop, outer, parts


def page_lines(page: str | None) -> list[tuple[str, int, bool]]:
    """(text, in an article, in a dropped element) of each block with text, in page order; the second is 2 in a
    ``PROSE`` element of an article, 1 elsewhere in it, else 0.

    An article or main inside an element that only its class or id would drop is not dropped with it. A
    dropped inline element (a button or select within a paragraph) leaves its block in one piece.
    """
    page = page or ""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    stack: list[_Open] = []
    prose = 0
    article = strong = weak = pos = 0  # open articles, elements dropped by tag, elements dropped by class

    def flush():
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append((text, (2 if prose else 1) if article else 0, strong + weak > 0))

    def leave():
        nonlocal article, strong, weak, prose
        e = stack.pop()
        prose -= e.tag in PROSE
        if e.parts is not None:  # a dropped inline element: its text goes, the block goes on
            parts[:] = [*e.parts, " "]
        elif e.article or e.drop:
            flush()
        article, strong, weak = article - e.article, strong - (e.drop == 2), e.outer if e.article else weak - (e.drop == 1)
        return e.tag

    while True:
        lt = page.find("<", pos)
        if lt < 0:
            parts.append(page[pos:])
            break
        if lt > pos:
            parts.append(page[pos:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2 if page.startswith("<!-->", lt) else lt + 4)
            pos = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            pos = len(page) if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            if re.match(r"</?[a-zA-Z]", page[lt:lt + 3]):  # a tag that never ends
                break
            parts.append("<")
            pos = lt + 1
            continue
        close, tag, attrs, pos = m.group(1), m.group(2).lower(), m.group(3), m.end()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
        if close:
            if any(e.tag == tag for e in stack):
                while leave() != tag:
                    pass
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, pos)
            if not end:
                pos = len(page)
            else:
                gt = page.find(">", end.start())
                pos = len(page) if gt < 0 else gt + 1
            continue
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if tag in BLOCKS and stack and stack[-1].tag == "p":
            leave()
        a, d = tag in ("article", "main"), _dropped(tag, attrs, article > 0)
        held = None
        if d and tag not in BLOCKS and not a:
            held = list(parts)
            parts.clear()
        elif a or d:
            flush()
        stack.append(_Open(tag, a, d, weak, held))
        prose += tag in PROSE
        article, strong, weak = article + a, strong + (d == 2), 0 if a else weak + (d == 1)
    while stack:
        leave()
    flush()
    return lines


def signature(lines) -> np.ndarray:
    """One number for each line outside dropped elements: 43 bits of its hash, its length (``LENGTH_BITS``) and
    whether it is of the body. By the tags, the body is what stands in an ``article`` or ``main`` if that is
    half of the page's text or more, else everything."""
    lines = [(t, a) for t, a, d in lines if not d]
    inside = sum(len(t) for t, a in lines if a)
    tagged = inside > 0 and 2 * inside >= sum(len(t) for t, _ in lines)
    return np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) >> _LOW << _LOW
                     | min(len(t), (1 << LENGTH_BITS) - 1) << 1 | (a > 0 or not tagged) for t, a in lines], "<u8")


def is_copy(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the bodies of two pages share nearly all of their text, as characters of equal lines in any order."""
    (x, m), (y, n) = (np.unique(k[k & _BODY > 0], return_counts=True) for k in (a, b))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    size = lambda keys, counts: int(((keys >> np.uint64(1) & np.uint64((1 << LENGTH_BITS) - 1)).astype(np.int64) * counts).sum())
    return size(x[i], np.minimum(m[i], n[j])) >= COPY_SHARE * max(size(x, m), size(y, n))


def common_lines(a: list, b: list) -> list[bool]:
    """Which items of ``a`` are in a longest common subsequence with ``b``. Bit-parallel; every ``step``-th
    row is kept and the rows between are computed again on the way back, so memory stays near sqrt(n) rows."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    mid_a, mid_b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    in_b, in_a = set(mid_b), set(mid_a)
    at = [i for i, x in enumerate(mid_a) if x in in_b]
    cols = [x for x in mid_b if x in in_a]
    out = [True] * lo + [False] * len(mid_a) + [True] * hi
    if not at or not cols:
        return out
    full, masks = (1 << len(cols)) - 1, {}
    for j, x in enumerate(cols):
        masks[x] = masks.get(x, 0) | 1 << j
    n, step = len(at), max(1, int(len(at) ** 0.5))

    def after(v: int, i: int) -> int:
        u = v & masks[mid_a[at[i]]]
        return ((v + u) | (v - u)) & full

    kept, v = [full], full
    for i in range(n):
        v = after(v, i)
        if (i + 1) % step == 0:
            kept.append(v)
    row, c = n, len(cols)
    while row and c:
        base = (row - 1) // step * step
        rows = [kept[base // step]]
        for i in range(base, row):
            rows.append(after(rows[-1], i))
        while row > base and c:
            if rows[row - base] >> (c - 1) & 1:
                c -= 1
                continue
            row -= 1
            if not rows[row - base] >> (c - 1) & 1:
                continue
            out[lo + at[row]] = True
            c -= 1
    return out


def kept_inside(own: list, prose: list, there: list):
    """For each line of a tagged article whether it stays although the other page has it. Two articles may hold
    one sentence or heading: a line that the other body holds too stays if it stands in a ``PROSE`` element, else
    it goes only where both bodies begin or end with it. A line that the other page has outside its body goes."""
    head = next((i for i, (x, y) in enumerate(zip(own, there)) if x != y), min(len(own), len(there)))
    tail = next((i for i, (x, y) in enumerate(zip(own[::-1], there[::-1])) if x != y), min(len(own), len(there)))
    body = set(there)
    for i, (k, p) in enumerate(zip(own, prose, strict=True)):
        yield k in body and (p or head <= i < len(own) - tail)


def article_text(page: str | None, near: np.ndarray | None) -> str:
    """Text of the page's blocks that stay, given the signature of the page it is paired with."""
    lines = page_lines(page)
    inside = sum(len(t) for t, a, d in lines if a and not d)
    guarded = inside > 0 and 2 * inside >= sum(len(t) for t, _, d in lines if not d)
    shared = [False] * len(lines)
    if near is not None:
        own = (signature(lines) & ~_BODY).tolist()
        there = (near[near & _BODY > 0] & ~_BODY).tolist()
        inner = [a for _, a, d in lines if not d]
        held = kept_inside([k for k, a in zip(own, inner, strict=True) if a], [a > 1 for a in inner if a], there) if guarded else iter(())
        stays = [a and next(held, False) for a in inner]
        same = iter([s and not k for s, k in zip(common_lines(own, (near & ~_BODY).tolist()), stays, strict=True)])
        shared = [not d and next(same) for _, _, d in lines]
    left = [(t, a) for (t, a, d), s in zip(lines, shared, strict=True) if not d and not s]
    inside = sum(len(t) for t, a in left if a)
    tagged = inside > 0 and 2 * inside >= sum(len(t) for t, _ in left)
    return "\n\n".join(t for t, a in left if a or not tagged)


class _Chain:
    """Pages of one host behind a walk: the last page, the nearest one before it that is no copy of it, and so
    on. A copy of the last page takes over the rest of the chain: a run of copies, however long, is one step."""

    def __init__(self):
        self.host, self.pages = None, []

    def pair(self, host: str, path: str, sig: np.ndarray):
        """The nearest page that is no copy of this one, or None; then this page is the last."""
        found = [] if host != self.host else next(
            (self.pages[i:] for i, (_, other) in enumerate(self.pages) if not is_copy(sig, other)), [])
        self.host, self.pages = host, [(path, sig), *found][:CHAIN]
        return found[0] if found else None


_DEALT = "pid int, at int, u1 long, u2 long, host string, path string, sig binary"


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _ends(schema):
    """The pages of one range pass; behind them come its chains: first pages (``at`` 1, 2, ...) and last ones (-1, ...)."""
    def run(batches):
        chain, head, host, pid = _Chain(), [], None, None
        for batch in batches:
            for pid, _, _, _, h, path, sig in _rows([batch]):
                if not sig:
                    continue
                sig, host = np.frombuffer(sig, "<u8"), h if host is None else host
                if h == host and len(head) < CHAIN and not (head and is_copy(head[-1][1], sig)):
                    head.append((path, sig))
                chain.pair(h, path, sig)
            yield pa.RecordBatch.from_arrays(batch.columns, schema=schema)
        ends = [(pid, at * k, 0, 0, h, path, sig.tobytes()) for at, h, pages in ((1, host, head), (-1, chain.host, chain.pages))
                for k, (path, sig) in enumerate(pages, 1)]
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ends, strict=True), schema, strict=True)], schema=schema)

    return run


def _across(schema, sign: int):
    """Chains of the ranges, range by range and the farthest page first -> for each range the chain that leads to it."""
    def run(batches):
        chain, last = _Chain(), None
        for pid, _, _, _, host, path, sig in _rows(batches):
            if pid != last and chain.pages:
                rows = [(pid, sign * k, 0, 0, chain.host, x, s.tobytes()) for k, (x, s) in enumerate(chain.pages, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            last = pid
            chain.pair(host, path, np.frombuffer(sig, "<u8"))

    return run


def _prefix(x: str, y: str) -> int:
    k = 0
    while k < min(len(x), len(y)) and x[k] == y[k]:
        k += 1
    return k


def _pick(batches):
    """Pages of ranges in order, each range between the chains that lead to it -> (u1, u2, near)."""
    done: list = []
    waiting: list = []  # pages of the last run of copies: the page behind the run is the next for all of them
    chain, last = _Chain(), None

    def settle(path=None, sig=None):
        for u1, u2, x, own, before in waiting:
            after = None if sig is None or is_copy(own, sig) else (path, sig)
            if before and after:
                before = after if _prefix(x, after[0]) > _prefix(x, before[0]) else before
            near = before or after
            done.append((u1, u2, None if near is None else near[1].tobytes()))
        waiting.clear()

    def batch():
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                         names=["u1", "u2", "near"])
        done.clear()
        return out

    for pid, at, u1, u2, host, path, sig in _rows(batches):
        if not sig:
            done.append((u1, u2, None))
            continue
        sig = np.frombuffer(sig, "<u8")
        if pid != last:
            settle()
            chain, last = _Chain(), pid
        if host != chain.host:
            settle()
        elif waiting and not is_copy(waiting[-1][3], sig):
            settle(path, sig)
        before = chain.pair(host, path, sig)
        if at == 0:
            waiting.append((u1, u2, path, sig, before))
        if len(done) >= 1000:
            yield batch()
    settle()
    if done:
        yield batch()


def _neighbours(keys: DataFrame) -> DataFrame:
    """(u1, u2, near): signature of each page's pair. ``keys``: u1, u2, host, path, sig, distinct."""
    n = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order, schema = ["host", "path", "u1", "u2"], arrow_schema(_DEALT)
    dealt = keys.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("pid"), F.lit(0).alias("at"), "u1", "u2", "host", "path", "sig")
    dealt = materialize(dealt.mapInArrow(_ends(schema), _DEALT), "page-order")
    # pages at the ends of a range may have their neighbour in another range: at most CHAIN rows a range and side
    one = dealt.filter("at <> 0").repartition(1)
    before = one.filter("at < 0").sortWithinPartitions("pid", "at").mapInArrow(_across(schema, -1), _DEALT)
    behind = one.filter("at > 0").sortWithinPartitions(F.desc("pid"), F.desc("at")).mapInArrow(_across(schema, 1), _DEALT)
    pages = dealt.filter("at = 0").unionByName(before).unionByName(behind)
    return pages.repartition(n, "pid").sortWithinPartitions("pid", "at", *order).mapInArrow(
        _pick, "u1 long, u2 long, near binary")


def extract_text(df: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row (page_id, url, text) per row of ``df``.

    A null page is empty, an empty page has the empty text. Pages with a null URL, or one without ``://``,
    form one host with an empty path. Equal rows share their neighbour and result; the first neighbour wins
    a tie. A page that has nothing but copies of itself on its host has no pair: all its text counts as its own.
    Other columns are ignored. Only keys and line hashes are sorted, by ranges of (host, path), so a
    hot host is spread over many tasks; the pages themselves move once, for the join with their neighbours.
    """
    src = df.select(col(page_id).alias("page_id"), col(url).alias("url"), col(page).alias("html")).withColumn(
        "u1", F.xxhash64("page_id", "url")).withColumn("u2", F.xxhash64("html", "url", F.lit("page")))
    schema = arrow_schema("u1 long, u2 long, host string, path string, sig binary")

    def keys(batches):
        for part in chunks(batches, "html"):
            urls, pages = part.column(0).to_pylist(), part.column(1).to_pylist()
            split = [split_url(u) for u in urls]
            sigs = [signature(page_lines(p)).tobytes() for p in pages]
            yield pa.RecordBatch.from_arrays(
                [part.column(2), part.column(3), pa.array([h for h, _ in split], pa.string()),
                 pa.array([p for _, p in split], pa.string()), pa.array(sigs, pa.binary())], schema=schema)

    found = src.select("url", "html", "u1", "u2").mapInArrow(keys, "u1 long, u2 long, host string, path string, sig binary")
    distinct = found.groupBy("u1", "u2").agg(*[F.first(c).alias(c) for c in ("host", "path", "sig")])
    paired = src.join(_neighbours(distinct), ["u1", "u2"], "left").select("page_id", "url", "html", "near")
    out_schema = arrow_schema("text string")

    def texts(batches):
        for part in chunks(batches, "html"):
            pages, near = part.column(2).to_pylist(), part.column(3).to_pylist()
            text = [article_text(p, None if s is None else np.frombuffer(s, "<u8")) for p, s in zip(pages, near, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, out_schema.field(0).type)],
                                             names=["page_id", "url", "text"])

    ids = dict(paired.dtypes)
    return paired.mapInArrow(texts, f"page_id {ids['page_id']}, url string, text string")


def op9_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op9_html_text": op9_html_text}
ORACLE: dict[str, str] = {}  # parsing and alignment; tested by brute force and planted pages
