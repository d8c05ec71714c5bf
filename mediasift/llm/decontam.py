"""Benchmark decontamination with one Aho-Corasick automaton over word windows of the test items."""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.common import col, keep_rows, map_text
from mediasift.sources.tables import table

WINDOW = 10

#: Test sets are small and hand-made; a larger table is refused instead of being broadcast.
MAX_BENCHMARK_CHARS = 64_000_000

#: A-Z to a-z; every other ASCII character that is no letter or digit becomes a space.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normal_words(text: str | None) -> list[str]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return [] if text is None else [w for w in text.encode().translate(_NORMAL).decode().split(" ") if w]


def build_automaton(items: list[tuple[str, str]], window: int = WINDOW):
    """Automaton of all windows; a value is (number of words, indexes of the items that hold the window)."""
    found: dict[str, tuple[int, list[int]]] = {}
    for k, (_, text) in enumerate(items):
        words = normal_words(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if size else ():
            of = found.setdefault(" " + " ".join(words[i:i + size]) + " ", (size, []))[1]
            if not of or of[-1] != k:
                of.append(k)
    automaton = ahocorasick.Automaton()
    for pattern, value in found.items():
        automaton.add_word(pattern, value)
    if found:
        automaton.make_automaton()
    return automaton


_BUILT: dict = {}  # of this Python worker: the automaton of the last call


def scan(automaton, ids: list[str], text: str | None):
    """(words, hit words, item ids found, hit spans as offsets in ``text``)."""
    words = normal_words(text)
    if not words or not len(automaton):
        return len(words), 0, [], []
    marks, found = None, set()
    for end, (size, items) in automaton.iter(" " + " ".join(words) + " "):
        if marks is None:
            marks = np.zeros(len(words) + 1, np.int64)
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()  # where the space after each word stands
        last = bisect_left(ends, end) + 1
        marks[last - size] += 1
        marks[last] -= 1
        found.update(items)
    if marks is None:
        return len(words), 0, [], []
    hit = np.cumsum(marks)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    at = [m.span() for m in _WORD.finditer(text)]
    spans = [(at[a][0], at[b - 1][1]) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
    return len(words), int(hit.sum()), [ids[k] for k in sorted(found)], spans


def find_contamination(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (distinct ids as text) and ``spans`` (start, end offsets of the
    hit passages in the original text, end exclusive).

    A document word inside any occurrence of a window of ``window`` consecutive item words is hit; an item
    of fewer words is one window. Null and empty texts have no words and no hit; items with null or empty
    text or a null id are left out; a repeated item counts once. The benchmark (bounded by
    ``MAX_BENCHMARK_CHARS``, checked before it is read) is broadcast; each text is scanned once. No shuffle.
    """
    items = items.select(col(item_id).cast("string").alias("i"), col(item_text).alias("t")).dropna()
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    if size > MAX_BENCHMARK_CHARS:
        raise ValueError(f"benchmark of {size} characters; at most {MAX_BENCHMARK_CHARS} are broadcast")
    rows = df.sparkSession.sparkContext.broadcast(sorted({(r.i, r.t) for r in items.collect()}))
    call = uuid.uuid4().hex

    def make():
        if _BUILT.get("of") != call:
            _BUILT.update(of=call, automaton=build_automaton(rows.value, window))
        automaton, ids = _BUILT["automaton"], [i for i, _ in rows.value]

        def run(texts):
            out = [scan(automaton, ids, t) for t in texts]
            return ([n for n, _, _, _ in out], [h for _, h, _, _ in out],
                    [sorted(set(i)) for _, _, i, _ in out],
                    [[{"start": a, "end": b} for a, b in s] for _, _, _, s in out])

        return run

    return map_text(df, text_col, "n_words long, n_hit long, items array<string>, "
                                  "spans array<struct<start:int,end:int>>", make)


def drop_contaminated(df: DataFrame, items: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` without any hit, with all columns as they were, whatever their names."""
    return keep_rows(df, [text_col], lambda rows, text: find_contamination(rows, items, text, **how).filter("n_hit = 0"))


def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {"op6_decontamination": op6_decontamination}

#: Words, then windows as joined strings; a hit word is one that lies in a matched window.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = r"list_filter(string_split_regex({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

ORACLE = {"op6_decontamination": f"""
WITH item_words AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_SPLIT.format(_LOWER.format('text'))} AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
                lambda i: array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' '))) AS piece
  FROM item_words WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows
), doc_words AS (
  SELECT row_number() OVER () AS row_no, doc_id, {_SPLIT.format(_LOWER.format("coalesce(text, '')"))} AS w
  FROM documents
), doc_windows AS (
  SELECT row_no, size, w, unnest(range(1, len(w) - size + 2)) AS pos FROM doc_words, sizes WHERE len(w) >= size
), matched AS (
  SELECT d.row_no, d.pos, d.size, x.item
  FROM (SELECT row_no, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS piece FROM doc_windows) d
  JOIN windows x ON x.piece = d.piece AND x.size = d.size
), hit AS (
  SELECT row_no, count(DISTINCT p) AS n_hit
  FROM (SELECT row_no, unnest(range(pos, pos + size)) AS p FROM matched) GROUP BY row_no
), of_items AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row_no, item FROM matched) GROUP BY row_no
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (row_no) LEFT JOIN of_items USING (row_no)"""}
