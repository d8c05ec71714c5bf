"""Alignment of two tokenizers' tokens by byte offsets, merged along merge-path diagonals.

Both tokenizers cut the same bytes, so each gives a sorted list of token ends. Merging the lists finds the
overlaps of A and B tokens and the offsets where both end. The merge is divided by diagonals: diagonal d
crosses the merge path where the first d elements of the merged list are taken, a binary search finds how
many of them come from A, and between two diagonals lies a piece of equal work that needs nothing from
the others. The ends of all texts of a batch follow one another in one list, so a long text is as many
pieces as short ones of its size. Pieces emit their overlaps and cuts; a group that crosses a piece's
border has its first tokens in one piece and its cut in a later one and is stitched there.

Corpus counts of linked id pairs: texts fall into blocks of bounded size, a block holds each of its
distinct pairs once, and only these rows are counted, joined with their counts and sent back to the block.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediasift.llm.bpe import PATTERN, _byte_letters
from mediasift.llm.bpe import default_path as path_a_default
from mediasift.llm.common import chunks, col, map_text
from mediasift.session import materialize
from mediasift.sources.tables import table

IDS = np.dtype("<u4")
#: Merged ends of one piece.
PIECE_WORK = 65_536
#: Links of one block (a text with more is a block of its own).
BLOCK_LINKS = 500_000


def path_b_default() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- tokenizers ---

class TokenizerA:
    """Byte-level BPE; ids and their bytes. Special tokens' strings are ordinary text."""

    def __init__(self, spec: str):
        data, letters = json.loads(spec), _byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in data["model"]["vocab"].items()
                 if i not in {s["id"] for s in data["added_tokens"]}}
        self.encoding = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.bytes_of[i] = t

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts]


class TokenizerB:
    """Sentencepiece model with byte fallback; it adds the space itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.bytes_of = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(map(self.model.id_to_piece, range(size)))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def _tokenizers(spec_a: str, model_b: bytes):
    a, b = TokenizerA(spec_a), TokenizerB(model_b)
    return a, b, np.array(list(map(len, a.bytes_of))), np.array(list(map(len, b.bytes_of)))


# --- merge path ---

def diagonal_cuts(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """(places in a, places in b) where the merge of the sorted lists is divided into pieces of ``work``.

    One binary search per diagonal, all diagonals at once; of equal elements that of ``a`` comes first, and
    a border between two equal elements moves behind both, so that a common end lies in one piece.
    """
    d = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        at = np.flatnonzero(open_)
        first = a[mid[at]] <= b[d[at] - 1 - mid[at]]
        low[at[first]] = mid[at[first]] + 1
        high[at[~first]] = mid[at[~first]]
    i, j = low, d - low
    split = np.flatnonzero((i > 0) & (j < len(b)))
    split = split[a[i[split] - 1] == b[j[split]]]
    j[split] += 1
    return i, j


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Overlaps (token of a, token of b, whether both end there) whose ends lie in the piece."""
    mine, other = a[i0:i1], b[j0:j1]
    ends = np.concatenate((mine, other))
    ends.sort(kind="stable")
    if len(ends):
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))]
    x, y = np.searchsorted(mine, ends), np.searchsorted(other, ends)
    both = np.zeros(len(ends), bool)
    inside = (x < len(mine)) & (y < len(other))
    both[inside] = (mine[x[inside]] == ends[inside]) & (other[y[inside]] == ends[inside])
    return x + i0, y + j0, both


def stitch(pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of all pieces in order. A group left open by a piece ends with the next cut, in any later
    piece, so the groups of the whole are the stretches between the cuts of all pieces."""
    parts = list(pieces)
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def merge(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps of two token lists given by their ends, piece by piece."""
    i, j = diagonal_cuts(a, b, work)
    return stitch(merge_piece(a, b, *place) for place in zip(i[:-1], i[1:], j[:-1], j[1:], strict=True))


# --- operator ---

ALIGNED = "a_ids binary, b_ids binary, a_cuts binary, b_cuts binary, n_overlaps long"


def align_texts(texts: list, a: TokenizerA, b: TokenizerB, len_a: np.ndarray, len_b: np.ndarray,
                work: int = PIECE_WORK) -> list[tuple]:
    """(A ids, B ids, A cuts, B cuts, number of overlaps) of each text of a batch, merged as one list."""
    none = np.empty(0, np.int64)
    out = [(none, none, none, none, 0)] * len(texts)
    there = [k for k, t in enumerate(texts) if t]
    given = [texts[k] for k in there]
    kept, ids_a, ids_b = [], [], []
    for k, t, x, y in zip(there, given, a.encode(given), b.encode(given), strict=True):
        raw = (" " + t).encode()
        if (b"".join(map(a.bytes_of.__getitem__, x.tolist())) == raw
                and b"".join(map(b.bytes_of.__getitem__, y.tolist())) == raw):
            kept.append(k)
            ids_a.append(x)
            ids_b.append(y)
    if not kept:
        return out
    ends_a, ends_b = np.cumsum(len_a[np.concatenate(ids_a)]), np.cumsum(len_b[np.concatenate(ids_b)])
    over_a, over_b, both = merge(ends_a, ends_b, work)
    cuts_a, cuts_b = over_a[both] + 1, over_b[both] + 1
    last_a, last_b = np.cumsum(list(map(len, ids_a))), np.cumsum(list(map(len, ids_b)))
    to_cut = np.searchsorted(cuts_a, last_a, side="right")
    to_over = np.searchsorted(over_a, last_a, side="left")
    c0 = o0 = 0
    for n, k in enumerate(kept):
        c1, o1 = to_cut[n], to_over[n]
        out[k] = (ids_a[n], ids_b[n], cuts_a[c0:c1] - (last_a[n] - len(ids_a[n])), cuts_b[c0:c1] - (last_b[n] - len(ids_b[n])), int(o1 - o0))
        c0, o0 = c1, o1
    return out


def _files(df: DataFrame, path_a: str | None, path_b: str | None):
    with open(path_a or path_a_default(), encoding="utf-8") as f, open(path_b or path_b_default(), "rb") as g:
        return df.sparkSession.sparkContext.broadcast((f.read(), g.read()))  # two vocabulary files


def align(df: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
          work: int = PIECE_WORK) -> DataFrame:
    """Add ``a_ids``, ``b_ids`` (tokens of space + text), ``a_cuts``, ``b_cuts`` (for each group, how many A and
    B tokens lie up to its end), all little-endian unsigned 32-bit integers, and ``n_overlaps``.

    Null and empty texts, and texts whose joined A or B bytes differ from space + text (as with the letter
    U+2581), have no tokens: empty values, 0. All other columns pass through; input columns of the results'
    names are replaced. Repeated rows each get their result; a text of any length is handled whole by one
    task. One map, no shuffle; an empty table gives an empty table.
    """
    files = _files(df, path_a, path_b)

    def make():
        tokenizers = _tokenizers(*files.value)

        def run(texts):
            done = align_texts(texts, *tokenizers, work)
            return [*([x[c].astype(IDS).tobytes() for x in done] for c in range(4)), [x[4] for x in done]]

        return run

    return map_text(df, text_col, ALIGNED, make)


@lru_cache(maxsize=2)
def _numerals(most: int) -> np.ndarray:
    """Bytes of each id with the sign that follows it: comma, bar, semicolon."""
    return np.array([b"%d" % i + s for s in (b",", b"|", b";") for i in range(most)], object)


def groups_text(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, most: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` for the groups of one text."""
    if not len(cuts_a):
        return b""
    group_a, group_b = np.repeat(np.arange(len(cuts_a)), np.diff(cuts_a, prepend=0)), np.repeat(
        np.arange(len(cuts_b)), np.diff(cuts_b, prepend=0))
    codes = np.empty(len(a) + len(b), np.int64)
    mark_a, mark_b = a.copy(), b.copy()
    mark_a[cuts_a - 1] += most
    mark_b[cuts_b - 1] += 2 * most
    codes[np.arange(len(a)) + np.concatenate(([0], cuts_b))[group_a]] = mark_a
    codes[np.arange(len(b)) + cuts_a[group_b]] = mark_b
    return b"".join(_numerals(most)[codes].tolist())[:-1]


def _blocks(id_field: T.StructField, files, most: int, work: int, block_links: int):
    """Rows (id, text) -> one row per text, and one per distinct id pair of each block of texts."""
    schema = T.StructType([T.StructField("id", id_field.dataType), *T.StructType.fromDDL(
        "n_a long, n_b long, groups_sha256 string, codes binary, block long, code int, pair long, n long").fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        tokenizers = _tokenizers(*files.value)
        target = to_arrow_schema(schema)
        task, seq = TaskContext.get().partitionId() << 32, 0
        rows: list[tuple] = []
        links: list[np.ndarray] = []
        held = 0

        def flush():
            pairs, code, n = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            code, at, packed = code.astype(IDS), 0, []
            for part in links:
                packed.append(code[at:at + len(part)].tobytes())
                at += len(part)
            columns = [*zip(*rows, strict=True), packed, [task + seq] * len(rows)]
            for lo in range(0, len(rows), 1024):
                cut = [pa.array(c[lo:lo + 1024], f.type) for c, f in zip(columns, target, strict=False)]
                size = len(cut[0])
                yield pa.RecordBatch.from_arrays([*cut, *(pa.nulls(size, f.type) for f in list(target)[6:])], schema=target)
            for lo in range(0, len(pairs), 65_536):
                p = pairs[lo:lo + 65_536]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(len(p), f.type) for f in list(target)[:5]), pa.array(np.full(len(p), task + seq)),
                     pa.array(np.arange(lo, lo + len(p), dtype=np.int32)), pa.array(p), pa.array(n[lo:lo + 65_536])], schema=target)

        for part in chunks(batches, "text"):
            done = align_texts(part.column(1).to_pylist(), *tokenizers, work)
            for key, (a, b, ca, cb, _) in zip(part.column(0).to_pylist(), done, strict=True):
                text = groups_text(a, b, ca, cb, most)
                rows.append((key, len(a), len(b), hashlib.sha256(text).hexdigest() if text else ""))
                links.append(a[ca - 1] << 32 | b[cb - 1])
                held += len(ca) + 1
                if held >= block_links:
                    yield from flush()
                    rows, links, held, seq = [], [], 0, seq + 1
        if rows:
            yield from flush()

    return run, schema


def link_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                path_b: str | None = None, work: int = PIECE_WORK, block_links: int = BLOCK_LINKS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``df``, aligned as by ``align``.

    A link is a pair of an A and a B token that end at the same byte; the count of an id pair is the number
    of links that hold it in all rows (repeated rows count each time). ``n_best``: links whose pair has the
    highest count among the pairs of its B id, ties included; ``count_sum``: the sum of the links' counts.
    ``groups_sha256`` is the digest of ``groups_text``, empty for a row without tokens, whose numbers are 0. A
    null id stays null. Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    most = 1 << 17  # more than either vocabulary's size
    run, schema = _blocks(df.schema[id_col], _files(df, path_a, path_b), most, work, block_links)
    texts = df.select(col(id_col).alias("id"), col(text_col).alias("text"))
    stored = materialize(texts.mapInArrow(run, schema), "align")
    texts = stored.filter("pair is null").select("id", "n_a", "n_b", "groups_sha256", "codes", "block")
    pairs = stored.filter("pair is not null").select(F.col("block").alias("of"), "code", "pair", "n")
    by_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))  # a B id has one row for an A id
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("c")).withColumn("best", F.col("c") == F.max("c").over(by_b))
    answers = pairs.select("of", "code", "pair").join(counts, "pair").select("of", "code", "c", "best")
    result = T.StructType([T.StructField(id_col, schema["id"].dataType), *T.StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        c, best = np.zeros(size, np.int64), np.zeros(size, bool)
        code = right.column("code").to_numpy()
        c[code], best[code] = right.column("c").to_numpy(), right.column("best").to_numpy()
        own = [np.frombuffer(x or b"", IDS) for x in left.column("codes").to_pylist()]
        n = pa.array([len(x) for x in own], pa.int64())
        return pa.Table.from_arrays(
            [left.column("id"), left.column("n_a"), left.column("n_b"), n, n, pa.array([int(best[x].sum()) for x in own], pa.int64()),
             pa.array([int(c[x].sum()) for x in own], pa.int64()), left.column("groups_sha256")], names=result.names)

    return texts.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(total, result)


def op11_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return link_counts(docs)


QUERIES = {"op11_alignment": op11_alignment}
ORACLE: dict[str, str] = {}  # token merges are not expressible in SQL; tested against brute force
