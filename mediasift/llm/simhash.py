"""SimHash near-duplicates with a Gray-order hierarchical index over exact block tables.

Distinct fingerprints go to ``C(d+2, 2)`` tables (ten at distance d = 3). The 64 bits are cut into
d+2 blocks; two fingerprints within d bits agree on at least two blocks, so they meet in the bucket of
one of the block pairs. Inside a bucket the fingerprints are sorted by Gray rank and put into a tree:
a node keeps the bits on which all its members agree and that no upper node keeps. A query walks down,
adds up its differences from the nodes' bits and leaves whole groups as soon as the sum exceeds d.
Groups that already belong to the query's component are left too, so a bucket of near copies costs
about one pass and yields a forest of links, never its pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediasift.llm.common import col, keep_rows, lower_words, map_text
from mediasift.llm.components import connected_components
from mediasift.session import materialize
from mediasift.sources.tables import table

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: A bucket with more fingerprints is dealt to a second set of tables over the bits it has not used.
MAX_BUCKET = 1_000_000
FANOUT = 8
_U = np.uint64


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is 1 if over half of the shingle hashes (repeats included) have it."""
    words = lower_words(text)
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), seed)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start:start + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text_col: str = "text", size: int = SHINGLE, seed: int = SEED,
                     name: str = "fp") -> DataFrame:
    """Add ``fp`` (the fingerprint as signed long). Null and empty texts have fingerprint zero."""
    def make():
        return lambda texts: [np.array([fingerprint(t, size, seed) for t in texts], np.uint64).view(np.int64)]

    return map_text(df, text_col, f"`{name}` long", make)


def block_masks(bits: list[int], max_bits: int) -> list[int]:
    """Masks over the given bit positions, one for each pair of blocks that must agree."""
    blocks = np.array_split(np.array(bits), max_bits + 2)
    return [sum(1 << int(b) for b in (*x, *y)) for x, y in combinations(blocks, 2)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each word in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> _U(s)
    return x


class GrayIndex:
    """Hierarchical index over distinct fingerprints in Gray order; nodes of a level lie side by side."""

    def __init__(self, fps: np.ndarray, fanout: int = FANOUT):
        self.fps, self.fanout = fps[np.argsort(gray_rank(fps), kind="stable")], fanout
        same = np.full(len(self.fps), ~_U(0))  # bits on which all members agree, leaf level first
        pattern, levels = self.fps, [(same, self.fps)]
        while len(pattern) > 1:
            starts = np.arange(0, len(pattern), fanout)
            agree = np.bitwise_and.reduceat(same, starts) & ~(
                np.bitwise_or.reduceat(pattern, starts) & np.bitwise_or.reduceat(~pattern, starts))
            same, pattern = agree, pattern[starts]
            levels.append((same, pattern))
        # each level keeps only the bits that no upper level has compared already
        self.levels = [(s & ~np.repeat(levels[i + 1][0], fanout)[:len(s)] if i + 1 < len(levels) else s, p)
                       for i, (s, p) in enumerate(levels)]

    def links(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Edges of a forest that connects what lies within ``max_bits``, and nothing else."""
        n = len(self.fps)
        parent = np.arange(n)
        out: list[tuple[int, int]] = []

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        step = max(1, min(64, n))
        for lo in range(0, n, step):
            labels = parent  # flatten once per block of queries: then a label is a component
            while True:
                up = labels[labels]
                if np.array_equal(up, labels):
                    break
                labels = up
            parent = labels.copy()
            lows, highs = [labels], [labels]
            for _ in self.levels[1:]:
                starts = np.arange(0, len(lows[-1]), self.fanout)
                lows.append(np.minimum.reduceat(lows[-1], starts))
                highs.append(np.maximum.reduceat(highs[-1], starts))
            q = np.arange(lo, min(n, lo + step))
            node, acc = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                acc = acc + np.bitwise_count((self.fps[q] ^ pattern[node]) & mask[node])
                own = labels[q]
                keep = (acc <= max_bits) & ~((lows[level][node] == own) & (highs[level][node] == own))
                q, node, acc = q[keep], node[keep], acc[keep]
                if level:
                    width = len(self.levels[level - 1][1])
                    kids = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                    q, acc = np.repeat(q, self.fanout), np.repeat(acc, self.fanout)
                    there = kids < width
                    q, node, acc = q[there], kids[there], acc[there]
            for a, b in zip(q.tolist(), node.tolist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((a, b))
        if not out:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = np.array(out).T
        return self.fps[a], self.fps[b]


def _links_of_sorted(max_bits: int):
    """Batches sorted by bucket -> links. Only the rows of the bucket at hand are held."""
    def edges(fps: np.ndarray):
        a, b = GrayIndex(fps).links(max_bits)
        return a.view(np.int64), b.view(np.int64)

    def run(batches):
        held_key, held = None, []
        for batch in batches:
            t, k, s, fp = (batch.column(i).to_numpy() for i in range(4))
            if not len(t):
                continue
            new = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1])) + 1
            bounds = [0, *new.tolist(), len(t)]
            found = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                key = (t[lo], k[lo], s[lo])
                if key != held_key:
                    if sum(map(len, held)) > 1:
                        found.append(edges(np.concatenate(held)))
                    held_key, held = key, []
                held.append(fp[lo:hi].view(np.uint64))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            held = [np.concatenate(held)]
        if sum(map(len, held)) > 1:
            a, b = edges(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: a forest for each bucket, which together connect
    exactly the pairs that differ in at most ``max_bits`` bits. Lossless: see the module's text."""
    masks = block_masks(list(range(64)), max_bits)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
                       .alias("t", "k")).select("t", "k", F.lit(0).cast("long").alias("s"), "fp")
    big = dealt.groupBy("t", "k").count().filter(F.col("count") > max_bucket).select("t", "k")
    big = materialize(big, "simhash-big")
    if big.limit(1).count():
        finer = None
        for t, mask in enumerate(masks):  # the bits of this table's key agree already: cut up the others
            free = [b for b in range(64) if not mask >> b & 1]
            subs = [m - (1 << 64) if m >> 63 else m for m in block_masks(free, max_bits)]
            part = dealt.filter(F.col("t") == t).join(big, ["t", "k"], "left_semi").select(
                "fp", "k", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in subs])).alias("u", "s")
            ).select((F.lit(1000 + 100 * t) + F.col("u")).alias("t"), "k", "s", "fp")
            finer = part if finer is None else finer.unionByName(part)
        dealt = dealt.join(big, ["t", "k"], "left_anti").select("t", "k", "s", "fp").unionByName(finer)
    ordered = dealt.repartition("t", "k", "s").sortWithinPartitions("t", "k", "s", "fp")
    return ordered.mapInArrow(_links_of_sorted(max_bits), "a long, b long")


def _label(df: DataFrame, id_col: str, text_col: str, size: int, max_bits: int, seed: int, max_bucket: int):
    """(id, fp) of every row, and (fp, first_id, component_id) of every distinct fingerprint."""
    rows = with_fingerprint(df.select(col(id_col).alias("id"), col(text_col).alias("text")), "text", size, seed)
    rows = materialize(rows.select("id", "fp"), "simhash-rows")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-fps")
    comp = connected_components(fingerprint_links(fps.select("fp"), max_bits, max_bucket))
    rooted = comp.join(fps, comp["node"] == fps["fp"]).select("node", "root", "first_id")
    best = rooted.groupBy("root").agg(F.min("first_id").alias("best"))
    label = rooted.join(best, "root").select(F.col("node").alias("fp"), "root", "best")
    return rows, materialize(fps.join(label, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"),
        F.coalesce("best", "first_id").alias("component_id")), "simhash-labels")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                   max_bits: int = MAX_BITS, seed: int = SEED, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row (id, fp, component_id) per row of ``df``: the fingerprint as signed long, and the smallest id
    reachable over links of at most ``max_bits`` differing bits, the own included. Other columns are ignored.

    Rows without words have fingerprint zero and link like any other. Rows without an id take part and
    get their component's smallest id (null if it has none). Equal fingerprints (copies, repeated rows)
    collapse in one aggregation before the search; a bucket beyond ``max_bucket`` goes to finer tables.
    """
    rows, labels = _label(df, id_col, text_col, size, max_bits, seed, max_bucket)
    return rows.join(labels.select("fp", "component_id"), "fp").select("id", "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             max_bits: int = MAX_BITS, seed: int = SEED, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest id (rows without an id
    come last, repeated rows count once). All columns stay as they were, whatever their names."""
    def keep(rows, key, text):
        _, labels = _label(rows, key, text, size, max_bits, seed, max_bucket)
        first = labels.groupBy("root").agg(F.min_by("fp", F.struct(F.col("first_id").isNull(), "first_id", "fp")).alias("b"))
        stay = labels.join(first, (labels["root"] == first["root"]) & (labels["fp"] == first["b"])).select(
            F.col("fp").alias("stays"), F.col("first_id").alias("first"))
        held = with_fingerprint(rows, text, size, seed, "fp").join(stay, F.col("fp") == F.col("stays")).filter(
            F.col(key).eqNullSafe(F.col("first")))
        order = Window.partitionBy("fp").orderBy(F.xxhash64(*rows.columns))
        return held.withColumn("n", F.row_number().over(order)).filter("n = 1")

    return keep_rows(df, [id_col, text_col], keep)


def op8_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLE: dict[str, str] = {}  # XXH64 is not at hand in SQL; tested against brute force
