"""Overlapping passages between all documents (D3): winnowed seeds, split by document frequency, extended to
maximal spans at the original positions.

1. Winnowing: of every ``window`` consecutive shingles of ``k`` words the one with the least hash (the
   rightmost of equals) is a seed, so about 2 / (window + 1) of the shingles are, and two texts that share
   ``k + window - 1`` words in a row share a seed there. Only seeds are shuffled, never every shingle.
2. A seed that one text alone holds ends here. A seed of up to ``max_df`` texts links each text with every
   earlier one that holds it; a more frequent seed (boilerplate, a group of near copies) links each text with
   the first that holds it. Rows grow with the occurrences, not with their pairs.
3. Extension: the matched seeds alone are sent back to their text for the ``window`` words on either side. In a
   common passage the next seed is never farther off, so the extents of its seeds overlap and are joined. Where
   that next seed is a frequent one, linked with another text, the span is compared on, some words of both
   texts at a time. Spans are maximal.

Exact copies collapse before step 2 (``content.exact_dedup`` lists them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasift.functions.text import words
from mediasift.session import materialize

SHINGLE, WINDOW, MAX_DF = 8, 16, 20
SEEDS_AT_ONCE = 1 << 16  # seeds of one batch that leaves a task, besides those of one text


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Of every ``k`` words of a text (UTF-8, one space between words) the first 60 bits of their MD5."""
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    starts = np.concatenate([[0], spaces + 1])[:max(0, len(spaces) + 2 - k)].tolist()
    ends = np.concatenate([spaces, [len(text)]])[k - 1:].tolist()
    digests = b"".join([hashlib.md5(text[lo:hi]).digest() for lo, hi in zip(starts, ends)])
    return (np.frombuffer(digests, ">u8")[::2] >> np.uint64(4)).astype(np.int64)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions selected in every ``window`` consecutive values: the least, the rightmost of equals."""
    if not len(hashes):
        return np.empty(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, min(window, len(hashes)))
    chosen = [np.empty(0, np.int64)]
    for lo in range(0, len(view), 65_536):
        part = view[lo:lo + 65_536, ::-1]
        chosen.append(lo + np.arange(len(part)) + part.shape[1] - 1 - np.argmin(part, axis=1))
    return np.unique(np.concatenate(chosen))


def seeds(docs: DataFrame, id_col: str, text_col: str, k: int = SHINGLE, window: int = WINDOW) -> DataFrame:
    """(h, id, pos, first): the selected shingles of each text; ``first`` marks a hash's first place in it."""
    src = (docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
           .select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")))
    kind = src.schema["id"].dataType.simpleString()

    def batch_of(ids, at, h, pos, first):
        rows = pa.array(np.repeat(at, [len(x) for x in h]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), ids.take(rows), pa.array(np.concatenate(pos)),
                                           pa.array(np.concatenate(first))], names=["h", "id", "pos", "first"])

    def run(batches):
        for batch in batches:
            out, held = ([], [], [], []), 0
            for at in range(batch.num_rows):
                # bytes part at the ASCII white space that ``words`` parts at; no object per word is sent
                hashes = shingle_hashes(b" ".join(batch.column(1)[at].as_py().split()), k)
                if not len(hashes):
                    continue
                pos = winnow(hashes, window)
                h = hashes[pos]
                first = np.zeros(len(pos), bool)
                first[np.unique(h, return_index=True)[1]] = True
                for part, value in zip(out, (at, h, pos.astype(np.int32), first)):
                    part.append(value)
                held += len(pos)
                if held >= SEEDS_AT_ONCE:
                    yield batch_of(batch.column(0), *out)
                    out, held = ([], [], [], []), 0
            if held:
                yield batch_of(batch.column(0), *out)

    return src.mapInArrow(run, f"h long, id {kind}, pos int, first boolean")


def _written(df: DataFrame, name: str) -> DataFrame:
    """A written table that is joined by merge: words, seeds and spans grow with the texts, and the size of their
    compressed files says little of what their rows take in the driver that would broadcast them."""
    return materialize(df, name).hint("merge")


def _equal_ahead(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


AHEAD, FASTER = 64, 16  # words that the first round compares beyond an open end, and how much more each further one


def _asked_words(text: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """(id, on, at, words): up to ``size`` words after ``at``, or before it in reverse order (``on`` false), of each
    (id, on, at) in ``places``. A text is sent once for all its places, and only the words asked for leave it."""
    asked = places.distinct().groupBy("id").agg(F.collect_list(F.struct("on", "at")).alias("m"))
    after = F.slice("w", F.col("m.at") + 1, F.lit(size))
    before = F.reverse(F.slice("w", F.greatest(F.col("m.at") - size, F.lit(0)) + 1, F.least(F.col("m.at"), F.lit(size))))
    split = text.join(asked.hint("merge"), "id").select("id", words("text").alias("w"), "m")  # before explode: once a text, not once a place
    return _written(split.select("id", "w", F.explode("m").alias("m"))
                    .select("id", "m.on", "m.at", F.when(F.col("m.on"), after).otherwise(before).alias("words")).distinct(), "asked-words")


def _extended(spans: DataFrame, text: DataFrame) -> DataFrame:
    """Spans with an end that lies ``window`` words from their last seed (``more_back``, ``more_on``; the next seed
    there is a frequent one, linked with another source): compared on, word by word.

    A round compares ``AHEAD`` words, ``FASTER`` times more in the next, and only ends that are equal that far go on.
    So the texts are never joined to each span, and what is compared follows what is equal.
    """
    key = ["id", "source", "diag", "start", "end"]
    open_ = _written(spans.where("more_back").select(*key, F.lit(False).alias("on"), F.col("start").alias("at")).unionByName(
        spans.where("more_on").select(*key, F.lit(True).alias("on"), F.col("end").alias("at"))), "open-ends")
    closed, size = None, AHEAD
    while not open_.isEmpty():
        there = open_.withColumn("there", F.col("at") - F.col("diag"))
        found = _asked_words(text, open_.select("id", "on", "at").unionByName(
            there.select(F.col("source").alias("id"), "on", F.col("there").alias("at"))), size)
        both = there.join(found.withColumnRenamed("words", "a"), ["id", "on", "at"]).join(
            found.select(F.col("id").alias("source"), "on", F.col("at").alias("there"), F.col("words").alias("b")), ["source", "on", "there"])
        moved = _written(both.select(*key, "on", "at", _equal_ahead(F.col("a"), F.col("b")).alias("n"))
                         .select(*key, "on", F.when(F.col("on"), F.col("at") + F.col("n")).otherwise(F.col("at") - F.col("n")).alias("at"),
                                 (F.col("n") == size).alias("goes")), "moved-ends")
        done = moved.where("NOT goes").select(*key, "on", "at")
        closed = done if closed is None else closed.unionByName(done)
        open_, size = moved.where("goes").select(*key, "on", "at"), size * FASTER
    if closed is None:
        return spans.select(*key)
    ends = closed.groupBy(*key).agg(F.min(F.when(~F.col("on"), F.col("at"))).alias("s"), F.max(F.when(F.col("on"), F.col("at"))).alias("e"))
    return ends.select("id", "source", "diag", F.coalesce("s", "start").alias("start"), F.coalesce("e", "end").alias("end"))


def document_overlaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                      window: int = WINDOW, max_df: int = MAX_DF, min_words: int | None = None) -> DataFrame:
    """(doc_id, source_id, start, source_start, length): common passages of a document and an earlier one.

    ``start`` and ``source_start`` count words (from 0), ``length`` is in words and at least ``min_words``
    (``k + window - 1`` unless given: the length from which no common passage lacks a seed). A source has a
    smaller id; it is matched at the first place where it holds a seed. Of equal texts the smallest id takes
    part. Null ids and texts of under ``k`` words give no rows, nor does a null text; repeated rows count once (an id
    must name one text); other columns are ignored. An empty table gives no rows.
    """
    least = k + window - 1 if min_words is None else min_words
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    digests = _written(text.where("text IS NOT NULL").select("id", F.sha2("text", 256).alias("digest")), "digests")
    copies = digests.groupBy("digest").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "keep")
    extra = digests.join(copies, "digest").where("id <> keep").select("id").distinct()
    found = _written(seeds(text, "id", "text", k, window).join(extra.hint("merge"), "id", "left_anti"), "seeds")

    held = found.where("first").groupBy("h", "id").agg(F.lit(1).alias("one"))  # an id once, whatever its rows
    shared = (held.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("id").alias("origin")).where("df > 1"))
    matched = found.join(_written(shared, "shared"), "h")
    # the words on either side, from each text once
    asked = matched.groupBy("id").agg(F.collect_set(F.struct("h", "pos", "first", "df", "origin")).alias("m"))
    around = (text.join(asked.hint("merge"), "id").select("id", words("text").alias("w"), "m").select("id", "w", F.explode("m").alias("m"))
              .select("m.h", "id", "m.pos", "m.first", "m.df", "m.origin",
                      F.reverse(F.slice("w", F.greatest(F.col("m.pos") - window, F.lit(0)) + 1, F.least(F.col("m.pos"), F.lit(window)))).alias("before"),
                      F.slice("w", F.col("m.pos") + k + 1, F.lit(window)).alias("after")))
    around = _written(around, "seed-words")

    source = around.where(F.col("first") & ((F.col("df") <= max_df) | (F.col("id") == F.col("origin")))).select(
        "h", F.col("id").alias("source"), F.col("pos").alias("q"), F.col("before").alias("b0"), F.col("after").alias("a0"))
    back, on = _equal_ahead(F.col("before"), F.col("b0")), _equal_ahead(F.col("after"), F.col("a0"))
    pairs = around.join(source, "h").where(F.col("id") > F.col("source")).select(
        "id", "source", "pos", (F.col("pos") - F.col("q")).alias("diag"), back.alias("back"), on.alias("on"))
    pairs = pairs.select("id", "source", "diag", (F.col("pos") - F.col("back")).alias("lo"), (F.col("back") == window).alias("more_back"),
                         (F.col("pos") + k + F.col("on")).alias("hi"), (F.col("on") == window).alias("more_on")).distinct()
    along = Window.partitionBy("id", "source", "diag").orderBy("lo", "hi")
    reach = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    spans = (pairs.withColumn("new", F.coalesce((F.col("lo") > reach).cast("int"), F.lit(0)))
             .withColumn("island", F.sum("new").over(along))
             .groupBy("id", "source", "diag", "island")
             .agg(F.min(F.struct("lo", "more_back")).alias("l"), F.max(F.struct("hi", ~F.col("more_on"))).alias("r"))
             .select("id", "source", "diag", F.col("l.lo").alias("start"), F.col("r.hi").alias("end"),
                     F.col("l.more_back").alias("more_back"), (~F.col("r.col2")).alias("more_on")))
    spans = _written(spans, "spans")
    more = F.col("more_back") | F.col("more_on")
    spans = spans.where(~more).drop("more_back", "more_on").unionByName(_extended(spans.where(more), text)).distinct()
    return spans.where(F.col("end") - F.col("start") >= least).select(
        F.col("id").alias(id_col), F.col("source").alias("source_id"), "start",
        (F.col("start") - F.col("diag")).alias("source_start"), (F.col("end") - F.col("start")).alias("length"))
