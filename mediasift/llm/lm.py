"""Language-model scoring with a weighted backoff automaton whose counts come from the whole corpus.

The model is a word trigram model with Dirichlet smoothing at each order:
p(w|uv) = (c(uvw) + m3 p(w|v)) / (c(uv) + m3), p(w|v) = (c(vw) + m2 p(w)) / (c(v) + m2) and
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). As an automaton: each bigram and each word seen in training is a state,
and so is the begin of a text; a seen n-gram is an arc. A state without an arc for the next word takes its
failure arc (a bigram's leads to its last word, a word's to the root; weight m / (c + m)), as often as needed; the
root has an arc for every word. Scoring is one traversal from left to right that carries the state and sums up
log-probabilities.

The vocabulary and the n-grams grow with the corpus, so no task and no broadcast holds the model. The
corpus is cut into blocks of consecutive rows, bounded in rows and in bytes; the number of shards follows the
bytes of the corpus. A block asks for the counts of the n-grams it has: it sends
their hashes and its own training counts to shards (ranges of the hash), packed in one message per shard that has
any of them, so there are never more messages than n-grams. A shard sums up, and answers only where the total
differs from what the asking block knows. Each block
then builds its own part of the automaton, which holds all arcs its texts can walk, and scores them. An
n-gram is shuffled once for each block that has it, however often it occurs there, so frequent words are
no hot keys. Words are told apart by 64 bits of hash; longer n-grams by 20 bits more than the corpus' bytes need
(48 at least, 64 at most): two share a key by a chance of under one in a million.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediasift.llm.common import arrow_schema, col, fold, lower_words
from mediasift.session import materialize
from mediasift.sources.tables import table

#: Rows and bytes of text of a block, the unit whose n-grams one task holds (a block passes ``BLOCK_BYTES`` by its
#: last text at most), and bytes of text of all blocks for each shard.
BLOCK_ROWS, BLOCK_BYTES, SHARD_BYTES = 2048, 8 << 20, 1 << 25
#: Weight, in tokens, of the word model in the bigram model and of the bigram model in the trigram model.
PRIORS = (500.0, 10.0)
#: Tokens of a run, the part of a text that one row of the traversal's vectors walks.
SPAN = 256
_BEGIN, _END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC3A5C85C97CB3127)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit key of a pair of word hashes."""
    x = (a ^ (a >> np.uint64(31))) * _M1 + b
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(29))


class Tokens:
    """Texts as word numbers, each text ended by the end token; ``hashes`` by word number (0: end)."""

    def __init__(self, texts: list[str | None]):
        index: dict = defaultdict()
        index.default_factory = index.__len__
        index[None]  # the end token
        lists = [[*map(index.__getitem__, lower_words(t)), 0] for t in texts]
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.ids = np.fromiter(chain.from_iterable(lists), np.int32, int(self.sizes.sum()))
        index.default_factory = None  # it holds the index: without this cycle the memory is free at once
        words = iter(index)
        next(words)
        self.hashes = np.array([int(_END), *map(xxhash.xxh64_intdigest, words)], np.uint64)
        self.first = np.cumsum(self.sizes) - self.sizes

    def inner(self) -> np.ndarray:
        """Positions but each text's first: there a trigram ends."""
        keep = np.ones(len(self.ids), bool)
        keep[self.first] = False
        return np.flatnonzero(keep)

    def bigram_keys(self, drop: int = 0) -> np.ndarray:
        """Key of (previous word, word) at each position; a text's first word follows the begin mark. The last
        ``drop`` bits are zero."""
        h = self.hashes[self.ids]
        left = np.concatenate(([_BEGIN], h[:-1]))
        left[self.first] = _BEGIN
        return _cleared(_mix(left, h), drop)

    def trigram_keys(self, drop: int = 0) -> np.ndarray:
        """Key of (word or begin mark, word, word) at each of ``inner()``."""
        at = self.inner()
        return _cleared(_mix(self.bigram_keys()[at - 1], self.hashes[self.ids[at]]), drop)


def _cleared(keys: np.ndarray, drop: int) -> np.ndarray:
    return keys >> np.uint64(drop) << np.uint64(drop)


def pack(keys: np.ndarray, counts: np.ndarray, drop: int = 0) -> tuple[bytes, bytes]:
    """Sorted keys as byte planes of their differences, and small counts (both compress well in a shuffle)."""
    gaps = np.diff(keys >> np.uint64(drop), prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), _pack_counts(counts)


def _pack_counts(counts: np.ndarray) -> bytes:
    big = np.flatnonzero(counts >= 255)
    small = np.minimum(counts, 255).astype(np.uint8)
    return np.int64(len(counts)).tobytes() + small.tobytes() + counts[big].astype("<i8").tobytes()


def _unpack_counts(counts: bytes) -> np.ndarray:
    n = int(np.frombuffer(counts, "<i8", 1)[0])
    out = np.frombuffer(counts, np.uint8, n, 8).astype(np.int64)
    out[out == 255] = np.frombuffer(counts, "<i8", offset=8 + n)
    return out


def unpack(keys: bytes, counts: bytes, drop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    gaps = np.ascontiguousarray(np.frombuffer(keys, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64) << np.uint64(drop), _unpack_counts(counts)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def block_counts(texts: list[str | None], learn: np.ndarray, drop: int = 0):
    """(order, keys, training counts) of the words, the bigrams and the trigrams of some texts, sorted by key.
    N-grams of texts that are not learned from are there with their training count, maybe 0."""
    t = Tokens(texts)
    weight = np.repeat(learn.astype(np.int64), t.sizes)
    yield 1, *_summed(t.hashes, np.bincount(t.ids, weight, minlength=len(t.hashes)).astype(np.int64))
    yield 2, *_summed(t.bigram_keys(drop), weight)
    yield 3, *_summed(t.trigram_keys(drop), weight[t.inner()])


_ASK = "shard int, file long, no long, kind int, keys binary, counts binary"
_ANSWER = "file long, no long, kind int, shard int, marks binary, counts binary, words long, tokens long"


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range begins in sorted keys (and the end)."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64), np.arange(shards + 1))


def _asked(shards: int, drop: int):
    schema = arrow_schema(_ASK)

    def run(batches):
        for batch in batches:
            files, nos = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], (files[1:] != files[:-1]) | (nos[1:] != nos[:-1]), [True])))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = batch.slice(lo, hi - lo)
                learn = part.column(1).to_numpy(zero_copy_only=False)
                for kind, keys, counts in block_counts(part.column(0).to_pylist(), learn, drop):
                    at, cut = _cuts(keys, shards), drop if kind > 1 else 0
                    rows = [(s, int(files[lo]), int(nos[lo]), kind, *pack(keys[at[s]:at[s + 1]], counts[at[s]:at[s + 1]], cut))
                            for s in np.flatnonzero(at[:-1] < at[1:]).tolist()]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _answered(drop: int):
    schema = arrow_schema(_ANSWER)

    def run(messages: pa.Table) -> pa.Table:
        """All messages of one shard -> its answers: for each block marks on those of its keys whose total the
        block does not know already, and these totals; and one row of kind 0 with the shard's number of words seen
        in training and of training tokens."""
        by_kind: dict = defaultdict(lambda: defaultdict(list))
        shard = messages.column("shard")[0].as_py()
        for _, file, no, kind, keys, counts in zip(*(c.to_pylist() for c in messages.columns), strict=True):
            by_kind[kind][file, no].append(unpack(keys, counts, drop if kind > 1 else 0))
        rows = []
        for kind, blocks in by_kind.items():
            own = {b: parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                   for b, parts in blocks.items()}
            keys, totals = _summed(*(np.concatenate(x) for x in zip(*own.values(), strict=True)))
            for (file, no), (k, c) in own.items():
                total = totals[np.searchsorted(keys, k)]
                tell = total != c
                rows.append((file, no, kind, shard, np.packbits(tell).tobytes(), _pack_counts(total[tell]), None, None))
            if kind == 1:
                rows.append((None, None, 0, shard, None, None, int((totals > 0).sum()), int(totals.sum())))
        columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


class BackoffAutomaton:
    """States are the root (0), the words (1 + word number), the begin of a text (n + 1) and the bigrams
    (n + 2 + bigram number), of ``n`` words; only those seen in training are ever entered."""

    def __init__(self, words: np.ndarray, total: int, distinct: int, begins: int, pairs: tuple, triples: tuple,
                 priors: tuple[float, float] = PRIORS):
        """Training counts: ``words`` by word number, ``begins`` of texts, ``pairs`` (previous word number or -1 for
        the begin, word number, count) and ``triples`` (numbers of the first and of the last bigram, count)."""
        self.n = n = len(words)
        (left, word, c2), (head, tail, c3) = pairs, triples
        m2, m3 = priors
        p1 = (words + 0.5) / (total + 0.5 * (distinct + 1))
        context = np.append(words, begins).astype(float)
        p2 = (c2 + m2 * p1[word]) / (context[left] + m2)
        self.start = n + 1 if begins > 0 else 0
        # failure arcs by state: weight and goal
        self.fail = np.concatenate(([0.0], np.log10(m2 / (context + m2)), np.log10(m3 / (c2 + m3))))
        self.fail_to = np.concatenate((np.zeros(n + 2, np.int64), 1 + word))
        # arcs by length of the n-gram, then its number: weight (none: not a number) and goal
        seen2, seen3 = np.where(c2 > 0, 1.0, np.nan), np.where(c3 > 0, 1.0, np.nan)
        self.arc = {1: np.log10(p1), 2: seen2 * np.log10(p2),
                    3: seen3 * np.log10((c3 + m3 * p2[tail]) / (c2[head] + m3))}
        self.goal = {1: np.where(words > 0, np.arange(1, n + 1), 0), 2: n + 2 + np.arange(len(c2)), 3: n + 2 + tail}

    def step(self, state: np.ndarray, gram: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(next states, weights) when each state reads a word; ``gram`` has the numbers of the n-grams that end
        with it, by length. Where a state has no arc its failure arc is taken, down to the root."""
        state, weight, goal = state.copy(), np.zeros(len(state)), np.full(len(state), -1)
        for size in (3, 2, 1):
            depth = (state > 0).astype(np.int64) + (state > self.n + 1)
            here = np.flatnonzero((goal < 0) & (depth == size - 1))
            number = gram[size][here]
            arc = self.arc[size][number]
            none = np.isnan(arc)
            fails, takes = here[none], here[~none]
            weight[takes] += arc[~none]
            goal[takes] = self.goal[size][number[~none]]
            weight[fails] += self.fail[state[fails]]
            state[fails] = self.fail_to[state[fails]]
        return goal, weight

    def walk(self, gram: dict[int, np.ndarray], first: np.ndarray, sizes: np.ndarray, span: int = SPAN) -> np.ndarray:
        """log10 probability of each text; ``gram`` by length has the number of the n-gram that ends at each position.

        All texts are walked side by side, a word a step, in runs of ``span`` tokens. A run inside a text begins at
        the root two words early and counts nothing there: two words lead to the same state from anywhere."""
        runs = -(-sizes // span)
        text = np.repeat(np.arange(len(sizes)), runs)
        lo = (np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)) * span
        warm = np.where(lo > 0, 2, 0)
        length = np.minimum(span, sizes[text] - lo) + warm
        order = np.argsort(-length, kind="stable")
        text, warm, length = text[order], warm[order], length[order]
        at, state = (first[text] + lo[order]) - warm, np.where(warm > 0, 0, self.start)
        score = np.zeros(len(text))
        for i in range(int(length.max(initial=0))):
            m = int(np.searchsorted(-length, -i))  # the runs that are longer
            here = at[:m] + i
            state[:m], weight = self.step(state[:m], {size: g[here] for size, g in gram.items()})
            score[:m] += np.where(i >= warm[:m], weight, 0.0)
        return np.bincount(text, score, minlength=len(sizes))


def _with_totals(counts: np.ndarray, keys: np.ndarray, answers: list, shards: int) -> np.ndarray:
    """A block's own counts (by sorted key) with the totals that the shards told it: rows (shard, marks, counts)."""
    cuts = _cuts(keys, shards)
    for shard, marks, told in answers:
        lo, hi = cuts[shard], cuts[shard + 1]
        counts[lo + np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), count=hi - lo))] = _unpack_counts(told)
    return counts


def score_block(texts: list[str | None], learn: np.ndarray, answers, shards: int, distinct: int, total: int,
                drop: int = 0, priors: tuple[float, float] = PRIORS):
    """(n_tokens, n_known, base score, score) of the texts of one block. ``answers`` are rows
    (kind, shard, marks, counts); ``distinct`` words and ``total`` tokens are those of training."""
    t, by_kind = Tokens(texts), defaultdict(list)
    del texts
    for kind, *answer in answers:
        by_kind[kind].append(answer)
    weight = np.repeat(learn.astype(np.int64), t.sizes)
    order = np.argsort(t.hashes)
    count = np.empty(len(order), np.int64)
    count[order] = _with_totals(np.bincount(t.ids, weight, minlength=len(order)).astype(np.int64)[order],
                                t.hashes[order], by_kind[1], shards)
    keys, at, pair = np.unique(t.bigram_keys(drop), return_index=True, return_inverse=True)
    c2 = _with_totals(np.bincount(pair, weight, minlength=len(keys)).astype(np.int64), keys, by_kind[2], shards)
    pair = pair.astype(np.int32)
    previous = np.roll(t.ids, 1)
    previous[t.first] = -1
    pairs, inner = (previous[at], t.ids[at], c2), t.inner()
    keys, at, number = np.unique(t.trigram_keys(drop), return_index=True, return_inverse=True)
    c3 = _with_totals(np.bincount(number, weight[inner], minlength=len(keys)).astype(np.int64), keys, by_kind[3], shards)
    triple = np.zeros(len(t.ids), np.int32)
    triple[inner] = number
    last = inner[at]
    automaton = BackoffAutomaton(count, total, distinct, int(count[0]),  # as many texts begin as end
                                 pairs, (pair[last - 1], pair[last], c3), priors)
    del keys, at, number, last, weight, pairs, c2, c3, inner, previous, answers, by_kind
    return (t.sizes, np.add.reduceat((count > 0)[t.ids].astype(np.int64), t.first),
            np.add.reduceat(automaton.arc[1][t.ids], t.first),
            automaton.walk({1: t.ids, 2: pair, 3: triple}, t.first, t.sizes))


_PACKED = "file long, no long, rows binary"


def _packed(batches):
    """Rows with their block (the last two columns) -> one row for each run of a block's rows, as a compressed
    Arrow stream."""
    for batch in batches:
        files, nos = (batch.column(k).to_numpy() for k in (-2, -1))
        cuts = np.flatnonzero(np.concatenate(([True], (files[1:] != files[:-1]) | (nos[1:] != nos[:-1]), [True])))
        rows = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            sink = pa.BufferOutputStream()
            part = batch.slice(lo, hi - lo).select(batch.schema.names[:-2])
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(part)
            rows.append((int(files[lo]), int(nos[lo]), sink.getvalue().to_pybytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "no", "rows"])


def _with_blocks(df: DataFrame, columns: list, block_rows: int, block_bytes: int) -> tuple[DataFrame, int]:
    """``columns`` (one is ``_text``) and the block (``_file``, ``_no``) of each row; bytes of all texts. A block is
    a run of rows of an input file, so both passes see the same blocks whatever the partitions; a frame that is
    not a plain file scan is written first. Runs of ``block_rows`` rows with over ``block_bytes`` of text are cut
    by cumulated bytes."""
    at = F.col("_metadata.row_index")
    place = [F.xxhash64(F.col("_metadata.file_path")).alias("_file"), F.floor(at / block_rows).cast("long").alias("_run"),
             (at % block_rows).cast("long").alias("_row")]
    try:
        rows = df.select(*columns, *place)
    except AnalysisException:
        rows = materialize(df, "lm-texts").select(*columns, *place)
    sizes = rows.select("_file", "_run", "_row", F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("_size"))
    runs = materialize(sizes.groupBy("_file", "_run").agg(F.sum("_size").alias("_bytes")), "lm-runs")
    total = runs.agg(F.sum("_bytes")).first()[0] or 0
    long = runs.filter(F.col("_bytes") > block_bytes).select("_file", "_run")
    before = F.sum("_size").over(Window.partitionBy("_file", "_run").orderBy("_row")) - F.col("_size")
    # both broadcasts: at most a number for each block_bytes of the corpus
    cuts = materialize(sizes.join(F.broadcast(long), ["_file", "_run"]).withColumn("_cut", F.floor(before / block_bytes)).groupBy(
        "_file", "_run", "_cut").agg(F.min("_row").alias("_first")).groupBy("_file", "_run").agg(
        F.collect_list("_first").alias("_firsts")), "lm-cuts")
    cut = F.coalesce(F.size(F.filter("_firsts", lambda x: x <= F.col("_row"))) - 1, F.lit(0))
    cut = F.when(F.col("_firsts").isNull(), F.lit(0)).otherwise(cut)
    return rows.join(F.broadcast(cuts), ["_file", "_run"], "left").withColumn(
        "_no", (F.col("_run") * block_rows + cut).cast("long")).drop("_run", "_row", "_firsts"), int(total)


def score_texts(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", learn=None,
                block_rows: int = BLOCK_ROWS, priors: tuple[float, float] = PRIORS, block_bytes: int = BLOCK_BYTES,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``df``: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``learn`` (a boolean column, default all rows) says what the model learns from; counts cover all of it.
    Null and empty texts are the end token alone. Repeated rows count as often as they occur and score alike.
    Without any training text all n-grams are unknown. Other columns are ignored. Neither ``block_rows``,
    ``block_bytes`` nor ``shard_bytes`` changes the result.
    """
    learn = F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))
    rows, size = _with_blocks(df, [col(text_col).alias("_text"), learn.alias("_learn"), col(id_col).alias("_id")],
                              block_rows, block_bytes)
    shards = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    drop = 64 - min(64, max(48, size.bit_length() + 20))
    asked = rows.select("_text", "_learn", "_file", "_no").mapInArrow(_asked(shards, drop), _ASK)
    answers = materialize(asked.groupBy("shard").applyInArrow(_answered(drop), _ANSWER), "lm-answers")
    distinct, total = (n or 0 for n in answers.agg(F.sum("words"), F.sum("tokens")).first())
    id_type = dict(rows.dtypes)["_id"]

    def finish(packed: pa.Table, told: pa.Table) -> pa.Table:
        names = [id_col, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        texts = pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in packed.column("rows"))
        ids, learn = texts.column("_id"), texts.column("_learn").to_numpy()
        texts = texts.column("_text").to_pylist()
        sizes, known, base, score = score_block(
            texts, learn,
            zip(*(told.column(c).to_pylist() for c in ("kind", "shard", "marks", "counts")), strict=True),
            shards, distinct, total, drop, priors)
        return pa.Table.from_arrays([ids, *map(pa.array, (sizes, known, np.full(len(sizes), total), base, score))],
                                    names=names)

    blocks = rows.select("_text", "_learn", "_id", "_file", "_no").mapInArrow(_packed, _PACKED)
    return blocks.groupBy("file", "no").cogroup(answers.filter("kind > 0").groupBy("file", "no")).applyInArrow(
        finish, f"`{id_col}` {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, learn=fold() != 1).withColumn("held_out", fold() == 1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op10_lm_score": op10_lm_score}
ORACLE: dict[str, str] = {}  # see tests: the blocks and shards against one plain model of the whole corpus
