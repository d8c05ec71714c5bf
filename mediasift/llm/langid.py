"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of one fixed public vocabulary. A word's probability
is the sum over all its segmentations into pieces (forward algorithm); a text's is the product over its
words. Piece probabilities are fitted by expectation maximisation over all segmentations.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediasift.llm.common import col, fold, map_text
from mediasift.sources.tables import table

#: Bound of the training sample: rows per language and characters of the longest text taken.
SAMPLE_ROWS, SAMPLE_CHARS = 300, 4000
ROUNDS, SMOOTHING = 4, 0.05
UNKNOWN_LANGUAGE = "und"
CACHE_WORDS = 200_000
#: Words of a batch, and its words times the letters of its longest word.
BATCH, CELLS = 4096, 1 << 18
_START = "▁"  # the vocabulary's mark for a word's beginning
_RUN = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of letters in lower case, with or without the mark of a word's beginning."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    return sorted(p for p in pieces | {_START} if p == p.lower() and (p.removeprefix(_START).isalpha() or p == _START))


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    if not text:
        return []
    runs = _RUN.findall(text.lower())
    if "".join(runs).isalpha():
        return runs
    return list(chain.from_iterable(map(_LETTERS.findall, runs)))


class Segmenter:
    """All segmentations of words into vocabulary pieces, for many words at once."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)  # piece number n stands for a character that no piece covers
        self.longest = max(map(len, pieces))
        node, ends = {"": 0}, {}
        for i, p in enumerate(pieces):
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
            ends[node[p]] = i
        step = sorted((node[p[:-1]] << 21 | ord(p[-1]), s) for p, s in node.items() if p)
        self.keys = np.array([k for k, _ in step], np.int64)
        self.next = np.array([s for _, s in step], np.int64)
        self.piece = np.full(len(node), -1, np.int64)
        self.piece[list(ends)] = list(ends.values())

    def lattice(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(lengths with the start mark, for each piece length l the piece that begins at [word, position])."""
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        width = int(lens.max())
        chars = np.zeros((len(words), width), np.int64)
        chars[np.arange(width) < lens[:, None]] = np.frombuffer(
            (_START + _START.join(words)).encode("utf-32-le", "surrogatepass"), "<u4")
        flat, found = chars.ravel(), []
        at = np.flatnonzero(flat)
        state = np.zeros(len(at), np.int64)
        left = width - at % width
        for k in range(min(self.longest, width)):
            go = left > k
            at, state, left = at[go], state[go], left[go]
            c = flat[at + k]
            key = state << 21 | c
            pos = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = (self.keys[pos] == key) & (c > 0)
            at, state, left = at[ok], self.next[pos[ok]], left[ok]
            grid = np.full(len(flat), -1, np.int64)
            grid[at] = self.piece[state]
            if k == 0:
                grid[(grid < 0) & (flat > 0)] = self.n
            found.append(grid.reshape(len(words), width))
            if not len(at):
                break
        return lens, found

    def forward(self, lens, found, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scaled sums over the segmentations of each prefix, log of their scales): [position, word, language]."""
        n, width, k = len(lens), int(lens.max()), prob.shape[1]
        padded = np.vstack((prob, np.zeros((1, k))))  # piece -1 has no probability
        alpha, scale = np.zeros((2, width + 1, n, k))
        alpha[0] = 1
        for i in range(1, width + 1):
            total = np.zeros((n, k))
            for ln in range(1, min(i, len(found)) + 1):
                p = found[ln - 1][:, i - ln]
                use = np.flatnonzero(p >= 0)
                if len(use):
                    part = alpha[i - ln, use] * padded[p[use]]
                    if i > 24:
                        part = part * np.exp(scale[i - ln, use] - scale[i - 1, use])
                    total[use] += part
            if i >= 24:  # long words: keep each language's sums near one
                top = np.where(total > 0, total, 1)
                total /= top
                scale[i] = scale[i - 1] + np.log(top)
            alpha[i] = total
        return alpha, scale

    def batches(self, words: list[str]):
        """Numbers of the words in order of length, in batches of at most ``BATCH`` words and, where more than one,
        ``CELLS`` letters of the longest word's width."""
        order = np.argsort([len(w) for w in words], kind="stable")
        lo = 0
        while lo < len(order):
            hi = min(len(order), lo + BATCH)
            while hi > lo + 1 and (len(words[order[hi - 1]]) > 2 * len(words[order[lo]]) + 8
                                   or len(words[order[hi - 1]]) * (hi - lo) > CELLS):
                hi = lo + (hi - lo) // 2
            yield order[lo:hi]
            lo = hi

    def log_prob(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log probability of each word in each language, marginal over its segmentations."""
        out = np.empty((len(words), prob.shape[1]))
        for part in self.batches(words):
            lens, found = self.lattice([words[i] for i in part])
            alpha, scale = self.forward(lens, found, prob)
            rows = np.arange(len(part))
            out[part] = np.log(np.maximum(alpha[lens, rows], 1e-300)) + scale[lens, rows]
        return out

    def expected(self, words: list[str], counts: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language; ``counts`` are [word, language]. Words of any length: both
        directions keep their sums near one in long words."""
        total = np.zeros((self.n + 1, prob.shape[1]))
        padded = np.vstack((prob, np.zeros((1, prob.shape[1]))))
        for part in self.batches(words):
            lens, found = self.lattice([words[i] for i in part])
            alpha, scale = self.forward(lens, found, prob)
            rows, width = np.arange(len(part)), int(lens.max())
            beta, back = np.zeros((2, *alpha.shape))  # sums over the segmentations of each suffix, log of their scales
            beta[lens, rows] = 1
            weight, end = counts[part] / np.maximum(alpha[lens, rows], 1e-300), scale[lens, rows]
            for i in range(width - 1, -1, -1):
                for ln in range(1, min(width - i, len(found)) + 1):
                    p = found[ln - 1][:, i]
                    use = np.flatnonzero(p >= 0)
                    if len(use):
                        q = beta[i + ln, use] * padded[p[use]]
                        if width > 24:
                            q *= np.exp(back[i + ln, use] - back[i + 1, use])
                        beta[i, use] += q
                        e = alpha[i, use] * q * weight[use]
                        if width > 24:
                            e *= np.exp(scale[i, use] + back[i + 1, use] - end[use])
                        for j in range(prob.shape[1]):
                            total[:, j] += np.bincount(p[use], e[:, j], minlength=self.n + 1)
                if width > 24:
                    top = np.where(beta[i] > 0, beta[i], 1)
                    beta[i] /= top
                    back[i] = back[i + 1] + np.log(top)
        return total


def fit(rows: list[tuple[str, str]], pieces: list[str], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages in order, piece probabilities [piece, language]) from (text, language) rows."""
    langs = sorted({lang for _, lang in rows})
    seg, at = Segmenter(pieces), {}
    pairs: dict[tuple[int, int], int] = {}
    for text, lang in rows:
        j = langs.index(lang)
        for w in words_of(text):
            key = (at.setdefault(w, len(at)), j)
            pairs[key] = pairs.get(key, 0) + 1
    prob = np.full((len(pieces) + 1, len(langs)), 1 / (len(pieces) + 1))
    if at:
        counts = np.zeros((len(at), len(langs)))
        for (i, j), n in pairs.items():
            counts[i, j] = n
        words = list(at)
        for _ in range(rounds):
            e = seg.expected(words, counts, prob) + SMOOTHING
            prob = e / e.sum(axis=0)
    return langs, prob


class Identifier:
    """Posterior over languages (equal priors); keeps the log probabilities of recent words."""

    def __init__(self, langs: list[str], prob: np.ndarray, pieces: list[str]):
        self.langs, self.prob, self.seg = langs, prob, Segmenter(pieces)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, len(langs)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lists = [words_of(t) for t in texts]
        flat = list(chain.from_iterable(lists))
        if not self.langs or not flat:
            return [UNKNOWN_LANGUAGE] * len(texts), [0.0] * len(texts)
        if len(self.rows) > CACHE_WORDS:
            self.rows, self.table = {}, self.table[:0]
        new = list(set(flat).difference(self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.table = np.vstack((self.table, self.seg.log_prob(new, self.prob)))
        ids = np.fromiter(map(self.rows.__getitem__, flat), np.int64, len(flat))
        sizes = np.array([len(x) for x in lists])
        full = np.flatnonzero(sizes)
        sums = np.add.reduceat(self.table[ids], np.concatenate(([0], np.cumsum(sizes[full])[:-1])), axis=0)
        best = sums.argmax(axis=1)
        post = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        pred, score = [UNKNOWN_LANGUAGE] * len(texts), [0.0] * len(texts)
        for i, b, p in zip(full.tolist(), best.tolist(), post.tolist(), strict=True):
            pred[i], score[i] = self.langs[b], p
        return pred, score


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """The bounded sample: per language the ``rows`` documents with the least hash of the id among those
    with crc32(id) modulo 5 not 0, a language and at most ``chars`` characters."""
    src = docs.select(col(id_col).alias("i"), col(lang_col).alias("l"), col(text_col).alias("t")).filter(
        F.col("l").isNotNull() & (fold("i") != 0) & (F.length("t") <= chars) & (F.length("t") > 0))
    mark, least = F.xxhash64("i"), F.row_number()
    ids = src.select("i", "l").distinct().withColumn("s", F.pmod(F.xxhash64("i", F.lit("salt")), F.lit(64)))
    for keys in (["l", "s"], ["l"]):  # first in 64 parts of a language: no task gets a whole language's ids
        ids = ids.withColumn("r", least.over(Window.partitionBy(*keys).orderBy(mark, "i"))).filter(F.col("r") <= rows)
    chosen = src.join(F.broadcast(ids.select("i", "l")), ["i", "l"]).groupBy("i", "l").agg(F.min("t").alias("t"))
    return [(r.t, r.l) for r in sorted(chosen.collect(), key=lambda r: (r.l, str(r.i)))]


def identify(df: DataFrame, langs: list[str], prob: np.ndarray, pieces: list[str], text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (its posterior, 0 to 1). Null, empty and letter-less texts, and all
    texts where nothing was learned, give ``und`` with score 0. Ties go to the first language by name.
    Only the text is read; whole texts, one map, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast((langs, prob, pieces))  # vocabulary x languages

    def make():
        who = Identifier(*shared.value)
        return lambda texts: list(who.predict(texts))

    return map_text(df, text_col, "lang_pred string, score double", make)


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pieces = vocabulary()
    langs, prob = fit(training_rows(docs), pieces)
    return identify(docs.drop("lang"), langs, prob, pieces).select(
        "doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op1_language_id": op1_language_id}
ORACLE: dict[str, str] = {}  # a fitted model; the forward sums are tested against enumeration
