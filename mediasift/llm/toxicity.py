"""Toxicity: bidirectional gated recurrent network with attention pooling over character and word inputs.

Trained in numpy on a bounded sample of labelled rows; applied to all overlapping windows of every
text. A text's score is that of its worst window, after a calibration on the sample.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.common import col, fold, keep_rows, map_text
from mediasift.sources.tables import table

WINDOW, STRIDE = 32, 24
#: Bound of the training sample: rows of either label, and the longest text that it takes (characters).
SAMPLE_ROWS, SAMPLE_CHARS = (1500, 2500), 3000
HIDDEN, WORD_DIM, CHAR_DIM = 12, 8, 16
WORD_BITS, CHAR_BITS = 15, 15
CACHE_WORDS = 100_000
_TOKEN = re.compile(r"[^\W_]{1,24}")
_GRAMS = (3, 4, 5)


def tokens(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits; longer runs are cut every 24 characters."""
    return [] if text is None else _TOKEN.findall(text.lower())


def _slots(code: np.ndarray, bits: int) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slots, character n-gram slots of all words in a row, start of each word's n-grams)."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.zeros((len(words), int(lens.max(initial=1)) + 2), np.uint64)
    chars[:, 0] = 2
    inside = np.arange(chars.shape[1] - 2) < lens[:, None]
    chars[:, 1:-1][inside] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    chars[np.arange(len(words)), lens + 1] = 3
    codes, valid, base = [], [], np.uint64(1_000_003)
    code = np.zeros_like(chars)
    whole = np.zeros(len(words), np.uint64)
    for k in range(1, max(_GRAMS) + 1):
        n = chars.shape[1] - k + 1
        if n <= 0:
            break
        code = code[:, :n] * base + chars[:, k - 1:]
        if k in _GRAMS:
            codes.append(code + np.uint64(k))
            valid.append(np.arange(n) + k <= (lens + 2)[:, None])
    for j in range(chars.shape[1]):
        whole = whole * base + chars[:, j]
    ok = np.concatenate(valid, axis=1)
    flat = _slots(np.concatenate(codes, axis=1)[ok], CHAR_BITS)
    return _slots(whole, WORD_BITS), flat, np.concatenate(([0], np.cumsum(ok.sum(axis=1))[:-1]))


def windows(ids: np.ndarray, ends: np.ndarray, size: int = WINDOW, stride: int = STRIDE):
    """Row numbers of the tokens of all windows (0: none) and the text of each window. Every token is in one."""
    ends = np.asarray(ends, np.int64)
    begins = np.concatenate((np.zeros(min(1, len(ends)), np.int64), ends[:-1]))
    length = ends - begins
    count = np.where(length > 0, np.maximum(0, -(-(length - size) // stride)) + 1, 0)
    owner = np.repeat(np.arange(len(ends)), count)
    first = begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * stride
    at = first[:, None] + np.arange(size)
    there = at < ends[owner][:, None]
    return np.where(there, ids[np.minimum(at, max(len(ids) - 1, 0))], 0) if len(owner) else np.zeros((0, size), np.int64), owner


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Net:
    """Parameters, forward pass over windows of word rows, and gradients."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        f = lambda *s, scale: r.normal(0, scale, s).astype(np.float32)
        self.p = {"word": f(1 << WORD_BITS, WORD_DIM, scale=0.1), "char": f(1 << CHAR_BITS, CHAR_DIM, scale=0.3),
                  "wx": f(2, d, 3 * h, scale=d ** -0.5), "b": np.zeros((2, 3 * h), np.float32),
                  "u": f(2, h, 3 * h, scale=h ** -0.5), "wa": f(2 * h, h, scale=(2 * h) ** -0.5),
                  "ba": np.zeros(h, np.float32), "va": f(h, scale=0.3), "wo": f(2 * h, scale=0.3),
                  "bo": np.zeros(1, np.float32)}
        self.p["b"][:, :h] = 1  # keep the state at first
        self.g2 = {k: np.full(v.shape, 1e-6, np.float32) for k, v in self.p.items()}
        self.scale, self.shift = 1.0, 0.0

    def embed(self, inputs) -> np.ndarray:
        word, grams, starts = inputs
        sums = np.add.reduceat(self.p["char"][grams], starts, axis=0)
        n = np.diff(np.append(starts, len(grams)))[:, None]
        return np.concatenate((self.p["word"][word], sums / np.sqrt(n)), axis=1).astype(np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input parts of all gates in both directions; row 0 (no token) must be put before by the caller."""
        return np.stack([x @ self.p["wx"][d] + self.p["b"][d] for d in (0, 1)])

    def forward(self, proj: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows ``ids`` (rows of ``proj``); with ``keep`` also what the gradients need."""
        h, (n, t) = HIDDEN, ids.shape
        mask = ids > 0
        full = mask.all(axis=0)
        states = np.empty((t, n, 2 * h), np.float32)
        kept: list = [[None] * t, [None] * t]
        for d in (0, 1):
            u, s = self.p["u"][d], np.zeros((n, h), np.float32)
            for i in range(t) if d == 0 else range(t - 1, -1, -1):
                a = proj[d][ids[:, i]]
                m = s @ u
                gates = a[:, :2 * h] + m[:, :2 * h]
                gates *= 0.5
                np.tanh(gates, out=gates)
                gates *= 0.5
                gates += 0.5
                z, r = gates[:, :h], gates[:, h:]
                c = m[:, 2 * h:] * r
                c += a[:, 2 * h:]
                np.tanh(c, out=c)
                new = c + z * (s - c)
                if not full[i]:
                    new = np.where(mask[:, i, None], new, s)
                if keep:
                    kept[d][i] = (s, z, r, c, m[:, 2 * h:])
                states[i, :, d * h:(d + 1) * h] = s = new
        att = np.tanh(states.reshape(-1, 2 * h) @ self.p["wa"] + self.p["ba"])
        e = (att @ self.p["va"]).reshape(t, n)
        e = np.where(mask.T, e, -1e9)
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", e, states, optimize=True)
        logit = pooled @ self.p["wo"] + self.p["bo"][0]
        return (logit, mask, states, kept, att.reshape(t, n, h), e, pooled) if keep else logit

    def train(self, inputs, ids: np.ndarray, label: np.ndarray, weight: np.ndarray, rate: float = 0.1) -> None:
        """One AdaGrad step. ``inputs`` are those of the words, ``ids`` counts them from 1."""
        p, h = self.p, HIDDEN
        x = self.embed(inputs)
        x1 = np.concatenate((np.zeros((1, x.shape[1]), np.float32), x))
        logit, mask, states, kept, att, e, pooled = self.forward(self.project(x1), ids, keep=True)
        n, t = ids.shape
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        dl = (weight * (_sigmoid(logit) - label) / weight.sum()).astype(np.float32)
        g["wo"], g["bo"][0] = pooled.T @ dl, dl.sum()
        dp = dl[:, None] * p["wo"]
        de = np.einsum("tnh,nh->tn", states, dp)
        de = e * (de - (e * de).sum(axis=0))
        datt = de[..., None] * p["va"] * (1 - att * att)
        g["va"] = np.einsum("tn,tnh->h", de, att)
        g["wa"] = states.reshape(-1, 2 * h).T @ datt.reshape(-1, h)
        g["ba"] = datt.sum(axis=(0, 1))
        ds = e[..., None] * dp + (datt.reshape(-1, h) @ p["wa"].T).reshape(t, n, 2 * h)
        dproj = np.zeros((2, len(x1), 3 * h), np.float32)
        for d in (0, 1):
            u, carry = p["u"][d], np.zeros((n, h), np.float32)
            gates = np.empty((t, n, 3 * h), np.float32)
            for i in range(t - 1, -1, -1) if d == 0 else range(t):
                s, z, r, c, mc = kept[d][i]
                dh = carry + ds[i][:, d * h:(d + 1) * h]
                live = mask[:, i, None]
                dn = np.where(live, dh, 0)
                dc = dn * (1 - z) * (1 - c * c)
                ga = gates[i]
                ga[:, :h] = dn * (s - c) * z * (1 - z)
                ga[:, h:2 * h] = dc * mc * r * (1 - r)
                ga[:, 2 * h:] = dc
                dm = ga.copy()
                dm[:, 2 * h:] *= r
                g["u"][d] += s.T @ dm
                carry = dm @ u.T + dn * z + np.where(live, 0, dh)
            order = np.argsort(ids.T.ravel(), kind="stable")
            rows = ids.T.ravel()[order]
            starts = np.flatnonzero(np.diff(rows, prepend=-1))
            dproj[d][rows[starts]] = np.add.reduceat(gates.reshape(-1, 3 * h)[order], starts, axis=0)
        dproj = dproj[:, 1:]
        dx = np.zeros_like(x)
        for d in (0, 1):
            g["wx"][d], g["b"][d] = x.T @ dproj[d], dproj[d].sum(axis=0)
            dx += dproj[d] @ p["wx"][d].T
        for k, v in g.items():
            self.g2[k] += v * v
            p[k] -= rate * v / np.sqrt(self.g2[k])
        word, grams, starts = inputs
        size = np.diff(np.append(starts, len(grams)))
        self._rows("word", word, dx[:, :WORD_DIM], rate)
        self._rows("char", grams, np.repeat(dx[:, WORD_DIM:] / np.sqrt(size)[:, None], size, axis=0), rate)

    def _rows(self, name: str, slots: np.ndarray, grad: np.ndarray, rate: float) -> None:
        order = np.argsort(slots, kind="stable")
        starts = np.flatnonzero(np.diff(slots[order], prepend=-1))
        rows, sums = slots[order][starts], np.add.reduceat(grad[order], starts, axis=0)
        self.g2[name][rows] += sums * sums
        self.p[name][rows] -= rate * sums / np.sqrt(self.g2[name][rows])


class Scorer:
    """Worst-window logits of texts; keeps the gate inputs of recent words."""

    def __init__(self, net: Net, block: int = 1024):
        self.net, self.block = net, block
        self._clear()

    def _clear(self):
        self.rows: dict[str, int] = {}
        zero = np.zeros((1, WORD_DIM + CHAR_DIM), np.float32)
        self.table = self.net.project(zero)

    def logits(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(logit of each window, text of each window) for tokenised texts."""
        if len(self.rows) > CACHE_WORDS:
            self._clear()
        rows = self.rows
        flat = list(chain.from_iterable(texts))
        new = list(set(flat).difference(rows))
        if new:
            for lo in range(0, len(new), 8192):
                part = new[lo:lo + 8192]
                rows.update(zip(part, range(len(rows) + 1, len(rows) + len(part) + 1), strict=True))
                more = self.net.project(self.net.embed(word_inputs(part)))
                if len(rows) + 1 > self.table.shape[1]:
                    grown = np.empty((2, 2 * (len(rows) + 1), self.table.shape[2]), np.float32)
                    grown[:, :self.table.shape[1]] = self.table
                    self.table = grown
                self.table[:, len(rows) + 1 - len(part):len(rows) + 1] = more
        ids = np.fromiter(map(rows.__getitem__, flat), np.int64, len(flat))
        win, owner = windows(ids, np.cumsum([len(t) for t in texts], dtype=np.int64))
        out = np.empty(len(win), np.float32)
        for lo in range(0, len(win), self.block):
            out[lo:lo + self.block] = self.net.forward(self.table, win[lo:lo + self.block])
        return out, owner

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Calibrated score of the worst window; 0 for texts without a word."""
        best = np.full(len(texts), -np.inf, np.float64)
        logit, owner = self.logits([tokens(t) for t in texts])
        np.maximum.at(best, owner, logit)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.net.scale * best + self.net.shift)))


def train(rows: list[tuple[str, int]], rounds: int = 4, batch: int = 256, seed: int = 7) -> Net | None:
    """Fit on (text, label) rows; a text is toxic if one of its windows is (none of both labels: None).

    The first pass gives every window its text's label; later rounds take the worst windows of each
    text under the net so far.
    """
    docs = [(tokens(t), int(y)) for t, y in rows]
    docs = [d for d in docs if d[0]]
    label = np.array([y for _, y in docs], np.float32)
    if not docs or label.min() == label.max():
        return None
    rng, net = np.random.default_rng(seed), Net(seed)
    words = sorted({w for t, _ in docs for w in t})
    at = {w: i for i, w in enumerate(words, 1)}
    ids = np.fromiter((at[w] for t, _ in docs for w in t), np.int64)
    win, owner = windows(ids, np.cumsum([len(t) for t, _ in docs]))
    per_doc = np.bincount(owner, minlength=len(docs))

    def passes(chosen, weight, least):
        times = max(1, -(-least * batch // len(chosen)))
        order = np.concatenate([rng.permutation(chosen) for _ in range(times)])
        for lo in range(0, len(order), batch):
            part = order[lo:lo + batch]
            used, local = np.unique(win[part], return_inverse=True)
            if used[0] != 0:
                used, local = np.concatenate(([0], used)), local + 1
            net.train(word_inputs([words[i - 1] for i in used[1:]]), local.reshape(len(part), -1),
                      label[owner[part]], weight[part])

    def all_logits():
        proj = np.empty((2, len(words) + 1, 3 * HIDDEN), np.float32)
        proj[:, :1] = net.project(np.zeros((1, WORD_DIM + CHAR_DIM), np.float32))
        for lo in range(0, len(words), 8192):
            proj[:, lo + 1:lo + 1 + 8192] = net.project(net.embed(word_inputs(words[lo:lo + 8192])))
        return np.concatenate([net.forward(proj, win[lo:lo + 2048]) for lo in range(0, len(win), 2048)])

    toxic = label[owner] > 0
    share = np.where(toxic, 1 / np.sqrt(per_doc[owner]), toxic.sum() / max(1, (~toxic).sum())).astype(np.float32)
    some = np.concatenate((np.flatnonzero(toxic), rng.permutation(np.flatnonzero(~toxic))[:toxic.sum()]))
    passes(some, share, 100)
    weight = np.where(toxic, 1.0, 0.5).astype(np.float32)
    for _ in range(rounds):
        logit = all_logits()
        order = np.lexsort((-logit, owner))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)[:len(order)]
        chosen = np.flatnonzero(rank < np.where(toxic, 1, 2))
        passes(chosen, weight, 30)
    best = np.full(len(docs), -np.inf)
    np.maximum.at(best, owner, all_logits())
    # calibration: logistic fit of the texts' worst logits, both labels weighing the same
    a, b, w = 1.0, 0.0, np.where(label > 0, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    top = float(np.abs(best).max()) or 1.0
    x = best / top
    for _ in range(2000):
        d = w * (1 / (1 + np.exp(-(a * x + b))) - label)
        a, b = a - 20 * ((d * x).sum() + 1e-4 * a), b - 20 * d.sum()
    net.scale, net.shift = a / top, b
    return net


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", sample_rows=SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> list:
    """The bounded sample: at most ``sample_rows`` (toxic, other) labelled texts of at most ``sample_chars``
    characters whose id's crc32 modulo 5 is not 0, by the least hash of the id. Ids are chosen first, so
    only the sample's texts move."""
    marks = labels.select(col(id_col).alias("i"), col(label_col).cast("int").alias("y")).dropna().groupBy("i").agg(
        F.max("y").alias("y"))
    able = docs.select(col(id_col).alias("i")).filter(
        (fold(id_col) != 0) & (F.length(col(text_col)) <= sample_chars)).distinct()
    held = able.join(marks, "i")
    ids = None
    for y, most in zip((1, 0), sample_rows, strict=True):
        part = held.filter(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select(col(id_col).alias("i"), col(text_col).alias("t")).filter(
        F.length("t") <= sample_chars).join(F.broadcast(ids), "i").groupBy("i", "y").agg(F.min("t").alias("t"))
    return [(r.t, r.y) for r in sorted(rows.collect(), key=lambda r: (str(r.i), r.t))]


def score_toxicity(df: DataFrame, net: Net | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1). Null, empty and word-less texts score 0; without a net (no labels of both
    kinds) all texts do. Whole texts, one map, no shuffle; very long texts are scored in window blocks."""
    shared = df.sparkSession.sparkContext.broadcast(net)  # fixed size

    def make():
        if shared.value is None:
            return lambda texts: [[0.0] * len(texts)]
        scorer = Scorer(shared.value)
        return lambda texts: [scorer.score(texts)]

    return map_text(df, text_col, f"`{score_col}` double", make)


def drop_toxic(df: DataFrame, net: Net | None, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows of ``df`` that score under ``limit``, with all columns as they were, whatever their names."""
    return keep_rows(df, [text_col], lambda rows, text: score_toxicity(rows, net, text).filter(F.col("score") < limit))


def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(training_rows(docs, table(spark, sf_dir, "labels")))
    return score_toxicity(docs, net).select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLE: dict[str, str] = {}  # a trained network; tested by gradients and held-out accuracy
