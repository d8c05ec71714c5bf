"""Byte-level BPE encoding and decoding; long unsplit text by tree concatenation.

Texts up to ``leaf_chars`` characters are encoded in one piece. A longer one is cut where every
reading of the split pattern cuts (a space between two letters or digits); its parts are encoded by
different tasks. A stretch without such a place that is still one piece after the pattern ("long
unsplit text") is halved until the halves are small. The halves are encoded in parallel and joined
again in a tree: around each join a window of k tokens on either side is encoded anew, and k doubles
until the window's first token is the left side's token there and its last token the right side's.

Why this is exact: a token sequence is the BPE encoding of its text if and only if each pair of
neighbouring tokens is the encoding of the pair's text. Inside both sides and inside the window all
pairs are such, and the agreement puts the pairs at the window's edges into one of these sequences.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.common import col, map_text, without
from mediasift.sources.tables import table

LEAF_CHARS = 65_536
IDS = np.dtype("<u4")
#: The split pattern of this kind of vocabulary (fixed value; white space is Unicode's property).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_EXACT = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                       .replace(r"\S", r"\P{White_Space}"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabulary files."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder, decoder and joiner of one vocabulary file (JSON, byte-level BPE, ids in merge order)."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = _byte_letters()
        if data["model"]["type"] != "BPE" or data["pre_tokenizer"] != {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} \
                or data["normalizer"] is not None:
            raise ValueError("only byte-level BPE with the usual split pattern and no normalizer")
        ranks = {bytes(letters[c] for c in t): i for t, i in data["model"]["vocab"].items()}
        merged = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        order = [ranks[bytes(letters[c] for c in a + b)] for a, b in merged]
        if order != sorted(order):
            raise ValueError("token ids must follow the order of merges")
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks,
                                          special_tokens=self.special)
        self.bytes_of = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for t, i in [*ranks.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.bytes_of[i] = t
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype(IDS, copy=False)

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def encode_piece(self, piece: bytes) -> np.ndarray:
        """Tokens of one piece that the split pattern leaves whole."""
        return np.array(self.encoding._encode_single_piece(piece) if piece else [], IDS)

    def join(self, left: np.ndarray, right: np.ndarray, k: int = 4) -> np.ndarray:
        """Encoding of the joined text from the encodings of both sides (within one unsplit piece)."""
        if not len(left) or not len(right):
            return np.concatenate((left, right))
        while True:
            a, b = left[-k:], right[:k]
            window = self.encode_piece(self.decode_bytes(a) + self.decode_bytes(b))
            if (len(a) == len(left) or window[0] == a[0]) and (len(b) == len(right) or window[-1] == b[-1]):
                return np.concatenate((left[:len(left) - len(a)], window, right[len(b):]))
            k *= 2

    def tree(self, leaves: list[np.ndarray]) -> np.ndarray:
        while len(leaves) > 1:
            leaves = [self.join(leaves[i], leaves[i + 1]) if i + 1 < len(leaves) else leaves[i]
                      for i in range(0, len(leaves), 2)]
        return leaves[0]

    def pieces(self, text: str):
        """(piece, id of the special token it is or None) of a text, by the split pattern."""
        for i, part in enumerate(self._cut.split(text) if self._cut else [text]):
            if i % 2:
                yield part, self.special[part]
            else:
                yield from ((m.group(), None) for m in _EXACT.finditer(part))


@lru_cache(maxsize=4)
def _bpe(spec: str) -> ByteBpe:
    return ByteBpe(spec)


_SAFE = regex.compile(r"(?<=[\p{L}\p{N}]) (?=[\p{L}\p{N}])")


def cut_long(bpe: ByteBpe, text: str, leaf_chars: int):
    """Rows (seq, part, parts, whole, piece, ids) of a long text. ``whole`` rows hold ordinary text; rows
    with ``parts`` > 1 hold the halves of an unsplit piece; rows with ids are encoded already."""
    seq, start = 0, 0
    while start < len(text):
        end, last = start + leaf_chars, None
        if end >= len(text):
            end = len(text)
        else:
            for m in _SAFE.finditer(text, start + 1, end):
                last = m.start()
            if last is None:
                m = _SAFE.search(text, end)
                last = m.start() if m else len(text)
            end = last
        if end - start <= leaf_chars:
            yield seq, 0, 1, text[start:end].encode(), None
            seq += 1
        else:
            done: list[np.ndarray] = []
            for piece, special in bpe.pieces(text[start:end]):
                raw = piece.encode()
                if special is not None or len(raw) <= leaf_chars:
                    done.append(np.array([special], IDS) if special is not None else bpe.encode_piece(raw))
                    continue
                yield seq, 0, 1, None, np.concatenate([np.empty(0, IDS), *done]).tobytes()
                done, parts = [], 1
                while len(raw) > parts * leaf_chars:
                    parts *= 2
                size = -(-len(raw) // parts)
                for p in range(parts):
                    yield seq + 1, p, parts, raw[p * size:(p + 1) * size], None
                seq += 2
            yield seq, 0, 1, None, np.concatenate([np.empty(0, IDS), *done]).tobytes()
            seq += 1
        start = end


_PARTS = "_key string, _seq int, _part int, _parts int, _raw binary, _ids binary"


def _encode_long(texts: DataFrame, spec, leaf_chars: int) -> DataFrame:
    """``texts`` (_key, _text): one row per distinct long text, with the tokens in ``_ids``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(_PARTS)

    def cut(batches):
        bpe, target = _bpe(spec.value), to_arrow_schema(schema)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in cut_long(bpe, text, leaf_chars):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], f.type) for v, f in zip((key, *row), target, strict=True)], schema=target)

    def encode(batches):
        bpe, target = _bpe(spec.value), to_arrow_schema(schema)
        for batch in batches:
            raws, parts, ids = (batch.column(i).to_pylist() for i in (4, 3, 5))
            done = [i if i is not None else
                    (bpe.encode_piece(r) if n > 1 else bpe.encode(r.decode())).tobytes()
                    for r, n, i in zip(raws, parts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.nulls(batch.num_rows, target.field(4).type), pa.array(done, target.field(5).type)],
                schema=target)

    def join(group: pa.Table) -> pa.Table:
        bpe = _bpe(spec.value)
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("_seq", "_part", "_ids")), strict=True))
        by_seq: dict[int, list] = {}
        for seq, _, ids in rows:
            by_seq.setdefault(seq, []).append(np.frombuffer(ids, IDS))
        ids = np.concatenate([bpe.tree(leaves) for leaves in by_seq.values()])
        return pa.table({"_key": [group.column("_key")[0].as_py()], "_ids": pa.array([ids.tobytes()], pa.binary())})

    parts = texts.mapInArrow(cut, schema).repartition("_key", "_seq", "_part").mapInArrow(encode, schema)
    return parts.groupBy("_key").applyInArrow(join, "_key string, _ids binary")


def encode(df: DataFrame, text_col: str = "text", path: str | None = None,
           leaf_chars: int = LEAF_CHARS, ids_col: str = "ids") -> DataFrame:
    """Add ``ids``: the tokens as little-endian unsigned 32-bit integers (binary). Null text is empty text.

    Equal to the vocabulary library's own encoding without added special tokens (their strings inside a
    text are special tokens, as there). Short texts take one map without a shuffle. Of the longer ones
    each distinct text is encoded once, its parts in parallel; equal long texts (repeated rows) share it.
    """
    with open(path or default_path(), encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    df = without(df, [ids_col, "_key", "_ids"])

    def make():
        bpe = _bpe(spec.value)
        return lambda texts: [[bpe.encode(t or "").tobytes() for t in texts]]

    long = F.length(F.coalesce(col(text_col), F.lit(""))) > leaf_chars
    short = map_text(df.filter(~long), text_col, f"`{ids_col}` binary", make)
    if df.filter(long).select(F.lit(1)).limit(1).count() == 0:
        return short
    keyed = df.filter(long).withColumn("_key", F.sha2(col(text_col), 256))
    texts = keyed.groupBy("_key").agg(F.first(col(text_col)).alias("_text"))
    done = _encode_long(texts, spec, leaf_chars)
    joined = keyed.join(done, "_key").select(*[col(c) for c in df.columns], F.col("_ids").alias(ids_col))
    return short.unionByName(joined)


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None, text_col: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of the tokens, special tokens included; broken UTF-8 is replaced."""
    with open(path or default_path(), encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def make():
        bpe = _bpe(spec.value)
        return lambda rows: [[bpe.decode_bytes(np.frombuffer(r or b"", IDS)).decode("utf-8", "replace") for r in rows]]

    return map_text(df, ids_col, f"`{text_col}` string", make)


def digests(df: DataFrame) -> DataFrame:
    """Token count and digests of ``ids`` and ``decoded``."""
    return df.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                     F.sha2("ids", 256).alias("ids_sha256"),
                     F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op3_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(decode(encode(docs).drop("text")))


QUERIES = {"op3_bpe": op3_bpe}
ORACLE: dict[str, str] = {}  # merges by rank are not expressible in SQL; tested against the library
