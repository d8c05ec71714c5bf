"""Byte-level BPE encoding and decoding with a sentencepiece model written from the vocabulary.

A rank file (token bytes and rank per line) becomes a sentencepiece BPE model: each byte is mapped to one
printable letter, a token is the piece of its bytes' letters, its score the negative rank (so the lowest
rank merges first, the leftmost among equals, as by ranks), and the normaliser is the identity. A piece's
id is its rank. Each match of the split pattern ("pre-token") is mapped to letters and encoded by itself;
decoding maps ids to pieces and their letters back to bytes.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache
from itertools import islice

import numpy as np
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.llm.bpe import _byte_letters
from mediasift.llm.common import map_text
from mediasift.sources.tables import table

IDS = np.dtype("<u4")
#: Pre-tokens whose ids a task remembers (a full memory is emptied; it changes the speed only).
REMEMBERED = 500_000
LONGEST_REMEMBERED = 64
#: Matches of the split pattern that are held at once for one text.
MATCHES = 1_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Rank of each token of a rank file (base64 of the bytes, a space, the rank)."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model (protocol buffer) of a vocabulary whose ranks are 0 to n-1."""
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0 to n-1, each once")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("each single byte must be a token")
    letter = {b: c for c, b in _byte_letters().items()}
    unknown, bpe = 2, 2  # values of the format's enumerations
    out = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        piece = "".join(map(letter.__getitem__, token)).encode()
        out += _message(1, _message(1, piece) + b"\x15" + struct.pack("<f", -rank))
    out += _message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + b"\x18" + _varint(unknown))
    out += _message(2, b"\x18" + _varint(bpe) + _varint(40 << 3) + _varint(len(ranks)))
    # identity; no added prefix, no removed or escaped white space
    out += _message(3, _message(1, b"identity") + b"\x18\x00\x20\x00\x28\x00")
    return bytes(out)


class BytePieces:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, lines: bytes, pattern: str):
        ranks = read_ranks(lines)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        # in the pattern, white space is Unicode's property, as in the library that defines it
        space = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
        self._split = regex.compile(space.replace(r"\S", r"\P{White_Space}"))
        letters = _byte_letters()
        letter = {b: c for c, b in letters.items()}
        self._to_letters = {b: letter[b] for b in range(256)}
        self.bytes_of = [bytes(map(letters.__getitem__, self.model.id_to_piece(i))) for i in range(len(ranks))]
        # a pre-token that is a token by itself is that token, also where no row of merges leads to it
        tokens = [t for t, _ in sorted(ranks.items(), key=lambda item: item[1])]
        self.unmerged = {t: i for i, (t, ids) in enumerate(zip(tokens, self._pieces(tokens), strict=True))
                         if len(ids) != IDS.itemsize}
        self._known: dict[str, bytes] = {}

    def _pieces(self, tokens: list[bytes]) -> list[bytes]:
        mapped = [t.decode("latin-1").translate(self._to_letters) for t in tokens]
        return [np.array(ids, IDS).tobytes() for ids in self.model.encode(mapped, num_threads=1)]

    def _learn(self, pretokens: list[str]) -> dict[str, bytes]:
        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        return {p: struct.pack("<I", self.unmerged[r]) if r in self.unmerged else ids
                for p, r, ids in zip(pretokens, raw, self._pieces(raw), strict=True)}

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        matches, out = self._split.finditer(text), []
        while part := [m.group() for m in islice(matches, MATCHES)] if len(text) > MATCHES else self._split.findall(text):
            new = list(set(part).difference(self._known))
            if new:
                if len(self._known) + len(new) > REMEMBERED:
                    self._known = {}
                    new = list(set(part))
                found = self._learn(new)
                self._known.update((p, i) for p, i in found.items() if len(p) <= LONGEST_REMEMBERED)
                known = {**self._known, **found} if any(len(p) > LONGEST_REMEMBERED for p in new) else self._known
            else:
                known = self._known
            out.append(b"".join([known[p] for p in part]))
            if len(text) <= MATCHES:
                break
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, IDS).tolist()))


@lru_cache(maxsize=4)
def _coder(lines: bytes, pattern: str) -> BytePieces:
    return BytePieces(lines, pattern)


def _vocabulary(df: DataFrame, path: str | None):
    with open(path or default_path(), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file


def encode(df: DataFrame, text_col: str = "text", path: str | None = None, pattern: str | None = None,
           ids_col: str = "ids") -> DataFrame:
    """Add ``ids``: the tokens of each whole text as little-endian unsigned 32-bit integers (binary).

    One map, no shuffle. Null text is empty text and has no ids; rows of any other kind (repeated, nulls in
    other columns) pass through; an input column of the result's name is replaced; a very long text is
    split by ``MATCHES`` pre-tokens at a time; an empty table gives an empty table.
    """
    lines, pattern = _vocabulary(df, path), pattern or default_pattern()

    def make():
        coder = _coder(lines.value, pattern)
        return lambda texts: [[coder.encode(t) if t else b"" for t in texts]]

    return map_text(df, text_col, f"`{ids_col}` binary", make)


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None, out_col: str = "decoded") -> DataFrame:
    """Add ``decoded``: the bytes of the tokens (binary; a sequence need not be whole UTF-8). Null: empty."""
    lines, pattern = _vocabulary(df, path), default_pattern()

    def make():
        coder = _coder(lines.value, pattern)
        return lambda rows: [[coder.decode(r or b"") for r in rows]]

    return map_text(df, ids_col, f"`{out_col}` binary", make)


def op12_byte_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = decode(encode(docs).drop("text"))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op12_byte_pieces": op12_byte_pieces}
ORACLE: dict[str, str] = {}  # merges by rank are not expressible in SQL; tested against the library
