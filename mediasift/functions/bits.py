"""Bit-level Column helpers for 64-bit perceptual hashes stored as BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 64


def sign_hash(vec: str, bits: int = HASH_BITS) -> Column:
    """Pack ``vec[i] > 0`` for i < bits into one BIGINT (bit i = dimension i)."""
    return F.expr(f"aggregate(sequence(0, {bits - 1}), 0L, "
                  f"(acc, i) -> acc | IF(`{vec}`[i] > 0, shiftleft(1L, i), 0L))")


def hamming(a: Column, b: Column) -> Column:
    """Hamming distance of two BIGINT hashes."""
    return F.bit_count(a.bitwiseXOR(b))


def total_hamming(a: Column, b: Column) -> Column:
    """Sum over positions of the Hamming distance of two equal-length hash arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                       F.lit(0), lambda s, x: s + x)


def to_hex(h: Column) -> Column:
    """16-digit lowercase hex text of a 64-bit hash."""
    return F.lpad(F.lower(F.hex(h)), 16, "0")
