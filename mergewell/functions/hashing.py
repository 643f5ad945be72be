"""Deterministic entity hashing, folds and samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_hash(entity: Column, salt: int = 0) -> Column:
    """A 32-bit mix of the digits that end an id; null if there are none."""
    digits = F.regexp_extract(entity, r"(\d+)$", 1)
    x = (F.when(digits != "", digits).cast("long") + F.lit(salt * 1_000_000_007)) % F.lit(1 << 32)
    for _ in range(2):
        x = (x.bitwiseXOR(F.floor(x / 65536).cast("long")) * F.lit(0x45D9F3B)) % F.lit(1 << 32)
    return x.bitwiseXOR(F.floor(x / 65536).cast("long"))


def fold(entity: Column, folds: int) -> Column:
    return (id_hash(entity) % folds).cast("int")


def sampled(entity: Column, share: float, salt: int = 1) -> Column:
    """True for about this share of ids, the same in every run."""
    return id_hash(entity, salt) % 1_000_000 < int(share * 1_000_000)
