"""Bit tables of bounded size that tell which hashes may be in a set; built by the executors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a table per entry, and at most.
BITS_PER_ENTRY, MAX_BITS = 16, 1 << 28


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """Two bits for each 64-bit hash in the column; more hashes than fit make more pass, never less."""
    n = hashes.count()
    size = 1 << max(16, min(MAX_BITS, n * BITS_PER_ENTRY).bit_length() - 1)
    spots = F.array(*[F.expr(f"{spot} & {size - 1}L") for spot in (column, f"shiftright({column}, 29)")])
    rows = (
        hashes.select(F.explode(spots).alias("s"))
        .groupBy(F.shiftright("s", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(size // 64, dtype=np.int64)
    table[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint64)


def held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the table."""
    signed, mask, found = hashes.view(np.int64), np.int64(len(table) * 64 - 1), np.ones(len(hashes), dtype=bool)
    for spot in (signed & mask, (signed >> np.int64(29)) & mask):
        found &= ((table[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return found
