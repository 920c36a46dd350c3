"""Helpers shared by the operators: tables, splits by id, byte-level words and hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = bytes(range(65, 91))
#: Lower-cases A-Z only; bytes of other characters stay.
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: As LOWER; ASCII other than digits and letters becomes a space.
LETTERS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).translate(LOWER)
)
#: The six characters that end a word.
BLANKS = b" \t\n\v\f\r"

_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True
#: Bytes hashed at once; eight-byte intermediates make this about 12 MB.
_PIECE = 1 << 18


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


#: Rows and bytes of an Arrow batch that suit whole texts and sets: what a worker and the JVM hold depends on both.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches within ``BATCH`` for the jobs run inside; then the session's own again."""
    before = {name: spark.conf.get(name) for name in BATCH}
    for name, most in BATCH.items():
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def give_back() -> None:
    """Free memory of this worker returns to the system: workers live on, idle, between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have none
    if trim is not None:
        trim(0)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = _PIECE) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``limit`` bytes; one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _weight(places: np.ndarray) -> np.ndarray:
    """An odd factor for each place in a word."""
    return mix((places.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


_WEIGHTS = _weight(np.arange(1 << 12))


def _weights(places: np.ndarray) -> np.ndarray:
    out = _WEIGHTS[np.minimum(places, len(_WEIGHTS) - 1)]
    far = places >= len(_WEIGHTS)
    if far.any():
        out[far] = _weight(places[far])
    return out


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end of every word (run of bytes other than ``BLANKS``).

    Long texts are taken in pieces cut at a blank, so memory stays bounded but
    for a single word longer than a piece.
    """
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + _PIECE)
        if end < len(text):
            cut = max(text.rfind(bytes([b]), at, end) for b in BLANKS)
            if cut < 0:
                nxt = [p for b in BLANKS if (p := text.find(bytes([b]), end)) >= 0]
                cut = min(nxt, default=len(text) - 1)
            end = cut + 1
        parts.append((at, *_piece_hashes(np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at))))
        at = end
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    return (
        np.concatenate([p[1] for p in parts]),
        np.concatenate([p[2] + p[0] for p in parts]),
        np.concatenate([p[3] + p[0] for p in parts]),
    )


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([True], _IS_BLANK[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts.astype(np.uint64), starts, ends
    lengths = ends - starts
    letters = ~_IS_BLANK[data]
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = (data[letters].astype(np.uint64) + np.uint64(1)) * _weights(place)
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix(sums + mix(lengths.astype(np.uint64))), starts, ends
