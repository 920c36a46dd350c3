"""Recursive character splitting as one Column expression.

The splitter runs in an Arrow pass, in one go over the text: pieces tile it, so
only their lengths are needed, a chunk is a range, and the overlap is an earlier
start of the range. Time and memory grow with the length of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.text import SPACE_CHARS

# Default sizes and separators, coarse to fine.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def split_keep(text: Column, separator: str) -> Column:
    """Split on a literal, keep it at the end of each piece, drop empty pieces."""
    if separator == "":
        pattern = "(?s)."
    elif len(separator) == 1:
        mark = re.escape(separator)
        pattern = f"[^{mark}]*+{mark}|[^{mark}]++"
    else:
        pattern = f"(?s).*?{re.escape(separator)}|.++"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def piece_lengths(text: str, size: int, separators: Sequence[str]) -> Iterator[int]:
    """Lengths of the pieces of a text, in order: larger ones than ``size`` are split by the next separator."""
    if len(text) <= size:
        yield len(text)
    elif not separators:
        yield from [size] * (len(text) // size)
        if len(text) % size:
            yield len(text) % size
    elif separators[0] == "":
        # Single characters fit, so nothing finer is ever tried.
        yield from [1] * len(text)
    else:
        mark, parts = separators[0], text.split(separators[0])
        last = parts.pop()
        for part in parts:
            if len(part) + len(mark) <= size:
                yield len(part) + len(mark)
            else:
                yield from piece_lengths(part + mark, size, separators[1:])
        if last:
            yield from piece_lengths(last, size, separators[1:])


def chunk_ranges(lengths: Iterator[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Greedy packing of piece lengths into ``(start, stop)`` ranges."""
    start = stop = 0
    for piece in lengths:
        if stop - start + piece > size:
            yield start, stop
            tail = min(overlap, stop - start)
            start = stop - tail if tail + piece <= size else stop
        stop += piece
    yield start, stop


def split_chunks(
    text: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> Column:
    """Chunks of at most ``size`` characters sharing ``overlap`` with the one before.

    Blank or null text has none; an overlap not below the size counts as 0.
    """
    if size < 1:
        raise ValueError("size must be positive")
    if overlap >= size:
        overlap = 0

    overlap, marks = max(overlap, 0), tuple(separators)

    def chunks(value: str | None) -> list[str]:
        if value is None or not value.strip(SPACE_CHARS):
            return []
        if len(value) <= size:
            return [value]
        return [value[a:b] for a, b in chunk_ranges(piece_lengths(value, size, marks), size, overlap)]

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([chunks(t.as_py()) for t in texts], pa.list_(pa.string()))

    # Not copied into filters and generators that look at the chunks.
    return split.asNondeterministic()(text)
