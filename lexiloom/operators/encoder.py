"""Embedding of texts.

The built-in encoder hashes terms into signed buckets. Tokenising and hashing
run on the JVM; a small Arrow function only adds up the hashes of a batch and
scales the rows, so the plan stays free of shuffles. Any other encoder is a
function from a list of texts to a matrix and is loaded once per task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.tokens import terms

# Fixed value: width of a vector.
DIMENSIONS = 384
# Texts per Arrow batch handed to an external encoder.
ENCODER_BATCH = 256


def term_hashes(text: Column, hash_term: Callable[[Column], Column] = F.xxhash64) -> Column:
    """Hash of every term of a text, in order; null text has none."""
    return F.transform(terms(F.coalesce(text, F.lit(""))), lambda term: hash_term(term))


def _bucket_sums(lists: pa.Array, dimensions: int) -> np.ndarray:
    """Signed bucket counts per row: the lowest bit is the sign, the rest the bucket."""
    rows = len(lists)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    hashes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row_of = np.repeat(np.arange(rows), sizes)
    cell = row_of * dimensions + (hashes >> 1) % dimensions
    sign = np.where(hashes & 1, -1.0, 1.0)
    return np.bincount(cell, weights=sign, minlength=rows * dimensions).reshape(rows, dimensions)


def hash_embed(
    df: DataFrame,
    text_col: str,
    dimensions: int = DIMENSIONS,
    hash_term: Callable[[Column], Column] = F.xxhash64,
    normalize: bool = True,
) -> DataFrame:
    """``df`` plus ``embedding``: unit vectors, or raw bucket sums without ``normalize``.

    A text without terms gets the zero vector.
    """

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            sums = _bucket_sums(lists, dimensions)
            if normalize:
                lengths = np.linalg.norm(sums, axis=1, keepdims=True)
                sums = sums / np.where(lengths > 0, lengths, 1.0)
            offsets = np.arange(0, sums.size + 1, dimensions, dtype=np.int32)
            yield pa.ListArray.from_arrays(offsets, sums.astype(np.float32).ravel())

    return df.withColumn("embedding", encode(term_hashes(F.col(text_col), hash_term)))


def embed(
    df: DataFrame, text_col: str, load_encoder: Callable[[], Callable[[list[str]], np.ndarray]]
) -> DataFrame:
    """``df`` plus ``embedding`` from an external encoder."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for texts in batches:
            parts = [
                encoder(texts.iloc[i : i + ENCODER_BATCH].fillna("").tolist())
                for i in range(0, len(texts), ENCODER_BATCH)
            ]
            rows = [np.asarray(v, dtype=np.float32) for part in parts for v in part]
            yield pd.Series(rows, index=texts.index, dtype=object)

    return df.withColumn("embedding", encode(F.col(text_col)))
