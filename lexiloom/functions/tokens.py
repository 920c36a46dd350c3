"""Tokens: index terms, grounding words and token counts."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The shape of an index term and of a content word.
TERM = r"[\p{L}\p{N}_]{2,}"
CONTENT_WORD = "[a-z]{4,}"
CHARS_PER_TOKEN = 4


def terms(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def content_words(text: Column) -> Column:
    """Distinct lower-cased ASCII words of four or more letters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(CONTENT_WORD), F.lit(0)))


def estimated_tokens(text: Column) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / CHARS_PER_TOKEN).cast("int"))


def counted_tokens(load_encoder: Callable[[], object]) -> Callable[[Column], Column]:
    """Exact counts with an encoder that has ``encode(str) -> list``.

    ``load_encoder`` runs once per task; texts travel in Arrow batches.
    """

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else len(encoder.encode(t))).astype("Int32")

    return count
