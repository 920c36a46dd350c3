"""Clean stage over a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.binding import compute_once
from lexiloom.functions.text import clean_text, is_valid_text, looks_printable, text_length


def process_documents(df: DataFrame, text_col: str = "text", drop_empty: bool = False) -> DataFrame:
    """Add ``clean_text``, ``original_length`` and ``clean_length``; the raw text stays.

    Cleaned-to-empty documents are kept unless ``drop_empty`` is set.
    """
    cleaned = compute_once(df, clean_text=clean_text(F.col(text_col)))
    out = cleaned.withColumns(
        {
            "original_length": text_length(F.col(text_col)),
            "clean_length": text_length(F.col("clean_text")),
        }
    )
    return out.filter(F.col("clean_length") > 0) if drop_empty else out


def drop_blank(df: DataFrame, text_col: str) -> DataFrame:
    """Keep rows with usable text."""
    return df.filter(is_valid_text(F.col(text_col)))


def drop_binary(
    df: DataFrame, text_col: str, min_ratio: float = 0.9, max_token: int = 200
) -> DataFrame:
    """Keep rows that read as text rather than encoded attachments."""
    return df.filter(looks_printable(F.col(text_col), min_ratio, max_token))


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Fail at plan time when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail when the table is empty."""
    if df.isEmpty():
        raise ValueError(f"{what} has no usable rows")
    return df
