"""Chunk records from documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.chunking import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS, split_chunks


def chunk_documents(
    df: DataFrame,
    text_col: str = "clean_text",
    id_col: str = "doc_id",
    category_col: str = "category",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """One row per chunk with a stable id; documents without text give none.

    A missing category column counts as null. The work is row-local, so the
    plan is scan, project, explode without a shuffle.
    """
    category = F.col(category_col) if category_col in df.columns else F.lit(None).cast("string")
    split = df.select(
        F.col(id_col).alias("doc_id"),
        category.alias("category"),
        split_chunks(F.col(text_col), size, overlap, separators).alias("chunks"),
    )
    return split.select(
        "doc_id",
        "category",
        F.size("chunks").alias("num_chunks_in_doc"),
        # The outer form keeps the optimizer from splitting twice for a size filter.
        F.posexplode_outer("chunks").alias("chunk_index", "chunk_text"),
    ).filter(F.col("chunk_text").isNotNull()).select(
        F.concat_ws("_", F.col("doc_id").cast("string"), F.col("chunk_index").cast("string")).alias(
            "chunk_id"
        ),
        "doc_id",
        "category",
        "chunk_index",
        "chunk_text",
        F.length("chunk_text").alias("chunk_length"),
        "num_chunks_in_doc",
    )
