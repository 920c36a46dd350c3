"""Queries on splitting and chunk records."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.inputs import documents
from catalog.registry import query
from lexiloom.functions.chunking import split_chunks, split_keep
from lexiloom.operators.chunks import chunk_documents as chunk_table


@query(
    "split_keep",
    """SELECT doc_id, CAST(len(kept) AS BIGINT) AS pieces,
  array_to_string(list_transform(kept, lambda p: CAST(length(p) AS VARCHAR)), ',') AS lengths,
  kept[1] AS first_piece FROM (
    SELECT doc_id, list_filter(list_transform(parts, lambda p, i:
      CASE WHEN i < len(parts) THEN p || '. ' ELSE p END), lambda p: p <> '') AS kept
    FROM (SELECT doc_id, string_split(text, '. ') AS parts FROM documents))""",
)
def split_on_sentences(spark, folder):
    kept = documents(spark, folder).select("doc_id", split_keep(F.col("text"), ". ").alias("kept"))
    lengths = F.transform("kept", lambda p: F.length(p).cast("string"))
    return kept.select(
        "doc_id",
        F.size("kept").alias("pieces"),
        F.array_join(lengths, ",").alias("lengths"),
        F.try_element_at("kept", F.lit(1)).alias("first_piece"),
    )


@query(
    "chunk_counts",
    f"""WITH {S.chunked('documents', 'text', 60, 15)}
SELECT doc_id, count(*) AS chunks, CAST(sum(length(chunk_text)) AS BIGINT) AS chars,
  CAST(max(length(chunk_text)) AS BIGINT) AS longest FROM chunked GROUP BY doc_id""",
)
def chunk_counts(spark, folder):
    """Small chunks, so that every separator level comes into play."""
    chunks = split_chunks(F.col("text"), 60, 15)
    lengths = F.transform("chunks", lambda c: F.length(c).cast("long"))
    return (
        documents(spark, folder)
        .select("doc_id", chunks.alias("chunks"))
        .filter(F.size("chunks") > 0)
        .select(
            "doc_id",
            F.size("chunks").alias("chunks"),
            F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"),
            F.array_max(lengths).alias("longest"),
        )
    )


@query(
    "chunk_documents",
    f"""WITH {S.chunked('documents', 'text', 1000, 100)}
SELECT doc_id || '_' || chunk_index AS chunk_id, doc_id, source AS category,
  CAST(chunk_index AS BIGINT) AS chunk_index, chunk_text,
  CAST(length(chunk_text) AS BIGINT) AS chunk_length,
  CAST(num_chunks_in_doc AS BIGINT) AS num_chunks_in_doc
FROM chunked JOIN (SELECT doc_id, source FROM documents) USING (doc_id)""",
)
def chunk_documents(spark, folder):
    return chunk_table(documents(spark, folder), "text", category_col="source")
