"""From raw documents to an ingested collection."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from lexiloom.operators.chunks import chunk_documents
from lexiloom.operators.cleaning import drop_binary, process_documents
from lexiloom.operators.encoder import hash_embed
from lexiloom.operators.language import with_language
from lexiloom.operators.perf import batch_timing
from lexiloom.sources.collection import Collection
from lexiloom.sources.logs import append_embedding_perf


def prepare_corpus(
    raw: DataFrame,
    profile: DataFrame,
    text_col: str = "text",
    drop_empty: bool = False,
) -> DataFrame:
    """Clean text, lengths and language of every document."""
    processed = process_documents(raw, text_col, drop_empty)
    return with_language(processed, profile, "clean_text")


def publish(processed: DataFrame, path: str) -> DataFrame:
    """Write the processed table and return it as stored.

    Reports, chunking and indexing each read it, so it is computed once here.
    """
    processed.write.mode("overwrite").parquet(path)
    return processed.sparkSession.read.parquet(path)


def ingest(
    processed: DataFrame,
    collection: Collection,
    embed=None,
    skip_binary: bool = False,
    replace_docs: bool = False,
    order: list | None = None,
    perf_log: str | None = None,
    model_name: str = "hashing",
    **chunking,
) -> int:
    """Chunk, embed and upsert documents; returns the collection version.

    ``order`` says which of several rows of a chunk id is the last write. With
    ``perf_log`` the batch is timed and a row about it appended there.
    """
    started = time.perf_counter()
    source = drop_binary(processed, "clean_text") if skip_binary else processed
    chunks = chunk_documents(source, **chunking)
    embedded = embed(chunks) if embed else hash_embed(chunks, "chunk_text")
    version = collection.upsert(embedded, order, replace_docs)
    if perf_log is not None:
        append_embedding_perf(
            batch_timing(embedded, collection.batch_rows, time.perf_counter() - started), perf_log, model_name
        )
    return version
