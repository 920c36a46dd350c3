"""Clean and chunk documents as they arrive.

Both stages are row-local, so the stream needs neither state nor watermark and
takes the same code as a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lexiloom.operators.chunks import chunk_documents
from lexiloom.operators.cleaning import process_documents


def read_documents(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    )


def clean_and_chunk(documents: DataFrame, text_col: str = "text", **chunking) -> DataFrame:
    return chunk_documents(process_documents(documents, text_col), "clean_text", **chunking)


def write_chunks(chunks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, exactly once, and stop when the input is used up."""
    return (
        chunks.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
