"""CSV and Parquet tables.

Parquet is the format between stages. CSV is for exchange: quoted fields may
hold line breaks, which makes a file unsplittable, so write many files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_STAMP = "yyyy-MM-dd'T'HH:mm:ss"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input that is read in fewer pieces than there are cores.

    A file cannot be read in more pieces than it has row groups. Inputs of any
    size have more pieces than a cluster has cores and pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV with header; fields may be quoted over several lines."""
    return (
        spark.read.options(**_CSV, multiLine=multi_line, timestampFormat=_STAMP)
        .schema(schema)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header, no index; nulls and empty texts are both written empty."""
    df.write.mode(mode).options(**_CSV, emptyValue="", timestampFormat=_STAMP).csv(path)
