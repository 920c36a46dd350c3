"""Corpus acquisition: union of splits, decoded labels, seeded order, dense ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.plans.sizing import join_dimension

# Hex digits of the order key that name a bucket: 4 give 65,536 buckets.
BUCKET_DIGITS = 4


def order_key(seed: int, *keys: Column) -> Column:
    """Shuffle position of a row: a digest of the seed and the row's own key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def dense_ids(df: DataFrame, position: Column, id_col: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number rows 0..n-1 in the order of a hex digest.

    Rows are numbered within digest prefixes, which are of even size because the
    digest covers the row's own key. A prefix then starts where the counts of all
    smaller ones end; that table has at most 16^digits rows.
    """
    keyed = df.withColumn("__position", position).withColumn(
        "__bucket", F.substring("__position", 1, digits)
    )
    counts = keyed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy("__bucket").orderBy("__position")
    return (
        keyed.withColumn("__row", F.row_number().over(within))
        .join(F.broadcast(starts), "__bucket")
        .withColumn(id_col, F.col("__start") + F.col("__row") - 1)
        .drop("__position", "__bucket", "__row", "__start")
    )


def acquire_corpus(
    splits: dict[str, DataFrame],
    labels: DataFrame,
    row_key: str,
    text_col: str = "text",
    label_col: str = "label",
    category_col: str = "category",
    seed: int = 42,
) -> DataFrame:
    """``(doc_id, text, category)`` from labelled splits.

    ``labels`` maps ``label_col`` to ``category_col``. ``row_key`` identifies a
    row within its split; order and ids depend on it and the seed only.
    """
    parts = [
        df.select(
            F.lit(name).alias("__split"), F.col(row_key).alias("__key"), F.col(text_col).alias("text"), label_col
        )
        for name, df in splits.items()
    ]
    rows = reduce(DataFrame.unionByName, parts)
    decoded = join_dimension(rows, labels.select(label_col, category_col), label_col)
    numbered = dense_ids(decoded, order_key(seed, F.col("__split"), F.col("__key")), "doc_id")
    return numbered.select("doc_id", "text", F.col(category_col).alias("category"))
