"""Corpus profiles.

Profiles group by a digest of the text first and then aggregate the groups. The
shuffle carries 32 bytes per distinct text instead of the text, copies are
merged before it, and duplicates and all length figures come from one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.text import has_encoding_issue, is_valid_text

# Fixed value: texts below this many characters are reported as very short.
SHORT_BELOW = 20


def text_digest(text: Column) -> Column:
    """Content key; null text keeps a null key, which groups like any value."""
    return F.unhex(F.sha2(text, 256))


def duplicate_count(df: DataFrame, *columns: str) -> DataFrame:
    """Rows beyond the first of each equal value, per column; nulls equal each other."""
    counted = [
        df.groupBy(text_digest(F.col(c)).alias("digest"))
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))
        .select(F.lit(c).alias("column_name"), "duplicates")
        for c in columns
    ]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out


def raw_profile(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: nulls, blanks, duplicates, encoding issues and length figures."""
    text = F.col(text_col)
    groups = (
        df.select(
            text_digest(text).alias("digest"),
            F.length(text).alias("chars"),
            (text.isNotNull() & ~is_valid_text(text)).alias("blank"),
            has_encoding_issue(text.cast("binary")).alias("broken"),
        )
        .groupBy("digest")
        .agg(
            F.count("*").alias("n"),
            F.max("chars").alias("chars"),
            F.max("blank").alias("blank"),
            F.max("broken").alias("broken"),
        )
    )

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    known = F.col("chars").isNotNull()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs"),
        rows(~known).alias("null_count"),
        rows(F.col("blank")).alias("empty_or_whitespace_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
        rows(F.col("broken")).alias("encoding_issue_count"),
        F.min("chars").cast("long").alias("length_min"),
        F.max("chars").cast("long").alias("length_max"),
        F.round(
            F.try_divide(F.sum(F.col("chars").cast("long") * F.col("n")).cast("double"), rows(known)), 1
        ).alias("length_mean"),
        F.percentile(F.col("chars"), F.lit(0.5), F.col("n")).alias("length_median"),
        rows(F.col("chars") < SHORT_BELOW).alias("very_short_count"),
    )


def quality_profile(
    df: DataFrame,
    clean_col: str = "clean_text",
    original_length: str = "original_length",
    clean_length: str = "clean_length",
) -> DataFrame:
    """One row on what cleaning did; the reduction comes from the rounded averages."""
    groups = df.groupBy(text_digest(F.col(clean_col)).alias("digest")).agg(
        F.count("*").alias("n"),
        F.sum(F.col(original_length).cast("long")).alias("original_chars"),
        F.sum(F.col(clean_length).cast("long")).alias("clean_chars"),
        F.max(clean_length).alias("chars"),
    )

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs"),
        F.round(F.try_divide(F.sum("original_chars").cast("double"), F.sum("n")), 1).alias(
            "avg_original_length"
        ),
        F.round(F.try_divide(F.sum("clean_chars").cast("double"), F.sum("n")), 1).alias(
            "avg_clean_length"
        ),
        rows(F.col("chars") == 0).alias("became_empty"),
        rows((F.col("chars") > 0) & (F.col("chars") < SHORT_BELOW)).alias("very_short_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    )
    reduction = F.round(
        100 * (1 - F.try_divide(F.col("avg_clean_length"), F.col("avg_original_length"))), 1
    )
    return totals.withColumn("pct_reduction", F.coalesce(reduction, F.lit(0.0)))


def category_counts(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Documents per category, by name."""
    return (
        df.groupBy(F.col(category_col).alias("category"))
        .agg(F.count("*").alias("n"))
        .orderBy("category")
    )


def category_cardinality(df: DataFrame, category_col: str = "category") -> DataFrame:
    """Number of distinct categories."""
    return df.agg(F.count_distinct(category_col).alias("categories"))


#: Registers of a sketch, as a power of two, and the relative error they mean: three standard errors.
SKETCH_SIZE = 14
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_SIZE / 2)


def distinct_sketches(df: DataFrame, value: Column, *groups: Column | str) -> DataFrame:
    """Groups plus ``sketch``: a state of bounded size (16 KB) that stands for the distinct values.

    Stored states of days, sources or batches are merged later without the rows;
    groups are sketched where they lie and a hot group shuffles only its states.
    Null values do not count; a group of nulls alone has an empty state.
    """
    return df.groupBy(*groups).agg(F.hll_sketch_agg(value, SKETCH_SIZE).alias("sketch"))


def merged_distinct(sketches: DataFrame, *groups: Column | str) -> DataFrame:
    """Groups plus ``distinct_estimate`` over all their states, within ``SKETCH_ERROR`` in 997 of 1000 cases."""
    union = F.hll_union_agg("sketch")
    return sketches.groupBy(*groups).agg(
        F.coalesce(F.hll_sketch_estimate(union), F.lit(0)).alias("distinct_estimate")
    )


def language_distribution(
    df: DataFrame, language_col: str = "language", top: int = 10
) -> DataFrame:
    """Most frequent languages with their share of all documents; ties by name."""
    counts = df.groupBy(F.col(language_col).alias("language")).agg(F.count("*").alias("n"))
    # The window spans one row per language, not the corpus.
    share = F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2)
    return (
        counts.select("language", "n", share.alias("pct")).orderBy(F.desc("n"), "language").limit(top)
    )
