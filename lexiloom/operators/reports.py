"""Profiles as long tables and as report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.operators import profile

# Report labels in order, with the column each one shows.
_CHECKS = [
    ("Null text entries", "null_count"),
    ("Empty / whitespace-only entries", "empty_or_whitespace_count"),
    ("Exact duplicate documents", "duplicate_count"),
    ("Documents with encoding issues", "encoding_issue_count"),
]
_LENGTHS = [
    ("Min", "length_min"),
    ("Max", "length_max"),
    ("Mean", "length_mean"),
    ("Median", "length_median"),
    ("Suspiciously short (<20 chars)", "very_short_count"),
]
_IMPACT = [
    ("Average original length", "avg_original_length"),
    ("Average cleaned length", "avg_clean_length"),
    ("Average size reduction", "pct_reduction"),
    ("Documents that became empty after cleaning", "became_empty"),
    ("Very short cleaned documents (<20 chars)", "very_short_count"),
    ("Duplicate documents after cleaning", "duplicate_count"),
]
_DECIMALS = {"length_mean", "length_median", "avg_original_length", "avg_clean_length", "pct_reduction"}


def _shown(column: str) -> Column:
    if column in _DECIMALS:
        text = F.format_string("%.1f", F.col(column))
        return F.concat(text, F.lit("%")) if column == "pct_reduction" else text
    return F.col(column).cast("string")


def _unpivot(one_row: DataFrame, sections: list[tuple[str, list[tuple[str, str]]]]) -> DataFrame:
    cells = [
        F.struct(
            F.lit(number).alias("section_no"),
            F.lit(section).alias("section"),
            F.lit(position).alias("position"),
            F.lit(label).alias("metric"),
            _shown(column).alias("value"),
        )
        for number, (section, items) in enumerate(sections)
        for position, (label, column) in enumerate(items)
    ]
    return one_row.select(F.inline(F.array(*cells)))


def _listed(rows: DataFrame, number: int, section: str, position: Column, metric: str, value: Column):
    return rows.select(
        F.lit(number).alias("section_no"),
        F.lit(section).alias("section"),
        position.cast("int").alias("position"),
        F.col(metric).alias("metric"),
        value.alias("value"),
    )


def profile_report(df: DataFrame, text_col: str = "text", category_col: str = "category") -> DataFrame:
    """Raw profile and category counts as ``(section, metric, value)`` rows."""
    figures = _unpivot(
        profile.raw_profile(df, text_col),
        [
            ("Documents", [("Total documents loaded", "total_docs")]),
            ("Checks", _CHECKS),
            ("Document Length (characters)", _LENGTHS),
        ],
    )
    categories = _listed(
        profile.category_counts(df, category_col),
        3,
        "Category Distribution",
        F.lit(0),
        "category",
        F.col("n").cast("string"),
    )
    return figures.unionByName(categories)


def quality_report(df: DataFrame, language_col: str = "language") -> DataFrame:
    """Quality profile and top languages as ``(section, metric, value)`` rows."""
    figures = _unpivot(
        profile.quality_profile(df),
        [
            ("Documents", [("Total documents processed", "total_docs")]),
            ("Cleaning Impact", _IMPACT),
        ],
    )
    languages = _listed(
        profile.language_distribution(df, language_col),
        2,
        "Language Distribution (top 10, post-cleaning)",
        -F.col("n"),
        "language",
        F.concat(F.col("n"), F.lit(" ("), F.col("pct").cast("string"), F.lit("%)")),
    )
    return figures.unionByName(languages)


def report_lines(report: DataFrame, title: str) -> DataFrame:
    """Markdown lines in reading order; a report has some tens of rows."""
    body = report.select(
        "section_no",
        F.lit(1).alias("part"),
        "position",
        "metric",
        F.concat(F.lit("- "), F.coalesce("metric", F.lit("null")), F.lit(": "), F.coalesce("value", F.lit(""))).alias("line"),
    )
    heads = report.select(
        "section_no",
        F.lit(0).alias("part"),
        F.lit(0).alias("position"),
        F.lit("").alias("metric"),
        F.concat(
            F.when(F.col("section_no") == 0, F.lit(f"# {title}\n\n")).otherwise(F.lit("")),
            F.lit("## "),
            F.col("section"),
        ).alias("line"),
    ).distinct()
    return (
        heads.unionByName(body).orderBy("section_no", "part", "position", "metric").select("line")
    )
