"""Queries on corpus profiles, reports and timings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as S
from catalog.inputs import documents, posts, table
from catalog.registry import query
from lexiloom.operators import language, perf, profile, reports
from lexiloom.operators.cleaning import process_documents
from lexiloom.plans.corpus import prepare_corpus, publish
from lexiloom.sources.scratch import scratch_path

_RAW = f"""raw_profile AS (SELECT count(*) AS total_docs,
  count(*) FILTER (text IS NULL) AS null_count,
  count(*) FILTER (text IS NOT NULL AND NOT {S.valid('text')}) AS empty_or_whitespace_count,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM posts GROUP BY text)) AS duplicate_count,
  CAST(0 AS BIGINT) AS encoding_issue_count,
  min(length(text)) AS length_min, max(length(text)) AS length_max,
  round(avg(length(text)), 1) AS length_mean, CAST(median(length(text)) AS DOUBLE) AS length_median,
  count(*) FILTER (length(text) < 20) AS very_short_count FROM posts)"""

_QUALITY = """quality_profile AS (SELECT *, CASE WHEN avg_original_length = 0 THEN 0
    ELSE round(100 * (1 - avg_clean_length / avg_original_length), 1) END AS pct_reduction FROM (
  SELECT count(*) AS total_docs, round(avg(original_length), 1) AS avg_original_length,
    round(avg(clean_length), 1) AS avg_clean_length,
    count(*) FILTER (clean_length = 0) AS became_empty,
    count(*) FILTER (clean_length > 0 AND clean_length < 20) AS very_short_count,
    (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM cleaned GROUP BY clean_text))
      AS duplicate_count FROM cleaned))"""


@query("raw_profile", f"WITH {S.POSTS}, {_RAW} SELECT * FROM raw_profile")
def raw_profile(spark, folder):
    return profile.raw_profile(posts(spark, folder))


@query(
    "duplicate_count",
    f"""WITH {S.POSTS}
SELECT 'text' AS column_name, CAST(sum(n - 1) AS BIGINT) AS duplicates
  FROM (SELECT count(*) AS n FROM posts GROUP BY text)
UNION ALL SELECT 'category', CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM posts GROUP BY category)""",
)
def duplicate_count(spark, folder):
    return profile.duplicate_count(posts(spark, folder), "text", "category")


@query("quality_profile", f"WITH {S.POSTS}, {S.cleaned()}, {_QUALITY} SELECT * FROM quality_profile")
def quality_profile(spark, folder):
    return profile.quality_profile(process_documents(posts(spark, folder)))


@query("category_counts", "SELECT source AS category, count(*) AS n FROM documents GROUP BY source")
def category_counts(spark, folder):
    return profile.category_counts(table(spark, folder, "documents"), "source")


@query("category_cardinality", "SELECT count(DISTINCT source) AS categories FROM documents")
def category_cardinality(spark, folder):
    return profile.category_cardinality(table(spark, folder, "documents"), "source")


@query(
    "distinct_sketches",
    """SELECT lang, count(DISTINCT text) AS texts, true AS within_error FROM documents GROUP BY lang
UNION ALL SELECT 'all', count(DISTINCT text), true FROM documents""",
)
def distinct_sketches(spark, folder):
    """Distinct texts from stored sketches of each source and language, merged and held against exact counts."""
    docs = table(spark, folder, "documents")
    path = scratch_path(spark, "sketches")
    profile.distinct_sketches(docs, profile.text_digest(F.col("text")), "source", "lang").write.parquet(path)
    stored = spark.read.parquet(path)
    every = F.lit("all").alias("lang")
    merged = profile.merged_distinct(stored, "lang").unionAll(profile.merged_distinct(stored, every))
    # Equal texts of two languages are met again in the whole: counted in two steps, by text and by language.
    kinds = docs.groupBy(profile.text_digest(F.col("text")).alias("digest")).agg(F.collect_set("lang").alias("langs"))
    named = F.filter(F.concat("langs", F.array(F.lit("all"))), lambda x: x.isNotNull())
    exact = (
        kinds.filter("digest is not null").select(F.explode(named).alias("lang"))
        .groupBy("lang").agg(F.count("*").alias("texts"))
    )
    near = F.abs(F.col("distinct_estimate") - F.col("texts")) <= F.ceil(profile.SKETCH_ERROR * F.col("texts"))
    return exact.join(merged, "lang").select("lang", "texts", near.alias("within_error"))


@query(
    "language_top10",
    """SELECT lang AS language, count(*) AS n,
  round(100 * count(*) / (SELECT count(*) FROM documents), 2) AS pct
FROM documents GROUP BY lang ORDER BY n DESC, language LIMIT 10""",
)
def language_top10(spark, folder):
    return profile.language_distribution(table(spark, folder, "documents"), "lang")


def _cells(table_name: str, items: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{metric}' AS metric, {value} AS value FROM {table_name}"
        for section, metric, value in items
    )


_COUNT = "CAST({} AS VARCHAR)".format
_TENTH = "printf('%.1f', {})".format


@query(
    "profile_report",
    f"WITH {S.POSTS}, {_RAW} "
    + _cells(
        "raw_profile",
        [
            ("Documents", "Total documents loaded", _COUNT("total_docs")),
            ("Checks", "Null text entries", _COUNT("null_count")),
            ("Checks", "Empty / whitespace-only entries", _COUNT("empty_or_whitespace_count")),
            ("Checks", "Exact duplicate documents", _COUNT("duplicate_count")),
            ("Checks", "Documents with encoding issues", _COUNT("encoding_issue_count")),
            ("Document Length (characters)", "Min", _COUNT("length_min")),
            ("Document Length (characters)", "Max", _COUNT("length_max")),
            ("Document Length (characters)", "Mean", _TENTH("length_mean")),
            ("Document Length (characters)", "Median", _TENTH("length_median")),
            (
                "Document Length (characters)",
                "Suspiciously short (<20 chars)",
                _COUNT("very_short_count"),
            ),
        ],
    )
    + " UNION ALL SELECT 'Category Distribution', category, CAST(count(*) AS VARCHAR) FROM posts GROUP BY category",
)
def profile_report(spark, folder):
    return reports.profile_report(posts(spark, folder)).select("section", "metric", "value")


@query(
    "quality_report",
    f"WITH {S.POSTS}, {S.cleaned()}, {S.detected('cleaned', 'clean_text')}, {_QUALITY}, "
    "langs AS (SELECT language, count(*) AS n FROM detected GROUP BY language ORDER BY n DESC, language LIMIT 10) "
    + _cells(
        "quality_profile",
        [
            ("Documents", "Total documents processed", _COUNT("total_docs")),
            ("Cleaning Impact", "Average original length", _TENTH("avg_original_length")),
            ("Cleaning Impact", "Average cleaned length", _TENTH("avg_clean_length")),
            ("Cleaning Impact", "Average size reduction", _TENTH("pct_reduction") + " || '%'"),
            ("Cleaning Impact", "Documents that became empty after cleaning", _COUNT("became_empty")),
            ("Cleaning Impact", "Very short cleaned documents (<20 chars)", _COUNT("very_short_count")),
            ("Cleaning Impact", "Duplicate documents after cleaning", _COUNT("duplicate_count")),
        ],
    )
    + """ UNION ALL SELECT 'Language Distribution (top 10, post-cleaning)', language, n || ' (' ||
  CAST(round(100 * n / (SELECT count(*) FROM detected), 2) AS VARCHAR) || '%)' FROM langs""",
)
def quality_report(spark, folder):
    words = language.language_profile(documents(spark, folder))
    processed = prepare_corpus(posts(spark, folder), words)
    processed = publish(processed, scratch_path(spark, "processed"))
    return reports.quality_report(processed).select("section", "metric", "value")


def _perf(spark, folder):
    """Every event read as the timing of one embedding batch."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("model_name"),
        (1 + F.col("event_id") % 256).cast("int").alias("num_chunks"),
        F.col("value").alias("total_time_sec"),
        F.lit(384).alias("embedding_dim"),
    )


@query(
    "perf_rollup",
    """SELECT event_type AS model_name, count(*) AS batches,
  CAST(sum(1 + event_id % 256) AS BIGINT) AS num_chunks, round(sum(value), 2) AS total_time_sec,
  round(sum(value) / sum(1 + event_id % 256), 6) AS avg_time_per_chunk_sec, CAST(384 AS BIGINT) AS embedding_dim
FROM events GROUP BY event_type""",
)
def perf_rollup(spark, folder):
    return perf.embedding_rollup(_perf(spark, folder))


@query(
    "latency_rollup",
    """SELECT event_type, count(*) AS queries, min(value) AS min_latency,
  round(avg(value), 6) AS avg_latency, max(value) AS max_latency FROM events GROUP BY event_type""",
)
def latency_rollup(spark, folder):
    return perf.latency_rollup(table(spark, folder, "events"), "value", "event_type")


@query(
    "embedding_stats",
    """SELECT CAST(label AS BIGINT) AS label, count(*) AS num_chunks, round(max(vec_id) / 1000, 4) AS total_time_sec,
  round(max(vec_id) / 1000 / count(*), 6) AS avg_time_per_chunk_sec, max(len(embedding)) AS embedding_dim
FROM embeddings GROUP BY label""",
)
def embedding_stats(spark, folder):
    timed = table(spark, folder, "embeddings").withColumn("elapsed", F.col("vec_id") / 1000)
    return perf.batch_stats(timed, ["label"], "elapsed")
