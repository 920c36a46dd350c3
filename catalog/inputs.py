"""Inputs shared by queries: the given tables and tables derived from all their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.sources.files import read_table, spread

# Mail-like posts around every document, so that each cleaning step has work, and
# beside them a missing, a blank and a header-only post per source.
# The same text runs on both engines.
POSTS_SQL = """
SELECT doc_id, source AS category, lang,
  concat(
      'From: user', CAST(doc_id % 97 AS STRING), '@site.example', chr(10),
      'Subject: Re: item ', CAST(doc_id % 31 AS STRING), chr(10),
      'NNTP-Posting-Host: h.example', chr(10), chr(10),
      CASE WHEN doc_id % 4 = 0 THEN concat('Note: eaten by the header rule', chr(10)) ELSE '' END,
      CASE WHEN doc_id % 3 = 0 THEN concat('In article <1@x.example>, (b@c.example) wrote:', chr(10),
        ' > quoted', chr(10), chr(10)) ELSE '' END,
      text, chr(10),
      CASE WHEN doc_id % 5 = 0 THEN concat('see <b>this</b> https://a.example/p?q=1 and www.b.example',
        chr(10)) ELSE '' END,
      CASE WHEN doc_id % 6 = 0 THEN concat('great 😀 👍', chr(10)) ELSE '' END,
      CASE WHEN doc_id % 7 = 0 THEN concat('itâ€™s broken', chr(10)) ELSE '' END,
      CASE WHEN doc_id % 2 = 0 THEN concat('-- ', chr(10), 'A. Name', chr(10), 'a.name@site.example',
        chr(10)) ELSE '' END) AS text
FROM {documents}
UNION ALL SELECT -1 - 3 * min(doc_id), source, min(lang), CAST(NULL AS STRING)
FROM {documents} GROUP BY source
UNION ALL SELECT -2 - 3 * min(doc_id), source, min(lang), concat('  ', chr(10), chr(9), ' ')
FROM {documents} GROUP BY source
UNION ALL SELECT -3 - 3 * min(doc_id), source, min(lang),
  concat('From: a@b.example', chr(10), 'Lines: 0', chr(10), chr(10))
FROM {documents} GROUP BY source
"""

# One captured API attempt per event, three to a request.
ATTEMPTS_SQL = """
SELECT CAST(floor(event_id / 3) AS BIGINT) AS request_id, CAST(event_id % 3 + 1 AS INT) AS attempt,
  CASE WHEN event_type = 'click' AND user_id % 5 = 0 THEN NULL
       WHEN event_type IN ('purchase', 'signup') THEN 200
       WHEN event_type = 'view' THEN 429
       WHEN event_type = 'click' THEN 503
       WHEN user_id % 3 = 1 THEN 401 ELSE 400 END AS http_status,
  (event_type = 'click' AND user_id % 10 = 0) AS timed_out,
  CASE WHEN event_type = 'view' AND user_id % 2 = 0
       THEN CAST(user_id % 10 AS STRING) END AS retry_after,
  CASE WHEN event_type = 'signup' AND user_id % 4 = 0 THEN '{{"unexpected": true}}'
       WHEN event_type IN ('purchase', 'signup') THEN concat(
         '{{"choices": [{{"message": {{"content": "  reply ', CAST(event_id AS STRING), ' "}}}}]}}')
       WHEN event_type = 'error' AND user_id % 3 = 0
         THEN '{{"error": {{"message": "maximum Context length passed"}}}}'
       WHEN event_type = 'error' AND user_id % 3 = 1 THEN '{{"error": {{"message": "bad key"}}}}'
       WHEN event_type = 'error' THEN 'not json' END AS body
FROM {events}
"""

# Every user turn, with the reply that follows as the model's response; a turn
# without one is a call that got none. Beside them each conversation asks its
# least user text twice more: one call abstains and one fails.
DIALOGUES_SQL = """
SELECT u.conv_id * 1000 + u.turn AS query_id, u.text AS question, a.text AS response,
  CAST(NULL AS STRING) AS error,
  CAST(length(u.text) AS DOUBLE) / 8192 AS retrieval_latency_s,
  coalesce(CAST(length(a.text) AS DOUBLE) / 1024, 0) AS generation_latency_s
FROM {conversations} u LEFT JOIN {conversations} a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'
UNION ALL SELECT -1 - 2 * conv_id, min(text),
  concat('  I cannot answer this from the provided context. ', CAST(conv_id AS STRING)),
  CAST(NULL AS STRING), CAST(length(min(text)) AS DOUBLE) / 8192, CAST(conv_id % 8 AS DOUBLE) / 1024
FROM {conversations} WHERE role = 'user' GROUP BY conv_id
UNION ALL SELECT -2 - 2 * conv_id, min(text), CAST(NULL AS STRING), 'Server error 503',
  CAST(length(min(text)) AS DOUBLE) / 8192, CAST(0 AS DOUBLE)
FROM {conversations} WHERE role = 'user' GROUP BY conv_id
"""


def duck(sql: str) -> str:
    """The same text for an engine in which the tables are views."""
    return sql.format(documents="documents", events="events", conversations="conversations")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(read_table(spark, folder, "documents"), "doc_id")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(POSTS_SQL, documents=documents(spark, folder))


def attempts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(ATTEMPTS_SQL, events=table(spark, folder, "events"))


def dialogues(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(DIALOGUES_SQL, conversations=table(spark, folder, "conversations"))


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages as queries."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
