"""Outcome of captured API attempts, per attempt and per request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.text import strip

# Attempts per request, back-off base and time limit in seconds,
# and the outcome names and error texts.
MAX_ATTEMPTS = 3
BASE_BACKOFF_SECONDS = 2
TIMEOUT_SECONDS = 30
OK, RETRYABLE, PROMPT_TOO_LONG, PERMANENT, MALFORMED = (
    "ok",
    "retryable",
    "prompt_too_long",
    "permanent",
    "malformed",
)
RAW_SHOWN = 300


def classify_attempts(attempts: DataFrame, timeout: int = TIMEOUT_SECONDS) -> DataFrame:
    """Add ``outcome``, ``content``, ``error`` and ``wait_s``.

    Time-outs, lost connections (no status), 429 and 5xx may be retried after
    ``wait_s``: the server's Retry-After for 429, else a doubling back-off.
    """
    status = F.col("http_status")
    body = F.coalesce("body", F.lit(""))
    content = F.get_json_object(body, "$.choices[0].message.content")
    detail = F.coalesce(F.get_json_object(body, "$.error.message"), body)
    lost = F.col("timed_out") | status.isNull()
    outcome = (
        F.when(lost | (status == 429) | (status >= 500), RETRYABLE)
        .when((status == 400) & F.contains(F.lower(detail), F.lit("context")), PROMPT_TOO_LONG)
        .when(status >= 400, PERMANENT)
        .when(content.isNull(), MALFORMED)
        .otherwise(OK)
    )
    code = status.cast("string")
    error = (
        F.when(F.col("timed_out"), F.lit(f"Request timed out after {timeout}s"))
        .when(status.isNull(), F.lit("Connection error"))
        .when(status == 429, F.lit("Rate limited (429)"))
        .when(status >= 500, F.concat(F.lit("Server error "), code))
        .when(
            F.col("outcome") == PROMPT_TOO_LONG,
            F.concat(F.lit("Prompt too long for model context window: "), detail),
        )
        .when(status >= 400, F.concat(F.lit("API error "), code, F.lit(": "), detail))
        .when(
            content.isNull(),
            F.concat(F.lit("Malformed API response: raw="), F.substring(body, 1, RAW_SHOWN)),
        )
    )
    backoff = BASE_BACKOFF_SECONDS * F.pow(F.lit(2.0), F.col("attempt") - 1)
    asked = F.when(~lost & (status == 429), F.expr("try_cast(retry_after AS double)"))
    return attempts.withColumn("outcome", outcome).withColumns(
        {
            "content": F.when(F.col("outcome") == OK, strip(content)),
            "error": error,
            "wait_s": F.when(F.col("outcome") == RETRYABLE, F.coalesce(asked, backoff)).otherwise(
                F.lit(0.0)
            ),
        }
    )


def resolve_requests(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row per request: the first attempt that ends it, else a failure.

    Takes classified attempts. Each of the few attempt numbers is its own
    aggregate, so a request with many captured rows is merged before the shuffle.
    Attempts beyond ``max_attempts`` decide nothing, but their request stays: one
    that has no others failed after 0 attempts, with no error known.
    """
    fields = F.struct("outcome", "content", "error", "wait_s")
    slots = [
        F.max(F.when(F.col("attempt") == n, fields)).alias(f"a{n}")
        for n in range(1, max_attempts + 1)
    ]
    wide = attempts.groupBy("request_id").agg(*slots)
    seen = [F.col(f"a{n}") for n in range(1, max_attempts + 1)]
    ends = [slot["outcome"] != RETRYABLE for slot in seen]
    decided = F.coalesce(
        *[
            F.when(end, F.struct(F.lit(n).alias("attempt"), slot.alias("result")))
            for n, (slot, end) in enumerate(zip(seen, ends), start=1)
        ]
    )
    wide = wide.withColumn("decided", decided)
    stop = F.coalesce("decided.attempt", F.lit(max_attempts + 1))
    waited = sum(
        (
            F.when(stop > n, F.coalesce(slot["wait_s"], F.lit(0.0))).otherwise(F.lit(0.0))
            for n, slot in enumerate(seen, start=1)
        ),
        F.lit(0.0),
    )
    tried = F.coalesce(
        "decided.attempt",
        sum((F.when(slot.isNotNull(), 1).otherwise(0) for slot in seen), F.lit(0)),
    )
    last_error = F.coalesce(*[slot["error"] for slot in reversed(seen)], F.lit("unknown"))
    failure = F.concat(
        F.lit("Failed after "), tried.cast("string"), F.lit(" attempts. Last error: "), last_error
    )
    return wide.select(
        "request_id",
        F.coalesce("decided.result.outcome", F.lit("failed")).alias("outcome"),
        tried.alias("attempts"),
        waited.alias("wait_s"),
        F.col("decided.result.content").alias("content"),
        F.when(F.col("decided").isNull(), failure)
        .otherwise(F.col("decided.result.error"))
        .alias("error"),
    )
