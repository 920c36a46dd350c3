import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions.grounding import is_grounded
from lexiloom.functions.tokens import counted_tokens, estimated_tokens
from lexiloom.operators.answers import ABSTAIN_PHRASE, gate, log_records
from lexiloom.operators.attempts import classify_attempts, resolve_requests
from lexiloom.operators.contexts import ABSTAIN_SENTENCE, context_blocks, messages, rank_hits, summarize_hits
from lexiloom.operators.perf import query_log_metrics
from lexiloom.plans.answering import answer_questions, build_prompts
from lexiloom.sources.logs import append_query_log, read_query_log

HITS = "query_id LONG, doc_id STRING, text STRING, score DOUBLE"


def hits(spark, *rows):
    return rank_hits(spark.createDataFrame(list(rows), HITS))


def test_context_order_and_numbers(spark):
    block = context_blocks(hits(spark, (1, "a", "low", 0.1), (1, "b", "  high ", 0.9))).first()
    assert block.context == "[1] high\n\n[2] low" and block.num_pieces == 2


def test_first_piece_is_kept_over_budget(spark):
    block = context_blocks(hits(spark, (1, "a", "w" * 900, 0.9), (1, "b", "x", 0.5)), 50).first()
    assert block.num_pieces == 1 and block.context.startswith("[1] www")


@given(st.lists(st.integers(0, 200), min_size=1, max_size=8), st.integers(1, 120))
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_context_is_the_longest_fitting_prefix(spark, sizes, budget):
    rows = [(1, str(i), "w" * n, 1.0 - i / 100) for i, n in enumerate(sizes)]
    kept, used = 0, 0
    for i, n in enumerate(sizes, start=1):
        tokens = max(1, len(f"[{i}] " + "w" * n) // 4)
        if kept and used + tokens > budget:
            break
        kept, used = kept + 1, used + tokens
    assert context_blocks(hits(spark, *rows), budget).first().num_pieces == kept


def test_messages(spark):
    df = spark.createDataFrame([("Why 100%?", "[1] because")], "q STRING, c STRING")
    got = df.select(messages(F.col("q"), F.col("c"), "Be brief.").alias("m")).first().m
    assert [m.role for m in got] == ["system", "user"]
    assert got[0].content == "Be brief."
    assert got[1].content.startswith("Context:\n[1] because\n\nQuestion: Why 100%?\n\n")


def test_token_counts(apply, spark):
    assert apply(estimated_tokens, "", "abc", "a" * 9) == [1, 1, 2]

    class Spaces:
        def encode(self, text):
            return text.split()

    assert apply(counted_tokens(Spaces), "one two three", None) == [3, None]


def test_grounding(spark):
    rows = [
        ("The orbiter broke apart during its return", "An orbiter broke apart while it returned", True),
        ("Penguins dance gracefully under moonlight", "The orbiter broke apart", False),
        ("", "anything", True),
        ("so it is", "", True),
        ("Penguins", None, False),
    ]
    df = spark.createDataFrame(rows, "a STRING, c STRING, want BOOLEAN")
    got = df.select(is_grounded(F.col("a"), F.col("c")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def attempt(request, n, status=None, timed_out=False, retry_after=None, body=None):
    return (request, n, status, timed_out, retry_after, body)


def ok(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


ATTEMPTS = [
    attempt(1, 1, 200, body=ok("  done \n")),
    attempt(2, 1, 400, body=json.dumps({"error": {"message": "maximum Context length"}})),
    attempt(3, 1, 200, body='{"odd": 1}'),
    attempt(4, 1, 429, retry_after="7"),
    attempt(4, 2, 200, body=ok("second")),
    attempt(5, 1, 429),
    attempt(5, 2, 429),
    attempt(5, 3, 429),
    attempt(6, 1, timed_out=True),
    attempt(6, 2, timed_out=True),
    attempt(6, 3, timed_out=True),
    attempt(7, 1, 500),
    attempt(7, 2),
    attempt(7, 3, 401, body="no entry"),
    attempt(8, 1, 503),
    attempt(8, 2, 503),
    attempt(8, 3, 503),
    attempt(8, 4, 200, body=ok("too late")),
    attempt(9, 1, 200, body="not json"),
]


@pytest.fixture(scope="module")
def classified(spark):
    return classify_attempts(
        spark.createDataFrame(
            ATTEMPTS,
            "request_id LONG, attempt INT, http_status INT, timed_out BOOLEAN, retry_after STRING, body STRING",
        )
    )


def test_attempt_outcomes(classified):
    got = {(r.request_id, r.attempt): r for r in classified.collect()}
    assert got[1, 1].outcome == "ok" and got[1, 1].content == "done"
    assert got[2, 1].outcome == "prompt_too_long" and "Context" in got[2, 1].error
    assert got[3, 1].outcome == got[9, 1].outcome == "malformed"
    assert (got[4, 1].outcome, got[4, 1].wait_s) == ("retryable", 7.0)
    assert [got[5, n].wait_s for n in (1, 2, 3)] == [2.0, 4.0, 8.0]
    assert got[7, 2].error == "Connection error" and got[7, 3].outcome == "permanent"


def test_request_resolution(classified):
    got = {r.request_id: r for r in resolve_requests(classified).collect()}
    assert (got[1].outcome, got[1].attempts, got[1].content) == ("ok", 1, "done")
    assert (got[2].outcome, got[2].attempts) == ("prompt_too_long", 1)
    assert (got[4].outcome, got[4].attempts, got[4].wait_s) == ("ok", 2, 7.0)
    assert (got[5].outcome, got[5].attempts, got[5].wait_s) == ("failed", 3, 14.0)
    assert got[5].error == "Failed after 3 attempts. Last error: Rate limited (429)"
    assert "timed out" in got[6].error and got[6].outcome == "failed"
    assert (got[7].outcome, got[7].attempts, got[7].wait_s) == ("permanent", 3, 6.0)
    assert got[8].outcome == "failed" and got[8].content is None
    assert set(got) == {row[0] for row in ATTEMPTS}


def test_request_with_late_attempts_only(classified):
    late = resolve_requests(classified.filter("request_id = 8 AND attempt = 4")).collect()
    assert [(r.request_id, r.outcome, r.attempts, r.wait_s) for r in late] == [(8, "failed", 0, 0.0)]
    assert late[0].error == "Failed after 0 attempts. Last error: unknown"


def test_percentiles_are_exact_in_large_groups(spark):
    log = spark.range(30_001).selectExpr(
        "'answered' AS status", "true AS grounded", "id / 10000D AS total_latency_s", "1L AS num_chunks_retrieved"
    )
    got = query_log_metrics(log).first()
    assert (got.p50_latency_s, got.p95_latency_s) == (1.5, 2.85)


QUESTIONS = [
    (1, "where was the wooden boat built"),
    (2, "unrelated"),
    (3, "weak match"),
    (4, "abstains"),
    (5, "service down"),
    (6, "drifts"),
    (7, "no response row"),
]


@pytest.fixture(scope="module")
def results(spark):
    questions = spark.createDataFrame(QUESTIONS, "query_id LONG, question STRING")
    found = hits(
        spark,
        (1, "d1", "The wooden boat was built in a small harbour town.", 0.5),
        (1, "d2", "Boats need paint.", 0.2),
        (3, "d1", "The wooden boat", 0.0799),
        *[(q, "d1", "The wooden boat was built in town.", 0.08) for q in (4, 5, 6, 7)],
    )
    responses = spark.createDataFrame(
        [
            (1, "The wooden boat was built in a harbour town [1].", None, 0.25, 1.5),
            (2, "never asked", None, 0.25, 1.5),
            (4, "  I CANNOT answer this from the provided context. ", None, 0.25, 1.0),
            (5, None, "Failed after 3 attempts. Last error: Server error 500", 0.25, 2.0),
            (6, "Penguins dance gracefully under moonlight", None, 0.12345, 1.0),
        ],
        "query_id LONG, response STRING, error STRING, retrieval_latency_s DOUBLE, generation_latency_s DOUBLE",
    )
    return questions, found, answer_questions(questions, found, responses).cache()


def test_statuses(results):
    got = {r.query_id: r for r in results[2].collect()}
    assert {q: got[q].status for q in got} == {
        1: "answered",
        2: "out_of_domain",
        3: "out_of_domain",
        4: "abstained",
        5: "error",
        6: "answered",
        7: "error",
    }
    assert got[1].grounded is True and got[6].grounded is False
    assert got[2].grounded is None and got[5].grounded is None
    assert got[5].error.startswith("Failed after") and got[7].error == "no response"
    assert got[1].error is None and got[2].generation_latency_s == 0.0
    assert got[1].total_latency_s >= got[1].retrieval_latency_s
    assert [c.doc_id for c in got[1].retrieved_chunks] == ["d1", "d2"]
    assert got[2].retrieved_chunks is None and got[2].num_chunks_retrieved == 0
    assert ABSTAIN_PHRASE in ABSTAIN_SENTENCE.lower()


def test_gate_is_strict(results):
    questions, found, _ = results
    got = {r.query_id: r.out_of_domain for r in gate(questions, summarize_hits(found)).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: False, 6: False, 7: False}
    assert {r.query_id for r in build_prompts(questions, found, "Be brief.").collect()} == {1, 4, 5, 6, 7}


def test_log_has_one_row_per_question(spark, results, tmp_path):
    log = log_records(results[2], "some-model")
    path = str(tmp_path / "log")
    append_query_log(log.filter("status = 'out_of_domain'").limit(1), path)
    assert read_query_log(spark, path).count() == 1
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert len(lines[0]) == 11 and lines[0]["grounded"] is None
    append_query_log(log, path)
    back = read_query_log(spark, path)
    assert back.count() == 1 + len(QUESTIONS)
    drift = back.filter("question = 'drifts'").first()
    assert (drift.retrieval_latency_s, drift.total_latency_s) == (0.1235, 1.1235)
    metrics = {r.status: r for r in query_log_metrics(back).collect()}
    assert metrics["answered"].grounded_rate == 0.5 and metrics["error"].questions == 2
