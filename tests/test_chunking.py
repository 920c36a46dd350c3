import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions.chunking import SEPARATORS, chunk_ranges, piece_lengths, split_chunks, split_keep
from lexiloom.operators.chunks import chunk_documents


def split(apply, text, size=1000, overlap=100, separators=SEPARATORS):
    return apply(lambda c: split_chunks(c, size, overlap, separators), text)[0]


def brute_force(text, size, overlap, separators):
    """Small model of the splitter working on cut positions."""
    if not text.strip():
        return []
    if overlap >= size:
        overlap = 0
    if len(text) <= size:
        return [text]
    spans = [(0, len(text))]
    for sep in separators:
        finer = []
        for a, b in spans:
            if b - a <= size:
                finer.append((a, b))
            elif sep == "":
                finer += [(i, i + 1) for i in range(a, b)]
            else:
                at = a
                while (hit := text.find(sep, at, b)) >= 0:
                    finer.append((at, hit + len(sep)))
                    at = hit + len(sep)
                if at < b:
                    finer.append((at, b))
        spans = finer
    out, start, stop = [], spans[0][0], spans[0][1]
    for a, b in spans[1:]:
        if b - start <= size:
            stop = b
            continue
        out.append(text[start:stop])
        back = max(start, stop - overlap) if overlap else stop
        start = back if b - back <= size else stop
        stop = b
    return out + [text[start:stop]]


def test_blank_text_has_no_chunks(apply):
    assert apply(lambda c: split_chunks(c), None, "", " \n\t") == [[], [], []]


def test_short_text_is_one_chunk(apply):
    assert split(apply, "a short text") == ["a short text"]
    assert split(apply, "a" * 1000) == ["a" * 1000]


def test_overlap_not_below_size_counts_as_none(apply):
    text = "abcd " * 400
    chunks = split(apply, text, 100, 100)
    assert len(chunks) > 1 and max(map(len, chunks)) <= 100
    assert "".join(chunks) == text


def test_size_bound_and_no_loss(apply):
    text = "One sentence here. Another, longer one follows it. And a third! " * 40
    chunks = split(apply, text, 500, 50)
    assert len(chunks) > 1 and max(map(len, chunks)) <= 500
    assert "".join(split(apply, text.strip(), 200, 0)) == text.strip()


def test_paragraphs_are_found(apply):
    text = "Alpha paragraph one.\n\nBeta paragraph two.\n\nGamma paragraph three."
    chunks = split(apply, text, 30, 5)
    for word in ("Alpha paragraph one", "Beta paragraph two", "Gamma paragraph three"):
        assert any(word in c for c in chunks)


def test_overlap_is_shared(apply):
    chunks = split(apply, "0123456789" * 50, 100, 20)
    assert len(chunks) > 1
    for before, after in zip(chunks, chunks[1:]):
        assert before[-20:] == after[:20]


def test_unbroken_text_is_cut(apply):
    chunks = split(apply, "y" * 350, 100, 10)
    assert len(chunks) >= 4 and max(map(len, chunks)) <= 100
    assert split(apply, "y" * 25, 10, 0, ["\n"]) == ["y" * 10, "y" * 10, "y" * 5]


def test_split_keep(apply):
    assert apply(lambda c: split_keep(c, "\n\n"), "a\n\n\nb", "\n\na\n\n", "a") == [
        ["a\n\n", "\nb"],
        ["\n\n", "a\n\n"],
        ["a"],
    ]
    assert apply(lambda c: split_keep(c, ""), "a😀") == [["a", "😀"]]


def test_size_must_be_positive():
    with pytest.raises(ValueError):
        split_chunks(F.lit("x"), 0)


@given(
    st.lists(st.text(alphabet="ab. \n😀", max_size=120), min_size=1, max_size=12),
    st.integers(1, 25),
    st.integers(0, 12),
)
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_equals_model(apply, texts, size, overlap):
    want = [brute_force(t, size, overlap, SEPARATORS) for t in texts]
    assert apply(lambda c: split_chunks(c, size, overlap), *texts) == want


def test_chunk_records(spark):
    df = spark.createDataFrame(
        [(42, "x", "A sentence. " * 200), (7, "y", "short"), (8, "y", ""), (9, None, None)],
        "doc_id LONG, category STRING, clean_text STRING",
    )
    rows = chunk_documents(df, size=100, overlap=10).orderBy("doc_id", "chunk_index").collect()
    long = [r for r in rows if r.doc_id == 42]
    assert [r.chunk_id for r in long] == [f"42_{i}" for i in range(len(long))]
    assert {r.category for r in long} == {"x"} and {r.num_chunks_in_doc for r in long} == {len(long)}
    assert all(r.chunk_length == len(r.chunk_text) <= 100 for r in rows)
    assert [r.doc_id for r in rows if r.doc_id != 42] == [7]


def test_other_columns_and_empty_input(spark):
    df = spark.createDataFrame([("d1", "tiny")], "key STRING, body STRING")
    row = chunk_documents(df, "body", "key").first()
    assert (row.chunk_id, row.category, row.num_chunks_in_doc) == ("d1_0", None, 1)
    empty = chunk_documents(df.filter("key = 'none'"), "body", "key")
    assert empty.count() == 0 and "chunk_text" in empty.columns


def test_chunking_needs_no_shuffle(spark):
    df = spark.range(10).selectExpr("id AS doc_id", "repeat('ab ', 900) AS clean_text")
    plan = chunk_documents(df)._jdf.queryExecution().executedPlan().toString()
    # One Arrow pass over the texts; what follows does not repeat it.
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_time_grows_with_the_length_of_the_text():
    def seconds(n):
        text = ("word and another. " * 50 + "x" * 1200 + "\n") * (n // 2100)
        best = 9.0
        for _ in range(3):
            started = time.perf_counter()
            ranges = list(chunk_ranges(piece_lengths(text, 1000, SEPARATORS), 1000, 100))
            best = min(best, time.perf_counter() - started)
        assert ranges[-1][1] == len(text)
        return best

    one, two, four = (seconds(n) for n in (600_000, 1_200_000, 2_400_000))
    assert two < 2.5 * one + 0.02 and four < 2.5 * two + 0.02


def test_a_text_of_five_million_characters(apply):
    text = "a sentence of some words. " * 200_000
    got = split(apply, text)
    assert len(got) == sum(1 for _ in chunk_ranges(piece_lengths(text, 1000, SEPARATORS), 1000, 100))
    assert all(len(c) <= 1000 for c in got) and got[-1] == text[-len(got[-1]) :]


def test_registered_queries_bound_the_arrow_batches(spark, folder):
    from catalog import QUERIES

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        QUERIES["chunk_counts"](spark, folder)
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)
