import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexiloom.operators.chunks import chunk_documents
from lexiloom.operators.encoder import hash_embed
from lexiloom.operators.language import language_profile
from lexiloom.operators.upsert import upsert
from lexiloom.plans.corpus import ingest, prepare_corpus
from lexiloom.sources.collection import Collection
from lexiloom.sources.corpus import acquire_corpus
from lexiloom.sources.files import read_csv, write_csv
from lexiloom.sources.logs import (
    append_embedding_perf,
    append_retrieval_perf,
    read_embedding_perf,
    read_retrieval_perf,
)
from lexiloom.sources.schemas import RAW_DOCUMENT
from lexiloom.sources.scratch import scratch_path
from lexiloom.streaming.chunks import clean_and_chunk, read_documents, write_chunks


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [(1, 'a "b", c\nd', "x"), (2, "plain, with comma", "y"), (3, "back\\slash", None)]
    df = spark.createDataFrame(rows, RAW_DOCUMENT)
    write_csv(df, str(tmp_path / "csv"))
    assert sorted(read_csv(spark, str(tmp_path / "csv"), RAW_DOCUMENT).collect()) == sorted(df.collect())


def test_acquire_corpus(spark):
    train = spark.createDataFrame([(i, f"t{i}", i % 2) for i in range(50)], "k INT, text STRING, label INT")
    test = spark.createDataFrame([(i, "same", 1) for i in range(30)], "k INT, text STRING, label INT")
    labels = spark.createDataFrame([(0, "zero"), (1, "one")], "label INT, category STRING")
    got = acquire_corpus({"train": train, "test": test}, labels, "k").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == list(range(80))
    assert sum(r.text == "same" for r in got) == 30
    assert all(r.category == ("one" if r.text == "same" or int(r.text[1:]) % 2 else "zero") for r in got)
    again = acquire_corpus({"train": train.repartition(7), "test": test}, labels, "k")
    assert again.orderBy("doc_id").collect() == got
    other = acquire_corpus({"train": train, "test": test}, labels, "k", seed=1)
    assert other.orderBy("doc_id").collect() != got


def batch(spark, *rows):
    df = spark.createDataFrame(list(rows), "doc_id STRING, clean_text STRING, category STRING")
    return hash_embed(chunk_documents(df, size=20, overlap=0), "chunk_text", 16)


def texts(collection):
    return {r.chunk_id: r.chunk_text for r in collection.read().collect()}


def test_collection_upsert(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "store"))
    assert store.count() == 0 and "embedding" in store.read().columns
    assert store.upsert(batch(spark).limit(0)) == 0
    assert store.upsert(batch(spark, ("a", "one two three four five six", "x"), ("b", "bee", "y"))) == 1
    first = texts(store)
    assert set(first) == {"a_0", "a_1", "b_0"}
    assert store.upsert(batch(spark, ("a", "short now", "x"))) == 2
    assert texts(store) == {**first, "a_0": "short now"}
    assert store.upsert(batch(spark, ("a", "last", "x")), replace_docs=True) == 3
    assert texts(store) == {"a_0": "last", "b_0": "bee"}
    assert Collection(spark, str(tmp_path / "store")).count() == 2
    assert sorted(p.name for p in (tmp_path / "store").iterdir()) == [f"version={v}" for v in (1, 2, 3)]


def test_unfinished_version_is_ignored(spark, tmp_path):
    store = Collection(spark, str(tmp_path / "store"))
    store.upsert(batch(spark, ("a", "one", "x")))
    os.makedirs(tmp_path / "store" / "version=2")
    assert texts(store) == {"a_0": "one"}
    assert store.upsert(batch(spark, ("b", "two", "x"))) == 2
    assert texts(store) == {"a_0": "one", "b_0": "two"}


def test_last_write_in_a_batch_wins(spark):
    old = spark.createDataFrame([("k", "old", 0), ("stays", "old", 0)], "chunk_id STRING, v STRING, n INT")
    new = spark.createDataFrame([("k", "first", 1), ("k", "last", 2)], old.schema)
    got = {r.chunk_id: r.v for r in upsert(old, new, order=[F.desc("n")]).collect()}
    assert got == {"k": "last", "stays": "old"}
    got = [(r.chunk_id, r.v) for r in upsert(old, new).collect()]
    assert sorted(got) == [("k", "last"), ("stays", "old")]


def test_prepare_and_ingest(spark, tmp_path):
    raw = spark.createDataFrame(
        [
            (1, "Subject: x\n\nthe boat and the sea", "c"),
            (2, "le bateau et la mer", "c"),
            (3, "Lines: 0", "c"),
            (4, "M" * 500, "c"),
        ],
        RAW_DOCUMENT,
    )
    train = spark.createDataFrame([("the and of", "en"), ("le la et", "fr")], "text STRING, lang STRING")
    processed = prepare_corpus(raw, language_profile(train))
    assert {r.doc_id: r.language for r in processed.collect()} == {
        1: "en",
        2: "fr",
        3: "unknown",
        4: "unknown",
    }
    store = Collection(spark, str(tmp_path / "store"))
    ingest(processed, store, skip_binary=True)
    assert set(texts(store)) == {"1_0", "2_0"}
    assert len(store.read().first().embedding) == 384


def test_perf_logs(spark, tmp_path):
    stats = spark.createDataFrame(
        [(256, 9.5, 0.037109, 384)],
        "num_chunks INT, total_time_sec DOUBLE, avg_time_per_chunk_sec DOUBLE, embedding_dim INT",
    )
    path = str(tmp_path / "embedding")
    append_embedding_perf(stats, path, "hashing", "batch 0-256")
    append_embedding_perf(stats, path, "hashing")
    rows = read_embedding_perf(spark, path).collect()
    assert len(rows) == 2 and {r.num_chunks for r in rows} == {256}
    assert all(r.timestamp is not None for r in rows)
    timing = spark.createDataFrame([("a question, quoted", 0.0123456, 5)], "query STRING, latency_sec DOUBLE, num_results INT")
    append_retrieval_perf(timing, str(tmp_path / "retrieval"))
    row = read_retrieval_perf(spark, str(tmp_path / "retrieval")).first()
    assert (row.query, row.latency_sec, row.num_results) == ("a question, quoted", 0.01235, 5)


def test_scratch_folder_is_the_shared_one(spark):
    def session(setting, master):
        conf = SimpleNamespace(get=lambda key, default: setting or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("s3a://shared/", "yarn"), "x").startswith("s3a://shared/x-")
    with pytest.raises(ValueError):
        scratch_path(session("", "yarn"), "x")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("files_per_trigger", [1, 100])
def test_stream_equals_batch(spark, folder, tmp_path, files_per_trigger):
    source = str(tmp_path / "in")
    spark.read.parquet(f"{folder}/documents.parquet").repartition(3).write.parquet(source)
    documents = spark.read.parquet(source)
    stream = read_documents(spark, source, documents.schema, files_per_trigger)
    query = write_chunks(
        clean_and_chunk(stream, category_col="source"), str(tmp_path / "out"), str(tmp_path / "check")
    )
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = clean_and_chunk(documents, category_col="source")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_csv_keeps_blanks_at_the_edges(spark, tmp_path):
    texts = ["  lead", "trail  ", "\n two\n", "\ttab\t"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    write_csv(df, str(tmp_path / "csv"))
    assert sorted(r.text for r in read_csv(spark, str(tmp_path / "csv"), df.schema).collect()) == sorted(texts)
