import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.functions.stopwords import ENGLISH_STOP_WORDS
from lexiloom.operators import encoder
from lexiloom.operators.tfidf import TfidfIndex, vocabulary, term_counts
from lexiloom.operators.vectors import CellIndex, vector_topk
from lexiloom.plans.retrieval import positive_hits, retrieve

FACTS = [
    (10, "The lighthouse keeper rowed a small wooden boat through the storm."),
    (11, "Bread dough rises when yeast turns sugar into gas."),
    (12, "A storm at sea can capsize a wooden boat."),
    (13, "   "),
    (14, None),
    (15, "Copper wire conducts electricity; wooden poles do not."),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(FACTS, "doc_id LONG, text STRING").repartition(3)


def ask(spark, *questions):
    return spark.createDataFrame(list(enumerate(questions)), "query_id LONG, query STRING")


def brute_force(facts, question, k):
    """Cosine of smoothed, unit-length TF-IDF rows in plain Python."""

    def terms(text):
        return [t for t in re.findall(r"\w\w+", text.lower()) if t not in ENGLISH_STOP_WORDS]

    docs = {i: Counter(terms(t)) for i, t in facts if t and t.strip()}
    df = Counter(t for c in docs.values() for t in c)

    def unit(counts):
        raw = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in counts.items() if t in df}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1
        return {t: w / norm for t, w in raw.items()}

    q = unit(Counter(terms(question)))
    scored = [
        (-round(sum(w * q.get(t, 0) for t, w in unit(c).items()), 6), i) for i, c in docs.items()
    ]
    return [(i, -s) for s, i in sorted(scored)[:k] if s < 0]


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((int(r.doc_id), r.score))
    return out


QUESTIONS = ["wooden boat in a storm", "yeast bread", "nothing shared zzz", "  ", "wooden"]


def test_tfidf_equals_brute_force(spark, facts):
    got = found(TfidfIndex.build(facts).search(ask(spark, *QUESTIONS)))
    want = {i: h for i, q in enumerate(QUESTIONS) if (h := brute_force(FACTS, q, 4))}
    assert got == want and 2 not in got and 3 not in got


def test_salted_and_stored_index_give_the_same(spark, facts, tmp_path, monkeypatch):
    asked = ask(spark, *QUESTIONS)
    index = TfidfIndex.build(facts)
    want = found(index.search(asked))
    monkeypatch.setattr("lexiloom.operators.tfidf.POSTINGS_PER_SALT", 1)
    assert found(index.search(asked, broadcast_queries=False)) == want
    index.write(str(tmp_path / "index"))
    stored = TfidfIndex.read(spark, str(tmp_path / "index"))
    assert found(stored.search(asked)) == want
    assert found(stored.search(asked, broadcast_queries=False)) == want


def test_search_scores_without_a_shuffle_of_candidates(spark, facts):
    hits = TfidfIndex.build(facts).search(ask(spark, "wooden"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan
    assert "hashpartitioning(query_id" in plan
    # Scores are grouped by query and document where the document lies.
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", plan)
    assert "NestedLoop" not in plan


def test_vocabulary_cap_and_ties(spark):
    df = spark.createDataFrame([(1, "bb aa bb"), (2, "cc aa")], "doc_id LONG, text STRING")
    rows = vocabulary(term_counts(df), 2).collect()
    assert [(r.term, r.tf, r.df) for r in rows] == [("aa", 2, 2), ("bb", 2, 1)]


def test_retrieve_contract(spark, facts):
    hits = retrieve(ask(spark, *QUESTIONS), facts)
    assert dict(hits.dtypes)["doc_id"] == "string"
    top = hits.filter("query_id = 1").first()
    assert top.text == FACTS[1][1] and top["rank"] == 1
    embedded = encoder.hash_embed(facts.filter("length(trim(text)) > 0"), "text", 128)
    near = retrieve(
        ask(spark, *QUESTIONS),
        embedded,
        "vector",
        k=2,
        embed_queries=lambda q: encoder.hash_embed(q, "query", 128),
    )
    assert {r.query_id for r in near.collect()} == {0, 1, 2, 4}
    assert near.filter("query_id = 1 AND rank = 1").first().doc_id == "11"
    assert positive_hits(near).count() == near.count()
    with pytest.raises(ValueError):
        retrieve(ask(spark, "x"), facts, "other")


def vectors(spark, n, seed, name, copies=0):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(copies)]
    return rows, spark.createDataFrame(rows, f"{name} LONG, embedding ARRAY<FLOAT>").repartition(5)


def nearest(queries, stored, k):
    out = {}
    points = np.array([v for _, v in stored], dtype=np.float32).astype(np.float64)
    for q, v in queries:
        d = ((points - np.array(v, dtype=np.float32).astype(np.float64)) ** 2).sum(axis=1).round(6)
        out[q] = [(i, x) for x, i in sorted(zip(d.tolist(), [i for i, _ in stored]))[:k]]
    return out


def hits_of(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.distance))
    return out


@pytest.mark.parametrize("copies", [0, 150])
def test_vector_search_equals_brute_force(spark, copies):
    """All three ways, also when a third of the vectors are copies of one."""
    q_rows, queries = vectors(spark, 30, 1, "query_id")
    v_rows, stored = vectors(spark, 300, 2, "vec_id", copies)
    q_rows.append((99, v_rows[0][1]))
    queries = queries.union(spark.createDataFrame(q_rows[-1:], queries.schema))
    want = nearest(q_rows, v_rows, 5)
    assert hits_of(vector_topk(queries, stored, 5)) == want
    assert hits_of(vector_topk(queries, stored, 5, query_block=7)) == want
    index = CellIndex.build(stored, cells=12)
    assert hits_of(index.search(queries, 5, probes=1, vector_block=20)) == want
    assert hits_of(index.search(queries, 5, probes=2, query_block=10)) == want


def test_fewer_vectors_than_asked_for(spark):
    q_rows, queries = vectors(spark, 3, 1, "query_id")
    v_rows, stored = vectors(spark, 2, 2, "vec_id")
    want = nearest(q_rows, v_rows, 4)
    assert hits_of(vector_topk(queries, stored)) == want
    assert hits_of(CellIndex.build(stored).search(queries)) == want
    assert vector_topk(queries, stored.limit(0)).count() == 0
    assert vector_topk(queries.limit(0), stored).count() == 0


def test_score_of_distance(spark):
    _, stored = vectors(spark, 5, 3, "vec_id")
    hit = vector_topk(stored.withColumnRenamed("vec_id", "query_id"), stored, 2)
    assert hit.filter("rank = 1").agg(F.min("score"), F.max("distance")).first() == (1.0, 0.0)
    assert hit.filter("abs(score - 1 / (1 + distance)) > 1e-5").count() == 0


def test_stored_cells(spark, tmp_path):
    q_rows, queries = vectors(spark, 4, 5, "query_id")
    v_rows, stored = vectors(spark, 60, 6, "vec_id")
    index = CellIndex.build(stored, cells=4, path=str(tmp_path / "cells"))
    assert hits_of(index.search(queries, 3, probes=1)) == nearest(q_rows, v_rows, 3)


def test_hash_embedding(spark):
    df = spark.createDataFrame([(1, "red boat red"), (2, "!!"), (3, None), (4, "red boat red")], "i INT, t STRING")
    rows = {r.i: np.array(r.embedding) for r in encoder.hash_embed(df, "t", 64).collect()}
    assert abs(np.linalg.norm(rows[1]) - 1) < 1e-6 and (rows[1] == rows[4]).all()
    assert not rows[2].any() and not rows[3].any()
    sums = encoder.hash_embed(df, "t", 64, normalize=False).filter("i = 1").first().embedding
    assert sorted(abs(x) for x in sums if x) in ([1.0, 2.0], [3.0])
    assert encoder.hash_embed(df.limit(0), "t").count() == 0


def test_external_encoder(spark):
    df = spark.createDataFrame([("ab",), (None,)], "t STRING")

    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    got = [r.embedding for r in encoder.embed(df.coalesce(1), "t", load).collect()]
    assert got == [[2.0, 1.0], [0.0, 1.0]]
