"""Pruned search and weights in place against plain Python; what moves."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiloom.operators import tfidf
from lexiloom.operators.tfidf import TfidfIndex, _Asked, _Block, _whole_documents, term_runs


def corpus(n, seed):
    """Words of very different frequency, copies, blank and null texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = [vocabulary[min(199, int(rng.paretovariate(0.6)))] for _ in range(rng.randint(1, 40))]
        rows.append((i, " ".join(words)))
    rows += [(n + i, rows[0][1]) for i in range(n // 3)]
    return rows + [(9000, None), (9001, "  "), (9002, "a . !")]


def frames(spark, rows, asked):
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(5)
    return docs, spark.createDataFrame(asked, "query_id LONG, query STRING")


def rows_of(hits):
    return sorted(tuple(r) for r in hits.collect())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 3, 500])
def test_pruned_search_equals_the_join(spark, monkeypatch, k):
    rows = corpus(300, k)
    asked = [(100 + i, t) for i, t in rows[:40:2]] + [(1, "w1 w2 w3"), (2, "unknown"), (3, None), (4, "w150 w1")]
    docs, queries = frames(spark, rows, asked)
    index = TfidfIndex.build(docs)
    want = rows_of(index.search(queries, k, broadcast_queries=False))
    assert rows_of(index.search(queries, k)) == want and len(want) > 20
    monkeypatch.setattr(tfidf, "BLOCK", 50)
    assert rows_of(index.search(queries, k)) == want


def test_large_vocabularies_and_query_tables_give_the_same(spark, monkeypatch):
    rows = corpus(120, 9)
    docs, queries = frames(spark, rows, [(i, t) for i, t in rows[:30]])
    want = rows_of(TfidfIndex.build(docs).search(queries))
    weights = {(r.doc_id, r.term): round(r.weight, 9) for r in TfidfIndex.build(docs).postings.collect()}
    monkeypatch.setattr(tfidf, "VOCABULARY_TERMS", 10)
    joined = TfidfIndex.build(docs)
    assert {(r.doc_id, r.term): round(r.weight, 9) for r in joined.postings.collect()} == weights
    assert rows_of(joined.search(queries)) == want
    monkeypatch.setattr(tfidf, "BROADCAST_CHARS", 600)
    monkeypatch.setattr(tfidf, "chars_within", lambda *_: False)
    assert rows_of(joined.search(queries)) == want


def test_nothing_but_partials_and_hits_moves(spark):
    docs, queries = frames(spark, corpus(200, 2), [(1, "w1 w2"), (2, "w3 w4")])
    index = TfidfIndex.build(docs)
    assert "Exchange" not in re.sub(r"Exchange RoundRobin\S*", "", plan_of(index.postings))
    plan = plan_of(index.search(queries, 3))
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(moved) == 1 and moved[0].startswith("query_id") and "NestedLoop" not in plan
    counts = plan_of(tfidf.vocabulary(tfidf.term_counts(docs)))
    assert len(re.findall(r"Exchange hashpartitioning\(term", counts)) == 1 and "hashpartitioning(doc_id" not in counts
    # At most k rows of a query leave a task.
    scored = index._best(index._asked(queries, "query_id", "query"), queries.schema["query_id"].dataType, 3)
    per_task = scored.groupBy("query_id", F.spark_partition_id()).count()
    assert per_task.agg(F.max("count")).first()[0] <= 3


def test_weak_terms_are_not_searched():
    rng = np.random.default_rng(4)
    k, docs = 5, 3000
    asked = _Asked(pa.table({"query_id": [1, 1], "term": ["rare", "common"], "query_weight": [0.98, 0.2]}), k)
    term = np.concatenate((np.zeros(20, np.int64), np.ones(docs, np.int64)))
    doc = np.concatenate((np.arange(20), np.arange(docs)))
    weight = np.concatenate((rng.uniform(0.5, 0.9, 20), rng.uniform(0.01, 0.3, docs)))
    whole = np.zeros(docs)
    np.add.at(whole, doc, weight * np.where(term == 0, 0.98, 0.2))
    best = asked.fresh()
    asked.look(best, list(range(docs)), term, doc, weight)
    top = sorted(((-round(s, 6), i) for i, s in enumerate(whole)))[:k]
    assert [(-a, b) for a, b in top] == [tuple(x) for x in best[0]]
    before = [list(x) for x in best]
    # A block with the common term alone cannot reach the k-th score: it is skipped whole.
    asked.look(best, [docs + i for i in range(100)], np.ones(100, np.int64), np.arange(100), np.full(100, 0.9))
    assert best == before


def test_term_runs(apply):
    got = apply(term_runs, "The boat, the BOAT and a sea_1 é2", None, "", "the and")
    assert [(r.term, r.tf) for r in got[0]] == [("boat", 2), ("sea_1", 1), ("é2", 1)]
    assert got[1:] == [[], [], []]


def test_documents_stay_whole_between_blocks(monkeypatch):
    ids = np.repeat(np.arange(30), np.random.default_rng(0).integers(1, 25, 30))
    table = pa.table({"id": ids, "term": ["t"] * len(ids), "w": [1.0] * len(ids)})
    monkeypatch.setattr(tfidf, "BLOCK", 40)
    parts = list(_whole_documents(table.to_batches(max_chunksize=7)))
    assert sum(p.num_rows for p in parts) == len(ids) and len(parts) > 3
    seen = [set(p.column("id").to_pylist()) for p in parts]
    assert all(not a & b for i, a in enumerate(seen) for b in seen[i + 1 :])


def test_no_documents_and_no_terms(spark):
    docs, queries = frames(spark, [(1, None), (2, " ")], [(1, "w1")])
    assert TfidfIndex.build(docs).search(queries).collect() == []
    assert TfidfIndex.build(docs.limit(0)).search(queries).collect() == []
    assert Counter(r.doc_id for r in TfidfIndex.build(docs).postings.collect()) == {}


def test_passes_ask_equal_texts_once_and_weigh_postings_once(spark, monkeypatch):
    rows = corpus(90, 5)
    asked = [(i, rows[i % 12][1]) for i in range(60)] + [(500, rows[0][1]), (500, rows[1][1]), (None, rows[2][1]), (501, None)]
    docs, queries = frames(spark, rows, asked)
    index = TfidfIndex.build(docs)
    want = sorted(map(str, index.search(queries).collect()))
    counted, weighed = [], []
    monkeypatch.setattr(tfidf, "BROADCAST_CHARS", 1500)
    monkeypatch.setattr(tfidf, "chars_within", lambda *_: False)
    search = TfidfIndex._searched

    def searched(self, frame, asked, *rest):
        counted.append(len(asked.column("query_id").unique()))
        return search(self, frame, asked, *rest)

    monkeypatch.setattr(TfidfIndex, "_searched", searched)
    monkeypatch.setattr(tfidf, "kept", lambda f, n, real=tfidf.kept: weighed.append(n) or real(f, n))
    assert sorted(map(str, index.search(queries).collect())) == want
    assert len(counted) > 1 and sum(counted) == 13 and weighed.count("postings") == 1


def test_the_salted_join_moves_postings_of_asked_terms_only(spark, monkeypatch):
    docs, queries = frames(spark, corpus(120, 7), [(1, "w1 w2 w30"), (2, "w3 w150"), (3, "unknown")])
    want = rows_of(TfidfIndex.build(docs).search(queries))
    for terms_held in (10**6, 10):
        monkeypatch.setattr(tfidf, "VOCABULARY_TERMS", terms_held)
        index, moved, real = TfidfIndex.build(docs), [], TfidfIndex._summed
        monkeypatch.setattr(TfidfIndex, "_summed", lambda self, p, q, real=real: moved.append(self) or real(self, p, q))
        assert (index.raw is None) == (terms_held > 10)
        assert rows_of(index.search(queries, broadcast_queries=False)) == want and moved
        met = index._asked_postings(index.query_weights(queries, "query_id", "query"))
        assert {r.term for r in met.select("term").distinct().collect()} <= {"w1", "w2", "w30", "w3", "w150"}
        monkeypatch.setattr(TfidfIndex, "_summed", real)


def test_blocks_sum_up_terms_of_few_and_of_many_documents():
    rng = np.random.default_rng(6)
    docs, terms, k = 700, 40, 4
    whole = np.where(rng.random((terms, docs)) < np.geomspace(0.01, 0.9, terms)[:, None], rng.random((terms, docs)), 0.0)
    term, doc = np.nonzero(whole)
    block = _Block(docs, np.searchsorted(term, np.arange(terms + 1)), doc, whole[term, doc])
    assert 0 < len(block.many) < terms and block.length >= docs
    factors = rng.random(terms)
    for some in (range(terms), sorted(block.many), sorted(set(range(terms)) - block.many), []):
        want = sum((factors[t] * whole[t] for t in some), np.zeros(docs))
        assert np.allclose(block.scores(list(some), [factors[t] for t in some])[:docs], want)
    at = np.array([0, 3, 333, docs - 1])
    assert all((block.of(t, at) == whole[t][at]).all() for t in range(terms))
    score = block.scores(list(range(terms)), factors.tolist())
    assert (score >= block.first(score, k)).sum() >= k and block.first(np.zeros(block.length), k) > 0
    asked = pa.table({"query_id": [7] * terms, "term": [f"t{i}" for i in range(terms)], "query_weight": factors})
    best, held = _Asked(asked, k).fresh(), _Asked(asked, k)
    held.search(best, list(range(docs)), block)
    top = sorted((-x, i) for i, x in enumerate(np.round(factors @ whole, 6)))[:k]
    assert [i for _, i in best[0]] == [i for _, i in top]


def test_passes_read_postings_by_term_and_join_them(spark, monkeypatch):
    rows = corpus(300, 8)
    docs, queries = frames(spark, rows, [(i, t) for i, t in rows[:40]])
    index = TfidfIndex.build(docs)
    want = rows_of(index.search(queries))
    name, seen, sizes = "spark.sql.parquet.columnarReaderBatchSize", [], spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")
    monkeypatch.setattr(tfidf, "BROADCAST_CHARS", 1500)
    monkeypatch.setattr(tfidf, "chars_within", lambda *_: False)
    monkeypatch.setattr(tfidf, "BLOCK", 100)
    real = TfidfIndex._searched
    monkeypatch.setattr(TfidfIndex, "_searched", lambda self, f, *rest: seen.append((spark.conf.get(name), f)) or real(self, f, *rest))
    for joined in (1, 500, 1 << 22):
        monkeypatch.setattr(tfidf, "JOINED", joined)
        assert rows_of(index.search(queries)) == want
    assert {n for n, _ in seen} == {str(tfidf.ROWS_AT_ONCE)} and spark.conf.get(name) == sizes
    stored = seen[0][1].collect()
    assert len(stored) > 3 and sum(len(r.ids) for r in stored) == len({i for i, t in rows if t and "w" in t})
    for r in stored:
        assert len(set(r.terms)) == len(r.terms) == len(r.counts) and sum(r.counts) == len(r.docs) == len(r.weights)
