"""Toxicity: n-gram bags against a plain listing, learning, held-out labels and cases."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiloom.llm import toxicity as tx


def plain_bag(words):
    """Characters of every n-gram of every word, edges included, with its weight."""
    out = {}
    for word in words:
        marked = f" {word} "
        grams = [marked[i : i + n] for n in tx.SIZES for i in range(len(marked) - n + 1)]
        for gram in grams:
            out[gram] = out.get(gram, 0) + 1 / len(grams) / len(words)
    return out


def bucket(gram):
    rolling = ord(gram[0]) + 1
    for c in gram[1:]:
        rolling = (rolling * int(tx._STEP) + ord(c) + 1) % 2**32
    return (rolling * int(tx._SPREAD) % 2**32) >> int(tx._SHIFT)


@pytest.mark.parametrize("text,words", [
    ("You  are\tan IDIOT!", ["you", "are", "an", "idiot"]),
    ("x", ["x"]),
    ("çà – ok😀", ["çà", "–", "ok😀"]),
    ("a,b..c", ["a", "b", "c"]),
])
def test_bag_is_the_average_over_words_of_their_n_grams(text, words):
    grams = tx.Grams(text)
    assert grams.words == len(words)
    for a in range(len(words)):
        for b in range(a + 1, len(words) + 1):
            want = np.zeros(tx.BUCKETS)
            for gram, weight in plain_bag(words[a:b]).items():
                want[bucket(gram)] += weight
            got = np.bincount(*[x.astype(t) for x, t in zip(grams.bag(a, b), (int, float))][:1], weights=grams.bag(a, b)[1], minlength=tx.BUCKETS)
            assert np.allclose(got, want, atol=1e-6) and abs(got.sum() - 1) < 1e-5
    values = np.random.default_rng(0).normal(size=tx.BUCKETS).astype(np.float32)
    each = [sum(values[bucket(g)] * w for g, w in plain_bag([word]).items()) for word in words]
    assert np.allclose(grams.summed(values), each, atol=1e-5)


def test_long_texts_are_taken_in_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(2000)) + " " + "z" * 500
    model = tx.Model.new(0.5)
    folded = model.folded()
    whole = max(d[3].max() for d in tx._decisions(text, folded, 0.0))
    monkeypatch.setattr(tx, "PIECE", 97)
    pieces = list(tx._pieces(text))
    assert "".join(pieces) == text and max(map(len, pieces)) <= 97 and len(pieces) > 100
    assert all(p[0] in " z" for p in pieces[1:])
    assert max(d[3].max() for d in tx._decisions("word7 " * 40, folded, 0.0)) <= whole


def texts(n, seed, stems=("mugglo", "vilest"), ends=("oso", "ent", "ika", "ura")):
    """Invented prose; toxic texts have a few words of a bad stem with any end."""
    rng = random.Random(seed)
    syllables = ["ba", "de", "ti", "lo", "nu", "ra", "se", "ko", "mi", "fa"]
    out = []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 120))]
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * rng.randint(1, 3)):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(ends) + rng.choice(syllables))
        out.append((i, " ".join(words), toxic))
    return out


def test_words_never_seen_are_found_by_their_parts():
    model = tx.Model.new(0.4)
    rows = [(t, y) for _, t, y in texts(1500, 1)]
    for _ in range(6):
        model = tx.trained(model, rows)
    other = texts(200, 2, ends=("ZZA", "qui"))  # ends that training never saw
    folded = model.folded()
    decided = np.array([max(d[3].max() for d in tx._decisions(t, folded, model.bias)) for _, t, _ in other])
    truth = np.array([y for _, _, y in other]) > 0
    model._calibrate(decided, truth)
    called = model.probability(decided) >= tx.LIMIT
    assert called[truth].mean() > 0.9 and called[~truth].mean() < 0.03


def test_held_out_labels(spark, folder):
    data = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.1")
    if not os.path.isdir(data):
        pytest.skip("no larger tables")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    found = tx.judged(spark.read.parquet(f"{data}/documents.parquet"), labels).join(labels, "doc_id").filter("held_out")
    row = found.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))).alias("caught"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("wrong"),
    ).first()
    assert row.caught > 0.6 and row.wrong < 0.01


DOCS = "doc_id bigint, text string, lang string, y int, t string, decision string"


def test_cases(spark):
    rows = [(i, t, "en", 9, "x", "x") for i, t, _ in texts(300, 3)]
    rows += [(None, "nothing", "en", 0, "", ""), (1000, None, None, 0, "", ""), (1001, "", "en", 0, "", "")]
    rows += [(1002, "...", "en", 0, "", ""), (1003, rows[0][1], "xx", 0, "", ""), (1004, rows[0][1], None, 0, "", "")]
    rows += [rows[0], (1005, "ba " * 300_000, "en", 0, "", ""), (1006, "q" * 600_000, "en", 0, "", "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    labels = [(i, 1, y) for i, _, y in texts(300, 3)] + [(None, 0, 1), (1001, 0, None), (5000, 0, 1), (0, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = tx.judged(docs, labels)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    score = {r.doc_id: r.score for r in found}
    assert score[1000] == score[1001] == score[1002] < 0.7
    assert score[1003] == score[1004] == score[0]


def test_one_label_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(i, "some words", "", 0, "", "") for i in range(9)], DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id bigint, toxic int")
    assert {(r.score, r.predicted) for r in tx.judged(docs, labels).collect()} == {(1.0, 1)}
    assert {(r.score, r.predicted) for r in tx.judged(docs, labels.limit(0)).collect()} == {(0.0, 0)}
    assert tx.judged(docs.limit(0), labels).collect() == []
