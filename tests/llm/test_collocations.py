"""Collocations against a plain count, and the parts of the partitioned trees."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lexiloom.llm import collocations as co


def plain(rows, least=10, share=50, top=2000):
    """(lang, text) rows to the contract's result."""
    f, out = {}, []
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            own.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for lang, own in f.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        kept = []
        for p, a in own.items():
            if len(p) < 2 or a < least:
                continue
            longer = [c for q, c in own.items() if len(q) > len(p) and c >= least and p in (q[:2], q[1:])]
            if any(100 * c >= share * a for c in longer):
                continue
            cuts = [(1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = ["The", "new", "york", "times", "of", "é", "to\xa0be", "x-1", "Straße", "日本"] + [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        words = []
        while len(words) < rng.randint(0, 60):
            words += rng.choice([["New", "York", "times"], ["the", "new"], ["of", "the"], [rng.choice(vocabulary)]])
            if rng.random() < 0.1:
                words[-1] += rng.choice([".", ",", "\n", "\x0b", "!?", "\t", "  "])
        out.append((rng.choice(["en", "en", "de", None]), " ".join(words)))
    return out + [("en", None), ("en", ""), ("fr", " . \t"), ("it", "solo")] + [("en", "the same copy of all")] * 40


def frame(spark, rows):
    rows = [(lang, text, 1, "", "") for lang, text in rows]
    return spark.createDataFrame(rows, "lang string, text string, n int, word string, h string")


def result(found):
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert all(t == "bigint" for c, t in found.dtypes if c not in ("lang", "phrase"))
    return sorted(tuple(r) for r in found.collect())


def test_against_a_plain_count(spark):
    rows = texts(400, 1)
    want = plain(rows)
    assert len(want) > 30 and {w[0] for w in want} >= {"en", "de", "und"}
    assert result(co.collocations(frame(spark, rows).repartition(4))) == want
    assert result(co.collocations(frame(spark, rows), least=3, share=80, top=7)) == plain(rows, 3, 80, 7)


def test_small_budgets_slices_and_tables_give_the_same(spark, monkeypatch):
    rows = texts(150, 2) + [("de", " ".join(["the new york times of"] * 400)), ("de", "lang" * 300 + " of the " * 300)]
    want = plain(rows, 5)
    for name, value in (("BUDGET", 40), ("HELD_WORDS", 300), ("HELD_KINDS", 25), ("SLICE", 64)):
        monkeypatch.setattr(co, name, value)
    assert result(co.collocations(frame(spark, rows).repartition(3), least=5)) == want
    # Full tables of words and pairs let everything pass.
    monkeypatch.setattr(co, "bit_table", lambda *_: np.full(4, 2**64 - 1, dtype=np.uint64))
    assert result(co.collocations(frame(spark, rows), least=5)) == want


def test_another_seed_when_frequent_words_share_a_hash(spark, monkeypatch):
    def words(texts, seed):
        rows = [("en", b"york", 9, 5 if seed < 2 else 6), ("en", b"times", 1, 5), ("de", b"rare", 1, 7), ("de", b"so", 1, 7)]
        return spark.createDataFrame(rows, "lang string, word binary, n bigint, h bigint")

    monkeypatch.setattr(co, "_words", words)
    counted, seed = co._frequent_words(None, 5)
    assert seed == 2 and counted.count() == 4


def test_empty_table(spark):
    assert result(co.collocations(frame(spark, [("en", "x")]).limit(0))) == []
    assert result(co.collocations(frame(spark, [(None, None), ("en", "")]))) == []


def test_cells_are_packed_within_the_budget():
    counts = np.random.default_rng(0).integers(0, 40, 300)
    counts[7] = 500
    groups, n = co.packed_cells(counts, 100)
    sizes = np.bincount(groups, weights=counts, minlength=n)
    assert n == groups[-1] + 1 and (np.diff(groups) >= 0).all()
    assert sorted(sizes)[-1] == 500 and sorted(sizes)[-2] <= 100


def test_heavy_prefixes_get_groups_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(co, "BUDGET", 100)
    path = np.random.default_rng(1).integers(1, 2**63, (500, 2)).astype(np.uint64)
    path[:300, 0] = 77  # one prefix with most suffixes
    places = co.path_hash(path[:, :-1]).view(np.int64)
    rows = [(int(p), int((places == p).sum())) for p in np.unique(places)]
    groups = co.deal(spark.createDataFrame(rows, "place bigint, n bigint"))
    of = groups.of(path)
    assert len(set(of[:300])) == 4 and not set(of[:300]) & set(of[300:])
    assert np.bincount(of).max() <= 130


@pytest.mark.parametrize("depth", [2, 3])
def test_runs_and_subtrees(depth):
    rng = np.random.default_rng(depth)
    want, runs = Counter(), []
    for _ in range(5):
        path = np.unique(rng.integers(1, 6, (40, depth)).astype(np.uint64), axis=0)
        counts = rng.integers(1, 9, len(path))
        want.update({tuple(p): int(c) for p, c in zip(path.tolist(), counts)})
        runs.append(co.run_of(path, counts))
        back, n = co.of_run(runs[-1])
        assert (back == path).all() and (n == counts).all()
    leaves, total = co.subtree(runs)
    assert [tuple(p) for p in leaves.tolist()] == sorted(want) and total.tolist() == [want[p] for p in sorted(want)]
