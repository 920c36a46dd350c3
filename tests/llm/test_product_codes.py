"""Product codes against a plain Lloyd's algorithm."""

import hashlib

import numpy as np
import pytest

from lexiloom.llm import product_codes as pc


def plain(points, books):
    """Nearest entry of each part, ties to the lower index."""
    return ((points[:, :, None] - books[:, None]) ** 2).sum(axis=3).argmin(axis=2)


def lloyd(rows, parts, entries, rounds):
    """Codes, errors and codebooks of (id, label, integers) rows."""
    whole = np.array([r[2] for r in rows])
    points = whole.reshape(len(rows), parts, -1).transpose(1, 0, 2)
    first = sorted(range(len(rows)), key=lambda i: rows[i][0])[:entries]
    books = points[:, first].copy()
    for _ in range(rounds):
        near = plain(points, books)
        for p in range(parts):
            for e in range(books.shape[1]):
                own = points[p][near[p] == e]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    near = plain(points, books)
    error = ((points - np.take_along_axis(books, near[:, :, None], axis=1)) ** 2).sum(axis=(0, 2))
    return {r[0]: ("".join(f"{x:02x}" for x in near[:, i]), int(error[i])) for i, r in enumerate(rows)}, books


@pytest.mark.parametrize("n,width,spread", [(1, 3, 9), (40, 2, 2), (700, 4, 3), (900, 8, 400)])
def test_trees_give_what_brute_force_gives(n, width, spread):
    rng = np.random.default_rng(n)
    points = rng.integers(-spread, spread, (3, n, width))
    points[:, n // 2 :] //= 4  # many equal points, and a dense middle
    balls = pc.trees(points)
    placed = points.reshape(-1, width)[balls.places]
    assert sorted(balls.places) == list(range(3 * n))
    books = points[:, : min(n, 16)].copy()
    for _ in range(4):
        near = plain(points, books)
        found = np.zeros(3 * n, int)
        found[balls.places] = pc.codes(balls, placed, books)
        assert (found.reshape(3, n) == near).all()
        counts, sums = pc.totals(balls, placed, books)
        for p in range(3):
            for e in range(books.shape[1]):
                own = points[p][near[p] == e]
                assert counts[p, e] == len(own) and (sums[p, e] == own.sum(axis=0)).all()
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)


def test_balls_hold_their_points_and_dense_ones_are_owned():
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 4))
    points = (centres[rng.integers(0, 16, 3000)] + rng.integers(-20, 20, (3000, 4)))[None]
    balls = pc.trees(points)
    placed = points.reshape(-1, 4)[balls.places]
    for a, b, radius, total in zip(balls.first, balls.last, balls.radius, balls.sums):
        assert (placed[a:b].sum(axis=0) == total).all()
        away = np.sqrt(((placed[a:b] - total / (b - a)) ** 2).sum(axis=1)).max()
        assert away <= radius * (1 + 1e-9) + 1e-9
    (owned, _), (single, _, _) = pc.walk(balls, placed, centres[None])
    assert (balls.last - balls.first)[owned].sum() > 2900 and len(single) < 100


def test_large_integers_stay_exact():
    points = np.array([[[pc.LIMIT, -pc.LIMIT], [pc.LIMIT - 1, -pc.LIMIT], [0, 1], [0, 0]]])
    balls = pc.trees(points)
    books = points[:, [1, 0, 3, 2]].copy()
    found = np.zeros(4, int)
    found[balls.places] = pc.codes(balls, points[0][balls.places], books)
    assert found.tolist() == [1, 0, 3, 2]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, id string, v int")


def test_compressed_against_lloyd_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(7)
    rows, good = [], []
    for i in range(300):
        vector = rng.normal(size=8) / 3 if i % 3 else np.full(8, 0.25)  # a third are copies
        vector = vector.astype(np.float32)
        label = None if i % 5 == 0 else i % 5
        rows.append((1000 - i, [float(x) for x in vector], label, "x", 1))
        good.append((1000 - i, label, np.floor(4096 * vector.astype(float)).astype(int).tolist()))
    bad = [(1, None, 1, "x", 1), (2, [None] + [0.0] * 7, 1, "x", 1), (3, [float("nan")] * 8, 1, "x", 1)]
    bad.append((4, [float("inf")] + [0.0] * 7, 1, "x", 1))
    got = pc.compressed(frame(spark, rows + bad).repartition(5), parts=4, entries=6, rounds=5)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    found = {r.vec_id: r for r in got.collect()}
    want, books = lloyd(good, 4, 6, 5)
    assert {i: (r.code, r.error) for i, r in found.items()} == want
    for label in (None, 1, 2, 3, 4):
        own = [i for i, own_label, _ in good if own_label == label]
        assert {found[i].label_error for i in own} == {sum(want[i][1] for i in own)}
    text = ",".join(str(x) for x in books.ravel())
    assert {r.codebooks_sha256 for r in found.values()} == {hashlib.sha256(text.encode()).hexdigest()}


def test_more_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)], 0, "", 0) for i in range(200)]
    one = pc.compressed(frame(spark, rows).coalesce(1), parts=2, entries=4).collect()
    monkeypatch.setattr(pc, "BLOCK", 17)
    monkeypatch.setattr(pc, "LABELS", 0)
    many = pc.compressed(frame(spark, rows).repartition(3), parts=2, entries=4).collect()
    assert sorted(one) == sorted(many)


def test_few_repeated_null_and_no_ids(spark):
    same = [0.5, -0.5]
    rows = [(7, same, 1, "", 0), (7, [0.0, 0.0], 1, "", 0), (None, same, None, "", 0), (9, same, 1, "", 0)]
    found = pc.compressed(frame(spark, rows), parts=2).collect()
    # The least vector of a repeated id names its entry, here (0, 0) for the second part and the first.
    assert len(found) == 4 and {r.error for r in found} == {0}
    nameless = pc.compressed(frame(spark, [(None, same, 1, "", 0)]), parts=2).collect()
    assert [(r.code, r.error) for r in nameless] == [("0000", 0)]
    assert pc.compressed(frame(spark, []), parts=2).collect() == []


@pytest.mark.parametrize("vectors", [[[1.0, 2.0, 3.0]], [[1.0, 2.0], [1.0] * 4], [[1e9, 0.0]]])
def test_vectors_that_cannot_be_cut_are_errors(spark, vectors):
    rows = [(i, v, 0, "", 0) for i, v in enumerate(vectors)]
    with pytest.raises(Exception, match="components"):
        pc.compressed(frame(spark, rows), parts=2).collect()
