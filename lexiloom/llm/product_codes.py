"""Product codes of vectors, fitted with metric trees over the parts of the vectors.

Each vector is cut into equal parts; every part position has a codebook that
Lloyd's rounds fit. Rounds do not look at single parts where they need not:

* Vectors are taken in blocks. For every part position a block gets an anchors
  hierarchy: anchors are placed farthest first and take over the points nearer
  to them (skipping those that the triangle inequality keeps away), balls around
  the anchors are merged upwards by least radius and split downwards in the same
  way. Every ball caches the count and the sum of its points.
* A round walks down from the roots. A ball inherits the list of entries that
  may be nearest to some of its points; an entry goes when the whole ball lies
  on the other side of its bisector with the entry nearest to the centre. A ball
  with one entry left is owned: its cached count and sum are added, its points
  are not touched. Points of leaves are compared with what is left of the list.

Blocks and trees are built once and kept as a table in the shared folder. A round
is one job over that table; it returns a sum per codebook entry and component.
All sums and compared distances are exact integers; floating point only decides
what may be skipped, with a margin on the safe side.

Cases: vectors that are null or hold null or non-finite components are dropped;
null ids take part, but name no first entry; of repeated ids one vector (the
least) names an entry; with fewer ids than entries, codebooks are shorter, and
without any, they start with one entry of zeros; null labels are one label; equal
distances go to the entry of lower index; an empty table gives an empty table.
Kept vectors must share one length that the number of parts divides, and their
integers must lie within ``LIMIT``; anything else is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.sources.scratch import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block, and components at most (a block has one vector at least).
BLOCK, BLOCK_VALUES = 4096, 1 << 20
#: Points of a ball that is not split further.
LEAF = 32
#: Largest absolute value of an integer component, so that distances fit in 64 bits.
LIMIT = 1 << 24
#: Labels whose totals are broadcast; more are joined.
LABELS = 100_000


@dataclass
class Balls:
    """Trees of one block: a row for each ball, whose points are a range of ``places``."""

    part: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    radius: np.ndarray
    sums: np.ndarray
    places: np.ndarray

    _TYPES = {"part": "i1", "first": "i4", "last": "i4", "left": "i4", "right": "i4", "radius": "f8", "sums": "i8"}

    def packed(self) -> list[bytes]:
        return [getattr(self, n).astype(t).tobytes() for n, t in self._TYPES.items()] + [self.places.astype("i4").tobytes()]

    @classmethod
    def unpacked(cls, data: list[bytes], width: int) -> Balls:
        arrays = [np.frombuffer(d, dtype=t) for d, t in zip(data, [*cls._TYPES.values(), "i4"])]
        arrays[6] = arrays[6].reshape(-1, width)
        return cls(*arrays)


class _Builder:
    """Anchors hierarchy over the points of one part position."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.whole = points
        self.members: list[np.ndarray | None] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.radius: list[float] = []
        self.count: list[int] = []
        self.sums: list[np.ndarray] = []

    def _ball(self, members, left, right, radius, count, sums) -> int:
        self.members.append(members)
        self.left.append(left)
        self.right.append(right)
        self.radius.append(radius)
        self.count.append(count)
        self.sums.append(sums)
        return len(self.count) - 1

    def build(self, members: np.ndarray) -> int:
        """Ball over some points; returns its number."""
        points = self.points[members]
        total = self.whole[members].sum(axis=0)
        centre = total / len(members)
        radius = math.sqrt(((points - centre) ** 2).sum(axis=1).max())
        if len(members) <= LEAF or not radius:
            return self._ball(members, -1, -1, radius, len(members), total)
        owner, used = self._anchors(points)
        if used == 1:  # distances too small to tell the points apart
            return self._ball(members, -1, -1, radius, len(members), total)
        order = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[order], np.arange(used + 1))
        groups = [members[order[a:b]] for a, b in zip(edges[:-1], edges[1:]) if b > a]
        return self._merged([self.build(group) for group in groups])

    def _anchors(self, points: np.ndarray) -> tuple[np.ndarray, int]:
        """Owner of each point among about as many anchors as the root of their number."""
        n, most = len(points), max(2, math.isqrt(len(points)))
        owner = np.zeros(n, dtype=np.int32)
        away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
        anchors = points[:1]
        while len(anchors) < most:
            far = int(away.argmax())
            if not away[far]:
                break
            apart = np.sqrt(((anchors - points[far]) ** 2).sum(axis=1))
            # Points nearer to their anchor than half the way to the new one stay.
            near = np.flatnonzero(away > apart[owner] / 2)
            new = np.sqrt(((points[near] - points[far]) ** 2).sum(axis=1))
            taken = new < away[near]
            owner[near[taken]], away[near[taken]] = len(anchors), new[taken]
            anchors = np.vstack((anchors, points[far]))
        return owner, len(anchors)

    def _merged(self, balls: list[int]) -> int:
        """Root over the balls; the two whose common ball is least are merged first."""
        if len(balls) == 1:
            return balls[0]
        k = len(balls)
        number, alive = list(balls), np.ones(k, dtype=bool)
        weight = np.array([self.count[b] for b in balls], dtype=np.float64)
        centres = np.array([self.sums[b] for b in balls]) / weight[:, None]
        radii = np.array([self.radius[b] for b in balls])

        def common(i: int) -> np.ndarray:
            """Radius of the ball around ball i and each other, centred at their mean."""
            apart = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
            share = weight / (weight + weight[i])
            out = np.maximum(apart * share + radii[i], apart * (1 - share) + radii)
            out[~alive] = np.inf
            out[i] = np.inf
            return out

        sizes = np.array([common(i) for i in range(k)])
        for _ in range(k - 1):
            i, j = divmod(int(sizes.argmin()), k)
            a, b, radius = number[i], number[j], float(sizes[i, j])
            number[i] = self._ball(None, a, b, radius, self.count[a] + self.count[b], self.sums[a] + self.sums[b])
            alive[j] = False
            weight[i] += weight[j]
            centres[i], radii[i] = self.sums[number[i]] / weight[i], radius
            sizes[j], sizes[:, j] = np.inf, np.inf
            sizes[i] = sizes[:, i] = common(i)
            root = number[i]
        return root

    def ordered(self, root: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last place of every ball, and the points in order of their places."""
        first, last = np.zeros(len(self.count), np.int32), np.zeros(len(self.count), np.int32)
        places, at, stack = [], 0, [root]
        while stack:
            ball = stack.pop()
            first[ball], last[ball] = at, at + self.count[ball]
            if self.left[ball] < 0:
                places.append(self.members[ball])
                at += self.count[ball]
            else:
                stack += [self.right[ball], self.left[ball]]
        return first, last, np.concatenate(places)


def trees(points: np.ndarray) -> Balls:
    """Trees over ``points`` (parts, n, width); the first ball of a part is its root."""
    columns: dict[str, list] = {name: [] for name in (*Balls._TYPES, "places")}
    n, base = points.shape[1], 0
    for p, own in enumerate(points):
        builder = _Builder(own)
        root = builder.build(np.arange(n))
        first, last, places = builder.ordered(root)
        balls = len(first)
        # The root comes first.
        order = np.concatenate(([root], np.delete(np.arange(balls), root)))
        number = np.empty(balls + 1, dtype=np.int64)
        number[order], number[-1] = np.arange(balls) + base, -1
        columns["part"].append(np.full(balls, p))
        columns["first"].append(first[order] + p * n)
        columns["last"].append(last[order] + p * n)
        columns["left"].append(number[np.array(builder.left)[order]])
        columns["right"].append(number[np.array(builder.right)[order]])
        columns["radius"].append(np.array(builder.radius)[order])
        columns["sums"].append(np.array(builder.sums)[order])
        columns["places"].append(places + p * n)
        base += balls
    return Balls(**{name: np.concatenate(parts) for name, parts in columns.items()})


def walk(balls: Balls, points: np.ndarray, books: np.ndarray) -> tuple[tuple, tuple]:
    """Owned balls with their entries, and single points with theirs.

    ``points`` are (parts * n, width), ``books`` (parts, entries, width).
    """
    entries = books.astype(np.float64)
    gaps = np.sqrt(((entries[:, :, None] - entries[:, None]) ** 2).sum(axis=3))
    largest = float(max(np.abs(points).max(initial=1), np.abs(books).max(initial=1)))
    slack = 1e-14 * books.shape[2] * largest * largest
    root = np.concatenate(([0], np.flatnonzero(np.diff(balls.part)) + 1)) if len(balls.part) else np.zeros(0, int)
    nodes, able = root, np.ones((len(root), books.shape[1]), dtype=bool)
    owned, owners, leaves, lists = [], [], [], []
    while len(nodes):
        part, radius = balls.part[nodes], balls.radius[nodes]
        centre = balls.sums[nodes] / (balls.last[nodes] - balls.first[nodes])[:, None]
        away = ((entries[part] - centre[:, None]) ** 2).sum(axis=2)
        away[~able] = np.inf
        near = away.argmin(axis=1)
        least = away[np.arange(len(nodes)), near]
        gap = gaps[part, near]
        beyond = np.where(able, away - least[:, None], 0) > 2 * gap * (radius[:, None] * (1 + 1e-9)) + 4 * slack
        same = (gap == 0) & (np.arange(books.shape[1]) > near[:, None])
        able = able & ~beyond & ~same
        done = able.sum(axis=1) == 1
        owned.append(nodes[done])
        owners.append(near[done])
        leaf = ~done & (balls.left[nodes] < 0)
        leaves.append(nodes[leaf])
        lists.append(able[leaf])
        inner = ~done & ~leaf
        nodes = np.concatenate((balls.left[nodes[inner]], balls.right[nodes[inner]]))
        able = np.concatenate((able[inner], able[inner]))
    leaves, lists = np.concatenate(leaves), np.concatenate(lists)
    sizes = (balls.last - balls.first)[leaves]
    ball = np.repeat(np.arange(len(leaves)), sizes)
    single = _ranges(balls.first[leaves], sizes)
    chosen = np.zeros(len(single), dtype=np.int64)
    part = balls.part[leaves][ball]
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        for at in range(0, len(own), 1 << 15):
            rows = own[at : at + (1 << 15)]
            chosen[rows] = _nearest(points[single[rows]], books[p], lists[ball[rows]])
    return (np.concatenate(owned), np.concatenate(owners)), (single, part, chosen)


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of every range, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - before, sizes)


def _nearest(points: np.ndarray, book: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Exact nearest entry among the able ones; ties to the lower index."""
    largest = int(max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * largest * largest * book.shape[1] < 1 << 52:
        # All intermediate values are integers that a double holds.
        entries = book.astype(np.float64)
        away = (entries**2).sum(axis=1) - 2 * (points.astype(np.float64) @ entries.T)
        return np.where(able, away, np.inf).argmin(axis=1)
    away = np.stack([((points - entry) ** 2).sum(axis=1) for entry in book], axis=1)
    return np.where(able, away, np.iinfo(np.int64).max).argmin(axis=1)


def totals(balls: Balls, points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sum of the parts nearest to each entry, (parts, entries) and (parts, entries, width)."""
    counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
    (owned, owners), (single, part, chosen) = walk(balls, points, books)
    at = (balls.part[owned], owners)
    np.add.at(counts, at, (balls.last - balls.first)[owned])
    np.add.at(sums, at, balls.sums[owned])
    np.add.at(counts, (part, chosen), 1)
    order = np.argsort(part * books.shape[1] + chosen, kind="stable")
    if len(order):
        slot = (part * books.shape[1] + chosen)[order]
        starts = np.concatenate(([0], np.flatnonzero(np.diff(slot)) + 1))
        sums.reshape(-1, books.shape[2])[slot[starts]] += np.add.reduceat(points[single[order]], starts, axis=0)
    return counts, sums


def codes(balls: Balls, points: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Entry of each part, in the order of ``places``."""
    out = np.zeros(len(points), dtype=np.int64)
    (owned, owners), (single, _, chosen) = walk(balls, points, books)
    sizes = (balls.last - balls.first)[owned]
    out[_ranges(balls.first[owned], sizes)] = np.repeat(owners, sizes)
    out[single] = chosen
    return out


def usable(vector: str) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & finite


def _integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, (n, length)."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if (sizes != width).any():
        raise ValueError(f"vectors of {int(sizes[sizes != width][0])} and of {width} components")
    values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(values) and np.abs(values).max() > LIMIT:
        raise ValueError(f"components beyond {LIMIT} / {scale}")
    return values.astype(np.int64).reshape(len(vectors), width)


_FIELDS = [*Balls._TYPES, "places", "points"]


def _blocks(kept: DataFrame, length: int, parts: int, scale: int) -> DataFrame:
    """One row per block: ids, labels, points in tree order and the trees."""
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = f"id array<{kinds['id']}>, label array<{kinds['label']}>, " + ", ".join(f"{n} binary" for n in _FIELDS)
    most = max(1, min(BLOCK, BLOCK_VALUES // max(1, length)))

    def block(rows: pa.Table) -> pa.RecordBatch:
        whole = _integers(rows.column("v").combine_chunks(), length, scale)
        points = np.ascontiguousarray(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2))
        found = trees(points)
        placed = points.reshape(-1, length // parts)[found.places]
        columns = []
        for name in ("id", "label"):
            values = rows.column(name).combine_chunks()
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
        data = [*found.packed(), placed.astype("i4").tobytes()]
        columns += [pa.array([d], pa.binary()) for d in data]
        return pa.RecordBatch.from_arrays(columns, names=["id", "label", *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = most - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == most:
                    yield block(pa.Table.from_batches(held))
                    held = []
        if held:
            yield block(pa.Table.from_batches(held))

    return kept.mapInArrow(run, schema)


def _opened(batch: pa.RecordBatch, i: int, width: int) -> tuple[Balls, np.ndarray]:
    data = [batch.column(name)[i].as_py() for name in _FIELDS]
    return Balls.unpacked(data[:-1], width), np.frombuffer(data[-1], dtype="i4").reshape(-1, width).astype(np.int64)


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one more round."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                c, s = totals(*_opened(batch, i, books.shape[2]), books)
                counts += c
                sums += s
        values = np.concatenate((counts[:, :, None], sums), axis=2).ravel()
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at])], names=["slot", "value"])

    found = blocks.select(*_FIELDS).mapInArrow(run, "slot bigint, value bigint")
    # At most one row for each entry and component.
    rows = found.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()
    values = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), dtype=np.int64)
    values[rows.column("slot").to_numpy()] = rows.column("value").to_numpy()
    values = values.reshape(*books.shape[:2], -1)
    counts, sums = values[:, :, :1], values[:, :, 1:]
    shared.unpersist()
    return np.where(counts > 0, sums // np.maximum(counts, 1), books)


def _coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every vector."""
    kinds = {f.name: f.dataType.elementType.simpleString() for f in blocks.schema.fields[:2]}
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, width = books.shape[0], books.shape[2]
        for batch in batches:
            for i in range(batch.num_rows):
                balls, points = _opened(batch, i, width)
                n = len(points) // parts
                found = codes(balls, points, books)
                part = np.repeat(np.arange(parts), n)
                apart = ((points - books[part, found]) ** 2).sum(axis=1)
                code, error = np.zeros((parts, n), np.uint8), np.zeros((parts, n), np.int64)
                at = (part, balls.places % n)
                code[at], error[at] = found, apart
                texts = code.T.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id")[i].values,
                        batch.column("label")[i].values,
                        pa.array([texts[2 * parts * k : 2 * parts * (k + 1)] for k in range(n)]),
                        pa.array(error.sum(axis=0)),
                    ],
                    names=["id", "label", "code", "error"],
                )

    return blocks.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def _stored(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, f"codes-{name}")
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


@dataclass
class Codebooks:
    """Entries by part, (parts, entries, width), and the blocks they were fitted on."""

    entries: np.ndarray
    blocks: DataFrame

    @classmethod
    def fit(
        cls,
        vectors: DataFrame,
        id_col: str = "vec_id",
        vector_col: str = "embedding",
        label_col: str = "label",
        parts: int = PARTS,
        entries: int = ENTRIES,
        rounds: int = ROUNDS,
        scale: int = SCALE,
    ) -> Codebooks:
        """Codebooks that start as the parts of the least ids and go through the rounds."""
        if not 1 <= entries <= 256:
            raise ValueError("entries must be 1 to 256, as a code has two digits for a part")
        named = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
        kept = named.filter(usable("v"))
        # Ids first, so that only vectors of these ids meet.
        ids = kept.filter("id is not null").select("id").distinct().orderBy("id").limit(entries)
        chosen = kept.select("id", "v").join(F.broadcast(ids), "id").groupBy("id").agg(F.min("v").alias("v"))
        first = chosen.orderBy("id").select("v").toArrow().column("v").combine_chunks()
        if len(first):
            length = len(first[0])
        else:
            row = kept.select(F.size("v").alias("n")).first()
            length = row.n if row else parts
        if not length or length % parts:
            raise ValueError(f"{length} components do not make {parts} equal parts")
        whole = _integers(first, length, scale) if len(first) else np.zeros((1, length), dtype=np.int64)
        books = np.ascontiguousarray(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2))
        blocks = _stored(_blocks(kept, length, parts, scale), "blocks")
        for _ in range(rounds):
            books = _round(blocks, books)
        return cls(books, blocks)

    def sha256(self) -> str:
        """Hash of all components by part, entry and place, in decimal and comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """``(id, label, code, error)`` of the fitted vectors."""
        return _coded(self.blocks, self.entries)


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **how) -> DataFrame:
    """``(id_col, code, error, label_error, codebooks_sha256)`` for every kept vector."""
    books = Codebooks.fit(vectors, id_col, vector_col, label_col, **how)
    coded = _stored(books.codes(), "coded")
    sums = _stored(coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "labels")
    if sums.count() <= LABELS:
        sums = F.broadcast(sums)
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("l")))
    return found.select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
