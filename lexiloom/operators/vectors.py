"""Exact nearest neighbours by squared Euclidean distance, for batches of queries.

Distances are block matrix products inside Arrow tasks, and a task hands on only
the best ``k`` rows per query, so pairs are never written out. Queries go to the
vectors, never the other way: a bounded block of queries is broadcast, and larger
query tables take several passes over the vectors, one block after another. The
cell index prunes with the triangle inequality and stays exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.sources.scratch import scratch_path

# Default result count and the precision distances are ranked at.
TOP_K = 4
DIGITS = 6
# Queries that one task holds, and vectors in one block of a co-group.
QUERY_BLOCK = 2048
VECTOR_BLOCK = 50_000
# Distances computed at a time: bounds memory to some tens of megabytes.
_TILE = 4_000_000


def similarity(distance: Column) -> Column:
    """Distance as a score in (0, 1]."""
    return 1 / (1 + distance)


def matrix(column: pa.Array) -> np.ndarray:
    """List column as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def squared_distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    cross = queries @ vectors.T
    square = (queries**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1)[None, :] - 2 * cross
    return np.round(np.maximum(square, 0.0), DIGITS) + 0.0


class _Best:
    """Running best ``k`` per query over batches, ties to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries = queries
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Look at some vectors, for all queries or those in ``rows``."""
        queries = self.queries if rows is None else self.queries[rows]
        if not len(ids) or not len(queries):
            return
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        step = max(1, _TILE // len(ids))
        for first in range(0, len(queries), step):
            distances = squared_distances(queries[first : first + step], vectors)
            if len(ids) > self.k:
                cut = np.partition(distances, self.k - 1, axis=1)[:, self.k - 1 : self.k]
                row, col = np.nonzero(distances <= cut)
            else:
                row, col = np.nonzero(distances >= 0)
            near = distances[row, col]
            own = row + first if rows is None else rows[row + first]
            row, near, picked = self._trim(own, near, ids[col])
            self.found.append((row, near, picked))
        if len(self.found) > 64:
            self._merge()

    def _trim(self, row, near, ids):
        order = np.lexsort((np.argsort(np.argsort(ids, kind="stable"), kind="stable"), near, row))
        row, near, ids = row[order], near[order], ids[order]
        starts = np.searchsorted(row, row, side="left")
        keep = np.arange(len(row)) - starts < self.k
        return row[keep], near[keep], ids[keep]

    def _merge(self) -> None:
        row, near, ids = (np.concatenate(parts) for parts in zip(*self.found))
        self.found = [self._trim(row, near, ids)]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.found:
            return np.array([], dtype=int), np.array([]), np.array([])
        self._merge()
        return self.found[0]


def _hits_schema(queries: DataFrame, query_id: str, vectors: DataFrame, vec_id: str) -> str:
    q_type = queries.schema[query_id].dataType.simpleString()
    v_type = vectors.schema[vec_id].dataType.simpleString()
    return f"query_id {q_type}, vec_id {v_type}, distance double"


def _ids(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def _hits_batch(query_ids: np.ndarray, best: _Best, types: list[pa.DataType]) -> pa.RecordBatch:
    row, near, ids = best.result()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids[row].tolist(), type=types[0]),
            pa.array(ids.tolist(), type=types[1]),
            pa.array(near, type=pa.float64()),
        ],
        names=["query_id", "vec_id", "distance"],
    )


def _rank(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(
            "query_id", "rank", "vec_id", "distance", F.round(similarity(F.col("distance")), DIGITS).alias("score")
        )
    )


def vector_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = TOP_K,
    query_id: str = "query_id",
    vec_id: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, distance, score)``, nearest first, ties by id.

    More queries than ``query_block`` take as many passes as they have blocks.

    Ids must be unique on both sides and neither ids nor vectors null.
    """
    if k < 1:
        raise ValueError("k must be positive")
    return _rank(in_passes(
        queries.select(query_id, vector_col),
        query_id,
        query_block,
        lambda asked: _broadcast_hits(queries, asked, vectors, k, query_id, vec_id, vector_col),
    ), k)


def in_passes(queries: DataFrame, query_id: str, query_block: int, search) -> DataFrame:
    """``search(block)`` over blocks of queries, each an Arrow table that the driver can hold.

    A single block stays lazy. Several run one after the other, and what each
    finds is stored, so only one block is held and broadcast at a time.
    """
    asked = queries.limit(query_block + 1).toArrow()
    if asked.num_rows <= query_block:
        return search(asked)
    spark = queries.sparkSession
    path, hits = scratch_path(spark, "queries"), scratch_path(spark, "hits")
    queries.write.parquet(path)
    stored = spark.read.parquet(path)
    # Blocks by hash of the id differ a little in size; half a block to spare.
    blocks = max(2, math.ceil(stored.count() / max(1, query_block // 2)))
    block = F.pmod(F.xxhash64(query_id), F.lit(blocks))
    for b in range(blocks):
        search(stored.filter(block == b).toArrow()).write.mode("append").parquet(hits)
    return spark.read.parquet(hits)


def _broadcast_hits(queries, asked, vectors, k, query_id, vec_id, vector_col) -> DataFrame:
    held = queries.sparkSession.sparkContext.broadcast(
        (_ids(asked.column(0)), matrix(asked.column(1)) if asked.num_rows else np.empty((0, 0)))
    )
    types = [asked.schema.field(0).type]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, points = held.value
        best, id_type = _Best(points, k), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            best.add(_ids(batch.column(0)), matrix(batch.column(1)))
        if id_type is not None:
            yield _hits_batch(query_ids, best, types + [id_type])

    return vectors.select(vec_id, vector_col).mapInArrow(
        search, _hits_schema(queries, query_id, vectors, vec_id)
    )


def _search_group(k: int):
    """Co-group function: the best ``k`` of one vector block for one query block."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        types = [left.schema.field(0).type, right.schema.field(0).type]
        best = _Best(matrix(left.column(1)) if left.num_rows else np.empty((0, 0)), k)
        if left.num_rows and right.num_rows:
            best.add(_ids(right.column(0)), matrix(right.column(1)))
        return pa.Table.from_batches([_hits_batch(_ids(left.column(0)), best, types)])

    return search


class CellIndex:
    """Vectors assigned to their nearest pivot, with the reach of every cell.

    ``pivots`` is a matrix of at most some hundred rows. ``assigned`` is the
    vector table plus ``cell`` and ``reach`` (distance to the pivot).
    """

    def __init__(self, pivots: np.ndarray, assigned: DataFrame, vec_id: str, vector_col: str):
        self.pivots = pivots
        self.assigned = assigned
        self.vec_id = vec_id
        self.vector_col = vector_col

    @classmethod
    def build(
        cls,
        vectors: DataFrame,
        cells: int = 64,
        vec_id: str = "vec_id",
        vector_col: str = "embedding",
        path: str | None = None,
    ) -> CellIndex:
        """Assign all vectors; with ``path`` the result is stored and read back."""
        chosen = (
            vectors.select(vec_id, vector_col)
            .orderBy(F.xxhash64(vec_id), vec_id)
            .limit(cells)
            .toArrow()
        )
        pivots = matrix(chosen.column(1)) if chosen.num_rows else np.empty((0, 0))
        assigned = _assign(vectors.select(vec_id, vector_col), pivots)
        if path is not None:
            # Ranged, so that a cell fills few files and a large cell several.
            (
                assigned.repartitionByRange("cell", vec_id)
                .write.mode("overwrite")
                .partitionBy("cell")
                .parquet(path)
            )
            assigned = vectors.sparkSession.read.parquet(path)
        return cls(pivots, assigned, vec_id, vector_col)

    def search(
        self,
        queries: DataFrame,
        k: int = TOP_K,
        query_id: str = "query_id",
        probes: int = 4,
        query_block: int = QUERY_BLOCK,
        vector_block: int = VECTOR_BLOCK,
    ) -> DataFrame:
        """The same rows as ``vector_topk``.

        First every query looks into its ``probes`` nearest cells, which gives a
        distance its result cannot exceed. Then it looks into each further cell
        that could hold something as near; the others are skipped for good.
        """
        cells = self.assigned.groupBy("cell").agg(
            F.count("*").alias("n"), F.max("reach").alias("radius")
        )
        # One row per pivot, so a few hundred at most.
        reach = {row["cell"]: row for row in cells.collect()}
        salts = [
            math.ceil(reach[c]["n"] / vector_block) if c in reach else 0
            for c in range(len(self.pivots))
        ]
        radii = np.array([reach[c]["radius"] if c in reach else 0.0 for c in range(len(salts))])
        q_blocks = max(1, math.ceil(queries.count() / query_block))
        near = self._ordered_cells(queries, query_id, radii, np.array(salts) > 0)

        def visit(wanted: DataFrame) -> DataFrame:
            return self._visit(wanted, k, salts, q_blocks)

        first = near.select(
            "query_id", "point", F.explode(F.slice("cells", 1, probes).getField("cell")).alias("cell")
        )
        found = visit(first)
        kth = (
            _rank(found, k)
            .filter(F.col("rank") == k)
            .select("query_id", F.col("distance").alias("kth"))
        )
        # Ranked distances are rounded; the bound takes that as slack.
        slack = 2 * 10.0**-DIGITS
        rest = (
            near.join(kth, "query_id", "left")
            .select(
                "query_id", "point", "kth", F.explode(F.slice("cells", probes + 1, 2**31 - 1)).alias("c")
            )
            .filter(F.col("kth").isNull() | (F.col("c.least") <= F.col("kth") + slack))
            .select("query_id", "point", F.col("c.cell").alias("cell"))
        )
        return _rank(found.unionByName(visit(rest)), k)

    def _ordered_cells(self, queries, query_id, radii, used) -> DataFrame:
        """Per query its cells by pivot distance, each with the least distance inside."""
        pivots = self.pivots
        q_type = queries.schema[query_id].dataType.simpleString()
        p_type = queries.schema[self.vector_col].dataType.simpleString()

        def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                away = np.sqrt(squared_distances(matrix(batch.column(1)), pivots))
                away[:, ~used] = np.inf
                cells = np.argsort(away, axis=1, kind="stable")[:, : int(used.sum())]
                least = np.maximum(np.take_along_axis(away, cells, axis=1) - radii[cells], 0.0) ** 2
                pairs = pa.StructArray.from_arrays(
                    [pa.array(cells.ravel().astype(np.int32)), pa.array(least.ravel())],
                    names=["cell", "least"],
                )
                offsets = np.arange(0, cells.size + 1, max(1, cells.shape[1]), dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, pairs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), lists], names=["query_id", "point", "cells"]
                )

        return queries.select(query_id, self.vector_col).mapInArrow(
            order,
            f"query_id {q_type}, point {p_type}, cells array<struct<cell: int, least: double>>",
        )

    def _visit(self, wanted: DataFrame, k: int, salts: list[int], q_blocks: int) -> DataFrame:
        """Best ``k`` per query within the cells asked for; large cells are salted."""
        spread = F.array(*[F.lit(s) for s in salts])
        left = wanted.withColumn(
            "qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")
        ).withColumn("salt", F.explode(F.sequence(F.lit(0), spread[F.col("cell")] - 1)))
        # At most one row per pivot; of a stored index only these cells are read.
        cells = F.broadcast(wanted.select("cell").distinct())
        right = self.assigned.join(cells, "cell", "left_semi").select(
            self.vec_id,
            self.vector_col,
            "cell",
            F.pmod(F.xxhash64(self.vec_id), spread[F.col("cell")]).cast("int").alias("salt"),
            F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"),
        )
        keys = ["cell", "salt", "qb"]
        q_type = wanted.schema["query_id"].dataType.simpleString()
        v_type = self.assigned.schema[self.vec_id].dataType.simpleString()
        return (
            left.select("query_id", "point", *keys)
            .groupBy(*keys)
            .cogroup(right.groupBy(*keys))
            .applyInArrow(_search_group(k), f"query_id {q_type}, vec_id {v_type}, distance double")
        )


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot and the distance to it."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = squared_distances(pivots, matrix(batch.column(1)))
            cell = away.argmin(axis=0).astype(np.int32)
            reach = np.sqrt(away.min(axis=0))
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(cell), pa.array(reach)],
                names=batch.schema.names + ["cell", "reach"],
            )

    return vectors.mapInArrow(place, f"{fields}, cell int, reach double")
