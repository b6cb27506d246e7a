"""Approximate nearest neighbours by an inverted multi-index.

The halves of a vector are quantised separately, with ``codes`` centroids each, so codes²
cells come from two small codebooks. A query goes through pairs of centroids in the order of
their summed inner products, by a heap, until the cells it has met hold as many different
vectors as its budget says; their entries are then reranked by the exact measure.

The budget is measured: for a bounded set of queries the exact neighbours are found among all
rows, and the budget is what reaches the wanted share of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfield.llm.common import batches, quoted
from rankfield.session import written

#: Vectors that the codebooks are fitted on, at most: those with the least hash of their id.
TRAIN_ROWS = 20_000

#: Queries whose exact neighbours set the budget, at most.
CALIBRATION_QUERIES = 128

#: Share of those neighbours that the budget has to reach.
RECALL = 0.96

#: Different vectors for each cell that the number of centroids aims at, and its bound.
PER_CELL = 12
MOST_CODES = 256

#: Vectors, and queries, that one task holds at a time.
CHUNK = 8192
BLOCK = 4096


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it is there, is not zero and has finite components only."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def kmeans(points: np.ndarray, count: int, rounds: int = 12) -> np.ndarray:
    """Return centroids; fewer different points than ``count`` are their own centroids."""
    if not points.shape[1]:
        return np.zeros((1, 0))  # the second half of vectors of one component
    different = np.unique(points, axis=0)
    if len(different) <= count:
        return different
    centres = different[np.random.default_rng(11).choice(len(different), count, replace=False)]
    for _ in range(rounds):
        nearest = closest(points, centres)
        sizes = np.bincount(nearest, minlength=count)
        order = np.argsort(nearest, kind="stable")
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        centres[filled] = np.add.reduceat(points[order], starts) / sizes[filled, None]
    return centres


def closest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (((centres**2).sum(axis=1))[None, :] - 2 * points @ centres.T).argmin(axis=1)


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Yield pairs of codes by falling sum, with the number of vectors of the pair's cell.

    A pair enters the heap when both pairs before it, in either list, have left it.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    up, down = first[a].tolist(), second[b].tolist()
    codes_a, codes_b = a.tolist(), b.tolist()
    heap = [(-(up[0] + down[0]), 0, 0)]
    gone = [0] * len(up)  # how far each row of pairs has been taken
    while heap:
        _, i, j = heapq.heappop(heap)
        gone[i] = j + 1
        yield codes_a[i], codes_b[j], int(sizes[codes_a[i], codes_b[j]])
        if i + 1 < len(up) and gone[i + 1] == j:
            heapq.heappush(heap, (-(up[i + 1] + down[j]), i + 1, j))
        if j + 1 < len(down) and (i == 0 or gone[i - 1] > j + 1):
            heapq.heappush(heap, (-(up[i] + down[j + 1]), i, j + 1))


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, in the same order of addition for every row."""
    return (vectors * query).sum(axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Return the places of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


_PAIR = pa.schema(
    [
        ("query_id", pa.int64()),
        ("vec_id", pa.int64()),
        ("score", pa.float64()),
        ("c1", pa.int32()),
        ("c2", pa.int32()),
    ]
)
_PAIR_DDL = "query_id bigint, vec_id bigint, score double, c1 int, c2 int"


@dataclass
class InvertedMultiIndex:
    """An index of all usable vectors: a table (vec_id, c1, c2, vector) and two codebooks."""

    cells: DataFrame
    books: tuple[np.ndarray, np.ndarray]
    width: int
    #: Different vectors, and all vectors, in each cell.
    different: np.ndarray
    total: np.ndarray

    @classmethod
    def build(
        cls, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", per_cell: int = PER_CELL
    ) -> InvertedMultiIndex | None:
        """Index every usable vector of the commonest width; None if there is none.

        Of equally common widths the smaller is taken. A null key is not indexed; vectors with
        one key are indexed each.
        """
        spark = vectors.sparkSession
        value = F.col(quoted(vector)).cast("array<double>")
        good = vectors.select(F.col(quoted(key)).cast("bigint").alias("vec_id"), value.alias("vector"))
        good = good.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        shape = (
            good.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "width").first()
        )
        if shape is None:
            return None
        width, rows = shape["width"], shape["n"]
        good = good.filter(F.size("vector") == width)
        sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRAIN_ROWS).select("vector").toArrow()
        points = _matrix(sample["vector"].combine_chunks(), width)
        codes = int(min(MOST_CODES, max(1, round(math.sqrt(rows / per_cell)))))
        half = (width + 1) // 2
        books = (kmeans(points[:, :half], codes), kmeans(points[:, half:], codes))
        shared = spark.sparkContext.broadcast(books)

        def encode(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            one, two = shared.value
            for batch in source:
                if batch.num_rows:
                    x = _matrix(batch.column(1), width)
                    c1, c2 = closest(x[:, :half], one), closest(x[:, half:], two)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))],
                        names=["vec_id", "vector", "c1", "c2"],
                    )

        cells = written(good.mapInArrow(encode, "vec_id bigint, vector array<double>, c1 int, c2 int"), "cells")
        # At most one row for each cell, of which there are MOST_CODES².
        sizes = (
            cells.groupBy("c1", "c2", F.xxhash64("vector").alias("h")).agg(F.count("*").alias("n"))
            .groupBy("c1", "c2").agg(F.count("*").alias("d"), F.sum("n").alias("n")).collect()
        )
        different, total = np.zeros((2, len(books[0]), len(books[1])), np.int64)
        for r in sizes:
            different[r["c1"], r["c2"]], total[r["c1"], r["c2"]] = r["d"], r["n"]
        return cls(cells, books, width, different, total)

    @property
    def half(self) -> int:
        return self.books[0].shape[1]

    def budget_for(self, queries: DataFrame, k: int, recall: float) -> int:
        """Return how many different vectors a query has to meet to reach ``recall``."""
        chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).toArrow()
        if not chosen.num_rows:
            return k
        ids, asked = chosen["vec_id"].to_numpy(), _matrix(chosen["vector"].combine_chunks(), self.width)
        shared = self.cells.sparkSession.sparkContext.broadcast((ids, asked))
        width = self.width

        def exact(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, asked = shared.value

            def rows() -> Iterator[tuple]:
                for batch in source:
                    if not batch.num_rows:
                        continue
                    x, own = _matrix(batch.column(1), width), batch.column(0).to_numpy()
                    c1, c2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                    for q, query in zip(ids, asked):
                        scores = exact_scores(x, query)
                        scores[own == q] = -np.inf
                        for i in best(own, scores, k):
                            if scores[i] > -np.inf:
                                yield int(q), int(own[i]), float(scores[i]), int(c1[i]), int(c2[i])

            yield from batches(rows(), _PAIR)

        nearest = ranked(self.cells.mapInArrow(exact, _PAIR_DDL), k).select("query_id", "c1", "c2").collect()
        wanted: dict[int, list[tuple[int, int]]] = {}
        for r in nearest:
            wanted.setdefault(r["query_id"], []).append((r["c1"], r["c2"]))
        needs: list[int] = []
        for q, query in zip(ids.tolist(), asked):
            open_cells = list(wanted.get(q, ()))
            met = 0
            near = (query[: self.half] @ self.books[0].T, query[self.half :] @ self.books[1].T)
            for a, b, size in traverse(*near, self.different):
                if not open_cells:
                    break
                met += size
                while (a, b) in open_cells:
                    open_cells.remove((a, b))
                    needs.append(met)
        if not needs:
            return k
        return int(np.sort(needs)[min(len(needs) - 1, math.ceil(recall * len(needs)) - 1)])

    def search(self, queries: DataFrame, *, k: int, recall: float = RECALL) -> DataFrame:
        """Return (query_id, rank, vec_id, score): the ``k`` nearest found for every query.

        ``queries`` has ``vec_id`` and ``vector``, usable and of the index's width. Nearness is
        the largest inner product of the original vectors in double precision, ties to the
        smaller id; rows with the query's own id are no candidates. A query meets at least
        ``k`` vectors besides its own where there are as many.
        """
        budget = self.budget_for(queries, k, recall)
        context = self.cells.sparkSession.sparkContext
        # Both are bounded by the codebooks, not by the rows.
        shared = context.broadcast((self.books, self.different, self.total))
        width, half = self.width, self.half

        def probes(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            schema = pa.schema(
                [
                    ("query_id", pa.int64()),
                    ("query", pa.list_(pa.float64())),
                    ("c1", pa.int32()),
                    ("codes", pa.list_(pa.int32())),
                ]
            )

            def rows() -> Iterator[tuple]:
                (one, two), different, total = shared.value
                for batch in source:
                    if not batch.num_rows:
                        continue
                    for q, query in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), width)):
                        met = every = 0
                        lists: dict[int, list[int]] = {}
                        for a, b, size in traverse(query[:half] @ one.T, query[half:] @ two.T, different):
                            if size:
                                lists.setdefault(a, []).append(b)
                                met += size
                                every += int(total[a, b])
                            if met >= budget and every > k:
                                break
                        for a, codes in lists.items():
                            yield q, query, a, codes

            yield from batches(rows(), schema, 1024)

        asked = written(
            queries.select("vec_id", "vector").mapInArrow(
                probes, "query_id bigint, query array<double>, c1 int, codes array<int>"
            ),
            "probes",
        )
        # A first code with many vectors is split in chunks, one with many queries in blocks;
        # the sizes are one number for each first code.
        chunks = {int(c): int(-(-n // CHUNK)) for c, n in enumerate(self.total.sum(axis=1)) if n}
        blocks = {r["c1"]: -(-r["n"] // BLOCK) for r in asked.groupBy("c1").agg(F.count("*").alias("n")).collect()}

        def part(of: dict[int, int], hashed: Column) -> Column:
            counts = F.create_map(*[F.lit(x) for pair in of.items() for x in pair]) if of else None
            return F.lit(0) if counts is None else F.pmod(hashed, F.element_at(counts, F.col("c1"))).cast("int")

        def all_parts(of: dict[int, int]) -> Column:
            counts = F.create_map(*[F.lit(x) for pair in of.items() for x in pair])
            return F.explode(F.sequence(F.lit(0), F.coalesce(F.element_at(counts, F.col("c1")), F.lit(0)) - 1))

        if not blocks:
            return self.cells.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        some = F.col("c1").isin(list(blocks))
        left = asked.withColumn("block", part(blocks, F.xxhash64("query_id")))
        left = left.withColumn("chunk", all_parts(chunks))
        right = self.cells.filter(some).withColumn("chunk", part(chunks, F.xxhash64("vec_id")))
        right = right.withColumn("block", all_parts(blocks))

        def rerank(left_: pa.Table, right_: pa.Table) -> pa.Table:
            found: list[tuple] = []
            if left_.num_rows and right_.num_rows:
                ids, codes = right_["vec_id"].to_numpy(), right_["c2"].to_numpy()
                x = _matrix(right_["vector"].combine_chunks(), width)
                reach = np.zeros(len(shared.value[0][1]), bool)
                for q, query, wanted in zip(
                    left_["query_id"].to_numpy(), _matrix(left_["query"].combine_chunks(), width), left_["codes"]
                ):
                    reach[:] = False
                    reach[wanted.values.to_numpy()] = True
                    at = np.flatnonzero(reach[codes] & (ids != q))
                    scores = exact_scores(x[at], query)
                    top = best(ids[at], scores, k)
                    found.append((np.full(len(top), q), ids[at][top], scores[top]))
            empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            columns = [np.concatenate(c) for c in zip(*found)] if found else empty
            return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})

        keys = ["c1", "chunk", "block"]
        met = (
            left.groupBy(*keys)
            .cogroup(right.groupBy(*keys))
            .applyInArrow(rerank, "query_id bigint, vec_id bigint, score double")
        )
        return ranked(met, k).select("query_id", "rank", "vec_id", "score")


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    """Keep the ``k`` largest scores of each query; tasks have cut their own before."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_neighbours(
    vectors: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 20
) -> DataFrame:
    """Index ``vectors`` and search the rows for which ``queries`` holds against all of them.

    Vectors that are null, zero, or hold a null or a component that is not finite take no part,
    and neither do vectors of another width than the commonest. An empty table gives no rows.
    """
    index = InvertedMultiIndex.build(vectors, key=key, vector=vector)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return index.search(index.cells.filter(queries).select("vec_id", "vector"), k=k)
