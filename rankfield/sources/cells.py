"""Stored vector indexes: vectors grouped into cells around k-means centres."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfield.functions.distances import as_matrix, check_metric, distance_block
from rankfield.operators.knn import (
    DEFAULT_K,
    DISTANCE,
    apply_where,
    blocks_for,
    candidate_schema,
    cores,
    directions,
    held_queries,
    near_grid,
    offer_block,
    one_task_a_core,
    query_block,
    query_blocks,
    single_query,
)
from rankfield.operators.topk import RunningTopK, check_k, ranked
from rankfield.session import BROADCAST_ROWS, spread, written
from rankfield.sources import records

#: Copies of a query, one for each cell that it looks in, that may be shuffled, on average.
MOST_COPIES = 16

#: What cells are marked by: bits, numbers or how many they are.
_MARKS = {"binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "bigint": pa.int64()}

#: Most cells that are chosen without being asked for; centres are held by the driver.
MOST_CELLS = 4096


def default_cells(rows: int) -> int:
    """About as many cells as rows in one, so that either side of a search stays small."""
    return max(1, min(MOST_CELLS, math.isqrt(rows)))


def _fit(vectors: DataFrame, vector: str, cells: int, metric: str, seed: int):
    """Learn the centres from all vectors."""
    if metric == "cosine":
        # A vector without a direction cannot be clustered by angle.
        vectors = vectors.filter(F.exists(vector, lambda x: x != 0))
    points = vectors.select(array_to_vector(vector).alias("features"))
    if cells == 1:
        mean = points.select(Summarizer.mean(F.col("features")).alias("mean")).first()["mean"]
        return np.asarray(mean, dtype=np.float64)[None, :]
    measure = "cosine" if metric == "cosine" else "euclidean"
    model = KMeans(k=cells, seed=seed, distanceMeasure=measure, maxIter=10).fit(points)
    return np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()])


def _directed(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the vectors at length one, and which of them have a direction."""
    length = np.linalg.norm(vectors, axis=1)
    return vectors / np.where(length > 0, length, 1.0)[:, None], length > 0


def distance_from(vectors: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Return the Euclidean distance of each vector (by angle: at length one) from its centre."""
    if metric != "cosine":
        return np.linalg.norm(vectors - centres, axis=1)
    unit, known = _directed(vectors)
    # A vector without a direction is at distance 1 from all: its cell is never ruled out.
    return np.where(known, np.linalg.norm(unit - centres, axis=1), np.inf)


def least_distance(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray, metric: str) -> np.ndarray:
    """Return the least distance, in the measure, that a vector of each cell can have."""
    known = np.ones(len(queries), dtype=bool)
    if metric == "cosine":
        queries, known = _directed(queries)
    with np.errstate(invalid="ignore"):
        if metric == "dot":
            return -(queries @ centres.T) - np.linalg.norm(queries, axis=1)[:, None] * radii
        away = np.sqrt(np.maximum(distance_block(queries, centres, "l2"), 0.0))
        bound = np.maximum(away - radii, 0.0) ** 2
    return np.where(known[:, None], bound / 2, -np.inf) if metric == "cosine" else bound


def nearest_cell(vector: str | Column, centres: np.ndarray, metric: str) -> Column:
    """Return the number of the centre nearest to each vector."""
    measure = "cosine" if metric == "cosine" else "l2"
    column = F.col(vector) if isinstance(vector, str) else vector

    @F.arrow_udf("int")
    def assign(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.int32())
        block = np.round(distance_block(centres, as_matrix(vectors), measure), 12)
        return pa.array(block.argmin(axis=0), pa.int32())

    return assign(column)


@dataclass(frozen=True)
class CellIndex:
    """A vector index in a folder: ``vectors``, one folder per cell, and the centres."""

    path: str
    key: str
    vector: str
    metric: str
    centres: tuple[tuple[float, ...], ...]
    columns: str
    #: Folders of vectors: that of the build, then one for each change.
    parts: tuple[str, ...]
    #: Numbers of the parts that have ``gone``, keys whose vectors in earlier parts are void.
    voiding: tuple[int, ...] = ()
    #: For each cell the most that a vector is away from the centre, and how many it holds.
    radii: tuple[float, ...] = ()
    sizes: tuple[int, ...] = ()

    @classmethod
    def build(
        cls,
        corpus: DataFrame,
        *,
        key: str,
        vector: str = "embedding",
        path: str,
        metric: str = "cosine",
        cells: int | None = None,
        carry: Sequence[str] = (),
        seed: int = 42,
    ) -> CellIndex:
        """Learn the centres, assign every vector to its nearest and write the cells.

        ``carry`` names columns to store beside the vectors so that searches can filter
        on them. The rows are written once before anything reads them, so a model that makes
        the vectors sees each row once.
        """
        check_metric(metric)
        spark = corpus.sparkSession
        stored = corpus.select(key, vector, *carry).filter(F.col(vector).isNotNull())
        stored = written(spread(stored, key), "vectors")
        rows = stored.count()
        if not rows:
            raise ValueError("a vector index needs stored rows: its width is read from them")
        cells = default_cells(rows) if cells is None else check_k(cells, "cells")
        centres = _fit(stored, vector, min(cells, rows), metric, seed)
        cell = T.StructField("cell", T.IntegerType())
        columns = T.StructType([*stored.schema.fields, cell]).json()
        part = f"{path}/vectors"
        index = cls(path, key, vector, metric, tuple(map(tuple, centres.tolist())), columns, (part,))
        index = index._write(stored, part)
        records.create(spark, f"{path}/centres.json", asdict(index))
        return index

    def _write(self, rows: DataFrame, part: str) -> CellIndex:
        """Write rows to their cells; return the index with the cells' new radii and sizes."""
        # A rebalance splits a cell that holds too many rows over several files.
        (
            rows.withColumn("cell", nearest_cell(self.vector, np.array(self.centres), self.metric))
            .hint("rebalance", "cell")
            .sortWithinPartitions("cell", self.key)
            .write.partitionBy("cell")
            .parquet(part)
        )

        spark, centres, metric = rows.sparkSession, np.array(self.centres), self.metric

        @F.arrow_udf("double")
        def away(vectors: pa.Array, cells: pa.Array) -> pa.Array:
            if not len(vectors):
                return pa.array([], pa.float64())
            return pa.array(distance_from(as_matrix(vectors), centres[cells.to_numpy()], metric))

        stored = spark.read.schema(T.StructType.fromJson(json.loads(self.columns))).parquet(part)
        found = stored.select("cell", away(self.vector, "cell").alias("away")).groupBy("cell")
        radii = np.array(self.radii or [0.0] * len(centres))
        sizes = np.array(self.sizes or [0] * len(centres))
        for cell, most, count in found.agg(F.max("away"), F.count("*")).collect():
            radii[cell] = max(radii[cell], most)
            sizes[cell] += count
        return replace(self, radii=tuple(radii.tolist()), sizes=tuple(sizes.tolist()))

    @property
    def rows(self) -> int:
        """Vectors stored, void ones included."""
        return sum(self.sizes)

    def change(self, added: DataFrame, gone: DataFrame | None = None) -> str:
        """Add rows to their cells and void others by key; return the path of the changed index.

        The centres stay. The index it grew from stays as it is for those who have it open.
        """
        fields = T.StructType.fromJson(json.loads(self.columns)).names[:-1]
        new = added.select(*fields).filter(F.col(self.vector).isNotNull())
        path = f"{self.path.rsplit('/', 1)[0]}/vectors-{uuid.uuid4().hex}"
        part, voiding = f"{path}/vectors", self.voiding
        if gone is not None:
            gone.select(self.key).write.parquet(f"{part}-gone")
            voiding = (*voiding, len(self.parts))
        index = replace(self._write(new, part), path=path, parts=(*self.parts, part), voiding=voiding)
        records.create(added.sparkSession, f"{path}/centres.json", asdict(index))
        return path

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> CellIndex:
        found = records.read(spark, f"{path}/centres.json")
        centres = tuple(map(tuple, found["centres"]))
        lists = {name: tuple(found[name]) for name in ("parts", "voiding", "radii", "sizes")}
        return cls(**{**found, "centres": centres, **lists})

    def vectors(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.columns))
        frames = [spark.read.schema(schema).parquet(part) for part in self.parts]
        if not self.voiding:
            return reduce(DataFrame.unionByName, frames)
        every = reduce(DataFrame.unionByName, [f.withColumn("_part", F.lit(i)) for i, f in enumerate(frames)])
        keys = T.StructType([schema[self.key]])
        gone = [spark.read.schema(keys).parquet(f"{self.parts[i]}-gone").withColumn("_until", F.lit(i)) for i in self.voiding]
        last = reduce(DataFrame.unionByName, gone).groupBy(self.key).agg(F.max("_until").alias("_until"))
        void = (every[self.key] == last[self.key]) & (F.col("_part") < F.col("_until"))
        return every.join(last, void, "left_anti").drop("_part")

    def _probe(self, queries: np.ndarray, nprobe: int) -> np.ndarray:
        """Return which cells each query looks in: its ``nprobe`` nearest centres.

        Nearest in the index's own measure: large inner products are in cells whose centres
        have large ones, not in those around the query.
        """
        centres = np.array(self.centres)
        order = np.argsort(distance_block(queries, centres, self.metric), axis=1, kind="stable")
        chosen = np.zeros((len(queries), len(centres)), dtype=bool)
        np.put_along_axis(chosen, order[:, :nprobe], True, axis=1)
        return chosen

    def _start(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Return which cells each query looks in first: its nearest, until they hold ``k`` rows."""
        centres, sizes = np.array(self.centres), np.array(self.sizes)
        order = np.argsort(distance_block(queries, centres, self.metric), axis=1, kind="stable")
        held = sizes[order]
        chosen = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(chosen, order, np.cumsum(held, axis=1) - held < k, axis=1)
        return chosen

    def _can_reach(self, queries: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Return which cells may hold a row as near to each query as its ``kth`` distance.

        No vector of a cell is nearer than the centre is, less the cell's radius.
        """
        bound = least_distance(queries, np.array(self.centres), np.array(self.radii), self.metric)
        return ~(bound > (kth + 1e-9 * (1.0 + np.abs(kth)))[:, None])

    def search(
        self,
        queries: DataFrame | None = None,
        *,
        spark: SparkSession | None = None,
        query_vector: Sequence[float] | None = None,
        query_key: str = "query_id",
        query_vector_column: str = "query_vector",
        metric: str | None = None,
        k: int = DEFAULT_K,
        nprobe: int | None = 4,
        where: Column | Mapping[str, Any] | None = None,
        broadcast_rows: int = BROADCAST_ROWS,
    ) -> DataFrame:
        """Return ``query_key, rank, key, _distance`` from the cells nearest each query.

        Reads only the folders of cells that some query looks in. With ``nprobe`` ``None`` the
        answer is the exact one: after the nearest cells only those are read that can hold a
        row as near as the k-th found, by the triangle inequality. A ``metric`` other than the
        index's, and queries that share an id, are refused.
        """
        check_k(k)
        if nprobe is not None:
            nprobe = min(check_k(nprobe, "nprobe"), len(self.centres))
        if metric is not None and check_metric(metric.lower()) != self.metric:
            raise ValueError(f"the index was built for {self.metric!r}, not {metric!r}")
        if (queries is None) == (query_vector is None):
            raise ValueError("pass exactly one of queries and query_vector")
        spark = queries.sparkSession if queries is not None else spark
        stored = apply_where(self.vectors(spark), where)
        if queries is None:
            queries = single_query(stored, query_vector=query_vector)
            query_key, query_vector_column = "query_id", "query_vector"
        asked = queries.select(query_key, query_vector_column).filter(
            F.col(query_vector_column).isNotNull()
        )
        schema = candidate_schema(stored, queries, self.key, query_key)
        stored = stored.select(self.key, self.vector, "cell")
        block = query_block(k, broadcast_rows)
        asked, table = held_queries(asked, query_key, block)
        order = [F.col(DISTANCE).asc_nulls_last(), F.col(self.key).asc()]

        def best(near: DataFrame, tasks: int | None = None) -> DataFrame:
            return ranked(near, query_key, order, k, tasks).select(query_key, "rank", self.key, DISTANCE)

        if table is not None:
            ids, matrix = table.column(0).combine_chunks(), as_matrix(table.column(1))
            look = lambda chosen, most=None: self._search_broadcast(
                stored, ids, matrix, np.packbits(chosen, axis=1), schema, k, most
            )
            if not len(ids):
                return best(look(np.zeros((0, 1), dtype=bool)))
            if nprobe is not None:
                return best(look(self._probe(matrix, nprobe)))
            first = self._start(matrix, k)
            near = written(best(look(first)).drop("rank"), "near")
            # One number for each of the bounded number of queries.
            farthest = near.groupBy(query_key).agg(F.max(DISTANCE), F.count(DISTANCE)).collect()
            known = {i: d for i, d, n in farthest if n == k}
            kth = np.array([known.get(i, np.inf) for i in ids.to_pylist()])
            rest = self._can_reach(matrix, kth) & ~first
            return best(near.unionByName(look(rest, kth)) if rest.any() else near)

        def in_cells(queries: DataFrame, of, most: str | None = None) -> tuple[DataFrame, int | None]:
            """Search the cells that ``of`` marks; return how many tasks found rows of one query, if bounded.

            ``most`` names a column of the queries: a distance beyond which no row is wanted.
            """
            more = [] if most is None else [most]

            def cells(pack, kind: str):
                @F.arrow_udf(kind)
                def chosen(vectors: pa.Array, *more: pa.Array) -> pa.Array:
                    of_row = of(as_matrix(vectors), *(m.to_numpy(zero_copy_only=False) for m in more)) if len(vectors) else []
                    return pa.array([pack(row) for row in of_row], _MARKS[kind])

                return chosen(query_vector_column, *more)

            # A copy of a query for each cell is shuffled, or all vectors are read for each block.
            copies = queries.agg(F.sum(cells(lambda row: int(row.sum()), "bigint"))).first()[0] or 0
            blocks = blocks_for(queries, k, block)
            if copies <= min(blocks, MOST_COPIES) * self.rows:
                per_cell = queries.withColumn("cell", F.explode(cells(np.flatnonzero, "array<int>")))
                per_cell = per_cell.select(query_key, query_vector_column, "cell", *more)
                return near_grid(stored, per_cell, schema, self.metric, k, block, within="cell", most=most), None
            marked = queries.withColumn("_cells", cells(lambda row: np.packbits(row).tobytes(), "binary"))
            near, whole = [], one_task_a_core(stored)
            for table in query_blocks(marked.select(query_key, query_vector_column, "_cells", *more), blocks):
                if table.num_rows:
                    ids, matrix = table.column(0).combine_chunks(), as_matrix(table.column(1))
                    bits = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
                    known = None if most is None else table.column(most).to_numpy()
                    near.append(self._search_broadcast(whole, ids, matrix, bits, schema, k, known))
            return reduce(DataFrame.unionByName, near), cores(stored)

        if nprobe is not None:
            probe, width = self._probe, nprobe
            return best(*in_cells(asked, lambda vectors: probe(vectors, width)))
        start, can_reach = self._start, self._can_reach
        near = best(*in_cells(asked, lambda vectors: start(vectors, k)))
        near = written(near.drop("rank"), "near")
        farthest = near.groupBy(query_key).agg(F.max(DISTANCE).alias("_most"), F.count(DISTANCE).alias("_found"))
        kth = F.coalesce(F.when(F.col("_found") == k, F.col("_most")), F.lit(float("inf")))
        bounds = asked.join(farthest, query_key, "left").select(query_key, query_vector_column, kth.alias("_kth"))
        # What was found is all in one task for a query, but for where its file is cut.
        left = lambda vectors, kth: can_reach(vectors, kth) & ~start(vectors, k)
        rest, tasks = in_cells(written(bounds, "bounds"), left, "_kth")
        return best(near.unionByName(rest), tasks)

    def _search_broadcast(self, stored, ids, matrix, bits, schema, k: int, most=None) -> DataFrame:
        """Score queries against the rows of the cells that each has a bit for.

        ``most`` is a distance for each query beyond which no row is wanted.
        """
        cells, metric, names = len(self.centres), self.metric, schema.fieldNames()
        seen = np.bitwise_or.reduce(bits, axis=0) if len(bits) else np.zeros(0, np.uint8)
        looked_in = np.flatnonzero(np.unpackbits(seen, count=cells)).tolist()
        shared = stored.sparkSession.sparkContext.broadcast((ids, matrix, bits, most))

        def search(batches):
            ids, matrix, bits, most = shared.value
            best = RunningTopK(len(ids), k, most=most)
            units = directions(matrix) if metric == "cosine" else None
            for batch in batches:
                cell = batch.column(2).to_numpy()
                for number in np.unique(cell):
                    part = batch.filter(pa.array(cell == number))
                    numbers = np.flatnonzero(bits[:, number // 8] >> (7 - number % 8) & 1)
                    rows = as_matrix(part.column(1))
                    offer_block(best, matrix, numbers, rows, part.column(0), metric, units)
            yield from best.batches(ids, names)

        if len(looked_in) < cells:
            stored = stored.filter(F.col("cell").isin(looked_in))
        return stored.mapInArrow(search, schema)
