"""Exact nearest neighbours of a table of query vectors in a table of vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfield.functions.distances import (
    as_matrix,
    check_metric,
    distance_block,
    distance_pairs,
    query_vector,
)
from rankfield.operators.topk import RunningTopK, check_k, hit_columns, ranked
from rankfield.session import (
    BROADCAST_ROWS,
    TASK_CANDIDATES,
    bounded,
    broadcast_if,
    scratch_path,
    spread,
    written,
)

DISTANCE = "_distance"
DEFAULT_K = 5

#: Distances one task holds at a time: bounds its memory whatever the batch sizes are.
BLOCK_CELLS = 4_000_000

#: Queries and rows whose directions are compared at a time: their products stay in the cache.
TILE_QUERIES = 256
TILE_ROWS = 2048

#: Vector components of one group's rows, whatever the vectors' width.
SLICE_VALUES = 8_000_000

#: Blocks of queries that a large query table is dealt into are larger than one that is alone,
#: as each costs a scan of the corpus; their vectors have at most so many components.
BLOCK_FACTOR = 4
BLOCK_VALUES = 1 << 22


def single_query(corpus: DataFrame, **values: Any) -> DataFrame:
    """Return a query table of one row: ``query_id`` 0 and the given text or vector."""
    fields = [T.StructField("query_id", T.LongType())]
    row: list[Any] = [0]
    if values.get("query_text") is not None:
        fields.append(T.StructField("query_text", T.StringType()))
        row.append(values["query_text"])
    if values.get("query_vector") is not None:
        fields.append(T.StructField("query_vector", T.ArrayType(T.DoubleType())))
        row.append(query_vector(values["query_vector"]))
    return corpus.sparkSession.createDataFrame([tuple(row)], T.StructType(fields))


def unique_queries(queries: DataFrame, query_key: str) -> DataFrame:
    """Return the queries, written once, if no two share an id; those would be one answer."""
    queries = written(queries, "queries")
    if not queries.groupBy(query_key).count().filter("count > 1").isEmpty():
        raise ValueError(f"two queries have the same {query_key!r}")
    return queries


def held_queries(asked: DataFrame, query_key: str, rows: int) -> tuple[DataFrame, pa.Table | None]:
    """Return the queries, and as a table if they are few; repeated ids are refused."""
    table = bounded(asked, rows=rows)
    if table is None:
        return unique_queries(asked, query_key), None
    if pc.count_distinct(table.column(0), mode="all").as_py() < table.num_rows:
        raise ValueError(f"two queries have the same {query_key!r}")
    return asked, table


def where_condition(df: DataFrame, where: Column | Mapping[str, Any] | None) -> Column:
    """Return which rows of ``df`` a filter keeps: a condition, or equalities by column."""
    if where is None:
        return F.lit(True)
    if isinstance(where, Column):
        return F.coalesce(where, F.lit(False))
    kept = F.lit(True)
    for name, value in where.items():
        if name.startswith("$") or isinstance(value, Mapping):
            raise ValueError(f"filter {name!r} must be a plain equality, operators are refused")
        if name not in df.columns:
            raise ValueError(f"cannot filter on {name!r}: not a column of this table")
        kept = kept & F.coalesce(F.col(f"`{name}`") == F.lit(value), F.lit(False))
    return kept


def apply_where(df: DataFrame, where: Column | Mapping[str, Any] | None) -> DataFrame:
    """Filter before ranking: filtering a finished top-k could only shrink it."""
    return df if where is None else df.filter(where_condition(df, where))


def directions(vectors: np.ndarray) -> np.ndarray | None:
    """Return the vectors at length one in single precision, or ``None`` if lengths are extreme.

    A vector without a direction stays zero, which is at the cosine distance 1 from all.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        length = np.sqrt((vectors**2).sum(1))
    if not ((length == 0) | ((length > 1e-100) & (length < 1e100))).all():
        return None
    return (vectors / np.where(length > 0, length, 1.0)[:, None]).astype(np.float32)


def offer_block(
    best: RunningTopK,
    matrix: np.ndarray,
    numbers: np.ndarray,
    rows: np.ndarray,
    keys: pa.Array,
    metric: str,
    units: np.ndarray | None = None,
) -> None:
    """Score ``rows`` against the queries ``matrix[numbers]`` and offer them to ``best``.

    ``units`` are the directions of all of ``matrix``, if they are to be used. A component that
    is missing or not finite is an error: such a row has no place in any order, and leaving it
    out would shorten the answer without a word.
    """
    if not np.isfinite(rows).all():
        raise ValueError("a stored vector has a component that is missing or not finite")
    row_units = directions(rows) if units is not None else None
    if row_units is not None and len(rows) and len(numbers):
        _offer_directions(best, matrix, units, numbers, rows, row_units, keys)
        return
    step = max(1, BLOCK_CELLS // max(1, len(rows)))
    for start in range(0, len(numbers), step):
        part = matrix[numbers[start : start + step]]
        block = distance_block(part, rows, metric)
        exact, slack = None, 0.0
        if metric == "l2" and block.size:
            # The block form subtracts nearly equal numbers; redo the few chosen pairs.
            scale = (part**2).sum(1).max() + (rows**2).sum(1).max()
            slack = 1e-13 * scale

            def exact(i, j, part=part):
                return distance_pairs(part[i], rows[j], "l2")

        best.offer(block, keys, numbers[start : start + step], exact, slack)


def _offer_directions(best, matrix, units, numbers, rows, row_units, keys) -> None:
    """Offer rows by angle: single precision rules pairs out, double precision scores the rest.

    A sum of products of two unit vectors is off by less than half of ``slack``.
    """
    width = rows.shape[1]
    slack, step = (width + 8) * 2.0**-23, max(1, BLOCK_CELLS // max(1, width))
    for row in range(0, len(rows), TILE_ROWS):
        right = np.ascontiguousarray(row_units[row : row + TILE_ROWS].T)
        count = right.shape[1]
        for start in range(0, len(numbers), TILE_QUERIES):
            own = numbers[start : start + TILE_QUERIES]
            block = units[own] @ right
            least = 1.0 - best.limits(own) - slack
            fresh = np.flatnonzero(np.isinf(least))
            if len(fresh) and count >= best.k:
                at = count - best.k
                least[fresh] = np.partition(block[fresh], at, axis=1)[:, at] - slack
            i, j = _places(block >= least.astype(np.float32)[:, None])
            for some in range(0, len(i), step):
                query, found = own[i[some : some + step]], row + j[some : some + step]
                values = distance_pairs(matrix[query], rows[found], "cosine")
                best.offer_pairs(query, values, keys.take(pa.array(found)))


def _places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return where a mask with few marks is true, looking at eight places at a time."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    word, bit = np.nonzero(flat[:whole].reshape(-1, 8)[words])
    at = np.concatenate([words[word] * 8 + bit, whole + np.flatnonzero(flat[whole:])])
    return at // mask.shape[1], at % mask.shape[1]


def query_block(k: int, rows: int = BROADCAST_ROWS) -> int:
    """Return how many queries a task may answer at once, given that it keeps ``k`` each."""
    return max(1, min(rows, TASK_CANDIDATES // k))


def candidate_schema(
    corpus: DataFrame, queries: DataFrame, key: str, query_key: str
) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_key, queries.schema[query_key].dataType),
            T.StructField(key, corpus.schema[key].dataType),
            T.StructField(DISTANCE, T.DoubleType()),
        ]
    )


def _near_broadcast(
    slim: DataFrame, table: pa.Table, schema: T.StructType, metric: str, k: int
) -> DataFrame:
    """Score every task's rows against the whole query table, held by each executor."""
    ids = table.column(0).combine_chunks()
    matrix = as_matrix(table.column(1))
    names = schema.fieldNames()
    shared = slim.sparkSession.sparkContext.broadcast((ids, matrix))

    def search(batches):
        ids, matrix = shared.value
        best = RunningTopK(len(ids), k)
        numbers = np.arange(len(ids))
        units = directions(matrix) if metric == "cosine" else None
        for batch in batches:
            if batch.num_rows:
                rows = as_matrix(batch.column(1))
                offer_block(best, matrix, numbers, rows, batch.column(0), metric, units)
        yield from best.batches(ids, names)

    return slim.mapInArrow(search, schema)


def blocks_for(queries: DataFrame, k: int, block_rows: int) -> int:
    """Return how many blocks a query table is dealt into, for tasks that keep ``k`` each."""
    rows, width = queries.agg(F.count(F.lit(1)), F.max(F.size(queries.columns[1]))).first()
    held = min(BLOCK_FACTOR * block_rows, TASK_CANDIDATES // k, BLOCK_VALUES // max(1, width or 1))
    return max(1, math.ceil(rows / max(1, held)))


def query_blocks(queries: DataFrame, blocks: int) -> Iterator[pa.Table]:
    """Yield a written query table block by block; each is read by itself."""
    spark, path = queries.sparkSession, scratch_path(queries.sparkSession, "query-blocks")
    block = F.pmod(F.xxhash64(queries.columns[0]), F.lit(blocks)).cast("int")
    numbered = queries.withColumn("_block", block)
    numbered.repartition(blocks, "_block").write.partitionBy("_block").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    for number in range(blocks):
        yield stored.filter(F.col("_block") == number).drop("_block").toArrow()


def cores(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def one_task_a_core(df: DataFrame) -> DataFrame:
    """Read a table in as many tasks as there are cores: each passes on ``k`` rows per query."""
    return df.coalesce(cores(df))


def near_blocks(
    slim: DataFrame,
    queries: DataFrame,
    schema: T.StructType,
    metric: str,
    k: int,
    block_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Score a query table of any size, a bounded block of it at a time.

    Each block is held by every executor while the corpus is read past it, so the corpus is
    scanned once per block and never shuffled or copied.
    """
    blocks = blocks_for(queries, k, block_rows)
    slim = one_task_a_core(slim)
    near = [_near_broadcast(slim, t, schema, metric, k) for t in query_blocks(queries, blocks)]
    return reduce(DataFrame.unionByName, near)


def near_grid(
    slim: DataFrame,
    queries: DataFrame,
    schema: T.StructType,
    metric: str,
    k: int,
    block_rows: int,
    within: str,
    most: str | None = None,
) -> DataFrame:
    """Score queries against the rows that share their value of ``within``.

    The queries of a value are dealt in bounded blocks and its rows in bounded slices, each
    by the value's own counts; a group holds one of either and keeps ``k`` rows per query.
    ``most`` names a column of the queries: a distance beyond which no row is wanted.
    """
    key, vector = slim.columns[:2]
    query_key, q_vector = queries.columns[:2]
    names = schema.fieldNames()
    groups = [within, "_block", "_slice"]
    asks = [query_key, q_vector, *([] if most is None else [most])]

    def counted(df: DataFrame, size: Column, most: int, name: str) -> DataFrame:
        parts = F.greatest(F.ceil(F.sum(size) / F.lit(most)), F.lit(1)).cast("int")
        return df.groupBy(within).agg(parts.alias(name))

    slices = counted(slim, F.size(vector), SLICE_VALUES, "_slices")
    parts = slices.join(counted(queries, F.lit(1), block_rows, "_blocks"), within)
    parts = written(parts, "parts")

    def numbered(column: str, n: str) -> Column:
        return F.pmod(F.xxhash64(column), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # One row for each value of ``within``.
    left = slim.join(parts, within).withColumn("_slice", numbered(key, "_slices"))
    left = left.withColumn("_block", every("_blocks")).select(key, vector, *groups)
    right = queries.join(parts, within).withColumn("_block", numbered(query_key, "_blocks"))
    right = right.withColumn("_slice", every("_slices")).select(*asks, *groups)

    def search(corpus: pa.Table, asked: pa.Table) -> pa.Table:
        ids = asked.column(query_key).combine_chunks()
        best = RunningTopK(len(ids), k, most=None if most is None else asked.column(most).to_numpy())
        if corpus.num_rows and asked.num_rows:
            matrix = as_matrix(asked.column(q_vector))
            numbers = np.arange(len(ids))
            units = directions(matrix) if metric == "cosine" else None
            for batch in corpus.select([key, vector]).to_batches(max_chunksize=10_000):
                rows = as_matrix(batch.column(1))
                offer_block(best, matrix, numbers, rows, batch.column(0), metric, units)
        found = list(best.batches(ids, names))
        if found:
            return pa.Table.from_batches(found)
        empty = [
            pa.array([], ids.type),
            pa.array([], corpus.column(key).type),
            pa.array([], pa.float64()),
        ]
        return pa.table(empty, names=list(names))

    return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInArrow(search, schema)


def attach_columns(
    hits: DataFrame, corpus: DataFrame, key: str, columns: Sequence[str], bound: int | None
) -> DataFrame:
    """Join ranked hits back to the table for its ordinary columns.

    ``bound`` is the most rows ``hits`` can have, queries times k, when that is known.
    While it is small the hits are the side that travels and the corpus is streamed past
    them, with only ``columns`` read; otherwise both sides are shuffled on the key.
    """
    if not columns:
        return hits
    side = hits if bound is None else broadcast_if(hits, bound)
    return corpus.select(key, *columns).join(side, key)


def knn(
    corpus: DataFrame,
    queries: DataFrame | None = None,
    *,
    key: str,
    query_vector: Sequence[float] | None = None,
    query_key: str = "query_id",
    query_vector_column: str = "query_vector",
    vector: str = "embedding",
    metric: str = "cosine",
    k: int = DEFAULT_K,
    columns: Sequence[str] | None = None,
    where: Column | Mapping[str, Any] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Return the ``k`` nearest rows of ``corpus`` for every query.

    Ask with a table of queries (``query_key``, ``query_vector_column``) or with one
    ``query_vector``. Result: ``query_key, rank, key, columns..., _distance``, where lower
    is nearer and ``rank`` breaks ties by key. ``where`` filters before ranking. Rows
    without a vector are not ranked.
    """
    check_metric(metric)
    check_k(k)
    carried = hit_columns(
        corpus, columns, key=key, searched=None, ranking=DISTANCE, vector=vector
    )
    if (queries is None) == (query_vector is None):
        raise ValueError("pass exactly one of queries and query_vector")
    if queries is None:
        queries = single_query(corpus, query_vector=query_vector)
        query_key, query_vector_column = "query_id", "query_vector"
    if query_key == key:
        raise ValueError(f"query_key and key are both named {key!r}; rename one")
    corpus = apply_where(corpus, where)
    slim = corpus.select(key, vector).filter(F.col(vector).isNotNull())
    asked = queries.select(query_key, query_vector_column).filter(
        F.col(query_vector_column).isNotNull()
    )
    schema = candidate_schema(corpus, queries, key, query_key)
    block = query_block(k, broadcast_rows)
    asked, table = held_queries(asked, query_key, block)
    if table is not None:
        near, tasks = _near_broadcast(spread(slim, key), table, schema, metric, k), None
    else:
        near, tasks = near_blocks(slim, asked, schema, metric, k, block), cores(slim)
    order = [F.col(DISTANCE).asc_nulls_last(), F.col(key).asc()]
    hits = ranked(near, query_key, order, k, tasks)
    bound = None if table is None else table.num_rows * k
    hits = attach_columns(hits, corpus, key, carried, bound)
    return hits.select(query_key, "rank", key, *carried, DISTANCE)
