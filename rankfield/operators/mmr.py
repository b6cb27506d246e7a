"""Maximal marginal relevance: near the query, far from what is already chosen."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfield.functions.distances import as_matrix
from rankfield.operators.knn import attach_columns, knn, single_query
from rankfield.operators.topk import TIE_DECIMALS, check_k, hit_columns
from rankfield.session import row_bound

#: Defaults of a diversified search.
MMR_K = 4
MMR_FETCH_K = 20
MMR_LAMBDA = 0.5

#: Vector components of the pools that are selected from at a time.
POOL_VALUES = 1 << 21


def select_diverse(
    query: np.ndarray, rows: np.ndarray, k: int, lambda_mult: float = MMR_LAMBDA
) -> list[int]:
    """Return up to ``k`` row numbers in the order they are chosen.

    Both terms are cosine similarities. Equal scores go to the earlier row.
    """
    if not len(rows):
        return []
    return select_each(query[None], rows[None], k, lambda_mult)[0].tolist()


def select_each(
    queries: np.ndarray, rows: np.ndarray, k: int, lambda_mult: float = MMR_LAMBDA
) -> np.ndarray:
    """Do that for many queries with pools of one size: ``rows[i]`` are those of ``queries[i]``."""
    length = np.sqrt((rows**2).sum(axis=2))

    def alike(to: np.ndarray) -> np.ndarray:
        norms = length * np.sqrt((to**2).sum(axis=1))[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(norms == 0.0, 0.0, np.matmul(rows, to[:, :, None])[:, :, 0] / norms)

    each, picks = np.arange(len(rows)), np.empty((len(rows), min(k, rows.shape[1])), dtype=np.int64)
    relevance, open_ = alike(queries), np.ones(length.shape, dtype=bool)
    # The first pick is by relevance alone, whatever the balance is.
    score, redundancy = relevance, np.full(length.shape, -np.inf)
    for step in range(picks.shape[1]):
        if step:
            redundancy = np.maximum(redundancy, alike(rows[each, picks[:, step - 1]]))
            score = lambda_mult * relevance - (1.0 - lambda_mult) * redundancy
        score = np.where(open_, np.round(score, TIE_DECIMALS), -np.inf)
        picks[:, step] = score.argmax(axis=1)
        open_[each, picks[:, step]] = False
    return picks


def mmr_select(
    pool: DataFrame,
    *,
    key: str,
    query_key: str,
    vector: str,
    query_vector_column: str,
    queries: DataFrame | None = None,
    k: int = MMR_K,
    lambda_mult: float = MMR_LAMBDA,
) -> DataFrame:
    """Choose ``k`` rows per query from a ranked pool.

    ``pool`` has ``query_key, rank, key`` and ``vector``. The query's vector is in the pool as
    well or, so that it travels once instead of with each row, in a table of ``queries``. A
    task holds a few batches of rows, sorted by query, or one query's pool, if that is larger.
    """
    check_k(k)
    schema = T.StructType(
        [
            T.StructField(query_key, pool.schema[query_key].dataType),
            T.StructField("rank", T.LongType()),
            T.StructField(key, pool.schema[key].dataType),
        ]
    )

    def chosen(table: pa.Table, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Select from whole groups, which begin at these rows; pools of one size at a time."""
        asks = table.column(3).is_null().to_numpy()
        size, first = np.diff(np.append(begin, table.num_rows)) - asks[begin], begin + asks[begin]
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for one in np.unique(size[size > 0]):
            own = np.flatnonzero((size == one) & table.column(4).is_valid().to_numpy()[begin])
            width = len(table.column(3)[int(first[own[0]])]) if len(own) else 0
            step = max(1, POOL_VALUES // max(1, int(one) * width))
            for start in range(0, len(own), step):
                part = own[start : start + step]
                at = first[part][:, None] + np.arange(one)
                rows = as_matrix(table.column(3).take(pa.array(at.ravel()))).reshape(len(part), one, -1)
                picks = select_each(as_matrix(table.column(4).take(pa.array(begin[part]))), rows, k, lambda_mult)
                places.append(np.take_along_axis(at, picks, axis=1).ravel())
                numbers.append(np.tile(np.arange(1, picks.shape[1] + 1), len(part)))
        found = table.select([0, 2]).take(pa.array(np.concatenate(places))).combine_chunks()
        ranks = pa.array(np.concatenate(numbers), pa.int64())
        found = pa.table([found.column(0), ranks, found.column(1)], names=[query_key, "rank", key])
        yield from found.to_batches()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch])
            code = pc.dictionary_encode(table.column(0).combine_chunks(), null_encoding="encode").indices.to_numpy()
            begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
            if len(begin) > 1:
                yield from chosen(table.slice(0, begin[-1]), begin[:-1])
            held = table.slice(begin[-1]).to_batches() if len(begin) else []
        if held:
            yield from chosen(pa.Table.from_batches(held), np.zeros(1, np.int64))

    fields = [F.col(query_key), F.col("rank").cast("long").alias("rank"), F.col(key), F.col(vector)]
    if queries is None:
        needed = pool.select(*fields, F.col(query_vector_column).alias("_asked"))
    else:
        asked = queries.select(query_key, query_vector_column).toDF(query_key, "_asked")
        asked = asked.filter("_asked IS NOT NULL").withColumn("rank", F.lit(None).cast("long"))
        needed = pool.select(*fields).unionByName(asked, allowMissingColumns=True)
    # A query is before its rows.
    order = [F.col(query_key), F.col("rank").asc_nulls_first()]
    return needed.repartition(query_key).sortWithinPartitions(*order).mapInArrow(choose, schema)


def mmr(
    corpus: DataFrame,
    queries: DataFrame | None = None,
    *,
    key: str,
    query_vector: Sequence[float] | None = None,
    query_key: str = "query_id",
    query_vector_column: str = "query_vector",
    vector: str = "embedding",
    metric: str = "cosine",
    k: int = MMR_K,
    fetch_k: int = MMR_FETCH_K,
    lambda_mult: float = MMR_LAMBDA,
    columns: Sequence[str] | None = None,
    where: Column | Mapping[str, Any] | None = None,
) -> DataFrame:
    """Return ``k`` diversified rows per query: ``query_key, rank, key, columns...``.

    The pool is the ``max(fetch_k, k)`` nearest rows by ``metric``; ``rank`` is the order
    of selection, which is not the order of distance.
    """
    check_k(k)
    carried = hit_columns(corpus, columns, key=key, searched=None, ranking="rank", vector=vector)
    if queries is None:
        if query_vector is None:
            raise ValueError("pass exactly one of queries and query_vector")
        queries = single_query(corpus, query_vector=query_vector)
        query_key, query_vector_column = "query_id", "query_vector"
    near = knn(
        corpus,
        queries,
        key=key,
        query_key=query_key,
        query_vector_column=query_vector_column,
        vector=vector,
        metric=metric,
        k=max(fetch_k, k),
        where=where,
    )
    rows = row_bound(queries)
    depth = None if rows is None else rows * max(fetch_k, k)
    pool = attach_columns(near, corpus, key, [vector], depth)
    picked = mmr_select(
        pool,
        key=key,
        query_key=query_key,
        vector=vector,
        query_vector_column=query_vector_column,
        queries=queries,
        k=k,
        lambda_mult=lambda_mult,
    )
    picked = attach_columns(picked, corpus, key, carried, depth)
    return picked.select(query_key, "rank", key, *carried)
