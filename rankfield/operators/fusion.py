"""Reciprocal-rank fusion of a text ranking and a vector ranking."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfield.functions.tokens import check_text
from rankfield.operators.bm25 import SCORE, bm25_scan
from rankfield.operators.knn import DEFAULT_K, attach_columns, knn, single_query
from rankfield.operators.topk import TIE_DECIMALS, check_k, hit_columns, ranked
from rankfield.session import row_bound

#: Fixed value: damping constant of the fusion formula.
RRF_K = 60

#: Candidates taken from each ranking when the caller does not say.
DEPTH_FACTOR = 4
MIN_DEPTH = 20


def fetch_depth(k: int, fetch_k: int | None = None) -> int:
    """Return how many rows each ranking contributes; never fewer than ``k``."""
    check_k(k)
    return max(fetch_k, k) if fetch_k is not None else max(DEPTH_FACTOR * k, MIN_DEPTH)


def fuse(
    text_ranks: DataFrame,
    vector_ranks: DataFrame,
    *,
    key: str,
    query_key: str,
    k: int,
    rrf_k: int = RRF_K,
) -> DataFrame:
    """Combine two ranked lists per query into ``query_key, rank, key, score``.

    Only ranks are used, never the scores behind them. A row missing from one list gets
    nothing from it. Equal scores are ordered by key.
    """
    check_k(rrf_k, "rrf_k")
    left = text_ranks.select(query_key, key, F.col("rank").alias("_text"))
    right = vector_ranks.select(query_key, key, F.col("rank").alias("_near"))

    def part(column: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(float(rrf_k)) + F.col(column)), F.lit(0.0))

    both = left.join(right, [query_key, key], "full_outer").withColumn(
        SCORE, F.round(part("_text") + part("_near"), TIE_DECIMALS)
    )
    return ranked(
        both.select(query_key, key, SCORE), query_key, [F.col(SCORE).desc(), F.col(key).asc()], k
    )


def hybrid(
    corpus: DataFrame,
    queries: DataFrame | None = None,
    *,
    key: str,
    text: str,
    vector: str = "embedding",
    query: str | None = None,
    query_vector: Sequence[float] | None = None,
    query_key: str = "query_id",
    query_text: str = "query_text",
    query_vector_column: str = "query_vector",
    k: int = DEFAULT_K,
    fetch_k: int | None = None,
    rrf_k: int = RRF_K,
    metric: str = "cosine",
    columns: Sequence[str] | None = None,
    where: Column | Mapping[str, Any] | None = None,
    text_search: Callable[[DataFrame, int], DataFrame] | None = None,
    vector_search: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Rank ``corpus`` by words and by vectors for every query and fuse the two rankings.

    ``text_search`` and ``vector_search`` replace the scans by searches of stored
    indexes; each takes the query table and a depth. ``where`` filters what either scan ranks;
    a search that is passed in has to filter by itself, so the two cannot be combined. Result: ``query_key, rank, key,
    columns..., score``; the default column is the searched text.
    """
    depth = fetch_depth(k, fetch_k)
    check_k(rrf_k, "rrf_k")
    carried = hit_columns(
        corpus, columns, key=key, searched=text, ranking=SCORE, vector=vector
    )
    if queries is None:
        if query is None or query_vector is None:
            raise ValueError("a fused search needs both a query text and a query vector")
        queries = single_query(
            corpus, query_text=check_text(query), query_vector=query_vector
        )
        query_key, query_text, query_vector_column = "query_id", "query_text", "query_vector"
    if where is not None and (text_search is not None or vector_search is not None):
        raise ValueError("where filters the scans; a search that is passed in filters by itself")
    if text_search is not None:
        by_text = text_search(queries, depth)
    else:
        by_text = bm25_scan(
            corpus,
            queries,
            key=key,
            text=text,
            query_key=query_key,
            query_text=query_text,
            k=depth,
            where=where,
        )
    if vector_search is not None:
        by_vector = vector_search(queries, depth)
    else:
        by_vector = knn(
            corpus,
            queries,
            key=key,
            query_key=query_key,
            query_vector_column=query_vector_column,
            vector=vector,
            metric=metric,
            k=depth,
            where=where,
        )
    hits = fuse(by_text, by_vector, key=key, query_key=query_key, k=k, rrf_k=rrf_k)
    asked = row_bound(queries)
    bound = None if asked is None else asked * k
    hits = attach_columns(hits, corpus, key, carried, bound)
    return hits.select(query_key, "rank", key, *carried, SCORE)
