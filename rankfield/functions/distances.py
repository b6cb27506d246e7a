"""Vector distances, as column functions and as blocks of a matrix product."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metric name -> public name of its distance function.
DISTANCE_FUNCTIONS = {
    "cosine": "cosine_distance",
    "l2": "l2_distance",
    "dot": "negative_dot_product",
}


def check_metric(metric: str) -> str:
    if metric not in DISTANCE_FUNCTIONS:
        raise ValueError(f"metric must be one of {sorted(DISTANCE_FUNCTIONS)}, got {metric!r}")
    return metric


def query_vector(vector: Sequence[float]) -> list[float]:
    """Return the query floats unchanged, refusing an empty vector."""
    values = [float(v) for v in vector]
    if not values:
        raise ValueError("query vector must not be empty")
    return values


def as_matrix(array: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Return a list column without NULLs as a 2-D float64 matrix."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return np.zeros((0, 0))
    lengths = pc.list_value_length(array).to_numpy(zero_copy_only=False)
    width = int(lengths[0])
    if (lengths != width).any():
        raise ValueError("vectors of one column must all have the same number of dimensions")
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(array), width)


def _check_width(left: np.ndarray, right: np.ndarray) -> None:
    if left.shape[1] != right.shape[1]:
        raise ValueError(
            f"query vector has {right.shape[1]} dimensions, the column has {left.shape[1]}"
        )


def distance_block(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """Return the ``len(queries) x len(rows)`` distances, by one matrix product."""
    _check_width(rows, queries)
    product = queries @ rows.T
    if metric == "dot":
        return -product
    if metric == "l2":
        squared = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
        return np.maximum(squared - 2.0 * product, 0.0)
    norms = np.sqrt((queries**2).sum(1))[:, None] * np.sqrt((rows**2).sum(1))[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms == 0.0, 1.0, 1.0 - product / norms)


def distance_pairs(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Return the distance of each row of ``left`` from the same row of ``right``."""
    _check_width(left, right)
    if metric == "l2":
        return ((left - right) ** 2).sum(1)
    product = np.einsum("ij,ij->i", left, right)
    if metric == "dot":
        return -product
    norms = np.sqrt((left**2).sum(1)) * np.sqrt((right**2).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms == 0.0, 1.0, 1.0 - product / norms)


def _scatter(valid: np.ndarray, values: np.ndarray) -> pa.Array:
    out = np.full(len(valid), np.nan)
    out[valid] = values
    return pa.array(out, pa.float64(), mask=~valid)


def distance(column: str | Column, vector: Sequence[float] | Column, metric: str) -> Column:
    """Return the distance of a vector column from one vector or from another column.

    Runs as an Arrow function: whole batches of list values become one matrix, where a
    higher-order SQL expression would be interpreted element by element.
    """
    check_metric(metric)
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(vector, Column):

        @F.arrow_udf("double")
        def between(a: pa.Array, b: pa.Array) -> pa.Array:
            keep = pc.and_(pc.is_valid(a), pc.is_valid(b))
            valid = keep.to_numpy(zero_copy_only=False)
            if not valid.any():
                return pa.nulls(len(a), pa.float64())
            left, right = as_matrix(a.filter(keep)), as_matrix(b.filter(keep))
            return _scatter(valid, distance_pairs(left, right, metric))

        return between(column, vector)

    fixed = np.array([query_vector(vector)])

    @F.arrow_udf("double")
    def from_fixed(a: pa.Array) -> pa.Array:
        keep = pc.is_valid(a)
        valid = keep.to_numpy(zero_copy_only=False)
        if not valid.any():
            return pa.nulls(len(a), pa.float64())
        rows = as_matrix(a.filter(keep))
        _check_width(rows, fixed)
        return _scatter(valid, distance_pairs(rows, np.repeat(fixed, len(rows), 0), metric))

    return from_fixed(column)


def cosine_distance(column: str | Column, vector: Sequence[float] | Column) -> Column:
    """``1 - cos``; 1.0 where either side has no length."""
    return distance(column, vector, "cosine")


def l2_distance(column: str | Column, vector: Sequence[float] | Column) -> Column:
    """Squared Euclidean distance, without the root."""
    return distance(column, vector, "l2")


def negative_dot_product(column: str | Column, vector: Sequence[float] | Column) -> Column:
    return distance(column, vector, "dot")


def relevance_score(distance: Column, metric: str) -> Column:
    """Turn a distance into a relevance score, higher is better.

    ``l2`` divides the squared distance by the square root of two, as callers of this
    score expect, although that rule was made for the plain Euclidean distance.
    """
    check_metric(metric)
    if metric == "cosine":
        return F.lit(1.0) - distance
    if metric == "l2":
        return F.lit(1.0) - distance / F.sqrt(F.lit(2.0))
    return F.when(distance > 0, F.lit(1.0) - distance).otherwise(-distance)
