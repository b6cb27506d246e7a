"""Top-k: a running selection inside each task, then one ranked window over the rest."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values are compared at this many decimals, then by key. Sums of doubles differ in
#: their last bits with the order they were added in; ranks must not.
TIE_DECIMALS = 12

#: The same for BM25 scores, which are sums of many terms and can exceed a hundred.
SCORE_DECIMALS = 9


#: Parts into which the candidates of one group are dealt before they are merged.
MERGE_WAYS = 32


def check_k(k: int, label: str = "k") -> int:
    if k < 1:
        raise ValueError(f"{label} must be >= 1, got {k}")
    return k


class RunningTopK:
    """The ``k`` smallest values per query among the rows one task has seen.

    Only rows at or below a query's current k-th value are looked at again, so after the
    first batch a task keeps few candidates however many rows it reads.
    """

    def __init__(
        self, n_queries: int, k: int, decimals: int = TIE_DECIMALS, most: np.ndarray | None = None
    ) -> None:
        """``most`` is a value for each query of which it is known that no larger one is wanted."""
        self.k = k
        self._decimals = decimals
        self._kth = np.full(n_queries, np.inf) if most is None else np.array(most, dtype=np.float64)
        self._best: pa.Table | None = None
        self._waiting: list[pa.Table] = []

    def offer(
        self,
        values: np.ndarray,
        keys: pa.Array,
        queries: np.ndarray,
        exact=None,
        slack: float = 0.0,
    ) -> None:
        """Add a block: ``values[i, j]`` belongs to ``queries[i]`` and ``keys[j]``.

        ``exact(i, j)`` may recompute the chosen values where the block is only accurate
        to ``slack``. Infinite values are never chosen.
        """
        limit = self._kth[queries]
        if values.shape[1] >= self.k and np.isinf(limit).any():
            local = np.partition(values, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(limit, local)
        slack += 2.0 * 10.0**-self._decimals
        row, col = np.nonzero((values <= limit[:, None] + slack) & np.isfinite(values))
        if not len(row):
            return
        chosen = exact(row, col) if exact is not None else values[row, col]
        self.offer_pairs(queries[row], chosen, keys.take(pa.array(col)))
        self._merge()

    def limits(self, queries: np.ndarray) -> np.ndarray:
        """Return what values of these queries are certain not to be chosen if they are above."""
        return self._kth[queries] + 2.0 * 10.0**-self._decimals

    def offer_pairs(self, queries: np.ndarray, values: np.ndarray, keys: pa.Array) -> None:
        """Add single values; they are merged when as many wait as have been chosen."""
        found = {"query": pa.array(queries, pa.int64()), "value": np.round(values, self._decimals) + 0.0, "key": keys}
        self._waiting.append(pa.table(found))
        if sum(t.num_rows for t in self._waiting) >= (0 if self._best is None else self._best.num_rows):
            self._merge()

    def reached(self, values: np.ndarray) -> np.ndarray:
        """Say of ``values[query, j]`` whether they could still be chosen."""
        return values <= self._kth[:, None] + 2.0 * 10.0**-self._decimals

    def _merge(self) -> None:
        if not self._waiting:
            return
        both = pa.concat_tables([*self._waiting, *([] if self._best is None else [self._best])])
        self._waiting = []
        order = pc.sort_indices(
            both,
            sort_keys=[("query", "ascending"), ("value", "ascending"), ("key", "ascending")],
        )
        both = both.take(order)
        query = both["query"].to_numpy()
        position = np.arange(len(query))
        first = np.r_[True, query[1:] != query[:-1]]
        within = position - np.maximum.accumulate(np.where(first, position, 0))
        last = within == self.k - 1
        self._kth[query[last]] = np.minimum(self._kth[query[last]], both["value"].to_numpy()[last])
        self._best = both.filter(pa.array(within < self.k)).combine_chunks()

    def batches(self, query_ids: pa.Array, names: Sequence[str]):
        """Yield the selection as record batches ``(query id, key, value)``."""
        self._merge()
        if self._best is None:
            return
        best = self._best
        out = pa.table(
            [query_ids.take(best["query"].combine_chunks()), best["key"], best["value"]],
            names=list(names),
        )
        yield from out.to_batches(max_chunksize=10_000)


def ranked(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    k: int | None,
    tasks: int | None = None,
) -> DataFrame:
    """Number the rows of each group in ``order`` as ``rank`` and keep the first ``k``.

    With ``k`` a group is cut in two steps, so that what all tasks found for one group does
    not meet in one: first among ``MERGE_WAYS`` parts of the tasks, then among their results.
    If it is known that no more ``tasks`` than that found ``k`` rows each, the first step would
    cut nothing and is left out.
    """
    group = [group] if isinstance(group, str) else list(group)
    if k is not None:
        check_k(k)
    if k is not None and (tasks is None or tasks > MERGE_WAYS):
        ways = F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS))
        part = Window.partitionBy(*group, "_part").orderBy(*order)
        df = df.withColumn("_part", ways).withColumn("rank", F.row_number().over(part))
        df = df.filter(F.col("rank") <= k).drop("_part")
    numbered = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    if k is not None:
        numbered = numbered.filter(F.col("rank") <= k)
    return numbered.withColumn("rank", F.col("rank").cast("bigint"))


def hit_columns(
    df: DataFrame,
    columns: Sequence[str] | None,
    *,
    key: str,
    searched: str | None,
    ranking: str,
    vector: str | None = None,
) -> list[str]:
    """Return the table columns a hit carries besides its key.

    The default is the searched column. A vector column is never returned, and neither is
    a column of the table's own under the ranking column's name.
    """
    if columns is not None and not list(columns):
        raise ValueError("columns must not be empty")
    wanted = list(columns) if columns is not None else [searched] if searched else []
    kept = [c for c in dict.fromkeys(wanted) if c not in (ranking, vector)]
    if columns is not None and not kept:
        raise ValueError(
            f"columns must name at least one column besides {ranking!r} and the vector column"
        )
    missing = [c for c in kept if c not in df.columns]
    if missing:
        raise ValueError(f"no column named {missing[0]!r}")
    return [c for c in kept if c != key]


def page(df: DataFrame, order: Sequence[Column], *, offset: int, limit: int) -> DataFrame:
    """Return one page. ``order`` has to end in a unique key, or pages would overlap."""
    return df.orderBy(*order).offset(offset).limit(limit)
