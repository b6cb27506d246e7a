"""Deep pages: narrow down to the rows around a page by counted ranges, sort only those."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfield.operators.topk import check_k

#: Ranges a round counts, and sampled rows for each of them.
RANGES = 64
SAMPLES = 16

#: Rows that are sorted without narrowing further.
SORT_ROWS = 1_000_000


def _compared(left: Column, right: Column) -> Column:
    """Whether ``left`` sorts before ``right`` ascending, nulls first."""
    return F.coalesce(left < right, left.isNull() & right.isNotNull())


def _before(row: Mapping[str, Column], other: Mapping[str, Column], order: Mapping[str, bool]) -> Column:
    """Whether one row comes before another, compared column by column."""
    result = F.lit(False)
    for name, ascending in reversed(order.items()):
        a, b = row[name], other[name]
        first = _compared(a, b) if ascending else _compared(b, a)
        result = first | (a.eqNullSafe(b) & result)
    return result


def _lead(name: str, ascending: bool, low: Column | None, high: Column | None, nulls: bool) -> Column:
    """A plain test of the leading column that no row of the range fails; a scan can use it."""
    if not ascending:
        low, high = high, low
    column = F.col(f"`{name}`")
    tests = [column >= low] if low is not None else []
    tests += [column <= high] if high is not None else []
    if not tests:
        return F.lit(True)
    inside = reduce(Column.__and__, tests)
    return inside | column.isNull() if nulls else inside


def _within(df: DataFrame, order: Mapping[str, bool], low: tuple | None, high: tuple | None) -> DataFrame:
    """Rows from ``low`` on, it included, and before ``high``."""
    row = {name: F.col(f"`{name}`") for name in order}
    at = {bound: _literals(df, order, bound) for bound in (low, high) if bound is not None}
    lead, ascending = next(iter(order.items()))
    ends = [at[bound][lead] if bound is not None and bound[0] is not None else None for bound in (low, high)]
    # Nulls are first in ascending order and last in descending order.
    nulls = (low is None or low[0] is None) if ascending else (high is None or high[0] is None)
    found = df.filter(_lead(lead, ascending, *ends, nulls))
    if low is not None:
        found = found.filter(~_before(row, at[low], order))
    if high is not None:
        found = found.filter(_before(row, at[high], order))
    return found


def _literals(df: DataFrame, order: Mapping[str, bool], values: tuple) -> dict[str, Column]:
    return {name: F.lit(value).cast(df.schema[name].dataType) for name, value in zip(order, values)}


def _sort(order: Mapping[str, bool]) -> list[Column]:
    return [F.asc(f"`{name}`") if ascending else F.desc(f"`{name}`") for name, ascending in order.items()]


def _splitters(df: DataFrame, order: Mapping[str, bool]) -> list[tuple]:
    """Rows that cut ``df`` into about even ranges, from a uniform sample of fixed size."""
    sample = df.orderBy(F.rand(7)).limit(RANGES * SAMPLES).orderBy(*_sort(order)).collect()
    return list(dict.fromkeys(tuple(r) for r in sample[SAMPLES::SAMPLES]))


def _counted(df: DataFrame, order: Mapping[str, bool], cuts: list[tuple]) -> list[int]:
    """Return how many rows each range between the cuts has; a task hands on one sum each."""
    row = {name: F.col(f"`{name}`") for name in order}
    names = {name: f"c{i}" for i, name in enumerate(order)}
    listed = F.array(
        *[
            F.struct(*[value.alias(names[n]) for n, value in _literals(df, order, cut).items()])
            for cut in cuts
        ]
    )
    passed = F.filter(listed, lambda cut: ~_before(row, {n: cut[c] for n, c in names.items()}, order))
    found = df.groupBy(F.size(passed).alias("range")).count().collect()
    counts = [0] * (len(cuts) + 1)
    for r in found:
        counts[r["range"]] = r["count"]
    return counts


def narrowed(
    df: DataFrame, order: Mapping[str, bool], offset: int, limit: int, sort_rows: int = SORT_ROWS
) -> tuple[DataFrame, int]:
    """Return the rows of the ranges that a page lies in, and how many rows come before them.

    Each round samples the rows left, counts the ranges between the sample's cuts in one scan of
    the order columns, and goes on with those that the page touches, until at most
    ``sort_rows`` (or twice the page) are left. The counts are exact, so the page is, however
    the sample fell. Rows equal in all order columns stay in one range.
    """
    low = high = None
    skipped, left = 0, None
    while left is None or left > max(sort_rows, 2 * limit):
        rows = _within(df, order, low, high).select(*[f"`{name}`" for name in order])
        cuts = _splitters(rows, order)
        if not cuts or (left is not None and len(cuts) == 1 and cuts[0] == low):
            break
        counts = _counted(rows, order, cuts)
        bounds = [low, *cuts, high]
        if left is None and sum(counts) <= max(sort_rows, 2 * limit):
            break
        total, start = sum(counts), 0
        ahead = skipped
        while start < len(counts) - 1 and ahead + counts[start] <= offset:
            ahead += counts[start]
            start += 1
        end, seen = start, ahead + counts[start]
        while end < len(counts) - 1 and seen < offset + limit:
            end += 1
            seen += counts[end]
        skipped, low, high, left = ahead, bounds[start], bounds[end + 1], seen - ahead
        if left == total:
            break
    return _within(df, order, low, high), skipped


def deep_page(
    df: DataFrame, order: Mapping[str, bool], *, offset: int, limit: int, sort_rows: int = SORT_ROWS
) -> DataFrame:
    """Return one page, sorting only the rows around it.

    ``order`` names the columns, true for ascending, and has to end in a unique key. Nulls are
    the smallest values and NaN the largest, as in Spark's own order. ``df`` is scanned a few
    times and has to give the same rows each time: a table, not a random expression. A page
    beyond the last row is empty.
    """
    check_k(limit, "limit")
    if offset < 0:
        raise ValueError(f"offset must be >= 0, got {offset}")
    if not order:
        raise ValueError("order must name at least one column")
    found, skipped = narrowed(df, order, offset, limit, sort_rows)
    return found.orderBy(*_sort(order)).offset(offset - skipped).limit(limit)
