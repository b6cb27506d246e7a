"""Deep pages against sorted lists, and that they sort little."""

import math

import pytest
from pyspark.sql import functions as F

from rankfield.operators import paging
from rankfield.operators.paging import deep_page, narrowed

ORDERS = [{"v": True, "id": True}, {"v": False, "id": True}, {"id": False}]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """A hot value in a third of the rows, nulls and NaN."""
    path = str(tmp_path_factory.mktemp("paging") / "t")
    value = (
        F.when(F.col("id") % 3 == 0, 5.0)
        .when(F.col("id") % 101 == 1, F.lit(None))
        .when(F.col("id") % 97 == 1, F.lit(float("nan")))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) / 7)
    )
    spark.range(20_000).select("id", value.alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def place(order):
    def of(row):
        parts = []
        for name, ascending in order.items():
            v = row[name]
            size = -math.inf if v is None else (math.inf if v != v else v)
            parts.append(size if ascending else -size)
        return parts

    return of


@pytest.mark.parametrize("order", ORDERS)
def test_pages_are_those_of_the_whole_order(table, order):
    expected = [r["id"] for r in sorted(table.collect(), key=place(order))]
    for offset, limit in [(0, 10), (9_990, 20), (19_995, 50), (30_000, 5), (3_000, 4_000)]:
        rows, skipped = narrowed(table, order, offset, limit, sort_rows=200)
        found = deep_page(table, order, offset=offset, limit=limit, sort_rows=200).collect()
        assert [r["id"] for r in found] == expected[offset : offset + limit]
        # Only rows around the page reach the sort.
        assert skipped <= offset
        assert rows.count() <= max(200, 2 * limit)


def test_the_range_reaches_the_scan(table):
    found = deep_page(table, {"id": True}, offset=10_000, limit=10, sort_rows=200)
    plan = found._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThanOrEqual(id," in plan


def test_small_empty_and_equal_tables(spark, table):
    assert deep_page(table.filter("id < 0"), {"id": True}, offset=0, limit=5).collect() == []
    same = table.select(F.lit("x").alias("a"))
    assert deep_page(same, {"a": True}, offset=19_998, limit=5, sort_rows=10).count() == 2
    few = table.filter("id < 7")
    found = deep_page(few, {"id": False}, offset=2, limit=3, sort_rows=paging.SORT_ROWS)
    assert [r["id"] for r in found.collect()] == [4, 3, 2]
    with pytest.raises(ValueError):
        deep_page(few, {}, offset=0, limit=1)
    with pytest.raises(ValueError):
        deep_page(few, {"id": True}, offset=-1, limit=1)
