import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rankfield.functions import patterns
from rankfield.functions.distances import (
    cosine_distance,
    l2_distance,
    negative_dot_product,
    relevance_score,
)
from rankfield.functions.tokens import tokens


def vectors(spark, rows):
    return spark.createDataFrame(rows, "id int, v array<float>, w array<float>")


def test_distances_from_a_fixed_vector(spark):
    df = vectors(spark, [(1, [1.0, 0.0], None), (2, [0.0, 2.0], None), (3, [0.0, 0.0], None)])
    query = [1.0, 0.0]
    rows = df.select(
        "id",
        cosine_distance("v", query).alias("c"),
        l2_distance("v", query).alias("l"),
        negative_dot_product("v", query).alias("d"),
    ).collect()
    assert {r["id"]: r["c"] for r in rows} == {1: 0.0, 2: 1.0, 3: 1.0}
    # Squared: no root is taken.
    assert {r["id"]: r["l"] for r in rows} == {1: 0.0, 2: 5.0, 3: 1.0}
    assert {r["id"]: r["d"] for r in rows} == {1: -1.0, 2: 0.0, 3: 0.0}


def test_distance_between_columns_and_nulls(spark):
    df = vectors(spark, [(1, [1.0, 0.0], [0.0, 1.0]), (2, [1.0, 1.0], None), (3, None, [1.0, 1.0])])
    rows = df.select("id", l2_distance("v", F.col("w")).alias("l")).collect()
    assert {r["id"]: r["l"] for r in rows} == {1: 2.0, 2: None, 3: None}


def test_empty_and_mismatched_vectors_are_refused(spark):
    df = vectors(spark, [(1, [1.0, 0.0], None)])
    with pytest.raises(ValueError, match="empty"):
        cosine_distance("v", [])
    with pytest.raises(Exception, match="dimensions"):
        df.select(cosine_distance("v", [1.0, 2.0, 3.0])).collect()


@pytest.mark.parametrize(
    "metric, distance, expected",
    [
        ("cosine", 0.25, 0.75),
        ("l2", 0.25, 1 - 0.25 / math.sqrt(2)),
        ("dot", 0.25, 0.75),
        ("dot", -0.5, 0.5),
        ("dot", 0.0, 0.0),
    ],
)
def test_relevance(spark, metric, distance, expected):
    row = spark.range(1).select(relevance_score(F.lit(distance), metric).alias("r")).first()
    assert row["r"] == pytest.approx(expected)


@pytest.mark.parametrize(
    "template, expected",
    [
        ("YYYY-MM-DD", "%Y-%m-%d"),
        ("yyyy/mm/dd", "%Y/%m/%d"),
        ("HH24:MI:SS", "%H:%M:%S"),
        ("DD MON YY", "%d %b %y"),
        ("DAY, DD MONTH YYYY", "%A, %d %B %Y"),
        ("DY HH:MI", "%a %I:%M"),
        ("YYYY-MM-DDTHH24", "%Y-%m-%dT%H"),
        ("YYYY-QQ", None),
        ("YYYY年", None),
        ("YYYYtMM", None),
    ],
)
def test_template_rewrites(template, expected):
    assert patterns.template_to_strftime(template) == expected


def test_templates_are_refused_with_the_rewrite():
    with pytest.raises(ValueError, match="%Y-%m-%d"):
        patterns.to_char("ts", "YYYY-MM-DD")
    with pytest.raises(ValueError) as error:
        patterns.to_date("s", "YYYY-QQ")
    assert "write" not in str(error.value)
    # Nothing to interpret, and nothing that looks like a template.
    assert patterns.check_pattern("to_char", " - / ") == " - / "


def test_directives_without_an_equivalent_are_refused():
    with pytest.raises(ValueError, match="%Z"):
        patterns.spark_pattern("%Y %Z")
    with pytest.raises(ValueError):
        patterns.spark_pattern("%Y %")


def test_dates(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2026-08-12 17:05:09.123456' AS ts, '12|08|26' AS s")
    row = df.select(
        patterns.to_char("ts", "%A %d. %B '%y at %I:%M %p, 100%%").alias("a"),
        patterns.to_date("s", "%d|%m|%y").alias("b"),
        patterns.date_trunc("hour", "ts").alias("c"),
        patterns.date_bin("15 minutes", "ts").alias("d"),
        patterns.to_char("ts", "%F %T.%f").alias("e"),
        patterns.to_timestamp(F.lit("2026-08-12 10:00:00")).alias("f"),
    ).first()
    assert row["a"] == "Wednesday 12. August '26 at 05:05 PM, 100%"
    assert row["b"] == dt.date(2026, 8, 12)
    assert row["c"] == dt.datetime(2026, 8, 12, 17)
    assert row["d"] == dt.datetime(2026, 8, 12, 17)
    assert row["e"] == "2026-08-12 17:05:09.123456"
    assert row["f"] == dt.datetime(2026, 8, 12, 10)


def test_tokens(spark):
    df = spark.createDataFrame([("It's ÉTÉ, 2nd!",), ("",), (None,)], "text string")
    assert [r[0] for r in df.select(tokens("text")).collect()] == [
        ["it", "s", "été", "2nd"],
        [],
        [],
    ]
