"""Counts from footers and copies in another order."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rankfield.operators.profile import table_profile
from rankfield.sources import footers, records
from rankfield.sources.copies import create_sorted_copy, read_sorted_copy
from rankfield.sources.database import Database
from rankfield.sources.footers import footer_counts, stored_profile


def without_pages(folder, target):
    """Copy files with zeros in place of all but the footers."""
    os.makedirs(target)
    for file in glob.glob(f"{folder}/*.parquet"):
        with open(file, "rb") as source:
            body = source.read()
        size = int.from_bytes(body[-8:-4], "little") + 8
        with open(f"{target}/{os.path.basename(file)}", "wb") as out:
            out.write(body[:4] + b"\0" * (len(body) - 4 - size) + body[-size:])


def test_counts_come_without_reading_a_page(spark, folder):
    path, blank = f"{folder}/whole", f"{folder}/no pages"
    spark.range(1_000).select(
        "id",
        F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("Name"),
        F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") % 2 > 0, F.lit(float("nan"))).alias("nan"),
    ).repartition(3).write.parquet(path)
    without_pages(path, blank)
    rows = stored_profile(spark, {"t": spark.read.parquet(blank)}).collect()
    assert [(r["column_name"], r["row_count"], r["non_null"]) for r in rows] == [
        ("id", 1000, 1000), ("Name", 1000, 666), ("none", 1000, 0), ("nan", 1000, 500),
    ]


def test_a_scan_only_where_footers_say_nothing(spark, folder, monkeypatch):
    rows = spark.range(10).select(
        "id",
        F.when(F.col("id") > 3, F.array("id")).alias("list"),
        F.when(F.col("id") > 5, F.struct("id")).alias("row"),
        (F.col("id") % 2).alias("part"),
    )
    rows.write.partitionBy("part").parquet(f"{folder}/nested")
    plain = rows.select("id", F.when(F.col("id") > 6, 1).alias("v")).toArrow()
    pq.write_table(plain, f"{folder}/silent.parquet", write_statistics=False)
    spark.createDataFrame([], "a int, b array<int>").write.parquet(f"{folder}/empty")
    names = {"nested": "nested", "silent": "silent.parquet", "empty": "empty"}
    tables = {name: spark.read.parquet(f"{folder}/{path}") for name, path in names.items()}
    known = footer_counts(spark, tables)
    assert known["nested"] == {None: 10, "id": 10, "list": None, "row": None, "part": None}
    assert not footers._opens("nowhere://host/a.parquet")
    assert known["silent"] == {None: 10, "id": None, "v": None}
    order = ["table_name", "position"]
    found = stored_profile(spark, tables).orderBy(*order).collect()
    expected = table_profile(tables).orderBy(*order).collect()
    assert found == expected
    # A store that Arrow does not know.
    monkeypatch.setattr(footers, "_opens", lambda file: False)
    assert footer_counts(spark, tables)["silent"] == {None: None, "id": None, "v": None}
    assert stored_profile(spark, tables).orderBy(*order).collect() == expected


def test_sorted_copy(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"])
    source = spark.range(4_000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1_000)).alias("code"), F.col("id").cast("string").alias("v")
    )
    database.load("t", source)
    table = database.table("t")
    with pytest.raises(LookupError, match="no current copy"):
        read_sorted_copy(table, "code")
    # As many files as a large table would have.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = create_sorted_copy(table, ["CODE"], columns=["id"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = read_sorted_copy(table, "code", columns=["id"])
    assert read.columns == ["id", "code"]
    assert sorted(read.collect()) == sorted(table.read().select("id", "code").collect())
    # The filter reaches the scan, and few row groups can hold what it asks for.
    plan = read.filter("code BETWEEN 10 AND 20")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(code,10)" in plan and "LessThanOrEqual(code,20)" in plan
    groups = []
    for file in glob.glob(f"{path}/*.parquet"):
        footer = pq.read_metadata(file)
        at = footer.schema.names.index("code")
        found = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups)]
        groups += [s.min <= 20 and s.max >= 10 for s in found]
    assert len(groups) > 2 and sum(groups) < len(groups) / 2
    with pytest.raises(LookupError):
        read_sorted_copy(table, "code", columns=["v"])
    with pytest.raises(LookupError):
        read_sorted_copy(table, "id")
    with pytest.raises(ValueError, match="no column"):
        create_sorted_copy(table, ["absent"])
    # A load leaves the copy behind.
    database.load("t", source.limit(1), "append")
    with pytest.raises(LookupError):
        read_sorted_copy(table, "code")
    create_sorted_copy(table, ["code"])
    assert read_sorted_copy(table, "code").count() == 4_001


def test_records_are_named_when_whole_and_never_overwritten(spark, folder):
    path = f"{folder}/records/1.json"
    records.create(spark, path, {"a": "é"})
    with pytest.raises(records.RecordConflict):
        records.create(spark, path, {"a": "b"})
    assert records.read(spark, path) == {"a": "é"}
    assert records.names(spark, f"{folder}/records") == ["1.json"]
    assert not [name for name in os.listdir(f"{folder}/records") if "draft" in name]
