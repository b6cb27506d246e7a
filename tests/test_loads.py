import os

import pytest
from pyspark.sql import functions as F

from rankfield.operators.merge import apply_load, get_by_ids, key_report
from rankfield.session import clear_scratch, scratch_root, written
from rankfield.sources import records
from rankfield.sources.attach import attach, attachment, catalogs_in_scope, detach
from rankfield.sources.database import Database, EmptyTable, split_table
from rankfield.sources.parquet import scan_parquet

SCHEMA = "id bigint, label string"


def rows(spark, *values):
    return spark.createDataFrame([tuple(v) for v in values], SCHEMA)


def held(df):
    return sorted((r["id"], r["label"]) for r in df.collect())


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("replace", [(2, "B"), (4, "D")]),
        ("append", [(1, "a"), (2, "B"), (2, "b"), (3, "c"), (4, "D")]),
        ("upsert", [(1, "a"), (2, "B"), (3, "c"), (4, "D")]),
        ("update", [(1, "a"), (2, "B"), (3, "c")]),
        ("delete", [(1, "a"), (3, "c")]),
    ],
)
def test_modes(spark, folder, mode, expected):
    target = rows(spark, (1, "a"), (2, "b"), (3, "c"))
    source = rows(spark, (2, "B"), (4, "D"))
    key = None if mode in ("replace", "append") else ["id"]
    assert held(apply_load(target, source, mode, key)) == expected
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    database.load("t", target)
    result = database.load("t", source, mode, key)
    assert held(database.table("t").read()) == expected
    assert (result.row_count, result.full_name) == (len(expected), "default.public.t")


def test_upsert_is_idempotent_and_append_is_not(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    for mode, count in (("upsert", 2), ("upsert", 2), ("append", 4)):
        key = ["id"] if mode == "upsert" else None
        assert database.load("t", rows(spark, (1, "a"), (2, "b")), mode, key).row_count == count


def test_composite_keys(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    source = spark.createDataFrame([(1, 2, "B"), (2, 2, "C")], "x int, y int, v string")
    merged = apply_load(target, source, "upsert", ["x", "y"])
    assert sorted(map(tuple, merged.collect())) == [(1, 1, "a"), (1, 2, "B"), (2, 2, "C")]


def test_delete_needs_only_the_key_and_ignores_absent_ones(spark):
    target = rows(spark, (1, "a"), (2, "b"))
    gone = spark.createDataFrame([(2,), (9,)], "id bigint")
    assert held(apply_load(target, gone, "delete", ["id"])) == [(1, "a")]


@pytest.mark.parametrize("mode", ["upsert", "update", "delete"])
def test_keyed_modes_check_before_they_work(spark, folder, mode):
    target = rows(spark, (1, "a"))
    with pytest.raises(ValueError, match="key is required"):
        apply_load(target, target, mode)
    with pytest.raises(ValueError, match="repeated key"):
        apply_load(target, rows(spark, (1, "x"), (1, "y")), mode, ["id"])
    with pytest.raises(ValueError, match="repeated key"):
        apply_load(target, rows(spark, (None, "x")), mode, ["id"])
    with pytest.raises(ValueError, match="missing column 'id'"):
        apply_load(target, target.select("label"), mode, ["id"])
    database = Database.create(spark, folder, database_id="d", tables=["t"])
    database.load("t", target)
    with pytest.raises(ValueError, match="without a key"):
        database.load("t", target, mode, ["id"])


def test_missing_and_unknown_columns(spark):
    target = rows(spark, (1, "a"))
    with pytest.raises(ValueError, match="missing column 'label'"):
        apply_load(target, target.select("id"), "upsert", ["id"])
    with pytest.raises(ValueError, match="does not have"):
        apply_load(target, target.withColumn("extra", F.lit(1)), "append")
    with pytest.raises(ValueError, match="mode must be"):
        apply_load(target, target, "merge", ["id"])


def test_declared_and_empty(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    with pytest.raises(EmptyTable, match="no data"):
        database.table("t").read()
    # Nothing can match in a table without rows, so these leave it as it is.
    assert database.load("t", rows(spark, (1, "a")), "update", ["id"]).row_count == 0
    assert database.load("t", rows(spark, (1, "a")).select("id"), "delete", ["id"]).row_count == 0
    assert not database.table("t").record.version
    assert database.load("t", rows(spark, (1, "a")), "upsert", ["id"]).row_count == 1


def test_keys_only_for_declared_tables(spark, folder):
    with pytest.raises(ValueError, match="not a declared table"):
        Database.create(spark, folder, tables=["t"], keys={"other": ["id"]})


def test_readers_keep_their_version(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"])
    database.load("t", rows(spark, (1, "a")))
    before = database.table("t").read()
    database.load("t", rows(spark, (2, "b")))
    assert held(before) == [(1, "a")]
    assert held(database.table("t").read()) == [(2, "b")]


def test_many_appends_are_one_scan(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"])
    for i in range(4):
        database.load("t", rows(spark, (i, "x")), "append")
    read = database.table("t").read()
    assert held(read) == [(i, "x") for i in range(4)]
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_scratch_tables_can_be_cleared(spark):
    kept = written(rows(spark, (1, "a")), "test")
    assert held(kept) == [(1, "a")]
    clear_scratch(spark)
    with pytest.raises(Exception):
        kept.collect()


def test_one_of_two_racing_loads_fails(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"])
    table = database.table("t")
    stale = table.record
    table.load(rows(spark, (1, "a")))
    with pytest.raises(records.RecordConflict):
        from dataclasses import replace

        table._commit(replace(stale, version=1))
    assert held(table.read()) == [(1, "a")]


def test_layout_keeps_values_types_and_order(spark, folder):
    database = Database.create(
        spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]},
        partition_by={"t": ["code"]}, sorted_by={"t": ["id"]},
    )
    source = spark.createDataFrame([(2, "007", "x"), (1, "7", "y")], "ID bigint, code string, v string")
    database.load("t", source)
    database.load("t", source.select("v", "code", F.lit(3).alias("id")).limit(1), "append")
    read = database.table("t").read()
    assert read.columns == ["id", "code", "v"]
    assert sorted((r["id"], r["code"]) for r in read.collect())[:2] == [(1, "7"), (2, "007")]
    assert read.schema["id"].dataType.simpleString() == "bigint"
    database.publish()
    view = spark.table("d.t")
    assert view.columns == read.columns and sorted(view.collect()) == sorted(read.collect())
    plan = read.filter("code = '007' AND id > 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(code" in plan and "GreaterThan(id,1)" in plan


def test_a_hot_partition_value_is_written_whole(spark, folder):
    database = Database.create(
        spark, folder, database_id="d", tables=["t"],
        partition_by={"t": ["kind"]}, sorted_by={"t": ["v"]},
    )
    source = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("kind"),
        F.lit(1).alias("v"),
    )
    assert database.load("t", source).row_count == 30_000
    read = database.table("t").read()
    assert (read.count(), read.filter("kind = 'hot'").count()) == (30_000, 10_000)


def test_only_parquet(spark, folder):
    with pytest.raises(FileNotFoundError, match="parquet"):
        scan_parquet(spark, f"{folder}/missing.parquet")
    text = f"{folder}/rows.csv"
    with open(text, "w") as out:
        out.write("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)parquet"):
        scan_parquet(spark, text).collect()


def test_get_by_ids(spark):
    table = rows(spark, (1, "a"), (2, "b"), (3, "c"))
    assert held(get_by_ids(table, [3, 1, 9, 1], key="id")) == [(1, "a"), (3, "c")]
    assert held(get_by_ids(table, [], key="id")) == []
    ids = spark.createDataFrame([(2,), (2,), (8,)], "wanted bigint")
    assert held(get_by_ids(table, ids, key="id")) == [(2, "b")]


@pytest.mark.parametrize(
    "reference, parts",
    [
        ("Listings", (None, None, "listings")),
        ("Public.Listings", (None, "public", "listings")),
        ("DEFAULT.public.listings", ("default", "public", "listings")),
    ],
)
def test_table_references(reference, parts):
    assert split_table(reference) == parts


def test_bad_table_references():
    for bad in ("a.b.c.d", "a b", "", "a.;"):
        with pytest.raises(ValueError):
            split_table(bad)


def test_describe(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["broken", "later", "t"])
    database.load("t", rows(spark, (1, "a"), (2, None)))
    database.load("broken", rows(spark, (1, "a")))
    for part in database.table("broken").record.paths:
        for file in os.listdir(part):
            if file.startswith("part-"):
                with open(f"{part}/{file}", "wb") as out:
                    out.write(b"no parquet")
    found = [tuple(r)[:7] for r in database.describe().orderBy("table_name", "position").collect()]
    assert found == [
        ("broken", "unreadable", 1, "id", "bigint", None, None),
        ("broken", "unreadable", 2, "label", "string", None, None),
        ("later", "empty", None, None, None, 0, None),
        ("t", "loaded", 1, "id", "bigint", 2, 2),
        ("t", "loaded", 2, "label", "string", 2, 1),
    ]
    quick = database.describe(stats=False).filter("table_name = 't'").collect()
    assert [(r["row_count"], r["non_null"]) for r in quick] == [(None, None)] * 2
    assert [tuple(r) for r in database.overview().collect()] == [("broken", 2), ("t", 2)]


def test_keyed_loads_write_only_their_buckets(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]}, buckets=8)
    database.load("t", rows(spark, *[(i, "old") for i in range(200)]))
    table = database.table("t")
    before = set(table.record.paths)
    assert len(before) == 8
    for mode, source in (("upsert", rows(spark, (7, "new"))), ("delete", rows(spark, (8, "")).select("id"))):
        database.load("t", source, mode, ["id"])
        after = set(table.record.paths)
        assert len(before - after) == 1 and len(after - before) <= 1
        before = after
    found = {r["id"]: r["label"] for r in table.read().collect()}
    assert found == {**{i: "old" for i in range(200) if i != 8}, 7: "new"}
    assert table.record.row_count == 199


def test_key_report(spark):
    df = rows(spark, (1, "a"), (1, "b"), (2, "c"), (None, "d"))
    assert tuple(key_report(df, ["id"]).first()) == (4, 1, 1)
    assert tuple(key_report(df.limit(0), ["id"]).first()) == (0, 0, 0)


def test_scratch_is_never_on_one_machine_of_a_cluster(spark, monkeypatch):
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.master": "spark://host:7077", "spark.sql.warehouse.dir": "file:/tmp/w"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session)
    Session.conf["spark.checkpoint.dir"] = "file:/shared/"
    assert scratch_root(Session) == "file:/shared"
    del Session.conf["spark.checkpoint.dir"]
    Session.conf["spark.sql.warehouse.dir"] = "hdfs://store/w"
    assert scratch_root(Session).startswith("hdfs://store/w/")


def test_publish_and_attach(spark, folder):
    database = Database.create(spark, folder, database_id="own_db", tables=["t", "later"])
    database.load("t", rows(spark, (1, "a")))
    database.load("t", rows(spark, (2, "b")), "append")
    assert database.publish() == ["own_db.t"]
    path = f"{folder}/outside"
    rows(spark, (2, "joined")).write.parquet(path)
    for _ in range(2):
        assert attach(spark, "Src", {"t": path}).tables == ("t",)
    joined = spark.sql("SELECT s.label FROM own_db.t o JOIN src.t s ON o.id = s.id")
    assert [r[0] for r in joined.collect()] == ["joined"]
    assert {"default", "own_db", "src"} <= set(catalogs_in_scope(spark))
    detach(spark, "src")
    detach(spark, "src")
    assert not spark.catalog.databaseExists("src")
    assert held(spark.read.parquet(path)) == [(2, "joined")]
    attach(spark, "src", {"t": path})
    assert attachment(spark, "src").tables == ("t",)
    detach(spark, "src")
