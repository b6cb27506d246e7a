"""Table profiles: columns, types and how many rows hold a value."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfield.operators.topk import check_k


def column_stats(df: DataFrame) -> DataFrame:
    """Return one row: ``row_count`` and ``<column>_non_null`` per column, in one pass."""
    counts = [F.count(F.col(f"`{c}`")).alias(f"{c}_non_null") for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts)


def column_profile(
    df: DataFrame,
    table: str,
    *,
    stats: bool = True,
    max_columns: int | None = None,
    hidden: Iterable[str] = (),
    searchable: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Return one row per column: name, type, position, counts and what it is searched by.

    All columns are listed unless ``max_columns`` asks for fewer. The counts come from one
    aggregation, turned on its side afterwards.
    """
    if max_columns is not None:
        check_k(max_columns, "max_columns")
    hidden = set(hidden)
    fields = [f for f in df.schema.fields[:max_columns] if f.name not in hidden]
    searchable = searchable or {}
    if stats:
        totals = column_stats(df.select(*[f"`{f.name}`" for f in fields]))
        total = F.col("row_count")
    else:
        totals = df.sparkSession.range(1)
        total = F.lit(None).cast("bigint")

    def entry(position: int, name: str, kind: str):
        nouns = searchable.get(name)
        seen = F.col(f"`{name}_non_null`") if stats else F.lit(None).cast("bigint")
        listed = F.array(*[F.lit(n) for n in nouns]) if nouns else F.lit(None)
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(position).cast("bigint").alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            total.alias("row_count"),
            seen.alias("non_null"),
            listed.cast("array<string>").alias("searchable_by"),
        )

    entries = [
        entry(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, start=1)
    ]
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def table_profile(tables: Mapping[str, DataFrame], *, stats: bool = True) -> DataFrame:
    """Profile several tables: one row per column, with counts from one pass over each.

    All tables are counted in one aggregation: each gives its name and, by position,
    whether its columns hold a value, so one row per table and task is shuffled.
    Without ``stats`` nothing is read.
    """
    spark = next(iter(tables.values())).sparkSession
    listed = [
        (name, position, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    schema = "table_name string, position bigint, column_name string, data_type string"
    columns = spark.createDataFrame(listed, schema)
    if not stats:
        none = F.lit(None).cast("bigint")
        return columns.withColumns({"row_count": none, "non_null": none})
    width = max(len(df.columns) for df in tables.values())

    def marked(name: str, df: DataFrame) -> DataFrame:
        held = [
            f"CASE WHEN `{c}` IS NOT NULL THEN true END AS c{i}" for i, c in enumerate(df.columns)
        ]
        held += [f"CAST(NULL AS boolean) AS c{i}" for i in range(len(held), width)]
        return df.selectExpr(*held).withColumn("table_name", F.lit(name))

    rows = reduce(DataFrame.union, [marked(name, df) for name, df in tables.items()])
    counts = [F.count(f"c{i}") for i in range(width)]
    totals = rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.array(*counts).alias("counts")
    )
    # A table without rows has no group, and counts of zero.
    return columns.join(totals, "table_name", "left").select(
        *columns.columns,
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce(F.element_at("counts", F.col("position").cast("int")), F.lit(0))
        .cast("bigint")
        .alias("non_null"),
    )


def table_overview(profile: DataFrame) -> DataFrame:
    """Return each table's column count, ordered by name."""
    return (
        profile.groupBy("table_name")
        .agg(F.count("column_name").alias("column_count"))
        .orderBy("table_name")
    )
