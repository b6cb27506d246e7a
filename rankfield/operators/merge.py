"""The five load modes, as a function from two frames to the table's next contents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The load modes, and those among them that match rows by key.
LOAD_MODES = ("replace", "append", "upsert", "update", "delete")
KEYED_LOAD_MODES = ("upsert", "update", "delete")


def check_mode(mode: str, key: Sequence[str] | None) -> None:
    if mode not in LOAD_MODES:
        raise ValueError(f"mode must be one of {list(LOAD_MODES)}, got {mode!r}")
    if mode in KEYED_LOAD_MODES and not key:
        raise ValueError(f"mode={mode!r} matches rows by key, so key is required")


def check_columns(target: DataFrame, source: DataFrame, mode: str, key: Sequence[str]) -> None:
    """Refuse a source that lacks a column; a delete needs only the key columns."""
    needed = key if mode == "delete" else target.columns
    for name in needed:
        if name not in source.columns:
            raise ValueError(f"upload is missing column {name!r}")
    if mode != "delete":
        for name in source.columns:
            if name not in target.columns:
                raise ValueError(f"upload has column {name!r}, which the table does not have")


def check_keys(source: DataFrame, key: Sequence[str]) -> None:
    """Refuse NULL or repeated keys in a source: which row should win is undefined.

    One aggregation of the source's key columns; the target is not read.
    """
    missing = F.lit(False)
    for name in key:
        missing = missing | F.col(name).isNull()
    bad = (
        source.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") > 1) | missing)
        .limit(1)
        .collect()
    )
    if bad:
        values = {name: bad[0][name] for name in key}
        raise ValueError(f"upload has a missing or repeated key: {values}")


def key_report(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Return one row: ``rows``, ``missing`` (a key column is NULL) and ``repeated`` (keys that
    several rows have). A keyed load takes a source with none of either."""
    present = F.lit(True)
    for name in key:
        present = present & F.col(name).isNotNull()
    counted = source.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_ok", present)
    zero = F.lit(0).cast("bigint")
    return counted.agg(
        F.coalesce(F.sum("_n"), zero).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), zero).alias("missing"),
        F.count(F.when(F.col("_ok") & (F.col("_n") > 1), True)).alias("repeated"),
    )


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """Return the source with the target's columns, in its order and types."""
    types = {f.name: f.dataType for f in target.schema.fields}
    return source.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in target.columns])


def apply_load(
    target: DataFrame | None,
    source: DataFrame,
    mode: str = "replace",
    key: Sequence[str] | None = None,
    *,
    checked: bool = False,
) -> DataFrame:
    """Return what a table holds after ``source`` is loaded into ``target``.

    ``replace`` discards the target, ``append`` keeps it and adds blindly. ``upsert``
    replaces matched rows and inserts the others, ``update`` replaces matched rows only,
    ``delete`` removes matched rows and inserts nothing. The source's keys are the side
    of each join that Spark can broadcast, so a small load does not shuffle a large table.
    """
    check_mode(mode, key)
    if mode == "replace" or target is None:
        if mode in ("update", "delete"):
            return source.limit(0)
        return source
    key = list(key or [])
    check_columns(target, source, mode, key)
    if mode == "append":
        return target.unionByName(conform(source, target))
    if not checked:
        check_keys(source, key)
    keys = source.select(*key)
    kept = target.join(keys, key, "left_anti").select(*target.columns)
    if mode == "delete":
        return kept
    if mode == "update":
        matched = target.select(*key).join(keys, key, "left_semi").distinct()
        source = source.join(matched, key, "left_semi")
    return kept.unionByName(conform(source, target))


def get_by_ids(table: DataFrame, ids: DataFrame | Sequence[str], *, key: str) -> DataFrame:
    """Return the rows with the given ids. Absent ids are skipped, none asked gives none."""
    if not isinstance(ids, DataFrame):
        values = list(dict.fromkeys(ids))
        if not values:
            return table.limit(0)
        return table.filter(F.col(key).isin(values))
    return table.join(ids.select(F.col(ids.columns[0]).alias(key)), key, "left_semi")
