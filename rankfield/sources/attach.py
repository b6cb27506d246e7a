"""Attached sources: parquet that others own, readable under an alias."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from rankfield.session import scratch_root
from rankfield.sources.database import OWN_CATALOG, check_name


@dataclass(frozen=True)
class Attachment:
    """A registered source: its alias and the tables it offers."""

    alias: str
    tables: tuple[str, ...]


def attach(spark: SparkSession, alias: str, tables: Mapping[str, str]) -> Attachment:
    """Register parquet paths as ``<alias>.<table>``. Attaching again changes nothing."""
    alias = check_name(alias, "alias")
    home = f"{scratch_root(spark)}/rankfield/attached/{alias}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {alias} LOCATION '{home}'")
    for name, path in tables.items():
        name = check_name(name, "table")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {alias}.{name} USING parquet LOCATION '{path}'")
    return attachment(spark, alias)


def attachment(spark: SparkSession, alias: str) -> Attachment:
    names = sorted(t.name for t in spark.catalog.listTables(alias) if not t.isTemporary)
    return Attachment(alias, tuple(names))


def detach(spark: SparkSession, alias: str) -> None:
    """Drop the registration. The tables are external, so their files stay."""
    alias = check_name(alias, "alias")
    if not spark.catalog.databaseExists(alias):
        return
    for name in attachment(spark, alias).tables:
        spark.sql(f"DROP TABLE IF EXISTS {alias}.{name}")
    spark.sql(f"DROP DATABASE IF EXISTS {alias}")


def catalogs_in_scope(spark: SparkSession) -> list[str]:
    """Return the catalogs a query may name: the own one and every attached alias."""
    names = {db.name for db in spark.catalog.listDatabases()}
    return sorted((names - {"information_schema"}) | {OWN_CATALOG})
