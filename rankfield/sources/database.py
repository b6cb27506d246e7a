"""Databases of keyed, versioned parquet tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.operators.merge import (
    KEYED_LOAD_MODES,
    apply_load,
    check_columns,
    check_keys,
    check_mode,
    conform,
    get_by_ids,
)
from rankfield.operators.profile import table_overview
from rankfield.session import written
from rankfield.sources import records
from rankfield.sources.footers import stored_counts
from rankfield.sources.parquet import lowered, scan_parquet

#: Fixed value: the catalog name a database's own tables answer to.
OWN_CATALOG = "default"
DEFAULT_SCHEMA = "public"

#: Partition columns that keep one load's files apart from another's, and within a load of a
#: keyed table the rows of one hash bucket of the key.
LOAD = "rankfield_load"
BUCKET = "rankfield_bucket"

#: Hash buckets of a keyed table when its declaration does not say. A keyed load rewrites only
#: those its keys fall in, so a large table is declared with more.
KEY_BUCKETS = 16

#: What missing files raise in planning, and damaged footers in tasks.
_UNREADABLE = (AnalysisException, PythonException)

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def check_name(value: str, label: str) -> str:
    """Return an identifier in its stored, lowercase form."""
    if not _NAME.fullmatch(value):
        raise ValueError(f"{label} must be a plain identifier, got {value!r}")
    return value.lower()


def split_table(reference: str) -> tuple[str | None, str | None, str]:
    """Split ``table``, ``schema.table`` or ``catalog.schema.table``, lowercased."""
    parts = [check_name(part, "table") for part in reference.split(".")]
    if len(parts) > 3:
        raise ValueError(f"a table reference has at most three parts, got {reference!r}")
    catalog, schema, name = [None] * (3 - len(parts)) + parts
    return catalog, schema, name


class EmptyTable(RuntimeError):
    """The table is declared but has never been loaded."""


@dataclass(frozen=True)
class TableRecord:
    """One version of a table. ``version`` 0 is declared and has no data yet.

    ``columns`` is the schema as loaded: read back from folder names alone, a partition
    value such as ``007`` would turn into a number.
    """

    schema: str
    table: str
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sorted_by: tuple[str, ...] = ()
    version: int = 0
    paths: tuple[str, ...] = ()
    row_count: int = 0
    columns: str = ""
    buckets: int = KEY_BUCKETS

    @property
    def folders(self) -> tuple[str, ...]:
        """The partition columns of the stored files, below the load's."""
        return (BUCKET, *self.partition_by) if self.key else self.partition_by


def bucket_of_path(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


@dataclass(frozen=True)
class LoadResult:
    """What a load did: the table it wrote and how many rows that table now holds."""

    schema_name: str
    table_name: str
    row_count: int
    version: int

    @property
    def full_name(self) -> str:
        return f"{OWN_CATALOG}.{self.schema_name}.{self.table_name}"


def laid_out(
    df: DataFrame, partition_by: Sequence[str], sorted_by: Sequence[str]
) -> DataFrame:
    """Arrange rows for writing in a declared layout.

    Partition values are brought together by a rebalance, which splits a value that
    holds too many rows over several tasks. A sorted table is range-partitioned on its
    sort columns with a hash of the row behind them, so rows that share one sort value
    can be split as well.
    """
    if not partition_by and not sorted_by:
        return df
    if not sorted_by or set(partition_by) - {BUCKET}:
        return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sorted_by)
    spreader = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ordered = [*partition_by, *sorted_by]
    return df.repartitionByRange(*ordered, spreader).sortWithinPartitions(*ordered)


class ManagedTable:
    """A table whose contents change only by loads. Readers keep the version they opened."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self.folder = folder

    @property
    def record(self) -> TableRecord:
        versions = records.names(self._spark, f"{self.folder}/versions")
        if not versions:
            raise LookupError(f"no table is declared at {self.folder}")
        return self._version(versions[-1])

    def _version(self, name: str) -> TableRecord:
        found = records.read(self._spark, f"{self.folder}/versions/{name}")
        return TableRecord(
            **{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()}
        )

    def _commit(self, record: TableRecord) -> None:
        path = f"{self.folder}/versions/{record.version:08d}.json"
        records.create(self._spark, path, asdict(record))

    @property
    def full_name(self) -> str:
        record = self.record
        return f"{OWN_CATALOG}.{record.schema}.{record.table}"

    def read(self) -> DataFrame:
        """Return the rows of the current version."""
        return self._open(self.record)

    def _open(self, record: TableRecord) -> DataFrame:
        if not record.version:
            raise EmptyTable(
                f"{record.schema}.{record.table} is declared but has no data; load it first"
            )
        # The load's number is the outermost partition of its folder, so any number of
        # appends is still one scan. The declared schema does not have it.
        return self._rows(record, record.paths)

    def _rows(self, record: TableRecord, paths: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(record.columns))
        if not paths:
            return self._spark.createDataFrame([], schema)
        reader = self._spark.read.schema(schema).option("basePath", f"{self.folder}/data")
        return reader.parquet(*paths).select(*[f"`{name}`" for name in schema.names])

    def changed_since(self, version: int) -> tuple[DataFrame, DataFrame | None] | None:
        """Return the rows added since a version and those that are gone, or ``None``.

        A row whose columns changed is in both. After appends nothing is gone. Only the hash
        buckets that loads have rewritten are compared. ``None`` means that the rows of the two
        versions cannot be told apart: without a key, with other columns, or with maps.
        """
        record = self.record
        name = f"{version:08d}.json"
        if name not in records.names(self._spark, f"{self.folder}/versions"):
            return None
        old = self._version(name)
        if not old.version or old.columns != record.columns:
            return None
        left = [p for p in old.paths if p not in set(record.paths)]
        new = [p for p in record.paths if p not in set(old.paths)]
        if not left:
            return self._rows(record, new), None
        if not record.key:
            return None
        before, after = self._rows(record, left), self._rows(record, new)
        if any("map<" in kind for _, kind in after.dtypes):
            return None
        key = list(record.key)
        whole = lambda df, name: df.select(*key, F.struct(*[f"`{c}`" for c in df.columns]).alias(name))
        pairs = whole(before, "_old").join(whole(after, "_new"), key, "full_outer")
        differs = ~F.col("_old").eqNullSafe(F.col("_new"))
        pairs = written(pairs.filter(differs).select("_old", "_new"), "changes")
        added = pairs.filter(F.col("_new").isNotNull()).select("_new.*")
        return added, pairs.filter(F.col("_old").isNotNull()).select("_old.*")

    def lookup(self, ids: DataFrame | Sequence) -> DataFrame:
        """Return the rows with the given values of the table's one key column.

        Only the hash buckets that the ids fall in are opened. Absent ids are skipped.
        """
        record = self.record
        if len(record.key) != 1:
            raise ValueError(f"a lookup needs a table with one key column, this one has {list(record.key)}")
        (key,) = record.key
        rows = self._open(record)
        if isinstance(ids, DataFrame):
            wanted = ids.select(F.col(f"`{ids.columns[0]}`").cast(rows.schema[key].dataType).alias(key))
        else:
            wanted = self._spark.createDataFrame([(i,) for i in ids], StructType([rows.schema[key]]))
        # At most one number for each bucket reaches the driver.
        hit = {r[0] for r in wanted.select(_bucket(record)).distinct().collect()}
        rows = self._rows(record, [p for p in record.paths if bucket_of_path(p) in hit])
        return get_by_ids(rows, wanted if isinstance(ids, DataFrame) else ids, key=key)

    def load(
        self,
        source: DataFrame | str,
        mode: str = "replace",
        key: Sequence[str] | None = None,
    ) -> LoadResult:
        """Load a frame or a parquet path in one of the five modes.

        The new version is written beside the old one and then recorded in one step. A
        load that loses the race to record its version fails and changes nothing. An
        append writes only its own rows. Upsert, update and delete write the next contents of
        the key's hash buckets that their keys fall in; all other files stay as they are.
        """
        check_mode(mode, key)
        record = self.record
        key = [k.lower() for k in key or []]
        if mode in KEYED_LOAD_MODES:
            if not record.key:
                raise ValueError(
                    f"{record.table} was declared without a key, so mode={mode!r} is refused"
                )
            if sorted(key) != sorted(record.key):
                raise ValueError(f"{record.table} has key {list(record.key)}, got {key}")
        rows = lowered(scan_parquet(self._spark, source) if isinstance(source, str) else source)
        target = self._open(record) if record.version else None
        missing = [k for k in record.key if k not in rows.columns]
        if mode in KEYED_LOAD_MODES:
            if target is not None:
                check_columns(target, rows, mode, key)
            # The keys that are checked have to be those that are stored.
            rows = rows if missing else written(rows, "load")
        if missing and (target is None or mode in ("replace", "delete")):
            raise ValueError(f"upload is missing column {missing[0]!r}")
        if mode in KEYED_LOAD_MODES:
            check_keys(rows, key)
            if target is None and mode != "upsert":
                return LoadResult(record.schema, record.table, 0, 0)
        kept: tuple[str, ...] = ()
        before = 0
        if mode == "append" and target is not None:
            check_columns(target, rows, mode, key)
            rows, kept, before = conform(rows, target), record.paths, record.row_count
        elif mode in KEYED_LOAD_MODES and target is not None:
            stored = conform(rows.select(*key), target.select(*key))
            hit = {r[0] for r in stored.select(_bucket(record)).distinct().collect()}
            touched = [p for p in record.paths if bucket_of_path(p) in hit]
            kept = tuple(p for p in record.paths if bucket_of_path(p) not in hit)
            target = self._rows(record, touched)
            before = record.row_count - target.count()
            rows = apply_load(target, rows, mode, key, checked=True)
        else:
            rows = apply_load(None, rows, mode, key, checked=True)
        version = record.version + 1
        path = f"{self.folder}/data/{LOAD}={version:08d}-{uuid.uuid4().hex}"
        total = before + self._write(rows, record, path)
        columns = record.columns if target is not None and mode != "replace" else rows.schema.json()
        paths = (*kept, *self._written(record, path))
        changes = {"version": version, "paths": paths, "row_count": total, "columns": columns}
        self._commit(replace(record, **changes))
        return LoadResult(record.schema, record.table, total, version)

    def _write(self, rows: DataFrame, record: TableRecord, path: str) -> int:
        if record.key:
            rows = rows.withColumn(BUCKET, _bucket(record))
        # Counted in the writing tasks, after any shuffle, where each row passes once.
        counted = Observation()
        rows = laid_out(rows, record.folders, record.sorted_by)
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        writer = rows.write
        if record.folders:
            writer = writer.partitionBy(*record.folders)
        writer.parquet(path)
        return int(counted.get["rows"])

    def _written(self, record: TableRecord, path: str) -> list[str]:
        """Return what a load wrote: its folder, or for a keyed table those of its buckets."""
        if not record.key:
            return [path]
        return [f"{path}/{name}" for name in records.names(self._spark, path) if "=" in name]


def _bucket(record: TableRecord) -> Column:
    keys = [F.col(f"`{k}`") for k in record.key]
    return F.pmod(F.xxhash64(*keys), F.lit(record.buckets)).cast("int").alias(BUCKET)


class Database:
    """A folder of tables, addressed by its id. Ids are the only address; names are labels."""

    def __init__(self, spark: SparkSession, root: str, database_id: str) -> None:
        self.spark = spark
        self.id = check_name(database_id, "database id")
        self.folder = f"{root.rstrip('/')}/{self.id}"

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        *,
        database_id: str | None = None,
        tables: Sequence[str] = (),
        schema: str = DEFAULT_SCHEMA,
        keys: Mapping[str, Sequence[str]] | None = None,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        sorted_by: Mapping[str, Sequence[str]] | None = None,
        buckets: int = KEY_BUCKETS,
    ) -> Database:
        """Create a database and declare its tables with their keys and layouts.

        Keys and layouts can only be given here and are permanent.
        """
        database = cls(spark, root, database_id or f"db_{uuid.uuid4().hex}")
        options = {"keys": keys, "partition_by": partition_by, "sorted_by": sorted_by}
        for option, given in options.items():
            for table in given or {}:
                if table not in tables:
                    raise ValueError(f"{option} names {table!r}, which is not a declared table")
        for table in tables:
            database.declare(
                table,
                schema=schema,
                key=(keys or {}).get(table, ()),
                partition_by=(partition_by or {}).get(table, ()),
                sorted_by=(sorted_by or {}).get(table, ()),
                buckets=buckets,
            )
        return database

    def declare(
        self,
        table: str,
        *,
        schema: str = DEFAULT_SCHEMA,
        key: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        sorted_by: Sequence[str] = (),
        buckets: int = KEY_BUCKETS,
    ) -> ManagedTable:
        if buckets < 1:
            raise ValueError(f"buckets must be >= 1, got {buckets}")
        record = TableRecord(
            buckets=buckets,
            schema=check_name(schema, "schema"),
            table=check_name(table, "table"),
            key=tuple(k.lower() for k in key),
            partition_by=tuple(c.lower() for c in partition_by),
            sorted_by=tuple(c.lower() for c in sorted_by),
        )
        managed = ManagedTable(self.spark, f"{self.folder}/{record.schema}/{record.table}")
        managed._commit(record)
        return managed

    def schemas(self) -> list[str]:
        return records.names(self.spark, self.folder)

    def tables(self, schema: str = DEFAULT_SCHEMA) -> list[str]:
        """Return the declared tables of a schema, loaded or not."""
        return records.names(self.spark, f"{self.folder}/{schema}")

    def has(self, reference: str) -> bool:
        """Report whether a table is declared; another catalog's table never is."""
        catalog, schema, name = split_table(reference)
        if catalog not in (None, OWN_CATALOG):
            return False
        return name in self.tables(schema or DEFAULT_SCHEMA)

    def table(self, reference: str) -> ManagedTable:
        _, schema, name = split_table(reference)
        if not self.has(reference):
            raise LookupError(f"no table named {reference!r} in database {self.id}")
        return ManagedTable(self.spark, f"{self.folder}/{schema or DEFAULT_SCHEMA}/{name}")

    def load(
        self,
        table: str,
        source: DataFrame | str,
        mode: str = "replace",
        key: Sequence[str] | None = None,
    ) -> LoadResult:
        return self.table(table).load(source, mode, key)

    def namespace(self, schema: str = DEFAULT_SCHEMA) -> str:
        return self.id if schema == DEFAULT_SCHEMA else f"{self.id}_{schema}"

    def publish(self, schema: str = DEFAULT_SCHEMA) -> list[str]:
        """Make the loaded tables queryable as ``<database id>.<table>`` in Spark SQL.

        Each is a view of its current version; call again after loads.
        """
        space = self.namespace(schema)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} LOCATION '{self.folder}/_sql'")
        published = []
        for name in self.tables(schema):
            record = self.table(f"{schema}.{name}").record
            if record.version:
                self._publish_view(f"{space}.{name}", record)
                published.append(f"{space}.{name}")
        return published

    def _publish_view(self, view: str, record: TableRecord) -> None:
        """Register all loads as one external table and the current ones as a view of it.

        The table is declared with the stored types, so partition values keep theirs.
        """
        columns = StructType.fromJson(json.loads(record.columns)).fields
        declared = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in columns)
        declared += f", {LOAD} string" + (f", {BUCKET} int" if record.key else "")
        partitions = ", ".join(f"`{c}`" for c in (LOAD, *record.folders))
        loads = f"{view}__loads"
        data = f"{self.folder}/{record.schema}/{record.table}/data"
        self.spark.sql(f"DROP TABLE IF EXISTS {loads}")
        self.spark.sql(
            f"CREATE TABLE {loads} ({declared}) USING parquet "
            f"PARTITIONED BY ({partitions}) LOCATION '{data}'"
        )
        self.spark.sql(f"ALTER TABLE {loads} RECOVER PARTITIONS")
        current: dict[str, list[int]] = {}
        for path in record.paths:
            load = re.search(f"{LOAD}=([^/]*)", path)[1]
            current.setdefault(load, []).extend([bucket_of_path(path)] if record.key else [])
        parts = [
            f"{LOAD} = '{load}'" + (f" AND {BUCKET} IN ({', '.join(map(str, of))})" if of else "")
            for load, of in current.items()
        ]
        where = " OR ".join(f"({p})" for p in parts) or "false"
        listed = ", ".join(f"`{c.name}`" for c in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS "
            f"SELECT {listed} FROM {loads} WHERE {where}"
        )

    def describe(self, schema: str = DEFAULT_SCHEMA, *, stats: bool = True) -> DataFrame:
        """Return one row for each column of each declared table of a schema.

        ``table_name, state, position, column_name, data_type, row_count, non_null,
        searchable_by``. The columns come from the stored schemas, so they are known whatever
        happens to the files. ``state`` is ``empty`` for a table without a load, which has one
        row without a column, ``unreadable`` for one whose rows can't be counted, else
        ``loaded``. Vector columns that an index made are left out.
        """
        from rankfield.sources.indexes import table_rankings

        found: list[tuple] = []
        for name in self.tables(schema):
            table = self.table(f"{schema}.{name}")
            record = table.record
            if not record.version:
                found.append((name, "empty", None, None, None, 0, None, []))
                continue
            rankings = table_rankings(table)
            counts, state = {}, "loaded"
            if stats:
                try:
                    counts = stored_counts(self.spark, {name: table.read()})[name]
                except _UNREADABLE:  # one table that can't be read leaves the others described
                    state = "unreadable"
            fields = StructType.fromJson(json.loads(record.columns)).fields
            for position, field in enumerate(fields, start=1):
                if field.name not in rankings.made_columns:
                    found.append(
                        (
                            name, state, position, field.name, field.dataType.simpleString(),
                            counts.get(None), counts.get(field.name),
                            rankings.uses(field.name),
                        )
                    )
        columns = (
            "table_name string, state string, position bigint, column_name string, data_type string, "
            "row_count bigint, non_null bigint, searchable_by array<string>"
        )
        return self.spark.createDataFrame(found, columns)

    def overview(self, schema: str = DEFAULT_SCHEMA) -> DataFrame:
        """Return every loaded table with its number of columns, by name."""
        columns = self.describe(schema, stats=False).filter("state != 'empty'")
        return table_overview(columns)
