"""Row and value counts from the footers of parquet files, read in tasks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from rankfield.operators.profile import column_stats

#: Files whose footers one task reads.
TASK_FILES = 64

_COUNTS = "table_name string, column_name string, row_count bigint, non_null bigint"


def _opens(file: str) -> bool:
    """Whether Arrow knows the file's store; some only Spark's own readers can open."""
    try:
        fs.FileSystem.from_uri(file)
    except (pa.ArrowException, OSError):
        return False
    return True


def _nulls(footer, name: str) -> int | None:
    """Return a column's nulls in one file, or ``None`` where the footer does not say."""
    total = 0
    for group in range(footer.num_row_groups):
        part = footer.row_group(group)
        at = [i for i in range(part.num_columns) if part.column(i).path_in_schema == name]
        if len(at) != 1:
            return None
        found = part.column(at[0])
        if not found.is_stats_set or not found.statistics.has_null_count:
            return None
        total += found.statistics.null_count
    return total


def _read(columns: Mapping[str, Sequence[str]]):
    """A row for each file and column, and one without a column for the file's rows."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for table, file in zip(part["table_name"], part["file"]):
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    footer = pq.read_metadata(source)
                found.append((table, None, footer.num_rows, None))
                for name in columns[table]:
                    nulls = _nulls(footer, name)
                    held = None if nulls is None else footer.num_rows - nulls
                    found.append((table, name, footer.num_rows, held))
            names = ["table_name", "column_name", "row_count", "non_null"]
            rows = pd.DataFrame(found, columns=names)
            yield rows.astype({"row_count": "Int64", "non_null": "Int64"})

    return read


def footer_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame]
) -> dict[str, dict[str, int | None]]:
    """Return for each table its ``row_count`` under ``None`` and each column's filled rows.

    Each frame has to be a plain scan of parquet files. Only footers are read, a few files a
    task, and their sums reach the driver: one number for each column. A column that some
    footer does not count (no statistics, nested, or not in the file) is ``None``.
    """
    nested = (ArrayType, MapType, StructType, VariantType)
    columns = {
        name: [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
        for name, df in tables.items()
    }
    found: dict[str, dict[str, int | None]] = {}
    files = []
    for name, df in tables.items():
        inputs = df.inputFiles()
        found[name] = dict.fromkeys([None, *df.columns], None if inputs else 0)
        if inputs and _opens(inputs[0]):
            files += [(name, file) for file in inputs]
    if not files:
        return found
    listed = spark.createDataFrame(files, "table_name string, file string")
    listed = listed.repartition(-(-len(files) // TASK_FILES), "file")
    sums = (
        listed.mapInPandas(_read(columns), _COUNTS)
        .groupBy("table_name", "column_name")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("non_null").alias("non_null"),
            F.count_if(F.col("non_null").isNull()).alias("unknown"),
        )
    )
    for r in sums.collect():
        if r["column_name"] is None:
            found[r["table_name"]][None] = r["row_count"]
        elif not r["unknown"]:
            found[r["table_name"]][r["column_name"]] = r["non_null"]
    return found


def stored_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame]
) -> dict[str, dict[str, int]]:
    """Return the counts of ``footer_counts``, scanning the columns no footer counts."""
    found = footer_counts(spark, tables)
    for name, df in tables.items():
        unknown = [c for c in df.columns if found[name][c] is None]
        if unknown or found[name][None] is None:
            held = column_stats(df.select(*[f"`{c}`" for c in unknown])).first()
            found[name].update({c: held[f"{c}_non_null"] for c in unknown})
            found[name][None] = held["row_count"]
    return found


def stored_profile(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profile parquet tables: one row per column, with counts from the files' footers.

    ``table_name, position, column_name, data_type, row_count, non_null``, as ``table_profile``
    gives by a scan, which frames other than plain scans of files need.
    """
    counts = stored_counts(spark, tables)
    rows = [
        (
            name, position, f.name, f.dataType.simpleString(),
            counts[name][None], counts[name][f.name],
        )
        for name, df in tables.items()
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, position bigint, column_name string, data_type string, "
        "row_count bigint, non_null bigint",
    )
