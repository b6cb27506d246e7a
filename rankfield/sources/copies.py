"""Copies of a managed table in a second order, for filters on another column."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from rankfield.sources import records
from rankfield.sources.database import ManagedTable, laid_out


def create_sorted_copy(
    table: ManagedTable, sorted_by: Sequence[str], *, columns: Sequence[str] | None = None
) -> str:
    """Write the table's current rows sorted by other columns and return the copy's folder.

    ``columns`` are those the copy holds, all unless given; the sort columns are always among
    them. Rows are range-partitioned by the sort columns, with a hash of the row behind them, so
    that a value that many rows share is several files. Nulls come first. Repeated rows stay.
    """
    sorted_by = [c.lower() for c in sorted_by]
    if not sorted_by:
        raise ValueError("sorted_by must name at least one column")
    rows = table.read()
    wanted = list(dict.fromkeys([*sorted_by, *(c.lower() for c in columns or rows.columns)]))
    missing = [c for c in wanted if c not in rows.columns]
    if missing:
        raise ValueError(f"no column named {missing[0]!r}")
    # In the table's order of columns.
    rows = rows.select(*[f"`{c}`" for c in rows.columns if c in wanted])
    version = table.record.version
    name = f"{version:08d}-{uuid.uuid4().hex}"
    folder = f"{table.folder}/copies_data/{name}"
    laid_out(rows, [], sorted_by).write.parquet(folder)
    made = {"version": version, "sorted_by": sorted_by, "columns": rows.schema.json(), "folder": folder}
    records.create(table._spark, f"{table.folder}/copies/{name}.json", made)
    return folder


def read_sorted_copy(
    table: ManagedTable, column: str, *, columns: Sequence[str] | None = None
) -> DataFrame:
    """Return the table's rows from the copy whose first sort column is ``column``.

    A filter on that column opens only the row groups that can match. ``columns`` are those the
    caller needs; a copy without them is passed over, and of several the narrowest is read.
    A copy made before the table's last load is never read: without a current one this raises
    ``LookupError``, and the caller makes a copy anew or reads the table.
    """
    version, folder = table.record.version, f"{table.folder}/copies"
    found = []
    # The names start with the version, so others' records are not opened.
    for name in records.names(table._spark, folder):
        if name.startswith(f"{version:08d}-"):
            made = records.read(table._spark, f"{folder}/{name}")
            schema = StructType.fromJson(json.loads(made["columns"]))
            if made["sorted_by"][0] == column.lower() and {c.lower() for c in columns or []} <= set(schema.names):
                found.append((len(schema), name, schema, made["folder"]))
    if not found:
        raise LookupError(f"{table.full_name} has no current copy sorted by {column!r}")
    _, _, schema, path = min(found, key=lambda f: f[:2])
    return table._spark.read.schema(schema).parquet(path)
