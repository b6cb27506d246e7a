"""What the operators share: reading tables, the empty text, and running counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfield.session import written

#: Rows of an output batch that one task holds before it hands them on.
BATCH_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a given table by path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """Return the text, null as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """Return ``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """Return a column name as Spark reads it whole, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Gather rows into record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return starts and ends (exclusive) of the maximal runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def with_row_id(df: DataFrame, key: str, text: str) -> tuple[DataFrame, str, bool]:
    """Return ``df`` with a column of unique ids that sort as the key does, the column's name,
    and whether the ids are the keys.

    That is the key itself where keys are whole numbers, present and unique. Otherwise rows are
    numbered in the order of key (null last) and text; rows equal in both share a number, so
    they are one document and get the same result.
    """
    name = free_name(df, "_row_id")
    keyed = F.col(quoted(key)).cast("bigint")
    odd = (
        df.select(keyed.alias("k"))
        .groupBy("k")
        .agg(F.count("*").alias("n"))
        .filter((F.col("n") > 1) | F.col("k").isNull())
    )
    if odd.isEmpty():
        return df.withColumn(name, keyed), name, True
    hashed = F.xxhash64(text_or_empty(quoted(text)))
    ranked = df.select(keyed.alias("k"), hashed.alias("h")).distinct()
    ranked = ranked.orderBy(F.col("k").asc_nulls_last(), "h")
    numbered = written(ranked.withColumn("n", F.monotonically_increasing_id()), "row-ids")
    names = [free_name(df, f"_row_{c}") for c in ("k", "h", "key", "hash")]
    ids = numbered.toDF(names[0], names[1], name)
    marked = df.withColumns({names[2]: keyed, names[3]: hashed})
    match = F.col(names[2]).eqNullSafe(F.col(names[0])) & (F.col(names[3]) == F.col(names[1]))
    return marked.join(ids, match).drop(*names), name, False
