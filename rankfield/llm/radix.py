"""Distributed LSD radix sort: the final rank of every row, by stable counting sorts.

Each pass sorts by one digit of the composite key. Rows lie in parts of bounded size. Every part
counts its digits; prefix sums over (digit, part) say where the rows of a digit in a part go;
the parts then place their rows, in the order they have, at those positions. No task holds more
than one part, whatever the digits are, and the driver sees the totals of one digit's values.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfield.session import written

#: Bits of a digit; a pass collects at most 2^DIGIT totals.
DIGIT = 12

#: Rows of a part, and parts for each shuffle partition where rows are few.
PART_ROWS = 1 << 20
PARTS = 4


class Digit(NamedTuple):
    """Some bits of a column, counted from its least value (or back from its largest)."""

    column: str
    origin: int
    descending: bool
    shift: int
    width: int

    def of(self, values: np.ndarray) -> np.ndarray:
        bits = values.view(np.uint64)
        origin = np.uint64(self.origin % (1 << 64))
        away = origin - bits if self.descending else bits - origin
        return ((away >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)).astype(np.int32)


def digits_of(column: str, low: int, high: int, descending: bool) -> list[Digit]:
    """Return the digits of a column with values from ``low`` to ``high``, the lowest first."""
    bits = (high - low).bit_length()
    passes = -(-bits // DIGIT)
    if not passes:
        return []
    width = -(-bits // passes)
    origin = high if descending else low
    return [Digit(column, origin, descending, width * i, width) for i in range(passes)]


def _counts(digit: Digit):
    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            part = batch.column(0).to_numpy().astype(np.int64)
            code = part << digit.width | digit.of(batch.column(1).to_numpy())
            found, n = np.unique(code, return_counts=True)
            part, value = found >> digit.width, found & ((1 << digit.width) - 1)
            columns = [pa.array(part), pa.array(value.astype(np.int32)), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "digit", "n"])

    return count


def _place(digit: Digit, block: int, names: Sequence[str]):
    def place(rows: pa.Table, offsets: pa.Table) -> pa.Table:
        """Counting sort of one part: its rows keep their order within a digit."""
        rows = rows.take(pa.array(np.argsort(rows["pos"].to_numpy(), kind="stable")))
        value = digit.of(np.ascontiguousarray(rows[digit.column].to_numpy()))
        start = np.zeros(1 << digit.width, np.int64)
        start[offsets["digit"].to_numpy()] = offsets["start"].to_numpy()
        order = np.argsort(value, kind="stable")
        sorted_value = value[order]
        first = np.searchsorted(sorted_value, sorted_value, side="left")
        to = np.empty(len(order), np.int64)
        to[order] = start[sorted_value] + np.arange(len(order)) - first
        columns = [pa.array(to // block), pa.array(to), *[rows[c] for c in names]]
        return pa.table(columns, names=["part", "pos", *names])

    return place


def sorted_ranks(rows: DataFrame, by: Sequence[tuple[str, bool]]) -> DataFrame:
    """Return ``rows`` with ``rank``, from 1, in the order of whole-number columns.

    ``by`` has (column, descending), the most significant first; nulls are not allowed. All
    columns of ``rows`` have to be bigint. Rows equal in all of ``by`` get adjacent ranks, in
    no particular order. An empty table gives an empty one.
    """
    names = rows.columns
    placed = rows.select(F.spark_partition_id().cast("bigint").alias("part"), F.monotonically_increasing_id().alias("pos"), *names)
    placed = written(placed, "radix")
    ends = itertools.chain.from_iterable((F.min(c), F.max(c)) for c, _ in by)
    total, *ends = placed.agg(F.count("*"), *ends).first()
    if not total:
        return placed.select(*names, F.lit(0).cast("bigint").alias("rank"))
    spark = rows.sparkSession
    parts = max(PARTS * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_ROWS))
    block = -(-total // parts)
    passes = [digits_of(c, ends[2 * i], ends[2 * i + 1], d) for i, (c, d) in enumerate(by)]
    passes = list(itertools.chain.from_iterable(reversed(passes)))
    if not passes:  # all rows are equal: any digit numbers them
        passes = [Digit(by[0][0], ends[0], False, 0, 1)]
    schema = "part bigint, pos bigint, " + ", ".join(f"`{c}` bigint" for c in names)
    for digit in passes:
        counted = placed.select("part", digit.column).mapInArrow(_counts(digit), "part bigint, digit int, n bigint")
        counted = written(counted.groupBy("part", "digit").agg(F.sum("n").alias("n")), "radix-counts")
        totals = dict(counted.groupBy("digit").agg(F.sum("n")).collect())
        values = sorted(totals)
        begins = itertools.accumulate((totals[v] for v in values), initial=0)
        begin = spark.createDataFrame([*zip(values, begins)], "digit int, begin bigint")
        before = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .join(F.broadcast(begin), "digit")
            .select("part", "digit", (F.col("begin") + F.col("before")).alias("start"))
        )
        pairs = placed.groupBy("part").cogroup(offsets.groupBy("part"))
        placed = written(pairs.applyInArrow(_place(digit, block, names), schema), "radix")
    return placed.select(*names, (F.col("pos") + 1).alias("rank"))
