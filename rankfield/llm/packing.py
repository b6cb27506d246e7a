"""Best-fit packing by hierarchical residuals.

Every partition packs its own pieces best-fit, longest first, and hands on the sequences that
are nearly full. The others become items of the next round, in which fewer partitions pack
what several left over, up to one partition with a bounded number of items. A sequence holds
at most ``capacity`` pieces, so a row stays small however often it is merged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfield.llm import bpe
from rankfield.llm.common import BATCH_ROWS, batches, quoted
from rankfield.session import written

CAPACITY = 2048

#: Items that one task packs at a time; a larger partition is packed in parts.
ROUND_ITEMS = 200_000

#: A sequence with no more free tokens than this is handed on and not packed further.
SLACK = 4

#: A round that leaves more than this share of its items unmerged is the last.
STALL = 0.995


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Put each item into the fullest bin that still has room, longest items first.

    Returns the bin of each item and the number of bins. The free sizes that occur are bits
    of one integer, so the tightest fit is its lowest bit at or above the item's length.
    """
    bin_of = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    sizes = count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = sizes >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            chosen = open_bins[free].pop()
            if not open_bins[free]:
                sizes ^= 1 << free
        else:
            free, chosen, count = capacity, count, count + 1
        bin_of[i] = chosen
        if free > need:
            if not open_bins[free - need]:
                sizes |= 1 << (free - need)
            open_bins[free - need].append(chosen)
    return bin_of, count


def _merged(table: pa.Table, capacity: int) -> pa.Table:
    """Pack the rows (fill, members) of one part; offsets of members move with their bin."""
    fill = table["fill"].to_numpy()
    bin_of, count = best_fit(fill, capacity)
    order = np.argsort(bin_of, kind="stable")
    fills = np.bincount(bin_of, weights=fill, minlength=count).astype(np.int32)
    sorted_fill, sorted_bin = fill[order].astype(np.int64), bin_of[order]
    before = np.cumsum(sorted_fill) - sorted_fill
    first = np.searchsorted(sorted_bin, np.arange(count))
    base = before - before[first][sorted_bin]

    members = table["members"].combine_chunks().take(pa.array(order))
    sizes = np.diff(members.offsets.to_numpy())
    flat = members.flatten()
    offset = flat.field("offset").to_numpy() + np.repeat(base, sizes)
    names = [f.name for f in flat.type]
    values = pa.StructArray.from_arrays(
        [pa.array(offset, pa.int64()) if n == "offset" else flat.field(n) for n in names],
        fields=list(flat.type),
    )
    per_bin = np.bincount(sorted_bin, weights=sizes, minlength=count).astype(np.int32)
    ends = np.concatenate(([0], np.cumsum(per_bin))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), values, type=members.type)
    return pa.table({"fill": pa.array(fills), "members": lists})


def _round(capacity: int, part_items: int):
    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in source:
            held.append(batch)
            rows += batch.num_rows
            if rows >= part_items:
                yield from _merged(pa.Table.from_batches(held), capacity).to_batches(BATCH_ROWS)
                held, rows = [], 0
        if rows:
            yield from _merged(pa.Table.from_batches(held), capacity).to_batches(BATCH_ROWS)

    return pack


def pack(
    items: DataFrame,
    *,
    length: str = "length",
    capacity: int = CAPACITY,
    slack: int = SLACK,
    round_items: int = ROUND_ITEMS,
) -> DataFrame:
    """Place every row of ``items`` in a sequence of at most ``capacity`` tokens.

    Returns all columns with ``sequence_id`` (any distinct numbers) and ``offset`` (gapless
    from 0 within a sequence). A length of null counts as 0; rows of length 0 share
    sequences like others; a negative length or one above ``capacity`` is an error. Repeated
    rows are placed each for itself. Columns named ``sequence_id`` or ``offset`` are replaced.
    Ties between lengths are settled by row order within a partition.
    """
    names = [c for c in items.columns if c.lower() not in ("sequence_id", "offset")]
    size = F.coalesce(F.col(quoted(length)).cast("int"), F.lit(0))
    checked = F.when((size >= 0) & (size <= capacity), size).otherwise(
        F.raise_error(F.lit(f"a length is below 0 or above {capacity}")).cast("int")
    )
    member = F.struct(
        F.lit(0).cast("bigint").alias("offset"),
        F.struct(*[F.col(quoted(c)) for c in names]).alias("row"),
    )
    bins = items.select(checked.alias("fill"), F.array(member).alias("members"))
    full = (F.col("fill") >= capacity - slack) | F.col("last")
    done: list[DataFrame] = []
    before, parts = None, None
    while True:
        last = parts == 1
        if parts:
            bins = bins.repartition(parts)
        bins = written(
            bins.mapInArrow(_round(capacity, round_items), bins.schema).withColumn("last", F.lit(last)),
            "packed",
        )
        done.append(bins.filter(full))
        left = bins.filter(~full).drop("last")
        rows = 0 if last else left.count()
        if rows == 0:
            break
        if before is not None and rows > STALL * before:
            done.append(bins.filter(~full))
            break
        before, parts, bins = rows, -(-rows // round_items), left
    packed = done[0]
    for frame in done[1:]:
        packed = packed.unionByName(frame)
    return (
        packed.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
        .select("sequence_id", F.inline("members"))
        .select("row.*", "sequence_id", "offset")
    )


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def _cut(vocabulary: str | None, capacity: int, end_id: int, keep_ids: bool):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words = bpe.load(vocabulary)
        for batch in source:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.ids(text.as_py() or "")
                ids.append(end_id)
                raw = np.array(ids, "<u4")
                first = len(ids) % capacity or capacity
                start = piece = 0
                while start < len(ids):
                    stop = start + capacity if piece else min(first, len(ids))
                    part = raw[start:stop]
                    kept = part.astype(np.int32) if keep_ids else None
                    yield doc_id, piece, start, stop - start, zlib.crc32(part.tobytes()), kept
                    start, piece = stop, piece + 1

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(rows(source), _PIECES, 512 if keep_ids else BATCH_ROWS)

    return cut


def token_pieces(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    vocabulary: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Cut every document's ids, then ``end_id``, into pieces of ``capacity`` tokens.

    Only a document longer than ``capacity`` is cut; its first piece takes the remainder, the
    others are whole. A null text is an empty one, which is the end id alone; a null key stays
    null; repeated rows are each cut. ``keep_ids`` carries the ids themselves.
    """
    chosen = documents.select(F.col(quoted(key)).cast("bigint"), F.col(quoted(text)))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
    pieces = chosen.mapInArrow(_cut(vocabulary, capacity, end_id, keep_ids), schema)
    return pieces if keep_ids else pieces.drop("ids")


def pack_documents(documents: DataFrame, **options) -> DataFrame:
    """Tokenize, cut and pack documents; options as for ``token_pieces``.

    The pieces are written first, so no text is encoded twice and a lost executor repeats
    only its own partitions. An empty table gives an empty result.
    """
    capacity = options.get("capacity", CAPACITY)
    return pack(written(token_pieces(documents, **options), "pieces"), capacity=capacity)
