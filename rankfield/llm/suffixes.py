"""Exact removal of repeated byte strings by a distributed, sampled suffix array.

A window is ``length`` bytes. In every window the ``seed``-byte string with the least hash is
its anchor, so equal windows have equal anchors at equal offsets, and about one suffix in
thirty has to be looked at instead of all. An anchor stands for a run of windows that share it.

1. Anchors whose whole run of windows repeats an earlier anchor's are decided by hash: first
   among the rows of a task, then among all rows with that seed. Seeds that occur once drop out.
2. What is left, mostly the edges of repeats, gets its bytes back. These suffixes are
   range-partitioned by their leading bytes with sampled splitters; each bucket sorts them by
   multikey quicksort, to the right of the anchor and to the left of it. Windows are equal
   exactly where no neighbour in between shares too few bytes, on both sides.
3. The first and last seed of a bucket may go on in the next one; their windows, one of each
   kind and bucket, are compared across buckets by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.llm import hashing
from rankfield.llm.common import BATCH_ROWS, batches, quoted, runs, text_or_empty, with_row_id
from rankfield.session import written

LENGTH = 100
SEED = 32

#: Bytes of text whose anchors one task compares at a time.
CHUNK_BYTES = 32 << 20

#: Different runs, two at least, that one chunk sends on for one seed; more are known repeats.
SEED_RUNS = 64

#: Bytes of anchored text that a bucket is planned to hold.
BUCKET_BYTES = 8 << 20

MARK, ANCHOR, SUSPECT = 0, 1, 2

_ROWS = pa.schema(
    [
        ("tag", pa.int8()),
        ("route", pa.int64()),
        ("run", pa.int64()),
        ("id", pa.int64()),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("anchor", pa.int32()),
    ]
)
_ROWS_DDL = "tag tinyint, route bigint, run bigint, id bigint, first int, last int, anchor int"


def anchors(data: np.ndarray, length: int, seed: int):
    """Return for each anchor of a text: first and last window, place, seed hash, run hash."""
    hashes = hashing.sliding_hashes(data, seed)
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (hashing.sliding_min(ranked, length - seed + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    place = at[first]
    sums = hashing.prefix_sums(data, hashing.BASES[1])
    run = hashing.range_hashes(sums, first, last + length, hashing.BASES[1])
    # Two anchors with the same bytes around them differ still if their offsets do.
    run = hashing.mixed(run + (place - first).astype(np.uint64))
    return first, last, place, hashes[place].view(np.int64), run.view(np.int64)


def _joined(ids: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Join runs of windows of one text that follow on each other."""
    order = np.lexsort((first, ids))
    ids, first, last = ids[order], first[order], last[order]
    starts = np.ones(len(ids), bool)
    starts[1:] = (ids[1:] != ids[:-1]) | (first[1:] > last[:-1] + 1)
    at = np.flatnonzero(starts)
    return ids[at], first[at], np.maximum.reduceat(last, at) if len(at) else last


def _rows(tag: int, route, run, ids, first, last, anchor) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, tag, np.int8)),
            pa.array(route, pa.int64()),
            pa.array(run, pa.int64()),
            pa.array(ids, pa.int64()),
            pa.array(first.astype(np.int32)),
            pa.array(last.astype(np.int32)),
            pa.array(anchor.astype(np.int32)),
        ],
        schema=_ROWS,
    )


def _marks(ids, first, last) -> Iterator[pa.RecordBatch]:
    if len(ids):
        ids, first, last = _joined(ids, first, last)
        route = hashing.mixed(ids.astype(np.uint64) + first.astype(np.uint64)).view(np.int64)
        yield _rows(MARK, route, np.zeros(len(ids), np.int64), ids, first, last, first)


def _decide(found: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Compare the anchors of one chunk; hand on one of each run."""
    ids, first, last, place, seed, run = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((first, ids, run, seed))
    ids, first, last, place, seed, run = (c[order] for c in (ids, first, last, place, seed, run))
    new_seed = np.ones(len(ids), bool)
    new_seed[1:] = seed[1:] != seed[:-1]
    new_run = new_seed.copy()
    new_run[1:] |= run[1:] != run[:-1]
    yield from _marks(*(c[~new_run] for c in (ids, first, last)))
    ids, first, last, place, seed, run, new_seed = (
        c[new_run] for c in (ids, first, last, place, seed, run, new_seed)
    )
    starts = np.flatnonzero(new_seed)
    nth = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    for tag, part in ((ANCHOR, nth < SEED_RUNS), (SUSPECT, nth >= SEED_RUNS)):
        if part.any():
            route = seed[part] if tag == ANCHOR else hashing.mixed(run[part].view(np.uint64)).view(np.int64)
            yield _rows(tag, route, run[part], ids[part], first[part], last[part], place[part])


def _scan(length: int, seed: int):
    def scan(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        held = 0
        for batch in source:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                if len(data) < length:
                    continue
                first, last, place, seeds, run = anchors(data, length, seed)
                found.append((np.full(len(first), key), first, last, place, seeds, run))
                held += len(data)
                if held >= CHUNK_BYTES:
                    yield from _decide(found)
                    found, held = [], 0
        if found:
            yield from _decide(found)

    return scan


def _settle(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Go through rows sorted by seed, run and place; the first of a run decides the others.

    Anchors whose seed has one run only are dropped; the others become suspects. Between two
    batches only the last row and a first run that still waits for a second are kept.
    """
    before, waiting = None, None
    for batch in source:
        tag = batch.column("tag").to_numpy()
        for other in (MARK, SUSPECT):
            if (tag == other).any():
                yield batch.filter(pa.array(tag == other))
        rows = batch.filter(pa.array(tag == ANCHOR))
        if not rows.num_rows:
            continue
        seed, run = rows.column("route").to_numpy(), rows.column("run").to_numpy()
        new_seed = np.ones(len(seed), bool)
        new_seed[1:] = seed[1:] != seed[:-1]
        new_run = new_seed.copy()
        new_run[1:] |= run[1:] != run[:-1]
        if before is not None:
            new_seed[0] = before[0] != seed[0]
            new_run[0] = new_seed[0] or before[1] != run[0]
        before = (seed[-1], run[-1])
        columns = [rows.column(c).to_numpy() for c in ("route", "run", "id", "first", "last", "anchor")]
        yield from _marks(*(columns[i][~new_run] for i in (2, 3, 4)))
        columns = [c[new_run] for c in columns]
        opens = new_seed[new_run]
        if not len(opens):
            continue
        if waiting is not None and not opens[0]:
            yield _rows(SUSPECT, *waiting)
        waiting = None
        followed = np.append(~opens[1:], False)
        keep = ~opens | followed
        if keep.any():
            yield _rows(SUSPECT, *(c[keep] for c in columns))
        if opens[-1]:
            waiting = [c[-1:] for c in columns]


_PLACED = pa.schema(
    [
        ("lead", pa.binary()),
        ("id", pa.int64()),
        ("first", pa.int32()),
        ("anchor", pa.int32()),
        ("bytes", pa.binary()),
    ]
)
_PLACED_DDL = "lead binary, id bigint, first int, anchor int, bytes binary"


def _slices(length: int, seed: int):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in source:
            for key, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                for p in places.as_py():
                    at = p["anchor"]
                    yield data[at : at + seed], key, p["first"], at, data[p["first"] : p["last"] + length]

    def slices(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(rows(source), _PLACED)

    return slices


def multikey_quicksort(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of bytes; return their order and, for each but the first, what it shares.

    A symbol is eight bytes. Rows are sorted by their first symbol; those still tied are
    sorted by the next one, and so on, so distinct strings leave early. The second result is
    the number of leading bytes that a row has in common with the row before it.
    """
    count, width = strings.shape
    padded = np.zeros((count, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    symbols = padded.view(">u8").astype(np.uint64)
    order = np.arange(count)
    group = np.zeros(count, np.int64)
    tied = np.arange(count)
    for column in range(symbols.shape[1]):
        value = symbols[order[tied], column]
        by = np.lexsort((value, group[tied]))
        order[tied] = order[tied][by]
        value, old = value[by], group[tied]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (old[1:] != old[:-1]) | (value[1:] != value[:-1])
        starts = np.flatnonzero(fresh)
        # A group is named by the position of its first row, so names stay in order.
        group[tied] = np.repeat(tied[starts], np.diff(np.append(starts, len(tied))))
        size = np.diff(np.append(starts, len(tied)))
        tied = tied[np.repeat(size > 1, size)]
        if not len(tied):
            break
    ordered = strings[order]
    differs = ordered[1:] != ordered[:-1]
    shared = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    return order, np.concatenate(([0], shared)) if count else np.zeros(0, np.int64)


def _classes(order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Number the rows so that those with ``least`` leading bytes in common have one number."""
    new = shared < least
    if len(new):
        new[0] = True
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


_FOUND = pa.schema(
    [
        ("id", pa.int64()),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("target", pa.int32()),
        ("h1", pa.list_(pa.int64())),
        ("h2", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int64())),
        ("places", pa.list_(pa.int32())),
    ]
)
_FOUND_DDL = (
    "id bigint, first int, last int, target int, h1 array<bigint>, h2 array<bigint>, "
    "ids array<bigint>, places array<int>"
)


def _packed(edges: list[tuple[np.ndarray, ...]], targets: int) -> Iterator[pa.RecordBatch]:
    """Send windows to their targets, those of one bucket and target as one row of lists."""
    h1, h2, ids, places = (np.concatenate(c) for c in zip(*edges))
    target = (h1.view(np.uint64) % np.uint64(targets)).astype(np.int32)
    order = np.argsort(target, kind="stable")
    target = target[order]
    starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
    offsets = pa.array(np.append(starts, len(target)).astype(np.int32))
    lists = [
        pa.ListArray.from_arrays(offsets, pa.array(c[order].astype(t)))
        for c, t in ((h1, np.int64), (h2, np.int64), (ids, np.int64), (places, np.int32))
    ]
    none = [pa.nulls(len(starts), _FOUND.field(c).type) for c in ("id", "first", "last")]
    yield pa.RecordBatch.from_arrays([*none, pa.array(target[starts]), *lists], schema=_FOUND)


def _across(table: pa.Table) -> pa.Table:
    """Compare the windows of one target; return those that an earlier place has too."""
    h1, h2, ids, places = (
        table[c].combine_chunks().flatten().to_numpy() for c in ("h1", "h2", "ids", "places")
    )
    order = np.lexsort((places, ids, h2, h1))
    h1, h2, ids, places = (c[order] for c in (h1, h2, ids, places))
    again = np.zeros(len(ids), bool)
    again[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    ids, first, last = _joined(ids[again], places[again], places[again])
    return pa.table({"id": ids, "first": first.astype(np.int32), "last": last.astype(np.int32)})


def _bucket(length: int, seed: int, targets: int):
    span = length - seed
    steps = [hashing.powers(base, length) for base in hashing.BASES]

    def windows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in source if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        ids, first, place = (table[c].to_numpy() for c in ("id", "first", "anchor"))
        order = np.lexsort((place, ids))
        ids, first, place = (c[order].astype(np.int64) for c in (ids, first, place))
        texts = [x for x in table["bytes"].take(pa.array(order)).to_pylist()]
        leads = table["lead"].take(pa.array(order)).to_pylist()
        edge = {min(leads), max(leads)}
        edged = np.array([x in edge for x in leads])

        back = place - first
        ahead = np.array([len(x) for x in texts]) - back
        right = np.zeros((len(ids), length), np.uint8)
        left = np.zeros((len(ids), span + 1), np.uint8)
        for i, x in enumerate(texts):
            data = np.frombuffer(x, np.uint8)
            tail = data[back[i] : back[i] + length]
            right[i, : len(tail)] = tail
            left[i, : back[i]] = data[: back[i]][::-1]
        right_order, right_shared = multikey_quicksort(right)
        left_order, left_shared = multikey_quicksort(left)

        marked: list[tuple[np.ndarray, np.ndarray]] = []
        edges: list[tuple[np.ndarray, ...]] = []
        for offset in range(span + 1):
            has = np.flatnonzero((back >= offset) & (ahead >= length - offset))
            if not len(has):
                continue
            same = _classes(right_order, right_shared, length - offset)[has] * (len(ids) + 1)
            same += _classes(left_order, left_shared, offset)[has]
            by = np.argsort(same, kind="stable")  # rows are in order of place already
            opens = np.ones(len(by), bool)
            opens[1:] = same[by][1:] != same[by][:-1]
            again = has[by[~opens]]
            marked.append((ids[again], place[again] - offset))
            shown = has[by[opens]]
            shown = shown[edged[shown]]
            for at in range(0, len(shown), BATCH_ROWS):
                part = shown[at : at + BATCH_ROWS]
                string = np.hstack([left[part, :offset][:, ::-1], right[part, : length - offset]])
                values = hashing.byte_table()[string]
                h1, h2 = (hashing.mixed((values * s).sum(axis=1, dtype=np.uint64)).view(np.int64) for s in steps)
                edges.append((h1, h2, ids[part], place[part] - offset))
        if edges:
            yield from _packed(edges, targets)
        at_ids = np.concatenate([m[0] for m in marked]) if marked else np.zeros(0, np.int64)
        if len(at_ids):
            starts = np.concatenate([m[1] for m in marked])
            out_ids, begin, end = _joined(at_ids, starts, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_ids, pa.int64()),
                    pa.array(begin.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    *[pa.nulls(len(out_ids), f.type) for f in list(_FOUND)[3:]],
                ],
                schema=_FOUND,
            )

    return windows


def repeated_windows(
    documents: DataFrame, row_id: str, text: str, *, length: int = LENGTH, seed: int | None = None
) -> DataFrame:
    """Return runs of windows (id, first, last) that all start earlier as well.

    ``first`` and ``last`` are byte positions of windows of ``length`` bytes; earlier is a
    smaller id, or the same id and a smaller position. Runs may overlap.
    """
    seed = seed or max(1, min(SEED, length // 3))
    spark = documents.sparkSession
    texts = documents.select(F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"))
    texts = texts.filter(F.octet_length("text") >= length)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (
        texts.mapInArrow(_scan(length, seed), _ROWS_DDL)
        .repartition(parts, "route")
        .sortWithinPartitions("route", "run", "id", "first")
    )
    settled = written(
        sorted_rows.mapInArrow(_settle, _ROWS_DDL).select("tag", "id", "first", "last", "anchor"), "anchors"
    )
    suspects = settled.filter(F.col("tag") == SUSPECT)
    places = suspects.groupBy(F.col("id").alias("place_id")).agg(
        F.collect_list(F.struct("first", "last", "anchor")).alias("places")
    )
    placed = written(
        texts.join(places, F.col("id") == F.col("place_id"))
        .select("id", "text", "places")
        .mapInArrow(_slices(length, seed), _PLACED_DDL),
        "suffixes",
    )
    size = placed.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(int(size // BUCKET_BYTES) + 1, 1)
    found = written(
        placed.repartitionByRange(buckets, "lead", F.xxhash64("id", "anchor")).mapInArrow(
            _bucket(length, seed, buckets), _FOUND_DDL
        ),
        "windows",
    )
    marks = settled.filter(F.col("tag") == MARK).select("id", "first", "last")
    inner = found.filter(F.col("target").isNull()).select("id", "first", "last")
    across = (
        found.filter(F.col("target").isNotNull())
        .groupBy("target")
        .applyInArrow(_across, "id bigint, first int, last int")
    )
    return marks.unionByName(inner).unionByName(across)


def remove_spans(data: bytes, first: np.ndarray, last: np.ndarray, length: int):
    """Return starts and ends of the bytes that the runs of windows cover."""
    edges = np.zeros(len(data) + 1, np.int32)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + length, -1)
    return runs(np.cumsum(edges[:-1]) > 0)


_REMOVED = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
        ("kept_sha256", pa.string()),
    ]
)
_REMOVED_DDL = (
    "n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, "
    "kept binary, kept_sha256 string"
)


def _cut(length: int, keep: bool):
    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for text, found in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode()
                spans, kept = [], data
                if found.is_valid:
                    pairs = found.values
                    begin, end = remove_spans(
                        data, pairs.field("first").to_numpy(), pairs.field("last").to_numpy(), length
                    )
                    spans = [{"start": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())]
                    edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2]))
                sha = hashlib.sha256(kept).hexdigest()
                out.append((len(data), len(data) - len(kept), spans, kept if keep else None, sha))
            if out:
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), _REMOVED)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *_REMOVED.names])

    return cut


def remove_repeats(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    seed: int | None = None,
    keep_bytes: bool = True,
) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also starts earlier.

    Returns the columns of ``documents`` but the text, with ``n_bytes``, ``n_removed``,
    ``spans`` (start and end of the removed runs, in bytes of the input), ``kept`` (the bytes
    left; null without ``keep_bytes``) and ``kept_sha256``, in place of columns of those names.
    A null text is an empty one. Keys that are null sort last; rows equal in key and text are
    one document and get one result each.
    """
    marked, row_id, plain = with_row_id(documents, key, text)
    once = marked if plain else marked.dropDuplicates([row_id])
    found = repeated_windows(once, row_id, text, length=length, seed=seed)
    per_row = found.groupBy(F.col("id").alias("_found_id")).agg(
        F.collect_list(F.struct("first", "last")).alias("_found")
    )
    dropped = {text.lower(), *_REMOVED.names}
    kept = [c for c in documents.columns if c.lower() not in dropped]
    rows = marked.select(
        F.col(quoted(row_id)).alias("_id"),
        F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"),
        text_or_empty(quoted(text)).alias("text"),
    )
    joined = rows.join(per_row, F.col("_id") == F.col("_found_id"), "left").select("row", "text", "_found")
    schema = StructType([*joined.select("row").schema, *StructType.fromDDL(_REMOVED_DDL)])
    out = joined.mapInArrow(_cut(length, keep_bytes), schema)
    return out.select("row.*", *_REMOVED.names)

