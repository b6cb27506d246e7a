"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last lines decides where a chunk ends, so an inserted
line moves no boundary but those near it. Chunks of several lines that occur again anywhere are
removed, after their bytes have been compared with those of the first occurrence. Passages of over
50 words are found wherever they begin, by the shortest runs of so many words around each line.

Joins are sort-merge joins at every size: a plan that broadcasts small tables and shuffles
large ones would say nothing, on small tables, about the disk that large ones need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.llm import hashing
from rankfield.llm.common import BATCH_ROWS, batches, quoted, runs, with_row_id
from rankfield.session import written

#: Lines whose hashes decide on a boundary.
WINDOW = 2

#: One in so many lines ends a chunk.
MODULUS = 2

LEAST_LINES = 2
MOST_LINES = 32

#: A passage of so many words counts by itself, be it one line.
LEAST_WORDS = 51


class Lines:
    """Begin, end and end without the newline of every line, whether it is filled, and the words
    before each line and in all. Lines of white space alone are blank."""

    def __init__(self, data: bytes):
        self.raw = raw = np.frombuffer(data, np.uint8)
        end = np.flatnonzero(raw == 10) + 1
        if not len(end) or end[-1] < len(raw):
            end = np.append(end, len(raw))
        self.end, self.begin = end, np.concatenate(([0], end[:-1]))
        self.stop = end - (raw[end - 1] == 10)
        solid = (raw != 32) & ((raw < 9) | (raw > 13))
        starts = solid & ~np.concatenate(([False], solid[:-1]))
        self.words = np.concatenate(([0], np.cumsum(starts)))[np.append(self.begin, len(raw))]
        self.filled = np.diff(self.words) > 0

    @cached_property
    def sums(self) -> np.ndarray:
        return hashing.prefix_sums(self.raw, hashing.BASES[0])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return hashing.range_hashes(self.sums, begin, end, hashing.BASES[0])


def chunk_bounds(data: bytes | Lines) -> list[tuple[int, int, int]]:
    """Return start, end (exclusive) and weight of every chunk.

    A line ends with its newline. A filled line weighs one, and one of ``LEAST_WORDS`` or more
    words as much as ``LEAST_LINES``. A chunk ends once it weighs ``LEAST_LINES`` and has a line
    of so many words after it or as its last, or the rolling hash of its last two filled lines
    says so, or it weighs ``MOST_LINES``. Blank lines go with the filled line before them and do
    not count. What is left at the end and weighs less than ``LEAST_LINES`` joins the chunk before.
    """
    lines = data if isinstance(data, Lines) else Lines(data)
    filled = np.flatnonzero(lines.filled)
    if not len(filled):
        return [(0, len(lines.raw), 0)]
    hashes = lines.hashes(lines.begin[filled], lines.end[filled])
    rolling = hashes.copy()
    for back, step in zip(range(1, WINDOW), hashing.powers(hashing.BASES[1], WINDOW)[1:]):
        rolling[back:] += hashes[:-back] * step
    long = np.diff(lines.words)[filled] >= LEAST_WORDS
    cut = (hashing.mixed(rolling) % np.uint64(MODULUS) == 0) | long | np.append(long[1:], False)
    weights = np.where(long, LEAST_LINES, 1).tolist()
    ends = [*lines.begin[filled[1:]].tolist(), len(lines.raw)]
    bounds, start, weight = [], 0, 0
    for end, stops, more in zip(ends, cut.tolist(), weights):
        weight += more
        if (stops and weight >= LEAST_LINES) or weight >= MOST_LINES:
            bounds.append((start, end, weight))
            start, weight = end, 0
    if weight:
        if weight < LEAST_LINES and bounds:
            start, _, before = bounds.pop()
            weight += before
        bounds.append((start, len(lines.raw), weight))
    return bounds


def chunk_spans(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Return starts and ends of the chunks that can be repeats."""
    bounds = np.array([b[:2] for b in chunk_bounds(lines) if b[2] >= LEAST_LINES], np.int64).reshape(-1, 2)
    return bounds[:, 0], bounds[:, 1]


def passage_spans(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Return starts and ends of the shortest runs of lines with ``LEAST_WORDS`` words, from each
    filled line on and back from each, and of the chunks of fewer words.

    Every line of a passage of so many words is in a run within the passage, wherever it is.
    """
    filled, words = np.flatnonzero(lines.filled), lines.words
    last = np.searchsorted(words, words[filled] + LEAST_WORDS) - 1
    on = last < len(lines.begin)
    first = np.searchsorted(words, words[filled + 1] - LEAST_WORDS, side="right") - 1
    back = first >= 0
    # First and last line in one number, to have each run once.
    ahead, behind = filled[on] << 32 | last[on], first[back] << 32 | filled[back]
    pairs = np.unique(np.concatenate([ahead, behind]))
    start, end = chunk_spans(lines)
    size = words[np.searchsorted(lines.begin, end)] - words[np.searchsorted(lines.begin, start)]
    few = size < LEAST_WORDS
    return (
        np.concatenate([lines.begin[pairs >> 32], start[few]]),
        np.concatenate([lines.stop[pairs & 0xFFFFFFFF], end[few]]),
    )


_SPAN = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("h", pa.int64())])


def _span_batch(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], schema=_SPAN)


def _spans(spans_of: Callable) -> Callable:
    def spans(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in source:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode()
                if not data:
                    continue
                lines = Lines(data)
                start, end = spans_of(lines)
                h = lines.hashes(start, end).view(np.int64)
                held.append((np.full(len(start), key), start, end - start, h))
                rows += len(start)
                if rows >= BATCH_ROWS:
                    yield _span_batch(held)
                    held, rows = [], 0
        if held:
            yield _span_batch(held)

    return spans


def _merged(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join spans of a text that overlap or touch and repeat one other place."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("of", pa.int64()), ("at", pa.int64())])

    def rows() -> Iterator[tuple]:
        for batch in source:
            for key, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = None
                for f in sorted(found.as_py(), key=lambda f: (f["of"], f["shift"], f["start"])):
                    of, shift, start, end = f["of"], f["shift"], f["start"], f["start"] + f["n"]
                    if held and held[:2] == (of, shift) and start <= held[3]:
                        held = (of, shift, held[2], max(end, held[3]))
                        continue
                    if held:
                        yield key, held[2], held[3] - held[2], held[0], held[2] + held[1]
                    held = (of, shift, start, end)
                yield key, held[2], held[3] - held[2], held[0], held[2] + held[1]

    yield from batches(rows(), schema)


def _bytes_of(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("of", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in source:
            for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                for w in wanted.as_py():
                    yield key, w["at"], w["n"], data[w["at"] : w["at"] + w["n"]]

    yield from batches(rows(), schema, 512)


_CLEAN = pa.schema([("cleaned", pa.string()), ("n_lines", pa.int64()), ("n_removed_lines", pa.int64())])


def _without(data: bytes, found: list[dict]) -> tuple[bytes, int]:
    """Return the text without the lines of the spans whose bytes are equal, and their number."""
    lines = Lines(data)
    count = len(lines.begin)
    steps = np.zeros(count + 1, np.int64)
    for f in found:
        start, end = f["start"], f["start"] + len(f["bytes"])
        if data[start:end] == f["bytes"]:
            first = np.searchsorted(lines.begin, start)
            after = np.searchsorted(lines.stop, end, side="right")
            if first < after:
                steps[first] += 1
                steps[after] -= 1
    filled = np.flatnonzero(lines.filled)
    # Blank lines go with the filled line before them, the first ones with the first.
    owner = filled[np.maximum(np.cumsum(lines.filled) - 1, 0)]
    gone = (np.cumsum(steps[:-1]) > 0)[owner]
    kept = [data[lines.begin[a] : lines.end[b - 1]] for a, b in zip(*runs(~gone))]
    return b"".join(kept), int(gone.sum())


def _remove(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        out = []
        for text, found in zip(batch.column(1), batch.column(2)):
            if not text.is_valid:
                out.append((None, 0, 0))
                continue
            data = text.as_py().encode()
            lines = data.count(b"\n") + (not data.endswith(b"\n") and bool(data))
            if not found.is_valid:
                out.append((text.as_py(), lines, 0))
                continue
            left, removed = _without(data, found.as_py())
            out.append((left.decode(), lines, removed))
        if out:
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), _CLEAN)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *_CLEAN.names])


def remove_repeated_chunks(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove chunks of two filled lines or more, or with a line of ``LEAST_WORDS`` words, that
    occur earlier as well.

    Earlier is a smaller key, or the same document and an earlier place. Returns the columns of
    ``documents`` with the text cleaned, ``n_lines`` (of the input) and ``n_removed_lines``, in
    place of columns of those names. All rows stay; a text of which all chunks are removed is
    empty, and a null text stays null. Keys that are null sort last; rows equal in key and text
    are one document and keep the same lines. A shorter line alone, or blank lines alone, are
    never removed.
    """
    return _remove_repeats(documents, chunk_spans, key, text)


def remove_repeated_passages(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every run of lines with ``LEAST_WORDS`` words or more that occurs earlier as well,
    to its first and last line, and chunks as ``remove_repeated_chunks`` does.

    Earlier is a smaller key, or the same document and a place that ends before the later one
    begins. Of each line removed an equal one is left earlier. Columns, rows, null and empty
    texts, null and repeated keys are treated as ``remove_repeated_chunks`` does.
    """
    return _remove_repeats(documents, passage_spans, key, text)


def _remove_repeats(documents: DataFrame, spans_of: Callable, key: str, text: str) -> DataFrame:
    marked, row_id, _ = with_row_id(documents, key, text)
    texts = marked.select(F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"))
    spans = written(texts.mapInArrow(_spans(spans_of), "id bigint, start bigint, n bigint, h bigint"), "spans")
    origin = (
        spans.groupBy("h", "n")
        .agg(F.min(F.struct("id", "start")).alias("origin"), F.count("*").alias("c"))
        .filter("c > 1")
        .drop("c")
    )
    again = (
        spans.join(origin.hint("merge"), ["h", "n"])
        .filter("id != origin.id or start >= origin.start + n")
        .groupBy("id")
        .agg(F.collect_list(F.expr("struct(origin.id as of, origin.start - start as shift, start, n)")).alias("found"))
        .mapInArrow(_merged, "id bigint, start bigint, n bigint, of bigint, at bigint")
    )
    again = written(again, "repeats")
    sources = again.select("of", "at", "n").distinct()
    wanted = sources.groupBy(F.col("of").alias("wanted_id")).agg(F.collect_list(F.struct("at", "n")).alias("wanted"))
    first = (
        texts.join(wanted.hint("merge"), F.col("id") == F.col("wanted_id"))
        .select("id", "text", "wanted")
        .mapInArrow(_bytes_of, "of bigint, at bigint, n bigint, bytes binary")
    )
    per_row = (
        again.select(F.col("id").alias("found_id"), "start", "of", "at", "n")
        .join(first.hint("merge"), ["of", "at", "n"])
        .groupBy("found_id")
        .agg(F.collect_list(F.struct("start", "bytes")).alias("found"))
    )
    dropped = {text.lower(), "n_lines", "n_removed_lines"}
    kept = [c for c in documents.columns if c.lower() not in dropped]
    rows = marked.select(
        F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"),
        F.col(quoted(text)).alias("text"),
        F.col(quoted(row_id)).alias("id"),
    )
    joined = rows.join(per_row.hint("merge"), F.col("id") == F.col("found_id"), "left").select("row", "text", "found")
    schema = StructType(
        [*joined.select("row").schema, *StructType.fromDDL("cleaned string, n_lines bigint, n_removed_lines bigint")]
    )
    out = joined.mapInArrow(_remove, schema)
    names = [c for c in documents.columns if c.lower() not in ("n_lines", "n_removed_lines")]
    columns = [F.col("cleaned").alias(c) if c.lower() == text.lower() else F.col(f"row.{quoted(c)}") for c in names]
    return out.select(*columns, "n_lines", "n_removed_lines")
