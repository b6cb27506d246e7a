"""Importance resampling towards a target text, by hashed runs of words.

Weights are scored in arrays: the CRC-32 of every run of words comes from those of its words by
the linear maps that appending bytes amounts to, so no run is ever made. Scores with Gumbel
noise are then sorted by a distributed radix sort, whose final positions are the ranks; the
first of them are a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfield.llm.common import free_name, quoted, runs, text_or_empty, with_row_id
from rankfield.llm.radix import sorted_ranks
from rankfield.session import written

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

#: Columns that the operator adds.
ADDED = ("n_features", "weight", "score", "rank")

#: Bytes of text, and words of it, that are turned into arrays at a time.
BLOCK_BYTES = 1 << 22
BLOCK_WORDS = 1 << 19

#: Bytes that one table lookup appends; longer words take several.
LONGEST = 64

# The characters of words: 0-9, a-z and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@lru_cache(maxsize=1)
def _byte_steps() -> np.ndarray:
    """What one byte does to a CRC-32 register, by the register's lowest byte."""
    # zlib inverts the register before and after, so crc(b) = ~step(~0, b).
    raw = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32) ^ np.uint32(0xFFFFFFFF)
    low = np.arange(256, dtype=np.uint32) ^ np.uint32(0xFF)
    out = np.empty(256, np.uint32)
    out[low] = raw ^ np.uint32(0x00FFFFFF)
    return out


@lru_cache(maxsize=1)
def _append_maps() -> np.ndarray:
    """maps[n, i, v]: a register with v in byte i, after n zero bytes."""
    steps = _byte_steps()
    values = np.arange(256, dtype=np.uint32)
    maps = np.empty((LONGEST + 1, 4, 256), np.uint32)
    maps[0] = [values << np.uint32(8 * i) for i in range(4)]
    for n in range(1, LONGEST + 1):
        maps[n] = steps[maps[n - 1] & np.uint32(255)] ^ (maps[n - 1] >> np.uint32(8))
    return maps


def _after(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Return the part that ``crc`` has in the CRC-32 of its text with ``count`` bytes appended."""
    maps, left, out = _append_maps(), count, crc
    while True:
        n = np.minimum(left, LONGEST)
        moved = maps[n, 0, out & 255]
        for i in range(1, 4):
            moved ^= maps[n, i, (out >> np.uint32(8 * i)) & 255]
        out, left = moved, left - n
        if not left.any():
            return out


def word_crcs(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Return the CRC-32 of every raw[begin:end], a byte of all of them at a time."""
    steps = _byte_steps()
    length = end - begin
    order = np.argsort(-length, kind="stable")
    at, size = begin[order], length[order]
    state = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for i in range(min(LONGEST, int(size[0]) if len(size) else 0)):
        n = np.searchsorted(-size, -i, side="left")  # words of more than i bytes
        state[:n] = steps[(state[:n] ^ raw[at[:n] + i]) & 255] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > LONGEST):
        out[i] = zlib.crc32(raw[begin[i] : end[i]].tobytes())
    return out


def run_buckets(data: bytes, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (bucket, line) of all runs of one to three words of each line of lower-case text.

    A line here is what lies between newlines; the caller puts one text on each, a newline in a
    text having been made a space.
    """
    raw = np.frombuffer(data, np.uint8)
    begins, ends = runs(_WORD[raw])
    newlines = np.flatnonzero(raw == 10)
    space = np.uint32(zlib.crc32(b" "))
    for at in range(0, len(begins), BLOCK_WORDS):
        begin, end = begins[at : at + BLOCK_WORDS + RUN - 1], ends[at : at + BLOCK_WORDS + RUN - 1]
        own = min(BLOCK_WORDS, len(begins) - at)
        line = np.searchsorted(newlines, begin)
        crc = word_crcs(raw, begin, end)
        size = end - begin
        spaced = _after(np.full(len(size), space), size) ^ crc
        current, where = crc[:own], np.arange(own)
        yield (current % np.uint32(buckets)).astype(np.int64), line[:own]
        for n in range(1, RUN):
            inside = where + n < len(line)
            current, where = current[inside], where[inside]
            same = line[where] == line[where + n]
            current, where = current[same], where[same]
            if not len(where):
                break
            current = _after(current, size[where + n] + 1) ^ spaced[where + n]
            yield (current % np.uint32(buckets)).astype(np.int64), line[where]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, bytes]]:
    """Yield first row, number of rows and their texts in lower case, each on one line."""
    held, first, size = [], 0, 0
    for row, text in enumerate(texts):
        data = (text.as_py() or "").encode().lower().replace(b"\n", b" ")
        held.append(data)
        size += len(data)
        if size >= BLOCK_BYTES:
            yield first, len(held), b"\n".join(held)
            held, first, size = [], row + 1, 0
    if held:
        yield first, len(held), b"\n".join(held)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Return how many runs of words of all texts fall in each bucket.

    What reaches the driver is one number for each of the fixed number of buckets.
    """

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in source:
            for _, _, data in _blocks(batch.column(0)):
                for bucket, _ in run_buckets(data, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    found = texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Return floor(1000 ln) of the smoothed share in the target over that in the source."""
    buckets = len(source)
    all_source, all_target = float(source.sum() + buckets), float(target.sum() + buckets)
    shares = zip(source.tolist(), target.tolist())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target))) for s, t in shares], np.int64
    )


_SCORED = pa.schema([(c, pa.int64()) for c in ("id", "n_words", "n_features", "weight", "score")])
_SCORED_DDL = "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"


def _scores(gains: np.ndarray):
    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            words, features, weight = np.zeros((3, batch.num_rows), np.int64)
            for first, count, data in _blocks(batch.column(1)):
                part = slice(first, first + count)
                raw = np.frombuffer(data, np.uint8)
                begins, _ = runs(_WORD[raw])
                words[part] = np.bincount(np.searchsorted(np.flatnonzero(raw == 10), begins), minlength=count)
                for bucket, line in run_buckets(data, len(gains)):
                    features[part] += np.bincount(line, minlength=count)
                    # Sums of whole numbers below 2^53 are exact in doubles.
                    weight[part] += np.bincount(line, gains[bucket], minlength=count).astype(np.int64)
            columns = [words, features, weight, weight + batch.column(2).to_numpy()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], schema=_SCORED)

    return score


def gumbel(key: str, seed: int) -> Column:
    """Return floor(1000 times a Gumbel number) that a hash of seed and key decides."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    number = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((number + 0.5) / 4294967296.0)))


def resample(
    documents: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Draw the documents most like the target text, with Gumbel noise.

    Returns the columns of ``documents`` with ``n_features`` (runs of one to three words,
    repeats counted), ``weight`` (the sum of their gains), ``score`` (with the noise) and
    ``rank``, in place of columns of those names. Of the N documents of ``least_words`` words or
    more, the ``percent * N // 100`` with the highest scores are drawn and have a rank.

    A null text has no words and weighs 0. A null key is an empty text to the noise, and sorts
    after all others among equal scores. Rows equal in key and text score the same and are one
    draw: they share a rank, and count once for N. An empty target gives gains that favour rare
    buckets; empty documents give an empty table.
    """
    gains = bucket_gains(
        bucket_counts(documents.select(text_or_empty(quoted(text))), buckets),
        bucket_counts(target.select(text_or_empty(quoted(target_text))), buckets),
    )
    marked, row_id, plain = with_row_id(documents, key, text)
    slim = marked.select(
        F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"), gumbel(quoted(key), seed).alias("noise")
    )
    if not plain:
        slim = slim.dropDuplicates(["id"])
    scored = written(slim.mapInArrow(_scores(gains), _SCORED_DDL), "weights")
    able = scored.filter(F.col("n_words") >= least_words).select("id", "score")
    ranks = written(sorted_ranks(able, [("score", True), ("id", False)]), "ranks")
    drawn = percent * ranks.count() // 100
    ranks = ranks.filter(F.col("rank") <= drawn).select(F.col("id").alias("ranked"), "rank")
    match = free_name(marked, "_scored_id")
    found = scored.join(ranks.hint("merge"), F.col("id") == F.col("ranked"), "left")
    found = found.select(F.col("id").alias(match), *ADDED)
    kept = [quoted(c) for c in documents.columns if c.lower() not in ADDED]
    held = marked.select(*kept, quoted(row_id))
    out = held.join(found.hint("merge"), F.col(quoted(row_id)) == F.col(match))
    return out.select(*kept, *ADDED)
