"""Postings by shards of rows, in blocks that say how well a row of theirs can score.

All postings of a row are in one shard, so a task scores the shards it is given by itself and
passes on ``k`` rows per query; no posting is shuffled. A shard is a file sorted by term. The
rows of a shard are dealt into segments, and a block has the postings of one term in one
segment, with the largest count and the least length among them. What the blocks of a segment
can add up to bounds its rows' scores: segments below a query's k-th score are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfield.operators.bm25 import SCORE, B, K1, Asked, by_term, score_rows
from rankfield.operators.topk import SCORE_DECIMALS, RunningTopK

#: Rows of the table in one shard, and in one segment of it.
SHARD_ROWS = 1 << 15
SEGMENT_ROWS = 1 << 10

#: Shards of a table that would fill fewer, unless they had fewer rows than this.
LEAST_SHARDS = 8
LEAST_ROWS = 1 << 7

#: Shards that one task scores, one after the other.
TASK_SHARDS = 8

#: Bytes of a row group, the least that is read at a time.
GROUP_BYTES = 1 << 21

#: Postings of a segment that a task holds while it makes blocks, and blocks it hands on at once.
MOST_POSTINGS = 1 << 22
BATCH_BLOCKS = 1 << 12

#: Segments scored between two looks at what can be skipped: at first, and at most.
FIRST_SEGMENTS = 1
MOST_SEGMENTS = 16

_HEAD = ["term", "segment", "most_tf", "least_len"]
_BODY = ["keys", "tfs", "lens"]


class Part(NamedTuple):
    """Shards that were written together, as URIs that tasks open.

    Each of ``gone`` has keys whose postings here are void, ``only`` those that may be scored.
    """

    postings: str
    shards: int
    gone: tuple[str, ...] = ()
    only: str | None = None


def shards_for(rows: int) -> int:
    return max(-(-rows // SHARD_ROWS), min(LEAST_SHARDS, -(-rows // LEAST_ROWS)), 1)


def _shard_of(key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def write_blocks(lists: DataFrame, path: str, key: str, rows: int) -> int:
    """Write ``(key, terms, tfs, doc_len)`` of so many rows and return the number of shards.

    A task that has all rows of a segment makes its blocks, and only those are sorted by term.
    """
    shards = shards_for(rows)
    segments = max(1, -(-rows // (shards * SEGMENT_ROWS)))
    segment = F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(segments)).cast("int")
    key_type = lists.schema[key].dataType.simpleString()
    (
        lists.select(
            _shard_of(key, shards).alias("shard"), segment.alias("segment"),
            F.col(key).alias("key"), "terms", "tfs", "doc_len",
        )
        .repartition("shard", "segment")
        .sortWithinPartitions("shard", "segment", "key")
        .mapInArrow(_gather(segments), f"shard int, {_columns(key_type)}")
        .repartition("shard")
        .sortWithinPartitions("shard", "term", "segment")
        .write.option("parquet.block.size", GROUP_BYTES)
        .partitionBy("shard")
        .parquet(path)
    )
    return shards


def _columns(key_type: str) -> str:
    return (
        "term string, segment int, most_tf int, least_len int, "
        f"keys array<{key_type}>, tfs array<int>, lens array<int>"
    )


def _gather(segments: int):
    """Turn rows sorted by shard, segment and key into the blocks of each segment.

    A segment of more than ``MOST_POSTINGS`` goes on as another, ``segments`` further on.
    """

    def blocks(shard: int, segment: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys, terms, tfs, lens = (table[c].chunk(0) for c in ("key", "terms", "tfs", "doc_len"))
        row = np.repeat(np.arange(len(keys)), pc.list_value_length(terms).to_numpy())
        words = terms.flatten().dictionary_encode()
        word = words.indices.to_numpy()
        order = np.argsort(word, kind="stable")
        found, starts = np.unique(word[order], return_index=True)
        row, tf = row[order], tfs.flatten().to_numpy()[order]
        length = lens.to_numpy()[row]
        ends = pa.array(np.append(starts, len(row)), pa.int32())
        whole = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(found), shard), pa.int32()),
                words.dictionary.take(pa.array(found)),
                pa.array(np.full(len(found), segment), pa.int32()),
                pa.array(np.maximum.reduceat(tf, starts), pa.int32()),
                pa.array(np.minimum.reduceat(length, starts), pa.int32()),
                pa.ListArray.from_arrays(ends, keys.take(pa.array(row))),
                pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(length, pa.int32())),
            ],
            names=["shard", *_HEAD, *_BODY],
        )
        yield from (whole.slice(at, BATCH_BLOCKS) for at in range(0, len(found), BATCH_BLOCKS))

    def gather(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings, current, number = [], 0, None, 0
        for batch in source:
            if not batch.num_rows:
                continue
            shard, segment = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ends = np.cumsum(pc.list_value_length(batch.column(3)).to_numpy())
            new = np.flatnonzero((np.diff(shard) != 0) | (np.diff(segment) != 0)) + 1
            cuts = [0, *new.tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                at = int(shard[start]), int(segment[start])
                while start < stop:
                    if at != current or postings >= MOST_POSTINGS:
                        if held:
                            yield from blocks(current[0], current[1] + number * segments, held)
                        number = number + 1 if at == current else 0
                        held, postings, current = [], 0, at
                    before = int(ends[start - 1]) if start else 0
                    room = int(np.searchsorted(ends, before + MOST_POSTINGS - postings, "left")) + 1
                    end = min(stop, room)
                    held.append(batch.slice(start, end - start))
                    postings, start = postings + int(ends[end - 1]) - before, end
        if held:
            yield from blocks(current[0], current[1] + number * segments, held)

    return gather


def read_blocks(spark: SparkSession, path: str, key: str, key_type: str) -> DataFrame:
    """Return ``(key, term, tf, doc_len)`` of the blocks in a folder."""
    rows = spark.read.schema(f"{_columns(key_type)}, shard int").parquet(path)
    rows = rows.select("term", F.explode(F.arrays_zip("keys", "tfs", "lens")).alias("_row"))
    return rows.select(
        F.col("_row.keys").alias(key), "term",
        F.col("_row.tfs").alias("tf"), F.col("_row.lens").alias("doc_len"),
    )


def count_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Return ``(term, rows, words)`` of each block in a folder: its rows and occurrences."""
    blocks = spark.read.schema("term string, tfs array<int>, shard int").parquet(path)
    words = F.aggregate("tfs", F.lit(0).cast("bigint"), lambda total, tf: total + tf)
    return blocks.select("term", F.size("tfs").cast("bigint").alias("rows"), words.alias("words"))


def write_keys(keys: DataFrame, key: str, shards: Sequence[int], path: str) -> None:
    """Write keys as ``key``, in a folder for each part and the shard there that would have it."""
    places = [
        F.struct(F.lit(i).alias("part"), _shard_of(key, n).alias("shard"))
        for i, n in enumerate(shards)
    ]
    (
        keys.select(F.col(key).alias("key"), F.explode(F.array(*places)).alias("_at"))
        .select("key", "_at.part", "_at.shard")
        .repartition("part", "shard")
        .write.partitionBy("part", "shard")
        .parquet(path)
    )


def write_weights(weights: DataFrame, query_key: str, block_rows: int, path: str) -> int:
    """Write ``(query_key, term, idf)`` in blocks of queries and return how many there are."""
    blocks = max(1, -(-weights.select(query_key).distinct().count() // block_rows))
    block = F.pmod(F.xxhash64(query_key), F.lit(blocks)).cast("int")
    (
        weights.select(F.col(query_key).alias("query"), "term", "idf", block.alias("block"))
        .repartition("block")
        .write.partitionBy("block")
        .parquet(path)
    )
    return blocks


def _files(folder: str) -> list[pq.ParquetFile]:
    store, path = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = sorted(f.path for f in found if f.is_file and f.base_name[0] not in "._")
    return [pq.ParquetFile(store.open_input_file(name)) for name in names]


def _keys(folders: Sequence[str]) -> pa.ChunkedArray | None:
    tables = [file.read(columns=["key"])["key"] for folder in folders for file in _files(folder)]
    return pa.chunked_array([c for t in tables for c in t.chunks], tables[0].type) if tables else None


def _may_hold(group, listed: list[str]) -> bool:
    """Whether some of the sorted words can be in a row group, by its statistics."""
    found = group.column(0).statistics
    if found is None or not found.has_min_max:
        return True
    at = bisect_left(listed, found.min)
    return at < len(listed) and listed[at] <= found.max


class _Shard:
    """The blocks of the asked words in one shard; their postings are read when asked for."""

    def __init__(self, folder: str, asked: Asked, listed: list[str]) -> None:
        self._groups: list[tuple[pq.ParquetFile, int]] = []
        self._read: dict[int, pa.Table] = {}
        heads = [np.zeros((0, 6), np.int64)]
        for file in _files(folder):
            for number in range(file.num_row_groups):
                if not _may_hold(file.metadata.row_group(number), listed):
                    continue
                head = file.read_row_group(number, columns=_HEAD)
                word = pc.index_in(head["term"].cast(asked.terms.type), value_set=asked.terms)
                row = np.flatnonzero(word.is_valid().to_numpy())
                columns = [head[c].to_numpy()[row] for c in _HEAD[1:]]
                at = np.full(len(row), len(self._groups))
                heads.append(np.stack([at, row, word.to_numpy()[row].astype(np.int64), *columns], axis=1))
                self._groups.append((file, number))
        self.group, self.row, self.word, self.segment, self.most_tf, self.least_len = np.concatenate(heads).T

    def bounds(self, asked: Asked) -> np.ndarray:
        """Return, for each query and segment, what no row of the segment scores above."""
        bound = np.zeros((len(asked.ids), int(self.segment.max(initial=-1)) + 1))
        norm = K1 * (1.0 - B + B * self.least_len / asked.average)
        most = asked.weight[self.word] * self.most_tf * (K1 + 1.0) / (self.most_tf + norm)
        order = np.argsort(self.word, kind="stable")
        words, starts = np.unique(self.word[order], return_index=True)
        for word, blocks in zip(words.tolist(), np.split(order, starts[1:])):
            members = asked.members[asked.starts[word] : asked.starts[word + 1]]
            # A word has one block in a segment, so no place is added to twice.
            bound[np.ix_(members, self.segment[blocks])] += most[blocks]
        return bound

    def postings(self, segments: np.ndarray) -> tuple[pa.ChunkedArray, np.ndarray, np.ndarray, np.ndarray]:
        """Return keys, word numbers, counts and lengths of all asked words in some segments."""
        wanted = np.flatnonzero(np.isin(self.segment, segments))
        keys, words, rest = [], [], []
        for number in np.unique(self.group[wanted]).tolist():
            if number not in self._read:
                file, at = self._groups[number]
                self._read[number] = file.read_row_group(at, columns=_BODY)
            own = wanted[self.group[wanted] == number]
            table = self._read[number].take(pa.array(self.row[own])).combine_chunks()
            lists = [table[c].chunk(0) for c in _BODY]
            words.append(np.repeat(self.word[own], pc.list_value_length(lists[0]).to_numpy()))
            keys.append(lists[0].flatten())
            rest.append([c.flatten().to_numpy() for c in lists[1:]])
        tf, length = (np.concatenate(c) for c in zip(*rest))
        return pa.chunked_array(keys), np.concatenate(words), tf, length


def _score_segments(shard: _Shard, segments, asked, best, names, key_type, gone, only):
    keys, word, tf, length = shard.postings(segments)
    kept = np.ones(len(keys), bool)
    if gone is not None:
        kept &= ~pc.is_in(keys, value_set=gone).to_numpy()
    if only is not None:
        kept &= pc.is_in(keys, value_set=only).to_numpy()
    kept = np.flatnonzero(kept)
    if not len(kept):
        return
    keys = keys.take(pa.array(kept)).cast(key_type, safe=False).combine_chunks()
    order = pc.sort_indices(keys)
    keys, at = keys.take(order), kept[order.to_numpy()]
    new = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    new = np.concatenate([[True], new])
    first = np.flatnonzero(new)
    rows = keys.take(pa.array(first))
    yield from score_rows(asked, best, names, rows, np.cumsum(new) - 1, word[at], tf[at], length[at[first]])


def score_shard(
    part: Part, number: int, asked: Asked, listed: list[str], best: RunningTopK | None, names, key_type: pa.DataType
) -> Iterator[pa.RecordBatch]:
    """Offer the scores of one shard's rows to ``best``, or yield every match if there is none.

    ``listed`` are the asked words in order.
    """
    folder = f"shard={number}"
    only = None
    if part.only is not None:
        only = _keys([f"{part.only}/{folder}"])
        if only is None:
            return
    shard = _Shard(f"{part.postings}/{folder}", asked, listed)
    if not len(shard.word):
        return
    gone = _keys([f"{path}/{folder}" for path in part.gone])
    bound = shard.bounds(asked)
    order = np.argsort(-bound.max(axis=0), kind="stable")
    done, step = 0, FIRST_SEGMENTS
    while done < len(order):
        some = order[done : done + step]
        done, step = done + len(some), min(2 * step, MOST_SEGMENTS)
        open_ = bound[:, some] > 0
        if best is not None:
            open_ &= best.reached(-bound[:, some])
        some = some[open_.any(axis=0)]
        if len(some):
            yield from _score_segments(shard, some, asked, best, names, key_type, gone, only)


def _asked_block(folder: str, block: int, average: float) -> Asked:
    """Return the queries of one block that ``write_weights`` wrote."""
    files = _files(f"{folder}/block={block}")
    if not files:
        nothing = pa.array([], pa.string())
        return Asked(nothing, nothing, np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), average)
    table = pa.concat_tables([file.read(columns=["query", "term", "idf"]) for file in files])
    ids = table["query"].combine_chunks().dictionary_encode()
    words = table["term"].combine_chunks().dictionary_encode()
    term = words.indices.to_numpy()
    starts, members = by_term(ids.indices.to_numpy(), term, len(words.dictionary))
    weight = np.zeros(len(words.dictionary))
    weight[term] = table["idf"].to_numpy()
    return Asked(ids.dictionary, words.dictionary, starts, members, weight, average)


def score_shards(
    spark: SparkSession,
    parts: Sequence[Part],
    schema: T.StructType,
    k: int | None,
    *,
    asked: Asked | None = None,
    weights: str | None = None,
    blocks: int = 1,
    average: float = 1.0,
) -> DataFrame:
    """Return ``(query id, key, score)``: every match, or with ``k`` what can be among the best.

    The queries are either ``asked``, which is sent to every executor, or ``blocks`` of them in
    the folder ``weights``. A task answers one block or more from a few shards; each reads the
    row groups of its words alone.
    """
    names = schema.fieldNames()
    parts, total = tuple(tuple(p) for p in parts), sum(p.shards for p in parts)
    units = total * blocks
    tasks = max(1, min(units, spark.sparkContext.defaultParallelism), -(-units // TASK_SHARDS))
    types = spark.createDataFrame([], schema).toArrow().schema
    query_type, key_type = types.field(0).type, types.field(1).type
    shared = None if asked is None else spark.sparkContext.broadcast(tuple(asked))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best = -1, None
        for unit in (u for batch in batches for u in batch.column(0).to_pylist()):
            block, number = divmod(unit, total)
            if block != current:
                if best is not None:
                    yield from best.batches(known.ids, names)
                known = Asked(*shared.value) if shared else _asked_block(weights, block, average)
                known = known._replace(ids=known.ids.cast(query_type, safe=False))
                listed, current = sorted(known.terms.to_pylist()), block
                best = None if k is None else RunningTopK(len(known.ids), k, SCORE_DECIMALS)
            for part in map(lambda p: Part(*p), parts):
                if number < part.shards:
                    break
                number -= part.shards
            yield from score_shard(part, number, known, listed, best, names, key_type)
        if best is not None:
            yield from best.batches(known.ids, names)

    found = spark.range(0, units, 1, tasks).mapInArrow(search, schema)
    return found.withColumn(SCORE, -F.col(SCORE))
