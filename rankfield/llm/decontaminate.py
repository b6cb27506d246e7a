"""Benchmark decontamination by a prefix-filtered set join.

Words of the benchmark are ordered by how rare they are in the documents, over all documents.
An occurrence of a window has every one of its words, so its rarest word is all the prefix
that the join needs: a document looks only at the places of such words. From the place of the
word in the window follows where the window would start, which has to lie within the document;
then all its words are compared.

The benchmark is the query set: its segments are broadcast in blocks of a bounded number of
words, however large it is.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.llm.common import batches, quoted, runs, with_row_id
from rankfield.session import written

WINDOW = 13

#: Words of the benchmark that one block, which is broadcast, holds at most.
BLOCK_WORDS = 1_000_000

#: Words of an item in one segment; a longer item is several segments that overlap.
SEGMENT_WORDS = 4096

#: Rows and listed entries of hits up to which they are broadcast to the documents.
SMALL_ROWS, SMALL_ENTRIES = 50_000, 500_000

# A word is of digits, letters and bytes beyond ASCII; A-Z count as a-z.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Return the words of a whole text; null has none."""
    return (text or "").encode().translate(_WORDS).split()


def _segments(window: int):
    schema = pa.schema([("item", pa.string()), ("words", pa.list_(pa.binary()))])

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in source:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), SEGMENT_WORDS):
                    yield item or "", words[at : at + SEGMENT_WORDS + window - 1]

    def segments(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(rows(source), schema, 64)

    return segments


def _counter(vocabulary):
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = vocabulary.value, Counter()
        for batch in source:
            for text in batch.column(0):
                found = Counter(words_of(text.as_py()))
                for word in found.keys() & known:
                    total[word] += found[word]
        yield from batches(iter(total.items()), schema)

    return count


def build_index(segments: list[tuple[str, list[bytes]]], counts: dict[bytes, int], window: int) -> dict:
    """Return, by rarest word, the forms (place in the window, length) and the windows."""
    index: dict[bytes, tuple[set, dict]] = {}
    order = {w: (counts.get(w, 0), w) for _, words in segments for w in words}
    for item, words in segments:
        size = min(window, len(words))
        for at in range(len(words) - size + 1):
            found = tuple(words[at : at + size])
            rare = min(found, key=order.__getitem__)
            forms, windows = index.setdefault(rare, (set(), {}))
            forms.add((found.index(rare), size))
            items = windows.setdefault(found, [])
            if item not in items:
                items.append(item)
    return {w: (sorted(forms), windows) for w, (forms, windows) in index.items()}


def find(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Return the places of all windows in a document and the items they belong to."""
    spans, items = [], set()
    for i, word in enumerate(words):
        if word not in index:
            continue
        forms, windows = index[word]
        for place, size in forms:
            start = i - place
            if start < 0 or start + size > len(words):
                continue
            found = windows.get(tuple(words[start : start + size]))
            if found:
                spans.append((start, start + size))
                items.update(found)
    return spans, items


_HITS = pa.schema(
    [
        ("hit_id", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)
_HITS_DDL = "hit_id bigint, spans array<struct<start:int,end:int>>, items array<string>"


def _matcher(index):
    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = index.value
        for batch in source:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                spans, items = find(words_of(text.as_py()), known)
                if spans:
                    covered = np.zeros(max(e for _, e in spans) + 1, bool)
                    for start, end in spans:
                        covered[start:end] = True
                    begin, stop = runs(covered)
                    merged = [{"start": b, "end": e} for b, e in zip(begin.tolist(), stop.tolist())]
                    yield key, merged, sorted(items)

    def match(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(rows(source), _HITS, 512)

    return match


_REPORT = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)
_REPORT_DDL = "n_words bigint, n_hit bigint, items array<string>, items_sha256 string, contaminated boolean"


def _report(share: int):
    def report(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for text, spans, items in zip(batch.column(1), batch.column(2), batch.column(3)):
                n_words, n_hit, names = len(words_of(text.as_py())), 0, []
                if spans.is_valid:
                    covered = np.zeros(n_words, bool)
                    for span in spans.as_py():
                        covered[span["start"] : span["end"]] = True
                    n_hit, names = int(covered.sum()), sorted(set(items.as_py()))
                digest = hashlib.sha256(",".join(names).encode()).hexdigest()
                out.append((n_words, n_hit, names, digest, n_hit > 0 and share * n_hit >= n_words))
            if out:
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), _REPORT)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *_REPORT.names])

    return report


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = 20,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Report for every document which of its words occur as part of a benchmark window.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. Adds
    ``n_words``, ``n_hit``, ``items`` (those with occurring windows, as sorted strings),
    ``items_sha256`` (of their ids joined by commas) and ``contaminated`` (some word is hit, and
    ``share`` · ``n_hit`` ≥ ``n_words``) to the documents' columns, in place of columns of
    those names.

    A null text has no words and an item without words no windows; an empty benchmark hits
    nothing. Items with one id are one item, and a null id is the empty string. Documents equal
    in key and text are one document, with one result each.
    """
    spark = documents.sparkSession
    marked, row_id, _ = with_row_id(documents, key, text)
    texts = marked.select(F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"))
    segments = written(
        benchmark.select(F.col(quoted(item)).cast("string"), F.col(quoted(item_text)))
        .mapInArrow(_segments(window), "item string, words array<binary>"),
        "segments",
    )
    total = segments.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words)
    numbered = segments.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(blocks, 1))))
    hits = None
    for number in range(blocks):
        block = [(r["item"], [bytes(w) for w in r["words"]]) for r in numbered.filter(F.col("block") == number).toLocalIterator()]
        vocabulary = spark.sparkContext.broadcast({w for _, words in block for w in words})
        counted = texts.select("text").mapInArrow(_counter(vocabulary), "word binary, n bigint")
        # At most as many rows as the block has words.
        counts = {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
        index = spark.sparkContext.broadcast(build_index(block, counts, window))
        found = texts.mapInArrow(_matcher(index), _HITS_DDL)
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = spark.createDataFrame([], _HITS_DDL)
    hits = written(
        hits.groupBy("hit_id").agg(
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
        ),
        "hits",
    )
    size = hits.agg(F.count("*"), F.sum(F.size("spans") + F.size("items"))).first()
    if size[0] <= SMALL_ROWS and (size[1] or 0) <= SMALL_ENTRIES:
        hits = F.broadcast(hits)
    dropped = set(_REPORT.names)
    kept = [F.col(quoted(c)) for c in documents.columns if c.lower() not in dropped]
    rows = marked.select(
        F.struct(*kept).alias("row"), F.col(quoted(text)).alias("text"), F.col(quoted(row_id)).alias("id")
    )
    joined = rows.join(hits, F.col("id") == F.col("hit_id"), "left").select("row", "text", "spans", "items")
    schema = StructType([*joined.select("row").schema, *StructType.fromDDL(_REPORT_DDL)])
    return joined.mapInArrow(_report(share), schema).select("row.*", *_REPORT.names)
