"""Token counts by offset-mapped attribution.

A document is encoded once, whole. Its tokens' character spans are joined with the spans of its
fields or sections, and a token that crosses a boundary goes by an explicit rule: to the
section with most of its characters, and of equal ones to the earlier.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankfield.llm import bpe
from rankfield.llm.common import quoted, text_or_empty


def token_spans(text: str, words: bpe.Bpe) -> tuple[np.ndarray, np.ndarray]:
    """Return start and end (exclusive) characters of each token of a text.

    A token of some bytes of a character covers that character; tokens that share one overlap.
    """
    size = words.n_bytes[np.array(words.ids(text), np.int64)]
    stop = np.cumsum(size)
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    if not len(size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return char[stop - size], char[stop - 1] + 1


def attribute(start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Return the section of each token; section i is bounds[i] to bounds[i + 1].

    An interval join of two sorted lists: the section of a token's first character, and, where
    its last one is in another, the one with most of its characters, the earlier if equal.
    """
    low = np.searchsorted(bounds, start, "right") - 1
    high = np.searchsorted(bounds, end - 1, "right") - 1
    for i in np.flatnonzero(high > low):
        shares = [
            min(end[i], bounds[s + 1]) - max(start[i], bounds[s]) for s in range(low[i], high[i] + 1)
        ]
        low[i] += int(np.argmax(shares))
    return low


_COUNTED = pa.schema([("section_tokens", pa.list_(pa.int64())), ("crossing", pa.int64())])


def _counter(vocabulary: str | None):
    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = bpe.load(vocabulary)
        for batch in source:
            out = []
            for text, sizes in zip(batch.column(1), batch.column(2)):
                bounds = np.concatenate(([0], np.cumsum(sizes.values.to_numpy()))).astype(np.int64)
                start, end = token_spans(text.as_py(), words)
                section = attribute(start, end, bounds)
                crossing = int((np.searchsorted(bounds, end - 1, "right") > np.searchsorted(bounds, start, "right")).sum())
                out.append((np.bincount(section, minlength=len(bounds) - 1), crossing))
            if out:
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*out), _COUNTED)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *_COUNTED.names])

    return count


def count_section_tokens(
    documents: DataFrame, sections: list[Column] | Column, *, vocabulary: str | None = None
) -> DataFrame:
    """Count the tokens of each section of a document, encoded as the sections' whole text.

    ``sections`` are text columns, in order, or one column that is an array of texts; null
    texts are empty ones, and a null array has no sections. Adds ``section_tokens`` (a count
    for each section; they add up to all tokens) and ``crossing`` (tokens with characters of
    several sections) in place of columns of those names. Empty sections count 0.
    """
    if isinstance(sections, Column):
        texts = F.coalesce(F.transform(sections, text_or_empty), F.array().cast("array<string>"))
    else:
        texts = F.array(*[text_or_empty(c.cast("string")) for c in sections])
    kept = [F.col(quoted(c)) for c in documents.columns if c.lower() not in ("section_tokens", "crossing")]
    held = documents.select(F.struct(*kept).alias("row"), texts.alias("texts")).select(
        "row", F.concat_ws("", "texts").alias("text"), F.transform("texts", F.length).alias("sizes")
    )
    schema = StructType(
        [*held.select("row").schema, *StructType.fromDDL("section_tokens array<bigint>, crossing bigint")]
    )
    return held.mapInArrow(_counter(vocabulary), schema).select("row.*", "section_tokens", "crossing")
