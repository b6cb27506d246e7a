"""Turning a text column into vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfield.functions.distances import distance
from rankfield.functions.tokens import check_text, tokens, word_slices
from rankfield.session import spread


class Embedder(Protocol):
    """Anything that gives a vector column for a text column."""

    dim: int

    def column(self, text: str | Column) -> Column: ...


def once(function):
    """Keep the optimizer from copying a costly function into a filter as well.

    A filter on a deterministic column is pushed below it together with a copy of the
    whole expression, and the vectors would be computed twice.
    """
    return function.asNondeterministic()


def embed(df: DataFrame, embedder: Embedder, text: str, out: str | None = None) -> DataFrame:
    """Add ``<text>_embedding`` (or ``out``), computed row by row.

    Only an input small enough to sit in a few tasks is shuffled first.
    """
    return spread(df).withColumn(out or f"{text}_embedding", embedder.column(text))


class HashingEmbedder:
    """Unit vectors of word counts, each word counted in the bucket its MD5 names.

    Needs no model. The JVM splits the text; a batch's distinct words are hashed once
    each, however often they occur, and all its rows are counted together.
    """

    def __init__(self, dim: int = 64) -> None:
        if dim < 1:
            raise ValueError(f"dim must be >= 1, got {dim}")
        self.dim = dim

    def bucket(self, word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim

    def column(self, text: str | Column) -> Column:
        dim, bucket = self.dim, self.bucket

        def part(words: pa.Array) -> pa.Array:
            rows = len(words)
            length = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            coded = words.flatten().dictionary_encode()
            buckets = np.array([bucket(w) for w in coded.dictionary.to_pylist()], dtype=np.int64)
            cell = np.repeat(np.arange(rows) * dim, length)
            cell += buckets[coded.indices.to_numpy()] if len(coded) else 0
            counts = np.bincount(cell, minlength=rows * dim).astype(np.float64)
            counts = counts.reshape(rows, dim)
            norm = np.sqrt((counts**2).sum(1, keepdims=True))
            unit = np.divide(counts, norm, out=counts, where=norm > 0)
            offsets = pa.array(np.arange(rows + 1) * dim, pa.int32())
            flat = pa.array(unit.astype(np.float32).ravel(), pa.float32())
            return pa.ListArray.from_arrays(offsets, flat)

        @F.arrow_udf("array<float>")
        def count(words: pa.Array) -> pa.Array:
            parts = [part(words.slice(*run)) for run in word_slices(words)]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float32()))

        return once(count)(tokens(text))


class ModelEmbedder:
    """Vectors from any model: ``load()`` runs once per task and returns the model.

    The model takes a list of texts and returns one vector per text.
    """

    def __init__(
        self, load: Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]], dim: int
    ) -> None:
        self._load = load
        self.dim = dim

    def column(self, text: str | Column) -> Column:
        load, dim = self._load, self.dim

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                vectors = np.asarray(model(texts.fillna("").tolist()), dtype=np.float32)
                if len(texts) and vectors.shape != (len(texts), dim):
                    raise ValueError(
                        f"model returned shape {vectors.shape} for {len(texts)} texts of "
                        f"{dim} dimensions"
                    )
                yield pd.Series(list(vectors))

        return once(run)(F.col(text) if isinstance(text, str) else text)


def embed_text(spark: SparkSession, embedder: Embedder, text: str) -> list[float]:
    """Return the vector of one query text, made the way the column's vectors are."""
    row = spark.createDataFrame([(check_text(text),)], "text string")
    return list(row.select(embedder.column("text").alias("v")).first()["v"])


def vector_distance(
    spark: SparkSession,
    vector: str | Column,
    text: str,
    embedder: Embedder,
    metric: str = "cosine",
) -> Column:
    """Return the distance of a vector column from a text, as an ordinary column."""
    return distance(vector, embed_text(spark, embedder, text), metric)
