"""Stored BM25 indexes: the terms of a text column, written so that a search reads few."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfield.operators.bm25 import (
    SCORE,
    Asked,
    asked_terms,
    finish_text,
    idf,
    idf_values,
    query_terms,
    score_pool,
    score_postings,
    score_schema,
    term_counts,
    term_lists,
    text_queries,
    unique_queries,
)
from rankfield.operators.knn import apply_where, query_block
from rankfield.operators.merge import check_keys
from rankfield.operators.topk import check_k, hit_columns
from rankfield.session import BROADCAST_ROWS, bounded, row_bound, scratch_path, spread, written
from rankfield.sources import records
from rankfield.sources.blocks import (
    Part,
    count_blocks,
    read_blocks,
    score_shards,
    write_blocks,
    write_keys,
    write_weights,
)
from rankfield.sources.footers import _opens

#: Words listed in the scan filter; beyond it the buckets and the join do the pruning.
LISTED_TERMS = 1_000


@dataclass(frozen=True)
class PostingsIndex:
    """A BM25 index in a folder: ``postings``, ``terms`` and the totals kept here.

    ``postings`` are blocks in one file per shard of the rows, sorted by term, which a search
    scores shard by shard. ``terms`` holds ``(bucket, term, df)`` in one folder per bucket.
    """

    path: str
    key: str
    text: str
    buckets: int
    rows: int
    words: int
    key_type: str
    #: Folders that hold ``postings`` and ``terms``: that of the build, then those of changes.
    parts: tuple[str, ...] = ()
    #: How many shards each part has.
    shards: tuple[int, ...] = ()
    #: Numbers of the parts that have ``gone``, keys whose postings in earlier parts are void.
    voiding: tuple[int, ...] = ()

    @classmethod
    def build(
        cls, corpus: DataFrame, *, key: str, text: str, path: str, buckets: int = 64, checked: bool = False
    ) -> PostingsIndex:
        """Write the index of ``corpus[text]``. Keys have to be present and unique.

        ``checked`` says that they are known to be.
        """
        check_k(buckets, "buckets")
        if not checked:
            check_keys(corpus.select(key), [key])
        key_type = corpus.schema[key].dataType.simpleString()
        empty = cls(path, key, text, buckets, 0, 0, key_type)
        return empty._with(corpus, path)

    def _with(self, rows: DataFrame, path: str, gone: DataFrame | None = None) -> PostingsIndex:
        """Write the postings of ``rows`` to ``path`` with a record of all parts up to it.

        ``gone`` has rows that earlier parts index and that are so no more. Their words are
        taken off the numbers of rows with each word, which are sums over the parts.
        """
        spark = rows.sparkSession
        lists = term_lists(spread(rows.select(self.key, self.text), self.key), self.key, self.text)
        count, voiding = rows.count(), self.voiding
        shards = write_blocks(lists, f"{path}/postings", self.key, count)
        bucket = bucket_of("term", self.buckets).alias("bucket")
        signed = count_blocks(spark, f"{path}/postings").select(bucket, "term", "rows", "words")
        if gone is not None:
            gone = written(gone.select(self.key, self.text), "gone")
            write_keys(gone, self.key, self.shards, f"{path}/gone")
            off = term_counts(gone, self.key, self.text)
            signed = signed.unionByName(off.select(bucket, "term", F.lit(-1).alias("rows"), (-F.col("tf")).alias("words")))
            count, voiding = count - gone.count(), (*voiding, len(self.parts))
        (
            signed.groupBy("bucket", "term")
            .agg(F.sum("rows").alias("df"))
            .hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", "term")
            .write.partitionBy("bucket")
            .parquet(f"{path}/terms")
        )
        index = replace(
            self,
            path=path,
            rows=self.rows + count,
            words=self.words + (signed.agg(F.sum("words")).first()[0] or 0),
            parts=(*self.parts, path),
            shards=(*self.shards, shards),
            voiding=voiding,
        )
        records.create(spark, f"{path}/totals.json", asdict(index))
        return index

    def change(self, added: DataFrame, gone: DataFrame | None = None) -> str:
        """Take rows off and add others; return the path of the changed index.

        ``gone`` has indexed rows as they were, text included. Keys of ``added`` must not be in
        the index otherwise. Only the postings of ``added`` are written; the index that this
        one grew from stays as it is.
        """
        check_keys(added.select(self.key), [self.key])
        path = f"{self.path.rsplit('/', 1)[0]}/words-{uuid.uuid4().hex}"
        return self._with(added, path, gone).path

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> PostingsIndex:
        found = records.read(spark, f"{path}/totals.json")
        return cls(**{name: tuple(v) if isinstance(v, list) else v for name, v in found.items()})

    def postings(self, spark: SparkSession) -> DataFrame:
        """Return all valid postings: those of each part but for rows that a later one voids."""
        frames = [read_blocks(spark, f"{p}/postings", self.key, self.key_type) for p in self.parts]
        if not self.voiding:
            return reduce(DataFrame.unionByName, frames)
        numbered = [f.withColumn("_part", F.lit(i)) for i, f in enumerate(frames)]
        every = reduce(DataFrame.unionByName, numbered)
        columns = f"key {self.key_type}, part int, shard int"
        gone = [
            spark.read.schema(columns).parquet(f"{self.parts[i]}/gone").select(F.col("key").alias("_gone"), F.lit(i).alias("_until"))
            for i in self.voiding
        ]
        last = reduce(DataFrame.unionByName, gone).groupBy("_gone").agg(F.max("_until").alias("_until"))
        void = (F.col(self.key) == F.col("_gone")) & (F.col("_part") < F.col("_until"))
        return every.join(last, void, "left_anti").drop("_part")

    def terms(self, spark: SparkSession) -> DataFrame:
        """How many rows have each term."""
        columns = "term string, df bigint, bucket int"
        frames = [spark.read.schema(columns).parquet(f"{part}/terms") for part in self.parts]
        parts = reduce(DataFrame.unionByName, frames)
        if len(self.parts) == 1:
            return parts
        return parts.groupBy("bucket", "term").agg(F.sum("df").alias("df")).filter("df > 0")

    def _places(self, spark: SparkSession, only: DataFrame | None) -> list[Part] | None:
        """Return where tasks find the postings, or ``None`` in a store that Arrow cannot open.

        ``only`` is written by shard, so that each task reads the keys of its own.
        """
        if not _opens(records.uri(spark, self.path)):
            return None
        allowed = None
        if only is not None:
            path = scratch_path(spark, "bm25-only")
            write_keys(only, self.key, self.shards, path)
            allowed = records.uri(spark, path)
        places = []
        for i, (part, shards) in enumerate(zip(self.parts, self.shards)):
            later = [self.parts[j] for j in self.voiding if j > i]
            gone = tuple(records.uri(spark, f"{p}/gone/part={i}") for p in later)
            own = None if allowed is None else f"{allowed}/part={i}"
            places.append(Part(records.uri(spark, f"{part}/postings"), shards, gone, own))
        return places

    def scores(
        self,
        queries: DataFrame,
        *,
        query_key: str,
        query_text: str,
        k: int | None = None,
        only: DataFrame | None = None,
        broadcast_rows: int = BROADCAST_ROWS,
    ) -> DataFrame:
        """Return ``(query_key, key, score)``: every match, or with ``k`` a superset of the best.

        ``only`` has the keys that may be scored.
        """
        spark = queries.sparkSession
        postings, terms = self.postings(spark), self.terms(spark)
        average = self.words / self.rows if self.words else 1.0
        key_type = postings.schema[self.key].dataType
        query_type = queries.schema[query_key].dataType
        schema = score_schema(query_key, query_type, self.key, key_type)
        asked = query_terms(queries, query_key, query_text)
        block = query_block(k or 1, broadcast_rows)
        table = bounded(asked, rows=block)
        few = None if table is None else asked_terms(table)
        if few is None:
            pairs = asked.select(query_key, F.explode("terms").alias("term"))
            weights = pairs.join(terms, "term").select(
                query_key, "term", idf(F.col("df"), F.lit(float(self.rows))).alias("idf")
            )
            places = None if k is None else self._places(spark, only)
            if places is not None:
                path = scratch_path(spark, "bm25-weights")
                blocks = write_weights(weights, query_key, block, path)
                path = records.uri(spark, path)
                return score_shards(
                    spark, places, schema, k, weights=path, blocks=blocks, average=average
                )
            weights = written(weights, "bm25-weights")
            if only is not None:
                postings = postings.join(only, self.key, "left_semi")
            return score_pool(
                postings, weights, key=self.key, query_key=query_key, average=average
            )
        ids, words, starts, members = few
        if not len(words):
            return spark.createDataFrame([], schema)
        listed = spark.createDataFrame(pa.table({"term": words}))
        listed = listed.withColumn("bucket", bucket_of("term", self.buckets))
        chosen = sorted({r["bucket"] for r in listed.select("bucket").collect()})
        terms = terms.filter(F.col("bucket").isin(chosen))
        if len(words) <= LISTED_TERMS:
            terms = terms.filter(F.col("term").isin(words.to_pylist()))
        else:
            terms = terms.join(F.broadcast(listed.select("term")), "term", "left_semi")
        rows = {r["term"]: r["df"] for r in terms.select("term", "df").collect()}
        df = np.array([rows.get(word, 0) for word in words.to_pylist()], dtype=np.float64)
        weight = idf_values(self.rows, df)
        known = Asked(ids, words, starts, members, weight, average)
        places = self._places(spark, only)
        if places is not None:
            return score_shards(spark, places, schema, k, asked=known)
        postings = postings.join(F.broadcast(listed.select("term")), "term", "left_semi")
        if only is not None:
            postings = postings.join(only, self.key, "left_semi")
        return score_postings(postings, known, schema, k)

    def search(
        self,
        corpus: DataFrame,
        queries: DataFrame | None = None,
        *,
        query: str | None = None,
        query_key: str = "query_id",
        query_text: str = "query_text",
        k: int | None = None,
        columns: Sequence[str] | None = None,
        where: Column | Mapping[str, Any] | None = None,
        broadcast_rows: int = BROADCAST_ROWS,
    ) -> DataFrame:
        """Same answer as a scan of the column, read from the index."""
        if k is not None:
            check_k(k)
        asked = text_queries(corpus, queries, query)
        if queries is None:
            query_key, query_text = "query_id", "query_text"
        carried = hit_columns(corpus, columns, key=self.key, searched=None, ranking=SCORE)
        asked = unique_queries(asked, query_key)
        only = None if where is None else apply_where(corpus, where).select(self.key)
        scored = self.scores(
            asked,
            query_key=query_key,
            query_text=query_text,
            k=k,
            only=only,
            broadcast_rows=broadcast_rows,
        )
        rows = None if k is None else row_bound(asked)
        return finish_text(
            scored,
            corpus,
            key=self.key,
            query_key=query_key,
            k=k,
            columns=carried,
            bound=None if rows is None else rows * k,
        )


def bucket_of(term: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")
