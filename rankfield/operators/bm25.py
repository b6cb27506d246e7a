"""BM25 text relevance, computed by scanning a text column."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankfield.functions.tokens import check_text, tokens, word_slices
from rankfield.operators.knn import (
    attach_columns,
    query_block,
    single_query,
    unique_queries,
    where_condition,
)
from rankfield.operators.merge import check_keys
from rankfield.operators.topk import (
    SCORE_DECIMALS,
    RunningTopK,
    check_k,
    hit_columns,
    ranked,
)
from rankfield.session import BROADCAST_ROWS, bounded, scratch_path, spread, written

#: Fixed values of the ranking formula.
K1 = 1.2
B = 0.75

SCORE = "score"

#: Whether a row may be ranked; all rows count for how rare a word is.
RANKED = "_ranked"

#: Distinct query terms that may be written into a filter and sent to every executor.
BROADCAST_TERMS = 20_000

#: Scores one task holds at a time.
SCORE_CELLS = 4_000_000

#: Rows with one term that a task joins; a word in more rows is split into so many parts.
TERM_ROWS = 1_000_000


def idf(df: Column, n: Column) -> Column:
    return F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))


def term_weight(tf: Column, length: Column, average: Column) -> Column:
    """Return the part of a score that depends on the row: damped, length-adjusted tf."""
    norm = F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * length / average)
    return tf * F.lit(K1 + 1.0) / (tf + norm)


def term_lists(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Return ``(key, terms, tfs, doc_len)``: the distinct terms of each row that has some.

    A row's tokens are all in that row, so counting them needs no shuffle.
    """
    split = rows.select(F.col(key), tokens(text).alias("_tokens"))
    schema = T.StructType(
        [
            T.StructField(key, rows.schema[key].dataType),
            T.StructField("terms", T.ArrayType(T.StringType())),
            T.StructField("tfs", T.ArrayType(T.IntegerType())),
            T.StructField("doc_len", T.IntegerType()),
        ]
    )
    names = schema.fieldNames()

    def count(batches):
        for batch in (b.slice(*run) for b in batches for run in word_slices(b.column(1))):
            lists = batch.column(1)
            words = lists.flatten().dictionary_encode()
            if not len(words):
                continue
            length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lists)), length)
            size = len(words.dictionary)
            pair, tf = np.unique(
                row * size + words.indices.to_numpy().astype(np.int64), return_counts=True
            )
            row, word = pair // size, pair % size
            kept, starts = np.unique(row, return_index=True)
            ends = pa.array(np.append(starts, len(row)), pa.int32())
            columns = [
                batch.column(0).take(pa.array(kept)),
                pa.ListArray.from_arrays(ends, words.dictionary.take(pa.array(word))),
                pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                pa.array(length[kept], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return split.mapInArrow(count, schema)


def term_counts(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Return ``(key, term, tf, doc_len)``: each row's distinct terms with their counts."""
    lists = term_lists(rows, key, text)
    each = lists.select(F.col(key), "doc_len", F.explode(F.arrays_zip("terms", "tfs")).alias("_term"))
    return each.select(F.col(key), F.col("_term.terms").alias("term"), F.col("_term.tfs").alias("tf"), "doc_len")


def query_terms(queries: DataFrame, query_key: str, query_text: str) -> DataFrame:
    """Return each query's distinct terms; a word repeated in a query counts once."""
    return queries.select(query_key, F.array_distinct(tokens(query_text)).alias("terms"))


class Asked(NamedTuple):
    """The queries of one search, held by every executor.

    ``starts``/``members`` list, for each term number, the queries that contain it.
    """

    ids: pa.Array
    terms: pa.Array
    starts: np.ndarray
    members: np.ndarray
    weight: np.ndarray
    average: float


def by_term(query: np.ndarray, term: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Return ``starts`` and ``members`` of pairs of query number and term number."""
    order = np.argsort(term, kind="stable")
    return np.searchsorted(term[order], np.arange(terms + 1)), query[order]


def asked_terms(table: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray] | None:
    """Return ``ids, terms, starts, members`` of a table of term lists, if they are few."""
    lists = table.column(1).combine_chunks()
    words = lists.flatten().dictionary_encode()
    if len(words.dictionary) > BROADCAST_TERMS:
        return None
    length = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    query = np.repeat(np.arange(len(lists)), length)
    starts, members = by_term(query, words.indices.to_numpy(), len(words.dictionary))
    return table.column(0).combine_chunks(), words.dictionary, starts, members


def idf_values(rows: int, df: np.ndarray) -> np.ndarray:
    return np.log(1.0 + (rows - df + 0.5) / (df + 0.5))


def _pieces(asked: Asked, row: np.ndarray, word: np.ndarray, tf: np.ndarray, length: np.ndarray):
    """Yield ``(first row, queries x rows scores)`` for rows whose terms are all here.

    ``row``, ``word`` and ``tf`` are the occurrences, ordered by row; ``length`` has one
    entry per row. A piece is bounded in rows and in term-query pairs, but is at least
    one row.
    """
    n_queries, n_rows = len(asked.ids), len(length)
    norm = K1 * (1.0 - B + B * length[row] / asked.average)
    weight = asked.weight[word] * tf * (K1 + 1.0) / (tf + norm)
    fan = np.diff(asked.starts)[word]
    grown = np.concatenate([[0], np.cumsum(fan)])
    step = max(1, SCORE_CELLS // n_queries)
    first = 0
    while first < n_rows:
        lo = np.searchsorted(row, first)
        full = np.searchsorted(grown, grown[lo] + SCORE_CELLS, side="right") - 1
        last = row[full] if full < len(row) else n_rows
        width = int(min(max(last - first, 1), step, n_rows - first))
        hi = np.searchsorted(row, first + width)
        if lo < hi:
            repeat = fan[lo:hi]
            source = np.repeat(np.arange(lo, hi), repeat)
            offset = np.arange(len(source)) - np.repeat(grown[lo:hi] - grown[lo], repeat)
            query = asked.members[asked.starts[word[source]] + offset]
            cell = query * width + (row[source] - first)
            total = np.bincount(cell, weights=weight[source], minlength=n_queries * width)
            yield first, total.reshape(n_queries, width)
        first += width


def score_rows(asked: Asked, best: RunningTopK | None, names, keys, row, word, tf, length):
    """Offer the scores of some rows to ``best``, or yield every match if there is none."""
    numbers = np.arange(len(asked.ids))
    for first, total in _pieces(asked, row, word, tf, length):
        part = keys.slice(first, total.shape[1])
        if best is not None:
            best.offer(np.where(total > 0, -total, np.inf), part, numbers)
            continue
        query, col = np.nonzero(total)
        value = -np.round(total[query, col], SCORE_DECIMALS)
        table = pa.table(
            [asked.ids.take(pa.array(query)), part.take(pa.array(col)), pa.array(value)],
            names=names,
        )
        yield from table.to_batches(max_chunksize=50_000)


def score_schema(query_key: str, query_type: T.DataType, key: str, key_type: T.DataType):
    return T.StructType(
        [
            T.StructField(query_key, query_type),
            T.StructField(key, key_type),
            T.StructField(SCORE, T.DoubleType()),
        ]
    )


def _score_rows(matched: DataFrame, asked: Asked, schema, k: int | None) -> DataFrame:
    """Score rows that carry the words they have in common with the queries."""
    # Sent as a plain tuple, so that executors need nothing but the arrays to read it.
    shared = matched.sparkSession.sparkContext.broadcast(tuple(asked))
    names = schema.fieldNames()

    def search(batches):
        asked = Asked(*shared.value)
        best = None if k is None else RunningTopK(len(asked.ids), k, SCORE_DECIMALS)
        for batch in batches:
            if not batch.num_rows:
                continue
            hits = batch.column(2)
            words = pc.index_in(hits.flatten(), value_set=asked.terms)
            count = pc.list_value_length(hits).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(hits)), count)
            pair = row * len(asked.terms) + words.to_numpy(zero_copy_only=False)
            pair, tf = np.unique(pair, return_counts=True)
            row, word = pair // len(asked.terms), pair % len(asked.terms)
            length = batch.column(1).to_numpy(zero_copy_only=False)
            yield from score_rows(asked, best, names, batch.column(0), row, word, tf, length)
        if best is not None:
            yield from best.batches(asked.ids, names)

    return matched.mapInArrow(search, schema).withColumn(SCORE, -F.col(SCORE))


def _runs(postings: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Return the row number of each posting and where each row starts, in key order."""
    keys = postings.column(0).combine_chunks()
    changed = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
    starts = np.concatenate([[True], changed.to_numpy(zero_copy_only=False)])
    return np.cumsum(starts) - 1, np.flatnonzero(starts)


def _score_sorted(asked: Asked, best: RunningTopK | None, names, postings: pa.Table):
    """Score postings ``(key, term, tf, doc_len)`` that are ordered by key."""
    words = pc.index_in(postings.column(1), value_set=asked.terms)
    postings = postings.filter(pc.is_valid(words))
    if not postings.num_rows:
        return
    word = words.drop_null().to_numpy()
    row, starts = _runs(postings)
    keys = postings.column(0).combine_chunks().take(pa.array(starts))
    tf = postings.column(2).to_numpy()
    length = postings.column(3).to_numpy()[starts]
    yield from score_rows(asked, best, names, keys, row, word, tf, length)


def score_postings(
    postings: DataFrame, asked: Asked, schema: T.StructType, k: int | None
) -> DataFrame:
    """Score postings against queries that every executor holds.

    The postings of a row are brought together by its key. What is shuffled is the
    postings themselves, whatever the number of queries; pairs of query and row exist
    only inside a task, which passes on ``k`` rows per query.
    """
    query_key, key, _ = names = schema.fieldNames()
    shared = postings.sparkSession.sparkContext.broadcast(tuple(asked))

    def search(batches):
        asked = Asked(*shared.value)
        best = None if k is None else RunningTopK(len(asked.ids), k, SCORE_DECIMALS)
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            # The last row's postings may go on in the next batch.
            cut = pc.index(table.column(0), table.column(0)[-1]).as_py()
            held = table.slice(cut)
            yield from _score_sorted(asked, best, names, table.slice(0, cut))
        if held is not None:
            yield from _score_sorted(asked, best, names, held)
        if best is not None:
            yield from best.batches(asked.ids, names)

    return (
        postings.select(key, "term", "tf", "doc_len")
        .repartition(key)
        .sortWithinPartitions(key)
        .mapInArrow(search, schema)
        .withColumn(SCORE, -F.col(SCORE))
    )


def score_pool(
    postings: DataFrame, weights: DataFrame, *, key: str, query_key: str, average: float
) -> DataFrame:
    """Return every match of a query table of any size: ``(query_key, key, score)``.

    The answer is as large as the matches are many. Both sides are split by a salt
    besides the term, as finely as the commonest word asks for.
    """
    commonest = postings.groupBy("term").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, math.ceil(commonest / TERM_ROWS))
    salt = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    joined = postings.withColumn("_salt", salt).join(
        weights.withColumn("_salt", salts), ["term", "_salt"]
    )
    part = F.col("idf") * term_weight(F.col("tf"), F.col("doc_len"), F.lit(average))
    return joined.groupBy(query_key, key).agg(F.round(F.sum(part), SCORE_DECIMALS).alias(SCORE))


def _scan_bounded(slim, table, schema, key, text, k) -> DataFrame | None:
    asked = asked_terms(table)
    if asked is None:
        return None
    ids, terms, starts, members = asked
    wanted = terms.to_pylist()
    if not wanted:
        return slim.sparkSession.createDataFrame([], schema)
    # Terms are letters and digits only, so they can be written into SQL as they are.
    listed = ", ".join(f"'{term}'" for term in wanted)
    # The text is split once. What is kept of it is small: each row's length and those of
    # its words that some query asks for. Totals and scores are both read from that.
    kept = written(
        spread(slim, key)
        .select(key, tokens(text).alias("_tokens"), RANKED)
        .select(
            key,
            F.size("_tokens").alias("doc_len"),
            F.expr(f"filter(_tokens, word -> word IN ({listed}))").alias("hits"),
            RANKED,
        ),
        "bm25-scan",
    )
    # The NULL term of each row stands for the row itself: its group counts all rows.
    marked = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("hits"))
    totals = (
        kept.select("doc_len", F.explode(marked).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("doc_len").alias("words"))
        .toArrow()
        .to_pylist()
    )
    rows = {r["term"]: r["rows"] for r in totals}
    n = rows.get(None, 0)
    words = next((r["words"] for r in totals if r["term"] is None), 0)
    df = np.array([rows.get(term, 0) for term in wanted], dtype=np.float64)
    weight = idf_values(n, df)
    average = words / n if n and words else 1.0
    matched = kept.filter((F.size("hits") > 0) & F.col(RANKED)).drop(RANKED)
    return _score_rows(matched, Asked(ids, terms, starts, members, weight, average), schema, k)


def _scan_any(
    slim, queries, key, text, query_key, query_text, k, broadcast_rows, filtered
) -> DataFrame:
    """Score a query table of any size, from an index of the text made for it."""
    # The index module builds on this one.
    from rankfield.sources.postings import PostingsIndex

    path = scratch_path(slim.sparkSession, "bm25-postings")
    index = PostingsIndex.build(slim, key=key, text=text, path=path, checked=True)
    return index.scores(
        queries,
        query_key=query_key,
        query_text=query_text,
        k=k,
        only=slim.filter(RANKED).select(key) if filtered else None,
        broadcast_rows=broadcast_rows,
    )


def text_queries(
    corpus: DataFrame, queries: DataFrame | None, query: str | None
) -> DataFrame:
    if (queries is None) == (query is None):
        raise ValueError("pass exactly one of queries and query")
    if query is None:
        return queries
    return single_query(corpus, query_text=check_text(query))


def finish_text(
    scored: DataFrame,
    corpus: DataFrame,
    *,
    key: str,
    query_key: str,
    k: int | None,
    columns: Sequence[str],
    bound: int | None,
) -> DataFrame:
    """Rank scored rows and add the table's columns; ``k=None`` keeps the whole pool."""
    if k is None:
        hits = attach_columns(scored, corpus, key, columns, None)
        return hits.select(query_key, key, *columns, SCORE)
    order = [F.col(SCORE).desc(), F.col(key).asc()]
    hits = attach_columns(ranked(scored, query_key, order, k), corpus, key, columns, bound)
    return hits.select(query_key, "rank", key, *columns, SCORE)


def bm25_scan(
    corpus: DataFrame,
    queries: DataFrame | None = None,
    *,
    key: str,
    text: str,
    query: str | None = None,
    query_key: str = "query_id",
    query_text: str = "query_text",
    k: int | None = None,
    columns: Sequence[str] | None = None,
    where: Column | Mapping[str, Any] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rank rows by BM25 relevance of ``text`` to each query, without an index.

    A row matches when it has any of a query's words. With ``k`` the result is
    ``query_key, rank, key, columns..., score``; without it every match is returned,
    unranked and uncapped. ``key`` has to be unique, and so have the queries' ids.

    ``where`` says which rows are ranked. How rare a word is stays a matter of all rows, as
    it does in a stored index.
    """
    if k is not None:
        check_k(k)
    asked = text_queries(corpus, queries, query)
    if queries is None:
        query_key, query_text = "query_id", "query_text"
    if query_key == key:
        raise ValueError(f"query_key and key are both named {key!r}; rename one")
    carried = hit_columns(corpus, columns, key=key, searched=None, ranking=SCORE)
    chosen = where_condition(corpus, where)
    slim = corpus.select(key, text, chosen.alias(RANKED))
    check_keys(corpus.select(key), [key])
    asked = unique_queries(asked, query_key)
    block = query_block(k or 1, broadcast_rows)
    table = bounded(query_terms(asked, query_key, query_text), rows=block)
    schema = score_schema(
        query_key, asked.schema[query_key].dataType, key, corpus.schema[key].dataType
    )
    scored = None
    if table is not None:
        scored = _scan_bounded(slim, table, schema, key, text, k)
    if scored is None:
        scored = _scan_any(
            slim, asked, key, text, query_key, query_text, k, broadcast_rows, where is not None
        )
    bound = None if table is None or k is None else table.num_rows * k
    return finish_text(
        scored, corpus, key=key, query_key=query_key, k=k, columns=carried, bound=bound
    )
