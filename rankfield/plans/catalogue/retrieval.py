"""Search by words, by vectors and by both; selection, scores and stored indexes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rankfield.functions.distances import (
    cosine_distance,
    l2_distance,
    negative_dot_product,
    relevance_score,
)
from rankfield.operators.bm25 import bm25_scan
from rankfield.operators.embed import HashingEmbedder, embed
from rankfield.operators.fusion import hybrid
from rankfield.operators.knn import knn
from rankfield.operators.mmr import mmr_select
from rankfield.operators.topk import ranked
from rankfield.plans.catalogue.registry import new_database, query, read
from rankfield.plans.search import search, search_table, semantic_search
from rankfield.session import scratch_path
from rankfield.sources.cells import CellIndex
from rankfield.sources.indexes import create_text_index, create_vector_index, refresh_indexes
from rankfield.sources.postings import PostingsIndex
from rankfield.sources.rankings import Rankings, TextIndex, VectorIndex

#: The text asked for by the single-query searches below.
ASKED = "thtion eringed the blees"

EMBEDDER = HashingEmbedder(64)


def _query_seven(embeddings):
    """The vector of row 7, as a query table of one row."""
    return embeddings.filter("vec_id = 7").select(
        F.lit(0).alias("query_id"), F.col("embedding").alias("query_vector")
    )


def _all_vectors(embeddings):
    return embeddings.select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def _benchmark(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")
    )


# ------------------------------------------------------------------ SQL pieces

_SQL_DISTANCE = {
    "cosine": "list_cosine_distance({a}, {b})",
    "l2": "list_distance({a}, {b}) ** 2",
    "dot": "-list_inner_product({a}, {b})",
}


def _sql_distance(metric: str, a: str = "e.embedding::DOUBLE[]", b: str = "q.v") -> str:
    return _SQL_DISTANCE[metric].format(a=a, b=b)


_SQL_SEVEN = "q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 7)"

_SQL_TOKENS = "unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))"


def _sql_nearest(metric: str, k: int, where: str = "true") -> str:
    return f"""
    WITH {_SQL_SEVEN},
    d AS (SELECT e.vec_id, e.label, round({_sql_distance(metric)}, 12) AS dist
          FROM embeddings e, q WHERE {where}),
    r AS (SELECT row_number() OVER (ORDER BY dist, vec_id) AS rank, * FROM d)
    SELECT rank, vec_id, label, round(dist, 6) AS _distance FROM r WHERE rank <= {k}
    """


_SQL_KNN_JOIN = f"""
    WITH d AS (SELECT q.vec_id AS query_id, e.vec_id,
                      round({_sql_distance("cosine", b="q.embedding::DOUBLE[]")}, 12) AS dist
               FROM embeddings e, embeddings q),
    r AS (SELECT row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS rank, * FROM d)
    SELECT query_id, rank, vec_id, round(dist, 6) AS _distance FROM r WHERE rank <= 5
"""


def _sql_bm25(queries: str, documents: str = "documents") -> str:
    """CTEs ending in ``scored (query_id, doc_id, score)`` for ``queries(query_id, text)``."""
    return f"""
    tok AS (SELECT doc_id, {_SQL_TOKENS} AS t FROM {documents}),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM tok GROUP BY ALL),
    len AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id),
    tot AS (SELECT (SELECT count(*) FROM {documents})::DOUBLE AS n,
                   (SELECT sum(len) FROM len)::DOUBLE AS words),
    df AS (SELECT t, count(*)::DOUBLE AS df FROM tf GROUP BY t),
    asked AS (SELECT DISTINCT query_id, {_SQL_TOKENS} AS t FROM ({queries})),
    scored AS (
        SELECT query_id, doc_id, round(sum(
            ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
            / (tf + 1.2 * (0.25 + 0.75 * len / (words / n)))), 9) AS score
        FROM asked JOIN tf USING (t) JOIN df USING (t) JOIN len USING (doc_id), tot
        GROUP BY query_id, doc_id)
    """


def _sql_hashed(name: str, source: str, key: str) -> str:
    """CTE ``name(id, b, v)``: the non-zero entries of the hashed vectors of ``source``."""
    return f"""
    {name}_count AS (
        SELECT id, CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 64 AS b, count(*)::DOUBLE AS c
        FROM (SELECT {key} AS id, {_SQL_TOKENS} AS t FROM ({source})) GROUP BY ALL),
    {name} AS (
        SELECT id, b, (c / sqrt(sum(c * c) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS v
        FROM {name}_count)
    """


#: CTE ``near (query_id, doc_id, dist)`` from hashed vectors ``dv`` and ``qv``.
_SQL_HASHED_NEAR = """
    dn AS (SELECT id, sqrt(sum(v * v)) AS n FROM dv GROUP BY id),
    qn AS (SELECT id, sqrt(sum(v * v)) AS n FROM qv GROUP BY id),
    dot AS (SELECT qv.id AS query_id, dv.id AS doc_id, sum(qv.v * dv.v) AS p
            FROM qv JOIN dv USING (b) GROUP BY ALL),
    near AS (
        SELECT qn.id AS query_id, d.doc_id,
               round(CASE WHEN dn.n IS NULL THEN 1.0
                          ELSE 1.0 - coalesce(p, 0.0) / (qn.n * dn.n) END, 12) AS dist
        FROM qn CROSS JOIN documents d
        LEFT JOIN dn ON dn.id = d.doc_id
        LEFT JOIN dot ON dot.query_id = qn.id AND dot.doc_id = d.doc_id)
"""


def _sql_fused(depth: int, k: int) -> str:
    """CTEs from ``scored`` and ``near`` to ``fused (query_id, rank, doc_id, score)``."""
    return f"""
    a AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (
              PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM scored)
          WHERE r <= {depth}),
    b AS (SELECT * FROM (SELECT query_id, doc_id, row_number() OVER (
              PARTITION BY query_id ORDER BY dist, doc_id) AS r FROM near) WHERE r <= {depth}),
    f AS (SELECT query_id, doc_id,
                 round(coalesce(1.0::DOUBLE / (60 + a.r), 0)
                       + coalesce(1.0::DOUBLE / (60 + b.r), 0), 12) AS score
          FROM a FULL JOIN b USING (query_id, doc_id)),
    fused AS (SELECT * FROM (SELECT query_id, row_number() OVER (
                  PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
              FROM f) WHERE rank <= {k})
    """


# -------------------------------------------------------------------- distances


def _distances(metric: str) -> str:
    distance = _sql_distance(metric)
    return f"""
    WITH {_SQL_SEVEN}
    SELECT e.vec_id, round({distance}, 6) AS distance FROM embeddings e, q
    """


def _to_seven(spark, sf_dir, function):
    """Every vector's distance from vector 7, the two side by side in one row."""
    embeddings = read(spark, sf_dir, "embeddings")
    seven = embeddings.filter("vec_id = 7").select("embedding").scalar()
    both = embeddings.withColumn("other", seven)
    return both.select(
        "vec_id", F.round(function("embedding", F.col("other")), 6).alias("distance")
    )


@query("dist_cosine", _distances("cosine"))
def dist_cosine(spark, sf_dir):
    return _to_seven(spark, sf_dir, cosine_distance)


@query("dist_l2", _distances("l2"))
def dist_l2(spark, sf_dir):
    return _to_seven(spark, sf_dir, l2_distance)


@query("dist_dot", _distances("dot"))
def dist_dot(spark, sf_dir):
    return _to_seven(spark, sf_dir, negative_dot_product)


@query(
    "relevance_scores",
    f"""
    WITH {_SQL_SEVEN},
    d AS (SELECT e.vec_id, {_sql_distance("cosine")} AS c, {_sql_distance("l2")} AS l,
                 {_sql_distance("dot")} AS p FROM embeddings e, q)
    SELECT vec_id, round(1 - c, 6) AS cosine, round(1 - l / sqrt(2), 6) AS l2,
           round(CASE WHEN p > 0 THEN 1 - p ELSE -p END, 6) AS dot
    FROM d
    """,
)
def relevance_scores(spark, sf_dir):
    embeddings = read(spark, sf_dir, "embeddings")
    seven = embeddings.filter("vec_id = 7").select("embedding").scalar()
    both = embeddings.withColumn("other", seven)
    functions = {"cosine": cosine_distance, "l2": l2_distance, "dot": negative_dot_product}
    distances = both.select(
        "vec_id", *[f("embedding", F.col("other")).alias(m) for m, f in functions.items()]
    )
    return distances.select(
        "vec_id", *[F.round(relevance_score(F.col(m), m), 6).alias(m) for m in functions]
    )


# ------------------------------------------------------------------ vector search


def _nearest(spark, sf_dir, metric, where=None):
    embeddings = read(spark, sf_dir, "embeddings")
    hits = knn(
        embeddings,
        _query_seven(embeddings),
        key="vec_id",
        metric=metric,
        k=10,
        columns=["label"],
        where=where,
    )
    return hits.select("rank", "vec_id", "label", F.round("_distance", 6).alias("_distance"))


@query("knn_cosine", _sql_nearest("cosine", 10))
def knn_cosine(spark, sf_dir):
    return _nearest(spark, sf_dir, "cosine")


@query("knn_l2", _sql_nearest("l2", 10))
def knn_l2(spark, sf_dir):
    return _nearest(spark, sf_dir, "l2")


@query("knn_dot", _sql_nearest("dot", 10))
def knn_dot(spark, sf_dir):
    return _nearest(spark, sf_dir, "dot")


@query("knn_filtered", _sql_nearest("cosine", 10, "e.label = 3"))
def knn_filtered(spark, sf_dir):
    return _nearest(spark, sf_dir, "cosine", {"label": 3})


@query("knn_join", _SQL_KNN_JOIN)
def knn_join(spark, sf_dir):
    embeddings = read(spark, sf_dir, "embeddings")
    hits = knn(embeddings, _all_vectors(embeddings), key="vec_id", k=5)
    return hits.withColumn("_distance", F.round("_distance", 6))


@query(
    "semantic_topk",
    f"""
    WITH {_sql_hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")},
    {_sql_hashed("qv", f"SELECT 0 AS query_id, '{ASKED}' AS text", "query_id")},
    {_SQL_HASHED_NEAR},
    r AS (SELECT row_number() OVER (ORDER BY dist, doc_id) AS rank, doc_id, dist FROM near)
    SELECT rank, doc_id, lang, round(dist, 6) AS _distance
    FROM r JOIN documents USING (doc_id) WHERE rank <= 10
    """,
)
def semantic_topk(spark, sf_dir):
    documents = embed(read(spark, sf_dir, "documents"), EMBEDDER, "text")
    hits = semantic_search(
        documents,
        query=ASKED,
        embedder=EMBEDDER,
        key="doc_id",
        vector="text_embedding",
        k=10,
        columns=["lang"],
    )
    return hits.select("rank", "doc_id", "lang", F.round("_distance", 6).alias("_distance"))


@query(
    "semantic_cohort_agg",
    f"""
    WITH {_SQL_SEVEN},
    d AS (SELECT e.vec_id, round({_sql_distance("cosine")}, 12) AS dist FROM embeddings e, q),
    r AS (SELECT row_number() OVER (ORDER BY dist, vec_id) AS rank, * FROM d)
    SELECT lang, count(*) AS n, round(avg(dist), 6) AS avg_distance,
           round(avg(n_chars), 4) AS avg_chars
    FROM r JOIN documents ON doc_id = vec_id WHERE rank <= 100 GROUP BY lang
    """,
)
def semantic_cohort_agg(spark, sf_dir):
    embeddings = read(spark, sf_dir, "embeddings")
    cohort = knn(embeddings, _query_seven(embeddings), key="vec_id", k=100)
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return (
        documents.join(cohort, F.col("doc_id") == F.col("vec_id"))
        .groupBy("lang")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("_distance"), 6).alias("avg_distance"),
            F.round(F.avg("n_chars"), 4).alias("avg_chars"),
        )
    )


@query(
    "hash_embed",
    f"""
    WITH {_sql_hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")}
    SELECT id AS doc_id, b AS bucket, round(v, 6) AS weight FROM dv
    """,
)
def hash_embed(spark, sf_dir):
    documents = embed(read(spark, sf_dir, "documents").select("doc_id", "text"), EMBEDDER, "text")
    entries = documents.select("doc_id", F.posexplode("text_embedding").alias("bucket", "weight"))
    return entries.filter("weight != 0").select(
        "doc_id",
        F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("weight").cast("double"), 6).alias("weight"),
    )


@query("ivf_assign", "SELECT vec_id, true AS nearest FROM embeddings")
def ivf_assign(spark, sf_dir):
    """Every stored vector, and whether no centre is nearer to it than that of its cell.

    The angles are computed anew from the stored centres, of which there is a bounded number.
    """
    path = scratch_path(spark, "cells")
    CellIndex.build(read(spark, sf_dir, "embeddings"), key="vec_id", path=path)
    index = CellIndex.open(spark, path)
    shared = spark.sparkContext.broadcast(np.array(index.centres))

    def compare(batches):
        centres = shared.value / np.linalg.norm(shared.value, axis=1, keepdims=True)
        for batch in batches:
            vectors = np.array(batch.column(1).to_pylist(), float).reshape(-1, centres.shape[1])
            cosine = vectors @ centres.T / np.linalg.norm(vectors, axis=1, keepdims=True)
            own = cosine[np.arange(len(cosine)), batch.column(2).to_numpy()]
            nearest = own >= cosine.max(axis=1, initial=-1.0) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nearest)], names=["vec_id", "nearest"])

    stored = index.vectors(spark).select("vec_id", "embedding", "cell")
    return stored.mapInArrow(compare, "vec_id bigint, nearest boolean")


@query("ivf_full_probe", _SQL_KNN_JOIN)
def ivf_full_probe(spark, sf_dir):
    """A search of all cells, which has to give the exact answer."""
    embeddings = read(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "cells")
    index = CellIndex.build(embeddings, key="vec_id", path=path)
    hits = index.search(_all_vectors(embeddings), k=5, nprobe=len(index.centres))
    return hits.withColumn("_distance", F.round("_distance", 6))


@query("ivf_exact", _SQL_KNN_JOIN)
def ivf_exact(spark, sf_dir):
    """The same answer from the cells alone that can hold one of the nearest."""
    embeddings = read(spark, sf_dir, "embeddings")
    index = CellIndex.build(embeddings, key="vec_id", path=scratch_path(spark, "cells"))
    hits = index.search(_all_vectors(embeddings), k=5, nprobe=None)
    return hits.withColumn("_distance", F.round("_distance", 6))


# ------------------------------------------------------------------- diversified


def _sql_mmr(k: int, depth: int, balance: float) -> str:
    steps = [
        f"""
    WITH d AS (SELECT q.vec_id AS query_id, e.vec_id, e.embedding::DOUBLE[] AS v,
                      q.embedding::DOUBLE[] AS qv,
                      round({_sql_distance("cosine", b="q.embedding::DOUBLE[]")}, 12) AS dist
               FROM embeddings e, embeddings q WHERE e.vec_id <> q.vec_id),
    p AS (SELECT *, list_cosine_similarity(v, qv) AS rel FROM (
              SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS pr
              FROM d) WHERE pr <= {depth}),
    s1 AS (SELECT query_id, vec_id, v, pr, 1 AS rank FROM (
               SELECT *, row_number() OVER (
                   PARTITION BY query_id ORDER BY round(rel, 12) DESC, pr) AS n FROM p)
           WHERE n = 1)
    """
    ]
    for step in range(2, k + 1):
        last = f"s{step - 1}"
        steps.append(
            f"""
    s{step} AS (
        SELECT * FROM {last} UNION ALL
        SELECT query_id, vec_id, v, pr, {step} AS rank FROM (
            SELECT c.*, row_number() OVER (
                PARTITION BY c.query_id ORDER BY round({balance} * c.rel
                    - (1 - {balance}) * c.red, 12) DESC, c.pr) AS n
            FROM (SELECT p.query_id, p.vec_id, p.v, p.pr, p.rel,
                         max(list_cosine_similarity(p.v, s.v)) AS red
                  FROM p JOIN {last} s ON s.query_id = p.query_id
                  WHERE NOT EXISTS (SELECT 1 FROM {last} x
                                    WHERE x.query_id = p.query_id AND x.vec_id = p.vec_id)
                  GROUP BY ALL) c)
        WHERE n = 1)
    """
        )
    return ",".join(steps) + f"SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id FROM s{k}"


@query("mmr", _sql_mmr(4, 20, 0.7))
def mmr_all(spark, sf_dir):
    """For every vector, four others that are near it and unlike each other."""
    embeddings = read(spark, sf_dir, "embeddings")
    queries = _all_vectors(embeddings)
    near = knn(embeddings, queries, key="vec_id", k=21)
    others = near.filter("vec_id != query_id").drop("rank")
    # They are in one task for each query already.
    others = ranked(others, "query_id", [F.asc("_distance"), F.asc("vec_id")], 20, tasks=1)
    return mmr_select(
        others.join(embeddings.select("vec_id", "embedding"), "vec_id"),
        queries=queries,
        key="vec_id",
        query_key="query_id",
        vector="embedding",
        query_vector_column="query_vector",
        k=4,
        lambda_mult=0.7,
    )


# -------------------------------------------------------------------- text search

_SQL_ASKED = f"SELECT 0 AS query_id, '{ASKED}' AS text"
_SQL_BENCHMARK = "SELECT item_id AS query_id, text FROM benchmark"


@query(
    "bm25_topk",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)},
    r AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, * FROM scored)
    SELECT rank, doc_id, lang, round(score, 6) AS score
    FROM r JOIN documents USING (doc_id) WHERE rank <= 10
    """,
)
def bm25_topk(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    hits = bm25_scan(documents, query=ASKED, key="doc_id", text="text", k=10, columns=["lang"])
    return hits.select("rank", "doc_id", "lang", F.round("score", 6).alias("score"))


@query(
    "bm25_pool_count",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)}
    SELECT count(*) AS matches, round(sum(score), 4) AS total, round(max(score), 6) AS best
    FROM scored
    """,
)
def bm25_pool_count(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    pool = bm25_scan(documents, query=ASKED, key="doc_id", text="text")
    return pool.agg(
        F.count(F.lit(1)).alias("matches"),
        F.round(F.sum("score"), 4).alias("total"),
        F.round(F.max("score"), 6).alias("best"),
    )


@query(
    "bm25_cohort_agg",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)}
    SELECT quality, count(*) AS n, round(avg(score), 6) AS avg_score
    FROM scored JOIN labels USING (doc_id) GROUP BY quality
    """,
)
def bm25_cohort_agg(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    pool = bm25_scan(documents, query=ASKED, key="doc_id", text="text")
    return (
        pool.join(read(spark, sf_dir, "labels"), "doc_id")
        .groupBy("quality")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("avg_score"))
    )


_SQL_BM25_BATCH = f"""
    WITH {_sql_bm25(_SQL_BENCHMARK)},
    r AS (SELECT row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, *
          FROM scored)
    SELECT query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""


@query("bm25_batch", _SQL_BM25_BATCH)
def bm25_batch(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    hits = bm25_scan(documents, _benchmark(spark, sf_dir), key="doc_id", text="text", k=10)
    return hits.withColumn("score", F.round("score", 6))


def _postings(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    path = scratch_path(spark, "postings")
    return PostingsIndex.build(documents, key="doc_id", text="text", path=path, buckets=16)


@query(
    "bm25_postings",
    f"""
    WITH tok AS (SELECT doc_id, {_SQL_TOKENS} AS t FROM documents),
    tf AS (SELECT doc_id, t, count(*) AS tf FROM tok GROUP BY ALL),
    len AS (SELECT doc_id, sum(tf) AS len FROM tf GROUP BY doc_id)
    SELECT t AS term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences,
           CAST(max(len) AS BIGINT) AS longest
    FROM tf JOIN len USING (doc_id) GROUP BY t
    """,
)
def bm25_postings(spark, sf_dir):
    """What a built index holds about each word."""
    postings = _postings(spark, sf_dir).postings(spark)
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"),
        F.sum("tf").alias("occurrences"),
        F.max("doc_len").cast("bigint").alias("longest"),
    )


@query("bm25_index_batch", _SQL_BM25_BATCH)
def bm25_index_batch(spark, sf_dir):
    """The batch search again, answered from a built index."""
    documents = read(spark, sf_dir, "documents")
    hits = _postings(spark, sf_dir).search(documents, _benchmark(spark, sf_dir), k=10)
    return hits.withColumn("score", F.round("score", 6))


# ------------------------------------------------------------------------ fusion


@query(
    "hybrid_rrf",
    f"""
    WITH {_sql_bm25("SELECT 0 AS query_id, text FROM documents WHERE doc_id = 7")},
    {_SQL_SEVEN},
    near AS (SELECT 0 AS query_id, e.vec_id AS doc_id, round({_sql_distance("cosine")}, 12) AS dist
             FROM embeddings e, q WHERE e.vec_id IN (SELECT doc_id FROM documents)),
    {_sql_fused(40, 10)}
    SELECT rank, doc_id, lang, round(score, 9) AS score FROM fused JOIN documents USING (doc_id)
    """,
)
def hybrid_rrf(spark, sf_dir):
    """The documents most like document 7, by its words and by its vector."""
    documents = read(spark, sf_dir, "documents")
    vectors = read(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    # Only vectors of documents are ranked; one without a document could not be a hit.
    embeddings = vectors.join(documents.select("doc_id"), "doc_id", "left_semi")
    text = documents.filter("doc_id = 7").select(
        F.lit(0).alias("query_id"), F.col("text").alias("query_text")
    )
    vector = vectors.filter("doc_id = 7").select(
        F.lit(0).alias("query_id"), F.col("embedding").alias("query_vector")
    )
    hits = hybrid(
        documents,
        text.join(vector, "query_id"),
        key="doc_id",
        text="text",
        k=10,
        columns=["lang"],
        vector_search=lambda queries, depth: knn(embeddings, queries, key="doc_id", k=depth),
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 9).alias("score"))


@query(
    "hybrid_batch",
    f"""
    WITH {_sql_bm25(_SQL_BENCHMARK)},
    {_sql_hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")},
    {_sql_hashed("qv", _SQL_BENCHMARK, "query_id")},
    {_SQL_HASHED_NEAR},
    {_sql_fused(20, 5)}
    SELECT query_id, rank, doc_id, lang, round(score, 9) AS score
    FROM fused JOIN documents USING (doc_id)
    """,
)
def hybrid_batch(spark, sf_dir):
    documents = embed(read(spark, sf_dir, "documents"), EMBEDDER, "text")
    queries = embed(_benchmark(spark, sf_dir), EMBEDDER, "query_text", "query_vector")
    hits = hybrid(
        documents,
        queries,
        key="doc_id",
        text="text",
        vector="text_embedding",
        k=5,
        columns=["lang"],
    )
    return hits.withColumn("score", F.round("score", 9))


@query(
    "search_auto",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)},
    {_sql_hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")},
    {_sql_hashed("qv", _SQL_ASKED, "query_id")},
    {_SQL_HASHED_NEAR},
    {_sql_fused(40, 10)}
    SELECT rank, doc_id, lang, round(score, 9) AS score FROM fused JOIN documents USING (doc_id)
    """,
)
def search_auto(spark, sf_dir):
    """A search that finds for itself that words and vectors can be fused."""
    documents = embed(read(spark, sf_dir, "documents"), EMBEDDER, "text")
    rankings = Rankings((TextIndex("text"),), (VectorIndex("text_embedding"),))
    hits = search(
        documents,
        ASKED,
        column="text",
        rankings=rankings,
        key="doc_id",
        k=10,
        embedder=EMBEDDER,
        columns=["lang"],
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 9).alias("score"))


@query(
    "search_wide",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)},
    r AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, * FROM scored)
    SELECT rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 250
    """,
)
def search_wide(spark, sf_dir):
    """More hits than a page holds: all that were asked for are ranked."""
    documents = read(spark, sf_dir, "documents")
    hits = search(documents, ASKED, column="text", key="doc_id", k=250)
    return hits.select("rank", "doc_id", F.round("score", 6).alias("score"))


@query(
    "bm25_filtered",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)},
    r AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, lang, score
          FROM scored JOIN documents USING (doc_id) WHERE lang = 'en')
    SELECT rank, doc_id, lang, round(score, 6) AS score FROM r WHERE rank <= 10
    """,
)
def bm25_filtered(spark, sf_dir):
    """The best of one language; how rare a word is stays a matter of all documents."""
    hits = bm25_scan(
        read(spark, sf_dir, "documents"),
        query=ASKED,
        key="doc_id",
        text="text",
        k=10,
        columns=["lang"],
        where={"lang": "en"},
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 6).alias("score"))


_SQL_HYBRID_EN = f"""
    WITH {_sql_bm25(_SQL_ASKED).replace("scored AS (", "ranked_all AS (")},
    scored AS (SELECT * FROM ranked_all WHERE doc_id IN (SELECT doc_id FROM documents
               WHERE lang = 'en')),
    {_sql_hashed("dv", "SELECT doc_id, text FROM documents", "doc_id")},
    {_sql_hashed("qv", _SQL_ASKED, "query_id")},
    {_SQL_HASHED_NEAR.replace("near AS (", "near_all AS (")},
    near AS (SELECT * FROM near_all WHERE doc_id IN (SELECT doc_id FROM documents
             WHERE lang = 'en')),
    {_sql_fused(40, 10)}
    SELECT rank, doc_id, lang, round(score, 9) AS score FROM fused JOIN documents USING (doc_id)
"""


@query("hybrid_filtered", _SQL_HYBRID_EN)
def hybrid_filtered(spark, sf_dir):
    """Words and vectors fused over the documents of one language."""
    documents = embed(read(spark, sf_dir, "documents"), EMBEDDER, "text")
    hits = search(
        documents,
        ASKED,
        column="text",
        rankings=Rankings((TextIndex("text"),), (VectorIndex("text_embedding"),)),
        key="doc_id",
        k=10,
        embedder=EMBEDDER,
        columns=["lang"],
        where={"lang": "en"},
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 9).alias("score"))


def served_table(spark, sf_dir):
    """A managed table of documents whose indexes were built and then kept current.

    A part of the rows comes by an append after the indexes were built.
    """
    database = new_database(spark, tables=["docs"], keys={"docs": ["doc_id"]})
    documents = read(spark, sf_dir, "documents")
    # Filtered first: a filter is not pushed below the embedder, which would run on all rows.
    late = F.col("doc_id") % 8 == 0
    database.load("docs", embed(documents.filter(~late), EMBEDDER, "text"))
    table = database.table("docs")
    create_text_index(table, "text", buckets=16)
    create_vector_index(table, "text_embedding", carry=["lang"])
    database.load("docs", embed(documents.filter(late), EMBEDDER, "text"), "append")
    refresh_indexes(table)
    return table


@query(
    "search_stored_text",
    f"""
    WITH {_sql_bm25(_SQL_ASKED)},
    r AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, lang, score
          FROM scored JOIN documents USING (doc_id) WHERE lang = 'en')
    SELECT rank, doc_id, lang, round(score, 6) AS score FROM r WHERE rank <= 10
    """,
)
def search_stored_text(spark, sf_dir):
    """The filtered search by words, served from the stored index."""
    hits = search_table(
        served_table(spark, sf_dir), ASKED, column="text", strategy="text", k=10, columns=["lang"],
        where={"lang": "en"},
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 6).alias("score"))


@query("search_stored_hybrid", _SQL_HYBRID_EN)
def search_stored_hybrid(spark, sf_dir):
    """The filtered, fused search, served from both stored indexes."""
    hits = search_table(
        served_table(spark, sf_dir), ASKED, column="text", k=10, embedder=EMBEDDER, columns=["lang"],
        where={"lang": "en"},
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 9).alias("score"))


_SQL_CHANGED = """
    changed AS (
        SELECT doc_id, lang, CASE WHEN doc_id % 10 = 3 THEN concat(text, ' thtion thtion') ELSE text END AS text
        FROM documents WHERE doc_id % 10 <> 7)
"""


def changed_table(spark, sf_dir):
    """The served table after an upsert of a tenth of its rows and a delete of another."""
    table = served_table(spark, sf_dir)
    documents = read(spark, sf_dir, "documents")
    longer = documents.filter("doc_id % 10 = 3").withColumn("text", F.concat_ws(" ", "text", F.lit("thtion thtion")))
    table.load(embed(longer, EMBEDDER, "text"), "upsert", ["doc_id"])
    table.load(documents.filter("doc_id % 10 = 7"), "delete", ["doc_id"])
    refresh_indexes(table)
    return table


@query(
    "search_after_upsert",
    f"""
    WITH {_SQL_CHANGED}, {_sql_bm25(_SQL_ASKED, "changed")},
    r AS (SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, lang, score
          FROM scored JOIN changed USING (doc_id))
    SELECT rank, doc_id, lang, round(score, 6) AS score FROM r WHERE rank <= 20
    """,
)
def search_after_upsert(spark, sf_dir):
    """The search by words, served from an index that an upsert and a delete have changed."""
    hits = search_table(
        changed_table(spark, sf_dir), ASKED, column="text", strategy="text", k=20, columns=["lang"]
    )
    return hits.select("rank", "doc_id", "lang", F.round("score", 6).alias("score"))
