import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankfield.operators import knn as knn_module
from rankfield.operators.knn import knn
from rankfield.operators.topk import RunningTopK


def frame(spark, matrix, name="id", first=0):
    rows = [(first + i, [float(x) for x in v], i % 3) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>, kind int")


def asked(spark, matrix):
    return frame(spark, matrix, "query_id").select(
        "query_id", F.col("embedding").alias("query_vector")
    )


def brute(corpus, queries, metric, k):
    corpus, queries = np.float32(corpus).astype(float), np.float32(queries).astype(float)
    out = []
    for q, query in enumerate(queries):
        if metric == "l2":
            d = ((corpus - query) ** 2).sum(1)
        elif metric == "dot":
            d = -(corpus @ query)
        else:
            d = 1 - corpus @ query / (np.linalg.norm(corpus, axis=1) * np.linalg.norm(query))
        order = sorted(range(len(d)), key=lambda i: (round(d[i], 12), i))[:k]
        out += [(q, rank, i) for rank, i in enumerate(order, start=1)]
    return out


def found(df):
    return sorted((r["query_id"], r["rank"], r["id"]) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
@pytest.mark.parametrize("broadcast_rows", [8192, 3])
def test_matches_brute_force(spark, metric, broadcast_rows):
    rng = np.random.default_rng(1)
    corpus, queries = rng.normal(size=(300, 8)), rng.normal(size=(10, 8))
    hits = knn(
        frame(spark, corpus),
        asked(spark, queries),
        key="id",
        metric=metric,
        k=7,
        broadcast_rows=broadcast_rows,
    )
    assert found(hits) == brute(corpus, queries, metric, 7)


@pytest.mark.parametrize("broadcast_rows", [8192, 2])
def test_a_third_of_the_rows_are_copies(spark, broadcast_rows, monkeypatch):
    """Equal distances are settled by key however the rows are spread over tasks."""
    monkeypatch.setattr(knn_module, "SLICE_VALUES", 800)
    rng = np.random.default_rng(2)
    corpus = rng.normal(size=(600, 4))
    corpus[::3] = corpus[0]
    queries = np.vstack([corpus[0], corpus[1], corpus[2], rng.normal(size=4)])
    hits = knn(
        frame(spark, corpus), asked(spark, queries), key="id", k=50, broadcast_rows=broadcast_rows
    )
    assert found(hits) == brute(corpus, queries, "cosine", 50)


def test_l2_is_exact_for_far_away_vectors(spark):
    corpus = np.array([[1e4, 1e4], [1e4 + 0.5, 1e4], [1e4 + 0.25, 1e4], [0.0, 0.0]])
    hits = knn(frame(spark, corpus), query_vector=[1e4, 1e4], key="id", metric="l2", k=3).collect()
    assert {r["id"]: r["_distance"] for r in hits} == {0: 0.0, 2: 0.0625, 1: 0.25}


def test_string_keys_and_columns(spark):
    df = spark.createDataFrame(
        [("é", [1.0, 0.0], "x"), ("z", [1.0, 0.0], "y"), ("a", [0.0, 1.0], "z")],
        "id string, embedding array<float>, note string",
    )
    hits = knn(df, query_vector=[1.0, 0.0], key="id", k=2, columns=["note", "embedding"])
    assert hits.columns == ["query_id", "rank", "id", "note", "_distance"]
    assert [(r["rank"], r["id"], r["note"]) for r in hits.orderBy("rank").collect()] == [
        (1, "z", "y"),
        (2, "é", "x"),
    ]


def test_filter_comes_before_the_cut(spark):
    corpus = [[1.0, i / 100] for i in range(90)]
    hits = knn(frame(spark, corpus), query_vector=[1.0, 0.0], key="id", k=5, where={"kind": 2})
    assert [r["id"] for r in hits.orderBy("rank").collect()] == [2, 5, 8, 11, 14]


def test_rows_without_a_vector_are_not_ranked(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "id bigint, embedding array<float>")
    assert knn(df, query_vector=[1.0], key="id", k=5).count() == 1
    assert knn(df.filter("id = 2"), query_vector=[1.0], key="id", k=5).count() == 0


@pytest.mark.parametrize(
    "options, message",
    [
        ({"k": 0}, "k must be"),
        ({"metric": "hamming"}, "metric must be"),
        ({"columns": []}, "must not be empty"),
        ({"columns": ["embedding"]}, "besides"),
        ({"columns": ["nope"]}, "no column named"),
        ({"where": {"kind": {"$gt": 1}}}, "plain equality"),
        ({"where": {"nope": 1}}, "not a column"),
    ],
)
def test_bad_arguments(spark, options, message):
    with pytest.raises(ValueError, match=message):
        knn(frame(spark, [[1.0]]), query_vector=[1.0], key="id", **options)


def test_exactly_one_query_form(spark):
    corpus = frame(spark, [[1.0]])
    with pytest.raises(ValueError, match="exactly one"):
        knn(corpus, key="id")
    with pytest.raises(ValueError, match="empty"):
        knn(corpus, query_vector=[], key="id")


def _with_copies(rng, rows):
    """Vectors of which some are equal, without direction or nearly so, or very short or long."""
    corpus = rng.normal(size=(rows, 24))
    corpus[::7] = corpus[0]
    corpus[1::7] = corpus[1] + 1e-6 * rng.normal(size=corpus[1::7].shape)
    corpus[5], corpus[12] = 0.0, 1e-30
    return corpus * 10.0 ** rng.integers(-6, 6, size=(rows, 1))


def test_screening_leaves_out_no_neighbour(monkeypatch):
    """Angles compared in single precision give what double precision does, ties included."""
    rng = np.random.default_rng(8)
    corpus, queries = np.float32(_with_copies(rng, 1_500)).astype(float), rng.normal(size=(300, 24))
    queries[:100], queries[100] = corpus[:100], 0.0
    for k in (1, 9, 1_400, 2_000):
        best = RunningTopK(len(queries), k)
        numbers = np.arange(len(queries))
        units = knn_module.directions(queries)
        calls = []
        whole = knn_module.distance_block
        monkeypatch.setattr(knn_module, "distance_block", lambda *a: calls.append(1) or whole(*a))
        for start in range(0, len(corpus), 400):
            part = corpus[start : start + 400]
            knn_module.offer_block(best, queries, numbers, part, pa.array(np.arange(start, start + len(part))), "cosine", units)
        assert not calls
        monkeypatch.undo()
        got = pa.Table.from_batches(list(best.batches(pa.array(numbers), ["query", "id", "d"])))
        d = np.round(knn_module.distance_block(queries, corpus, "cosine"), 12) + 0.0
        far = np.sort(d, axis=1)[:, min(k, 1_500) - 1]
        assert got.num_rows == len(queries) * min(k, 1_500)
        query, found, value = (got[c].to_numpy() for c in ("query", "id", "d"))
        assert np.abs(value - d[query, found]).max() < 3e-12
        assert (d[query, found] <= far[query] + 3e-12).all()
        if k == 9:  # of equal copies those with the least keys
            assert found[query == 0].tolist() == list(range(0, 63, 7))


def test_large_query_tables_are_read_a_block_at_a_time(spark, monkeypatch):
    """Blocks of queries come from their own files and are as large as their vectors allow."""
    rng = np.random.default_rng(9)
    vectors = _with_copies(rng, 500)
    queries = asked(spark, vectors)
    assert knn_module.blocks_for(queries, 5, 50) == 3
    assert knn_module.blocks_for(queries, 20_000, 50) == 5
    monkeypatch.setattr(knn_module, "BLOCK_VALUES", 24 * 100)
    assert knn_module.blocks_for(queries, 5, 50) == 5
    tables = list(knn_module.query_blocks(queries, 5))
    assert sorted(i for t in tables for i in t.column(0).to_pylist()) == list(range(500))
    assert len(tables) == 5 and max(t.num_rows for t in tables) < 200
    one = found(knn(frame(spark, vectors), queries, key="id", k=5))
    assert one == found(knn(frame(spark, vectors), queries, key="id", k=5, broadcast_rows=50))
