"""MMR, cells, envelopes and profiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfield.operators import mmr as mmr_module
from rankfield.operators.embed import HashingEmbedder, ModelEmbedder, embed
from rankfield.operators.envelope import capped_result, clamp_k, truncation_warning
from rankfield.operators.knn import knn
from rankfield.operators.mmr import mmr, mmr_select, select_diverse
from rankfield.operators.profile import column_profile, column_stats, table_overview, table_profile
from rankfield.operators.topk import ranked
from rankfield.sources import cells
from rankfield.sources.cells import CellIndex

#: Two near copies and one that is unlike them.
GOLDEN = [("one", [1.0, 0.0, 0.2], "sf"), ("two", [1.0, 0.0, 0.25], "sf"), ("far", [0.0, 1.0, 0.0], "nyc")]


def golden(spark):
    return spark.createDataFrame(GOLDEN, "id string, embedding array<float>, city string")


def ids(df):
    return [r["id"] for r in df.orderBy("rank").collect()]


def test_mmr_golden(spark):
    corpus, query = golden(spark), [1.0, 0.0, 0.0]
    ask = {"query_vector": query, "key": "id"}
    assert ids(knn(corpus, k=2, **ask)) == ["one", "two"]
    assert ids(mmr(corpus, k=2, **ask)) == ["one", "far"]
    assert ids(mmr(corpus, k=2, lambda_mult=1.0, **ask)) == ["one", "two"]
    assert ids(mmr(corpus, k=2, where={"city": "nyc"}, **ask)) == ["far"]
    assert len(ids(mmr(corpus, k=3, fetch_k=1, **ask))) == 3
    assert ids(mmr(corpus.filter("false"), k=2, **ask)) == []
    carried = mmr(corpus, k=1, columns=["city", "embedding"], **ask)
    assert carried.columns == ["query_id", "rank", "id", "city"]
    with pytest.raises(ValueError, match="k must be"):
        mmr(corpus, k=0, **ask)


def test_mmr_of_a_query_table(spark):
    queries = spark.createDataFrame(
        [("q", [1.0, 0.0, 0.0]), ("r", [0.0, 1.0, 0.0])], "query_id string, query_vector array<double>"
    )
    rows = mmr(golden(spark), queries, key="id", k=2).collect()
    got = {q: [r["id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] for q in "qr"}
    assert got == {"q": ["one", "far"], "r": ["far", "one"]} or got["r"][0] == "far"


def test_selection_by_hand():
    rows = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    assert select_diverse(np.array([1.0, 0.1]), rows, 3) == [0, 2, 1]
    assert select_diverse(np.array([1.0, 0.1]), rows, 3, 1.0) == [0, 1, 2]
    assert select_diverse(np.array([1.0, 0.1]), np.zeros((0, 2)), 3) == []


def _greedy(query, rows, k, balance):
    """The selection one pair at a time."""
    cos = lambda a, b: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
    picks = []
    while len(picks) < min(k, len(rows)):
        scores = []
        for i, row in enumerate(rows):
            near, seen = cos(query, row), max((cos(rows[p], row) for p in picks), default=None)
            score = near if seen is None else balance * near - (1 - balance) * seen
            scores.append(-np.inf if i in picks else round(score, 12))
        picks.append(int(np.argmax(scores)))
    return picks


@pytest.mark.parametrize("values", [1 << 21, 40])
def test_pools_of_any_size_are_selected_from_many_at_a_time(spark, values, monkeypatch):
    """Pools span batches; queries may have none, and their vectors may be in either table."""
    monkeypatch.setattr(mmr_module, "POOL_VALUES", values)
    rng = np.random.default_rng(3)
    queries = np.float32(rng.normal(size=(60, 6))).astype(float)
    pools = {q: np.float32(rng.normal(size=(q % 9 if q else 70, 6))).astype(float) for q in range(60)}
    rows = [
        (f"q{q}", r + 1, 1000 * q + r, [float(x) for x in v], [float(x) for x in queries[q]])
        for q, pool in pools.items() for r, v in enumerate(pool)
    ]
    pool = spark.createDataFrame(rows, "q string, rank int, id bigint, v array<float>, w array<float>")
    asked = [(f"q{q}", [float(x) for x in v]) for q, v in enumerate(queries)] + [("none", None)]
    asked = spark.createDataFrame(asked, "q string, w array<double>")
    want = [
        (f"q{q}", n, 1000 * q + p)
        for q, pool in pools.items() for n, p in enumerate(_greedy(queries[q], pool, 5, 0.6), start=1)
    ]
    names = dict(key="id", query_key="q", vector="v", query_vector_column="w", k=5, lambda_mult=0.6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        for picked in (mmr_select(pool, **names), mmr_select(pool.drop("w"), queries=asked, **names)):
            assert sorted(tuple(r) for r in picked.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "Join" not in plan


def test_few_tasks_are_merged_in_one_step(spark):
    rows = spark.range(300).selectExpr("id % 7 AS q", "id", "(id * 37) % 101 AS d").repartition(4)
    order, exchanges = [F.asc("d"), F.asc("id")], []
    answers = []
    for tasks in (None, 4):
        df = ranked(rows, "q", order, 3, tasks)
        answers.append(sorted(tuple(r) for r in df.collect()))
        exchanges.append(df._jdf.queryExecution().sparkPlan().toString().count("row_number"))
    assert answers[0] == answers[1] and len(answers[0]) == 21
    assert exchanges[1] < exchanges[0]


# ------------------------------------------------------------------------- cells


def clustered(spark, n=900, hot=True):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 6)) * 4
    points = centres[rng.integers(0, 5, n)] + rng.normal(size=(n, 6))
    if hot:
        points[: n // 3] = points[0]
    rows = [(i, [float(x) for x in p], i % 4) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id bigint, embedding array<float>, kind int").repartition(4)


def as_queries(df, below=12):
    return df.filter(F.col("id") % 75 == 1).select(
        F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
    )


def found(df):
    return sorted((r["query_id"], r["rank"], r["id"], r["_distance"]) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
@pytest.mark.parametrize("broadcast_rows", [8192, 4])
def test_all_cells_give_the_exact_answer(spark, folder, metric, broadcast_rows):
    corpus = clustered(spark)
    CellIndex.build(corpus, key="id", path=f"{folder}/ix", metric=metric, cells=6, carry=["kind"])
    index = CellIndex.open(spark, f"{folder}/ix")
    asked = as_queries(corpus)
    got = index.search(asked, k=8, nprobe=6, broadcast_rows=broadcast_rows)
    assert found(got) == found(knn(corpus, asked, key="id", metric=metric, k=8))
    got = index.search(asked, k=8, nprobe=6, where={"kind": 2}, broadcast_rows=broadcast_rows)
    assert found(got) == found(knn(corpus, asked, key="id", metric=metric, k=8, where={"kind": 2}))


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
@pytest.mark.parametrize("broadcast_rows", [8192, 4])
def test_cells_that_cannot_hold_the_nearest_are_skipped(spark, folder, metric, broadcast_rows):
    """The exact answer, zero vectors and filters included."""
    corpus = clustered(spark).union(spark.createDataFrame([(5000, [0.0] * 6, 2)], "id bigint, embedding array<float>, kind int"))
    CellIndex.build(corpus, key="id", path=f"{folder}/ix", metric=metric, cells=12, carry=["kind"])
    index = CellIndex.open(spark, f"{folder}/ix")
    asked = as_queries(corpus).union(spark.createDataFrame([(9999, [0.0] * 6)], "q bigint, v array<float>"))
    for where in (None, {"kind": 2}):
        got = index.search(asked, k=8, nprobe=None, where=where, broadcast_rows=broadcast_rows)
        assert found(got) == found(knn(corpus, asked, key="id", metric=metric, k=8, where=where))
    assert index.search(asked, k=2000, nprobe=None, broadcast_rows=broadcast_rows).count() == 901 * asked.count()


def test_an_exact_search_of_clustered_data_opens_few_cells(spark, folder):
    corpus = clustered(spark, hot=False)
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", metric="l2", cells=30)
    assert sum(index.sizes) == 900
    queries = np.array([r["query_vector"] for r in as_queries(corpus).collect()])
    kth = {}
    for r in knn(corpus, as_queries(corpus), key="id", metric="l2", k=5).collect():
        kth[r["query_id"]] = max(kth.get(r["query_id"], 0.0), r["_distance"])
    order = [r["query_id"] for r in as_queries(corpus).collect()]
    opened = index._can_reach(queries, np.array([kth[q] for q in order])) | index._start(queries, 5)
    assert opened.sum(axis=1).mean() < 20


def test_queries_that_share_an_id_are_refused(spark, folder):
    corpus = clustered(spark)
    twice = as_queries(corpus).withColumn("query_id", F.lit(0))
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", cells=3)
    for rows in (8192, 4):
        with pytest.raises(ValueError, match="same 'query_id'"):
            knn(corpus, twice, key="id", k=2, broadcast_rows=rows)
        with pytest.raises(ValueError, match="same 'query_id'"):
            index.search(twice, k=2, broadcast_rows=rows)


def test_recall_grows_with_the_cells_looked_in(spark, folder):
    corpus = clustered(spark, hot=False)
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", cells=8)
    asked = as_queries(corpus)
    exact = {(q, i) for q, _, i, _ in found(knn(corpus, asked, key="id", k=10))}
    recall = [
        len(exact & {(q, i) for q, _, i, _ in found(index.search(asked, k=10, nprobe=n))}) / len(exact)
        for n in (1, 4, 8)
    ]
    assert recall == sorted(recall) and recall[0] > 0.4 and recall[-1] == 1.0


def test_a_search_opens_only_its_cells(spark, folder):
    index = CellIndex.build(clustered(spark), key="id", path=f"{folder}/ix", cells=6)
    hits = index.search(spark=spark, query_vector=[1.0] * 6, k=3, nprobe=1)
    assert "PartitionFilters: [isnotnull(cell" in hits._jdf.queryExecution().toString()


def test_cell_index_rules(spark, folder):
    corpus = clustered(spark)
    with pytest.raises(ValueError, match="stored rows"):
        CellIndex.build(corpus.filter("false"), key="id", path=f"{folder}/none")
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", cells=3)
    asked = as_queries(corpus)
    assert index.search(asked, metric="COSINE", k=1).count() == 12
    with pytest.raises(ValueError, match="built for 'cosine'"):
        index.search(asked, metric="l2")
    with pytest.raises(ValueError, match="exactly one"):
        index.search()


# ------------------------------------------------------------- embedders, envelope


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "b a a"), (2, ""), (3, None)], "id int, text string")
    rows = {r["id"]: r["text_embedding"] for r in embed(df, HashingEmbedder(4), "text").collect()}
    model = HashingEmbedder(4)
    want = np.zeros(4)
    for word in ("a", "a", "b"):
        want[model.bucket(word)] += 1
    assert np.allclose(rows[1], want / np.linalg.norm(want))
    assert rows[2] == rows[3] == [0.0] * 4


def test_a_model_is_loaded_per_task_and_checked(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "id int, text string")

    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    rows = embed(df, ModelEmbedder(load, 2), "text", "v").collect()
    assert {r["id"]: r["v"] for r in rows} == {1: [3.0, 1.0], 2: [0.0, 1.0]}
    with pytest.raises(Exception, match="dimensions"):
        embed(df, ModelEmbedder(load, 3), "text", "v").collect()


def test_vectors_are_computed_once_under_a_filter(spark):
    df = embed(spark.createDataFrame([(1, "a")], "id int, text string"), HashingEmbedder(4), "text", "v")
    plan = df.filter("v IS NOT NULL")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_capped_result(spark):
    df = spark.range(10)
    cut = capped_result(df, max_rows=3, order=[F.asc("id")], warnings=["first note.", None])
    assert [r["id"] for r in cut.rows.collect()] == [0, 1, 2]
    assert cut.row_count == 10
    assert cut.metadata["client_warning"].startswith("first note. 3 of 10")
    whole = capped_result(df, max_rows=10, warning="from the engine")
    assert whole.metadata == {"row_count": 10, "warning": "from the engine"}
    assert truncation_warning(3, 3) is None


def test_k_is_cut_before_ranking():
    assert clamp_k(None, 5, 3) == (5, None)
    assert clamp_k(0, 5, 100) == (1, None)
    assert clamp_k(100, 5, 100) == (100, None)
    k, note = clamp_k(200, 5, 100)
    assert k == 100 and "200" in note and "100" in note


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert column_stats(df).first().asDict() == {"row_count": 2, "a_non_null": 2, "b_non_null": 0}
    rows = column_profile(df, "t", searchable={"b": ["meaning"]}, hidden=["a"]).collect()
    assert [(r["column_name"], r["non_null"], r["searchable_by"]) for r in rows] == [("b", 0, ["meaning"])]


def test_profile_of_several_tables(spark):
    tables = {
        "t": spark.createDataFrame([(1, None), (2, "x")], "a int, b string"),
        "none": spark.createDataFrame([], "z double"),
    }
    rows = table_profile(tables).collect()
    assert sorted((r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows) == [
        ("none", 1, "z", "double", 0, 0),
        ("t", 1, "a", "int", 2, 2),
        ("t", 2, "b", "string", 2, 1),
    ]
    overview = table_overview(table_profile(tables, stats=False)).collect()
    assert [tuple(r) for r in overview] == [("none", 1), ("t", 2)]


@pytest.mark.parametrize("nprobe", [9, None])
def test_queries_that_look_everywhere_are_not_copied_to_every_cell(spark, folder, nprobe, monkeypatch):
    """Where that is less, all vectors are read for a block of queries; the answer is the same."""
    grids = []
    grid = cells.near_grid
    monkeypatch.setattr(cells, "near_grid", lambda *a, **b: grids.append(1) or grid(*a, **b))
    points = np.random.default_rng(5).normal(size=(700, 24))
    rows = [(i, [float(x) for x in p], i % 4) for i, p in enumerate(points)]
    corpus = spark.createDataFrame(rows, "id bigint, embedding array<float>, kind int")
    asked = corpus.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", cells=9, carry=["kind"])
    for where in (None, {"kind": 2}):
        got = index.search(asked, k=3, nprobe=nprobe, where=where, broadcast_rows=50)
        assert found(got) == found(knn(corpus, asked, key="id", k=3, where=where))
    # The nearest cells alone are few; those that may hold something near are nearly all.
    assert len(grids) == (0 if nprobe else 2)
    few = index.search(asked, k=3, nprobe=1, broadcast_rows=50)
    assert few.count() == 2100 and len(grids) == (1 if nprobe else 3)


@pytest.mark.parametrize("metric", ["cosine", "l2", "dot"])
@pytest.mark.parametrize("broadcast_rows", [8192, 60])
def test_cells_are_searched_for_what_is_nearer_than_the_kth_found(spark, folder, metric, broadcast_rows, monkeypatch):
    """Beyond the nearest cells no task passes on a row that cannot be chosen any more."""
    seen, plain = [], CellIndex._search_broadcast

    def search(self, stored, ids, matrix, bits, schema, k, most=None):
        near = plain(self, stored, ids, matrix, bits, schema, k, most)
        if most is not None:
            seen.append((near, dict(zip(ids.to_pylist(), np.asarray(most).tolist()))))
        return near

    monkeypatch.setattr(CellIndex, "_search_broadcast", search)
    points = np.random.default_rng(6).normal(size=(360, 20))
    points[::9] = points[0]
    corpus = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, embedding array<float>")
    asked = corpus.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", metric=metric, cells=6)
    got = index.search(asked, k=3, nprobe=None, broadcast_rows=broadcast_rows)
    assert found(got) == found(knn(corpus, asked, key="id", k=3, metric=metric))
    assert seen
    for near, most in seen:
        rows = near.collect()
        assert rows and all(r["_distance"] <= most[r["query_id"]] + 1e-11 for r in rows)
        assert any(np.isfinite(d) for d in most.values())


def test_copies_of_queries_stay_in_proportion(spark, folder, monkeypatch):
    """However many blocks there are, a query is not copied to more than some cells."""
    monkeypatch.setattr(cells, "near_grid", lambda *a, **b: pytest.fail("queries were copied"))
    monkeypatch.setattr(cells, "MOST_COPIES", 1)
    points = np.random.default_rng(7).normal(size=(200, 12))
    corpus = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, embedding array<float>")
    asked = corpus.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = CellIndex.build(corpus, key="id", path=f"{folder}/ix", cells=2)
    got = index.search(asked, k=3, nprobe=2, broadcast_rows=20)
    assert found(got) == found(knn(corpus, asked, key="id", k=3))
