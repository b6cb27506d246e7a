"""Rankings, search plans and the document store."""

import pytest
from pyspark.sql import functions as F

from rankfield.operators.embed import HashingEmbedder, ModelEmbedder, vector_distance
from rankfield.operators.fusion import hybrid
from rankfield.plans.catalogue import retrieval
from rankfield.plans.search import (
    default_columns,
    plan_search,
    search,
    search_capped,
    search_table,
    semantic_search,
)
from rankfield.plans.store import DocumentStore, promote_metadata
from rankfield.sources.blocks import read_blocks
from rankfield.sources.database import Database
from rankfield.sources.indexes import (
    create_text_index,
    create_vector_index,
    open_text_index,
    open_vector_index,
    refresh_indexes,
    stored_indexes,
    table_rankings,
)
from rankfield.sources.rankings import Rankings, TextIndex, VectorIndex

WORDS = TextIndex("text")
VECTORS = VectorIndex("embedding")
MADE = VectorIndex("text_embedding", text="text")
WITH = {"has_embedding": True}


def rankings(*indexes):
    return Rankings(
        tuple(i for i in indexes if isinstance(i, TextIndex)),
        tuple(i for i in indexes if isinstance(i, VectorIndex)),
    )


def plan(*indexes, column="text", columns=("id", "text", "embedding"), **options):
    return plan_search(rankings(*indexes), column=column, table_columns=columns, **options)


# Which ranking each table gives a search.
@pytest.mark.parametrize(
    "indexes, options, expected",
    [
        ([], {}, "text"),
        ([WORDS], {}, "text"),
        ([MADE], {}, "semantic"),
        ([VECTORS], {"column": "embedding", **WITH}, "semantic"),
        ([MADE], {"strategy": "text"}, "text"),
        ([], {"strategy": "text"}, "text"),
        ([WORDS, VECTORS], WITH, "hybrid"),
        ([WORDS, VECTORS], {}, "text"),
        ([WORDS, VECTORS], {"strategy": "text", **WITH}, "text"),
        ([WORDS, VectorIndex("t", text="title")], WITH, "text"),
        ([WORDS, VectorIndex("a"), VectorIndex("b")], WITH, "text"),
        ([WORDS, VectorIndex("a"), VectorIndex("b")], {"semantic_column": "b", **WITH}, "hybrid"),
        ([WORDS, VECTORS], {"key": None, **WITH}, "text"),
        ([WORDS, VECTORS], {"key": "nope", **WITH}, "text"),
        ([VECTORS], WITH, "text"),
        ([WORDS, VECTORS], {"semantic_column": "embedding"}, "text"),
    ],
)
def test_plans(indexes, options, expected):
    assert plan(*indexes, **options).form == expected


@pytest.mark.parametrize(
    "indexes, options, message",
    [
        ([VECTORS], {"column": "embedding"}, "embedder"),
        ([WORDS], {"strategy": "semantic"}, "no vector index covers"),
        ([WORDS, VectorIndex("a"), VectorIndex("b")], {"strategy": "hybrid", **WITH}, "a, b"),
        ([WORDS, VECTORS], {"strategy": "hybrid"}, "embedder"),
        ([WORDS, VECTORS], {"strategy": "hybrid", "key": None, **WITH}, "key"),
        ([VECTORS], {"strategy": "hybrid", **WITH}, "no ready text index"),
        ([WORDS], {"strategy": "hybrid", **WITH}, "exactly one"),
        ([WORDS, VECTORS], {"semantic_column": "nope", **WITH}, "nope"),
        ([WORDS], {"strategy": "fuzzy"}, "strategy"),
    ],
)
def test_plans_that_cannot_be_had(indexes, options, message):
    with pytest.raises(ValueError, match=message):
        plan(*indexes, **options)


def test_metric_names_are_read_without_case():
    assert VectorIndex("v", "COSINE").metric == "cosine"
    with pytest.raises(ValueError, match="metric"):
        VectorIndex("v", "hamming")


def test_what_rankings_say():
    found = rankings(WORDS, VectorIndex("late"), VectorIndex("t_vec", text="title"))
    assert [i.column for i in found.partners] == ["late"]
    assert found.made_columns == {"t_vec"}
    assert [found.uses(c) for c in ("text", "title", "late", "id")] == [["text relevance"], ["meaning"], ["meaning"], []]


def test_default_columns(spark):
    df = spark.createDataFrame([(1, "a", [1.0])], "id int, text string, embedding array<float>")
    assert default_columns(df, "text", key="id", holds_vectors=False) == ["id", "text"]
    assert default_columns(df, "text", key="nope", holds_vectors=False) == ["text"]
    assert default_columns(df, "id", key="id", holds_vectors=False) == ["id"]
    assert default_columns(df, "embedding", key="id", holds_vectors=True) == ["id"]
    with pytest.raises(ValueError, match="nothing readable"):
        default_columns(df, "embedding", key=None, holds_vectors=True)


# ------------------------------------------------------------------ whole searches

LISTINGS = [
    ("a", "quiet garden flat"), ("b", "garden shed"), ("c", "loud bar"), ("d", "quiet library room"),
]


def listings(spark):
    return spark.createDataFrame(LISTINGS, "id string, text string")


def test_search_by_each_form(spark):
    model = HashingEmbedder(64)
    table = listings(spark).withColumn("embedding", model.column("text"))
    both = rankings(WORDS, VECTORS)
    plain = search(table, "quiet garden", column="text", k=3)
    assert plain.columns[-1] == "score"
    assert plain.orderBy("rank").first()["id"] == "a"
    fused = search(table, "quiet garden", column="text", rankings=both, embedder=model, k=3)
    assert fused.columns == ["query_id", "rank", "id", "text", "score"]
    assert fused.count() == 3
    by_vector = search(table, "garden shed", column="embedding", rankings=rankings(VECTORS), embedder=model, k=2)
    assert by_vector.columns == ["query_id", "rank", "id", "_distance"]
    assert by_vector.orderBy("rank").first()["id"] == "b"
    made = rankings(VectorIndex("embedding", text="text"))
    by_meaning = search(table, "garden shed", column="text", rankings=made, embedder=model, k=2)
    assert by_meaning.columns == ["query_id", "rank", "id", "text", "_distance"]
    with pytest.raises(ValueError, match="embedder"):
        search(table, "x", column="text", rankings=made)


def test_all_that_is_asked_for_is_ranked(spark):
    rows = [(i, f"word {i}") for i in range(300)]
    table = spark.createDataFrame(rows, "id int, text string")
    assert search(table, "word", column="text", k=250).count() == 250
    for k in (0, -3):
        with pytest.raises(ValueError, match="k must be"):
            search(table, "word", column="text", k=k)
    result = search_capped(table, "word", column="text", k=7, max_rows=2)
    assert [r["rank"] for r in result.rows.collect()] == [1, 2]
    assert "2 of 7" in result.metadata["client_warning"]
    assert "client_warning" not in search_capped(table, "word 3", column="text", k=5, max_rows=9).metadata


def test_a_filter_reaches_every_ranking(spark, folder):
    model = HashingEmbedder(16)
    rows = [(i, f"quiet garden number {i}", i % 2) for i in range(40)]
    table = spark.createDataFrame(rows, "id int, text string, odd int")
    table = table.withColumn("embedding", model.column("text"))
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    database.load("t", table)
    stored = database.table("t")
    create_text_index(stored, "text", buckets=2)
    create_vector_index(stored, "embedding", cells=3, carry=["odd"])
    for where in ({"odd": 1}, F.col("odd") == 1):
        for options in ({"strategy": "text"}, {"strategy": "hybrid"}, {"column": "embedding"}):
            ask = {"column": "text", "k": 10, "columns": ["odd"], "where": where, "embedder": model} | options
            scanned = search(table, "quiet number 5", rankings=table_rankings(stored), **ask)
            found = sorted(scanned.collect())
            assert len(found) == 10 and {r["odd"] for r in found} == {1}
            assert found == sorted(search_table(stored, "quiet number 5", **ask).collect())
    with pytest.raises(ValueError, match="filters the scans"):
        hybrid(table, query="a", query_vector=[1.0] * 16, key="id", text="text", k=1, where={"odd": 1}, vector_search=print)


def test_semantic_search_takes_one_form_of_query(spark):
    model = HashingEmbedder(8)
    table = listings(spark).withColumn("v", model.column("text"))
    ask = {"key": "id", "vector": "v"}
    assert semantic_search(table, query="loud bar", embedder=model, k=1, **ask).first()["id"] == "c"
    assert semantic_search(table, query_vector=[1.0] * 8, k=1, **ask).count() == 1
    with pytest.raises(ValueError, match="exactly one"):
        semantic_search(table, query="x", query_vector=[1.0], **ask)
    with pytest.raises(ValueError, match="exactly one"):
        semantic_search(table, **ask)
    with pytest.raises(ValueError, match="embedder"):
        semantic_search(table, query="x", **ask)


def test_distance_from_a_text(spark):
    model = HashingEmbedder(16)
    table = listings(spark).withColumn("v", model.column("text"))
    near = table.select("id", vector_distance(spark, "v", "loud bar", model).alias("d"))
    assert near.orderBy("d").first()["id"] == "c"
    with pytest.raises(ValueError, match="null bytes"):
        vector_distance(spark, "v", "a\x00b", model)


def test_table_indexes(spark, folder):
    model = HashingEmbedder(16)
    database = Database.create(spark, folder, database_id="d", tables=["t", "u"], keys={"t": ["id"], "u": ["id"]})
    table = database.table("t")
    database.load("t", listings(spark).withColumn("embedding", model.column("text")))
    with pytest.raises(LookupError, match="No BM25"):
        search_table(table, "garden", column="text")
    with pytest.raises(LookupError, match="No BM25 index found on column 'text'"):
        open_text_index(table, "text")
    create_text_index(table, "text", buckets=2)
    assert create_vector_index(table, "embedding", cells=2).metric == "cosine"
    assert create_vector_index(table, "embedding", cells=2) is None
    with pytest.raises(ValueError, match="metric 'cosine'"):
        create_vector_index(table, "embedding", metric="l2", cells=2)
    with pytest.raises(LookupError, match="No vector index"):
        open_vector_index(table, "text")
    hits = open_text_index(table, "text").search(table.read(), query="quiet garden", k=1)
    assert hits.first()["id"] == "a"
    described = database.describe().filter("table_name = 't'").collect()
    assert {r["column_name"]: r["searchable_by"] for r in described} == {
        "id": [], "text": ["text relevance"], "embedding": ["meaning"],
    }
    for ask in ({}, {"embedder": model}, {"embedder": model, "nprobe": 2}):
        hits = search_table(table, "quiet garden", column="text", k=2, **ask)
        assert hits.columns == ["query_id", "rank", "id", "text", "score"]
        assert hits.orderBy("rank").first()["id"] == "a"
    scanned = search(
        table.read(), "quiet garden", column="text", rankings=table_rankings(table), embedder=model
    )
    stored = search_table(table, "quiet garden", column="text", embedder=model)
    assert sorted(scanned.collect()) == sorted(stored.collect())
    by_vector = search_table(table, "garden shed", column="embedding", embedder=model, k=1)
    assert by_vector.columns == ["query_id", "rank", "id", "_distance"]
    assert by_vector.first()["id"] == "b"


def test_indexes_are_kept_current(spark, folder):
    model = HashingEmbedder(16)
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    table = database.table("t")
    rows = listings(spark).withColumn("embedding", model.column("text"))
    database.load("t", rows.filter("id < 'c'"))
    create_text_index(table, "text", buckets=2)
    create_vector_index(table, "embedding", cells=2)
    database.load("t", rows.filter("id >= 'c'"), "append")
    assert table_rankings(table) == Rankings()
    assert {i.version for i in stored_indexes(table)} == {1}
    refresh_indexes(table)
    # A load adds a part to each index.
    assert len(open_text_index(table, "text").parts) == len(open_vector_index(table, "embedding").parts) == 2
    for ask in ({}, {"embedder": model}):
        stored = search_table(table, "quiet garden", column="text", **ask)
        scanned = search(table.read(), "quiet garden", column="text", rankings=table_rankings(table), **ask)
        assert sorted(stored.collect()) == sorted(scanned.collect())
    database.load("t", rows.filter("id = 'a'"), "delete", ["id"])
    refresh_indexes(table)
    assert len(open_text_index(table, "text").parts) == len(open_vector_index(table, "embedding").parts) == 3
    assert [r["id"] for r in search_table(table, "quiet", column="text").collect()] == ["d"]
    database.load("t", rows.filter("id < 'c'"), "replace")
    refresh_indexes(table)
    assert len(open_text_index(table, "text").parts) == 1


def test_an_upsert_writes_only_its_own_postings(spark, folder):
    model = HashingEmbedder(16)
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]}, buckets=2)
    table = database.table("t")
    words = ["garden", "flat", "quiet", "loud", "room"]
    listed = [(f"k{i}", " ".join(words[: 1 + i % 5])) for i in range(40)] + [("empty", None)]
    rows = spark.createDataFrame(listed, "id string, text string").withColumn("embedding", model.column("text"))
    database.load("t", rows)
    create_text_index(table, "text", buckets=2)
    create_vector_index(table, "embedding", cells=3)
    changes = [
        ("upsert", [("k3", "garden cellar cellar"), ("new", "quiet cellar")]),
        ("update", [("k3", "loud loud garden"), ("empty", "no longer quiet")]),
        ("delete", [("k7", None), ("new", None)]),
        ("append", [("new", "a new quiet cellar")]),
        ("upsert", [("k7", None), ("k8", "garden")]),
    ]
    for mode, changed in changes:
        source = spark.createDataFrame(changed, "id string, text string").withColumn("embedding", model.column("text"))
        database.load("t", source, mode, None if mode == "append" else ["id"])
        refresh_indexes(table)
        index = open_text_index(table, "text")
        written = read_blocks(spark, f"{index.path}/postings", "id", "string").select("id").distinct().collect()
        assert {r["id"] for r in written} <= {i for i, _ in changed}
        assert index.rows == table.read().count()
        for ask in ({"strategy": "text"}, {"embedder": model}):
            stored = search_table(table, "quiet garden cellar", column="text", k=50, **ask)
            scanned = search(table.read(), "quiet garden cellar", column="text", k=50, rankings=table_rankings(table), **ask)
            assert sorted(stored.collect()) == sorted(scanned.collect())
    many = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "query_id bigint, query_text string")
    got = open_text_index(table, "text").search(table.read(), many, k=5, broadcast_rows=2).collect()
    from rankfield.operators.bm25 import bm25_scan

    assert sorted(got) == sorted(bm25_scan(table.read(), many, key="id", text="text", k=5).collect())


def test_a_repeated_key_is_not_indexed(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]})
    table = database.table("t")
    database.load("t", spark.createDataFrame([(1, "red fox")], "id bigint, text string"))
    create_text_index(table, "text")
    database.load("t", spark.createDataFrame([(1, "red red red hen"), (3, "red cow")], "id bigint, text string"), "append")
    with pytest.raises(ValueError, match="repeated key"):
        refresh_indexes(table)


def test_a_lookup_opens_only_its_buckets(spark, folder):
    database = Database.create(spark, folder, database_id="d", tables=["t"], keys={"t": ["id"]}, buckets=8)
    rows = spark.range(400).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n"))
    database.load("t", rows)
    table = database.table("t")
    found = table.lookup(["7", "absent", "7"])
    assert [tuple(r) for r in found.collect()] == [("7", 7)]
    assert 1 <= len(found.inputFiles()) < len(table.read().inputFiles())
    ids = spark.createDataFrame([("5",), ("6",), ("6",), ("none",)], "key string")
    assert sorted(tuple(r) for r in table.lookup(ids).collect()) == [("5", 5), ("6", 6)]
    assert table.lookup([]).count() == 0


def test_an_index_that_makes_its_vectors(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return model

    model = ModelEmbedder(load, 2)
    database = Database.create(spark, folder, database_id="d", tables=["u"], keys={"u": ["id"]})
    other = database.table("u")
    database.load("u", listings(spark))
    create_vector_index(other, "text", embedder=model, cells=2)
    assert calls.value == len(LISTINGS)
    found = search_table(other, "loud bar", column="text", embedder=model, k=1, columns=["id", "text"])
    assert found.columns == ["query_id", "rank", "id", "text", "_distance"]
    with pytest.raises(ValueError, match="stands alone"):
        create_text_index(other, "text")
    assert table_rankings(other).made_columns == {"text_embedding"}
    keyless = Database.create(spark, folder, database_id="e", tables=["k"])
    keyless.load("k", listings(spark))
    with pytest.raises(ValueError, match="one key column"):
        search_table(keyless.table("k"), "x", column="text")


# --------------------------------------------------------------------------- store

PLACES = {"quiet": [1.0, 0.0, 0.0], "near one": [1.0, 0.0, 0.2], "near two": [1.0, 0.0, 0.25], "far": [0.0, 1.0, 0.0]}


def places():
    vectors = dict(PLACES)

    def load():
        return lambda texts: [vectors.get(t, [0.5, 0.5, 0.5]) for t in texts]

    return load


def store(spark, folder, **options):
    options.setdefault("metadata_columns", {"city": "string", "beds": "int", "rating": "float", "live": "bool"})
    return DocumentStore(Database(spark, folder, "d"), ModelEmbedder(places(), 3), **options)


def filled(spark, folder, **options):
    docs = store(spark, folder, **options)
    docs.add_texts(
        ["near one", "near two", "far"],
        [{"city": "sf", "beds": 1}, {"city": "sf", "deep": {"list": [1, {"x": None}]}}, {"city": "nyc", "rating": 4}],
        ids=["one", "two", "far"],
    )
    return docs


def hit_ids(df):
    return [r["id"] for r in df.orderBy("rank").collect()]


def test_store_searches(spark, folder):
    docs = filled(spark, folder)
    assert hit_ids(docs.similarity_search("quiet", k=2)) == ["one", "two"]
    assert hit_ids(docs.similarity_search([1.0, 0.0, 0.0], k=2)) == ["one", "two"]
    assert hit_ids(docs.max_marginal_relevance_search("quiet", k=2)) == ["one", "far"]
    assert hit_ids(docs.max_marginal_relevance_search("quiet", k=2, lambda_mult=1.0)) == ["one", "two"]
    assert hit_ids(docs.similarity_search("quiet", k=2, filter={"city": "nyc"})) == ["far"]
    assert hit_ids(docs.max_marginal_relevance_search("quiet", k=2, filter={"city": "nyc"})) == ["far"]
    first = docs.similarity_search("far", k=1, with_distance=True, with_relevance=True).first()
    assert (first["id"], first["_distance"], first["relevance"]) == ("far", 0.0, 1.0)
    assert docs.similarity_search("quiet").columns == ["query_id", "rank", "id", "content", "metadata_json"]
    batch = spark.createDataFrame([(1, "quiet"), (2, "far")], "query_id int, query_text string")
    hits = docs.similarity_search(batch, k=1).collect()
    assert sorted((r["query_id"], r["id"]) for r in hits) == [(1, "one"), (2, "far")]


def test_store_writes(spark, folder):
    docs = filled(spark, folder)
    types = {f.name: f.dataType.simpleString() for f in docs.documents().schema.fields}
    assert types == {
        "id": "string", "content": "string", "metadata_json": "string", "embedding": "array<float>",
        "city": "string", "beds": "bigint", "rating": "double", "live": "boolean",
    }
    rows = {r["id"]: r for r in docs.documents().collect()}
    assert (rows["far"]["rating"], rows["far"]["beds"]) == (4.0, None)
    assert '"deep": {"list": [1, {"x": null}]}' in rows["two"]["metadata_json"]
    assert docs.add_texts(["changed"], ids=["one"]) == ["one"]
    assert docs.documents().count() == 3
    assert docs.get_by_ids(["one", "absent"]).first()["content"] == "changed"
    assert docs.get_by_ids([]).count() == 0
    assert docs.delete(["one", "absent"]) and docs.documents().count() == 2
    assert docs.delete([]) and docs.documents().count() == 2
    with pytest.raises(ValueError, match="ids"):
        docs.delete(None)


def test_generated_ids_are_the_stored_ones(spark, folder):
    docs = store(spark, folder)
    ids = docs.add_texts(["a", "b"], ids=["x", None])
    assert ids[0] == "x" and len(ids[1]) == 32
    frame = spark.createDataFrame([(None, "c"), (None, "d")], "id string, content string")
    more = [r["id"] for r in docs.add_documents(frame).collect()]
    assert all(len(i) == 32 for i in more)
    assert {r["id"] for r in docs.documents().collect()} == {*ids, *more}


def test_store_refuses(spark, folder):
    docs = store(spark, folder)
    assert docs.add_texts([]) == []
    for bad in ({"ids": ["a"]}, {"metadatas": [{}]}):
        with pytest.raises(ValueError, match="for 2 texts"):
            docs.add_texts(["a", "b"], **bad)
    for bad in ("", "a\x00b"):
        with pytest.raises(Exception, match="non-empty text"):
            docs.add_texts(["a"], ids=[bad])
    for wrong in ({"beds": True}, {"rating": True}, {"live": 1}, {"beds": 1.5}, {"city": 3}):
        with pytest.raises(Exception, match="declared"):
            docs.add_texts(["a"], [wrong])
    frame = spark.createDataFrame([("a", "t", '{"beds": true}')], "id string, content string, metadata_json string")
    with pytest.raises(Exception, match="declared int but holds BOOLEAN"):
        docs.add_documents(frame)
    assert docs.documents().count() == 0 and docs.similarity_search("quiet").count() == 0
    for filter, message in (({"nope": 1}, "filterable"), ({"$and": []}, "operators"), ({"city": {"$in": []}}, "operators"), ({"beds": True}, "declared int")):
        with pytest.raises(ValueError, match=message):
            docs.similarity_search("quiet", filter=filter)
    for columns, message in (({"content": "string"}, "reserved"), ({"a": "date"}, "expected one of"), ({"a b": "int"}, "identifier")):
        with pytest.raises(ValueError, match=message):
            store(spark, folder, metadata_columns=columns)
    with pytest.raises(ValueError, match="metric"):
        store(spark, folder, distance="hamming")
    with pytest.raises(ValueError, match="stored rows"):
        docs.create_index()


def test_store_index(spark, folder):
    docs = filled(spark, folder)
    assert docs.create_index(cells=2) is not None
    assert docs.create_index(cells=2) is None
    exact = docs.similarity_search("quiet", k=2, with_distance=True).collect()
    assert sorted(exact) == sorted(docs.similarity_search("quiet", k=2, with_distance=True, nprobe=2).collect())
    assert hit_ids(docs.similarity_search("quiet", k=2, filter={"city": "nyc"}, nprobe=2)) == ["far"]
    with pytest.raises(ValueError, match="metric 'cosine'"):
        store(spark, folder, distance="l2").create_index()
    docs.add_texts(["far"], ids=["new"])
    with pytest.raises(LookupError, match="No vector index"):
        docs.similarity_search("quiet", nprobe=1)


def test_metadata_keys_keep_their_case(spark, folder):
    docs = store(spark, folder, metadata_columns={"City": "string"})
    docs.add_texts(["near one", "far"], [{"City": "sf"}, {"city": "nyc"}], ids=["a", "b"])
    assert {r["id"]: r["city"] for r in docs.documents().collect()} == {"a": "sf", "b": None}
    assert hit_ids(docs.similarity_search("quiet", filter={"City": "sf"})) == ["a"]
    with pytest.raises(ValueError, match="repeated"):
        store(spark, folder, metadata_columns={"a": "int", "A": "int"})


def test_from_texts_indexes_after_writing(spark, folder):
    docs = DocumentStore.from_texts(
        Database(spark, folder, "d"), ModelEmbedder(places(), 3), ["near one", "far"], ids=["a", "b"],
        create_index=True, table="made",
    )
    assert hit_ids(docs.similarity_search("quiet", k=1, nprobe=2)) == ["a"]


@pytest.mark.parametrize(
    "document, kind, expected",
    [
        ('{"k": 3}', "int", 3), ('{"k": 3}', "float", 3.0), ('{"k": 2.5}', "float", 2.5),
        ('{"k": 1e3}', "float", 1000.0), ('{"k": true}', "bool", True), ('{"k": "x"}', "string", "x"),
        ('{"k": null}', "int", None), ("{}", "bool", None),
    ],
)
def test_promotion(spark, document, kind, expected):
    df = spark.createDataFrame([(document,)], "metadata_json string")
    assert promote_metadata(df, {"k": kind}).first()["k"] == expected


@pytest.mark.parametrize(
    "document, kind",
    [('{"k": true}', "int"), ('{"k": true}', "float"), ('{"k": 2.5}', "int"), ('{"k": "3"}', "int"), ('{"k": 1}', "bool"), ('{"k": [1]}', "string")],
)
def test_promotion_refuses_other_kinds(spark, document, kind):
    df = spark.createDataFrame([(document,)], "metadata_json string")
    with pytest.raises(Exception, match=f"declared {kind} but holds"):
        promote_metadata(df, {"k": kind}).collect()


def test_a_served_table_embeds_each_document_once(spark, sf_dir, monkeypatch):
    """What is appended later is filtered before it is embedded, and so is the rest."""
    seen = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            seen.add(len(texts))
            return [[1.0, float(len(t))] for t in texts]

        return model

    monkeypatch.setattr(retrieval, "EMBEDDER", ModelEmbedder(load, 2))
    rows = retrieval.served_table(spark, sf_dir).read()
    assert seen.value == rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
