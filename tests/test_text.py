import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankfield.operators import bm25 as bm25_module
from rankfield.operators.bm25 import bm25_scan, idf_values
from rankfield.operators.fusion import fetch_depth, fuse, hybrid
from rankfield.operators.topk import SCORE_DECIMALS, RunningTopK
from rankfield.sources import blocks, postings
from rankfield.sources.postings import PostingsIndex

TEXTS = [
    "quiet garden by the sea",
    "a garden, a Garden and a garden gate",
    "noisy street",
    "the quiet street behind the garden",
    "",
    None,
    "quiet quiet quiet",
] + ["the quiet garden"] * 8


def corpus(spark, texts=TEXTS):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id bigint, text string").repartition(3)


def queries(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query_text string")


def brute(texts, query):
    split = [re.findall(r"[^\W_]+", (t or "").lower()) for t in texts]
    average = sum(map(len, split)) / len(split)
    scores = {}
    for term in set(re.findall(r"[^\W_]+", query.lower())):
        df = sum(term in words for words in split)
        idf = math.log(1 + (len(split) - df + 0.5) / (df + 0.5))
        for i, words in enumerate(split):
            tf = Counter(words)[term]
            if tf:
                norm = 1.2 * (0.25 + 0.75 * len(words) / average)
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + norm)
    return {i: round(s, 9) for i, s in scores.items()}


ASKED = ["quiet garden", "Garden garden gate!", "street", "nothing here matches"]


@pytest.mark.parametrize("broadcast_rows", [8192, 1])
def test_pool_matches_brute_force(spark, broadcast_rows):
    pool = bm25_scan(
        corpus(spark), queries(spark, ASKED), key="id", text="text", broadcast_rows=broadcast_rows
    )
    assert pool.columns == ["query_id", "id", "score"]
    got = {(r["query_id"], r["id"]): r["score"] for r in pool.collect()}
    want = {(q, i): s for q, text in enumerate(ASKED) for i, s in brute(TEXTS, text).items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=2e-9) for k in want)


@pytest.mark.parametrize("broadcast_rows", [8192, 1])
def test_ranks_and_copies(spark, broadcast_rows):
    """A third of the rows are copies of one text; they rank by key, none is dropped."""
    hits = bm25_scan(
        corpus(spark), queries(spark, ASKED), key="id", text="text", k=6,
        columns=["text"], broadcast_rows=broadcast_rows,
    )
    assert hits.columns == ["query_id", "rank", "id", "text", "score"]
    for q, text in enumerate(ASKED):
        scores = brute(TEXTS, text)
        want = sorted(scores, key=lambda i: (-scores[i], i))[:6]
        rows = sorted((r["rank"], r["id"]) for r in hits.collect() if r["query_id"] == q)
        assert rows == list(enumerate(want, start=1))


def test_many_terms_take_the_joined_form(spark, monkeypatch):
    monkeypatch.setattr(bm25_module, "BROADCAST_TERMS", 2)
    one = bm25_scan(corpus(spark), query="quiet garden street", key="id", text="text", k=5)
    monkeypatch.undo()
    other = bm25_scan(corpus(spark), query="quiet garden street", key="id", text="text", k=5)
    assert sorted(one.collect()) == sorted(other.collect())


@pytest.mark.parametrize("cells", [1, 3, 7, 20])
def test_small_pieces_give_the_same_scores(spark, monkeypatch, cells):
    whole = bm25_scan(corpus(spark), queries(spark, ASKED), key="id", text="text")
    want = sorted(whole.collect())
    monkeypatch.setattr(bm25_module, "SCORE_CELLS", cells)
    pieces = bm25_scan(corpus(spark), queries(spark, ASKED), key="id", text="text")
    assert sorted(pieces.collect()) == want


def small_shards(monkeypatch):
    monkeypatch.setattr(blocks, "SHARD_ROWS", 5)
    monkeypatch.setattr(blocks, "SEGMENT_ROWS", 2)


def test_many_queries_in_small_groups(spark, monkeypatch):
    small_shards(monkeypatch)
    asked = queries(spark, [f"{a} {b}" for a in ("quiet", "the", "sea", "no") for b in ("garden", "street")])
    got = bm25_scan(corpus(spark), asked, key="id", text="text", k=4, broadcast_rows=2)
    monkeypatch.undo()
    want = bm25_scan(corpus(spark), asked, key="id", text="text", k=4)
    assert sorted(got.collect()) == sorted(want.collect())


def test_query_text_is_data(spark):
    hits = bm25_scan(corpus(spark), query="'); DROP TABLE x; -- sea", key="id", text="text", k=3)
    assert [r["id"] for r in hits.collect()] == [0]
    assert bm25_scan(corpus(spark), query="?!", key="id", text="text", k=3).count() == 0
    with pytest.raises(ValueError, match="null bytes"):
        bm25_scan(corpus(spark), query="a\x00b", key="id", text="text")


def test_own_score_column_is_dropped(spark):
    table = corpus(spark).withColumn("score", F.lit(5))
    hits = bm25_scan(table, query="sea", key="id", text="text", k=1, columns=["score", "text"])
    assert hits.columns == ["query_id", "rank", "id", "text", "score"]
    assert hits.first()["score"] < 5
    with pytest.raises(ValueError, match="empty"):
        bm25_scan(table, query="sea", key="id", text="text", k=1, columns=[])
    with pytest.raises(ValueError, match="k must be"):
        bm25_scan(table, query="sea", key="id", text="text", k=0)


@pytest.mark.parametrize("broadcast_rows, batch", [(8192, 10_000), (8192, 2), (1, 10_000)])
def test_index_gives_the_scan_answer(spark, folder, broadcast_rows, batch):
    """Also when a row's postings are spread over batches, and for many queries."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, batch)
    try:
        _index_gives_the_scan_answer(spark, folder, broadcast_rows)
    finally:
        spark.conf.set(setting, before)


def _index_gives_the_scan_answer(spark, folder, broadcast_rows):
    docs = corpus(spark)
    index = PostingsIndex.build(docs, key="id", text="text", path=f"{folder}/ix", buckets=4)
    index = PostingsIndex.open(spark, index.path)
    assert (index.rows, index.words) == (len(TEXTS), sum(len((t or "").split()) for t in TEXTS))
    for k in (4, None):
        got = index.search(
            docs, queries(spark, ASKED), k=k, columns=["text"], broadcast_rows=broadcast_rows
        )
        want = bm25_scan(docs, queries(spark, ASKED), key="id", text="text", k=k, columns=["text"])
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_index_reads_only_the_buckets_of_its_words(spark, folder):
    index = PostingsIndex.build(corpus(spark), key="id", text="text", path=f"{folder}/ix", buckets=16)
    assert len(list(Path(folder, "ix", "terms").glob("bucket=*"))) > 1
    asked = queries(spark, ["sea"])
    read = index.scores(asked, query_key="query_id", query_text="query_text", k=2)
    assert "Exchange" not in plan_of(read) and "postings" not in plan_of(read)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_search_shuffles_no_postings(spark, folder, monkeypatch):
    """What a search shuffles is ``k`` rows per query and task; many queries, too."""
    small_shards(monkeypatch)
    index = PostingsIndex.build(corpus(spark), key="id", text="text", path=f"{folder}/ix")
    for rows in (8192, 1):
        names = {"query_key": "query_id", "query_text": "query_text", "broadcast_rows": rows}
        scored = index.scores(queries(spark, ASKED), k=2, **names)
        assert "Exchange" not in plan_of(scored)
        tasks = scored.rdd.getNumPartitions()
        most = scored.groupBy("query_id").count().agg(F.max("count")).first()[0]
        assert most <= 2 * tasks


def one_shard(spark, folder, monkeypatch):
    """Rows with the words of a query together are in few segments of one shard."""
    monkeypatch.setattr(blocks, "LEAST_SHARDS", 1)
    monkeypatch.setattr(blocks, "SEGMENT_ROWS", 50)
    texts = [f"garden {'sea ' * 5 if i % 500 == 3 else 'street wall door house gate'}" for i in range(2000)]
    docs = corpus(spark, texts)
    return docs, PostingsIndex.build(docs, key="id", text="text", path=f"{folder}/ix")


def test_segments_that_score_too_low_are_not_read(spark, folder, monkeypatch):
    docs, index = one_shard(spark, folder, monkeypatch)
    places = index._places(spark, None)
    assert [p.shards for p in places] == [1]
    words = pa.array(["garden", "sea"])
    weight = idf_values(2000, np.array([2000, 4]))
    ids, starts, members = pa.array([0]), np.array([0, 1, 2]), np.array([0, 0])
    asked = bm25_module.Asked(ids, words, starts, members, weight, index.words / 2000)
    read = []
    whole = blocks._Shard.postings
    monkeypatch.setattr(blocks._Shard, "postings", lambda self, some: read.extend(some) or whole(self, some))
    best = RunningTopK(1, 3, SCORE_DECIMALS)
    list(blocks.score_shard(places[0], 0, asked, ["garden", "sea"], best, ["q", "id", "s"], pa.int64()))
    assert len(read) == len(set(read)) <= 7
    found = pa.Table.from_batches(best.batches(ids, ["q", "id", "s"]))
    assert found["id"].to_pylist() == [3, 503, 1003]
    assert sorted(index.search(docs, query="garden sea", k=9).collect()) == sorted(
        bm25_scan(docs, query="garden sea", key="id", text="text", k=9).collect()
    )


def test_row_groups_without_the_words_are_not_read(spark, folder, monkeypatch):
    monkeypatch.setattr(blocks, "LEAST_SHARDS", 1)
    monkeypatch.setattr(blocks, "GROUP_BYTES", 1)
    docs = corpus(spark, [f"word{i} other{i} common" for i in range(1500)])
    index = PostingsIndex.build(docs, key="id", text="text", path=f"{folder}/ix")
    (file,) = blocks._files(f"{index._places(spark, None)[0].postings}/shard=0")
    groups = [file.metadata.row_group(i) for i in range(file.num_row_groups)]
    assert len(groups) > 5
    assert 1 <= sum(blocks._may_hold(g, ["word77"]) for g in groups) <= 2
    assert [r["id"] for r in index.search(docs, query="word77", k=5).collect()] == [77]


@pytest.mark.parametrize("rows", [8192, 1])
def test_a_changed_index_is_searched_by_shard(spark, folder, monkeypatch, rows):
    """Void rows and a filter are looked up by shard, in parts of different size."""
    small_shards(monkeypatch)
    old = corpus(spark)
    index = PostingsIndex.build(old, key="id", text="text", path=f"{folder}/words-0")
    gone = old.filter("id IN (0, 3, 7)")
    added = spark.createDataFrame([(3, "sea sea garden"), (40, "quiet sea")], "id bigint, text string")
    index = PostingsIndex.open(spark, index.change(added, gone))
    lost = added.filter("id = 3")
    more = spark.createDataFrame([(i, f"garden {i}") for i in range(50, 70)], "id bigint, text string")
    index = PostingsIndex.open(spark, index.change(more, lost))
    now = old.join(gone, "id", "left_anti").unionByName(added.filter("id = 40")).unionByName(more)
    for k in (3, None):
        for where in (None, F.col("id") % 2 == 0):
            got = index.search(now, queries(spark, ASKED), k=k, where=where, broadcast_rows=rows)
            want = bm25_scan(now, queries(spark, ASKED), key="id", text="text", k=k, where=where)
            assert sorted(got.collect()) == sorted(want.collect())


def test_a_store_that_arrow_cannot_open_is_searched_by_spark(spark, folder, monkeypatch):
    docs = corpus(spark)
    index = PostingsIndex.build(docs, key="id", text="text", path=f"{folder}/ix")
    monkeypatch.setattr(postings, "_opens", lambda uri: False)
    for rows in (8192, 1):
        got = index.search(docs, queries(spark, ASKED), k=3, where=F.col("id") > 1, broadcast_rows=rows)
        want = bm25_scan(docs, queries(spark, ASKED), key="id", text="text", k=3, where=F.col("id") > 1)
        assert sorted(got.collect()) == sorted(want.collect())


def test_keys_of_other_types(spark, folder):
    """Text and timestamp keys come back as they were."""
    docs = corpus(spark)
    for kind in ("CAST(id AS STRING)", "timestamp_seconds(id)", "CAST(id AS DECIMAL(20, 2))"):
        own = docs.select(F.expr(kind).alias("id"), "text")
        index = PostingsIndex.build(own, key="id", text="text", path=f"{folder}/{len(kind)}-ix")
        got = index.search(own, query="quiet garden", k=4).collect()
        assert got == bm25_scan(own, query="quiet garden", key="id", text="text", k=4).collect()


def test_index_refuses_repeated_keys(spark, folder):
    twice = corpus(spark).unionByName(corpus(spark))
    with pytest.raises(ValueError, match="repeated key"):
        PostingsIndex.build(twice, key="id", text="text", path=f"{folder}/ix")


def test_one_word_in_every_row_is_many_tasks(spark, folder):
    """A bucket holding one common word is split when written, and nothing is lost."""
    docs = spark.range(20_000).select("id", F.lit("common").alias("text"))
    index = PostingsIndex.build(docs, key="id", text="text", path=f"{folder}/ix", buckets=2)
    assert index.postings(spark).count() == 20_000
    assert index.search(docs, query="common").count() == 20_000


@pytest.mark.parametrize("k, fetch_k, depth", [(5, None, 20), (50, None, 200), (5, 30, 30), (40, 10, 40)])
def test_fetch_depth(k, fetch_k, depth):
    assert fetch_depth(k, fetch_k) == depth


def ranks(spark, ids):
    rows = [(0, r, i) for r, i in enumerate(ids, start=1)]
    return spark.createDataFrame(rows, "query_id int, rank bigint, id string")


def test_fusion_adds_reciprocal_ranks(spark):
    hits = fuse(
        ranks(spark, ["a", "b", "c"]), ranks(spark, ["c", "d", "a"]), key="id",
        query_key="query_id", k=10,
    ).orderBy("rank")
    assert [(r["id"], r["score"]) for r in hits.collect()] == [
        ("a", round(1 / 61 + 1 / 63, 12)),
        ("c", round(1 / 61 + 1 / 63, 12)),
        ("b", round(1 / 62, 12)),
        ("d", round(1 / 62, 12)),
    ]
    with pytest.raises(ValueError, match="rrf_k"):
        fuse(ranks(spark, ["a"]), ranks(spark, ["a"]), key="id", query_key="query_id", k=1, rrf_k=0)


def test_hybrid_uses_ranks_and_never_returns_the_vector(spark):
    docs = spark.createDataFrame(
        [(1, "red apple", [1.0, 0.0]), (2, "green apple", [0.0, 1.0]), (3, "stone", [0.9, 0.1]),
         (4, "red red apple", None)],
        "id bigint, text string, embedding array<float>",
    )
    hits = hybrid(docs, query="red apple", query_vector=[1.0, 0.0], key="id", text="text", k=4)
    assert hits.columns == ["query_id", "rank", "id", "text", "score"]
    assert hits.orderBy("rank").first()["id"] == 1
    assert hits.count() == 4
    scaled = docs.withColumn("embedding", F.transform("embedding", lambda x: x * 100))
    again = hybrid(scaled, query="red apple", query_vector=[7.0, 0.0], key="id", text="text", k=4)
    assert sorted(hits.collect()) == sorted(again.collect())
    with pytest.raises(ValueError, match="both"):
        hybrid(docs, query="red", key="id", text="text")


def test_a_task_makes_the_blocks_of_its_segments(monkeypatch):
    """Blocks leave a task whole; a segment of too many postings goes on under a free number."""
    rows = pa.RecordBatch.from_pylist(
        [
            {"shard": 0, "segment": s, "key": k, "terms": ["a", f"w{k % 2}"], "tfs": [k, 1], "doc_len": k + 1}
            for s in (0, 1)
            for k in range(10 * s, 10 * s + 6)
        ],
        schema=pa.schema(
            [("shard", pa.int32()), ("segment", pa.int32()), ("key", pa.int64())]
            + [("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32())), ("doc_len", pa.int32())]
        ),
    )
    for most, numbers in ((100, {0, 1}), (8, {0, 1, 2, 3})):
        monkeypatch.setattr(blocks, "MOST_POSTINGS", most)
        for step in (1, 5, 100):
            cut = [rows.slice(at, step) for at in range(0, rows.num_rows, step)]
            found = [r for b in blocks._gather(2)(iter(cut)) for r in b.to_pylist()]
            assert {r["segment"] for r in found} == numbers
            assert len({(r["term"], r["segment"]) for r in found}) == len(found)
            a = [r for r in found if r["term"] == "a"]
            assert sorted(k for r in a for k in r["keys"]) == [*range(6), *range(10, 16)]
            assert all(r["keys"] == r["tfs"] and r["most_tf"] == max(r["tfs"]) for r in a)
            assert all(r["lens"] == [k + 1 for k in r["keys"]] and r["least_len"] == min(r["lens"]) for r in found)


def test_shards_stay_small_enough_to_sort_in_memory():
    """The rows that one task sorts do not grow with the table beyond a few ten thousand."""
    assert all(-(-rows // blocks.shards_for(rows)) <= 40_000 for rows in (10**5, 10**6, 10**7))
