"""Archives, URL rules, vectors, the queries and the pipeline."""

import gzip
import io
import math

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankfield.llm import lines, urls, vectors, warc
from rankfield.llm.queries import ORACLES, QUERIES

# Archives

PAGES = "page_id bigint, url string, html string, payload int, headers string"
PAGE_ROWS = [
    (3, "http://a/\r\nx", "é" * 60, 1, "h"),
    (1, None, "é" * 60, None, None),
    (2, "http://b/", "short", 2, "h"),
    (4, "http://b/", "short", 2, "h"),
    (5, "http://c/", None, 3, "h"),
    (6, "http://d/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 9000, 3, "h"),
    (None, "http://e/", "é" * 60, None, None),
    (1, None, "é" * 60, None, None),
]


def test_archive_round_trip(spark, folder):
    pages = spark.createDataFrame(PAGE_ROWS, PAGES).repartition(3)
    path = f"file://{folder}/warc"
    warc.write_warc(warc.page_records(pages), path)
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == len(PAGE_ROWS)
    stored = sorted((r["record_id"] or "", bytes(r["payload"]).decode()) for r in rows if r["record_type"] == "response")
    assert stored == sorted(
        [("<urn:page:1>", "é" * 60)] * 2
        + [("<urn:page:2>", "short"), ("<urn:page:4>", "short"), ("<urn:page:5>", ""), ("<urn:page:6>", PAGE_ROWS[5][2])]
    )
    again = [r for r in rows if r["record_type"] == "revisit"]
    assert {r["refers_to"] for r in again} == {"<urn:page:1>"} and len(again) == 2
    assert all(bytes(r["payload"]) == b"" and r["headers"]["x-payload-length"] == "120" for r in again)
    assert "http://a/%0D%0Ax" in {r["target_uri"] for r in rows}


def test_predicates_reach_the_headers(spark, folder):
    warc.write_warc(warc.page_records(spark.createDataFrame(PAGE_ROWS, PAGES)), folder)
    wanted = warc.read_warc(spark, folder).filter("target_uri = 'http://b/' AND record_type IN ('response')")
    assert sorted(r["record_id"] for r in wanted.collect()) == ["<urn:page:2>", "<urn:page:4>"]
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "http://b/" not in plan  # nothing is left for Spark to test
    heads = warc.read_warc(spark, folder, **{"payload": "false", "header.x-payload-length": "5"}).collect()
    assert len(heads) == 2 and all(r["payload"] is None for r in heads)


def test_unwanted_payloads_are_not_read():
    wide = {"record_type": "response", "record_id": "1", "target_uri": None, "refers_to": None, "payload_digest": None}
    noise = np.random.default_rng(1).bytes(1 << 20)
    packed = warc.member(warc.record_bytes({**wide, "payload": noise, "payload_bytes": len(noise)}, "d"))

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            self.taken += len(data)
            return data

        def size(self):
            return len(self.getvalue())

    source = Counted(packed * 3)
    assert list(warc.records(source, lambda headers: False)) == []
    assert source.taken < 20_000



class Counted(io.BytesIO):
    """A file that counts what is read of it."""

    taken = 0

    def read(self, size=-1):
        found = super().read(size)
        self.taken += len(found)
        return found


def test_a_payload_nobody_asks_for_is_not_read():
    row = {"record_type": "response", "record_id": "r", "target_uri": "http://a/", "refers_to": None}
    bodies = [np.random.default_rng(i).bytes(300_000) for i in range(3)]
    members = [
        warc.member(
            warc.record_bytes({**row, "payload": body, "payload_bytes": len(body), "payload_digest": None}, "d")
        )
        for body in bodies
    ]
    file = Counted(b"".join(members))
    assert len(list(warc.records(file, lambda headers: True))) == 3
    assert file.taken < 20_000
    assert [payload() for _, payload in warc.records(io.BytesIO(file.getvalue()), lambda headers: True)] == bodies
    lost = io.BytesIO(file.getvalue()[:-1])
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(lost, lambda headers: True))


def test_archives_are_read_by_header_predicates(spark, sf_dir):
    plan = QUERIES["op4_warc"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # Spark tests neither kind again: the reader has taken both tests.
    assert plan.count("BatchScan") == 2
    assert not any("= re" in line for line in plan.splitlines() if "Filter" in line and "Scan" not in line)


def test_foreign_archives_are_read(tmp_path, spark):
    row = {"record_type": "response", "target_uri": "http://a/", "refers_to": None, "payload_digest": None}
    raw = [
        warc.record_bytes({**row, "record_id": str(i), "payload": b"x" * i, "payload_bytes": i}, "d")
        for i in (0, 5, 70_000)
    ]
    (tmp_path / "plain.warc").write_bytes(b"".join(raw))
    # Members without their length in the header have to be inflated to their end.
    (tmp_path / "other.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in raw))
    (tmp_path / "left.tmp").write_bytes(b"no archive")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(len(r["payload"]) for r in rows) == [0, 0, 5, 5, 70_000, 70_000]
    some = warc.read_warc(spark, str(tmp_path)).filter("record_id = '5'").collect()
    assert [bytes(r["payload"]) for r in some] == [b"xxxxx"] * 2


@pytest.mark.parametrize("length", [10_000, 20_000, 1 << 20])
def test_long_urls(spark, folder, length):
    url = "http://a/" + "x" * length
    pages = [(1, url, None), (2, url, "short"), (3, url, "é" * 60), (4, url, "é" * 60), (5, "http://b/", "other")]
    warc.write_warc(warc.page_records(spark.createDataFrame(pages, "page_id bigint, url string, html string")), folder)
    rows = {r["record_id"][10:-1]: r for r in warc.read_warc(spark, folder).collect()}
    assert [rows[str(i)]["target_uri"] for i in range(1, 6)] == [url] * 4 + ["http://b/"]
    assert [bytes(rows[str(i)]["payload"]).decode() for i in range(1, 6)] == ["", "short", "é" * 60, "", "other"]
    assert rows["4"]["refers_to"] == "<urn:page:3>"


@pytest.mark.parametrize("length", [*range(7_900, 8_300, 7), *range(16_200, 16_500, 7), 1 << 20])
def test_headers_of_any_length_are_inflated_whole(length):
    row = {"record_type": "response", "record_id": "1", "refers_to": None, "payload_digest": None}
    row |= {"target_uri": "x" * length, "payload": b"", "payload_bytes": 0}
    record = warc.record_bytes(row, "d")
    for packed in (warc.member(record), gzip.compress(record)):
        found = list(warc.records(io.BytesIO(packed * 2), lambda headers: True))
        assert [len(h["warc-target-uri"]) for h, _ in found] == [length] * 2
        with pytest.raises(ValueError, match="ends within"):
            list(warc.records(io.BytesIO(packed[: len(packed) // 2]), lambda headers: True))


def test_uncommitted_files_are_not_read(spark, folder):
    warc.write_warc(warc.page_records(spark.createDataFrame(PAGE_ROWS, PAGES)), folder)
    with open(f"{folder}/part-lost.warc.gz", "wb") as out:
        out.write(b"half a record")
    assert warc.read_warc(spark, folder).count() == len(PAGE_ROWS)


def test_no_pages(spark, folder):
    warc.write_warc(warc.page_records(spark.createDataFrame([], PAGES)), folder)
    assert warc.read_warc(spark, folder).count() == 0


# URL rules

RULES = [("com", "/", "allow"), ("b.com", "/x", "block"), ("b.com", "/x", "block"), (None, "/", "block"), ("c", "", "block")]


def judged(spark, rows, rules=RULES, **options):
    pages = spark.createDataFrame(rows, "page_id int, url string, rule int, host string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    found = urls.url_verdicts(pages, table, **options)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    return [(r["page_id"] or -1, r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()]


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_url_rules(spark, blocks):
    rows = [
        (1, "http://B.com/xy?q#f", 1, "h"), (2, "https://a.b.com/y", None, None), (3, "http://ab.com", 1, "h"),
        (4, "no scheme", 1, "h"), (5, None, 1, "h"), (6, "ftp://x.c?z", 1, "h"), (6, "ftp://x.c?z", 1, "h"),
        (7, "", 1, "h"), (8, "http:///x", 1, "h"), (None, "a://b.com/x://c", 1, "h"), (9, "http://ab.com/x", 1, "h"),
    ]
    want = (
        [
            (1, "b.com", "/xy", "b.com/x", "block"), (2, "a.b.com", "/y", "com/", "allow"),
            (3, "ab.com", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
            (6, "x.c", "", "c", "block"), (6, "x.c", "", "c", "block"), (7, "", "", None, "allow"),
            (8, "", "/x", None, "allow"), (-1, "b.com", "/x://c", "b.com/x", "block"),
            (9, "ab.com", "/x", "com/", "allow"),
        ]
    )
    assert sorted(judged(spark, rows, blocks=blocks), key=str) == sorted(want, key=str)


def test_no_rules_and_no_pages(spark):
    assert judged(spark, [(1, "http://a.com/", 1, "h")], []) == [(1, "a.com", "/", None, "allow")]
    assert judged(spark, []) == []


def test_the_filter_passes_all_listed_keys(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("/").alias("path"))
    others = spark.range(3000).select(F.concat(F.lit("o"), "id").alias("host"), F.lit("/").alias("path"))
    bloom = urls.blocked_bloom(keys, 1024)
    assert bloom.count() <= 1024
    assert urls.possible(keys, bloom, 1024).count() == 3000
    assert urls.possible(others, bloom, 1024).count() < 100


# Vectors


def nearest(rows, k):
    """{query: [(vec_id, score)]} over all usable rows."""
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, query in good:
        if q % 20 == 0:
            found = sorted(((-float((v * query).sum()), i) for i, v in good if i != q))[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def found_in(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_the_table(spark, sf_dir):
    got = found_in(QUERIES["op8_nearest_neighbours"](spark, sf_dir))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = nearest(rows, 20)
    assert got.keys() == want.keys()
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    exact = dict(rows)
    for q, pairs in got.items():
        for i, score in pairs:
            assert score == pytest.approx(float(np.dot(np.array(exact[q], float), np.array(exact[i], float))), abs=1e-12)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]),
            (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (20, [3.0, -1.0]), (9, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    df = df.withColumns({"vector": F.lit("clash"), "c1": F.lit(0), "rank": F.lit(1)})
    got = found_in(vectors.search_neighbours(df, F.col("vec_id") % 20 == 0, k=20))
    assert got == nearest(rows, 20)
    assert [i for i, _ in got[0]] == [1, 2, 20]
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vectors.search_neighbours(empty, F.col("vec_id") % 20 == 0).count() == 0
    single = spark.createDataFrame([(0, [2.0]), (1, [-1.0])], "vec_id bigint, embedding array<float>")
    assert found_in(vectors.search_neighbours(single, F.col("vec_id") == 0)) == {0: [(1, -2.0)]}


def test_chunks_and_blocks_do_not_matter(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=4).round(1).tolist()) for i in range(200)] + [(300 + i, [1.0] * 4) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(vectors, "RECALL", 1.0)
    monkeypatch.setattr(vectors, "CHUNK", 7)
    monkeypatch.setattr(vectors, "BLOCK", 3)
    index = vectors.InvertedMultiIndex.build(df)
    queries = index.cells.filter("vec_id % 20 = 0").select("vec_id", "vector")
    got, want = found_in(index.search(queries, k=5, recall=1.0)), nearest(rows, 5)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) > 0.95


def test_pairs_of_codes_come_by_falling_sum():
    draw = np.random.default_rng(3)
    a, b = draw.normal(size=7), draw.normal(size=5)
    seen = [(i, j) for i, j, _ in vectors.traverse(a, b, np.ones((7, 5), int))]
    sums = [a[i] + b[j] for i, j in seen]
    assert len(set(seen)) == 35 and sums == sorted(sums, reverse=True)


# Queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert oracle.compare(spark, sf_dir, QUERIES[name], ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def passages(data):
    starts, ends = lines.passage_spans(lines.Lines(data))
    return list(zip(starts.tolist(), ends.tolist()))


def test_pipeline(spark, sf_dir):
    """Each stage's decisions, each judged on its own input."""
    import brute

    from rankfield.llm import quality

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, tables[-1], sf_dir)
        tables.append(spark.createDataFrame(out.toArrow()))
    assert all(t.columns == columns for t in tables[:-1])
    rows = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~quality.held_out("doc_id"))
    good = quality.score_quality(docs, labels).filter("predicted = 1").collect()
    assert rows[1] == {r["doc_id"]: r["text"] for r in good}

    cleaned = brute.repeated_passages(list(rows[1].items()), passages)
    assert rows[2] == {k: t for k, (t, n) in cleaned.items() if t or not n}

    near = brute.near_duplicates(list(rows[2].items()), 5, 80)
    assert set(rows[3]) == {k for k, (_, _, kept) in near.items() if kept}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    report = brute.contamination(list(rows[3].items()), items, 13, 20)
    assert rows[4] == {k: t for k, t in rows[3].items() if not report[k][4]}

    assert {r["doc_id"] for r in tables[5].collect()} == set(rows[4])
    assert corpus_pipeline.run(spark, sf_dir).count() == tables[5].count()


def test_pipeline_packs_repeated_rows_once(spark, sf_dir, folder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    keyless = docs.withColumn("doc_id", F.lit(None).cast(docs.schema["doc_id"].dataType))
    fresh = keyless.withColumn("text", F.concat(F.reverse("text"), F.lit(" alone")))
    docs.union(docs).union(fresh).union(fresh).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    rows = corpus_pipeline.run(spark, folder).select("doc_id", "ids_crc32", "piece", "start", "length").collect()
    assert rows and len(rows) == len(set(rows))
