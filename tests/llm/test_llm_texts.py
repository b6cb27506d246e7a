"""The operators on texts, against brute force and on odd tables."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rankfield.llm import bpe, decontaminate, lines, minhash, packing, quality, suffixes, tokens

DOCS = "doc_id bigint, text string"

#: Nulls, empty and long texts, repeated rows, and columns named like the operators' own.
ODD = "doc_id bigint, text string, row string, id int, n_bytes string, kept string, score int, sequence_id int"
ODD_ROWS = [
    (1, "same words in both of these rows\nand a second line", "r", 1, "x", "k", 5, 6),
    (1, "same words in both of these rows\nand a second line", "r", 1, "x", "k", 5, 6),
    (1, "another text under the same key", None, None, None, None, None, None),
    (None, "a text without a key", "r", 2, "y", None, 7, 8),
    (None, None, None, None, None, None, None, None),
    (2, "", "", 3, "", "", 0, 0),
    (3, "word " * 30_000, "r", 4, "z", "k", 1, 1),
    (4, None, "r", 5, "x", "k", 2, 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


def test_row_ids_keep_all_columns(spark):
    from rankfield.llm.common import with_row_id

    df = spark.createDataFrame([(1, "a", "k", "h"), (1, "b", "k", "h"), (None, "c", "k", "h")], "n int, text string, k string, h string")
    marked, name, plain = with_row_id(df, "n", "text")
    assert marked.columns == [*df.columns, name] and not plain
    order = [r["n"] for r in marked.orderBy(name).collect()]
    assert order == [1, 1, None] and marked.select(name).distinct().count() == 3
    _, _, plain = with_row_id(df.filter("text = 'a'"), "n", "text")
    assert plain


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def made_up(seed, parts, count, most):
    draw = random.Random(seed)
    return [(i * 3, "".join(draw.choice(parts) for _ in range(draw.randint(0, most)))) for i in range(count)]


# Tokens


def test_ids_are_those_of_the_tokenizers_library():
    draw = random.Random(5)
    pool = ["a", " ", "\n", "'s", "é", "1", ".", "\u3000", "\t", "\x1c", "\x85", "  ", "<|endoftext|>"]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    mine = bpe.load(None)
    assert [mine.ids(t) for t in texts] == [
        e.ids for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_section_counts(spark, sample):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(sample, DOCS)
    rows = tokens.count_section_tokens(df, F.split("text", r"(?<=\n)")).collect()
    library = Tokenizer.from_file(bpe.default_vocabulary())
    for r in rows:
        encoded = library.encode(r["text"], add_special_tokens=False)
        assert list(r["section_tokens"]) == brute.line_counts(r["text"], encoded)


def test_section_rule_and_fields(spark):
    # A token over a boundary goes to the larger part, and to the earlier of equal parts.
    bounds = np.array([0, 2, 3, 10])
    assert tokens.attribute(np.array([0, 1, 1, 3]), np.array([1, 3, 5, 4]), bounds).tolist() == [0, 0, 2, 2]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "hello", " world"), (2, None, "x"), (3, None, None)], "k int, a string, b string")
    rows = tokens.count_section_tokens(df, [F.col("a"), F.col("b")]).orderBy("k").collect()
    assert [list(r["section_tokens"]) for r in rows] == [[1, 1], [0, 1], [0, 0]]


def test_section_counts_of_odd_tables(spark, odd, nothing):
    from pyspark.sql import functions as F

    counted = tokens.count_section_tokens(odd, [F.col("text"), F.col("row")])
    assert counted.columns == [*odd.columns, "section_tokens", "crossing"]
    assert counted.count() == len(ODD_ROWS)
    assert tokens.count_section_tokens(nothing, [F.col("text")]).count() == 0


# Packing


def test_pieces_and_places(spark, sample):
    import zlib

    library = Tokenizer.from_file(bpe.default_vocabulary())
    got = {}
    for r in packing.pack_documents(spark.createDataFrame(sample, DOCS), capacity=256).collect():
        got[r["doc_id"], r["piece"]] = r
    seen = 0
    for key, text in sample:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        start = 0
        for piece, length in enumerate(brute.pieces(ids, 256)):
            r = got[key, piece]
            part = np.array(ids[start : start + length], "<u4").tobytes()
            assert (r["start"], r["length"], r["ids_crc32"]) == (start, length, zlib.crc32(part))
            start, seen = start + length, seen + 1
    assert seen == len(got)
    check_sequences(list(got.values()), 256)


def check_sequences(rows, capacity, within=1.02):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(bins) <= max(least * within, least + 2)


def test_rounds_merge_what_tasks_leave(spark):
    draw = random.Random(3)
    items = [(i, draw.choice([3, 5, 11, 40, 63, 64])) for i in range(900)]
    df = spark.createDataFrame(items, "k int, length int").repartition(30)
    rows = packing.pack(df, capacity=64, slack=0, round_items=100).collect()
    assert sorted((r["k"], r["length"]) for r in rows) == sorted(items)
    _, together = packing.best_fit(np.array([n for _, n in items]), 64)
    assert len({r["sequence_id"] for r in rows}) <= together * 1.04
    check_sequences(rows, 64, 1.1)


def test_best_fit_takes_the_fullest_bin():
    bin_of, count = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert count == 2 and bin_of.tolist() == [0, 1, 0, 1, 1]
    assert packing.best_fit(np.zeros(3, np.int64), 4)[1] == 1


def test_packing_odd_tables(spark, odd, nothing):
    rows = packing.pack_documents(odd).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(ODD_ROWS)
    assert sum(r["doc_id"] is None for r in rows) == 2
    check_sequences(rows, 2048)
    assert packing.pack_documents(nothing).count() == 0
    with pytest.raises(Exception, match="above 4"):
        packing.pack(spark.createDataFrame([(5,)], "length int"), capacity=4).collect()
    kept = packing.token_pieces(odd, keep_ids=True).filter("doc_id = 2").collect()
    assert [list(r["ids"]) for r in kept] == [[0]]


# Near duplicates


def families(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(4):
        base = [draw.choice(words) for _ in range(60)]
        for _ in range(15):
            changed = list(base)
            for _ in range(draw.randint(0, 3)):
                changed[draw.randrange(60)] = draw.choice(words)
            docs.append((len(docs) * 7 + 100, " ".join(changed)))
    return docs + [(5, None), (6, ""), (8, "a b"), (9, "A  b"), (10, "a b c"), (11, " \n ")]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    docs = families(size)
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    rows = minhash.near_duplicates(df, size=size, percent=percent).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got == brute.near_duplicates(docs, size, percent)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(minhash, "WAITING", 3)
    monkeypatch.setattr(minhash, "CHUNK", 4)
    docs = families(9)[:40]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, DOCS), size=3, percent=85).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got == brute.near_duplicates(docs, 3, 85)


def test_near_duplicates_of_odd_tables(odd, nothing):
    found = minhash.near_duplicates(odd)
    assert found.columns == [c for c in odd.columns if c != "kept"] + ["n_shingles", "component_id", "kept"]
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS)
    same = [r for r in rows if (r["text"] or "").startswith("same words")]
    assert len({(r["component_id"], r["kept"]) for r in same}) == 1 and same[0]["kept"]
    assert all(r["n_shingles"] == 0 and r["kept"] for r in rows if not r["text"])
    assert minhash.near_duplicates(nothing).count() == 0


def test_components_of_a_chain(spark):
    from rankfield.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 90), (95, 100), (None, 3)]
    rows = components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    got = {r["node"]: r["component"] for r in rows}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


# Repeated bytes


@pytest.mark.parametrize("length, small", [(12, False), (40, False), (12, True)])
def test_repeated_bytes(spark, monkeypatch, length, small):
    if small:
        monkeypatch.setattr(suffixes, "SEED_RUNS", 2)
        monkeypatch.setattr(suffixes, "CHUNK_BYTES", 2000)
        monkeypatch.setattr(suffixes, "BUCKET_BYTES", 300)
    parts = made_up(1, "abé ", 12, 60)
    docs = made_up(2, [p for _, p in parts] + ["x", "yy"], 120, 12)
    docs += [(500, None), (501, ""), (502, "a" * 300), (503, "ab" * 100)]
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    rows = suffixes.remove_repeats(df, length=length).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows}
    assert got == brute.repeats(docs, length)
    for r in rows:
        text = (dict(docs)[r["doc_id"]] or "").encode()
        inside = {i for s in r["spans"] for i in range(s["start"], s["end"])}
        assert bytes(r["kept"]) == bytes(b for i, b in enumerate(text) if i not in inside)


def test_repeated_bytes_of_the_sample(spark, sample):
    rows = suffixes.remove_repeats(spark.createDataFrame(sample, DOCS), keep_bytes=False).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows}
    assert got == brute.repeats(sample, 100)


def test_repeated_bytes_of_odd_tables(odd, nothing):
    rows = suffixes.remove_repeats(odd, length=20)
    assert rows.columns == ["doc_id", "row", "id", "score", "sequence_id", *suffixes._REMOVED.names]
    got = rows.collect()
    assert len(got) == len(ODD_ROWS)
    # Rows equal in key and text are one document: the first of all, so nothing goes.
    assert sorted(r["n_removed"] for r in got if r["doc_id"] == 1 and r["row"]) == [0, 0]
    assert [r["n_removed"] for r in got if r["doc_id"] == 3] == [5 * 30_000 - 5]
    assert suffixes.remove_repeats(nothing).count() == 0


def test_multikey_quicksort():
    draw = np.random.default_rng(2)
    strings = draw.integers(97, 99, (500, 19), dtype=np.uint8)
    order, shared = suffixes.multikey_quicksort(strings)
    texts = [bytes(s) for s in strings]
    assert [texts[i] for i in order] == sorted(texts)
    for i in range(1, len(order)):
        a, b = texts[order[i - 1]], texts[order[i]]
        assert shared[i] == next((j for j in range(19) if a[j] != b[j]), 19)


# Lines


def test_repeated_chunks(spark, sample):
    docs = made_up(4, ["aa\n", "b\n", "\n", "c c\n", "é"], 100, 30)
    docs += [(500, None), (501, ""), (502, "\n" * 50), (503, "x\n" * 100)]
    for rows in (docs, sample):
        found = lines.remove_repeated_chunks(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
        got = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in found}
        assert got == brute.repeated_chunks(rows, lines.chunk_bounds)


def test_chunks_cover_the_text_and_resist_shifts():
    text = "".join(f"line number {i * i % 97}\n" for i in range(200)).encode()
    bounds = lines.chunk_bounds(text)
    assert bounds[0][0] == 0 and bounds[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    shifted = b"a new first line\n" + text
    before = {text[a:b] for a, b, _ in bounds}
    after = {shifted[a:b] for a, b, _ in lines.chunk_bounds(shifted)}
    assert len(before - after) <= 2


def test_repeated_chunks_of_odd_tables(odd, nothing):
    found = lines.remove_repeated_chunks(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_removed_lines"]
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS) and all(r["n_removed_lines"] == 0 for r in rows)
    assert sorted(map(str, (r["text"] for r in rows))) == sorted(str(r[1]) for r in ODD_ROWS)
    assert lines.remove_repeated_chunks(nothing).count() == 0


def sentences(seed, sizes, blank=False):
    draw = random.Random(seed)
    return [" ".join(f"w{draw.randrange(5000)}" for _ in range(n)) + "\n" * (1 + blank) for n in sizes]


@pytest.mark.parametrize("blank, end", [(False, ""), (False, "\n"), (True, ""), (True, "\n\n")])
def test_exact_copies_of_any_length_go_whole(spark, sf_dir, blank, end):
    rows = []
    for n in range(2, 41):
        text = "".join(sentences(n, [3 + n * i % 70 for i in range(n)], blank)).rstrip("\n") + end
        rows += [(n, text), (100 + n, text), (200 + n, text)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    left = corpus_pipeline.drop_repeated_lines(spark, docs, sf_dir)
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == sorted(rows[::3])


@pytest.mark.parametrize("space", ["\n", "\r\n", " \t\n"])
def test_blank_lines_do_not_exempt_chunks(space):
    parts = [line + space for line in sentences(5, [30] * 40)]
    bounds = lines.chunk_bounds("".join(parts).encode())
    assert min(n for _, _, n in bounds) >= lines.LEAST_LINES
    dense = lines.chunk_bounds("".join(sentences(5, [30] * 40)).encode())
    assert [n for _, _, n in bounds] == [n for _, _, n in dense]


def test_passages_of_over_50_words_go_to_their_edges(spark):
    rows = []
    for n in (1, 2, 3, 4, 6, 20):
        for blank in (False, True):
            passage = sentences(5000 + 2 * n + blank, [60] if n == 1 else [30] * n, blank)
            for copy in (0, 1):
                at = 1000 * copy + 2 * n + blank
                around = sentences(100 + at, [7, 20, 9, 11], blank)
                rows.append((at, "".join([*around[:2], *passage, *around[2:]]), "".join(around), n * (1 + blank)))
    docs = spark.createDataFrame([r[:2] for r in rows], DOCS).repartition(4)
    found = {r["doc_id"]: r for r in lines.remove_repeated_passages(docs).collect()}
    for at, text, around, n in rows:
        assert found[at]["text"] == (text if at < 1000 else around)
        assert found[at]["n_removed_lines"] == (0 if at < 1000 else n)


# Benchmark


def test_contamination(spark, sample, sf_dir, monkeypatch):
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in rows]
    check_contamination(spark, sample, items, 13)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 2)
    pool = ["a ", "B-", "c ", "é ", "dd "]
    short = [(i % 7, t) for i, t in made_up(6, pool, 12, 9)] + [(None, "zz zz"), (9, None)]
    docs = made_up(7, [*pool, "zz "], 80, 30) + [(900, None), (901, "")]
    check_contamination(spark, docs, short, 4, block_words=15)
    check_contamination(spark, docs[:5], [], 4)


def check_contamination(spark, docs, items, window, **options):
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_contamination(df, benchmark, window=window, **options).collect()
    got = {
        r["doc_id"]: (r["n_words"], r["n_hit"], len(r["items"]), r["items_sha256"], r["contaminated"])
        for r in rows
    }
    assert got == brute.contamination(docs, items, window, 20)


def test_contamination_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SMALL_ROWS", 0)
    docs = made_up(8, ["a ", "b ", "c "], 40, 20)
    check_contamination(spark, docs, [(1, "a b a"), (2, "c c b a b")], 3)


def test_contamination_of_odd_tables(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "same words in both", 1)], "item_id int, text string, id int")
    rows = decontaminate.find_contamination(odd, benchmark).collect()
    assert len(rows) == len(ODD_ROWS)
    assert sorted(r["n_hit"] for r in rows) == [0] * 6 + [4, 4]
    assert decontaminate.find_contamination(nothing, benchmark).count() == 0


# Quality


def test_quality_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs, labels.filter(~quality.held_out("doc_id")))
    rows = scored.join(labels, "doc_id").filter(quality.held_out("doc_id")).collect()
    assert len(rows) >= 10
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_pairs_learn_an_order():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 1] > 0.3).astype(int)
    model = quality.fit(x, y, {0: int((y == 0).sum()), 1: int((y == 1).sum())})
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_quality_fits_on_every_labelled_row(spark):
    """The threshold splits all labelled texts as the labels do, however many they are."""
    draw = np.random.default_rng(3)
    words = np.array(["a", "bc", "Def", "ghij", "12", "k,", "lm.", "Nopqrst"])
    texts = [" ".join(words[draw.integers(0, 8, n)]) for n in draw.integers(40, 80, 24_000)]
    y = (draw.random(len(texts)) < 0.4).astype(int).tolist()
    numbers = list(range(len(texts)))
    docs = spark.createDataFrame(pa.table({"doc_id": numbers, "text": texts}))
    labels = spark.createDataFrame(pa.table({"doc_id": numbers, "quality": y}))
    rows = sorted(quality.score_quality(docs, labels).select("doc_id", "score", "predicted").collect())
    assert sum(r["predicted"] for r in rows) == sum(y)
    again = quality.score_quality(docs.repartition(5), labels.repartition(3), columns=["doc_id"])
    assert [r["score"] for r in sorted(again.collect())] == [r["score"] for r in rows]


def test_pipeline_keeps_by_every_labelled_row(spark, tmp_path):
    """Of the documents that are trained on, the stage keeps as many as have label 1."""
    draw = np.random.default_rng(4)
    texts = ["".join(chr(97 + c) for c in draw.integers(0, 26, n)) + " x." for n in draw.integers(20, 90, 36_000)]
    numbers, y = list(range(len(texts))), (draw.random(len(texts)) < 0.3).astype(int).tolist()
    spark.createDataFrame(pa.table({"doc_id": numbers, "quality": y})).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(pa.table({"doc_id": numbers, "text": texts}))
    kept = corpus_pipeline.keep_quality(spark, docs, str(tmp_path))
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet").filter(~quality.held_out("doc_id"))
    assert labels.filter("quality = 0").count() > 10_000
    assert kept.filter(~quality.held_out("doc_id")).count() == labels.filter("quality = 1").count()


def test_quality_groups_pair_every_row():
    """A class of few rows meets every group; groups give the sums and ranks of the whole."""
    y = np.array([0] * 50 + [1] * 3)
    better, worse = (np.concatenate(c) for c in zip(*quality.pairs(y)))
    assert set(better.tolist()) == {50, 51, 52} and set(worse.tolist()) == set(range(50))
    x = np.random.default_rng(5).normal(size=(200, len(quality.FEATURES)))
    model = quality.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.ones(x.shape[1]), 0.0)
    cut = [slice(0, 20), slice(20, 190), slice(190, 200)]
    groups = lambda f: np.stack([f(x[c], np.zeros(len(x[c])), np.ones(len(x[c]), bool)) for c in cut])
    ranked = np.sort(model.raw(x))
    for below in (1, 77, 199):
        assert quality.quantile(groups, model, below) == (ranked[below - 1] + ranked[below]) / 2
    assert quality.quantile(groups, model, 200) == ranked[-1]


def test_features_are_finite():
    for text in (b"", b" \n", b"x", b"a b", "é".encode(), b"***", b"x\n" * 5, b"word " * 50_000):
        assert np.isfinite(quality.features(text)).all()


def test_quality_of_odd_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = quality.score_quality(odd, none).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)} and len(rows) == len(ODD_ROWS)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 0), (2, None), (4, 7)], "doc_id bigint, quality int")
    rows = quality.score_quality(odd, labels).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert quality.score_quality(nothing, labels).count() == 0


def passages(data):
    starts, ends = lines.passage_spans(lines.Lines(data))
    return list(zip(starts.tolist(), ends.tolist()))


def test_repeated_passages(spark, sample):
    parts = made_up(6, ["aa ", "b ", "c\n", "dd. "], 25, 60)
    docs = made_up(7, [f"{p}\n" for _, p in parts] + ["\n", "x\n", " \n", "y"], 120, 14)
    docs += [(1000, None), (1001, ""), (1002, "one two\n" * 90), (1003, "w " * 60 + "\n" + "w " * 60)]
    for rows in (docs, sample):
        found = lines.remove_repeated_passages(spark.createDataFrame(rows, DOCS).repartition(4)).collect()
        assert {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in found} == brute.repeated_passages(rows, passages)


def test_repeated_passages_of_odd_tables(odd, nothing):
    found = lines.remove_repeated_passages(odd)
    assert found.columns == [*odd.columns, "n_lines", "n_removed_lines"]
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS)
    same = [r["text"] for r in rows if r["row"] == "r" and r["id"] == 1]
    assert len(same) == 2 and len(set(same)) == 1
    assert lines.remove_repeated_passages(nothing).count() == 0


def test_words_with_equal_sums_stay_apart(spark):
    """Words made to collide under any polynomial modulo 2^64 are different words here."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = [(1, word), (2, other), (3, f"x {word} y z"), (4, f"x {other} y z")]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, DOCS), size=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i for i, _ in docs}


def test_a_large_group_of_near_copies(spark):
    """One hot group whose copies differ in different words, some too far from its centre."""
    draw = random.Random(17)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(400):
        changed = list(base)
        for at in draw.sample(range(150), draw.choice([1, 2, 3, 4, 5])):
            changed[at] = f"v{draw.randrange(40)}"
        docs.append((i, " ".join(changed)))
    docs += [(1000 + i, t) for i, (_, t) in enumerate(made_up(4, ["p ", "q ", "r ", "s "], 30, 40))]
    rows = minhash.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(4), size=3, percent=85).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got == brute.near_duplicates(docs, 3, 85)
