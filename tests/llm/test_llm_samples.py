"""Resampling, SimHash and phrases, against brute force and on odd tables."""

import random
import zlib

import brute
import numpy as np
import pytest

from rankfield.llm import phrases, radix, resample, simhash

DOCS = "doc_id bigint, text string"

#: Nulls, empty and long texts, repeated rows, and columns named like the operators' own.
ODD = "doc_id bigint, text string, lang string, id int, n int, rank string, f int, fingerprint string, ids string, score int"
ODD_ROWS = [
    (1, "Same words in both of these rows, é and more words", "x", 1, 1, "r", 1, "p", "i", 1),
    (1, "Same words in both of these rows, é and more words", "x", 1, 1, "r", 1, "p", "i", 1),
    (1, "another text under the same key", None, None, None, None, None, None, None, None),
    (None, "a text without a key", "x", 2, 2, None, 2, "q", None, 2),
    (None, None, None, None, None, None, None, None, None, None),
    (2, "", "", 3, 3, "", 3, "", "", 3),
    (3, "word " * 30_000, "x", 4, 4, "s", 4, "p", "j", 4),
    (4, None, "x", 5, 5, "t", 5, "q", "k", 5),
    (5, "w" * 200_000 + " end", "x", 6, 6, "t", 6, "q", "k", 6),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], ODD)


def made_up(seed, words, count, most):
    draw = random.Random(seed)
    return [(i * 3 - 50, " ".join(draw.choice(words) for _ in range(draw.randint(0, most)))) for i in range(count)]


# Importance resampling


@pytest.mark.parametrize("count", [0, 1, 5, 700])
def test_radix_ranks(spark, count):
    draw = random.Random(count)
    rows = [(draw.choice([-(2**63), 2**63 - 1, 0, *range(-5, 5)]), i * 2**40 - 2**45) for i in range(count)]
    df = spark.createDataFrame(rows, "score bigint, id bigint").repartition(3)
    got = radix.sorted_ranks(df, [("score", True), ("id", False)]).collect()
    assert [(r["score"], r["id"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r["rank"] for r in got) == list(range(1, count + 1))


def test_radix_ranks_of_equal_rows(spark):
    got = radix.sorted_ranks(spark.createDataFrame([(7, 1)] * 40, "score bigint, id bigint"), [("score", True)])
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 41))


def test_run_buckets_are_those_of_the_joined_words():
    words = ["a", "é" * 40, "x" * 64, "y" * 65, "z" * 1000, "0"]
    line = " ".join(words).encode()
    for block in (2, 100):
        resample.BLOCK_WORDS, held = block, resample.BLOCK_WORDS
        got = sorted(b for bucket, _ in resample.run_buckets(line, 10_000) for b in bucket.tolist())
        resample.BLOCK_WORDS = held
        wanted = [" ".join(words[i : i + n]).encode() for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert got == sorted(zlib.crc32(w) % 10_000 for w in wanted)


@pytest.mark.parametrize("blocks", [False, True])
def test_resampling(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(resample, "BLOCK_BYTES", 300)
        monkeypatch.setattr(resample, "BLOCK_WORDS", 7)
    words = ["a", "B", "cé", "a_b", "d-1", "word", "Ünder", "\n", "x" * 90]
    docs = made_up(3, words, 300, 60) + [(9000, None), (9001, ""), (None, "a b cé " * 10)]
    target = ["a b cé word", None, "Word A b"]
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resample.resample(df, items, percent=30, buckets=97, seed=7).collect()
    got = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows}
    assert got == brute.resampled(docs, target, 30, 20, 97, 7) and len(rows) == len(docs)


def test_resampling_of_odd_tables(odd, nothing):
    found = resample.resample(odd, nothing, percent=100, least_words=1)
    assert found.columns == [c for c in odd.columns if c not in ("rank", "score")] + list(resample.ADDED)
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS)
    same = [r for r in rows if (r["text"] or "").startswith("Same")]
    assert len({(r["rank"], r["score"]) for r in same}) == 1
    # Rows equal in key and text are one draw: five different texts have words.
    assert sorted({r["rank"] for r in rows if r["rank"]}) == [1, 2, 3, 4, 5]
    assert all((r["n_features"], r["weight"], r["rank"]) == (0, 0, None) for r in rows if not r["text"])
    assert resample.resample(nothing, odd).count() == 0


# SimHash


def test_fingerprints():
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["a", "B", "c\td", "é", "\n"]) for _ in range(n)) for n in range(40)]
    for text in [*texts, "", " \n", "one", "x " * 70_000]:
        assert simhash.fingerprint(text.encode()) == brute.simhash(text, 3)


def close_prints(seed, count, centres=4, spread=9):
    draw = random.Random(seed)
    middle = [draw.getrandbits(64) for _ in range(centres)]
    flips = lambda: sum(1 << b for b in draw.sample(range(64), draw.randint(0, spread)))
    return list({draw.choice(middle) ^ flips() for _ in range(count)} | {0, 7, 2**64 - 1})


@pytest.mark.parametrize("bits", [1, 2, 3, 5])
@pytest.mark.parametrize("run", [2048, 2])
def test_fingerprint_links(spark, monkeypatch, bits, run):
    from rankfield.llm.components import components

    monkeypatch.setattr(simhash, "RUN", max(run, 64) if bits == 1 else run)
    values = close_prints(bits, 250, spread=3 + bits)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "f bigint").repartition(4)
    labels = {r["node"]: r["component"] for r in components(simhash.fingerprint_links(df, bits)).collect()}
    wanted = brute.hamming_components(dict(zip(signed, values)), bits)
    assert {f: labels.get(f, f) for f in signed} == wanted


def test_a_common_key_gets_finer_ones(spark, monkeypatch):
    """Thousands of fingerprints with the same first half are neither paired nor cut."""
    from rankfield.llm.components import components

    monkeypatch.setattr(simhash, "RUN", 100)
    draw = np.random.default_rng(3)
    values = np.unique(draw.integers(0, 2**26, 3000, dtype=np.uint64) << np.uint64(38) | np.uint64(12345))
    df = spark.createDataFrame([(int(f),) for f in values.view(np.int64)], "f bigint")
    labels = {r["node"]: r["component"] for r in components(simhash.fingerprint_links(df, 3)).collect()}
    wanted = list(range(len(values)))

    def root(x):
        while wanted[x] != x:
            x = wanted[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 3) + i + 1:
            a, b = root(i), root(int(j))
            wanted[max(a, b)] = min(a, b)
    signed = values.view(np.int64).tolist()
    least = {}
    for i, f in enumerate(signed):
        least[root(i)] = min(least.get(root(i), f), f)
    assert {f: labels.get(f, f) for f in signed} == {f: least[root(i)] for i, f in enumerate(signed)}


def test_simhash_near_duplicates(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(-1, None), (-2, " "), (10**9, "a b"), (10**9 + 1, "A  b")]
    rows = simhash.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    prints = {key: brute.simhash(text, 3) for key, text in docs}
    wanted = brute.hamming_components(prints, 3)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        key: (f"{prints[key]:016x}", wanted[key]) for key in prints
    }
    assert len(rows) == len(docs)


def test_simhash_of_odd_tables(odd, nothing):
    found = simhash.near_duplicates(odd)
    assert found.columns == [c for c in odd.columns if c != "fingerprint"] + ["fingerprint", "component_id"]
    rows = found.collect()
    assert len(rows) == len(ODD_ROWS)
    # The least key among the texts without words is 2; null keys come last.
    assert {(r["fingerprint"], r["component_id"]) for r in rows if not r["text"]} == {("0" * 16, 2)}
    assert [r["component_id"] for r in rows if r["text"] == "a text without a key"] == [None]
    assert simhash.near_duplicates(nothing).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(odd, bits=0)


# Phrases


def walked(trie, phrase):
    *_, (at, state) = trie.levels(np.array(phrase), len(phrase))
    return int(trie.accept[state[0]]) if len(at) and at[0] == 0 else -1


def test_the_trie_knows_its_phrases():
    draw = random.Random(2)
    kept = list({tuple(draw.randrange(0, 90, 3) for _ in range(draw.randint(1, 5))) for _ in range(2000)})
    trie = phrases.Trie.build(kept, range(len(kept)))
    assert [walked(trie, p) for p in kept] == list(range(len(kept)))
    others = {tuple(draw.randrange(-1, 120) for _ in range(draw.randint(1, 5))) for _ in range(3000)} - set(kept)
    assert all(walked(trie, p) == -1 for p in others)


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:
        for name, value in (("TRIE_PHRASES", 40), ("VOCABULARY", 5), ("BLOCK_WORDS", 11), ("BLOCK_BYTES", 200), ("PLAIN", 1)):
            monkeypatch.setattr(phrases, name, value)
    draw = random.Random(11)
    parts = ["New York City", "new york", "of the", "the", "a", "é-x", "b.", "c,d", "e\n", "f\tg", "rare%d", "x! y", " z"]
    docs = []
    for i in range(250):
        text = " ".join(draw.choice(parts) for _ in range(draw.randint(0, 30)))
        docs.append((draw.choice(["en", "de", None, ""]), text.replace("%d", str(i))))
    docs += [("en", None), (None, None), ("fr", "just this once")]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    rows = phrases.collocations(df, least=12, first=25, cover=90).collect()
    got = sorted(tuple(r) for r in rows)
    assert got == sorted(brute.collocations(docs, 12, 5, 25, 90)) and len(got) > 40


def test_collocations_scan_in_proportion_to_their_tries(spark, monkeypatch):
    """One scan counts a level, however many tries its phrases fill."""
    for name, value in (("TRIE_PHRASES", 100), ("FOREST", 3), ("HELD", 500), ("SLICE_WORDS", 11), ("BLOCK_WORDS", 170)):
        monkeypatch.setattr(phrases, name, value, raising=False)
    tables, write = [], phrases.written
    monkeypatch.setattr(phrases, "written", lambda df, label: tables.append(label) or write(df, label))
    draw = random.Random(5)
    words = [f"w{i}" for i in range(9)]
    docs = [(draw.choice(["en", "de"]), " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))) for _ in range(300)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=6, first=300, cover=90).collect())
    assert got == sorted(brute.collocations(docs, 6, 5, 300, 90)) and len(got) > 500
    # The phrases of two words fill two tries, those of three words up to fifteen.
    assert tables.count("phrase-pairs") <= 4
    assert tables.count("phrase-numbers") <= 1 + 5 + 1


def test_collocation_scores_are_exact():
    import pyarrow as pa

    big = 2**62 + 12345
    batch = pa.RecordBatch.from_arrays([pa.array([0]), *(pa.array([x]) for x in (big, 10**12 + 7, big - 1, 10**12 + 3))], names=list("cablr"))
    (out,) = phrases._scores(iter([batch]))
    assert out.column(5).to_pylist() == [1000 * big * (10**12 + 7) // ((big - 1) * (10**12 + 3))]


def test_collocations_of_odd_tables(odd, nothing):
    rows = phrases.collocations(odd, least=2).collect()
    assert {r["lang"] for r in rows} == {"x"}
    # What lies in a longer phrase as frequent is left out; five words are the most.
    assert [(r["phrase"], r["a"]) for r in rows if r["phrase"].startswith("same")] == [("same words in both of", 2)]
    assert ("word word word word word", 29_996) in {(r["phrase"], r["a"]) for r in rows}
    assert phrases.collocations(nothing).count() == 0
    assert phrases.collocations(odd, least=10**6).count() == 0
