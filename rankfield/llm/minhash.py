"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of ``bands`` hashes each, of ``rows`` minima, make bands² table keys: a
key combines one hash of either collection. That takes 2 · bands · rows minima where separate
tables would take bands² · rows.

Documents with equal shingle sets, by 128 bits, are one class from the start. Each class is
compared with the most central one that it shares a bucket with: first over ``bands`` of the
table keys, where most of what belongs together meets, then over all keys of the classes whose
half keys still meet another component. Where buckets hold more than one component after that,
all members outside the main one are compared with the others in bounded blocks. So no link
between classes that share a bucket is left out, and no bucket is expanded into its pairs. Every
link is confirmed on the full sets of the words themselves.

Joins of texts and buckets are sort-merge joins at every size, so that small tables show what
large ones will shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfield.llm import hashing
from rankfield.llm.common import batches, quoted, runs, with_row_id
from rankfield.llm.components import components
from rankfield.session import written

SHINGLE = 5
PERCENT = 80
BANDS = 12
ROWS = 3

#: Classes that one task compares: so many that wait, with so many others.
WAITING = 256
CHUNK = 1024

#: Shingles that are hashed at a time.
BLOCK = 1 << 15

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Return the sorted distinct hashes of the runs of ``size`` words, A-Z in lower case.

    A text with fewer words is one shingle, and one without words is the empty set.
    """
    data = np.frombuffer(text.lower(), np.uint8)
    begin, end = runs(~_WHITE[data])
    if not len(begin):
        return np.zeros(0, np.uint64)
    words = hashing.word_hashes(data, begin, end)
    width = min(size, len(words))
    steps = hashing.powers(hashing.BASES[1], width)
    count = len(words) - width + 1
    sums = np.full(count, width, np.uint64)
    for i in range(width):
        sums += words[i : i + count] * steps[i]
    return np.unique(hashing.mixed(sums))


def word_shingles(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """Return the set that ``shingle_set`` hashes, as tuples of words."""
    words = text.lower().split()
    return set(zip(*(words[i:] for i in range(min(size, len(words))))))


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(81).integers(0, 2**64, (2, count), dtype=np.uint64)
    return numbers[0] | np.uint64(1), numbers[1]


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Return the least value of each hash function over the set."""
    least = np.full(len(family[0]), 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        part = shingles[at : at + BLOCK]
        values = part[None, :] * family[0][:, None] + family[1][:, None]
        least = np.minimum(least, values.min(axis=1))
    return least


_SIGNED = pa.schema(
    [
        ("id", pa.int64()),
        ("n", pa.int64()),
        ("d1", pa.int64()),
        ("d2", pa.int64()),
        ("a", pa.list_(pa.int64())),
        ("b", pa.list_(pa.int64())),
    ]
)
_SIGNED_DDL = "id bigint, n bigint, d1 bigint, d2 bigint, a array<bigint>, b array<bigint>"


def _signatures(size: int, bands: int, rows: int):
    def sign(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(2 * bands * rows)
        steps = hashing.powers(hashing.BASES[1], rows)

        def signed() -> Iterator[tuple]:
            for batch in source:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = shingle_set((text.as_py() or "").encode(), size)
                    if not len(found):
                        continue
                    low = minima(found, family).reshape(2, bands, rows)
                    halves = hashing.mixed((low * steps).sum(axis=2, dtype=np.uint64)).view(np.int64)
                    first = found.sum(dtype=np.uint64).view(np.int64)
                    second = np.bitwise_xor.reduce(hashing.mixed(found + np.uint64(1))).view(np.int64)
                    yield key, len(found), int(first), int(second), halves[0], halves[1]

        yield from batches(signed(), _SIGNED)

    return sign


_LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _confirm(size: int, percent: int):
    def confirm(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hub_set = None, None
        for batch in source:
            hubs, others = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            u, v = [], []
            for hub, other, hub_text, text in zip(hubs, others, batch.column(2), batch.column(3)):
                if hub != held:
                    held, hub_set = hub, word_shingles((hub_text.as_py() or "").encode(), size)
                found = word_shingles((text.as_py() or "").encode(), size)
                both = len(hub_set & found)
                if 100 * both >= percent * (len(hub_set) + len(found) - both):
                    u.append(hub)
                    v.append(other)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_LINK)

    return confirm


def _first_buckets(classes: DataFrame, bands: int) -> DataFrame:
    """Return (bucket, rep, comp, best) of the different groups that share one of ``bands`` keys.

    Each class is its own component yet. ``best`` has how many classes it meets in all its
    buckets: a text that others were copied from meets the most, so it is the one to compare
    them with.
    """
    keys = F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, i, a[i], b[i]))")
    rows = written(classes.select(F.explode(keys).alias("bucket"), "rep"), "tables")
    kept = written(_different(rows, F.xxhash64("rep"), F.xxhash64("rep", F.lit(1)), "rep"), "buckets")
    met = kept.groupBy("rep").agg(F.sum("c").alias("met"))
    best = F.struct("met", (-F.col("rep")).alias("least")).alias("best")
    return written(kept.drop("c").join(met, "rep").select("bucket", "rep", F.col("rep").alias("comp"), best), "buckets")


def _different(rows: DataFrame, one, other, label: str) -> DataFrame:
    """Return the rows of buckets with several labels, one bucket of each different group."""
    groups = rows.groupBy("bucket").agg(
        F.count("*").alias("c"),
        F.bit_xor(one).alias("f1"),
        F.bit_xor(other).alias("f2"),
        F.min(label).alias("low"),
        F.max(label).alias("high"),
    )
    groups = groups.filter("low < high").groupBy("c", "f1", "f2").agg(F.min("bucket").alias("bucket"))
    return rows.join(groups.select("bucket", "c").hint("merge"), "bucket")


def _open_buckets(classes: DataFrame) -> DataFrame:
    """Return (bucket, rep, comp, best) of the table keys whose half keys meet other components.

    ``classes`` has ``comp`` and ``met``. A bucket of several components lies within two half
    keys of several, so other keys are not made. Of each component in a bucket one class stays,
    that which met the most.
    """
    sides = [F.expr(f"transform({c}, (x, i) -> struct({s} AS side, i AS pos, x AS col))") for s, c in enumerate("ab")]
    halves = classes.select("rep", "comp", F.explode(F.concat(*sides)).alias("h")).select("rep", "comp", "h.*")
    halves = written(halves, "halves")
    half = ["side", "pos", "col"]
    mixed = halves.groupBy(*half).agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    met = halves.join(mixed.select(*half).hint("merge"), half)
    # At most one place for each band and side.
    places = met.groupBy("rep").agg(*(F.collect_set(F.when(F.col("side") == s, F.col("pos"))).alias(f"of_{c}") for s, c in enumerate("ab")))
    keys = F.expr("flatten(transform(of_a, i -> transform(of_b, j -> xxhash64(i, j, a[i], b[j]))))")
    placed = classes.join(places.hint("merge"), "rep")
    rows = placed.select(F.explode(keys).alias("bucket"), "comp", F.struct("met", (-F.col("rep")).alias("least")).alias("best"))
    central = written(rows.groupBy("bucket", "comp").agg(F.max("best").alias("best")), "tables")
    kept = _different(central, F.xxhash64("comp", "best"), F.xxhash64("best", "comp"), "comp")
    return written(kept.select("bucket", (-F.col("best.least")).alias("rep"), "comp", "best"), "buckets")


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """Pair every class with the one that meets the most of those of other components it meets."""
    hub = buckets.groupBy("bucket").agg(F.max(F.struct("best", "comp")).alias("hub"))
    met = buckets.join(hub, "bucket").filter(F.col("hub.comp") != F.col("comp"))
    best = met.groupBy("rep").agg(F.max("hub").alias("hub"))
    hub_rep = -F.col("hub.best.least")
    return best.select(F.least("rep", hub_rep).alias("u"), F.greatest("rep", hub_rep).alias("v")).distinct()


def _open_clusters(buckets: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Return (cluster, rep, comp, waiting) of the components in buckets of several.

    A cluster is what such buckets connect. All but the members of its largest component are
    ``waiting`` to be compared with the cluster's other members.
    """
    named = written(_named(buckets.select("bucket", "rep"), labels), "open")
    mixed = named.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    ties = named.join(mixed.select("bucket", "low"), "bucket").select(F.col("low").alias("u"), F.col("comp").alias("v"))
    clusters = components(ties)
    members = _named(classes.select("rep"), labels)
    met = members.join(clusters.hint("merge"), members["comp"] == clusters["node"])
    placed = written(met.select(F.col("component").alias("cluster"), "rep", "comp"), "clusters")
    main = (
        placed.groupBy("cluster", "comp")
        .agg(F.count("*").alias("size"))
        .groupBy("cluster")
        .agg(F.max(F.struct("size", "comp")).alias("most"))
        .select("cluster", F.col("most.comp").alias("main"))
    )
    return placed.join(main, "cluster").withColumn("waiting", F.col("comp") != F.col("main")).drop("main")


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``comp``, the component of ``rep``, to rows that have none."""
    met = rows.join(labels.hint("merge"), rows["rep"] == labels["node"], "left")
    return met.select(*rows.columns, F.coalesce("component", "rep").alias("comp"))


def _sets(size: int):
    def shingles(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [shingle_set((t.as_py() or "").encode(), size).view(np.int64) for t in batch.column(1)]
            if found:
                lists = pa.array(found, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["rep", "set"])

    return shingles


def _compare(percent: int):
    def compare(asked: pa.Table, members: pa.Table) -> pa.Table:
        """Link each waiting class to one similar member of each other component."""
        u, v = [], []
        if asked.num_rows and members.num_rows:
            lists = members["set"].combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy()
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(sizes)), sizes)[order]
            reps, comps = members["rep"].to_numpy(), members["comp"].to_numpy()
            for rep, comp, held in zip(asked["rep"].to_pylist(), asked["comp"].to_pylist(), asked["set"]):
                own = held.values.to_numpy()
                low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                hits = high - low
                at = np.repeat(low - (np.cumsum(hits) - hits), hits) + np.arange(hits.sum())
                both = np.bincount(owner[at], minlength=len(sizes))
                alike = (100 * both >= percent * (len(own) + sizes - both)) & (comps != comp)
                _, first = np.unique(comps[alike], return_index=True)
                v += reps[alike][first].tolist()
                u += [rep] * len(first)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return compare


def _link_within(clusters: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Compare the waiting classes of each cluster with all its members.

    A task holds a block of the one and a chunk of the other, both bounded, and counts shared
    shingles over an inverted index of the chunk; pairs are never made.
    """
    sets = texts.mapInArrow(_sets(size), "rep bigint, set array<bigint>")
    placed = written(clusters.join(sets.hint("merge"), "rep"), "sets")
    parts = placed.groupBy("cluster").agg(
        F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"),
        F.ceil(F.sum(F.col("waiting").cast("int")) / F.lit(WAITING)).cast("int").alias("blocks"),
    )
    dealt = placed.join(written(parts, "parts"), "cluster")

    def one_of(count: str):
        return F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")

    def each_of(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    left = dealt.filter("waiting").withColumn("block", one_of("blocks")).withColumn("chunk", each_of("chunks"))
    right = dealt.withColumn("chunk", one_of("chunks")).withColumn("block", each_of("blocks"))
    keys, columns = ["cluster", "block", "chunk"], ["cluster", "block", "chunk", "rep", "comp", "set"]
    return (
        left.select(*[F.col(c).alias(c) for c in columns])
        .groupBy(*keys)
        .cogroup(right.select(*columns).groupBy(*keys))
        .applyInArrow(_compare(percent), "u bigint, v bigint")
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Return the pairs (u, v) whose sets of word tuples are similar."""
    left = texts.select(F.col("rep").alias("v"), F.col("text").alias("other"))
    right = texts.select(F.col("rep").alias("u"), F.col("text").alias("hub"))
    met = pairs.join(left.hint("merge"), "v").join(right.hint("merge"), "u").select("u", "v", "hub", "other")
    return written(met.mapInArrow(_confirm(size, percent), "u bigint, v bigint"), "confirmed")


def link_classes(
    classes: DataFrame, texts: DataFrame, *, size: int, percent: int, bands: int
) -> DataFrame:
    """Return (node, component) of the classes that some confirmed link joins to another.

    ``classes`` has ``rep``, ``a`` and ``b``; ``texts`` has ``rep`` and ``text``. Each class is
    compared with the central one among those it shares a bucket with. That joins nearly all
    that belongs together; where buckets still hold several components, all members outside the
    main one are compared with all others.
    """

    def of(rows: DataFrame) -> DataFrame:
        return written(texts.join(rows.select("rep").distinct().hint("merge"), "rep", "left_semi"), "texts")

    first = _first_buckets(classes, bands)
    links = _confirmed(_first_pairs(first), of(first), size, percent)
    labels = components(links)
    met = first.groupBy(F.col("rep").alias("met_rep")).agg(F.max("best.met").alias("met"))
    known = _named(classes.select("rep", "a", "b"), labels)
    known = known.join(met.hint("merge"), F.col("rep") == F.col("met_rep"), "left").drop("met_rep")
    known = written(known.withColumn("met", F.coalesce("met", F.lit(0).cast("bigint"))), "named")
    buckets = _open_buckets(known)
    if buckets.isEmpty():
        return labels
    links = links.unionByName(_confirmed(_first_pairs(buckets), of(buckets), size, percent))
    labels = components(links)
    clusters = written(_open_clusters(buckets, classes, labels), "clusters")
    if clusters.isEmpty():
        return labels
    inside = of(clusters)
    found = written(_link_within(clusters, inside, size, percent), "within")
    return components(links.unionByName(_confirmed(found, inside, size, percent)))


def near_duplicates(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Group documents whose shingle sets are similar, directly or through others.

    Two documents are linked if 100 · intersection ≥ ``percent`` · union of their sets of
    ``size``-word shingles. Returns the columns of ``documents`` with ``n_shingles``,
    ``component_id`` (the least key reachable) and ``kept`` (whether that is the row's own), in
    place of columns of those names.

    A null or wordless text has an empty set and is a component by itself. A null key sorts
    after all others, and the least key of a component is null only if all are. Rows equal in
    key and text are one document.

    Of two sets at the threshold itself, similarity s, no shared table is found with the
    probability 1 − (1 − (1 − s^rows)^bands)²: 4e-4 at s = 0.80 with the defaults, 2e-5 at 0.85.
    """
    marked, row_id, plain = with_row_id(documents, key, text)
    ids = marked.select(F.col(quoted(row_id)).alias("id"), F.col(quoted(text)).alias("text"))
    signed = written(ids.mapInArrow(_signatures(size, bands, rows), _SIGNED_DDL), "signatures")
    classes = written(
        signed.groupBy("n", "d1", "d2").agg(
            F.min("id").alias("rep"), F.min("a").alias("a"), F.min("b").alias("b")
        ),
        "classes",
    )
    texts = ids.select(F.col("id").alias("rep"), "text")
    if not plain:
        texts = texts.dropDuplicates(["rep"])
    labels = link_classes(classes, texts, size=size, percent=percent, bands=bands)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("comp")
    )
    members = signed.join(named.hint("merge"), ["n", "d1", "d2"]).select(F.col("id").alias("member"), "n", "comp")
    if not plain:
        keys = marked.select(F.col(quoted(row_id)).alias("r"), F.col(quoted(key)).alias("least_key")).distinct()
        members = members.distinct().join(keys, F.col("comp") == F.col("r"))
    dropped = {"n_shingles", "component_id", "kept"}
    kept = [F.col(quoted(c)) for c in documents.columns if c.lower() not in dropped]
    held = marked.select(F.struct(*kept).alias("row"), F.col(quoted(row_id)).alias("id"), F.col(quoted(key)).alias("key"))
    least = F.coalesce("comp", "id") if plain else F.when(F.col("comp").isNull(), F.col("key")).otherwise(F.col("least_key"))
    return held.join(members.hint("merge"), F.col("id") == F.col("member"), "left").select(
        "row.*",
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_shingles"),
        least.alias("component_id"),
        F.coalesce(F.col("comp") == F.col("id"), F.lit(True)).alias("kept"),
    )
