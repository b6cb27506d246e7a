"""URL rules: a blocked Bloom filter lets possible hits pass to an exact hash join.

DataFrame functions only. The filter has a fixed number of blocks of eight 32-bit words, and
a key sets one bit in each word of its block; so its size is known before the list is read,
and that bound is what allows the broadcast. What it lets pass by mistake the join removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfield.llm.common import quoted

#: Blocks of 256 bits: 65,536 rows of about 80 bytes are the most that is broadcast.
BLOCKS = 1 << 16

WORDS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("host", "path"), F.lit(blocks))


def _bits() -> list[Column]:
    """One bit per word, from hashes that the block number does not use."""
    return [
        F.expr(f"shiftleft(1, cast(pmod(xxhash64(path, host, {word}), 32) as int))")
        for word in range(WORDS)
    ]


def blocked_bloom(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Fold keys (host, path) into at most ``blocks`` rows: ``block`` and its eight words."""
    bits = keys.select(_block(blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits())])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(keys: DataFrame, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Keep the keys whose eight bits are all set in their block."""
    met = keys.withColumn("block", _block(blocks)).join(F.broadcast(bloom), "block")
    for i, bit in enumerate(_bits()):
        met = met.filter(F.col(f"w{i}").bitwiseAND(bit) != 0)
    return met.select(*keys.columns)


def _candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Every (host suffix, path prefix) of a URL that has the form of some rule."""
    form = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    labels, lengths = form["labels"] or 0, form["lengths"] or []
    parts = F.split("_host", r"\.")
    most = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(
        F.sequence(F.lit(1), most), lambda n: F.concat_ws(".", F.slice(parts, -n, n))
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_path"))
    return (
        urls.filter(most >= 1)
        .withColumn("host", F.explode(suffixes))
        .withColumn("_n", F.explode(fitting))
        .withColumn("path", F.expr("substring(_path, 1, _n)"))
        .select("url", "host", "path")
    )


def url_verdicts(
    pages: DataFrame, rules: DataFrame, *, url: str = "url", blocks: int = BLOCKS
) -> DataFrame:
    """Judge every row's URL by the longest rule that fits it.

    ``rules`` has ``host``, ``path`` and ``action``; a rule fits its host and the host's
    subdomains where the URL's path starts with the rule's. The longest is that with the most
    characters in host and path together; of equal ones the longer host, then the smaller
    action. A rule with a null is not used; repeated rules count once.

    Adds ``host``, ``path``, ``rule`` (host and path, or null) and ``verdict`` (the rule's
    action, else ``allow``, as the URL is not listed), in place of columns of those names. A
    null URL, or one without ``://``, has an empty host and path. Equal URLs are judged once,
    so what is shuffled by URL is one row for each on that side.
    """
    given = F.col(quoted(url))
    listed = rules.select("host", "path", "action").dropna().distinct()
    urls = pages.select(given.alias("url")).filter(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"))
    keys = listed.select("host", "path").distinct()
    hits = possible(_candidates(urls, listed), blocked_bloom(keys, blocks), blocks)
    exact = hits.join(listed, ["host", "path"])
    length = F.length("host") + F.length("path")
    best = (
        exact.select(
            "url",
            F.struct(
                (-length).alias("size"),
                (-F.length("host")).alias("host_size"),
                "action",
                F.concat("host", "path").alias("rule"),
            ).alias("found"),
        )
        .groupBy("url")
        .agg(F.min("found").alias("found"))
        .select(F.col("url").alias("_judged"), "found.action", "found.rule")
    )
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    left = pages.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("_row"), given.alias("_url"))
    return left.join(best, F.col("_url") == F.col("_judged"), "left").select(
        "_row.*",
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        "rule",
        F.coalesce("action", F.lit("allow")).alias("verdict"),
    )
