"""One query for each operator, over its whole table; SQL where SQL can state the answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfield.llm import (
    decontaminate,
    lines,
    minhash,
    packing,
    phrases,
    quality,
    resample,
    simhash,
    suffixes,
    tokens,
    urls,
    vectors,
    warc,
)
from rankfield.llm.common import table
from rankfield.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if there is any."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op2_minhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(documents, size=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of a document, its newline included."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_section_tokens(documents, F.split("text", r"(?<=\n)")).drop("text")
    return counted.select(
        "doc_id",
        F.aggregate("section_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_tokens"),
        F.size("section_tokens").cast("bigint").alias("n_sections"),
        "section_tokens",
        "crossing",
    )


@query(
    "op4_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS body FROM pages
    ), d AS (
        SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p
    ), f AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END
               AS record_type,
           CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).cast("bigint")
    # Both tests are made on the headers; the payloads of responses alone are inflated.
    responses = warc.read_warc(spark, path).filter("record_type = 'response'")
    revisits = warc.read_warc(spark, path, payload="false").filter("record_type = 'revisit'")
    return responses.select(
        page("record_id").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    ).unionAll(
        revisits.select(
            page("record_id"),
            F.element_at("headers", "x-payload-length").cast("bigint"),
            "payload_digest",
            "record_type",
            page("refers_to"),
        )
    )


@query("op5_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.remove_repeated_passages(documents).select(
        "doc_id",
        "n_lines",
        "n_removed_lines",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(documents, keep_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out("doc_id"))
    return quality.score_quality(documents, labels, columns=["doc_id"]).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


@query("op8_nearest_neighbours")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search_neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_contamination(documents, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        "items_sha256",
        "contaminated",
    )


#: Host, path and action of each rule.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op10_url_filters",
    """
    WITH r AS (
        SELECT page_id,
               CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END
                   AS rest
        FROM pages
    ), h AS (
        SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM r
    ), u AS (
        SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz') AS host, path
        FROM h
    ), rules(rhost, rpath, action) AS (
        VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
               ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'),
               ('net', '/fr/', 'block')
    ), fits AS (
        SELECT u.page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
               max_by(action, length(rhost || rpath)) AS action
        FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
                         AND starts_with(path, rpath)
        GROUP BY u.page_id
    )
    SELECT u.page_id, host, path, rule, coalesce(action, 'allow') AS verdict
    FROM u LEFT JOIN fits USING (page_id)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.url_verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op11_importance_resampling",
    r"""
    WITH RECURSIVE bits(v, c, i) AS (
        SELECT v, v::UBIGINT, 0 FROM range(256) AS t(v)
        UNION ALL
        SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i + 1
        FROM bits WHERE i < 8
    ), steps AS (
        SELECT list(c ORDER BY v) AS step FROM bits WHERE i = 8
    ), texts AS (
        SELECT 'd' AS side, doc_id AS id, text FROM documents
        UNION ALL
        SELECT 'b', item_id, text FROM benchmark
    ), worded AS (
        SELECT side, id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
        FROM texts
    ), placed AS (
        SELECT side, id, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), features AS (
        SELECT side, id, array_to_string(w[i:i + n - 1], ' ') AS feature
        FROM placed, range(1, 4) AS r(n) WHERE i + n - 1 <= len(w)
    ), counted AS (
        SELECT side, id, feature, count(*) AS c FROM features GROUP BY ALL
    ), named AS (
        SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM counted)
    ), hashed AS (
        SELECT feature, xor(list_reduce(
            list_prepend(4294967295::UBIGINT, list_transform(
                range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)),
            lambda a, b: xor(a // 256, step[(xor(a, b) % 256 + 1)::BIGINT])), 4294967295) % 10000 AS bucket
        FROM named, steps
    ), sums AS (
        SELECT bucket, coalesce(sum(c) FILTER (side = 'd'), 0) AS s, coalesce(sum(c) FILTER (side = 'b'), 0) AS t
        FROM counted JOIN hashed USING (feature) GROUP BY bucket
    ), totals AS (
        SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums
    ), gains AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE
            / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
        FROM sums, totals
    ), weights AS (
        SELECT id, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight
        FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket)
        WHERE side = 'd' GROUP BY id
    ), scored AS (
        SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
               coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::UBIGINT
                   + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score
        FROM worded LEFT JOIN weights USING (id) WHERE side = 'd'
    ), ranked AS (
        SELECT *, CASE WHEN n_words >= 20 THEN
            row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
            5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(documents, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


@query("op12_simhash_near_dedup")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(documents).select("doc_id", "fingerprint", "component_id")


@query(
    "op13_phrase_collocations",
    r"""
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), pieces AS (
        SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
    ), worded AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), totals AS (
        SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
    ), placed AS (
        SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), counted AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
        FROM placed, range(1, 6) AS r(k) WHERE i + k - 1 <= len(w)
        GROUP BY ALL HAVING count(*) >= 100
    ), cuts AS (
        SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut
        FROM counted WHERE k > 1
    ), scored AS (
        SELECT c.lang, c.phrase, c.k, c.a, x.f AS l, y.f AS r, n, cut,
               ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN totals USING (lang)
        JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
        JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
    ), lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), longer AS (
        SELECT lang, f, k, i, j, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS part
        FROM counted, range(1, 6) AS b(i), range(2, 6) AS e(j)
        WHERE k > 2 AND i < j AND j <= k AND j - i + 1 < k
    ), kept AS (
        SELECT * FROM lowest c
        WHERE NOT EXISTS (SELECT 1 FROM longer p WHERE p.lang = c.lang AND p.part = c.phrase AND 100 * p.f >= 100 * c.a)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))
