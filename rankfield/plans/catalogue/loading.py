"""Keyed loads, layouts, attached sources and the document store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rankfield.operators.embed import HashingEmbedder
from rankfield.operators.merge import key_report
from rankfield.plans.catalogue.registry import new_database, query, read
from rankfield.plans.store import DocumentStore, promote_metadata
from rankfield.sources.attach import attach
from rankfield.sources.copies import create_sorted_copy, read_sorted_copy

#: The batch of every load below: labels worked out for the English documents. Some of
#: those have a label already, some do not, and labels of other languages are not in it.
_BATCH_SQL = """
    SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS quality, 0 AS toxic
    FROM documents WHERE lang = 'en'
"""


def _batch(spark, sf_dir):
    return (
        read(spark, sf_dir, "documents")
        .filter("lang = 'en'")
        .select(
            "doc_id",
            F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("quality"),
            F.lit(0).alias("toxic"),
        )
    )


def _loaded(spark, sf_dir, mode, batch):
    """Load the labels table, then the batch in the given mode; return the contents."""
    database = new_database(spark, tables=["labels"], keys={"labels": ["doc_id"]})
    database.load("labels", f"{sf_dir}/labels.parquet")
    key = None if mode in ("replace", "append") else ["doc_id"]
    database.load("labels", batch, mode, key)
    return database.table("labels").read()


@query("load_replace", _BATCH_SQL)
def load_replace(spark, sf_dir):
    return _loaded(spark, sf_dir, "replace", _batch(spark, sf_dir))


@query("load_append", f"SELECT doc_id, quality, toxic FROM labels UNION ALL {_BATCH_SQL}")
def load_append(spark, sf_dir):
    return _loaded(spark, sf_dir, "append", _batch(spark, sf_dir))


@query(
    "load_upsert",
    f"""
    WITH batch AS ({_BATCH_SQL})
    SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM batch)
    UNION ALL SELECT * FROM batch
    """,
)
def load_upsert(spark, sf_dir):
    return _loaded(spark, sf_dir, "upsert", _batch(spark, sf_dir))


@query(
    "load_update",
    f"""
    WITH batch AS ({_BATCH_SQL})
    SELECT doc_id, quality, toxic FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM batch)
    UNION ALL SELECT * FROM batch WHERE doc_id IN (SELECT doc_id FROM labels)
    """,
)
def load_update(spark, sf_dir):
    return _loaded(spark, sf_dir, "update", _batch(spark, sf_dir))


@query(
    "load_delete",
    """
    SELECT doc_id, quality, toxic FROM labels
    WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')
    """,
)
def load_delete(spark, sf_dir):
    return _loaded(spark, sf_dir, "delete", _batch(spark, sf_dir).select("doc_id"))


@query(
    "load_checks",
    """
    WITH keys AS (SELECT CASE WHEN quality IS NOT NULL AND doc_id % 10 <> 0 THEN doc_id // 3 END AS k
                  FROM labels),
         n AS (SELECT k, count(*) AS c FROM keys GROUP BY k)
    SELECT CAST(sum(c) AS BIGINT) AS rows,
           CAST(coalesce(sum(c) FILTER (k IS NULL), 0) AS BIGINT) AS missing,
           count(*) FILTER (k IS NOT NULL AND c > 1) AS repeated
    FROM n
    """,
)
def load_checks(spark, sf_dir):
    """What a keyed load would refuse in labels keyed by a coarser, partly missing key."""
    labels = read(spark, sf_dir, "labels")
    known = F.col("quality").isNotNull() & (F.col("doc_id") % 10 != 0)
    key = F.when(known, F.floor(F.col("doc_id") / 3))
    return key_report(labels.select(key.alias("k"), "quality"), ["k"])


@query(
    "sorted_layout_filter",
    """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events
    WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
    GROUP BY event_type
    """,
)
def sorted_layout_filter(spark, sf_dir):
    database = new_database(
        spark,
        tables=["events"],
        partition_by={"events": ["event_type"]},
        sorted_by={"events": ["ts"]},
    )
    database.load("events", f"{sf_dir}/events.parquet")
    events = database.table("events").read()
    return (
        events.filter("event_type = 'click'")
        .filter("ts >= TIMESTAMP_NTZ '2024-01-10' AND ts < TIMESTAMP_NTZ '2024-01-20'")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    )


@query(
    "sorted_copy_filter",
    """
    SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_custkey BETWEEN 10 AND 60 GROUP BY o_custkey
    """,
)
def sorted_copy_filter(spark, sf_dir):
    """A range of customers from a copy sorted by customer; the table is sorted by date."""
    database = new_database(spark, tables=["orders"], sorted_by={"orders": ["o_orderdate"]})
    database.load("orders", f"{sf_dir}/orders.parquet")
    orders = database.table("orders")
    create_sorted_copy(orders, ["o_custkey"], columns=["o_custkey", "o_totalprice"])
    return (
        read_sorted_copy(orders, "o_custkey")
        .filter("o_custkey BETWEEN 10 AND 60")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "attach_join",
    """
    SELECT r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
    """,
)
def attach_join(spark, sf_dir):
    database = new_database(spark, tables=["customer"], keys={"customer": ["c_custkey"]})
    database.load("customer", f"{sf_dir}/customer.parquet")
    (customer,) = database.publish()
    source = attach(
        spark,
        f"geo_{uuid.uuid4().hex}",
        {name: f"{sf_dir}/{name}.parquet" for name in ("nation", "region")},
    )
    return spark.sql(
        f"""
        SELECT r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM {customer}
        JOIN {source.alias}.nation ON c_nationkey = n_nationkey
        JOIN {source.alias}.region ON n_regionkey = r_regionkey
        GROUP BY r_name
        """
    )


@query(
    "store_lookup",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS content, quality
    FROM documents JOIN labels USING (doc_id) WHERE toxic = 1
    """,
)
def store_lookup(spark, sf_dir):
    """Stored documents by their ids; only the hash buckets of the ids are opened."""
    store = DocumentStore(new_database(spark), HashingEmbedder(), metadata_columns={"quality": "int"})
    documents = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    store.add_documents(
        documents.select(
            F.col("doc_id").cast("string").alias("id"),
            F.col("text").alias("content"),
            F.to_json(F.struct("quality")).alias("metadata_json"),
        )
    )
    ids = read(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    found = store.get_by_ids(ids)
    quality = F.get_json_object("metadata_json", "$.quality").cast("int")
    return found.select("id", "content", quality.alias("quality"))


@query(
    "store_upsert",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, lang, CAST(n_chars AS BIGINT) AS n_chars,
           CAST(quality AS BIGINT) AS quality, length(text) AS stored_chars
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def store_upsert(spark, sf_dir):
    """Add every document, then add the labelled ones again with their label."""
    store = DocumentStore(
        new_database(spark),
        HashingEmbedder(),
        metadata_columns={"lang": "string", "n_chars": "int", "quality": "int"},
    )
    documents = read(spark, sf_dir, "documents")

    def rows(df, *fields):
        return df.select(
            F.col("doc_id").cast("string").alias("id"),
            F.col("text").alias("content"),
            F.to_json(F.struct(*fields)).alias("metadata_json"),
        )

    store.add_documents(rows(documents, "lang", "n_chars"))
    labelled = documents.join(read(spark, sf_dir, "labels"), "doc_id")
    store.add_documents(rows(labelled, "lang", "n_chars", "quality"))
    return store.documents().select(
        "id", "lang", "n_chars", "quality", F.length("content").cast("bigint").alias("stored_chars")
    )


@query(
    "promote_metadata",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    """,
)
def promote(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "props")
    return promote_metadata(events, {"k": "int"}, "props").select("event_id", "k")


@query(
    "metadata_roundtrip",
    """
    SELECT concat(conv_id, ':', turn) AS id, role, turn, length(text) AS chars
    FROM conversations
    """,
)
def metadata_roundtrip(spark, sf_dir):
    """Store nested metadata and read values back out of it."""
    store = DocumentStore(new_database(spark), HashingEmbedder(), table="turns")
    turns = read(spark, sf_dir, "conversations")
    store.add_documents(
        turns.select(
            F.concat_ws(":", "conv_id", "turn").alias("id"),
            F.col("text").alias("content"),
            F.to_json(
                F.struct(
                    F.struct("role", F.array("turn", F.length("text")).alias("numbers")).alias("of")
                )
            ).alias("metadata_json"),
        )
    )
    kept = F.parse_json("metadata_json")
    return store.documents().select(
        "id",
        F.variant_get(kept, "$.of.role", "string").alias("role"),
        F.variant_get(kept, "$.of.numbers[0]", "bigint").alias("turn"),
        F.variant_get(kept, "$.of.numbers[1]", "bigint").alias("chars"),
    )
