"""Ordinary SQL: projection, joins, aggregates, windows, paging, dates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankfield.functions import patterns
from rankfield.operators.envelope import capped_result
from rankfield.operators.merge import get_by_ids
from rankfield.operators.paging import deep_page
from rankfield.operators.topk import page
from rankfield.plans.catalogue.registry import query, read
from rankfield.sources.parquet import scan_parquet


@query(
    "scan_parquet",
    """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    """,
)
def scan(spark, sf_dir):
    rows = scan_parquet(spark, f"{sf_dir}/supplier.parquet")
    return rows.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


@query(
    "project_filter",
    """
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price,
           coalesce(nullif(o_orderstatus, 'O'), 'open') AS status
    FROM orders
    WHERE o_totalprice > 100000 AND o_orderdate >= TIMESTAMP '1995-01-01'
    """,
)
def project_filter(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return orders.filter(
        "o_totalprice > 100000 AND o_orderdate >= TIMESTAMP_NTZ '1995-01-01'"
    ).select(
        "o_orderkey",
        F.floor("o_totalprice").alias("price"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("O")), F.lit("open")).alias("status"),
    )


@query(
    "ilike_filter",
    """
    SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%RED%' AND p_type LIKE '%O%'
    """,
)
def ilike_filter(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.filter(F.col("p_name").ilike("%RED%") & F.col("p_type").like("%O%")).select(
        "p_partkey", "p_name", "p_type"
    )


@query(
    "get_by_ids",
    """
    SELECT doc_id, lang, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
    """,
)
def by_ids(spark, sf_dir):
    ids = read(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return get_by_ids(documents, ids, key="doc_id")


@query(
    "join_inner",
    """
    SELECT n_name, o_orderpriority, count(*) AS orders,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
    """,
)
def join_inner(spark, sf_dir):
    lineitem = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "o_orderpriority")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias(
                "revenue"
            ),
        )
    )


@query(
    "group_agg",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_quantity), 6) AS avg_qty,
           round(sum(l_extendedprice), 2) AS total, min(l_shipdate) AS first_ship,
           max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY ALL
    """,
)
def group_agg(spark, sf_dir):
    return (
        read(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("total"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )


@query("distinct_values", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_values(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "window_rank",
    """
    SELECT o_custkey, o_orderkey,
           rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS price_rank,
           round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running
    FROM orders
    """,
)
def window_rank(spark, sf_dir):
    customer = Window.partitionBy("o_custkey")
    by_date = customer.orderBy("o_orderdate", "o_orderkey")
    return read(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.rank().over(customer.orderBy(F.desc("o_totalprice"))).cast("bigint").alias("price_rank"),
        F.round(
            F.sum("o_totalprice").over(by_date.rowsBetween(Window.unboundedPreceding, 0)), 2
        ).alias("running"),
    )


@query(
    "page_offset",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20
    """,
)
def page_offset(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], offset=20, limit=10)


@query(
    "page_deep",
    """
    SELECT o_orderkey, o_totalprice FROM (
        SELECT o_orderkey, o_totalprice,
               row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place,
               count(*) OVER () AS n
        FROM orders
    ) WHERE place > n // 2 AND place <= n // 2 + 50
    """,
)
def page_deep(spark, sf_dir):
    """Fifty orders from the middle of the table, the dearest first."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    order = {"o_totalprice": False, "o_orderkey": True}
    return deep_page(orders, order, offset=orders.count() // 2, limit=50, sort_rows=1_000)


@query(
    "capped_result",
    """
    SELECT o_orderkey, o_totalprice,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS row_count
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100
    """,
)
def capped(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    found = capped_result(
        orders.select("o_orderkey", "o_totalprice"), max_rows=100, order=[F.asc("o_orderkey")]
    )
    return found.rows.withColumn("row_count", F.lit(found.row_count).cast("bigint"))


@query(
    "cte_chain",
    """
    WITH spent AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey),
         named AS (SELECT c_mktsegment, total FROM spent JOIN customer ON o_custkey = c_custkey)
    SELECT c_mktsegment, count(*) AS customers, round(avg(total), 2) AS avg_total
    FROM named GROUP BY c_mktsegment
    """,
)
def cte_chain(spark, sf_dir):
    return spark.sql(
        """
        WITH spent AS (
            SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey
        ),
        named AS (
            SELECT c_mktsegment, total FROM spent JOIN {customer} ON o_custkey = c_custkey
        )
        SELECT c_mktsegment, count(*) AS customers, round(avg(total), 2) AS avg_total
        FROM named GROUP BY c_mktsegment
        """,
        orders=read(spark, sf_dir, "orders"),
        customer=read(spark, sf_dir, "customer"),
    )


@query(
    "subquery_filter",
    """
    SELECT s_suppkey, s_name FROM supplier
    WHERE s_acctbal > (SELECT avg(s_acctbal) FROM supplier)
      AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')
    """,
)
def subquery_filter(spark, sf_dir):
    return spark.sql(
        """
        SELECT s_suppkey, s_name FROM {supplier}
        WHERE s_acctbal > (SELECT avg(s_acctbal) FROM {supplier})
          AND s_suppkey IN (SELECT l_suppkey FROM {lineitem} WHERE l_returnflag = 'R')
        """,
        supplier=read(spark, sf_dir, "supplier"),
        lineitem=read(spark, sf_dir, "lineitem"),
    )


@query(
    "scalar_mix",
    """
    SELECT c_custkey, upper(c_name) AS name, length(c_mktsegment) AS n,
           round(abs(c_acctbal), 1) AS balance,
           CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS side,
           concat(c_mktsegment, '-', CAST(c_nationkey AS VARCHAR)) AS tag
    FROM customer
    """,
)
def scalar_mix(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.upper("c_name").alias("name"),
        F.length("c_mktsegment").cast("bigint").alias("n"),
        F.round(F.abs("c_acctbal"), 1).alias("balance"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("side"),
        F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("tag"),
    )


@query(
    "to_char_strftime",
    """
    SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, strftime(ts, '%d %b %Y, %j') AS day,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def to_char_strftime(spark, sf_dir):
    return (
        read(spark, sf_dir, "events")
        .groupBy(
            patterns.to_char("ts", "%Y-%m-%d %H:%M").alias("minute"),
            patterns.date_format("ts", "%d %b %Y, %j").alias("day"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "to_date_strftime",
    """
    SELECT CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS day,
           count(*) AS n
    FROM orders GROUP BY ALL
    """,
)
def to_date_strftime(spark, sf_dir):
    text = patterns.to_char("o_orderdate", "%d/%m/%Y")
    return (
        read(spark, sf_dir, "orders")
        .groupBy(patterns.to_date(text, "%d/%m/%Y").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "to_timestamp_strftime",
    """
    SELECT event_id, strptime(strftime(ts, '%Y.%m.%dT%H-%M-%S'), '%Y.%m.%dT%H-%M-%S') AS second
    FROM events
    """,
)
def to_timestamp_strftime(spark, sf_dir):
    text = patterns.to_char("ts", "%Y.%m.%dT%H-%M-%S")
    return read(spark, sf_dir, "events").select(
        "event_id", patterns.to_timestamp(text, "%Y.%m.%dT%H-%M-%S").alias("second")
    )


@query(
    "date_trunc_agg",
    """
    SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY ALL
    """,
)
def date_trunc_agg(spark, sf_dir):
    return (
        read(spark, sf_dir, "events")
        .groupBy(patterns.date_trunc("day", "ts").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    )


@query(
    "date_bin_hour",
    """
    SELECT time_bucket(INTERVAL '1 hour', CASE WHEN event_id % 10 != 0 THEN ts END) AS hour,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def date_bin_hour(spark, sf_dir):
    """Bins of a time that is missing in one row of ten; those rows are a group as well."""
    ts = F.when(F.col("event_id") % 10 != 0, F.col("ts"))
    return (
        read(spark, sf_dir, "events")
        .withColumn("ts", ts)
        .groupBy(patterns.date_bin("1 hour", "ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "interval_sub",
    """
    SELECT o_orderpriority, min(CAST(o_orderdate AS DATE) - INTERVAL '6 days') AS first_call,
           max(o_orderdate - INTERVAL '6 days') AS last_call
    FROM orders GROUP BY o_orderpriority
    """,
)
def interval_sub(spark, sf_dir):
    # A date minus an interval is a timestamp in the engine this is checked against.
    day = F.col("o_orderdate").cast("date").cast("timestamp_ntz")
    return (
        read(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.min(day - F.expr("INTERVAL '6 days'")).alias("first_call"),
            F.max(F.expr("o_orderdate - INTERVAL '6 days'")).alias("last_call"),
        )
    )


@query(
    "now_check",
    """
    SELECT event_type, count(*) AS n, bool_and(CAST(ts AS DATE) < current_date) AS all_past
    FROM events WHERE CAST(ts AS DATE) <= current_date GROUP BY event_type
    """,
)
def now_check(spark, sf_dir):
    events = read(spark, sf_dir, "events").filter(F.col("ts") <= F.localtimestamp())
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(F.col("ts").cast("date") < F.current_date()).alias("all_past"),
    )
