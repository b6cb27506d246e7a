"""What tables there are and how full their columns are."""

from __future__ import annotations

from rankfield.operators.profile import column_stats, table_profile
from rankfield.plans.catalogue.registry import TABLES, new_database, query, read
from rankfield.sources import records
from rankfield.sources.footers import stored_profile


def _found(spark, sf_dir) -> dict:
    """Every table in the folder, with the schema its files have."""
    folder = sf_dir.rstrip("/")
    names = [n.removesuffix(".parquet") for n in records.names(spark, folder) if n.endswith(".parquet")]
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


#: What the two engines call the same type.
_SQL_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'array<float>'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE data_type END"""


def _profile_sql() -> str:
    """Columns and types as DuckDB finds them in the files; counts over all of them."""
    counts = " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, column_name, non_null,
                   (SELECT count(*) FROM {t}) AS row_count
            FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {t})
                  ON COLUMNS(*) INTO NAME column_name VALUE non_null)"""
        for t in TABLES
    )
    return f"""
    WITH counts AS ({counts})
    SELECT table_name, CAST(ordinal_position AS BIGINT) AS position, column_name,
           {_SQL_TYPE} AS data_type, row_count, non_null
    FROM information_schema.columns JOIN counts USING (table_name, column_name)
    """


@query("table_profile", _profile_sql())
def profile(spark, sf_dir):
    """Counts from the files' footers; only nested columns are read."""
    return stored_profile(spark, _found(spark, sf_dir))


@query("table_profile_scan", _profile_sql())
def profile_by_scan(spark, sf_dir):
    """The same for frames of any kind, here read row by row."""
    return table_profile(_found(spark, sf_dir))


@query(
    "table_overview",
    f"""
    SELECT table_name, count(*) AS column_count FROM information_schema.columns
    WHERE table_name IN ({", ".join(f"'{t}'" for t in TABLES)})
    GROUP BY table_name
    """,
)
def overview(spark, sf_dir):
    """All tables loaded into a database, described from what it stored about them."""
    tables = _found(spark, sf_dir)
    database = new_database(spark, tables=sorted(tables))
    for name, rows in tables.items():
        database.load(name, rows)
    return database.overview()


@query(
    "column_stats",
    """
    SELECT count(*) AS row_count, count(doc_id) AS doc_id_non_null, count(text) AS text_non_null,
           count(lang) AS lang_non_null, count(source) AS source_non_null,
           count(n_chars) AS n_chars_non_null, count(quality) AS quality_non_null,
           count(toxic) AS toxic_non_null
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def null_profile(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return column_stats(documents.join(read(spark, sf_dir, "labels"), "doc_id", "left"))
