"""The corpus pipeline: each stage's result is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfield.llm import decontaminate, lines, minhash, packing, quality
from rankfield.llm.common import table, text_or_empty
from rankfield.session import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier predicts to be of class 1."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out("doc_id"))
    return quality.score_quality(docs, labels).filter("predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages and chunks of lines; a document of which nothing is left goes.

    Documents that were empty before stay. ``n_chars`` is that of the text left.
    """
    cleaned = lines.remove_repeated_passages(docs)
    emptied = (F.length("text") == 0) & (F.col("n_removed_lines") > 0)
    left = cleaned.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, size).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near duplicates, in one row.

    Rows equal in key and text are one document to the operator; the least of them stays.
    """
    kept = minhash.near_duplicates(docs).filter("kept").select(*docs.columns)
    again = docs.groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        return kept
    one = kept.groupBy(F.col("doc_id").alias("k"), F.xxhash64(text_or_empty("text")).alias("h"))
    return one.agg(F.min(F.struct(*kept.columns)).alias("row")).select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more of the words is benchmark text."""
    report = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return report.filter(~F.col("contaminated")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place what is left into training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("best-fit packing", pack),
]

#: Fitted weights, hashes and tokenizing are not SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
