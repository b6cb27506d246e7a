"""The one input format: parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def lowered(df: DataFrame) -> DataFrame:
    """Return ``df`` with lowercase column names, the form in which names are stored."""
    names = [name.lower() for name in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names differ only in case")
    return df if names == df.columns else df.toDF(*names)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Return the rows of a parquet file or folder."""
    try:
        return lowered(spark.read.parquet(path))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(
                f"nothing at {path!r}; pass the path of a parquet file or folder"
            ) from error
        raise
