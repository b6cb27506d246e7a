"""Small helpers around the Spark session: shared scratch space and size checks."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a query table that may travel to every executor.
BROADCAST_ROWS = 8192

#: Bytes of query data (vectors or text) that may travel to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

#: Candidates (queries times k) that one task may keep while it reads its rows.
TASK_CANDIDATES = 2_000_000

#: Inputs estimated below this are spread over all cores before CPU-heavy work.
SMALL_INPUT_BYTES = 256 * 1024 * 1024


def scratch_root(spark: SparkSession) -> str:
    """Return the shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a folder below the
    session's warehouse is used; executors of a cluster could not see one on the driver's
    disk, so there a local warehouse is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_rankfield_scratch"
        local = urlparse(root).scheme in ("", "file")
        if local and not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that the driver and all executors "
                f"share; the warehouse {root!r} is on one machine"
            )
    return root.rstrip("/")


def _session_folder(spark: SparkSession) -> str:
    name = spark.conf.get("spark.rankfield.session", None)
    if not name:
        name = uuid.uuid4().hex
        spark.conf.set("spark.rankfield.session", name)
    return f"{scratch_root(spark)}/rankfield/{name}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a path in the shared folder that nothing else uses."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's intermediate tables. Frames that read them cannot run again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the frame that reads it.

    Later jobs reuse the rows, and losing an executor costs a re-read instead of the
    whole upstream computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Return the optimizer's size estimate, the one ``explain(mode="cost")`` prints."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """Spread a small input over all cores; leave a large one as its scan split it.

    A small parquet file is often one row group, which is one task however many cores
    are free. Shuffling it is cheap because it is small. A large input, or one of as many
    files as there are cores, has enough splits already and is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if estimated_bytes(df) > SMALL_INPUT_BYTES or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, *by)


def bounded(
    df: DataFrame,
    *,
    rows: int = BROADCAST_ROWS,
    size: int = BROADCAST_BYTES,
) -> pa.Table | None:
    """Bring ``df`` to the driver if it holds at most ``rows`` rows, else return ``None``.

    Both limits are part of the job: at most ``rows + 1`` rows and, but for the last few of
    them, ``size`` bytes ever leave the executors.
    """

    def cut(batches):
        sent = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                yield part
                sent += part.nbytes
                if sent > size:
                    return

    table = df.limit(rows + 1).mapInArrow(cut, df.schema).toArrow()
    if table.num_rows > rows or table.nbytes > size:
        return None
    return table


def row_bound(df: DataFrame, *, rows: int = BROADCAST_ROWS) -> int | None:
    """Return the number of rows if it is at most ``rows``, else ``None``."""
    found = df.select(F.lit(1)).limit(rows + 1).count()
    return found if found <= rows else None


def broadcast_if(df: DataFrame, rows: int, limit: int = 200_000) -> DataFrame:
    """Hint a broadcast when the known row bound allows it, else leave the join to AQE."""
    return F.broadcast(df) if rows <= limit else df
