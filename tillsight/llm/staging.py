"""Shared plumbing of the training-data operators: reads, staged tables, limits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.session import ensure_checkpoint_dir

#: Arrow batches sent to Python workers hold about this many bytes at most, so
#: that a worker's memory does not follow the length of the texts in a batch.
ARROW_BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes (a batch always holds whole rows)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Parquet scan of one table of the data folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it back.

    Parquet files in the folder that ``spark.checkpoint.dir`` names outlive any
    executor, so a lost machine costs a re-read and never a recomputation.  Each
    call takes a new folder, so nothing is overwritten while it is being read.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A joined side of at most so many rows (8 to 32 bytes each) is sent to all tasks.
SMALL_ROWS = 1_000_000


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a narrow ``right`` that is usually small.

    It is counted first: up to SMALL_ROWS rows are broadcast, which spares the
    wide left side a shuffle; beyond that Spark joins by shuffle (and AQE splits
    skewed partitions).
    """
    right = stage(right, "join-side")
    return left.join(F.broadcast(right) if right.count() <= SMALL_ROWS else right, on, how)
