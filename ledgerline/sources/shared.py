"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows, and bytes, of one Arrow batch; whole texts travel, so a batch is kept short.
ARROW_ROWS = 1000
ARROW_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the context's checkpoint folder; a temporary one only where neither is set and the
    master is local (tests).  On a cluster a machine's own folder would lose rows, so there the setting is required."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
        base = sc._jsc.sc().getCheckpointDir().get()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/ledgerline-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends, the files outlive any executor.

    Parquet rather than ``checkpoint()``: compressed, column-pruned on re-read, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a path, if it is there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``cut`` made; nothing may read them any more."""
    for df in tables:
        drop_path(df.sparkSession, df._scratch)


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> None:
    """Bounds an Arrow batch by rows and by bytes (a single text may be larger): the default of 10,000 whole texts could be
    gigabytes.  The session keeps the smaller bounds: a query is planned lazily, and may be run long after this call."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
