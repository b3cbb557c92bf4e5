"""Session helpers shared by the operators: the checkpoint folder and how
many buckets a distributed order is cut into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all machines share.

    A temporary folder is set only where the session has none and everything
    runs in this process (tests); a cluster without the setting is an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
            folder = tempfile.mkdtemp(prefix="fieldlens-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable ``df.checkpoint()``: the rows go to the shared folder and
    survive the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet below the shared folder and read it again."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def releasing(run):
    """A ``mapInArrow`` function whose worker, which Spark keeps for later
    tasks, gives the memory of a task back to the system when it ends."""
    def task(batches):
        import ctypes
        import gc

        import pyarrow as pa
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if hasattr(ctypes.CDLL(None), "malloc_trim"):  # glibc
                ctypes.CDLL(None).malloc_trim(0)
    return task


def skew_join(rows: DataFrame, summary: DataFrame, on: list[str]) -> DataFrame:
    """Join rows to an aggregate of them by its long keys.  Both sides meet on
    the inverted keys, so the aggregate's own partitioning does not fix the
    join's and AQE can split a hot key's rows."""
    flipped = [F.bitwise_not(F.col(c)).alias(f"__{c}") for c in on]
    left = rows.select("*", *flipped)
    right = summary.select(*[c for c in summary.columns if c not in on], *flipped)
    return left.join(right, [f"__{c}" for c in on]).drop(*[f"__{c}" for c in on])


def shielded(docs: DataFrame, replaced: list[str]) -> tuple[list[Column], list[Column]]:
    """Input columns under names that cannot clash, and those names turned
    back, without the ``replaced`` ones.  Columns stay separate, so Catalyst
    still prunes the ones that nobody asks for."""
    kept = [c for c in docs.columns if c not in replaced]
    away = [F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(kept)]
    return away, [F.col(f"__in_{i}").alias(c) for i, c in enumerate(kept)]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
           broadcast_rows: int = 20_000) -> DataFrame:
    """Join a summary table to its rows.  The summary is checkpointed and
    counted: up to ``broadcast_rows`` it is broadcast, beyond that it is an
    ordinary shuffle join (AQE splits its skewed keys).  Keys match null-safely."""
    right = checkpoint(right)
    if right.count() <= broadcast_rows:
        right = F.broadcast(right)
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    return left.join(renamed, same, how).drop(*[f"__{c}" for c in on])
