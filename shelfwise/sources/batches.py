"""Tables that grow by micro-batches.

A run writes folders of its own, one per batch, below a base that compaction made. A replayed
batch overwrites its own folder only, so a restart changes nothing, and a run that starts
with a new checkpoint never touches what an earlier run or the base holds.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.topn import top_n

#: The run number of the compacted base. Runs that follow it are numbered from 1.
BASE_RUN = 0


def write_batch(df: DataFrame, path: str, batch: int, run: int = 1) -> None:
    """Store one batch of a run; ``run`` must be new for each new checkpoint."""
    if run <= BASE_RUN:
        raise ValueError("runs are numbered from 1; 0 is the compacted base")
    df.write.mode("overwrite").parquet(f"{path}/run={run}/batch={batch}")


def next_run(spark: SparkSession, path: str) -> int:
    """A run number above all that the table holds, for a job with a new checkpoint."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 1
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return 1 + max([0, *(int(m[1]) for name in names if (m := re.fullmatch(r"run=(\d+)", name)))])


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches with their numbers in ``run`` and ``batch``. The path must hold at least one."""
    numbers = [T.StructField(name, T.LongType()) for name in ("run", "batch")]
    return spark.read.schema(T.StructType([*schema.fields, *numbers])).parquet(path)


def latest(rows: DataFrame, key: str) -> DataFrame:
    """The newest batch's row per key."""
    newest = [F.col("run").desc(), F.col("batch").desc()]
    return top_n(rows, [key], newest, 1).drop("rank", "run", "batch")


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: str, into: str,
    newest_only: bool = True,
) -> None:
    """Fold all batches into the base of a new table at ``into``, to go on with.

    ``newest_only`` keeps each key's newest row, as for lists; a history keeps all.
    """
    rows = read_batches(spark, path, schema)
    folded = latest(rows, key) if newest_only else rows.drop("run", "batch")
    folded = folded.repartitionByRange(key).sortWithinPartitions(key)
    folded.write.parquet(f"{into}/run={BASE_RUN}/batch=0")
