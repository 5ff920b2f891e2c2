"""Size checks, ranking and other helpers the operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Up to this many short rows are broadcast; beyond it Spark picks a shuffled join by itself.
BROADCAST_ROWS = 1_000_000
BROADCAST_CHARS = 64_000_000


def is_at_most(df: DataFrame, n: int) -> bool:
    """Counts no more than n + 1 rows."""
    return df.limit(n + 1).count() <= n


def hint_small(df: DataFrame, proven: bool) -> DataFrame:
    return F.broadcast(df) if proven else df


def build_left(df: DataFrame, proven_small: bool) -> DataFrame:
    """A small left side of a left join: Spark hashes it, per bucket, instead of sorting the large side."""
    return df.hint("shuffle_hash") if proven_small else df


def settle(df: DataFrame, name: str) -> DataFrame:
    """A result that is used more than once, written to the shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def meet(held: DataFrame, asked: DataFrame, blocks: int, run: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """Every row of `held`, numbered by its int column `block` below `blocks`, meets every row of `asked`.

    run gets a block's Arrow batches in one task: the row of `held`, where the column `held` is true, before those of
    `asked`. A row of `held` moves once and one of `asked` once per block; nothing is broadcast or joined."""
    every = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("held", F.lit(False))
    both = held.withColumn("held", F.lit(True)).unionByName(every, allowMissingColumns=True)
    return both.repartitionById(blocks, "block").sortWithinPartitions("block", F.desc("held")).mapInArrow(run, schema)


def top_k(scores: DataFrame, k: int, score: str = "score", keys: tuple[str, ...] = ("query_id",),
          tie: str = "doc_id") -> DataFrame:
    """Ranks 1..k per key, best score first. Scores are compared at nine decimals, so the order
    in which a cluster adds floats cannot swap neighbours; ties go to the lower id.
    Each task cuts to k rows per key before the shuffle."""
    nanos = F.floor(F.col(score) * 1e9 + 0.5)
    order = W.partitionBy(*keys).orderBy(nanos.desc(), F.col(tie))
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that driver and executors share.

    That is `spark.checkpoint.dir`, else the folder given to `setCheckpointDir`. With neither, a session on one
    machine uses a temporary folder; on a cluster an executor could not read another one's files, so this fails."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_scratch()
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


@cache
def _own_scratch() -> str:
    return tempfile.mkdtemp(prefix="matchlake-")
