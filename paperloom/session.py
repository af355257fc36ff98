"""Settings shared by all operators: where lineage is cut and what may be broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its counted rows stay under this bound.
BROADCAST_ROWS = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where none is set (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="paperloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint, so that it is computed once and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_checked(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most ``bound`` rows, else unchanged (a shuffled join follows)."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def shuffled(df: DataFrame) -> DataFrame:
    """df with a hint to join it by shuffle and sort.  What Spark estimates of exploded or computed rows is far below their size, so that it would broadcast them through the driver."""
    return df.hint("merge")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, ...]:
    """The named Parquet tables below ``sf_dir``."""
    return tuple(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names)
