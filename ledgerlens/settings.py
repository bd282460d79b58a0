"""Session settings the library reads."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of one key above which the key no longer goes to a single task.
HOT_ROWS_CONF = "spark.ledgerlens.hotKeyRows"
DEFAULT_HOT_ROWS = 1_000_000

#: A hot key is split into pieces of this fraction of the limit.
PIECES_PER_LIMIT = 5


def hot_key_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-checkpoint-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/ledgerlens/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    This cuts the lineage, survives lost executors, and as Parquet lets later
    readers skip the columns they do not need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
