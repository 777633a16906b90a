"""Session construction and lineage control."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(master)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | conf
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` of the session wins; only where neither it nor a directory of the
    context is set and the session is local (tests, a laptop) a temporary folder is made. On a
    cluster every executor would write to a folder of its own, so it raises there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    if not wanted:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        wanted = tempfile.mkdtemp(prefix="lathework-")
    context.setCheckpointDir(wanted)
    return context.getCheckpointDir() or wanted


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; nothing is there yet."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, without its plan.

    A written table is computed once; an eager checkpoint of the engine computes all that is behind
    it a second time for the copy.
    """
    path = shared_folder(df.sparkSession, "table")
    df.write.option("compression", "lz4").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows up to which a side of a join is broadcast; they are counted first.
BROADCAST_ROWS = 100_000


def broadcast_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for a broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
