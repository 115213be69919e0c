"""Session construction and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins and splits skewed shuffle partitions at run time. The time zone is
# pinned because messages carry zone-less ISO text and months are derived from it.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Landing writes a few partitions per task; open files beat sorting every task by them.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tripstats", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on; `conf` wins over them.

    On a cluster leave `master` unset and let spark-submit name it. Shuffle widths are not
    fixed here: set `spark.sql.shuffle.partitions` to about shuffled bytes / 128 MB (see
    `shuffle_width`) and AQE merges what turns out too small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(shuffled_bytes: int, cores: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Shuffle partitions so that one task holds about `target_bytes`, at least one per core."""
    return max(cores, -(-shuffled_bytes // target_bytes))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach that the session names in `spark.checkpoint.dir`.

    Only a local master may do without: it gets a temporary folder. On a cluster a folder of
    one machine would be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tripstats-"))
    return context.getCheckpointDir()


def written(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For small intermediate results that several plans read: it cuts lineage, survives lost
    executors, and unlike `checkpoint()` computes the frame once, not twice.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/tripstats-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
