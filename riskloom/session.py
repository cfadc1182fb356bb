"""SparkSession construction and shared-storage locations.

Reports never hard-code cluster settings: on a cluster the session comes from
``spark-submit`` and its configuration wins.  ``build_session`` is for local
runs and tests only, and it sets a checkpoint directory only where the
session has none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the reports are designed around.  All are Spark defaults in 4.x
# except the session time zone; they are applied by ``build_session`` only.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# The reference's session settings and what takes their place:
#   parallel execution of independent stages -> Spark schedules independent
#       stages of one job concurrently by itself (nothing to set);
#   automatic map-side join conversion -> spark.sql.autoBroadcastJoinThreshold
#       (a size check) plus AQE's runtime conversion;
#   a fixed number of reducers -> spark.sql.shuffle.partitions, sized to the
#       input, with AQE coalescing small partitions (never a fixed 10).
def report_settings(spark: SparkSession, shuffle_partitions: int | None = None,
                    broadcast_threshold_bytes: int | None = None) -> None:
    """Apply the runtime SQL settings the reports are designed around."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if broadcast_threshold_bytes is not None:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(broadcast_threshold_bytes))


def partitions_for(input_bytes: int, target_bytes: int = 200 << 20, minimum: int = 8) -> int:
    """A shuffle partition count for an input size (about 200 MB each)."""
    return max(minimum, -(-input_bytes // target_bytes))


def build_session(master: str = "local[*]", app_name: str = "riskloom",
                  shuffle_partitions: int | None = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, if any."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext handle (e.g. Spark Connect)
        d = None
    return d or spark.conf.get("spark.checkpoint.dir", None)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint dir.  Where it is unset, a ``local`` master
    (tests, single-machine runs) gets a temporary folder; on a cluster that
    would scatter the files over the executors' own disks, so it is an error."""
    d = checkpoint_dir(spark)
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


# Intermediate tables written by this process and not yet deleted.
_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table under the shared checkpoint folder;
    it lives until ``drop_scratch`` or ``release_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.add(path)
    return path


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that no later frame reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _SCRATCH.discard(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete every intermediate table of this process: call it once the
    frames returned by the reports are written or no longer needed."""
    drop_scratch(spark, *list(_SCRATCH))


def save_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as a parquet table under the shared checkpoint folder;
    return a frame reading it back, and its path.

    This cuts the lineage like ``checkpoint()`` but computes the input only
    once (an eager RDD checkpoint runs its input twice unless it is cached),
    and the files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``save_scratch`` without the path."""
    return save_scratch(df, name)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
