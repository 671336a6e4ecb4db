"""Session helpers.

The library never creates a session behind the caller's back; ``build_session``
is for tests, the bench and scripts. ``ensure_checkpoint_dir`` reads the
cluster's ``spark.checkpoint.dir`` and only invents a local folder when the
setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "churnlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CHURNLENS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when nothing is configured (tests, local runs) a fresh folder under
    the system temp directory is created for this session; on any other master an
    unset folder is an error, as executors would write to their own disks. Works without a
    ``SparkContext`` handle (Spark Connect) because the library only writes
    tables there; with a classic session the context's checkpoint folder is set
    too, for callers that use ``DataFrame.checkpoint``.
    """
    global _LOCAL_DIR
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="churnlens-ckpt-")
        configured = _LOCAL_DIR
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


_LOCAL_DIR: str | None = None


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect sessions have no SparkContext
        return None


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (the files live on the cluster's
    shared ``spark.checkpoint.dir`` and survive lost executors) but, unlike a
    checkpointed RDD of whole rows, later scans are columnar: column pruning,
    predicate pushdown and the vectorised reader apply. ``name`` must be unique
    within the application (the folder is the application's checkpoint folder).
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


MAX_SHUFFLE_PARTITIONS = 200_000


def scale_conf(largest_input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Session settings for a cluster run, from the largest input and the core count.

    The adapter's shuffles carry at most the projected line-level data, so the
    shuffle partition count aims at ~256 MB per partition of the largest input,
    at least 3 waves of tasks, and at most 200,000 partitions (beyond that the
    driver's map-output bookkeeping grows faster than the gain). AQE coalesces
    the small mart shuffles back down and splits skewed join partitions. Scans
    read 256 MB splits.
    """
    parts = int(largest_input_bytes // target_partition_bytes) + 1
    parts = min(max(3 * total_cores, parts), max(MAX_SHUFFLE_PARTITIONS, 3 * total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
