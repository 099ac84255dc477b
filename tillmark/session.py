"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime plan changes that keep hot keys from ending up in one task. The force flag
# lets a skewed join be split even where that costs one more shuffle. ANSI mode turns an
# overflowing sum into an error.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS``, and sizes for large data on a cluster, where nothing else is set.

    On a cluster shuffles start out with several partitions per core and adaptive
    execution merges what turns out small; scans read larger splits.
    """
    wanted = dict(SETTINGS)
    if not is_local(spark):
        cores = spark.sparkContext.defaultParallelism
        first = max(4 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(first)
        wanted["spark.sql.files.maxPartitionBytes"] = "512MB"
    given = spark.sparkContext.getConf()
    for key, value in wanted.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    """One process on one machine, so that its own folders will do."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def build_session(
    app: str = "tillmark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **SETTINGS,
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local runs get one of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-tillmark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_MADE: list[str] = []


def new_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses."""
    _MADE.append(f"{shared_dir(spark)}/tillmark/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def dirs_made() -> list[str]:
    """The paths that ``new_dir`` has given out in this process, the latest last."""
    return list(_MADE)


def drop_dirs(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders of intermediate results that no DataFrame still in use reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _MADE:
            _MADE.remove(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure ``DataFrame.checkpoint`` has a folder to write to."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
