"""Session helper and shared-storage lookup."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for every session we build. Session time zone is pinned to UTC because raw
# timestamps carry no zone; AQE re-plans joins and coalesces tiny shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (hundreds of TB). Shuffle partitions start high and
# AQE coalesces them towards the advisory size; large input splits keep task counts
# manageable; skew join splits partitions of hot keys.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.ignoreMissingFiles": "false",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def get_session(
    master: str | None = None,
    app_name: str = "clickmart",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    cluster: bool = False,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if cluster:
        settings.update(CLUSTER_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the storage every executor shares: the cluster's ``spark.checkpoint.dir``.

    Where it is unset, a local master (one machine) gets a fresh local folder; any other
    master is an error, since executors don't see each other's disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master is {master})")
        base = tempfile.mkdtemp(prefix="clickmart-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared dir for one run. ``clear_scratch`` deletes it."""
    path = shared_dir(spark, "clickmart", f"{label}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system). There is no public DataFrame call to delete, rename or
    look for a folder; this is the one place that reaches for the JVM."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours through the file system it lies in."""
    target, fs = _file_system(spark, path)
    fs.delete(target, True)


def dir_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def rename_dir(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a name that isn't taken; an error if the file system refuses."""
    old, fs = _file_system(spark, source)
    new, _ = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"couldn't rename {source} to {target}")


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch folders there are now, for ``clear_scratch``."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, since: int = 0, keep_last: bool = False) -> None:
    """Delete the scratch folders made since the mark (but the newest, if that is to stay).
    Frames that read them end with it, so call it when their results are written."""
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    until = len(paths) - 1 if keep_last else len(paths)
    for path in paths[since:until]:
        delete_dir(spark, path)
    del paths[since:until]


__all__ = [
    "DEFAULT_CONF",
    "CLUSTER_CONF",
    "get_session",
    "shared_dir",
    "scratch_dir",
    "scratch_mark",
    "clear_scratch",
    "delete_dir",
    "dir_exists",
    "rename_dir",
]
