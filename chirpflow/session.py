"""Session factory (Y4, Y5) and the shared scratch location.

Cluster settings come from the deployment; the builder only fills in what is
unset.  Every path the library writes (stream checkpoints, intermediate tables,
saved models) lives under ``spark.checkpoint.dir``, the shared folder the
cluster names.  A private folder is created only when the session is local and
the setting is missing (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Defaults for a fresh session.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Delete reliable-checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "chirpflow",
                hive: bool = False, log_level: str = "WARN",
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session.  ``hive=True`` enables the Hive catalog."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)  # Y5
    ensure_checkpoint_dir(spark)
    return spark


def tune_shuffle(spark: SparkSession, input_bytes: int,
                 partition_bytes: int = 128 << 20) -> int:
    """Size shuffles for an input of ``input_bytes`` so each reducer holds about
    ``partition_bytes`` and none spills heavily.  AQE can only coalesce
    partitions, never split them, so the partition count must start high
    enough: one per ``partition_bytes`` of input, at least two per core.
    Returns the partition count set for the session."""
    cores = spark.sparkContext.defaultParallelism
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    return parts


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only for local runs."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, S3, ABFS, ...) that every executor can reach")
    path = tempfile.mkdtemp(prefix="chirpflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def ready(spark: SparkSession) -> SparkSession:
    """Name the shared folder and let Python workers import this package, also
    when the driver's process was started from another folder."""
    ensure_checkpoint_dir(spark)
    env = spark.sparkContext.environment
    known = [p for p in (env.get("PYTHONPATH") or os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
    return spark


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint folder; unique per call by default.

    Retention: whatever a job writes there lives in the application's own
    folder and serves that application only.  ``clear_scratch`` removes it at
    the end; a folder left by a lost application can be deleted at any time."""
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([_scratch_root(spark), *tail])


def _scratch_root(spark: SparkSession) -> str:
    return "/".join([ensure_checkpoint_dir(spark), "chirpflow", spark.sparkContext.applicationId])


def hadoop_fs(spark: SparkSession, path: str):
    """The file system of ``path`` and the path on it, for any store that Spark writes to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder."""
    fs, path = hadoop_fs(spark, _scratch_root(spark))
    fs.delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """Spark's estimate of a frame's input bytes (file sizes for a scan); no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path (tests only)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
