"""Session defaults.

The library never creates a session behind the caller's back; operators take
DataFrames. ``get_session`` is for scripts, tests and the bench: it switches on
AQE (coalescing, skew-join splitting, runtime broadcast conversion), keeps the
UI off and pins the session time zone to UTC so date arithmetic matches the
SQL oracle.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession

# Runtime settings every session of this engine wants.  They are applied only
# where the session was submitted without a value of its own.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}


def sizing(input_bytes: int, total_cores: int, target_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a job reading ``input_bytes`` on ``total_cores``.

    The initial shuffle partition count aims at ``target_bytes`` of input per
    partition (at least two waves of tasks); AQE then coalesces small partitions to the advisory size and splits skewed
    ones, so the count is an upper bound rather than a guess that must fit.
    """
    n = max(2 * total_cores, -(-input_bytes // target_bytes))
    return {"spark.sql.shuffle.partitions": str(n),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n)}


def input_bytes(paths) -> int:
    import os
    total = 0
    for p in paths:
        if os.path.isdir(p):
            for root, _, files in os.walk(p):
                total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
        elif os.path.exists(p):
            total += os.path.getsize(p)
    return total


def get_session(master: str | None = None, app: str = "salescast",
                conf: dict | None = None) -> SparkSession:
    """A session with ``conf`` and, where neither ``conf`` nor the submission
    set them, the engine's defaults.  Without ``master`` nothing about the
    cluster, its memory or its partitions is touched."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (builder.config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
                       .config("spark.ui.showConsoleProgress", "false"))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
        for k, v in DEFAULT_CONF.items():
            if k not in (conf or {}) and not sc.getConf().contains(k):
                spark.conf.set(k, v)
    return spark


def size_shuffles(spark: SparkSession, paths) -> None:
    """Sets the number of shuffle partitions from the bytes under ``paths``,
    unless the session was submitted with one."""
    sc = _context(spark)
    if sc is None or sc.getConf().contains("spark.sql.shuffle.partitions"):
        return
    total = 0
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    for k, v in sizing(total, sc.defaultParallelism).items():
        spark.conf.set(k, v)


def materialize(df, spark: SparkSession | None = None, name: str = "table"):
    """Cut lineage of an intermediate that several plans reuse by writing it
    as a Parquet table under the shared checkpoint folder and reading it back
    (never a local checkpoint).  One pass computes it; the read-back has
    column pruning and file statistics, and a lost executor re-reads files
    instead of recomputing from the raw tables."""
    import uuid
    spark = spark or df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/salescast-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one is installed only when
    none is configured (tests, local runs)."""
    return checkpoint_dir(spark, None if _configured(spark) else _local_fallback(spark))


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _configured(spark: SparkSession) -> bool:
    sc = _context(spark)
    return bool(spark.conf.get("spark.checkpoint.dir", None) or (sc is not None and sc.getCheckpointDir()))


def _local_fallback(spark: SparkSession) -> str:
    """Only for local runs and tests, where no shared folder is configured; on
    a cluster, executors would write to disks of their own."""
    import tempfile
    sc = _context(spark)
    if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="salescast-checkpoints-")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this is a
    shared file system path).  Only when it is unset — tests and local runs —
    ``fallback`` is installed as the checkpoint directory.
    """
    sc = _context(spark)
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir() if sc is not None else None
    if existing:
        return existing
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback given")
    os.makedirs(fallback, exist_ok=True)
    try:
        spark.conf.set("spark.checkpoint.dir", fallback)
    except Exception:  # static conf on some deployments
        pass
    if sc is not None:
        sc.setCheckpointDir(fallback)
    return fallback
