"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at cluster scale. AQE re-plans joins from runtime
# sizes (a side under the broadcast threshold is broadcast after its size is
# measured), splits skewed shuffle partitions, and coalesces small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Remove checkpoint files once their frames are garbage-collected, so the
    # shared folder does not grow with every metric run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int) -> dict:
    """Settings for a large cluster: many initial shuffle partitions (AQE
    coalesces them to ~128 MB each at runtime, and splits skewed ones), so a
    100 TB shuffle never lands in a few huge partitions."""
    parts = max(2000, 3 * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    }


def build_session(master: str | None = None, cpus: int | None = None,
                  app: str = "metricforge", extra: dict | None = None,
                  cluster_cores: int | None = None) -> SparkSession:
    """Local or cluster session with the scale settings applied.

    Local (tests, bench): ``master`` defaults to ``local[cpus]``.
    Cluster: pass ``cluster_cores`` (total executor cores); the master is
    left to spark-submit unless given.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app)
    conf = dict(SCALE_CONF)
    if cluster_cores:
        conf.update(cluster_conf(cluster_cores))
        if master:
            builder = builder.master(master)
    else:
        builder = builder.master(master or f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(max(cpus * 2, 8))
        conf["spark.driver.memory"] = "12g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder.

    On a cluster, ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when it is unset (local tests) a fresh scratch folder is
    created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no driver context
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for checkpoints")
        return current
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    # Unset: acceptable only in local mode (tests, bench) - a fresh scratch
    # folder per session. On a cluster a machine-local folder would lose
    # checkpoints with the executor, so the shared folder must be configured.
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder for checkpoints")
    local = tempfile.mkdtemp(prefix="mf-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Rows of the largest table that a shuffle partition of ``sized_session`` is
#: meant for. The limit keeps the blocks of a shuffle manageable; tasks with
#: more rows than that spill.
ROWS_PER_PARTITION, MOST_PARTITIONS = 500_000, 20_000


def sized_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session with the settings of ``spark`` and shuffle partitions for
    steps that have as many keys as ``rows``: with a fixed number of them, a
    task's sorts and hash maps grow with the input. AQE merges small
    partitions only up to a size that is no larger. ``spark`` is unchanged."""
    own, conf = spark.newSession(), spark.conf.getAll
    for k, v in conf.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    set_now = [int(spark.conf.get("spark.sql.shuffle.partitions")), int(conf.get(initial, 1))]
    needed = min(-(-rows // ROWS_PER_PARTITION), MOST_PARTITIONS)
    for k in ("spark.sql.shuffle.partitions", initial):
        own.conf.set(k, str(max(needed, *set_now)))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    return own


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, as ``--py-files`` would:
    the driver serves a zip of its sources to the executors, once."""
    sc = spark.sparkContext
    if getattr(sc, "_metricforge_shipped", False):
        return
    package = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="mf-ship-"), "metricforge.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    sc._metricforge_shipped = True


#: Folders of intermediates that this process has made, by application.
_MADE: dict[str, list[str]] = {}


def scratch(spark: SparkSession) -> list[str]:
    """The folders of intermediates made so far and not removed, in order."""
    return _MADE.setdefault(spark.sparkContext.applicationId, [])


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    scratch(spark).append(path)
    return path


def clean(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Remove folders of intermediates: all that this session has made, or
    ``paths``. Frames that were read from them can no longer be evaluated, so
    write or collect a result first."""
    made = scratch(spark)
    for path in list(made if paths is None else paths):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        if path in made:
            made.remove(path)


def write_once(df, reader: SparkSession | None = None):
    """Write a shared intermediate as Parquet in the shared folder and read it
    back. Its readers scan the written rows (pruned and filtered like any
    table) instead of recomputing the lineage, a lost executor does not force
    a recompute from the source tables, and the planner knows its exact size:
    a small one is broadcast before any fact shuffle starts. ``reader``: the
    session that reads it, if not the frame's."""
    spark = df.sparkSession
    path = shared_path(spark, "written")
    df.write.parquet(path)
    return (reader or spark).read.schema(df.schema).parquet(path)
