"""Session and shared-storage helpers.

Nothing here hard-codes a machine-local folder: every write goes under the
shared folder the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is absent (unit tests, a laptop) do we fall back to a fresh temporary
folder and register it as the checkpoint dir, so later reads agree.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small stages keep ~one task per core (parallelismFirst is on); no effect on large data.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: ~256 MB scan splits and shuffle partitions, at
    least 3 tasks per core, AQE free to coalesce small stages and split skewed
    ones.  E.g. 100 TB on 1000 executors x 8 cores -> 409,600 shuffle partitions
    for the widest exchange; AQE coalesces the aggregated ones."""
    parts = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "strata",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Sessions handed to us by a driver may predate our builder: pin the
    # settings correctness depends on (UTC wall clock) without touching others.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MIN_PARTITION_SIZE_KEY = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def apply_query_defaults(spark: SparkSession) -> None:
    """Settings results or layout depend on, applied to a session we did not build:
    the UTC wall clock always; the small-stage partition floor only where the
    session left it unset (it lets small shuffles keep one task per core and has
    no effect on large data)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    launched = spark.sparkContext.getConf().contains(MIN_PARTITION_SIZE_KEY)
    if not launched and spark.conf.get(MIN_PARTITION_SIZE_KEY, "1MB") in ("1MB", "1m", "1048576b"):
        spark.conf.set(MIN_PARTITION_SIZE_KEY, DEFAULT_CONF[MIN_PARTITION_SIZE_KEY])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and landed tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir); only when unset, and only on a local master, create one and register it.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # getCheckpointDir returns <dir>/<uuid>; land tables next to it.
        return root.rstrip("/").rsplit("/", 1)[0]
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared root for one landed table."""
    root = checkpoint_root(spark)
    return f"{root}/strata/{name}/{uuid.uuid4().hex}"


def input_key(spark: SparkSession, sf_dir: str, table: str = "events") -> tuple:
    """Key under which a session keeps what it landed or fitted from a table: the
    application, the folder, and name, length and time of the table's files, so a
    changed input is never answered from an old copy."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files = tuple((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return spark.sparkContext.applicationId, sf_dir, files


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for python-side checks in tests."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
