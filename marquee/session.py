"""Session construction and shared-folder lookup."""

from __future__ import annotations

import atexit
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI casts (overflow raises instead of
# wrapping), adaptive execution for skewed joins and partition coalescing.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints that no frame refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, executor_cores: int, executors: int, shuffle_share: float = 0.25,
                 partition_bytes: int = 512 * 1024 ** 2) -> dict[str, str]:
    """Settings sized to the input rather than to a laptop.

    Scans are split into ``partition_bytes``. The shuffle width aims at the
    same size for the share of the input that queries shuffle (they prune
    columns and combine before the exchange), at least two waves of the
    cluster's cores; AQE coalesces what turns out small and splits what turns
    out skewed. Few, large partitions keep the driver's bookkeeping (a status
    of every map task for every reducer) small: 100 TB on 1000 executors of 8
    cores gives 51,200 reducers.
    """
    cores = max(1, executor_cores * executors)
    width = max(2 * cores, -(-int(input_bytes * shuffle_share) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # broadcast only what AQE measured below this size
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }


def get_session(master: str | None = None, app: str = "marquee",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, warehouse: str | None = None) -> SparkSession:
    """Return (or create) a session with the defaults above.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests
    and the bench pass ``local[N]``. With a ``warehouse`` folder, its tables
    and views are known by name (``sinks.views.open_warehouse``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    if warehouse:
        from marquee.sinks.views import open_warehouse

        open_warehouse(spark, warehouse)
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and written hand-off tables.

    On a cluster this is the ``spark.checkpoint.dir`` the cluster names (the
    context already applied it at start-up). Only when it is unset and the
    master is local, as in tests, a fresh folder under the system temp dir
    stands in; elsewhere an unset folder is an error, as executors would write
    to disks of their own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="marquee-ckpt-")
        _LOCAL_ROOTS[sc.applicationId] = root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and hand-offs."""
    return ensure_checkpoint_dir(spark)


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint folder, for written
    hand-offs that a lazy result still reads; deleted when the driver ends."""
    root = f"{checkpoint_root(spark)}/marquee-{spark.sparkContext.applicationId}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_remove_scratch, spark, root)
    return root


_SCRATCH: set[str] = set()


def _remove_scratch(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is None:      # stopped: its folder was left to the cluster's clean-up
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
