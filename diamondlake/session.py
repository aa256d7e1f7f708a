"""Session construction and lineage helpers.

Scale notes: AQE is on so shuffle partition counts coalesce at runtime and
skewed sort-merge joins are split; broadcast decisions for tables whose size
grows with the data are left to the size checks of the planner
(``spark.sql.autoBroadcastJoinThreshold`` at plan time, AQE at runtime).
Explicit ``broadcast()`` hints are only used on sides whose size is bounded by
construction (see ``operators.joins.broadcast_bounded``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def _driver_memory() -> str:
    """Local-mode heap: 60 % of physical memory, between 2 and 16 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gb = int(total * 0.6 / (1 << 30))
    return f"{max(2, min(16, gb))}g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "diamondlake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``shuffle_partitions`` should be sized to the data (roughly input bytes /
    128 MB on a cluster); AQE coalesces small ones away at runtime.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    if "PYSPARK_GATEWAY_PORT" in os.environ:    # started by spark-submit: its JVM holds the settings
        SparkContext._ensure_initialized()
    given = SparkConf()
    local = master is None and not given.contains("spark.master")
    builder = SparkSession.builder.appName(app_name)
    if local:
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions or local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    if (master or given.get("spark.master")).startswith("local") and not given.contains("spark.driver.memory"):
        conf["spark.driver.memory"] = _driver_memory()
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def partitions_for_bytes(total_bytes: int, target_bytes: int = 256 << 20, minimum: int = 8) -> int:
    """Initial shuffle partition count for a job that shuffles ``total_bytes``:
    about ``target_bytes`` per task (AQE then merges small ones and splits
    skewed join partitions).  E.g. a 100 TB shuffle -> ~400k partitions."""
    return max(minimum, -(-int(total_bytes) // int(target_bytes)))


def _one_machine(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[...]``; ``local-cluster`` isn't)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset (local
    tests) create a private scratch folder for it."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (a remote session has no SparkContext; the server owns the dir)
        sc = None
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
        return configured
    if sc is not None and not _one_machine(sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="diamondlake-ckpt-")   # only when the cluster names none (tests)
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> str | None:
    """Make ``diamondlake`` importable in the Python workers (pandas functions
    in the scans run there): zip the package once per application and
    ``addPyFile`` it, which distributes it to every executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (remote session: ship with the session's own artifact mechanism)
        return None
    if sc.applicationId in _SHIPPED:
        return None
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="diamondlake-pkg-"), "diamondlake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint dir and read again. Like ``cut_lineage``, but for
    tables of size: columns are compressed, readers take only those they need, and Spark knows the size."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "diamondlake", f"stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
