"""Spark session and shared-folder helpers.

Every job in the library takes a ``SparkSession`` from the caller; this module
only builds one for tests, the bench and the driver contract, and resolves the
shared folder used for checkpoints and staged tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for correct and comparable results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Scale defaults for a cluster, applied only where the cluster did not set a
# value: large scan splits, and shuffle partitions sized by AQE from a starting
# count that follows the cluster's cores (it coalesces small ones and splits
# skewed ones), so a 100 TB input runs as ~400k scan tasks of 256 MB.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Stream state off the JVM heap (large keyed state, incremental commits).
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = 8,
                app_name: str = "quern", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    Locally (``local[...]``) the UI stays off and the shuffle partition count
    follows the cores. On a cluster the existing session is reused and only the
    ``CLUSTER_CONF`` values the cluster left unset are filled in.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    local = (master or "local").startswith("local")
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if local:
        # One long-lived local JVM runs many queries and streams: keep its
        # bookkeeping bounded and unload the state stores of finished streams.
        builder = (builder
                   .config("spark.driver.memory",
                           os.environ.get("QUERN_DRIVER_MEMORY", _local_heap()))
                   .config("spark.sql.ui.retainedExecutions", "50")
                   .config("spark.ui.retainedJobs", "200")
                   .config("spark.ui.retainedStages", "200")
                   .config("spark.ui.retainedTasks", "20000")
                   .config("spark.sql.streaming.stateStore.maintenanceInterval", "5s"))
    for k, v in {**REQUIRED_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    if spark.sparkContext.master.startswith("local"):
        if shuffle_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        apply_cluster_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_cluster_conf(spark: SparkSession) -> None:
    """Fill in ``CLUSTER_CONF`` and shuffle counts where a cluster's session leaves them unset.

    Shuffles start at 4 partitions a core (streams keep 2: their count is fixed for good).
    Local masters and sessions without a SparkContext stay as they are.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect): set at submit
        return
    if sc.master.startswith("local"):
        return
    cores = sc.defaultParallelism
    counts = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(200, 4 * cores)),
              "spark.sql.shuffle.partitions": str(max(200, 2 * cores))}
    for k, v in {**CLUSTER_CONF, **counts}.items():
        if not sc.getConf().contains(k):
            spark.conf.set(k, v)


def _local_heap() -> str:
    """Local driver heap: 60 % of the machine's memory, between 2 and 12 GB."""
    try:
        with open("/proc/meminfo") as f:
            kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal:"))
    except (OSError, StopIteration, ValueError):
        return "4g"
    return f"{max(2, min(12, int(kb / 1024 / 1024 * 0.6)))}g"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quern`` importable on every executor's Python workers.

    Functions handed to ``mapInPandas`` / ``applyInPandasWithState`` live in
    this package and are pickled by reference, so workers import it. The
    package is zipped in memory once per application, written through the
    Hadoop FileSystem API into the shared checkpoint folder and registered with
    ``addPyFile`` (what ``--py-files`` does at submit time).
    """
    import io
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect): ship at submit
        return
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pkg-{uuid.uuid4().hex[:12]}/quern.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset (local tests, the bench) a fresh
    folder is made and registered, so ``DataFrame.checkpoint()`` and stream
    checkpoints have a reliable home.
    """
    global _LOCAL_BASE
    base = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext handle (e.g. Spark Connect)
        sc = None
    if sc is not None:
        base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not a SQL conf on every version
            base = None
    if not base and sc is not None:
        existing = sc._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            base = existing.get()
    if not base:
        # Unset (tests, the local bench): one fresh folder per process. Executors of a
        # cluster would not see it.
        if sc is not None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _LOCAL_BASE is None:
            _LOCAL_BASE = tempfile.mkdtemp(prefix="quern-ckpt-")
        base = _LOCAL_BASE
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return base


_LOCAL_BASE: str | None = None


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{kind}-{uuid.uuid4().hex[:12]}"
