"""Session construction and small planning helpers shared by every operator."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side we will ever hint as a broadcast.  Sides above this go through
# a shuffle join (and AQE may still convert them at runtime when the actual
# shuffle output turns out small).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "semrec") -> SparkSession:
    """Build (or reuse) a session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("SEMREC_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a ``local[...]`` session without one (unit tests, a laptop) gets a
    temporary folder; on a cluster a machine-local folder would not survive
    the loss of that machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        configured = tempfile.mkdtemp(prefix="semrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a table that only this application reads, in a folder of its own under
    :func:`checkpoint_dir`; the file system deletes that folder when the application ends."""
    sc = spark.sparkContext
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{sc.applicationId}"
    if folder not in _SCRATCH:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate for ``df`` (what Catalyst uses for its own
    broadcast decision)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def input_size(df: DataFrame) -> int:
    """Bytes of the tables under ``df``'s plan (the estimate of a whole plan multiplies its joins)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


_SHARED: dict[str, list[DataFrame]] = {}
#: Plan nodes that make a frame worth keeping; anything else is read again as cheaply.
_WORK = re.compile(r"^[\s:+-]*'?(Join|Aggregate|Window|Sort|Repartition|Distinct|Deduplicate|MapIn|FlatMap)", re.M)


def shared(df: DataFrame, always: bool = False) -> DataFrame:
    """``df``, computed once for all its readers in the job.

    Nothing runs now: the first reader stores the partitions on the executors (memory, then their
    disks), later ones read them there, and a partition lost with its executor is computed again
    from its lineage.  Results never depend on it.  A frame without joins, aggregations or
    shuffles is returned as it is (unless ``always``), since reading its files again prunes columns.
    :func:`release` drops what a job has shared.
    """
    if df.is_cached or not always and not _WORK.search(df._jdf.queryExecution().analyzed().toString()):
        return df
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _SHARED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(kept)
    return kept


def release(spark: SparkSession) -> None:
    """Drop all that :func:`shared` has kept in this application; frames built on it stay usable."""
    for df in _SHARED.pop(spark.sparkContext.applicationId, []):
        df.unpersist()


#: Bytes that rows of a columnar file take in a join for each byte of the file (dictionaries, compression).
DECODED = 32


def _reads_columnar(df: DataFrame) -> bool:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return any(re.search(r" (parquet|orc)$", leaves.apply(i).toString()) for i in range(leaves.size()))


def sized_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is under ``max_bytes``.

    The optimizer's estimate is the size of the files; the driver holds their rows, so what is read from
    columnar files counts ``DECODED`` times.  Beyond the bound the join planner picks a shuffle
    (sort-merge) join and AQE decides again at runtime; a frame so small in its files that Spark might
    broadcast some of its columns by that estimate is merged in any case.
    """
    try:
        size = estimated_bytes(df)
        held = size * DECODED if _reads_columnar(df) else size
        own = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except Exception:  # pragma: no cover - plan stats unavailable
        return df
    if 0 <= held <= max_bytes:
        return F.broadcast(df)
    return df.hint("merge") if size < held and size <= own * DECODED else df


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan arrives in
    fewer partitions (e.g. one small file with a single row group).

    On real inputs a scan already spans many splits and this is a no-op; it
    only stops a small table from running row-heavy text work in one task.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - no RDD API (e.g. Spark Connect)
        return df
    return df.repartition(want) if have < want else df


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop file system API)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += int(path.getFileSystem(conf).getContentSummary(path).getLength())
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = 200 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` to about input bytes / ``target_bytes``
    (at least two per core) so shuffle partitions fit executor memory at any
    scale; AQE coalesces the ones that turn out small."""
    cores = spark.sparkContext.defaultParallelism
    n = max(2 * cores, -(-input_bytes(spark, paths) // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile`` of a zip).

    Needed by the only Python stage (the ``mapInPandas`` model hook) when the
    package is not installed on the executors; Spark copies the zip to every
    executor.  Done once per SparkContext.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="semrec-pyfiles-"), "semrec.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``.

    One DataFrame per application and path: a job reads the same table in
    several branches, and each fresh ``read.parquet`` lists files and reads
    footers on the driver again.  (Plans are unaffected; the input tables
    are read-only.)
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df
