"""Session construction and the shared scratch area.

Everything that must outlive a task (CSV landing files, layer tables,
streaming checkpoints, lineage cuts) goes under the folder the cluster
names in ``spark.checkpoint.dir``. On a cluster that folder is shared
storage; only when it is unset (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# SQL defaults, applied only to keys the launcher did not set.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Whole-stage methods over 8000 bytecode bytes are never JIT-compiled by
    # HotSpot; above this limit Spark splits the stage instead (measured 3x
    # faster on the wide cleaning projections).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Only for a local session this module starts itself.
_LOCAL_ONLY = {
    "spark.ui.enabled": "false",
    # concurrent ingest / layer jobs from driver threads share the cores fairly
    "spark.scheduler.mode": "FAIR",
    # remove reliable-checkpoint files once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "paddock") -> SparkSession:
    """Return the active session or build one, then fill in the engine's
    SQL defaults for keys the launcher left unset. The shuffle width is the
    launcher's (AQE coalesces from there); a local session of its own starts
    with two partitions a core."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app)
        launched = bool(os.environ.get("SPARK_MASTER")) or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
        if master or not launched:
            builder = builder.master(master or f"local[{os.environ.get('BENCH_CPUS', '8')}]")
            for k, v in _LOCAL_ONLY.items():
                builder = builder.config(k, v)
            builder = builder.config("spark.sql.shuffle.partitions", str(2 * int(os.environ.get("BENCH_CPUS", "8"))))
            builder = builder.config("spark.driver.memory", os.environ.get("PADDOCK_DRIVER_MEMORY", "16g"))
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    conf = spark.sparkContext.getConf()
    for k, v in _DEFAULTS.items():
        if not conf.contains(k):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``; a local session may leave it unset
    and gets a folder of its own, any other must name a shared one.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
        if root:
            # getCheckpointDir returns a per-application sub folder
            root = root.rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="paddock-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/paddock/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint),
    so a lost executor does not force recomputing the whole lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def tune_joins(spark: SparkSession) -> None:
    """What the wide joins need of the session, where its launcher left it at
    Spark's default: rows that are spread by one of a join's keys count as
    placed, and generated methods stay short enough for HotSpot."""
    for key, default, value in (
        ("spark.sql.requireAllClusterKeysForCoPartition", "true", "false"),
        ("spark.sql.codegen.hugeMethodLimit", "65535", _DEFAULTS["spark.sql.codegen.hugeMethodLimit"]),
    ):
        if spark.conf.get(key) == default and not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)


#: bytes of its input files that a task of a wide join gets
TASK_BYTES = 4 << 20


def file_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, from the file system's listing; 0 for rows without files."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def join_width(df: DataFrame) -> int:
    """Tasks for joins of ``df`` whose number follows its input, so that a task's
    rows don't; 0 where the launcher's shuffle width is enough. AQE puts the
    tasks of a wider shuffle together to about one a core, whatever their rows."""
    spark = df.sparkSession
    n = -(-file_bytes(df) // TASK_BYTES)
    return n if n > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism) else 0


def spread(df: DataFrame, width: int, *keys: str) -> DataFrame:
    """``df`` by its keys in ``width`` tasks (0: the launcher's width, put
    together by AQE). Frames of one width that are spread by the same key meet
    on it, and on it and further keys, without another shuffle (``tune_joins``)."""
    tune_joins(df.sparkSession)
    return df.repartition(width, *keys) if width else df.repartition(*keys)


#: rows of a dimension that each executor can hold besides its tasks
BROADCAST_ROWS = 400_000
#: bytes of files above which the rows of a dimension aren't counted
COUNTED_BYTES = 64 << 20


def broadcasts(dim: DataFrame) -> bool:
    """Whether a fact that has a width takes this dimension by broadcast: its
    files are within ``autoBroadcastJoinThreshold`` or, unless that is turned off,
    its rows few; to shuffle such a fact for it costs far more."""
    spark = dim.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = 0 if limit.startswith("-") else spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    size = file_bytes(dim) if limit else 0
    return 0 < size <= limit or (0 < size <= COUNTED_BYTES and dim.count() <= BROADCAST_ROWS)


def join_dimension(df: DataFrame, dim: DataFrame, left: str, right: str, width: int, placed: bool = False) -> DataFrame:
    """Inner join of a fact with a dimension. Where the fact has a width, the
    dimension is broadcast (``broadcasts``) or both meet spread in that width
    (``placed``: the fact already is); else the planner decides."""
    on = F.col(left) == F.col(right)
    if not width:
        return df.join(dim, on)
    if broadcasts(dim):
        return df.join(F.broadcast(dim), on)
    return (df if placed else spread(df, width, left)).join(spread(dim, width, right).hint("merge"), on)


#: removes a command's or a collect's shuffle files when it ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, no shuffle outlives the write or collect that made it. Otherwise
    shuffles stay on disk until the driver happens to collect its garbage, so
    those of all steps add up. For frames that are computed once."""
    was = spark.conf.get(CLEANUP, None)  # None: not set
    if spark.sparkContext.getConf().contains(CLEANUP):
        yield  # the launcher's choice
        return
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)
