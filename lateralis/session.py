"""Session helpers: reliable checkpoints and the settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000

CACHED_ROWS = 1_000
_CACHED_ROWS = "spark.sql.inMemoryColumnarStorage.batchSize"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lateralis") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lateralis-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    Meant for the small tables an iterative job carries from round to round: a lost executor then
    re-reads a file instead of replaying every earlier round.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def persisted(df: DataFrame, storage: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER) -> DataFrame:
    """``df.persist(storage)`` in batches of at most ``CACHED_ROWS`` rows.

    A stream of persisted batches to or from disk keeps up to a hundred of them on the heap, beside the memory that Spark
    accounts for: of the usual 10 000 rows each that is a whole partition a task. Kept as objects, they are
    not copied into chunks of 1 MB either, which take two regions of a small heap each. Spark reads the setting when
    it registers the frame, so the session has its own again afterwards.
    """
    settings = df.sparkSession.conf
    rows = settings.get(_CACHED_ROWS)
    settings.set(_CACHED_ROWS, str(min(int(rows), CACHED_ROWS)))
    try:
        return df.persist(storage)
    finally:
        settings.set(_CACHED_ROWS, rows)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a broadcast table of known size, or unhinted when it has more than ``limit`` rows.

    At most ``limit + 1`` rows reach the driver. A larger table is joined by whatever strategy
    Spark picks from its real size, with the skew handling of adaptive execution.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, for tables handed from job to job."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """A plain file scan with at least as many partitions as the session has cores.

    A single small file is one task however many cores there are; its rows are dealt out once, after
    column pruning and pushed filters. A scan that already fills the cores is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
