"""Session settings and the shared folder for checkpoints and stage tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}

TASK_BYTES = 16 * 1024 * 1024  # what a task reads of a shuffle, compressed, when partitions are merged
GUESSED_BYTES = 64 * 1024  # a table is broadcast up to this size as estimated from its files
KNOWN_BYTES = 2 * 1024 * 1024  # or up to this size of its rows, once they are counted


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results or protect against skew."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # the JVM never compiles a method above 8,000 bytes of bytecode; the pieces that a stage falls apart
    # into without whole-stage code are below that
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # chained sorts of a timeline keep a task's decoded rows in memory: small tasks need not spill
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    # stage tables are written small; that a file is smaller must not turn a join into a broadcast
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "2.0")
    # an estimate takes a column's share of a file by its type's width: for the key column of a wide table it
    # was some fifty times smaller than what the driver then hashes, so little is broadcast on estimates
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(GUESSED_BYTES))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(KNOWN_BYTES))
    # windows and seen ids live on disk, not on the executors' heap
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


PARTITION_BYTES = 32 * 1024 * 1024
GROWTH = 6  # decoded rows and expiry events against compressed input


def size_shuffles(spark: SparkSession, path: str) -> int:
    """Raise the number of shuffle partitions with the size of the input; never lower it.

    Adaptive execution merges partitions that turn out small, but it cannot split a shuffle that
    was planned too coarse.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = files.getContentSummary(target).getLength()
    wanted = min(200_000, -(-size * GROWTH // PARTITION_BYTES))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def shared_folder(spark: SparkSession) -> str:
    """Where stage tables live: the folder the cluster names, never a machine-local one.

    Only a local master without that setting (a test) falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="ledgerlens-")
    return _LOCAL_FALLBACK[app]


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/ledgerlens/{label}-{uuid.uuid4().hex}"
