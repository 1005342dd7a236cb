"""Session helpers: a tuned local session for tests/bench and shared paths.

Nothing here is needed on a managed cluster: every operator takes the
``SparkSession`` it is given.  The only session setting the library reads is
``spark.checkpoint.dir`` (shared storage for lineage cuts, stream checkpoints
and versioned tables); without it operators raise on a cluster.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recspark") -> SparkSession:
    """Local session with AQE on; for tests and bench only."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RECSPARK_DRIVER_MEMORY", "12g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(executors: int, cores_per_executor: int,
                 input_bytes: float | None = None) -> dict[str, str]:
    """Settings this library is designed around on a large cluster.

    AQE re-plans every shuffle at run time: it coalesces small partitions,
    splits skewed join partitions and turns joins with a small side into
    broadcasts from measured sizes.  The initial shuffle width is set high
    (about 3 tasks per core, more for very large inputs at ~256 MB per task)
    and AQE shrinks it; scans split files at 256 MB.
    """
    cores = executors * cores_per_executor
    width = 3 * cores
    if input_bytes:
        width = max(width, int(input_bytes // (256 << 20)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the session's ``spark.checkpoint.dir`` (or the context's checkpoint
    folder).  Where neither is set, a session on one machine (``local[...]``)
    uses a folder of its own; on a cluster this raises, because executors would
    write to their own disks.  Neither the session's settings nor the context's
    checkpoint folder are changed.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        one_machine = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        if not one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"/tmp/recspark-{sc.applicationId}"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/recspark/{name}-{uuid.uuid4().hex[:12]}"


def shared_folder(spark: SparkSession, path: str) -> str | None:
    """``path`` as workers can open and map it: that of a file system on the machine (or
    mounted on all of them), None for any other."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(conf)
    if found.getUri().getScheme() != "file":
        return None
    return found.makeQualified(there).toUri().getPath()


def tidied(df: DataFrame) -> DataFrame:
    """``df`` in a session with the same settings, in which a query's shuffle files go as
    soon as it has ended; else they stay until the driver collects its garbage."""
    spark = df.sparkSession
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    rows = spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(
        session._jsparkSession, df._jdf.logicalPlan())
    return DataFrame(rows, session)


def write_tidied(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a new table and read back; its shuffle files are gone then."""
    tidied(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a fresh table in the shared folder and read back: the plan
    behind it is one scan, whose files outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
