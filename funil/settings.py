"""Session settings, and the shared folder used for checkpoints and staged files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for.  Joins carry no hint unless a side is
# bounded by construction: Spark checks sizes against the broadcast threshold,
# and beyond it the sort-merge join splits skewed partitions at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(name: str, cpus: str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session may run without it: it then gets a fresh folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="funil-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own under the shared folder."""
    return f"{shared_folder(spark)}/funil/{purpose}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result that several plans read to the shared folder, and read it from there.

    Later stages then neither compute it again nor depend on executors that held it.
    """
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._written_to = folder
    return out


def discard(*written: DataFrame) -> None:
    """Remove what ``write_once`` wrote, once all results that read it are written themselves."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
