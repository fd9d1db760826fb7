"""Sessions, checkpoint folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regolith")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder in ``spark.checkpoint.dir``; a temporary one of our own only where it is unset and all runs in one process.

    Raises on a cluster without that setting: executors there share no local folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="regolith-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint, so that the lineage of an iterative job stays short and lost executors cost no rework."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def delete_on_exit(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder in the shared one; Spark removes it when the application ends."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table that several later steps read to the shared folder; Spark removes it when the application ends."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame, rows: int = 250_000) -> int:
    """Into how many tasks to deal a table whose count is at hand, as of a file or a staged one: at most about ``rows`` to each, so that
    what a task holds doesn't grow with the table, and no fewer than run at once."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def some(df: DataFrame, n: int, *key: str) -> DataFrame:
    """At most ``n`` rows, spread over the whole table by a hash of the key; about 2 n rows are looked at after one count.

    For bounded samples: what reaches the driver doesn't grow with the table or its partitions.
    """
    total = df.count()
    if total > 2 * n:
        share = 1 << 30
        df = df.filter(F.pmod(F.xxhash64(*key), F.lit(share)) < int(share * 2 * n / total))
    return df.limit(n)
