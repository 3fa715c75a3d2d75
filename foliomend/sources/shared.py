"""Tables cut from their lineage, in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's part of the folder in spark.checkpoint.dir; it goes when the driver's JVM ends.

    Where the session names no folder, a local one serves if the driver and its tasks are one machine;
    on a cluster that is an error.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = tempfile.mkdtemp(prefix="spark-foliomend-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found.rstrip('/')}/foliomend/{sc.applicationId}"
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends there,
    and a lost executor costs no more than the tasks it ran."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._written = path
    return found


#: With this set, what a query shuffled is removed when the query ends, and not at some later collection of the driver's objects.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written_and_cleaned(df: DataFrame, name: str) -> DataFrame:
    """`written`, where what was shuffled on the way is to leave the disk at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANED, None)
    conf.set(CLEANED, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(CLEANED) if before is None else conf.set(CLEANED, before)


def discard(table: DataFrame) -> None:
    """Remove a table that `written` gave and nothing reads any more, before the driver ends."""
    discard_folder(table.sparkSession, table._written)


def discard_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder in this application's part of the shared folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(spark: SparkSession) -> int:
    """Tasks for rows that are few or small but take long: as many as a shuffle has, which adaptive execution
    would join again by their bytes if the number were left to it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
