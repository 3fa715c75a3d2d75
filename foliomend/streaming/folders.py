"""A folder of page records as a stream: each run takes what is new, and what was done isn't done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_new(spark: SparkSession, folder: str, output: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], glob: str = "*.md", per_batch: int = 1000) -> StreamingQuery:
    """Run work on the texts (path, md) of files that no earlier run has seen; append its rows to output as Parquet.

    The file source's log under checkpoint knows the files that were taken, so a folder can be run over
    again and again. A batch that fails is taken again and overwrites its own part of the output.
    """
    schema = "value string"
    source = spark.readStream.schema(schema).option("wholetext", "true").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_batch).text(folder)
    texts = source.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return texts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
