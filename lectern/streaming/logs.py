"""Resumable logs as streams: new requests are those whose key no log has, and each batch appends its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lectern.operators import dedupe


def stream_requests(spark: SparkSession, path: str, schema: str, files_per_batch: int = 10) -> DataFrame:
    """Requests as they arrive as JSON lines; files_per_batch paces the work."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def resume(requests: DataFrame, key: str, answer: Callable[[DataFrame], DataFrame], log: str, checkpoint: str) -> StreamingQuery:
    """Answer each new request once and append to the log: the checkpoint knows which files were read, an anti-join with the log
    which keys are answered, so a batch that is run again after a failure adds nothing twice."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        todo = df.dropDuplicates([key])
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(log)
        if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
            todo = dedupe.not_done(todo, spark.read.schema(f"{key} string").json(log), key)
        answer(todo).write.mode("append").json(log)

    return requests.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(updates: DataFrame, key: str) -> DataFrame:
    """The first answer of each key, over a stream."""
    return updates.dropDuplicates([key])
