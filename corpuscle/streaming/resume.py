"""Append-only runs that can be stopped and resumed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``todo`` whose key isn't in ``done`` yet; null keys are never done."""
    return todo.join(done.select(key).where(f"{key} is not null").distinct(), key, "left_anti")


def run_batches(source: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies ``work`` to every arriving row whose key isn't in ``out`` yet, and appends the result there.

    ``source`` is a stream (readStream). A batch that is run again after a failure leaves out what it had written before it failed, so the
    output has each key once. Repeated keys of one batch are worked on once.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark: SparkSession = batch.sparkSession
        rows = batch.dropDuplicates([key])
        fs = spark._jvm.org.apache.hadoop.fs.Path(out).getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(out + "/_SUCCESS")):
            rows = pending(rows, spark.read.parquet(out), key)
        work(rows).write.mode("append").parquet(out)

    return source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
