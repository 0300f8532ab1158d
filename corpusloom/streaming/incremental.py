"""Restartable batches: new files only, through the same functions as a full run.

The operators are batch operators; a stream here is a way to skip what is done. Nothing is windowed or kept in state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_new(spark: SparkSession, source: str, schema: str, work: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, fmt: str = "json") -> None:
    """Apply ``work`` to files of ``source`` that no earlier run has seen and append the result to ``target`` as Parquet.

    A batch that is run again after a failure replaces what it had written, so each file counts once.
    """

    def batch(rows: DataFrame, number: int) -> None:
        work(rows).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(fmt).load(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
