"""Incremental arrival of yearly detections: an extension, the batch path has no stream.

Files land in folders named year=YYYY. Each micro-batch is merged and appended to its years' folders;
a checkpoint in the shared folder makes a restart continue where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tesserae.storage import scratch


def compile_years(spark: SparkSession, source: str, schema: StructType, sink: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, checkpoint: str | None = None) -> StreamingQuery:
    """Starts the stream over everything that has arrived and stops when it is caught up. A batch that is
    repeated after a failure overwrites its own folder, so rows appear once."""

    def write(batch: DataFrame, epoch: int) -> None:
        transform(batch).write.mode("overwrite").partitionBy("year").parquet(f"{sink}/batch={epoch}")

    stream = spark.readStream.schema(schema).option("basePath", source).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or scratch(spark, "years")).trigger(availableNow=True).start()
