"""The positive-behaviour projection as a Structured Streaming job.

The same Column code as the batch path (B1-B4, H9) runs on a file stream of
raw behaviour-log partitions; ``availableNow`` processes every file present
and stops, so a daily partition pull becomes an incremental, checkpointed
job that survives restarts (the checkpoint records which files are done).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.behaviors import positive_log


def stream_positive_behaviors(spark: SparkSession, path: str, schema: StructType | str,
                              out: str, checkpoint: str, min_web_seconds: float = 5.0,
                              max_files_per_trigger: int | None = None,
                              rows: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run the stream to completion and return the written result.  ``rows`` makes raw log rows of what the
    files hold (looks up texts that are kept beside them); the result is written with zstd, since texts repeat."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(path)
    if rows is not None:
        raw = rows(raw)
    query = (positive_log(raw, min_web_seconds).writeStream
             .format("parquet")
             .option("checkpointLocation", checkpoint)
             .option("path", out)
             .option("compression", "zstd")
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"stream failed: {exc}")
    return spark.read.parquet(out)
