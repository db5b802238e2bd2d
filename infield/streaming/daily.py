"""Incremental bronze to silver with Structured Streaming: an extension, the batch operators being the reference's own."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, path: str, schema: T.StructType, most_files: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def first_of_key(stream: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """The first row of each key; keys are forgotten ``late`` after their time, so the state stays bounded."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_totals(stream: DataFrame, time: str, width: str, late: str, keys: Sequence[str], value: str) -> DataFrame:
    """Sum and count of each key and window, final once the watermark has passed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.sum(value).alias("total"), F.count("*").alias("rows")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "total", "rows")


def run_once(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Works off all that has arrived, a batch at a time, and ends; the checkpoint remembers how far it came."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
