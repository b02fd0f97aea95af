"""Streams: the batch functions on readStream, and windowed KPIs with a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import scratch_path


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet path as a stream of its files, with the schema the files declare now.

    The file source wants a folder or a pattern; the pattern here matches the path alone,
    be it one file or a folder of files.
    """
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)


def start(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", **trigger):
    """Exactly-once parquet sink; the checkpoint lets a restarted query go on where it was."""
    return (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_available(stream: DataFrame) -> DataFrame:
    """Process what has arrived so far and return the sink's rows."""
    spark = stream.sparkSession
    out = scratch_path(spark, "stream-out")
    start(stream, out, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Score and decide each arriving record with the same function the batch uses."""
    return score(stream)


def windowed_kpi(
    stream: DataFrame, time: str, width: str, delay: str, groups: list[str], aggregates: dict
) -> DataFrame:
    """Tumbling-window aggregates; a window is emitted once the watermark has passed its end."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, width), *groups)
        .agg(*[expr.alias(name) for name, expr in aggregates.items()])
        .select(F.col("window.start").alias("window_start"), *groups, *aggregates)
    )
