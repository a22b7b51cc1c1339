"""Structured Streaming forms of resumable processing, meters, chunk lookup and rig grouping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that's there and stop; a rerun with the same checkpoint takes up where it ended."""
    q = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def idempotent_parquet(path: str, done: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch once: its folder is its number, so a replay overwrites itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn(done, F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch-{number}")

    return write


def skip_existing(batch: DataFrame, sink: DataFrame, key: list[str]) -> DataFrame:
    return batch.join(sink.select(*key), key, "left_anti")


def windowed_meter(events: DataFrame, by: list[str], length: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Count, sum and maximum of value by event-time window; rows later than the watermark are left out."""
    at = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(at.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("top")).select(F.col("w.start").alias("start"), *by, "n", "total", "top")


def in_chunk(events: DataFrame, chunks: DataFrame, cell: float) -> DataFrame:
    """Stream-static interval join on cells of the chunks' length."""
    cells = chunks.withColumn("_c", F.explode(F.sequence(F.floor(F.col("s") / cell), F.floor(F.col("e") / cell))))
    return events.withColumn("_c", F.floor(F.col("t") / cell)).join(cells, ["user_id", "_c"]).filter("t BETWEEN s AND e").drop("_c")


def first_of_rig(events: DataFrame, key: list[str], late: str = "1 day") -> DataFrame:
    """One row a key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)
