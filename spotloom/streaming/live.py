"""Live acquisition: files that arrive are processed once each; a checkpoint keeps what was done across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, folder: str, schema: str, glob: str = "*.parquet", per_trigger: int = 64) -> DataFrame:
    """A stream of the parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def process_available(stream: DataFrame, out: str, checkpoint: str, each: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append each(batch) of all files that are there to a table and stop. Files already in the checkpoint are not read again.

    A batch writes into a folder of its own number, overwriting it, so a batch that is repeated after a failure leaves
    no second copy.
    """

    def write(batch: DataFrame, number: int) -> None:
        (each(batch) if each else batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def once_by_key(stream: DataFrame, time: str, key: str, late: str = "10 minutes") -> DataFrame:
    """Drops redelivered keys; the state only spans the allowed lateness."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, width: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Counts per window of event time and keys; late rows within the watermark are counted."""
    w = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("start"), *keys, "n")


def missing_positions(expected: DataFrame, arrived: DataFrame, keys: list[str]) -> DataFrame:
    """Positions that have not arrived yet: the end of an acquisition is when there are none."""
    return expected.join(arrived.select(*keys).distinct(), keys, "left_anti")
