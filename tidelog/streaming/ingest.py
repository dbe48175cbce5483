"""Captures that grow, as streams: lines into tables batch by batch, and figures by event time with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.sources import logs
from tidelog.sources.store import Table


def stream_lines(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Each new file's physical lines, as :func:`tidelog.sources.logs.lines` gives them."""
    df = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", glob).text(folder)
    return df.select(F.col("_metadata.file_path").alias("url"), F.col("_metadata.file_block_start").alias("block"), F.regexp_replace("value", r"\r\z", "").alias("raw"))


def ingest(spark: SparkSession, folder: str, table: Table, checkpoint: str, glob: str = "*", zone: str | None = None) -> StreamingQuery:
    """New files into ``table``, insert-only: a batch that is run again after a failure writes nothing twice. Entries don't reach across files."""

    def land(batch: DataFrame, _: int) -> None:
        rows = logs.parsed(batch.withColumn("pos", F.monotonically_increasing_id()), zone)
        table.insert_new(rows, order=["runix"])

    stream = stream_lines(spark, folder, glob)
    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, at: str, by: list[str], width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Counts per window of event time, updated by late rows until the watermark has passed."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, width).alias("window"), *by).agg(F.count("*").alias("n"))


def once(stream: DataFrame, at: str, keys: list[str], lateness: str = "2 hours") -> DataFrame:
    """Rows without those whose keys have come before within the watermark."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)
