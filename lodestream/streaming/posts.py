"""Streaming forms: lines to posts, first copies within a watermark, tags, and a checkpoint sink.

First copies are the first to arrive here, not the first by number, as a stream has no end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.operators import clean, ingest, tags


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """(dump, line_no, raw_line, arrived) of text files as they are written to a folder."""
    df = spark.readStream.format("text").load(folder)
    return df.where(F.trim("value") != "").select(F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1).alias("dump"), F.lit(0).cast("bigint").alias("line_no"), F.trim("value").alias("raw_line"), F.current_timestamp().alias("arrived"))


def posts(stream: DataFrame, vocabulary, late: str = "10 minutes") -> DataFrame:
    """Kept, cleaned, tagged posts, each id once within the watermark."""
    kept = ingest.kept(ingest.flagged(stream.drop("arrived"), vocabulary))
    unique = clean.normalize(kept).withColumn("arrived", F.current_timestamp()).withWatermark("arrived", late).dropDuplicatesWithinWatermark(["dump", "post_id"])
    return tags.tagged(unique.where("clean_text != ''"), F.col("clean_text"))


def windowed_counts(events: DataFrame, ts: str, by: str, width: str, late: str) -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), by).agg(F.count("*").alias("n"))


def to_log(stream: DataFrame, path: str, checkpoint: str):
    """Append to a folder of JSON lines, resumable by its checkpoint folder."""
    return stream.writeStream.format("json").option("checkpointLocation", checkpoint).outputMode("append").start(path)
