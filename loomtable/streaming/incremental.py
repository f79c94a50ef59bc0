"""Incremental runs as streams: new rows are merged into a table batch by batch, windows are kept with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomtable.operators.dedup import new_rows


def append_new(stream: DataFrame, target: str, key: list[str], order: list[str], checkpoint: str) -> StreamingQuery:
    """Rows whose key is new go to a Parquet table.

    Each batch has a folder of its own that is overwritten if the batch runs again, and is
    compared with the folders of the batches before it, so a restart neither loses nor
    repeats a row.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files = spark._jvm.org.apache.hadoop.fs.Path(target)
        known = batch.limit(0).select(*key)
        if files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files):
            known = spark.read.option("basePath", target).schema(batch.schema).parquet(target)
            known = known.filter(F.regexp_extract(F.input_file_name(), r"batch=(\d+)", 1).cast("bigint") < number).select(*key)
        new_rows(batch, known, key, order).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, group: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per time window and group; rows later than the watermark are left out."""
    return (
        stream.withWatermark(at, late)
        .groupBy(F.window(at, width).alias("w"), group)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), group, "n")
    )


def session_counts(stream: DataFrame, at: str, group: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Counts per session of a group: rows no further apart than the gap."""
    return (
        stream.withWatermark(at, late)
        .groupBy(F.session_window(at, gap).alias("w"), group)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), group, "n")
    )


def first_seen(stream: DataFrame, at: str, key: list[str], late: str = "2 hours") -> DataFrame:
    """Each key once; its state is dropped when the watermark has passed."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(key)
