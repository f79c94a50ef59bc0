"""Problem 4: garbled student quotes and philosophy texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.mojibake import garbled_report, with_restored
from loomtable.sources.tables import table

_TEXTS = {"team_c_llm_students": ("record_id", "quote_text"), "school_philosophy_v2": ("id", "text_full")}


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (
        table(spark, folder, t).select(F.lit(t).alias("table_name"), F.col(key).cast("bigint").alias("record_id"), F.col(text).alias("text"))
        for t, (key, text) in _TEXTS.items()
    )
    return a.unionByName(b)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return with_restored(_texts(spark, folder), "text").filter("is_garbled").select("table_name", "record_id")


def p4_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Every garbled record with its original text, null where bytes are lost, and the way there."""
    found = with_restored(_texts(spark, folder), "text").filter("is_garbled")
    return found.select("table_name", "record_id", "restored", F.array_join("steps", ", ").alias("steps"))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_report(_texts(spark, folder), "table_name", "text")


QUERIES = {"p4_found": p4_found, "p4_restored": p4_restored, "p4_report": p4_report}
SQL: dict[str, str] = {}
