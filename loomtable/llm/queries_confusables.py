"""Problem 6: one consistent form of school names and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.confusables import alike_classes, alike_pairs, with_forms
from loomtable.sources.tables import table

_TEXTS = {"schools_v2": ("row_id", "name_ja"), "team_c_llm_principal_round4": ("record_id", "quote_text")}


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (table(spark, folder, t).select(F.lit(t).alias("table_name"), F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")) for t, (key, text) in _TEXTS.items())
    return a.unionByName(b)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return alike_pairs(_rows(spark, folder))


def p6_classes(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, row_key, class_key, n_links) of every row that has a text."""
    return alike_classes(_rows(spark, folder)).withColumnRenamed("key", "row_key")


def p6_forms(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, row_key, consistent_form) of every row."""
    return with_forms(_rows(spark, folder), "text").select("table_name", F.col("key").alias("row_key"), "consistent_form")


QUERIES = {"p6_found": p6_found, "p6_classes": p6_classes, "p6_forms": p6_forms}
SQL: dict[str, str] = {}
