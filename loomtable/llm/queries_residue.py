"""Problem 2: template residue in testimonials and philosophy texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.residue import find_residue, without_residue
from loomtable.sources.tables import table

_TEXTS = {"team_b2_students": ("record_id", "quote_text"), "school_philosophy_v2": ("id", "text_full")}


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    a, b = (
        table(spark, folder, t).select(F.lit(t).alias("table_name"), F.col(key).cast("bigint").alias("record_id"), F.col(text).alias("text"))
        for t, (key, text) in _TEXTS.items()
    )
    return a.unionByName(b)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_residue(_texts(spark, folder), "text").filter(F.size("residue_kinds") > 0).select("table_name", "record_id")


def p2_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Records by table and kind of residue."""
    found = find_residue(_texts(spark, folder), "text")
    return found.select("table_name", F.explode("residue_kinds").alias("kind")).groupBy("table_name", "kind").agg(F.count("*").alias("n_records"))


def p2_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The records that are left once residue is out."""
    return without_residue(_texts(spark, folder), "text")


QUERIES = {"p2_found": p2_found, "p2_kinds": p2_kinds, "p2_clean": p2_clean}
SQL: dict[str, str] = {}
