"""Problem 7: the schools that claims about persons mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.linkage import matches
from loomtable.sources.tables import table


def _master(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "schools_v2").select(
        "id",
        F.col("name_ja").alias("name"),
        F.col("name_kana").alias("kana"),
        F.col("location_city").alias("town"),
        F.col("location_pref").alias("prefecture"),
        F.col("establishment_year").alias("year"),
        F.col("school_corporation").alias("operator"),
        F.col("gender_type").alias("pupils"),
    )


def p7_matches(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, school_id, confidence) of every claim that is matched, also of those with a given id."""
    claims = table(spark, folder, "team_c1_gf")
    found = matches(claims, "record_id", "matched_school_name", "evidence_text", _master(spark, folder))
    return found.withColumnRenamed("key", "record_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    open_ = table(spark, folder, "team_c1_gf").filter("matched_school_id IS NULL").select("record_id")
    return p7_matches(spark, folder).join(open_, "record_id", "left_semi").select("record_id", "school_id")


QUERIES = {"p7_found": p7_found, "p7_matches": p7_matches}
SQL: dict[str, str] = {}
