"""Problem 5: personal data in student quotes and speaker descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.pii import THRESHOLD_BITS, fields_of, find_personal_data, redacted
from loomtable.sources.tables import table


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return fields_of(table(spark, folder, "team_c_llm_students"), "record_id", ["quote_text", "speaker_attribute"], "school_id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(_rows(spark, folder)).select(F.col("key").alias("record_id"), "field_name", "pii_type").distinct()


def p5_redacted(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, field_name, redacted_text) of every field that is not null."""
    return redacted(_rows(spark, folder)).select(F.col("key").alias("record_id"), "field_name", "redacted_text")


def p5_generalised(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, field_name, generalised_text): as p5_redacted, but of an address the part that tells little stays."""
    return redacted(_rows(spark, folder), generalise=True).select(F.col("key").alias("record_id"), "field_name", F.col("redacted_text").alias("generalised_text"))


def p5_terms(spark: SparkSession, folder: str) -> DataFrame:
    """(pii_type, n_spans, least_bits, most_bits, n_by_concentration) of what is found."""
    found = find_personal_data(_rows(spark, folder))
    return found.groupBy("pii_type").agg(F.count("*").alias("n_spans"), F.round(F.min("bits"), 4).alias("least_bits"), F.round(F.max("bits"), 4).alias("most_bits"), F.count_if((F.col("pii_type") == "name") & (F.col("bits") < THRESHOLD_BITS["name"])).alias("n_by_concentration"))


QUERIES = {"p5_found": p5_found, "p5_redacted": p5_redacted, "p5_generalised": p5_generalised, "p5_terms": p5_terms}
SQL: dict[str, str] = {}
