"""Problem 3: messages of school heads that were cut off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.truncation import find_cut
from loomtable.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    cut = find_cut(table(spark, folder, "team_c_llm_principal_round4"), "record_id", "quote_text")
    return cut.filter("is_cut").select(F.col("key").alias("record_id"))


def p3_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Per source_id (null is one of them): quotes, cut quotes and their share."""
    quotes = table(spark, folder, "team_c_llm_principal_round4")
    cut = find_cut(quotes, "record_id", "quote_text")
    joined = quotes.select("record_id", "source_id").join(cut, F.col("record_id") == F.col("key"))
    return (
        joined.groupBy("source_id")
        .agg(F.count("*").alias("n_quotes"), F.count_if("is_cut").alias("n_cut"))
        .withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_quotes"), 6))
    )


QUERIES = {"p3_found": p3_found, "p3_sources": p3_sources}
SQL: dict[str, str] = {}
