"""Problem 8: the corpus as ids of a public tokenizer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm.tokens import decoded, encoded
from loomtable.sources.tables import table


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: documents, tokens, characters, and documents whose ids decode to their text."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    ids = p8_ids(spark, folder)
    back = decoded(ids, "doc_id", "ids").withColumnRenamed("text", "back")
    joined = docs.join(back, "doc_id").join(ids.select("doc_id", F.size("ids").alias("n")), "doc_id")
    return joined.groupBy("source").agg(
        F.count("*").alias("n_docs"),
        F.sum("n").alias("n_tokens"),
        F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"),
        F.count_if(F.coalesce("text", F.lit("")) == F.col("back")).alias("n_exact"),
    )


QUERIES = {"p8_ids": p8_ids, "p8_round_trip": p8_round_trip}
SQL: dict[str, str] = {}
