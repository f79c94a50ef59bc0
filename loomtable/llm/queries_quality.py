"""Problem 10: statistics of the documents' texts, and those that are no prose."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.llm import quality
from loomtable.llm.quality import common_word_lists, scored, text_statistics
from loomtable.sources.tables import table


def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, junk_probability) of every document whose text is not blank."""
    return scored(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "common_words")).withColumnRenamed("key", "doc_id")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_scores(spark, folder).filter(F.col("junk_probability") > 0.5).select("doc_id")


def p10_stats(spark: SparkSession, folder: str) -> DataFrame:
    english, japanese = common_word_lists(table(spark, folder, "common_words"))
    return text_statistics(table(spark, folder, "documents"), "doc_id", "text", english, japanese)


QUERIES = {"p10_found": p10_found, "p10_scores": p10_scores, "p10_stats": p10_stats}


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(({part}) / ({whole}), 6) ELSE 0.0 END"


def _count(pattern: str) -> str:
    return f"len(regexp_extract_all(t, '{pattern.replace(chr(39), chr(39) * 2)}'))"


def _without(pattern: str) -> str:
    return f"length(regexp_replace(t, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g'))"


SQL = {
    "p10_stats": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
ja AS (SELECT coalesce(string_agg(word, '|' ORDER BY length(word) DESC, word), '(?:)') AS p FROM (SELECT DISTINCT word FROM common_words WHERE lang = 'ja')),
en AS (SELECT list(DISTINCT lower(word)) AS w FROM common_words WHERE lang = 'en'),
c AS (
  SELECT doc_id, t, {_count(quality.WORD)} AS w, length(t) - {_without(quality.WORD_CHARS)} AS letters, {_without(quality.BLANK)} AS solid,
    {_count(quality.LINE)} AS lines, {_count(quality.ENDED_LINE)} AS ended,
    len(list_filter(regexp_extract_all(lower(t), '[a-z]+'), lambda x: list_contains(en.w, x))) + len(regexp_extract_all(t, ja.p)) AS common
  FROM d, ja, en)
SELECT doc_id, length(t) AS n_chars, w AS n_words, {_share('letters', 'w')} AS mean_word_length, {_share(_without(quality.NO_SYMBOL), 'solid')} AS symbol_ratio,
  {_share("length(t) - " + _without('[0-9]+'), 'solid')} AS digit_ratio, lines AS n_lines, {_share('ended', 'lines')} AS ended_line_share, {_share('common', 'w')} AS common_word_share
FROM c"""
}
