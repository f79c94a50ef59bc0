"""Problem 9: the sources of mix_targets mixed to their shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomtable.llm.mixing import mixed
from loomtable.llm.tokens import token_counts
from loomtable.session import cut_lineage
from loomtable.sources.tables import table


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, folder, "mix_targets")
    docs = table(spark, folder, "documents").join(targets.select("source"), "source", "left_semi")
    # tokens are counted once; what is kept of a document is a few bytes
    sized = cut_lineage(token_counts(docs, ["doc_id", "source", "lang"], "text"))
    return mixed(sized, targets)


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of every document in the mix."""
    return _mixed(spark, folder)[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Per source: target, reached share, copies, tokens."""
    return _mixed(spark, folder)[1]


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
