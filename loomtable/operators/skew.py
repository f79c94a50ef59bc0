"""Joins of rows that may share one key with a table of few rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64
BROADCAST_ROWS = 100_000


def join_few(rows: DataFrame, few: DataFrame, on: list[str], spread: str, how: str = "inner", most: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """rows joined with few on equal columns, without a task that holds all rows of a key.

    few is counted (so it should be written or cheap): up to `most` rows it is broadcast;
    beyond, every row of few stands once in each of `salts` parts, and rows are spread over
    the parts by the hash of their column `spread`. how is 'inner', 'left' or 'left_semi'.
    """
    if few.count() <= most:
        return rows.join(F.broadcast(few), on, how)
    parts = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(parts, [*on, "__salt"], how).drop("__salt")
