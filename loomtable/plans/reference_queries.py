"""Problem 1 over the school tables, and its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.operators.references import orphan_references, orphan_report, references_of
from loomtable.sources.tables import table

_SOURCES = {"team_d1_stats": "record_id", "team_l1_admission": "record_id", "school_philosophy_v2": "id"}
_NO_SCHOOL = r"^(national_agg$|pref_agg_)"


def school_references(spark: SparkSession, folder: str) -> DataFrame:
    parts = [references_of(table(spark, folder, t), t, record, "school_id", "retrieved_at", _NO_SCHOOL) for t, record in _SOURCES.items()]
    return reduce(DataFrame.unionByName, parts)


def school_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of the master, under the id and the legacy id of each school."""
    from loomtable.functions.keys import comparable_id

    schools = table(spark, folder, "schools_v2").select("id", "legacy_id", "created_at").distinct()
    removed = (
        table(spark, folder, "schools_removed")
        .select(comparable_id(F.col("school_id")).alias("gone"), "removed_at")
        .groupBy("gone")
        .agg(F.min("removed_at").alias("valid_to"))
    )
    dated = schools.join(removed, comparable_id(schools.id) == F.col("gone"), "left")
    return dated.select(F.explode(F.array("id", "legacy_id")).alias("key"), F.col("created_at").alias("valid_from"), "valid_to")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_references(school_references(spark, folder), school_spans(spark, folder)).select("table_name", "record_id")


def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    refs = school_references(spark, folder)
    return orphan_report(refs, orphan_references(refs, school_spans(spark, folder)))


QUERIES = {"p1_found": p1_found, "p1_report": p1_report}

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")


def _bare(col: str) -> str:
    return f"nullif(regexp_replace(lower(translate({col}, '{_WIDE}', '{_NARROW}')), '^[\\s\\x{{3000}}\\x{{a0}}]+|[\\s\\x{{3000}}\\x{{a0}}]+$', '', 'g'), '')"


_BASE = f"""
WITH refs AS (
  SELECT * FROM (
    {' UNION ALL '.join(f"SELECT '{t}' AS table_name, CAST({r} AS BIGINT) AS record_id, {_bare('school_id')} AS k, retrieved_at AS t FROM {t}" for t, r in _SOURCES.items())}
  ) WHERE k IS NOT NULL AND k <> 'national_agg' AND k NOT LIKE 'pref!_agg!_%' ESCAPE '!'
), gone AS (
  SELECT {_bare('school_id')} AS sid, min(removed_at) AS removed_at FROM schools_removed GROUP BY 1
), spans AS (
  SELECT DISTINCT s.k, s.created_at, g.removed_at FROM (
    SELECT {_bare('id')} AS k, {_bare('id')} AS sid, created_at FROM schools_v2
    UNION ALL SELECT {_bare('legacy_id')}, {_bare('id')}, created_at FROM schools_v2
  ) s LEFT JOIN gone g ON g.sid = s.sid WHERE s.k IS NOT NULL
), firsts AS (SELECT k, min(coalesce(created_at, '')) AS first_from FROM spans GROUP BY k
), orphans AS (
  SELECT r.table_name, r.record_id, r.t,
    CASE WHEN f.k IS NULL THEN 'unknown' WHEN r.t < f.first_from THEN 'too_early' ELSE 'removed' END AS reason
  FROM refs r LEFT JOIN firsts f ON f.k = r.k
  WHERE f.k IS NULL OR (r.t IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM spans s WHERE s.k = r.k AND (s.created_at IS NULL OR r.t >= s.created_at) AND (s.removed_at IS NULL OR r.t < s.removed_at)))
)"""
_PERIOD = "CASE WHEN t IS NULL THEN '(none)' WHEN regexp_matches(t, '^\\d{4}-(0[1-9]|1[0-2])') THEN substr(t, 1, 7) ELSE '(irregular)' END"
SQL = {
    "p1_found": _BASE + " SELECT table_name, record_id FROM orphans",
    "p1_report": _BASE
    + f""", total AS (SELECT table_name, {_PERIOD} AS period, count(*) AS n FROM refs GROUP BY 1, 2),
bad AS (SELECT table_name, {_PERIOD} AS period, count(*) AS n, count(*) FILTER (WHERE reason = 'unknown') AS u,
  count(*) FILTER (WHERE reason = 'too_early') AS e, count(*) FILTER (WHERE reason = 'removed') AS r FROM orphans GROUP BY 1, 2)
SELECT t.table_name, t.period, t.n AS n_references, coalesce(b.n, 0) AS n_orphans, coalesce(b.u, 0) AS n_unknown,
  coalesce(b.e, 0) AS n_too_early, coalesce(b.r, 0) AS n_removed, round(coalesce(b.n, 0) / t.n, 6) AS orphan_share
FROM total t LEFT JOIN bad b ON b.table_name = t.table_name AND b.period = t.period""",
}
