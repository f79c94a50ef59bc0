"""Merges of a table with a change derived from it, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.operators import merge as M
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_OLD = "SELECT c_custkey, c_name, c_acctbal FROM customer"
_NEW = "SELECT c_custkey + 500 AS c_custkey, 'N' || c_name AS c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 3 = 0"


def _both(spark, folder):
    c = table(spark, folder, "customer")
    old = c.select("c_custkey", "c_name", "c_acctbal")
    new = c.filter("c_custkey % 3 = 0").select((F.col("c_custkey") + 500).alias("c_custkey"), F.concat(F.lit("N"), "c_name").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return old, new


@query("append_rows", f"{_OLD} UNION ALL {_NEW}")
def append_rows(spark, folder):
    old, new = _both(spark, folder)
    return old.unionByName(new)


@query("upsert_rows", f"{_NEW} UNION ALL SELECT * FROM ({_OLD}) o WHERE NOT EXISTS (SELECT 1 FROM ({_NEW}) n WHERE n.c_custkey = o.c_custkey)")
def upsert_rows(spark, folder):
    old, new = _both(spark, folder)
    return M.upsert(old, new, ["c_custkey"])


@query("insert_absent", f"{_OLD} UNION ALL SELECT * FROM ({_NEW}) n WHERE NOT EXISTS (SELECT 1 FROM customer o WHERE n.c_custkey = o.c_custkey)")
def insert_absent(spark, folder):
    old, new = _both(spark, folder)
    return M.insert_absent(old, new, ["c_custkey"], ["c_name"])


@query("upsert_last", "SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def upsert_last(spark, folder):
    """Of several changes of a key the last one holds."""
    e = table(spark, folder, "events").select("event_type", "event_id", "value", "ts")
    old = e.limit(0)
    return M.upsert(old, e, ["event_type"], ["ts", "event_id"]).select("event_type", "event_id", "value")


@query("replace_keys", "SELECT event_id, user_id FROM events WHERE user_id % 2 = 1 UNION ALL SELECT event_id + 1000000, user_id FROM events WHERE user_id % 2 = 0 AND event_type = 'view' UNION ALL SELECT event_id, user_id FROM events WHERE user_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'view')")
def replace_keys(spark, folder):
    e = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    new = e.filter("user_id % 2 = 0 AND event_type = 'view'").select((F.col("event_id") + 1000000).alias("event_id"), "user_id")
    return M.replace_keys(e.select("event_id", "user_id"), new, ["user_id"])


@query("fill_missing", "SELECT s.row_id, coalesce(nullif(s.homepage_url, ''), v.u) AS homepage_url FROM schools_v2 s LEFT JOIN (SELECT school_id, min(source_url) AS u FROM team_l1_admission GROUP BY 1) v ON v.school_id = s.id")
def fill_missing(spark, folder):
    values = table(spark, folder, "team_l1_admission").groupBy(F.col("school_id").alias("id")).agg(F.min("source_url").alias("homepage_url"))
    return M.fill_missing(table(spark, folder, "schools_v2").select("row_id", "id", "homepage_url"), values, "id", "homepage_url").select("row_id", "homepage_url")


@query(
    "partial_update",
    "SELECT s.row_id, CASE WHEN s.row_id % 7 = 0 THEN NULL WHEN s.row_id % 2 = 0 THEN coalesce(CASE WHEN s.row_id % 3 = 0 THEN NULL ELSE 'checked' END, s.notes) ELSE s.notes END AS notes, CASE WHEN s.row_id % 7 = 0 THEN NULL WHEN s.row_id % 2 = 0 THEN 1 ELSE s.data_completeness_v2 END AS data_completeness_v2 FROM schools_v2 s",
)
def partial_update(spark, folder):
    s = table(spark, folder, "schools_v2").select("row_id", "notes", "data_completeness_v2")
    r = F.col("row_id")
    changes = s.filter((r % 2 == 0) | (r % 7 == 0)).select(
        "row_id", F.when(r % 3 != 0, "checked").alias("notes"), F.when(r % 2 == 0, 1).alias("data_completeness_v2"), (r % 7 == 0).alias("drop")
    )
    return M.partial_update(s, changes, "row_id", ["notes", "data_completeness_v2"], "drop")


@query("restore_flagged", "SELECT record_id, CASE WHEN length(quote_text) > 60 AND record_id % 5 <> 0 THEN quote_text ELSE substr(quote_text, 1, 60) END AS quote_text FROM team_b2_students")
def restore_flagged(spark, folder):
    """Texts that were cut take their full form back where the snapshot holds them."""
    q = table(spark, folder, "team_b2_students").select("record_id", "quote_text")
    current = q.withColumn("flagged", F.length("quote_text") > 60).withColumn("quote_text", F.substring("quote_text", 1, 60))
    snapshot = q.filter("record_id % 5 <> 0")
    return M.restore(current, snapshot, "record_id", ["quote_text"], F.col("flagged")).select("record_id", "quote_text")


@query("strip_notes", "SELECT row_id, nullif(array_to_string(list_filter(string_split(notes || '; 確認:' || gender_type || '; ' || notes, '; '), lambda s: NOT regexp_matches(s, '^確認')), '; '), '') AS left_notes FROM schools_v2")
def strip_notes(spark, folder):
    notes = F.concat(F.col("notes"), F.lit("; 確認:"), F.col("gender_type"), F.lit("; "), F.col("notes"))
    return table(spark, folder, "schools_v2").select("row_id", M.without_note(notes, "^確認").alias("left_notes"))


@query(
    "next_ids",
    "SELECT doc_id, 'jpms_s_' || CASE WHEN length(n) >= 6 THEN n ELSE lpad(n, 6, '0') END AS id FROM (SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) + (SELECT max(CAST(regexp_extract(id, '([0-9]+)$', 1) AS BIGINT)) FROM schools_v2) AS VARCHAR) AS n FROM documents)",
)
def next_ids(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return M.next_ids(docs, table(spark, folder, "schools_v2"), "id", ["doc_id"], "jpms_s_", 6).select("doc_id", "id")


@query("fan_out", "SELECT row_id, 'primary' AS kind, primary_outcome_cluster AS value FROM schools_v2 WHERE primary_outcome_cluster IS NOT NULL UNION ALL SELECT row_id, 'secondary', secondary_outcome_cluster FROM schools_v2 WHERE secondary_outcome_cluster IS NOT NULL")
def fan_out(spark, folder):
    return M.fanned_out(table(spark, folder, "schools_v2"), ["row_id"], {"primary_outcome_cluster": "primary", "secondary_outcome_cluster": "secondary"})
