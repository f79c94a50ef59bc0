"""Serving and reporting queries, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.operators.windows import top_per_group
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_TABLES = ["schools_v2", "team_d1_stats", "team_l1_admission", "school_philosophy_v2", "team_b2_students", "documents"]


@query("kpi_row", "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS n_{t}" for t in _TABLES) + ", (SELECT count(DISTINCT school_id) FROM team_b2_students) AS n_schools_with_quotes")
def kpi_row(spark, folder):
    """One row of counts; each is an aggregate of one row, joined by position."""
    parts = [table(spark, folder, t).agg(F.count("*").alias(f"n_{t}")) for t in _TABLES]
    parts.append(table(spark, folder, "team_b2_students").agg(F.count_distinct("school_id").alias("n_schools_with_quotes")))
    return reduce(DataFrame.crossJoin, parts)


@query("top_schools", "SELECT school_id, count(*) AS n FROM team_c_llm_students WHERE school_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, school_id LIMIT 15")
def top_schools(spark, folder):
    q = table(spark, folder, "team_c_llm_students").filter("school_id IS NOT NULL")
    return q.groupBy("school_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "school_id").limit(15)


@query("counts_with_zero", "SELECT n.n_name, count(s.s_suppkey) AS n FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > 5000 GROUP BY 1")
def counts_with_zero(spark, folder):
    s = table(spark, folder, "supplier").filter("s_acctbal > 5000").groupBy("s_nationkey").agg(F.count("*").alias("n"))
    n = table(spark, folder, "nation")
    return n.join(s, n.n_nationkey == s.s_nationkey, "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"))


_YEARS = list(range(1992, 2003))


@query(
    "period_heatmap",
    "WITH s AS (SELECT l_suppkey, year(l_shipdate) AS y, l_quantity AS q FROM lineitem), t AS (SELECT l_suppkey FROM s GROUP BY 1 ORDER BY sum(q) DESC, l_suppkey LIMIT 15) SELECT l_suppkey, " + ", ".join(f"coalesce(sum(q) FILTER (WHERE y = {y}), 0) AS y{y}" for y in _YEARS) + " FROM s WHERE l_suppkey IN (SELECT l_suppkey FROM t) GROUP BY 1",
)
def period_heatmap(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"), "l_quantity")
    top = rows.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("t")).orderBy(F.desc("t"), "l_suppkey").limit(15).select("l_suppkey")
    wide = rows.join(F.broadcast(top), "l_suppkey", "left_semi").groupBy("l_suppkey").pivot("y", _YEARS).agg(F.sum("l_quantity")).na.fill(0)  # fifteen keys
    return wide.select("l_suppkey", *(F.col(str(y)).alias(f"y{y}") for y in _YEARS))


@query("cluster_period_mean", "SELECT c_mktsegment, year(o_orderdate) AS y, round(avg(o_totalprice), 6) AS mean FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2")
def cluster_period_mean(spark, folder):
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment", F.year("o_orderdate").alias("y")).agg(F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query("top_per_period", "SELECT y, l_partkey FROM (SELECT y, l_partkey, row_number() OVER (PARTITION BY y ORDER BY q DESC, l_partkey) AS r FROM (SELECT year(l_shipdate) AS y, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)) WHERE r <= 5")
def top_per_period(spark, folder):
    sums = table(spark, folder, "lineitem").groupBy(F.year("l_shipdate").alias("y"), "l_partkey").agg(F.sum("l_quantity").alias("q"))
    return top_per_group(sums, ["y"], [F.desc("q"), "l_partkey"], 5).select("y", "l_partkey")


@query("radar_members", "SELECT u.user_id, d.d AS dim, coalesce(nullif(round(avg(e.value), 6), 0), 50) AS score FROM (SELECT DISTINCT user_id FROM events WHERE user_id IN (3, 5, 8)) u CROSS JOIN (SELECT unnest(['click', 'view', 'other']) AS d) d LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = d.d GROUP BY 1, 2")
def radar_members(spark, folder):
    """Scores of named members on a fixed list of dimensions; missing or zero reads 50."""
    e = table(spark, folder, "events").filter(F.col("user_id").isin(3, 5, 8))
    dims = e.select("user_id").distinct().withColumn("dim", F.explode(F.array(F.lit("click"), F.lit("view"), F.lit("other"))))
    score = e.groupBy("user_id", F.col("event_type").alias("dim")).agg(F.round(F.avg("value"), 6).alias("s"))
    return dims.join(score, ["user_id", "dim"], "left").select("user_id", "dim", F.coalesce(F.nullif("s", F.lit(0.0)), F.lit(50.0)).alias("score"))


@query("faceted_list", "SELECT id, count(*) AS n_rows, min(name_ja) AS name FROM schools_v2 WHERE (name_ja LIKE '%森%' OR name_kana LIKE '%もり%') AND gender_type = 'coed' GROUP BY 1")
def faceted_list(spark, folder):
    s = table(spark, folder, "schools_v2").filter((F.col("name_ja").contains("森") | F.col("name_kana").contains("もり")) & (F.col("gender_type") == "coed"))
    return s.groupBy("id").agg(F.count("*").alias("n_rows"), F.min("name_ja").alias("name"))


@query(
    "entity_detail",
    "SELECT s.id, coalesce(p.n, 0) AS n_texts, coalesce(q.n, 0) AS n_quotes, coalesce(a.n, 0) AS n_facts, p.first_text FROM (SELECT DISTINCT id FROM schools_v2) s LEFT JOIN (SELECT school_id, count(*) AS n, arg_min(substr(text_full, 1, 30), id) AS first_text FROM school_philosophy_v2 GROUP BY 1) p ON p.school_id = s.id LEFT JOIN (SELECT school_id, count(*) AS n FROM team_b2_students GROUP BY 1) q ON q.school_id = s.id LEFT JOIN (SELECT school_id, count(*) AS n FROM team_l1_admission GROUP BY 1) a ON a.school_id = s.id",
)
def entity_detail(spark, folder):
    s = table(spark, folder, "schools_v2").select("id").distinct()
    p = table(spark, folder, "school_philosophy_v2").groupBy(F.col("school_id").alias("id")).agg(F.count("*").alias("n_texts"), F.min_by(F.substring("text_full", 1, 30), "id").alias("first_text"))
    q = table(spark, folder, "team_b2_students").groupBy(F.col("school_id").alias("id")).agg(F.count("*").alias("n_quotes"))
    a = table(spark, folder, "team_l1_admission").groupBy(F.col("school_id").alias("id")).agg(F.count("*").alias("n_facts"))
    return s.join(p, "id", "left").join(q, "id", "left").join(a, "id", "left").na.fill(0, ["n_texts", "n_quotes", "n_facts"]).select("id", "n_texts", "n_quotes", "n_facts", "first_text")


@query("facet_values", "SELECT DISTINCT 'gender' AS facet, gender_type AS value FROM schools_v2 UNION SELECT 'religion', religious_affiliation FROM schools_v2 UNION SELECT 'pref', location_pref FROM schools_v2")
def facet_values(spark, folder):
    s = table(spark, folder, "schools_v2")
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("facet"), F.col(c).alias("value")) for n, c in (("gender", "gender_type"), ("religion", "religious_affiliation"), ("pref", "location_pref")))))
    return s.select(pairs.alias("x")).select("x.facet", "x.value").distinct()


@query("distribution_shares", "SELECT source_type, n, round(100.0 * n / sum(n) OVER (), 6) AS pct FROM (SELECT source_type, count(*) AS n FROM team_c_llm_principal_round4 GROUP BY 1)")
def distribution_shares(spark, folder):
    n = table(spark, folder, "team_c_llm_principal_round4").groupBy("source_type").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return n.crossJoin(F.broadcast(total)).select("source_type", "n", F.round(F.lit(100.0) * F.col("n") / F.col("t"), 6).alias("pct"))


@query(
    "coverage_summary",
    "SELECT coalesce(s.location_pref, '?') AS pref, count(DISTINCT s.id) AS n_schools, count(q.record_id) AS n_quotes, count(DISTINCT CASE WHEN q.record_id IS NOT NULL THEN s.id END) AS n_covered, count(DISTINCT q.speaker_role) AS n_roles FROM (SELECT id, min(location_pref) AS location_pref FROM schools_v2 GROUP BY 1) s LEFT JOIN team_b2_students q ON q.school_id = s.id GROUP BY 1",
)
def coverage_summary(spark, folder):
    s = table(spark, folder, "schools_v2").groupBy("id").agg(F.min("location_pref").alias("location_pref"))
    q = table(spark, folder, "team_b2_students").groupBy("school_id").agg(F.count("*").alias("n"), F.collect_set("speaker_role").alias("roles"))  # a few roles
    joined = s.join(q, s.id == q.school_id, "left")
    return joined.groupBy(F.coalesce("location_pref", F.lit("?")).alias("pref")).agg(
        F.count("*").alias("n_schools"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_quotes"), F.count("n").alias("n_covered"), F.size(F.array_distinct(F.flatten(F.collect_set("roles")))).cast("bigint").alias("n_roles")
    )


@query("export_cube", "SELECT school_id, map_from_entries(list((stat_name, m) ORDER BY stat_name))::VARCHAR IS NOT NULL AS has_cube, count(*) AS n_stats, round(sum(m), 6) AS total FROM (SELECT school_id, stat_name, round(avg(stat_value), 6) AS m FROM team_d1_stats WHERE stat_value IS NOT NULL AND school_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def export_cube(spark, folder):
    """Nested measures per key, as a map; a key has as many entries as there are measures."""
    d = table(spark, folder, "team_d1_stats").filter("stat_value IS NOT NULL AND school_id IS NOT NULL")
    m = d.groupBy("school_id", "stat_name").agg(F.round(F.avg("stat_value"), 6).alias("m"))
    cube = m.groupBy("school_id").agg(F.map_from_entries(F.collect_list(F.struct("stat_name", "m"))).alias("cube"), F.round(F.sum("m"), 6).alias("total"))
    return cube.select("school_id", F.col("cube").isNotNull().alias("has_cube"), F.size("cube").cast("bigint").alias("n_stats"), "total")


@query("revenue_by_flag", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-01' GROUP BY 1, 2")
def revenue_by_flag(spark, folder):
    rows = table(spark, folder, "lineitem").filter("l_shipdate <= timestamp '2000-09-01'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n")
    )
