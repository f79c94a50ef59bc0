"""Filters, joins, aggregates, windows, limits and set operations, each with its SQL."""

from __future__ import annotations


from pyspark.sql import functions as F

from loomtable.operators import windows as W
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql


def _t(spark, folder, *names):
    return [table(spark, folder, n) for n in names]


# ---- filters


@query("basic_filters", "SELECT row_id, id FROM schools_v2 WHERE homepage_url IS NOT NULL AND homepage_url <> '' AND location_pref IN ('碧海県', '黒潮県') AND establishment_year BETWEEN 1900 AND 1980")
def basic_filters(spark, folder):
    (s,) = _t(spark, folder, "schools_v2")
    return s.filter("homepage_url IS NOT NULL AND homepage_url <> ''").filter(F.col("location_pref").isin("碧海県", "黒潮県") & F.col("establishment_year").between(1900, 1980)).select("row_id", "id")


def faceted(df, **facets):
    """Rows that agree with every facet that is given; empty facets do not filter."""
    for column, wanted in facets.items():
        if wanted not in (None, ""):
            df = df.filter(F.col(column) == wanted)
    return df


@query("facets", "SELECT row_id, name_ja FROM schools_v2 WHERE gender_type = 'girls' AND integrated_type = 'attached'")
def facets(spark, folder):
    (s,) = _t(spark, folder, "schools_v2")
    return faceted(s, gender_type="girls", location_pref="", integrated_type="attached", religious_affiliation=None).select("row_id", "name_ja")


# ---- joins


@query("join_inner", "SELECT n.n_name, r.r_name, count(*) AS n_customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2")
def join_inner(spark, folder):
    c, n, r = _t(spark, folder, "customer", "nation", "region")
    joined = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.groupBy("n_name", "r_name").agg(F.count("*").alias("n_customers"))


@query("join_left", "SELECT c.c_custkey, count(o.o_orderkey) AS n_orders, round(coalesce(sum(o.o_totalprice), 0), 2) AS spent FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1")
def join_left(spark, folder):
    c, o = _t(spark, folder, "customer", "orders")
    spent = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent"))  # summed before the join
    return c.join(spent, c.c_custkey == spent.o_custkey, "left").select("c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"))


@query("join_semi", "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)")
def join_semi(spark, folder):
    p, l = _t(spark, folder, "part", "lineitem")  # noqa: E741
    return p.join(l.filter("l_quantity >= 49"), p.p_partkey == l.l_partkey, "left_semi").select("p_partkey", "p_name")


@query("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_anti(spark, folder):
    c, o = _t(spark, folder, "customer", "orders")
    return c.join(o.filter("o_orderstatus = 'F'"), c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query(
    "semi_of_union",
    "SELECT DISTINCT id FROM schools_v2 WHERE id IN (SELECT school_id FROM team_b2_students UNION SELECT school_id FROM team_c_llm_students UNION SELECT school_id FROM school_philosophy_v2)",
)
def semi_of_union(spark, folder):
    s, *others = _t(spark, folder, "schools_v2", "team_b2_students", "team_c_llm_students", "school_philosophy_v2")
    a, b, c = (o.select("school_id") for o in others)
    return s.join(a.union(b).union(c).distinct(), s.id == F.col("school_id"), "left_semi").select("id").distinct()


@query("scalar_subquery", "SELECT s.id, (SELECT count(*) FROM team_b2_students q WHERE q.school_id = s.id) AS n FROM (SELECT DISTINCT id FROM schools_v2) s WHERE (SELECT count(*) FROM team_b2_students q WHERE q.school_id = s.id) >= 1")
def scalar_subquery(spark, folder):
    s, q = _t(spark, folder, "schools_v2", "team_b2_students")
    n = q.groupBy("school_id").agg(F.count("*").alias("n"))
    return s.select("id").distinct().join(n, F.col("id") == F.col("school_id")).filter("n >= 1").select("id", "n")


@query("lookup_replicate", "SELECT s.s_suppkey, n.n_name, a.mean FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey, (SELECT round(avg(s_acctbal), 8) AS mean FROM supplier) a")
def lookup_replicate(spark, folder):
    """A regional value to each member, and one national row to all."""
    s, n = _t(spark, folder, "supplier", "nation")
    one = s.agg(F.round(F.avg("s_acctbal"), 8).alias("mean"))  # one row
    return s.join(n, s.s_nationkey == n.n_nationkey).crossJoin(F.broadcast(one)).select("s_suppkey", "n_name", "mean")


@query(
    "lookup_fallback",
    "SELECT q.record_id, coalesce(nullif(q.source_url, ''), h.home, '') AS url FROM team_b2_students q LEFT JOIN (SELECT id, max(homepage_url) AS home FROM schools_v2 GROUP BY 1) h ON h.id = q.school_id",
)
def lookup_fallback(spark, folder):
    q, s = _t(spark, folder, "team_b2_students", "schools_v2")
    home = s.groupBy("id").agg(F.max("homepage_url").alias("home"))
    return q.join(home, q.school_id == home.id, "left").select("record_id", F.coalesce(F.nullif("source_url", F.lit("")), "home", F.lit("")).alias("url"))


@query("join_fill", "SELECT id, coalesce(n, 0) AS n_facts, round(coalesce(m, 0), 3) AS mean_ratio FROM (SELECT DISTINCT id FROM schools_v2) LEFT JOIN (SELECT school_id, count(*) AS n, avg(competition_ratio) AS m FROM team_l1_admission GROUP BY 1) ON school_id = id")
def join_fill(spark, folder):
    s, a = _t(spark, folder, "schools_v2", "team_l1_admission")
    facts = a.groupBy("school_id").agg(F.count("*").alias("n_facts"), F.avg("competition_ratio").alias("m"))
    joined = s.select("id").distinct().join(facts, F.col("id") == F.col("school_id"), "left")
    return joined.na.fill(0, ["n_facts"]).na.fill(0.0, ["m"]).select("id", "n_facts", F.round("m", 3).alias("mean_ratio"))


# ---- aggregates


@query("group_counts", "SELECT source, count(*) AS n, count(DISTINCT school_id) AS n_schools, count(text) AS n_texts FROM documents GROUP BY 1")
def group_counts(spark, folder):
    (d,) = _t(spark, folder, "documents")
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("school_id").alias("n_schools"), F.count("text").alias("n_texts"))


@query("conditional_counts", "SELECT school_id, count(*) FILTER (WHERE applicants IS NOT NULL) AS with_applicants, count(*) FILTER (WHERE exam_type = '一般') AS general, sum(CASE WHEN applicants > admitted THEN 1 ELSE 0 END) AS selective, count(DISTINCT year) AS n_years FROM team_l1_admission GROUP BY 1")
def conditional_counts(spark, folder):
    (a,) = _t(spark, folder, "team_l1_admission")
    return a.groupBy("school_id").agg(
        F.count("applicants").alias("with_applicants"), F.count_if(F.col("exam_type") == "一般").alias("general"), F.sum(F.when(F.col("applicants") > F.col("admitted"), 1).otherwise(0)).alias("selective"), F.count_distinct("year").alias("n_years")
    )


@query(
    "coverage_by_region",
    "SELECT coalesce(s.location_pref, '?') AS pref, count(DISTINCT s.id) AS n_schools, count(DISTINCT CASE WHEN q.record_id IS NOT NULL THEN s.id END) AS n_covered FROM (SELECT DISTINCT id, location_pref FROM schools_v2) s LEFT JOIN team_b2_students q ON q.school_id = s.id GROUP BY 1",
)
def coverage_by_region(spark, folder):
    s, q = _t(spark, folder, "schools_v2", "team_b2_students")
    have = q.select("school_id").distinct().withColumn("has", F.lit(True))
    joined = s.select("id", "location_pref").distinct().join(have, F.col("id") == F.col("school_id"), "left")
    return joined.groupBy(F.coalesce("location_pref", F.lit("?")).alias("pref")).agg(F.count_distinct("id").alias("n_schools"), F.count_distinct(F.when(F.col("has"), F.col("id"))).alias("n_covered"))


@query("having_count", "SELECT count(*) AS n_groups, sum(n) AS n_rows FROM (SELECT school_id, count(*) AS n FROM team_d1_stats GROUP BY 1 HAVING count(*) >= 5)")
def having_count(spark, folder):
    (d,) = _t(spark, folder, "team_d1_stats")
    return d.groupBy("school_id").agg(F.count("*").alias("n")).filter("n >= 5").agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_rows"))


@query("mean_after_filter", "SELECT stat_name, count(*) AS n, round(avg(stat_value), 8) AS mean, min(stat_value) AS low, max(stat_value) AS high FROM team_d1_stats WHERE school_id NOT LIKE 'NATIONAL%' AND stat_value > 0 GROUP BY 1")
def mean_after_filter(spark, folder):
    (d,) = _t(spark, folder, "team_d1_stats")
    kept = d.filter(~F.col("school_id").like("NATIONAL%") & (F.col("stat_value") > 0))
    return kept.groupBy("stat_name").agg(F.count("*").alias("n"), F.round(F.avg("stat_value"), 8).alias("mean"), F.min("stat_value").alias("low"), F.max("stat_value").alias("high"))


@query("ordered_concat", "SELECT school_id, string_agg(philosophy_type, ' | ' ORDER BY id) AS types FROM school_philosophy_v2 GROUP BY 1")
def ordered_concat(spark, folder):
    (p,) = _t(spark, folder, "school_philosophy_v2")
    ordered = F.array_sort(F.collect_list(F.struct("id", "philosophy_type")))
    return p.groupBy("school_id").agg(F.array_join(F.transform(ordered, lambda x: x.philosophy_type), " | ").alias("types"))


_EVENTS = ["click", "error", "purchase", "signup", "view"]


@query("pivot_mean", "SELECT user_id, " + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{e}'), 8) AS \"{e}\"" for e in _EVENTS) + " FROM events GROUP BY 1")
def pivot_mean(spark, folder):
    (e,) = _t(spark, folder, "events")
    wide = e.groupBy("user_id").pivot("event_type", _EVENTS).agg(F.avg("value"))
    return wide.select("user_id", *(F.round(c, 8).alias(c) for c in _EVENTS))


@query("pivot_count", "SELECT o_orderstatus, " + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p[0]}\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " FROM orders GROUP BY 1")
def pivot_count(spark, folder):
    (o,) = _t(spark, folder, "orders")
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    wide = o.groupBy("o_orderstatus").pivot("o_orderpriority", names).count().na.fill(0)
    return wide.select("o_orderstatus", *(F.col(f"`{n}`").alias(n[0]) for n in names))


@query("numeric_profile", "SELECT event_type, min(value) AS low, round(avg(value), 8) AS mean, max(value) AS high, round(median(value), 8) AS middle, round(quantile_cont(value, 0.9), 8) AS p90 FROM events GROUP BY 1")
def numeric_profile(spark, folder):
    (e,) = _t(spark, folder, "events")
    plain = e.groupBy("event_type").agg(F.min("value").alias("low"), F.round(F.avg("value"), 8).alias("mean"), F.max("value").alias("high"))
    places = W.order_statistics(e, ["value"], [0.5, 0.9], ["event_type"]).withColumnRenamed("event_type", "_type")
    both = plain.join(places, F.col("event_type").eqNullSafe(F.col("_type")))
    return both.select("event_type", "low", "mean", "high", F.round("value_0", 8).alias("middle"), F.round("value_1", 8).alias("p90"))


@query("counts_of_counts", "SELECT round(avg(n), 8) AS mean, median(n) AS middle, max(n) AS most FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)")
def counts_of_counts(spark, folder):
    (e,) = _t(spark, folder, "events")
    n = e.groupBy("user_id").agg(F.count("*").alias("n"))
    plain = n.agg(F.round(F.avg("n"), 8).alias("mean"), F.max("n").alias("most"))
    return plain.crossJoin(F.broadcast(W.order_statistics(n, ["n"], [0.5]))).select("mean", F.col("n_0").alias("middle"), "most")  # one row each


@query("histogram", "SELECT CAST(floor(value / 10) AS BIGINT) AS bin, count(*) AS n FROM events GROUP BY 1")
def histogram(spark, folder):
    (e,) = _t(spark, folder, "events")
    return e.groupBy(F.floor(F.col("value") / 10).alias("bin")).agg(F.count("*").alias("n"))


@query("column_means", "SELECT event_type, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 8) AS p FROM events GROUP BY 1")
def column_means(spark, folder):
    (e,) = _t(spark, folder, "events")
    return e.groupBy("event_type").agg(F.round(F.avg((F.col("value") > 50).cast("double")), 8).alias("p"))


@query("missing_members", "SELECT n_nationkey, n_name, 'absent' AS state FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9000) UNION ALL SELECT n_nationkey, n_name, 'present' FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9000)")
def missing_members(spark, folder):
    n, c = _t(spark, folder, "nation", "customer")
    have = c.filter("c_mktsegment = 'MACHINERY' AND c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    absent = n.join(have, "n_nationkey", "left_anti").withColumn("state", F.lit("absent"))
    return absent.unionByName(n.join(have, "n_nationkey", "left_semi").withColumn("state", F.lit("present"))).select("n_nationkey", "n_name", "state")


@query("set_union_first5", "SELECT source, list_slice(list_sort(list(DISTINCT lang) FILTER (WHERE lang IS NOT NULL)), 1, 5) AS langs FROM documents GROUP BY 1")
def set_union_first5(spark, folder):
    (d,) = _t(spark, folder, "documents")
    return d.groupBy("source").agg(F.slice(F.array_sort(F.collect_set("lang")), 1, 5).alias("langs"))


@query(
    "group_profile",
    "SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS n_types, count(*) FILTER (WHERE event_type = 'error') AS n_errors, count(*) >= 5 AS enough, count(DISTINCT event_type) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) >= 2 AS two_core FROM events GROUP BY 1",
)
def group_profile(spark, folder):
    (e,) = _t(spark, folder, "events")
    core = F.array(*(F.lit(x) for x in ("click", "view", "purchase")))
    seen = F.collect_set("event_type")
    return e.groupBy("user_id").agg(
        F.count("*").alias("n"), F.size(seen).cast("bigint").alias("n_types"), F.count_if(F.col("event_type") == "error").alias("n_errors"), (F.count("*") >= 5).alias("enough"), (F.size(F.array_intersect(seen, core)) >= 2).alias("two_core")
    )


@query(
    "rollup_shares",
    "SELECT pref, n, round(100.0 * n / greatest(t.total, 1), 8) AS pct FROM (SELECT coalesce(location_pref, '?') AS pref, count(*) AS n FROM schools_v2 GROUP BY 1), (SELECT count(*) AS total FROM schools_v2) t UNION ALL SELECT '(all)', count(*), 100.0 FROM schools_v2",
)
def rollup_shares(spark, folder):
    (s,) = _t(spark, folder, "schools_v2")
    by = s.groupBy(F.coalesce("location_pref", F.lit("?")).alias("pref")).agg(F.count("*").alias("n"))
    total = by.agg(F.sum("n").alias("total"))
    shares = by.crossJoin(F.broadcast(total)).select("pref", "n", F.round(F.lit(100.0) * F.col("n") / F.greatest("total", F.lit(1)), 8).alias("pct"))
    return shares.union(total.select(F.lit("(all)"), "total", F.lit(100.0)))


@query(
    "archetype_summary",
    "SELECT category, count(*) AS n, round(sum(coalesce(birth, 0)) / count(*), 8) AS mean_with_zero, list_slice(list(record_id ORDER BY coalesce(birth, 9999), record_id), 1, 5) AS earliest FROM team_c1_gf GROUP BY 1",
)
def archetype_summary(spark, folder):
    """The five earliest members by a bounded aggregate: each task keeps five per group."""
    (g,) = _t(spark, folder, "team_c1_gf")
    n = g.groupBy("category").agg(F.count("*").alias("n"), F.round(F.sum(F.coalesce("birth", F.lit(0))) / F.count("*"), 8).alias("mean_with_zero"))
    first = W.top_per_group(g.withColumn("b", F.coalesce("birth", F.lit(9999))), ["category"], ["b", "record_id"], 5)
    ids = first.groupBy("category").agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "record_id"))), lambda x: x.record_id).alias("earliest"))
    return n.join(ids, n.category.eqNullSafe(ids.category)).select(n.category, "n", "mean_with_zero", "earliest")


@query("reason_counts", "SELECT CASE WHEN applicants IS NULL THEN 'no applicants' WHEN admitted IS NULL THEN 'no admitted' WHEN applicants < admitted THEN 'too few' ELSE 'ok' END AS reason, count(*) AS n FROM team_l1_admission GROUP BY 1")
def reason_counts(spark, folder):
    (a,) = _t(spark, folder, "team_l1_admission")
    reason = F.when(F.col("applicants").isNull(), "no applicants").when(F.col("admitted").isNull(), "no admitted").when(F.col("applicants") < F.col("admitted"), "too few").otherwise("ok")
    return a.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("safe_count", "SELECT 'documents' AS name, (SELECT count(*) FROM documents) AS n UNION ALL SELECT 'no_such_table', 0")
def safe_count(spark, folder):
    """Counts of tables; one that does not exist has none."""
    from pyspark.errors import AnalysisException

    out = None
    for name in ("documents", "no_such_table"):
        try:
            n = table(spark, folder, name).agg(F.count("*").alias("n"))
        except AnalysisException:
            n = spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        row = n.select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.union(row)
    return out


# ---- windows


@query("keep_first_per_key", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def keep_first_per_key(spark, folder):
    (o,) = _t(spark, folder, "orders")
    return W.keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("keep_longest_per_key", "SELECT school_id, id FROM (SELECT *, row_number() OVER (PARTITION BY school_id ORDER BY length(text_full) DESC, id) AS r FROM school_philosophy_v2) WHERE r = 1")
def keep_longest_per_key(spark, folder):
    (p,) = _t(spark, folder, "school_philosophy_v2")
    return W.keep_longest(p, ["school_id"], "text_full", "id").select("school_id", "id")


@query("cap_per_group", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r <= 7")
def cap_per_group(spark, folder):
    (e,) = _t(spark, folder, "events")
    return W.top_per_group(e, ["user_id"], ["ts", "event_id"], 7).select("event_id")


@query(
    "cap_with_room",
    "SELECT e.event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE event_type <> 'error') e LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) x ON x.user_id = e.user_id WHERE e.r <= 15 - coalesce(x.n, 0)",
)
def cap_with_room(spark, folder):
    (e,) = _t(spark, folder, "events")
    existing = e.filter("event_type = 'error'").groupBy("user_id").agg(F.count("*").alias("n_existing"))
    return W.cap_with_room(e.filter("event_type <> 'error'"), "user_id", ["ts", "event_id"], existing, 15).select("event_id")


@query("top_scores_per_group", "SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r <= 3")
def top_scores_per_group(spark, folder):
    (l,) = _t(spark, folder, "lineitem")  # noqa: E741
    return W.top_per_group(l, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 3).select("l_suppkey", "l_orderkey", "l_linenumber")


@query(
    "cap_by_existing",
    "SELECT e.event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events WHERE event_type = 'view') e LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1) x ON x.user_id = e.user_id WHERE e.r <= CASE WHEN coalesce(x.n, 0) >= 15 THEN 0 ELSE 15 - coalesce(x.n, 0) END",
)
def cap_by_existing(spark, folder):
    (e,) = _t(spark, folder, "events")
    existing = e.filter("event_type = 'signup'").groupBy("user_id").agg(F.count("*").alias("n_existing"))
    return W.cap_with_room(e.filter("event_type = 'view'"), "user_id", [F.desc("value"), "event_id"], existing, 15).select("event_id")


@query("carry_forward", "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events")
def carry_forward(spark, folder):
    (e,) = _t(spark, folder, "events")
    marked = e.withColumn("signup", F.when(F.col("event_type") == "signup", F.col("value")))
    return W.carried_forward(marked, "user_id", ["ts", "event_id"], "signup", "last_signup").select("event_id", "last_signup")


@query("section_spans", "SELECT user_id, event_id, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 1000000) AS until FROM events WHERE event_type = 'signup'")
def section_spans(spark, folder):
    (e,) = _t(spark, folder, "events")
    starts = e.filter("event_type = 'signup'").withColumn("end", F.lit(1000000).cast("bigint"))
    return W.section_spans(starts, "user_id", "event_id", "end").select("user_id", "event_id", "until")


@query("neighbours", "SELECT o_orderkey, lag(o_orderkey) OVER w AS previous, lead(o_orderkey) OVER w AS next FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def neighbours(spark, folder):
    (o,) = _t(spark, folder, "orders")
    return W.with_neighbours(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey").select("o_orderkey", "previous", "next")


@query("even_ranges", "SELECT c_custkey, ntile(7) OVER (ORDER BY c_custkey) AS bucket FROM customer")
def even_ranges(spark, folder):
    (c,) = _t(spark, folder, "customer")
    return W.even_ranges(c, "c_custkey", 7).select("c_custkey", F.col("bucket").cast("bigint").alias("bucket"))


_EDGES = ", ".join(f"quantile_cont(m, {q}) AS q{k}" for k, q in enumerate((0.2, 0.4, 0.6, 0.8)))


@query("quantile_bins", f"SELECT user_id, 1 + (m > q0)::INT + (m > q1)::INT + (m > q2)::INT + (m > q3)::INT AS bin FROM (SELECT user_id, avg(value) AS m FROM events GROUP BY 1), (SELECT {_EDGES} FROM (SELECT avg(value) AS m FROM events GROUP BY user_id))")
def quantile_bins(spark, folder):
    (e,) = _t(spark, folder, "events")
    means = e.groupBy("user_id").agg(F.avg("value").alias("m"))
    edges = W.order_statistics(means, ["m"], [0.2, 0.4, 0.6, 0.8])  # one row
    bin_ = F.lit(1) + sum(((F.col("m") > F.col(f"m_{k}")).cast("int") for k in range(4)), F.lit(0))
    return means.crossJoin(F.broadcast(edges)).select("user_id", bin_.alias("bin"))


# ---- limits and set operations


@query("top_n", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 15")
def top_n(spark, folder):
    (c,) = _t(spark, folder, "customer")
    return c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(15).select("c_custkey", "c_acctbal")


@query("page_of_rows", "SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100 OFFSET 200")
def page_of_rows(spark, folder):
    (c,) = _t(spark, folder, "customer")
    return c.select("c_custkey").orderBy("c_custkey").offset(200).limit(100)


@query("newest", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def newest(spark, folder):
    (e,) = _t(spark, folder, "events")
    return e.orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id")


@query("top_truthy", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax > 0 ORDER BY l_tax DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10")
def top_truthy(spark, folder):
    (l,) = _t(spark, folder, "lineitem")  # noqa: E741
    return l.filter("l_tax > 0").orderBy(F.desc("l_tax"), "l_orderkey", "l_linenumber", "l_partkey").limit(10).select("l_orderkey", "l_linenumber", "l_tax")


@query("top_sums", "SELECT l_partkey, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_sums(spark, folder):
    (l,) = _t(spark, folder, "lineitem")  # noqa: E741
    return l.groupBy("l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("total")).orderBy(F.desc("total"), "l_partkey").limit(15)


@query("argmax_first", "SELECT user_id, arg_max(event_type, (n, -k)) AS kind FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS k FROM events GROUP BY 1, 2) GROUP BY 1")
def argmax_first(spark, folder):
    """The most frequent kind; of equals, the one seen first."""
    (e,) = _t(spark, folder, "events")
    n = e.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("k"))
    return n.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", -F.col("k"))).alias("kind"))


@query("union_distinct", "SELECT school_id FROM team_b2_students UNION SELECT school_id FROM team_c_llm_principal_round4")
def union_distinct(spark, folder):
    a, b = _t(spark, folder, "team_b2_students", "team_c_llm_principal_round4")
    return a.select("school_id").union(b.select("school_id")).distinct()


@query("append_mixed", "SELECT 'quote' AS kind, record_id, quote_text AS text, NULL::INTEGER AS word_count FROM team_b2_students UNION ALL SELECT 'philosophy', id, text_full, word_count FROM school_philosophy_v2")
def append_mixed(spark, folder):
    a, b = _t(spark, folder, "team_b2_students", "school_philosophy_v2")
    quotes = a.select(F.lit("quote").alias("kind"), "record_id", F.col("quote_text").alias("text"))
    texts = b.select(F.lit("philosophy").alias("kind"), F.col("id").alias("record_id"), F.col("text_full").alias("text"), "word_count")
    return quotes.unionByName(texts, allowMissingColumns=True)


@query("set_difference", "SELECT id AS school_id FROM schools_v2 EXCEPT SELECT school_id FROM team_b2_students")
def set_difference(spark, folder):
    s, q = _t(spark, folder, "schools_v2", "team_b2_students")
    return s.select(F.col("id").alias("school_id")).subtract(q.select("school_id"))


@query("set_intersection", "SELECT school_id FROM team_b2_students WHERE school_id IS NOT NULL INTERSECT SELECT school_id FROM team_l1_admission")
def set_intersection(spark, folder):
    a, b = _t(spark, folder, "team_b2_students", "team_l1_admission")
    return a.filter("school_id IS NOT NULL").select("school_id").intersect(b.select("school_id"))


@query("distinct_first", "SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY 1")
def distinct_first(spark, folder):
    """Distinct texts by their first document; a hash of the text is what is shuffled."""
    (d,) = _t(spark, folder, "documents")
    first = d.filter("text IS NOT NULL").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"))
    return d.join(first, "doc_id", "left_semi").select("text", "doc_id")
