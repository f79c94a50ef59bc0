"""Audit of records in full, logs of changes and their undoing, the export cube, and more of the models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from loomtable.functions.text import class_share
from loomtable.models import irt, kmeans
from loomtable.operators import dedup as D
from loomtable.operators import rules as R
from loomtable.operators.windows import order_statistics, top_per_group
from loomtable.plans.base import Plans
from loomtable.plans.model_queries import _ANSWERS, _ITEMS, answers
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_BOILERPLATE = "お問い合わせはこちら|ページの先頭|個人情報保護|著作権|プライバシーポリシー|続きを読む|資料請求|コンテンツへスキップ|(?i:read more|copyright|all rights reserved|click here|skip to content)"


@query("boilerplate_free", f"SELECT doc_id FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '{_BOILERPLATE}')")
def boilerplate_free(spark, folder):
    return table(spark, folder, "documents").filter(F.col("text").isNotNull() & ~F.col("text").rlike(_BOILERPLATE)).select("doc_id")


_JA, _ENDS = "[ぁ-んァ-ヶー一-龥]", "[。！？!?.」』）)]$"
_SHARE = "(length(t) - length(regexp_replace(t, '{0}', '', 'g'))) / greatest(length(t), 1)::DOUBLE"


@query(
    "quotable",
    f"SELECT record_id FROM (SELECT record_id, trim(quote_text) AS t FROM team_c_llm_students) WHERE length(t) BETWEEN 30 AND 400 AND {_SHARE.format(_JA)} >= 0.4 AND NOT regexp_matches(t, '{_BOILERPLATE}') AND regexp_matches(t, '{_ENDS}') AND length(t) - length(replace(t, '|', '')) < 4 AND regexp_matches(t, '私|僕|思|感じ|学び|先生|友')",
)
def quotable(spark, folder):
    """Quotes fit to be cited: of some length, in Japanese, no boilerplate or navigation, ending as sentences do, in a voice."""
    t = F.trim("t")
    rows = table(spark, folder, "team_c_llm_students").select("record_id", F.trim("quote_text").alias("t"))
    fit = F.length("t").between(30, 400) & (class_share(F.col("t"), _JA[1:-1]) >= 0.4) & ~F.col("t").rlike(_BOILERPLATE) & F.col("t").rlike(_ENDS)
    return rows.filter(fit & (F.length("t") - F.length(F.replace(F.col("t"), F.lit("|"), F.lit(""))) < 4) & t.rlike("私|僕|思|感じ|学び|先生|友")).select("record_id")


_LOG = [("[0-9]{4}年", "<year>"), ("(?:中学|高校)[1-3]年", "<grade>"), ("第[0-9]+期", "<cohort>"), ("[0-9]+人", "<count>")]
_ROLES = [("alumni", "卒業生|[0-9]+年卒|第[0-9]+期"), ("pupil", "中学|高校|中[1-3]|高[1-3]|部")]
_PRINTABLE = "[A-Za-z0-9ぁ-んァ-ヶー一-龥々、。「」・！？!?.,\\s]"
_MASKED = "speaker_attribute || '。' || quote_text"
for _pattern, _to in _LOG:
    _MASKED = f"regexp_replace({_MASKED}, '{_pattern}', '{_to}', 'g')"


@query(
    "audit_in_full",
    f"WITH r AS (SELECT *, speaker_attribute || '。' || quote_text AS t, row_number() OVER (PARTITION BY school_id, substr(quote_text, 1, 80) ORDER BY record_id) AS n, {_MASKED} AS m FROM team_c_llm_students WHERE speaker_attribute IS NOT NULL AND quote_text IS NOT NULL), "
    f"s AS (SELECT record_id, source_url, t, m, CASE WHEN n > 1 THEN 'duplicate' WHEN {_SHARE.format(_PRINTABLE)} < 0.4 OR ({_SHARE.format(_JA)} < 0.05 AND {_SHARE.format('[A-Za-z]')} < 0.5) THEN 'garbled' WHEN regexp_matches(t, '(?i)not found|エラー') THEN 'error' WHEN regexp_matches(t, '(?i)lorem|ダミー') THEN 'dummy' WHEN length(quote_text) < 40 THEN 'flagged_length' WHEN regexp_matches(t, '未成年|<minor>') THEN 'flagged_minor' ELSE 'approved' END AS status, "
    "CASE WHEN regexp_matches(speaker_attribute, '卒業生|[0-9]+年卒|第[0-9]+期') THEN 'alumni' WHEN regexp_matches(speaker_attribute, '中学|高校|中[1-3]|高[1-3]|部') THEN 'pupil' ELSE speaker_role END AS role FROM r) "
    "SELECT record_id, CASE WHEN status LIKE 'flagged%' AND NOT regexp_matches(coalesce(source_url, ''), '^https?://[^/]+') THEN 'source_invalid' ELSE status END AS status, CASE WHEN status IN ('approved', 'flagged_length', 'flagged_minor') THEN role END AS role, CASE WHEN status IN ('approved', 'flagged_length', 'flagged_minor') THEN m <> t ELSE FALSE END AS was_masked FROM s",
)
def audit_in_full(spark, folder):
    """Status of each record: copies, garbled, error, filler, length in this order, else masked and given a refined role; what is flagged and has no address is invalid."""
    rows = table(spark, folder, "team_c_llm_students").filter("speaker_attribute IS NOT NULL AND quote_text IS NOT NULL").withColumn("head", F.substring("quote_text", 1, 80))
    rows = D.mark_duplicates(rows, ["school_id", "head"], ["record_id"]).withColumn("t", F.concat("speaker_attribute", F.lit("。"), "quote_text"))
    t = F.col("t")
    share = lambda c: class_share(t, c[1:-1])
    status = R.first_reason(
        [
            ("duplicate", F.col("is_duplicate")),
            ("garbled", (share(_PRINTABLE) < 0.4) | ((share(_JA) < 0.05) & (share("[A-Za-z]") < 0.5))),
            ("error", R.matches(t, "not found|エラー")),
            ("dummy", R.matches(t, "lorem|ダミー")),
            ("flagged_length", F.length("quote_text") < 40),
            ("flagged_minor", t.rlike("未成年|<minor>")),
        ],
        "approved",
    )
    role = R.first_match([(label, F.col("speaker_attribute").rlike(p)) for label, p in _ROLES], F.col("speaker_role"))
    rows = rows.withColumn("s", status).withColumn("m", R.masked_with_log(t, _LOG))
    kept = F.col("s").isin("approved", "flagged_length", "flagged_minor")
    invalid = F.col("s").startswith("flagged") & ~F.coalesce("source_url", F.lit("")).rlike("^https?://[^/]+")
    return rows.select("record_id", F.when(invalid, "source_invalid").otherwise(F.col("s")).alias("status"), F.when(kept, role).alias("role"), F.when(kept, F.size("m.log") > 0).otherwise(False).alias("was_masked"))


@query("changes_undone", "SELECT record_id, speaker_attribute || '。' || quote_text AS undone FROM team_c_llm_students WHERE speaker_attribute IS NOT NULL AND quote_text IS NOT NULL")
def changes_undone(spark, folder):
    """Texts masked with a log of the changes, and had back by undoing the log from its end."""
    rows = table(spark, folder, "team_c_llm_students").filter("speaker_attribute IS NOT NULL AND quote_text IS NOT NULL")
    m = rows.select("record_id", R.masked_with_log(F.concat("speaker_attribute", F.lit("。"), "quote_text"), _LOG).alias("m"))
    return m.select("record_id", R.undone(F.col("m.text"), F.col("m.log")).alias("undone"))


@query("guarded_names")
def guarded_names(spark, folder):
    """Names before a form of address masked, unless what stands there is a role."""
    rows = table(spark, folder, "team_c_llm_students").filter("quote_text IS NOT NULL")
    roles = "担任|顧問|生徒|先生|同級生|卒業生|後輩|先輩|部活|学校|皆"
    return rows.select("record_id", F.regexp_replace("quote_text", f"(?<![一-龥々])(?!(?:{roles}))[一-龥々]{{2,4}}(?=さん|くん|ちゃん)", "<name>").alias("masked"))


# ---- the export cube

_SECTIONS_SQL = {
    "meta": "SELECT 'schools' AS k1, '' AS k2, NULL AS text, count(*)::DOUBLE AS number FROM schools_v2 UNION ALL SELECT 'records', '', NULL, count(*) FROM team_d1_stats",
    "progress": "SELECT 'with_url', '', NULL, count(DISTINCT CASE WHEN homepage_url <> '' THEN id END) FROM schools_v2 UNION ALL SELECT 'philosophies', '', NULL, count(*) FROM school_philosophy_v2 UNION ALL SELECT 'voices', '', NULL, count(*) FROM team_b2_students UNION ALL SELECT 'covered', '', NULL, count(DISTINCT school_id) FROM team_b2_students",
    "schools": "SELECT id, '', min(name_ja), min(establishment_year)::DOUBLE FROM schools_v2 GROUP BY 1",
    "culture_dims": "SELECT DISTINCT stat_name, '', NULL, NULL::DOUBLE FROM team_d1_stats WHERE stat_name IS NOT NULL",
    "culture_scores": "SELECT school_id, stat_name, NULL, round(avg(stat_value), 6) FROM team_d1_stats WHERE school_id IS NOT NULL AND stat_name IS NOT NULL AND stat_value IS NOT NULL GROUP BY 1, 2",
    "outcome_clusters": "SELECT primary_outcome_cluster, '', NULL, count(*) FROM schools_v2 WHERE primary_outcome_cluster IS NOT NULL GROUP BY 1",
    "outcome_dims": "SELECT primary_outcome_cluster, secondary_outcome_cluster, NULL, count(*) FROM schools_v2 WHERE primary_outcome_cluster IS NOT NULL AND secondary_outcome_cluster IS NOT NULL GROUP BY 1, 2",
    "eras": "SELECT DISTINCT CAST(establishment_year // 10 * 10 AS VARCHAR), '', NULL, NULL::DOUBLE FROM schools_v2 WHERE establishment_year IS NOT NULL",
    "era_relevance": "SELECT CAST(establishment_year // 10 * 10 AS VARCHAR), primary_outcome_cluster, NULL, count(*) FROM schools_v2 WHERE establishment_year IS NOT NULL AND primary_outcome_cluster IS NOT NULL GROUP BY 1, 2",
    "traits": "SELECT DISTINCT category, '', NULL, NULL::DOUBLE FROM team_c1_gf WHERE category IS NOT NULL",
    "archetypes": "SELECT archetype_label, '', NULL, count(*) FROM schools_v2 WHERE archetype_label IS NOT NULL GROUP BY 1",
    "philosophy": "SELECT school_id, philosophy_type, arg_max(substr(text_full, 1, 300), id), NULL::DOUBLE FROM school_philosophy_v2 WHERE school_id IS NOT NULL AND philosophy_type IS NOT NULL AND text_full IS NOT NULL GROUP BY 1, 2",
    "alumni_by_category": "SELECT category, '', NULL, count(*) FROM team_c1_gf WHERE category IS NOT NULL GROUP BY 1",
    "alumni_top_schools": "SELECT matched_school_id, '', NULL, n FROM (SELECT matched_school_id, count(*) AS n FROM team_c1_gf WHERE matched_school_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)",
}
_NAMED = {name: f"SELECT '{name}' AS section, * FROM ({sql}) AS {name}(k1, k2, text, number)" for name, sql in _SECTIONS_SQL.items()}


def cube_sections(spark, folder):
    """(section, k1, k2, text, number) of every section of the cube."""
    s, p, d, g, b = (table(spark, folder, t) for t in ("schools_v2", "school_philosophy_v2", "team_d1_stats", "team_c1_gf", "team_b2_students"))
    none, era = F.lit(None), (F.floor(F.col("establishment_year") / 10) * 10).cast("string")

    def section(name, df, k1, k2=None, text=none, number=none):
        return df.select(F.lit(name).alias("section"), k1.alias("k1"), (F.lit("") if k2 is None else k2).alias("k2"), text.cast("string").alias("text"), number.cast("double").alias("number"))

    def one(name, label, df, value):
        return section(name, df.agg(value.alias("n")), F.lit(label), number=F.col("n"))

    def counted(name, df, *keys):
        known = df
        for k in keys:
            known = known.filter(k.isNotNull())
        n = known.groupBy(*(k.alias(f"key{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("n"))
        return section(name, n, F.col("key0"), F.col("key1") if len(keys) > 1 else None, number=F.col("n"))

    listed = lambda name, df, k: section(name, df.filter(k.isNotNull()).select(k.alias("k")).distinct(), F.col("k"))
    stats = d.filter("school_id IS NOT NULL AND stat_name IS NOT NULL AND stat_value IS NOT NULL").groupBy("school_id", "stat_name").agg(F.round(F.avg("stat_value"), 6).alias("n"))
    texts = p.filter("school_id IS NOT NULL AND philosophy_type IS NOT NULL AND text_full IS NOT NULL").groupBy("school_id", "philosophy_type").agg(F.max_by(F.substring("text_full", 1, 300), "id").alias("x"))
    names = s.groupBy("id").agg(F.min("name_ja").alias("x"), F.min("establishment_year").alias("n"))
    top = g.filter("matched_school_id IS NOT NULL").groupBy("matched_school_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "matched_school_id").limit(15)
    primary, secondary = F.col("primary_outcome_cluster"), F.col("secondary_outcome_cluster")
    parts = [
        one("meta", "schools", s, F.count("*")),
        one("meta", "records", d, F.count("*")),
        one("progress", "with_url", s, F.count_distinct(F.when(F.col("homepage_url") != "", F.col("id")))),
        one("progress", "philosophies", p, F.count("*")),
        one("progress", "voices", b, F.count("*")),
        one("progress", "covered", b, F.count_distinct("school_id")),
        section("schools", names, F.col("id"), text=F.col("x"), number=F.col("n")),
        listed("culture_dims", d, F.col("stat_name")),
        section("culture_scores", stats, F.col("school_id"), F.col("stat_name"), number=F.col("n")),
        counted("outcome_clusters", s, primary),
        counted("outcome_dims", s, primary, secondary),
        listed("eras", s, era),
        counted("era_relevance", s, era, primary),
        listed("traits", g, F.col("category")),
        counted("archetypes", s, F.col("archetype_label")),
        section("philosophy", texts, F.col("school_id"), F.col("philosophy_type"), text=F.col("x")),
        counted("alumni_by_category", g, F.col("category")),
        section("alumni_top_schools", top, F.col("matched_school_id"), number=F.col("n")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("export_sections", " UNION ALL ".join(_NAMED.values()))
def export_sections(spark, folder):
    """All sections of the cube in long form; files.write_cube makes one script of them."""
    return cube_sections(spark, folder)


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("cluster_period_pivot", "SELECT year(o_orderdate) AS y, " + ", ".join(f"coalesce(round(avg(o_totalprice) FILTER (WHERE c_mktsegment = '{s}'), 6), 0) AS {s.lower()}" for s in _SEGMENTS) + " FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def cluster_period_pivot(spark, folder):
    """Means per period as one column per cluster, a missing one being 0."""
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    wide = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.year("o_orderdate").alias("y")).pivot("c_mktsegment", _SEGMENTS).agg(F.round(F.avg("o_totalprice"), 6)).na.fill(0.0)
    return wide.select("y", *(F.col(s).alias(s.lower()) for s in _SEGMENTS))


@query(
    "faceted_with_dimensions",
    "WITH top AS (SELECT stat_name FROM team_d1_stats WHERE stat_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3), d AS (SELECT school_id, count(*) AS n_stats, count(DISTINCT stat_name) AS n_dims, count(DISTINCT CASE WHEN stat_name IN (SELECT stat_name FROM top) THEN stat_name END) AS n_top FROM team_d1_stats WHERE stat_value IS NOT NULL GROUP BY 1) "
    "SELECT s.id, s.name, coalesce(d.n_stats, 0) AS n_stats, coalesce(d.n_dims, 0) AS n_dims, coalesce(d.n_top, 0) AS n_top FROM (SELECT id, min(name_ja) AS name FROM schools_v2 WHERE gender_type = 'coed' GROUP BY 1) s LEFT JOIN d ON d.school_id = s.id",
)
def faceted_with_dimensions(spark, folder):
    """Schools of a facet with what their dimensions hold."""
    s, d = table(spark, folder, "schools_v2"), table(spark, folder, "team_d1_stats")
    top = d.filter("stat_name IS NOT NULL").groupBy("stat_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "stat_name").limit(3).select("stat_name", F.lit(True).alias("is_top"))
    per = d.filter("stat_value IS NOT NULL").join(F.broadcast(top), "stat_name", "left")  # three rows
    per = per.groupBy("school_id").agg(F.count("*").alias("n_stats"), F.count_distinct("stat_name").alias("n_dims"), F.count_distinct(F.when(F.col("is_top"), F.col("stat_name"))).alias("n_top"))
    named = s.filter("gender_type = 'coed'").groupBy("id").agg(F.min("name_ja").alias("name"))
    return named.join(per, named.id == per.school_id, "left").select("id", "name", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_stats", "n_dims", "n_top")))


@query(
    "short_names_with_stops",
    "SELECT short, min(id) AS key FROM (SELECT DISTINCT id, regexp_replace(name_ja, '(?:中学校|中等部|中等教育学校)$', '') AS short FROM schools_v2) WHERE length(short) >= 4 AND NOT regexp_matches(short, '女学院|国際|^聖') GROUP BY 1 HAVING count(DISTINCT id) = 1",
)
def short_names_with_stops(spark, folder):
    """Short names of four characters or more that stand for one school and hold no word that many bear."""
    from loomtable.operators.resolve import unique_short_names

    found = unique_short_names(table(spark, folder, "schools_v2"), "id", "name_ja", ["中学校", "中等部", "中等教育学校"], 4)
    return found.filter(~F.col("short").rlike("女学院|国際|^聖"))


_BLOBS = [("team_c1_gf", "evidence_text"), ("team_b2_students", "quote_text"), ("team_c_llm_students", "quote_text"), ("team_c_llm_principal_round4", "quote_text")]


@query(
    "blobs_of_four_tables",
    "SELECT school_id, count(*) AS n_parts, CAST(sum(length(part)) AS BIGINT) AS n_chars, md5(string_agg(part, ' ' ORDER BY k, record_id)) AS digest FROM ("
    + " UNION ALL ".join(f"SELECT {'matched_school_id' if t == 'team_c1_gf' else 'school_id'} AS school_id, {k} AS k, record_id, {c} AS part FROM {t}" for k, (t, c) in enumerate(_BLOBS))
    + ") WHERE part IS NOT NULL AND school_id IS NOT NULL GROUP BY 1",
)
def blobs_of_four_tables(spark, folder):
    """What four tables say of a school, joined in order; the digest stands for the text."""
    parts = None
    for k, (t, c) in enumerate(_BLOBS):
        part = table(spark, folder, t).select(F.col("matched_school_id" if t == "team_c1_gf" else "school_id").alias("school_id"), F.lit(k).alias("k"), "record_id", F.col(c).alias("part"))
        parts = part if parts is None else parts.unionByName(part)
    known = parts.filter("part IS NOT NULL AND school_id IS NOT NULL")
    ordered = F.array_sort(F.collect_list(F.struct("k", "record_id", "part")))  # a blob is one value of its school
    return known.groupBy("school_id").agg(F.count("*").alias("n_parts"), F.sum(F.length("part")).alias("n_chars"), F.md5(F.array_join(F.transform(ordered, lambda x: x.part), " ")).alias("digest"))


# ---- models

_FIXED = "wide AS (SELECT user_id, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{c}') AS \"{c}\"" for c in _ITEMS) + " FROM events GROUP BY 1), f AS (SELECT * FROM wide WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in _ITEMS) + ")"


@query(
    "binarised_above_50",
    f"WITH {_FIXED}, c AS (SELECT " + ", ".join(f'CASE WHEN avg(("{c}" > 50)::INT) BETWEEN 0.02 AND 0.98 THEN 50 ELSE median("{c}") END AS "c_{c}"' for c in _ITEMS) + " FROM f) SELECT user_id, " + ", ".join(f'("{c}" > "c_{c}")::INT AS "{c}"' for c in _ITEMS) + " FROM f, c",
)
def binarised_above_50(spark, folder):
    """1 above 50; an item that almost all or almost none pass is split at its median instead."""
    wide = table(spark, folder, "events").groupBy("user_id").pivot("event_type", _ITEMS).agg(F.avg("value")).na.drop()
    shares = wide.agg(*(F.avg((F.col(c) > 50).cast("int")).alias(f"p_{c}") for c in _ITEMS))  # one row
    cuts = shares.crossJoin(order_statistics(wide, _ITEMS, [0.5])).select(*(F.when(F.col(f"p_{c}").between(0.02, 0.98), 50.0).otherwise(F.col(f"{c}_0")).alias(f"c_{c}") for c in _ITEMS))
    return wide.crossJoin(F.broadcast(cuts)).select("user_id", *((F.col(c) > F.col(f"c_{c}")).cast("int").alias(c) for c in _ITEMS))


@query("item_information")
def item_information(spark, folder):
    """Information of each item and of the test at 61 abilities from -3 to 3."""
    u, n = irt.patterns(answers(spark, folder), _ITEMS)
    f = irt.fit(u, n)
    theta = np.linspace(-3, 3, 61)
    p = irt.probability(theta, f["a"], f["b"])
    each = f["a"] ** 2 * p * (1 - p)
    return spark.createDataFrame([(round(float(t), 6), *(round(float(x), 6) for x in row), round(float(row.sum()), 6)) for t, row in zip(theta, each)], "theta double, " + ", ".join(f"{c} double" for c in _ITEMS) + ", test double")


_CELL5 = "sum(f * u) AS a, sum(f * (1 - u)) AS b, sum((1 - f) * u) AS c, sum((1 - f) * (1 - u)) AS d"
_SCORE = " + ".join(f'"{c}"' for c in _ITEMS)


@query(
    "functioning_by_ability_bin",
    f"WITH {_ANSWERS}, s AS (SELECT *, CAST(least(floor(({_SCORE}) * 5 / {len(_ITEMS) + 1}), 4) AS INTEGER) AS bin FROM ans), lng AS (" + " UNION ALL ".join(f"SELECT user_id, bin, '{c}' AS item, \"{c}\" AS u FROM s" for c in _ITEMS) + f"), cells AS (SELECT item, bin, {_CELL5} FROM (SELECT *, (user_id % 2 = 0)::INT AS f FROM lng) GROUP BY 1, 2), "
    "t AS (SELECT item, sum(a * d / (a + b + c + d)::DOUBLE) AS num, sum(b * c / (a + b + c + d)::DOUBLE) AS den FROM cells WHERE a + b + c + d >= 2 GROUP BY 1) SELECT item, round(CASE WHEN num > 0 AND den > 0 THEN num / den END, 6) AS odds_ratio FROM t",
)
def functioning_by_ability_bin(spark, folder):
    """Odds ratios of even against odd users within five bins of the ability that the score stands for."""
    a = answers(spark, folder)
    score = sum((F.col(c) for c in _ITEMS[1:]), F.col(_ITEMS[0]))
    items = F.explode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).alias("u")) for c in _ITEMS)))
    long = a.select((F.col("user_id") % 2 == 0).alias("focal"), F.least(F.floor(score * 5 / (len(_ITEMS) + 1)), F.lit(4)).cast("int").alias("bin"), items.alias("x")).select("focal", "bin", "x.item", "x.u")
    return irt.mantel_haenszel(long, "item", "u", "focal", "bin").select("item", "odds_ratio")


_MODES = {"gone": ["A", "R"], "kept": ["N"]}
_BUCKET = "CASE " + " ".join(f"WHEN l_returnflag IN ({', '.join(repr(m) for m in ms)}) THEN '{b}'" for b, ms in _MODES.items()) + " END"


@query(
    "factor_inputs",
    f"WITH b AS (SELECT l_suppkey, {_BUCKET} AS b FROM lineitem), w AS (SELECT l_suppkey, " + ", ".join(f"count(*) FILTER (WHERE b = '{m}') AS n_{m}" for m in _MODES) + " FROM b GROUP BY 1), j AS (SELECT s_suppkey, s_acctbal, w.* FROM supplier JOIN w ON l_suppkey = s_suppkey WHERE " + " + ".join(f"n_{m}" for m in _MODES) + " > 0), "
    "x AS (SELECT s_suppkey, " + ", ".join(f"ln(1 + n_{m}) AS {m}" for m in _MODES) + " FROM j), z AS (SELECT " + ", ".join(f"avg({m}) AS m_{m}, stddev_pop({m}) AS d_{m}" for m in _MODES) + " FROM x) "
    "SELECT s_suppkey, " + ", ".join(f"round(CASE WHEN d_{m} > 1e-12 THEN ({m} - m_{m}) / d_{m} ELSE 0 END, 5) AS {m}" for m in _MODES) + " FROM x, z",
)
def factor_inputs(spark, folder):
    """Inputs of a factor model: kinds in buckets, counted per unit in a column each, joined, positive ones kept, log1p, standardised."""
    l, s = table(spark, folder, "lineitem"), table(spark, folder, "supplier")  # noqa: E741
    bucket = F.coalesce(*(F.when(F.col("l_returnflag").isin(ms), b) for b, ms in _MODES.items()))
    wide = l.groupBy("l_suppkey").agg(*(F.count_if(bucket == m).alias(f"n_{m}") for m in _MODES))
    joined = s.join(wide, s.s_suppkey == wide.l_suppkey).filter(" + ".join(f"n_{m}" for m in _MODES) + " > 0").select("s_suppkey", *(F.log1p(f"n_{m}").alias(m) for m in _MODES))
    moments = joined.agg(*(F.avg(m).alias(f"m_{m}") for m in _MODES), *(F.stddev_pop(m).alias(f"d_{m}") for m in _MODES))  # one row
    z = joined.crossJoin(F.broadcast(moments))
    return z.select("s_suppkey", *(F.round(F.when(F.col(f"d_{m}") > 1e-12, (F.col(m) - F.col(f"m_{m}")) / F.col(f"d_{m}")).otherwise(0.0), 5).alias(m) for m in _MODES))


@query("cluster_portraits")
def cluster_portraits(spark, folder):
    """Of each cluster: size, three most frequent labels, first five members, and its center."""
    e = table(spark, folder, "embeddings")
    centers, _ = kmeans.fit(e, "embedding", kmeans.initial_centers(e, "vec_id", "embedding", 8))
    c = kmeans.assign(e, "vec_id", "embedding", centers).join(e.select("vec_id", "label"), "vec_id")
    labels = top_per_group(c.groupBy("cluster", "label").agg(F.count("*").alias("k")), ["cluster"], [F.desc("k"), "label"], 3)
    labels = labels.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), "label"))), lambda x: x.label).alias("top_labels"))  # three
    members = top_per_group(c, ["cluster"], ["vec_id"], 5).groupBy("cluster").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))  # five
    middle = spark.createDataFrame([(k, [round(float(x), 6) for x in row]) for k, row in enumerate(centers)], "cluster int, center array<double>")
    return c.groupBy("cluster").agg(F.count("*").alias("n")).join(labels, "cluster").join(members, "cluster").join(F.broadcast(middle), "cluster")
