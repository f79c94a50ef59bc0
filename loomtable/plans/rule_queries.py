"""Rule engines over the school tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.operators import rules as R
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_TOPICS = [("club", "部|大会|練習"), ("class", "授業|問題|発表"), ("place", "図書館|体育館|礼拝堂|中庭"), ("future", "将来|進路|卒業")]


def _case(column: str, rules, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '(?i){p}') THEN '{label}'" for label, p in rules) + f" ELSE {default} END"


def _has(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, '(?i){pattern}'), false)"


@query("first_match", f"SELECT record_id, {_case('quote_text', _TOPICS, chr(39) + 'other' + chr(39))} AS topic FROM team_b2_students")
def first_match(spark, folder):
    return table(spark, folder, "team_b2_students").select("record_id", R.first_pattern(F.col("quote_text"), _TOPICS, "other").alias("topic"))


_SLUGS = [("class", "class"), ("club", "club"), ("future", "alumni")]


@query("priority_cascade", f"SELECT record_id, coalesce({_case('quote_text', _TOPICS[:2])}, {_case('context', [('school', '学校'), ('event', '式|祭')])}, {_case('source_url', _SLUGS)}, 'none') AS topic FROM team_c_llm_principal_round4")
def priority_cascade(spark, folder):
    c = [F.col(x) for x in ("quote_text", "context", "source_url")]
    topic = R.cascade([(c[0], _TOPICS[:2]), (c[1], [("school", "学校"), ("event", "式|祭")]), (c[2], _SLUGS)], "none")
    return table(spark, folder, "team_c_llm_principal_round4").select("record_id", topic.alias("topic"))


_ROLES = [("student_current", "所属|授業で|寮生活"), ("student_current", "練習"), ("student_alumni", "卒業して|たった今"), ("student_alumni", "働く")]
_CUR = " + ".join(f"CAST({_has('quote_text', p)} AS INTEGER)" for label, p in _ROLES if label == "student_current")
_ALU = " + ".join(f"CAST({_has('quote_text', p)} AS INTEGER)" for label, p in _ROLES if label == "student_alumni")


@query(
    "vote_refine",
    f"SELECT record_id, CASE WHEN a = 0 AND b = 0 OR a + g1 = b + g2 THEN speaker_role WHEN a + g1 > b + g2 THEN 'student_current' ELSE 'student_alumni' END AS label, CASE WHEN a = 0 AND b = 0 THEN 'kept' WHEN a + g1 = b + g2 THEN 'ambiguous' WHEN (a + g1 > b + g2) = (speaker_role = 'student_current') THEN 'confirmed' ELSE 'reclassified' END AS outcome FROM (SELECT *, {_CUR} AS a, {_ALU} AS b, CAST(speaker_role = 'student_current' AS INTEGER) AS g1, CAST(speaker_role = 'student_alumni' AS INTEGER) AS g2 FROM team_b2_students)",
)
def vote_refine(spark, folder):
    rows = table(spark, folder, "team_b2_students").withColumn("v", R.voted(F.col("speaker_role"), F.col("quote_text"), _ROLES))
    return rows.select("record_id", "v.label", "v.outcome")


@query(
    "multi_label",
    "SELECT record_id, unnest(CASE WHEN len(h) > 0 THEN h ELSE ['none'] END) AS label FROM (SELECT record_id, list_filter([" + ", ".join(f"CASE WHEN {_has('quote_text', p)} THEN '{label}' END" for label, p in _TOPICS) + "], lambda x: x IS NOT NULL) AS h FROM team_b2_students)",
)
def multi_label(spark, folder):
    rows = table(spark, folder, "team_b2_students")
    return rows.select("record_id", F.explode(R.all_matches(F.col("quote_text"), _TOPICS, "none")).alias("label"))


@query(
    "additive_score",
    f"SELECT record_id, CASE WHEN length(quote_text) BETWEEN 40 AND 120 THEN 3 ELSE 0 END + CASE WHEN {_has('quote_text', '私|僕')} THEN 2 ELSE 0 END + CASE WHEN coalesce(quote_text LIKE '%ます。', false) THEN 1 ELSE 0 END AS score FROM team_b2_students",
)
def additive_score(spark, folder):
    t = F.col("quote_text")
    score = R.additive([(F.length(t).between(40, 120), 3), (R.matches(t, "私|僕"), 2), (F.coalesce(t.like("%ます。"), F.lit(False)), 1)])
    return table(spark, folder, "team_b2_students").select("record_id", score.alias("score"))


def _hits(column: str, terms) -> str:
    return "(" + " + ".join(f"CAST(coalesce(contains({column}, '{t}'), false) AS INTEGER)" for t in terms) + ")"


_AXES = [["授業", "理科", "数学"], ["先生", "先輩", "仲間"], ["将来", "進路"]]


@query("gated_score", "SELECT record_id, CASE WHEN a = 0 OR b = 0 THEN 0 ELSE a + b + c END AS score FROM (SELECT record_id, " + ", ".join(f"{_hits('quote_text', t)} AS {n}" for n, t in zip("abc", _AXES)) + " FROM team_b2_students)")
def gated_score(spark, folder):
    t = F.col("quote_text")
    return table(spark, folder, "team_b2_students").select("record_id", R.gated([R.keyword_hits(t, terms) for terms in _AXES]).alias("score"))


_DIMS = {
    "openness": {"lookups": [{"girls": -3, "coed": 5}, {"full": 6, "attached": 2}], "plus": ["開かれ", "世界"], "minus": ["規律"], "step": 4},
    "tradition": {"lookups": [{"boys": 7, "girls": 4}, {"none": -5}], "plus": ["創立", "伝統", "守り"], "minus": ["変化"], "step": 9},
}


def _dim_sql(name: str, d: dict) -> str:
    looks = " + ".join("CASE " + " ".join(f"WHEN {c} = '{k}' THEN {w}" for k, w in m.items()) + " ELSE 0 END" for c, m in zip(("gender_type", "integrated_type"), d["lookups"]))
    plus, minus = _hits("t", d["plus"]), _hits("t", d["minus"])
    return f"SELECT school_id, '{name}' AS dim, greatest(least(50 + {looks} + {d['step']} * ({plus} - {minus}), 100), 0) AS score, {plus} + {minus} + 2 AS evidence FROM base"


@query(
    "dimension_scores",
    "WITH base AS (SELECT s.id AS school_id, s.gender_type, s.integrated_type, p.t FROM (SELECT id, min(gender_type) AS gender_type, min(integrated_type) AS integrated_type FROM schools_v2 GROUP BY 1) s LEFT JOIN (SELECT school_id, string_agg(text_full, ' | ' ORDER BY id) AS t FROM school_philosophy_v2 GROUP BY 1) p ON p.school_id = s.id) "
    + " UNION ALL ".join(_dim_sql(n, d) for n, d in _DIMS.items()),
)
def dimension_scores(spark, folder):
    schools = table(spark, folder, "schools_v2").groupBy("id").agg(F.min("gender_type").alias("gender_type"), F.min("integrated_type").alias("integrated_type"))
    # whether a term occurs is a maximum over texts: nothing is concatenated or sorted
    texts = table(spark, folder, "school_philosophy_v2")
    terms = sorted({t for d in _DIMS.values() for t in d["plus"] + d["minus"]})
    said = texts.groupBy("school_id").agg(F.array_join(F.array_compact(F.array(*(F.when(F.max(F.contains("text_full", F.lit(t))), t) for t in terms))), "|").alias("t"))
    rows = schools.join(said, schools.id == said.school_id, "left")
    scores = R.dimension_scores(50, [F.col("gender_type"), F.col("integrated_type")], F.col("t"), _DIMS)
    return rows.select(F.col("id").alias("school_id"), F.explode(scores).alias("s")).select("school_id", "s.dim", "s.score", "s.evidence")


@query(
    "primary_secondary",
    "SELECT row_id, list_sort([(-a, 0, 'size'), (-b, 1, 'age'), (-c, 2, 'web')])[1][3] AS best, list_sort([(-a, 0, 'size'), (-b, 1, 'age'), (-c, 2, 'web')])[2][3] AS second FROM (SELECT row_id, coalesce(data_completeness_v2, 0) AS a, coalesce((2000 - establishment_year) // 2, 0) AS b, CASE WHEN homepage_url IS NULL THEN 0 ELSE 50 END AS c FROM schools_v2)",
)
def primary_secondary(spark, folder):
    scores = {"size": F.coalesce("data_completeness_v2", F.lit(0)), "age": F.coalesce(F.expr("(2000 - establishment_year) div 2"), F.lit(0)).cast("int"), "web": F.when(F.col("homepage_url").isNull(), 0).otherwise(50)}
    order = R.ranked(scores)
    return table(spark, folder, "schools_v2").select("row_id", order[0].alias("best"), order[1].alias("second"))


@query("joined_labels", "SELECT row_id, concat_ws('/', gender_type, religious_affiliation, integrated_type) AS label FROM schools_v2")
def joined_labels(spark, folder):
    return table(spark, folder, "schools_v2").select("row_id", F.concat_ws("/", "gender_type", "religious_affiliation", "integrated_type").alias("label"))


def _checks():
    t = F.col("quote_text")
    return [
        ("length", "critical", "quote_text", F.coalesce(F.length(t), F.lit(0)) < 20),
        ("length", "warning", "quote_text", F.length(t) > 300),
        ("source", "critical", "source_url", F.col("source_url").isNull() & F.col("source_id").isNull()),
        ("rights", "warning", "rights_level", ~F.col("rights_level").isin("anonymized_only", "quoted_with_attribution")),
        ("summary", "info", "quote_summary", F.col("quote_summary").isNull()),
    ]


_CHECKS = [
    ("length", "critical", "quote_text", "coalesce(length(quote_text), 0) < 20"),
    ("length", "warning", "quote_text", "length(quote_text) > 300"),
    ("source", "critical", "source_url", "source_url IS NULL AND source_id IS NULL"),
    ("rights", "warning", "rights_level", "rights_level NOT IN ('anonymized_only', 'quoted_with_attribution')"),
    ("summary", "info", "quote_summary", "quote_summary IS NULL"),
]


@query("gate_issues", " UNION ALL ".join(f"SELECT record_id, '{n}' AS \"check\", '{s}' AS severity, '{f}' AS field FROM team_b2_students WHERE {w}" for n, s, f, w in _CHECKS))
def gate_issues(spark, folder):
    rows = table(spark, folder, "team_b2_students").select("record_id", F.explode(R.issues(_checks())).alias("i"))
    return rows.select("record_id", "i.check", "i.severity", "i.field")


_CRITICAL = " OR ".join(f"coalesce({w}, false)" for _, s, _, w in _CHECKS if s == "critical")
_ANY = " OR ".join(f"coalesce({w}, false)" for *_, w in _CHECKS)


@query(
    "gate_summary",
    f"SELECT source_type, count(*) AS n, count(*) FILTER (WHERE s = 'approved') AS approved, count(*) FILTER (WHERE s = 'flagged') AS flagged, count(*) FILTER (WHERE s = 'rejected') AS rejected, round(count(*) FILTER (WHERE s = 'approved') / count(*), 6) AS rate FROM (SELECT *, CASE WHEN {_CRITICAL} THEN 'rejected' WHEN {_ANY} THEN 'flagged' ELSE 'approved' END AS s FROM team_b2_students) GROUP BY 1",
)
def gate_summary(spark, folder):
    rows = table(spark, folder, "team_b2_students").withColumn("s", R.status_of(R.issues(_checks())))
    out = rows.groupBy("source_type").agg(F.count("*").alias("n"), *(F.count_if(F.col("s") == x).alias(x) for x in ("approved", "flagged", "rejected")))
    return out.withColumn("rate", F.round(F.col("approved") / F.col("n"), 6))


@query(
    "load_gate",
    "SELECT record_id, CASE WHEN quote_text IS NULL OR length(quote_text) < 30 THEN 'too short' WHEN length(quote_text) > 150 THEN 'too long' WHEN source_url IS NULL AND source_id IS NULL THEN 'no source' WHEN rights_level = 'archive_only' THEN 'rights' WHEN r > 1 THEN 'duplicate' ELSE 'ok' END AS reason FROM (SELECT *, row_number() OVER (PARTITION BY school_id, substr(quote_text, 1, 80), (quote_text IS NULL OR length(quote_text) < 30 OR length(quote_text) > 150 OR (source_url IS NULL AND source_id IS NULL) OR coalesce(rights_level = 'archive_only', false)) ORDER BY record_id) AS r FROM team_b2_students)",
)
def load_gate(spark, folder):
    """First failing reason; duplicates are sought among the rows that pass all else."""
    from loomtable.operators.dedup import mark_duplicates

    t = F.col("quote_text")
    reason = R.first_reason(
        [("too short", t.isNull() | (F.length(t) < 30)), ("too long", F.length(t) > 150), ("no source", F.col("source_url").isNull() & F.col("source_id").isNull()), ("rights", F.col("rights_level") == "archive_only")]
    )
    rows = table(spark, folder, "team_b2_students").withColumn("reason", reason)
    good = mark_duplicates(rows.filter("reason = 'ok'").withColumn("head", F.substring("quote_text", 1, 80)), ["school_id", "head"], ["record_id"])
    again = good.select("record_id", F.when(F.col("is_duplicate"), "duplicate").otherwise("ok").alias("reason"))
    return rows.filter("reason <> 'ok'").select("record_id", "reason").unionByName(again)


@query(
    "audit_chain",
    "SELECT doc_id, CASE WHEN coalesce(length(text), 0) < 30 THEN 'rejected_length' WHEN hira + latin < 0.3 THEN 'garbled' WHEN regexp_matches(text, '(?i)not found|エラー') THEN 'error' WHEN regexp_matches(text, '(?i)lorem|ダミー') THEN 'dummy' ELSE 'approved' END AS status FROM (SELECT *, (length(text) - length(regexp_replace(text, '[ぁ-んァ-ヶー]', '', 'g'))) / greatest(length(text), 1) AS hira, (length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g'))) / greatest(length(text), 1) AS latin FROM documents)",
)
def audit_chain(spark, folder):
    from loomtable.functions.text import class_share

    t = F.col("text")
    status = R.first_reason(
        [
            ("rejected_length", F.coalesce(F.length(t), F.lit(0)) < 30),
            ("garbled", class_share(t, "ぁ-んァ-ヶー") + class_share(t, "A-Za-z") < 0.3),
            ("error", R.matches(t, "not found|エラー")),
            ("dummy", R.matches(t, "lorem|ダミー")),
        ],
        "approved",
    )
    return table(spark, folder, "documents").select("doc_id", status.alias("status"))


_MASKS = [("[0-9]{4}年", "<year>"), ("(?:中学|高校)[1-3１-３]?年", "<grade>"), ("[ァ-ヶー]{2,}部", "<club>"), ("第[0-9]+期", "<cohort>")]


@query(
    "pattern_masks",
    "SELECT record_id, t4 AS masked, array_to_string(list_filter([" + ", ".join(f"CASE WHEN t{k} <> t{k - 1} THEN '{to}' END" for k, (_, to) in enumerate(_MASKS, 1)) + "], lambda x: x IS NOT NULL), ',') AS changed FROM (SELECT *, "
    + "regexp_replace(t3, '" + _MASKS[3][0] + "', '<cohort>', 'g') AS t4 FROM (SELECT *, regexp_replace(t2, '" + _MASKS[2][0] + "', '<club>', 'g') AS t3 FROM (SELECT *, regexp_replace(t1, '" + _MASKS[1][0] + "', '<grade>', 'g') AS t2 FROM (SELECT record_id, t0, regexp_replace(t0, '" + _MASKS[0][0] + "', '<year>', 'g') AS t1 FROM (SELECT record_id, coalesce(speaker_attribute, '') || '。' || quote_text AS t0 FROM team_b2_students)))))",
)
def pattern_masks(spark, folder):
    text = F.concat(F.coalesce("speaker_attribute", F.lit("")), F.lit("。"), F.col("quote_text"))
    rows = table(spark, folder, "team_b2_students").select("record_id", R.masked(text, _MASKS).alias("m"))
    return rows.select("record_id", F.col("m.text").alias("masked"), F.array_join("m.changed", ",").alias("changed"))


@query("template_salvage", "SELECT record_id FROM team_c_llm_students WHERE substr(quote_text, 1, 20) IN (SELECT substr(quote_text, 1, 20) FROM team_c_llm_students GROUP BY 1 HAVING count(DISTINCT school_id) = 1)")
def template_salvage(spark, folder):
    rows = table(spark, folder, "team_c_llm_students").withColumn("head", F.substring("quote_text", 1, 20))
    own = rows.groupBy("head").agg(F.count_distinct("school_id").alias("n")).filter("n = 1").select("head")
    return rows.join(own, "head", "left_semi").select("record_id")


_RULES = {"balanced": {"click": ">45", "view": ">45"}, "calm": {"error": "<45"}, "keen": {"purchase": ">=55", "signup": "<60"}}


def _rule_sql(p: dict) -> str:
    return " AND ".join(f"coalesce(\"{k}\" {v.rstrip('0123456789.')} {v.lstrip('<>=')}, false)" for k, v in p.items())


@query(
    "threshold_rules",
    "WITH w AS (SELECT user_id, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{e}') AS \"{e}\"" for e in ("click", "view", "error", "purchase", "signup")) + " FROM events GROUP BY 1) " + " UNION ALL ".join(f"SELECT user_id, '{n}' AS rule FROM w WHERE {_rule_sql(p)}" for n, p in _RULES.items()),
)
def threshold_rules(spark, folder):
    scores = table(spark, folder, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("m")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "m"))).alias("s"))
    met = F.array_compact(F.array(*(F.when(R.threshold_rule(F.col("s"), p), n) for n, p in _RULES.items())))
    return scores.select("user_id", F.explode(met).alias("rule"))


@query("pattern_extract", "SELECT record_id, nullif(regexp_extract(evidence_text, '(在籍した|学んだ|卒業した|教鞭をとった|設立に加わった|通った)', 1), '') AS tie, CASE WHEN regexp_matches(evidence_text, '設立に加わった') THEN 'founder' WHEN regexp_matches(evidence_text, '教鞭') THEN 'teacher' WHEN regexp_matches(evidence_text, '在籍|卒業|学んだ|通った') THEN 'student' END AS kind, CASE WHEN regexp_matches(evidence_text, '卒業|設立') THEN 5 WHEN regexp_matches(evidence_text, '教鞭|在籍') THEN 4 ELSE 3 END AS strength FROM team_c1_gf")
def pattern_extract(spark, folder):
    t = F.col("evidence_text")
    return table(spark, folder, "team_c1_gf").select(
        "record_id",
        F.nullif(F.regexp_extract(t, "(在籍した|学んだ|卒業した|教鞭をとった|設立に加わった|通った)", 1), F.lit("")).alias("tie"),
        R.first_pattern(t, [("founder", "設立に加わった"), ("teacher", "教鞭"), ("student", "在籍|卒業|学んだ|通った")]).alias("kind"),
        F.when(R.matches(t, "卒業|設立"), 5).when(R.matches(t, "教鞭|在籍"), 4).otherwise(3).alias("strength"),
    )
