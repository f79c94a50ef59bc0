"""Scalar functions over the school tables and the documents, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.functions import text as X
from loomtable.functions.keys import fold_width
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = ("".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " ").replace("'", "''")
_SPACE = r"[\s\x{00A0}\x{3000}]+"
_PAGE_SQL = """'<html><head><style>p {{color: red}}</style><script>var a = "<p>";</script></head><body><!-- note --><h1>' || coalesce({title}, '') || '</h1><p class="v">' || replace({text}, chr(10), '<br/>') || '</p>&nbsp;</body></html>'"""


def page(title, text):
    """A page around a text, as a crawler would have stored it."""
    return F.concat(
        F.lit('<html><head><style>p {color: red}</style><script>var a = "<p>";</script></head><body><!-- note --><h1>'),
        F.coalesce(title, F.lit("")),
        F.lit('</h1><p class="v">'),
        F.replace(text, F.lit("\n"), F.lit("<br/>")),
        F.lit("</p>&nbsp;</body></html>"),
    )


def page_sql(title: str, text: str) -> str:
    return _PAGE_SQL.format(title=title, text=text)


@query("fold_width", f"SELECT row_id, translate(name_ja, '{_WIDE}', '{_NARROW}') AS folded FROM schools_v2")
def fold_width_(spark, folder):
    return table(spark, folder, "schools_v2").select("row_id", fold_width(F.col("name_ja")).alias("folded"))


@query("collapse_space", f"SELECT doc_id, trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' ') AS collapsed FROM documents")
def collapse_space(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.collapse_space(F.col("text")).alias("collapsed"))


_STRIP = f"trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>|&[A-Za-z#0-9]+;', ' ', 'g'), '{_SPACE}', ' ', 'g'), ' ')"


@query("html_strip", f"SELECT id, {_STRIP} AS body FROM (SELECT id, {page_sql('philosophy_type', 'text_full')} AS html FROM school_philosophy_v2)")
def html_strip(spark, folder):
    html = page(F.col("philosophy_type"), F.col("text_full"))
    return table(spark, folder, "school_philosophy_v2").select("id", X.strip_html(html).alias("body"))


_SENTENCES = "list_filter(list_transform(regexp_split_to_array(regexp_replace({0}, '([。.!?！？]+)', '\\1' || chr(1), 'g'), '[' || chr(1) || chr(10) || ']'), lambda s: trim(s, ' ')), lambda s: s <> '')"


@query("sentence_split", f"SELECT record_id, CAST(i AS INTEGER) AS pos, s AS sentence FROM (SELECT record_id, unnest({_SENTENCES.format('quote_text')}) AS s, generate_subscripts({_SENTENCES.format('quote_text')}, 1) - 1 AS i FROM team_b2_students)")
def sentence_split(spark, folder):
    quotes = table(spark, folder, "team_b2_students")
    return quotes.select("record_id", F.posexplode(X.sentences(F.col("quote_text"))).alias("pos", "sentence"))


@query(
    "sentence_profile",
    f"SELECT source, count(*) AS n_sentences, min(length(s)) AS shortest, max(length(s)) AS longest, round(avg(length(s)), 8) AS mean_length FROM (SELECT source, unnest({_SENTENCES.format('text')}) AS s FROM documents) GROUP BY 1",
)
def sentence_profile(spark, folder):
    parts = table(spark, folder, "documents").select("source", F.explode(X.sentences(F.col("text"))).alias("s"))
    n = F.length("s")
    return parts.groupBy("source").agg(F.count("*").alias("n_sentences"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.round(F.avg(n), 8).alias("mean_length"))


def _mark_sql(head: str, marks: str) -> str:
    return "greatest(" + ", ".join(f"CASE WHEN instr({head}, '{m}') > 0 THEN length({head}) - instr(reverse({head}), '{m}') + 1 ELSE 0 END" for m in marks) + ")"


@query(
    "cut_at_mark",
    f"SELECT doc_id, CASE WHEN length(text) <= 120 THEN text WHEN {_mark_sql('h', '。.!?')} > 60 THEN substr(h, 1, {_mark_sql('h', '。.!?')}) ELSE h || '…' END AS cut FROM (SELECT doc_id, text, substr(text, 1, 120) AS h FROM documents WHERE regexp_matches(coalesce(text, ''), '^[ぁ-んァ-ヶ一-龠々ーA-Za-z0-9 、。「」,.!?\\n]*$'))",
)
def cut_at_mark(spark, folder):
    docs = table(spark, folder, "documents").filter(F.coalesce("text", F.lit("")).rlike(r"^[ぁ-んァ-ヶ一-龠々ーA-Za-z0-9 、。「」,.!?\n]*\z"))
    return docs.select("doc_id", X.cut_at_mark(F.col("text"), 120, 60).alias("cut"))


@query(
    "summary_cut",
    f"SELECT record_id, CASE WHEN length(quote_text) <= 50 THEN quote_text WHEN {_mark_sql('h', '。、')} > 20 THEN substr(h, 1, {_mark_sql('h', '。、')}) ELSE h END AS with_mark, CASE WHEN length(quote_text) <= 50 THEN quote_text WHEN {_mark_sql('h', '。、')} > 20 THEN substr(h, 1, {_mark_sql('h', '。、')} - 1) ELSE h END AS without_mark FROM (SELECT record_id, quote_text, substr(quote_text, 1, 50) AS h FROM team_b2_students)",
)
def summary_cut(spark, folder):
    t = F.col("quote_text")
    return table(spark, folder, "team_b2_students").select("record_id", X.summary(t).alias("with_mark"), X.summary(t, keep_mark=False).alias("without_mark"))


@query("shortened", f"SELECT doc_id, CASE WHEN length(t) <= 40 THEN t ELSE substr(t, 1, 37) || '...' END AS short FROM (SELECT doc_id, trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' ') AS t FROM documents)")
def shortened(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.shortened(F.col("text"), 40).alias("short"))


@query("context_snippet", "SELECT record_id, substr(evidence_text, greatest(p - 10, 1), p + length('創立') + 20 - greatest(p - 10, 1)) AS snippet FROM (SELECT record_id, evidence_text, instr(evidence_text, '創立') AS p FROM team_c1_gf) WHERE p > 0")
def context_snippet(spark, folder):
    found = table(spark, folder, "team_c1_gf").select("record_id", X.around(F.col("evidence_text"), "創立", 10, 20).alias("snippet"))
    return found.filter("snippet IS NOT NULL")


@query(
    "content_keys",
    "SELECT record_id, md5(school_id || '|' || substr(quote_text, 1, 80)) AS head_key, md5(substr(t, 1, 80) || '||' || right(t, 30)) AS ends_key, substr(sha1(quote_text), 1, 16) AS short_sha1, 'anon_' || substr(sha256(CAST(record_id AS VARCHAR)), 1, 16) AS anonymous FROM (SELECT *, regexp_replace(quote_text, '[\\s\\x{3000}]+', '', 'g') AS t FROM team_c_llm_students)",
)
def content_keys(spark, folder):
    t = F.col("quote_text")
    return table(spark, folder, "team_c_llm_students").select(
        "record_id", X.head_key(F.col("school_id"), t, 80).alias("head_key"), X.head_tail_key(t).alias("ends_key"), F.substring(F.sha1(t), 1, 16).alias("short_sha1"), X.anonymous_id(F.col("record_id")).alias("anonymous")
    )


@query("numbers_in_text", "SELECT doc_id, CAST(replace(nullif(regexp_extract(text, '[0-9][0-9,]*(\\.[0-9]+)?'), ''), ',', '') AS DOUBLE) AS number FROM documents WHERE length(nullif(regexp_extract(text, '[0-9][0-9,]*(\\.[0-9]+)?'), '')) < 16")
def numbers_in_text(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", F.regexp_extract("text", r"[0-9][0-9,]*(\.[0-9]+)?", 0).alias("m"))
    return docs.filter("m <> '' AND length(m) < 16").select("doc_id", X.number_in(F.col("text")).alias("number"))


_WEST = "TRY_CAST(regexp_extract(evidence_text, '([0-9]{4})年', 1) AS INTEGER)"
_ERA_SQL = ", ".join(f"TRY_CAST(regexp_extract(evidence_text, '{e}([0-9]{{1,2}})年', 1) AS INTEGER) + {b}" for e, b in X._ERAS.items())


@query("years_in_text", f"SELECT record_id, coalesce(CASE WHEN {_WEST} BETWEEN 1600 AND 2100 THEN {_WEST} END, {_ERA_SQL}) AS founded FROM team_c1_gf")
def years_in_text(spark, folder):
    return table(spark, folder, "team_c1_gf").select("record_id", X.year_in(F.col("evidence_text")).alias("founded"))


_URL_PATH = "regexp_extract(source_url, '^https?://[^/?#]+([^?#]*)', 1)"
_SLUG = f"regexp_replace(regexp_replace(CASE WHEN {_URL_PATH} = '' THEN '/' ELSE {_URL_PATH} END, '\\.[A-Za-z0-9]+$', ''), '[^A-Za-z0-9]+', '_', 'g')"


@query(
    "url_parts",
    f"SELECT record_id, nullif(regexp_extract(source_url, '^https?://([^/?#]+)', 1), '') AS host, CASE WHEN regexp_extract(source_url, '^https?://([^/?#]+)', 1) <> '' THEN CASE WHEN {_URL_PATH} = '' THEN '/' ELSE {_URL_PATH} END END AS path, CASE WHEN regexp_extract(source_url, '^https?://([^/?#]+)', 1) <> '' THEN substr(CASE WHEN length(replace({_SLUG}, '_', '')) = 0 THEN 'index' ELSE regexp_replace({_SLUG}, '^_+|_+$', '', 'g') END, 1, 60) END AS slug FROM team_l1_admission",
)
def url_parts(spark, folder):
    u = F.col("source_url")
    return table(spark, folder, "team_l1_admission").select("record_id", X.url_host(u).alias("host"), X.url_path(u).alias("path"), X.slug(u).alias("slug"))


_LINK_WEIGHTS = {"exam": 3, "admission": 3, "guideline": 2, "index": 1, "html": 1}


@query("link_score", "SELECT record_id, source_url, " + " + ".join(f"CASE WHEN contains(source_url, '{t}') THEN {w} ELSE 0 END" for t, w in _LINK_WEIGHTS.items()) + " AS score FROM team_l1_admission WHERE source_url IS NOT NULL")
def link_score(spark, folder):
    links = table(spark, folder, "team_l1_admission").filter("source_url IS NOT NULL")
    return links.select("record_id", "source_url", X.weighted_terms(F.col("source_url"), _LINK_WEIGHTS).alias("score"))


@query("suffix_strip", "SELECT row_id, regexp_replace(name_ja, '(?:中学校|中等部|中等教育学校)$', '') AS once, regexp_replace(name_ja, '(?:中学校|中等部|学園|学院|女)+$', '') AS every FROM schools_v2")
def suffix_strip(spark, folder):
    n = F.col("name_ja")
    return table(spark, folder, "schools_v2").select(
        "row_id", X.without_suffix(n, ["中学校", "中等部", "中等教育学校"]).alias("once"), X.without_suffix(n, ["中学校", "中等部", "学園", "学院", "女"], True).alias("every")
    )


@query("first_part", "SELECT record_id, regexp_split_to_array(speaker_attribute, '[、。,/／・\\s]')[1] AS part FROM team_b2_students WHERE speaker_attribute IS NOT NULL")
def first_part(spark, folder):
    rows = table(spark, folder, "team_b2_students").filter("speaker_attribute IS NOT NULL")
    return rows.select("record_id", X.first_part(F.col("speaker_attribute")).alias("part"))


@query(
    "class_ratios",
    "SELECT doc_id, round((length(text) - length(regexp_replace(text, '[ぁ-ん]', '', 'g'))) / length(text), 6) AS hiragana, round((length(text) - length(regexp_replace(text, '[一-龠]', '', 'g'))) / length(text), 6) AS ideographs, round((length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g'))) / length(text), 6) AS latin FROM documents WHERE length(text) > 0",
)
def class_ratios(spark, folder):
    docs = table(spark, folder, "documents").filter(F.length("text") > 0)
    return docs.select("doc_id", *(F.round(X.class_share(F.col("text"), c), 6).alias(n) for n, c in (("hiragana", "ぁ-ん"), ("ideographs", "一-龠"), ("latin", "A-Za-z"))))


_SIGNS = {"pipes": "|", "slashes": "/", "dots": "・", "arrows": ">"}


@query(
    "navigation_signs",
    "SELECT doc_id, pipes, slashes, dots, arrows, (pipes >= 4 OR slashes >= 5 OR dots >= 8 OR arrows >= 3) AS is_navigation FROM (SELECT doc_id, " + ", ".join(f"length(text) - length(replace(text, '{s}', '')) AS {n}" for n, s in _SIGNS.items()) + " FROM documents WHERE text IS NOT NULL)",
)
def navigation_signs(spark, folder):
    docs = table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", *(X.occurrences(F.col("text"), s).alias(n) for n, s in _SIGNS.items()))
    return docs.withColumn("is_navigation", F.expr("pipes >= 4 OR slashes >= 5 OR dots >= 8 OR arrows >= 3"))


_TERMS = ["授業", "先輩", "図書館", "大会", "世界", "学び"]


@query(
    "keyword_predicates",
    "SELECT record_id, n AS n_terms, n > 0 AS any_term, n >= 2 AS two_terms, n = 6 AS all_terms FROM (SELECT record_id, " + " + ".join(f"CASE WHEN contains(quote_text, '{t}') THEN 1 ELSE 0 END" for t in _TERMS) + " AS n FROM team_b2_students)",
)
def keyword_predicates(spark, folder):
    rows = table(spark, folder, "team_b2_students").select("record_id", X.distinct_terms(F.col("quote_text"), _TERMS).alias("n_terms"))
    return rows.select("*", *(F.expr(e).alias(a) for a, e in (("any_term", "n_terms > 0"), ("two_terms", "n_terms >= 2"), ("all_terms", "n_terms = 6"))))


@query("like_filters", "SELECT row_id, name_ja FROM schools_v2 WHERE name_ja ILIKE '%学園%' AND id NOT LIKE 'NATIONAL%' AND (notes LIKE '%統合%' OR archetype_label ILIKE 'GIRLS%')")
def like_filters(spark, folder):
    schools = table(spark, folder, "schools_v2")
    name, notes = F.col("name_ja"), F.col("notes")
    return schools.filter(name.ilike("%学園%") & ~F.col("id").like("NATIONAL%") & (notes.like("%統合%") | F.col("archetype_label").ilike("GIRLS%"))).select("row_id", "name_ja")


@query("null_safe_concat", "SELECT id, (philosophy_type || ' ' || coalesce(text_summary, '')) AS loose, (philosophy_type || ' ' || text_summary) AS strict FROM school_philosophy_v2")
def null_safe_concat(spark, folder):
    rows = table(spark, folder, "school_philosophy_v2")
    kind, short = F.col("philosophy_type"), F.col("text_summary")
    return rows.select("id", F.concat(kind, F.lit(" "), F.coalesce(short, F.lit(""))).alias("loose"), F.concat(kind, F.lit(" "), short).alias("strict"))


@query("length_band", "SELECT speaker_role, count(*) AS n_kept FROM team_b2_students WHERE length(quote_text) BETWEEN 30 AND 400 GROUP BY 1")
def length_band(spark, folder):
    rows = table(spark, folder, "team_b2_students").filter(F.length("quote_text").between(30, 400))
    return rows.groupBy("speaker_role").agg(F.count("*").alias("n_kept"))


@query("json_parts", "SELECT record_id, TRY_CAST(json_extract_string(j, '$.total_points') AS INTEGER) AS total_points, coalesce(json_array_length(j, '$.subjects'), 0) AS n_subjects, json_extract_string(j, '$.exam_dates[0]') AS first_date FROM (SELECT record_id, TRY_CAST(scoring_summary AS JSON) AS j FROM team_l1_admission) WHERE j IS NOT NULL")
def json_parts(spark, folder):
    """Broken JSON counts as none."""
    rows = table(spark, folder, "team_l1_admission").withColumn("v", F.try_parse_json("scoring_summary")).filter("v IS NOT NULL")
    parsed = F.from_json("scoring_summary", "exam_dates array<string>, subjects array<struct<subject: string, minutes: int>>, total_points int")
    return rows.withColumn("p", parsed).select("record_id", "p.total_points", F.coalesce(F.size("p.subjects"), F.lit(0)).cast("bigint").alias("n_subjects"), F.get("p.exam_dates", F.lit(0)).alias("first_date")).withColumn("n_subjects", F.greatest("n_subjects", F.lit(0)))


@query("event_props", "SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS total_k FROM events GROUP BY 1")
def event_props(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total_k"))


@query("standard_scores", "SELECT c_custkey, round(ln(1 + abs(c_acctbal)), 6) AS logged, round((c_acctbal - m) / CASE WHEN s = 0 THEN NULL ELSE s END, 6) AS z FROM customer, (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)")
def standard_scores(spark, folder):
    customers = table(spark, folder, "customer")
    moments = customers.agg(F.avg("c_acctbal").alias("m"), F.stddev_pop("c_acctbal").alias("s"))
    z = (F.col("c_acctbal") - F.col("m")) / F.nullif("s", F.lit(0.0))
    return customers.crossJoin(F.broadcast(moments)).select("c_custkey", F.round(F.log1p(F.abs("c_acctbal")), 6).alias("logged"), F.round(z, 6).alias("z"))


@query("clamped_completeness", "SELECT id, greatest(least(30 + 7 * count(DISTINCT name_ja) + 3 * count(location_city) + 2 * count(homepage_url), 100), 0) AS score FROM schools_v2 GROUP BY 1")
def clamped_completeness(spark, folder):
    score = F.lit(30) + 7 * F.count_distinct("name_ja") + 3 * F.count("location_city") + 2 * F.count("homepage_url")
    return table(spark, folder, "schools_v2").groupBy("id").agg(F.greatest(F.least(score, F.lit(100)), F.lit(0)).alias("score"))


@query("stay_length", "SELECT doc_id, coalesce(TRY_CAST(regexp_extract(text, '([0-9]+)日', 1) AS INTEGER), TRY_CAST(regexp_extract(text, '([0-9]+)泊', 1) AS INTEGER) + 1, 1) AS days FROM documents WHERE text IS NOT NULL")
def stay_length(spark, folder):
    return table(spark, folder, "documents").filter("text IS NOT NULL").select("doc_id", X.days_and_nights(F.col("text")).alias("days"))


_LABELS = {"coed": "共学", "girls": "女子校", "boys": "男子校"}


@query("value_labels", "SELECT row_id, coalesce(CASE gender_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LABELS.items()) + " END, gender_type) AS label FROM schools_v2")
def value_labels(spark, folder):
    names = F.create_map(*(F.lit(x) for pair in _LABELS.items() for x in pair))
    return table(spark, folder, "schools_v2").select("row_id", F.coalesce(F.try_element_at(names, F.col("gender_type")), "gender_type").alias("label"))


@query("flag_list", "SELECT row_id, array_to_string(list_filter([CASE WHEN data_completeness_v2 >= 80 THEN 'complete' END, CASE WHEN homepage_url IS NULL THEN 'no homepage' END, CASE WHEN establishment_year < 1900 THEN 'old' END], lambda x: x IS NOT NULL), ',') AS flags FROM schools_v2")
def flag_list(spark, folder):
    flags = F.array_compact(F.array(F.when(F.col("data_completeness_v2") >= 80, "complete"), F.when(F.col("homepage_url").isNull(), "no homepage"), F.when(F.col("establishment_year") < 1900, "old")))
    return table(spark, folder, "schools_v2").select("row_id", F.array_join(flags, ",").alias("flags"))


@query("html_escape", "SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS escaped FROM documents")
def html_escape(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.escape_html(F.col("text")).alias("escaped"))


@query("roundings", "SELECT p_partkey, round(p_retailprice / 7, 2) AS half_up, floor(p_retailprice / 7) AS down, ceil(p_retailprice / 7) AS up FROM part")
def roundings(spark, folder):
    x = F.col("p_retailprice") / 7
    return table(spark, folder, "part").select("p_partkey", F.round(x, 2).alias("half_up"), F.floor(x).alias("down"), F.ceil(x).alias("up"))


@query("heat_levels", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'high' WHEN p_size >= 20 THEN 'middle' WHEN p_size > 0 THEN 'low' ELSE 'none' END AS level, round(p_size / 50.0, 3) AS opacity FROM part")
def heat_levels(spark, folder):
    s = F.col("p_size")
    return table(spark, folder, "part").select("p_partkey", F.when(s >= 40, "high").when(s >= 20, "middle").when(s > 0, "low").otherwise("none").alias("level"), F.round(s / 50.0, 3).alias("opacity"))


@query("nfkc_lower")
def nfkc_lower(spark, folder):
    """Compatibility forms without blanks in lower case."""
    return table(spark, folder, "schools_v2").select("row_id", F.regexp_replace(F.lower(X.nfkc("name_ja")), r"\s+", "").alias("plain"))


@query("packed_sentences")
def packed_sentences(spark, folder):
    """Sentences of each quote packed in order into lines of at most 80 characters."""
    quotes = table(spark, folder, "team_b2_students")
    return quotes.select("record_id", F.posexplode(X.packed_lines(X.sentences(F.col("quote_text")), 80)).alias("pos", "line"))
