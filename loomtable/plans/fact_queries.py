"""Facts in text and structure of pages, over pages of several shapes made from the tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.functions.text import sentences
from loomtable.operators import dedup as D
from loomtable.operators import extract as X
from loomtable.operators import facts as A
from loomtable.operators import resolve as E
from loomtable.plans.base import Plans
from loomtable.plans.text_queries import _SENTENCES
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql

# ---- facts

_TYPES = [("帰国生", "帰国"), ("特別", "特待|適性")]
_PAGE = (
    "'本年度、' || exam_type || '入試の募集は' || admitted || '名。' || chr(10) || '受験者' || applicants || '名、合格者' || admitted || '名、倍率' || round(competition_ratio, 2) || 'でした。' || chr(10) || "
    "'試験日は2月' || (record_id % 28 + 1) || '日。国語' || (record_id % 3 * 10 + 40) || '分、算数60分、国語30分。合計' || (record_id % 2000) || '点、受験料' || (record_id % 30 * 1000) || '円。'"
)


def _admission_pages(spark, folder):
    a = table(spark, folder, "team_l1_admission").filter("exam_type IS NOT NULL AND admitted IS NOT NULL AND applicants IS NOT NULL AND competition_ratio IS NOT NULL")
    r, word = F.col("record_id"), lambda c: c.cast("string")
    parts = [
        F.lit("本年度、"), F.col("exam_type"), F.lit("入試の募集は"), word(F.col("admitted")), F.lit("名。\n受験者"), word(F.col("applicants")), F.lit("名、合格者"), word(F.col("admitted")), F.lit("名、倍率"),
        word(F.round("competition_ratio", 2)), F.lit("でした。\n試験日は2月"), word(r % 28 + 1), F.lit("日。国語"), word(r % 3 * 10 + 40), F.lit("分、算数60分、国語30分。合計"), word(r % 2000), F.lit("点、受験料"), word(r % 30 * 1000), F.lit("円。"),
    ]
    return a.select("record_id", F.concat(*parts).alias("body"))


_ADMISSIONS = f"(SELECT record_id, {_PAGE} AS body FROM team_l1_admission WHERE exam_type IS NOT NULL AND admitted IS NOT NULL AND applicants IS NOT NULL AND competition_ratio IS NOT NULL)"


def _near(cue: str, unit: str, low: int, high: int, gap: int = 10, of: str = "w") -> str:
    n = f"TRY_CAST(replace(regexp_extract({of}, '(?:{cue})[^0-9\\n]{{0,{gap}}}([0-9][0-9,]*)\\s*(?:{unit})', 1), ',', '') AS INTEGER)"
    return f"CASE WHEN {n} BETWEEN {low} AND {high} THEN {n} END"


_TYPE = "CASE WHEN contains(w, '帰国') THEN '帰国生' WHEN regexp_matches(w, '特待|適性') THEN '特別' ELSE '一般' END"
_RATIO = "TRY_CAST(regexp_extract(w, '倍率[^0-9\\n]{0,6}([0-9]+\\.[0-9]{1,2})', 1) AS DOUBLE)"


@query(
    "admission_facts",
    f"WITH p AS {_ADMISSIONS}, q AS (SELECT record_id, 1 AS k, 'quota' AS kind, {_TYPE} AS exam_type, CAST(NULL AS INTEGER) AS applicants, {_near('募集', '名', 5, 1500, 40)} AS admitted, CAST(NULL AS DOUBLE) AS ratio FROM (SELECT record_id, unnest(regexp_extract_all(body, '([^。\\n]{{0,40}}募集[^。、\\n]{{0,40}}?[0-9][0-9,]*\\s*名)', 1)) AS w FROM p)), "
    f"r AS (SELECT record_id, 2 AS k, 'results' AS kind, {_TYPE} AS exam_type, {_near('受験者|志願者', '名|人', 5, 5000)} AS applicants, {_near('合格者', '名|人', 1, 1500)} AS admitted, CASE WHEN {_RATIO} BETWEEN 0.5 AND 30 THEN {_RATIO} END AS ratio FROM (SELECT record_id, unnest(regexp_extract_all(body, '((?:受験者|志願者)[^\\n]{{0,200}})', 1)) AS w FROM p)), "
    "d AS (SELECT record_id, 3 AS k, 'details' AS kind, '一般' AS exam_type, CAST(NULL AS INTEGER) AS applicants, CAST(NULL AS INTEGER) AS admitted, CAST(NULL AS DOUBLE) AS ratio FROM p) "
    "SELECT record_id, kind, exam_type, applicants, admitted, ratio FROM (SELECT * FROM q WHERE admitted IS NOT NULL UNION ALL SELECT * FROM r WHERE coalesce(applicants, admitted, ratio) IS NOT NULL UNION ALL SELECT * FROM d)",
)
def admission_facts(spark, folder):
    """Quotas, results and details that admission pages state, three at most of each page."""
    return A.admission_facts(_admission_pages(spark, folder), "record_id", "body", _TYPES).drop("details")


@query(
    "admission_details",
    f"SELECT record_id, '2月' || (record_id % 28 + 1) || '日' AS first_date, 2 AS n_subjects, CAST(record_id % 3 * 10 + 40 AS INTEGER) AS minutes, {_near('合計', '点', 50, 1500, 5, 'body')} AS points, {_near('検定料|受験料', '円', 1000, 200000, 15, 'body')} AS fee FROM {_ADMISSIONS}",
)
def admission_details(spark, folder):
    """Dates, minutes of the first subject, points and fee, read from the JSON of the details."""
    d = A.admission_facts(_admission_pages(spark, folder), "record_id", "body", _TYPES).filter("kind = 'details'")
    r = F.from_json("details", "dates array<string>, subjects array<struct<subject:string,minutes:int>>, points int, fee int")
    return d.select("record_id", r.alias("r")).select("record_id", F.get("r.dates", F.lit(0)).alias("first_date"), F.size("r.subjects").alias("n_subjects"), F.get("r.subjects", F.lit(0)).getField("minutes").alias("minutes"), "r.points", "r.fee")


_PLACES = [(f"{stem}大学", "university", f"{stem}(?:大学|女子短期大学)") for stem in ("凪ノ宮", "雫ノ宮", "鷺台", "霞谷", "汐丘", "翠崎")]
_CLAIM = "evidence_text || CASE record_id % 4 WHEN 0 THEN '進学先：鷺台大学（現役）' || (record_id % 1200) || '名、' WHEN 1 THEN '霞谷大学 ' || (record_id % 50) || 'ページ、' WHEN 2 THEN '2019年（令和元）年 PDF、2021年度（PDF）' ELSE '' END || chr(10) || '以上'"


def _near_place(p: str) -> tuple[str, str]:
    near = f"(?:{p})\\s*(?:[(（][^)）\\n]{{0,10}}[)）]\\s*)?([0-9]{{1,3}})((?:[^0-9.][^\\n]{{0,8}})?)(?:[^0-9.]|$)"
    n = f"CASE WHEN NOT regexp_matches(regexp_extract(body, '{near}', 2), 'PDF|ページ|kB|MB') THEN TRY_CAST(regexp_extract(body, '{near}', 1) AS INTEGER) END"
    return f"CASE WHEN {n} > 0 THEN {n} END", f"regexp_matches(body, '{p}')"


_FOUND = " UNION ALL ".join(f"SELECT record_id, '{n}' AS name, '{k}' AS kind, {_near_place(p)[0]} AS count FROM p WHERE {_near_place(p)[1]}" for n, k, p in _PLACES)


@query(
    "destinations",
    f"WITH p AS (SELECT record_id, {_CLAIM} AS body FROM team_c1_gf WHERE evidence_text IS NOT NULL), f AS ({_FOUND}), "
    "y AS (SELECT record_id, unnest(list_slice(regexp_extract_all(body, '(20[12][0-9])[^()（）\\n]{0,8}年[^()（）\\n]{0,8}[（(]?PDF', 1), 1, 3)) AS y FROM p WHERE record_id NOT IN (SELECT record_id FROM f)) "
    "SELECT record_id, name, kind, count, CAST(NULL AS INTEGER) AS year, CASE WHEN count IS NULL THEN 'named' ELSE 'counted' END AS how FROM f UNION ALL SELECT record_id, 'PDF', 'aggregate', NULL, CAST(y AS INTEGER), 'years' FROM y",
)
def destinations(spark, folder):
    """Where those who left went to: counted, only named, or years of which there is a list."""
    g, r = table(spark, folder, "team_c1_gf").filter("evidence_text IS NOT NULL"), F.col("record_id")
    more = F.when(r % 4 == 0, F.concat(F.lit("進学先：鷺台大学（現役）"), (r % 1200).cast("string"), F.lit("名、"))).when(r % 4 == 1, F.concat(F.lit("霞谷大学 "), (r % 50).cast("string"), F.lit("ページ、"))).when(r % 4 == 2, "2019年（令和元）年 PDF、2021年度（PDF）").otherwise("")
    return A.destinations(g.select("record_id", F.concat("evidence_text", more, F.lit("\n以上")).alias("body")), "record_id", "body", _PLACES)


_KINDS = [("library", "図書館|図書室"), ("gym", "体育館"), ("science", "理科棟"), ("music", "音楽室"), ("art", "美術室"), ("ground", "グラウンド"), ("hall", "講堂|ホール")]
_NOTABLE = "新しい|自慢|いちばん|建てられた"


@query(
    "facility_facts",
    "SELECT doc_id, kind, snippet, regexp_matches(snippet, '" + _NOTABLE + "') AS notable, CASE WHEN TRY_CAST(replace(regexp_extract(snippet, '([0-9][0-9,]*)\\s*(?:人|名|席)', 1), ',', '') AS INTEGER) BETWEEN 1 AND 20000 THEN TRY_CAST(replace(regexp_extract(snippet, '([0-9][0-9,]*)\\s*(?:人|名|席)', 1), ',', '') AS INTEGER) END AS capacity FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, regexp_extract(text, '([^\\n]{{0,20}}(?:{p})[^\\n]{{0,20}})', 1) AS snippet FROM documents WHERE regexp_matches(text, '{p}')" for k, p in _KINDS) + ")",
)
def facility_facts(spark, folder):
    return A.facilities(table(spark, folder, "documents"), "doc_id", "text", _KINDS, _NOTABLE)


@query("attributed_quotes", f"SELECT record_id, unnest(regexp_extract_all(evidence_text, '{A.ATTRIBUTED}', 1)) AS lead, unnest(regexp_extract_all(evidence_text, '{A.ATTRIBUTED}', 2)) AS quote FROM team_c1_gf")
def attributed_quotes(spark, folder):
    return table(spark, folder, "team_c1_gf").select("record_id", F.explode(A.attributed_quotes(F.col("evidence_text"))).alias("q")).select("record_id", "q.lead", "q.quote")


@query("first_person_sentences", f"SELECT record_id, s AS sentence FROM (SELECT record_id, unnest({_SENTENCES.format('quote_text')}) AS s FROM team_c_llm_students) WHERE regexp_matches(s, '{A.FIRST_PERSON}')")
def first_person_sentences(spark, folder):
    return table(spark, folder, "team_c_llm_students").select("record_id", F.explode(A.first_person(sentences(F.col("quote_text")))).alias("sentence"))


# ---- pages of four shapes

_SHAPES = [
    ('<html><body><nav><p>menu</p></nav><main><h2>{title}</h2><span>x</span><p>{body}</p><dl><dt>問い</dt><dd>{title}です</dd></dl></main><footer><p>foot</p></footer></body></html>'),
    ('<body><div class="sidebar"><p>side</p></div><div id="Content"><h3>{title}</h3><div>{body}</div><ul><li>授業</li><li>行事</li></ul></div><div><p>outside</p></div></body>'),
    ('<body><article><blockquote>{body}</blockquote><h2>{title}</h2><i>a</i><i>b</i><i>c</i><p>too far</p></article></body>'),
    ('<p class="breadcrumb">top</p><p>{body}<p>{title}<h4>見出し</h4><h2>次</h2><p>後</p>'),
]


_GAPS = r"[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}]+"


def _plain(c):
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[<>&]", ""), _GAPS, " "))


def _shaped(spark, folder):
    p = table(spark, folder, "school_philosophy_v2").filter("text_full IS NOT NULL AND philosophy_type IS NOT NULL").withColumn("body", _plain(F.col("text_full"))).filter("body <> ''")
    html = F.lit("")
    for k, shape in enumerate(_SHAPES):
        made = F.replace(F.replace(F.lit(shape), F.lit("{title}"), F.col("philosophy_type")), F.lit("{body}"), F.col("body"))
        html = F.when(F.col("id") % 4 == k, made).otherwise(html)
    return p.select("id", html.alias("html"))


_SHAPED = "(SELECT id, philosophy_type AS title, trim(regexp_replace(regexp_replace(text_full, '[<>&]', '', 'g'), '" + _GAPS + "', ' ', 'g')) AS body, id % 4 AS k FROM school_philosophy_v2 WHERE text_full IS NOT NULL AND philosophy_type IS NOT NULL)"


def _rows(columns: list[str], rows: list[tuple[int, ...]]) -> str:
    """SELECTs of the rows that each shape gives: (shape, *expressions)."""
    return " UNION ALL ".join(f"SELECT id, {', '.join(f'{x} AS {c}' for c, x in zip(columns, r))} FROM s WHERE k = {shape}" for shape, *r in rows)


@query(
    "main_texts",
    f"WITH s AS (SELECT * FROM {_SHAPED} WHERE body <> '') "
    + _rows(["pos", "tag", "body"], [(0, "0", "'p'", "body"), (0, "1", "'dd'", "title || 'です'"), (1, "0", "'div'", "body"), (1, "1", "'li'", "'授業'"), (1, "2", "'li'", "'行事'"), (2, "0", "'blockquote'", "body"), (2, "1", "'p'", "'too far'"), (3, "0", "'p'", "body"), (3, "1", "'p'", "title"), (3, "2", "'p'", "'後'")]),
)
def main_texts(spark, folder):
    """Innermost texts of the main region, whatever frames it."""
    return X.main_texts(_shaped(spark, folder), "id", "html")


@query(
    "structured_answers",
    f"WITH s AS (SELECT * FROM {_SHAPED} WHERE body <> '') "
    + _rows(["pos", "how", "question", "answer"], [(0, "0", "'heading'", "title", "body"), (0, "1", "'definition'", "'問い'", "title || 'です'"), (1, "0", "'heading'", "title", "body"), (2, "0", "'quotation'", "''", "body"), (3, "0", "'heading'", "'次'", "'後'")]),
)
def structured_answers(spark, folder):
    """Definitions, quotations, and headings with the text within three elements."""
    return X.answers(_shaped(spark, folder), "id", "html")


@query(
    "headed_texts",
    f"WITH s AS (SELECT * FROM {_SHAPED} WHERE body <> '' AND NOT regexp_matches(title, 'vision')) "
    + _rows(["pos", "title", "body"], [(0, "0", "title", "body"), (1, "0", "title", "body")]).replace("FROM s WHERE k = 1", "FROM s WHERE k = 1 AND regexp_matches(title, 'mission|principle')").replace("FROM s WHERE k = 0", "FROM s WHERE k = 0 AND regexp_matches(title, 'mission|principle')")
    + f" UNION ALL SELECT id, 0, '', '授業' FROM (SELECT * FROM {_SHAPED} WHERE body <> '') WHERE k = 1 AND NOT regexp_matches(title, 'mission|principle') UNION ALL SELECT id, 0, title, '' FROM s WHERE k = 2 AND regexp_matches(title, 'mission|principle')",
)
def headed_texts(spark, folder):
    """Headings of some topics with the text beside them, else list items of these topics."""
    return X.headed(_shaped(spark, folder), "id", "html", "mission|principle|授業")


@query(
    "wiki_alumni",
    "SELECT record_id, 1 AS pos, '著名な卒業生 / ' || category AS section, name, '学者' AS description FROM team_c1_gf WHERE name IS NOT NULL AND category IS NOT NULL",
)
def wiki_alumni(spark, folder):
    """Linked persons below headings of alumni; plain items, other sections and other links are none."""
    g = table(spark, folder, "team_c1_gf").filter("name IS NOT NULL AND category IS NOT NULL")
    text = F.concat(F.lit("== 沿革 ==\n* [[校舎]] - 古い\n== 著名な卒業生 ==\n=== "), "category", F.lit(" ===\n* [["), "name", F.lit("]]（学者）\n* 名の無い人\n* [[Category:人]]\n* [[1999年]]卒\n== 関連項目 ==\n* [[学校]]"))
    return X.alumni(g.select("record_id", text.alias("text")), "record_id", "text")


@query(
    "host_subpages",
    "WITH b AS (SELECT record_id, source_url, regexp_extract(source_url, '^(https?://[^/]+)', 1) AS root FROM team_l1_admission WHERE source_url IS NOT NULL), u AS (SELECT record_id, source_url, unnest([root || '/about/x.html', root || '/voice/' || record_id || '.html']) AS url FROM b) "
    "SELECT record_id, url, CASE WHEN contains(url, '/voice/') THEN 5 ELSE 2 END AS score FROM u WHERE url <> source_url",
)
def host_subpages(spark, folder):
    """Pages of the same host that links lead to, scored by their address."""
    a = table(spark, folder, "team_l1_admission").filter("source_url IS NOT NULL")
    root = F.regexp_extract("source_url", "^(https?://[^/]+)", 1)
    links = F.array(F.lit("/a/b/../../about/x.html"), F.lit("?q=1"), F.lit("//other.example/voice/"), F.concat(F.lit("/voice/"), F.col("record_id").cast("string"), F.lit(".html#top")), F.lit("mailto:a@b.example"), F.lit("/guide.pdf"), F.concat(root, F.lit("/./about/x.html")))
    return A.subpages(a.withColumn("links", links), "record_id", "source_url", "links", [("/voice/", 5), ("/about/", 2)])


_SHORT = "regexp_replace(name_ja, '(?:中学校|中等部|中等教育学校)$', '')"


@query(
    "article_quotes",
    f"WITH n AS (SELECT DISTINCT {_SHORT} AS name FROM schools_v2), m AS (SELECT g.record_id, n.name, row_number() OVER (PARTITION BY g.record_id ORDER BY length(n.name) DESC, n.name) AS r FROM team_c1_gf g JOIN n ON contains(g.evidence_text, n.name) WHERE length(n.name) >= 3), "
    "q AS (SELECT g.record_id, m.name, 'https://press.example/' || g.gf_person_id AS url, substr(g.evidence_text, 1, 80) AS head FROM team_c1_gf g JOIN m ON m.record_id = g.record_id AND m.r = 1), "
    "a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY record_id) AS u FROM q) WHERE u = 1) SELECT record_id, name, url, head FROM (SELECT *, row_number() OVER (PARTITION BY name, head ORDER BY record_id) AS h FROM a) WHERE h = 1",
)
def article_quotes(spark, folder):
    """Articles that name a school as quote records: the longest name, first per address, then first per school and head."""
    from loomtable.functions.text import without_suffix

    names = table(spark, folder, "schools_v2").select(without_suffix(F.col("name_ja"), ["中学校", "中等部", "中等教育学校"]).alias("name"))
    g = table(spark, folder, "team_c1_gf")
    found = E.longest_name(E.names_in_texts(g, "record_id", "evidence_text", names, "name", 3)).select(F.col("key").alias("record_id"), F.col("name").alias("school"))
    rows = g.join(found, "record_id").select("record_id", F.col("school").alias("name"), F.concat(F.lit("https://press.example/"), F.col("gf_person_id").cast("string")).alias("url"), F.substring("evidence_text", 1, 80).alias("head"))
    return D.new_by_keys_in_turn(rows, rows.limit(0), [["url"], ["name", "head"]], ["record_id"])
