"""Extraction over pages, dossiers and wiki texts made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.functions.text import packed_lines, sentences
from loomtable.operators import extract as X
from loomtable.operators import rules as R
from loomtable.operators.windows import top_per_group
from loomtable.plans.base import Plans
from loomtable.plans.text_queries import _STRIP, page, page_sql
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql


def _pages(spark, folder):
    p = table(spark, folder, "school_philosophy_v2")
    return p.select("id", "school_id", page(F.col("philosophy_type"), F.col("text_full")).alias("html"))


_PAGES = f"SELECT id, school_id, {page_sql('philosophy_type', 'text_full')} AS html FROM school_philosophy_v2"


@query(
    "tag_contents",
    " UNION ALL ".join(f"SELECT id, '{t}' AS tag, {_STRIP} AS body FROM (SELECT id, unnest(regexp_extract_all(html, '(?is)<{t}(?:\\s[^>]*)?>(.*?)</{t}>', 1)) AS html FROM ({_PAGES}))" for t in ("h1", "p")),
)
def tag_contents(spark, folder):
    return _pages(spark, folder).select("id", F.explode(X.tag_contents(F.col("html"), ["h1", "p"])).alias("x")).select("id", "x.tag", "x.body")


@query("quoted_spans", "SELECT doc_id, unnest(regexp_extract_all(text, '「([^「」\\n]{5,200})」', 1)) AS span FROM documents")
def quoted_spans(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.explode(X.quoted_spans(F.col("text"))).alias("span"))


_QA = "(?m)^Q[:：]\\s*([^\\n]*)\\nA[:：]\\s*([^\\n]*)"


@query("questions_answers", f"SELECT doc_id, unnest(regexp_extract_all(text, '{_QA}', 1)) AS question, unnest(regexp_extract_all(text, '{_QA}', 2)) AS answer FROM documents")
def questions_answers(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.explode(X.questions_and_answers(F.col("text"))).alias("x")).select("doc_id", "x.question", "x.answer")


_FACTS = [("founded", "((?:明治|大正|昭和|平成|令和)[0-9]+年)"), ("western", "([0-9]{4})年"), ("operator", "学校法人([^、。「」]+?)である"), ("pupils", "(共学|男子校|女子校)")]


@query(
    "fact_rules",
    "SELECT record_id, label, value FROM (" + " UNION ALL ".join(f"SELECT record_id, {k} AS k, '{label}' AS label, regexp_extract(evidence_text, '{p}', 1) AS value FROM team_c1_gf WHERE regexp_matches(evidence_text, '{p}')" for k, (label, p) in enumerate(_FACTS)) + ") QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY k) <= 3",
)
def fact_rules(spark, folder):
    return X.rule_hits(table(spark, folder, "team_c1_gf"), "record_id", "evidence_text", _FACTS, 3).select("record_id", "label", "value")


@query(
    "count_facts",
    "SELECT doc_id, CASE WHEN n BETWEEN 5 AND 150 THEN n END AS visitors FROM (SELECT doc_id, TRY_CAST(regexp_extract(text, '([0-9]+)人以上の来場者', 1) AS INTEGER) AS n FROM documents WHERE regexp_matches(text, '[0-9]+人以上の来場者'))",
)
def count_facts(spark, folder):
    docs = table(spark, folder, "documents").filter(F.col("text").rlike("[0-9]+人以上の来場者"))
    return docs.select("doc_id", X.plausible(F.regexp_extract("text", "([0-9]+)人以上の来場者", 1), 5, 150).alias("visitors"))


_LINKED = "'<a href=\"' || source_url || '\">x</a><a class=\"n\" href=''' || source_url || '#top''>y</a><a href=\"/local\">z</a>'"


@query("link_discovery", f"SELECT record_id, unnest(list_distinct(regexp_extract_all({_LINKED}, '(?i)<a\\s[^>]*href=[\"'']([^\"''#]+)', 1))) AS link FROM team_l1_admission WHERE source_url IS NOT NULL")
def link_discovery(spark, folder):
    u = F.col("source_url")
    html = F.concat(F.lit('<a href="'), u, F.lit('">x</a><a class="n" href=\''), u, F.lit("#top'>y</a><a href=\"/local\">z</a>"))
    rows = table(spark, folder, "team_l1_admission").filter("source_url IS NOT NULL")
    return rows.select("record_id", F.explode(X.links(html)).alias("link"))


@query("page_pipeline")
def page_pipeline(spark, folder):
    """Pages to blocks, lines of at most 120 characters, topic, first per head and school, at most 8 per school, counted."""
    b = X.blocks(_pages(spark, folder), "id", "html").join(_pages(spark, folder).select("id", "school_id"), "id")
    lines = b.select("id", "school_id", "pos", F.posexplode(packed_lines(sentences(F.col("body")), 120)).alias("line_no", "line")).filter(F.length("line").between(20, 400))
    topic = R.first_pattern(F.col("line"), [("spirit", "精神|建学"), ("class", "授業|探究"), ("world", "世界|国際")], "other")
    kept = top_per_group(lines.withColumn("topic", topic).withColumn("head", F.substring("line", 1, 80)), ["school_id", "head"], ["id", "pos", "line_no"], 1)
    return top_per_group(kept, ["school_id"], ["id", "pos", "line_no"], 8).groupBy("school_id", "topic").agg(F.count("*").alias("n"))


@query("page_blocks")
def page_blocks(spark, folder):
    return X.blocks(_pages(spark, folder), "id", "html")


@query("inner_elements", " UNION ALL ".join(f"SELECT id, {_STRIP} AS body FROM (SELECT id, unnest(regexp_extract_all(html, '(?is)<{t}(?:\\s[^>]*)?>([^<]*)</{t}>', 1)) AS html FROM ({_PAGES}))" for t in ("style", "h1", "p")))
def inner_elements(spark, folder):
    return _pages(spark, folder).select("id", F.explode(X.any_element(F.col("html"))).alias("body"))


@query("linked_data", "SELECT record_id, 'Review' AS kind, coalesce(speaker_role, '') AS name, quote_text AS body FROM team_b2_students WHERE quote_text <> '' AND NOT contains(quote_text, '</script>')")
def linked_data(spark, folder):
    q = table(spark, folder, "team_b2_students").filter("quote_text IS NOT NULL")
    body = F.to_json(F.struct(F.lit("Review").alias("@type"), F.col("speaker_role").alias("name"), F.col("quote_text").alias("reviewBody")))
    html = F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    return X.linked_data(q.select("record_id", html.alias("html")), "record_id", "html")


@query("dossier_statements", "SELECT record_id, school_id AS entity, CAST(record_id AS INTEGER) AS number, speaker_role AS speaker, '' AS theme, coalesce(source_url, '-') AS source, trim(regexp_replace(quote_text, '[\\s\\x{3000}]+', ' ', 'g')) AS quote FROM team_b2_students WHERE quote_text IS NOT NULL AND school_id IS NOT NULL AND speaker_role IS NOT NULL AND length(trim(regexp_replace(quote_text, '[\\s\\x{3000}]+', ' ', 'g'))) >= 2")
def dossier_statements(spark, folder):
    """Quotes of each school written as a dossier and read back."""
    q = table(spark, folder, "team_b2_students").filter("quote_text IS NOT NULL AND school_id IS NOT NULL")
    text = F.concat(F.lit("# "), "school_id", F.lit("\n\n### #"), F.col("record_id").cast("string"), F.lit("\n- speaker: "), "speaker_role", F.lit("\n- source: "), F.coalesce("source_url", F.lit("-")), F.lit("\n\n> "), F.regexp_replace("quote_text", r"[\s\x{3000}]+", " "))
    return X.statements(q.select("record_id", text.alias("text")), "record_id", "text")


@query("wiki_items", "SELECT record_id, 0 AS pos, 3 AS level, '出身者 / ' || category AS section, name, regexp_replace(regexp_replace(split_part(coalesce(evidence_text, ''), chr(10), 1), '^[\\s\\x{3000}\\-–—:：（(]+', ''), '[\\s\\x{3000}）)]+$', '') AS description FROM team_c1_gf WHERE name IS NOT NULL AND category IS NOT NULL")
def wiki_items(spark, folder):
    g = table(spark, folder, "team_c1_gf").filter("name IS NOT NULL")
    text = F.concat(F.lit("== 出身者 ==\n=== "), "category", F.lit(" ===\n* [["), "name", F.lit("]] - "), F.coalesce("evidence_text", F.lit("")))
    return X.wiki_items(g.select("record_id", text.alias("text")), "record_id", "text")


@query("calendar_events")
def calendar_events(spark, folder):
    return X.events(table(spark, folder, "documents").filter("text IS NOT NULL"), "doc_id", "text")


@query("insert_values", "SELECT row_id, 0 AS \"row\", 0 AS col, CAST(row_id AS VARCHAR) AS value FROM schools_v2 UNION ALL SELECT row_id, 0, 1, coalesce(name_ja, '') FROM schools_v2 UNION ALL SELECT row_id, 0, 2, NULL FROM schools_v2")
def insert_values(spark, folder):
    """Rows written as INSERT statements and taken apart again."""
    s = table(spark, folder, "schools_v2")
    q = lambda c: F.concat(F.lit("'"), F.replace(F.coalesce(c, F.lit("")), F.lit("'"), F.lit("''")), F.lit("'"))
    text = F.concat(F.lit("INSERT INTO t (a, b, c) VALUES ("), F.col("row_id").cast("string"), F.lit(", "), q("name_ja"), F.lit(", NULL);"))
    return X.inserted_values(s.select("row_id", text.alias("sql")), "row_id", "sql")


_SECTIONS = "'<section class=\"v\"><h2>' || coalesce(context, '') || '</h2><p>' || quote_text || '</p><p>' || coalesce(quote_summary, '') || '</p></section><section></section>'"


@query(
    "section_paragraphs",
    f"SELECT record_id, {_STRIP} AS body FROM (SELECT record_id, unnest(regexp_extract_all(section, '(?is)<p(?:\\s[^>]*)?>(.*?)</p>', 1)) AS html FROM (SELECT record_id, unnest(regexp_extract_all({_SECTIONS}, '(?is)<section(?:\\s[^>]*)?>(.*?)</section>', 1)) AS section FROM team_b2_students))",
)
def section_paragraphs(spark, folder):
    """Paragraphs inside sections: two nested extractions."""
    from loomtable.functions.text import strip_html

    q = table(spark, folder, "team_b2_students")
    html = F.concat(F.lit('<section class="v"><h2>'), F.coalesce("context", F.lit("")), F.lit("</h2><p>"), "quote_text", F.lit("</p><p>"), F.coalesce("quote_summary", F.lit("")), F.lit("</p></section><section></section>"))
    inner = q.select("record_id", F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<section(?:\s[^>]*)?>(.*?)</section>"), F.lit(1))).alias("section"))
    paragraphs = inner.select("record_id", F.explode(F.regexp_extract_all("section", F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), F.lit(1))).alias("p"))
    return paragraphs.select("record_id", strip_html(F.col("p")).alias("body"))
