"""Deduplication and name resolution, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtable.operators import dedup as D
from loomtable.operators import resolve as E
from loomtable.plans.base import Plans
from loomtable.sources.tables import table

query = Plans()
QUERIES, SQL = query.queries, query.sql


@query("dedup_head80", "SELECT record_id, row_number() OVER (PARTITION BY school_id, substr(quote_text, 1, 80) ORDER BY record_id) > 1 AS is_duplicate FROM team_b2_students")
def dedup_head80(spark, folder):
    rows = table(spark, folder, "team_b2_students").withColumn("head", F.substring("quote_text", 1, 80))
    return D.mark_duplicates(rows, ["school_id", "head"], ["record_id"]).select("record_id", "is_duplicate")


@query("dedup_role_head", "SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY speaker_role, substr(quote_text, 1, 60) ORDER BY record_id) AS r FROM team_c_llm_students) WHERE r = 1")
def dedup_role_head(spark, folder):
    rows = table(spark, folder, "team_c_llm_students").withColumn("head", F.substring("quote_text", 1, 60))
    return D.mark_duplicates(rows, ["speaker_role", "head"], ["record_id"]).filter("NOT is_duplicate").select("record_id")


@query(
    "dedup_against_stored",
    "SELECT record_id FROM (SELECT record_id, quote_text, row_number() OVER (PARTITION BY school_id, quote_text ORDER BY record_id) AS r, school_id FROM team_b2_students WHERE record_id > 300) n WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM team_b2_students o WHERE o.record_id <= 300 AND o.school_id IS NOT DISTINCT FROM n.school_id AND o.quote_text IS NOT DISTINCT FROM n.quote_text)",
)
def dedup_against_stored(spark, folder):
    rows = table(spark, folder, "team_b2_students")
    stored, batch = rows.filter("record_id <= 300"), rows.filter("record_id > 300")  # the stored part and the new batch are the feature
    return D.new_rows(batch, stored, ["school_id", "quote_text"], ["record_id"]).select("record_id")


@query("dedup_exact_normalised", "SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY school_id, lower(regexp_replace(quote_text, '[\\s\\x{3000}]+', '', 'g')) ORDER BY record_id) AS r FROM team_c_llm_principal_round4) WHERE r = 1")
def dedup_exact_normalised(spark, folder):
    rows = table(spark, folder, "team_c_llm_principal_round4").withColumn("plain", F.lower(F.regexp_replace("quote_text", r"[\s\x{3000}]+", "")))
    return D.mark_duplicates(rows, ["school_id", "plain"], ["record_id"]).filter("NOT is_duplicate").select("record_id")


_BLANK_FREE = "regexp_replace(quote_text, '[\\s\\x{3000}]+', '', 'g')"


def _blank_free(text: str):
    return F.regexp_replace(text, r"[\s\x{3000}]+", "")


@query("dedup_blank_free_head", f"SELECT record_id, row_number() OVER (PARTITION BY substr({_BLANK_FREE}, 1, 80) ORDER BY record_id) > 1 AS is_duplicate FROM team_c_llm_students WHERE quote_text IS NOT NULL")
def dedup_blank_free_head(spark, folder):
    """The first 80 characters without blanks, over all schools."""
    rows = table(spark, folder, "team_c_llm_students").filter("quote_text IS NOT NULL").withColumn("head", F.substring(_blank_free("quote_text"), 1, 80))
    return D.mark_duplicates(rows, ["head"], ["record_id"]).select("record_id", "is_duplicate")


@query(
    "dedup_head50_against_stored",
    f"WITH k AS (SELECT record_id, school_id, substr({_BLANK_FREE}, 1, 50) AS head, 'new' AS part FROM team_c_llm_students UNION ALL SELECT record_id, school_id, substr({_BLANK_FREE}, 1, 50), 'old' FROM team_b2_students) "
    "SELECT record_id FROM (SELECT *, row_number() OVER (PARTITION BY school_id, head ORDER BY record_id) AS r FROM k WHERE part = 'new') n WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM k o WHERE o.part = 'old' AND o.school_id IS NOT DISTINCT FROM n.school_id AND o.head IS NOT DISTINCT FROM n.head)",
)
def dedup_head50_against_stored(spark, folder):
    """New quotes whose first 50 characters without blanks neither a stored quote of the school has nor an earlier new one."""
    heads = lambda t: table(spark, folder, t).select("record_id", "school_id", F.substring(_blank_free("quote_text"), 1, 50).alias("head"))
    return D.new_rows(heads("team_c_llm_students"), heads("team_b2_students"), ["school_id", "head"], ["record_id"]).select("record_id")


@query(
    "dedup_address_then_text",
    "WITH s AS (SELECT source_url, substr(quote_text, 1, 80) AS head FROM team_b2_students), n AS (SELECT record_id, source_url, substr(quote_text, 1, 80) AS head FROM team_c_llm_students), "
    "a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(source_url, CAST(record_id AS VARCHAR)) ORDER BY record_id) AS r FROM n) WHERE r = 1 AND (source_url IS NULL OR source_url NOT IN (SELECT source_url FROM s WHERE source_url IS NOT NULL))), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY head ORDER BY record_id) AS q FROM a WHERE head NOT IN (SELECT head FROM s WHERE head IS NOT NULL)) SELECT record_id FROM b WHERE q = 1",
)
def dedup_address_then_text(spark, folder):
    """New rows whose address is neither stored nor earlier in the batch (rows without one pass), of these those whose head is not."""
    heads = lambda t: table(spark, folder, t).select("record_id", "source_url", F.substring("quote_text", 1, 80).alias("head"))
    stored, new = heads("team_b2_students"), heads("team_c_llm_students").filter("head IS NOT NULL")
    return D.new_by_keys_in_turn(new, stored, [["source_url"], ["head"]], ["record_id"]).select("record_id")


@query("dedup_person_school_type", "SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY gf_person_id, matched_school_name, match_type ORDER BY record_id) AS r FROM team_c1_gf WHERE matched_school_name IS NOT NULL) WHERE r = 1")
def dedup_person_school_type(spark, folder):
    """The first claim of each person, school and kind of match."""
    claims = table(spark, folder, "team_c1_gf").filter("matched_school_name IS NOT NULL")
    return D.mark_duplicates(claims, ["gf_person_id", "matched_school_name", "match_type"], ["record_id"]).filter("NOT is_duplicate").select("record_id")


@query("dedup_exact_nfkc")
def dedup_exact_nfkc(spark, folder):
    """The first quote of each school and compatibility form in lower case."""
    from loomtable.functions.text import nfkc

    rows = table(spark, folder, "team_c_llm_principal_round4").withColumn("plain", F.lower(nfkc("quote_text")))
    return D.mark_duplicates(rows, ["school_id", "plain"], ["record_id"]).filter("NOT is_duplicate").select("record_id")


@query("dedup_keep_longest", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, substr(text, 1, 80) ORDER BY length(text) DESC, doc_id) AS r FROM documents WHERE text IS NOT NULL) WHERE r = 1")
def dedup_keep_longest(spark, folder):
    from loomtable.operators.windows import keep_longest

    docs = table(spark, folder, "documents").filter("text IS NOT NULL").withColumn("head", F.substring("text", 1, 80))
    return keep_longest(docs, ["source", "head"], "text", "doc_id").select("doc_id")


@query("dedup_person_school", "SELECT gf_person_id, matched_school_name, min(record_id) AS record_id, count(*) AS n_claims FROM team_c1_gf GROUP BY 1, 2")
def dedup_person_school(spark, folder):
    return table(spark, folder, "team_c1_gf").groupBy("gf_person_id", "matched_school_name").agg(F.min("record_id").alias("record_id"), F.count("*").alias("n_claims"))


_STORED = (
    "SELECT 'src_' || lpad(CAST(row_number() OVER (ORDER BY url, title) AS VARCHAR), 6, '0') AS id, url, title FROM "
    "(SELECT DISTINCT source_url AS url, coalesce(school_id, '') || ' voices' AS title FROM team_b2_students WHERE source_url IS NOT NULL UNION SELECT NULL, id || ' mission' FROM schools_v2 WHERE homepage_url IS NULL)"
)
_ASKED = "SELECT id AS record_id, source_url AS url, coalesce(school_id, '') || ' ' || philosophy_type AS title FROM school_philosophy_v2"


@query(
    "source_find_or_create",
    f"WITH stored AS ({_STORED}), asked AS ({_ASKED}), bu AS (SELECT url AS u, min(id) AS i FROM stored WHERE url IS NOT NULL GROUP BY 1), bt AS (SELECT title AS t, min(id) AS i FROM stored WHERE url IS NULL GROUP BY 1), "
    "a AS (SELECT record_id, url, title, bu.i AS by_url, bt.i AS by_title FROM asked LEFT JOIN bu ON url = u LEFT JOIN bt ON title = t), "
    "titled AS (SELECT title AS t, min(record_id) AS since FROM a WHERE url IS NULL AND by_title IS NULL GROUP BY 1), "
    "made AS (SELECT url AS u, min(record_id) AS m FROM a LEFT JOIN titled ON title = t WHERE url IS NOT NULL AND by_url IS NULL AND by_title IS NULL AND (since IS NULL OR record_id < since) GROUP BY 1), "
    "fresh AS (SELECT u, NULL AS t, m AS born FROM made UNION ALL SELECT NULL, t, since FROM titled), "
    "ids AS (SELECT u, t, born, 'src_' || lpad(CAST(row_number() OVER (ORDER BY born) + (SELECT count(*) FROM stored) AS VARCHAR), 6, '0') AS id FROM fresh) "
    "SELECT record_id, CASE WHEN by_url IS NOT NULL THEN by_url WHEN n.born <= record_id THEN n.id WHEN by_title IS NOT NULL THEN by_title ELSE k.id END AS source_id, by_url IS NULL AND (coalesce(n.born <= record_id, FALSE) OR by_title IS NULL) AS is_new "
    "FROM a LEFT JOIN ids n ON n.u = url LEFT JOIN ids k ON k.t = title",
)
def source_find_or_create(spark, folder):
    """The source of each philosophy text: found by address, else by title without address, else made."""
    from loomtable.operators.merge import find_or_create, numbered, padded

    voices, schools = table(spark, folder, "team_b2_students"), table(spark, folder, "schools_v2")
    kept = voices.filter("source_url IS NOT NULL").select(F.col("source_url").alias("url"), F.concat(F.coalesce("school_id", F.lit("")), F.lit(" voices")).alias("title"))
    kept = kept.union(schools.filter("homepage_url IS NULL").select(F.lit(None).cast("string"), F.concat("id", F.lit(" mission")))).distinct()
    order = [F.col("url").asc_nulls_last(), "title"]
    stored = numbered(kept, order, "n").select(F.concat(F.lit("src_"), padded(F.col("n"), 6)).alias("id"), "url", "title")
    asked = table(spark, folder, "school_philosophy_v2").select(F.col("id").alias("record_id"), F.col("source_url").alias("url"), F.concat(F.coalesce("school_id", F.lit("")), F.lit(" "), "philosophy_type").alias("title"))
    return find_or_create(asked, stored, "record_id", "src_", 6).select("record_id", "source_id", "is_new")


@query(
    "dedup_contained_heads",
    "SELECT DISTINCT b.record_id FROM team_b2_students a JOIN team_b2_students b ON a.school_id IS NOT DISTINCT FROM b.school_id AND a.record_id < b.record_id WHERE length(a.quote_text) > 0 AND length(b.quote_text) > 0 AND (contains(a.quote_text, substr(b.quote_text, 1, 80)) OR contains(b.quote_text, substr(a.quote_text, 1, 80)))",
)
def dedup_contained_heads(spark, folder):
    """Quotes whose first 80 characters stand in an earlier quote of the school, or that hold the first 80 of one."""
    return D.contained_heads(table(spark, folder, "team_b2_students"), "school_id", "record_id", "quote_text").withColumnRenamed("id", "record_id")


@query("dedup_similar")
def dedup_similar(spark, folder):
    """Near copies among the messages of each school."""
    return D.mark_similar(table(spark, folder, "team_c_llm_principal_round4"), "school_id", "record_id", "quote_text")


_SHORT = "regexp_replace(name_ja, '(?:中学校|中等部|中等教育学校)$', '')"


@query("names_in_texts", f"SELECT g.record_id, n.name FROM team_c1_gf g JOIN (SELECT DISTINCT {_SHORT} AS name FROM schools_v2) n ON contains(g.evidence_text, n.name) WHERE length(n.name) >= 3")
def names_in_texts(spark, folder):
    from loomtable.functions.text import without_suffix

    names = table(spark, folder, "schools_v2").select(without_suffix(F.col("name_ja"), ["中学校", "中等部", "中等教育学校"]).alias("name"))
    found = E.names_in_texts(table(spark, folder, "team_c1_gf"), "record_id", "evidence_text", names, "name", 3)
    return found.select(F.col("key").alias("record_id"), "name")


@query(
    "longest_name_in_text",
    f"SELECT record_id, name FROM (SELECT g.record_id, n.name, row_number() OVER (PARTITION BY g.record_id ORDER BY length(n.name) DESC, n.name) AS r FROM team_c1_gf g JOIN (SELECT DISTINCT {_SHORT} AS name FROM schools_v2) n ON contains(g.evidence_text, n.name) WHERE length(n.name) >= 3) WHERE r = 1",
)
def longest_name_in_text(spark, folder):
    from loomtable.functions.text import without_suffix

    names = table(spark, folder, "schools_v2").select(without_suffix(F.col("name_ja"), ["中学校", "中等部", "中等教育学校"]).alias("name"))
    found = E.names_in_texts(table(spark, folder, "team_c1_gf"), "record_id", "evidence_text", names, "name", 3)
    return E.longest_name(found).select(F.col("key").alias("record_id"), "name")


@query("unique_short_names", f"SELECT short, min(id) AS key FROM (SELECT DISTINCT id, {_SHORT} AS short FROM schools_v2) WHERE length(short) >= 2 GROUP BY 1 HAVING count(DISTINCT id) = 1")
def unique_short_names(spark, folder):
    return E.unique_short_names(table(spark, folder, "schools_v2"), "id", "name_ja", ["中学校", "中等部", "中等教育学校"])


@query("last_writer_names", f"SELECT {_SHORT} AS name, arg_max(id, row_id) AS value FROM schools_v2 GROUP BY 1")
def last_writer_names(spark, folder):
    from loomtable.functions.text import without_suffix

    schools = table(spark, folder, "schools_v2").withColumn("short", without_suffix(F.col("name_ja"), ["中学校", "中等部", "中等教育学校"]))
    return E.last_writer(schools, "short", "id", "row_id")


@query("context_match", "SELECT record_id FROM team_c1_gf WHERE regexp_matches(evidence_text, '蒼森(?:学園|に|へ|の)') AND NOT regexp_matches(evidence_text, '蒼森(?:大学|幼稚園|小学校)')")
def context_match(spark, folder):
    good = E.in_context(F.col("evidence_text"), "蒼森", ["学園", "に", "へ", "の"], ["大学", "幼稚園", "小学校"])
    return table(spark, folder, "team_c1_gf").filter(good).select("record_id")


_SUFFIX = "regexp_replace({0}, '(?:中学校|中等部|中等教育学校)$', '')"


@query(
    "resolve_names",
    "WITH c AS (SELECT record_id, list_concat([matched_school_name], regexp_split_to_array(matched_school_name, '[、,/／・|\\s]+')) AS parts FROM team_c1_gf WHERE matched_school_name IS NOT NULL), "
    f"p AS (SELECT record_id, pos, part, {_SUFFIX.format('part')} AS bare FROM (SELECT record_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM c) WHERE length(part) >= 2), "
    f"k AS (SELECT DISTINCT id, name_ja AS known, {_SUFFIX.format('name_ja')} AS kb FROM schools_v2), top AS (SELECT known, max(id) AS id FROM k GROUP BY 1), asked AS (SELECT DISTINCT part, bare FROM p), "
    "m AS (SELECT part, arg_max(known, (length(known), known)) AS known FROM asked JOIN (SELECT DISTINCT known FROM k) ON contains(part, known) OR contains(known, part) OR (length(bare) >= 2 AND contains(known, bare)) GROUP BY 1), "
    "e AS (SELECT record_id, pos, id, known, 1 AS tier FROM p JOIN k ON part = known UNION ALL SELECT record_id, pos, id, known, 2 FROM p JOIN k ON bare = kb WHERE length(bare) >= 2 UNION ALL SELECT record_id, pos, id, m.known, 3 FROM p JOIN m USING (part) JOIN top ON top.known = m.known) "
    "SELECT record_id, id AS school_id, tier FROM e QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY tier, pos, length(known) DESC, known DESC, id DESC) = 1",
)
def resolve_names(spark, folder):
    """Schools of claims by exact, suffix-free and contained names."""
    claims = table(spark, folder, "team_c1_gf").filter("matched_school_name IS NOT NULL")
    found = E.resolve_names(claims, "record_id", "matched_school_name", table(spark, folder, "schools_v2"), "id", "name_ja", ["中学校", "中等部", "中等教育学校"])
    return found.select(F.col("key").alias("record_id"), F.col("entity").alias("school_id"), "tier")


@query("biography_blobs", "SELECT gf_person_id, string_agg(part, ' ' ORDER BY record_id, k) AS blob FROM (SELECT gf_person_id, record_id, 1 AS k, name AS part FROM team_c1_gf UNION ALL SELECT gf_person_id, record_id, 2, category FROM team_c1_gf UNION ALL SELECT gf_person_id, record_id, 3, evidence_text FROM team_c1_gf) WHERE part IS NOT NULL GROUP BY 1")
def biography_blobs(spark, folder):
    g = table(spark, folder, "team_c1_gf")
    parts = g.select("gf_person_id", "record_id", F.posexplode(F.array("name", "category", "evidence_text")).alias("k", "part")).filter("part IS NOT NULL")
    ordered = F.array_sort(F.collect_list(F.struct("record_id", "k", "part")))  # the fields of one person
    return parts.groupBy("gf_person_id").agg(F.array_join(F.transform(ordered, lambda x: x.part), " ").alias("blob"))


_CURATED = "SELECT DISTINCT CASE WHEN record_id % 2 = 0 THEN substr(name, 1, 3) ELSE name END AS rule FROM team_c1_gf WHERE match_method = 'curated_rule' AND name IS NOT NULL"


@query(
    "curated_matches",
    f"WITH r AS (SELECT * FROM ({_CURATED}) WHERE length(rule) >= 2), p AS (SELECT DISTINCT name AS person FROM team_c1_gf WHERE name IS NOT NULL), e AS (SELECT rule, person FROM r JOIN p ON rule = person), rest AS (SELECT rule FROM r WHERE rule NOT IN (SELECT rule FROM e)) "
    "SELECT rule, person, 'exact' AS how FROM e UNION ALL SELECT rule, person, 'contained' FROM rest JOIN p ON contains(person, rule) OR (contains(rule, person) AND length(person) >= 2)",
)
def curated_matches(spark, folder):
    g = table(spark, folder, "team_c1_gf")
    rules = g.filter("match_method = 'curated_rule' AND name IS NOT NULL").select(F.when(F.col("record_id") % 2 == 0, F.substring("name", 1, 3)).otherwise(F.col("name")).alias("rule")).filter(F.length("rule") >= 2)
    return E.curated_matches(rules, g.select(F.col("name").alias("person")))
