"""Facts stated in running text: admissions, destinations, facilities, quotes and links.

All are column expressions: patterns find windows of the text, numbers outside of plausible
bounds become null, rules are given as tables, and what is found of a text is one array that
is exploded in place. No Python, no shuffle. Null and empty texts state nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.operators.extract import plausible

NUMBER = "[0-9][0-9,]*"


def number_after(text: Column, cue: str, unit: str, low: int, high: int, gap: int = 10) -> Column:
    """The first number that stands with its unit within `gap` characters after a cue, if plausible."""
    return plausible(F.regexp_extract(text, f"(?:{cue})[^0-9\\n]{{0,{gap}}}({NUMBER})\\s*(?:{unit})", 1), low, high)


def labelled(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first rule (label, pattern) that fits."""
    out = F.lit(otherwise)
    for label, pattern in reversed(rules):
        out = F.when(text.rlike(pattern), label).otherwise(out)
    return out


def admission_facts(df: DataFrame, key: str, text: str, types: list[tuple[str, str]], most: int = 3) -> DataFrame:
    """(key, kind, exam_type, applicants, admitted, ratio, details), at most `most` per text in the order quota, results, details.

    A quota is a number of places after 募集, its type that named in the same sentence before
    it. Results are applicants, admitted and ratio of a line that begins with applicants; a
    number that is not plausible is null, and a line without any is none. Details are dates,
    minutes per subject (the first of each), points and the fee, as JSON.
    """
    t = F.col(text)
    none = F.lit(None)
    row = lambda kind, exam=none, applicants=none, admitted=none, ratio=none, details=none: F.struct(
        F.lit(kind).alias("kind"), exam.cast("string").alias("exam_type"), applicants.cast("int").alias("applicants"), admitted.cast("int").alias("admitted"), ratio.cast("double").alias("ratio"), details.cast("string").alias("details")
    )
    quotas = F.transform(F.regexp_extract_all(t, F.lit(f"([^。\\n]{{0,40}}募集[^。、\\n]{{0,40}}?{NUMBER}\\s*名)"), F.lit(1)), lambda w: row("quota", labelled(w, types, "一般"), admitted=number_after(w, "募集", "名", 5, 1500, 40)))
    quotas = F.filter(quotas, lambda r: r.admitted.isNotNull())
    ratio = lambda w: F.regexp_extract(w, "倍率[^0-9\\n]{0,6}([0-9]+\\.[0-9]{1,2})", 1).try_cast("double")
    results = F.transform(
        F.regexp_extract_all(t, F.lit("((?:受験者|志願者)[^\\n]{0,200})"), F.lit(1)),
        lambda w: row("results", labelled(w, types, "一般"), number_after(w, "受験者|志願者", "名|人", 5, 5000), number_after(w, "合格者", "名|人", 1, 1500), F.when(ratio(w).between(0.5, 30), ratio(w))),
    )
    results = F.filter(results, lambda r: F.coalesce(r.applicants, r.admitted, r.ratio).isNotNull())
    dates = F.slice(F.regexp_extract_all(t, F.lit("(?:入試|試験日)[^。\\n]{0,30}?([0-9]{1,2}月[0-9]{1,2}日)"), F.lit(1)), 1, 4)
    subject, minutes = (F.regexp_extract_all(t, F.lit("(国語|算数|理科|社会|数学|英語)\\s*([0-9]{2,3})\\s*分"), F.lit(k)) for k in (1, 2))
    first = F.transform(F.array_distinct(subject), lambda s: F.struct(s.alias("subject"), F.get(minutes, F.array_position(subject, s) - 1).cast("int").alias("minutes")))
    points, fee = number_after(t, "合計", "点", 50, 1500, 5), number_after(t, "検定料|受験料", "円", 1000, 200000, 15)
    details = F.to_json(F.struct(F.when(F.size(dates) > 0, dates).alias("dates"), F.when(F.size(first) > 0, first).alias("subjects"), points.alias("points"), fee.alias("fee")))
    detailed = F.when(details != "{}", F.array(row("details", F.lit("一般"), details=details))).otherwise(F.array().cast("array<struct<kind:string,exam_type:string,applicants:int,admitted:int,ratio:double,details:string>>"))
    return df.filter(t.isNotNull()).select(key, F.explode(F.slice(F.concat(quotas, results, detailed), 1, most)).alias("f")).select(key, "f.*")


def destinations(df: DataFrame, key: str, text: str, rules: list[tuple[str, str, str]], most: int = 15) -> DataFrame:
    """(key, name, kind, count, year, how) of the places of rules (name, kind, pattern) that a text names, at most `most`.

    'counted': a number of at most three digits right after the name (a remark in brackets
    may stand between), unless it counts pages or bytes; then 'named' without a number; only
    if there is neither, 'years': up to three years of which the text offers a list as PDF.
    """
    t = F.col(text)

    def rule(name: str, kind: str, pattern: str) -> Column:
        near = f"(?:{pattern})\\s*(?:[(（][^)）\\n]{{0,10}}[)）]\\s*)?([0-9]{{1,3}})((?:[^0-9.][^\\n]{{0,8}})?)(?:[^0-9.]|$)"
        count = F.when(~F.regexp_extract(t, near, 2).rlike("PDF|ページ|kB|MB"), F.regexp_extract(t, near, 1)).try_cast("int")
        count = F.when(count > 0, count)
        made = lambda how, n: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("kind"), n.cast("int").alias("count"), F.lit(None).cast("int").alias("year"), F.lit(how).alias("how"))
        return F.when(count.isNotNull(), made("counted", count)).when(t.rlike(pattern), made("named", F.lit(None)))

    found = F.array_compact(F.array(*(rule(*r) for r in rules)))
    ordered = F.concat(F.filter(found, lambda r: r.how == "counted"), F.filter(found, lambda r: r.how == "named"))
    years = F.slice(F.regexp_extract_all(t, F.lit("(20[12][0-9])[^()（）\\n]{0,8}年[^()（）\\n]{0,8}[（(]?PDF"), F.lit(1)), 1, 3)
    listed = F.transform(years, lambda y: F.struct(F.lit("PDF").alias("name"), F.lit("aggregate").alias("kind"), F.lit(None).cast("int").alias("count"), y.cast("int").alias("year"), F.lit("years").alias("how")))
    rows = F.when(F.size(ordered) > 0, F.slice(ordered, 1, most)).otherwise(listed)
    return df.filter(t.isNotNull()).select(key, F.explode(rows).alias("d")).select(key, "d.*")


def facilities(df: DataFrame, key: str, text: str, rules: list[tuple[str, str]], notable: str, most: int = 10) -> DataFrame:
    """(key, kind, snippet, notable, capacity) of the first place where each rule (kind, pattern) fits, at most `most` per text."""
    t = F.col(text)

    def rule(kind: str, pattern: str) -> Column:
        snippet = F.regexp_extract(t, f"([^\\n]{{0,20}}(?:{pattern})[^\\n]{{0,20}})", 1)
        return F.when(t.rlike(pattern), F.struct(F.lit(kind).alias("kind"), snippet.alias("snippet"), snippet.rlike(notable).alias("notable"), plausible(F.regexp_extract(snippet, f"({NUMBER})\\s*(?:人|名|席)", 1), 1, 20000).alias("capacity")))

    return df.filter(t.isNotNull()).select(key, F.explode(F.slice(F.array_compact(F.array(*(rule(*r) for r in rules))), 1, most)).alias("f")).select(key, "f.*")


ATTRIBUTED = "([^。、\\n「」]{0,20})「([^「」\\n]{5,200})」と(?:話|語|述べ|言|教え|ある|あった)"


def attributed_quotes(text: Column) -> Column:
    """array(struct(lead, quote)) of quotes that someone is said to have spoken."""
    lead, quote = (F.regexp_extract_all(text, F.lit(ATTRIBUTED), F.lit(k)) for k in (1, 2))
    return F.arrays_zip(lead.alias("lead"), quote.alias("quote"))


FIRST_PERSON = "私|僕|自分|(?:^|[^A-Za-z])(?:I|[Mm]y)(?:[^A-Za-z]|$)"


def first_person(sentences: Column) -> Column:
    """The sentences in which the writer speaks of themselves."""
    return F.filter(sentences, lambda s: s.rlike(FIRST_PERSON))


def absolute_url(base: Column, link: Column) -> Column:
    """A link as seen from a page, without its fragment; null for what is no address of the web."""
    link = F.regexp_replace(F.trim(link), "#.*$", "")
    root, folder = F.regexp_extract(base, "^(https?://[^/?#]+)", 1), F.regexp_extract(F.regexp_replace(base, "[?#].*$", ""), "^(https?://[^/]+(?:/.*)?/)[^/]*$", 1)
    folder = F.when(folder == "", F.concat(root, F.lit("/"))).otherwise(folder)
    whole = (
        F.when(link.rlike("(?i)^https?://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.startswith("?"), F.concat(F.regexp_replace(base, "[?#].*$", ""), link))
        .when(link != "", F.concat(folder, link))
    )
    plain = F.regexp_replace(whole, "/(?:\\./)+", "/")
    ups = F.sequence(F.lit(0), F.regexp_count(plain, F.lit("/\\.\\.(?=/|$)")))
    return F.aggregate(ups, plain, lambda u, _: F.regexp_replace(u, "^(https?://[^/]+)(?:(.*?)/(?!\\.\\./)[^/]+)?/\\.\\.(?:/|$)", "$1$2/"))


def subpages(df: DataFrame, key: str, base: str, links: str, scores: list[tuple[str, int]], skipped: str = "pdf|jpe?g|png|gif|zip|docx?|xlsx?|mp4|css|js") -> DataFrame:
    """(key, url, score) of the links (an array) of a page to other pages of its host, with a score above 0, the best first by `rank`.

    A score adds the points of each rule (pattern, points) that fits the address. Files of
    the skipped endings and the page itself are left out; repeated links are one.
    """
    host = lambda u: F.regexp_extract(F.lower(u), "^https?://([^/?#:]+)", 1)
    urls = F.array_distinct(F.array_compact(F.transform(F.col(links), lambda x: absolute_url(F.col(base), x))))
    rows = df.select(key, F.col(base).alias("__base"), F.explode(urls).alias("url"))
    rows = rows.filter((host(F.col("url")) == host(F.col("__base"))) & ~F.lower("url").rlike(f"\\.(?:{skipped})(?:\\?|$)") & (F.col("url") != F.regexp_replace("__base", "#.*$", "")))
    score = reduce(lambda a, b: a + b, (F.when(F.lower("url").rlike(p), n).otherwise(0) for p, n in scores))
    return rows.select(key, "url", score.alias("score")).filter("score > 0")
