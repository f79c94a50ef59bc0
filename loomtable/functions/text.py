"""Scalar text functions as JVM-side column expressions.

All keep null as null and count code points. Patterns use only what Java and RE2 share.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SENTENCE_MARKS = "。.!?！？"


@F.pandas_udf(StringType())
def nfkc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility composition; no JVM function has it, so batches cross by Arrow."""
    for batch in texts:
        yield batch.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def collapse_space(text: Column) -> Column:
    """Runs of blanks of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s\x{00A0}\x{3000}]+", " "))


def strip_html(html: Column) -> Column:
    """Text of markup: scripts, styles and comments dropped, tags and entities as blanks, blanks collapsed."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return collapse_space(F.regexp_replace(bare, r"(?s)<[^>]+>|&[A-Za-z#0-9]+;", " "))


def sentences(text: Column) -> Column:
    """Array of sentences with their marks; pieces without a mark count, blank ones do not."""
    parts = F.split(F.regexp_replace(text, "([。.!?！？]+)", "$1\u0001"), "[\u0001\n]")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda s: s != "")


def last_mark(text: Column, marks: Iterable[str]) -> Column:
    """Position, from 1, of the last of the marks; 0 if there is none."""
    return F.greatest(*(F.when(F.instr(text, m) > 0, F.length(text) - F.instr(F.reverse(text), m) + 1).otherwise(0) for m in marks))


def cut_at_mark(text: Column, most: int, least: int, marks: Iterable[str] = "。.!?") -> Column:
    """At most `most` characters, ending at the last mark beyond `least`, else with an ellipsis."""
    head = F.substring(text, 1, most)
    at = last_mark(head, marks)
    return F.when(F.length(text) <= most, text).when(at > least, F.substring(head, F.lit(1), at)).otherwise(F.concat(head, F.lit("…")))


def summary(text: Column, most: int = 50, least: int = 20, keep_mark: bool = True) -> Column:
    """The first characters up to the last comma or stop beyond `least`, with or without it."""
    head = F.substring(text, 1, most)
    at = last_mark(head, "。、")
    return F.when(F.length(text) <= most, text).when(at > least, F.substring(head, F.lit(1), at if keep_mark else at - 1)).otherwise(head)


def shortened(text: Column, most: int) -> Column:
    """Blanks collapsed; longer texts end in three dots within `most` characters."""
    t = collapse_space(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substring(t, 1, most - 3), F.lit("...")))


def around(text: Column, term: str, before: int, after: int) -> Column:
    """The stretch around the first occurrence of a term; null if it does not occur."""
    at = F.instr(text, term)
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at + len(term) + after - start))


def head_key(group: Column, text: Column, n: int) -> Column:
    """md5 of a group and the first n characters, for deduplication."""
    return F.md5(F.concat(group, F.lit("|"), F.substring(text, 1, n)))


def head_tail_key(text: Column, head: int = 80, tail: int = 30) -> Column:
    """md5 of both ends of a text without blanks."""
    t = F.regexp_replace(text, r"[\s\x{3000}]+", "")
    return F.md5(F.concat(F.substring(t, 1, head), F.lit("||"), F.right(t, F.lit(tail))))


def anonymous_id(value: Column, n: int = 16) -> Column:
    return F.concat(F.lit("anon_"), F.substring(F.sha2(value.cast("string"), 256), 1, n))


def number_in(text: Column) -> Column:
    """The first number of a text, thousand separators allowed; null if there is none."""
    return F.regexp_replace(F.nullif(F.regexp_extract(text, r"[0-9][0-9,]*(\.[0-9]+)?", 0), F.lit("")), ",", "").try_cast("double")


_ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018}


def year_in(text: Column, first: int = 1600, last: int = 2100) -> Column:
    """The first western year within bounds, else the first year of an era."""
    west = F.regexp_extract(text, r"([0-9]{4})年", 1).try_cast("int")
    eras = [F.regexp_extract(text, f"{era}([0-9]{{1,2}})年", 1).try_cast("int") + base for era, base in _ERAS.items()]
    return F.coalesce(F.when(west.between(first, last), west), *eras)


def url_host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"^https?://([^/?#]+)", 1), F.lit(""))


def url_path(url: Column) -> Column:
    """The path without query and fragment; '/' if it is empty."""
    path = F.regexp_extract(url, r"^https?://[^/?#]+([^?#]*)", 1)
    return F.when(url_host(url).isNotNull(), F.when(path == "", "/").otherwise(path))


def slug(url: Column, most: int = 60) -> Column:
    """A file name made of a URL's path."""
    bare = F.regexp_replace(F.regexp_replace(url_path(url), r"\.[A-Za-z0-9]+$", ""), r"[^A-Za-z0-9]+", "_")
    return F.substring(F.when(F.length(F.regexp_replace(bare, "_", "")) == 0, "index").otherwise(F.regexp_replace(bare, "^_+|_+$", "")), 1, most)


def weighted_terms(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the terms that occur, each once."""
    return reduce(lambda a, b: a + b, (F.when(F.contains(text, F.lit(t)), w).otherwise(0) for t, w in weights.items()), F.lit(0))


def distinct_terms(text: Column, terms: Iterable[str]) -> Column:
    return weighted_terms(text, dict.fromkeys(terms, 1))


def without_suffix(text: Column, suffixes: Iterable[str], all_of_them: bool = False) -> Column:
    """The text without the first suffix that fits, or without every one in turn."""
    options = "|".join(suffixes)
    return F.regexp_replace(text, f"(?:{options})+$" if all_of_them else f"(?:{options})$", "")


def first_part(text: Column, delimiters: str = r"[、。,/／・\s]") -> Column:
    return F.element_at(F.split(text, delimiters), 1)


def class_share(text: Column, characters: str) -> Column:
    """Share of a character class, given as what stands in brackets of a regular expression."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, f"[{characters}]", ""))) / n).otherwise(F.lit(0.0))


def occurrences(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def escape_html(text: Column) -> Column:
    out = text
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def days_and_nights(text: Column, default: int = 1) -> Column:
    """Days of a stay said as nights and days; of one that says nothing, the default."""
    days = F.regexp_extract(text, "([0-9]+)日", 1).try_cast("int")
    nights = F.regexp_extract(text, "([0-9]+)泊", 1).try_cast("int")
    return F.coalesce(days, nights + 1, F.lit(default))


def packed_lines(pieces: Column, most: int) -> Column:
    """Pieces joined in order to lines of at most `most` characters; a fold, since each break depends on the last."""
    start = F.array().cast("array<string>")
    step = lambda acc, p: F.when(
        (F.size(acc) > 0) & (F.length(F.element_at(acc, -1)) + F.length(p) <= most),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat(F.element_at(acc, F.greatest(F.size(acc), F.lit(1))), p))),
    ).otherwise(F.concat(acc, F.array(p)))
    return F.aggregate(pieces, start, step)
