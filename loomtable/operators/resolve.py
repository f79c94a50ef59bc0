"""Names in texts, and names to entities."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtable.functions.text import without_suffix
from loomtable.session import cut_lineage


AUTOMATON_NAMES = 200_000  # counted names up to which an automaton of them is sent to the tasks


@lru_cache(2)
def _automaton(digest: str, names: tuple[str, ...]):
    """A search over all names at once; digest stands for them in the cache."""
    try:
        import ahocorasick
    except ImportError:
        known, lengths = frozenset(names), sorted({len(n) for n in names})
        return lambda t: ((i + n - 1, t[i : i + n]) for n in lengths for i in range(len(t) - n + 1) if t[i : i + n] in known)
    search = ahocorasick.Automaton()
    for n in names:
        search.add_word(n, n)
    search.make_automaton()
    return search.iter


def _places(batches: Iterator[pa.RecordBatch], found: Callable[[str], Iterator[tuple[str, int]]]) -> Iterator[pa.RecordBatch]:
    """Rows (key, name, at) of the first place of each name that `found` gives of a text."""

    def made(kind: pa.DataType) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(parts, pa.string()), pa.array(places, pa.int32())], names=["key", "name", "at"])
        for kept in (ids, parts, places):
            kept.clear()
        return out

    ids, parts, places = [], [], []
    for batch in batches:
        kind = batch.schema.field(0).type
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            first: dict[str, int] = {}
            for name, at in found(t):
                if first.setdefault(name, at) > at:
                    first[name] = at
            ids += [k] * len(first)
            parts += first.keys()
            places += first.values()
            if len(ids) > 100_000:
                yield made(kind)
        if ids:
            yield made(kind)


def names_in_texts(texts: DataFrame, key: str, text: str, names: DataFrame, name: str, least: int = 2) -> DataFrame:
    """(key, name, at): every name that occurs in each text, with its first position from 1.

    Names are counted. Up to AUTOMATON_NAMES of them go to the tasks as one automaton, and
    only what matches leaves a batch. Beyond, a text is cut into all its stretches of the
    lengths that names have, and stretches meet names by equality; the lengths are few
    numbers and go through the driver. No pair of text and name is formed that does not match.
    """
    known = cut_lineage(names.select(F.col(name).alias("name")).filter(F.length("name") >= least).distinct())
    rows = texts.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, name string, at int"
    n = known.count()
    if n == 0:
        return rows.limit(0).select("key", F.lit("").alias("name"), F.lit(0).alias("at"))
    if n <= AUTOMATON_NAMES:
        some = tuple(sorted(r[0] for r in known.collect()))  # counted above
        digest = hashlib.sha256("\0".join(some).encode("utf-8", "surrogatepass")).hexdigest()

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hits = _automaton(digest, some)
            return _places(batches, lambda t: ((name, end - len(name) + 2) for end, name in hits(t)))

        return rows.mapInArrow(search, schema)
    lengths = sorted(r[0] for r in known.select(F.length("name")).distinct().collect())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _places(batches, lambda t: ((t[i : i + n], i + 1) for n in lengths for i in range(len(t) - n + 1)))

    return rows.mapInArrow(cut, schema).join(known, "name").select("key", "name", "at")


def longest_name(found: DataFrame) -> DataFrame:
    """Of each text the longest name; of equals the first in the alphabet."""
    w = Window.partitionBy("key").orderBy(F.length("name").desc(), "name")
    return found.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def unique_short_names(entities: DataFrame, key: str, name: str, suffixes: list[str], least: int = 2) -> DataFrame:
    """(short, key): names without their suffix that stand for one entity only."""
    short = entities.select(F.col(key).alias("key"), without_suffix(F.col(name), suffixes).alias("short")).filter(F.length("short") >= least)
    return short.groupBy("short").agg(F.min("key").alias("key"), F.max("key").alias("_other")).filter("key = _other").select("short", "key")


def last_writer(entities: DataFrame, name: str, value: str, order: str) -> DataFrame:
    """(name, value): of several values the one written last."""
    return entities.groupBy(F.col(name).alias("name")).agg(F.max_by(value, order).alias("value"))


def resolve_names(names: DataFrame, key: str, name: str, entities: DataFrame, entity: str, entity_name: str, suffixes: list[str], separators: str = r"[、,/／・|\s]+") -> DataFrame:
    """(key, entity, tier): the entity of each name; parts of a name are tried in order.

    Tier 1 is the same name, 2 the same without suffixes, 3 a name that stands anywhere in
    the other, the asked one also without its suffix. A form of one character asks for
    nothing. Within a tier the longest name wins, then the larger name, then the larger key.
    Containment is found by names_in_texts, and of each part only the longest name met goes on.
    """
    parts = names.select(F.col(key).alias("key"), F.posexplode(F.concat(F.array(F.col(name)), F.split(F.col(name), separators))).alias("pos", "part")).filter(F.length("part") >= 2)
    known = entities.select(F.col(entity).alias("entity"), F.col(entity_name).alias("known")).distinct()
    bare = lambda c: without_suffix(F.col(c), suffixes)
    one = parts.join(known, parts.part == known.known).select("key", "pos", "entity", "known", F.lit(1).alias("tier"))
    two = parts.withColumn("b", bare("part")).join(known.withColumn("kb", bare("known")), F.col("b") == F.col("kb")).filter(F.length("b") >= 2).select("key", "pos", "entity", "known", F.lit(2).alias("tier"))
    asked = parts.select("part").distinct()
    sought = asked.select("part", F.explode(F.array_distinct(F.array("part", bare("part")))).alias("form"))
    inside = names_in_texts(asked, "part", "part", known, "known", 1).select(F.col("key").alias("part"), F.col("name").alias("known"))
    around = names_in_texts(known.select("known").distinct(), "known", "known", sought, "form").select(F.col("key").alias("known"), F.col("name").alias("form"))
    met = inside.union(around.join(sought, "form").select("part", "known")).groupBy("part").agg(F.max_by("known", F.struct(F.length("known"), "known")).alias("known"))
    three = parts.join(met, "part").join(known.groupBy("known").agg(F.max("entity").alias("entity")), "known").select("key", "pos", "entity", "known", F.lit(3).alias("tier"))
    every = one.union(two).union(three)
    w = Window.partitionBy("key").orderBy("tier", "pos", F.length("known").desc(), F.desc("known"), F.desc("entity"))
    return every.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("key", "entity", "tier")


def in_context(text: Column, name: str, followed_by: list[str], not_followed_by: list[str] = ()) -> Column:
    """Whether a name occurs right before one of the words, and never right before a word that rules it out."""
    good = text.rlike(f"{name}(?:{'|'.join(followed_by)})")
    return good & ~text.rlike(f"{name}(?:{'|'.join(not_followed_by)})") if not_followed_by else good


def curated_matches(rules: DataFrame, persons: DataFrame, least: int = 2) -> DataFrame:
    """(rule, person, how): persons of rules(rule) by the same name; a rule that no one has, by containment either way.

    Containment is found by names_in_texts, never by pairs.
    """
    rules = rules.select("rule").filter("rule IS NOT NULL").distinct()
    persons = persons.select("person").filter("person IS NOT NULL").distinct()
    exact = rules.join(persons, rules.rule == persons.person).select("rule", "person", F.lit("exact").alias("how"))
    rest = rules.join(exact.select("rule"), "rule", "left_anti")
    inside = names_in_texts(persons, "person", "person", rest, "rule", least).select(F.col("name").alias("rule"), F.col("key").alias("person"))
    around = names_in_texts(rest, "rule", "rule", persons, "person", least).select(F.col("key").alias("rule"), F.col("name").alias("person"))
    return exact.unionByName(inside.unionByName(around).distinct().withColumn("how", F.lit("contained")))
