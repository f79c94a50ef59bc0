"""Functional merges: each gives the new state of a table from the old one and a change.

The result is written in one overwrite or partition swap, so a job that runs again gives the
same table. Keys are compared with nulls equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.operators.windows import ColumnOrName, placed, top_per_group
from loomtable.session import cut_lineage


def _anti(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    keys = b.select(*(F.col(k).alias(f"_{k}") for k in key)).distinct()
    return a.join(keys, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[ColumnOrName] | None = None) -> DataFrame:
    """New rows replace old ones of the same key; of several new ones the last by `order`."""
    last = top_per_group(new, list(key), [o.desc() if isinstance(o, Column) else F.desc(o) for o in order], 1) if order else new
    return _anti(old, last, key).unionByName(last.select(old.columns))


def insert_absent(old: DataFrame, new: DataFrame, key: list[str], order: list[ColumnOrName]) -> DataFrame:
    """Only new rows of keys that are not there; of several the first."""
    return old.unionByName(top_per_group(_anti(new, old, key), list(key), order, 1).select(old.columns))


def replace_keys(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """All old rows of the keys in new go, all new rows come: an idempotent seed."""
    return _anti(old, new, key).unionByName(new.select(old.columns))


def fill_missing(old: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Values fill what is null or empty; what is there stays. values has one row per key."""
    given = values.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
    return old.join(given, F.col(key) == F.col("_k"), "left").withColumn(column, F.coalesce(F.nullif(column, F.lit("")), "_v")).drop("_k", "_v")


def partial_update(old: DataFrame, changes: DataFrame, key: str, columns: list[str], clear: str | None = None) -> DataFrame:
    """Values that are given overwrite, nulls leave; columns are forced to null where `clear` is true."""
    given = changes.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns), *([F.col(clear).alias("_clear")] if clear else []))
    joined = old.join(given, F.col(key) == F.col("_k"), "left")
    gone = F.coalesce("_clear", F.lit(False)) if clear else F.lit(False)
    return joined.select(*(F.when(gone, None).otherwise(F.coalesce(f"_{c}", c)).alias(c) if c in columns else F.col(c) for c in old.columns))


def restore(current: DataFrame, snapshot: DataFrame, key: str, columns: list[str], where: Column) -> DataFrame:
    """Rows that meet `where` take their columns back from a snapshot that holds them."""
    kept = snapshot.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns))
    joined = current.join(kept, F.col(key) == F.col("_k"), "left")
    back = F.coalesce(where, F.lit(False)) & F.col("_k").isNotNull()
    return joined.select(*(F.when(back, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in current.columns))


def without_note(notes: Column, pattern: str) -> Column:
    """A '; ' separated note without the segments that match; null if none is left."""
    left = F.filter(F.split(notes, "; "), lambda s: ~s.rlike(pattern))
    return F.nullif(F.array_join(left, "; "), F.lit(""))


def numbered(df: DataFrame, order: list[str], into: str, after: int = 0) -> DataFrame:
    """Consecutive numbers in a total order, from after + 1 (see windows.placed)."""
    return placed(df, list(order), into).withColumn(into, F.col(into) + after + 1)


def padded(number: Column, width: int) -> Column:
    """A number's digits with leading zeros up to a width; longer ones stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def next_ids(df: DataFrame, existing: DataFrame, id_column: str, order: list[str], prefix: str, width: int) -> DataFrame:
    """df with ids that go on after the largest numeric suffix in use, zero-padded to a width at least."""
    largest = existing.select(F.max(F.regexp_extract(id_column, "([0-9]+)$", 1).try_cast("bigint"))).first()[0] or 0
    return numbered(df, order, "_id", largest).withColumn(id_column, F.concat(F.lit(prefix), padded(F.col("_id"), width))).drop("_id")


def find_or_create(asked: DataFrame, stored: DataFrame, key: str, prefix: str, width: int, no_title: str = "(no title)") -> DataFrame:
    """asked's rows with source_id and is_new (whether the source was created for these rows).

    asked(key, url, title), stored(id, url, title). The result is that of asking row by row
    in the order of the key: by address; else by title among sources without an address;
    else a source of the row's address and title is made, and later rows find it. Ids of new
    sources go on after the largest stored number, in the order in which they are made; of
    several stored sources that fit, the smallest id is taken. Null and blank addresses are
    none, null and blank titles are `no_title`.

    Only the first row of each pair of address and title can make a source, so all is decided
    on distinct pairs and only their outcome is joined to the rows.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    title = lambda c: F.coalesce(blank(c), F.lit(no_title))
    rows = asked.withColumn("_url", blank(F.col("url"))).withColumn("_title", title(F.col("title")))
    held = stored.select("id", blank(F.col("url")).alias("_u"), title(F.col("title")).alias("_t"))
    by_url = held.filter("_u IS NOT NULL").groupBy("_u").agg(F.min("id").alias("_by_url"))
    by_title = held.filter("_u IS NULL").groupBy("_t").agg(F.min("id").alias("_by_title"))
    pairs = rows.groupBy("_url", "_title").agg(F.min(key).alias("_first"))
    pairs = pairs.join(by_url, F.col("_url") == F.col("_u"), "left").join(by_title, F.col("_title") == F.col("_t"), "left").drop("_u", "_t")
    pairs = cut_lineage(pairs)
    # a title has a source of its own from its first row without an address on
    titled = pairs.filter("_url IS NULL AND _by_title IS NULL").select(F.col("_title").alias("_t"), F.col("_first").alias("_since"))
    # an address is made by its first row that finds neither
    may = pairs.filter("_url IS NOT NULL AND _by_url IS NULL AND _by_title IS NULL").join(titled, F.col("_title") == F.col("_t"), "left")
    made = may.filter(F.col("_since").isNull() | (F.col("_first") < F.col("_since"))).groupBy(F.col("_url").alias("_u")).agg(F.min("_first").alias("_made"))
    largest = stored.select(F.max(F.regexp_extract("id", "([0-9]+)$", 1).try_cast("bigint"))).first()[0] or 0
    fresh = made.select(F.col("_u"), F.lit(None).cast("string").alias("_t"), F.col("_made").alias("_at")).unionByName(titled.select(F.lit(None).cast("string").alias("_u"), "_t", F.col("_since").alias("_at")))
    ids = cut_lineage(numbered(fresh, ["_at"], "_number", largest).withColumn("_id", F.concat(F.lit(prefix), padded(F.col("_number"), width))))
    of_url = ids.filter("_u IS NOT NULL").select("_u", F.col("_at").alias("_made"), F.col("_id").alias("_new_url"))
    of_title = ids.filter("_u IS NULL").select("_t", F.col("_id").alias("_new_title"))
    outcome = pairs.drop("_first").join(of_url, F.col("_url") == F.col("_u"), "left").join(of_title, F.col("_title") == F.col("_t"), "left").drop("_u", "_t").withColumnsRenamed({"_url": "_pu", "_title": "_pt"})
    joined = rows.join(outcome, F.col("_url").eqNullSafe(F.col("_pu")) & (F.col("_title") == F.col("_pt")))
    own = F.col("_by_url").isNull() & F.col("_made").isNotNull() & (F.col("_made") <= F.col(key))
    source = F.when(F.col("_by_url").isNotNull(), F.col("_by_url")).when(own, F.col("_new_url")).otherwise(F.coalesce("_by_title", "_new_title"))
    return joined.select(*asked.columns, source.alias("source_id"), (F.col("_by_url").isNull() & (own | F.col("_by_title").isNull())).alias("is_new"))


def fanned_out(df: DataFrame, keep: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per column that is not null: keep, kind, value."""
    pairs = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value")) for c, kind in columns.items())))
    return df.select(*keep, pairs.alias("x")).select(*keep, "x.kind", "x.value").filter("value IS NOT NULL")
