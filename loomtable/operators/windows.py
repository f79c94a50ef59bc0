"""Row choices within groups, with a stated order, so that every run picks the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtable.session import cut_lineage

ColumnOrName = Column | str


def _order(columns: list[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def top_per_group(df: DataFrame, group: list[ColumnOrName], order: list[ColumnOrName], n: int | Column = 1) -> DataFrame:
    """The first n rows of each group; with a constant n each task keeps only n before the shuffle (WindowGroupLimit)."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*_order(order))))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def keep_first(df: DataFrame, key: list[ColumnOrName], order: list[ColumnOrName]) -> DataFrame:
    return top_per_group(df, key, order, 1)


def keep_longest(df: DataFrame, key: list[ColumnOrName], text: str, tie: str) -> DataFrame:
    return top_per_group(df, key, [F.length(text).desc(), tie], 1)


def cap_with_room(df: DataFrame, group: str, order: list[ColumnOrName], existing: DataFrame, cap: int) -> DataFrame:
    """At most cap rows per group together with those counted in existing(group, n_existing)."""
    room = df.join(existing.select(group, "n_existing"), group, "left").withColumn("_room", F.lit(cap) - F.coalesce("n_existing", F.lit(0)))
    return top_per_group(room.filter("_room > 0"), [group], order, F.col("_room")).drop("_room", "n_existing")


def carried_forward(df: DataFrame, group: str, order: list[ColumnOrName], value: str, into: str) -> DataFrame:
    """The last value that is not null, up to each row."""
    upto = Window.partitionBy(group).orderBy(*_order(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(into, F.last(value, ignorenulls=True).over(upto))


def with_neighbours(df: DataFrame, group: str, order: list[ColumnOrName], value: str) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*_order(order))
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


def section_spans(starts: DataFrame, group: str, at: str, end: str) -> DataFrame:
    """Each start with where the next one begins, the last with the end of its group."""
    following = F.lead(at).over(Window.partitionBy(group).orderBy(at))
    return starts.withColumn("until", F.coalesce(following, F.col(end)))


def placed(df: DataFrame, order: list[ColumnOrName], into: str) -> DataFrame:
    """df with the place of each row in the order, from 0: consecutive, each once.

    `order` must be total. A range-partitioned sort gives each row its partition and its
    place within it; both are written with the row, once, to the checkpoint folder. Rows and
    the sizes of the partitions are read from that one copy, so that they agree whatever
    AQE coalesces and however the range bounds were sampled. No task sorts the whole table.
    What is broadcast has a row per partition.
    """
    pinned = cut_lineage(df.repartitionByRange(*_order(order)).sortWithinPartitions(*_order(order)).withColumn("__placed_at", F.monotonically_increasing_id()))
    part, within = F.shiftrightunsigned("__placed_at", 33), F.col("__placed_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = pinned.groupBy(part.alias("__placed_part")).agg(F.count("*").alias("__placed_n"))
    before = Window.orderBy("__placed_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    sizes = sizes.select(F.col("__placed_part"), F.coalesce(F.sum("__placed_n").over(before), F.lit(0)).alias("__placed_before"))
    out = pinned.withColumn("__placed_part", part).join(F.broadcast(sizes), "__placed_part").withColumn(into, F.col("__placed_before") + within)
    return out.drop("__placed_at", "__placed_part", "__placed_before")


def even_ranges(df: DataFrame, order: str, n: int, into: str = "bucket") -> DataFrame:
    """n contiguous ranges of almost equal size over the whole order, larger ones first.

    Sizes follow from the count, positions from `placed`; `order` must be total.
    """
    rows = placed(df, [order], "__place")
    place = F.col("__place")
    whole = rows.agg(F.count("*").alias("__place_all"))  # one row
    small, extra = F.floor(F.col("__place_all") / n), F.col("__place_all") % n
    bucket = F.when(place < extra * (small + 1), F.floor(place / (small + 1))).otherwise(extra + F.floor((place - extra * (small + 1)) / F.greatest(small, F.lit(1)))) + 1
    return rows.crossJoin(F.broadcast(whole)).withColumn(into, bucket.cast("int")).drop("__place", "__place_all")


def order_statistics(df: DataFrame, columns: list[str], shares: list[float], group: list[str] = ()) -> DataFrame:
    """(group, one column `<column>_<k>` per column and share): exact interpolated percentiles, without a task that holds a group.

    Each column's distinct values are counted before the shuffle. A range-partitioned sort
    places them, running counts come from the counts per partition and group, and only the
    values on which a share falls are kept: two per group, column and share. Nulls are no
    values; a group without values has nulls.
    """
    keys = [F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]
    names = [f"_g{i}" for i in range(len(group))]
    stacked = F.explode(F.array(*(F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns)))
    counted = df.select(*keys, stacked.alias("x")).select(*names, "x._c", "x._v").filter("_v IS NOT NULL").groupBy(*names, "_c", "_v").agg(F.count("*").alias("_k"))
    ordered = cut_lineage(counted.repartitionByRange("_c", *names, "_v").sortWithinPartitions("_c", *names, "_v").withColumn("_part", F.spark_partition_id()))
    cells = [*names, "_c"]
    sums = ordered.groupBy(*cells, "_part").agg(F.sum("_k").alias("_s"))  # a row per cell, and one more per partition
    earlier = Window.partitionBy(*cells).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_s").over(earlier), F.lit(0))).withColumn("_n", F.sum("_s").over(Window.partitionBy(*cells)))
    sums = sums.select(*(F.col(c).alias(f"s{c}") for c in [*cells, "_part"]), "_before", "_n")
    same = [F.col(c).eqNullSafe(F.col(f"s{c}")) for c in [*cells, "_part"]]
    upto = Window.partitionBy(*cells, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one partition's values
    run = ordered.join(sums, same).withColumn("_last", F.col("_before") + F.sum("_k").over(upto))
    first = F.col("_last") - F.col("_k")
    at = [F.lit(float(s)) * (F.col("_n") - 1) for s in shares]
    holds = lambda place: (first <= place) & (place < F.col("_last"))
    picked = run.filter(F.expr("false") if not shares else _any([holds(F.floor(a)) | holds(F.ceil(a)) for a in at]))
    parts = []
    for c in columns:
        for k, a in enumerate(at):
            low, high = (F.max(F.when((F.col("_c") == c) & holds(f(a)), F.col("_v"))) for f in (F.floor, F.ceil))
            rest = F.max(F.when(F.col("_c") == c, a - F.floor(a)))
            parts.append((low + (high - low) * rest).alias(f"{c}_{k}"))
    found = picked.groupBy(*names).agg(*parts)
    if not group:
        return found
    every = df.select(*keys).distinct().select(*(F.col(n).alias(f"e{n}") for n in names))
    joined = every.join(found, [F.col(f"e{n}").eqNullSafe(F.col(n)) for n in names], "left")
    return joined.select(*(F.col(f"e{n}").alias(g) for n, g in zip(names, group)), *(f"{c}_{k}" for c in columns for k in range(len(shares))))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out
