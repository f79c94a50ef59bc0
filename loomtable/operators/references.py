"""Orphan references by bitmap algebra over (key range, period) cells.

Keys are dictionary-encoded as integers, 32,768 keys to a range. The references of a table
in a period are a bitmap per range; of the parents there is a bitmap of those that begin in
a period and one of those that end in it, so a parent counts twice however long it exists.
A walk over the periods of a range keeps the running `begun` and `ended` bitmaps, in
compressed containers, and takes

    there all through = begun before AND NOT ended up to now
    there in part     = begun up to now AND NOT ended before, AND NOT there all through
    orphans           = references AND NOT (all through OR in part)

Surviving bits are decoded to keys and records. References that hit a parent which is there
in part of their period are settled by comparing times, record by record. Parents with
several spans stand in several layers, one span each, that are united.

Scale: what is shuffled is one row per distinct (table, period, key) and two per span of a
parent, however often a key is referenced, so a key that a third of all rows refer to weighs
as much as any other. A walk holds the containers of one range. Surviving keys meet the
records by measured size (join_few). Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtable.functions.keys import comparable_id
from loomtable.operators.skew import join_few
from loomtable.session import cut_lineage, shuffle_width

NO_TIME = "(none)"
ODD_TIME = "(irregular)"
_MONTH = r"^\d{4}-(0[1-9]|1[0-2])"
_RANGE_BITS = 32768  # keys of one bitmap of Spark's bitmap_construct_agg


def pack_bits(flags: np.ndarray) -> bytes:
    """A bitmap as the smallest of three containers: sorted positions, runs, or plain bits."""
    positions = np.flatnonzero(flags).astype(np.uint16)
    if positions.size == 0:
        return b"a"
    breaks = np.flatnonzero(np.diff(positions.astype(np.int32)) != 1)
    starts = positions[np.r_[0, breaks + 1]]
    ends = positions[np.r_[breaks, positions.size - 1]]
    best = min((positions.size * 2, b"a"), (starts.size * 4, b"r"), (_RANGE_BITS // 8, b"b"))[1]
    if best == b"a":
        return best + positions.tobytes()
    if best == b"r":
        return best + np.stack([starts, ends], 1).tobytes()
    return best + np.packbits(flags, bitorder="little").tobytes()


def unpack_bits(packed: bytes | None) -> np.ndarray:
    """Flags of a container; of None, no flag is set."""
    flags = np.zeros(_RANGE_BITS, bool)
    if packed is None or len(packed) < 2:
        return flags
    kind, body = packed[:1], packed[1:]
    if kind == b"a":
        flags[np.frombuffer(body, np.uint16)] = True
    elif kind == b"r":
        steps = np.zeros(_RANGE_BITS + 1, np.int32)
        runs = np.frombuffer(body, np.uint16).reshape(-1, 2).astype(np.int32)
        np.add.at(steps, runs[:, 0], 1)
        np.add.at(steps, runs[:, 1] + 1, -1)
        flags = np.cumsum(steps[:-1]) > 0
    else:
        flags = np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little").astype(bool)
    return flags


#: What a row of a walk says of its key, in the order in which a period takes them.
EVER, VAGUE, BEGINS, ENDS, REFERS = range(5)
_EVENTS = "key_range bigint, period string, kind int, layer int, table_name string, bit int"


class _Walk:
    """The algebra of one key range, period by period."""

    def __init__(self, key_range: int):
        self.key_range = key_range
        self.ever, self.vague = b"a", b"a"
        self.layers: dict[int, tuple[bytes, bytes]] = {}

    def take(self, period: str, kind: np.ndarray, layer: np.ndarray, table: np.ndarray, bit: np.ndarray) -> list[tuple[str, str, np.ndarray, bool]]:
        """(table, period, key ids, whether surely orphans) of a period's references."""

        def flags(of: int, at: int | None = None, start: bytes = b"a") -> np.ndarray:
            out = unpack_bits(start)
            out[bit[(kind == of) & (layer == at)] if at is not None else bit[kind == of]] = True
            return out

        if (kind == EVER).any():
            self.ever = pack_bits(flags(EVER, start=self.ever))
        if (kind == VAGUE).any():
            self.vague = pack_bits(flags(VAGUE, start=self.vague))
        whole, there = np.zeros(_RANGE_BITS, bool), unpack_bits(self.vague)
        if period == NO_TIME:
            whole = unpack_bits(self.ever)
        elif period == ODD_TIME:
            there = unpack_bits(self.ever)
        else:
            changed = set(layer[(kind == BEGINS) | (kind == ENDS)].tolist())
            for at in self.layers.keys() | changed:
                begun, ended = (unpack_bits(x) for x in self.layers.get(at, (b"a", b"a")))
                begun_now, ended_now = (flags(BEGINS, at) | begun, flags(ENDS, at) | ended) if at in changed else (begun, ended)
                whole |= begun & ~ended_now
                there |= begun_now & ~ended
                if at in changed:
                    self.layers[at] = pack_bits(begun_now), pack_bits(ended_now)
        out = []
        for name in np.unique(table[kind == REFERS]):
            refs = np.unique(bit[(kind == REFERS) & (table == name)])  # the positions of a container
            first = (self.key_range - 1) * _RANGE_BITS
            out += [(str(name), period, refs[pick] + first, sure) for pick, sure in ((~(whole | there)[refs], True), ((there & ~whole)[refs], False)) if pick.any()]
        return out


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (table_name, period, key_id, sure) from events sorted by key range and period; ranges are not split."""
    walk: _Walk | None = None
    held: list[tuple] = []
    at: tuple | None = None

    def close() -> list[pa.RecordBatch]:
        nonlocal walk
        if at is None:
            return []
        if walk is None or walk.key_range != at[0]:
            walk = _Walk(at[0])
        found = walk.take(at[1], *(np.concatenate(c) for c in zip(*held)))
        return [
            pa.RecordBatch.from_arrays([pa.array([t] * ids.size, pa.string()), pa.array([p] * ids.size, pa.string()), pa.array(ids, pa.int64()), pa.array([sure] * ids.size, pa.bool_())], names=["table_name", "period", "key_id", "sure"])
            for t, p, ids, sure in found
        ]

    for batch in batches:
        if not batch.num_rows:
            continue
        ranges, periods = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), object)
        rest = [batch.column(k).to_numpy() for k in (2, 3)] + [np.array([x or "" for x in batch.column(4).to_pylist()], object), batch.column(5).to_numpy().astype(np.int64)]
        cuts = np.flatnonzero((ranges[1:] != ranges[:-1]) | (periods[1:] != periods[:-1])) + 1
        for i, j in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            now = (int(ranges[i]), periods[i])
            if now != at:
                yield from close()
                at, held = now, []
            held.append(tuple(c[i:j] for c in rest))
    yield from close()


def _period(at: Column) -> Column:
    return F.when(at.isNull(), NO_TIME).when(at.rlike(_MONTH), F.substring(at, 1, 7)).otherwise(ODD_TIME)


def references_of(df: DataFrame, table_name: str, record: str, key: str, at: str, ignore: str | None = None) -> DataFrame:
    """(table_name, record_id, key, at, period) of the rows of df that refer to something.

    Null and blank keys are no references, nor are keys whose comparable form matches the
    regular expression `ignore`. Only the three named columns are read.
    """
    out = df.select(
        F.lit(table_name).alias("table_name"),
        F.col(record).cast("bigint").alias("record_id"),
        comparable_id(F.col(key)).alias("key"),
        F.col(at).cast("string").alias("at"),
    ).filter(F.col("key").isNotNull())
    if ignore:
        out = out.filter(~F.col("key").rlike(ignore))
    return out.withColumn("period", _period(F.col("at")))


def encode_keys(keys: DataFrame) -> DataFrame:
    """(key, key_id): dense within each of the shuffle's partitions, the same on every run.

    The number of partitions is given, so that AQE leaves it, and each is sorted, so that a
    task that runs again numbers its keys alike.
    """
    n = shuffle_width(keys.sparkSession)
    return cut_lineage(
        keys.select("key").distinct().repartition(n, "key").sortWithinPartitions("key").withColumn("key_id", F.monotonically_increasing_id())
    )


def _events(cells: DataFrame, spans: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the walks: references, and begins and ends of spans, a layer for each span of a key."""
    layered = spans.withColumn("layer", F.row_number().over(Window.partitionBy("key").orderBy("valid_from", "valid_to")) - 1)
    regular = lambda c: F.col(c).isNull() | F.col(c).rlike(_MONTH)
    month = lambda c: F.substring(c, 1, 7)
    event = lambda kind, period, when=None: F.when(F.lit(True) if when is None else when, F.struct(F.lit(kind).alias("kind"), period.alias("period")))
    plain = regular("valid_from") & regular("valid_to")
    of_span = F.array_compact(
        F.array(
            event(EVER, F.lit("")),
            event(VAGUE, F.lit(""), ~plain),  # a bound that is no time leaves all to the comparison of times
            event(BEGINS, F.coalesce(month("valid_from"), F.lit("")), plain),
            event(ENDS, month("valid_to"), plain & F.col("valid_to").isNotNull()),
        )
    )
    parents = layered.select("key", "layer", F.explode(of_span).alias("e")).select("key", "e.period", "e.kind", "layer", F.lit(None).cast("string").alias("table_name"))
    asked = cells.select("key", "period", F.lit(REFERS).alias("kind"), F.lit(0).alias("layer"), "table_name")
    rows = asked.unionByName(parents).join(ids, "key")
    return rows.select(F.expr("bitmap_bucket_number(key_id + 1)").alias("key_range"), "period", "kind", "layer", "table_name", F.expr("bitmap_bit_position(key_id + 1)").cast("int").alias("bit"))


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """The rows of refs (see references_of) whose key has no parent, or none at the time `at`.

    parents(key, valid_from, valid_to): one row per span in which a parent exists; from
    valid_from on and before valid_to, both text that sorts by time; null means open. Keys
    are compared by comparable_id; several spans of a key are united. A reference with null
    `at` needs only a parent with any span. Result: refs' columns and `reason`
    ('unknown', 'too_early' or 'removed'). Empty refs give no row, empty parents give all.
    """
    spans = cut_lineage(
        parents.select(comparable_id(F.col("key")).alias("key"), F.col("valid_from").cast("string"), F.col("valid_to").cast("string"))
        .filter(F.col("key").isNotNull())
        .distinct()
    )
    cells = cut_lineage(refs.select("table_name", "period", "key").distinct())
    ids = encode_keys(cells.select("key").union(spans.select("key")))
    walks = _events(cells, spans, ids).repartition("key_range").sortWithinPartitions("key_range", "period", "kind")
    bounds = spans.groupBy("key").agg(F.min(F.coalesce("valid_from", F.lit(""))).alias("first_from"))
    left = cut_lineage(
        walks.mapInArrow(_survivors, "table_name string, period string, key_id bigint, sure boolean")
        .join(ids, "key_id")
        .join(bounds, "key", "left")
        .select("table_name", "period", "key", "sure", "first_from")
    )
    hit = cut_lineage(join_few(refs, left, ["table_name", "period", "key"], "record_id"))  # read once, and few
    covered = spans.select(F.col("key").alias("span_key"), "valid_from", "valid_to")
    open_refs = hit.filter(~F.col("sure")).join(
        covered,
        (F.col("key") == F.col("span_key"))
        & (F.col("valid_from").isNull() | (F.col("at") >= F.col("valid_from")))
        & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))),
        "left_anti",
    )
    orphans = hit.filter("sure").unionByName(open_refs)
    reason = F.when(F.col("first_from").isNull(), "unknown").when(F.col("at") < F.col("first_from"), "too_early").otherwise("removed")
    return orphans.select("table_name", "record_id", "key", "at", "period", reason.alias("reason"))


def orphan_report(refs: DataFrame, orphans: DataFrame) -> DataFrame:
    """Per table and period: references, orphans by reason, and the orphans' share (6 digits)."""
    total = refs.groupBy("table_name", "period").agg(F.count("*").alias("n_references"))
    bad = orphans.groupBy("table_name", "period").agg(
        F.count("*").alias("n_orphans"),
        *(F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("unknown", "too_early", "removed")),
    )
    counts = ["n_orphans", "n_unknown", "n_too_early", "n_removed"]
    return (
        total.join(bad, ["table_name", "period"], "left")
        .na.fill(0, counts)
        .withColumn("orphan_share", F.round(F.col("n_orphans") / F.col("n_references"), 6))
        .select("table_name", "period", "n_references", *counts, "orphan_share")
    )
