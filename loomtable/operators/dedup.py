"""Deduplication by keys and by similarity within groups."""

from __future__ import annotations

import difflib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtable.operators.windows import ColumnOrName, _order
from loomtable.session import cut_lineage, shuffle_width


def mark_duplicates(df: DataFrame, key: list[ColumnOrName], order: list[ColumnOrName]) -> DataFrame:
    """df with is_duplicate: true for every row of a key but its first."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*_order(order)))
    return df.withColumn("is_duplicate", rank > 1)


def new_rows(batch: DataFrame, existing: DataFrame, key: list[str], order: list[ColumnOrName]) -> DataFrame:
    """Rows of a batch whose key is neither stored nor earlier in the batch; null keys equal each other."""
    stored = existing.select(*(F.col(k).alias(f"_{k}") for k in key)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    fresh = batch.join(stored, same, "left_anti")
    return mark_duplicates(fresh, list(key), order).filter("NOT is_duplicate").drop("is_duplicate")


def new_by_keys_in_turn(batch: DataFrame, existing: DataFrame, keys: list[list[str]], order: list[ColumnOrName]) -> DataFrame:
    """Rows of a batch that are new by the first key, of these those that are new by the next, and so on.

    A row with a null in a key is new by it, as a row without an address is by its address.
    """
    for key in keys:
        whole = F.lit(True)
        for k in key:
            whole = whole & F.col(k).isNotNull()
        batch = batch.filter(~whole).unionByName(new_rows(batch.filter(whole), existing, key, order))
    return batch


BUCKETS = 128  # of characters, in the sketch of a text; two words of parities
TILE = 4096  # rows of a group that meet another such tile in one piece
FEW = 1 << 19  # rows that are broadcast


def _counts(texts: list[str]) -> np.ndarray:
    """How many characters of each text fall into each bucket, modulo 256."""
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    buckets = (points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)
    rows = np.repeat(np.arange(sizes.size) * BUCKETS, sizes)
    return np.bincount(rows + buckets, minlength=sizes.size * BUCKETS).astype(np.uint8).reshape(-1, BUCKETS)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (group, id, text, h) the length of the text and its counts as bytes."""
    for batch in batches:
        texts = batch.column(2).to_pylist()
        counts = [c.tobytes() for k in range(0, len(texts), 256) for c in _counts(texts[k : k + 256])]
        added = [pa.array([len(t) for t in texts], pa.int32()), batch.column(3), pa.array(counts, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *added], names=["group", "id", "size", "h", "counts"])


def _longest(n, least: float):
    """The most characters that a text may have to be like one of n."""
    return np.floor((n * (2 - least) + 1e-6) / least)


def _close(left: tuple, right: tuple | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pairs that can be alike by their sketches, of a left and a right row, or of two left ones if right is None.

    Each side is (ids, sizes, counts), in order of size, and no right row is shorter than a left one.
    """
    (ids, n, counts), (other, n_b, counts_b) = left, right or left
    parity, parity_b = (np.packbits(c & 1, axis=1).view(np.uint64) for c in (counts, counts_b))
    ends = np.searchsorted(n_b, _longest(n, least), "right")
    out = [], []
    for s in range(0, n.size, 64):
        e = min(s + 64, n.size)
        for c in range(s if right is None else 0, int(ends[e - 1]), 2048):
            d = min(c + 2048, int(ends[e - 1]))
            apart = sum(np.bitwise_count(parity[s:e, None, w] ^ parity_b[None, c:d, w]) for w in range(parity.shape[1]))
            i, j = np.nonzero(apart <= min(255, int((n[e - 1] + n_b[d - 1]) * (1 - least) + 1e-6)))
            i, j = i + s, j + c
            if right is None:
                i, j = i[i < j], j[i < j]
            if i.size:
                off = np.abs((counts[i] - counts_b[j]).view(np.int8).astype(np.int16)).sum(axis=1)  # at most the true difference, as counts are modulo 256
                near = np.maximum(off, n_b[j] - n[i]) <= np.floor((n[i] + n_b[j]) * (1 - least) + 1e-6)
                out[0].append(ids[i[near]])
                out[1].append(other[j[near]])
    return tuple(np.concatenate(x) if x else np.array([], np.int64) for x in out)


def _candidates(least: float):
    """Pairs (a, b), a before b, of rows (group, one, two, side, size, id, counts) in this order; a piece is a group and two of its tiles."""

    def pairs(sides: tuple[list, list]) -> tuple[np.ndarray, np.ndarray]:
        left, right = (tuple(map(np.concatenate, zip(*x))) if x else None for x in sides)
        return _close(left, right, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, sides = None, ([], [])

        def batch_of(found: list) -> pa.RecordBatch:
            x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            sizes, ids = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (4, 5))
            counts = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(-1, BUCKETS)
            starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
            found = []
            for s, e in zip(starts, [*starts[1:], len(keys)]):
                *key, side = keys[s]
                if piece is not None and key != piece:
                    found.append(pairs(sides))
                    sides = ([], [])
                piece = key
                sides[side].append((ids[s:e], sizes[s:e], counts[s:e]))
            if found:
                yield batch_of(found)
        if piece is not None:
            yield batch_of([pairs(sides)])

    return run


def _in_turn(x: str, y: str) -> int:
    """The length of the longest common subsequence; difflib's matches are one. Bits of v are clear where the length over x so far grows."""
    at: dict[str, int] = {}
    for k, c in enumerate(x):
        at[c] = at.get(c, 0) | 1 << k
    whole = (1 << len(x)) - 1
    v = whole
    for c in y:
        if m := v & at.get(c, 0):
            v = (v + m | v - m) & whole
    return len(x) - v.bit_count()


def _compared(least: float, guard: float):
    """Of rows (a, b, text_a, text_b), a before b, those that are alike, as (id, kept_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if abs(len(x) - len(y)) > guard * min(len(x), len(y)):
                    continue
                m = difflib.SequenceMatcher(None, x, y)
                if m.real_quick_ratio() >= least and m.quick_ratio() >= least and 2.0 * _in_turn(x, y) / (len(x) + len(y)) >= least and m.ratio() >= least:
                    out.append((b, a) if len(y) <= len(x) else (a, b))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "kept_id"])

    return run


def mark_similar(df: DataFrame, group: str, key: str, text: str, least: float = 0.95, guard: float = 0.5) -> DataFrame:
    """(id, kept_id): rows whose text is a near copy of a longer, or of equals an earlier, one of its group.

    The measure is difflib's ratio. Copies are removed by hash first. Of two texts of which
    it is `least` or more, at most u = (n + m) (1 - least) characters are unmatched, n and m
    being their lengths. All others are the same in both, so counts of characters by bucket
    differ by u at most, in sum, and so do their parities, which are two words a text: these
    are compared first, then the counts, and only texts that pass both are fetched and
    measured. No near copy is missed. Rows of a group stand in order of length, cut into tiles
    of TILE rows, and only tiles whose lengths are near meet. What is shuffled are sketches of
    BUCKETS bytes, once by group and once for each near tile, and the pairs that pass with
    their texts. Comparing parities grows with the square of a group, at a few billionths of
    a second a pair. Long texts of one language have like counts (English from about 5,000
    characters, Japanese from 20,000), so these are fetched for all near lengths; their longest
    common subsequence bounds the ratio and is found before it. Null texts and keys are in no
    pair. The keys must be unique.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(group).cast("string").alias("group"), F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    sketches = rows.withColumn("h", F.unhex(F.sha2("text", 256))).mapInArrow(_sketched, "group string, id bigint, size int, h binary, counts binary")
    along = Window.partitionBy("group").orderBy("size", "h", "id")
    place = F.sum(F.col("new").cast("bigint")).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = sketches.withColumn("new", ~F.lag("h").over(along).eqNullSafe(F.col("h"))).withColumn("tile", F.floor((place - 1) / TILE).cast("int"))
    ranked = ranked.withColumn("kept_id", F.min("id").over(Window.partitionBy("group", "size", "h").orderBy("id")))
    ranked = cut_lineage(ranked.select("group", "id", "kept_id", "tile", "size", F.when(F.col("new"), F.col("counts")).alias("counts")))
    exact = ranked.filter("id <> kept_id").select("id", "kept_id")
    rest = ranked.filter("counts IS NOT NULL").drop("kept_id")
    tiles = rest.groupBy("group", "tile").agg(F.count("*").alias("n"), F.min("size").alias("low"), F.max("size").alias("high"))
    other = tiles.select(F.col("group").alias("g"), F.col("tile").alias("two"), F.col("low").alias("low_two"))
    near = F.col("low_two") * least <= F.col("high") * (2 - least) + 1e-6
    pieces = tiles.join(other, F.col("group").eqNullSafe(F.col("g")) & (F.col("tile") <= F.col("two")) & near)
    pieces = cut_lineage(pieces.filter("tile < two OR n > 1").select("g", F.col("tile").alias("one"), "two"))
    sides = [
        rest.join(_sent_if_few(pieces.filter(kept)), F.col("group").eqNullSafe(F.col("g")) & (F.col("tile") == F.col(end))).select("group", "one", "two", F.lit(k).alias("side"), "size", "id", "counts")
        for k, (end, kept) in enumerate({"one": "true", "two": "one < two"}.items())
    ]
    width = shuffle_width(df.sparkSession)
    met = sides[0].unionByName(sides[1]).repartition(width, "group", "one", "two").sortWithinPartitions("group", "one", "two", "side", "size")
    pairs = cut_lineage(met.mapInArrow(_candidates(least), "a bigint, b bigint"))
    wanted = _sent_if_few(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct())
    texts = rows.select(F.col("id").alias("k"), "text").join(wanted, "k", "left_semi")
    both = pairs.join(texts.withColumnsRenamed({"k": "a", "text": "text_a"}), "a").join(texts.withColumnsRenamed({"k": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    alike = both.repartition(width, "a", "b").mapInArrow(_compared(least, guard), "id bigint, kept_id bigint").groupBy("id").agg(F.min("kept_id").alias("kept_id"))
    return exact.unionByName(alike)


def _sent_if_few(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is counted to be FEW rows at most."""
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df


def _anchor(window: str) -> str:
    """Of a window its stretch of half the length with the least checksum; the same wherever the window stands."""
    k = max(1, len(window) // 2)
    return min((window[i : i + k] for i in range(len(window) - k + 1)), key=lambda g: (zlib.crc32(g.encode("utf-8", "surrogatepass")), g))


def _anchors(text: str, size: int) -> set[str]:
    """The anchors of all windows of a size; each checksum is made once."""
    k = max(1, size // 2)
    grams = [text[i : i + k] for i in range(len(text) - k + 1)]
    ranks = [(zlib.crc32(g.encode("utf-8", "surrogatepass")), g) for g in grams]
    out, best, w = set(), -1, size - k + 1
    for i in range(len(text) - size + 1):
        if best < i:
            best = min(range(i, i + w), key=ranks.__getitem__)
        elif ranks[i + w - 1] < ranks[best]:
            best = i + w - 1
        out.add(grams[best])
    return out


def _text_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["group", "id", "size", "anchor"]
    for batch in batches:
        groups, ids, texts, sizes = (batch.column(i).to_pylist() for i in range(4))
        rows: list[tuple] = []
        for last, (g, k, t, of) in enumerate(zip(groups, ids, texts, sizes), 1 - batch.num_rows):
            rows += [(g, k, size, a) for size in of if size <= len(t) for a in _anchors(t, size)]
            if rows and (len(rows) > 100_000 or last == 0):
                kinds = [batch.schema.field(0).type, batch.schema.field(1).type, pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)
                rows = []


def _head_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads = batch.column(1).to_pylist()
        sizes = [1 << len(h).bit_length() - 1 for h in heads]
        added = [pa.array(sizes, pa.int32()), pa.array([_anchor(h[:size]) for h, size in zip(heads, sizes)], pa.string())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["g", "head", "first", "size", "anchor"])


def contained_heads(df: DataFrame, group: str, key: str, text: str, n: int = 80) -> DataFrame:
    """Keys of rows whose first n characters stand anywhere in the text of an earlier row of the group, or the other way round.

    Every earlier row counts, itself such a row or not. A head of 2^j characters or more
    (fewer than 2^(j+1)) goes by one anchor, the stretch of 2^(j-1) with the least checksum
    in its first 2^j; a text that holds the head has this anchor among those of its windows
    of 2^j. Rows meet heads by equality of anchors, and only those are searched. Equal heads
    of a group are one, so a head that a whole group begins with meets each row once.
    """
    rows = df.filter(F.length(text) > 0).select(F.col(group).alias("group"), F.col(key).alias("id"), F.col(text).alias("text"), F.substring(text, 1, n).alias("head"))
    heads = rows.groupBy(F.col("group").alias("g"), "head").agg(F.min("id").alias("first"))
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("group", "id")}
    anchored = heads.mapInArrow(_head_anchors, f"g {kind['group']}, head string, first {kind['id']}, size int, anchor string")
    sizes = anchored.groupBy("g").agg(F.collect_set("size").alias("sizes"))
    asked = rows.join(sizes, F.col("group").eqNullSafe(F.col("g"))).select("group", "id", "text", "sizes")
    places = asked.mapInArrow(_text_anchors, f"group {kind['group']}, id {kind['id']}, size int, anchor string")
    near = places.join(anchored.withColumnsRenamed({"size": "s", "anchor": "a"}), [F.col("group").eqNullSafe(F.col("g")), F.col("size") == F.col("s"), F.col("anchor") == F.col("a")])
    near = near.select("g", "head", "first", F.col("id").alias("holder"))
    held = near.join(rows.select("group", "id", "text"), [F.col("g").eqNullSafe(F.col("group")), F.col("holder") == F.col("id")]).filter(F.col("text").contains(F.col("head")))
    holders = held.groupBy("g", "head").agg(F.min("holder").alias("first_holder"))
    inside = rows.select("group", "id", F.col("head").alias("own")).join(holders, [F.col("group").eqNullSafe(F.col("g")), F.col("own") == F.col("head")]).filter("first_holder < id")
    return held.filter("first < holder").select(F.col("holder").alias("id")).union(inside.select("id")).distinct()
