"""One consistent form of text that looks the same, by table lookup on code-point arrays.

The Arrow buffers of a batch become one numpy array of code points. Each point is replaced
by its row of a lookup table: nothing, one point or several, gathered through expansion
offsets. Marks are put in canonical order and composed with their bases by array operations
over the whole batch, and the result goes back into Arrow buffers. No string method runs per
row, and none is made of a row.

The table is made by rule from the Unicode data of the standard library:
 - width forms, canonical and presentation variants are decomposed; characters that are
   enclosed, raised, lowered, squared or fractions keep their looks and stay;
 - invisible characters vanish; every kind of blank is a space; CR LF and CR are LF;
 - characters of other scripts and signs that are drawn alike (ALIKE) become one of them.

`skeleton` is the comparison form. `consistent_form` is the same string made readable: a
character shared by katakana and ideographs is written as its neighbours suggest. That
choice depends on the skeleton alone and can be undone, so both forms are equal for the
same texts. Letter case, sound marks, small kana and old and new ideographs stay distinct.

Null stays null, the empty text stays empty. A text of blanks stays blanks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtable.operators.skew import join_few
from loomtable.session import cut_lineage

#: Characters drawn like the one before the colon.
ALIKE = """
A:ΑА B:ΒВ C:СϹ D: E:ΕЕ F:Ϝ G:Ԍ H:ΗН I:ΙІӀ J:ЈͿ K:ΚК M:ΜМ N:Ν O:ΟО P:ΡР Q:Ԛ S:Ѕ T:ΤТ V:Ѵ W:Ԝ X:ΧХ Y:ΥҮ Z:Ζ
a:аɑα c:сϲ d:ԁ e:еҽ g:ɡ h:һ i:іɩ j:јϳ k: l:ӏ n:ո o:οоօ p:рρ q:ԛ s:ѕ u:ʋսυ v:νѵ w:ԝ x:х y:уγү
ー:一―—─━⼀ ロ:口囗 ト:卜 ニ:二 カ:力 エ:工 ハ:八 タ:夕 ヒ:匕 ム:厶 ノ:丿 オ:才 チ:千 メ:乂 ヘ:へ ベ:べ ペ:ぺ ミ:彡 イ:亻
-:‐‑‒–−﹣⁃ ・:·•‧∙⋅● ':‘’‚‛′ʹʼ` ":“”„‟″〃 ~:〜∼˜ /:⁄∕⧸ |:│┃∣ǀ ::∶꞉ ○:〇◯⚪ ,:‚ *:∗⁎ <:‹ >:›
"""
#: Forms of the radicals supplement, and the ideographs drawn like them.
RADICALS = "⺁厂⺅亻⺉刂⺋㔾⺎兀⺏尣⺐尢⺒巳⺓幺⺔彑⺖忄⺗㣺⺘扌⺙攵⺛旡⺞歺⺟母⺠民⺡氵⺢氺⺣灬⺤爫⺥爫⺦丬⺨犭⺩王⺫罒⺬示⺭礻⺮竹⺯糹⺰纟⺱罓⺲罒⺷羋⺹耂⺻聿⺽臼⺾艹⺿艹⻀艹⻁虎⻂衤⻃覀⻄西⻅见⻆角⻈讠⻉贝⻊足⻋车⻌辶⻍辶⻎辶⻏阝⻐钅⻑長⻒镸⻓长⻔门⻖阝⻗雨⻘青⻙韦⻚页⻛风⻜飞⻝食⻟飠⻠饣⻡首⻢马⻣骨⻤鬼⻥鱼⻦鸟⻧卤⻨麦⻩黄⻪黾⻫斉⻬齐⻭歯⻮齿⻯竜⻰龙⻱龜⻲亀"

_KEPT_TAGS = {"<circle>", "<super>", "<sub>", "<square>", "<fraction>"}
_EXTRA_INVISIBLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x180B, 0x180C, 0x180D, 0x180E, 0x180F}
_TOP = 0x110000


def _invisible(c: int) -> bool:
    return c in _EXTRA_INVISIBLE or 0xFE00 <= c <= 0xFE0F or 0xE0000 <= c <= 0xE0FFF or unicodedata.category(chr(c)) in ("Cf", "Cc")


def _pieces(c: int) -> str:
    """Decomposition of a character as far as it leaves its looks alone."""
    tag, _, rest = unicodedata.decomposition(chr(c)).rpartition("> ")
    if not rest or (tag and f"{tag}>" in _KEPT_TAGS) or 0x2474 <= c <= 0x249B or 0x3200 <= c <= 0x33FF or c in (0xA8, 0xAF, 0xB4, 0xB8, 0x309B, 0x309C):
        return chr(c)
    return "".join(_pieces(int(x, 16)) for x in rest.split())


@lru_cache(1)
def tables() -> dict[str, np.ndarray]:
    """The lookup tables; made once per process."""
    alike: dict[str, str] = {}
    for entry in ALIKE.split():
        alike |= dict.fromkeys(entry[2:], entry[0])
    alike |= dict(zip(RADICALS[::2], RADICALS[1::2]))
    alike |= {k: alike[v] for k, v in alike.items() if v in alike}
    start = np.arange(_TOP, dtype=np.int64)
    count = np.ones(_TOP, np.int8)
    extra: list[int] = []
    marks = np.zeros(_TOP, np.uint8)
    compose: dict[tuple[int, int], int] = {}
    for c in range(_TOP):
        if 0xD800 <= c < 0xF900 or c >= 0x30000 and c < 0xE0000 or c >= 0xF0000 or 0xAC00 <= c < 0xD7A4:
            continue
        ch = chr(c)
        category = unicodedata.category(ch)
        if category == "Cn":
            continue
        marks[c] = unicodedata.combining(ch)
        if ch in "\n\r\t\x0b\x0c\x85  " or category == "Zs":
            to = "\n" if ch in "\n\r\x85  " else " "
        elif _invisible(c):
            to = ""
        else:
            to = "".join(alike.get(p, p) for p in _pieces(c))
            to = "".join(" " if unicodedata.category(p) == "Zs" else p for p in to)
            parts = unicodedata.decomposition(ch).split()
            if len(parts) == 2 and not parts[0].startswith("<") and unicodedata.normalize("NFC", ch) == ch:
                a, b = (int(x, 16) for x in parts)
                compose[ord(alike.get(chr(a), chr(a))), b] = ord(alike.get(ch, ch))
        if to != ch:
            count[c] = len(to)
            start[c] = _TOP + len(extra) if len(to) != 1 else ord(to)
            extra += [ord(x) for x in to] if len(to) > 1 else []
    keys = np.array([a << 21 | b for a, b in compose], np.int64)
    order = np.argsort(keys)
    changed = (count != 1) | (start != np.arange(_TOP))
    return {
        "changed": changed,
        "start": start,
        "count": count,
        "pool": np.r_[np.arange(_TOP, dtype=np.int32), np.array(extra, np.int32)],
        "marks": marks,
        "pair": keys[order],
        "made": np.array(list(compose.values()), np.int32)[order],
    }


def _gathered(points: np.ndarray, row: np.ndarray, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each point's row of the table, laid out through expansion offsets."""
    cr = points == 13
    if cr.any():  # of CR LF, the CR goes
        drop = cr & np.r_[(points[1:] == 10) & (row[1:] == row[:-1]), False]
        points, row = points[~drop], row[~drop]
    at = np.flatnonzero(t["changed"][points])
    if not at.size:
        return points, row
    if (t["count"][points[at]] == 1).all():
        points = points.copy()
        points[at] = t["pool"][t["start"][points[at]]]
        return points, row
    n = t["count"][points].astype(np.int64)
    ends = np.cumsum(n)
    inner = np.arange(ends[-1] if n.size else 0) - np.repeat(ends - n, n)
    return t["pool"][np.repeat(t["start"][points], n) + inner], np.repeat(row, n)


def _ordered(points: np.ndarray, row: np.ndarray, t: dict[str, np.ndarray]) -> np.ndarray:
    """Runs of marks in canonical order: one stable sort over all marks, by run and class."""
    cc = t["marks"][points]
    if not ((cc[:-1] > cc[1:]) & (cc[1:] > 0) & (row[:-1] == row[1:])).any():
        return points
    run = np.cumsum((cc == 0) | np.r_[True, row[1:] != row[:-1]])
    marks = np.flatnonzero(cc)
    order = np.argsort(run[marks] * 256 + cc[marks], kind="stable")
    points = points.copy()
    points[marks] = points[marks[order]]
    return points


def _composed(points: np.ndarray, row: np.ndarray, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bases joined with the marks that follow them, pass by pass until none is left."""
    while points.size > 1:
        key = (points[:-1].astype(np.int64) << 21) | points[1:]
        may = np.flatnonzero((t["marks"][points[1:]] > 0) & (row[:-1] == row[1:]) & (t["marks"][points[:-1]] == 0))
        at = np.searchsorted(t["pair"], key[may])
        at[at == t["pair"].size] = 0
        good = t["pair"][at] == key[may]
        may, at = may[good], at[good]
        if not may.size:
            break
        points = points.copy()
        points[may] = t["made"][at]
        keep = np.ones(points.size, bool)
        keep[may + 1] = False
        points, row = points[keep], row[keep]
    return points, row


#: Of the shared signs: skeleton, and what it is beside ideographs or hiragana.
_READ_AS = dict(zip("ロニカエハタオチヘベペー", "口二力工八夕才千へべぺ一"))


def _readable(points: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Shared signs as ideographs or hiragana unless a neighbour of the same text, past other shared signs, is katakana."""
    shared = np.zeros(_TOP, bool)
    shared[[ord(c) for c in _READ_AS]] = True
    to = np.arange(_TOP, dtype=np.int32)
    to[[ord(k) for k in _READ_AS]] = [ord(v) for v in _READ_AS.values()]
    open_ = shared[points]
    if not open_.any():
        return points
    kana = (points >= 0x30A1) & (points <= 0x30FA) & ~open_
    latin = (points < 0x250) & (points > 0x40)
    stop = ~open_ | np.r_[True, row[1:] != row[:-1]]
    # the first settled character to the left and to the right, within the text
    index = np.arange(points.size)
    left = np.maximum.accumulate(np.where(~open_, index, -1))
    right = np.minimum.accumulate(np.where(~open_, index, points.size)[::-1])[::-1]
    del stop
    side = lambda at: (at >= 0) & (at < points.size) & (row[np.clip(at, 0, points.size - 1)] == row) & (kana | latin)[np.clip(at, 0, points.size - 1)]
    run = np.cumsum(np.r_[True, (open_[1:] != open_[:-1]) | (row[1:] != row[:-1])])
    long_run = np.bincount(run)[run] >= 3  # three shared signs in a row are katakana themselves
    as_kana = side(left) | side(right) | long_run
    # a lone bar is the long mark after hiragana and katakana, the numeral elsewhere
    return np.where(open_ & ~as_kana, to[points], points)


def _formed(points: np.ndarray, row: np.ndarray, readable: bool = False) -> tuple[np.ndarray, np.ndarray]:
    t = tables()
    points, row = _gathered(points, row, t)
    points = _ordered(points, row, t)
    points, row = _composed(points, row, t)
    return (_readable(points, row) if readable and points.size else points), row


def points_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, the row of each) from the buffers of a string array; a null has none."""
    column = column.cast(pa.string())
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4) if len(column) else np.zeros(1, np.int32)
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.int32)
    before = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]  # a code point begins at each byte that continues none
    return points, np.repeat(np.arange(len(column)), np.diff(before[ends - ends[0]]))


def array_of(points: np.ndarray, row: np.ndarray, like: pa.Array) -> pa.Array:
    """A string array of as many rows as `like`, null where it is."""
    size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    offsets = np.r_[0, np.cumsum(np.bincount(row, size, len(like)))].astype(np.int32)
    data = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    valid = pa.array(like.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)).cast(pa.bool_()).buffers()[1] if like.null_count else None
    return pa.StringArray.from_buffers(len(like), pa.py_buffer(offsets), pa.py_buffer(data), valid)


def skeletons(texts: list[str], readable: bool = False) -> list[str]:
    """The comparison forms of texts (see the module); with readable, the consistent forms."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    points, row = _formed(points, row, readable)
    out = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    ends = np.cumsum(np.bincount(row, minlength=len(texts)))
    return [out[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


def _mixed_bits(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(points: np.ndarray, row: np.ndarray, n: int) -> pa.Array:
    """128 bits of each text: sums, over its places, of two pseudo-random functions of place and code point."""
    sizes = np.bincount(row, minlength=n)
    ends = np.cumsum(sizes)
    place = (np.arange(points.size) - np.repeat(ends - sizes, sizes)).astype(np.uint64)
    key = (place + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    halves = []
    for seed in (0x2545F4914F6CDD1D, 0xC2B2AE3D27D4EB4F):
        total = np.r_[np.uint64(0), np.cumsum(_mixed_bits(key ^ np.uint64(seed)), dtype=np.uint64)]
        halves.append(_mixed_bits(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, pa.py_buffer(np.stack(halves, 1).tobytes())]).cast(pa.binary())


def with_forms(df: DataFrame, text: str, skeleton: str = "skeleton", form: str = "consistent_form") -> DataFrame:
    """df with the comparison form and the readable form of `text`; columns of those names are replaced."""
    base = df.drop(*({skeleton, form} - {text}))
    schema = T.StructType([*base.schema.fields, T.StructField(skeleton, T.StringType()), T.StructField(form, T.StringType())])
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(at)
            points, row = _formed(*points_of(given))
            made = [array_of(p, row, given) for p in (points, _readable(points, row) if points.size else points)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return base.mapInArrow(run, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points, row = points_of(batch.column(2))
        made = [hashes(*_formed(points, row), batch.num_rows), hashes(points, row, batch.num_rows)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], names=["table_name", "key", "looks", "string"])


SALTS = 64  # parts into which the rows of a string are spread before they meet their partners
BROADCAST_PAIRS = 100_000  # counted pairs of strings, of some 80 bytes, up to which they are broadcast to the rows
BLOCK = 4096  # rows of a string that stand in one block of pairs


def text_hashes(rows: DataFrame) -> DataFrame:
    """(table_name, key, looks, string) of rows(table_name, key, text) that are not null: hashes of skeleton and text, pinned once."""
    some = rows.select("table_name", F.col("key").cast("bigint").alias("key"), "text").filter(F.col("text").isNotNull())
    return cut_lineage(some.mapInArrow(_hashed, "table_name string, key bigint, looks binary, string binary"))


def _strings(hashed: DataFrame) -> DataFrame:
    """(table_name, looks, string, n, least) of the strings of which others look the same."""
    counts = hashed.groupBy("table_name", "looks", "string").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    mixed = counts.groupBy("table_name", "looks").agg(F.count("*").alias("n_strings")).filter("n_strings > 1")
    return counts.join(mixed.select("table_name", "looks"), ["table_name", "looks"], "left_semi")


def alike_classes(rows: DataFrame) -> DataFrame:
    """(table_name, key, class_key, n_links) of every row of rows(table_name, key, text) whose text is not null.

    class_key is the least key of the rows that look the same; n_links counts those of them
    that are another string. Classes and strings are counted before they meet rows.
    """
    hashed = text_hashes(rows)
    counts = hashed.groupBy("table_name", "looks", "string").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    classes = counts.groupBy("table_name", "looks").agg(F.sum("n").alias("n_all"), F.min("least").alias("class_key"))
    linked = cut_lineage(counts.join(classes, ["table_name", "looks"]).select("table_name", "string", "n", "class_key", (F.col("n_all") - F.col("n")).alias("n_links")))
    on, columns = ["table_name", "string"], ["table_name", "key", "class_key", "n_links"]
    # strings of more than BLOCK rows are few, and meet their rows by measured size; the others by equality
    marked = join_few(hashed, linked.filter(F.col("n") > BLOCK).drop("n"), on, "key", "left")
    common, rest = marked.filter("class_key IS NOT NULL"), marked.filter("class_key IS NULL").drop("class_key", "n_links")
    return common.select(columns).unionByName(rest.join(linked.filter(F.col("n") <= BLOCK), on).select(columns))


def alike_pairs(rows: DataFrame) -> DataFrame:
    """(table_name, key_lo, key_hi): pairs of rows(table_name, key, text) whose texts look the same but are not the same string.

    Texts meet as distinct strings, by a 128-bit hash of their skeleton; pairs of strings are
    then expanded to rows. Copies of a string, however many, never meet each other: what is
    joined is as large as the result. Rows meet their pairs by broadcast where these are
    counted to be few, else spread over SALTS parts; they meet those of the other string in
    blocks of BLOCK rows. No task holds all rows of a common string. Null texts are in no pair.
    """
    hashed = text_hashes(rows)
    of = ["table_name", "looks"]
    strings = cut_lineage(_strings(hashed))
    other = strings.select(*of, F.col("string").alias("b"), F.col("n").alias("n_b"))
    pairs = cut_lineage(strings.select(*of, F.col("string").alias("a"), F.col("n").alias("n_a")).join(other, of).filter("a < b"))
    if pairs.count() <= BROADCAST_PAIRS:
        meet = lambda own: hashed.withColumnRenamed("string", own).join(F.broadcast(pairs), [*of, own])
    else:
        salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        spread = hashed.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        meet = lambda own: spread.withColumnRenamed("string", own).join(salted, [*of, own, "salt"])
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = lambda n: F.pmod(F.xxhash64(F.lit(1), "key"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    at = [*of, "a", "b", "i", "j"]
    low = meet("a").withColumn("i", own("n_a")).withColumn("j", every("n_b")).select(*at, F.col("key").alias("key_a"))
    high = meet("b").withColumn("j", own("n_b")).withColumn("i", every("n_a")).select(*at, F.col("key").alias("key_b"))
    return low.join(high, at).select("table_name", F.least("key_a", "key_b").alias("key_lo"), F.greatest("key_a", "key_b").alias("key_hi"))
