"""Text that was decoded with the wrong encoding, found and restored by best-first search.

A text is searched piece by piece, plain Japanese parting the pieces, so that each kind of
damage is undone by itself. A state is such a piece; its cost sums how implausible each character is (a lookup by code point,
and for raw 7-bit JIS the density of its lead bytes). The steps from a state encode the
stretches of it that fit a legacy encoding and decode the bytes as what they may have been,
or undo an escape. A stretch is replaced only where that lowers its own cost, so clean parts
of a partly garbled text stay. States wait in a heap by cost and number of steps; texts seen
before are known by a hash and not expanded again. The cheapest state that is reached wins.
Of the steps that together undo all that can be undone, one undoes at least its share, the
whole over the number of steps, and steps on different stretches may change places. So only
steps are followed that take away this share of what is open in a state. The search ends
when nothing is open in the cheapest text: single rare characters apart from each other are
not, since every character of a wrong decoding becomes two at least, side by side, nor gaps,
which no step fills. Else it ends when no state that waits can lead to a cheaper one, a text
costing nothing at least and a step STEP_COST. No number of states ends it.

A text is garbled if the search reaches a plainly cheaper one through a decoding, or if it
bears what a lossy decoding leaves behind: replacement characters, controls and private
characters in number. `restored` is null where the lost bytes leave gaps.

One pass per row, no shuffle; most rows are settled by one array lookup for their batch and
never searched. The steps tried from a state are those whose characters it has. Every step
lowers the cost or the length of a stretch, so the states are finitely many. Null and empty
texts are not garbled.
"""

from __future__ import annotations

import codecs
import heapq
import html
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP_COST = 0.3
LEAST_GAIN = 1.0
GAP = "�"
_SUSPECT = 0.9  # cost below which no search begins


@lru_cache(1)
def costs() -> np.ndarray:
    """Implausibility by code point in texts of Japanese and English."""
    cost = np.full(0x110000, 2.5, np.float32)
    for c in range(0x30000):
        if 0xD800 <= c < 0xE000:
            cost[c] = 4
            continue
        ch, kind = chr(c), unicodedata.category(chr(c))
        if c < 0x80:
            cost[c] = 0 if c >= 0x20 or ch in "\t\n\r" else 3
        elif c < 0xA0:
            cost[c] = 4
        elif c < 0x100:
            cost[c] = 1.2 if kind[0] == "L" and ch not in "ªº" else 1.5
        elif 0x3041 <= c <= 0x30FF or 0x3000 <= c <= 0x301F or 0xFF01 <= c <= 0xFF60:
            cost[c] = 0
        elif 0xFF61 <= c <= 0xFF9F:
            cost[c] = 0.4
        elif 0x4E00 <= c <= 0x9FFF:
            try:
                cost[c] = 0 if ch.encode("cp932")[0] <= 0x97 else 0.8
            except UnicodeEncodeError:
                cost[c] = 1.8
        elif c < 0x250 or kind == "Mn":
            cost[c] = 1.5
        elif ch in "‘’“”—–…‥℃○●◎△▲□■☆★♪※→←↑↓〒々×÷◇◆−√∞々":
            cost[c] = 0.1
        elif c in range(0x2000, 0x2070) or ch in "€™":
            cost[c] = 1.6
        elif c < 0x530 or 0x2070 <= c < 0x2E80 or 0x3200 <= c < 0x3400:
            cost[c] = 0.8
        elif kind in ("Co", "Cn"):
            cost[c] = 4
    cost[0xE000:0xF900] = 4
    cost[0xF0000:] = 4
    cost[ord(GAP)] = 4
    cost[0xFE0F] = cost[0x200D] = cost[0x200B] = cost[0x200C] = cost[0x2060] = cost[0xFEFF] = cost[0xAD] = cost[0xA0] = cost[0x3099] = cost[0x309A] = 0.1
    cost[0x1F000:0x1FB00] = 0.1
    return cost


_JIS = re.compile(r"\$[!-s]")
_ESCAPE = re.compile(r"&#(?:x[0-9A-Fa-f]{2,6}|\d{3,7});|\\u[0-9a-fA-F]{4}|\\x[89a-fA-F][0-9a-fA-F]|%[89A-Fa-f][0-9A-Fa-f]|=[89A-F][0-9A-F](?==|\s|$)")
_ASCII_RUN = re.compile(r"[!-~]{8,}")


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def cost_of(text: str) -> float:
    total = float(costs()[_points(text)].sum())
    for run in _ASCII_RUN.findall(text):
        pairs = len(_JIS.findall(run))
        if pairs >= 3 and pairs * 8 > len(run):
            total += 0.8 * pairs
    return total + len(_ESCAPE.findall(text))


@lru_cache(200_000)
def _bytes_of(ch: str, codec: str) -> bytes | None:
    """A character's bytes in codec; controls of Latin-1 that a lax decoder let through are their own byte."""
    try:
        return ch.encode(codec)
    except UnicodeEncodeError:
        c = ord(ch)
        if 0x80 <= c < 0x100 and codec != "mac_roman" and (c < 0xA0 or codec == "latin-1"):
            return bytes([c])
        if codec == "cp932" and 0xE000 <= c < 0xE758:  # user-defined rows of Shift JIS
            row, cell = divmod(c - 0xE000, 188)
            return bytes([0xF0 + row, 0x40 + cell + (cell >= 63)])
        return None


def _lost(error: UnicodeError) -> tuple[bytes, int]:
    """What stands for characters that a codec lacks when sequences are only looked for."""
    return b"".join(_bytes_of(ch, error.encoding.replace("-", "_")) or b"\xfe" for ch in error.object[error.start : error.end]), error.end


codecs.register_error("loomtable-lost", _lost)

_UTF8 = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3})")


#: Of encodings that clean Japanese text fits as well, only sequences that Japanese text has.
_UTF8_JA = re.compile(rb"(?:\xe2[\x80-\xbf]{2}|[\xe3-\xe9][\x80-\xbf]{2}|\xef[\xbc-\xbf][\x80-\xbf])")


def _as_utf8(codec: str) -> Callable[[str], str]:
    """Bytes of codec read as UTF-8, wherever they form sequences and that lowers the cost."""
    sequence = _UTF8_JA if codec in ("cp932", "gbk", "euc_jp") else _UTF8

    def stretch(found: re.Match) -> str:
        run = found.group(0)
        # only what costs more than 0.5 can be replaced by something cheaper, and only where there is a sequence
        if float(costs()[_points(run)].sum()) <= 0.5 or not sequence.search(run.encode(codec, "loomtable-lost")):
            return run
        raw = bytearray()
        owner: list[int] = []
        for i, ch in enumerate(run):
            b = _bytes_of(ch, codec)
            b = b if b is not None else (b"\xff" if ch == GAP else b"\xfe")
            raw += b
            owner += [i] * len(b)
        table = costs()
        out: list[str] = []
        used = at = 0  # characters given out, bytes looked at
        piece: list[str] = []
        piece_from = 0

        def close(upto: int) -> None:
            nonlocal used
            if piece:
                new, old = "".join(piece), run[piece_from:upto]
                better = float(table[_points(new)].sum()) + 0.5 < float(table[_points(old)].sum())
                out.append(new if better else old)
                used = upto
                piece.clear()

        while at < len(raw):
            m = sequence.match(raw, at) if piece else sequence.search(raw, at)
            if m:
                at = m.start()
                first = owner[at]
                if not piece:
                    out.append(run[used:first])
                    piece_from = used = first
                    if at and owner[at - 1] == first:
                        piece.append(GAP)
                piece.append(m.group(0).decode("utf-8"))
                at = m.end()
                continue
            if not piece:
                break
            b = raw[at]
            inside = at and owner[at - 1] == owner[at]
            if b < 0x80 and inside:  # ASCII that was swallowed as a second byte
                piece.append(chr(b))
                at += 1
                continue
            if b == 0xFF or 0x80 <= b < 0xC0 or 0xE0 <= b < 0xF0 or inside:  # a byte of a lost sequence
                nxt = next((k for k in range(at + 1, min(at + 5, len(raw))) if sequence.match(raw, k)), None)
                ends = at + 3 >= len(raw) or owner[at] >= len(run) - 2
                if nxt is not None and b != 0xFE or ends and b != 0xFE:
                    if piece[-1] != GAP:
                        piece.append(GAP)
                    at = nxt if nxt is not None else len(raw)
                    continue
                if inside:
                    piece.append(GAP)
                    at += 1
                    continue
            close(owner[at])
            at += 1
        close(len(run))
        out.append(run[used:])
        return "".join(out)

    return lambda text: re.sub(r"[^\x00-\x7f]+", stretch, text)


_KANA = re.compile(r"[぀-ヿ、。]")


def _read_as(run_of: re.Pattern, codec: str, to: str) -> Callable[[str], str]:
    """Stretches read as another multi-byte encoding, where the result has the kana of Japanese prose."""

    def stretch(found: re.Match) -> str:
        run = found.group(0)
        parts = [(b"\xff" if ch == GAP else _bytes_of(ch, codec)) for ch in run]
        if any(p is None for p in parts):
            return run
        new = re.sub(f"{GAP}+", GAP, b"".join(parts).decode(to, "replace"))
        if len(_KANA.findall(new)) * 5 < len(new) or sum(ch > "\x7f" for ch in run) < 4:
            return run
        return new if cost_of(new) + 0.5 < cost_of(run) else run

    return lambda text: run_of.sub(stretch, text)


_SINGLE = re.compile("[\x20-\x7e]*[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ�]+(?:[\x20-\x7e\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ�]*[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ�\x40-\x7e])?")
_HIGH = re.compile("[\x80-\xff�]+")
_EUC_AS_SJIS = re.compile("[｡-ﾟ�-一-鿿]*[｡-ﾟ][｡-ﾟ�-一-鿿]*")


def _raw_jis(text: str) -> str:
    """7-bit JIS without its escape characters."""

    def stretch(found: re.Match) -> str:
        body = found.group(1)
        new = (b"\x1b$B" + body[: len(body) // 2 * 2].encode("ascii") + b"\x1b(B").decode("iso2022_jp", "replace")
        return new if _KANA.search(new) and GAP not in new else found.group(0)

    return re.sub(r"\x1b?\$[@B]((?:[!-~][!-~])+?)(?:\x1b?\([BJ]|(?=[^!-~])|$)", stretch, text)


def _raw_jis_bare(text: str) -> str:
    """7-bit JIS without any mark: stretches of printable ASCII dense with its kana rows."""

    def stretch(found: re.Match) -> str:
        run = found.group(0)
        if len(_JIS.findall(run)) * 6 < len(run):
            return run
        new = (b"\x1b$B" + run[: len(run) // 2 * 2].encode("ascii") + b"\x1b(B").decode("iso2022_jp", "replace")
        return new if GAP not in new and len(_KANA.findall(new)) * 4 > len(new) else run

    return re.sub(r"[!-~]{8,}", stretch, text)


def _percent(text: str) -> str:
    return re.sub(r"(?:%[89A-Fa-f][0-9A-Fa-f]){2,}", lambda m: unquote_to_bytes(m.group(0)).decode("utf-8", "replace"), text)


def _quoted_printable(text: str) -> str:
    return re.sub(r"(?:=[89A-F][0-9A-F](?:=\r?\n)?){2,}", lambda m: bytes.fromhex(re.sub(r"=\r?\n|=", "", m.group(0))).decode("utf-8", "replace"), text)


def _backslashes(text: str) -> str:
    text = re.sub(r"(?:\\u[0-9a-fA-F]{4})+", lambda m: m.group(0).encode().decode("unicode_escape").encode("utf-16", "surrogatepass").decode("utf-16", "replace"), text)
    return re.sub(r"(?:\\x[89a-fA-F][0-9a-fA-F]){2,}", lambda m: bytes.fromhex(m.group(0).replace("\\x", "")).decode("utf-8", "replace"), text)


def _entities(text: str) -> str:
    return re.sub(r"&#(?:x[0-9A-Fa-f]{2,6}|\d{3,7});|&[A-Za-z]{2,8}(?:uml|acute|grave|circ|tilde|cedil|ring|slash|lig);", lambda m: html.unescape(m.group(0)), text)


STEPS: dict[str, Callable[[str], str]] = {
    "latin-1 > utf-8": _as_utf8("latin-1"),
    "cp1252 > utf-8": _as_utf8("cp1252"),
    "mac_roman > utf-8": _as_utf8("mac_roman"),
    "cp932 > utf-8": _as_utf8("cp932"),
    "gbk > utf-8": _as_utf8("gbk"),
    "euc_jp > utf-8": _as_utf8("euc_jp"),
    "cp1252 > cp932": _read_as(_SINGLE, "cp1252", "cp932"),
    "mac_roman > cp932": _read_as(re.compile(r"[^　-\U0010ffff\n]*[^\x00-\x7f　-\U0010ffff][^　-\U0010ffff\n]*"), "mac_roman", "cp932"),
    "latin-1 > euc_jp": _read_as(_HIGH, "latin-1", "euc_jp"),
    "cp1252 > euc_jp": _read_as(re.compile("[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ�]+"), "cp1252", "euc_jp"),
    "cp932 > euc_jp": _read_as(_EUC_AS_SJIS, "cp932", "euc_jp"),
    "escape-less jis": _raw_jis,
    "bare jis": _raw_jis_bare,
    "percent": _percent,
    "quoted-printable": _quoted_printable,
    "backslash": _backslashes,
    "entity": _entities,
}
_ESCAPES = {"percent", "quoted-printable", "backslash", "entity"}


_CP1252 = frozenset(map(ord, "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"))
_MAC_LEADS = frozenset(map(ord, bytes(range(0xC2, 0xF5)).decode("mac_roman")))


def applicable(text: str) -> list[str]:
    """The steps that may change a text, by the characters they need."""
    points = np.unique(_points(text))
    beyond = points[points >= 0x80]
    leads, high = bool(((beyond >= 0xC2) & (beyond <= 0xF4)).any()), bool((beyond < 0x100).any())
    single = high or any(int(p) in _CP1252 for p in beyond[(beyond > 0x100) & (beyond < 0x2200)])
    east = bool((beyond >= 0x2E80).any())
    needs = {
        "latin-1 > utf-8": leads,
        "cp1252 > utf-8": leads,
        "mac_roman > utf-8": any(int(p) in _MAC_LEADS for p in beyond[(beyond < 0x3000) | (beyond == 0xF8FF) | (beyond >= 0xFB00)]),
        "cp932 > utf-8": east,
        "gbk > utf-8": east,
        "euc_jp > utf-8": east,
        "cp1252 > cp932": single,
        "mac_roman > cp932": bool((beyond < 0x3000).any()),
        "latin-1 > euc_jp": high,
        "cp1252 > euc_jp": single,
        "cp932 > euc_jp": bool(((beyond >= 0xFF61) & (beyond <= 0xFF9F)).any()),
        "escape-less jis": "$" in text,
        "bare jis": "$" in text,
        "percent": "%" in text,
        "quoted-printable": "=" in text,
        "backslash": "\\" in text,
        "entity": "&" in text,
    }
    return [name for name in STEPS if needs[name]]


_ESCAPED = re.compile(_ESCAPE.pattern + r"|\$[!-s].?\$")
RARE, APART = 0.35, 3  # cost from which a character counts as rare; characters between two that stand apart


def open_cost(text: str) -> float:
    """Cost of what a wrong decoding may have left: not that of single rare characters apart from each other, nor of gaps, which no step fills."""
    points = _points(text)
    cost = costs()[points]
    rare = np.flatnonzero((cost >= RARE) & (points != ord(GAP)))
    if not rare.size:
        return float(len(_ESCAPED.findall(text)))
    far = np.r_[True, np.diff(rare) > APART]
    lone = far & np.r_[far[1:], True] & (cost[rare] < 1.0)
    return float(cost[rare[~lone]].sum()) + len(_ESCAPED.findall(text))


def settled(text: str) -> bool:
    return open_cost(text) == 0


CLEAN_RUN = 10  # signs of plain Japanese in a row that part two stretches; one of a wrong decoding has a costly sign every few


def pieces(text: str) -> list[str]:
    """The text in parts that were damaged each by itself: cut at line ends, and amid runs of plain Japanese."""
    points = _points(text)
    plain = (costs()[points] == 0) & (points >= 0x3000)
    edges = np.flatnonzero(np.diff(np.r_[False, plain, False].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= CLEAN_RUN
    lines = np.flatnonzero((points[:-1] == 10) & (np.r_[0, points[:-2]] != ord("="))) + 1
    cuts = np.unique(np.r_[0, (starts[long] + ends[long]) // 2, lines, len(text)]).astype(int).tolist()
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def search(text: str) -> tuple[str, list[str]]:
    """The cheapest text that is reached from text, piece by piece, and the steps to it; those of different pieces one after the other."""
    done = [_search(p) for p in pieces(text)]
    paths = list(dict.fromkeys(tuple(path) for _, path in done if path))
    return "".join(t for t, _ in done), list(paths[0]) if len(paths) == 1 else list(dict.fromkeys(step for path in paths for step in path))


def _search(text: str) -> tuple[str, list[str]]:
    first = cost_of(text)
    best: tuple[float, str, tuple[str, ...]] = (first, text, ())
    heap = [(first, 0, text, ())]
    seen = {hash(text)}
    order = 0
    left = open_cost(text)
    while heap and left:
        _, _, state, path = heapq.heappop(heap)
        if STEP_COST * (len(path) + 1) >= best[0]:  # not even a text that costs nothing would be cheaper
            continue
        least = open_cost(state) / len(STEPS)
        before = cost_of(state)
        for name in applicable(state):
            reached = STEPS[name](state)
            if reached == state or hash(reached) in seen:
                continue
            seen.add(hash(reached))
            after = cost_of(reached)
            if before - after < least and name not in _ESCAPES:
                continue
            total = after + STEP_COST * (len(path) + 1)
            order += 1
            heapq.heappush(heap, (total, order, reached, (*path, name)))
            if total < best[0]:
                best = (total, reached, (*path, name))
                left = open_cost(reached)
    return best[1], list(best[2])


_DECAY = re.compile("[\x80-\x9f�-]|[\U000f0000-\U0010ffff]")


def judge(text: str) -> tuple[bool, str | None, list[str]]:
    """(garbled, restored, steps); restored is null unless the text could be had whole."""
    before = cost_of(text)
    new, path = search(text)
    after = cost_of(new)
    if any(p not in _ESCAPES for p in path) and before - after >= LEAST_GAIN:
        return True, None if _DECAY.search(new) else new, path
    decayed = len(_DECAY.findall(text.rstrip(GAP)))
    if decayed >= 2:
        return True, None, []
    if path and before - after >= max(LEAST_GAIN, 0.1 * len(text)):  # escaped for the larger part
        return True, new, path
    return False, None, []


def judge_all(texts: list[str | None]) -> list[tuple[bool, str | None, list[str]]]:
    """judge() of every text; one lookup over all of them says which are searched."""
    some = [t or "" for t in texts]
    sizes = np.fromiter(map(len, some), np.int64, len(some))
    table = costs()
    total = np.r_[0, np.cumsum(table[_points("".join(some))], dtype=np.float64)]
    ends = np.cumsum(sizes)
    suspect = total[ends] - total[ends - sizes] >= _SUSPECT
    return [judge(t) if s or _ESCAPED.search(t) else (False, None, []) for t, s in zip(some, suspect)]


def with_restored(df: DataFrame, text: str) -> DataFrame:
    """df with is_garbled, restored and steps for `text`; columns of those names are replaced."""
    names = ["is_garbled", "restored", "steps"]
    base = df.drop(*(n for n in names if n != text))
    schema = T.StructType([*base.schema.fields, T.StructField("is_garbled", T.BooleanType()), T.StructField("restored", T.StringType()), T.StructField("steps", T.ArrayType(T.StringType()))])
    at = base.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge_all(batch.column(at).to_pylist())
            made = [pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return base.mapInArrow(run, schema)


def garbled_report(df: DataFrame, group: str, text: str) -> DataFrame:
    """Per group: texts, garbled ones, and those restored whole."""
    judged = with_restored(df.select(F.col(group), F.col(text)), text)
    return judged.groupBy(group).agg(F.count("*").alias("n_texts"), F.count_if("is_garbled").alias("n_garbled"), F.count("restored").alias("n_restored"))
