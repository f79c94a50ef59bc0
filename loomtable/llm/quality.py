"""Statistics of each document's text, and which texts are no natural prose.

`text_statistics` is made of JVM expressions: words, their mean length, symbols, digits, lines
that end in punctuation, common words. The classifier takes the same statistics and shape
features that need more than regular expressions (share of text in whole sentences,
repetition, plausibility of characters) from one pass over the code points of an Arrow batch:
tables say of each point what it is, sums over each text are differences of running sums.

Labels are weak: texts that are plainly made of sentences are prose, texts without any and
with the marks of lists, tables, code or noise are not, the rest has no label. Gradient-
boosted trees are fitted on at most SAMPLE labelled rows, taken by the hash of their ids; their
scores are calibrated (Platt) on HOLDOUT, written and judged by hand. All rows are scored.

Null, empty and blank texts have zero statistics and are never listed. Ties and repeated
texts get equal scores; texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.mojibake import costs
from loomtable.session import cut_lineage

SAMPLE = 8000
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32

WORD = r"[A-Za-z]+(?:'[A-Za-z]+)?|[0-9]+|[\x{4E00}-\x{9FFF}\x{3005}]+|[\x{30A1}-\x{30FA}\x{30FC}]+|[\x{3041}-\x{3096}]+"
WORD_CHARS = r"[A-Za-z0-9\x{4E00}-\x{9FFF}\x{3005}\x{30A1}-\x{30FA}\x{30FC}\x{3041}-\x{3096}]+"
#: Blanks, letters, digits and the marks of ordinary sentences are no symbols.
NO_SYMBOL = r"[\s\x{A0}\x{3000}A-Za-z0-9\x{C0}-\x{24F}\x{4E00}-\x{9FFF}\x{3005}\x{30A1}-\x{30FC}\x{3041}-\x{3096}、。，．,.!?！？「」『』（）()'\x{22}“”‘’：:；;・…ー-]+"
BLANK = r"[\s\x{A0}\x{3000}]+"
LINE = r"(?m)^[ \t\r\f\x{0B}\x{A0}\x{3000}]*[^\s\x{A0}\x{3000}][^\n]*$"
ENDED_LINE = r"(?m)[。．.!?！？」』）)\x{22}”][ \t\r\x{3000}]*$"


def common_word_lists(common: DataFrame) -> tuple[list[str], list[str]]:
    """(English, Japanese) words of the table of frequent words; a fixed table of some ninety rows."""
    rows = common.filter("word IS NOT NULL").select("lang", "word").distinct().collect()
    return sorted(r.word.lower() for r in rows if r.lang == "en"), sorted((r.word for r in rows if r.lang == "ja"), key=lambda w: (-len(w), w))


def text_statistics(df: DataFrame, key: str, text: str, english: list[str], japanese: list[str]) -> DataFrame:
    """(key, n_chars, n_words, mean_word_length, symbol_ratio, digit_ratio, n_lines, ended_line_share, common_word_share).

    Ratios are of characters that are no blanks, shares of lines of lines that are not blank.
    Words are English words of the list or occurrences of Japanese ones, per word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    en = F.size(F.filter(F.regexp_extract_all(F.lower(t), F.lit("([a-z]+)"), F.lit(1)), lambda w: w.isin(english))) if english else F.lit(0)
    ja = count("|".join(japanese)) if japanese else F.lit(0)
    # each count is made once, in a projection of its own; the ratios below share them
    counts = df.select(
        F.col(key).alias("_key"),
        F.length(t).alias("n_chars"),
        count(WORD).alias("n_words"),
        (F.length(t) - F.length(F.regexp_replace(t, WORD_CHARS, ""))).alias("letters"),
        F.length(F.regexp_replace(t, BLANK, "")).alias("solid"),
        F.length(F.regexp_replace(t, NO_SYMBOL, "")).alias("symbols"),
        (F.length(t) - F.length(F.regexp_replace(t, "[0-9]+", ""))).alias("digits"),
        count(LINE).alias("n_lines"),
        count(ENDED_LINE).alias("ended"),
        (en + ja).alias("common"),
    )
    share = lambda part, whole: F.when(F.col(whole) > 0, F.round(F.col(part) / F.col(whole), 6)).otherwise(F.lit(0.0))
    return counts.select(
        F.col("_key").alias(key),
        "n_chars",
        "n_words",
        share("letters", "n_words").alias("mean_word_length"),
        share("symbols", "solid").alias("symbol_ratio"),
        share("digits", "solid").alias("digit_ratio"),
        "n_lines",
        share("ended", "n_lines").alias("ended_line_share"),
        share("common", "n_words").alias("common_word_share"),
    )


_FUNCTION = frozenset(
    "the of and to in a an is i we you my our it that for with was are as at on be this have not but they he she his her or from by me your their if when who where what which how because every each all most more than before after now then here there into through about over under such so no can could will would should has had did do does been being were us them its up out don't isn't must i'm i've it's you'll couldn't".split()
)
_SENTENCE_END = re.compile(r"(?:[。．!?！？]+|(?<=[A-Za-z\"')’”ぁ-ん」])\.(?=\s|$|[ぁ-ヿ一-鿿「]))[」』）)\"”]*")
_WORDS = re.compile(r"[A-Za-z][A-Za-z'’]*")
_BULLET = re.compile(r"^\s*(?:[-*+•・●○■□◆◇▶→–—>]|\(?\d{1,3}[.)）:：]|第\d+|[A-Z][.)])\s*")

SHAPES = ["sentence_share", "hiragana_share", "latin_share", "mean_line", "bullet_share", "delimiter_ratio", "code_ratio", "distinct_share", "implausibility", "longest_word", "function_share"]
FEATURES = ["n_chars", "n_words", "mean_word_length", "symbol_ratio", "digit_ratio", "n_lines", "ended_line_share", "common_word_share", *SHAPES]


_SPACE_JVM = frozenset(map(ord, " \t\n\x0b\f\r\xa0\u3000"))
_TAIL = frozenset(map(ord, " \t\r\u3000"))
_BREAKS = frozenset(map(ord, "\n\r\x85\u2028\u2029"))


@lru_cache(1)
def _classes() -> dict[str, np.ndarray]:
    """Tables by code point, made by rule from the patterns above."""
    top = 0x110000
    every = np.arange(top)

    def of(points) -> np.ndarray:
        out = np.zeros(top, bool)
        out[list(points)] = True
        return out

    latin, digit = ((every | 32) >= 97) & ((every | 32) <= 122) & (every < 128), (every >= 48) & (every <= 57)
    kanji = ((every >= 0x4E00) & (every <= 0x9FFF)) | (every == 0x3005)
    katakana = ((every >= 0x30A1) & (every <= 0x30FA)) | (every == 0x30FC)
    hiragana = (every >= 0x3041) & (every <= 0x3096)
    plain = latin | digit | ((every >= 0xC0) & (every <= 0x24F)) | kanji | hiragana | ((every >= 0x30A1) & (every <= 0x30FC))
    marks = of(map(ord, "、。，．,.!?！？「」『』（）()'\"“”‘’：:；;・…ー-"))
    space = np.zeros(top, bool)
    space[[c for c in range(0x3001) if chr(c).isspace()]] = True
    return {
        "word": (latin + 2 * digit + 3 * kanji + 4 * katakana + 5 * hiragana).astype(np.int8),
        "blank": of(_SPACE_JVM),
        "symbol": ~(plain | marks | of(_SPACE_JVM)),
        "digit": digit,
        "latin": latin,
        "hiragana": hiragana,
        "prose_hiragana": (every >= ord("ぁ")) & (every <= ord("ん")),
        "space": space,
        "end": of(map(ord, "。．.!?！？」』）)\"”")),
        "tail": of(_TAIL),
        "delimiter": of(map(ord, "\t|｜,，;；／/>＞")),
        "code": of(map(ord, "{}[]()<>=;^&_#$%")),
        "part": space | of(map(ord, "、。,.")),
    }


class _Sums:
    """Sums over stretches of an array, by one running sum."""

    def __init__(self, values: np.ndarray):
        self.total = np.zeros(values.size + 1, np.int64 if values.dtype == bool else float)
        np.cumsum(values, out=self.total[1:])

    def over(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.total[ends] - self.total[starts]


def _layout(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all texts, start and end of each)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return points, np.r_[0, ends[:-1]].astype(np.int64), ends


def _runs(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true flags; a run ends where a text begins."""
    begins = flags & (~np.r_[False, flags[:-1]] | first)
    stops = flags & (~np.r_[flags[1:], False] | np.r_[first[1:], True])
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def statistics(texts: list[str], english: frozenset[str], japanese: list[str]) -> np.ndarray:
    """The statistics of text_statistics, a row per text, as text_statistics rounds them."""
    t = _classes()
    points, starts, ends = _layout(texts)
    n = len(texts)
    first = np.zeros(points.size, bool)
    first[starts[starts < ends]] = True
    row = np.repeat(np.arange(n), ends - starts)
    word = t["word"][points]
    change = np.r_[True, word[1:] != word[:-1]][: points.size] | first
    begins = np.flatnonzero((word > 0) & change)
    # a Latin run after an apostrophe belongs to the Latin run before it, unless that one already has an apostrophe
    joined = np.zeros(begins.size, bool)
    after = begins[(begins >= 2) & (word[begins] == 1)]
    after = after[(points[after - 1] == 39) & (word[after - 2] == 1) & ~first[after] & ~first[after - 1]]
    joined[np.searchsorted(begins, after)] = True
    index = np.arange(begins.size)
    joined &= (index - np.maximum.accumulate(np.where(joined, -1, index))) % 2 == 1 if begins.size else joined
    words = np.bincount(row[begins[~joined]], minlength=n)
    count = lambda flags: np.bincount(row[flags], minlength=n)
    letters, blank, digits, symbols = count(word > 0), count(t["blank"][points]), count(t["digit"][points]), count(t["symbol"][points])
    solid = ends - starts - blank
    # lines that are not blank; an end mark counts where only blanks follow it up to a line's end
    line = np.cumsum(first | np.r_[False, points[:-1] == 10][: points.size])
    filled = ~t["blank"][points]
    lines = np.zeros(n, np.int64)
    if filled.any():
        at = np.flatnonzero(filled)
        lines = np.bincount(row[at[np.r_[True, np.diff(line[at]) > 0]]], minlength=n)
    marks = np.flatnonzero(t["end"][points])
    ended = np.zeros(n, np.int64)
    if marks.size:
        stop = ~t["tail"][points]
        following = np.minimum.accumulate(np.where(stop, np.arange(points.size), points.size)[::-1])[::-1]  # the next sign that is no blank
        after = np.r_[following, points.size][marks + 1]
        last = ends[row[marks]]
        to = np.minimum(after, last)
        over = after >= last
        breaks = np.isin(points[np.minimum(after, points.size - 1)], list(_BREAKS)) & ~over
        returns = _Sums(points == 13).over(marks + 1, to) > 0
        ended = np.bincount(row[marks[over | breaks | returns]], minlength=n)
    common = np.zeros(n, np.int64)
    latin = count(t["latin"][points] | (points == 0x212A) | (points == 0x130))  # what lower() makes a Latin letter of
    if english:
        for k in np.flatnonzero(latin):
            common[k] += sum(w in english for w in _LETTERS.findall(texts[k].lower()))
    if japanese:
        find = _japanese(tuple(japanese))
        for k in np.flatnonzero(letters - latin > 0):
            common[k] += find(texts[k])
    share = lambda part, whole: np.round(np.where(whole > 0, part / np.maximum(whole, 1), 0.0), 6)
    return np.stack([ends - starts, words, share(letters, words), share(symbols, solid), share(digits, solid), lines, share(ended, lines), share(common, words)], 1).astype(float)


_LETTERS = re.compile("[a-z]+")


@lru_cache(4)
def _japanese(words: tuple[str, ...]):
    """How many of the words stand in a text, one after the other, the longest first."""
    try:
        import ahocorasick
    except ImportError:
        pattern = re.compile("|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w)))))
        return lambda text: len(pattern.findall(text))
    search = ahocorasick.Automaton()
    for w in words:
        search.add_word(w, 1)
    search.make_automaton()
    return lambda text: len(list(search.iter_long(text)))


_RETURNS = re.compile(r"\r\n?")
_FLOW = re.compile(r"(?<=[ぁ-ヿ一-鿿、])\n(?=[ぁ-ヿ一-鿿、。0-9])")
_BLANKS = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace())


def shapes(texts: list[str]) -> np.ndarray:
    """The features of SHAPES, a row per text; no text may be blank."""
    t = _classes()
    given = [_RETURNS.sub("\n", x) if "\r" in x else x for x in texts]
    flat = [_FLOW.sub("", x) if "\n" in x else x for x in given]
    points, starts, ends = _layout(flat)
    n = len(texts)
    filled = ~t["space"][points]
    sums = {c: _Sums(t[c][points]) for c in ("hiragana", "prose_hiragana", "latin", "code", "delimiter")}
    solid = _Sums(filled)
    size = np.maximum(1, solid.over(starts, ends))
    cost = _Sums(costs()[points].astype(float) * filled)
    longest = _longest(given)
    in_sentences, function = np.zeros(n), np.zeros(n)
    hira, body, roman = sums["prose_hiragana"].total, solid.total, sums["latin"].total
    latin = sums["latin"].over(starts, ends)
    mean_line, bullets, distinct = np.zeros(n), np.zeros(n), np.ones(n)
    compact = points[filled].astype(np.int64)
    from_, to_ = solid.total[starts], solid.total[ends]
    for k, text in enumerate(flat):
        s = at = int(starts[k])
        for m in _SENTENCE_END.finditer(text):
            a, at = at, s + m.end()
            long = int(body[at] - body[a])
            if long >= 6 and (hira[at] - hira[a]) * 5 >= long and len(set(text[a - s : at - s]) - _BLANKS) >= 6:
                in_sentences[k] += long
            elif 2 * (roman[at] - roman[a]) + 12 >= long and roman[at] > roman[a]:
                words = [w.lower().replace("’", "'") for w in _WORDS.findall(text[a - s : at - s])]
                if len(words) >= 4 and len(set(words)) >= 4 and not _FUNCTION.isdisjoint(words) and 2 * sum(map(len, words)) >= long:
                    in_sentences[k] += long
        lines = [x for x in given[k].split("\n") if x and not x.isspace()]
        mean_line[k] = sum(map(len, lines)) / max(1, len(lines))
        bullets[k] = sum(1 for x in lines if _BULLET.match(x)) / max(1, len(lines))
        if latin[k]:
            words = _WORDS.findall(given[k].lower())
            function[k] = sum(1 for w in words if w in _FUNCTION) / max(1, len(words))
        p = compact[from_[k] : to_[k]]
        if p.size > 4:
            p = p[:-3] * 1000003 + p[1:-2] * 10007 + p[2:-1] * 101 + p[3:]
        p = np.sort(p)
        distinct[k] = (1 + np.count_nonzero(p[1:] != p[:-1])) / p.size if p.size else 0.0
    over = lambda c: sums[c].over(starts, ends) / size
    return np.stack([np.minimum(1.0, in_sentences / size), over("hiragana"), over("latin"), mean_line, bullets, over("delimiter"), over("code"), distinct, cost.over(starts, ends) / size, longest, function], 1)


def _longest(texts: list[str]) -> np.ndarray:
    """Of each text the longest stretch without a blank, comma or stop."""
    points, starts, ends = _layout(texts)
    first = np.zeros(points.size, bool)
    first[starts[starts < ends]] = True
    a, b = _runs(~_classes()["part"][points], first)
    longest = np.zeros(len(texts))
    np.maximum.at(longest, np.searchsorted(ends, a, side="right"), b - a)
    return longest


def features(df: DataFrame, key: str, text: str, english: list[str], japanese: list[str]) -> DataFrame:
    """(key, one double per name of FEATURES) of the rows whose text is not blank; key must be a bigint."""
    some = df.filter(F.col(text).rlike(r"(?U)\S")).select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = np.concatenate([statistics(texts, frozenset(english), japanese), shapes(texts)], 1) if texts else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(made[:, k]) for k in range(len(FEATURES)))], names=["key", *FEATURES])

    return some.mapInArrow(run, "key bigint, " + ", ".join(f"{c} double" for c in FEATURES))


def weak_label(x: np.ndarray) -> np.ndarray:
    """1 for what is plainly no prose, 0 for plain prose, -1 where the marks do not agree."""
    f = {n: x[:, k] for k, n in enumerate(FEATURES)}
    # a pattern that goes on and on repeats most of its grams; prose repeats phrases only
    stuck = (f["distinct_share"] < 0.06) & (f["n_chars"] > 100) & (f["n_words"] < 40 * np.maximum(1, f["distinct_share"] * f["n_chars"]))
    junk = (f["sentence_share"] < 0.35) & (
        (f["ended_line_share"] < 0.3) | (f["symbol_ratio"] > 0.2) | (f["digit_ratio"] > 0.3) | (f["delimiter_ratio"] > 0.1) | (f["implausibility"] > 0.3)
    )
    noise = (f["implausibility"] > 0.5) | (f["code_ratio"] > 0.25) | (stuck & (f["sentence_share"] < 0.6))
    prose = (f["sentence_share"] > 0.6) & (f["implausibility"] < 0.2) & (f["symbol_ratio"] < 0.1) & (f["code_ratio"] < 0.1) & (f["distinct_share"] > 0.03)
    return np.where(junk | noise, 1, np.where(prose, 0, -1))


class Trees:
    """Gradient-boosted regression trees for a binary label, on binned features."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS):
        self.n, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.base, self.splits, self.values = 0.0, [], []
        self.slope, self.shift = 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)
        p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.base = math.log(p0 / (1 - p0))
        score = np.full(len(y), self.base)
        for _ in range(self.n if 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), int)
            splits = []
            for level in range(self.depth):
                width = 2**level
                g_all, h_all = np.bincount(node, grad, width), np.bincount(node, hess, width)
                best = [(1e-6, 0, self.bins)] * width
                for j in range(x.shape[1]):
                    at = node * (self.bins + 1) + binned[:, j]
                    g = np.bincount(at, grad, width * (self.bins + 1)).reshape(width, -1).cumsum(1)
                    h = np.bincount(at, hess, width * (self.bins + 1)).reshape(width, -1).cumsum(1)
                    gain = g**2 / (h + 1) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + 1) - (g_all**2 / (h_all + 1))[:, None]
                    for k, b in enumerate(gain[:, :-1].argmax(1)):
                        if gain[k, b] > best[k][0]:
                            best[k] = (gain[k, b], j, int(b))
                splits.append([(j, b) for _, j, b in best])
                feature, border = np.array([s[0] for s in splits[-1]]), np.array([s[1] for s in splits[-1]])
                node = node * 2 + (binned[np.arange(len(y)), feature[node]] > border[node])
            leaves = 2**self.depth
            value = self.rate * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + 1)
            self.splits.append(splits)
            self.values.append(value)
            score += value[node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for splits, value in zip(self.splits, self.values):
            node = np.zeros(len(x), int)
            for level in splits:
                feature, border = np.array([s[0] for s in level]), np.array([s[1] for s in level])
                node = node * 2 + (binned[rows, feature[node]] > border[node])
            out += value[node]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Trees:
        """Platt scaling with smoothed targets, by Newton steps."""
        s = self.score(x)
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            g = np.array([((p - target) * s).sum() + 1e-3 * (a - 1), (p - target).sum() + 1e-3 * b])
            w = np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        if a > 0:
            self.slope, self.shift = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.score(x) + self.shift, -30, 30)))


#: Texts written and judged by hand: 1 for no prose.
HOLDOUT = [
    (0, "春の朝、校門の前で友人を待っていると、知らない先生が声をかけてくれました。それが私と図書室との出会いです。"),
    (0, "雨が続いた一週間、私たちは体育館で劇の練習を続けた。照明の係は最後まで決まらなかったが、誰も諦めなかった。"),
    (0, "I arrived late on the first day. Nobody laughed, and a girl I had never met moved her bag so that I could sit down."),
    (0, "When the river rose, the whole village came to the school. We carried books upstairs until it was dark."),
    (0, "Q: なぜこの仕事を選びましたか。\nA: 祖父が船乗りで、海の話を毎晩聞いていたからです。\nQ: 大変なことは何ですか。\nA: 朝が早いことですね。"),
    (0, "聞き手：最初に驚いたことは何ですか。\n卒業生：廊下で誰もが挨拶をすることでした。今でも思い出します。"),
    (0, "窓を開けると、校庭から笛の音が聞\nこえてきました。私はその音を聞き\nながら、三年間のことをゆっくりと\n思い出していました。"),
    (0, "We walked along the wall for an hour,\nand none of us said a word. It was the\nbest conversation I have ever had with\nmy classmates."),
    (0, "# 沿革\n本校は海辺の小さな塾から始まりました。当時の生徒は七人で、冬は炭を持ち寄って暖をとったといいます。\n・本館\n・別館"),
    (0, "卒業式の日、祖母は何も言わずに帽子を直してくれた。私は泣かないと決めていたのに、だめだった。\n場所\t講堂\n時刻\t十時"),
    (0, "この冊子は、先輩たちが残した言葉を集めたものです。読み返すたびに、違う一行が心に残ります。"),
    (0, "My sister asked me what I had learned. I told her that I had learned to listen, which surprised us both."),
    (0, "給食の時間になると、廊下に匂いが流れてきます。それだけで午前の疲れを忘れました。"),
    (0, "風の強い日でした。"),
    (0, "The bell rang twice, and then it was quiet."),
    (0, "本を閉じたとき、外はもう暗くなっていた。隣の席の人が、まだ静かに読んでいるのが見えた。ずっとここにいたいと思った。"),
    (1, "国語\n数学\n理科\n社会\n英語\n体育"),
    (1, "・入学式\n・遠足\n・運動会\n・合唱祭\n・修学旅行\n・卒業式"),
    (1, "1. the gate\n2. the pond\n3. the bridge\n4. the tower\n5. the garden"),
    (1, "year,name,count,rate\n2019,a,12,0.4\n2020,b,19,0.6\n2021,c,7,0.2"),
    (1, "| 月 | 行事 | 場所 |\n| --- | --- | --- |\n| 4 | 入学式 | 講堂 |\n| 5 | 遠足 | 公園 |"),
    (1, "学年\t人数\t部屋\n1\t120\tA\n2\t118\tB\n3\t121\tC"),
    (1, "<ul><li><a href=\"/a\">top</a></li><li><a href=\"/b\">map</a></li></ul><div class=\"x\"></div>"),
    (1, "function f(x){return x+1;} var a=[1,2,3]; for(i=0;i<3;i++){f(a[i]);}"),
    (1, "90121 33012 87 1209 55510 2384 19 40012 77121 3309 1182 90 4471"),
    (1, "qX8fLm20ZpR7vWc1TtYbN4uKjH6gSdE9aQoPzXcVbNm3AsDfGhJkLqWeRtYuIoP0"),
    (1, "縺薙ｓ縺ｫ縺｡縺ｯ縲ょ⊂縺励＞譛ｬ縺後≠繧翫∪縺吶"),
    (1, "ã\x81\x93ã\x82\x93ã\x81«ã\x81¡ã\x81¯ã\x80\x82æ\x9c¬ã\x81\x8cã\x81\x82ã\x82\x8aã\x81¾ã\x81\x99ã\x80\x82"),
    (1, "もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる もどる"),
    (1, "read more read more read more read more read more read more read more read more read more"),
    (1, "%$#@!◆◆■□※※★☆▼▼<>{}[]~^|\\_=+%%$$##"),
    (1, "ホーム > 学校案内 > 沿革 > 年表 > 資料 > 地図 > 問い合わせ"),
    (1, "鍋、皿、箸、匙、椀、盆、布巾、茶碗、急須、土瓶、やかん、鉄瓶"),
    (1, "the gate / the pond / the bridge / the tower / the garden / the wall / the hall"),
    (1, "月 火 水 木 金\n1 国語 数学 理科 社会 英語\n2 体育 音楽 美術 国語 数学\n3 理科 社会 英語 体育 音楽"),
    (1, "・\n\n1\n*\n―\n　\n・\n*\n1\n…\n―\n・"),
    (1, "蟻ヌ簾ヱ柑ロ擣ゾ鼬ヘ曚ギ榕ヨ齧ド碾ム菫ワ閂ホ"),
    (1, "4月1日 入学式\n4月8日 始業式\n5月2日 遠足\n6月9日 体育祭"),
]


def fitted(feats: DataFrame, holdout: np.ndarray, sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most `sample` weakly labelled rows of feats and calibrated on the holdout."""
    rows = feats.orderBy(F.xxhash64("key"), "key").limit(sample).collect()
    x = np.array([[r[c] for c in FEATURES] for r in rows], float).reshape(-1, len(FEATURES))
    y = weak_label(x)
    trees = Trees().fit(x[y >= 0], y[y >= 0].astype(float)) if (y >= 0).any() else Trees().fit(holdout[:, 1:], holdout[:, 0])
    if not trees.values:  # one kind of text only: the hand-judged texts say what the other is
        trees = Trees().fit(holdout[:, 1:], holdout[:, 0])
    return trees.calibrate(holdout[:, 1:], holdout[:, 0])


def holdout_features(spark, english: list[str], japanese: list[str]) -> np.ndarray:
    """One row per text of HOLDOUT: its label and its features."""
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(HOLDOUT)], "id bigint, text string")
    rows = sorted(features(df, "id", "text", english, japanese).collect(), key=lambda r: r.key)
    return np.array([[HOLDOUT[r.key][0], *(r[c] for c in FEATURES)] for r in rows], float)


def scored(df: DataFrame, key: str, text: str, common: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(key, junk_probability) of every row whose text is not blank."""
    english, japanese = common_word_lists(common)
    feats = cut_lineage(features(df, key, text, english, japanese))
    trees = fitted(feats, holdout_features(df.sparkSession, english, japanese), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k + 1).to_numpy() for k in range(len(FEATURES))], 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(trees.probability(x), 6) if len(x) else np.array([], float))], names=["key", "junk_probability"])

    return feats.mapInArrow(run, "key bigint, junk_probability double")
