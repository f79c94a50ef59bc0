"""Texts cut off by a field limit or a broken transfer.

The vocabulary of the whole corpus is a trie whose branches are walked in sorted order. The
last word of a text without a closing mark is looked up in it:

 - a word that is unknown but a proper prefix of known words was cut in mid-word; the more
   often the corpus has the longer words, the surer ('prefix');
 - a word that is known as a whole counts, as a node of the trie, how often a sentence ended
   with it, how often it went on to another word, and how often to the rest of a longer
   one. Where it mostly goes on it was cut: in mid-word if longer words are the more frequent
   way on ('prefix' too), else in mid-sentence ('goes_on'). The words before it break ties:
   the share of ends is that of the longest run seen, backed off to shorter ones, the
   model's order being a parameter;
 - a word unknown to both is a signature, motto or heading, unless the length or a mark of
   omission speaks for a cut.

To each of these log-odds is added the evidence of length: how many more texts end at this
length than at the lengths around it, bounded so that it settles only what the trie leaves
open ('length' where it alone makes the difference). An open bracket that is not closed and
a character broken in transfer are cuts by themselves ('bracket', 'broken'); marks of
omission are taken off and what is before them is judged.

What stands at the very end of a text without a mark never enters the vocabulary, so cut
words do not vouch for themselves. All counts weigh by their ratios, none has a threshold.

Scale: each text is parsed once; counts are summed per batch before the shuffle, and probes
and counts are written to the checkpoint folder. Words and asked tokens meet by first
character, sorted, and one streaming walk keeps only the open branch: no prefix of a word is
ever made a row, and a word of any length costs its own length. The histogram of lengths has
a row per length. Nothing is collected. Null, empty and blank texts are not cut. Repeated
texts are judged alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.llm.confusables import _formed, array_of, points_of
from loomtable.session import cut_lineage

ORDER = 3  # words in a row of the longest run
BACKOFF = 0.2  # weight of the shorter run's share beside a run's own counts
AROUND = 6  # lengths to each side that a length is held against
LENGTH_SMOOTHING = 2.0  # texts that every length is taken to have beside those counted
LENGTH_WEIGHT = 1.4  # most that length adds or takes, in log-odds
UNKNOWN = -1.1  # log-odds of a cut for a last word that is neither known nor a prefix
OMISSION = 4.0  # what a mark of omission adds to that

_WORD = re.compile(r"[A-Za-z]+(?:'[A-Za-z]+)?|[0-9]+|[一-鿿㐀-䶿豈-﫿々〆]+[ぁ-ん]*|[ァ-ヺー]+[ぁ-ん]*|[ぁ-ん]+|\n|[^\s]")
_END = frozenset("。.!?♪｡")
_STOP = _END | {"\n"}
_CLOSERS = frozenset("」』)\"'】〉》]")
_OPENERS = {"「": "」", "『": "』", "(": ")", "【": "】"}
_HANGING = frozenset("、,") | frozenset(_OPENERS)
_OMISSION = re.compile(r"(?:\.{3,}|[…‥]+|・{2,})\s*$")
_OMITS = frozenset(".…‥・")
_DIGITS = re.compile(r"[0-9]+")


def words(form: str) -> list[str]:
    return _WORD.findall(_DIGITS.sub("0", form.lower()))


def _tokens(text: str, order: int, counts: Counter) -> list[str]:
    """The words of a form; adds to counts (run, whether the sentence ended after it) of every run within a sentence, but for the last words."""
    w = words(text)
    if len(w) > 1:
        after = [x in _END for x in w[1:]]
        for j in range(len(w) - 2):  # an omission is no end
            if w[j + 1] == "." and w[j + 2] == ".":
                after[j] = None
        counts.update(zip(w, after))
        for k in range(2, order + 1):
            counts.update(zip(zip(*(w[i:] for i in range(k))), after[k - 1 :]))
    return w


def _summed(counts: Counter) -> dict[str, list[int]]:
    """Of each run of words of a sentence: [how often the text went on, how often the sentence ended]."""
    out: dict[str, list[int]] = {}
    for (run, ended), n in counts.items():
        if ended is None or (run in _STOP if isinstance(run, str) else not _STOP.isdisjoint(run)):
            continue
        out.setdefault(run if isinstance(run, str) else " ".join(run), [0, 0])[ended] += n
    return out


def last_words(form: str, w: list[str] | None = None, order: int = ORDER) -> tuple[str, bool, list[str]]:
    """(what the end shows, whether an omission was marked, the last words); w are the words of the form."""
    form = form.rstrip()
    if not form:
        return "complete", False, []
    if form[-1] == "�" or "\ud800" <= form[-1] <= "\udfff":
        return "broken", True, []
    bare = _OMISSION.sub("", form).rstrip() if form[-1] in _OMITS else form
    marked = bare != form
    w = words(bare) if marked or w is None else w
    if not w or w[-1] in _END:
        return "complete", marked, []
    start = max((i for i, x in enumerate(w) if x in _STOP), default=-1) + 1
    tail = w[start:]
    if w[-1] not in _HANGING and any(tail.count(a) > tail.count(b) for a, b in _OPENERS.items()):
        return "bracket", marked, []
    return "open", marked, w[-order:]


_PARSED = "kind string, key bigint, n_chars int, shown string, marked boolean, closed boolean, runs array<string>, run string, went_on bigint, ended bigint"


def _parse(order: int):
    """Rows of two kinds of one pass: a probe of each text, and the counts of each batch."""
    names = [c.strip().split(" ")[0] for c in _PARSED.split(",")]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.string()), pa.string(), pa.int64(), pa.int64()]

    def made(n: int, given: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given[c] if isinstance(given.get(c), pa.Array) else pa.array(given[c], k) if c in given else pa.nulls(n, k) for c, k in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, row = points_of(batch.column(1))
            sizes = np.bincount(row, minlength=batch.num_rows)
            forms = array_of(*_formed(points, row, True), batch.column(1)).to_pylist()
            counts: Counter = Counter()
            found = []
            for form in forms:
                form = (form or "").rstrip()
                found.append(last_words(form, _tokens(form, order, counts), order))
            yield made(batch.num_rows, {"kind": ["probe"] * batch.num_rows, "key": batch.column(0), "n_chars": pa.array(sizes, pa.int32()), "shown": [f[0] for f in found], "marked": [f[1] for f in found], "closed": [bool(f[2]) and f[2][-1] in _CLOSERS for f in found], "runs": [[" ".join(f[2][-k:]) for k in range(1, len(f[2]) + 1)] for f in found]})
            total = _summed(counts)
            yield made(len(total), {"kind": ["count"] * len(total), "run": list(total), "went_on": [c[0] for c in total.values()], "ended": [c[1] for c in total.values()]})

    return run


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, longer): of asked words how often the corpus has words that go on after them.

    Rows (word, n, asked) come sorted, those of one first character in one partition. What is
    held is the open branch of the trie: the asked words that are prefixes of the current one.
    """
    branch: list[list] = []
    out: list[tuple[str, int]] = []

    def close() -> None:
        word, n = branch.pop()
        out.append((word, n))
        if branch:
            branch[-1][1] += n

    for batch in batches:
        for word, n, asked in zip(*(batch.column(k).to_pylist() for k in range(3))):
            while branch and not word.startswith(branch[-1][0]):
                close()
            longer_than = [b for b in branch[-2:] if b[0] != word]  # a word is no proper prefix of itself
            if longer_than:
                longer_than[-1][1] += n
            if asked:
                branch.append([word, 0])
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], names=["word", "longer"])
        out = []
    while branch:
        close()
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], names=["word", "longer"])


def prefixes(asked: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, longer) of asked(word), distinct words: how often vocabulary(word, n) has words of which it is a proper prefix."""
    rows = vocabulary.select("word", "n", F.lit(False).alias("asked")).unionByName(asked.select("word", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asked")))
    branches = rows.withColumn("first", F.substring("word", 1, 1)).repartition("first").sortWithinPartitions("word", F.desc("asked")).select("word", "n", "asked")
    return branches.mapInArrow(_walk, "word string, longer bigint")


def length_evidence(probes: DataFrame) -> DataFrame:
    """(n_chars, by_length): log of the texts of a length over those of a length around it, bounded."""
    lengths = probes.filter("n_chars > 0").groupBy("n_chars").agg(F.count("*").alias("n"))
    around = F.explode(F.sequence(F.col("n_chars") - AROUND, F.col("n_chars") + AROUND)).alias("at")
    near = lengths.select(around, "n", (F.col("n_chars")).alias("from")).groupBy("at").agg(F.sum(F.when(F.col("at") == F.col("from"), F.col("n"))).alias("here"), F.sum(F.when(F.col("at") != F.col("from"), F.col("n")).otherwise(0)).alias("beside"))
    ratio = F.log((F.col("here") + LENGTH_SMOOTHING) / (F.col("beside") / (2 * AROUND) + LENGTH_SMOOTHING))
    return near.filter("here IS NOT NULL").select(F.col("at").alias("n_chars"), F.greatest(F.lit(-LENGTH_WEIGHT), F.least(F.lit(LENGTH_WEIGHT), ratio)).alias("by_length"))


def find_cut(df: DataFrame, key: str, text: str, order: int = ORDER) -> DataFrame:
    """(key, is_cut, evidence, score) for every row of df with a unique, non-null bigint key.

    evidence names what decided: 'prefix', 'goes_on', 'length', 'omission', 'bracket',
    'broken'; for texts that are not cut it is 'ends' (a known end), 'unknown' or 'none' (a
    closing mark, or no text). score holds the log-odds of a cut of texts without a mark.
    """
    parsed = cut_lineage(df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(_parse(order), _PARSED))
    probes = parsed.filter("kind = 'probe'").select("key", "n_chars", "shown", "marked", "closed", "runs")
    trie = parsed.filter("kind = 'count'").groupBy("run").agg(F.sum("went_on").alias("went_on"), F.sum("ended").alias("ended"))
    asked = probes.filter("shown = 'open'").select("key", "closed", F.posexplode("runs").alias("k", "run")).filter(~(F.col("closed") & (F.col("k") == 0)))  # a closing bracket alone says nothing
    one_word = F.instr("run", " ") == 0
    longer = prefixes(asked.filter("k = 0 AND NOT closed").select(F.col("run").alias("word")).distinct(), trie.filter(one_word).select(F.col("run").alias("word"), (F.col("went_on") + F.col("ended")).alias("n")))
    known = asked.join(trie, "run").groupBy("key").agg(F.collect_list(F.struct("k", "ended", "went_on")).alias("nodes"))  # at most `order` of a text
    total = trie.filter(one_word).agg(((F.sum("ended") + 1) / (F.sum("ended") + F.sum("went_on") + 2)).alias("base"))  # one row
    last = probes.filter("shown = 'open' AND NOT closed").select("key", F.col("runs")[0].alias("word")).join(longer, "word").select("key", "longer")
    judged = probes.join(known, "key", "left").join(last, "key", "left").join(length_evidence(probes), "n_chars", "left").crossJoin(F.broadcast(total))
    return judged.select("key", *_verdict())


def _verdict() -> list[Column]:
    hanging = F.coalesce(F.col("runs")[0].isin(*_HANGING), F.lit(False))
    open_, closed = F.col("shown") == "open", F.col("closed")
    met = F.col("nodes").isNotNull() | hanging
    base = F.coalesce("base", F.lit(0.5))
    longer = F.coalesce(F.col("longer"), F.lit(0))
    nodes = F.array_sort(F.coalesce("nodes", F.array().cast("array<struct<k:int,ended:bigint,went_on:bigint>>")))
    # of the last word alone, the text goes on also where the word itself does
    on = lambda x: x.went_on + F.when(x.k == 0, longer).otherwise(0)
    share = F.aggregate(nodes, F.when(hanging, base / 2).otherwise(base), lambda p, x: (x.ended + BACKOFF * p) / (x.ended + on(x) + BACKOFF))
    goes_on = F.log((1 - share) / share)
    within = longer > F.coalesce(F.aggregate(nodes, F.lit(0).cast("bigint"), lambda n, x: n + F.when(x.k == 0, x.went_on).otherwise(0)), F.lit(0))
    part = longer > 0
    by_trie = F.when(met, goes_on).when(closed, F.lit(-20.0)).when(part, F.log1p(F.col("longer").cast("double"))).otherwise(F.lit(UNKNOWN) + F.when(F.col("marked"), OMISSION).otherwise(0.0))
    by_length = F.when(closed, F.lit(0.0)).otherwise(F.coalesce("by_length", F.lit(0.0)))
    score = F.when(open_, by_trie + by_length)
    cut = F.when(open_, score > 0).otherwise(F.col("shown").isin("bracket", "broken"))
    evidence = (
        F.when(~open_, F.when(cut, F.col("shown")).otherwise("none"))
        .when(cut & (by_trie <= 0), "length")
        .when(cut, F.when(part & within, "prefix").when(met, "goes_on").otherwise("omission"))
        .otherwise(F.when(met, "ends").otherwise("unknown"))
    )
    return [cut.alias("is_cut"), evidence.alias("evidence"), F.round(score, 6).alias("score")]
