"""A mix of sources to target weights, in tokens.

Budgets run down a tree of domain, language and source. Each node's share of its parent's
budget is that of the targets under it. A source holds at most max_repeats times its tokens;
what it cannot take goes to its siblings, by their targets, and only what these cannot take
either goes up to the next level. A source with a budget of k times its tokens and a rest
gets k whole epochs, and of one more epoch, shuffled by a seeded hash, the prefix whose
tokens come nearest the rest.

Scale: the tree has a node per source and is solved on the driver from one row per source,
of at most MOST_SOURCES, which are counted before anything is sent to it or broadcast.
The prefix is cut in steps, so that no source is ever sorted as a whole: documents are
summed by source and hash range, ranges by span of RANGES_PER_SPAN; running sums go over the
spans of a source and over the ranges of a span; whole ranges are in or out, and only the
documents of the range on which the cut falls are put in order. Ranges hold few documents
however large the source, since their number grows with it.

Null and empty texts hold no tokens and are not in the mix. Sources without documents reach
a share of 0, sources without a target are left out. Repeated documents count as documents.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DOCS_PER_RANGE, RANGES_PER_SPAN = 2000, 1024
MOST_SOURCES = 100_000


def domain_of(source: str) -> str:
    """Default domain of a source: its name up to the first underscore."""
    return source.split("_")[0]


def shared_out(total: float, targets: dict[str, float], capacity: dict[str, float]) -> dict[str, float]:
    """total by targets, what some cannot hold going to the others by their targets (water-filling)."""
    given = dict.fromkeys(targets, 0.0)
    open_ = {k for k in targets if targets[k] > 0}
    left = total
    while open_ and left > 1e-9 * max(total, 1):
        weight = sum(targets[k] for k in open_)
        full = {k for k in open_ if given[k] + left * targets[k] / weight >= capacity[k]}
        if not full:
            for k in open_:
                given[k] += left * targets[k] / weight
            break
        for k in full:
            left -= capacity[k] - given[k]
            given[k] = capacity[k]
        open_ -= full
    return given


def budgets(total: float, leaves: dict[str, tuple[tuple[str, ...], float, float]]) -> dict[str, float]:
    """Tokens of each leaf: leaves has its path from the root (itself not in it), target and capacity.

    A shortage is first taken up by siblings under the same parent. A parent whose children
    are all full is itself full and hands what is left to its own siblings.
    """
    children: dict[tuple[str, ...], set[tuple[str, ...]]] = defaultdict(set)
    target: dict[tuple[str, ...], float] = defaultdict(float)
    capacity: dict[tuple[str, ...], float] = defaultdict(float)
    for name, (path, weight, most) in leaves.items():
        full = (*path, name)
        for k in range(len(full) + 1):
            target[full[:k]] += weight
            capacity[full[:k]] += most
            if k:
                children[full[: k - 1]].add(full[:k])
    out: dict[str, float] = {}

    def down(node: tuple[str, ...], amount: float) -> None:
        kids = sorted(children[node])
        if not kids:
            out[node[-1]] = min(amount, capacity[node])
            return
        for kid, part in shared_out(amount, {k: target[k] for k in kids}, {k: capacity[k] for k in kids}).items():
            down(kid, part)

    down((), min(total, capacity[()]))
    return out


def plan(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, domains: dict[str, str] | None = None, languages: dict[str, str] | None = None):
    """Rows (source, target_share, max_repeats, tokens, n_docs, budget, epochs, rest) of every target.

    docs(source, lang, n_tokens). total_tokens is by default all tokens of the listed
    sources, each document once. A source's language is the one most of its documents have.
    """
    if targets.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources are listed")
    listed = {r.source: (r.target_share or 0.0, r.max_repeats or 0) for r in targets.select("source", "target_share", "max_repeats").collect()}
    known = docs.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi")
    spoken = known.groupBy("source", "lang").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    named = F.when(F.col("lang") != "", F.struct("n", "lang"))
    rows = spoken.groupBy("source").agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.max(named).alias("most")).collect()  # a row per listed source
    tokens, count = defaultdict(int, {r.source: r.t for r in rows}), defaultdict(int, {r.source: r.n for r in rows})
    most = {r.source: r.most.lang for r in rows if r.most}
    language = lambda s: (languages or {}).get(s) or most.get(s, "und")
    domain = lambda s: (domains or {}).get(s) or domain_of(s)
    leaves = {s: ((domain(s), language(s)), share, float(tokens[s] * repeats)) for s, (share, repeats) in listed.items()}
    given = budgets(float(total_tokens if total_tokens is not None else sum(tokens[s] for s in listed)), leaves)
    out = []
    for s, (share, repeats) in sorted(listed.items()):
        size = tokens[s]
        epochs = min(repeats, int(given[s] // size)) if size else 0
        rest = given[s] - epochs * size if size and epochs < repeats else 0.0
        out.append((s, float(share), int(repeats), int(size), int(count[s]), float(given[s]), epochs, float(rest)))
    return out


_PLAN = "source string, target_share double, max_repeats int, tokens bigint, n_docs bigint, budget double, epochs int, rest double"


def mixed(docs: DataFrame, targets: DataFrame, seed: int = 0, **options) -> tuple[DataFrame, DataFrame]:
    """(mix, shares): mix(doc_id, source, n_tokens, copies) of the documents taken; shares per source.

    docs(doc_id, source, lang, n_tokens). doc_id orders documents of equal hash.
    """
    spark = docs.sparkSession
    docs = docs.filter("n_tokens > 0")
    rows = plan(docs, targets, **options)
    ranges = max(1, math.ceil(max((r[4] for r in rows), default=1) / DOCS_PER_RANGE))
    plan_df = F.broadcast(spark.createDataFrame(rows, _PLAN))  # a row per listed source, counted in plan()
    taken = docs.join(plan_df.select("source", "epochs", "rest"), "source").withColumn("place", F.xxhash64(F.lit(seed), F.col("epochs"), F.col("doc_id")))
    taken = taken.withColumn("range", F.pmod(F.shiftrightunsigned("place", 33), F.lit(ranges)))
    sums = taken.groupBy("source", "range").agg(F.sum("n_tokens").alias("range_tokens"))
    sums = sums.withColumn("span", F.floor(F.col("range") / RANGES_PER_SPAN))
    spans = sums.groupBy("source", "span").agg(F.sum("range_tokens").alias("span_tokens"))
    spans = spans.withColumn("earlier", F.sum("span_tokens").over(Window.partitionBy("source").orderBy("span")) - F.col("span_tokens"))
    upto = Window.partitionBy("source", "span").orderBy("range")
    sums = sums.join(spans.select("source", "span", "earlier"), ["source", "span"]).withColumn("before", F.col("earlier") + F.sum("range_tokens").over(upto) - F.col("range_tokens")).drop("span", "earlier")
    placed = taken.join(sums, ["source", "range"])
    inner = Window.partitionBy("source", "range").orderBy("place", "doc_id")
    cut = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("range_tokens") > F.col("rest"))
    edge = placed.filter(cut).withColumn("first", F.col("before") + F.sum("n_tokens").over(inner) - F.col("n_tokens"))
    edge = edge.withColumn("in_prefix", F.col("first") + F.col("n_tokens") / 2 <= F.col("rest"))
    whole = placed.filter(~cut).withColumn("in_prefix", F.col("before") + F.col("range_tokens") <= F.col("rest"))
    columns = ["doc_id", "source", "n_tokens", (F.col("epochs") + F.col("in_prefix").cast("int")).alias("copies")]
    mix = whole.select(*columns).unionByName(edge.select(*columns)).filter("copies > 0")
    reached = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mix_tokens"), F.count("*").alias("mix_docs"), F.max("copies").alias("most_copies"))
    shares = plan_df.join(reached, "source", "left").na.fill(0, ["mix_tokens", "mix_docs", "most_copies"])
    total = shares.agg(F.sum("mix_tokens").alias("all_tokens"))
    shares = shares.crossJoin(F.broadcast(total)).select(
        "source",
        "target_share",
        F.round(F.when(F.col("all_tokens") > 0, F.col("mix_tokens") / F.col("all_tokens")).otherwise(0.0), 6).alias("reached_share"),
        "max_repeats",
        "most_copies",
        F.col("tokens").alias("source_tokens"),
        F.round("budget", 3).alias("budget"),
        "mix_tokens",
        "mix_docs",
    )
    return mix, shares
