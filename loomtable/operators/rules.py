"""Classification, scoring and gates by rule tables.

Rules are data: (label, pattern) or (label, weight, terms) lists given by the caller. They are
compiled into one column expression, so a row is classified where it is read; there is no
join of rows with rules, and no Python per row. Patterns are case-insensitive regular
expressions that Java and RE2 share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def first_match(rules: list[tuple[str, Column]], default: Column | str | None = None) -> Column:
    """The label of the first rule whose condition holds."""
    out = None
    for label, test in rules:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(F.lit(default) if isinstance(default, str) or default is None else default)


def first_pattern(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    return first_match([(label, matches(text, pattern)) for label, pattern in rules], default)


def cascade(sources: list[tuple[Column, list[tuple[str, str]]]], default: str | None = None) -> Column:
    """The first label that any of the sources gives, in order of trust."""
    return F.coalesce(*(first_pattern(text, rules) for text, rules in sources), F.lit(default))


def all_matches(text: Column, rules: list[tuple[str, str]], fallback: str | None = None) -> Column:
    """Labels of every rule that holds, each once, in order of the rules; a fallback if there is none."""
    hits = F.array_distinct(F.array_compact(F.array(*(F.when(matches(text, pattern), label) for label, pattern in rules))))
    return hits if fallback is None else F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(fallback)))


def voted(given: Column, text: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(label, outcome): one vote for the given label and one per pattern that holds; of equals the earliest.

    outcome: 'kept' without a pattern, 'confirmed', 'reclassified', or 'ambiguous' where two labels tie.
    """
    labels = list(dict.fromkeys(label for label, _ in rules))
    count = {x: reduce(lambda a, b: a + b, (matches(text, p).cast("int") for label, p in rules if label == x), F.lit(0)) for x in labels}
    none = reduce(lambda a, b: a & b, (n == 0 for n in count.values()), F.lit(True))
    total = {x: n + (given == x).cast("int") for x, n in count.items()}
    most = F.greatest(*total.values(), F.lit(0)) if len(total) > 1 else next(iter(total.values()))
    winner = first_match([(x, total[x] == most) for x in labels])
    ties = reduce(lambda a, b: a + b, ((n == most).cast("int") for n in total.values()), F.lit(0))
    outcome = F.when(none, "kept").when(ties > 1, "ambiguous").when(winner == given, "confirmed").otherwise("reclassified")
    return F.struct(F.when(none | (ties > 1), given).otherwise(winner).alias("label"), outcome.alias("outcome"))


def additive(parts: list[tuple[Column, float]], low: float | None = None, high: float | None = None) -> Column:
    """Sum of the weights of the conditions that hold, clamped if bounds are given."""
    total = reduce(lambda a, b: a + b, (F.when(test, w).otherwise(0) for test, w in parts), F.lit(0))
    if low is not None:
        total = F.greatest(total, F.lit(low))
    return F.least(total, F.lit(high)) if high is not None else total


def gated(axes: list[Column], required: int = 2) -> Column:
    """Sum of axis scores, zero where one of the first `required` axes is zero."""
    dead = reduce(lambda a, b: a | b, (a == 0 for a in axes[:required]))
    return F.when(dead, 0).otherwise(reduce(lambda a, b: a + b, axes))


def keyword_hits(text: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.contains(text, F.lit(t)), F.lit(False)).cast("int") for t in terms), F.lit(0))


def lookup(column: Column, weights: dict[str, int], default: int = 0) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, column), F.lit(default))


def dimension_scores(base: int, lookups: list[tuple[Column, dict[str, int]]], text: Column, dims: dict[str, dict]) -> Column:
    """array(struct(dim, score, evidence)): base, lookups and keywords per dimension, clamped to 0..100.

    dims: name -> {'lookups': [weights of each lookup column], 'plus': terms, 'minus': terms, 'step': n}.
    """
    out = []
    for name, d in dims.items():
        plus, minus = keyword_hits(text, d.get("plus", [])), keyword_hits(text, d.get("minus", []))
        fixed = reduce(lambda a, b: a + b, (lookup(c, w) for c, w in zip(lookups, d["lookups"])), F.lit(base))
        score = F.greatest(F.least(fixed + d["step"] * (plus - minus), F.lit(100)), F.lit(0))
        out.append(F.struct(F.lit(name).alias("dim"), score.alias("score"), (plus + minus + len(lookups)).alias("evidence")))
    return F.array(*out)


def ranked(scores: dict[str, Column]) -> Column:
    """Names by score, best first; of equals in the order given."""
    pairs = F.array(*(F.struct((-s).alias("k"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, s) in enumerate(scores.items())))
    return F.transform(F.array_sort(pairs), lambda p: p.n)


def issues(checks: list[tuple[str, str, str, Column]]) -> Column:
    """array(struct(check, severity, field)) of the checks whose condition holds."""
    return F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), F.lit(f).alias("field"))) for n, s, f, test in checks)))


def status_of(found: Column) -> Column:
    """'rejected' with a critical issue, 'flagged' with any, else 'approved'."""
    return F.when(F.exists(found, lambda x: x.severity == "critical"), "rejected").when(F.size(found) > 0, "flagged").otherwise("approved")


def first_reason(checks: list[tuple[str, Column]], ok: str = "ok") -> Column:
    return first_match([(r, F.coalesce(test, F.lit(False))) for r, test in checks], ok)


def masked(text: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(text, changed): pattern replacements in order, and the names of those that changed anything."""
    out, steps = text, []
    for pattern, to in rules:
        new = F.regexp_replace(out, pattern, to)
        steps.append(F.when(new != out, F.lit(to)))
        out = new
    return F.struct(out.alias("text"), F.array_compact(F.array(*steps)).alias("changed"))


def masked_with_log(text: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(text, log): pattern replacements in order, and array(struct(was, to)) of every single change.

    The log is in the order in which `undone` takes it: the last rule first, and of a rule
    its matches from the start of the text on.
    """
    out, log = text, []
    change = lambda to: lambda was: F.struct(was.alias("was"), F.lit(to).alias("to"))
    for pattern, to in rules:
        log.insert(0, F.transform(F.regexp_extract_all(out, F.lit(f"({pattern})"), F.lit(1)), change(to)))
        out = F.regexp_replace(out, pattern, to)
    return F.struct(out.alias("text"), F.flatten(F.array(*log)).alias("log"))


def undone(text: Column, log: Column) -> Column:
    """The text before the changes of a log of masked_with_log; the first placeholder of its kind is that of each change.

    Whole as long as the text as it was had none of the placeholders.
    """

    def back(t: Column, c: Column) -> Column:
        at = F.position(c.to, t)
        return F.when(at > 0, F.concat(F.substring(t, F.lit(1), at - 1), c.was, F.substring(t, at + F.length(c.to), F.length(t)))).otherwise(t)

    return F.aggregate(log, text, back)


def threshold_rule(scores: Column, pattern: dict[str, str]) -> Column:
    """Whether a map of scores meets comparisons such as {'a': '>65', 'b': '<50'}; a missing score fails."""
    tests = []
    for name, rule in pattern.items():
        value, bound = F.try_element_at(scores, F.lit(name)), float(rule.lstrip("<>="))
        sign = rule[: len(rule) - len(rule.lstrip("<>="))]
        tests.append({">": value > bound, ">=": value >= bound, "<": value < bound, "<=": value <= bound, "=": value == bound}[sign])
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
