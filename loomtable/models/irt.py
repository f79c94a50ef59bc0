"""Item response models by joint maximum likelihood, and differential item functioning.

Persons with the same answers share one ability, so what is fitted are the distinct answer
patterns with their counts: one aggregation, at most 2 ** items rows however many persons.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.session import cut_lineage

BOUND, LOG_A = 5.0, 2.0


MOST_PATTERNS = 1_000_000


def patterns(df: DataFrame, items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct answer patterns, their counts); persons with a missing answer are left out.

    The patterns are counted before they are sent to the driver; more than MOST_PATTERNS raise.
    """
    found = cut_lineage(df.select(*items).na.drop().groupBy(*items).agg(F.count("*").alias("n")))
    if (n := found.count()) > MOST_PATTERNS:
        raise ValueError(f"{n} answer patterns are more than the driver fits")
    rows = found.orderBy(*items).collect()
    return np.array([[r[c] for c in items] for r in rows], float).reshape(-1, len(items)), np.array([r.n for r in rows], float)


def probability(theta: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a * (theta[:, None] - b), -35, 35)))


def log_likelihood(u: np.ndarray, n: np.ndarray, theta: np.ndarray, a: np.ndarray, b: np.ndarray) -> float:
    p = np.clip(probability(theta, a, b), 1e-12, 1 - 1e-12)
    return float((n[:, None] * (u * np.log(p) + (1 - u) * np.log(1 - p))).sum())


def fit(u: np.ndarray, n: np.ndarray, two_parameters: bool = True, outer: int = 40, ridge: float = 0.01) -> dict:
    """Abilities per pattern, discriminations and difficulties; abilities are standardised in each round."""
    items = u.shape[1]
    a, share = np.ones(items), np.clip((n[:, None] * u).sum(0) / n.sum(), 0.01, 0.99)
    b = -np.log(share / (1 - share))
    score = u.mean(1)
    theta = np.clip(np.log((score + 0.05) / (1.05 - score)), -BOUND, BOUND)
    last = -math.inf
    for _ in range(outer):
        for _ in range(8):  # Newton steps of each ability; they do not depend on each other
            p = probability(theta, a, b)
            grad, hess = (a * (u - p)).sum(1), (a**2 * p * (1 - p)).sum(1) + 1e-6
            theta = np.clip(theta + np.clip(grad / hess, -1, 1), -BOUND, BOUND)
        mean = (n * theta).sum() / n.sum()
        sd = math.sqrt(max((n * (theta - mean) ** 2).sum() / n.sum(), 1e-12))
        theta = (theta - mean) / sd
        b = np.clip((b - mean) / sd, -BOUND, BOUND)
        a = np.clip(a * sd, math.exp(-LOG_A), math.exp(LOG_A)) if two_parameters else a
        for _ in range(8):  # and of each item, in log a and b
            p = probability(theta, a, b)
            w, r = n[:, None] * p * (1 - p), n[:, None] * (u - p)
            d = theta[:, None] - b
            gb = -(a * r).sum(0)
            hb = (a**2 * w).sum(0) + 1e-6
            if two_parameters:
                gl = (a * d * r).sum(0) - 2 * ridge * np.log(a)
                hl = (a**2 * d**2 * w).sum(0) + 2 * ridge + 1e-6
                cross = -(a**2 * d * w).sum(0)
                det = hl * hb - cross**2
                safe = det > 1e-9 * hl * hb
                dl = np.where(safe, (hb * gl - cross * gb) / np.where(safe, det, 1), gl / hl)
                db = np.where(safe, (hl * gb - cross * gl) / np.where(safe, det, 1), gb / hb)
                a = np.exp(np.clip(np.log(a) + np.clip(dl, -0.5, 0.5), -LOG_A, LOG_A))
            else:
                db = gb / hb
            b = np.clip(b + np.clip(db, -1, 1), -BOUND, BOUND)
        now = log_likelihood(u, n, theta, a, b)
        if abs(now - last) < 1e-4:
            break
        last = now
    return {"theta": theta, "a": a, "b": b, "log_likelihood": now}


def information(theta: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Test information at each ability."""
    p = probability(theta, a, b)
    return (a**2 * p * (1 - p)).sum(1)


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of the chi-square distribution, by the incomplete gamma function."""
    if x <= 0:
        return 1.0
    s, z = df / 2, x / 2
    if z < s + 1:
        term = total = 1 / s
        k = s
        while abs(term) > 1e-16 * abs(total):
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1 - total * math.exp(-z + s * math.log(z) - math.lgamma(s)))
    b, c, d = z + 1 - s, 1e300, 1 / (z + 1 - s)
    h = d
    for i in range(1, 500):
        an = -i * (i - s)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-z + s * math.log(z) - math.lgamma(s)) * h


def mantel_haenszel(df: DataFrame, item: str, correct: str, focal: str, stratum: str) -> DataFrame:
    """(item, odds_ratio, chi2, delta, class): focal over reference, over strata of at least two persons.

    One aggregation to 2 x 2 tables by item and stratum, one to sums; null where a
    denominator is not positive.
    """
    yes, f = F.col(correct) == 1, F.col(focal)
    cells = df.groupBy(F.col(item).alias("item"), F.col(stratum).alias("s")).agg(
        F.count_if(f & yes).alias("a"), F.count_if(f & ~yes).alias("b"), F.count_if(~f & yes).alias("c"), F.count_if(~f & ~yes).alias("d")
    )
    t = F.col("a") + F.col("b") + F.col("c") + F.col("d")
    cells = cells.withColumn("t", t.cast("double")).filter("t >= 2")
    m1, m0, nf, nr = F.expr("a + c"), F.expr("b + d"), F.expr("a + b"), F.expr("c + d")
    sums = cells.groupBy("item").agg(
        F.sum(F.expr("a * d / t")).alias("num"), F.sum(F.expr("b * c / t")).alias("den"), F.sum("a").cast("double").alias("seen"), F.sum(nf * m1 / F.col("t")).alias("expected"), F.sum(nf * nr * m1 * m0 / (F.col("t") * F.col("t") * (F.col("t") - 1))).alias("var")
    )
    ratio = F.when((F.col("num") > 0) & (F.col("den") > 0), F.col("num") / F.col("den"))
    gap = F.greatest(F.abs(F.col("seen") - F.col("expected")) - 0.5, F.lit(0.0))
    out = sums.select("item", F.round(ratio, 6).alias("odds_ratio"), F.round(F.when(F.col("var") > 0, gap * gap / F.col("var")), 6).alias("chi2"), F.round(-2.35 * F.ln(ratio), 6).alias("delta"))
    size = F.abs("delta")
    return out.withColumn("class", F.when(size.isNull(), "NA").when(size < 1.0, "A").when(size < 1.5, "B").otherwise("C"))
