"""Random-intercept models by REML, from sufficient statistics of each group.

One aggregation gives per group n, sums and cross products; the likelihood is a function of
the variance ratio alone and is searched on the driver over (p + 1)-square matrices. Groups
enter as sums by their size, so data of any length become one small matrix per distinct n.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_statistics(df: DataFrame, group: str, y: str, x: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(n, groups, sum of z z' over rows, sum of s s' over groups) by group size; z = (1, x, y), s = sum of z in a group."""
    z = [F.lit(1.0), *(F.col(c).cast("double") for c in x), F.col(y).cast("double")]
    names = [f"z{i}" for i in range(len(z))]
    rows = df.select(F.col(group).alias("g"), *(c.alias(n) for c, n in zip(z, names))).na.drop()
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    per = rows.groupBy("g").agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{i}") for i, a in enumerate(names)), *(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"c{i}_{j}") for i, j in pairs))
    by = per.groupBy("n").agg(F.count("*").alias("m"), *(F.sum(f"c{i}_{j}").alias(f"c{i}_{j}") for i, j in pairs), *(F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"q{i}_{j}") for i, j in pairs))
    out = []
    for r in by.orderBy("n").collect():  # a row per distinct group size
        c, q = np.zeros((len(z), len(z))), np.zeros((len(z), len(z)))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"c{i}_{j}"]
            q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        out.append((r.n, r.m, c, q))
    return out


def _profile(stats, ratio: float):
    """REML profile at variance ratio = between / within: (-2 log likelihood, coefficients, within variance, inverse of X'WX)."""
    p = stats[0][2].shape[0] - 1
    a = np.zeros((p + 1, p + 1))
    logs, n_all = 0.0, 0
    for n, m, c, q in stats:
        w = ratio / (1 + n * ratio)
        a += c - w * q
        logs += m * math.log1p(n * ratio)
        n_all += n * m
    xx, xy, yy = a[:p, :p], a[:p, p], a[p, p]
    inverse = np.linalg.pinv(xx)
    beta = inverse @ xy
    rss = max(yy - xy @ beta, 1e-300)
    s2 = rss / (n_all - p)
    sign, logdet = np.linalg.slogdet(xx)
    return logs + (n_all - p) * math.log(s2) + (logdet if sign > 0 else 0), beta, s2, inverse


def fit(df: DataFrame, group: str, y: str, x: list[str]) -> dict:
    """Coefficients with errors, variances and the intraclass correlation. Needs two groups and more rows than terms."""
    stats = group_statistics(df, group, y, x)
    low, high = math.log(1e-8), math.log(1e4)
    golden = (math.sqrt(5) - 1) / 2
    grid = np.linspace(low, high, 60)
    best = min(range(60), key=lambda k: _profile(stats, math.exp(grid[k]))[0])
    a, b = grid[max(0, best - 1)], grid[min(59, best + 1)]
    f = lambda t: _profile(stats, math.exp(t))[0]
    c, d = b - golden * (b - a), a + golden * (b - a)
    fc, fd = f(c), f(d)
    for _ in range(60):
        if fc < fd:
            b, d, fd = d, c, fc
            c = b - golden * (b - a)
            fc = f(c)
        else:
            a, c, fc = c, d, fd
            d = a + golden * (b - a)
            fd = f(d)
    ratio = math.exp((a + b) / 2)
    if f(low) <= f((a + b) / 2):
        ratio = 0.0
    _, beta, s2, inverse = _profile(stats, ratio)
    errors = np.sqrt(np.maximum(np.diag(inverse) * s2, 0))
    terms = []
    for name, est, se in zip(["intercept", *x], beta, errors):
        z = est / se if se > 0 else 0.0
        terms.append({"term": name, "estimate": float(est), "error": float(se), "z": float(z), "p": math.erfc(abs(z) / math.sqrt(2)), "low": float(est - 1.959964 * se), "high": float(est + 1.959964 * se)})
    between = ratio * s2
    sizes = [(n, m) for n, m, _, _ in stats]
    return {"terms": terms, "within": float(s2), "between": float(between), "icc": float(between / (between + s2)), "groups": sum(m for _, m in sizes), "rows": sum(n * m for n, m in sizes), "smallest": sizes[0][0], "largest": sizes[-1][0]}


def pseudo_r2(null: dict, model: dict) -> float:
    return 1 - model["within"] / null["within"]
