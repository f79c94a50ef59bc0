"""Factor models with a structural part, by maximum likelihood on the covariance matrix.

Spark computes the covariances in one aggregation; what is optimised on the driver is a
function of a matrix as large as the number of indicators.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.models.irt import chi2_tail


def covariances(df: DataFrame, columns: list[str]) -> tuple[np.ndarray, int]:
    rows = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).na.drop()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    r = rows.agg(F.count("*").alias("n"), *(F.covar_samp(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    s = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        s[i, j] = s[j, i] = r[f"c{i}_{j}"] or 0.0
    return s, r.n


def implied(v: np.ndarray, factors: list[list[int]], paths: list[tuple[int, int]], size: int) -> np.ndarray:
    """Covariances of a model: loadings (first of each factor 1), paths between factors, residual and factor variances."""
    k = 0
    lam = np.zeros((size, len(factors)))
    for f, members in enumerate(factors):
        lam[members[0], f] = 1
        for m in members[1:]:
            lam[m, f] = v[k]
            k += 1
    beta = np.zeros((len(factors), len(factors)))
    for to, at in paths:
        beta[to, at] = v[k]
        k += 1
    psi = np.diag(np.exp(v[k : k + len(factors)]))
    k += len(factors)
    inverse = np.linalg.inv(np.eye(len(factors)) - beta)
    return lam @ inverse @ psi @ inverse.T @ lam.T + np.diag(np.exp(v[k : k + size]))


def discrepancy(v, s, factors, paths) -> float:
    m = implied(v, factors, paths, len(s))
    sign, logdet = np.linalg.slogdet(m)
    if sign <= 0 or not np.isfinite(logdet):
        return 1e10
    return float(logdet + np.trace(s @ np.linalg.inv(m)) - np.linalg.slogdet(s)[1] - len(s))


def fit(s: np.ndarray, n: int, factors: list[list[int]], paths: list[tuple[int, int]], steps: int = 400) -> dict:
    """BFGS on numerical gradients; chi-square and the usual indices of fit."""
    size = len(s)
    free = sum(len(f) - 1 for f in factors) + len(paths) + len(factors) + size
    v = np.concatenate([np.ones(sum(len(f) - 1 for f in factors)), np.full(len(paths), 0.1), np.log([max(s[f[0], f[0]] * 0.5, 1e-3) for f in factors]), np.log(np.maximum(np.diag(s) * 0.5, 1e-3))])

    def gradient(x):
        g = np.empty_like(x)
        for i in range(len(x)):
            h = 1e-6 * max(1, abs(x[i]))
            e = np.zeros_like(x)
            e[i] = h
            g[i] = (discrepancy(x + e, s, factors, paths) - discrepancy(x - e, s, factors, paths)) / (2 * h)
        return g

    value, g, h = discrepancy(v, s, factors, paths), gradient(v), np.eye(len(v))
    for _ in range(steps):
        direction = -h @ g
        if direction @ g > 0:
            h, direction = np.eye(len(v)), -g
        t = 1.0
        while t > 1e-12 and discrepancy(v + t * direction, s, factors, paths) > value + 1e-4 * t * (direction @ g):
            t /= 2
        new = v + t * direction
        g_new = gradient(new)
        d, y = new - v, g_new - g
        if d @ y > 1e-12:
            r = 1 / (d @ y)
            e = np.eye(len(v)) - r * np.outer(d, y)
            h = e @ h @ e.T + r * np.outer(d, d)
        moved, v, g = abs(value - discrepancy(new, s, factors, paths)), new, g_new
        value = discrepancy(v, s, factors, paths)
        if moved < 1e-11 and np.abs(g).max() < 1e-4:
            break
    df = size * (size + 1) // 2 - free
    chi2 = max(0.0, (n - 1) * value)
    base = max(0.0, (n - 1) * float(np.log(np.diag(s)).sum() - np.linalg.slogdet(s)[1]))
    base_df = size * (size - 1) // 2
    m = implied(v, factors, paths, size)
    scale = np.sqrt(np.outer(np.diag(s), np.diag(s)))
    residual = ((s - m) / scale)[np.tril_indices(size)]
    worse, base_worse = max(chi2 - df, 0), max(base - base_df, chi2 - df, 1e-12)
    return {
        "parameters": v, "chi2": chi2, "df": df, "p": chi2_tail(chi2, df) if df > 0 else 1.0, "cfi": 1 - worse / base_worse,
        "tli": ((base / base_df - chi2 / df) / max(base / base_df - 1, 1e-12)) if df > 0 else 1.0, "rmsea": float(np.sqrt(worse / (df * (n - 1)))) if df > 0 else 0.0, "srmr": float(np.sqrt((residual**2).mean())),
    }
