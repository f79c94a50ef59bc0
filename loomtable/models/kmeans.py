"""Lloyd's k-means: one pass over the rows per iteration, k sums of vectors as its only result."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.session import cut_lineage


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest center; of equals the lowest index."""
    score = (centers**2).sum(1) - 2 * x @ centers.T  # |x|^2 is the same for all centers
    at = score.argmin(1)
    return at, ((x - centers[at]) ** 2).sum(1)


def initial_centers(df: DataFrame, key: str, vector: str, k: int, seed: int = 42) -> np.ndarray:
    """Vectors of k rows chosen by a seeded hash of their keys; a choice that does not depend on partitions."""
    rows = df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k).select(vector).collect()
    return np.array([r[0] for r in rows], float)


def fit(df: DataFrame, vector: str, centers: np.ndarray, iterations: int = 100) -> tuple[np.ndarray, float]:
    """(centers, within sum of squares); an empty cluster keeps its center."""
    k, d = centers.shape
    wss = 0.0
    df = cut_lineage(df.select(vector)) if iterations > 1 else df  # read in every iteration
    for _ in range(iterations):

        def step(batches: Iterator[pa.RecordBatch], c: np.ndarray = centers) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, d + 2))
            for batch in batches:
                x = _matrix(batch.column(0))
                if len(x):
                    at, dist = nearest(x, c)
                    np.add.at(total, at, np.column_stack([x, np.ones(len(x)), dist]))
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])

        parts = df.select(vector).mapInArrow(step, "s array<double>").collect()  # k sums per partition
        total = np.sum([p.s for p in parts], 0).reshape(k, d + 2) if parts else np.zeros((k, d + 2))
        n = total[:, d]
        new = np.where(n[:, None] > 0, total[:, :d] / np.maximum(n, 1)[:, None], centers)
        wss = float(total[:, d + 1].sum())
        if np.allclose(new, centers, rtol=0, atol=1e-12):
            break
        centers = new
    return centers, wss


def assign(df: DataFrame, key: str, vector: str, centers: np.ndarray) -> DataFrame:
    """(key, cluster) of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = nearest(_matrix(batch.column(1)), centers)[0] if batch.num_rows else np.array([], int)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32())], names=[key, "cluster"])

    return df.select(key, vector).mapInArrow(run, f"`{key}` {kind}, cluster int")


def select_k(df: DataFrame, key: str, vector: str, choices: range, seed: int = 42, iterations: int = 100) -> list[tuple[int, float, float]]:
    """(k, within sum of squares, criterion wss + k ln(n) d) of each k."""
    df = cut_lineage(df.select(key, vector))
    n = df.count()
    out = []
    for k in choices:
        start = initial_centers(df, key, vector, k, seed)
        centers, wss = fit(df, vector, start, iterations)
        out.append((k, wss, wss + k * math.log(max(n, 1)) * centers.shape[1]))
    return out


def sample_rows(seed: int, n: int, k: int) -> list[int]:
    """Row numbers drawn as the standard library's sampler draws them; for parity with small runs."""
    return random.Random(seed).sample(range(n), k)
