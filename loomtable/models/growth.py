"""Simulated panels with known growth, and the models that recover it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtable.models import mixed

#: True slopes of the simulation.
LINEAR, QUADRATIC, PIECEWISE, KNOT = 3.5, (6.0, -0.25), (5.0, 1.5), 3


def _normal(seed: int, *keys: str):
    """A standard normal number from hashes of the keys: the same on every partitioning."""
    unit = lambda k: (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *keys), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    return F.sqrt(-2 * F.ln(unit(1))) * F.cos(2 * 3.141592653589793 * unit(2))


def panel(spark: SparkSession, students: int = 600, schools: int = 90, times: int = 6, seed: int = 7) -> DataFrame:
    """(student_id, school_id, time, time_sq, time_pre, time_post, y_linear, y_quadratic, y_piecewise)."""
    rows = spark.range(students).select(F.col("id").alias("student_id"), (F.col("id") % schools).alias("school_id"))
    rows = rows.withColumn("time", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("time", F.col("time").cast("double"))
    rows = rows.withColumn("time_sq", F.col("time") ** 2).withColumn("time_pre", F.least("time", F.lit(float(KNOT)))).withColumn("time_post", F.greatest(F.col("time") - KNOT, F.lit(0.0)))
    school, noise = 3 * _normal(seed, "school_id"), lambda k: 2 * _normal(seed + k, "student_id", "time")
    t = F.col("time")
    return rows.select(
        "*",
        (50 + LINEAR * t + school + noise(1)).alias("y_linear"),
        (50 + QUADRATIC[0] * t + QUADRATIC[1] * F.col("time_sq") + school + noise(2)).alias("y_quadratic"),
        (50 + PIECEWISE[0] * F.col("time_pre") + PIECEWISE[1] * F.col("time_post") + school + noise(3)).alias("y_piecewise"),
    )


MODELS = {"null": ("y_linear", []), "linear": ("y_linear", ["time"]), "quadratic": ("y_quadratic", ["time", "time_sq"]), "piecewise": ("y_piecewise", ["time_pre", "time_post"])}


def fit_all(df: DataFrame) -> dict[str, dict]:
    return {name: mixed.fit(df, "school_id", y, x) for name, (y, x) in MODELS.items()}
