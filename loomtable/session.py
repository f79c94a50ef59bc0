"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("loomtable")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def named_folder(spark: SparkSession) -> str | None:
    """The shared folder that the session, or else its context, names for checkpoints."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """checkpoint() into the shared folder named by spark.checkpoint.dir.

    The copy on shared storage outlives any executor, so a lost one costs a re-read, not a
    re-run. A session that names no folder gets a temporary one only if it runs in this very
    process (master local[...], as in tests); on a cluster each node would have its own, so
    that raises.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = named_folder(df.sparkSession)
        if not named and not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomtable-checkpoint-"))
    return df.checkpoint(eager)


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in every Python worker of the session, once per context.

    Workers that find it on their path anyway are not disturbed.
    """
    context = spark.sparkContext
    if getattr(context, "_loomtable_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="loomtable-package-")) / "loomtable.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._loomtable_shipped = True
