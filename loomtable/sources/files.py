"""Files in and out: JSON lines, pages, Markdown, JSON documents, CSV.

Readers are lazy scans that split large files; a malformed line costs that line only.
Writers leave the commit to Spark, so that a job that is run again replaces its output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomtable.operators.extract import decode_page


def json_lines(spark: SparkSession, path: str, schema: str, numbers: bool = False) -> DataFrame:
    """Records of JSON lines with `problem`: null, or the first 80 characters of a line that is no record. Blank lines go.

    With numbers, also `line`: the number of the line in its file, from 1. A file is then read
    as one value by one task, so that is for files of a size that a task can hold.
    """
    if numbers:
        whole_file = spark.read.text(path, wholetext=True)
        lines = whole_file.select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value")).withColumn("line", F.col("line") + 1).filter(F.trim("value") != "")
    else:
        lines = spark.read.text(path).filter(F.trim("value") != "")
    whole = StructType([*StructType.fromDDL(schema).fields, StructField("_broken", StringType())])
    read = lines.withColumn("r", F.from_json("value", whole, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}))
    names = StructType.fromDDL(schema).names
    bad = F.col("r").isNull() | F.col("r._broken").isNotNull()
    at = [F.col("line")] if numbers else []
    return read.select(*at, *(F.when(~bad, F.col(f"r.{n}")).alias(n) for n in names), F.when(bad, F.substring("value", 1, 80)).alias("problem"))


def pages(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(entity, slug, html) of stored pages folder/entity/slug.html in any of the usual encodings."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").load(folder)
    decode = F.udf(decode_page, StringType(), useArrow=True)
    named = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+\.html$", 1).alias("entity"), F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("slug"), decode("content").alias("html"))
    return named.filter(F.col("entity").startswith(prefix))


def documents(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(name, text) of whole text files."""
    read = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return read.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("name"), F.col("value").alias("text"))


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def progress_files(spark: SparkSession, folder: str) -> DataFrame:
    """(task, state): JSON files keyed by their task_id, else by their name; of equals the larger name holds."""
    read = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json").schema("task_id string, status string, count bigint").json(folder)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.json$", 1)
    keyed = read.select(F.coalesce("task_id", stem).alias("task"), stem.alias("stem"), "status", "count")
    return keyed.groupBy("task").agg(F.max_by("status", "stem").alias("status"), F.max_by("count", "stem").alias("count"))


def sections(spark: SparkSession, folder: str, order: list[str]) -> DataFrame:
    """(pos, name, body): the <section> of the named files, in the order given."""
    wanted = spark.createDataFrame([(k, n) for k, n in enumerate(order)], "pos int, name string")
    found = documents(spark, folder, "*.html").withColumn("body", F.regexp_extract("text", r"(?is)<section[^>]*>(.*?)</section>", 1))
    return wanted.join(found, "name").select("pos", "name", "body")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def write_script(df: DataFrame, path: str, variable: str, mode: str = "overwrite") -> None:
    """Each row as a JavaScript assignment to window.<variable>[n]; for small result frames."""
    df.select(F.concat(F.lit(f"window.{variable} = window.{variable} || []; window.{variable}.push("), F.to_json(F.struct(*df.columns)), F.lit(");")).alias("value")).write.mode(mode).text(path)


def write_cube(sections: DataFrame, path: str, variable: str, most_rows: int = 1_000_000, mode: str = "overwrite", dry_run: bool = False) -> DataFrame:
    """sections(section, k1, k2, text, number) as one script `window.<variable> = {...};`, which is also returned.

    The script is one value, made by one task, so the rows are counted first and more than
    most_rows raise. With dry_run nothing is written.
    """
    if (n := sections.count()) > most_rows:
        raise ValueError(f"{n} rows are more than one script holds")
    entry = F.struct("k1", "k2", "text", "number")
    per = sections.groupBy("section").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    cube = per.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "rows")))).alias("cube"))
    script = cube.select(F.concat(F.lit(f"window.{variable} = "), F.coalesce(F.to_json("cube"), F.lit("{}")), F.lit(";")).alias("value"))
    if not dry_run:
        script.coalesce(1).write.mode(mode).text(path)
    return script


def report(df: DataFrame) -> DataFrame:
    """One JSON string per row, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))
