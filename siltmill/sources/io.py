"""Readers and writers of article records, URL lists and ids.

Readers keep the order of lines: a record's place is (file, block, number in the
block). Writers leave whole files or none, as Spark commits them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltmill.functions.regex import NOT_WS, java, strip

RAW = "id string, title string, url string, thumbnail_url string, raw_html_content string, scraped_date string, source_url string"
CLEAN = "id string, title string, text string, domain string, url string"
FORMATS = ("ndjson", "json", "parquet")


def filled(line: str) -> Column:
    """Whether a line holds more than white space, of any kind."""
    return F.col(line).rlike(java(NOT_WS))


def site_of(path: Column) -> Column:
    """A file's name without folders and its last ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def read_lines(spark: SparkSession, path: str, site: str | None = None) -> DataFrame:
    """(site, file, place, line): lines in order of ``place`` within a file; files of other sites aren't opened."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("place"), F.col("value").alias("line"))
    rows = rows.select(site_of(F.col("file")).alias("site"), "file", "place", "line")
    return rows.where(F.col("site") == site) if site else rows


def parse_records(lines: DataFrame, schema: str = RAW) -> tuple[DataFrame, DataFrame]:
    """Records of the lines, and rejected lines with a reason; blank lines are neither.

    Absent keys and null values differ: a missing url is an empty one, a null
    url or title is a reason to reject, and so is a line that is no object.
    """
    keys = F.json_object_keys("line")
    null = lambda k: F.array_contains(keys, k) & F.get_json_object("line", f"$.{k}").isNull()
    reason = F.when(F.try_parse_json("line").isNull(), "not json").when(keys.isNull(), "not an object").when(null("url"), "null url").when(null("title"), "null title")
    full = lines.where(filled("line")).withColumn("reason", reason)
    good = full.where("reason is null").withColumn("r", F.from_json("line", schema)).select("site", "place", "r.*")
    for c in ("url", "title", "raw_html_content"):
        good = good.withColumn(c, F.coalesce(c, F.lit("")))
    return good, full.where("reason is not null").select("site", "place", "line", "reason")


def read_articles(spark: SparkSession, path: str, form: str = "ndjson", schema: str = RAW) -> DataFrame:
    """Article records; lines that can't be parsed are dropped."""
    if form == "parquet":
        return spark.read.schema(schema).parquet(path)
    rows = spark.read.schema(schema + ", _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("multiLine", form == "json").json(path)
    return rows.where("_corrupt is null").drop("_corrupt")


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(strip(F.col("value")).alias("url")).where("url != ''")


def existing_ids(spark: SparkSession, path: str, form: str = "ndjson") -> DataFrame:
    """Distinct ids of stored records; none where nothing is stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.globStatus(folder):
        return spark.createDataFrame([], "id string")
    return read_articles(spark, path, form, "id string").where("id is not null").distinct()


def _check(form: str) -> None:
    if form not in FORMATS:
        raise ValueError(f"format {form!r} is none of {', '.join(FORMATS)}")


def save_articles(df: DataFrame, path: str, form: str = "ndjson") -> None:
    """Append records. ``json`` is one record a line as well: an array can't be appended to without rewriting it."""
    _check(form)
    w = df.write.mode("append")
    w.parquet(path) if form == "parquet" else w.option("ignoreNullFields", False).json(path)


def save_batch(df: DataFrame, path: str, form: str = "ndjson") -> int:
    """Append records and give their number, which is counted as they are written."""
    seen = Observation()
    save_articles(df.observe(seen, F.count(F.lit(1)).alias("n")), path, form)
    return seen.get["n"]


def file_stats(spark: SparkSession, path: str, form: str = "ndjson") -> dict:
    """Whether a store exists, its bytes, and its records: lines that aren't blank, or elements of arrays."""
    _check(form)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = {"output_file": path, "format_type": form, "file_exists": files.exists(folder), "file_size": 0, "article_count": 0}
    if out["file_exists"]:
        out["file_size"] = files.getContentSummary(folder).getLength()
        out["article_count"] = spark.read.text(path).where(filled("value")).count() if form == "ndjson" else read_articles(spark, path, form, "id string").agg(F.count("id") + F.count_if(F.col("id").isNull())).first()[0]
    return out


def save_clean(df: DataFrame, path: str) -> None:
    """Overwrite the cleaned records, a folder for each site. Sites are rebalanced, so that adaptive execution writes a large one in as many tasks and files as its bytes ask for."""
    df.hint("rebalance", F.col("site")).write.mode("overwrite").partitionBy("site").option("ignoreNullFields", False).json(path)


def export_array(df: DataFrame, path: str) -> int:
    """One JSON array in a local file, for small results: rows are streamed, not collected. Gives the number of records."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for row in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():
            f.write(("," if n else "") + "\n  " + row[0])
            n += 1
        f.write("\n]\n")
    return n


def append_urls(urls: DataFrame, path: str) -> None:
    urls.select("url").write.mode("append").text(path)


def backup(spark: SparkSession, path: str, now: datetime.datetime | None = None) -> str:
    """Copy stored lines beside themselves, named by time; gives the copy's path."""
    copy = f"{path.rstrip('/')}.backup_{(now or datetime.datetime.now(datetime.UTC)).strftime('%Y%m%d_%H%M%S')}"
    spark.read.text(path).write.text(copy)
    return copy
