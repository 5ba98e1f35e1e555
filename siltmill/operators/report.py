"""Counters and reports: runs, storage, records, selectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.functions.urls import XPATH_MARKS, is_css_selector
from siltmill.operators.dom import parse, select
from siltmill.sources.io import filled

COUNTERS = ("pages_processed", "articles_found", "articles_saved", "articles_skipped", "errors", "urls_collected")


def run_stats(events: DataFrame) -> DataFrame:
    """One row of counters from (counter, amount) rows; counters without rows are 0."""
    return events.agg(*(F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("amount"))), F.lit(0)).cast("long").alias(c) for c in COUNTERS))


def count_by(df: DataFrame, key: str = "site") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def outcome(runs: DataFrame) -> DataFrame:
    """Total articles and whether all of (category, articles, success) rows succeeded; an empty table has succeeded."""
    return runs.agg(F.coalesce(F.sum("articles"), F.lit(0)).cast("long").alias("articles"), F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"), F.count_if("success").alias("n_ok"), F.count_if(~F.col("success")).alias("n_failed"))


def storage_stats(lines: DataFrame) -> DataFrame:
    """(file, articles): lines that aren't blank of (file, line) rows, whether or not they are JSON."""
    return lines.groupBy("file").agg(F.count_if(filled("line")).alias("articles"))


REQUIRED = ("id", "url", "scraped_at")


def check_records(lines: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """One row per line of (file, line_no, line) that isn't blank: whether it is JSON, and an object with the required keys."""
    keys = F.json_object_keys("line")
    good = F.lit(True)
    for k in required:
        good &= F.array_contains(keys, k)
    return lines.where(filled("line")).select("file", "line_no", F.try_parse_json("line").isNotNull().alias("is_json"), F.coalesce(good, F.lit(False)).alias("is_complete"))


def validation_report(lines: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Per file: records, valid and invalid ones, numbers of lines that aren't JSON (errors) or lack keys (warnings), and whether there are no errors."""
    c = check_records(lines, required)
    return c.groupBy("file").agg(
        F.count("*").alias("article_count"),
        F.count_if("is_complete").alias("valid_articles"),
        F.count_if(~F.col("is_complete")).alias("invalid_articles"),
        F.array_sort(F.collect_list(F.when(~F.col("is_json"), F.col("line_no")))).alias("errors"),
        F.array_sort(F.collect_list(F.when(F.col("is_json") & ~F.col("is_complete"), F.col("line_no")))).alias("warnings"),
        (F.count_if(~F.col("is_json")) == 0).alias("valid"),
    )


# Fixed value: the page on which selectors are tried.
SAMPLE_PAGE = """<html><body><div class="content-right"><div class="article-container"><article class="post">
<h4 class="title">Title</h4><p class="excerpt">Text</p></article></div></div>
<div class="sidebar"><h4 class="widget-title">Side</h4></div></body></html>"""

LINT = T.StructType(
    [T.StructField("is_valid", T.BooleanType()), T.StructField("test_matches", T.LongType())] + [T.StructField(k, T.ArrayType(T.StringType())) for k in ("errors", "warnings", "suggestions")]
)


def lint(css: str | None) -> tuple:
    """Whether a selector is one, its matches on a sample page, and remarks."""
    s = (css or "").strip()
    if not s:
        return False, 0, ["the selector is empty"], [], []
    xpath = ["the selector holds marks of XPath"] if any(m in s for m in XPATH_MARKS) else []
    try:
        n = len(select(parse(SAMPLE_PAGE), s))
    except ValueError as e:
        return False, 0, [str(e)], xpath, []
    warnings = xpath + [w for w, on in (("the selector is valid but matches nothing on the sample page", n == 0), ("more than 3 child steps", s.count(">") > 3), ("more than 5 blanks", s.count(" ") > 5)) if on]
    hints = [h for h, on in (("a class alone may match elsewhere", "." in s), ("ids may change between pages", "#" in s)) if on]
    return True, n, [], warnings, hints


def lint_selectors(df: DataFrame, column: str = "selector") -> DataFrame:
    r = F.udf(lint, LINT, useArrow=True)(F.col(column))
    return df.withColumn("__r", r).select(*df.columns, F.col("__r.*"), is_css_selector(F.col(column)).alias("is_css"))
