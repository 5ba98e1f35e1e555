"""Deduplication, frontiers, lookups and selections over tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order; ties fall to all other columns, so the result is one. Null keys are one key.

    A row number limited to 1: Spark keeps the first rows of each key before the
    exchange as well as behind it, so a key that many rows have sends one row per
    task, and wide columns move once.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__k", F.row_number().over(w)).where(F.col("__k") == 1).drop("__k")


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in ``seen``; the plan broadcasts ``seen`` only below Spark's size threshold. Null keys stay."""
    return df.join(seen.select(F.col(key)).distinct(), key, "left_anti")


def new_urls(found: DataFrame, frontier: DataFrame) -> DataFrame:
    """URLs of (url, position) that the frontier lacks, each once, at its first position."""
    first = found.groupBy("url").agg(F.min("position").alias("position"))
    return unseen(first, frontier, "url")


def first_success(df: DataFrame, key: str, ok: str, order: str) -> DataFrame:
    """Of repeated attempts the first that succeeded; keys without success have none."""
    return keep_first(df.where(F.col(ok)), [key], [order])


def first_of(tables: list[DataFrame], key: str, ok: Column) -> DataFrame:
    """For each key the row of the first table that has one that is ``ok``: sources in the order in which they are tried."""
    rows = None
    for k, t in enumerate(tables):
        t = t.where(ok).withColumn("__source", F.lit(k))
        rows = t if rows is None else rows.unionByName(t)
    return keep_first(rows, [key], ["__source"]).drop("__source")


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def attach(articles: DataFrame, items: DataFrame) -> DataFrame:
    """Thumbnails of archive items on articles with the same URL; the first of several items."""
    one = keep_first(items.select("url", "thumbnail_url").where("thumbnail_url is not null"), ["url"], ["thumbnail_url"])
    return articles.drop("thumbnail_url").join(one, "url", "left")


def lookup(df: DataFrame, config: DataFrame, defaults: dict, key: str = "site") -> DataFrame:
    """Settings of each row's site over defaults. The settings table has a row for each site, so it is small by its nature; Spark's threshold decides how it is joined."""
    joined = df.join(config, key, "left")
    for k, v in defaults.items():
        default = F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
        default = default.cast("array<string>") if isinstance(v, list) else default
        joined = joined.withColumn(k, F.coalesce(F.col(k), default) if k in config.columns else default)
    return joined


def categories(sites: DataFrame) -> DataFrame:
    """(site, ordinal, category, archive_url) of sites with named archive URLs or a single one, in the settings' order."""
    single = F.array(F.struct(F.lit("main").alias("category"), F.col("archive_url").alias("archive_url")))
    listed = F.coalesce("archive_urls", F.when(F.col("archive_url").isNotNull(), single))
    return sites.select("site", F.posexplode(listed).alias("ordinal", "e")).select("site", "ordinal", "e.category", "e.archive_url")


def resume_from(cats: DataFrame, category: str) -> DataFrame:
    """Categories of a site from the named one on; none for a site without it."""
    start = cats.where(F.col("category") == category).select("site", F.col("ordinal").alias("__start"))
    return cats.join(start, "site").where(F.col("ordinal") >= F.col("__start")).drop("__start")


def until_empty(pages: DataFrame, by: list[str], page: str, n: str, empties: int = 5, most: int = 1600) -> DataFrame:
    """Numbered pages up to and with the ``empties``-th empty page in a row, and no further than page ``most``."""
    w = Window.partitionBy(*by).orderBy(page)
    full = F.sum(F.when(F.col(n) > 0, 1).otherwise(0)).over(w)
    run = F.when(F.col(n) == 0, F.row_number().over(Window.partitionBy(*by, "__full").orderBy(page)) - F.when(F.col("__full") > 0, 1).otherwise(0)).otherwise(0)
    marked = pages.where(F.col(page) <= most).withColumn("__full", full).withColumn("__run", run)
    stopped = F.max(F.when(F.col("__run") >= empties, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return marked.withColumn("__stopped", stopped).where(F.coalesce("__stopped", F.lit(0)) == 0).drop("__full", "__run", "__stopped")


def context_windows(text: Column, pattern: str, around: int = 20) -> Column:
    """array<string>: every match with up to ``around`` characters on both sides."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(.{{0,{around}}}(?:{pattern}).{{0,{around}}})"), F.lit(1))
