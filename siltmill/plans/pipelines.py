"""The engine's three pipelines: cleaning a corpus, building a frontier, fetching articles."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.functions import pytext, text, urls
from siltmill.functions.regex import MYANMAR
from siltmill.operators import extract, relational
from siltmill.ship import prepare
from siltmill.sources.config import CLEANING_DEFAULTS
from siltmill.sources.io import parse_records

Hook = Callable[[Column], Column]


def clean_title(df: DataFrame, title: str, keywords: str, out: str, to_unicode: Hook | None = None) -> DataFrame:
    """The title steps in one Arrow step. A ``to_unicode`` hook, such as a converter of another encoding, comes first."""
    t = F.coalesce(title, F.lit(""))
    return df.withColumn(out, pytext.clean_titles(to_unicode(t) if to_unicode else t, F.col(keywords)))


def clean_text(df: DataFrame, source: str, keywords: str, out: str, to_unicode: Hook | None = None, strict: bool = False) -> DataFrame:
    """The text steps in one Arrow step, or two around a ``to_unicode`` hook. Decoding drops newlines, so patterns to the end of a
    line reach the end of the text; ``strict`` has a narrower range of pictures."""
    t = F.coalesce(source, F.lit(""))
    if to_unicode is None:
        return df.withColumn(out, pytext.clean_texts(strict)(t, F.col(keywords)))
    return df.withColumn(out, to_unicode(pytext.begin_texts(t))).withColumn(out, pytext.finish_texts(strict)(F.col(out), F.col(keywords)))


def _whole(title: str, image: str, text: str) -> str:
    return f"{title} {f'[IMAGE : {image}] ' if image else ''}{text}".strip()


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType())]))
def _articles(title: pd.Series, page: pd.Series, url: pd.Series, image_selector: pd.Series, text_selector: pd.Series, classes: pd.Series, title_words: pd.Series, text_words: pd.Series) -> pd.DataFrame:
    """Clean title and text of each page: one parse and one crossing."""
    rows = []
    for t, p, u, i, m, c, tk, xk in zip(title, page, url, image_selector, text_selector, classes, title_words, text_words, strict=True):
        image, text = extract.body(p, u, i, m, list(c) if c is not None else None)
        name = pytext.title_steps(t or "", tk)
        rows.append((name, _whole(name, image, pytext.last_steps(pytext.first_steps(text), xk))))
    return pd.DataFrame(rows, columns=["title", "text"], dtype=object)


def clean_corpus(lines: DataFrame, config: DataFrame, site: str | None = None, script: str | None = MYANMAR, least: int = 1000, to_unicode: Hook | None = None, seen: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean articles and rejected lines of (site, place, line).

    The first record of a site's id is chosen before any text is touched: ids
    don't depend on texts, and a first record that fails the gate suppresses
    later ones, as is defined; so does a key of ``seen`` (site, id). Records of all sites go in one plan. The Arrow
    step is marked so that the gate's filter isn't moved below it, where it
    would be computed a second time.
    """
    prepare(lines.sparkSession)
    rows, rejects = parse_records(lines.where(F.col("site") == site) if site else lines)
    rows = rows.select("site", "place", urls.article_id(F.col("url")).alias("id"), "url", "title", "raw_html_content")
    first = relational.keep_first(rows, ["site", "id"], ["place"])
    if seen is not None:
        first = first.join(seen, ["site", "id"], "left_anti")
    df = relational.lookup(first, config, CLEANING_DEFAULTS)
    settings = [F.col(c) for c in ("feature_image_selector", "main_text_selector", "removal_classes", "title_removal_keywords", "text_removal_keywords")]
    if to_unicode is None:
        a = _articles.asNondeterministic()(F.col("title"), F.col("raw_html_content"), F.col("url"), *settings)
        out = df.select("site", "id", a.alias("a"), "domain", "url").select("site", "id", "a.title", "a.text", "domain", "url")
    else:
        df = df.withColumn("__body", extract.extract_body(F.col("raw_html_content"), F.col("url"), *settings[:3]))
        df = clean_title(df, "title", "title_removal_keywords", "__title", to_unicode)
        df = clean_text(df.withColumn("__raw", F.col("__body.main_text")), "__raw", "text_removal_keywords", "__text", to_unicode)
        whole = F.pandas_udf(lambda t, i, x: pd.Series([_whole(*r) for r in zip(t, i, x, strict=True)], dtype=object), T.StringType()).asNondeterministic()
        out = df.select("site", "id", F.col("__title").alias("title"), whole(F.col("__title"), F.col("__body.feature_image"), F.col("__text")).alias("text"), "domain", "url")
    return out.where(text.passes_gate(F.col("title"), F.col("text"), script, least, stripped=True)), rejects


def build_frontier(sites: DataFrame, pages: DataFrame, frontier: DataFrame, item_selector: str, max_pages: int | None = None, thumbnail_selector: str | None = None) -> DataFrame:
    """New article URLs (site, category, url, title, thumbnail_url) of the sites' archive pages found in ``pages`` (url, html).

    A site has its own max_pages unless one is given for all. Null, 0 or less is
    unlimited: up to the fifth page in a row without items, and page 1600.
    """
    prepare(sites.sparkSession)
    own = F.col("max_pages") if "max_pages" in sites.columns else F.lit(None)
    settings = sites.select("site", "pagination_type", "pagination_param", F.coalesce("pagination_increment", F.lit(1)).alias("increment"), F.coalesce(F.lit(max_pages or None).cast("long"), own.cast("long"), F.lit(0)).alias("most"))
    cats = relational.categories(sites).join(settings, "site").withColumn("unlimited", F.col("most") <= 0)
    last = F.when(~F.col("unlimited"), F.col("most")).when(F.col("increment") == 1, 1600).otherwise(1599 * F.col("increment"))
    listed = urls.page_urls(F.col("archive_url"), urls.pagination_type(F.col("pagination_type")), F.col("pagination_param"), last, F.col("increment"), F.lit(None).cast("int"))
    at = ["site", "category", "ordinal", "page"]
    asked = cats.select("site", "category", "ordinal", "unlimited", F.explode(listed).alias("p")).select("site", "category", "ordinal", "unlimited", F.col("p.page").alias("page"), F.col("p.url").alias("url"))
    got = asked.join(pages.select("url", "html"), "url").withColumn("found", extract.extract_items(F.col("html"), F.col("url"), item_selector, thumbnail_selector))
    # the base page doesn't count among the empty ones
    probed = (F.col("unlimited")) & (F.col("page") > 1)
    sizes = got.where(probed).groupBy(*at).agg(F.max(F.size("found")).alias("n"))
    numbered = asked.where(probed).select(*at).join(sizes, at, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    reached = relational.until_empty(numbered, at[:3], "page", "n").select(*at)
    got = got.where(~probed).unionByName(got.where(probed).join(reached, at, "left_semi").select(*got.columns))
    items = got.select(*at, F.posexplode("found").alias("k", "i"))
    rows = items.select("i.url", F.struct("ordinal", "page", "k").alias("position"), "site", "category", "i.title", "i.thumbnail_url")
    return relational.unseen(relational.keep_first(rows, ["url"], ["position"]), frontier, "url").drop("position")


def fetch_articles(frontier: DataFrame, pages: DataFrame, stored_ids: DataFrame, content_selector: str, today: Column | None = None) -> DataFrame:
    """Article records of frontier URLs that aren't stored yet and whose page has the content. Stored ones leave before pages are joined."""
    prepare(frontier.sparkSession)
    wanted = frontier.select("url", *(c for c in frontier.columns if c == "thumbnail_url")).dropDuplicates(["url"]).withColumn("id", urls.article_id(F.col("url")))
    if "thumbnail_url" not in wanted.columns:
        wanted = wanted.withColumn("thumbnail_url", F.lit(None).cast("string"))
    got = relational.unseen(wanted, stored_ids, "id").join(pages.select("url", "html"), "url")
    got = got.withColumn("a", extract.extract_article(F.col("html"), content_selector)).where("a is not null")
    date = today if today is not None else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd")
    return got.select("id", "a.title", "url", "thumbnail_url", "a.raw_html_content", date.alias("scraped_date"), urls.source_url(F.col("url")).alias("source_url"))
