"""Extraction from pages: articles, archive items, main text, dates and authors.

Each function makes one Arrow-batched UDF over (html, settings...), so a page is
parsed once for all that is taken from it. A null page gives null.
"""

from __future__ import annotations

import re
from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.functions.urls import normal_date
from siltmill.operators.dom import Element, parse, select, select_one

_SPACES = re.compile(r"\s+")
ARTICLE = T.StructType([T.StructField("title", T.StringType()), T.StructField("raw_html_content", T.StringType())])
ITEM = T.StructType([T.StructField(k, T.StringType()) for k in ("url", "title", "thumbnail_url")])
BODY = T.StructType([T.StructField("feature_image", T.StringType()), T.StructField("main_text", T.StringType())])

# What is looked at, in order.
ITEM_TITLES = ("h1", "h2", "h3", ".title", ".headline", ".post-title", ".article-title")
IMAGE_ATTRS = ("src", "data-src", "data-lazy-src", "data-original", "data-lazy")
DATE_SELECTORS = (
    '[property="article:published_time"]', '[name="publishdate"]', '[name="date"]', '[name="publication-date"]', '[property="og:updated_time"]',
    "time[datetime]", "time[pubdate]", ".published", ".date", ".post-date", ".article-date", ".entry-date",
)
DATE_ATTRS = ("datetime", "content", "value")
AUTHOR_SELECTORS = ('meta[name="author"]', 'meta[property="article:author"]', 'meta[name="article:author"]', ".author", ".byline", ".writer", ".post-author", ".article-author", ".entry-author")
UNWANTED = (
    "script, style, noscript", '[role="banner"], [role="navigation"], [role="complementary"]', "[data-ad], [data-advertisement]",
    ".ad, .ads, .advertisement, .banner, .promo", ".social, .share, .sharing, .social-share", ".comment, .comments, .comment-section",
    ".related, .related-posts, .related-articles", ".sidebar, .widget, .widgets", ".navigation, .nav, .menu, .breadcrumb", ".header, .footer", ".popup, .modal, .overlay",
)
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}-\d{2}-\d{4}|\w+ \d{1,2}, \d{4}")


def tidy(text: str | None) -> str:
    return _SPACES.sub(" ", text or "").strip()


def _try_select(root: Element, text: str) -> list[Element]:
    try:
        return select(root, text)
    except ValueError:
        return []


def titles(page: Element, content: Element | None) -> list[str]:
    """Candidates for a page's title, best first."""
    found = [tidy(t.text())] if (t := page.find("title")) else []
    for key, name in (("property", "og:title"), ("name", "twitter:title")):
        m = page.find("meta", **{key: name})
        if m and m.attrs.get("content"):
            found.append(tidy(m.attrs["content"]))
    heads = page.find_all("h1") or page.find_all("h2")
    found += [tidy(h.text()) for h in heads]
    if content is not None and (h := content.find("h1")):
        found.append(tidy(h.text()))
    return found


def article(page: str | None, content_selector: str) -> tuple[str | None, str | None] | None:
    """Title and outer HTML of the first fit; None without one; (None, None) for a selector that isn't known."""
    if page is None:
        return None
    try:
        root = parse(page)
        content = select_one(root, content_selector)
    except ValueError:
        return None, None
    if content is None:
        return None
    return next((t for t in titles(root, content) if len(t) > 5), None), content.outer()


def items(page: str | None, base: str, item_selector: str, thumbnail_selector: str | None = None) -> list[tuple[str, str, str | None]]:
    """(url, title, thumbnail_url) of a page's archive items; items without a link are left out."""
    out = []
    for e in _try_select(parse(page or ""), item_selector):
        links = [e] if e.name == "a" and e.attrs.get("href") else e.find_all("a")
        link = links[0] if links and links[0].attrs.get("href") else next((x for x in links if "href" in x.attrs), None)
        if link is None:
            continue
        title = tidy(link.text())
        for s in ITEM_TITLES:
            better = select_one(e, s)
            if better is not None and len(t := tidy(better.text())) > len(title):
                title = t
                break
        picture = next(iter(_try_select(e, thumbnail_selector)), None) if thumbnail_selector else None
        source = next((v for a in IMAGE_ATTRS if picture is not None and (v := picture.attrs.get(a))), None)
        out.append((urljoin(base, link.attrs["href"].strip()), title, urljoin(base, source.strip()) if source else None))
    return out


#: Names whose class and id selectors say no more than a look at the attributes.
_PLAIN = re.compile(r"[A-Za-z_][\w-]*")


def prune(root: Element, classes: list[str]) -> None:
    """Drop elements by part of a class, by id, and by the list above. Without classes nothing is dropped."""
    if not classes:
        return
    for c in filter(None, classes):
        plain = _PLAIN.fullmatch(c)
        gone = [e for e in root.elements() if ((own := e.attrs.get("class")) and c in " ".join(own.split())) or (plain and e.attrs.get("id") == c)]
        if not plain:
            gone += _try_select(root, f".{c}") + _try_select(root, f"#{c}")
        for e in gone:
            e.remove()
    for e in select(root, ", ".join(UNWANTED)):
        e.remove()


def _images(root: Element, base: str) -> None:
    """Images become text marks with their address."""
    for img in root.find_all("img"):
        src = img.attrs.get("src") or img.attrs.get("data-src")
        if src:
            img.replace(f"[IMAGE : {urljoin(base, src) if base else src}]")


def body(page: str | None, base: str | None, image_selector: str | None, text_selector: str | None, classes: list[str] | None) -> tuple[str, str]:
    """Feature image and main text of a page or a part of one; the whole text where the selector finds none."""
    if not page:
        return "", ""
    try:
        root, base = parse(page), base or ""
        prune(root, list(classes or []))
        image = ""
        if image_selector and (e := select_one(root, image_selector)) is not None:
            image = e.attrs.get("src") or e.attrs.get("data-src") or ""
            image = urljoin(base, image) if image and base else image
        parts = []
        for e in select(root, text_selector) if text_selector else []:
            _images(e, base)
            parts.append(e.text(" "))
        text = " ".join(p for p in parts if p)
        if not text:
            for e in [*root.find_all("script"), *root.find_all("style")]:
                e.remove()
            _images(root, base)
            text = root.text(" ")
        return image, text
    except ValueError:
        return "", page


def published(page: str | None) -> str | None:
    """The first date: an attribute of the elements that carry dates, or text that looks like one."""
    root = parse(page or "")
    for s in DATE_SELECTORS:
        for e in select(root, s if s[0] != "[" else f"meta{s}"):
            value = next((v for a in DATE_ATTRS if (v := e.attrs.get(a))), None)
            if value:
                return tidy(value)
            if len(t := tidy(e.text())) >= 4 and _DATE.search(t):
                return t
    return None


def author(page: str | None) -> str | None:
    root = parse(page or "")
    for s in AUTHOR_SELECTORS:
        for e in select(root, s):
            if e.attrs.get("content"):
                return tidy(e.attrs["content"])
            if 0 < len(t := tidy(e.text())) < 100:
                return t
    return None


def extract_article(page: Column, content_selector: Column | str) -> Column:
    s = F.lit(content_selector) if isinstance(content_selector, str) else content_selector
    return F.udf(article, ARTICLE, useArrow=True)(page, s)


def extract_items(page: Column, base: Column, item_selector: str, thumbnail_selector: str | None = None) -> Column:
    """array<struct(url, title, thumbnail_url)>."""
    return F.udf(items, T.ArrayType(ITEM), useArrow=True)(page, base, F.lit(item_selector), F.lit(thumbnail_selector).cast("string"))


def extract_body(page: Column, base: Column, image_selector: Column, text_selector: Column, classes: Column) -> Column:
    return F.udf(body, BODY, useArrow=True)(page, base, image_selector, text_selector, classes)


def extract_published(page: Column) -> Column:
    """A page's date in normal form."""
    return normal_date(F.udf(published, T.StringType(), useArrow=True)(page))


def extract_author(page: Column) -> Column:
    return F.udf(author, T.StringType(), useArrow=True)(page)


def count_matches(page: Column, css: Column | str) -> Column:
    """How many elements fit; null for a selector that isn't known."""

    def count(p: str | None, s: str | None) -> int | None:
        try:
            return len(select(parse(p or ""), s or ""))
        except ValueError:
            return None

    return F.udf(count, T.LongType(), useArrow=True)(page, F.lit(css) if isinstance(css, str) else css)
