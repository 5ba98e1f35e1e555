"""Ids, URLs, slugs and crawl settings."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siltmill.functions.regex import DIGIT, WS, Rule, apply, let, strip

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_HOST = _SCHEME + r"//([^/?#]*)"
_PATH = _HOST + r"([^?#]*)"


def article_id(url: Column) -> Column:
    """The md5 of a URL as hex; a null URL has none."""
    return F.md5(url)


def url_host(url: Column) -> Column:
    """Host and port; empty where there is none."""
    return F.regexp_extract(url, _HOST, 2)


def source_url(url: Column) -> Column:
    """scheme://host."""
    return F.concat(F.lower(F.regexp_extract(url, _SCHEME, 1)), F.lit("://"), url_host(url))


def is_valid_url(url: Column) -> Column:
    """A scheme, a host, and a path beyond the root."""
    return F.coalesce((url_host(url) != "") & (F.length(F.regexp_extract(url, _PATH, 3)) > 1), F.lit(False))


@F.pandas_udf(StringType())
def resolve_url(base: pd.Series, relative: pd.Series) -> pd.Series:
    """A relative URL made absolute; null if either is."""
    return pd.Series([None if b is None or r is None else urljoin(b, r) for b, r in zip(base, relative, strict=True)])


#: Steps from any title to a file name's stem.
SLUG = [Rule(rf"{WS}+", "_"), Rule(r"[^\p{L}\p{N}_\-]", ""), Rule("_+", "_"), Rule("^_+|_+$", "")]
SLUG_DEFAULT = "scraper_output"


def slug(name: Column) -> Column:
    made = apply(strip(F.lower(name)), SLUG)
    return F.when(F.coalesce(made, F.lit("")) == "", SLUG_DEFAULT).otherwise(made)


SPACES = [Rule(rf"{WS}+", " ")]


def collapse_spaces(text: Column) -> Column:
    """White space runs to one blank, none at the ends; null gives an empty string."""
    return strip(apply(F.coalesce(text, F.lit("")), SPACES))


def delay_range(delay: Column) -> Column:
    """A wait setting as struct(low, high): null, a number, ``a,b`` or ``a to b``; anything else is the default.

    Fixed values: the default 0.5 to 1 seconds; 0 or less waits not at all; below 1 starts at 0.1, else at 0.5.
    """
    s = strip(delay)
    pair = lambda parts: (F.size(parts) == 2) & parts[0].try_cast("double").isNotNull() & parts[1].try_cast("double").isNotNull()
    comma = F.transform(F.split(s, ","), strip)
    to = F.transform(F.split(F.lower(s), " to "), strip)
    one = s.try_cast("double")
    span = lambda a, b: F.struct(a.cast("double").alias("low"), b.cast("double").alias("high"))
    single = F.when(one <= 0, span(F.lit(0), F.lit(0))).when(one < 1, span(F.lit(0.1), one)).when(one.isNotNull(), span(F.lit(0.5), one)).otherwise(span(F.lit(0.5), F.lit(1.0)))
    return F.when(s.isNull(), span(F.lit(0.5), F.lit(1.0))).when(pair(comma), span(comma[0].try_cast("double"), comma[1].try_cast("double"))).when(pair(to), span(to[0].try_cast("double"), to[1].try_cast("double"))).otherwise(single)


#: The numbers that configurations use for kinds of pagination.
PAGINATION = {0: "none", 1: "queryparam", 2: "click", 3: "scroll"}


def pagination_type(value: Column) -> Column:
    """A pagination setting, given as text: its number's name, ``none`` for other numbers and null, and names as they are."""
    number = value.try_cast("int")
    named = F.lit(None).cast("string")
    for k, v in PAGINATION.items():
        named = F.when(number == k, v).otherwise(named)
    return F.when(value.isNull(), "none").when(number.isNotNull(), F.coalesce(named, F.lit("none"))).otherwise(value)


def page_urls(base: Column, kind: Column, param: Column, max_pages: Column, increment: Column, resume: Column) -> Column:
    """The archive pages of a site as array<struct(page, url)>: the base page and, for query parameters, numbered ones.

    With an increment of 1 the numbers are the pages up to max_pages; else
    max_pages is the last page value, and page n has the value (n - 1) * increment.
    """
    total = F.when(increment == 1, max_pages).otherwise(F.ceil(max_pages / increment).cast("int") + 1).cast("int")
    first = F.coalesce(F.when(resume > 0, resume), F.lit(2)).cast("int")
    numbered = F.when((kind == "queryparam") & (F.coalesce(param, F.lit("")) != "") & (max_pages > 0) & (first <= total), F.sequence(first, total)).otherwise(F.array().cast("array<int>"))

    def one(n: Column) -> Column:
        value = F.when(increment == 1, n).otherwise((n - 1) * increment)
        filled = F.replace(param, F.lit("{n}"), value.cast("string"))
        joined = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(filled, "^/+", ""))
        return F.struct(n.alias("page"), F.when(filled.rlike("^[?&]"), F.concat(base, filled)).otherwise(joined).alias("url"))

    return F.concat(F.array(F.struct(F.lit(1).alias("page"), base.alias("url"))), F.transform(numbered, one))


XPATH_MARKS = ("/", "text()", "contains(", "following-sibling", "preceding-sibling", "@")


def is_css_selector(selector: Column) -> Column:
    """Whether a selector holds none of the marks of XPath."""
    out = F.lit(True)
    for mark in XPATH_MARKS:
        out &= ~F.contains(selector, F.lit(mark))
    return out


#: Fixed patterns: the forms of dates that are looked for.
DATES = [r"\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}", r"\p{Nd}{2}/\p{Nd}{2}/\p{Nd}{4}", r"\p{Nd}{2}-\p{Nd}{2}-\p{Nd}{4}", r"[\p{L}\p{N}_]+ \p{Nd}{1,2}, \p{Nd}{4}"]


def looks_like_date(text: Column) -> Column:
    return F.coalesce((F.length(text) >= 4) & text.rlike("|".join(DATES)), F.lit(False))


_DAYS = "yyyy-MM-dd yyyy/MM/dd MM/dd/yyyy MM-dd-yyyy".split()
_NAMED = ["MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy", "d MMMM yyyy", "d MMM yyyy"]
_DATE_FORMATS = [f"yyyy-MM-dd'T'{t}" for t in ("HH:mm:ss", "HH:mm")] + [d + t for d in _DAYS + _NAMED for t in ("", " HH:mm:ss", " HH:mm")]
#: What the letters of a format take at most; months by name hold no digits.
_LETTERS = {"yyyy": "[+-]?[0-9]{4,19}", "MMMM": "[^0-9]+", "MMM": "[^0-9]+", "d": "[+-]?[0-9]{1,19}", "'T'": "[Tt]"} | dict.fromkeys(("MM", "dd", "HH", "mm", "ss"), "[0-9]{2}")
#: A pattern for each format of all texts that it parses, and of some that it doesn't; and one of all that any format parses.
_FORMS = {f: "^" + "".join(_LETTERS.get(p, p) for p in re.findall("y+|M+|d+|H+|m+|s+|'T'|.", f)) + "$" for f in _DATE_FORMATS}
_ANY_FORM = "^[+-]?[0-9]+[-/][0-9]{2}[-/]|^[+-]?[0-9]+ [^0-9]+[0-9]{4}|^[^0-9]+[0-9]+,? [+-]?[0-9]{4}"


def _timestamp(text: Column) -> Column:
    """The time by the first format that parses a text. Formats are tried on texts of their form only, as a parser that fails
    throws an exception, which takes far longer than the look at the form."""
    tried = F.coalesce(*(F.when(text.rlike(_FORMS[f]), F.try_to_timestamp(text, F.lit(f))) for f in _DATE_FORMATS))
    return F.when(text.rlike(_ANY_FORM), tried)


def normal_date(text: Column) -> Column:
    """ISO form of a date or time that a text is (months by name, US order, a weekday before it, fractions of seconds, zones as offsets); else the text without spare white space."""
    parts = rf"^(?:[A-Za-z]{{3,9}}, )?(.*?)(?:(?<=:{DIGIT}{{2}})\.({DIGIT}{{1,6}}){DIGIT}*)?(?: ?(?<=[0-9 ])(Z|UTC|GMT|(?<=:[0-9]{{2}}.{{0,9}})[+-]{DIGIT}{{2}}:?{DIGIT}{{2}}))?$"

    def behind(s: Column) -> Column:
        """Microseconds and offset."""
        fraction = let(F.regexp_extract(s, parts, 2), lambda x: F.when(F.translate(x, "0", "") != "", F.concat(F.lit("."), F.rpad(x, 6, "0"))).otherwise(""))
        zone = let(F.regexp_extract(s, parts, 3), lambda x: F.when(x == "", "").when(x.isin("Z", "UTC", "GMT"), "+00:00").otherwise(F.regexp_replace(x, r"^(.\d\d):?(\d\d)$", "$1:$2")))
        return F.concat(fraction, zone)

    def read(s: Column) -> Column:
        # what stands behind a time has a colon before it, a zone behind a date a letter at its end; every format has a year of four digits
        more = s.rlike(":|[ZCT]$")
        base = F.when(more, F.regexp_extract(s, parts, 1)).otherwise(F.regexp_replace(s, "^[A-Za-z]{3,9}, ", ""))
        found = F.date_format(let(base, _timestamp), "yyyy-MM-dd'T'HH:mm:ss")
        whole = let(found, lambda x: F.when(x.isNull(), s).when(more, F.concat(x, behind(s))).otherwise(x))
        return F.when(s.rlike("[0-9]{4}"), whole).otherwise(s)

    return let(collapse_spaces(text), read)


def now_utc() -> Column:
    """The current time as an ISO text that ends in Z."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
