"""Column functions against plain Python, and cases written by hand."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltmill.functions import pytext, regex, text, urls


def values(spark, f, inputs):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], "k int, v string")
    return [r.o for r in df.select("k", f(F.col("v")).alias("o")).orderBy("k").collect()]


@pytest.mark.parametrize(
    "f, pairs",
    [
        (urls.is_valid_url, [("http://a/b", True), ("http://a/", False), ("a/b", False), ("", False), (None, False)]),
        (urls.slug, [("Daily News", "daily_news"), ("  --  ", "--"), ("!!", "scraper_output"), (None, "scraper_output"), ("A  b_", "a_b")]),
        (urls.collapse_spaces, [(" a\u00a0\n b ", "a b"), (None, "")]),
        (text.cut_zawgyi, [("a ZG b", "a "), ("x [Zawgyi] y ZG z", "x [Zawgyi] y "), ("none", "none"), (None, None)]),
        (text.remove_agency, [("A (Xinhua) mid text (end)", "A"), ("x (Xinhua/Name).", "x"), ("a\n————tail\nb", "a\n\nb"), ("one, (English version) y", "one"), ("one (Chinese version) two (English version)", "one (Chinese version) two"), ("…… x", "x")]),
        (text.fold_references, [("a == ကိုးကား == ", "a"), ("a  ==ကိုးကား== b", "a ကိုးကား b"), (" a ", "a")]),
        (pytext.remove_boilerplate, [("They had lunch. Then left.", "They h"), ("a menu: b\nc", "a \nc"), ("x [ Share ] y", "x  y"), ("x share y", "xy")]),
        (text.remove_bot_lines, [("a\nby BotUpload\nb", "a\nb")]),
        (text.fold_dashes, [("a----b", "a - b"), ("-", "-")]),
        (text.mark_exponents, [("2^3", "$2^{3}$")]),
        (text.mark_roots, [("sqrt(x)", "$\\sqrt{x}$")]),
        (text.remove_pictures, [("a😀漢字b★", "ab")]),
        (lambda c: text.remove_pictures(c, strict=True), [("a😀漢字b", "a漢字b")]),
        (text.passes_severe, [("", False), (None, False), ("plain words", True), ("a" * 50, False), ("%%%%ab", False)]),
        (text.passes_strict, [("a" * 20, False), ("fine text", True), ("a\n\n" * 12, False)]),
        (text.count_words, [("one two [IMAGE : x] www.a.b three", 3), (None, 0)]),
        (pytext.decode_entities, [("a&amp;nbsp;b&foo;", "a b"), ("x\n\ty\u200bz\u00a0w", "xyz w"), (None, None)]),
        (pytext.convert_fractions, [("so 1/2 is", "so $\\frac{1}{2}$ is"), ("open 24/7", "open 24/7"), ("YGN-40/7N", "YGN-40/7N"), ("fact 1/2", "fact 1/2"), ("(8/5)", "(8/5)"), ("x1/2.png", "x1/2.png")]),
        (pytext.convert_equations, [("x = 5", "$x = 5$"), ("a = မ", "a = မ"), ("x = " + "y" * 21, "x = " + "y" * 21)]),
        (pytext.convert_tables, [("|a|b\n|c|d\n", "\\begin{tabular}{cc}\na & b \\\\\nc & d \\\\\n\\end{tabular}")]),
    ],
)
def test_cases(spark, f, pairs):
    got = values(spark, f, [a for a, _ in pairs])
    assert got == [b for _, b in pairs]


def test_gate_length(spark):
    df = spark.createDataFrame([(k, "t", "ab😀 "[: 3] * (n // 3) + "x" * (n % 3)) for k, n in enumerate((999, 1000, 1001))], "k int, title string, text string")
    ok = [r.o for r in df.orderBy("k").select(text.passes_gate(F.col("title"), F.col("text"), None).alias("o")).collect()]
    assert ok == [False, True, True]


def test_delays(spark):
    got = values(spark, urls.delay_range, [None, "0", "0.5", "2", "2,5", "3 to 6", "abc"])
    assert [tuple(r) for r in got] == [(0.5, 1.0), (0, 0), (0.1, 0.5), (0.5, 2), (2, 5), (3, 6), (0.5, 1.0)]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=20, max_size=40))
def test_spaces_like_python(spark, texts):
    assert values(spark, urls.collapse_spaces, texts) == [re.sub(r"\s+", " ", t).strip() for t in texts]


def test_page_urls(spark):
    df = spark.createDataFrame([("http://h/a/", "?p={n}", 3, 1, None), ("http://h/a/", "/page/{n}", 20, 9, None), ("http://h/a", "&p={n}", 2, 1, 5), ("http://h", None, 9, 1, None)], "b string, p string, m int, i int, r int")
    got = [[x.url for x in r.u] for r in df.select(urls.page_urls(F.col("b"), F.lit("queryparam"), F.col("p"), F.col("m"), F.col("i"), F.col("r")).alias("u")).collect()]
    assert got == [["http://h/a/", "http://h/a/?p=2", "http://h/a/?p=3"], ["http://h/a/", "http://h/a/page/9", "http://h/a/page/18", "http://h/a/page/27"], ["http://h/a"], ["http://h"]]


def test_normal_dates(spark):
    cases = {
        "2024-05-06": "2024-05-06T00:00:00",
        " 2024-05-06T07:08:09Z": "2024-05-06T07:08:09+00:00",
        "2024-05-06T07:08:09.250+0630": "2024-05-06T07:08:09.250000+06:30",
        "2024-05-06T07:08:09.000-03:00": "2024-05-06T07:08:09-03:00",
        "2024-05-06 07:08": "2024-05-06T07:08:00",
        "Mon, 6 May 2024 07:08:09 GMT": "2024-05-06T07:08:09+00:00",
        "May 6,  2024": "2024-05-06T00:00:00",
        "05/06/2024": "2024-05-06T00:00:00",
        "no date": "no date",
        "2024-13-45": "2024-13-45",
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", urls.normal_date(F.col("s")).alias("v"))
    assert {r.s: r.v for r in df.collect()} == cases


def test_dates_try_few_formats(spark):
    """A format is tried on texts of its form, which are all that it parses; on a text that is no date none is."""
    for texts, most in ((["1-URGENT", "no date", "", "24/7"], 0), (["05/06/2024", "2024-05-06T07:08", "05-06-2024 07:08:09", "6 May 2024", "May 6, 2024"], 2)):
        assert all(sum(bool(re.search(p, t)) for p in urls._FORMS.values()) <= most for t in texts)
    for f, p in urls._FORMS.items():
        t = spark.sql("SELECT timestamp'2024-09-16 07:08:09' AS t").select(F.date_format("t", f)).first()[0]
        assert re.search(p, t) and re.search(urls._ANY_FORM, t), f
    cases = {"Monday, SEPTEMBER 06, 2024 07:08": "2024-09-06T07:08:00", "06 sep 2024 UTC": "2024-09-06T00:00:00+00:00", "+12024-05-06": "+12024-05-06T00:00:00", "02/30/2024": "02/30/2024", "2024-05-06t07:08Z": "2024-05-06T07:08:00+00:00"}
    assert values(spark, urls.normal_date, list(cases)) == list(cases.values())


def test_one_step_like_the_steps(spark):
    """The chain in one Arrow step against the single steps as columns."""
    texts = [
        "<p>Hello &amp; you</p>\nread more here", "share this  \u2003 [ Like ] x^2 is 3 ^ 2, y = 4", "A (Xinhua) text ———— tail\n(Xinhua/Name).", "so (English version) gone",
        " == ကိုးကား ==  notes ", "botupload line\nother -- line", "ZG zawgyi", "1/2 of sqrt(x)\t|a|b\n|c|d\n", "\u0130ad \u212aenu: x", "★ 漢字   end", "", "   ", "\u2003\u2003\u2003\u2003x \u200b",
        "all  rights reserved now", "li[share]ke me", "… dots\n… more", 'q "a" \\ b',
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    keys = F.array(F.lit("x"))
    c = pytext.remove_boilerplate(pytext.decode_entities(text.remove_tags(F.col("t"))))
    for step in (lambda v: text.remove_keywords(v, keys), text.cut_zawgyi, text.remove_agency, text.fold_references, text.remove_quotes, text.remove_bot_lines, text.fold_dashes, pytext.convert_formulas, pytext.decode_entities, text.remove_pictures, text.normal_spacing, regex.strip):
        c = step(c)
    got = df.select("k", c.alias("want"), pytext.clean_texts()(F.col("t"), keys).alias("v")).collect()
    assert {r.k: r.v for r in got} == {r.k: r.want for r in got}
