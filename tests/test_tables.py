import datetime
import json

import pytest
from pyspark.sql import functions as F

from siltmill.operators import relational, report
from siltmill.plans.pipelines import clean_corpus
from siltmill.sources import config, io
from siltmill.streaming.incremental import clean_stream


def test_keep_first_any_partitioning(spark):
    df = spark.createDataFrame([("s", "a", 2, "y"), ("s", "a", 1, "x"), ("s", None, 3, "n"), ("t", "a", 4, None)], "site string, id string, place int, v string")
    for n in (1, 3):
        got = {tuple(r) for r in relational.keep_first(df.repartition(n), ["site", "id"], ["place"]).collect()}
        assert got == {("s", "a", 1, "x"), ("s", None, 3, "n"), ("t", "a", 4, None)}


def test_first_success_and_unseen(spark):
    df = spark.createDataFrame([("a", False, 1), ("a", True, 2), ("a", True, 3), ("b", False, 1)], "k string, ok boolean, n int")
    assert [tuple(r) for r in relational.first_success(df, "k", "ok", "n").collect()] == [("a", True, 2)]
    seen = spark.createDataFrame([("a",)], "k string")
    assert {r.k for r in relational.unseen(df, seen, "k").collect()} == {"b"}


def test_until_empty(spark):
    n = [1, 0, 0, 1, 0, 0, 0, 0, 0, 1, 1]
    df = spark.createDataFrame([("s", k + 1, v) for k, v in enumerate(n)], "site string, page int, n int")
    assert sorted(r.page for r in relational.until_empty(df, ["site"], "page", "n").collect()) == list(range(1, 10))
    df = spark.createDataFrame([("s", k + 1, 0) for k in range(8)], "site string, page int, n int")
    assert sorted(r.page for r in relational.until_empty(df, ["site"], "page", "n").collect()) == [1, 2, 3, 4, 5]


def test_context_windows(spark):
    df = spark.createDataFrame([("abcdef 1/2 ghij",)], "t string")
    assert df.select(relational.context_windows(F.col("t"), "1/2", 3)).first()[0] == ["ef 1/2 gh"]


def test_validation_report(spark):
    lines = ['{"id":1,"url":2,"scraped_at":null}', "{bad", "[1]", "", '{"id":1}']
    df = spark.createDataFrame([("f", k + 1, x) for k, x in enumerate(lines)], "file string, line_no int, line string")
    r = report.validation_report(df).first()
    assert (r.article_count, r.valid_articles, r.invalid_articles, r.errors, r.warnings, r.valid) == (4, 1, 3, [2], [3, 5], False)
    assert report.storage_stats(df).first().articles == 4


def _lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")


def test_parse_and_clean(spark, tmp_path):
    good = "<div><p>" + "word " * 300 + "</p></div>"
    rows = [
        {"url": "http://a/1", "title": "First one", "raw_html_content": "<p>short</p>"},
        {"url": "http://a/1", "title": "Second try", "raw_html_content": good},
        {"url": "http://a/2", "title": "Good", "raw_html_content": good, "extra": 1},
        {"title": "no url", "raw_html_content": good},
        {"title": "no url either", "raw_html_content": good},
        {"url": None, "title": "x", "raw_html_content": good},
        {"url": "http://a/3", "title": None, "raw_html_content": good},
        "[1, 2]",
        "{broken",
        "",
        "\t \u2003",
    ]
    _lines(tmp_path / "site1.jsonl", rows)
    cfg = config.site_table(spark, {"sites": {"site1": {"domain": "D", "main_text_selector": "p"}}}, config.CLEANING)
    clean, rejects = clean_corpus(io.read_lines(spark, str(tmp_path / "*.jsonl")), cfg, script=None)
    got = {r.url: r for r in clean.collect()}
    # the first record of a url is the one, though it fails the gate; all without a url are one
    assert set(got) == {"http://a/2", ""} and got[""].title == "no url" and got["http://a/2"].domain == "D"
    assert sorted(r.reason for r in rejects.collect()) == ["not an object", "not json", "null title", "null url"]
    assert clean_corpus(io.read_lines(spark, str(tmp_path / "*.jsonl")), cfg)[0].count() == 0


def test_stream_is_incremental(spark, tmp_path):
    src, sink, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    src.mkdir()
    cfg = config.site_table(spark, {"sites": {}}, config.CLEANING)
    row = lambda k: {"url": f"http://a/{k}", "title": "Title", "raw_html_content": "<p>" + "word " * 300}
    _lines(src / "s.jsonl", [row(1), row(2), row(1)])
    clean_stream(spark, str(src), str(sink), str(check), cfg, script=None).awaitTermination()
    assert spark.read.parquet(f"{sink}/clean").count() == 2
    (src / "more").mkdir()
    _lines(src / "s2.jsonl", [row(5), {"url": "http://a/6", "title": "Title", "raw_html_content": "<p>short"}, "{broken"])
    clean_stream(spark, str(src), str(sink), str(check), cfg, script=None).awaitTermination()
    assert spark.read.parquet(f"{sink}/clean").count() == 3
    assert [r.reason for r in spark.read.parquet(f"{sink}/rejects").collect()] == ["not json"]


def test_stream_remembers_first_records(spark, tmp_path):
    """A first record that failed the gate in an earlier batch suppresses a later one, as in one batch."""
    src, sink, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    for k, rows in enumerate([[("1", "short"), ("2", "word " * 300)], [("1", "word " * 300), ("2", "word " * 300), ("3", "word " * 300)]]):
        (src / f"d{k}").mkdir(parents=True)
        _lines(src / f"d{k}" / "s.jsonl", [{"url": f"http://a/{u}", "title": "Title", "raw_html_content": f"<p>{t}"} for u, t in rows])
        clean_stream(spark, f"{src}/*", str(sink), str(check), config.site_table(spark, {"sites": {}}, config.CLEANING), script=None).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(f"{sink}/clean").collect()) == ["http://a/2", "http://a/3"]


def test_io_round_trip(spark, tmp_path):
    path = str(tmp_path / "a")
    df = spark.createDataFrame([("1", "ကို", None)], "id string, title string, url string")
    assert io.existing_ids(spark, path).count() == 0
    io.save_articles(df, path)
    io.save_articles(df, path)
    assert [r.title for r in io.read_articles(spark, path).collect()] == ["ကို", "ကို"]
    assert io.existing_ids(spark, path).count() == 1
    assert '"url":null' in spark.read.text(path).first()[0]
    copy = io.backup(spark, path, datetime.datetime(2024, 1, 2, 3, 4, 5))
    assert copy.endswith(".backup_20240102_030405") and spark.read.text(copy).count() == 2
    assert io.export_array(df, str(tmp_path / "x.json")) == 1 and json.loads((tmp_path / "x.json").read_text()) == [{"id": "1", "title": "ကို", "url": None}]
    io.save_clean(df.withColumn("site", F.lit("s")), str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).count() == 1
    with pytest.raises(ValueError):
        io.save_articles(df, path, "csv")
    assert io.save_batch(df.union(df), str(tmp_path / "b")) == 2 and io.existing_ids(spark, str(tmp_path / "b")).count() == 1
    got = io.file_stats(spark, str(tmp_path / "b"))
    assert (got["file_exists"], got["article_count"]) == (True, 2) and got["file_size"] > 20
    assert io.file_stats(spark, str(tmp_path / "none"))["file_exists"] is False
    (tmp_path / "arr.json").write_text('[{"id": "a", "title": "x"},\n {"id": "b"}]')
    assert {r.id for r in io.read_articles(spark, str(tmp_path / "arr.json"), "json").collect()} == {"a", "b"} and io.file_stats(spark, str(tmp_path / "arr.json"), "json")["article_count"] == 2
    (tmp_path / "urls.txt").write_text("\thttp://a \u00a0\n\t\n\u2003\nhttp://b\n")
    assert [r.url for r in io.read_urls(spark, str(tmp_path / "urls.txt")).collect()] == ["http://a", "http://b"]


def test_config(spark, tmp_path):
    (tmp_path / "s.yaml").write_text("defaults:\n  delay: 2\nsites:\n  b:\n    archive_urls:\n      z: http://z\n      a: http://a\n  c:\n    archive_url: http://c\n    delay: 1,3\n")
    t = config.site_table(spark, config.load_yaml(str(tmp_path / "s.yaml")))
    assert {r.site: r.delay for r in t.collect()} == {"b": "2", "c": "1,3"}
    assert [(r.site, r.category) for r in relational.categories(t).orderBy("site", "ordinal").collect()] == [("b", "z"), ("b", "a"), ("c", "main")]
    assert config.load_yaml(str(tmp_path / "none.yaml")) == {}
    env = tmp_path / ".env"
    env.write_text("SCRAPER_SLUG=s\nSCRAPER_ARCHIVE_URL=http://a\nSCRAPER_ARCHIVE_SELECTOR='.x'\nSCRAPER_CONTENT_SELECTOR=.y\nSCRAPER_MAX_PAGES=5\nSCRAPER_RESUME=Yes\n# c\n")
    got = config.load_env(str(env))
    assert (got["max_pages"], got["resume"], got["use_proxy"], got["archive_selector"], got["timeout"], got["thumbnail_selector"], got["pagination_param"]) == (5, True, False, ".x", 30.0, "img", None)
    env.write_text("SCRAPER_ARCHIVE_URL=http://a\n")
    assert config.load_env(str(env)) is None and config.load_env(str(tmp_path / "no")) is None


def test_robots():
    from siltmill.operators.robots import may_fetch

    rules = "User-agent: bad\nDisallow: /\n\nUser-agent: *\nDisallow: /private/"
    assert may_fetch("http://h/a", rules) and not may_fetch("http://h/private/a", rules) and not may_fetch("http://h/a", rules, "bad")
    assert may_fetch("http://h/a", None) and may_fetch(None, "")


def test_first_of(spark):
    a, b = (spark.createDataFrame(r, "url string, html string") for r in ([("x", None), ("y", "1")], [("x", "2"), ("y", "3"), ("z", "4")]))
    assert {tuple(r) for r in relational.first_of([a, b], "url", F.col("html").isNotNull()).collect()} == {("x", "2"), ("y", "1"), ("z", "4")}


def test_selector_warnings():
    assert report.lint("div.none")[3] == ["the selector is valid but matches nothing on the sample page"]
    assert report.lint("//div")[3] == ["the selector holds marks of XPath"] and report.lint("h4")[3] == []


def test_clean_plan(spark):
    """One Arrow step, no nested loops, and each site's settings by a join."""
    from siltmill.plans import catalog

    plan = catalog.flagship(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "NestedLoop" not in plan and plan.count("regexp_replace") == 1  # the gate's
