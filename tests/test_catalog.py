"""Every query with SQL equals it on the smallest tables; the others give rows."""

import os

import duckdb
import pytest

from siltmill.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([round(r[k], 9) if isinstance(r[k], float) else r[k] for k in order]) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalog.ORACLES:
        assert got
        return
    r = duck.execute(catalog.ORACLES[name])
    assert got == rows([c[0] for c in r.description], r.fetchall())


def on_texts(spark, tmp_path, name, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    return [r.v for r in sorted(catalog.QUERIES[name](spark, str(tmp_path)).collect())]


def test_slug_takes_whole_texts(spark, tmp_path):
    assert on_texts(spark, tmp_path, "p8_slug", ["word " * 40 + "End"]) == ["some_-_title_" + "word_" * 40 + "end"]


def test_conversions_take_documents_as_they_are(spark, tmp_path):
    """Fractions, tables and equations of the documents themselves, beside the ones that are added."""
    cases = {
        "f15_fractions": [("so 3/4 is what he had of it then", "so $\\frac{3}{4}$ is what he had of it then"), ("in 2024 a|b x=y", "in 2024 a|b x=y")],
        "f14_tables": [("|p|q\n|r|s\nend 12/3", "\\begin{tabular}{cc}\np & q \\\\\nr & s \\\\\n\\end{tabular}"), ("x = 1", "x = 1")],
        "f18_equations": [("z = 7", "$z = 7$"), ("a|b 1/2", "a|b 1/2")],
    }
    for name, texts in cases.items():
        assert name not in catalog.ORACLES
        got = on_texts(spark, tmp_path / name, name, [t for t, _ in texts])
        assert all(v.startswith(want) for v, (_, want) in zip(got, texts, strict=True)), got


def equals_sql(spark, tmp_path, name, pages):
    """The query's rows over (page_id, url, html), which its SQL gives as well."""
    at = str(tmp_path / "pages.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(at)
    df = catalog.QUERIES[name](spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW pages AS SELECT * FROM '{at}/*.parquet'")
    r = c.execute(catalog.ORACLES[name])
    got = [tuple(x) for x in df.collect()]
    assert rows(df.columns, got) == rows([x[0] for x in r.description], r.fetchall())
    return got


SHARED = [(1, "http://a/x", ""), (2, "http://a/x", ""), (3, "http://a/y", ""), (4, "http://a/x", ""), (5, "http://a/x", "")]


def test_resume_with_shared_urls(spark, tmp_path):
    """Pages with the URL of a stored page aren't that page; by id alone, which is its URL's, they are stored."""
    from siltmill.operators import relational

    assert sorted(n for _, n in equals_sql(spark, tmp_path, "d3_q5_resume", SHARED)) == [1, 3, 5]
    p = spark.createDataFrame(SHARED, "page_id long, url string, html string")
    assert [r.page_id for r in relational.unseen(p, p.where("page_id % 2 = 0"), "url").collect()] == [3]


def test_attach_with_shared_urls(spark, tmp_path):
    """Each page has its own thumbnail or none; by URL alone, pages of one URL have the first."""
    from siltmill.operators import relational

    assert sorted((n, t) for n, _, t in equals_sql(spark, tmp_path, "d6_attach", SHARED) if t) == [(2, "http://t/2"), (4, "http://t/4")]
    p = spark.createDataFrame([(n, u, f"http://t/{n}") for n, u, _ in SHARED if n != 3], "page_id long, url string, thumbnail_url string")
    assert {r.thumbnail_url for r in relational.attach(p, p).collect()} == {"http://t/1"}


@pytest.mark.parametrize("name", ["f21_normal_format", "f15_fractions", "f14_tables"])
def test_python_steps_take_bounded_batches(spark, name):
    """A query's Arrow batches have at most 2,000 rows and about 8 MB, unless the session has limits of its own."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType

    @F.pandas_udf(LongType())
    def held(s):
        return s * 0 + s.sum()

    new = spark.newSession()
    catalog.QUERIES[name](new, DIR)
    assert new.range(0, 5000, 1, 1).select(held(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] <= 2000
    wide = F.pandas_udf(lambda s: s.str.len() * 0 + s.str.len().sum(), LongType())
    assert new.range(0, 40, 1, 1).select(wide(F.repeat(F.col("id").cast("string"), 1_000_000)).alias("n")).agg(F.max("n")).first()[0] <= 10_000_000
    own = spark.newSession()
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3000")
    catalog.QUERIES[name](own, DIR)
    assert own.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "3000"


def test_normal_format_is_its_steps(spark):
    """One crossing gives what the three steps give as columns."""
    from pyspark.sql import functions as F

    from siltmill.functions import pytext, regex, text

    texts = ["", " ", "a\tb\n\n\nc", "★ a\u00a0&nbsp; b\t", "漢字 \u3000 x&#8230;&amp;lt;", "\u2003\u2003\u2003\u2003x   y", "\x1c\x85 z😀  °", None]
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select(pytext.normal_format(t).alias("a"), regex.strip(text.normal_spacing(text.remove_pictures(pytext.decode_entities(t)))).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and got[-1].a is None


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["site", "id", "title", "text", "domain", "url"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_frontier_follows_each_sites_pages(spark):
    """A site's own max_pages; null and 0 go on to the fifth empty page in a row, past single empty ones; known URLs leave."""
    from siltmill.plans import pipelines

    page = lambda *names: "<ul>" + "".join(f'<li><a href="/{x}">title of {x}</a></li>' for x in names) + "</ul>"
    html = [(f"http://{s}.x/" + (f"?p={n}" if n > 1 else ""), page(f"{s}{n}")) for s in "abc" for n in (1, 2, 3, 4, 6, 11, 17)]
    pages = spark.createDataFrame([*html, ("http://c.x/?p=5", page())], "url string, html string")
    sites = spark.createDataFrame([(s, f"http://{s}.x/", None, "1", "?p={n}", 1, most) for s, most in (("a", 2), ("b", None), ("c", 0))], "site string, archive_url string, archive_urls array<struct<category:string,archive_url:string>>, pagination_type string, pagination_param string, pagination_increment long, max_pages long")
    known = spark.createDataFrame([("http://b.x/b4",)], "url string")
    got = {r.url.rsplit("/", 1)[1] for r in pipelines.build_frontier(sites, pages, known, "li").collect()}
    assert got == {"a1", "a2", "b1", "b2", "b3", "b6", "b11", "c1", "c2", "c3", "c4", "c6", "c11"}
