from siltmill.operators.dom import parse, select, selector
from siltmill.operators.extract import article, author, body, items, published

import pytest


def test_unclosed_paragraphs_nest():
    assert body("<article><p>one<p>two</article>", "", None, "article p", [])[1] == "one two two"


def test_prune_by_part_of_class_and_id():
    page = '<div class="navbar">n</div><div id="nav">i</div><div class="share">s</div><p>text</p>'
    assert body(page, "", None, None, ["nav"])[1] == "text"
    assert body(page, "", None, None, [])[1] == "n i s text"


def test_images_and_scripts():
    page = '<img src="a.png"><script>x</script><p>t<img data-src="/b.png"></p>'
    assert body(page, "http://h/d/", "img", None, None) == ("http://h/d/a.png", "[IMAGE : http://h/d/a.png] t [IMAGE : http://h/b.png]")
    assert body(None, None, None, None, None) == ("", "")


def test_article_titles():
    assert article("<title>tiny</title><h1>A real title</h1><div class=c>x &amp; y<br></div>", ".c") == ("A real title", '<div class="c">x &amp; y<br/></div>')
    assert article("<p>x</p>", ".c") is None
    assert article("<p>x</p>", "//div") == (None, None)
    assert article(None, ".c") is None
    assert article('<meta property="og:title" content="From graph"><h2>a long heading</h2><b class=c></b>', ".c")[0] == "From graph"


def test_items():
    page = '<li><a href="/1">one</a></li><li>no link</li><li><h2>A longer title</h2><a href="2">x</a><img src="" data-src="t.png"></li>'
    assert items(page, "http://h/a/", "li", "img") == [("http://h/1", "one", None), ("http://h/a/2", "A longer title", "http://h/a/t.png")]
    assert items(page, "http://h/", "li >") == []


def test_date_and_author():
    assert published('<span class="date">on 2024-01-02</span>') == "on 2024-01-02"
    assert published('<time datetime="2024-01-02T03:04:05">x</time>') == "2024-01-02T03:04:05"
    assert published("<p>x</p>") is None
    assert author('<meta name="author" content=" A  B ">') == "A B"


@pytest.mark.parametrize("css, n", [("p", 3), ("div > p", 2), ("div p", 3), ("p:first-child", 2), ("p + p", 1), (".a.b", 1), ('[data-x*="ell"]', 1), ("#q, .a", 2), ("section > p", 1), ("*", 5)])
def test_selectors(css, n):
    root = parse('<div><p class="a b">1</p><p id="q">2</p><section><p data-x="hello">3</p></section></div>')
    assert len(select(root, css)) == n


@pytest.mark.parametrize("css", ["", "a >", "> a", "a[b", "//x", "a,,b", ".1a"])
def test_bad_selectors(css):
    with pytest.raises(ValueError):
        selector(css)
