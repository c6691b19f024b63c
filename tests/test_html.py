from pyspark.sql import functions as F

from quire.operators import html as H

from .conftest import rows

PAGE = """<html lang="de"><head><title> A  B </title><meta property="og:title" content="og"><meta name="Description" content="d1"><meta name="description" content="d2">
<link rel="canonical" href="https://s.de/x"><script>var t="</p>"</script></head><body><nav><a href="/nav">n</a><p>no</p></nav>
<article><h2>Kopf</h2><p>eins <b>zwei<p>drei<ul><li>a<ul><li>b</ul><li></li><li>c</ul>
<div role="banner"><p>no</p></div><div aria-hidden="true"><p>no</p></div><div><p>drei</p></div>
<table><caption>C</caption><thead><tr><th>H<th>I</thead><tbody><tr><td>1<td>2<tr><td> <td></tbody></table>
<figure><img data-src="f.png" alt="alt"><figcaption>cap</figcaption></figure><audio><source src="a.mp3"></audio>
<blockquote cite="c">q</blockquote><pre>x  \r\ny</pre><img src="i.png"><img alt="none"><a href="#top">up</a><p>  </p></article><footer>f</footer>"""


def test_nodes_assets_metadata(spark):
    pages = spark.createDataFrame([(1, PAGE, "clash"), (2, None, ""), (3, "", ""), (4, "<p>cut", "")], "page_id int, html string, type string")
    n = H.nodes(pages)
    got = [(r.ord, r.type, r.text) for r in n.where("page_id = 1").orderBy("ord").collect()]
    assert got == [
        (0, "heading", "Kopf"), (1, "paragraph", "eins zwei"), (2, "paragraph", "drei"), (3, "list", None), (4, "paragraph", "drei"),
        (5, "table", None), (6, "figure", None), (7, "media", None), (8, "quote", "q"), (9, "code", "x\ny"), (10, "image", None),
    ]
    assert rows(n.where("page_id > 1").select("page_id", "text")) == [(4, "cut")]
    t = n.where("type = 'table'").first()
    assert (t.headers, t.rows, t.caption) == ([["H", "I"]], [["1", "2"]], "C")
    assert n.where("type = 'list'").first().items_json == '[{"text": "ab", "children": [{"text": "b"}]}, {"text": "c"}]'
    a = H.assets(pages).where("page_id = 1")
    assert rows(a.select("type", "src", "href")) == [("image", "f.png", None), ("image", "i.png", None), ("link", None, "#top"), ("media", "a.mp3", None)]
    m = H.metadata(pages).where("page_id = 1").first()
    assert (m.title, m.canonical, m.lang, m.description) == ("A B", "https://s.de/x", "de", "d2")


def test_clean_and_render(spark):
    n = H.clean(H.nodes(spark.createDataFrame([(1, PAGE), (2, "<img src=x>")], "page_id int, html string")))
    assert n.where("page_id = 1 and text = 'drei'").count() == 1
    c = {r.page_id: r for r in H.counts(n).collect()}
    assert (c[1].paragraph, c[1].incomplete, c[2].incomplete) == (2, False, True)
    d = {r.page_id: r for r in H.documents(n).collect()}
    assert (d[1].words, d[1].status, d[2].status) == (1 + 2 + 1 + 2 + 2 + 1, "verified", "failed")
    assert "## Kopf\n\neins zwei\n\ndrei\n\n- ab\n  - b\n- c\n\n*C*\n\n| H | I |\n| --- | --- |\n| 1 | 2 |\n\n![cap](f.png)\n*cap*\n\n[audio](a.mp3)\n\n> q\n\n```\nx\ny\n```" in d[1].markdown
    assert d[2].markdown == "![](x)\n"


def test_long_and_deep_pages(spark):
    deep = "<div>" * 3000 + "<p>x</p>" + "</div>" * 3000
    long = "<p>" + "wort " * 100_000
    out = H.nodes(spark.createDataFrame([(1, deep), (2, long)], "page_id int, html string"))
    assert rows(out.select("page_id", F.length("text"))) == [(1, 1), (2, 499_999)]
