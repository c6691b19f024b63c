from pyspark.sql import functions as F

from quire.functions import urls as U
from quire.plans import queries as Q


def test_parts(one):
    assert one(U.host, "https://WWW.Site.de/a?b") == "www.site.de"
    assert one(U.path, "https://site.de") == "/"
    assert one(U.path, "no address") is None
    assert one(U.slug, "/Alpha/A1 x_y/") == "alpha--a1-x-y"
    assert one(U.slug, "/") == "index"


def test_crawling(one):
    f = lambda p: U.may_crawl(p, ["/alpha", "/beta"], ["/alpha/private"])
    assert one(f, "/alpha/a1") and one(f, "/beta")
    assert not one(f, "/alpha/private/x") and not one(f, "/alphax") and not one(f, None)
    r = lambda p: U.robots_allows(p, [("/a", False), ("/a/b", True), ("", False)])
    assert one(r, "/a/b/c") and not one(r, "/a/x") and one(r, "/z")


def test_links(one, spark):
    assert one(U.resolve, "../x?y", "https://s.de/a/b/") == "https://s.de/a/x?y"
    assert one(U.resolve, "http://[bad", "https://s.de") == "http://[bad"
    assert one(U.resolve, None, "https://s.de") is None
    kinds = [one(U.link_kind, h, a, "https://s.de/p") for h, a in [("#x", "https://s.de/p#x"), ("mailto:a@b", "mailto:a@b"), ("/f.PDF", "https://s.de/f.PDF"), ("/q", "https://s.de/q"), ("https://www.s.de/q", "https://www.s.de/q")]]
    assert kinds == ["anchor", "mailto", "download", "internal", "external"]
    df = spark.createDataFrame([("/alpha/b1/lesen",), ("/blog/x",), ("/",), ("/beta/mock-test",)], "p string")
    c = df.select(U.classify(F.col("p"), {"alpha": "alpha", "beta": "beta"}, {"lesen": "reading"}).alias("c")).collect()
    assert [(r.c.exam, r.c.level, r.c.section, r.c.content_type) for r in c] == [("alpha", "B1", "reading", ["exam-section"]), ("unknown", "unknown", None, ["blog-article"]), ("unknown", "unknown", None, ["landing"]), ("beta", "unknown", None, ["mock-test-info"])]
    assert one(U.sitemap_urls, "<loc> https://a/b </loc><loc>c</loc>") == ["https://a/b", "c"]


def test_addresses_of_many_families(spark, tmp_path):
    books = spark.range(1500).selectExpr("concat('f', lpad(id, 4, '0')) as family", "if(id % 2 = 0, 'A1', 'B1') as level", "concat('b', id) as slug")
    books.write.parquet(str(tmp_path / "collections.parquet"))
    assert Q.book_addresses(spark, str(tmp_path)).where("allowed").count() == 750
