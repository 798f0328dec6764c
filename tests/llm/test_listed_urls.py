"""Listed URLs of single pages."""

from quire.llm.url_filter import filtered


def test_a_listed_page_is_blocked(spark):
    urls = ["http://example.org/page.html", "http://www.example.org/page.html?q=1", "http://example.org/page.html/x", "http://example.org/page.htm", "http://example.org/a/b/c.html", "http://example.org/a/b/", "http://example.org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("example.org/page.html",), ("example.org/a/b/c.html",)], "entry string")
    got = {r["page_id"]: r["verdict"] for r in filtered(pages, listed).collect()}
    assert got == {k: "block" if k in (0, 1, 4) else "allow" for k in range(len(urls))}


def test_entries_and_urls_are_made_canonical_alike(spark):
    listed = ["https://www.Bad.org:443/", "x.org/~user/", "x.org/a/%62/../c/", "Page.org./One%2fTwo.html?q=1#f", "whole.org", "x.org/./p.html", "/nothing", "", None]
    blocked = ["http://bad.org/", "http://user@BAD.org:8080/x", "http://x.org/%7Euser/y", "http://x.org/~user/", "http://x.org/b/../%7euser/", "http://x.org/a/c/d", "http://www.page.org/One%2FTwo.html#g", "http://a.whole.org", "http://x.org/z/../p.html", "http://x.org/a/../../a/c/."]
    clean = ["http://x.org/user/", "http://page.org/One/Two.html", "http://page.org/one%2Ftwo.html", "http://x.org/a/", "http://x.org/p.htm", "http://x.org/a/%zz/", "http://x.org/%", "http://nothing/"]
    pages = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(blocked + clean)], "page_id long, url string, _u_rule string")
    rows = filtered(pages, spark.createDataFrame([(x,) for x in listed], "entry string"), rules=()).orderBy("page_id").collect()
    assert [r["verdict"] for r in rows] == ["block"] * len(blocked) + ["allow"] * len(clean) and {r["_u_rule"] for r in rows} == {"mine"}
    tiny = filtered(pages, spark.createDataFrame([(x,) for x in listed], "entry string"), rules=(), bits=1, most=1).orderBy("page_id").collect()
    assert tiny == rows  # a filter that lets nearly all pass changes nothing
