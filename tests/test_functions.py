from datetime import date

from pyspark.sql import functions as F

from plumbline.functions import hosts, text, web


def values(spark, *columns, rows=(("x",),), schema="c string"):
    return [tuple(r) for r in spark.createDataFrame(list(rows), schema).select(*columns).collect()]


def test_hosts(spark):
    u = F.col("c")
    rows = [("HTTP://User@Www.Foo.COM:80/a/b?q=1#f",), ("foo.gov",), ("https://foo.gov/",), ("",), (None,), ("https://www2.foo.gov/p/",)]
    got = values(spark, hosts.url_host(u), hosts.url_path(u), hosts.address_key(u), rows=rows)
    assert got == [("www.foo.com", "/a/b", "foo.com/a/b?q=1"), ("foo.gov", "", "foo.gov"), ("foo.gov", "", "foo.gov"), (None, "", None), (None, None, None), ("www2.foo.gov", "/p/", "www2.foo.gov/p")]
    assert values(spark, hosts.strip_www_digits(F.lit("www3.a.b")), hosts.strip_www(F.lit("www3.a.b")), hosts.strip_www(F.lit("www.a.b")), hosts.messy_host(F.lit(" HTTP://www.A.gov:8080/x "))) == [("a.b", "www3.a.b", "a.b", "a.gov")]
    assert values(spark, *(hosts.host_is_valid(F.lit(h), ["gov"]) for h in ("a.gov", "wwww.a.gov", "a.yonkers", "-a.gov", "a")), hosts.host_is_valid(F.lit(None))) == [(True, False, False, False, False, False)]


def test_registered_domain(spark):
    df = spark.createDataFrame([(h,) for h in ("www.a.example", "x.b.co.uk", "foo.ck", "a.foo.ck", "www.ck", "z.www.ck", "com", None, "co.uk")], "host string")
    got = {r.host: r.base_domain for r in hosts.with_base_domain(df, "host", hosts.suffix_rules(spark)).collect()}
    assert got == {"www.a.example": "a.example", "x.b.co.uk": "b.co.uk", "foo.ck": None, "a.foo.ck": "a.foo.ck", "www.ck": "www.ck", "z.www.ck": "www.ck", "com": None, None: None, "co.uk": None}


def test_names(spark):
    lit = F.lit
    assert values(spark, text.norm_name(lit(" A & B--c ")), text.slug(lit("--")), text.slug(lit("A b!")), text.place_key(lit("Town of Mt. Saint Foo")), text.place_key(lit("St. Lawrence County")), text.place_key_suffix(lit("Garden City village"), lit("village")), text.official_name(lit("county"), lit(" Foo ")), text.official_name(lit("town"), lit("Foo"))) == [
        ("a b c", "entity", "a-b", "mountstfoo", "stlawrence", "gardencity", "Foo County", "Town of Foo")
    ]
    g = lambda s: text.classify_government(lit(s))
    got = values(spark, g("Inc. Village of the Bar, NY"), g("Bar County"), g("Bar Police County"), g("County of X"), g("Somebody"))[0]
    assert [tuple(x) if x else None for x in got] == [("village", "Bar"), ("county", "Bar"), None, ("county", "X"), None]
    assert values(spark, text.digit_code(lit("12"), 4), text.digit_code(lit("12345"), 4), text.digit_code(lit("a"), 4), text.partial_date(lit("2020")), text.partial_date(lit("2020-13")), text.partial_date(lit("2020-05-01T10"))) == [("0012", "12345", None, date(2020, 1, 1), None, date(2020, 5, 1))]
    assert values(spark, text.address_line(lit("1 A St"), lit(""), lit("B"), lit(None), lit("1")), text.address_line(*[lit(None).cast("string")] * 5), text.split_multi(lit("a; ;b ")), text.norm_page_name(lit("The Official Website of A & B"))) == [("1 A St, B, 1", None, ["a", "b"], "a and b")]


def test_texts(spark):
    page = "head\n---\nnav\nThis is a long sentence that has more than twelve words and so it counts as prose.\nShare\nmore\n\nSecond para.\nFollow us on X\nzzz"
    got = values(spark, text.extract_prose(F.col("c")), rows=[(page,), ("we’re sorry. gone",), ("",), (None,)])
    assert got[0][0] == "This is a long sentence that has more than twelve words and so it counts as prose. more\n\nSecond para."
    assert [g[0] or "" for g in got[1:]] == ["", "", ""]
    s = text.llms_shape(F.lit("\n# A\n\n> b"))
    assert values(spark, s["h1"], s["summary_blockquote"], text.count_words(F.lit("héllo 12 a1 _")), text.truncated(F.lit(" abc "), 2)["text"], text.truncated(F.lit(None).cast("string"))["truncated"]) == [(True, True, 2, "ab", False)]
    assert values(spark, text.about_link_score(F.lit("about us"), F.lit("about-us")), text.about_link_score(F.lit("news"), F.lit("news")), text.looks_like_html(F.lit("  <!DOCTYPE html>")), text.looks_like_html(F.lit("# x"))) == [(11, 0, True, False)]


def robots(spark, body, asks):
    df = spark.createDataFrame([(body,)], "c string").select(web.parse_robots("c").alias("r"))
    return [r[0] for r in (df.select(web.robots_decision(F.col("r"), F.lit(t), F.lit(p))["decision"]).first() for t, p in asks)]


def test_robots(spark):
    body = "User-agent: A\nUser-agent: b # x\nDisallow: /p\nAllow: /p/open\nSitemap: https://x/s\nContent-Signal: ai=no\nUser-agent: *\nDisallow: /*.pdf$\nUser-agent: a\nDisallow: /q%2f"
    asks = [("a", "/p/x"), ("B", "/p/open/1"), ("c", "/f.pdf"), ("c", "/f.pdf?x"), ("a", "/q%2Fz"), ("a", "/robots.txt"), ("a", "/f.pdf")]
    assert robots(spark, body, asks) == ["disallow", "allow", "disallow", "allow", "disallow", "allow", "allow"]
    assert robots(spark, "User-agent: *\nDisallow: /a\nAllow: /a", [("x", "/a"), ("x", "/")]) == ["allow", "allow"]
    assert robots(spark, None, [("x", "/a")]) == ["allow"]


def test_parsers():
    m = web.read_sitemap(b'<s:urlset xmlns:s="u"><s:url><s:lastmod> 2020 </s:lastmod></s:url><s:url/></s:urlset>')
    assert (m["kind"], m["count"], m["lastmods"]) == ("urlset", 2, ["2020", None])
    import gzip

    assert web.read_sitemap(gzip.compress(b"<sitemapindex><sitemap/></sitemapindex>"))["kind"] == "sitemapindex"
    for bad in (b"", b"<html>", b"\x1f\x8bxx", b"<a/>", None):
        assert web.read_sitemap(bad)["kind"] == "invalid"
    p = web.read_page("<title>T</title><a href=x>un<b>closed")
    assert p["title"] == "T" and p["links"] == [{"href": "x", "text": "unclosed", "hreflang": None}]
    assert web.read_page(None)["text_all"] == ""
    assert web.read_main_text("<nav><p>no</p></nav><p>out</p><main><p>in  it</p><li>x1</li></main>") == "in it\n\nx1"
    assert web.read_link_header('<a>; rel="Alternate"; type=text/markdown, <b>; rel=x')[0] == {"href": "a", "rel": "alternate", "type": "text/markdown"}
