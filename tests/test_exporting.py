import json

from pyspark.sql import functions as F

from plumbline.functions import hosts
from plumbline.operators import exporting as X


def one(spark, *c):
    return tuple(spark.range(1).select(*c).first())


def test_small_rules(spark):
    lit = F.lit
    assert one(spark, X.board_entity(lit("bk08")), X.board_entity(lit("XX1")), X.site_slug(lit("/site/dob/about")), X.html_slug(lit("/x")), X.page_kind(lit("https://a/robots.txt")), X.as_chrome(lit("HeadlessChrome/1"))) == ("brooklyn-community-board-8", None, "dob", None, "robots", "Chrome/1")
    ok, bad, no = (X.lookup_data(lit(s)) for s in ('{"status":"ok","data":{"ip":"1"}}', '{"status":"down"}', "x"))
    assert one(spark, ok["data"], ok["problem"], bad["problem"], no["problem"]) == ('{"ip":"1"}', None, "status down", "no JSON")
    assert one(spark, X.names_overlap(F.array(lit("A b")), F.array(lit("x"), lit("a-B"))), X.names_overlap(F.array(lit("")), F.array(lit("")))) == (True, False)
    assert X.split_by_load({"a": 5, "b": 4, "c": 3, "d": 3}, 2) == [["a", "d"], ["b", "c"]]
    assert one(spark, X.divergent_list(lit(False), lit(None).cast("array<string>")), X.divergent_list(lit(True), lit(None).cast("array<string>")), X.owner_name(F.array(lit("n")), F.array(lit("a"), lit("b")))) == (None, [], None)


def test_evidence_and_rules(spark):
    ev = lambda **k: json.dumps(k)
    rows = [("h", "W1", "pass", ev(status=200), 1), ("h", "W1", "fail", ev(status=404), 2), ("h", "I2", "partial", ev(title="", site_name="S"), 3), ("h", "R3", "reported", ev(landmarks=["main"]), 4), ("g", "M2", "fail", ev(count=None), 5)]
    df = spark.createDataFrame(rows, "host string, test string, verdict string, evidence string, seq int")
    got = {r.host: r for r in X.evidence_columns(df).collect()}
    assert (got["h"].robots_status, got["h"].og_title, got["h"].og_site_name, got["h"].has_main) == (200, None, "S", True)
    assert got["g"].robots_status is None and got["g"].has_main is None
    rules = spark.createDataFrame([("a", "disallow", "/x"), ("a", "allow", "/x"), ("b", "disallow", "/xy"), ("b", "allow", "/x")], "g string, kind string, path string")
    assert {r.g: r.kind for r in X.best_rule(rules, "g").collect()} == {"a": "allow", "b": "disallow"}
    assert [r.rule for r in X.top_level_rules(hosts.suffix_rules(spark)).orderBy("rule").collect()] == ["com", "example", "gov", "net", "org", "uk"]
    log = spark.createDataFrame([("a", i, 403) for i in range(4)] + [("b", i, 403 if i != 2 else 200) for i in range(5)], "host string, seq int, status int")
    assert [tuple(r) for r in X.refusing_hosts(log).collect()] == [("a", 3)]


def test_confirmed_websites(spark):
    scans = [("e1", "town", "rye", "Town of Rye", "www.rye.gov", "rye.gov", "content"), ("e2", "city", "rye", "Rye", "ryecity.gov", "ryecity.gov", "content"), ("e3", "village", "foo", "Foo", "shared.gov", "shared.gov", "content"), ("e4", "village", "bar", "Bar", "shared.gov", "shared.gov", "content"), ("e5", "village", "baz", "Baz", "owned.gov", "owned.gov", "content"), ("e6", "village", "qux", "Qux", "qux.gov", "qux.gov", "near_empty"), ("e7", "village", "zip", "Zip", "x.zip.gov", "zip.gov", "content")]
    df = spark.createDataFrame(scans, "entity_id string, level string, place string, title string, final_host string, base_domain string, body_class string")
    places = spark.createDataFrame([(s[1], s[2]) for s in scans], "level string, place string")
    checks, counts = X.confirm_websites(df, places, spark.createDataFrame([("www.owned.gov",)], "host string"))
    assert [tuple(r) for r in checks.collect()] == [("e1", "rye.gov")]
    assert {r.outcome: r.n for r in counts.collect()} == {"confirmed": 1, "host_shared": 2, "host_owned": 1}
