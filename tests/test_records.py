from pyspark.sql import functions as F

from plumbline.operators import quality, records


def test_governance(spark):
    rows = [("G1", " Foo Dept ", "FD", "https://www.foo.gov/x", "Active", "Agency", "Old Foo; Foo2 ", ""), ("G2", "Gone", None, None, "Dissolved", None, None, None), ("", "Bare", " ", "", "active", "", None, None)]
    df = spark.createDataFrame(rows, "record_id string, name string, acronym string, url string, operational_status string, organization_type string, alternate_or_former_names string, alternate_or_former_acronyms string")
    got = {r.name: r for r in records.governance_records(df).collect()}
    assert set(got) == {"Foo Dept", "Bare"}
    f = got["Foo Dept"]
    assert [o.name for o in f.other_names] == ["FD", "Old Foo", "Foo2"] and f.web_properties[0].domain == "www.foo.gov" and f.identifiers[0].identifier == "G1"
    assert got["Bare"].identifiers == [] and got["Bare"].web_properties == [] and got["Bare"].short_name is None


def test_pipelines(spark):
    ents = spark.createDataFrame([("foo", "Foo Dept", "FD", [("Foo Office", "x")], "nyc", [("foo.gov", "primary")]), ("bar", "Bar", None, None, "city", None)], "id string, name string, short_name string, other_names array<struct<name:string,note:string>>, government_level string, web_properties array<struct<domain:string,role:string>>")
    rows = [("Foo Office", None, "s", "http://old.foo.org", "1", "a", 1), ("Foo Office", "", "s", "http://old.foo.org", "2", "b", 2), ("Foo Office", None, "t", "http://x.org", "2", "b", 3), ("Bar", None, None, None, None, None, 4), ("Zed", None, None, None, None, None, 5), ("", None, None, None, None, None, 6)]
    df = spark.createDataFrame(rows, "agency_name string, acronym string, section string, website string, phone string, address string, seq int")
    got = {r.agency_name: r for r in records.greenbook_pipeline(df, ents, "nyc").collect()}
    assert {k: (v.bucket, v.reason) for k, v in got.items()} == {"Foo Office": ("attach", "exact"), "Bar": ("review", "cross_government_level"), "Zed": ("unmatched", "no_match")}
    f = got["Foo Office"]
    assert f.row_count == 3 and f.legacy_domain == "old.foo.org" and [c.value for c in f.contact_details] == ["b", "2"]
    b = spark.createDataFrame([("http://w/Q1", "Foo", "F", "https://www.foo.gov/"), ("http://w/Q1", "Foo", "G", None), ("http://w/Q2", "bar", None, None), ("http://w/Q3", "z", None, None)], "item string, itemLabel string, altLabel string, website string")
    rep = spark.createDataFrame([("bar", "Q2", "Q9", 1)], "entity_id string, reject string, target string, seq int")
    out = {r.cand_id: (r.decision, r.reason, r.code) for r in records.wikidata_pipeline(b, ents, rep).collect()}
    assert out == {"Q1": ("auto", "distinctive_domain", "Q1"), "Q2": ("repointed", "exact_name", "Q9"), "Q3": ("unmatched", "no_match", "Q3")}


def test_localities(spark):
    units = spark.createDataFrame([(1, "town", "Foo", "A"), (2, "town", "Foo", "B"), (3, "city", "Bar", "A")], "unit_id int, tier string, name string, county string")
    state = spark.createDataFrame([(10, "town", "Town of Foo", "A", None, "c1"), (11, "town", "Foo", "C", "B", "c2"), (12, "city", "Bar", "A", None, "c2")], "right_id int, tier string, name string, county string, second_county string, code string")
    leads = spark.createDataFrame([("city", "Bar", "x", "bar.gov", ""), ("city", "Bar", "y", "bar.gov", ""), ("town", "Foo", "x", "foo.gov", "")], "tier string, name string, source string, host string, path string")
    out, review = records.locality_pipeline(units, state, leads, spark.createDataFrame([], "host string"))
    assert {r.unit_id: (r.id, r.code, r.primary_host) for r in out.collect()} == {1: ("foo-a", "c1", None), 2: ("foo-b", None, None), 3: ("bar", None, "bar.gov")}
    assert sorted((r.subject, r.reason) for r in review.collect()) == [("c2", "code_shared_by_places")]


def test_migration(spark):
    old = spark.createDataFrame([("L1", "Foo", None, "city", "x", None, ["L2", "L9"], {"a": "1", "b": ""}, ["L2"], ["L8"], "1900", None), ("L2", "Foo", "F", "city", "x", "L1", [], {}, [], [], None, None)], "legacy_id string, name string, short_name string, level string, entity_type string, parent_id string, child_ids array<string>, crosswalk map<string,string>, succeeds_ids array<string>, succeeded_by_ids array<string>, valid_from string, valid_to string")
    ids = records.id_map(old, spark.createDataFrame([("L1", "foo-main")], "legacy_id string, id string"))
    assert {r.legacy_id: r.id for r in ids.collect()} == {"L1": "foo-main", "L2": "f"}
    got = {r.id: r for r in records.migrate(old, ids, {"a": "sa", "b": "sb"}, "legacy").collect()}
    m = got["foo-main"]
    assert m.child_ids == ["f"] and [(x.type, x.target_id) for x in m.relations] == [("successor_of", "f"), ("predecessor_of", "L8")]
    assert [(p.scheme, p.identifier) for p in m.identifiers] == [("legacy", "L1"), ("sa", "1")] and got["f"].parent_id == "foo-main"


def test_crawlers(spark):
    rows = [("A-Bot", "yes", "x W.X.Y.Z A-Bot || A-Bot/1", "https://a", "c", "p", "2026-01-01", None), ("B", "yes", "token-only", "https://b", "c", "p", "2026-01-01", None), ("C", "rules-only", "", None, "c", "p", "bad", ""), ("(none)", "rules-only", None, None, "c", "p", "2026-01-01", "absent"), ("D", "yes", "D W.X.Y.Z", "http://d", "c", None, "2026-01-01", None)]
    df = spark.createDataFrame(rows, "name string, send string, ua_exact string, doc_url string, company string, purpose string, checked string, reason_not_sent string")
    got = {r.name: (r.key, r.label, r.label_kind, r.sent) for r in records.crawler_identities(df).collect()}
    assert got["A-Bot"] == ("a_bot", "A-Bot/1", "published", True) and got["B"] == ("b", "B", "token-only", True) and not got["C"][3] and not got["D"][3]
    bad = sorted((r.key, r.problem) for r in quality.violations(df, "name", records.crawler_rules()).collect())
    assert bad == [("C", "checked is no date"), ("C", "rules-only without a reason"), ("D", "company, name and purpose needed"), ("D", "sent without a company page")]
    d = records.description_record(F.lit("found"), F.lit("x " * 50))
    assert tuple(spark.range(1).select(d["status"], d["truncated"]).first()) == ("ok", False)
    assert {r.status: r.n for r in records.coverage(spark.createDataFrame([("no_url",)], "status string")).collect()} == {"ok": 0, "no_url": 1}
