"""Steps of the pipelines over small tables, each result stated in SQL as (step, row)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import web
from plumbline.operators import bases, exporting, inventory, quality, records, resolve, runlog, scoring, verdicts
from plumbline.session import shared_dir
from plumbline.sources import sinks
from plumbline.streaming import state

_L = F.lit


def _rows(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, df in parts:
        one = df.select(_L(name).alias("step"), F.to_json(F.struct(*df.columns)).alias("row"))
        out = one if out is None else out.unionByName(one)
    return out


def _stated(rows: list[tuple[str, str]]) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return "select step, row from (values " + ", ".join(f"({q(s)}, {q(r)})" for s, r in rows) + ") v(step, row)"


def joining_steps(spark: SparkSession, d: str) -> DataFrame:
    t = spark.createDataFrame
    decided = t([("u1", "a.example", "primary"), ("u2", None, "no_lead")], "unit_id string, host string, outcome string")
    scans = t([("e1", "town", "rye", "Town of Rye, New York", "www.rye.example", "rye.example", "content"), ("e2", "town", "ry", "Welcome to Rye", "other.example", "other.example", "content"), ("e3", "town", "ossining", "Ossining", "o.example", "o.example", "near_empty")], "entity_id string, level string, place string, title string, final_host string, base_domain string, body_class string")
    places = t([("town", "rye"), ("city", "rye"), ("town", "ossining")], "level string, place string")
    checks, outcomes = exporting.confirm_websites(scans, places, t([("x.example",)], "host string"))
    items = t([(1, '{"url":"https://www.bad.example/x","note":"see good.example there"}'), (2, '{"urls":["ok.example"]}')], "item_id int, payload string")
    pages = t([("https://a.example/x", "A", "a", "s1", 1), ("https://a.example/x", "B", "b", "s2", 2)], "url string, name string, entity_id string, source string, seq int")
    addresses = t([("https://a.example/x",), ("https://a.example/y/",), ("https://a.example/",)], "address string")
    bindings = t([("http://w/Q1", "One", None, "https://one.example"), ("http://w/Q2", "Two", "Zwei", None), ("http://w/Q3", "Nobody", None, "https://none.example")], "item string, itemLabel string, altLabel string, website string")
    entities = t([("e1", "First", "F", [("Old First", None)], "nyc", "agency", "active", [("one.example", "primary")]), ("e2", "Two", None, [], "nyc", None, "dissolved", [])], "id string, name string, short_name string, other_names array<struct<name:string,note:string>>, government_level string, classification string, status string, web_properties array<struct<domain:string,role:string>>")
    repoints = t([("e1", "Q1", "Q9", 1)], "entity_id string, reject string, target string, seq int")
    officers = t([("First", "", "S", "https://new.example", "212", "1 Main", 1), ("First", "", "S", "https://new.example", None, None, 2), ("Nowhere", None, None, None, None, None, 3)], "agency_name string, acronym string, section string, website string, phone string, address string, seq int")
    units = t([(1, "town", "Town of Rye", "Westchester"), (2, "town", "Town of Ames", "Lewis"), (3, "village", "Village of Rye", "Westchester")], "unit_id int, tier string, name string, county string")
    its = t([(11, "town", "Rye", "Westchester", None, "100"), (12, "town", "Ames", "Oneida", "Lewis", "200")], "right_id int, tier string, name string, county string, second_county string, code string")
    leads = t([("town", "Rye", "dotgov", "rye.example", ""), ("town", "Rye", "listing", "rye.example", "")], "tier string, name string, source string, host string, path string")
    located, review = records.locality_pipeline(units, its, leads, t([("taken.example",)], "host string"))
    old = t([("L1", "One Board", "OB", "city", "board", None, ["L2"], {"x": "9"}, [], ["gone"], "1999", None), ("L2", "Two", None, "city", "board", "L1", [], {}, ["L1"], [], None, None)], "legacy_id string, name string, short_name string, level string, entity_type string, parent_id string, child_ids array<string>, crosswalk map<string,string>, succeeds_ids array<string>, succeeded_by_ids array<string>, valid_from string, valid_to string")
    ids = records.id_map(old, t([("L2", "two-given")], "legacy_id string, id string"))
    minted = resolve.mint_ids(t([("Rye", 1), ("rye!", 2), ("Rye", 3), ("", 4)], "name string, seq int"), "name", "seq", t([("rye",), ("rye-3",)], "id string"))
    sites = t([("a.example", ["a", "b"], ["https://a.example/x", "https://a.example/gone"])], "host_key string, ids array<string>, page_urls array<string>")
    no = t([("https://a.example/gone", "gone", None)], "url string, issue string, moved_to string")
    return _rows([
        ("checks", resolve.apply_checks(decided, t([("u2", "b.example"), ("u1", "c.example")], "unit_id string, host string"))), ("confirmed", checks), ("confirm counts", outcomes), ("leads", resolve.leads_not_owned(t([(1, "a.example"), (2, "b.example")], "id int, host string"), t([("a.example",)], "key string"))),
        ("marked", resolve.tag_marked(items, "payload", t([("bad.example",), ("good.example",)], "host string")).select("item_id", "marked_hosts")), ("owners", inventory.page_owners(pages)), ("pages", inventory.page_targets(addresses, t([("a.example/y",)], "page_key string"), t([("www.a.example",), ("a.example",)], "host string")).select("address", "pace_host")),
        ("log owner", inventory.owner_of(t([("a.example", "A")], "domain string, owner string"), t([("b.example", "B"), ("b.example", "B"), ("c.example", "B"), ("c.example", "C")], "domain string, owner string"), t([("x.a.example", "a.example"), ("x.b.example", "b.example"), ("x.c.example", "c.example")], "name string, domain string"))),
        ("log names", inventory.names_from_log(t([("a.example", "*.a.example\\nshop.a.example".replace("\\n", "\n"), "A.example")], "domain string, name_value string, common_name string"))), ("kept", inventory.kept_names(t([("n", "b", 2), ("n", "a", 1), ("t", "a", 3)], "name string, domain string, seq int"), t([("t",)], "name string"))),
        ("registered", inventory.registered_domains(t([("a.example",), ("a.example",), (None,)], "b string"), "b")), ("wikidata", records.wikidata_pipeline(bindings, entities, repoints).select("cand_id", "decision", "code")), ("greenbook", records.greenbook_pipeline(officers, entities, "nyc").select("agency_name", "bucket", "entity_id", "legacy_domain", "row_count")),
        ("localities", located.select("unit_id", "id", "code", "primary_host")), ("locality review", review), ("ids", ids), ("migrated", records.migrate(old, ids, {"x": "scheme_x"}, "legacy").select("id", "parent_id", "child_ids", "identifiers")), ("minted", minted.select("seq", "id")),
        ("listed pages", bases.listed_page_targets(sites, pages, t([("https://a.example/z", 9)], "url string, seq int"), no).select("url", "names")), ("cells", bases.text_cells(t([(" 01 ", "a"), (" ", "")], "code string, name string"), ["code", "name"])), ("batch", resolve.check_batch(t([("r1", 1, "First", [], "e9", None, False), ("r2", 2, "First", [], None, "e1", False)], "rec_id string, seq int, name string, pairs array<struct<scheme:string,identifier:string>>, match_entity_id string, mint_id string, expect_new boolean"), t([("e1", 1, "First", [])], "id string, ord int, name string, pairs array<struct<scheme:string,identifier:string>>"))),
    ])


_JOINED = [
    ("checks", '{"unit_id":"u1","host":"c.example","outcome":"checked","conflict":true}'), ("checks", '{"unit_id":"u2","host":"b.example","outcome":"checked","conflict":false}'), ("confirmed", '{"unit_id":"e1","host":"rye.example"}'), ("confirm counts", '{"outcome":"confirmed","n":1}'), ("leads", '{"host":"b.example","id":2}'),
    ("marked", '{"item_id":1,"marked_hosts":["bad.example"]}'), ("marked", '{"item_id":2}'), ("owners", '{"url":"https://a.example/x","names":["A","B"],"entity_ids":["a","b"],"sources":["s1","s2"]}'), ("pages", '{"address":"https://a.example/x","pace_host":"www.a.example"}'),
    ("log owner", '{"name":"x.a.example","domain":"a.example","owner":"A"}'), ("log owner", '{"name":"x.b.example","domain":"b.example","owner":"B"}'), ("log owner", '{"name":"x.c.example","domain":"c.example"}'), ("log names", '{"domain":"a.example","name":"shop.a.example"}'), ("log names", '{"domain":"a.example","name":"a.example"}'), ("kept", '{"name":"n","domain":"a"}'),
    ("registered", '{"domain":"a.example"}'), ("wikidata", '{"cand_id":"Q1","decision":"repointed","code":"Q9"}'), ("wikidata", '{"cand_id":"Q2","decision":"proposal","code":"Q2"}'), ("wikidata", '{"cand_id":"Q3","decision":"unmatched","code":"Q3"}'),
    ("greenbook", '{"agency_name":"First","bucket":"attach","entity_id":"e1","legacy_domain":"new.example","row_count":2}'), ("greenbook", '{"agency_name":"Nowhere","bucket":"unmatched","row_count":1}'),
    ("localities", '{"unit_id":1,"id":"town-of-rye","code":"100","primary_host":"rye.example"}'), ("localities", '{"unit_id":2,"id":"town-of-ames","code":"200"}'), ("localities", '{"unit_id":3,"id":"village-of-rye"}'), ("locality review", '{"subject":"3","reason":"no_match"}'),
    ("ids", '{"legacy_id":"L2","id":"two-given"}'), ("ids", '{"legacy_id":"L1","id":"ob"}'), ("migrated", '{"id":"ob","child_ids":["two-given"],"identifiers":[{"scheme":"legacy","identifier":"L1"},{"scheme":"scheme_x","identifier":"9"}]}'), ("migrated", '{"id":"two-given","parent_id":"ob","child_ids":[],"identifiers":[{"scheme":"legacy","identifier":"L2"}]}'),
    ("minted", '{"seq":1,"id":"rye-2"}'), ("minted", '{"seq":2,"id":"rye-4"}'), ("minted", '{"seq":3,"id":"rye-5"}'), ("minted", '{"seq":4,"id":"entity"}'), ("listed pages", '{"url":"https://a.example/x","names":["A","B"]}'), ("listed pages", '{"url":"https://a.example/z"}'), ("cells", '{"code":"01","name":"a"}'),
    ("batch", '{"rec_id":"r1","problem":"unknown entity"}'), ("batch", '{"rec_id":"r2","problem":"id in use"}'), ("batch", '{"rec_id":"r2","problem":"name in use"}'),
]


def running_steps(spark: SparkSession, d: str) -> DataFrame:
    t = spark.createDataFrame
    links = t([("p", 2, 5, "b"), ("p", 1, 1, "c"), ("p", 1, 9, "a")], "page string, depth int, score int, url string")
    log = t([("h", k, s) for k, s in enumerate((403, 403, 403, 403, 200))] + [("g", 9, 403)], "host string, seq int, status int")
    rules = t([("g", "allow", "/a/b"), ("g", "disallow", "/a"), ("h", "allow", "/x"), ("h", "disallow", "/y")], "g string, kind string, path string")
    results = t([("h", "W1", "research", "pass", 1, "https://h/", "e"), ("h", "W4", "gptbot", "fail", 2, None, None), ("g", "W4", "all_ai", "fail", 3, None, None)], "host string, test string, identity string, verdict string, seq int, page_url string, entity_id string")
    review = t([("b", "x", "r"), ("a", None, "q")], "section string, subject string, reason string")
    base = f"{shared_dir(spark)}/plumbline/{uuid.uuid4().hex}"
    sinks.append_unit(t([(1,)], "v int"), f"{base}/units", "run", "u1")
    sinks.append_unit(t([(2,)], "v int"), f"{base}/units", "run", "u1")
    sinks.append_unit(t([(3,)], "v int"), f"{base}/units", "run", "u2")
    sinks.write_twins(t([("b", True, ["x", "y"], None), ("a", False, [], 1)], "k string, f boolean, l array<string>, n int"), f"{base}/twins", ["k", "f", "l", "n"], ["k"])
    report = sinks.markdown_table(t([("a", None)], "k string, v string"), 5)
    same = verdicts.same_host_links(_L("https://a.example/"), F.array(*map(_L, ("https://a.example/x#f", "https://b.example/", "https://a.example/x", "https://a.example/", "mailto:x"))))
    sm = web.parse_sitemap(F.encode(_L("<sitemapindex><sitemap><loc>https://a.example/1.xml</loc></sitemap></sitemapindex>"), "utf-8"))
    asked = t([("h", 1, 0.0), ("h", 2, 1.0), ("h", 3, 60.0)], "host string, seq long, t double").select("host", "seq", F.timestamp_seconds("t").alias("asked"))
    asked.write.parquet(f"{base}/asked")
    ready = state.run_to_end(state.ready_stream(state.read_stream(spark, f"{base}/asked", asked.schema), 30.0))
    crawler = t([("Co", "Bot", "yes", "Bot/1", "https://x.example", "2026-01-01", "train", None), ("Co", "Ant", "maybe", "", "", "x", "train", None)], "company string, name string, send string, ua_exact string, doc_url string, checked string, purpose string, reason_not_sent string")
    return _rows([
        ("ranking", runlog.about_ranking(links, "page").select("url", "rank")), ("refusing", exporting.refusing_hosts(log)), ("best rule", exporting.best_rule(rules, "g")), ("pages", exporting.page_rows(results)), ("visited", exporting.hosts_visited(results)), ("identities", spark.range(1).select(_L(",".join(scoring.identities_of(results, ["research"]))).alias("ids"))),
        ("review", exporting.review_order(review, {"a": 1, "b": 0}).limit(1)), ("only", exporting.only_hosts(log, t([("g",)], "host string"))), ("load", spark.range(1).select(_L(str(exporting.split_by_load({"a": 3, "b": 2, "c": 2}, 2))).alias("split"))), ("units", spark.read.parquet(f"{base}/units").select("unit", "v")),
        ("twins csv", spark.read.option("header", True).csv(f"{base}/twins/csv")), ("twins json", spark.read.schema("k string, f boolean").json(f"{base}/twins/json")), ("report", spark.range(1).select(_L(report).alias("text"))), ("links", spark.range(1).select(same.alias("urls"))), ("sitemap", spark.range(1).select(sm["kind"].alias("kind"), sm["count"].alias("n"))),
        ("ready", ready), ("queue", exporting.queue_lines(t([(1, "e", "open", None)], "status_rank int, id string, status string, note string"))), ("rewritten", exporting.rewrite_descriptions(t([("a", 1), ("b", 1)], "id string, v int"), t([("b", 2)], "id string, v int"))), ("plan", exporting.candidate_plan(t([("a", "https://a.example/")], "id string, start_url string"), ["/about"], 2)),
        ("crawler problems", quality.violations(crawler, "name", records.crawler_rules())), ("stale", spark.range(1).select(_L(quality.is_stale("a\ngenerated 1", "a\ngenerated 2")).alias("stale"), _L(quality.is_stale("a", "b")).alias("changed"))), ("captured", spark.range(1).select(records.description_record(_L("fetch_failed"), _L("x"))["status"].alias("status"))),
    ])


_RAN = [
    ("ranking", '{"url":"a","rank":1}'), ("ranking", '{"url":"c","rank":2}'), ("ranking", '{"url":"b","rank":3}'), ("refusing", '{"host":"h","at":3}'), ("best rule", '{"g":"g","kind":"allow","path":"/a/b"}'), ("best rule", '{"g":"h","kind":"allow","path":"/x"}'), ("pages", '{"page_url":"https://h/","host":"h","entity_id":"e","seq":1}'),
    ("visited", '{"host":"h"}'), ("visited", '{"host":"g"}'), ("identities", '{"ids":"gptbot"}'), ("review", '{"section":"b","subject":"x","reason":"r"}'), ("only", '{"host":"g","seq":9,"status":403}'), ("load", "{\"split\":\"[['a'], ['b', 'c']]\"}"), ("units", '{"unit":"u1","v":2}'), ("units", '{"unit":"u2","v":3}'),
    ("twins csv", '{"k":"a","f":"FALSE","n":"1"}'), ("twins csv", '{"k":"b","f":"TRUE","l":"x,y"}'), ("twins json", '{"k":"a","f":false}'), ("twins json", '{"k":"b","f":true}'), ("report", '{"text":"| k | v |\\n|---|---|\\n| a |  |"}'), ("links", '{"urls":["https://a.example/x"]}'), ("sitemap", '{"kind":"sitemapindex","n":1}'),
    ("ready", '{"host":"h","seq":1,"ready_at":0.0}'), ("ready", '{"host":"h","seq":2,"ready_at":30.0}'), ("ready", '{"host":"h","seq":3,"ready_at":60.0}'), ("queue", '{"n":1,"line":"| `e` | open |  |"}'), ("rewritten", '{"id":"a","v":1}'), ("rewritten", '{"id":"b","v":2}'), ("plan", '{"id":"a","rank":0,"url":"https://a.example/about"}'),
    ("crawler problems", '{"key":"Ant","problem":"send unknown"}'), ("crawler problems", '{"key":"Ant","problem":"checked is no date"}'), ("stale", '{"stale":false,"changed":true}'), ("captured", '{"status":"fetch_failed"}'),
]

QUERIES = {f.__name__: f for f in (joining_steps, running_steps)}
ORACLE = {"joining_steps": _stated(_JOINED), "running_steps": _stated(_RAN)}
