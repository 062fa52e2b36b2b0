"""Rules on single values, each met with cases whose results are stated in SQL; readers, records and exports over small
tables and over the registry."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import hosts, text, web
from plumbline.operators import bases, exporting, records, runlog, scoring, verdicts
from plumbline.session import shared_dir, table
from plumbline.sources import readers

_L = F.lit


def _null() -> Column:
    return F.lit(None).cast("string")


def _cases(spark: SparkSession, cases: dict[str, Column]) -> DataFrame:
    """rule, result: each case computed by Spark, as a string ('-' for null)."""
    each = [F.struct(_L(k).alias("rule"), F.coalesce(c.cast("string"), _L("-")).alias("result")) for k, c in cases.items()]
    return spark.range(1).select(F.explode(F.array(*each)).alias("c")).select("c.*")


def _stated(expected: dict[str, str]) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return "select rule, result from (values " + ", ".join(f"({q(k)}, {q(v)})" for k, v in expected.items()) + ") v(rule, result)"


def rules_text(spark, d):
    long = _L("The board of the district keeps the wells and the pipes of the area in order for all who live there, and it meets every month.")
    page = F.concat(_L("---\nMenu\n"), long, _L("\n\nMore of the same kind of text about the board and what it does for people who live in the area.\nTab Context:\nx"))
    place = lambda level, s: text.place_part(_L(level), _L(s))
    return _cases(spark, {
        "norm name": text.norm_name(_L("  City of  New-York, N.Y. ")), "slug": text.slug(_L("City of O'Neil")), "slug of nothing": text.slug(_L("--")), "token key": text.token_key(_L("GPT Bot 2.0")),
        "official county": text.official_name(_L("county"), _L("Kings")), "official town": text.official_name(_L("town"), _L("Rye")), "place part county": place("county", "Kings County"), "place part town": place("town", "Town of Rye"),
        "place key suffix": text.place_key_suffix(_L("Rye Village"), _L("village")), "digits padded": text.digit_code(_L("361"), 5), "no digits": text.digit_code(_L("abc"), 5),
        "active": text.is_active(_L(" Active ")), "not active": text.is_active(_L("Dissolved")), "split": F.array_join(text.split_multi(_L(" a;; b ;")), "|"), "item code": text.initials_code(_L("http://www.wikidata.org/entity/Q42")),
        "address": text.address_line(_L("1 Main St"), _null(), _L("Rye"), _L("NY"), _L("10580")), "html": text.looks_like_html(_L(" <!DOCTYPE html><p>")), "no html": text.looks_like_html(_L("User-agent: *")),
        "squeeze": text.squeeze(_L(" a \n\t b ")), "words": text.count_words(_L("12 towns, 3rd año — né")), "tokens": text.count_tokens(_L("12 towns, 3rd")), "challenge": text.is_challenge(_L("Just a moment..."), _null()), "challenge late": text.is_challenge(_null(), F.concat(F.repeat(_L("x "), 1000), _L("access denied"))),
        "cut": text.truncated(_L("abcdef "), 3)["truncated"], "not cut": text.truncated(_L("abc"), 3)["text"], "prose line": text.is_prose_start(long), "menu line": text.is_prose_start(_L("Home | About")),
        "prose": F.length(text.extract_prose(page)) > 150, "prose of a menu": text.extract_prose(_L("Home\nAbout\n")), "wrapper": text.strip_wrapper(_L("a\n---\nbody\nTab Context:\nx")),
        "platform socrata": text.registry_platform(_L("Socrata (Tyler)")), "platform none": text.registry_platform(_L("in house")), "catalog ckan": text.catalog_url(_L("ckan"), _L("data.example")), "lookup ckan": text.lookup_url(_L("ckan"), _L("data.example")),
        "about exact": text.about_link_score(_L("About Us"), _L("about")) > text.about_link_score(_L("News"), _L("news")), "sha": exporting.sha256(_L("abc")), "names overlap": exporting.names_overlap(F.array(_L("Town of Rye")), F.array(_L("x"), _L("town OF rye!"))), "names differ": exporting.names_overlap(F.array(_L("a")), F.array(_L("b"))),
        "partial date year": text.partial_date(_L("2024")), "partial date month": text.partial_date(_L("2024-05")), "partial date none": text.partial_date(_L("May")),
    })


_TEXT = {
    "norm name": "city of new york n y", "slug": "city-of-o-neil", "slug of nothing": "entity", "token key": "gpt_bot_2_0", "official county": "Kings County", "official town": "Town of Rye", "place part county": "kings", "place part town": "rye",
    "place key suffix": "rye", "digits padded": "00361", "no digits": "-", "active": "true", "not active": "false", "split": "a|b", "item code": "Q42", "address": "1 Main St, Rye, NY 10580", "html": "true", "no html": "false", "squeeze": "a b", "words": "4", "tokens": "3",
    "challenge": "true", "challenge late": "false", "cut": "true", "not cut": "abc", "prose line": "true", "menu line": "false", "prose": "true", "prose of a menu": "", "wrapper": "[body]", "platform socrata": "socrata", "platform none": "-",
    "catalog ckan": "https://data.example/api/3/action/package_list?limit=1", "lookup ckan": "-", "about exact": "true", "sha": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad", "names overlap": "true", "names differ": "false",
    "partial date year": "2024-01-01", "partial date month": "2024-05-01", "partial date none": "-",
}


def rules_hosts(spark, d):
    link = F.get(web.link_header(_L('<https://a.example/x>; rel="alternate"; type="text/markdown", </y>; rel=next')), 0)
    robots = "User-agent: *\nDisallow: /private\nAllow: /private/open\n"
    legacy = web.legacy_robots(web.parse_robots(_L("User-agent: GPTBot\nCrawl-delay: 5\nDisallow: /\n")), ["GPTBot", "Other"])
    answer = lambda s, t, u: hosts.accept_answer(_L(s).cast("int"), _L(t), _L(u), _L("a.example"))["kept"]
    return _cases(spark, {
        "mime": hosts.bare_mime(_L("Text/HTML; charset=utf-8")), "tracker": hosts.is_email_tracker(_L("u123.ct.sendgrid.net")), "no tracker": hosts.is_email_tracker(_L("mail.example")), "answer page": answer(200, "text/html", ""), "answer dead": answer(None, None, None),
        "host ok": hosts.host_ok(_L("www.a.example"), _L("a.example")), "host below": hosts.host_ok(_L("b.a.example"), _L("a.example")), "social": hosts.host_ok(_L("facebook.com"), _L("facebook.com")), "location": hosts.clean_location(_L("  https://a.example/\tx \n")),
        "candidates": F.array_join(hosts.candidate_urls(_L("https://a.example/site/x/"), ["/about", "/about-us"], 3), " "), "page kind": exporting.page_kind(_L("https://a.example/robots.txt")), "page kind other": exporting.page_kind(_L("https://a.example/a")),
        "site slug": exporting.site_slug(_L("/site/doe/about.page")), "html slug": exporting.html_slug(_L("/html/doe/home")), "no slug": exporting.site_slug(_L("/x")), "as chrome": exporting.as_chrome(_L("HeadlessChrome/1")), "board": exporting.board_entity(_L("mn05")), "no board": exporting.board_entity(_L("ZZ1")),
        "link header": link["href"], "link type": link["type"], "relative": web.url_join(_L("https://a.example/b/c"), _L("../d?x=1")), "robots closed": web.robots_allows(_L(robots), _L("Bot"), _L("https://a.example/private/x")), "robots open": web.robots_allows(_L(robots), _L("Bot"), _L("https://a.example/b")),
        "legacy robots": F.concat(F.get(legacy, 0)["token"], F.get(legacy, 0)["rules"].cast("string"), F.size(legacy).cast("string")), "website struct": readers.website_cell(_L('{"url": " https://a.example "}')), "website text": readers.website_cell(_L(" a.example ")), "website none": readers.website_cell(_L("{}")),
        "display county": readers.display_name(_L("County"), _L("Kings"), _null()), "display town": readers.display_name(_L("town"), _L("Rye"), _null()), "display county only": readers.display_name(_null(), _null(), _L("Kings")), "quoted": readers.quoted_field(_L("id: 'a', name: \"B's\""), "name"),
        "union": F.array_join(readers.vocabulary_blocks(_L("type Layer = 'a' | \"b\"; type X = 'c';"), "Layer"), "|"), "city row": exporting.is_city_row(_L("Borough/County"), _L("x")), "no city row": exporting.is_city_row(_L("City"), _L("Rye")),
    })


_HOSTS = {
    "mime": "text/html", "tracker": "true", "no tracker": "false", "answer page": "true", "answer dead": "false", "host ok": "true", "host below": "false", "social": "false", "location": "https://a.example/x", "candidates": "https://a.example/site/x/about https://a.example/site/x/about-us https://a.example/about",
    "page kind": "robots", "page kind other": "page", "site slug": "doe", "html slug": "doe", "no slug": "-", "as chrome": "Chrome/1", "board": "manhattan-community-board-5", "no board": "-", "link header": "https://a.example/x", "link type": "text/markdown", "relative": "https://a.example/d?x=1",
    "robots closed": "false", "robots open": "true", "legacy robots": "GPTBot11", "website struct": "https://a.example", "website text": "a.example", "website none": "-", "display county": "Kings County", "display town": "Town of Rye", "display county only": "Kings", "quoted": "B's", "union": "a|b", "city row": "true", "no city row": "false",
}


def rules_export(spark, d):
    s = lambda v: _L(v).cast("string")
    i = lambda v: _L(v).cast("int")
    doors = F.create_map(_L("a"), _L("pass"), _L("b"), _L("blocked"))
    reach = lambda **kw: verdicts.reach_diagnosis({**{k: _L(None).cast("boolean") for k in ("dns", "dns_alt", "tcp443", "tcp80", "tls_ok", "https_error", "cert_error")}, **{k: i(None) for k in ("https", "http")}, **kw})
    resp = lambda **kw: F.struct(*(F.coalesce(kw[k], _L(None).cast(t)).alias(k) if k in kw else _L(None).cast(t).alias(k) for k, t in (("status", "int"), ("transport_error", "string"), ("transport_kind", "string"), ("is_block_page", "boolean"), ("body_class", "string"))))
    lookup = lambda b: exporting.lookup_data(_L(b))["problem"]
    return _cases(spark, {
        "scan done": scoring.scan_status(i(200), s(None), _L(True)), "scan dns": scoring.scan_status(i(None), s("transport dns: x"), _L(True)), "scan other": scoring.scan_status(i(None), s("HTTP 429"), _L(True)), "scan unknown": scoring.scan_status(i(None), s(None), _L(True)), "scan nothing": scoring.scan_status(i(None), s(None), _L(False)),
        "test scan": scoring.test_scan_status(_L(True), i(None), _L("timeout")), "test scan none": scoring.test_scan_status(_L(False), i(None), _L("timeout")), "https yes": scoring.https_enforced(i(301), _L(True)), "https no": scoring.https_enforced(i(200), _L(False)), "https unknown": scoring.https_enforced(i(404), _L(False)),
        "redirect": scoring.is_redirect(_L("https://a.example"), _L("https://a.example/x")), "no redirect": scoring.is_redirect(_L("http://a.example/"), _L("https://a.example")), "live": scoring.is_live(i(204)), "not live": scoring.is_live(i(404)), "live unknown": scoring.is_live(i(None)),
        "map at root": scoring.sitemap_at_root(_L("https://a.example/sitemap.xml")), "map elsewhere": scoring.sitemap_at_root(_L("https://a.example/a/sitemap.xml")), "robots found": scoring.robots_detected(i(200), _L("https://a.example/robots.txt"), _L("a.example")), "robots moved": scoring.robots_detected(i(200), _L("https://b.example/robots.txt"), _L("a.example")),
        "decisions": F.array_join(scoring.decisions_list(F.create_map(_L("b"), _L("allow"), _L("a"), _L("disallow"))), ","), "admitted": scoring.admitted(_L("pass")), "refused": scoring.admitted(_L("blocked")), "admitted na": scoring.admitted(_L("na")), "name decides": scoring.name_decides(_L("blocked"), _L("pass")), "name unknown": scoring.name_decides(_L("na"), _L("pass")),
        "let in": F.array_join(scoring.admitted_split(doors, True), ","), "kept out": F.array_join(scoring.admitted_split(doors, False), ","), "nobody": F.array_join(scoring.admitted_split(F.create_map(_L("a"), _L("pass")), False), ","), "family 6": scoring.family_ok(_L(""), _L("2001:db8::1"), "ipv6"), "family 6 seen": scoring.family_ok(s(None), _L("2001:db8::1"), "ipv6"), "family 4": scoring.family_ok(s(None), _L("2001:db8::1"), "ipv4"),
        "network same": scoring.network_change(_L("a"), _L("a")), "network unknown": scoring.network_change(_L("a"), s(None)), "owner": exporting.owner_name(F.array(_L("A")), F.array(_L("x"))), "owner shared": exporting.owner_name(F.array(_L("A"), _L("B")), F.array(_L("x"), _L("y"))), "divergent none": F.size(exporting.divergent_list(_L(True), _L(None).cast("array<string>"))), "divergent not run": exporting.divergent_list(_L(False), F.array(_L("a"))).isNull(),
        "place": exporting.place_sent_from(_L(" Home ")), "no place": exporting.place_sent_from(_L("moon")), "network": exporting.network_record(_L("cloud"), _L("a"), _L("b"))["changed"], "lookup ok": lookup('{"status":"ok","data":{}}'), "lookup bad": lookup('{"status":"error"}'), "lookup no JSON": lookup("<p>"), "lookup no data": lookup('{"status":"ok"}'), "csv list": scoring.csv_value(F.array(_L("a"), _L("b")), "array<string>"), "csv true": scoring.csv_value(_L(True), "boolean"),
        "dns gone": reach(dns=_L(False)), "headless pass": verdicts.headless_verdict(i(200), _L(False), i(9), s(None)), "headless blocked": verdicts.headless_verdict(i(200), _L(True), i(9), s(None)), "headless na": verdicts.headless_verdict(i(None), _L(False), i(0), _L("x")), "headless fail": verdicts.headless_verdict(i(200), _L(False), i(0), s(None)), "page gone": verdicts.page_verdict(i(410), _L(False), i(9), s(None), _L(False)),
        "person challenge": verdicts.needs_person(i(200), _L(True), i(1)), "person empty": verdicts.needs_person(i(200), _L(False), i(0)), "person none": verdicts.needs_person(i(200), _L(False), i(5)), "transport timeout": verdicts.transport_kind(_L("ReadTimeout")), "transport tls": verdicts.transport_kind(_L("SSLCertVerificationError")), "transport dns": verdicts.transport_kind(_L("gaierror")),
        "pushback 429": verdicts.pushback(resp(status=i(429)))["quarantine"], "pushback 403": verdicts.pushback(resp(status=i(403)))["quarantine"], "pushback dead": verdicts.pushback(resp(transport_error=_L("x"), transport_kind=_L("dns")))["what"], "pushback none": verdicts.pushback(resp(status=i(200)))["what"],
        "radware": verdicts.block_redirect(F.array(F.struct(_L("https://validate.perfdrive.com/?q=botmanager_support@radware.com").alias("location")))), "wordpress": verdicts.is_wordpress(F.array(_L("WordPress 6"))), "dataset page": verdicts.dataset_page(_L("ckan"), _L("d.example"), _L('{"result":["a b"]}'), s(None)),
        "geoid county": F.get(records.census_areas(_L("county"), _L("36047"), s(None)), 0)["layer"], "geoid unsure": F.size(records.census_areas(_L("town"), _L("3604700001"), _L("36001"))), "identifier": records.identifier_of(F.array(F.struct(_L("a").alias("scheme"), _L("1").alias("identifier"))), "a"), "labels": F.size(records.published_labels(_L("A || B"))), "job unit": runlog.job_unit(s(None), _L("a.example")), "pace host": runlog.pace_host(s(None), _L("https://a.example/x")), "page hours": runlog.page_hours(i(10), _L(2.0)),
    })


_EXPORT = {
    "scan done": "completed", "scan dns": "dns_resolution_error", "scan other": "skipped", "scan unknown": "unknown_error", "scan nothing": "-", "test scan": "timeout", "test scan none": "-", "https yes": "true", "https no": "false", "https unknown": "-", "redirect": "true", "no redirect": "false", "live": "true", "not live": "false", "live unknown": "-",
    "map at root": "true", "map elsewhere": "false", "robots found": "true", "robots moved": "false", "decisions": "a=disallow,b=allow", "admitted": "true", "refused": "false", "admitted na": "-", "name decides": "true", "name unknown": "-", "let in": "a", "kept out": "b", "nobody": "-", "family 6": "false", "family 6 seen": "true", "family 4": "-",
    "network same": "false", "network unknown": "-", "owner": "A", "owner shared": "-", "divergent none": "0", "divergent not run": "true", "place": "home", "no place": "-", "network": "true", "lookup ok": "-", "lookup bad": "status error", "lookup no JSON": "no JSON", "lookup no data": "no data object", "csv list": "a,b", "csv true": "TRUE",
    "dns gone": "dns_missing", "headless pass": "pass", "headless blocked": "blocked", "headless na": "na", "headless fail": "fail", "page gone": "not_found", "person challenge": "challenge page", "person empty": "empty page", "person none": "-", "transport timeout": "timeout", "transport tls": "tls", "transport dns": "dns",
    "pushback 429": "true", "pushback 403": "false", "pushback dead": "transport dns: x", "pushback none": "-", "radware": "radware_botmanager", "wordpress": "true", "dataset page": "https://d.example/dataset/a%20b", "geoid county": "county", "geoid unsure": "0", "identifier": "1", "labels": "2", "job unit": "a.example", "pace host": "a.example", "page hours": "2.0",
}

def _file(spark: SparkSession, body: str, ending: str = "txt") -> str:
    """A folder of the shared work folder with one file that holds a text as it is."""
    path = f"{shared_dir(spark)}/plumbline/{uuid.uuid4().hex}/source.{ending}"
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(path)
    return path


def source_readers(spark, d):
    """Rows of every kind of source as (source, row): files are written to the shared folder and read back."""
    one = lambda name, df: df.select(_L(name).alias("source"), F.to_json(F.struct(*df.columns)).alias("row"))
    small = lambda rows, schema: spark.createDataFrame(rows, schema)
    csv = _file(spark, "\ufeffDomain , agency\n A.example ,One\n,Two\nb.example,\"Th,ree\"", "csv")
    gov = small([("rye.gov", "City", "City of Rye", "NY"), ("x.gov", "City", "City of X", "NJ"), ("y.gov", "Federal", "Y", "NY"), ("z.gov", "City", "Library", "NY")], "d string, k string, o string, s string")
    leads, skipped = readers.dotgov(gov, "s", "d", "k", "o")
    program = small([("const L = [{ id: 'cd', name: \"Council\", namePlural: 'Councils', description: 'x' }, { other: 1 }];",)], "t string")
    results = small([("h", "W1", '{"first_8kb":"Sitemap: https://h/s.xml\\nSitemap: https://h/t.xml"}'), ("h", "F4", '{"final_url":"https://h/"}')], "host string, test string, evidence string")
    bindings = small([("http://w/entity/Q1", "One", "Uno", "https://www.one.example/"), ("http://w/entity/Q1", "One", "Eins", "https://one2.example")], "item string, itemLabel string, altLabel string, website string")
    parts = [
        one("json", readers.json_array(spark, _file(spark, '{"entities":[{"id":"a","n":1},{"id":"b","n":null}]}', "json"), "entities", "id string, n int")),
        one("no file", readers.json_array(spark, f"{shared_dir(spark)}/none.json", "entities", "id string, n int")),
        one("lines", readers.json_lines(spark, _file(spark, '{"id":"a"}\n{"id":"b', "jsonl"), "id string")),
        one("csv", readers.listing(readers.csv_table(spark, csv, ["Domain", "agency"]), "Domain")),
        one("active", readers.active_only(small([("a", "Active"), ("b", "Dissolved")], "id string, s string"), "s")),
        one("last", readers.last_by_key(small([("a", "x", 1), ("a", "y", 2), ("a", " ", 3)], "k string, v string, n int"), "k", "v", "n")),
        one("gov", leads), one("gov skipped", skipped), one("layers", readers.layer_rows(program, "t")), one("links", readers.links_in_results(results)), one("bindings", readers.sparql_bindings(bindings)),
        one("moved", readers.moved_pages(small([("u", "moved", "v"), ("w", "gone", None)], "url string, issue string, moved_to string"))),
        one("attributes", readers.attribute_rows(small([([(("Rye", 1),)],)], "features array<struct<attributes:struct<NAME:string,N:int>>>"))),
        one("targets", readers.targets(readers.targets_from_addresses(small([("a.example", "site", ["e"]), ("https://b.example/x", "site", ["e", "f"])], "` Address` string, Kind string, ids array<string>"), ["site"]))),
        one("cells", readers.table_cells(spark, _file(spark, "| `a` | x | edited |\n| `b` | y | tbd |"), "tbd")),
        one("one label", exporting.top_level_rules(small([("com", "rule"), ("co.uk", "rule"), ("ck", "wild")], "rule string, kind string"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_READ = [
    ("json", '{"id":"a","n":1}'), ("json", '{"id":"b"}'), ("lines", '{"id":"a"}'), ("csv", '{"Domain":"a.example","agency":"One"}'), ("csv", '{"Domain":"b.example","agency":"Th,ree"}'), ("active", '{"id":"a","s":"Active"}'), ("last", '{"k":"a","v":"y"}'),
    ("gov", '{"domain":"rye.gov","tier":"city","place":"Rye","organization":"City of Rye"}'), ("gov skipped", '{"skipped":"other state","n":1}'), ("gov skipped", '{"skipped":"other kind","n":1}'), ("gov skipped", '{"skipped":"names no government","n":1}'),
    ("layers", '{"pos":0,"id":"cd","name":"Council","name_plural":"Councils","description":"x"}'), ("links", '{"host":"h","url":"https://h/s.xml","via":"robots"}'), ("links", '{"host":"h","url":"https://h/t.xml","via":"robots"}'), ("links", '{"host":"h","url":"https://h/","via":"probe"}'),
    ("bindings", '{"code":"Q1","label":"One","aliases":["Eins","Uno"],"hosts":["one.example","one2.example"]}'), ("moved", '{"url":"u","issue":"moved","moved_to":"v"}'), ("moved", '{"url":"w","issue":"gone"}'), ("attributes", '{"NAME":"Rye","N":1}'),
    ("targets", '{"url":"https://a.example/","host":"a.example","entity_id":"e","entity_ids":["e"]}'), ("targets", '{"url":"https://b.example/x","host":"b.example","entity_ids":["e","f"]}'), ("cells", '{"id":"a","note":"edited"}'), ("one label", '{"rule":"com"}'),
]


def canonical_registry(spark, d):
    return records.canonical_rows(table(spark, d, "registry"))


def matcher_key_counts(spark, d):
    return records.matcher_keys(table(spark, d, "registry")).groupBy("priority").agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


def role_histogram(spark, d):
    return records.review_histogram(table(spark, d, "web_property_updates").select(F.coalesce("role", _L("-")).alias("reason")))


def listing_pages(spark, d):
    """Targets of every distinct address of the listing."""
    return readers.targets(table(spark, d, "state_listing").where("trim(url) <> '' and url like 'http%://%'").select("url").distinct()).select("url", F.size("entity_ids").alias("n"))


def description_coverage(spark, d):
    return records.coverage(table(spark, d, "descriptions"))


def crawler_labels(spark, d):
    rows = [("GPTBot", "yes", "Mozilla GPTBot/1.0", None), ("(none)", "yes", "x", "no name"), ("Ant", "rules-only", "Ant/1", "rules only")]
    df = spark.createDataFrame(rows, "name string, send string, ua_exact string, reason_not_sent string")
    return records.crawler_identities(df).select("name", "key", F.coalesce("label", _L("-")).alias("label"), F.col("sent").cast("int").alias("sent"), F.coalesce("reason", _L("-")).alias("reason"))


def governance_import(spark, d):
    """The registry written as a governance export and read back as canonical records."""
    r = table(spark, d, "registry")
    others = F.array_join(F.transform(F.coalesce("other_names", F.array().cast("array<struct<name:string,note:string>>")), lambda o: F.coalesce(o["name"], _L(""))), ";")
    rows = r.select(F.col("id").alias("record_id"), "name", F.col("short_name").alias("acronym"), F.concat(_L("https://www."), "id", _L(".example/")).alias("url"), F.when(F.length("id") % 3 == 0, "Dissolved").otherwise("Active").alias("operational_status"), F.col("classification").alias("organization_type"), others.alias("alternate_or_former_names"), _null().alias("alternate_or_former_acronyms"))
    out = records.governance_records(rows)
    return out.select("name", F.coalesce("short_name", _L("-")).alias("short_name"), F.size("other_names").alias("others"), records.identifier_of(F.col("identifiers"), "nyc_goid").alias("goid"), F.get("web_properties", 0)["domain"].alias("domain"), "status")


def _governed(spark, d):
    level = F.element_at(F.array(*map(_L, ("city", "town", "village", "county"))), (F.length("id") % 4 + 1).cast("int"))
    return table(spark, d, "registry").select("id", level.alias("level"), "name", F.substring(F.md5("id"), 1, 3).alias("code"))


def places_report(spark, d):
    """The registry as minted places against codes and names of which some are missing and some are doubled."""
    p = _governed(spark, d)
    spine = p.where("code < 'e'").select("code").distinct().unionByName(spark.createDataFrame([("zzz",)], "code string"))
    return bases.places_report(p, spine, p.where("code > '3'").select("level", "name", "code"), p.where("code < '8'").select("level", "name"))


def worker_states(spark, d):
    """Days of the log as runs, users as workers; a worker crashes whose value is high."""
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("run"), F.concat(_L("w"), F.col("user_id") % 3).alias("worker"), F.when(F.col("event_id") % 997 == 0, _L("boom")).alias("error"))
    return bases.run_states(e).select("run", "state", F.coalesce("error", _L("-")).alias("error"))


def known_host_keys(spark, d):
    return bases.known_hosts(table(spark, d, "registry").select(F.explode("web_properties").alias("w")).select("w.domain"), "domain")


def decision_records(spark, d):
    """The registry's names, half of them altered, decided by the exact matcher over the registry."""
    reg = table(spark, d, "registry")
    rows = reg.select(F.xxhash64("id").alias("row_id"), F.when(F.length("id") % 2 == 0, F.upper("name")).otherwise(F.concat("name", _L(" X"))).alias("name"), _null().alias("acronym"))
    out = bases.decisions(rows, records.matcher_keys(reg.where("name is not null").withColumns({"short_name": _null(), "other_names": _L(None).cast("array<struct<name:string,note:string>>")})), reg, "nyc")
    return out.groupBy("decision", "reason", "confidence_tier").agg(F.count("*").alias("n"))


def base_before_batch(spark, d):
    """The registry's first two thirds as seed, the rest as two batches: the base that the second finds."""
    reg = table(spark, d, "registry").where("name is not null")
    none = F.array().cast("array<struct<scheme:string,identifier:string>>")
    pairs = F.transform(F.coalesce("identifiers", F.array().cast("array<struct<scheme:string,identifier:string>>")), lambda p: F.struct(p["scheme"].alias("scheme"), p["identifier"].alias("identifier")))
    part = F.pmod(F.length("id"), _L(3))
    seed = reg.where(part == 0).select("id", F.pmod(F.xxhash64("id"), _L(1_000_000_000)).alias("ord"), "name", none.alias("pairs"))
    batch = lambda k: reg.where(part == k).select(F.col("id").alias("rec_id"), F.pmod(F.xxhash64("id"), _L(1_000_000_000)).alias("seq"), F.concat("name", _L(" "), "id").alias("name"), none.alias("pairs"), _null().alias("match_entity_id"), F.concat(_L("m-"), "id").alias("mint_id"), _L(True).alias("expect_new"))
    base = bases.base_registry(seed, {"first": batch(1), "second": batch(2)}, "first", without="second")
    return base.select("id", "name")


QUERIES = {f.__name__: f for f in (rules_text, rules_hosts, rules_export, source_readers, canonical_registry, matcher_key_counts, role_histogram, listing_pages, description_coverage, crawler_labels, governance_import, places_report, worker_states, known_host_keys, decision_records, base_before_batch)}
_GOVERNED = "(select id, (['city','town','village','county'])[length(id) % 4 + 1] as level, name, substr(md5(id), 1, 3) as code from registry)"
_NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
ORACLE = {
    "rules_text": _stated(_TEXT), "rules_hosts": _stated(_HOSTS), "rules_export": _stated(_EXPORT),
    "source_readers": "select * from (values " + ", ".join(f"('{s}', '{r}')" for s, r in _READ) + ") v(source, row)",
    "canonical_registry": "select id as record_id, coalesce(name, '') as name, coalesce(short_name, '') as acronym, coalesce(array_to_string(list_filter(list_transform(other_names, lambda o: o.name), lambda n: coalesce(n, '') <> ''), ';'), '') as alternate_or_former_names, coalesce(classification, '') as organization_type, case when status = 'active' then 'Active' else coalesce(status, '') end as operational_status from registry",
    "matcher_key_counts": f"with k as (select {_NORM.format('short_name')} as key, 0 as priority from registry union all select {_NORM.format('name')}, 1 from registry union all select {_NORM.format('o.name')}, 2 from (select unnest(other_names) as o from registry)) select priority, count(*) as n, count(distinct key) as keys from k where key <> '' group by priority",
    "role_histogram": "select coalesce(role, '-') as reason, count(*) as n from web_property_updates group by 1",
    "listing_pages": "select distinct url, 0 as n from state_listing where trim(url) <> '' and url like 'http%://%'",
    "description_coverage": "select status, count(*) as n from descriptions group by status union all select 'ok', 0 where not exists (select 1 from descriptions where status = 'ok')",
    "crawler_labels": "select * from (values ('GPTBot', 'gptbot', 'Mozilla GPTBot/1.0', 1, '-'), ('(none)', 'none', '-', 0, 'no name'), ('Ant', 'ant', '-', 0, 'rules only')) v(name, key, label, sent, reason)",
    "governance_import": """select trim(name) as name, coalesce(nullif(trim(short_name), ''), '-') as short_name, cast((case when nullif(trim(short_name), '') is not null then 1 else 0 end) + coalesce(len(list_filter(flatten(list_transform(other_names, lambda o: string_split(coalesce(o.name, ''), ';'))), lambda n: trim(n) <> '')), 0) as int) as others,
id as goid, 'www.' || id || '.example' as domain, 'active' as status from registry where length(id) % 3 <> 0""",
    "worker_states": "with w as (select strftime(ts, '%Y-%m-%d') as run, 'w' || (user_id % 3) as worker, case when event_id % 997 = 0 then 'boom' end as error from events) select run, case when count(error) > 0 then 'broke' else 'done' end as state, coalesce('worker crashed: ' || string_agg(distinct worker || ': ' || error, '; ' order by worker || ': ' || error) filter (error is not null), '-') as error from w group by run",
    "known_host_keys": "select distinct regexp_replace(regexp_replace(regexp_replace(lower(trim(w.domain)), '^[a-z]+://', ''), '[/?#:].*$', ''), '^www[.]', '') as host_key from (select unnest(web_properties) as w from registry) where trim(w.domain) <> ''",
    "decision_records": f"""with k as (select {_NORM.format('name')} as key, government_level as level, id, row_number() over (partition by {_NORM.format('name')} order by id) as r from registry where name is not null), a as (select {_NORM.format("case when length(id) % 2 = 0 then upper(name) else name || ' X' end")} as key from registry),
j as (select a.key, k.id, k.level from a left join k on a.key = k.key and k.r = 1 and a.key <> '') select case when id is null then 'unmatched' when level <> 'nyc' then 'review' else 'attach' end as decision, case when id is null then 'no_match' when level <> 'nyc' then 'cross_government_level' else 'exact' end as reason, case when id is null then 'none' else 'exact' end as confidence_tier, count(*) as n from j group by all""",
    "base_before_batch": "select id, name from registry where name is not null and length(id) % 3 = 0 union all select 'm-' || id, name || ' ' || id from registry where name is not null and length(id) % 3 = 1",
    "places_report": f"""with p as {_GOVERNED}, spine as (select distinct code from p where code < 'e' union all select 'zzz'), twice as (select code from p group by code having count(*) > 1),
k as (select level, code, trim(regexp_replace(lower(name), '[^a-z0-9]+', '', 'g')) as nk from p)
select 'places' as "check", level, 'places' as what, count(*) as n from p group by level
union all select 'spine', 'all', 'code unknown', count(*) from p where code not in (select code from spine)
union all select 'spine', 'all', 'not minted', count(*) from spine where code not in (select code from p)
union all select 'spine', 'all', 'minted twice', count(*) from twice having count(*) > 0
union all select 'codes', level, 'matched', count(*) from p where code > '3' group by level
union all select 'names', level, 'matched', count(*) from p where code < '8' group by level""",
}
