"""The tests of captured responses, run over captures of every record of the registry, against verdicts stated in SQL.

A host's captures are one of six stories, by the length of its id; each story gives every kind of response, and each
test must tell its own part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import exporting, verdicts
from plumbline.session import table, written

_WORDS = " ".join(["The office keeps records and answers residents of the area every working day."] * 16)
_GOOD = f"""<!doctype html><html lang="en"><head><title>Office of HOST</title><meta name="description" content="The office keeps the records of the area and answers residents on every working day.">
<meta name="generator" content="CKAN 2.9"><meta property="og:title" content="Office"><meta property="og:description" content="Records"><meta property="og:site_name" content="HOST">
<link rel="alternate" type="text/markdown" href="/index.md"><link rel="alternate" type="application/rss+xml" href="/feed/"><link rel="https://api.w.org/" href="https://HOST/wp-json/">
<script type="application/ld+json">{{"@context":"https://schema.org","@type":"GovernmentOrganization","name":"Office of HOST"}}</script><script src="https://cdn.other.example/a.js"></script></head>
<body><nav><a href="/a">A</a></nav><main><h1>Office</h1><p>{_WORDS}</p><a href="https://portal.example/d">Open data</a><a href="https://town.legistar.com/c">Calendar</a><a href="/es" hreflang="es">Español</a></main>
<img src="/wp-content/x.png"><div id="google_translate_element"></div><footer>Copyright 2020-2026</footer></body></html>"""
_BARE = "<html><body>hello</body></html>"
_HALF = f"""<html><head><title>Half</title><meta name="description" content="A short line."><meta property="og:title" content="Half"><script type="application/ld+json">{{"@type":"Organization","name":"Half"}}</script></head>
<body><h1>Half</h1><p>{_WORDS}</p><p>Please enable JavaScript. Powered by Socrata.</p><p>© 2019</p><a href="/x">x</a></body></html>"""
_ROBOTS = "User-agent: GPTBot\nDisallow: /\n\nUser-agent: *\nAllow: /\nContent-Signal: ai-train=no\n\nSitemap: https://HOST/sitemap.xml\n"
_MAP = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://HOST/a</loc><lastmod>2026-01-02</lastmod></url><url><loc>https://HOST/b</loc></url></urlset>'

_KINDS = ("robots", "llms", "llms_full", "sitemap", "home", "notfound", "http", "md_accept", "md_index", "api_catalog", "wp_rest", "portal_catalog")
_PLAIN, _HTML, _JSON = "text/plain", "text/html", "application/json"
#: Story -> kind -> (status, content type, body); a kind that isn't named has the story's answer to all others.
_STORIES: list[dict[str, tuple]] = [
    {
        "robots": (200, _PLAIN, _ROBOTS), "llms": (200, _PLAIN, "# Office\n> What it does\n"), "llms_full": (200, _PLAIN, "# All"), "sitemap": (200, "application/xml", _MAP), "home": (200, _HTML, _GOOD), "notfound": (404, _HTML, "no"),
        "http": (301, _HTML, ""), "md_index": (200, "text/markdown", "# Office"), "api_catalog": (200, "application/linkset+json", '{"linkset":[{"anchor":"a","item":[{"href":"b"}]}]}'), "wp_rest": (200, _JSON, '{"namespaces":["wp/v2"]}'),
        "portal_catalog": (200, _JSON, '{"success":true,"result":["a","b"]}'), "*": (404, _HTML, "no"), "links": (3, 1), "gptbot": (403, _HTML, "no"), "claudebot": (200, _HTML, _GOOD),
    },
    {"home": (200, _HTML, _BARE), "notfound": (200, _HTML, _BARE), "*": (404, _HTML, "no"), "links": (0, 0), "gptbot": (200, _HTML, _BARE), "claudebot": (200, _HTML, _BARE)},
    {"*": (403, _HTML, "no"), "links": (2, 2), "gptbot": (403, _HTML, "no"), "claudebot": (429, _HTML, "no")},
    {"*": (None, "", None), "links": (0, 0), "gptbot": (None, "", None), "claudebot": (None, "", None)},
    {"robots": (200, _HTML, "<!doctype html><html></html>"), "llms": (200, _PLAIN, "# Half\nNo quote"), "sitemap": (200, _PLAIN, "no map"), "home": (200, _HTML, _HALF), "notfound": (410, _HTML, "gone"), "*": (404, _HTML, "no"), "links": (3, 2), "gptbot": (500, _HTML, "no"), "claudebot": (200, _HTML, _HALF)},
    {"*": (500, _HTML, "no"), "links": (2, 0), "gptbot": (500, _HTML, "no"), "claudebot": (500, _HTML, "no")},
]


def _captures(spark: SparkSession, d: str) -> DataFrame:
    """captures of all records: their story's responses with the host's name put in."""
    rows = []
    for story, s in enumerate(_STORIES):
        answers = [(k, "research", s.get(k, s["*"])) for k in _KINDS] + [("home", i, s[i]) for i in ("gptbot", "claudebot")]
        answers += [("link", "research", (404 if n < s["links"][1] else 200, _HTML, "")) for n in range(s["links"][0])]
        rows += [(story, seq, k, i, *a) for seq, (k, i, a) in enumerate(answers)]
    told = F.broadcast(spark.createDataFrame(rows, "story int, seq long, kind string, identity string, status int, type string, text string"))  # a fixed number of rows
    host = F.concat("id", F.lit(".example"))
    hosts = table(spark, d, "registry").select(host.alias("host"), (F.length("id") % len(_STORIES)).alias("story"))
    j = hosts.join(told, "story").withColumns({"body": F.replace("text", F.lit("HOST"), F.col("host")), "url": F.concat(F.lit("https://"), "host", F.lit("/"))})
    headers = F.map_from_arrays(F.array(F.lit("content-type"), F.lit("location"), F.lit("server")), F.array(F.col("type"), F.col("url"), F.lit("nginx")))
    none = lambda t: F.lit(None).cast(t)
    dead = F.col("status").isNull()
    return j.select(
        "host", "kind", "identity", "seq", "url", F.col("url").alias("final_url"), "status", F.when(~dead, headers).alias("headers"), "body", none("binary").alias("raw"), F.lit(False).alias("is_block_page"), none("string").alias("body_class"),
        F.when(dead, "timed out").alias("transport_error"), F.when(dead, "timeout").alias("transport_kind"), F.lit(False).alias("quarantined"), F.lit(False).alias("offhost_redirect"), none("array<struct<status:int,location:string>>").alias("redirects"), F.octet_length("body").cast("long").alias("bytes"),
    )


def _scored(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "registry").select(F.concat("id", F.lit(".example")).alias("host"), F.array("name").alias("names"))
    classes = {"gptbot": "ai_training", "claudebot": "ai_search"}
    return verdicts.score_captures(_captures(spark, d), ["GPTBot", "ClaudeBot"], F.lit("2026-11-26").cast("date"), ("portal.example",), classes, names, {"gptbot": "GPTBot", "claudebot": "ClaudeBot"})


def capture_verdicts(spark, d):
    return _scored(spark, d).select("host", "test", "identity", "verdict")


def capture_evidence(spark, d):
    """Columns of the wide export from the evidence of the same tests."""
    rows = written(_scored(spark, d).withColumn("seq", F.lit(1)), "results")
    e = exporting.evidence_columns(rows)
    keep = ("robots_status", "robots_tokens_named", "sitemap_kind", "sitemap_newest", "llms_status", "markdown_served", "lang", "description_length", "og_title", "https_redirect", "rest_index", "api_catalog", "datasets", "newest_year", "third_party_scripts", "divergent", "has_main")
    return e.select("host", *(F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in keep))


def capture_scores(spark, d):
    return exporting.both_scores(_scored(spark, d).withColumn("seq", F.lit(1))).select("host", "score", F.col("measured_rows").cast("int").alias("measured_rows"), F.col("blocked_rows").cast("int").alias("blocked_rows"))


def waf_and_blocks(spark, d):
    """Block pages, firewalls and challenge pages by the fixed tables, each entry met once."""
    rows = [(k, *c) for k, c in enumerate(_BLOCKS)]
    df = spark.createDataFrame(rows, "id int, body string, headers map<string,string>, cookies string, title string")
    c = verdicts.classify_body(F.col("body"), verdicts.BLOCK_PATTERNS)
    return df.select("id", c["body_class"].alias("body_class"), c["is_block_page"].cast("int").alias("blocked"), F.array_join(verdicts.fingerprint_waf(F.col("headers"), F.col("cookies")), ",").alias("waf"), text.is_challenge(F.col("title"), F.col("body")).cast("int").alias("challenge"))


_LONG = "The town board meets on the first Monday of the month in the hall. " * 4
_BLOCKS = [
    ("<h1>Access Denied</h1>", {}, None, None),
    ("You don't have permission to access this server", {"X-Akamai-Request": "1"}, None, None),
    ("Reference #18.2f", {"CF-Ray": "1"}, None, None),
    ("see errors.edgesuite.net", {"x-cdn": "1"}, None, None),
    ("Attention Required! | Cloudflare", {"X-Amz-Cf-Id": "1"}, None, "Attention Required!"),
    ("cf-browser-verification", {"X-Served-By": "cache"}, None, None),
    ("Incapsula incident id: 1", {}, "_abck=1", None),
    ("Request unsuccessful. Incapsula", {}, "__cf_bm=1", None),
    ("<title>Just a moment...</title>", {}, "visid_incap_1=2", "Just a moment..."),
    ("Bot detection is on", {"server": "AkamaiGHost"}, None, None),
    ("Your request has been blocked", {"x-served-by": "a", "cf-cache-status": "HIT"}, "bm_so=1", None),
    ("short", {}, None, "Access denied"),
    (_LONG, {"content-type": "text/html"}, "a=b", "Town"),
    (_LONG * 30 + "access denied", None, None, None),
    (None, None, None, None),
]

QUERIES = {f.__name__: f for f in (capture_verdicts, capture_evidence, capture_scores, waf_and_blocks)}

_TESTS = "W1 W2 W3 W6 M1 M2 M3 M4 M5 R1 R2 R3 I1 I2 I3 I4 I5 D1 D2 D3 D4 D5 F1 F2 F3 F4 P1 P2 P3 P4 C1".split()
#: What each test must say of each story, in the order of _TESTS, and W4 of research, gptbot, claudebot and all of them.
_EXPECTED = [
    "pass pass reported reported pass pass reported pass reported pass reported reported pass pass pass reported reported pass reported reported reported pass pass reported pass pass reported reported reported reported reported",
    "fail fail reported reported fail fail na fail reported fail reported reported fail fail fail reported reported fail reported reported reported na na reported na fail reported reported reported reported reported",
    "blocked blocked blocked blocked blocked blocked na blocked blocked blocked reported blocked blocked blocked blocked blocked reported blocked blocked blocked blocked na blocked reported fail blocked na na na na reported",
    "na na na na na na na na na na reported na na na na na reported na na na na na na na na na na na na na reported",
    "fail fail reported reported fail fail na partial reported partial reported reported partial partial partial reported reported fail reported reported reported fail fail reported fail pass reported reported reported reported reported",
    "fail fail reported reported fail fail na fail reported fail reported fail fail fail fail fail reported fail fail reported reported na fail reported pass fail na na na na reported",
]
_DOORS = ["pass blocked pass partial", "pass pass pass pass", "blocked blocked blocked blocked", "na na na na", "pass fail pass partial", "fail fail fail fail"]
_SAID = [
    (s, t, i, v)
    for s, (row, doors) in enumerate(zip(_EXPECTED, _DOORS))
    for t, i, v in [*((t, "research", v) for t, v in zip(_TESTS, row.split(), strict=True)), *(("W4", i, v) for i, v in zip(("research", "gptbot", "claudebot", "all_ai"), doors.split(), strict=True))]
]
_HOSTS = f"(select id || '.example' as host, name, length(id) % {len(_STORIES)} as story, length(id) as n from registry)"


def _case(column: str, values: list) -> str:
    return f"case story {' '.join(f'when {k} then {v!r}' for k, v in enumerate(values))} end as {column}"


ORACLE = {
    "capture_verdicts": f"select host, test, identity, verdict from {_HOSTS} join (values {', '.join(map(str, _SAID))}) e(story, test, identity, verdict) using (story) union all select host, 'W5', 'research', 'reported' from {_HOSTS} where story in (0, 1, 4, 5)",
    "capture_evidence": f"""select host, {', '.join((
        _case('robots_status', ['200', '404', '403', '-', '200', '500']), _case('robots_tokens_named', ['["GPTBot"]', '-', '-', '-', '-', '-']), _case('sitemap_kind', ['urlset', 'invalid', '-', '-', 'invalid', 'invalid']), _case('sitemap_newest', ['2026-01-02', '-', '-', '-', '-', '-']),
        _case('llms_status', ['200', '404', '403', '-', '200', '500']), _case('markdown_served', ['true', 'false', 'false', 'false', 'false', 'false']), _case('lang', ['en', '-', '-', '-', '-', '-']), _case('description_length', ['84', '0', '-', '-', '13', '-']), _case('og_title', ['Office', '-', '-', '-', 'Half', '-']),
        _case('https_redirect', ['true', 'false', 'false', 'false', 'false', 'false']), _case('rest_index', ['true', 'false', '-', '-', 'false', 'false']), _case('api_catalog', ['true', 'false', '-', '-', 'false', 'false']), _case('datasets', ['2', '-', '-', '-', '-', '-']), _case('newest_year', ['2026', '-', '-', '-', '2019', '-']),
        _case('third_party_scripts', ['1', '0', '-', '-', '0', '-']), _case('divergent', ['[]', '[]', '-', '-', '[]', '[]']), _case('has_main', ['true', 'false', '-', '-', 'false', '-']),
    ))} from {_HOSTS}""",
    "capture_scores": f"select host, cast(score as double) as score, {_case('measured_rows', [12, 11, 0, 0, 12, 12])}, {_case('blocked_rows', [0, 0, 12, 0, 0, 0])} from (select *, {_case('score', [11.5, 1.0, 0.0, 0.0, 3.0, 0.0])} from {_HOSTS})",
    "waf_and_blocks": "select * from (values (0, 'access_denied', 1, '', 1), (1, 'akamai_denied', 1, 'akamai', 0), (2, 'akamai_reference', 1, 'cloudflare', 0), (3, 'akamai_edgesuite', 1, 'imperva', 0), (4, 'cloudflare_challenge', 1, 'aws_cloudfront', 1), (5, 'cloudflare_challenge', 1, 'fastly', 0), (6, 'imperva_incapsula', 1, 'akamai_botmanager', 0), (7, 'imperva_incapsula', 1, 'cloudflare', 0), (8, 'cloudflare_jschallenge', 1, 'imperva_incapsula', 1), (9, 'generic_bot_challenge', 1, 'akamai', 0), (10, 'generic_blocked', 1, 'akamai_botmanager,cloudflare,fastly', 0), (11, 'near_empty', 0, '', 1), (12, 'content', 0, '', 0), (13, 'content', 0, '', 0), (14, 'near_empty', 0, '', 0)) v(id, body_class, blocked, waf, challenge)",
}
