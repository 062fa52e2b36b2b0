"""Columns of the wide export from verdict rows, and small rules around runs, captures and reviews."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import hosts, text
from plumbline.operators import resolve, scoring

# Boroughs behind the letters of a board's code, places a run can be sent from.
BOROUGHS = {"MN": "manhattan", "BX": "bronx", "BK": "brooklyn", "QN": "queens", "SI": "staten-island"}
PLACES = ("office", "home", "cloud")

#: Evidence columns of the export: name, test, path in its evidence, type.
EVIDENCE_COLUMNS = (
    ("robots_status", "W1", "$.status", "int"),
    ("robots_tokens_named", "W2", "$.tokens_named", "string"),
    ("sitemap_url", "M2", "$.url", "string"),
    ("sitemap_kind", "M2", "$.kind", "string"),
    ("sitemap_count", "M2", "$.count", "int"),
    ("sitemap_newest", "M3", "$.newest", "string"),
    ("llms_status", "M4", "$.status", "int"),
    ("llms_full_present", "M5", "$.present", "boolean"),
    ("words", "R1", "$.words", "int"),
    ("markdown_served", "R2", "$.markdown_served", "boolean"),
    ("markdown_advertised", "R2", "$.advertised", "string"),
    ("lang", "R3", "$.lang", "string"),
    ("landmarks", "R3", "$.landmarks", "string"),
    ("description_length", "I1", "$.length", "int"),
    ("og_title", "I2", "$.title", "string"),
    ("og_site_name", "I2", "$.site_name", "string"),
    ("names_agree", "I4", "$.names_agree", "boolean"),
    ("https_redirect", "I5", "$.http_redirects_to_https", "boolean"),
    ("http_status", "I5", "$.http_status", "int"),
    ("data_links", "D2", "$.count", "int"),
    ("rest_index", "D3", "$.rest_index", "boolean"),
    ("api_catalog", "D4", "$.present", "boolean"),
    ("datasets", "D5", "$.datasets", "int"),
    ("newest_year", "F1", "$.newest", "int"),
    ("cms", "C1", "$.cms", "string"),
    ("third_party_scripts", "P4", "$.third_party_script_hosts", "int"),
    ("divergent", "W5", "$.divergent", "string"),
)


def evidence_columns(results: DataFrame, key: str = "host", order: str = "seq") -> DataFrame:
    """EXP-16, 17, 22 to 29, 31: one row per host with what its tests' evidence says; a test that didn't run, and a blank
    text, is null, an empty list is not. One aggregate: each test's first row gives all its columns."""
    tests = dict.fromkeys(t for _, t, _, _ in EVIDENCE_COLUMNS)
    first = results.groupBy(key).agg(*(F.min_by("evidence", F.when(F.col("test") == t, F.col(order))).alias(t) for t in tests))
    value = lambda t, p, kind: F.nullif(F.get_json_object(t, p), F.lit("")).try_cast(kind)
    out = first.select(key, *(value(t, p, kind).alias(n) for n, t, p, kind in EVIDENCE_COLUMNS))
    return out.withColumn("has_main", F.col("landmarks").contains('"main"'))


def page_rows(results: DataFrame) -> DataFrame:
    """EXP-2, 3, 32: targets of a page run, from the first row of each page."""
    return scoring.first_rows(results.where("page_url is not null").select("page_url", "host", "entity_id", "seq"), ["page_url"], "seq")


def hosts_visited(results: DataFrame) -> DataFrame:
    """EXP-13."""
    return results.where("page_url is null").select("host").distinct()


def owner_name(names: Column, ids: Column) -> Column:
    """EXP-14: nobody owns a host that several share."""
    return F.when(F.coalesce(F.size(ids), F.lit(0)) <= 1, F.get(names, F.lit(0)))


def divergent_list(ran: Column, divergent: Column) -> Column:
    """EXP-21: null if the test didn't run, else a list that may be empty."""
    return F.when(ran, F.sort_array(F.coalesce(divergent, F.array().cast("array<string>"))))


def both_scores(results: DataFrame, key: str = "host", order: str = "seq") -> DataFrame:
    """EXP-23."""
    s = scoring.scores(scoring.host_verdicts(results, key, order))
    return s.select(key, "score", "measured_rows", "blocked_rows", "na_rows")


def board_entity(code: Column) -> Column:
    """PRJ-15: a community board's entity from its code; null for other codes."""
    c = F.upper(F.trim(code))
    rx = r"^(MN|BX|BK|QN|SI)0?(\d{1,2})$"
    borough = F.coalesce(*(F.when(F.regexp_extract(c, rx, 1) == k, v) for k, v in BOROUGHS.items()))
    return F.when(c.rlike(rx), F.concat(borough, F.lit("-community-board-"), F.regexp_extract(c, rx, 2).try_cast("int").cast("string")))


def top_level_rules(rules: DataFrame) -> DataFrame:
    """SRC-18: suffix rules of one label."""
    return rules.where("kind = 'rule' and instr(rule, '.') = 0").select("rule")


def portal_lists(config: DataFrame) -> dict[str, list[str]]:
    """SRC-31: one config row (hosts, host_suffixes, url_prefixes) as lists in lower case."""
    r = config.first()
    return {k: [x.lower().rstrip("/") if k == "url_prefixes" else x.lower() for x in (r[k] or [])] for k in ("hosts", "host_suffixes", "url_prefixes")}


def site_slug(path: Column) -> Column:
    """MSC-30."""
    return F.nullif(F.regexp_extract(path, "^/site/([^/]+)/", 1), F.lit(""))


def html_slug(path: Column) -> Column:
    """MSC-31."""
    return F.nullif(F.regexp_extract(path, "^/html/([^/]+)/", 1), F.lit(""))


def candidate_plan(blocked: DataFrame, tails: list[str], limit: int) -> DataFrame:
    """MSC-32: (id, rank, url): addresses to try for each entity, best first."""
    return blocked.select("id", F.posexplode(hosts.candidate_urls(F.col("start_url"), tails, limit)).alias("rank", "url"))


def page_kind(url: Column) -> Column:
    """MSC-53."""
    return F.when(hosts.url_path(url) == "/robots.txt", "robots").otherwise("page")


def as_chrome(agent: Column) -> Column:
    """MSC-51: a browser's own name without the mark of the headless one."""
    return F.replace(agent, F.lit("HeadlessChrome"), F.lit("Chrome"))


def browser_capture(rows: DataFrame) -> DataFrame:
    """MSC-52: what a browser saw, in the shape of a captured response."""
    return rows.select(
        "host", F.lit("home").alias("kind"), F.lit("browser").alias("identity"), "seq", "url", "final_url", "status", "headers", "body", F.lit(None).cast("binary").alias("raw"), F.lit(None).cast("boolean").alias("is_block_page"),
        F.lit(None).cast("string").alias("body_class"), F.col("error").alias("transport_error"), F.when(F.col("error").isNotNull(), "other").alias("transport_kind"), F.lit(False).alias("quarantined"), F.lit(False).alias("offhost_redirect"),
        F.array().cast("array<struct<status:int,location:string>>").alias("redirects"), F.octet_length("body").cast("long").alias("bytes"),
    )


def place_sent_from(vantage: Column) -> Column:
    """SCL-37."""
    v = F.lower(F.trim(vantage))
    return F.when(v.isin(*PLACES), v)


def network_record(vantage: Column, start: Column, end: Column) -> Column:
    """MSC-54, SCL-38: struct(place, start, end, changed); changed is null unless both readings worked."""
    return F.struct(place_sent_from(vantage).alias("place"), start.alias("start"), end.alias("end"), scoring.network_change(start, end).alias("changed"))


def lookup_data(body: Column) -> Column:
    """MSC-55, SCL-19: struct(data, problem) of a lookup service's answer: JSON with status ok and a data object."""
    doc = F.try_parse_json(body)
    status = F.try_variant_get(doc, "$.status", "string")
    data = F.get_json_object(body, "$.data")
    problem = F.when(doc.isNull(), "no JSON").when(F.coalesce(status, F.lit("")) != "ok", F.concat(F.lit("status "), F.coalesce(status, F.lit("missing")))).when(~F.coalesce(F.ltrim(data).startswith("{"), F.lit(False)), "no data object")
    return F.struct(F.when(problem.isNull(), data).alias("data"), problem.alias("problem"))


def sha256(c: Column) -> Column:
    """SCL-1: of text or bytes; null counts as empty."""
    return F.sha2(F.coalesce(c.cast("binary"), F.lit(b"")), 256)


def names_overlap(a: Column, b: Column) -> Column:
    """SET-2: whether two lists of names have one in common after normalising."""
    norm = lambda xs: F.filter(F.transform(xs, lambda x: text.norm_name(x)), lambda k: k != "")
    return F.coalesce(F.arrays_overlap(norm(a), norm(b)), F.lit(False))


def best_rule(rules: DataFrame, by: str) -> DataFrame:
    """WIN-12: the longest of a group's matching rules, allow before disallow at a tie. ``rules(kind, path)``."""
    return rules.groupBy(by).agg(F.max_by(F.struct("kind", "path"), F.struct(F.length("path").alias("n"), (F.col("kind") == "allow").alias("ok"))).alias("rule")).select(by, "rule.*")


def review_order(items: DataFrame, rank: dict[str, int]) -> DataFrame:
    """SRT-1, 2, 3: review items by rank of their section, subject, reason and payload, as a sink writes them."""
    r = F.coalesce(*(F.when(F.col("section") == k, v) for k, v in rank.items()), F.lit(len(rank)))
    return items.orderBy(r, F.coalesce("subject", F.lit("")), "reason", F.to_json(F.struct(*items.columns)))


def only_hosts(jobs: DataFrame, names: DataFrame, limit: int | None = None) -> DataFrame:
    """SRT-5: the jobs of named hosts, and the first of them if a limit is asked for."""
    kept = jobs.join(names.select("host").distinct(), "host", "left_semi")
    return kept.orderBy("seq").limit(limit) if limit else kept


def split_by_load(loads: dict[str, int], workers: int) -> list[list[str]]:
    """WIN-10: hosts to workers, largest first to the least loaded; a scheduler's list on the driver, not a query."""
    heap, out = [(0, k) for k in range(workers)], [[] for _ in range(workers)]
    for host, n in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        load, k = heapq.heappop(heap)
        out[k].append(host)
        heapq.heappush(heap, (load + n, k))
    return out


def refusing_hosts(log: DataFrame, trip: int = 4) -> DataFrame:
    """STR-7: hosts at which a crawl gives up: so many refusals in a row, set back by a success. ``log(host, seq,
    status)``."""
    from plumbline.operators import runlog

    b = runlog.breakers(log, "host", "seq", F.col("status") == 403, F.col("status") == 200, trip)
    return b.where("tripped").groupBy("host").agg(F.min("seq").alias("at"))


def confirm_websites(scans: DataFrame, places: DataFrame, owned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOIN-20: websites confirmed by their titles: (checks, counts of outcomes). ``scans(entity_id, level, place, title,
    final_host, base_domain, body_class)``, ``places(level, place)``, ``owned(host)``.

    A scan counts if the page has content, its host is a registered domain of its own, and its title names the place and,
    where places of that name have several levels, or it is a county, the level. One such host per entity, that no other
    entity has or came to, is its primary.
    """
    content = scans.where("body_class = 'content'").withColumn("host", hosts.strip_www(F.lower("final_host"))).where(hosts.host_ok(F.col("final_host"), F.col("base_domain")))
    named = resolve.title_places(content.withColumn("page_id", F.xxhash64("entity_id", "title")), places)
    rivals = places.groupBy("place").agg(F.collect_set("level").alias("levels"))
    j = content.withColumn("page_id", F.xxhash64("entity_id", "title")).join(named, ["page_id", "place"], "left_semi").join(rivals, "place")
    ok = j.where(resolve.title_names_level(F.col("title"), F.col("level"), F.col("place"), (F.size("levels") > 1) | (F.col("level") == "county"), F.col("levels")))
    per = ok.groupBy("entity_id").agg(F.countDistinct("host").alias("n"), F.min("host").alias("host"))
    claims = ok.groupBy("host").agg(F.countDistinct("entity_id").alias("claims"))
    out = per.join(claims, "host", "left").join(owned.select(hosts.strip_www(F.col("host")).alias("host"), F.lit(True).alias("taken")).distinct(), "host", "left")
    outcome = F.when(F.col("n") > 1, "several_hosts").when(F.col("claims") > 1, "host_shared").when(F.col("taken"), "host_owned").otherwise("confirmed")
    decided = out.withColumn("outcome", outcome)
    return decided.where("outcome = 'confirmed'").select(F.col("entity_id").alias("unit_id"), "host"), decided.groupBy("outcome").agg(F.count("*").alias("n"))


def queue_lines(rows: DataFrame) -> DataFrame:
    """MSC-33, SRT-3: lines of a review queue with their place in it."""
    w = Window.orderBy("status_rank", "id")  # a queue that people work off: as long as they can read
    return rows.withColumn("line", F.concat(F.lit("| `"), "id", F.lit("` | "), F.coalesce("status", F.lit("")), F.lit(" | "), F.coalesce("note", F.lit("")), F.lit(" |"))).withColumn("n", F.row_number().over(w)).select("n", "line")


def rewrite_descriptions(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """SNK-14: a description document with the entities crawled anew replaced."""
    return existing.join(fresh.select("id"), "id", "left_anti").unionByName(fresh)


def is_city_row(kind: Column, name: Column) -> Column:
    """MSC-19: rows of a state's list that are parts of the one big city."""
    return (kind == "Borough/County") | ((kind == "City") & text.place_key(name).isin("newyork", "newyorkcity"))
