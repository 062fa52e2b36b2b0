"""Queries over hosts, names and records of the registry and its sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import hosts, text
from plumbline.operators import inventory, quality, resolve
from plumbline.session import table

_L = F.lit


def _urls(spark: SparkSession, d: str) -> DataFrame:
    """Every address of the listing and every domain of the registry's properties."""
    a = table(spark, d, "state_listing").select(F.col("url"))
    b = table(spark, d, "registry").select(F.explode("web_properties").alias("w")).select(F.col("w.domain").alias("url"))
    return a.unionByName(b).where("url is not null").distinct()


_URLS = "(select distinct url from (select url from state_listing union all select w.domain as url from (select unnest(web_properties) as w from registry)) where url is not null)"
_SCHEMED = "(case when contains(trim(url), '//') then trim(url) else 'https://' || trim(url) end)"
_HOST = f"nullif(lower(regexp_replace(regexp_replace(regexp_extract({_SCHEMED}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1), '^.*@', ''), ':\\d*$', '')), '')"
_PATH = f"(case when regexp_extract({_SCHEMED}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//[^/?#]*([^?#]*)', 1) = '/' then '' else regexp_extract({_SCHEMED}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//[^/?#]*([^?#]*)', 1) end)"
_QUERY = "regexp_extract(url, '\\?([^#]*)', 1)"
_AKEY = f"(regexp_replace(regexp_replace({_HOST}, '\\.+$', ''), '^www\\.', '') || regexp_replace({_PATH}, '/+$', '') || case when {_QUERY} <> '' then '?' || {_QUERY} else '' end)"
_NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
_SLUG = "(case when regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') = '' then 'entity' else regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') end)"


def host_parse(spark, d):
    u = F.col("url")
    return _urls(spark, d).select("url", hosts.url_host(u).alias("host"), hosts.url_path(u).alias("path"), hosts.host_path(u)["path"].alias("path_query"))


def host_keys(spark, d):
    h = hosts.url_host(F.col("url"))
    return _urls(spark, d).select(h.alias("host")).distinct().select("host", hosts.strip_www_digits(F.col("host")).alias("key_digits"), hosts.strip_www(F.col("host")).alias("key_www"))


def host_valid(spark, d):
    return _urls(spark, d).select(hosts.url_host(F.col("url")).alias("host")).distinct().select("host", hosts.host_is_valid(F.col("host"), ["example"]).cast("int").alias("valid"), hosts.tld(F.col("host")).alias("tld"))


def _bases(spark, d):
    h = _urls(spark, d).select(hosts.url_host(F.col("url")).alias("host")).where("host is not null").distinct()
    return hosts.with_base_domain(h, "host", hosts.suffix_rules(spark))


def base_domain(spark, d):
    return _bases(spark, d)


def address_key_dedup(spark, d):
    rows = _urls(spark, d).withColumn("address_key", hosts.address_key(F.col("url")))
    return rows.groupBy("address_key").agg(F.min("url").alias("first_url"), F.count("*").alias("n"))


def below_marked_host(spark, d):
    marks = table(spark, d, "registry").select(F.explode("web_properties").alias("w")).where("w.role = 'primary'").select(hosts.url_host(F.col("w.domain")).alias("mark")).distinct()
    b = _bases(spark, d)
    return hosts.below_marked(b, "host", "base_domain", marks, "mark").select("host", "marked_above")


def subsite_kind(spark, d):
    rows = table(spark, d, "registry").select("id", F.explode("web_properties").alias("w")).select("id", hosts.url_host(F.col("w.domain")).alias("host"))
    base = hosts.with_base_domain(rows.groupBy("host").agg(F.collect_set("id").alias("ids")), "host", hosts.suffix_rules(spark))
    # the base itself is listed too, with the same owners
    roots = base.select(F.col("base_domain").alias("host"), "ids", "base_domain").where("host is not null")
    every = base.unionByName(roots.select(*base.columns)).groupBy("host").agg(F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"), F.min("base_domain").alias("base_domain"))
    return hosts.subsite_of(every, "host", "base_domain", "ids").select("host", "parent_site")


def infra_label_filter(spark, d):
    return _bases(spark, d).where("base_domain is not null").select("host", hosts.is_infra(F.col("host"), F.col("base_domain")).cast("int").alias("infra"), hosts.on_vendor(F.col("base_domain")).cast("int").alias("vendor"), hosts.is_machine_endpoint(F.concat(_L("https://"), "host")).cast("int").alias("machine"))


def _rollup_rows(spark, d):
    reg = table(spark, d, "registry").select("id", "name", "government_level", F.posexplode("web_properties").alias("pos", "w")).select(F.col("w.domain").alias("url"), "name", F.col("id").alias("entity_id"), F.col("government_level").alias("level"), _L(None).cast("string").alias("kind"), F.concat_ws(" ", "id", F.lpad("pos", 4, "0")).alias("seq"))
    lst = table(spark, d, "state_listing").select("url", F.col("agency").alias("name"), _L(None).cast("string").alias("entity_id"), _L("state").alias("level"), _L("portal").alias("kind"), F.concat_ws(" ", F.lpad("entry_no", 12, "0"), "snapshot_date", "loaded_at").alias("seq"))
    return inventory.union_sources([("registry", reg), ("state_listing", lst)])


def host_rollup(spark, d):
    """One row per host over the registry and the state listing: the flagship."""
    r = inventory.host_rollup(_rollup_rows(spark, d))
    j = lambda c: F.coalesce(F.array_join(c, "; "), _L(""))
    return r.select("host_key", "host", F.coalesce(F.size("names"), _L(0)).cast("bigint").alias("n_names"), j("ids").alias("ids"), j("levels").alias("levels"), F.coalesce(F.size("paths"), _L(0)).cast("bigint").alias("n_paths"), j("sources").alias("sources"), "agency", "kind", "records")


_ROLL = f"""
with rows as (
  select w.domain as url, name, id as entity_id, government_level as level, null as kind, 0 as p, id || ' ' || lpad(cast(pos - 1 as varchar), 4, '0') as seq, 'registry' as source
  from (select id, name, government_level, unnest(web_properties) as w, unnest(range(1, len(web_properties) + 1)) as pos from registry)
  union all select url, agency, null, 'state', 'portal', 1, lpad(cast(entry_no as varchar), 12, '0') || ' ' || cast(snapshot_date as varchar) || ' ' || cast(loaded_at as varchar), 'state_listing' from state_listing
), parsed as (
  select *, {_HOST} as host, {_PATH} as path, regexp_replace({_HOST}, '^www\\.', '') as host_key,
    (contains(lower(url), '/rest/services') or contains(lower(url), '/api/') or lower(url) like '%/api' or contains(lower(url), '/odata/') or lower(url) like '%.json' or lower(url) like 'https://api.%' or contains(lower(url), '/wfs') or contains(lower(url), '/wms')) as machine
  from rows where {_HOST} is not null
)
select host_key, arg_min(host, (p, seq)) as host, count(distinct name) as n_names, coalesce(string_agg(distinct entity_id, '; ' order by entity_id), '') as ids,
  coalesce(string_agg(distinct level, '; ' order by level), '') as levels, count(distinct nullif(path, '')) as n_paths,
  coalesce(string_agg(distinct source, '; ' order by source), '') as sources,
  case when count(distinct entity_id) <= 1 then arg_min(name, (p, seq)) filter (path = '' and name is not null) end as agency,
  case when bool_or(coalesce(kind, '') <> 'portal') then 'main site' when bool_and(machine) then 'API' else 'data portal' end as kind, count(*) as records
from parsed group by host_key"""


def inventory_union(spark, d):
    reg = table(spark, d, "registry").select("name", F.explode("web_properties").alias("w")).select(F.col("w.domain").alias("address"), _L("main site").alias("kind"), "name", _L("2026-01-01").alias("date_found"), F.concat_ws(" ", "w.domain", "name").alias("seq"))
    lst = table(spark, d, "state_listing").select(F.col("url").alias("address"), _L("listed page").alias("kind"), F.col("agency").alias("name"), F.date_format("snapshot_date", "yyyy-MM-dd").alias("date_found"), F.concat_ws(" ", "snapshot_date", F.lpad("entry_no", 12, "0"), "loaded_at", "url").alias("seq"))
    return inventory.address_inventory(inventory.union_sources([("registry", reg), ("listing", lst)])).select("address_key", "kind", "date_found", "sources")


_INV = f"""
with rows as (
  select w.domain as url, 'main site' as kind, '2026-01-01' as d, 0 as p, 'registry' as source, w.domain || ' ' || name as seq from (select name, unnest(web_properties) as w from registry)
  union all select url, 'listed page', strftime(snapshot_date, '%Y-%m-%d'), 1, 'listing', '' from state_listing
), k as (select *, {_AKEY} as address_key from rows)
select address_key, arg_min(kind, p) as kind, min(d) as date_found, case when count(distinct source) = 2 then 'registry; listing' else min(source) end as sources
from k where address_key is not null group by address_key"""


def source_counts(spark, d):
    rows = inventory_union(spark, d).select(F.split_part("sources", _L(";"), _L(1)).alias("source"))
    return inventory.counts_of(rows, "source", ["registry", "listing", "portals"])


def deep_page_targets(spark, d):
    shared = inventory.tenants(_properties(spark, d).withColumn("role", _L("primary"))).select("host_key", F.array(_L("a"), _L("b")).alias("ids"))
    lst = table(spark, d, "state_listing").where("url is not null").groupBy("url").agg(F.min("entry_no").alias("seq"))
    fixes = lst.where("seq % 7 = 0").select("url", F.when(F.col("seq") % 2 == 0, "gone").otherwise("moved").alias("issue"), F.concat("url", _L("-new")).alias("moved_to"))
    pages = lst.unionByName(_properties(spark, d).select(F.concat(_L("https://"), F.lower(F.trim("domain")), _L("/about")).alias("url"), _L(0).cast("bigint").alias("seq")).distinct())
    return inventory.deep_pages(shared, pages, fixes).select("page_key", (F.col("moved_from").isNotNull()).cast("int").alias("moved"))


def _properties(spark, d):
    return table(spark, d, "registry").select(F.col("id").alias("entity_id"), F.explode("web_properties").alias("w")).select("entity_id", "w.domain", "w.role")


def representative_address(spark, d):
    rank = F.when(F.col("role") == "primary", 0).when(F.col("role") == "microsite", 1).otherwise(2)
    base = hosts.with_base_domain(_properties(spark, d).withColumn("h", hosts.url_host(F.col("domain"))), "h", hosts.suffix_rules(spark))
    t = base.select(F.col("base_domain").alias("host"), F.col("domain").alias("url"), rank.alias("kind_rank"), F.col("role").alias("kind"), "entity_id", F.concat_ws(" ", "entity_id", "domain").alias("seq")).where("host is not null")
    return inventory.representative(t).select("host", "url", F.array_join("kinds", ",").alias("kinds"), F.size("entity_ids").cast("bigint").alias("n_entities"))


def host_tenants(spark, d):
    return inventory.tenants(_properties(spark, d)).select("host_key", F.array_join("ids", ",").alias("ids"))


def norm_names(spark, d):
    n = F.col("name")
    return table(spark, d, "registry").select("id", text.norm_name(n).alias("norm"), text.slug(n).alias("slug"), text.place_key(n).alias("place_key"), text.norm_title(n).alias("title"), text.token_key(n).alias("token"))


def page_names(spark, d):
    return table(spark, d, "agency_contacts").select("agency").distinct().select("agency", text.norm_page_name(F.col("agency")).alias("page_name"), text.drop_level_prefix(F.col("agency")).alias("place"))


def lpad_code(spark, d):
    c = table(spark, d, "registry").select("id", F.explode("identifiers").alias("i")).select("id", "i.scheme", "i.identifier")
    return c.select("id", "scheme", text.digit_code(F.col("identifier"), 9).alias("code"))


def org_classify(spark, d):
    g = text.classify_government(F.col("name"))
    return table(spark, d, "registry").select("id", g["tier"].alias("tier"), g["place"].alias("place"))


def partial_dates(spark, d):
    return table(spark, d, "web_property_updates").select("entity_id", "domain", "valid_from", F.date_format(text.partial_date(F.col("valid_from")), "yyyy-MM-dd").alias("first_day")).distinct()


def address_lines(spark, d):
    c = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"])
    return c.select("contact_id", text.address_line(F.col("address_line_1"), _L(None).cast("string"), F.col("city"), F.col("state"), F.col("zip")).alias("line"))


def name_index(spark, d):
    r = resolve.inverted(table(spark, d, "registry"), text.norm_name(F.col("short_name")), "id")
    return r.select("key", F.array_join("owners", ",").alias("owners"), "n")


def domain_index(spark, d):
    r = resolve.inverted(_properties(spark, d), hosts.strip_www_digits(hosts.url_host(F.col("domain"))), "entity_id")
    return r.select("key", F.array_join("owners", ",").alias("owners"), "n")


def _entities(spark, d):
    return table(spark, d, "registry").select("id", F.xxhash64("id").alias("ord"), "name", F.coalesce("identifiers", F.expr(f"cast(array() as {resolve.PAIR})")).alias("pairs"))


def identifier_match(spark, d):
    reg = table(spark, d, "registry")
    none = F.expr(f"cast(array() as {resolve.PAIR})")
    records = reg.select(F.concat(_L("r-"), "id").alias("rec_id"), F.xxhash64("id").alias("seq"), F.when(F.length("id") % 2 == 0, F.col("name")).otherwise(F.concat(_L("New "), "name")).alias("name"), F.when(F.length("id") % 3 == 0, F.coalesce("identifiers", none)).otherwise(none).alias("pairs"), _L(None).cast("string").alias("match_entity_id"), _L(None).cast("string").alias("mint_id"))
    unique = _entities(spark, d).withColumn("ord", _L(1))
    return resolve.match_batch(records, unique).select("rec_id", F.when(F.col("how") == "identifier", F.col("entity_id")).alias("by_pair"), (F.col("how").isNull()).cast("int").alias("unmatched"))


def mint_ids(spark, d):
    used = table(spark, d, "registry").select("id")
    rows = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"]).where("agency is not null")
    return resolve.mint_ids(rows.select("contact_id", "agency"), "agency", "contact_id", used, "minted").select("contact_id", "minted")


def collision_suffix(spark, d):
    rows = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"]).where("agency is not null").select("contact_id", text.slug(F.col("agency")).alias("slug"), text.slug(F.coalesce("city", _L("nowhere"))).alias("place"))
    return resolve.collision_suffix(rows, "slug", F.col("place"), "new_id").select("contact_id", "new_id")


def code_shared_nullify(spark, d):
    rows = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"]).select("contact_id", "phone")
    return resolve.nullify_shared(rows, "phone")[0]


def _greenbook(spark, d):
    return table(spark, d, "greenbook_enrichment").dropDuplicates(["enrichment_id"])


def distinctive_match(spark, d):
    root = lambda h: F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1)
    props = _properties(spark, d).withColumn("root", root(hosts.url_host(F.col("domain"))))
    host_index = resolve.inverted(props, F.col("root"), "entity_id")
    names = resolve.inverted(table(spark, d, "registry"), text.norm_name(F.col("name")), "id")
    g = _greenbook(spark, d).select(F.col("enrichment_id").alias("cand_id"), F.col("matched_from.agency_name").alias("name"), F.transform(F.coalesce("web_candidates", F.array().cast("array<string>")), lambda w: root(hosts.messy_host(w))).alias("hosts"))
    return resolve.distinctive_match(g, host_index, names).select(F.col("cand_id").alias("enrichment_id"), "decision", "reason", "entity_id", F.coalesce(F.col("name_divergent").cast("int"), _L(-1)).alias("name_divergent"))


def one_to_one_match(spark, d):
    left = _greenbook(spark, d).select(F.col("enrichment_id").alias("left_id"), text.norm_name(F.col("matched_from.agency_name")).alias("key"))
    right = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"]).select(F.col("contact_id").alias("right_id"), text.norm_name(F.col("agency")).alias("key"))
    m = resolve.one_to_one(left, right, "key")
    said = lambda c: F.coalesce(F.col(c).cast("string"), _L(""))
    return m.select(said("left_id").alias("left_id"), said("right_id").alias("right_id"), "reason")


def multiset_match_rate(spark, d):
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 2000).alias("band"))
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 2000).alias("band"))
    m = resolve.multiset_match(a, b, ["nation", "band"])
    return resolve.match_rate(m, "nation", "matched")


def reconcile_tiers(spark, d):
    reg = table(spark, d, "registry")
    key = lambda c, p: reg.select(text.norm_name(F.col(c)).alias("key"), _L(p).alias("priority"), F.col("id").alias("ord"), F.col("id").alias("entity_id"), F.col("government_level").alias("level")).where("key <> ''")
    keys = key("short_name", 0).unionByName(key("name", 1))
    rows = table(spark, d, "agency_contacts").dropDuplicates(["contact_id"]).select(F.col("contact_id").alias("row_id"), F.col("agency").alias("name"), F.col("agency").alias("acronym"))
    return resolve.reconcile(rows, keys, _L("authority"))


def website_rule(spark, d):
    a = _properties(spark, d).select(F.col("entity_id").alias("unit_id"), F.regexp_extract(hosts.url_host(F.col("domain")), r"([^.]+\.[^.]+)$", 1).alias("host"), _L("registry").alias("source"), _L("").alias("path"))
    g = _greenbook(spark, d).where("entity_id is not null").select(F.lower(F.trim("entity_id")).alias("unit_id"), F.explode("web_candidates").alias("u"))
    b = g.select("unit_id", hosts.messy_host(F.col("u")).alias("host"), _L("greenbook").alias("source"), _L("").alias("path"))
    owned = a.where("length(host) % 5 = 0").select("host")
    return resolve.website_rule(a.unionByName(b), owned)


def enrichment_additive(spark, d):
    ents = table(spark, d, "registry").select("id", F.transform("other_names", lambda o: o["name"]).alias("names"))
    adds = _greenbook(spark, d).where("entity_id is not null").select(F.col("entity_id").alias("id"), F.col("matched_from.agency_name").alias("value"), F.col("enrichment_id").alias("ord")).where("value is not null")
    out = resolve.append_missing(ents, adds, "names")
    return out.select("id", F.array_join("names", "|").alias("names"))


def enrichment_skipped(spark, d):
    adds = _greenbook(spark, d).where("entity_id is not null").select("entity_id").distinct()
    return resolve.unmatched(adds, table(spark, d, "registry"), "entity_id")


def recovery_merge_lattice(spark, d):
    t = table(spark, d, "descriptions").where("entity_id is not null")
    pick = lambda odd: t.where(f"desc_id % 2 = {odd}").groupBy("entity_id").agg(F.max_by("status", "desc_id").alias("status")).withColumnRenamed("entity_id", "id")
    return resolve.recovery_merge(pick(0), pick(1))


def override_repoint(spark, d):
    dec = _greenbook(spark, d).where("entity_id is not null").select("enrichment_id", "entity_id", F.col("matched_from.match_type").alias("decision"), F.concat(_L("Q"), F.col("enrichment_id") % 10).alias("code"))
    rep = table(spark, d, "registry").select(F.col("id").alias("entity_id"), _L("Q3").alias("reject"), F.concat(_L("Q-"), "id").alias("target"), _L(1).alias("seq"))
    return resolve.override(dec, rep).select("enrichment_id", "entity_id", "decision", "code")


def subset_drift(spark, d):
    g = _greenbook(spark, d).select(F.col("entity_id").alias("id")).where("id is not null")
    return resolve.drift(g, table(spark, d, "registry").select("id"), "id")


def append_if_absent(spark, d):
    a = table(spark, d, "registry").select("id", "name")
    b = _greenbook(spark, d).where("entity_id is not null").groupBy(F.col("entity_id").alias("id")).agg(F.min("matched_from.agency_name").alias("name"))
    return resolve.append_if_absent(a, b, "id")


def url_then_host_lookup(spark, d):
    rows = _urls(spark, d).withColumn("host", hosts.url_host(F.col("url")))
    recs = table(spark, d, "state_listing").where("url is not null").groupBy("url").agg(F.min("entry_no").alias("entry_no")).select("url", hosts.url_host(F.col("url")).alias("host"), F.col("entry_no").cast("string").alias("value"), F.col("entry_no").alias("seq"))
    return resolve.url_then_host(rows, recs).select("url", "value")


def title_places(spark, d):
    titles = table(spark, d, "state_listing").groupBy("entry_no").agg(F.min("name").alias("title")).where("title is not null").withColumnRenamed("entry_no", "page_id")
    places = table(spark, d, "registry").where("government_level in ('city', 'town', 'village', 'county')").select(text.place_part(F.col("government_level"), F.col("name")).alias("place")).where("place <> ''")
    return resolve.title_places(titles, places)


def start_urls(spark, d):
    e = table(spark, d, "registry").select("id", F.transform(F.coalesce("identifiers", F.expr(f"cast(array() as {resolve.PAIR})")), lambda i: i["identifier"]).alias("keys"), F.transform("web_properties", lambda w: F.struct(w["domain"].alias("domain"), w["role"].alias("role"))).alias("domains"))
    listed = table(spark, d, "registry").select(F.explode("identifiers").alias("i"), "id").select(F.col("i.identifier").alias("key"), F.concat(_L("https://listed.example/"), "id").alias("url")).where("length(key) = 7")
    return resolve.start_urls(e, listed.groupBy("key").agg(F.min("url").alias("url")))


def listing_targets(spark, d):
    lst = table(spark, d, "state_listing").where("url is not null").select("agency", hosts.url_host(F.col("url")).alias("host"), F.col("entry_no").alias("seq")).where("host is not null").distinct()
    over = lst.where("length(host) % 6 = 0").select("host").distinct().withColumn("target", F.concat(_L("o-"), F.length("host")))
    codes = lst.select("agency").distinct().where("length(agency) % 2 = 0").withColumn("target", text.slug(F.col("agency")))
    t = resolve.listing_targets(lst, over, codes)
    return t.select("target", F.size("hosts").cast("bigint").alias("n_hosts"), F.array_min("hosts").alias("least"))


def dq_violations(spark, d):
    rules = quality.schema_rules(["id", "name", "status", "short_name"], {"status": ["active", "dissolved", "merged", "inactive"], "government_level": ["city", "town", "village", "county", "authority"]}, {"founding_date": r"^\d{4}-\d{2}-\d{2}$"})
    return quality.violations(table(spark, d, "registry"), "id", rules)


def dq_duplicates(spark, d):
    return quality.duplicates(table(spark, d, "agency_contacts"), ["contact_id"])


def dq_outside(spark, d):
    return quality.outside(table(spark, d, "registry"), "classification", ["department", "municipality"])


def collapse_by_key(spark, d):
    c = inventory.collapse(table(spark, d, "agency_contacts").where("city is not null"), "city", ["zip", "phone"], ["state"], "contact_id")
    return c.select("city", "zip", "phone", F.array_join("state", ",").alias("states"))


def mode_first_seen(spark, d):
    return inventory.mode_first_seen(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


def officer_modes(spark, d):
    return inventory.modes(table(spark, d, "agency_contacts").where("zip is not null"), ["zip"], ["city", "state", "phone"], "contact_id")


def carried_forward(spark, d):
    pub = inventory.host_rollup(_rollup_rows(spark, d)).where("names is not null").select("host_key", "names")
    others = table(spark, d, "registry").select("name", F.explode("web_properties").alias("w")).select(hosts.strip_www(hosts.url_host(F.col("w.domain"))).alias("host_key"), "name")
    return inventory.carried_forward(pub, others)


QUERIES = {
    f.__name__: f
    for f in (
        host_rollup, host_parse, host_keys, host_valid, base_domain, address_key_dedup, below_marked_host, subsite_kind, infra_label_filter, inventory_union, source_counts,
        deep_page_targets, representative_address, host_tenants, norm_names, page_names, lpad_code, org_classify, partial_dates, address_lines, name_index, domain_index,
        identifier_match, mint_ids, collision_suffix, code_shared_nullify, distinctive_match, one_to_one_match, multiset_match_rate, reconcile_tiers, website_rule,
        enrichment_additive, enrichment_skipped, recovery_merge_lattice, override_repoint, subset_drift, append_if_absent, url_then_host_lookup, title_places, start_urls,
        listing_targets, dq_violations, dq_duplicates, dq_outside, collapse_by_key, mode_first_seen, officer_modes, carried_forward,
    )
}

_PROPS = "(select id as entity_id, w.domain as domain, w.role as role from (select id, unnest(web_properties) as w from registry))"
_GB = "(select distinct on (enrichment_id) * from greenbook_enrichment)"
_AC = "(select distinct on (contact_id) * from agency_contacts)"
_BASED = f"(select host, case when len(string_split(host, '.')) >= 2 then array_to_string(string_split(host, '.')[-2:], '.') end as base_domain from (select distinct {_HOST} as host from {_URLS}) where host is not null)"
_ROOT = "regexp_extract({0}, '([^.]+\\.[^.]+)$', 1)"
_MESSY = "nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '^[a-z][a-z0-9+.\\-]*:/*', ''), '[/?#\\s].*$', ''), ':\\d+$', ''), '^www\\d*\\.', ''), '')"
_PURL = "regexp_replace(coalesce(url, domain), '', '')"


def _host_of(col: str) -> str:
    return _HOST.replace("url", col)


_PLACE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(trim({0})), '&', ' and '), '^(?:(?:county|city|town|village)\\s+of\\s+)+', ''), '\\s+county$', ''), '\\bsaint\\b', 'st', 'g'), '\\bmt\\b\\.?', 'mount', 'g'), '^the\\s+', ''), '[^a-z0-9]+', '', 'g')"
_TITLE = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(coalesce({0}, '')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'), '\\bsaint\\b', 'st', 'g'), '\\bmt\\b', 'mount', 'g'), '\\s+', ' ', 'g'))"
ORACLE = {
    "host_rollup": _ROLL,
    "enrichment_additive": f"""with own as (select id, unnest(other_names).name as v, unnest(range(1, len(other_names) + 1)) as o from registry),
a as (select entity_id as id, matched_from.agency_name as v, min(enrichment_id) as o from {_GB} where entity_id is not null and matched_from.agency_name is not null group by 1, 2),
every as (select id, v, 0 as side, o from own union all select id, v, 1, o from a where not exists (select 1 from own where own.id = a.id and own.v = a.v))
select r.id, case when r.other_names is null and count(v) filter (side = 1) = 0 then null else coalesce(string_agg(v, '|' order by side, o), '') end as names from registry r left join every using (id) group by r.id, r.other_names""",
    "carried_forward": f"""with pub as (select distinct host_key, name from (select regexp_replace({_HOST}, '^www\\.', '') as host_key, agency as name from state_listing union all select regexp_replace({_host_of('domain')}, '^www\\.', ''), r.name from {_PROPS} p join registry r on r.id = p.entity_id)),
reg as (select distinct regexp_replace({_host_of('domain')}, '^www\\.', '') as host_key, r.name from {_PROPS} p join registry r on r.id = p.entity_id)
select host_key, min(name) as name from pub where host_key is not null and name is not null and (host_key, name) not in (select host_key, name from reg) group by host_key having count(*) = 1""",
    "host_parse": f"select url, {_HOST} as host, {_PATH} as path, {_PATH} || case when {_QUERY} <> '' then '?' || {_QUERY} else '' end as path_query from {_URLS}",
    "host_keys": f"select host, regexp_replace(lower(host), '^www\\d*\\.', '') as key_digits, regexp_replace(host, '^www\\.', '') as key_www from (select distinct {_HOST} as host from {_URLS})",
    "host_valid": f"select host, cast(coalesce(length(host) <= 253 and regexp_matches(host, '^([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?\\.)+[a-z]{{2,63}}$') and not starts_with(host, 'wwww.') and host like '%.example', false) as int) as valid, lower(string_split(host, '.')[-1]) as tld from (select distinct {_HOST} as host from {_URLS})",
    "base_domain": f"select * from {_BASED}",
    "address_key_dedup": f"select {_AKEY} as address_key, min(url) as first_url, count(*) as n from {_URLS} group by 1",
    "below_marked_host": f"""with m as (select distinct {_host_of('domain')} as mark from {_PROPS} where role = 'primary')
select b.host, arg_max(m.mark, length(m.mark)) as marked_above from {_BASED} b left join m on b.host like '%.' || m.mark and length(m.mark) >= length(b.base_domain) group by b.host""",
    "subsite_kind": f"""with p as (select {_host_of('domain')} as host, entity_id from {_PROPS}), b as (select host, entity_id, array_to_string(string_split(host, '.')[-2:], '.') as base from p),
e as (select host, entity_id, base from b union select base, entity_id, base from b)
select h.host, arg_max(q.host, length(q.host)) as parent_site from (select distinct host from e) h left join (select a.host as low, c.host from e a join e c on a.entity_id = c.entity_id and a.host like '%.' || c.host) q on q.low = h.host group by h.host""",
    "infra_label_filter": f"""select host, cast(coalesce(list_bool_or(list_transform(string_split(regexp_replace(substr(host, 1, greatest(length(host) - length(base_domain), 0)), '\\.$', ''), '.'), lambda x:
  regexp_matches(x, '^(?:mail|smtp|imap|pop3?|mx\\d*|ns\\d*|dns\\d*|ftp|sftp|vpn|remote|autodiscover|owa|exchange|webmail|cpanel|whm|webdisk|dev|test|qa|uat|stage|admin|api|cdn|static|assets|img|images|proxy|gateway|firewall|sip|lyncdiscover|msoid|enterpriseregistration|enterpriseenrollment)\\d*$') or contains(x, 'staging'))), false) as int) as infra,
  0 as vendor, cast(host like 'api.%' as int) as machine from {_BASED} where base_domain is not null""",
    "inventory_union": _INV,
    "source_counts": f"select s as source, count(k) as n from (select unnest(['registry', 'listing', 'portals']) as s) left join (select string_split(sources, ';')[1] as k from ({_INV})) on k = s group by s",
    "deep_page_targets": f"""with shared as (select distinct regexp_replace({_host_of('domain')}, '^www\\.', '') as hk from {_PROPS}),
lst as (select url, min(entry_no) as seq from state_listing where url is not null group by url),
pages as (select * from lst union all select distinct 'https://' || lower(trim(domain)) || '/about', 0 from {_PROPS}),
mine as (select url, seq, case when seq % 7 = 0 and exists (select 1 from lst l where l.url = pages.url) then case when seq % 2 = 0 then 'gone' else 'moved' end end as issue from pages where {_PATH} <> '' and regexp_replace({_HOST}, '^www\\.', '') in (select hk from shared)),
t as (select case when issue = 'moved' then url || '-new' else url end as url, issue, seq from mine where issue is null or issue <> 'gone')
select page_key, cast(arg_min(coalesce(issue, '') = 'moved', seq) as int) as moved from (select {_AKEY} as page_key, issue, seq from t) group by page_key""",
    "representative_address": f"""with p as (select *, case role when 'primary' then 0 when 'microsite' then 1 else 2 end as r, array_to_string(string_split({_host_of('domain')}, '.')[-2:], '.') as host, entity_id || ' ' || domain as seq from {_PROPS} where len(string_split({_host_of('domain')}, '.')) >= 2)
select host, arg_min(domain, (r, entity_id, seq)) as url, string_agg(distinct role, ',' order by role) as kinds, count(distinct entity_id) as n_entities from p group by host""",
    "host_tenants": f"select regexp_replace({_host_of('domain')}, '^www\\.', '') as host_key, string_agg(distinct entity_id, ',' order by entity_id) as ids from {_PROPS} where role = 'primary' group by 1",
    "norm_names": f"select id, {_NORM.format('name')} as norm, {_SLUG.format('name')} as slug, {_PLACE.format('name')} as place_key, {_TITLE.format('name')} as title, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as token from registry",
    "page_names": "select agency, trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(coalesce(agency, '')), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), '\\b(the|official website of|official site of|website|homepage|home)\\b', ' ', 'g'), '\\s+', ' ', 'g')) as page_name, regexp_replace(agency, '^(?:(?:County|City|Town|Village) of\\s+)+', '', 'i') as place from (select distinct agency from agency_contacts)",
    "lpad_code": "select id, i.scheme as scheme, case when regexp_matches(trim(i.identifier), '^\\d+$') then case when length(trim(i.identifier)) < 9 then lpad(trim(i.identifier), 9, '0') else trim(i.identifier) end end as code from (select id, unnest(identifiers) as i from registry)",
    "org_classify": "select id, case when regexp_matches(name, '^(Town|Village|City) of ') then lower(string_split(name, ' ')[1]) when regexp_matches(name, '^County of ') then 'county' end as tier, case when regexp_matches(name, '^(Town|Village|City|County) of ') then trim(regexp_replace(name, '^\\S+ of (?:the )?', '')) end as place from registry",
    "partial_dates": "select distinct entity_id, domain, valid_from, strftime(try_cast(case length(trim(valid_from)) when 4 then trim(valid_from) || '-01-01' when 7 then trim(valid_from) || '-01' else trim(valid_from) end as date), '%Y-%m-%d') as first_day from web_property_updates",
    "address_lines": f"select contact_id, nullif(concat_ws(', ', nullif(trim(address_line_1), ''), nullif(trim(city), ''), nullif(concat_ws(' ', nullif(trim(state), ''), nullif(trim(zip), '')), '')), '') as line from {_AC}",
    "name_index": f"select {_NORM.format('short_name')} as key, string_agg(distinct id, ',' order by id) as owners, count(distinct id) as n from registry where {_NORM.format('short_name')} <> '' group by 1",
    "domain_index": f"select regexp_replace({_host_of('domain')}, '^www\\d*\\.', '') as key, string_agg(distinct entity_id, ',' order by entity_id) as owners, count(distinct entity_id) as n from {_PROPS} where {_host_of('domain')} is not null group by 1",
    "identifier_match": f"""with e as (select id, i.scheme as s, i.identifier as v from (select id, unnest(identifiers) as i from registry)),
h as (select s, v, min(id) as id from e group by s, v), r as (select id, case when length(id) % 2 = 0 then name else 'New ' || name end as name, length(id) % 3 = 0 as has from registry),
p as (select e.id, any_value(h.id) as by_pair from e join h using (s, v) where length(e.id) % 3 = 0 group by e.id)
select 'r-' || r.id as rec_id, by_pair, cast(by_pair is null and {_NORM.format('r.name')} not in (select {_NORM.format('name')} from registry) as int) as unmatched from r left join p using (id)""",
    "collision_suffix": f"with r as (select contact_id, {_SLUG.format('agency')} as slug, {_SLUG.format(chr(99) + 'oalesce(city, ' + chr(39) + 'nowhere' + chr(39) + ')')} as place from {_AC} where agency is not null) select contact_id, case when count(*) over (partition by slug) > 1 then slug || '-' || place else slug end as new_id from r",
    "code_shared_nullify": f"select contact_id, case when count(*) over (partition by phone) = 1 then phone end as phone from {_AC}",
    "distinctive_match": f"""with hosts as (select {_ROOT.format(_host_of('domain'))} as key, min(entity_id) as one, count(distinct entity_id) as n from {_PROPS} group by 1),
names as (select {_NORM.format('name')} as key, min(id) as one, count(distinct id) as n from registry group by 1),
c as (select enrichment_id, matched_from.agency_name as name, web_candidates from {_GB}),
x as (select distinct enrichment_id, {_ROOT.format(_MESSY.format('w'))} as key from (select enrichment_id, unnest(web_candidates) as w from c)),
h as (select enrichment_id, count(distinct one) filter (n = 1) as ids, min(one) filter (n = 1) as one, max(cast(n > 1 as int)) as apex from x join hosts using (key) where key <> '' group by enrichment_id)
select c.enrichment_id, case when ids >= 2 then 'review' when ids = 1 then 'auto' when names.n = 1 then 'proposal' when names.n > 1 then 'review' when apex = 1 then 'review' else 'unmatched' end as decision,
case when ids >= 2 then 'domain_conflict' when ids = 1 then 'distinctive_domain' when names.n = 1 then 'exact_name' when names.n > 1 then 'ambiguous_name' when apex = 1 then 'apex_shared_only' else 'no_match' end as reason,
case when ids = 1 then h.one when coalesce(ids, 0) = 0 and names.n = 1 then names.one end as entity_id,
case when ids = 1 then cast(coalesce(names.n, 0) > 0 and h.one not in (select id from registry r where {_NORM.format('r.name')} = {_NORM.format('c.name')}) as int) else -1 end as name_divergent
from c left join h using (enrichment_id) left join names on names.key = {_NORM.format('c.name')} and names.key <> ''""",
    "one_to_one_match": f"""with l as (select enrichment_id as left_id, {_NORM.format('matched_from.agency_name')} as key from {_GB}), r as (select contact_id as right_id, {_NORM.format('agency')} as key from {_AC}),
a as (select key, count(*) as nl from l group by key), b as (select key, count(*) as nr, min(right_id) as rid from r group by key)
select cast(left_id as varchar) as left_id, case when nl = 1 and nr = 1 then cast(rid as varchar) else '' end as right_id, case when nr is null then 'no_match' when nl = 1 and nr = 1 then 'matched' else 'ambiguous' end as reason from l left join a using (key) left join b using (key)
union all select '', cast(right_id as varchar), 'right_unmatched' from r left join a using (key) left join b using (key) where not coalesce(nl = 1 and nr = 1, false)""",
    "multiset_match_rate": "with a as (select c_nationkey as nation, floor(c_acctbal / 2000) as band, count(*) as n from customer group by all), b as (select s_nationkey as nation, floor(s_acctbal / 2000) as band, count(*) as n from supplier group by all), j as (select coalesce(a.nation, b.nation) as nation, coalesce(a.n, 0) = coalesce(b.n, 0) as m from a full join b on a.nation = b.nation and a.band = b.band) select nation, count(*) filter (m) as matched, count(*) as entities, round(count(*) filter (m) / count(*), 4) as rate from j group by nation",
    "reconcile_tiers": f"""with k as (select {_NORM.format('short_name')} as key, 0 as p, id, government_level as lv from registry union all select {_NORM.format('name')}, 1, id, government_level from registry),
b as (select a.contact_id as row_id, arg_min(k.id, (k.p, k.id)) as e, arg_min(k.lv, (k.p, k.id)) as lv from {_AC} a join k on k.key = {_NORM.format('a.agency')} and k.key <> '' group by 1)
select a.contact_id as row_id, e as entity_id, case when e is null then 'unmatched' when lv <> 'authority' then 'review' else 'attach' end as decision, case when e is null then 'no_match' when lv <> 'authority' then 'cross_government_level' else 'exact' end as reason from {_AC} a left join b on a.contact_id = b.row_id""",
    "website_rule": f"""with p as (select entity_id as u, {_ROOT.format(_host_of('domain'))} as host, 'r' as s from {_PROPS}),
l as (select * from p union all select lower(trim(entity_id)), {_MESSY.format('w')}, 'g' from (select entity_id, unnest(web_candidates) as w from {_GB} where entity_id is not null)),
ag as (select u, host from l group by u, host having count(distinct s) >= 2), cl as (select host, count(*) as claims from ag group by host),
a as (select u, count(*) as hosts, min(host) as host from ag group by u), un as (select u, count(distinct s) as sources from l group by u)
select un.u as unit_id, case when hosts = 1 then a.host end as host, case when hosts > 1 then 'website_several_hosts_agreed' when hosts is null then case when sources = 1 then 'website_single_lead' else 'website_leads_disagree' end when claims > 1 then 'website_host_shared' when a.host in (select host from p where length(host) % 5 = 0) then 'website_host_owned_by_existing_entity' else 'primary' end as outcome
from un left join a using (u) left join cl on cl.host = a.host""",
    "enrichment_skipped": f"select distinct entity_id from {_GB} where entity_id is not null and entity_id not in (select id from registry)",
    "recovery_merge_lattice": """with a as (select entity_id as id, arg_max(status, desc_id) as o from descriptions where entity_id is not null and desc_id % 2 = 0 group by 1), b as (select entity_id as id, arg_max(status, desc_id) as n from descriptions where entity_id is not null and desc_id % 2 = 1 group by 1),
j as (select coalesce(a.id, b.id) as id, o, n, case when n is null then 'kept' when o is null then 'filled' when n = 'ok' and o in ('fetch_failed', 'no_about_found', 'extraction_empty') then 'replaced' when n <> 'ok' and o = 'fetch_failed' then 'reclassified' else 'protected' end as action from a full join b on a.id = b.id)
select id, case when action in ('kept', 'protected') then o else n end as status, action from j""",
    "mint_ids": """with r as (select contact_id, coalesce(nullif(trim(regexp_replace(lower(min(agency)), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'entity') as s from agency_contacts where agency is not null group by contact_id), k as (select *, row_number() over (partition by s order by contact_id) as k from r),
m as (select s, max(k) + (select count(*) from registry where id = s or starts_with(id, s || '-')) as m from k group by s), g as (select s, unnest(range(1, m + 1)) as g from m),
free as (select s, g, row_number() over (partition by s order by g) as k from g where case when g = 1 then s else s || '-' || g end not in (select id from registry)) select contact_id, case when g = 1 then s else s || '-' || g end as minted from k join free using (s, k)""",
    "override_repoint": f"select enrichment_id, entity_id, case when hit then 'repointed' else matched_from.match_type end as decision, case when hit then 'Q-' || entity_id else 'Q' || (enrichment_id % 10) end as code from (select *, enrichment_id % 10 = 3 and entity_id in (select id from registry) as hit from {_GB} where entity_id is not null)",
    "subset_drift": f"select distinct entity_id as id, 'left_only' as side from {_GB} where entity_id is not null and entity_id not in (select id from registry) union all select id, 'right_only' from registry where id not in (select entity_id from {_GB} where entity_id is not null)",
    "append_if_absent": f"select id, name from registry union all select entity_id, min(matched_from.agency_name) from {_GB} where entity_id is not null and entity_id not in (select id from registry) group by entity_id",
    "url_then_host_lookup": f"""with r as (select url, min(entry_no) as e from state_listing where url is not null group by url), h as (select {_HOST} as host, min(e) as e from r group by 1)
select u.url, cast(coalesce(r.e, h.e) as varchar) as value from (select url, {_HOST} as host from {_URLS}) u left join r using (url) left join h on h.host = u.host""",
    "start_urls": """with k as (select id, i.identifier as key, pos from (select id, unnest(identifiers) as i, unnest(range(1, len(identifiers) + 1)) as pos from registry)), l as (select key, min('https://listed.example/' || id) as url from k where length(key) = 7 group by key),
f as (select id, arg_min(url, pos) as listed from k join l using (key) group by id), r as (select id, list_filter(web_properties, lambda w: w.role = 'primary')[1].domain as p, web_properties[1].domain as a from registry)
select id, coalesce(listed, 'https://' || p || '/', 'https://' || a || '/') as start_url, case when listed is not null then 'listed' when p is not null then 'primary_domain' when a is not null then 'first_domain' else 'skipped' end as derivation from r left join f using (id)""",
    "listing_targets": f"""with l as (select distinct agency, {_HOST} as host from state_listing where url is not null and nullif(trim(url), '') is not null), t as (select case when length(host) % 6 = 0 then 'o-' || length(host) when length(agency) % 2 = 0 then {_SLUG.format('agency')} end as target, host from l)
select target, count(distinct host) as n_hosts, min(host) as least from t group by target""",
    "dq_violations": """select id as key, p as problem from (select id, unnest(list_filter([case when id is null then 'id missing' end, case when name is null then 'name missing' end, case when status is null then 'status missing' end, case when short_name is null then 'short_name missing' end,
case when status not in ('active', 'dissolved', 'merged', 'inactive') then 'status unknown' end, case when government_level not in ('city', 'town', 'village', 'county', 'authority') then 'government_level unknown' end, case when not regexp_matches(founding_date, '^\\d{4}-\\d{2}-\\d{2}$') then 'founding_date malformed' end], lambda x: x is not null)) as p from registry)""",
    "dq_duplicates": "select contact_id, count(*) as n from agency_contacts group by 1 having count(*) > 1",
    "dq_outside": "select classification, count(*) as n from registry where classification not in ('department', 'municipality') group by 1",
    "collapse_by_key": "select city, arg_min(zip, contact_id) as zip, arg_min(phone, contact_id) as phone, coalesce(string_agg(distinct state, ',' order by state), '') as states from agency_contacts where city is not null group by city",
    "mode_first_seen": "with c as (select o_custkey, o_orderpriority as m, count(*) as n, min(o_orderkey) as fa from orders where trim(o_orderpriority) <> '' group by all) select o_custkey, arg_min(m, (-n, fa)) as mode from c group by o_custkey",
    "officer_modes": "with x as (select zip, contact_id, unnest(['city', 'state', 'phone']) as a, unnest([city, state, phone]) as v from agency_contacts where zip is not null), c as (select zip, a, v, count(*) as n, min(contact_id) as fa from x where trim(v) <> '' group by all), b as (select zip, a, arg_min(v, (-n, fa)) as m from c group by zip, a) select zip, max(m) filter (a = 'city') as city, max(m) filter (a = 'state') as state, max(m) filter (a = 'phone') as phone from b group by zip",
    "title_places": f"""with t as (select entry_no as page_id, {_TITLE.format('min(name)')} as t from state_listing group by entry_no having min(name) is not null),
p as (select distinct case when government_level = 'county' then regexp_replace(s, ' county$', '') else s end as place from (select government_level, regexp_replace({_TITLE.format('name')}, '^(?:(?:county|city|town|village) of )+', '') as s from registry where government_level in ('city', 'town', 'village', 'county'))),
w as (select page_id, string_split(t, ' ') as w from t), i as (select page_id, w, unnest(range(1, len(w) + 1)) as i from w), n as (select page_id, w, i, unnest(range(1, 6)) as n from i),
h as (select page_id, i, i + n as e, place from n join p on p.place = array_to_string(w[i:i + n - 1], ' ') where i + n - 1 <= len(w) and place <> '')
select distinct a.page_id, a.place from h a where not exists (select 1 from h b where b.page_id = a.page_id and b.i <= a.i and a.e <= b.e and b.e - b.i > a.e - a.i)""",
}
