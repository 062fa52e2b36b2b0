"""Source rows as canonical records, crawler labels, and the pipelines that string the operators together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import hosts, text
from plumbline.operators import inventory, quality, resolve

_WEB = "array<struct<domain:string,role:string,valid_from:string,valid_to:string,notes:string>>"
_NAMES = "array<struct<name:string,note:string>>"
_AREAS = "array<struct<scheme:string,layer:string,id:string,role:string>>"

# What a list of crawlers says instead of a label, and what a label must not hold.
TOKEN_ONLY, NO_PAGE, SEPARATOR = "token-only", "no page", " || "
STAND_IN = r"[WXYZ]\.[WXYZ]"


def _given(c: Column) -> Column:
    """Trimmed; null if blank."""
    return F.nullif(F.trim(c), F.lit(""))


def _pair(scheme: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(F.lit(scheme).alias("scheme"), value.alias("identifier")))


def _web(domain: Column, role: str, notes: str) -> Column:
    no = F.lit(None).cast("string")
    return F.when(domain.isNotNull(), F.struct(domain.alias("domain"), F.lit(role).alias("role"), no.alias("valid_from"), no.alias("valid_to"), F.lit(notes).alias("notes")))


def _named(names: Column, note: str) -> Column:
    return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(note).alias("note")))


def _list(kind: str, *items: Column) -> Column:
    return F.array_compact(F.array(*items)).cast(kind) if items else F.array().cast(kind)


def governance_records(rows: DataFrame, source: str = "moda") -> DataFrame:
    """PRJ-39: active rows of a governance export (record_id, name, acronym, url, operational_status, organization_type,
    alternate_or_former_names, alternate_or_former_acronyms) as records without an id."""
    acronym = _given(F.col("acronym"))
    others = F.concat(
        _named(F.array_compact(F.array(acronym)), "acronym"),
        _named(F.coalesce(text.split_multi(F.col("alternate_or_former_names")), F.array().cast("array<string>")), "alternate or former name"),
        _named(F.coalesce(text.split_multi(F.col("alternate_or_former_acronyms")), F.array().cast("array<string>")), "alternate or former acronym"),
    )
    return rows.where(text.is_active(F.col("operational_status"))).select(
        F.trim("name").alias("name"),
        acronym.alias("short_name"),
        others.alias("other_names"),
        F.lit("nyc").alias("government_level"),
        _given(F.col("organization_type")).alias("classification"),
        _list(resolve.PAIR, _pair("nyc_goid", _given(F.col("record_id")))).alias("identifiers"),
        _list(_WEB, _web(hosts.url_host(_given(F.col("url"))), "primary", "current site of the source")).alias("web_properties"),
        _list(_AREAS).alias("areas"),
        F.lit("active").alias("status"),
        F.struct(F.array(F.lit(source)).alias("sources"), F.lit(None).cast("string").alias("last_verified")).alias("provenance"),
    )


def census_areas(level: Column, fips: Column, county_fips: Column) -> Column:
    """PRJ-34: an area only where the code's form is certain: counties of five digits, towns of ten in their county."""
    area = lambda layer: F.array(F.struct(F.lit("us_census_geoid").alias("scheme"), F.lit(layer).alias("layer"), fips.alias("id"), F.lit("jurisdiction").alias("role"))).cast(_AREAS)
    return F.when((level == "county") & (F.length(fips) == 5) & fips.startswith("36"), area("county")).when((level == "town") & (F.length(fips) == 10) & (F.left(fips, F.lit(5)) == county_fips), area("county_subdivision")).otherwise(_list(_AREAS))


def locality_records(units: DataFrame) -> DataFrame:
    """PRJ-40: ``units(id, name, tier, spine, swis, gnis, osc_code, osc_name, fips, county_fips, primary_host,
    lead_sources)`` as records to be minted under their own ids."""
    osc = F.regexp_replace("osc_name", r"^((?:Village|Town|City) of )(?:\1)+", "$1")
    renamed = F.when(F.col("osc_code").isNotNull() & (text.norm_name(osc) != text.norm_name(F.col("name"))), F.array(osc)).otherwise(F.array().cast("array<string>"))
    by_state = (F.col("spine") == "osc") & (F.col("swis").isNotNull() | F.col("gnis").isNotNull()) & F.col("osc_code").isNotNull()
    sources = F.array_distinct(F.array_compact(F.concat(F.array("spine", F.when(F.col("osc_code").isNotNull(), "osc"), F.when(by_state, "its_localities")), F.coalesce("lead_sources", F.array().cast("array<string>")))))
    return units.select(
        F.col("id").alias("mint_id"),
        "name",
        _named(renamed, "name in the comptroller's tables").alias("other_names"),
        F.col("tier").alias("government_level"),
        _list(resolve.PAIR, _pair("nys_swis", F.col("swis")), _pair("us_gnis", F.col("gnis")), _pair("nys_osc_muni_code", F.col("osc_code"))).alias("identifiers"),
        _list(_WEB, _web(F.col("primary_host"), "primary", "independent leads agree")).alias("web_properties"),
        census_areas(F.col("tier"), F.col("fips"), F.col("county_fips")).alias("areas"),
        F.lit("active").alias("status"),
        F.struct(sources.alias("sources"), F.lit(None).cast("string").alias("last_verified")).alias("provenance"),
        F.lit(True).alias("expect_new"),
    )


def migrate(old: DataFrame, ids: DataFrame, crosswalk: dict[str, str], legacy_scheme: str) -> DataFrame:
    """PRJ-41, MSC-34: records of a first schema (legacy_id, name, short_name, level, entity_type, parent_id, child_ids,
    crosswalk map, succeeds_ids, succeeded_by_ids, valid_from, valid_to) under new ids ``ids(legacy_id, id)``. Unknown
    successors keep their old id, unknown parents vanish."""
    base = old.join(ids, "legacy_id")
    listed = lambda c, kind: old.select("legacy_id", F.posexplode(c).alias("pos", "x")).join(ids.select(F.col("legacy_id").alias("x"), F.col("id").alias("to")), "x", "left").select("legacy_id", "pos", F.coalesce("to", "x").alias("to"), F.col("to").isNotNull().alias("known"), F.lit(kind).alias("type"))
    links = listed("child_ids", "child").unionByName(listed("succeeds_ids", "successor_of")).unionByName(listed("succeeded_by_ids", "predecessor_of"))
    in_order = lambda rows: F.transform(F.sort_array(F.collect_list(rows)), lambda s: s["v"])
    per = links.groupBy("legacy_id").agg(
        in_order(F.when((F.col("type") == "child") & F.col("known"), F.struct("pos", F.col("to").alias("v")))).alias("child_ids"),
        in_order(F.when(F.col("type") != "child", F.struct(F.struct((F.col("type") == "predecessor_of").alias("second"), "pos").alias("at"), F.struct("type", F.col("to").alias("target_id"), F.lit(None).cast("string").alias("date")).alias("v")))).alias("relations"),
    )
    parents = ids.select(F.col("legacy_id").alias("parent_id"), F.col("id").alias("parent"))
    held = [_pair(legacy_scheme, F.col("legacy_id")), *(_pair(s, F.nullif(F.try_element_at("crosswalk", F.lit(f)), F.lit(""))) for f, s in crosswalk.items())]
    j = base.drop("child_ids").join(per, "legacy_id", "left").join(parents, "parent_id", "left")
    return j.select("id", "name", "short_name", F.col("level").alias("government_level"), F.col("entity_type").alias("classification"), F.col("parent").alias("parent_id"), "child_ids", "relations", _list(resolve.PAIR, *held).alias("identifiers"), F.col("valid_from").alias("founding_date"), F.col("valid_to").alias("dissolution_date"))


def id_map(old: DataFrame, overrides: DataFrame) -> DataFrame:
    """AGG-25: (legacy_id, id): the curated id, else a slug of the short name or name, numbered where it is taken."""
    j = old.join(overrides.select("legacy_id", F.col("id").alias("given")), "legacy_id", "left")
    curated = j.where("given is not null").select("legacy_id", F.col("given").alias("id"))
    rest = j.where("given is null").select("legacy_id", F.coalesce(_given(F.col("short_name")), "name").alias("label"))
    return curated.unionByName(resolve.mint_ids(rest, "label", "legacy_id", curated).select("legacy_id", "id"))


def canonical_rows(entities: DataFrame) -> DataFrame:
    """PRJ-43: entities as rows for a name resolver."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    other = F.filter(F.transform(F.coalesce("other_names", F.array().cast(_NAMES)), lambda o: o["name"]), lambda n: F.coalesce(n, F.lit("")) != "")
    return entities.select(F.col("id").alias("record_id"), blank(F.col("name")).alias("name"), blank(F.col("short_name")).alias("acronym"), F.array_join(other, ";").alias("alternate_or_former_names"), blank(F.col("classification")).alias("organization_type"), F.when(F.col("status") == "active", "Active").otherwise(blank(F.col("status"))).alias("operational_status"))


def matcher_keys(entities: DataFrame) -> DataFrame:
    """JOIN-9, MSC-9: keys of the exact matcher: acronym before name before variants."""
    key = lambda k, p: entities.select(text.norm_name(k).alias("key"), F.lit(p).alias("priority"), F.col("id").alias("ord"), F.col("id").alias("entity_id"), F.col("government_level").alias("level"))
    variants = entities.select("id", "government_level", F.explode("other_names").alias("o")).select(text.norm_name(F.col("o.name")).alias("key"), F.lit(2).alias("priority"), F.col("id").alias("ord"), F.col("id").alias("entity_id"), F.col("government_level").alias("level"))
    return key(F.col("short_name"), 0).unionByName(key(F.col("name"), 1)).unionByName(variants).where("key <> ''")


def agencies(rows: DataFrame) -> DataFrame:
    """AGG-2, MSC-4: officer rows (agency_name, acronym, section, website, phone, address, seq) as one row per agency
    with the modes of its attributes; officers are never read."""
    named = rows.withColumns({"agency_name": F.trim("agency_name"), "acronym": F.coalesce(F.trim("acronym"), F.lit(""))}).where("agency_name <> ''")
    n = named.groupBy("agency_name", "acronym").agg(F.count("*").alias("row_count"))
    return n.join(inventory.modes(named, ["agency_name", "acronym"], ["section", "website", "phone", "address"], "seq"), ["agency_name", "acronym"], "left")


def contact_details(address: Column, phone: Column, note: str) -> Column:
    """MSC-2: contact points that are there."""
    point = lambda kind, v: F.when(_given(v).isNotNull(), F.struct(F.lit(kind).alias("type"), _given(v).alias("value"), F.lit(note).alias("note")))
    return F.array_compact(F.array(point("address", address), point("voice", phone)))


def greenbook_pipeline(rows: DataFrame, entities: DataFrame, level: str) -> DataFrame:
    """MSC-4: officer rows -> agencies -> exact matching -> one table with bucket attach, review or unmatched; attached
    agencies carry their contact points, and a legacy domain if their site is none of the entity's."""
    a = agencies(rows).withColumn("row_id", F.xxhash64("agency_name", "acronym"))
    r = resolve.reconcile(a.select("row_id", F.col("agency_name").alias("name"), "acronym"), matcher_keys(entities), F.lit(level))
    owned = entities.select(F.col("id").alias("entity_id"), F.transform("web_properties", lambda w: hosts.strip_www_digits(hosts.url_host(w["domain"]))).alias("owned"))
    host = hosts.messy_host(F.col("website"))
    j = a.join(r, "row_id").join(owned, "entity_id", "left")
    lead = F.when((F.col("decision") == "attach") & host.isNotNull() & ~F.coalesce(F.array_contains("owned", host), F.lit(False)), host)
    return j.select("agency_name", "acronym", "row_count", F.col("decision").alias("bucket"), "reason", "entity_id", contact_details(F.col("address"), F.col("phone"), "as of the source").alias("contact_details"), lead.alias("legacy_domain"))


def wikidata_pipeline(bindings: DataFrame, entities: DataFrame, repoints: DataFrame) -> DataFrame:
    """MSC-5: bindings (item, itemLabel, altLabel, website) -> candidates -> distinctive-domain match -> re-pointing:
    one row per candidate with its bucket."""
    from plumbline.sources import readers

    cands = readers.sparql_bindings(bindings)
    props = entities.select("id", F.explode("web_properties").alias("w")).withColumn("host", hosts.strip_www_digits(hosts.url_host(F.col("w.domain"))))
    names = entities.select("id", F.explode(F.concat(F.array("name"), F.transform(F.coalesce("other_names", F.array().cast(_NAMES)), lambda o: o["name"]))).alias("n"))
    d = resolve.distinctive_match(cands.select(F.col("code").alias("cand_id"), F.col("label").alias("name"), "hosts"), resolve.inverted(props, F.col("host"), "id"), resolve.inverted(names, text.norm_name(F.col("n")), "id"))
    return resolve.override(d.withColumn("code", F.col("cand_id")), repoints)


def locality_pipeline(units: DataFrame, state: DataFrame, leads: DataFrame, owned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MSC-16 to 18, JOIN-16: units (unit_id, tier, name, county) -> ids -> one-to-one match with the state's rows
    (right_id, tier, name, county, second_county, code) -> shared codes nullified -> websites by two leads: (records,
    review). ``leads(tier, name, source, host, path)`` come to the unit of their name; to several of one name, none."""
    u = units.withColumn("slug", text.slug(F.col("name")))
    u = resolve.collision_suffix(u, "slug", text.slug(F.coalesce("county", F.lit(""))), "id")
    key = lambda county: F.concat_ws("|", "tier", text.place_key(F.col("name")), text.place_key(county))
    left = u.select(F.col("unit_id").alias("left_id"), key(F.col("county")).alias("key"))
    right = state.select("right_id", F.array(key(F.col("county")), F.when(F.col("second_county").isNotNull(), key(F.col("second_county")))).alias("keys"))
    m = resolve.one_to_one_either(left, right, "key", "keys").withColumnRenamed("left_id", "unit_id")
    coded = m.join(state.select("right_id", "code"), "right_id", "left")
    clean, shared = resolve.nullify_shared(coded, "code")
    named = u.select("unit_id", F.concat_ws("|", "tier", text.place_key(F.col("name"))).alias("k"))
    alone = named.groupBy("k").agg(F.count("*").alias("n"), F.min("unit_id").alias("unit_id")).where("n = 1").drop("n")
    lead_rows = leads.withColumn("k", F.concat_ws("|", "tier", text.place_key(F.col("name")))).join(alone, "k").select("unit_id", "host", "source", "path")
    sites = resolve.website_rule(lead_rows, owned)
    out = u.join(clean.select("unit_id", "code", "reason"), "unit_id").join(sites.where("outcome = 'primary'").select("unit_id", F.col("host").alias("primary_host")), "unit_id", "left")
    review = clean.where("reason <> 'matched'").select(F.col("unit_id").cast("string").alias("subject"), "reason").unionByName(sites.where("outcome <> 'primary'").select(F.col("unit_id").cast("string").alias("subject"), F.col("outcome").alias("reason"))).unionByName(shared.select(F.col("code").alias("subject"), F.lit("code_shared_by_places").alias("reason")))
    return out.select("unit_id", "id", "name", "tier", "code", "primary_host"), review


def review_histogram(review: DataFrame) -> DataFrame:
    """AGG-20, 21, 26: reasons and their numbers."""
    return review.groupBy("reason").agg(F.count("*").alias("n"))


def qa_codes(entities: DataFrame, official: DataFrame) -> DataFrame:
    """JOIN-25, 26: ``entities(id, code)`` against ``official(code)``: problems code unknown, not minted, minted twice."""
    twice = quality.duplicates(entities.where("code is not null"), ["code"]).select("code", F.lit("minted twice").alias("problem"))
    unknown = entities.where("code is not null").join(official, "code", "left_anti").select("code", F.lit("code unknown").alias("problem"))
    missing = official.join(entities.select("code"), "code", "left_anti").select("code", F.lit("not minted").alias("problem"))
    return twice.unionByName(unknown).unionByName(missing)


def identifier_of(pairs: Column, scheme: str) -> Column:
    """MSC-23, 25: the first identifier of a scheme."""
    return F.get(F.filter(pairs, lambda p: p["scheme"] == scheme), F.lit(0))["identifier"]


def published_labels(cell: Column) -> Column:
    """PRJ-45: labels in a cell of the crawler list; none where it says so."""
    return F.when(F.coalesce(cell, F.lit("")).isin("", TOKEN_ONLY, NO_PAGE), F.array().cast("array<string>")).otherwise(F.split(cell, r" \|\| "))


def crawler_identities(rows: DataFrame) -> DataFrame:
    """PRJ-44 to 48, 50, 53: ``rows(name, send, ua_exact, reason_not_sent)`` as (name, key, label, label_kind, sent, reason): the
    first label without a stand-in, the bare name where only the name is published; names in brackets say that there is
    none."""
    labels = F.filter(published_labels(F.col("ua_exact")), lambda x: ~x.rlike(STAND_IN))
    bare = F.col("ua_exact") == TOKEN_ONLY
    label = F.when(bare, F.col("name")).otherwise(F.get(labels, F.lit(0)))
    pseudo, wanted = F.col("name").startswith("("), F.col("send") == "yes"
    sent = ~pseudo & wanted & label.isNotNull()
    reason = F.when(pseudo, F.coalesce("reason_not_sent", F.lit("not a crawler name"))).when(~wanted, F.col("reason_not_sent")).when(label.isNull(), "every label has a stand-in")
    return rows.select("name", text.token_key(F.col("name")).alias("key"), F.when(sent, label).alias("label"), F.when(sent, F.when(bare, "token-only").otherwise("published")).alias("label_kind"), sent.alias("sent"), reason.alias("reason"))


def crawler_rules() -> dict[str, Column]:
    """DQ-1: what a row of the crawler list must not be."""
    c = F.col
    sent = c("send") == "yes"
    return {
        "send unknown": ~c("send").isin("yes", "rules-only"),
        "checked is no date": F.try_to_date(c("checked"), "yyyy-MM-dd").isNull(),
        "company, name and purpose needed": c("company").isNull() | c("name").isNull() | c("purpose").isNull(),
        "sent without a label": sent & F.coalesce(c("ua_exact"), F.lit("")).isin("", NO_PAGE),
        "sent without a company page": sent & ~F.coalesce(c("doc_url"), F.lit("")).startswith("https://"),
        "label without the name": sent & F.exists(published_labels(c("ua_exact")), lambda x: ~F.lower(x).contains(F.lower(c("name")))),
        "rules-only without a reason": (c("send") == "rules-only") & (F.coalesce(F.trim("reason_not_sent"), F.lit("")) == ""),
        "unfinished": F.concat_ws(" ", c("company"), c("name"), c("ua_exact"), c("doc_url")).rlike("TODO|NEEDS BROWSER"),
    }


def description_record(status_hint: Column, raw: Column) -> Column:
    """SCL-30, MSC-28, 29: struct(status, text, truncated) of a captured page."""
    cut = text.truncated(text.extract_prose(raw))
    ok = F.coalesce(cut["text"], F.lit("")) != ""
    status = F.when(status_hint.isin("fetch_failed", "no_about_found"), status_hint).when(ok, "ok").otherwise("extraction_empty")
    return F.struct(status.alias("status"), F.when(status == "ok", cut["text"]).alias("text"), ((status == "ok") & cut["truncated"]).alias("truncated"))


def coverage(descriptions: DataFrame) -> DataFrame:
    """AGG-13: statuses and their numbers, ok always among them."""
    return inventory.counts_of(descriptions, "status", ["ok"])
