"""Roll-ups of many sources into one row per host and one per address, with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import hosts


def mode_first_seen(rows: DataFrame, by: list[str], value: str, order: str, out: str = "mode") -> DataFrame:
    """AGG-1: the most frequent value that isn't blank; of equally frequent ones the one seen first."""
    counted = rows.where(F.col(value).isNotNull() & (F.trim(F.col(value).cast("string")) != "")).groupBy(*by, value).agg(F.count("*").alias("__n"), F.min(order).alias("__at"))
    return counted.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("__n"), "__at")).alias(out))


def modes(rows: DataFrame, by: list[str], values: list[str], order: str) -> DataFrame:
    """AGG-2: the mode of several attributes per group, one pass over the rows for all of them."""
    long = rows.select(*by, F.col(order).alias("__o"), F.explode(F.array(*(F.struct(F.lit(v).alias("a"), F.col(v).cast("string").alias("v")) for v in values))).alias("x"))
    best = mode_first_seen(long.select(*by, "__o", "x.a", "x.v"), [*by, "a"], "v", "__o")
    return best.groupBy(*by).agg(*(F.max(F.when(F.col("a") == v, F.col("mode"))).alias(v) for v in values))


def collapse(rows: DataFrame, key: str, firsts: list[str], sets: list[str], order: str) -> DataFrame:
    """AGG-3, SRC-24: one row per key: the first value that is there of some columns, sorted sets of others."""
    return rows.groupBy(key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts), *(F.sort_array(F.collect_set(c)).alias(c) for c in sets))


def union_sources(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """SRC-14, SET-1: all sources with their name and rank; columns that one lacks are null."""
    out = None
    for rank, (name, df) in enumerate(sources):
        one = df.withColumns({"source": F.lit(name), "precedence": F.lit(rank)})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def _ordered(value: str, *order: str) -> Column:
    """Distinct values in the order in which they were first met."""
    pairs = F.sort_array(F.collect_set(F.when(F.col(value).isNotNull(), F.struct(*order, value))))
    return F.array_distinct(F.transform(pairs, lambda p: p[value]))


def host_rollup(rows: DataFrame) -> DataFrame:
    """AGG-4, 5, 6: one row per host from ``rows(url, name, entity_id, level, source, precedence, seq, kind)``.

    The key drops www.; host is the one of the first source. names in order of encounter; ids, levels and paths sorted;
    agency is null if several ids share the host, else the first name of a record without a path. kind: any source that
    isn't a portal list makes it a main site; all addresses machines' make it an API; else a data portal. Rows without a
    host are left out. A host's lists grow with its distinct records only.
    """
    parsed = rows.withColumns({"host": hosts.url_host(F.col("url")), "path": hosts.url_path(F.col("url"))}).where("host is not null")
    parsed = parsed.withColumn("host_key", hosts.strip_www(F.col("host")))
    at = F.struct("precedence", "seq")
    filled = lambda a: F.when(F.size(a) > 0, a)
    agg = parsed.groupBy("host_key").agg(
        F.min_by("host", at).alias("host"),
        _ordered("name", "precedence", "seq").alias("names"),
        F.sort_array(F.collect_set("entity_id")).alias("ids"),
        F.sort_array(F.collect_set("level")).alias("levels"),
        F.sort_array(F.collect_set(F.nullif("path", F.lit("")))).alias("paths"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.min_by("name", F.when((F.col("path") == "") & F.col("name").isNotNull(), at)).alias("root_name"),
        F.bool_or(F.coalesce("kind", F.lit("")) != "portal").alias("not_portal"),
        F.bool_and(hosts.is_machine_endpoint(F.col("url"))).alias("machines"),
        F.count("*").alias("records"),
    )
    kind = F.when(F.col("not_portal"), "main site").when(F.col("machines"), "API").otherwise("data portal")
    return agg.select("host_key", "host", *(filled(F.col(c)).alias(c) for c in ("names", "ids", "levels", "paths", "sources")), F.when(F.size("ids") <= 1, F.col("root_name")).alias("agency"), kind.alias("kind"), "records")


def carried_forward(published: DataFrame, others: DataFrame) -> DataFrame:
    """SRC-13: names of published hosts that no other source explains, where exactly one is left."""
    known = others.groupBy("host_key").agg(F.collect_set("name").alias("__k"))
    left = published.join(known, "host_key", "left").withColumn("rest", F.array_except("names", F.coalesce("__k", F.array().cast("array<string>"))))
    return left.where(F.size("rest") == 1).select("host_key", F.col("rest")[0].alias("name"))


def address_inventory(rows: DataFrame) -> DataFrame:
    """JOIN-39: one row per address: the first source's row stands, later ones add their label and what it lacked.
    ``rows(address, kind, source, date_found, name, precedence, seq)``."""
    keyed = rows.withColumn("address_key", hosts.address_key(F.col("address"))).where("address_key is not null")
    at = F.struct("precedence", "seq")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
    return keyed.groupBy("address_key").agg(F.min_by("address", at).alias("address"), first("kind"), first("name"), F.min("date_found").alias("date_found"), F.array_join(_ordered("source", "precedence", "seq"), "; ").alias("sources"))


def counts_of(rows: DataFrame, column: str, vocabulary: list[str]) -> DataFrame:
    """AGG-7, 13: counts per value of a vocabulary, zero where there is none; values outside it are counted too."""
    spark = rows.sparkSession
    words = spark.createDataFrame([(v,) for v in vocabulary], f"{column} string")
    return words.join(rows.groupBy(column).agg(F.count("*").alias("n")), column, "full").na.fill(0, ["n"])


def owner_of(address_owner: DataFrame, host_owner: DataFrame, names: DataFrame) -> DataFrame:
    """JOIN-40: owner of a name found in a log: that of its registered domain, else that of all listed hosts below it if
    they agree. ``names(name, domain)``, both owners ``(domain, owner)``."""
    apex = address_owner.groupBy("domain").agg(F.min("owner").alias("apex_owner"))
    below = host_owner.groupBy("domain").agg(F.countDistinct("owner").alias("n"), F.min("owner").alias("one"))
    j = names.join(apex, "domain", "left").join(below.where("n = 1"), "domain", "left")
    return j.select("name", "domain", F.coalesce("apex_owner", "one").alias("owner"))


def representative(targets: DataFrame) -> DataFrame:
    """JOIN-15: one address per host: best kind, then rows with an entity, then entity and order; all its entities and
    kinds beside it. ``targets(host, url, kind_rank, kind, entity_id, seq)``."""
    at = F.struct("kind_rank", F.col("entity_id").isNull(), "entity_id", "seq")
    return targets.groupBy("host").agg(F.min_by(F.struct("url", "entity_id"), at).alias("r"), _ordered("entity_id", "seq").alias("entity_ids"), F.sort_array(F.collect_set("kind")).alias("kinds")).select("host", "r.url", F.when(F.size("entity_ids") == 1, F.col("r.entity_id")).alias("entity_id"), "entity_ids", "kinds")


def page_owners(rows: DataFrame) -> DataFrame:
    """JOIN-29: url -> names, ids and sources in order of encounter."""
    return rows.groupBy("url").agg(*(_ordered(c, "seq").alias(f"{c}s") for c in ("name", "entity_id", "source")))


def deep_pages(host_rows: DataFrame, pages: DataFrame, corrections: DataFrame) -> DataFrame:
    """JOIN-30: pages of hosts that several bodies share: those marked gone drop out, moved ones go to their new
    address, doubles (by address key) are one. ``host_rows(host_key, ids)``, ``pages(url, seq)``, ``corrections(url,
    issue, moved_to)``."""
    shared = host_rows.where(F.size("ids") > 1).select("host_key")
    mine = pages.where(hosts.url_path(F.col("url")) != "").withColumn("host_key", hosts.strip_www(hosts.url_host(F.col("url")))).join(shared, "host_key", "left_semi")
    j = mine.join(corrections, "url", "left").where("issue is null or issue <> 'gone'")
    to = j.select(F.when(F.col("issue") == "moved", F.col("moved_to")).otherwise(F.col("url")).alias("url"), F.when(F.col("issue") == "moved", F.col("url")).alias("moved_from"), "seq")
    return to.withColumn("page_key", hosts.address_key(F.col("url"))).groupBy("page_key").agg(F.min_by(F.struct("url", "moved_from"), "seq").alias("r")).select("page_key", "r.*")


def page_targets(addresses: DataFrame, listed: DataFrame, run_hosts: DataFrame) -> DataFrame:
    """JOIN-31: addresses with a path that no list has, with the host to pace them by: the run's own form of the host,
    the one with www. if there are both."""
    own = run_hosts.groupBy(hosts.strip_www(F.col("host")).alias("host_key")).agg(F.max_by("host", F.col("host").startswith("www.")).alias("pace_host"))
    rows = addresses.withColumns({"page_key": hosts.address_key(F.col("address")), "host_key": hosts.strip_www(hosts.url_host(F.col("address")))}).where(hosts.url_path(F.col("address")) != "")
    return rows.join(listed.select("page_key"), "page_key", "left_anti").join(own, "host_key", "left").withColumn("pace_host", F.coalesce("pace_host", "host_key"))


def tenants(properties: DataFrame) -> DataFrame:
    """JOIN-32: entities per primary host. ``properties(entity_id, domain, role)``."""
    return properties.where("role = 'primary'").groupBy(hosts.strip_www(hosts.url_host(F.col("domain"))).alias("host_key")).agg(F.sort_array(F.collect_set("entity_id")).alias("ids"))


def registered_domains(rows: DataFrame, base: str) -> DataFrame:
    """PRJ-22: distinct registered domains worth asking a certificate log about: not on vendors' domains."""
    return rows.where(F.col(base).isNotNull() & ~hosts.on_vendor(F.col(base))).select(F.col(base).alias("domain")).distinct()


def names_from_log(entries: DataFrame, domain: str = "domain") -> DataFrame:
    """SRC-36: names that log entries give for a domain: each line of name_value and the common name, in lower case,
    without wildcards, below the domain. ``entries(domain, name_value, common_name)``."""
    each = entries.select(F.col(domain).alias("domain"), F.explode(F.concat(F.split(F.coalesce("name_value", F.lit("")), r"\n"), F.array("common_name"))).alias("n"))
    name = F.lower(F.trim("n"))
    clean = each.select("domain", name.alias("name")).where(~F.col("name").contains("*") & ((F.col("name") == F.col("domain")) | F.col("name").endswith(F.concat(F.lit("."), "domain"))))
    return clean.where(~hosts.is_infra(F.col("name"), F.col("domain"))).distinct()


def kept_names(names: DataFrame, trackers: DataFrame) -> DataFrame:
    """MSC-43: each kept name once, with its first domain, without senders of tracked mail."""
    return names.groupBy("name").agg(F.min_by("domain", "seq").alias("domain")).join(trackers.select("name"), "name", "left_anti")


def api_share(rows: DataFrame) -> DataFrame:
    """PRJ-16 over a host's addresses."""
    return rows.groupBy("host").agg(F.count_if(hosts.is_machine_endpoint(F.col("url"))).alias("machine"), F.count("*").alias("n"))
