"""Bases that a run starts from and checks at its end: the registry before a batch, pages to visit, known hosts, states of
workers, and the quality report of minted places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import hosts, text
from plumbline.operators import inventory, quality, records, resolve

#: MSC-10: one decision about a name of a source.
DECISION = "row_id long, source_name string, source_level string, decision string, reason string, entity_id string, matched_name string, matched_level string, confidence_score double, confidence_tier string, match_type string"


def base_registry(seed: DataFrame, batches: dict[str, DataFrame | None], needed: str, without: str | None = None, only: list[str] | None = None) -> DataFrame:
    """MSC-12, 13: the seed with batches merged in their order, as the next batch must find it: all but ``without``, or
    ``only`` some. Without the batch ``needed``, on which all others build, it is refused."""
    if batches.get(needed) is None:
        raise ValueError(f"batch {needed} is missing: its records would be minted twice")
    use = [b for name, b in batches.items() if b is not None and name != without and (only is None or name in only)]
    return resolve.merge_batches(seed, use)[0] if use else seed


def decisions(rows: DataFrame, keys: DataFrame, entities: DataFrame, level: str) -> DataFrame:
    """MSC-10: decisions of the exact matcher in full: what was matched and how surely (1 for an exact key, else 0)."""
    d = resolve.reconcile(rows.select("row_id", "name", "acronym"), keys, F.lit(level))
    meant = entities.select(F.col("id").alias("entity_id"), F.col("name").alias("matched_name"), F.col("government_level").alias("matched_level"))
    sure = F.col("reason") != "no_match"
    j = d.join(rows.select("row_id", F.col("name").alias("source_name")), "row_id").join(meant, "entity_id", "left")
    full = j.withColumns({"source_level": F.lit(level), "confidence_score": sure.cast("double"), "confidence_tier": F.when(sure, "exact").otherwise("none"), "match_type": F.when(sure, "exact").otherwise("no_match")})
    return full.select(*(c.strip().split(" ")[0] for c in DECISION.split(",")))


def known_hosts(sites: DataFrame, domain: str) -> DataFrame:
    """MSC-42: distinct host keys of listed sites."""
    key = hosts.strip_www(hosts.url_host(F.col(domain)))
    return sites.select(key.alias("host_key")).where("host_key <> ''").distinct()


def listed_page_targets(sites: DataFrame, pages: DataFrame, extra: DataFrame, corrections: DataFrame) -> DataFrame:
    """MSC-46: deep pages of a list of sites and of an extra list, with their owners; a table that isn't laid out as a
    list of sites is refused. ``sites(host_key, ids, page_urls)``, ``pages(url, name, entity_id, source, seq)``,
    ``extra(url, seq)``."""
    quality.require_columns(sites, ["host_key", "ids", "page_urls"])
    listed = sites.select(F.posexplode("page_urls").alias("pos", "url")).select("url", F.col("pos").cast("long").alias("seq"))
    deep = inventory.deep_pages(sites, listed.unionByName(extra.select("url", F.col("seq").cast("long").alias("seq"))), corrections)
    owners = inventory.page_owners(pages).withColumn("page_key", hosts.address_key(F.col("url"))).drop("url").dropDuplicates(["page_key"])
    return deep.join(owners, "page_key", "left")


def text_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-10: cells of a workbook as trimmed texts; a column that came as a number has lost its leading zeros and is
    refused. Rows without any text are left out."""
    kinds = dict(df.dtypes)
    wrong = [c for c in columns if kinds[c] != "string"]
    if wrong:
        raise TypeError(f"numbers where texts were expected: {', '.join(wrong)}")
    trimmed = df.select(*(F.trim(c).alias(c) for c in columns))
    return trimmed.where(F.concat_ws("", *columns) != "")


def run_states(workers: DataFrame) -> DataFrame:
    """STR-8: run, state and error of runs from the ends of their workers ``workers(run, worker, error)``: a run one of
    whose workers crashed broke, whatever the others did."""
    errors = F.sort_array(F.collect_set(F.concat_ws(": ", "worker", "error")))  # as many as a run has workers
    crashed = F.filter(errors, lambda e: e.contains(": "))
    state = F.when(F.count("error") > 0, "broke").otherwise("done")
    return workers.groupBy("run").agg(state.alias("state"), F.when(F.size(crashed) > 0, F.concat(F.lit("worker crashed: "), F.array_join(crashed, "; "))).alias("error"))


def places_report(places: DataFrame, spine: DataFrame, codes: DataFrame, names: DataFrame) -> DataFrame:
    """MSC-24: the three checks over minted places as (check, level, what, n): problems of codes against the spine, rate
    of one-to-one matches by code and name, rate of matches by name as often as it occurs. ``places(id, level, name,
    code)``, ``spine(code)``, ``codes(level, name, code)``, ``names(level, name)``."""
    of = lambda check, df: df.select(F.lit(check).alias("check"), "level", "what", F.col("n").cast("long").alias("n"))
    problems = records.qa_codes(places.select("id", "code"), spine).groupBy(F.col("problem").alias("what")).agg(F.count("*").alias("n")).withColumn("level", F.lit("all"))
    counted = places.groupBy("level").agg(F.count("*").alias("n")).withColumn("what", F.lit("places"))
    key = lambda *more: F.concat_ws("|", "level", text.place_key(F.col("name")), *more)
    left, right = places.select("level", key("code").alias("k")), codes.select(key("code").alias("k")).distinct()
    by_code = left.join(right, "k", "left_semi").groupBy("level").agg(F.count("*").alias("n")).withColumn("what", F.lit("matched"))
    a = places.groupBy("level", key().alias("k")).agg(F.count("*").alias("n"))
    b = names.groupBy(key().alias("k")).agg(F.count("*").alias("m"))
    by_name = a.join(b, "k").groupBy("level").agg(F.sum(F.least("n", "m")).alias("n")).withColumn("what", F.lit("matched"))
    return of("spine", problems).unionByName(of("places", counted)).unionByName(of("codes", by_code)).unionByName(of("names", by_name))
