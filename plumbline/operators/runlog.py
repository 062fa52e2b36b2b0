"""Request logs of a run: streaks, pacing, quarantine, breakers, estimates, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Failures in a row, and different hosts among them, at which the own network is suspected.
STREAK, STREAK_HOSTS = 8, 4
#: Refusals in a row at which a host is left alone.
REFUSALS = 4
#: Seconds between requests, seconds a request takes (assumed), seconds between requests to one host.
PACE, RESPONSE, FLOOR = 6.0, 1.0, 30.0


def failure_streaks(log: DataFrame, run: str, order: str, host: str, failed: Column, streak: int = STREAK, least_hosts: int = STREAK_HOSTS) -> DataFrame:
    """WIN-3: adds streak (failures in a row up to this row), streak_hosts (different hosts among them) and suspect.
    Gaps and islands: successes number the islands; a run's rows are sorted once."""
    w = Window.partitionBy(run).orderBy(order)
    isl = log.withColumns({"__f": F.coalesce(failed, F.lit(False)), "__isl": F.sum(F.when(F.coalesce(failed, F.lit(False)), 0).otherwise(1)).over(w)})
    inside = Window.partitionBy(run, "__isl").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    firsts = isl.withColumn("__new", (F.row_number().over(Window.partitionBy(run, "__isl", host, "__f").orderBy(order)) == 1) & F.col("__f"))
    out = firsts.withColumns({"streak": F.sum(F.col("__f").cast("int")).over(inside), "streak_hosts": F.sum(F.col("__new").cast("int")).over(inside)})
    return out.withColumn("suspect", (F.col("streak") >= streak) & (F.col("streak_hosts") >= least_hosts)).drop("__f", "__isl", "__new")


def pacing(log: DataFrame, host: str, ts: str, floor: float | Column = FLOOR) -> DataFrame:
    """WIN-4: adds gap_s to the host's request before, and too_soon."""
    at = F.col(ts).cast("timestamp")  # times without a zone are read in the session's
    gap = F.unix_micros(at) - F.unix_micros(F.lag(at).over(Window.partitionBy(host).orderBy(ts)))
    floor = floor if isinstance(floor, Column) else F.lit(floor)
    return log.withColumn("gap_s", gap / 1e6).withColumn("too_soon", F.coalesce(F.col("gap_s") < floor, F.lit(False)))


def quarantined(log: DataFrame, host: str, order: str, pushback: Column) -> DataFrame:
    """WIN-5: adds quarantined, true after a host's first pushback. The first is an aggregate, joined back, so that no
    host's rows are sorted."""
    first = log.where(pushback).groupBy(host).agg(F.min(order).alias("__first"))
    return log.join(first, host, "left").withColumn("quarantined", F.coalesce(F.col(order) > F.col("__first"), F.lit(False))).drop("__first")


def breakers(log: DataFrame, host: str, order: str, refused: Column, succeeded: Column, trip: int = REFUSALS) -> DataFrame:
    """WIN-6: adds refusals (in a row, set back by a success) and tripped."""
    w = Window.partitionBy(host).orderBy(order)
    isl = log.withColumn("__isl", F.sum(F.when(F.coalesce(succeeded, F.lit(False)), 1).otherwise(0)).over(w))
    run = F.sum(F.when(F.coalesce(refused, F.lit(False)), 1).otherwise(0)).over(Window.partitionBy(host, "__isl").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return isl.withColumn("refusals", run).withColumn("tripped", F.col("refusals") >= trip).drop("__isl")


def interleave(jobs: DataFrame, host: str, key: Column) -> DataFrame:
    """WIN-9: adds turn and host_key; ordered by both, the hosts take turns. ``key`` orders a host's jobs (a seeded hash
    in a run, a column in a test)."""
    return jobs.withColumn("turn", F.row_number().over(Window.partitionBy(host).orderBy(key))).withColumn("host_key", F.col(host))


def about_ranking(links: DataFrame, page: str) -> DataFrame:
    """WIN-7: candidates of a page by depth, score and address."""
    return links.withColumn("rank", F.row_number().over(Window.partitionBy(page).orderBy("depth", F.desc("score"), "url")))


def requests_per_host(tier: str, identities: int, is_portal: Column | None = None) -> Column:
    """AGG-18: struct(least, most)."""
    core = 5 + identities
    if tier == "core":
        return F.struct(F.lit(core).alias("least"), F.lit(core).alias("most"))
    more = F.when(F.coalesce(is_portal, F.lit(False)), 3 + identities - 1).otherwise(0) if is_portal is not None else F.lit(0)
    return F.struct(F.lit(core + 4).alias("least"), (F.lit(core + 25) + more).alias("most"))


def run_estimate(jobs: DataFrame, host: str, seq: str, tier: str, identities: int, is_portal: Column, workers: int = 1, pace: float = PACE, floor: float = FLOOR) -> DataFrame:
    """AGG-16: one row: hosts, requests and hours (least and most), the busiest host. Of equally busy hosts the first."""
    each = jobs.select(F.col(host).alias("host"), F.col(seq).alias("seq"), requests_per_host(tier, identities, is_portal).alias("n"))
    one = each.agg(F.count("*").alias("hosts"), F.sum("n.least").alias("requests_min"), F.sum("n.most").alias("requests_max"), F.min_by("host", F.struct(-F.col("n.most"), "seq")).alias("busiest"), F.min_by("n", F.struct(-F.col("n.most"), "seq")).alias("b"))
    hours = lambda n, b: F.bround(F.greatest(F.col(n) * (pace + RESPONSE) / max(1, workers), F.greatest(F.col(b) - 1, F.lit(0)) * floor) / 3600, 1)
    return one.select("hosts", "requests_min", "requests_max", hours("requests_min", "b.least").alias("hours_min"), hours("requests_max", "b.most").alias("hours_max"), "busiest")


def page_estimate(jobs: DataFrame, host: str, page_host: str, seq: str, identities: int, floor: float = FLOOR) -> DataFrame:
    """AGG-17: one row: pages, hosts, robots files, requests, busiest host, least hours. A page host's robots file is
    charged to the host of its first job."""
    robots = jobs.groupBy(page_host).agg(F.min_by(host, seq).alias(host)).groupBy(host).agg(F.count("*").alias("r"))
    per = jobs.groupBy(host).agg((F.count("*") * identities).alias("n"), F.count("*").alias("pages"), F.min(seq).alias("at"))
    j = per.join(robots, host, "left").na.fill(0, ["r"]).withColumn("all", F.col("n") + F.col("r"))
    return j.agg(F.sum("pages").alias("pages"), F.count("*").alias("hosts"), F.sum("r").alias("robots"), F.sum("all").alias("requests"), F.min_by(host, F.struct(-F.col("all"), "at")).alias("busiest"), F.bround((F.max("all") - 1) * floor / 3600, 1).alias("min_hours"))


def page_hours(requests: Column, min_hours: Column, workers: int = 1, pace: float = PACE) -> Column:
    """MSC-45."""
    return F.greatest(F.bround(requests * (pace + RESPONSE) / max(1, workers) / 3600, 1), min_hours)


def pending(jobs: DataFrame, done: DataFrame, unit: list[str]) -> DataFrame:
    """STR-4: jobs whose unit isn't finished."""
    return jobs.join(done.select(*unit).distinct(), unit, "left_anti")


def finished_rows(rows: DataFrame, done: DataFrame, unit: list[str]) -> DataFrame:
    """STR-4: rows of finished units only; what a torn unit left is dropped."""
    return rows.join(done.select(*unit).distinct(), unit, "left_semi")


def within_cap(log: DataFrame, run: str, order: str, cap: int) -> DataFrame:
    """STR-5: the run's first ``cap`` requests."""
    return log.withColumn("__n", F.row_number().over(Window.partitionBy(run).orderBy(order))).where(F.col("__n") <= cap).drop("__n")


def job_unit(page_url: Column, host: Column) -> Column:
    """MSC-47."""
    return F.coalesce(page_url, host)


def pace_host(given: Column, url: Column) -> Column:
    """MSC-48."""
    from plumbline.functions import hosts

    return F.coalesce(given, hosts.url_host(url))


def plan_requests(hosts_df: DataFrame, tier: str, identities: list[str]) -> DataFrame:
    """Requests of a host run as rows (host, step, kind, identity, url): files first, then the homepage once per
    identity, the probe for a missing page and plain http; the full tier adds its documented extra addresses."""
    base = F.concat(F.lit("https://"), F.col("host"))
    fixed = [("robots", "research", F.concat(base, F.lit("/robots.txt"))), ("llms", "research", F.concat(base, F.lit("/llms.txt"))), ("sitemap", "research", F.concat(base, F.lit("/sitemap.xml")))]
    fixed += [("home", i, F.concat(base, F.lit("/"))) for i in identities]
    fixed += [("notfound", "research", F.concat(base, F.lit("/not-here-"), F.left(F.sha2("host", 256), F.lit(12)))), ("http", "research", F.concat(F.lit("http://"), F.col("host"), F.lit("/")))]
    if tier == "full":
        fixed += [("llms_full", "research", F.concat(base, F.lit("/llms-full.txt"))), ("md_accept", "research", F.concat(base, F.lit("/"))), ("md_index", "research", F.concat(base, F.lit("/index.md"))), ("api_catalog", "research", F.concat(base, F.lit("/.well-known/api-catalog")))]
    steps = F.array(*(F.struct(F.lit(k).alias("step"), F.lit(kind).alias("kind"), F.lit(i).alias("identity"), u.alias("url")) for k, (kind, i, u) in enumerate(fixed, 1)))
    return hosts_df.select("host", F.explode(steps).alias("s")).select("host", "s.*")
