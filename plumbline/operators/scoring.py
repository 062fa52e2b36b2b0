"""Scores from verdict rows, their wide form, summaries, and comparison of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The twelve scored rows and their tests, points of a verdict, and all verdicts.
SCORED = (
    ("Has robots.txt", "W1"),
    ("Names AI crawlers", "W2"),
    ("Homepage reachable by an agent", "W4"),
    ("Sitemap listed in robots.txt", "M1"),
    ("Working sitemap.xml", "M2"),
    ("Has llms.txt", "M4"),
    ("Text readable without JavaScript", "R1"),
    ("Meta description", "I1"),
    ("Open Graph tags", "I2"),
    ("Structured data (schema.org)", "I3"),
    ("Open data linked from the homepage", "D1"),
    ("No stale or broken content", "F1+F3"),
)
VERDICTS = ("pass", "partial", "fail", "blocked", "na", "reported")
# Names of transport failures in the federal scan's vocabulary.
SCAN_STATUS = {"dns": "dns_resolution_error", "tls": "invalid_ssl_cert", "reset": "connection_reset", "timeout": "timeout", "refused": "connection_refused", "other": "unknown_error"}


def first_rows(rows: DataFrame, by: list[str], order: str, last: bool = False) -> DataFrame:
    """WIN-1, WIN-2: the first (or last) row of each group in the given order; one aggregate, no sort of groups."""
    pick = F.max_by if last else F.min_by
    kept = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(pick(F.struct(*kept), order).alias("__r")).select(*by, "__r.*")


def composite(f1: Column, f3: Column) -> Column:
    """The two freshness tests as one row."""
    either = lambda v: F.coalesce(f1 == v, F.lit(False)) | F.coalesce(f3 == v, F.lit(False))
    return F.when(f3.isNull(), F.coalesce(f1, F.lit("na"))).when((f1 == "pass") & (f3 == "pass"), "pass").when(either("blocked"), "blocked").when(either("fail"), "fail").when(either("pass"), "partial").otherwise("na")


def host_verdicts(results: DataFrame, key: str = "host", order: str = "seq") -> DataFrame:
    """AGG-9: one row per host with a verdict column for each test (F1+F3 as f1f3). The first row of a test stands; W4
    and D7 count only as their all-AI aggregate."""
    counts = ~F.col("test").isin("W4", "D7") | (F.col("identity") == "all_ai")
    tests = [t for _, t in SCORED if t != "F1+F3"] + ["F1", "F3", "D7"]
    at = lambda t: F.min_by("verdict", F.when(F.col("test") == t, F.col(order))).alias(t.lower())
    wide = results.where(counts).groupBy(key).agg(*(at(t) for t in tests))
    return wide.withColumn("f1f3", composite(F.col("f1"), F.col("f3")))


def _columns() -> list[str]:
    return ["f1f3" if t == "F1+F3" else t.lower() for _, t in SCORED]


def scores(wide: DataFrame) -> DataFrame:
    """AGG-10, 11: score of twelve (1, 0.5, 0), and the view that keeps what wasn't measured apart."""
    points = lambda c: F.when(F.col(c) == "pass", 1.0).when(F.col(c) == "partial", 0.5).otherwise(0.0)
    n = lambda *vs: sum((F.coalesce(F.col(c).isin(*vs), F.lit(False)).cast("int") for c in _columns()), F.lit(0))
    total = sum((points(c) for c in _columns()), F.lit(0.0))
    missing = sum(((F.coalesce(F.col(c), F.lit("na")) == "na").cast("int") for c in _columns()), F.lit(0))
    return wide.withColumns({"score": total, "measured_rows": n("pass", "partial", "fail"), "blocked_rows": n("blocked"), "na_rows": missing})


def verdict_counts(results: DataFrame) -> DataFrame:
    """AGG-12: counts of each verdict per test, and over all tests, in one pass (rollup)."""
    return results.rollup("test").agg(F.grouping("test").cast("int").alias("is_total"), *(F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS))


def score_summary(scored: DataFrame) -> DataFrame:
    """Hosts, mean, median, least and greatest score."""
    return scored.agg(F.count("*").alias("hosts"), F.bround(F.avg("score"), 2).alias("mean"), F.median("score").alias("median"), F.min("score").alias("least"), F.max("score").alias("most"))


def identities_of(results: DataFrame, first: list[str]) -> list[str]:
    """EXP-5: identities of a run, the given ones first; as many as a run has names it sends."""
    seen = {r.identity for r in results.where("test = 'W4' and identity <> 'all_ai'").select("identity").distinct().collect()}
    return [i for i in first if i in seen] + sorted(seen - set(first))


def wide_export(targets: DataFrame, results: DataFrame, identities: list[str], key: str = "host", order: str = "seq") -> DataFrame:
    """EXP-1, 2, 4: one row per target, verdicts of all tests, and verdict and status for each identity; targets without
    results keep nulls. One aggregate over the results and one join."""
    scored = scores(host_verdicts(results, key, order))
    by = lambda i: (F.col("test") == "W4") & (F.col("identity") == i)
    admitted = F.min_by("verdict", F.when(F.col("test") == "W4", F.col(order)))
    per = results.groupBy(key).agg(
        *(F.min_by("verdict", F.when(by(i), F.col(order))).alias(f"w4_{i}") for i in identities),
        *(F.min_by(F.get_json_object("evidence", "$.status").cast("int"), F.when(by(i), F.col(order))).alias(f"status_{i}") for i in identities),
        admitted.alias("first_w4"),
    )
    return targets.join(scored, key, "left").join(per, key, "left")


def scan_status(status: Column, quarantine: Column, has_rows: Column) -> Column:
    """EXP-6."""
    kind = F.regexp_extract(quarantine, r"^transport (\w+)", 1)
    mapped = F.coalesce(*(F.when(kind == k, v) for k, v in SCAN_STATUS.items()), F.lit("unknown_error"))
    return F.when(status.isNotNull(), "completed").when(quarantine.isNull(), F.when(has_rows, "unknown_error")).when(quarantine.startswith("transport "), mapped).otherwise("skipped")


def test_scan_status(has_row: Column, test_status: Column, primary: Column) -> Column:
    """EXP-7."""
    return F.when(~has_row, F.lit(None).cast("string")).when(test_status.isNotNull(), "completed").when(primary == "completed", "unknown_error").otherwise(primary)


def https_enforced(http_status: Column, redirects: Column) -> Column:
    """EXP-8: null where plain http neither served nor went on to https."""
    return F.when(F.coalesce(redirects, F.lit(False)), True).when(http_status.between(200, 299), False)


def is_redirect(url: Column, final_url: Column) -> Column:
    """EXP-9."""
    from plumbline.functions import hosts

    a, b = (F.concat(hosts.url_host(u), F.lit("/"), F.regexp_replace(hosts.url_path(u), "^/", "")) for u in (url, final_url))
    return F.when(final_url.isNotNull(), a != b)


def is_live(status: Column) -> Column:
    """EXP-15."""
    return F.when(status.isNotNull(), status.between(200, 206))


def sitemap_at_root(url: Column) -> Column:
    """EXP-10, 17: the federal fields describe /sitemap.xml only."""
    from plumbline.functions import hosts

    return F.coalesce(hosts.url_path(url) == "/sitemap.xml", F.lit(False))


def robots_detected(status: Column, final_url: Column, host: Column) -> Column:
    """EXP-18."""
    from plumbline.functions import hosts

    place = final_url.isNull() | ((hosts.url_host(final_url) == host) & (hosts.url_path(final_url) == "/robots.txt"))
    return F.when(status.isNotNull(), (status == 200) & place)


def decisions_list(tokens: Column) -> Column:
    """EXP-19: map token -> decision as sorted 'token=decision'; null if empty."""
    pairs = F.array_sort(F.transform(F.map_entries(tokens), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.when(F.size(pairs) > 0, pairs)


def admitted(verdict: Column) -> Column:
    """EXP-20."""
    return F.when(verdict != "na", verdict == "pass")


def name_decides(plain: Column, as_browser: Column) -> Column:
    """V1: whether only the name kept a browser out; null where either wasn't measured."""
    return F.when(plain.isNotNull() & as_browser.isNotNull() & (plain != "na") & (as_browser != "na"), (plain == "blocked") & (as_browser == "pass"))


def admitted_split(ids: Column, yes: bool) -> Column:
    """EXP-30: sorted identities that were (or weren't) admitted; null if there are none."""
    names = F.array_sort(F.map_keys(F.map_filter(ids, lambda k, v: (v == "pass") if yes else (v != "pass"))))
    return F.when(F.size(names) > 0, names)


def family_ok(by_family_ip: Column, public_ip: Column, family: str) -> Column:
    """EXP-11, SCL-36: whether a family of addresses worked: its own reading, else that of the one address seen."""
    is6 = public_ip.contains(":")
    return F.coalesce(by_family_ip != "", F.when((is6 if family == "ipv6" else ~is6), True))


def network_change(start: Column, end: Column) -> Column:
    """SCL-38: null when either reading failed."""
    return F.when(start.isNotNull() & end.isNotNull(), start != end)


def flips(results: DataFrame, by: list[str], run: str = "run_ts") -> DataFrame:
    """WIN-11: verdicts that changed from one run to the next, confirmed if the run after says the same."""
    w = Window.partitionBy(*by).orderBy(run)
    rows = results.withColumns({"before": F.lag("verdict").over(w), "after": F.lead("verdict").over(w)})
    return rows.where("before is not null and before <> verdict").withColumn("confirmed", F.coalesce(F.col("after") == F.col("verdict"), F.lit(False)))


def parity(results: DataFrame, by: list[str], side: str, a: str, b: str) -> DataFrame:
    """V2: verdicts from two vantage points that differ."""
    wide = results.groupBy(*by).agg(F.max(F.when(F.col(side) == a, F.col("verdict"))).alias("left"), F.max(F.when(F.col(side) == b, F.col("verdict"))).alias("right"))
    return wide.where("left is not null and right is not null and left <> right")


def retest(results: DataFrame, again: DataFrame, by: list[str]) -> DataFrame:
    """EXP-1: what a second run says beside the first."""
    return results.join(again.select(*by, F.col("verdict").alias("again")), by, "left").withColumn("same", F.col("verdict") == F.col("again"))


def csv_value(c: Column, kind: str) -> Column:
    """SNK-3: TRUE and FALSE, lists joined by commas, blanks for null."""
    if kind == "boolean":
        s = F.when(c, "TRUE").when(~c, "FALSE")
    elif kind.startswith("array"):
        s = F.array_join(c, ",")
    else:
        s = c.cast("string")
    return F.coalesce(s, F.lit(""))


def dictionary(df: DataFrame, notes: dict[str, str]) -> list[tuple[str, str, str]]:
    """EXP-12, 33, SNK-7: (column, type, note) from the very schema that is written, so that they can't drift."""
    return [(f.name, f.dataType.simpleString(), notes.get(f.name, "")) for f in df.schema]
