"""Hosts, URLs and registered domains as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A small suffix table for tests and for data whose hosts end like these; suffix_rules() reads a full list.
SAMPLE_RULES = "com\norg\nnet\ngov\nny.us\nuk\nco.uk\n*.ck\n!www.ck\nexample\n"

# Names of hosts that are machinery, vendors that host for others, senders of tracked mail.
INFRA_LABELS = r"^(?:mail|smtp|imap|pop3?|mx\d*|ns\d*|dns\d*|ftp|sftp|vpn|remote|autodiscover|owa|exchange|webmail|cpanel|whm|webdisk|dev|test|qa|uat|stage|admin|api|cdn|static|assets|img|images|proxy|gateway|firewall|sip|lyncdiscover|msoid|enterpriseregistration|enterpriseenrollment)\d*$"
VENDOR_DOMAINS = ("govdelivery.com", "granicus.com", "civicplus.com", "azurewebsites.net", "cloudfront.net", "herokuapp.com", "wpengine.com")
EMAIL_TRACKERS = ("sendgrid.net", "mailgun.org", "mandrillapp.com", "mcsv.net", "list-manage.com", "exacttarget.com", "pardot.com", "hubspotemail.net")


def _with_scheme(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.contains("//"), t).otherwise(F.concat(F.lit("https://"), t))


def url_host(c: Column) -> Column:
    """PRJ-1: lower-case host of a URL or bare host, without user and port; null if there is none."""
    rest = F.regexp_extract(_with_scheme(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(rest, "^.*@", ""), r":\d*$", ""))
    return F.nullif(host, F.lit(""))


def url_path(c: Column) -> Column:
    """PRJ-1: path, '' for the root."""
    p = F.regexp_extract(_with_scheme(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.when(p == "/", "").otherwise(p)


def url_query(c: Column) -> Column:
    return F.regexp_extract(c, r"\?([^#]*)", 1)


def host_path(c: Column) -> Column:
    """PRJ-2: struct(host, path) of a website cell; the path keeps the query. Null host where it has no dot."""
    host = url_host(c)
    q = url_query(c)
    path = F.concat(url_path(c), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.struct(F.when(host.contains("."), host).alias("host"), path.alias("path"))


def strip_www_digits(c: Column) -> Column:
    """PRJ-3: without www., www1. and so on."""
    return F.regexp_replace(F.lower(c), r"^www\d*\.", "")


def strip_www(c: Column) -> Column:
    """PRJ-4: without exactly www."""
    return F.regexp_replace(c, r"^www\.", "")


def messy_host(c: Column) -> Column:
    """PRJ-5, 6, 7: the host of a website cell as people fill it in: scheme, www, path, port and blanks dropped."""
    h = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.\-]*:/*", "")
    return F.nullif(strip_www_digits(F.regexp_replace(F.regexp_replace(h, r"[/?#\s].*$", ""), r":\d+$", "")), F.lit(""))


def host_is_valid(host: Column, tlds: list[str] | None = None) -> Column:
    """PRJ-8: labels and length right, no 'wwww.', last label among ``tlds`` if they are given."""
    ok = host.rlike(r"^(?=.{1,253}$)([a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}$") & ~host.startswith("wwww.")
    if tlds is not None:
        ok = ok & tld(host).isin(*tlds)
    return F.coalesce(ok, F.lit(False))


def tld(host: Column) -> Column:
    """PRJ-10."""
    return F.lower(F.element_at(F.split(host, r"\."), -1))


def bare_mime(c: Column) -> Column:
    """PRJ-11."""
    return F.lower(F.trim(F.split_part(c, F.lit(";"), F.lit(1))))


def suffix_rules(spark: SparkSession, path: str | None = None, text: str | None = None) -> DataFrame:
    """SRC-17: a public suffix list as rows (rule, kind) with kind rule, wild or exception. The list's size is that of
    the published file (some ten thousand rules)."""
    lines = spark.read.text(path) if path else spark.createDataFrame([(x,) for x in (text or SAMPLE_RULES).splitlines()], "value string")
    rule = F.lower(F.regexp_extract(F.trim("value"), r"^(\S+)", 1))
    kind = F.when(rule.startswith("!"), "exception").when(rule.startswith("*."), "wild").otherwise("rule")
    return lines.where((F.trim("value") != "") & ~F.trim("value").startswith("//")).select(F.regexp_replace(rule, r"^!|^\*\.", "").alias("rule"), kind.alias("kind")).distinct()


def with_base_domain(df: DataFrame, host: str, rules: DataFrame, out: str = "base_domain") -> DataFrame:
    """PRJ-9: add the registered domain. Every ending of a distinct host is met with the rules; the longest hit decides
    (an exception is one label shorter, no hit means a suffix of one label). Null for null and for hosts that are a
    suffix. A join of distinct hosts' endings, so a host that many rows share is worked out once."""
    hosts = df.select(F.col(host).alias("__h")).where("__h is not null").distinct()
    labels = F.split(F.regexp_replace(F.lower("__h"), r"\.+$", ""), r"\.")
    ends = hosts.withColumn("__l", labels).select("__h", "__l", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("__l")), lambda i: F.array_join(F.slice("__l", i, F.size("__l")), "."))).alias("__i", "__end"))
    n = F.size("__l")
    hit = ends.join(rules.withColumnsRenamed({"rule": "__end"}), "__end").select(
        "__h",
        F.when(F.col("kind") == "wild", F.col("__i") - 1).otherwise(F.col("__i")).alias("at"),
        F.when(F.col("kind") == "exception", n - F.col("__i") - 1).when(F.col("kind") == "wild", n - F.col("__i") + 1).otherwise(n - F.col("__i")).alias("len"),
        (F.col("kind") == "exception").cast("int").alias("exc"),
    )
    # at one place an exception goes before a rule; wild rules at place -1 would be longer than the host
    best = hit.where("at >= 0").groupBy("__h").agg(F.min(F.struct("at", (-F.col("exc")).alias("e"), "len"))["len"].alias("len"))
    size = F.coalesce("len", F.lit(1))
    done = hosts.withColumn("__l", labels).join(best, "__h", "left").select("__h", F.when(F.size("__l") > size, F.array_join(F.slice("__l", F.size("__l") - size, size + 1), ".")).alias(out))
    return df.join(done, df[host] == done["__h"], "left").drop("__h")


def address_key(c: Column) -> Column:
    """PRJ-12, 13: what makes two addresses the same: host without www, path without final slash, query."""
    q = url_query(c)
    host = strip_www(F.regexp_replace(url_host(c), r"\.+$", ""))
    return F.concat(host, F.regexp_replace(url_path(c), "/+$", ""), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def parents_of(host: Column, base: Column) -> Column:
    """Hosts above ``host``, lowest first, down to and with its registered domain."""
    labels = F.split(host, r"\.")
    n = F.size(labels) - F.size(F.split(base, r"\."))
    up = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    return F.when(n >= 1, up).otherwise(F.array().cast("array<string>"))


def below_marked(df: DataFrame, host: str, base: str, marked: DataFrame, mark: str) -> DataFrame:
    """PRJ-14: add marked_above, the lowest marked host above each row's host within its registered domain."""
    ups = df.select(F.col(host).alias("__h"), F.col(base).alias("__b")).where("__h is not null and __b is not null").distinct()
    ups = ups.select("__h", F.posexplode(parents_of(F.col("__h"), F.col("__b"))).alias("__i", "__p"))
    hit = ups.join(marked.select(F.col(mark).alias("__p")).distinct(), "__p").groupBy("__h").agg(F.min_by("__p", "__i").alias("marked_above"))
    return df.join(hit, df[host] == hit["__h"], "left").drop("__h")


def subsite_of(df: DataFrame, host: str, base: str, owners: str) -> DataFrame:
    """PRJ-17: add parent_site, the nearest host above that is listed too and shares an owner."""
    rows = df.select(F.col(host).alias("__h"), F.col(base).alias("__b"), F.col(owners).alias("__o")).where("__h is not null and __b is not null").groupBy("__h", "__b").agg(F.flatten(F.collect_set("__o")).alias("__o"))
    ups = rows.select("__h", "__o", F.posexplode(parents_of(F.col("__h"), F.col("__b"))).alias("__i", "__p"))
    listed = rows.select(F.col("__h").alias("__p"), F.col("__o").alias("__po"))
    hit = ups.join(listed, "__p").where(F.arrays_overlap("__o", "__po")).groupBy("__h").agg(F.min_by("__p", "__i").alias("parent_site"))
    return df.join(hit, df[host] == hit["__h"], "left").drop("__h")


def is_machine_endpoint(c: Column) -> Column:
    """PRJ-16: addresses that answer programs, not people."""
    u = F.lower(c)
    return u.contains("/rest/services") | u.contains("/api/") | u.endswith("/api") | u.contains("/odata/") | u.endswith(".json") | u.startswith("https://api.") | u.contains("/wfs") | u.contains("/wms")


def is_infra(name: Column, domain: Column) -> Column:
    """PRJ-18: any label below the domain is machinery."""
    below = F.regexp_replace(name, F.concat(F.lit(r"\.?"), F.regexp_replace(domain, r"\.", r"\\\\."), F.lit("$")), "")
    return F.exists(F.split(below, r"\."), lambda x: x.rlike(INFRA_LABELS) | x.contains("staging"))


def _below_any(h: Column, domains: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, ((h == d) | h.endswith(f".{d}") for d in domains))


def on_vendor(domain: Column) -> Column:
    """PRJ-19."""
    return _below_any(F.lower(domain), VENDOR_DOMAINS)


def is_email_tracker(canonical: Column) -> Column:
    """PRJ-20."""
    return F.coalesce(_below_any(F.regexp_replace(F.lower(canonical), r"\.$", ""), EMAIL_TRACKERS), F.lit(False))


def accept_answer(status: Column, content_type: Column, location: Column, name: Column) -> Column:
    """PRJ-21: struct(kept, why) for the first answer of a host found in a certificate log."""
    target = url_host(location)
    return (
        F.when(status.isNull(), F.struct(F.lit(False).alias("kept"), F.lit("no answer").alias("why")))
        .when(status.between(300, 399) & target.isNotNull() & (strip_www(target) != strip_www(name)), F.struct(F.lit(False).alias("kept"), F.lit("redirects to another host").alias("why")))
        .when(status.between(300, 399), F.struct(F.lit(True).alias("kept"), F.lit("redirects on its own host").alias("why")))
        .when((status == 200) & bare_mime(content_type).isin("text/html", "application/xhtml+xml"), F.struct(F.lit(True).alias("kept"), F.lit("serves a page").alias("why")))
        .when(status.isin(401, 403, 429), F.struct(F.lit(True).alias("kept"), F.lit("refuses").alias("why")))
        .otherwise(F.struct(F.lit(False).alias("kept"), F.concat(F.lit("status "), status.cast("string")).alias("why")))
    )


def host_ok(host: Column, base: Column) -> Column:
    """MSC-20, 21: the registered domain itself (or its www), and not a social network."""
    # Social networks that are nobody's own site.
    social = ("facebook.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "youtube.com", "nextdoor.com", "tiktok.com")
    bare = strip_www(host)
    return F.coalesce((bare == base) & ~bare.isin(*social), F.lit(False))


def clean_location(c: Column) -> Column:
    """PRJ-52: a Location header as a browser reads it: control characters and blanks at the ends cut, tabs and line
    breaks inside dropped, other blanks and controls percent-encoded."""
    s = F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    s = F.regexp_replace(s, r"[\t\n\r]", "")
    codes = [*range(0x00, 0x09), 0x0B, 0x0C, *range(0x0E, 0x21), 0x7F]
    return reduce(lambda x, k: F.replace(x, F.lit(chr(k)), F.lit(f"%{k:02X}")), codes, s)


def candidate_urls(start: Column, tails: list[str], limit: int) -> Column:
    """PRJ-49, 50, 51: addresses to try, best first: ``tails`` below the start's directory, then below its host;
    without the start itself and without doubles, at most ``limit``."""
    host = F.concat(F.regexp_extract(start, r"^([a-zA-Z]+)://", 1), F.lit("://"), url_host(start))
    directory = F.regexp_replace(url_path(start), "/[^/]*$", "")
    tried = F.concat(
        F.when(directory != "", F.array(*(F.concat(host, directory, F.lit(t)) for t in tails))).otherwise(F.array().cast("array<string>")),
        F.array(*(F.concat(host, F.lit(t)) for t in tails)),
    )
    fresh = F.array_except(F.array_distinct(tried), F.array(start, F.regexp_replace(start, "/$", "")))
    return F.when(start.rlike("^[a-zA-Z]+://[^/]+"), F.slice(fresh, 1, limit)).otherwise(F.array().cast("array<string>"))
