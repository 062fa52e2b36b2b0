"""Queries over result rows and request logs (the events table stands in for both), texts, and general relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import text, web
from plumbline.operators import resolve, runlog, scoring, verdicts
from plumbline.session import table, written
from plumbline.streaming import state

_L = F.lit


def _results(spark: SparkSession, d: str) -> DataFrame:
    """events as verdict rows: user is the host, event type the test, value the verdict."""
    e = table(spark, d, "events")
    tests = ["W1", "W2", "W4", "M1", "R1", "F1", "F3", "I1"]
    test = F.element_at(F.array(*map(_L, tests)), (F.col("event_id") % 8 + 1).cast("int"))
    v = F.element_at(F.array(*map(_L, ("pass", "partial", "fail", "blocked", "na"))), (F.floor(F.col("value") * 7) % 5 + 1).cast("int"))
    identity = F.when(F.col("event_id") % 3 == 0, "all_ai").when(F.col("event_id") % 3 == 1, "gptbot").otherwise("research")
    return e.select(F.concat(_L("h"), F.col("user_id")).alias("host"), test.alias("test"), identity.alias("identity"), v.alias("verdict"), F.to_json(F.struct((F.col("event_id") % 5 * 100).cast("int").alias("status"))).alias("evidence"), F.col("event_id").alias("seq"), F.date_format("ts", "yyyy-MM-dd").alias("run"), F.col("ts"))


_RES = """(select 'h' || user_id as host, (['W1','W2','W4','M1','R1','F1','F3','I1'])[event_id % 8 + 1] as test, case event_id % 3 when 0 then 'all_ai' when 1 then 'gptbot' else 'research' end as identity,
(['pass','partial','fail','blocked','na'])[cast(floor(value * 7) % 5 + 1 as int)] as verdict, cast(event_id % 5 * 100 as int) as status, event_id as seq, strftime(ts, '%Y-%m-%d') as run, ts from events)"""


def result_first_wins(spark, d):
    return scoring.first_rows(_results(spark, d).select("host", "test", "identity", "verdict", "seq"), ["host", "test", "identity"], "seq")


def result_last_wins(spark, d):
    return scoring.first_rows(_results(spark, d).select("host", "test", "identity", "verdict", "seq"), ["host", "test", "identity"], "seq", last=True)


def ai_aggregate(spark, d):
    rows = _results(spark, d).withColumn("identity_class", F.when(F.col("identity") == "gptbot", "ai_training").when(F.col("identity") == "all_ai", "ai_search").otherwise("control"))
    return verdicts.all_ai(rows, ["host", "test"]).select("host", "test", "verdict", F.array_join("admitted", ",").alias("admitted"))


def verdict_counts(spark, d):
    return scoring.verdict_counts(_results(spark, d)).select(F.coalesce("test", _L("all")).alias("test"), "is_total", F.col("pass").alias("n_pass"), "partial", "fail", "blocked", "na", "reported")


def host_scores(spark, d):
    return scoring.scores(scoring.host_verdicts(_results(spark, d))).select("host", "f1f3", "score", F.col("measured_rows").cast("bigint").alias("measured_rows"), F.col("blocked_rows").cast("bigint").alias("blocked_rows"), F.col("na_rows").cast("bigint").alias("na_rows"))


def score_summary(spark, d):
    return scoring.score_summary(scoring.scores(scoring.host_verdicts(_results(spark, d))))


def wide_pivot(spark, d):
    targets = table(spark, d, "customer").select(F.concat(_L("h"), F.col("c_custkey")).alias("host"), F.col("c_name").alias("name"))
    r = scoring.wide_export(targets, _results(spark, d), ["research", "gptbot"])
    j = lambda c: F.coalesce(F.col(c).cast("string"), _L(""))
    return r.select("host", "name", *(j(c).alias(c) for c in ("w1", "w2", "m1", "w4_research", "w4_gptbot", "status_gptbot")))


def run_flips(spark, d):
    last = scoring.first_rows(_results(spark, d).select("host", "test", "run", "verdict", "seq"), ["host", "test", "run"], "seq", last=True)
    return scoring.flips(last, ["host", "test"], "run").select("host", "test", "run", "before", "verdict", F.col("confirmed").cast("int").alias("confirmed"))


def vantage_parity(spark, d):
    rows = scoring.first_rows(_results(spark, d).select("host", "test", "identity", "verdict", "seq"), ["host", "test", "identity"], "seq")
    return scoring.parity(rows, ["host", "test"], "identity", "research", "gptbot")


def retest_compare(spark, d):
    r = scoring.first_rows(_results(spark, d).select("host", "test", "identity", "verdict", "seq"), ["host", "test", "identity"], "seq")
    a, b = r.where("identity = 'research'").select("host", "test", "verdict"), r.where("identity = 'all_ai'").select("host", "test", "verdict")
    return scoring.retest(a, b, ["host", "test"]).select("host", "test", "verdict", F.coalesce("again", _L("")).alias("again"), F.coalesce(F.col("same").cast("int"), _L(-1)).alias("same"))


def _log(spark, d):
    r = _results(spark, d)
    return r.select("host", "run", "seq", "ts", "verdict")


def failure_streak(spark, d):
    s = runlog.failure_streaks(_log(spark, d), "run", "seq", "host", F.col("verdict").isin("blocked", "na", "fail"), 4, 3)
    return s.select("seq", F.col("streak").cast("bigint").alias("streak"), F.col("streak_hosts").cast("bigint").alias("streak_hosts"), F.col("suspect").cast("int").alias("suspect"))


def host_pacing(spark, d):
    p = runlog.pacing(_log(spark, d), "host", "ts", 3600.0)
    return p.groupBy("host").agg(F.count("*").alias("n"), F.count_if("too_soon").alias("too_soon"))


def quarantine_after_first(spark, d):
    return runlog.quarantined(_log(spark, d), "host", "seq", F.col("verdict") == "na").select("host", "seq", F.col("quarantined").cast("int").alias("quarantined"))


def streaming_quarantine(spark, d):
    """The same by Structured Streaming with state per host, over the log as a stream of files."""
    src = written(_log(spark, d).select("host", "seq", (F.col("verdict") == "na").alias("pushback")).repartitionByRange("seq"), "log")
    path = src.inputFiles()[0].rsplit("/", 1)[0]
    out = state.run_to_end(state.quarantine_stream(state.read_stream(spark, path, src.schema)))
    return out.select("host", "seq", F.col("quarantined").cast("int").alias("quarantined"))


def streaming_streak(spark, d):
    src = written(_log(spark, d).select("run", "seq", "host", F.col("verdict").isin("blocked", "na", "fail").alias("failed")).repartitionByRange("seq"), "log")
    path = src.inputFiles()[0].rsplit("/", 1)[0]
    out = state.run_to_end(state.streak_stream(state.read_stream(spark, path, src.schema), 4, 3))
    return out.select("seq", F.col("streak").cast("bigint").alias("streak"), F.col("hosts").cast("bigint").alias("streak_hosts"), F.col("suspect").cast("int").alias("suspect"))


def breaker_refusals(spark, d):
    b = runlog.breakers(_log(spark, d), "host", "seq", F.col("verdict") == "blocked", F.col("verdict") == "pass", 3)
    return b.select("seq", F.col("refusals").cast("bigint").alias("refusals"), F.col("tripped").cast("int").alias("tripped"))


def interleave_round_robin(spark, d):
    return runlog.interleave(_log(spark, d), "host", F.col("seq")).select("seq", F.col("turn").cast("bigint").alias("turn"), "host_key")


def _jobs(spark, d):
    return table(spark, d, "state_listing").where("url is not null").groupBy("entry_no").agg(F.max_by("url", F.struct("snapshot_date", "loaded_at", "url")).alias("url"), F.max_by("agency", F.struct("snapshot_date", "loaded_at", "agency")).alias("agency"))


def run_estimate(spark, d):
    jobs = _jobs(spark, d)
    e = runlog.run_estimate(jobs, "agency", "entry_no", "full", 6, F.col("url").contains("portal."), 2)
    return e.select("hosts", F.col("requests_min").cast("bigint").alias("requests_min"), F.col("requests_max").cast("bigint").alias("requests_max"), "hours_min", "hours_max", "busiest")


def page_estimate(spark, d):
    return runlog.page_estimate(_jobs(spark, d), "agency", "url", "entry_no", 6)


def busiest_hosts(spark, d):
    """A top-k report: the 15 hosts with most requests."""
    return _results(spark, d).groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(15)


def resume_pending(spark, d):
    r = _results(spark, d)
    done = r.where("test = 'I1' and verdict = 'pass'").select("host", "run")
    return runlog.pending(r.select("host", "run").distinct(), done, ["host", "run"])


def resume_finished_rows(spark, d):
    r = _results(spark, d)
    return runlog.finished_rows(r.select("host", "run", "seq"), r.where("test = 'I1' and verdict = 'pass'"), ["host", "run"])


def request_cap(spark, d):
    return runlog.within_cap(_log(spark, d).select("run", "seq"), "run", "seq", 100)


def plan_requests(spark, d):
    h = table(spark, d, "registry").select(F.explode("web_properties").alias("w")).select(F.lower(F.trim("w.domain")).alias("host")).distinct()
    p = runlog.plan_requests(h, "core", ["research", "googlebot", "gptbot"])
    return p.select("host", "step", "kind", "identity", "url")


def evidence_json(spark, d):
    return table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), _L(-1)).alias("k"))


def evidence_sha256(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", _L("")), 256).alias("sha"))


def truncate_flag(spark, d):
    t = text.truncated(F.col("text"), 800)
    return table(spark, d, "documents").select("doc_id", F.sha2(t["text"], 256).alias("sha"), t["truncated"].cast("int").alias("truncated"))


def word_counts(spark, d):
    """Words with a letter, ASCII form so that SQL can follow; the Unicode form is text.count_words()."""
    n = F.size(F.regexp_extract_all("text", _L(r"[A-Za-z0-9_]*[A-Za-z][A-Za-z0-9_]*"), 0))
    return table(spark, d, "documents").where("text is not null").select("doc_id", n.cast("bigint").alias("words"))


def llms_shape(spark, d):
    s = text.llms_shape(F.regexp_replace("text", r"\r", ""))
    return table(spark, d, "documents").select("doc_id", s["h1"].cast("int").alias("h1"), s["summary_blockquote"].cast("int").alias("quote"))


def block_page_class(spark, d):
    c = verdicts.classify_body(F.col("description"), verdicts.BLOCK_PATTERNS)
    return table(spark, d, "descriptions").where("description is not null").select("desc_id", c["body_class"].alias("body_class"), c["is_block_page"].cast("int").alias("blocked"))


def prose_lines(spark, d):
    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", r"\n")).alias("line")).withColumn("line", F.trim(F.regexp_replace("line", r"\r", "")))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(text.is_prose_start(F.col("line"))).alias("prose"))


def extracted_prose(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", text.extract_prose(F.col("text")).alias("prose"))


def page_structs(spark, d):
    """Documents read as pages: title, links, words in view."""
    p = table(spark, d, "documents").select("doc_id", web.parse_page("text").alias("p"))
    return p.select("doc_id", "p.lang", "p.title", "p.headings", F.size("p.links").alias("links"), text.count_words(F.col("p.text_all")).alias("words"))


def main_texts(spark, d):
    return table(spark, d, "documents").select("doc_id", web.main_text("text").alias("main"))


_ROBOTS = (
    ("a", "User-agent: GPTBot\nUser-agent: CCBot\nDisallow: /private\nAllow: /private/open\n\nUser-agent: *\nDisallow: /*.pdf$\nSitemap: https://a.example/s.xml"),
    ("b", "User-agent: *\nDisallow: /\n# all closed\nUser-agent: gptbot\nAllow: /"),
    ("c", ""),
    ("d", "User-agent: GPTBot\nDisallow:\nContent-Signal: search=yes, ai-train=no\nUser-agent: GPTBot\nDisallow: /x"),
)


def robots_decisions(spark, d):
    """Stated decisions for two tokens at four paths of four files; the expected rows are in SQL as a table."""
    files = spark.createDataFrame(_ROBOTS, "file string, body string").select("file", web.parse_robots("body").alias("r"))
    asks = F.array(*(F.struct(_L(t).alias("token"), _L(p).alias("path")) for t in ("GPTBot", "Other") for p in ("/", "/private/x", "/private/open/y", "/f.pdf")))
    return files.select("file", "r", F.explode(asks).alias("a")).select("file", "a.token", "a.path", web.robots_decision(F.col("r"), F.col("a.token"), F.col("a.path"))["decision"].alias("decision"))


def lastmod_stats(spark, d):
    """Order dates of a customer as a sitemap's dates."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("l"))
    maps = o.select("o_custkey", F.struct(_L("urlset").alias("kind"), F.size("l").alias("count"), F.col("l").alias("lastmods"), _L(False).alias("gzip"), _L(None).cast("string").alias("error")).alias("m"), F.struct(_L(200).alias("status"), _L(False).alias("is_block_page")).alias("r"))
    ev = verdicts.m3(F.col("r"), F.col("m"), F.to_date(_L("2024-01-01")))["evidence"]
    g = lambda k: F.get_json_object(ev, f"$.{k}")
    return maps.select("o_custkey", g("with_lastmod").cast("bigint").alias("n"), g("newest").alias("newest"), g("median").alias("median"))


def event_windows(spark, d):
    w = state.tumbling(table(spark, d, "events"), "ts", "6 hours", ["event_type"], "value")
    return w.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def event_sessions(spark, d):
    s = state.sessions(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "12 hours", ["user_id"])
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").where(F.col("l_shipdate") <= _L("1998-09-02").cast("date"))
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


def revenue_cube(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.cube("l_returnflag", "o_orderpriority").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n")).select(F.coalesce("l_returnflag", _L("all")).alias("flag"), F.coalesce("o_orderpriority", _L("all")).alias("priority"), "revenue", "n")


def top_orders_per_customer(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("k", F.row_number().over(w)).where("k <= 3").select("o_custkey", "o_orderkey", F.col("k").cast("bigint").alias("k"))


def nation_revenue(spark, d):
    li, o, c, n = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def customers_without_orders(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("custkey")).join(table(spark, d, "orders").select(F.col("o_custkey").alias("custkey")), "custkey", "left_anti")


def set_operations(spark, d):
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))
    return c.intersect(s).withColumn("side", _L("both")).unionByName(c.exceptAll(s).distinct().withColumn("side", _L("left")))


def fuzzy_review(spark, d):
    g = table(spark, d, "greenbook_enrichment").select(F.col("enrichment_id").alias("row_id"), F.col("matched_from.agency_name").alias("name")).where("name is not null").distinct()
    return resolve.fuzzy_review(g, table(spark, d, "registry").select(F.col("id").alias("entity_id"), "name"))


QUERIES = {
    f.__name__: f
    for f in (
        result_first_wins, result_last_wins, ai_aggregate, verdict_counts, host_scores, score_summary, wide_pivot, run_flips, vantage_parity, retest_compare, failure_streak, host_pacing,
        quarantine_after_first, streaming_quarantine, streaming_streak, breaker_refusals, interleave_round_robin, run_estimate, page_estimate, busiest_hosts, resume_pending,
        resume_finished_rows, request_cap, plan_requests, evidence_json, evidence_sha256, truncate_flag, word_counts, llms_shape, block_page_class, prose_lines, extracted_prose,
        page_structs, main_texts, robots_decisions, lastmod_stats, event_windows, event_sessions, pricing_summary, revenue_cube, top_orders_per_customer, nation_revenue,
        customers_without_orders, set_operations, fuzzy_review,
    )
}

_WS = r"[\s\v\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_FIRST = "(select host, test, identity, arg_min(verdict, seq) as verdict, min(seq) as seq from " + _RES + " group by all)"
_WIDE = f"""(select host, {', '.join(f"arg_min(verdict, seq) filter (test = '{t}' and (test not in ('W4', 'D7') or identity = 'all_ai')) as {t.lower()}" for t in ('W1', 'W2', 'W4', 'M1', 'R1', 'I1', 'F1', 'F3'))} from {_RES} where test not in ('W4', 'D7') or identity = 'all_ai' group by host)"""
_F1F3 = "case when f3 is null then coalesce(f1, 'na') when f1 = 'pass' and f3 = 'pass' then 'pass' when 'blocked' in (coalesce(f1, ''), f3) then 'blocked' when 'fail' in (coalesce(f1, ''), f3) then 'fail' when 'pass' in (coalesce(f1, ''), f3) then 'partial' else 'na' end"
_SCORED = ("w1", "w2", "w4", "m1", "r1", "i1", "f1f3")
_SCORES = f"""(select host, f1f3, {' + '.join(f"(case {c} when 'pass' then 1.0 when 'partial' then 0.5 else 0.0 end)" for c in _SCORED)} as score,
{' + '.join(f"cast(coalesce({c} in ('pass', 'partial', 'fail'), false) as int)" for c in _SCORED)} as measured_rows, {' + '.join(f"cast(coalesce({c} = 'blocked', false) as int)" for c in _SCORED)} as blocked_rows,
5 + {' + '.join(f"cast(coalesce({c}, 'na') = 'na' as int)" for c in _SCORED)} as na_rows from (select *, {_F1F3} as f1f3 from {_WIDE}))"""
_JOBS = "(select entry_no, arg_max(url, (snapshot_date, loaded_at, url)) as url, arg_max(agency, (snapshot_date, loaded_at, agency)) as agency from state_listing where url is not null group by entry_no)"
_STREAK = f"""with l as (select *, verdict in ('blocked', 'na', 'fail') as f from {_RES}), i as (select *, sum(cast(not f as int)) over (partition by run order by seq) as g from l),
n as (select *, cast(f and row_number() over (partition by run, g, host, f order by seq) = 1 as int) as fresh from i),
s as (select seq, cast(sum(cast(f as int)) over w as bigint) as streak, cast(sum(fresh) over w as bigint) as streak_hosts from n window w as (partition by run, g order by seq))
select seq, streak, streak_hosts, cast(streak >= 4 and streak_hosts >= 3 as int) as suspect from s"""
_QUAR = f"with f as (select host, min(seq) filter (verdict = 'na') as m from {_RES} group by host) select r.host, seq, cast(coalesce(seq > m, false) as int) as quarantined from {_RES} r join f using (host)"
ORACLE = {
    "result_first_wins": f"select * from {_FIRST}",
    "result_last_wins": f"select host, test, identity, arg_max(verdict, seq) as verdict, max(seq) as seq from {_RES} group by all",
    "ai_aggregate": f"""with a as (select host, test, count(*) filter (identity <> 'research') as n, count(*) filter (identity <> 'research' and verdict = 'pass') as ok, count(*) filter (identity <> 'research' and verdict = 'blocked') as bl, count(*) filter (identity <> 'research' and verdict = 'na') as na,
coalesce(string_agg(distinct identity, ',' order by identity) filter (identity <> 'research' and verdict = 'pass'), '') as admitted from {_RES} group by host, test)
select host, test, case when n = 0 then 'na' when ok = n then 'pass' when ok > 0 then 'partial' when bl > 0 then 'blocked' when na = n then 'na' else 'fail' end as verdict, admitted from a""",
    "verdict_counts": f"select coalesce(test, 'all') as test, cast(grouping(test) as int) as is_total, count(*) filter (verdict = 'pass') as n_pass, count(*) filter (verdict = 'partial') as partial, count(*) filter (verdict = 'fail') as fail, count(*) filter (verdict = 'blocked') as blocked, count(*) filter (verdict = 'na') as na, count(*) filter (verdict = 'reported') as reported from {_RES} group by rollup (test)",
    "host_scores": f"select host, f1f3, cast(score as double) as score, cast(measured_rows as bigint) as measured_rows, cast(blocked_rows as bigint) as blocked_rows, cast(na_rows as bigint) as na_rows from {_SCORES}",
    "score_summary": f"select count(*) as hosts, round_even(avg(score), 2) as mean, cast(median(score) as double) as median, cast(min(score) as double) as least, cast(max(score) as double) as most from {_SCORES}",
    "wide_pivot": f"""with p as (select host, arg_min(verdict, seq) filter (test = 'W1') as w1, arg_min(verdict, seq) filter (test = 'W2') as w2, arg_min(verdict, seq) filter (test = 'M1') as m1, arg_min(verdict, seq) filter (test = 'W4' and identity = 'research') as a, arg_min(verdict, seq) filter (test = 'W4' and identity = 'gptbot') as b, arg_min(status, seq) filter (test = 'W4' and identity = 'gptbot') as s from {_RES} group by host)
select 'h' || c_custkey as host, c_name as name, coalesce(w1, '') as w1, coalesce(w2, '') as w2, coalesce(m1, '') as m1, coalesce(a, '') as w4_research, coalesce(b, '') as w4_gptbot, coalesce(cast(s as varchar), '') as status_gptbot from customer left join p on p.host = 'h' || c_custkey""",
    "run_flips": f"with l as (select host, test, run, arg_max(verdict, seq) as verdict from {_RES} group by all), w as (select *, lag(verdict) over (partition by host, test order by run) as before, lead(verdict) over (partition by host, test order by run) as aft from l) select host, test, run, before, verdict, cast(coalesce(aft = verdict, false) as int) as confirmed from w where before is not null and before <> verdict",
    "vantage_parity": f"with p as (select host, test, max(verdict) filter (identity = 'research') as \"left\", max(verdict) filter (identity = 'gptbot') as \"right\" from {_FIRST} group by all) select * from p where \"left\" is not null and \"right\" is not null and \"left\" <> \"right\"",
    "retest_compare": f"select a.host, a.test, a.verdict, coalesce(b.verdict, '') as again, coalesce(cast(a.verdict = b.verdict as int), -1) as same from {_FIRST} a left join (select * from {_FIRST} where identity = 'all_ai') b on a.host = b.host and a.test = b.test where a.identity = 'research'",
    "failure_streak": _STREAK,
    "streaming_streak": f"select seq, streak, least(streak_hosts, 3) as streak_hosts, suspect from ({_STREAK})",
    "host_pacing": f"with g as (select host, epoch_us(ts) - lag(epoch_us(ts)) over (partition by host order by ts) as gap from {_RES}) select host, count(*) as n, count(*) filter (gap < 3600000000) as too_soon from g group by host",
    "quarantine_after_first": _QUAR,
    "streaming_quarantine": _QUAR,
    "breaker_refusals": f"with i as (select *, sum(cast(verdict = 'pass' as int)) over (partition by host order by seq) as g from {_RES}), r as (select seq, cast(sum(cast(verdict = 'blocked' as int)) over (partition by host, g order by seq) as bigint) as refusals from i) select seq, refusals, cast(refusals >= 3 as int) as tripped from r",
    "interleave_round_robin": f"select seq, row_number() over (partition by host order by seq) as turn, host as host_key from {_RES}",
    "run_estimate": f"""with e as (select agency, entry_no, 15 as lo, 36 + case when contains(url, 'portal.') then 8 else 0 end as hi from {_JOBS}),
s as (select count(*) as hosts, cast(sum(lo) as bigint) as requests_min, cast(sum(hi) as bigint) as requests_max, arg_min(agency, (-hi, entry_no)) as busiest, max(hi) as b from e)
select hosts, requests_min, requests_max, round_even(greatest(requests_min * 7.0 / 2, 14 * 30.0) / 3600, 1) as hours_min, round_even(greatest(requests_max * 7.0 / 2, (b - 1) * 30.0) / 3600, 1) as hours_max, busiest from s""",
    "page_estimate": f"""with j as {_JOBS}, r as (select agency, count(*) as r from (select url, arg_min(agency, entry_no) as agency from j group by url) group by agency),
p as (select agency, count(*) as pages, count(*) * 6 as n, min(entry_no) as m from j group by agency), a as (select p.*, coalesce(r, 0) as r, n + coalesce(r, 0) as t from p left join r using (agency))
select cast(sum(pages) as bigint) as pages, count(*) as hosts, cast(sum(r) as bigint) as robots, cast(sum(t) as bigint) as requests, arg_min(agency, (-t, m)) as busiest, round_even((max(t) - 1) * 30.0 / 3600, 1) as min_hours from a""",
    "busiest_hosts": f"select host, count(*) as n from {_RES} group by host order by n desc, host limit 15",
    "resume_pending": f"select distinct host, run from {_RES} where (host, run) not in (select host, run from {_RES} where test = 'I1' and verdict = 'pass')",
    "resume_finished_rows": f"select host, run, seq from {_RES} where (host, run) in (select host, run from {_RES} where test = 'I1' and verdict = 'pass')",
    "request_cap": f"select run, seq from {_RES} qualify row_number() over (partition by run order by seq) <= 100",
    "plan_requests": """with h as (select distinct lower(trim(w.domain)) as host from (select unnest(web_properties) as w from registry)), s as (select * from (values (1, 'robots', 'research', '/robots.txt'), (2, 'llms', 'research', '/llms.txt'), (3, 'sitemap', 'research', '/sitemap.xml'), (4, 'home', 'research', '/'), (5, 'home', 'googlebot', '/'), (6, 'home', 'gptbot', '/'), (7, 'notfound', 'research', '/not-here-'), (8, 'http', 'research', '/')) v(step, kind, identity, p))
select host, step, kind, identity, case when kind = 'http' then 'http://' else 'https://' end || host || p || case when kind = 'notfound' then left(sha256(host), 12) else '' end as url from h cross join s""",
    "evidence_json": "select event_id, coalesce(cast(json_extract_string(props, '$.k') as bigint), -1) as k from events",
    "evidence_sha256": "select doc_id, sha256(coalesce(text, '')) as sha from documents",
    "truncate_flag": f"select doc_id, sha256(case when length(t) > 800 then regexp_replace(left(t, 800), '{_WS}+$', '') else t end) as sha, cast(length(t) > 800 as int) as truncated from (select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '^{_WS}+', ''), '{_WS}+$', '') as t from documents)",
    "word_counts": "select doc_id, len(regexp_extract_all(text, '[A-Za-z0-9_]*[A-Za-z][A-Za-z0-9_]*')) as words from documents where text is not null",
    "llms_shape": "with l as (select doc_id, list_filter(string_split(coalesce(replace(text, chr(13), ''), ''), chr(10)), lambda x: trim(x) <> '') as l from documents) select doc_id, cast(coalesce(starts_with(l[1], '# '), false) as int) as h1, cast(coalesce(starts_with(l[1], '# ') and starts_with(l[2], '> '), false) as int) as quote from l",
    "block_page_class": "with b as (select desc_id, description, lower(left(description, 6000)) as low from descriptions where description is not null), c as (select *, " + "case " + "when contains(low, 'access denied') then 'access_denied' when regexp_matches(low, 'you don''?t have permission to access') then 'akamai_denied' when regexp_matches(low, 'reference\\s*#[0-9]+[.]') then 'akamai_reference' when contains(low, 'errors.edgesuite.net') then 'akamai_edgesuite' when regexp_matches(low, '(?-s)attention required.*cloudflare') or contains(low, 'cf-browser-verification') or contains(low, 'cf_chl_') then 'cloudflare_challenge' when contains(low, 'incapsula incident id') or contains(low, '_incapsula_resource') or regexp_matches(low, '(?-s)request unsuccessful.*incapsula') then 'imperva_incapsula' when regexp_matches(low, '<title>\\s*just a moment') then 'cloudflare_jschallenge' when contains(low, 'bot detection') or contains(low, 'are you a robot') or contains(low, 'verify you are human') then 'generic_bot_challenge' when contains(low, 'your request has been blocked') then 'generic_blocked'" + " end as name from b) select desc_id, coalesce(name, case when length(trim(description)) < 200 then 'near_empty' else 'content' end) as body_class, cast(name is not null as int) as blocked from c",
    "prose_lines": "with l as (select doc_id, trim(replace(unnest(string_split(text, chr(10))), chr(13), '')) as line from documents where text is not null) select doc_id, count(*) as lines, count(*) filter (length(line) >= 80 or (len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')) >= 12 and regexp_matches(rtrim(line), '[.!?]$'))) as prose from l group by doc_id",
    "robots_decisions": "select * from (values "
    + ", ".join(
        f"('{f}', '{t}', '{p}', '{v}')"
        for f, t, vs in (
            ("a", "GPTBot", "allow disallow allow allow"), ("a", "Other", "allow allow allow disallow"), ("b", "GPTBot", "allow allow allow allow"), ("b", "Other", "disallow disallow disallow disallow"),
            ("c", "GPTBot", "allow allow allow allow"), ("c", "Other", "allow allow allow allow"), ("d", "GPTBot", "allow allow allow allow"), ("d", "Other", "allow allow allow allow"),
        )
        for p, v in zip(("/", "/private/x", "/private/open/y", "/f.pdf"), vs.split())
    )
    + ") v(file, token, path, decision)",
    "lastmod_stats": "select o_custkey, count(*) as n, strftime(max(o_orderdate), '%Y-%m-%d') as newest, strftime(cast(quantile_disc(cast(o_orderdate as date), 0.5) as date), '%Y-%m-%d') as median from orders group by o_custkey",
    "event_windows": "select strftime(time_bucket(interval '6 hours', ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M') as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "event_sessions": "with g as (select user_id, case when ts - lag(ts) over (partition by user_id order by ts) < interval '12 hours' then 0 else 1 end as f from events) select user_id, cast(sum(f) as bigint) as sessions, count(*) as events from g group by user_id",
    "pricing_summary": "select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem where l_shipdate <= date '1998-09-02' group by all",
    "revenue_cube": "select coalesce(l_returnflag, 'all') as flag, coalesce(o_orderpriority, 'all') as priority, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, count(*) as n from lineitem join orders on l_orderkey = o_orderkey group by cube (l_returnflag, o_orderpriority)",
    "top_orders_per_customer": "select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as k from orders qualify k <= 3",
    "nation_revenue": "select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1",
    "customers_without_orders": "select c_custkey as custkey from customer where c_custkey not in (select o_custkey from orders)",
    "set_operations": "select distinct c_nationkey as nation, 'both' as side from customer where c_nationkey in (select s_nationkey from supplier) union all select distinct nation, 'left' from (select c_nationkey as nation from customer except all select s_nationkey from supplier)",
}
