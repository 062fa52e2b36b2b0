import pytest
from pyspark.sql import functions as F

from plumbline.llm import lexicon, names
from plumbline.session import table, written

REG = [("foo-hd", "Foobarville Housing Authority"), ("foo-pd", "Foobarville Parking Authority"), ("nfoo-hd", "North Foobarville Housing Authority"), ("bar-hd", "Quuxholm Housing Authority"), ("t", "Town of Foobarville"), ("w1", "Quuxholm Water District No. 1"), ("w2", "Quuxholm Water District No. 2"), ("prd", "Quuxholm Parks and Recreation Department"), ("twin1", "Twinham Public Library"), ("twin2", "Twinham Public Library"), ("court", "Saratoga Springs City Court"), ("kirov", "Библиотека Кирова"), ("long", "Regional Board for the Care of Old Mill Race Canals and Weirs"), (None, "X"), ("bad", None)]
SHORT = {"long": "VIDA", "foo-hd": "FHA", "bar-hd": "QHA", "w1": "QWD", "w2": "QWD", "t": " "}
CASES = {
    "FOOBARVILLE HOUSING AUTHORITY": "foo-hd", "Housing Auth., Foobarville": "foo-hd", "Fobarville Housing Authority": "foo-hd", "N. Foobarville HA": "nfoo-hd", "Foobarville PA": "foo-pd",
    "Quuxholm Wtr Dist #2": "w2", "Water District I of Quuxholm": "w1", "Dept of Parks & Rec, Quuxholm": "prd", "Foobar Housing Authority": "foo-hd", "Foobarville (Town)": "t", "T/O Foobarville": "t",
    "Court of the City of Saratoga Spring": "court", "SaratogaSprings City Court": "court", "Библиотека кирова": "kirov", "VIDA": "long", "FHA": "foo-hd", "Bd. for Care of Old Mill Race Canals & Weirs, Regional": "long",
    "Quuxholm Water District No. 3": None, "Zzzville Housing Authority": None, "South Foobarville Housing Authority": None, "Foobarville Public Library": None, "Twinham Public Library": None, "QWD": None, "": None, "  ": None,
}


def link(spark, var, known, reg, **more):
    out = names.link_variants(var, known, reg, "row", "typed", "meant", "id", ["name", "short"], **more)
    return {r.enrichment_id: r.entity_id for r in out.collect()}


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame([(i, n, SHORT.get(i)) for i, n in REG], "id string, name string, short string").withColumn("head", F.lit(1)).withColumn("w", F.lit(1))


def test_cases(spark, registry):
    rows = list(enumerate(CASES)) + [(900, None), (0, next(iter(CASES)))]
    var = spark.createDataFrame(rows, "row long, typed string").withColumn("kind", F.lit("x")).withColumn("words", F.lit(1))
    known = spark.createDataFrame([("Foobarville Housing Authority", "FOO-HD "), ("x", "gone"), (None, None)], "typed string, meant string")
    assert link(spark, var, known, registry) == {i: CASES[t] for i, t in rows[:-2] if CASES[t]}
    for v, k, r in ((var.limit(0), known, registry), (var, known, registry.limit(0)), (var, known.limit(0), registry)):
        assert len(link(spark, v, k, r)) in (0, sum(v is not None for v in CASES.values()))


def test_prior_and_channel_decide(spark, registry):
    """How often a record is meant decides between equal likelihoods; without the prior there is no link. Rates of words
    that are left out are learned from known rows."""
    reg = registry.unionByName(spark.createDataFrame([("n1", "North Barholm Library", None), ("n2", "New Barholm Library", None)], "id string, name string, short string").withColumn("head", F.lit(1)).withColumn("w", F.lit(1)))
    var = spark.createDataFrame([(1, "N Barholm Library")], "row long, typed string")
    known = spark.createDataFrame([("North Barholm Library", "n1")] * 9, "typed string, meant string")
    assert link(spark, var, known, reg) == {1: "n1"}
    assert link(spark, var, known, reg, use_prior=False) == {}
    var = spark.createDataFrame([(1, "Quuxholm Parks and Recreation")], "row long, typed string")
    assert link(spark, var, known, reg) == {}
    seen = [(f"Place{i} Parks and Recreation", f"p{i}") for i in range(9)]
    more = reg.unionByName(spark.createDataFrame([(f"p{i}", f"Place{i} Parks and Recreation Department", None, 1, 1) for i in range(9)], reg.schema))
    assert link(spark, var, spark.createDataFrame(seen, "typed string, meant string"), more) == {1: "prd"}


def test_frequent_spelling_is_canonical(spark, registry):
    """A spelling typed often for a known record leads its own variants to that record."""
    var = spark.createDataFrame([(1, "Millrace Keeperss")], "row long, typed string")
    known = spark.createDataFrame([("Millrace Keepers", "long")] * 3, "typed string, meant string")
    assert link(spark, var, known, registry) == {1: "long"}
    assert link(spark, var, known.limit(1), registry) == {}


def test_channel():
    assert lexicon.channel("dept", "department") > lexicon.channel("deprtmnet", "department") > -20
    assert lexicon.channel("wtr", "water") > -3 and lexicon.channel("x", "water") < -50
    assert lexicon.one_edit("abcd", "abdc") and lexicon.one_edit("abc", "abcd") and not lexicon.one_edit("abc", "abed1")
    assert lexicon.distance("kitten", "sitting") == 3 and lexicon.distance("ab", "ba") == 1
    for a, b in (("statecliff", "sttaecliff"), ("librarry", "library"), ("agnecy", "agency"), ("foobar", "foobarville"), ("abcdefgh", "abdcegfh")):
        assert lexicon.channel(a, b) > -6 and set(lexicon.typed_marks(a)) & set(lexicon.word_marks(b))


def test_held_out_rows(spark, data):
    """Rows whose record is known: their names alone must lead back to it."""
    big = data.replace("sf0.001", "sf0.01")
    g = table(spark, big, "greenbook_enrichment").select(F.col("enrichment_id").alias("row"), F.col("entity_id").alias("meant"), F.col("matched_from.agency_name").alias("typed")).where("meant is not null")
    reg = table(spark, big, "registry").withColumn("short", F.col("short_name"))
    half = F.pmod(F.xxhash64("row"), F.lit(2)) == 0
    got = link(spark, g.where(half), g.where(~half), reg)
    truth = {r.row: r.t for r in g.where(half).select("row", F.lower(F.trim("meant")).alias("t")).distinct().join(reg.select(F.col("id").alias("t")), "t").collect()}
    assert sum(got.get(k) == t for k, t in truth.items()) >= 0.95 * len(truth)
    assert sum(k in got and got[k] != t for k, t in truth.items()) <= 0.01 * len(truth)


@pytest.mark.parametrize("name", ["", "...", "123", "(x)", "a" * 10000, "И" * 300])
def test_odd_names(name):
    words = lexicon.read(name)
    lexicon.Channel().score(lexicon.content(name), words)
    lexicon.Common(["housing", "authority"], ["housing authority"]).stands_for(words[0] if words else "")


def test_nothing_that_grows_goes_to_the_driver(spark, registry, monkeypatch):
    plans = {}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for m in (lexicon, names):
        monkeypatch.setattr(m, "written", lambda df, name: plans.update({name: plan(df)}) or written(df, name))
    rows = spark.createDataFrame([(1, "Fobarville Housing Authority", "foo-hd")], "row long, typed string, meant string")
    plans["result"] = plan(names.link_variants(rows, rows, registry, "row", "typed", "meant", "id", ["name", "short"]))
    assert [n for n, p in plans.items() if "Broadcast" in p] == []
    assert "TakeOrderedAndProject" in plans["labelled"]
