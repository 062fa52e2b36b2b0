import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import crossmatch, lexicon, names
from plumbline.session import table, written

G = "enrichment_id long, entity_id string, agency_name string, confidence_score double, contact_details array<struct<type:string,value:string,note:string>>, web_candidates array<string>"
C = "contact_id long, agency string, agency_contact_url string, phone string, address_line_1 string, city string, zip string"
REG = [(f"{p}-{k}", f"{p.title()} {n}") for p in ("foobarville", "quuxholm", "zedfordham") for k, n in (("ha", "Housing Authority"), ("pl", "Public Library"), ("w1", "Water District No. 1"), ("w2", "Water District No. 2"))]


def addr(street, city):
    return [("address", f"{street}, {city}, NY 12345", None), ("voice", "(100) 555-0199", None)]


def run(spark, g, c, reg=REG, **off):
    g = spark.createDataFrame([(*r[:3], None, *r[3:]) for r in g], G).withColumn("q", F.lit(1))
    out = crossmatch.match_offices(g, spark.createDataFrame(c, C).withColumn("words", F.lit(1)), spark.createDataFrame(reg, "id string, name string"), **off)
    return sorted((r.enrichment_id, r.contact_id) for r in out.collect())


def test_pairs(spark):
    g = [
        (1, "foobarville-ha", "Foobarville Housing Authority", addr("1 Main St", "Foobarville"), ["https://www.foo-ha.example/"]),
        (2, None, "Housing Auth., Foobarville", None, []),
        (3, None, "Quuxholm Water Dist. #2", addr("2 Elm Ave", "Quuxholm"), None),
        (4, None, "Zedfordham Public Library", None, ["zed-lib.example"]),
        (5, None, None, None, None),
        (1, "foobarville-ha", "Foobarville Housing Authority", addr("1 Main St", "Foobarville"), ["https://www.foo-ha.example/"]),
        (6, None, "Quuxholm Water District No. 1", addr("2 Elm Ave", "Quuxholm"), None),
    ]
    c = [
        (11, "Housing Authority", "http://foo-ha.example/contact", None, None, "Foobarville", None),
        (12, "FOOBARVILLE HOUSING AUTHORITY", "n/a", "100 555 0199", "1 Main Street", None, "12345"),
        (13, "Water District II", None, "1005550199", "2 Elm Avenue", "QUUXHOLM", None),
        (14, "Quuxholm Housing Authority", None, "1005550199", None, "Quuxholm", "12345"),
        (15, None, "", "", "", "", ""),
        (16, "Zedfordham Public Libary", None, None, None, None, None),
    ]
    want = [(1, 11), (1, 12), (2, 11), (2, 12), (3, 13), (4, 16)]
    assert run(spark, g, c + c[:1]) == want
    assert run(spark, g, c, []) is not None
    assert run(spark, [], c) == [] and run(spark, g, []) == []


def test_hot_organisation(spark):
    """Rows of an organisation that holds a third of all rows and says only its name are matched, however many there are."""
    places = [f"{a}{b}" for a in ("alder", "birch", "cedar", "maple") for b in ("ford", "holm", "wick", "mont", "stead")]
    reg = REG + [(f"{p}-pl", f"{p.title()} Public Library") for p in places]
    g = [(i, None, "Foobarville Housing Authority", None, None) for i in range(10)] + [(100 + i, None, f"{p.title()} Public Library", None, None) for i, p in enumerate(places)]
    c = [(i, "Foobarville Housing Authority", None, None, None, None, None) for i in range(10)] + [(100 + i, f"{p.title()} Public Library", None, None, None, None, None) for i, p in enumerate(places)]
    want = [(i, j) for i in range(10) for j in range(10)] + [(100 + i, 100 + i) for i in range(20)]
    assert run(spark, g, c, reg) == want


def test_rows_of_one_host_meet(spark, data):
    """Rows of both sources with one host are nearly always of one office."""
    big = data.replace("sf0.001", "sf0.01")
    g = table(spark, big, "greenbook_enrichment").withColumns({"agency_name": F.col("matched_from.agency_name"), "confidence_score": F.col("matched_from.confidence_score")})
    whole = {(r.enrichment_id, r.contact_id) for r in crossmatch.match_offices(g, table(spark, big, "agency_contacts"), table(spark, big, "registry")).collect()}
    hosts = g.select("enrichment_id", F.explode(F.transform("web_candidates", crossmatch.host_of)).alias("h"))
    same = hosts.join(table(spark, big, "agency_contacts").select("contact_id", crossmatch.host_of(F.col("agency_contact_url")).alias("h")), "h")
    same = {(r.enrichment_id, r.contact_id) for r in same.collect()}
    assert len(same & whole) >= 0.9 * len(same)


def test_weights_decide(spark):
    """Offices of one town hall share its phone, street and zip, which say little; one word of the name says more."""
    hall = [("address", "1 Hall St, Quuxholm, NY 12345", None), ("voice", "(100) 555-0100", None)]
    kinds = ("Housing Authority", "Parking Authority", "Water Authority", "Transit Authority", "Bridge Authority", "Port Authority", "Power Authority", "Dormitory Authority")
    reg = [(f"q-{k}", f"Quuxholm {n}") for k, n in enumerate(kinds)]
    g = [(k, None, f"Quuxholm {n}", hall, None) for k, n in enumerate(kinds)]
    c = [(100, "Quuxholm Housing Authority", None, None, None, None, None)] + [(100 + k, f"Quuxholm {n}", None, "100 555 0100", "1 Hall Street", "Quuxholm", "12345") for k, n in enumerate(kinds) if k]
    assert run(spark, g, c, reg) == [(k, 100 + k) for k in range(len(kinds))]
    assert run(spark, g, c, reg, weighed=False) != [(k, 100 + k) for k in range(len(kinds))]


def test_pruning_is_exact(spark):
    """With candidates pruned, every pair within reach of the best score of either class is still there."""
    rng = np.random.default_rng(4)
    bags = {(side, i): {f"t{t}" for t in rng.zipf(1.5, 6) % 60} for side, n in ((0, 80), (1, 120)) for i in range(n)}
    df = {t: sum(t in b for b in bags.values()) for b in bags.values() for t in b}
    gain = {k: {t: float(np.sqrt(np.log(1 + 200 / df[t]) / len(b) ** 0.3)) for t in b} for k, b in bags.items()}
    postings = spark.createDataFrame([(side, i, int(t[1:]), v) for (side, i), b in gain.items() for t, v in b.items()], "side int, q long, term long, gain double")
    pairs = crossmatch._candidates(postings)
    got = {(r.g, r.c): r.score for r in crossmatch.scores(pairs, postings).collect()}
    score = lambda a, b: sum(v * gain[b].get(t, 0.0) for t, v in gain[a].items())
    for a in bags:
        s = {b: score(a, b) for b in bags if b[0] != a[0]}
        for b, v in s.items():
            key = (a[1], b[1]) if a[0] == 0 else (b[1], a[1])
            if key in got:
                assert abs(got[key] - v) < 1e-5
            assert key in got or v < crossmatch.NEAR * max(s.values()) + 1e-5


def test_logistic():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    y = (x @ [2, -1, 0.5] + 0.3 + rng.logistic(size=500) > 0).astype(float)
    w = crossmatch.fit_logistic(x, y, np.zeros(4))
    assert np.all(np.sign(w[1:]) == [1, -1, 1])
    assert (crossmatch.fit_logistic(np.ones((500, 5)), np.ones(500)) == crossmatch.PRIOR).all()


def test_nothing_that_grows_goes_to_the_driver(spark, monkeypatch):
    plans = {}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for m in (crossmatch, lexicon, names):
        monkeypatch.setattr(m, "written", lambda df, name: plans.update({name: plan(df)}) or written(df, name))
    g = spark.createDataFrame([(1, "foobarville-ha", "Foobarville Housing Authority", None, addr("1 Main St", "Foobarville"), [])], G)
    c = spark.createDataFrame([(12, "Foobarville Housing Authority", None, None, "1 Main Street", None, "12345")], C)
    plans["result"] = plan(crossmatch.match_offices(g, c, spark.createDataFrame(REG, "id string, name string")))
    assert [n for n, p in plans.items() if "Broadcast" in p] == []
    assert all("TakeOrderedAndProject" in plans[n] for n in ("labelled", "labels"))
