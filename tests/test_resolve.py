import pytest
from pyspark.sql import functions as F

from plumbline.operators import inventory, quality, resolve
from plumbline.sources import readers, sinks

ENT = "id string, ord long, name string, pairs " + resolve.PAIR
REC = "rec_id string, seq long, name string, pairs " + resolve.PAIR + ", match_entity_id string, mint_id string, expect_new boolean"


def test_merge(spark):
    ents = spark.createDataFrame([("foo", 1, "Foo", [("s", "1")]), ("foo-2", 2, "Foo ", []), ("bar", 3, "Bar", [("s", "2")])], ENT)
    one = spark.createDataFrame(
        [
            ("a", 1, "Other", [("t", "9"), ("s", "2")], None, None, False),
            ("b", 2, "FOO!", [("u", "1")], None, None, False),
            ("c", 3, "New", [("v", "1")], None, None, True),
            ("d", 4, "new", [], None, None, False),
            ("e", 5, "Elsewhere", [("v", "1")], None, None, False),
            ("f", 6, "Foo", [], None, "foo-city", False),
            ("g", 7, "Foo 2", [], None, None, False),
        ],
        REC,
    )
    two = spark.createDataFrame([("h", 1, "x", [("v", "1")], None, None, False), ("i", 2, "y", [("z", "1")], "bar", None, False)], REC)
    out, log = resolve.merge_batches(ents, [one, two])
    got = {r.id: (r.name, [tuple(p) for p in r.pairs]) for r in out.collect()}
    assert got["bar"] == ("Bar", [("s", "2"), ("t", "9"), ("z", "1")])
    assert got["foo-2"][1] == [("u", "1")]  # of equal names the last
    assert got["new"] == ("New", [("v", "1")]) and "foo-city" in got and "foo-2-2" in got and len(got) == 6
    assert sorted((r.action, r.entity_id) for r in log.collect()) == [("add", "foo-2-2"), ("add", "foo-city"), ("add", "new"), ("enrich", "bar"), ("enrich", "bar"), ("enrich", "foo-2")]
    again, log2 = resolve.merge_batches(out.select("id", "ord", "name", "pairs"), [two])
    assert log2.count() == 0 and again.count() == 6
    bad = spark.createDataFrame([("x", 1, "Q", [], "nobody", None, False), ("y", 2, "Bar", [], None, None, True), ("z", 3, "Foo", [], None, "bar", False)], REC)
    assert sorted(map(tuple, resolve.check_batch(bad, ents).collect())) == [("x", "unknown entity"), ("y", "expected new"), ("z", "id in use"), ("z", "name in use")]


def test_mint_ids_like_a_loop(spark):
    import re

    names = ["A b", "a-b", "A  B", "A b 2", "", "!", "c", "c 3", "C"] * 2
    used = ["a-b", "a-b-3", "c-2", "entity"]
    df = spark.createDataFrame(list(enumerate(names)), "seq long, name string")
    got = [r.id for r in resolve.mint_ids(df, "name", "seq", spark.createDataFrame([(u,) for u in used], "id string")).orderBy("seq").collect()]
    taken = set(used)
    for n, g in zip(names[:4], got):  # the first rows, one after the other
        slug = re.sub("[^a-z0-9]+", "-", n.lower()).strip("-") or "entity"
        k, want = 1, slug
        while want in taken:
            k += 1
            want = f"{slug}-{k}"
        taken.add(want)
        assert g == want
    assert len(set(got)) == len(got) and not set(got) & set(used)


def test_matching(spark):
    a = spark.createDataFrame([(1, "k"), (2, "m"), (3, "m"), (4, None)], "left_id int, key string")
    b = spark.createDataFrame([(10, "k"), (11, "m"), (12, "z"), (13, None)], "right_id int, key string")
    got = sorted(((r.left_id, r.right_id, r.reason) for r in resolve.one_to_one(a, b, "key").collect()), key=str)
    assert got == sorted([(1, 10, "matched"), (2, None, "ambiguous"), (3, None, "ambiguous"), (4, None, "no_match"), (None, 11, "right_unmatched"), (None, 12, "right_unmatched"), (None, 13, "right_unmatched")], key=str)
    w = spark.createDataFrame([(10, ["k", "m"]), (11, ["m", "m"])], "right_id int, keys array<string>")
    assert sorted((r.left_id, r.reason) for r in resolve.one_to_one_either(a, w, "key", "keys").collect()) == [(1, "ambiguous"), (2, "ambiguous"), (3, "ambiguous"), (4, "no_match")]
    leads = [("u1", "a.gov", "x", ""), ("u1", "a.gov", "y", "/index.html"), ("u2", "b.gov", "x", ""), ("u3", "c.gov", "x", ""), ("u3", "d.gov", "y", ""), ("u4", "o.gov", "x", ""), ("u4", "o.gov", "y", ""), ("u5", "a2.gov", "x", "/deep")]
    out = resolve.website_rule(spark.createDataFrame(leads, "unit_id string, host string, source string, path string"), spark.createDataFrame([("o.gov",)], "host string"))
    assert {r.unit_id: r.outcome for r in out.collect()} == {"u1": "primary", "u2": "website_single_lead", "u3": "website_leads_disagree", "u4": "website_host_owned_by_existing_entity"}


def test_titles(spark):
    t = spark.createDataFrame([(1, "Welcome to Rye Brook"), (2, "Rye and Rye Brook"), (3, None)], "page_id int, title string")
    p = spark.createDataFrame([("rye",), ("rye brook",)], "place string")
    assert sorted(map(tuple, resolve.title_places(t, p).collect())) == [(1, "rye brook"), (2, "rye"), (2, "rye brook")]
    n = lambda title, lvl, needs, both: spark.range(1).select(resolve.title_names_level(F.lit(title), F.lit(lvl), F.lit("rye"), F.lit(needs), F.array(*map(F.lit, both)))).first()[0]
    assert n("Town of Rye", "town", True, ["city"]) and not n("City of Rye", "town", True, ["city"]) and not n("Town and Village of Rye", "town", False, []) and n("Rye", "town", False, [])


def test_additive_is_idempotent(spark):
    e = spark.createDataFrame([("a", ["x"]), ("b", None)], "id string, v array<string>")
    add = spark.createDataFrame([("a", "y", 2), ("a", "x", 1), ("a", "z", 1), ("b", "q", 1), ("zz", "q", 1)], "id string, value string, ord int")
    once = resolve.append_missing(e, add, "v")
    assert {r.id: r.v for r in once.collect()} == {"a": ["x", "z", "y"], "b": ["q"]}
    assert {r.id: r.v for r in resolve.append_missing(once, add, "v").collect()} == {"a": ["x", "z", "y"], "b": ["q"]}
    assert [r.id for r in resolve.unmatched(add, e).collect()] == ["zz"]


def test_rollup_does_not_depend_on_partitions(spark):
    rows = [("https://www.a.gov/x", "P", "e1", "city", "s1", 0, i, None) for i in range(3)] + [("a.gov", "Q", None, None, "s2", 1, 1, "portal"), (None, "Z", None, None, "s2", 1, 2, None)]
    df = spark.createDataFrame(rows, "url string, name string, entity_id string, level string, source string, precedence int, seq int, kind string")
    out = [inventory.host_rollup(df.repartition(n)).collect() for n in (1, 7)]
    assert out[0] == out[1] and len(out[0]) == 1
    r = out[0][0]
    assert (r.host, r.names, r.ids, r.paths, r.agency, r.kind) == ("www.a.gov", ["P", "Q"], ["e1"], ["/x"], "Q", "main site")


def test_quality_and_sources(spark, tmp_path):
    with pytest.raises(quality.ContractError):
        quality.require_empty(spark.range(1), "rows")
    (tmp_path / "a.csv").write_text("﻿host,agency\n A.gov ,x\n,y\n", encoding="utf-8")
    df = readers.listing(readers.csv_table(spark, str(tmp_path / "a.csv"), ["host", "agency"], exact=True), "host")
    assert [tuple(r) for r in df.collect()] == [("a.gov", "x")]
    with pytest.raises(quality.ContractError):
        readers.csv_table(spark, str(tmp_path / "a.csv"), ["agency", "host"], exact=True)
    (tmp_path / "e.json").write_text('{"entities": [{"id": "a", "name": "A"}]}')
    assert readers.json_array(spark, str(tmp_path / "e.json"), "entities", readers.ENTITY).first().id == "a"
    assert readers.json_array(spark, str(tmp_path / "no.json"), "entities", readers.ENTITY).count() == 0
    (tmp_path / "r.jsonl").write_text('{"run_id": "r", "host": "h"}\n{"torn')
    assert readers.json_lines(spark, str(tmp_path / "r.jsonl"), readers.RESULT).where("host is not null").count() == 1
    src = spark.createDataFrame([("const L = [{ id: 'a', name: \"A's\" }, { id: 'b' }]; type Ids = 'a' | 'b';",)], "t string")
    assert [(r.id, r.name) for r in readers.layer_rows(src, "t").collect()] == [("a", "A's"), ("b", None)]
    assert src.select(readers.vocabulary_blocks(F.col("t"), "Ids")).first()[0] == ["a", "b"]
    w = lambda s: spark.range(1).select(readers.website_cell(F.lit(s))).first()[0]
    assert w('{"url": "https://a"}') == "https://a" and w("https://b") == "https://b" and w("{}") is None
    out = spark.createDataFrame([(2, True, ["a", "b"]), (1, None, None)], "k int, b boolean, l array<string>")
    sinks.write_twins(out, str(tmp_path / "twins"), ["k", "b", "l"], ["k"])
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "twins/csv")).orderBy("k").collect()] == [("1", None, None), ("2", "TRUE", "a,b")]
    for n in (1, 2):
        sinks.append_unit(spark.range(n), str(tmp_path / "units"), "r", "u")
    assert spark.read.parquet(str(tmp_path / "units")).count() == 2
    assert not quality.is_stale("a\n_Generated x_", "a\n_Generated y_") and quality.is_stale("a", "b")


def test_fuzzy_review_finds_every_pair(spark):
    """An edit anywhere, the first letters included."""
    known = [("a", "Foobarville Library"), ("b", "Town of Quux"), ("c", "Town of Quuz")]
    rows = [(1, "Fobarville Library"), (2, "oobarvile Library"), (3, "Tovn of Quux"), (4, "Xtown of Quux"), (5, "Foobarville Library"), (6, "Something Else"), (7, None)]
    got = resolve.fuzzy_review(spark.createDataFrame(rows, "row_id int, name string"), spark.createDataFrame(known, "entity_id string, name string"))
    want = [(1, "a", 1), (2, "a", 2), (3, "b", 1), (3, "c", 2), (4, "b", 1), (4, "c", 2)]
    assert sorted((r.row_id, r.entity_id, r.edits) for r in got.collect()) == want
