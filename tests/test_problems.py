import random
from datetime import date, datetime

import numpy as np
from pyspark.sql import functions as F

from plumbline.operators import hierarchy, history, orphans, snapshots

REFS = "ref_table string, ref_field string, row_id long, day date, namespace string, key string, extra int, reason string"
PARENTS = "namespace string, key string, added date, removed date, day date"


def d(text):
    return date.fromisoformat(text)


def orphan_rows(spark, refs, parents, **kw):
    out = orphans.find_orphans(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), **kw)
    return sorted(map(tuple, out.collect()))


def test_orphans_reasons_and_edges(spark):
    parents = [("r", " A ", d("2020-01-01"), d("2021-01-01"), None), ("r", "b", d("2020-06-01"), None, None), ("r", "b", d("2020-06-01"), None, None), ("r", None, None, None, None), ("l", "a", None, None, None), ("r", "two", d("2019-01-01"), d("2019-06-01"), None), ("r", "two", d("2020-01-01"), None, None), ("r", "é" * 400, None, None, None)]
    ref = lambda i, day, ns, k: ("t", "f", i, day and d(day), ns, k, 1, "x")
    refs = [ref(1, "2020-05-01", "r", "a"), ref(2, "2021-01-01", "r", "a"), ref(3, "2019-12-31", "r", "A"), ref(4, "2020-05-31", "r", "B "), ref(5, "2020-05-31", "r", "none"), ref(6, "2020-05-31", "r", " "), ref(7, "2020-05-31", "r", None), ref(8, None, "r", "none"), ref(5, "2020-05-31", "r", "none"), ref(9, "2000-01-01", "l", "A"), ref(10, "2019-07-01", "r", "two"), ref(11, "2020-07-01", "r", "two"), ref(12, "2020-01-01", "r", "É" * 400), ref(13, "2020-01-01", "q", "a"), (None, "f", None, d("2020-01-01"), "r", "none", 1, "x")]
    assert orphan_rows(spark, refs, parents) == [("t", "f", 2, "2021-01", "deleted"), ("t", "f", 3, "2019-12", "late"), ("t", "f", 4, "2020-05", "late"), ("t", "f", 5, "2020-05", "missing"), ("t", "f", 10, "2019-07", "deleted"), ("t", "f", 13, "2020-01", "missing")]


def test_orphans_empty(spark):
    refs = [("t", "f", 1, d("2020-01-01"), "r", "a", 1, "x")]
    assert orphan_rows(spark, refs, []) == [("t", "f", 1, "2020-01", "missing")]
    assert orphan_rows(spark, [], [("r", "a", None, None, None)]) == []
    assert orphan_rows(spark, [], []) == []


def test_orphans_hot_key_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(orphans, "BLOCK_ROWS", 7)
    rng = random.Random(1)
    parents = [("r", f"k{i}", d("2020-01-01"), d("2022-01-01") if i % 3 else None, None) for i in range(100)]
    refs = [("t", "f", i, date(2019 + rng.randrange(5), 1, 2), "r", "hot" if i % 3 == 0 else f"k{rng.randrange(120)}", 0, "") for i in range(600)]
    span = {p[1]: p[2:4] for p in parents}
    want = []
    for r in refs:
        s = span.get(r[5])
        why = "missing" if s is None else "late" if r[3] < s[0] else "deleted" if s[1] and s[1] <= r[3] else None
        if why:
            want.append(("t", "f", r[2], r[3].strftime("%Y-%m"), why))
    assert orphan_rows(spark, refs, parents, chunk_rows=20) == sorted(want)


SNAP = "snap date, entry long, name string, at timestamp, value string"


def changes(spark, rows, **kw):
    df = spark.createDataFrame(rows, SNAP)
    out = snapshots.snapshot_changes(df, "snap", "entry", "at", F.coalesce("name", F.lit("")), **kw)
    return sorted(map(tuple, out.collect()))


def test_xxhash_equals_spark(spark):
    rng = np.random.default_rng(3)
    a, b = (rng.integers(-(2**63), 2**63 - 1, 50) for _ in range(2))
    got = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    assert [r.h for r in got] == snapshots.xxhash64_longs(np.array([r.a for r in got]), np.array([r.b for r in got])).tolist()


def brute_changes(rows):
    at = {}
    for s, e, n, t, _ in rows:
        if s is not None and e is not None:
            k = at.setdefault(s, {})
            if e not in k or (t or datetime.min) > k[e][0]:
                k[e] = (t or datetime.min, n or "")
    days = sorted(at)
    out = []
    for p, q in zip(days, days[1:]):
        for e in at[p].keys() | at[q].keys():
            x, y = at[p].get(e), at[q].get(e)
            if x is None or y is None or x[1] != y[1]:
                out.append((q.isoformat(), e, "added" if x is None else "removed" if y is None else "changed"))
    return sorted(out)


def test_snapshots_enlarge_failed_buckets(spark):
    rng = random.Random(2)
    rows, i = [], 0
    for k, day in enumerate((d("2024-01-05"), d("2024-02-02"), d("2024-04-05"))):
        for e in range(400):
            if rng.random() < 0.8:
                i += 1
                rows.append((day, e - 200, f"n{e}{rng.randrange(2)}", datetime(2024, 5, 1, 0, i // 60 % 60, i % 60), "v"))
    rows += [(day, e, "late", datetime(2025, 1, 1), "v") for day, e, *_ in rows[::50]] + rows[:5]
    want = brute_changes(rows)
    assert changes(spark, rows) == want
    assert changes(spark, rows, bucket_rows=100, cells=30) == want  # far too small: every bucket is built again


def test_snapshots_edges(spark):
    t = datetime(2024, 1, 1)
    assert changes(spark, []) == []
    assert changes(spark, [(d("2024-01-01"), 1, "a", t, "")]) == []
    rows = [(d("2024-01-01"), 1, None, t, ""), (d("2024-02-01"), 1, "", t, ""), (d("2024-02-01"), None, "a", t, ""), (None, 2, "a", t, ""), (d("2024-02-01"), 3, "x", None, ""), (d("2024-02-01"), 3, "y", t, "")]
    assert changes(spark, rows) == [("2024-02-01", 3, "added")]


def periods(spark, rows):
    df = spark.createDataFrame(rows, "k string, role string, f string, t string, at timestamp, n int")
    out = history.periods(df, ["k"], ["role"], history.first_day(F.col("f")), history.first_day(F.col("t")), "at")
    return sorted((r.k, r.role or "", str(r.valid_from), str(r.valid_to)) for r in out.collect())


def test_history(spark):
    t = lambda i: datetime(2024, 1, i)
    rows = [
        ("a", "x", "2010", None, t(1), 1), ("a", "x", "2011-05", None, t(1), 1), ("a", "y", "2012-01-02", "2013", t(1), 1), ("a", "y", "2014", None, t(1), 1),
        ("b", "x", "2010", "2012", t(1), 1), ("b", "y", "2010", "2011", t(2), 1), ("b", "y", "2011", None, None, 1), ("b", "y", "2010", "2011", t(2), 1),
        ("c", "x", "bad", None, t(1), 1), (None, "x", "2010", None, t(1), 1), ("d", "x", "2012", "2011", t(1), 1), ("e", None, "2012", None, t(1), 1),
    ]
    assert periods(spark, rows) == [
        ("a", "x", "2010-01-01", "2012-01-02"), ("a", "y", "2012-01-02", "2013-01-01"), ("a", "y", "2014-01-01", "None"),
        ("b", "y", "2010-01-01", "None"), ("e", "", "2012-01-01", "None"),
    ]
    assert periods(spark, []) == []


def brute_tree(tree):
    par, out = dict(tree), {}
    for i in par:
        seen, cur = [i], i
        while par.get(cur) is not None and len(seen) <= len(par) + 1:
            cur = par[cur]
            seen.append(cur)
        out[i] = ("", -1, ()) if par.get(cur) is not None else (cur, len(seen) - 1, tuple(reversed(seen)))
    return out


def test_hierarchy_shapes(spark):
    rng = random.Random(1)
    n, ids = 200, [f"n{i}" for i in range(200)]
    shapes = [
        [(ids[i], ids[i - 1] if i else None) for i in range(n)],
        [(ids[i], ids[rng.randrange(i)] if i and rng.random() < 0.95 else None) for i in range(n)],
        [(ids[i], rng.choice(ids) if rng.random() < 0.97 else None) for i in range(n)],
        [(ids[i], "n0" if i else None) for i in range(n)],
    ]
    for tree in shapes:
        df = spark.createDataFrame(tree, "id string, parent string")
        for base in (25, 1000):
            got = {r.id: (r.root, r.depth, tuple(r.path)) for r in hierarchy.resolve_hierarchy(df, True, base).collect()}
            assert got == brute_tree(tree)


def test_hierarchy_links(spark):
    rows = [("a", None, ["b", "zz", None]), ("b", None, []), ("c", "b", None), ("d", "d", None), ("e", "d", None), (None, "a", None), ("a", None, ["b"]), ("f", "gone", None)]
    df = spark.createDataFrame(rows, "id string, up string, down array<string>").withColumn("parent", F.lit("x"))
    tree = hierarchy.links(df, "id", "up", "down")
    got = {r.id: (r.root, r.depth) for r in hierarchy.resolve_hierarchy(tree, False).collect()}
    assert got == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("", -1), "e": ("", -1), "f": ("f", 0)}
    pairs = sorted(map(tuple, hierarchy.descendants(hierarchy.resolve_hierarchy(tree)).collect()))
    assert pairs == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]
    assert hierarchy.resolve_hierarchy(tree.limit(0)).count() == 0
