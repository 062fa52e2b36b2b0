"""What changed between consecutive full snapshots, by invertible Bloom lookup tables.

Each snapshot is summarised per hash bucket by a small table of cells (count and xors of key, value hash and check
hash). The tables of two consecutive snapshots are subtracted, so that everything equal cancels, and the pairs that
differ are peeled out. What the comparison sends over the network is a few cells per bucket; only the choice of the row loaded last
moves rows, once. Buckets that can't be peeled, or
whose digest disagrees, are built again with more cells, from their own rows only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import written

#: Rows of a snapshot that share a bucket, cells of a bucket at first, factor of each enlargement.
BUCKET_ROWS, CELLS, ENLARGE = 2048, 768, 4
_HASHES = 3
_COLUMNS = ["seq", "bucket", "entry", "value", "sign", "failed"]
_PEELED = "seq int, bucket long, entry long, value long, sign int, failed boolean"

# The five primes of the public XXH64 algorithm.
_P1, _P2, _P3, _P4, _P5 = (
    0x9E3779B185EBCA87,
    0xC2B2AE3D27D4EB4F,
    0x165667B19E3779F9,
    0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5,
)


def _rot(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64_longs(*columns: np.ndarray) -> np.ndarray:
    """The value of Spark's xxhash64 over bigint columns, for arrays."""
    with np.errstate(over="ignore"):
        h = np.full(len(columns[0]), 42, np.uint64)
        for c in columns:
            h = h + np.uint64(_P5 + 8)
            h = h ^ (_rot(np.ascontiguousarray(c, np.int64).view(np.uint64) * np.uint64(_P2), 31) * np.uint64(_P1))
            h = _rot(h, 27) * np.uint64(_P1) + np.uint64(_P4)
            h = (h ^ (h >> np.uint64(33))) * np.uint64(_P2)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(_P3)
            h = h ^ (h >> np.uint64(32))
    return h.view(np.int64)


def _cells_of(size: int) -> Column:
    """The three cells of a pair, one in each third of the table, as functions of its check hash."""
    third = size // _HASHES
    return F.array(*((F.pmod(F.shiftrightunsigned("check", 20 * i), F.lit(third)) + i * third).cast("int") for i in range(_HASHES)))


def _positions(check: np.ndarray, size: int) -> np.ndarray:
    third = size // _HASHES
    return np.stack([((check.view(np.uint64) >> np.uint64(20 * i)).view(np.int64) % third) + i * third for i in range(_HASHES)])


def _differences(pairs: DataFrame, size: int, last: int) -> DataFrame:
    """Tables of seq less those of seq - 1, as cells that aren't zero."""
    hashed = pairs.withColumns({"check": F.xxhash64("entry", "value"), "digest": F.xxhash64("value", "entry")})
    sums = [F.bit_xor(c).alias(c) for c in ("entry", "value", "check", "digest")]
    one = hashed.withColumn("cell", F.explode(_cells_of(size))).groupBy("seq", "bucket", "cell").agg(F.count("*").alias("n"), *sums)
    both = one.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumns({"seq": F.col("seq") + F.col("side"), "n": F.when(F.col("side") == 0, F.col("n")).otherwise(-F.col("n"))})
    diff = both.where((F.col("seq") > 1) & (F.col("seq") <= last)).groupBy("seq", "bucket", "cell").agg(F.sum("n").alias("n"), *sums)
    return diff.where("n <> 0 or `check` <> 0 or entry <> 0 or value <> 0 or digest <> 0")


def _peel(size: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        seq, bucket = int(g["seq"].iloc[0]), int(g["bucket"].iloc[0])
        t = {k: np.zeros(size, np.int64) for k in ("n", "entry", "value", "check", "digest")}
        for k, x in t.items():
            x[g["cell"].to_numpy()] = g[k].to_numpy()
        owed = np.bitwise_xor.reduce(t["digest"][: size // _HASHES])  # each pair is once in the first third
        out = []
        while True:
            pure = np.flatnonzero(np.abs(t["n"]) == 1)
            pure = pure[xxhash64_longs(t["entry"][pure], t["value"][pure]) == t["check"][pure]]
            if not len(pure):
                break
            found = np.unique(np.stack([t["entry"][pure], t["value"][pure], t["n"][pure]], 1), axis=0)
            entry, value, sign = (np.ascontiguousarray(found[:, i]) for i in range(3))
            check, digest = xxhash64_longs(entry, value), xxhash64_longs(value, entry)
            for at in _positions(check, size):
                np.subtract.at(t["n"], at, sign)
                for k, x in (("entry", entry), ("value", value), ("check", check), ("digest", digest)):
                    np.bitwise_xor.at(t[k], at, x)
            owed ^= np.bitwise_xor.reduce(digest)
            out.append(found)
        if owed or any(x.any() for x in t.values()):
            return pd.DataFrame([(seq, bucket, 0, 0, 0, True)], columns=_COLUMNS)
        rows = np.concatenate(out) if out else np.empty((0, 3), np.int64)
        return pd.DataFrame({"seq": seq, "bucket": bucket, "entry": rows[:, 0], "value": rows[:, 1], "sign": rows[:, 2], "failed": False}, columns=_COLUMNS)

    return run


def snapshot_changes(
    rows: DataFrame, snapshot: str, entry: str, loaded: str, value: Column, bucket_rows: int = BUCKET_ROWS, cells: int = CELLS
) -> DataFrame:
    """Columns snapshot_date (``YYYY-MM-DD`` of the later snapshot), entry_no, change_kind (added, removed, changed).

    ``value`` is what counts as the entry's content. Of several rows for one entry in a snapshot the one loaded last
    stands (a null load time is the earliest; at a tie the larger content hash, so that the result is stable). Rows
    without snapshot or entry are left out. An empty table, or a single snapshot, gives no rows. Snapshots are compared
    in the order of their dates, whenever they were loaded. Contents are compared by 64-bit hashes. Extra columns are
    ignored.
    """
    snap = F.col(snapshot).cast("date").alias("snap")
    latest = (
        rows.select(snap, F.col(entry).cast("long").alias("entry"), F.col(loaded).alias("at"), F.xxhash64(value).alias("value"))
        .where("snap is not null and entry is not null")
        .groupBy("snap", "entry")
        .agg(F.max(F.struct("at", "value"))["value"].alias("value"))
    )
    dates = written(rows.select(snap).where("snap is not null").groupBy("snap").agg(F.count("*").alias("n")), "snapshots")
    # a row per snapshot: the window without partitions is as small as the calendar
    order = dates.select("snap", F.row_number().over(Window.orderBy("snap")).alias("seq"))
    largest, last = dates.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    buckets = max(1, -(-largest // bucket_rows))
    pairs = written(
        latest.join(F.broadcast(order), "snap").select("seq", F.pmod(F.xxhash64("entry"), F.lit(buckets)).alias("bucket"), "entry", "value"), "pairs"
    )
    size, todo, wanted, good = cells - cells % _HASHES, pairs, None, []
    while True:
        diff = _differences(todo, size, last)
        if wanted is not None:
            diff = diff.join(wanted, ["seq", "bucket"], "left_semi")
        peeled = written(diff.groupBy("seq", "bucket").applyInPandas(_peel(size), _PEELED), "peeled")
        good.append(peeled.where("not failed"))
        wanted = peeled.where("failed").select("seq", "bucket")
        if wanted.isEmpty():
            break
        sides = wanted.unionByName(wanted.withColumn("seq", F.col("seq") - 1)).distinct()
        todo = pairs.join(sides, ["seq", "bucket"], "left_semi")
        size *= ENLARGE
    found = good[0]
    for more in good[1:]:
        found = found.unionByName(more)
    ends = found.groupBy("seq", "entry").agg(F.max("sign").alias("hi"), F.min("sign").alias("lo"))
    kind = F.when(F.col("hi") > F.col("lo"), "changed").when(F.col("hi") > 0, "added").otherwise("removed")
    return ends.join(F.broadcast(order), "seq").select(F.date_format("snap", "yyyy-MM-dd").alias("snapshot_date"), F.col("entry").alias("entry_no"), kind.alias("change_kind"))
