"""References whose target did not exist on the row's day.

Parents are range-partitioned by key and stored as one sorted block per range; references are routed to their range by
binary search over the range bounds and probed in Arrow batches by binary search inside the block. Only misses leave
the probe. A range that attracts many references (one key may hold a third of them) is split into chunks by a hash of
the row, its block being repeated for each chunk.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import written

#: Parents of one stored block, and references of one probe chunk; both fit easily into one task.
BLOCK_ROWS = 32_768
CHUNK_ROWS = 131_072

#: Days outside every calendar: an open start and an open end.
_FIRST, _NEVER = -(2**30), 2**30

_BLOCK = "namespace string, range_id long, lo string, keys array<string>, added array<int>, removed array<int>"
_MISS = "ref_table string, ref_field string, row_id long, day int, reason string"


def norm_key(c: Column) -> Column:
    """Lower case without blanks (Unicode ones too) at the ends; blank becomes null."""
    k = F.lower(F.regexp_replace(c, r"(?U)^[\s ﻿]+|[\s ﻿]+$", ""))
    return F.when(k != "", k)


def _as_bytes(values) -> np.ndarray:
    out = [v.encode() for v in values]
    if out and max(map(len, out)) <= 256 and not any(b"\0" in b for b in out):
        return np.array(out, dtype=f"S{max(1, max(map(len, out)))}")
    a = np.empty(len(out), dtype=object)
    a[:] = out
    return a


def _blocks(batches):
    """Cut a sorted partition into blocks of one namespace and at most BLOCK_ROWS keys; a key never straddles two."""
    rows: list[tuple] = []

    def flush():
        ns, lo = rows[0][0], rows[0][1]
        data = [[ns], [0], [lo], [[r[1] for r in rows]], [[r[2] for r in rows]], [[r[3] for r in rows]]]
        types = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array(d, t) for d, t in zip(data, types)], names=["namespace", "range_id", "lo", "keys", "added", "removed"]
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and (row[0] != rows[0][0] or len(rows) >= BLOCK_ROWS and row[1] != rows[-1][1]):
                yield flush()
                rows = []
            rows.append(row)
    if rows:
        yield flush()


def parent_blocks(parents: DataFrame) -> DataFrame:
    """``parents(namespace, key, added, removed)`` as sorted blocks in the shared folder. The same key may have several
    spans of days; equal spans are kept once. A null ``added`` or ``removed`` leaves that side open."""
    spans = parents.select(
        "namespace",
        norm_key(F.col("key")).alias("key"),
        F.coalesce(F.unix_date("added"), F.lit(_FIRST)).alias("added"),
        F.coalesce(F.unix_date("removed"), F.lit(_NEVER)).alias("removed"),
    )
    spans = spans.where("key is not null").distinct()
    ordered = spans.repartitionByRange("namespace", "key").sortWithinPartitions("namespace", "key", "added")
    return written(ordered.mapInArrow(_blocks, _BLOCK), "parent_blocks")


def find_orphans(refs: DataFrame, parents: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Misses of ``refs(ref_table, ref_field, row_id, day date, namespace, key)`` against ``parents(namespace, key,
    added date, removed date)``: columns ref_table, ref_field, row_id, ref_period (``YYYY-MM``), reason.

    reason: ``missing`` (no such key at any time), ``deleted`` (a span of the key ended on or before the day) or
    ``late`` (every span starts after it). Null or blank keys are no reference; rows without a day or row_id are left
    out, since neither can be placed. Repeated rows give one case. No parents: every reference is missing. No
    references: no rows. Extra columns are ignored.
    """
    blocks = parent_blocks(parents)
    bounds = blocks.select("namespace", "lo").orderBy("namespace", "lo").collect()  # one short row per BLOCK_ROWS keys
    lows: dict[str, np.ndarray] = {}
    for ns in dict.fromkeys(r[0] for r in bounds):
        a = np.empty(sum(r[0] == ns for r in bounds), dtype=object)
        a[:] = [r[1].encode() for r in bounds if r[0] == ns]
        lows[ns] = a

    @F.pandas_udf("long")
    def range_of(ns: pd.Series, key: pd.Series) -> pd.Series:
        out = np.full(len(ns), -1, dtype=np.int64)
        for name, lo in lows.items():
            at = np.flatnonzero((ns == name).to_numpy())
            probe = np.empty(len(at), dtype=object)
            probe[:] = [k.encode() for k in key.to_numpy()[at]]
            out[at] = np.maximum(np.searchsorted(lo, probe, side="right") - 1, 0)
        return pd.Series(out)

    known = refs.select("ref_table", "ref_field", F.col("row_id").cast("long").alias("row_id"), F.unix_date("day").alias("day"), "namespace", norm_key(F.col("key")).alias("key"))
    known = known.where("key is not null and day is not null and row_id is not null")
    known = known.withColumn("range_id", range_of("namespace", "key"))
    counts = known.groupBy("namespace", "range_id").agg(F.ceil(F.count("*") / F.lit(chunk_rows)).cast("int").alias("chunks"))
    counts = F.broadcast(written(counts, "range_counts"))  # a row per block of BLOCK_ROWS parents, as the bounds here
    chunk = F.pmod(F.xxhash64("ref_table", "ref_field", "row_id"), F.col("chunks")).cast("int")
    left = known.join(counts, ["namespace", "range_id"]).withColumn("chunk", chunk).drop("chunks")
    numbered = blocks.withColumn("range_id", range_of("namespace", "lo"))
    right = numbered.join(counts, ["namespace", "range_id"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")

    def probe(rows: pa.Table, parent: pa.Table) -> pa.Table:
        day = rows["day"].to_numpy()
        n = len(day)
        alive, any_past, found = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
        asked = _as_bytes(rows["key"].to_pylist())
        for block in range(parent.num_rows if n else 0):
            sought = asked
            keys = _as_bytes(parent["keys"][block].values.to_pylist())
            added = parent["added"][block].values.to_numpy()
            removed = parent["removed"][block].values.to_numpy()
            if keys.dtype != sought.dtype and object in (keys.dtype, sought.dtype):
                keys, sought = keys.astype(object), sought.astype(object)
            at, end = np.searchsorted(keys, sought, side="left"), np.searchsorted(keys, sought, side="right")
            found |= end > at
            while (more := at < end).any():  # once for each span of a key
                i = at[more]
                alive[more] |= (added[i] <= day[more]) & (day[more] < removed[i])
                any_past[more] |= removed[i] <= day[more]
                at = at + more
        reason = np.where(~found, "missing", np.where(any_past, "deleted", "late"))
        miss = np.flatnonzero(~alive)
        cols = [rows[c].take(pa.array(miss)) for c in ("ref_table", "ref_field", "row_id", "day")]
        return pa.table([*cols, pa.array(reason[miss].tolist(), pa.string())], names=["ref_table", "ref_field", "row_id", "day", "reason"])

    by = ("namespace", "range_id", "chunk")
    misses = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(probe, _MISS).distinct()
    return misses.select("ref_table", "ref_field", "row_id", F.date_format(F.date_from_unix_date("day"), "yyyy-MM").alias("ref_period"), "reason")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Misses per table, field, period and reason."""
    return orphans.groupBy("ref_table", "ref_field", "ref_period", "reason").agg(F.count("*").alias("n"))


def fields_as_refs(df: DataFrame, ref_table: str, row_id: str, day: Column, fields: dict[str, str]) -> DataFrame:
    """One reference row per field of ``df``; fields: column name -> namespace of its target. One scan."""
    pairs = F.array(*(F.struct(F.lit(f).alias("ref_field"), F.lit(ns).alias("namespace"), F.col(f).alias("key")) for f, ns in fields.items()))
    one = df.select(F.lit(ref_table).alias("ref_table"), F.col(row_id).alias("row_id"), day.cast(T.DateType()).alias("day"), F.explode(pairs).alias("r"))
    return one.select("ref_table", "r.ref_field", "row_id", "day", "r.namespace", "r.key")
