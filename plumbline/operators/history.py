"""History of changing attributes: periods of validity from dated statements that arrive in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_day(text: Column) -> Column:
    """The first day of a ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` date as a date; null for anything else."""
    t = F.trim(text)
    full = (
        F.when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01")))
        .when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-01")))
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t)
    )
    return F.try_to_date(full, "yyyy-MM-dd")


def periods(statements: DataFrame, keys: list[str], attributes: list[str], start: Column, end: Column, loaded: str) -> DataFrame:
    """Gaps and islands: columns keys, attributes, valid_from, valid_to (dates; valid_to null if open).

    Of several statements with one start for a key the one loaded last stands (a null load time is the earliest; at a
    tie the larger attribute values). A statement holds until its stated end or the start of the next one, whichever
    comes first. One that repeats the running attributes without a gap starts no new period. Statements without a start
    or with a null key, and those that end before they begin, hold for no day and only cut what ran before. Null
    attributes are a value like any other. An empty table gives no rows.

    The first step leaves at most one row for a key and day, with partial sums before the shuffle, so that no window
    over a key can be longer than the calendar, however many statements a key has.
    """
    rows = statements.select(*(F.col(k) for k in keys), *(F.col(a) for a in attributes), start.alias("__start"), end.alias("__end"), F.col(loaded).alias("__at"))
    rows = rows.where(F.col("__start").isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    stands = F.max(F.struct("__at", *attributes, "__end")).alias("r")
    one = rows.groupBy(*keys, "__start").agg(stands).select(*keys, "__start", *(F.col(f"r.{a}").alias(a) for a in attributes), F.col("r.__end").alias("__end"))
    w = Window.partitionBy(*keys).orderBy("__start")
    one = one.withColumns({"__hash": F.xxhash64(*attributes), "__until": F.least("__end", F.lead("__start").over(w))})
    one = one.where("__until is null or __until > __start")
    before_hash, before_until = F.lag("__hash").over(w), F.lag("__until").over(w)
    runs_on = F.coalesce((F.col("__hash") == before_hash) & (before_until == F.col("__start")), F.lit(False))
    marked = one.withColumn("__new", F.when(runs_on, 0).otherwise(1))
    island = marked.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    closes = F.when(F.count("*") == F.count("__until"), F.max("__until"))
    return island.groupBy(*keys, *attributes, "__island").agg(F.min("__start").alias("valid_from"), closes.alias("valid_to")).drop("__island")
