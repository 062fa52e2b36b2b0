"""Contracts of tables: problems as rows, and guards that refuse to go on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table breaks its contract; the message holds some of the rows that do."""


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """DQ-1, 6: (key, problem) for every rule (a condition that must not hold) that a row breaks; a condition that is
    null holds not."""
    said = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), n) for n, c in rules.items())))
    return rows.select(F.col(key).alias("key"), F.explode(said).alias("problem"))


def schema_rules(required: list[str], enums: dict[str, list[str]], patterns: dict[str, str]) -> dict[str, Column]:
    """DQ-6: rules from a schema: required fields, closed vocabularies, patterns."""
    rules = {f"{c} missing": F.col(c).isNull() for c in required}
    rules |= {f"{c} unknown": F.col(c).isNotNull() & ~F.col(c).isin(*v) for c, v in enums.items()}
    return rules | {f"{c} malformed": ~F.col(c).rlike(p) for c, p in patterns.items()}


def duplicates(rows: DataFrame, by: list[str]) -> DataFrame:
    """SET-6."""
    return rows.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")


def outside(rows: DataFrame, column: str, vocabulary: list[str]) -> DataFrame:
    """SET-4, DQ-8: values outside a vocabulary, with their number."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*vocabulary)).groupBy(column).agg(F.count("*").alias("n"))


def require_empty(problems: DataFrame, what: str) -> None:
    """Refuse to go on if there are problems (a few of them are named)."""
    some = problems.take(5)
    if some:
        raise ContractError(f"{what}: {[tuple(r) for r in some]}")


def require_columns(df: DataFrame, columns: list[str], exact: bool = False) -> None:
    """Header contract: all columns there, or exactly these in this order."""
    if exact and df.columns != columns:
        raise ContractError(f"columns {df.columns} are not {columns}")
    if missing := [c for c in columns if c not in df.columns]:
        raise ContractError(f"columns {missing} are missing")


def unit_contract(units: DataFrame, expected: dict[str, int], code: str, level: str, parent: str, flags: str) -> DataFrame:
    """DQ-4, 5: (problem, subject): published counts per level, codes that are twice, parents that aren't there, flags
    other than Y and N."""
    n = units.groupBy(level).agg(F.count("*").alias("n"))
    want = units.sparkSession.createDataFrame(list(expected.items()), f"{level} string, want long")
    counts = want.join(n, level, "left").where("coalesce(n, 0) <> want").select(F.lit("row count").alias("problem"), F.col(level).alias("subject"))
    twice = duplicates(units.where(F.col(code).isNotNull()), [code]).select(F.lit("code twice").alias("problem"), F.col(code).alias("subject"))
    parents = units.where(F.col(level) == "county").select(F.col("name").alias(parent)).distinct()
    orphan = units.where(F.col(parent).isNotNull()).join(parents, parent, "left_anti").select(F.lit("parent unknown").alias("problem"), F.col(parent).alias("subject"))
    flag = outside(units, flags, ["Y", "N"]).select(F.lit("flag unknown").alias("problem"), F.col(flags).alias("subject"))
    return reduce(lambda a, b: a.unionByName(b), (counts, twice, orphan, flag))


def run_guard(rows: DataFrame, labels: DataFrame, today: Column, oldest_days: int = 30) -> DataFrame:
    """DQ-2: (label, problem) before a run: labels that no row lists, stand-ins, unclassed ones, rows checked too long
    ago. ``rows(label, class, checked, status)``, ``labels(label)``."""
    j = labels.join(rows, "label", "left")
    rules = {"unlisted": F.col("status").isNull(), "stand-in": F.col("status") == "stand-in", "unclassed": F.col("status").isNotNull() & F.col("class").isNull(), "checked too long ago": F.datediff(today, F.col("checked")) > oldest_days}
    return violations(j, "label", rules).withColumnRenamed("key", "label")


def label_choice(rows: DataFrame, key: str, labels: str, usable: Column) -> DataFrame:
    """PRJ-46: the first usable of a row's labels, and why those before it weren't. ``usable`` is a condition on
    columns label and pos."""
    each = rows.select(key, F.posexplode_outer(labels).alias("pos", "label")).withColumn("ok", F.coalesce(usable, F.lit(False)))
    return each.groupBy(key).agg(F.min_by("label", F.when(F.col("ok"), F.col("pos"))).alias("label"), F.sort_array(F.collect_list(F.when(~F.col("ok") & F.col("label").isNotNull(), F.col("label")))).alias("skipped"))


def is_stale(existing: str, generated: str, footer: str = "generated") -> bool:
    """DQ-9: whether a written report differs from a new one, lines of the footer aside."""
    strip = lambda t: [x.rstrip() for x in t.splitlines() if not x.lower().lstrip("_* ").startswith(footer)]
    return strip(existing) != strip(generated)
