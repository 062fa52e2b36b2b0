"""Sinks: idempotent table writes, and small reports rendered on the driver."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import scoring


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK-1: Parquet; the whole table, or only the partitions that ``df`` has (SNK-2: one's own section)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_twins(df: DataFrame, folder: str, columns: list[str], order: list[str]) -> None:
    """SNK-4, 5, 6: the same rows as CSV (TRUE, FALSE, joined lists, blanks) and JSON, in a fixed column order. Rows are
    range-partitioned and sorted, so that the files in their order are sorted too."""
    rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    rows.write.mode("overwrite").json(f"{folder}/json")
    rows.select(*(scoring.csv_value(F.col(c), kinds[c]).alias(c) for c in columns)).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(f"{folder}/csv")


def append_unit(df: DataFrame, path: str, run_id: str, unit: str) -> None:
    """SNK-8: rows of one unit of work; written again they replace themselves."""
    write_table(df.withColumns({"run_id": F.lit(run_id), "unit": F.lit(unit)}), path, ["run_id", "unit"])


def write_status(path: str, text: str) -> None:
    """SNK-9: a local status file, replaced in one step."""
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.tmp", path)


def markdown_table(df: DataFrame, limit: int) -> str:
    """SNK-11, 12, 13: a report's table; the caller's limit bounds what comes to the driver."""
    rows = df.limit(limit).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)])


def run_manifest(run_id: str, **facts) -> dict:
    """SNK-10: what a run was, as a row for the runs table."""
    return {"run_id": run_id, **{k: v for k, v in sorted(facts.items())}}
