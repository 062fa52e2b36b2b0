"""Parent-child links to whole hierarchies: path, depth, root, descendants, and rings told apart.

Rake and contract. Leaves are set aside; the rest is spread so that a node and its parent often meet in one task, where
parent chains are followed to the last node that the task knows (the fragment's exit). Only nodes that are an exit of
some fragment go on to the next, smaller, quotient forest, which is solved in the same way until it fits into one task;
every forest is contracted once at least. Results are then handed back down, level by level. Rings that lie in one task show there, others in a later quotient.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import written

#: Nodes that one task solves at the end of the recursion, and that one contracts at most.
BASE_NODES, TASK_NODES = 4_096, 65_536
#: Children of one parent that may be drawn to the parent's task.
NEAR_CHILDREN = 10_000

_CHAIN = "id string, exit string, steps int, way array<string>, ring boolean"
_SOLVED = "id string, root string, depth int, path array<string>"


def links(nodes: DataFrame, id: str, parent: str | None = None, children: str | None = None) -> DataFrame:
    """One row (id, parent) for each node; a link holds if either side states it. Links to nodes that are not there
    don't count; of several parents the least id stands. Null ids are no nodes, repeated ids are one node."""
    ids = nodes.select(F.col(id).alias("id")).where("id is not null").distinct()
    stated = []
    if parent:
        stated.append(nodes.select(F.col(id).alias("id"), F.col(parent).alias("parent")))
    if children:
        stated.append(nodes.select(F.explode(children).alias("id"), F.col(id).alias("parent")))
    up = stated[0] if len(stated) == 1 else stated[0].unionByName(stated[1])
    up = up.where("id is not null and parent is not null").distinct()
    up = up.join(ids.select(F.col("id").alias("parent")), "parent", "left_semi")
    best = up.groupBy("id").agg(F.min("parent").alias("parent"))
    return ids.join(best, "id", "left")


def _follow(ids: np.ndarray, parents: np.ndarray, steps: np.ndarray, ways, with_path: bool) -> pd.DataFrame:
    """Pointer doubling inside one task. Ends: a node of the task without parent (exit = itself, steps to it), or the
    first node that isn't in the task (exit = that node). Nodes that reach no end are on, or below, a ring."""
    n = len(ids)
    index = pd.Index(ids)
    parent_at = index.get_indexer(pd.Index(parents, dtype=object)) if n else np.empty(0, int)
    is_root = pd.isna(pd.Series(parents, dtype=object)).to_numpy() if n else np.empty(0, bool)
    inside = (parent_at >= 0) & ~is_root
    jump, dist = np.where(inside, parent_at, np.arange(n)), np.where(inside, steps, 0).astype(np.int64)
    for _ in range(max(1, int(n).bit_length() + 1)):
        dist = dist + dist[jump]
        jump = jump[jump]
    ring = inside[jump] if n else np.empty(0, bool)
    last_out = ~is_root[jump] & ~ring
    exit_ = np.empty(n, dtype=object)
    exit_[:] = ids[jump]
    exit_[last_out] = parents[jump[last_out]]
    total = dist + np.where(last_out, steps[jump], 0)
    out = pd.DataFrame({"id": ids, "exit": exit_, "steps": np.where(ring, 0, total).astype(np.int32), "ring": ring})
    empty: list[str] = []
    if with_path:  # way: the nodes strictly below the exit down to the node itself
        memo: dict[int, list] = {}
        for i in np.argsort(np.where(ring, -1, dist), kind="stable").tolist():
            own = list(ways[i]) if ways is not None else [ids[i]]
            if ring[i]:
                memo[i] = empty
            elif inside[i]:
                memo[i] = memo[int(parent_at[i])] + own
            else:
                memo[i] = empty if is_root[i] else own
        out["way"] = [memo[i] for i in range(n)]
    else:
        out["way"] = [empty] * n
    return out[["id", "exit", "steps", "way", "ring"]]


def _contract(with_path: bool):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        return _follow(g["id"].to_numpy(object), g["parent"].to_numpy(object), g["steps"].to_numpy(np.int64), g["way"].tolist(), with_path)

    return run


def _solve(with_path: bool):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        got = _follow(g["id"].to_numpy(object), g["parent"].to_numpy(object), g["steps"].to_numpy(np.int64), g["way"].tolist(), with_path)
        return pd.DataFrame(
            {
                "id": got["id"],
                "root": got["exit"].where(~got["ring"], ""),
                "depth": got["steps"].where(~got["ring"], -1).astype(np.int32),
                "path": [[] if r else [e, *w] for r, e, w in zip(got["ring"], got["exit"], got["way"])] if with_path else got["way"],
            }
        )

    return run


def _draw(seed: int) -> Column:
    """Where a node goes: to its parent's place if a coin says so for both, else to its own. A parent of too many
    children draws only a share of them."""
    tails = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(2)) == 1
    heads = F.pmod(F.xxhash64(F.lit(seed), "parent"), F.lit(2)) == 0
    near = F.pmod(F.xxhash64(F.lit(seed + 1), "id"), F.greatest(F.lit(1), F.floor(F.col("fan") / NEAR_CHILDREN))) == 0
    return F.when(F.col("parent").isNotNull() & tails & heads & near, F.col("parent")).otherwise(F.col("id"))


def resolve_hierarchy(tree: DataFrame, with_path: bool = True, base_nodes: int = BASE_NODES) -> DataFrame:
    """Columns id, root, depth, path (ids from the root to the node) for ``tree(id, parent)``, one row for each id.

    A root is its own root with depth 0. A node on a ring, or below one, has root '', depth -1 and an empty path. With
    ``with_path=False`` paths are empty arrays and cost nothing. An empty tree gives no rows. Chains of any depth and
    parents with any number of children are solved; the last quotient has at most ``base_nodes`` nodes.
    """
    level = written(tree.select("id", "parent", F.lit(1).alias("steps"), F.array("id").alias("way")), "tree")
    handed: list[DataFrame] = []
    n, seed = level.count(), 0
    wide = int(tree.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while n > base_nodes or (n and not handed):
        fan = level.where("parent is not null").groupBy("parent").agg(F.count("*").alias("fan"))
        inner = level.join(fan.select(F.col("parent").alias("id")), "id", "left_semi")
        leaves = level.join(fan.select(F.col("parent").alias("id")), "id", "left_anti")
        tasks = max(2, wide, -(-n // TASK_NODES))
        spread = inner.join(fan, "parent", "left").withColumn("task", F.pmod(F.xxhash64(_draw(seed)), F.lit(tasks)))
        chains = written(spread.select("id", "parent", "steps", "way", "task").groupBy("task").applyInPandas(_contract(with_path), _CHAIN), "chains")
        exits = chains.where("not ring").select(F.col("exit").alias("id")).distinct()
        quotient = chains.where("not ring").join(exits, "id", "left_semi")
        own = F.col("exit") == F.col("id")
        level_up = quotient.select("id", F.when(~own, F.col("exit")).alias("parent"), "steps", F.when(own, F.array("id")).otherwise(F.col("way")).alias("way"))
        ring_exits = chains.where("ring").select("id", F.col("id").alias("parent"), F.lit(1).alias("steps"), F.array("id").alias("way"))
        ring_exits = ring_exits.join(exits, "id", "left_semi")  # a ring below which others lie stays a ring: its own parent
        upper = written(level_up.unionByName(ring_exits), "quotient")
        settled = chains.join(upper.select("id"), "id", "left_anti").select("id", F.when(~F.col("ring"), F.col("exit")).alias("exit"), "steps", "way")
        lone = leaves.select("id", F.coalesce("parent", "id").alias("exit"), F.when(F.col("parent").isNull(), 0).otherwise(F.col("steps")).alias("steps"), F.when(F.col("parent").isNull(), F.array().cast("array<string>")).otherwise(F.col("way")).alias("way"))
        handed.append((settled, lone))
        level, n, seed = upper, upper.count(), seed + 2
    solved = level.withColumn("task", F.lit(0)).groupBy("task").applyInPandas(_solve(with_path), _SOLVED)
    for settled, lone in reversed(handed):
        solved = _hand_down(written(solved, "solved"), settled, with_path)
        solved = _hand_down(written(solved, "solved"), lone, with_path)
    return solved


def _hand_down(solved: DataFrame, rows: DataFrame, with_path: bool) -> DataFrame:
    """Give ``rows(id, exit, steps, way)`` what is known of their exits. Exits nobody has solved are rings or, if a row
    is its own exit, roots."""
    up = solved.select(F.col("id").alias("exit"), "root", F.col("depth").alias("d"), F.col("path").alias("p"))
    j = rows.join(up, "exit", "left")
    is_root = F.coalesce(F.col("exit") == F.col("id"), F.lit(False)) & F.col("root").isNull()
    good = F.coalesce(F.col("d") >= 0, F.lit(False))
    none = F.array().cast("array<string>")
    path = F.when(is_root, F.array("id")).when(good, F.concat("p", "way")).otherwise(none) if with_path else none
    down = j.select(
        "id",
        F.when(is_root, F.col("id")).when(good, F.col("root")).otherwise("").alias("root"),
        F.when(is_root, 0).when(good, F.col("d") + F.col("steps")).otherwise(-1).cast("int").alias("depth"),
        path.alias("path"),
    )
    return solved.unionByName(down)


def descendants(resolved: DataFrame) -> DataFrame:
    """Pairs (ancestor_id, descendant_id, distance) below every node: each path is unfolded where it lies, no join."""
    steps = resolved.where("depth > 0").select(F.col("id").alias("descendant_id"), "depth", F.posexplode("path").alias("pos", "ancestor_id"))
    return steps.where("pos < depth").select("ancestor_id", "descendant_id", (F.col("depth") - F.col("pos")).alias("distance"))
