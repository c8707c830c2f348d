"""Dependency levels, ancestors and tree paths of name graphs, in few rounds.

Where a node has one parent, its way up is followed by pointer doubling: each round joins the
pointers with themselves, so the number of rounds is the logarithm of the depth.  The
closure squares in the same way.  Rounds are written to the shared folder, and only counts
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import stored

#: Relaxations of levels that one write takes.
UNROLLED = 3
#: Doublings of pointers that one write takes.
DOUBLED = 2


def _anchors(single: DataFrame) -> DataFrame:
    """``(node, up, d)`` of ``single(node, up)``, a parent for each node: ``up`` becomes the
    first node above that has no row itself, ``d`` steps up, and null above a cycle."""
    state = single.select("node", "up", F.lit(1).cast("long").alias("d"), F.lit(False).alias("through"))
    n, rounds, open_ = None, 0, True
    while open_ and (n is None or rounds <= n.bit_length()):
        for _ in range(DOUBLED):
            above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("d").alias("_d"), F.col("through").alias("_through"))
            met, end = ~F.col("through") & F.col("_d").isNotNull(), F.col("_d").isNull()
            state = state.join(above, "up", "left").select(
                "node", F.when(met, F.col("_up")).otherwise(F.col("up")).alias("up"), F.when(met, F.col("d") + F.col("_d")).otherwise(F.col("d")).alias("d"), (F.col("through") | end | F.col("_through")).alias("through")
            )
            rounds += 1
        state = stored(state, "pointers")
        now = state.agg(F.count("*").alias("n"), F.count(F.when(~F.col("through"), 1)).alias("open")).first()
        n, open_ = now["n"], now["open"]
    return state.select("node", F.when(F.col("through"), F.col("up")).alias("up"), "d")


def dependency_levels(nodes: DataFrame, edges: DataFrame, mode: str = "fail") -> DataFrame:
    """``(node, level)``: level 0 depends on nothing, level k on nodes of lower levels only.
    ``edges(node, dep)``.  A cycle is an error that lists some stuck nodes with what they wait
    for; in mode ``report`` stuck nodes have a null level.

    Nodes with one dependency lie a known number of levels above the first node below them
    that has several or none, so chains and trees take a logarithmic number of rounds.  The
    levels of nodes with several follow from those of the nodes that they rest on, UNROLLED
    rounds a write, over the edges of nodes that have none yet."""
    nodes = stored(nodes.select("node").distinct(), "nodes")
    deps = stored(edges.select("node", "dep").distinct().join(nodes, "node", "left_semi"), "edges")
    deps = deps.join(deps.groupBy("node").agg(F.count("*").alias("n")), "node")
    single = stored(deps.where("n = 1").select("node", F.col("dep").alias("up")), "single")
    anchors = _anchors(single)
    by = anchors.select(F.col("node").alias("dep"), F.col("up").alias("_up"), "d")
    # edges of nodes with several dependencies, to the nodes that decide them; null above a cycle
    several = deps.where("n > 1").select("node", "dep").join(by, "dep", "left")
    wait = stored(several.select("node", F.when(F.col("d").isNull(), F.col("dep")).otherwise(F.col("_up")).alias("dep"), (F.coalesce("d", F.lit(0)) + 1).alias("d")), "waits")
    levels = nodes.join(deps.select("node"), "node", "left_anti").withColumn("level", F.lit(0).cast("long"))
    while not wait.isEmpty():
        known = levels
        for _ in range(UNROLLED):
            met = wait.join(known.withColumnRenamed("node", "dep"), "dep", "left").groupBy("node")
            ready = met.agg(F.max(F.col("level") + F.col("d")).alias("level"), F.count(F.when(F.col("level").isNull(), 1)).alias("_open")).where("_open = 0").select("node", "level")
            known = levels.unionByName(ready)
        now = stored(known.join(levels.select("node"), "node", "left_anti"), "levels")
        if now.isEmpty():
            break
        levels = levels.unionByName(now)
        wait = stored(wait.join(now, "node", "left_anti"), "waits")
    above = anchors.select("node", "up", "d").join(levels.select(F.col("node").alias("up"), "level"), "up").select("node", (F.col("level") + F.col("d")).alias("level"))
    out = nodes.join(levels.unionByName(above), "node", "left").select("node", F.col("level").cast("int").alias("level"))
    out = stored(out, "levels")
    if mode == "fail":
        left = out.where("level IS NULL").select("node")
        if not left.isEmpty():
            waits = edges.select("node", "dep").distinct().join(left, "node", "left_semi").join(out.where("level IS NOT NULL").select(F.col("node").alias("dep")), "dep", "left_anti")
            stuck = waits.groupBy("node").agg(F.array_sort(F.collect_set("dep")).alias("deps")).orderBy("node").limit(20).collect()
            raise ValueError("stuck: " + "; ".join(f"{r.node} waits for {', '.join(map(str, r.deps))}" for r in stuck))
    return out


def ancestors(edges: DataFrame) -> DataFrame:
    """``(node, ancestor)``: all pairs of the transitive closure, each once; cycles end.

    A shortest way of more than 2^k steps begins with one of 2^k, which the last round
    found, so each round joins what is new with all pairs and doubles the length."""
    known = new = stored(edges.select("node", F.col("dep").alias("ancestor")).distinct(), "pairs")
    while not new.isEmpty():
        step = known.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("next"))
        found = new.join(step, "ancestor").select("node", F.col("next").alias("ancestor")).distinct()
        new = stored(found.join(known, ["node", "ancestor"], "left_anti"), "pairs")
        known = known.unionByName(new)
    return known


def tree_paths(edges: DataFrame, roots: DataFrame, max_depth: int = 100) -> DataFrame:
    """``(node, depth, path)`` of every node below ``roots(node)``; ``edges(node, parent)``
    is a forest.  Deeper than ``max_depth`` is an error.  A root below another root, and what
    is below both, has a row for each.

    Every node's path upwards doubles each round, up to ``max_depth`` and one."""
    most = max_depth + 2
    name = lambda c: F.col(c).cast("string")
    tree = edges.select("node", F.col("parent").alias("up"), F.array(name("parent"), name("node")).alias("path"))
    tops = roots.select("node").distinct().join(edges.select("node"), "node", "left_anti")
    paths = stored(tree.unionByName(tops.select("node", F.lit(None).cast(edges.schema["parent"].dataType).alias("up"), F.array(name("node")).alias("path"))), "tree")
    size = 1
    while size < most:
        above = paths.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"), F.lit(True).alias("_met"))
        joined = paths.join(above, "up", "left")
        whole = F.when(F.col("_met"), F.concat(F.slice("_path", 1, F.size("_path") - 1), "path")).otherwise(F.col("path"))
        cut = F.when(F.size(whole) > most, F.slice(whole, F.size(whole) - most + 1, most)).otherwise(whole)
        paths = stored(joined.select("node", F.when(F.col("_met") & (F.size(whole) < most), F.col("_up")).alias("up"), cut.alias("path")), "tree")
        size *= 2
        if paths.where("up IS NOT NULL").isEmpty():
            break
    named = roots.select(name("node").alias("_root")).distinct()
    at = paths.select("node", "path", F.posexplode("path").alias("_at", "_root")).join(named, "_root")
    out = stored(at.select("node", (F.size("path") - 1 - F.col("_at")).alias("depth"), F.slice("path", F.col("_at") + 1, F.size("path")).alias("path")), "tree")
    if not out.where(F.col("depth") > max_depth).isEmpty():
        raise ValueError(f"deeper than {max_depth}: the edges hold a cycle or max_depth is too small")
    return out
