"""Dominance join: for each demand the first of the offers with at least as much on every axis.

An equi-join can't find it and a join on inequalities compares everything with everything.
Here both sides are cut at quantiles of each axis into cells; the cut values themselves
are cells of their own.  For a demand, offers that have enough fall into two kinds:

* those in a greater cell on every axis: all of them have enough, so the first of them is a
  minimum over cells, read from a table of suffix minima of fixed size;
* those in the demand's own cell on some axis: they meet the demands of that cell (a slab)
  as a problem of its own, that holds a small part of the rows, or has one value on the
  axis, which then needs no more comparing.

Slabs that are still large are cut in the next round; small ones are solved in a task, by
sorting: the levels of a binary tree over each axis but the last, running minima along the
last.  A row goes to a slab for each axis and round, and rounds grow with the logarithm of
the number of rows; no two rows are compared but in sorting.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .positions import stored

#: Rows of a group that one task solves.
LIMIT = 1 << 16
#: Cells of the table of suffix minima, about.
CELLS = 1 << 15
#: Large groups (there are at most rows * axes ** round / LIMIT) are broadcast up to this many.
BROADCAST_GROUPS = 50_000
_NONE = (1 << 63) - 1


def _cuts(k: int) -> int:
    """Cut values of each of ``k`` axes: ``c`` of them make 2 * c + 1 cells."""
    return max(1, min(31, (round(CELLS ** (1 / k)) - 2) // 2))


def _cell(cuts: str, x: str):
    """The cell of a value: odd for a cut value, else even."""
    return 2 * F.size(F.filter(cuts, lambda c: c < F.col(x))) + F.array_contains(cuts, F.col(x)).cast("int")


def solve(group_o, values_o, rank, group_d, values_d, place, best) -> None:
    """Lower ``best[place]`` to the least ``rank`` of an offer of the demand's group with no
    smaller values.  ``values`` have a row for each axis."""
    import numpy as np

    n, m = len(rank), len(place)
    if not n or not m:
        return
    if len(values_o) == 1:
        # of equal values the offers come first
        order = np.lexsort((np.repeat((0, 1), (n, m)), -np.unique(np.concatenate([values_o[0], values_d[0]]), return_inverse=True)[1], np.concatenate([group_o, group_d])))
        group = np.concatenate([group_o, group_d])[order]
        head = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
        segment = np.repeat(np.arange(len(head)), np.diff(head, append=len(group)))
        # later segments get lower numbers, so that a running minimum starts anew in each
        top = int(rank.max()) + 2
        number = np.concatenate([rank, np.full(m, top - 1)])[order] + (len(head) - segment) * top
        least = np.minimum.accumulate(number) - (len(head) - segment) * top
        asks = order >= n
        at, found = place[order[asks] - n], least[asks]
        at, found = at[found < top - 1], found[found < top - 1]
        np.minimum.at(best, at, found)
        return
    steps = np.unique(values_o[0])
    node_o, node_d = np.searchsorted(steps, values_o[0]) + 1, np.searchsorted(steps, values_d[0])
    levels = len(steps).bit_length()
    for level in range(levels):
        # an offer is above a demand where, below a common prefix, their bits are 1 and 0
        o, d = np.flatnonzero(node_o >> level & 1), np.flatnonzero(~(node_d >> level) & 1)
        key_o, key_d = (group_o[o] << levels) + (node_o[o] >> level), (group_d[d] << levels) + (node_d[d] >> level) + 1
        met = np.intersect1d(key_o, key_d)
        keep_o, keep_d = np.isin(key_o, met), np.isin(key_d, met)
        o, d, at_o, at_d = o[keep_o], d[keep_d], np.searchsorted(met, key_o[keep_o]), np.searchsorted(met, key_d[keep_d])
        solve(at_o, [v[o] for v in values_o[1:]], rank[o], at_d, [v[d] for v in values_d[1:]], place[d], best)


def _numpy(table, name: str):
    import numpy as np

    return np.asarray(table.column(name).combine_chunks())


def _solved(offers: DataFrame, demands: DataFrame, axes: list[str]) -> DataFrame:
    """``(id, rank)`` of groups that a task holds."""

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        ids = _numpy(right, "id")
        best = np.full(len(ids), _NONE, dtype=np.int64)
        if left.num_rows and right.num_rows:
            zeros = lambda t: np.zeros(t.num_rows, dtype=np.int64)
            solve(zeros(left), [_numpy(left, x) for x in axes], _numpy(left, "rank"), zeros(right), [_numpy(right, x) for x in axes], np.arange(len(ids)), best)
        hit = best < _NONE
        return pa.table({"id": pa.array(ids[hit], pa.int64()), "rank": pa.array(best[hit], pa.int64())})

    return offers.groupBy("group").cogroup(demands.groupBy("group")).applyInArrow(run, "id long, rank long")


def _greater(offers: DataFrame, demands: DataFrame, k: int) -> DataFrame:
    """The first offer in greater cells, for each cell that holds demands; both sides have at
    most a row for each cell and group."""
    cells, width = [f"c{i}" for i in range(k)], 2 * _cuts(k) + 2

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        grid = np.full((width,) * k, _NONE, dtype=np.int64)
        out = np.full(right.num_rows, _NONE, dtype=np.int64)
        if left.num_rows and right.num_rows:
            np.minimum.at(grid, tuple(_numpy(left, c) for c in cells), _numpy(left, "rank"))
            for i in range(k):
                grid = np.flip(np.minimum.accumulate(np.flip(grid, i), axis=i), i)
            dead = int(_numpy(right, "dead")[0])  # there one cell holds all and has enough
            out = grid[tuple(_numpy(right, c) + (1 - (dead >> i & 1)) for i, c in enumerate(cells))]
        hit = pa.array(out < _NONE)
        return pa.table({**{c: right.column(c) for c in ("group", *cells)}, "rank": pa.array(out)}).filter(hit)

    schema = f"group string, {', '.join(f'{c} int' for c in cells)}, rank long"
    return offers.groupBy("group").cogroup(demands.groupBy("group")).applyInArrow(run, schema)


def first_dominating(offers: DataFrame, demands: DataFrame, axes: list[str]) -> DataFrame:
    """``(id, rank)``: for each of ``demands(group, *axes, id)`` the least rank of the
    ``offers(group, *axes, rank)`` of its group with no smaller value on any axis; demands
    without one are left out.

    ``group`` is text, axes are numbers, ids and ranks whole numbers.  A null is below every
    number, on both sides.  Repeated rows and ties are allowed."""
    k = len(axes)
    whole = {x: all(df.schema[x].dataType.typeName() in ("byte", "short", "integer", "long") for df in (offers, demands)) for x in axes}
    low = {x: F.lit(-(1 << 63)).cast("long") if whole[x] else F.lit(float("-inf")) for x in axes}

    def number(x):
        if whole[x]:
            return F.coalesce(F.col(x).cast("long"), low[x]).alias(x)
        value = F.col(x).cast("double")
        return F.coalesce(F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value), low[x]).alias(x)

    plain = lambda df, last: df.select("group", F.lit(0).alias("dead"), *map(number, axes), F.col(last).cast("long"))
    o, d, found = plain(offers, "rank"), plain(demands, "id"), []
    if o.select(F.lit(1)).union(d.select(F.lit(1))).count() <= LIMIT:
        return _solved(o, d, axes).groupBy("id").agg(F.min("rank").alias("rank"))
    o, d = stored(o, "axes"), stored(d, "axes")
    while True:
        sizes = o.select("group").union(d.select("group")).groupBy("group").agg(F.count("*").alias("n"))
        large = stored(sizes.where(F.col("n") > LIMIT).select("group"), "large")
        n = large.count()
        if not n:
            found.append(_solved(o, d, axes))
            break
        large = F.broadcast(large) if n <= BROADCAST_GROUPS else large
        found.append(_solved(o.join(large, "group", "left_anti"), d.join(large, "group", "left_anti"), axes))
        o, d = (df.join(large, "group", "left_semi") for df in (o, d))
        share = [i / (_cuts(k) + 1) for i in range(1, _cuts(k) + 1)]
        both = o.select("group", *axes).unionByName(d.select("group", *axes))
        cuts = stored(both.groupBy("group").agg(*(F.array_distinct(F.percentile_approx(x, share, 1000)).alias(f"cut{i}") for i, x in enumerate(axes))), "cuts")

        def celled(df, cuts=cuts, n=n):
            met = df.join(F.broadcast(cuts) if n <= BROADCAST_GROUPS else cuts, "group")
            cell = [_cell(f"cut{i}", x) for i, x in enumerate(axes)]
            return stored(met.select(*df.columns, *(F.when(F.expr(f"dead & {1 << i}") != 0, 0).otherwise(c).alias(f"c{i}") for i, c in enumerate(cell))), "cells")

        o, d = celled(o), celled(d)
        cells = [f"c{i}" for i in range(k)]
        table = _greater(o.groupBy("group", *cells).agg(F.min("rank").alias("rank")), d.select("group", "dead", *cells).distinct(), k)
        found.append(d.join(table, ["group", *cells]).select("id", "rank"))

        def slabs(df, last):
            at = F.array(*(F.struct(F.lit(i).alias("axis"), F.col(c).alias("cell")) for i, c in enumerate(cells)))
            open_ = F.filter(at, lambda a: F.col("dead").bitwiseAND(F.pow(F.lit(2), a["axis"]).cast("int")) == 0)
            cut = df.select("*", F.explode(open_).alias("s"))
            dead = F.when(F.col("s.cell") % 2 == 1, F.col("dead").bitwiseOR(F.pow(F.lit(2), F.col("s.axis")).cast("int"))).otherwise(F.col("dead"))
            return cut.select(F.concat_ws("/", "group", F.concat_ws(".", F.col("s.axis").cast("string"), F.col("s.cell").cast("string"))).alias("group"), dead.alias("dead"), *axes, last)

        o, d = stored(slabs(o, "rank"), "slabs"), stored(slabs(d, "id"), "slabs")
    return reduce(DataFrame.union, found).groupBy("id").agg(F.min("rank").alias("rank"))
