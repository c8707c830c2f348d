"""The dominance join and what stands on it, against comparing all with all."""

import random

import pytest
from pyspark.sql import functions as F

from fanfold.operators import dominance, offers


def low(x):
    return float("-inf") if x is None else x


def first_of(offer_rows, demand):
    """Least rank of an offer of the demand's group with enough on every axis."""
    return min((o[-1] for o in offer_rows if o[0] == demand[0] and all(low(a) >= low(b) for a, b in zip(o[1:-1], demand[1:-1]))), default=None)


@pytest.mark.parametrize("axes,limit", [(1, 20), (2, 20), (3, 12), (3, 1 << 16)])
def test_first_dominating_equals_brute_force(spark, monkeypatch, axes, limit):
    monkeypatch.setattr(dominance, "LIMIT", limit)
    monkeypatch.setattr(dominance, "CELLS", 60)
    random.seed(axes * limit)
    hot = lambda: random.choice([5, 5, 5, random.randrange(30), None])
    value = lambda i: hot() if i else random.choice([None, random.random(), 0.5, float(random.randrange(3))])
    o = [(random.choice("gggh"), *(value(i) for i in range(axes)), r) for r in range(120)]
    d = [(random.choice("gggk"), *(value(i) for i in range(axes)), i) for i in range(90)]
    names = [f"x{i}" for i in range(axes)]
    kinds = ", ".join(f"{n} {'int' if i else 'double'}" for i, n in enumerate(names))
    got = dominance.first_dominating(spark.createDataFrame(o, f"group string, {kinds}, rank int"), spark.createDataFrame(d, f"group string, {kinds}, id long"), names)
    assert {r.id: r.rank for r in got.collect()} == {x[-1]: r for x in d if (r := first_of(o, x)) is not None}


def test_empty_sides(spark):
    kinds = "group string, x int"
    one = [("g", 1, 1)]
    for o, d in (([], one), (one, []), ([], [])):
        assert dominance.first_dominating(spark.createDataFrame(o, kinds + ", rank int"), spark.createDataFrame(d, kinds + ", id int"), ["x"]).collect() == []


OFFER = "name string, memory_mb int, disk_gb int, cpu int, price double, gpu boolean"


def random_offers(n):
    size = lambda: random.choice([None, *range(6)])
    return [(f"o{i}{random.choice(['', '_v2'])}", size(), size(), size(), random.choice([None, 1.0, 2.0, 3.0]), random.choice([None, True, False])) for i in range(n)]


def order(o):
    return (o[4] is not None, o[4] or 0, "_v2" not in o[0], o[0])


@pytest.mark.parametrize("limit", [25, 1 << 16])
def test_skyline_and_cheapest_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(dominance, "LIMIT", limit)
    random.seed(limit)
    o = random_offers(80)
    df = spark.createDataFrame(o, OFFER)
    for equal in ((), ("gpu",)):
        beats = lambda b, a, e=equal: all(x is not None and y is not None and x >= y for x, y in zip(b[1:4], a[1:4])) and (not e or a[5] == b[5]) and order(b) < order(a)
        firsts = {}
        for x in sorted(o, key=order):
            firsts.setdefault((x[1:4], x[5] if equal else None), x)
        want = {a[0] for a in firsts.values() if not any(beats(b, a) for b in firsts.values())}
        assert {r.name for r in offers.skyline(df, equal=equal).collect()} == want
        asks = [(i, *(random.choice([None, *range(7)]) for _ in range(3)), random.choice([None, True, False])) for i in range(60)]
        fits = lambda o, r, e=equal: all(q is None or (p is not None and p >= q) for p, q in zip(o[1:4], r[1:4])) and (not e or r[4] is None or o[5] == r[4])
        got = offers.cheapest_offer(spark.createDataFrame(asks, "id int, memory_mb int, disk_gb int, cpu int, gpu boolean"), df, equal=equal, mode="report")
        assert {r.id: r.offer for r in got.collect()} == {r[0]: min((x for x in o if fits(x, r)), key=order, default=(None,))[0] for r in asks}


def test_no_join_on_inequalities(spark):
    df = spark.createDataFrame(random_offers(20), OFFER)
    for out in (offers.skyline(df), offers.cheapest_offer(df.drop("name", "price"), df, equal=("gpu",), mode="report")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_hot_value_on_every_axis_ends(spark, monkeypatch):
    monkeypatch.setattr(dominance, "LIMIT", 50)
    same = spark.range(400).select(F.lit("g").alias("group"), F.lit(7).alias("x"), F.lit(1).alias("y"), F.col("id"))
    got = dominance.first_dominating(same.withColumnRenamed("id", "rank"), same, ["x", "y"]).collect()
    assert len(got) == 400 and {r.rank for r in got} == {0}
