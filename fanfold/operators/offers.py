"""Offers and requests: the cheapest offer that satisfies a request.

A request has minima (null: no demand).  Many requests ask alike, so the search runs on
distinct demands, which meet the offers in a dominance join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import cpu_count, disk_gib, memory_mib
from .dominance import first_dominating
from .positions import stored, with_positions

AXES = ("memory_mb", "disk_gb", "cpu")
#: Fixed values of the default filters.
RELEASE, BARRED, TEST, LEAST_MEMORY, LEAST_CPU = "16.04", ("fpga", "hdd"), "test", 3072, 2
#: Sizes of the steps in which offers without prices are compared.
MEMORY_STEP, DISK_STEP = 1024, 16
#: Rows of pairs that a task sorts or groups at once.
PART_ROWS = 1 << 20


def parse_request(requests: DataFrame, memory: str = "memory", disks: str = "disks", cpu: str = "cpu", gpu: str = "gpu") -> DataFrame:
    """Request texts as the demands ``memory_mb, disk_gb, cpu, gpu``; a missing text is no
    demand, and a bad one an error.  The text columns go."""
    typed = {"memory_mb": memory_mib(memory), "disk_gb": disk_gib(disks), "cpu": cpu_count(cpu), "gpu": F.col(gpu).cast("boolean")}
    rest = [c for c in requests.columns if c not in (memory, disks, cpu, gpu)]
    return requests.select(*rest, *(c.alias(name) for name, c in typed.items()))


def offer_filter(offers: DataFrame) -> DataFrame:
    """Offers with the release and without a barred word in the name."""
    ok = F.exists("os", lambda o: o["release"] == RELEASE)
    for word in BARRED:
        ok = ok & ~F.contains("name", F.lit(word))
    return offers.where(ok)


def default_filter(offers: DataFrame) -> DataFrame:
    return offers.where(~F.contains("name", F.lit(TEST)) & (F.col("memory_mb") >= LEAST_MEMORY) & (F.col("cpu") >= LEAST_CPU))


def price_join(available: DataFrame, prices: DataFrame | None) -> DataFrame:
    """Offers with the price of their name; those without one go.  Without prices all cost 0."""
    if prices is None:
        return available.withColumn("price", F.lit(0.0))
    return available.drop("price").join(prices.select("name", "price"), "name")


def old_version(name: str = "name") -> Column:
    """Ties go to names of the second version."""
    return ~F.contains(name, F.lit("_v2"))


def choice_order() -> list[Column]:
    return [F.col("price"), old_version(), F.col("name")]


def order_offers(offers: DataFrame) -> DataFrame:
    return offers.orderBy(*choice_order())


def mask_prices(offers: DataFrame) -> DataFrame:
    """Prices replaced by their ranks 1..n, ties in the order of names."""
    ranked = with_positions(offers.select("name", "price"), [F.col("price"), F.col("name")], "rank")
    return offers.drop("price").join(ranked.select("name", (F.col("rank") + 1).alias("price")), "name")


def _ranked(offers: DataFrame, axes: tuple[str, ...], equal: tuple[str, ...]) -> DataFrame:
    """One offer for each combination of values, with its ``_rank`` in the order of choice."""
    distinct = offers.groupBy(*axes, *equal).agg(F.min_by(F.struct(*offers.columns), F.struct(*choice_order())).alias("o")).select("o.*")
    return with_positions(distinct, choice_order(), "_rank")


def skyline(offers: DataFrame, axes: tuple[str, ...] = AXES, equal: tuple[str, ...] = ()) -> DataFrame:
    """Offers that no other beats: at least as much on every axis, equal in ``equal``, and
    earlier in the order of choice; of offers alike in all of these, the first.  An offer with
    a null on an axis beats none and is beaten by none.

    An offer stays if the first of all offers that have as much as it has is the offer itself."""
    known = reduce(lambda a, b: a & b, (F.col(x).isNotNull() for x in axes))
    ranked = stored(_ranked(offers, axes, equal), "ranked")
    rows = ranked.where(known).select(F.to_json(F.struct(F.lit(0).alias("_"), *equal)).alias("group"), *axes, F.col("_rank").alias("rank"))
    first = first_dominating(rows, rows.withColumnRenamed("rank", "id"), list(axes))
    kept = ranked.join(first.where("id = rank").select(F.col("id").alias("_rank")), "_rank", "left_semi")
    return kept.unionByName(ranked.where(~known)).select(*offers.columns)


def cheapest_offer(requests: DataFrame, offers: DataFrame, axes: tuple[str, ...] = AXES, equal: tuple[str, ...] = (), mode: str = "fail") -> DataFrame:
    """Requests with ``offer``, the name of the cheapest fitting offer, ties to the second
    version, then by name.  ``offer_name`` in a request skips the search but must exist.
    No match: an error, or null with ``mode='report'``.

    Distinct demands meet the offers in a dominance join.  A demand that leaves an ``equal``
    column open goes to a group in which offers of all its values are."""
    named = "offer_name" in requests.columns
    demand = [*axes, *equal]
    ranked = stored(_ranked(offers, axes, equal), "ranked")
    asked = stored(requests.select(*demand).distinct().withColumn("_id", F.monotonically_increasing_id()), "asked")
    group_o, group_d = [], F.lit(None).cast("string")
    for open_ in range(1 << len(equal)):
        fixed = [x for i, x in enumerate(equal) if not open_ >> i & 1]
        key = lambda value, f=fixed, m=open_: F.to_json(F.struct(F.lit(m).alias("_"), *(value(x).alias(x) for x in f)))
        given = lambda cond, f=fixed: reduce(lambda a, b: a & b, (cond(x) for x in f), F.lit(True))
        group_o.append(F.when(given(lambda x: F.col(x).isNotNull()), key(F.col)))
        fits = given(lambda x: F.col(x).isNotNull()) & reduce(lambda a, b: a & b, (F.col(x).isNull() for x in equal if x not in fixed), F.lit(True))
        group_d = F.when(fits, key(lambda x: F.col(x).cast(offers.schema[x].dataType))).otherwise(group_d)
    sides = ranked.select(F.explode(F.array(*group_o)).alias("group"), *axes, F.col("_rank").alias("rank")).where("group IS NOT NULL")
    first = first_dominating(sides, asked.select(group_d.alias("group"), *axes, F.col("_id").alias("id")), list(axes))
    won = first.join(ranked.select(F.col("_rank").alias("rank"), F.col("name").alias("offer")), "rank").select("id", "offer")
    found = asked.join(won, F.col("_id") == F.col("id")).select(*(F.col(x).alias(f"_{x}") for x in demand), "offer")
    same = F.lit(True)
    for x in demand:
        same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
    out = requests.join(found, same, "left").drop(*(f"_{x}" for x in demand))
    if named:
        known = offers.select(F.col("name").alias("_known")).distinct()
        out = out.join(known, F.col("offer_name") == F.col("_known"), "left").withColumn("offer", F.when(F.col("offer_name").isNotNull(), F.col("_known")).otherwise(F.col("offer"))).drop("_known")
    if mode == "report":
        return out
    return out.withColumn("offer", F.coalesce("offer", F.raise_error(F.lit("no offer satisfies a request"))))


def dealt(df: DataFrame, n_rows: int, key: str) -> DataFrame:
    """``df`` in as many parts by ``key`` as ``n_rows`` rows need, so that what a task sorts
    or groups doesn't grow with the table; as it is where the session's shuffle partitions
    are enough."""
    n = n_rows // PART_ROWS + 1
    return df.repartition(n, key) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def dominated(pairs: DataFrame, offers: DataFrame, a: str = "a", b: str = "b", n_pairs: int = 0) -> DataFrame:
    """Add ``leq``: offer ``a`` has at most what offer ``b`` has, on all axes; false for an
    unknown name.  ``n_pairs``, a bound on the rows of ``pairs``, keeps the tasks of large
    tables small."""
    left = offers.select(F.col("name").alias(a), *(F.col(x).alias(f"_a_{x}") for x in AXES))
    right = offers.select(F.col("name").alias(b), *(F.col(x).alias(f"_b_{x}") for x in AXES))
    leq = F.lit(True)
    for x in AXES:
        leq = leq & (F.col(f"_a_{x}") <= F.col(f"_b_{x}"))
    met = dealt(dealt(pairs, n_pairs, a).join(left, a, "left"), n_pairs, b).join(right, b, "left")
    return met.withColumn("leq", F.coalesce(leq, F.lit(False))).select(*pairs.columns, "leq")


def minimal_offer(requests: DataFrame, offers: DataFrame, mode: str = "fail") -> DataFrame:
    """Without prices: the least fitting offer by steps of memory and disk, then cpu, then
    name; a fixed order where the steps alone don't decide."""
    steps = F.floor(F.col("memory_mb") / MEMORY_STEP) + F.floor(F.col("disk_gb") / DISK_STEP) + F.col("cpu")
    return cheapest_offer(requests, offers.withColumn("price", steps.cast("double")), mode=mode)
