"""Mix sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (by digest of the id) into one token stream,
repeated as often as its slots ask, and cut into blocks of equal token counts.
A schedule of slots names the source of each block: slot ``n`` takes the golden
ratio point ``frac((n + 1) * phi)``, which falls into one interval of the
cumulated weights.  The slots of a source are ranked, and the slot of rank ``r`` meets
block ``r`` in a join.  The schedule alone decides how many blocks a source gives and
where they stand: sources stay evenly interleaved at every length of the mix, each
within a few blocks of its share (the discrepancy of the points grows with the
logarithm of their number).

Running counts never gather a source in one task: they are summed per digest
bucket (documents) or per run of slots (schedule), the few sums are accumulated,
and ranks inside a bucket or run start there.  Only the table of sources, a row
for each, is ordered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

#: A block has this many tokens, or fewer so that the mix has MIN_SLOTS slots at least.
BLOCK_TOKENS, MIN_SLOTS = 64, 1 << 18
#: Documents of a source are dealt to 16**BUCKET_HEX digest buckets.
BUCKET_HEX = 3
#: Slots whose ranks are counted together.
RUN = 1 << 16
#: Equal cells of [0, 1) in which a slot looks for its interval.
CELLS = 1024
GOLDEN = (math.sqrt(5) - 1) / 2


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``(sid, source, source_size, target)`` from one row ``(source, source_size)``
    per source.

    Sources in order of code points, null last, weigh ``weights``, repeating.  They
    split ``share`` times the sum of all sizes; no target passes ``cap`` times its
    source, and what a capped source can't use goes to the others by weight.  That
    split has one common level: a target is ``min(cap * size, level * weight)``."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("sid", F.row_number().over(everything)).withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("sid") - 1) % len(weights) + 1))
    by_ratio = Window.orderBy("ratio", "sid")
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("most", cap * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("w"))
        .withColumn("capped_before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (share * F.sum("source_size").over(whole) - F.col("capped_before")) / F.col("open_weight"))
    )
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "sid", "level"))).over(whole)["level"]
    return levels.withColumn("final", level).select("sid", "source", "source_size", F.least(F.col("most"), F.coalesce(F.col("final") * F.col("w"), F.col("most"))).alias("target"))


def token_stream(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with their place ``[a, a + size)`` in the shuffled stream of their
    source; ``sized`` has ``(doc_id, source, size)``.  ``(sid, bucket, rn)`` tells
    rows apart, also repeated ones."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = sized.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "size", "sid", "source_size", "target", "until", digest.alias("digest"))
    rows = rows.withColumn("bucket", F.substring("digest", 1, BUCKET_HEX))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("sid", "bucket").orderBy("digest", "doc_id", "size")
    placed = rows.withColumn("rn", F.row_number().over(inside)).withColumn("inner", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return placed.join(sums.select("sid", "bucket", before.alias("base")), ["sid", "bucket"]).withColumn("a", F.col("base") + F.col("inner")).drop("base", "inner", "digest")


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """``(slot, sid, rank)``: the source of each slot and the slot's rank in it."""
    spark = sources.sparkSession
    order = Window.orderBy("sid")
    share = F.col("target") / F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    bounds = (
        sources.where("target > 0")
        .withColumn("share", share)
        .withColumn("hi", F.sum("share").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0.0)))
        .withColumn("hi", F.when(F.lead("sid").over(order).isNull(), 2.0).otherwise(F.col("hi")))
        .select("sid", "lo", "hi")
    )
    cell = lambda x: F.least(F.lit(CELLS - 1), F.floor(x * CELLS)).cast("int")
    cells = bounds.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    slots = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("u", point - F.floor(point)).withColumn("cell", cell(F.col("u")))
    drawn = slots.join(cells, "cell").where("lo <= u AND u < hi").select("slot", "sid", F.floor(F.col("slot") / RUN).alias("run"))
    counts = drawn.groupBy("sid", "run").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot")) - 1
    ranked = drawn.withColumn("inner", inner).join(counts.select("sid", "run", before.alias("base")), ["sid", "run"])
    return ranked.select("slot", "sid", (F.col("base") + F.col("inner")).alias("rank"))


def pieces(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, block_tokens: int | None = None, heads: bool = False) -> DataFrame:
    """``(sid, bucket, rn, doc_id, size, source_size, target, pass, slot, start, end)``: the
    mix, a row for each document's part in a slot, with the words ``[start, end)`` of the
    document; ``pass`` counts how often its source's stream has been repeated.  Rows that
    the mix takes nothing of stay once, with null ``slot``; ``(sid, bucket, rn)`` tells
    rows of ``docs(doc_id, text, source)`` apart.  A source ends at ``cap`` times its size,
    should its slots ask for more.

    ``heads`` leaves the pieces of a document in one pass together, as one row with the
    slot where they begin, for callers that don't cut documents at slots.  Without
    ``block_tokens`` a block has ``BLOCK_TOKENS`` words, or as few as ``MIN_SLOTS`` slots
    ask for.  Larger blocks make fewer slots; a source stays within a few blocks of its
    target."""
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = stored(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    total = sources.agg(F.sum("target")).first()[0] or 0
    block = block_tokens or max(1, min(BLOCK_TOKENS, int(total / MIN_SLOTS)))
    slots = stored(schedule(sources, math.ceil(total / block)), "slots")
    given = slots.groupBy("sid").agg(F.count("*").alias("blocks"))
    until = F.least(F.coalesce("blocks", F.lit(0)) * block, F.floor(cap * F.col("source_size"))).cast("long").alias("until")
    sources = sources.join(given, "sid", "left").select("sid", "source", "source_size", "target", until)
    rows = token_stream(sized, sources)
    passes = F.when((F.col("until") > 0) & (F.col("size") > 0), F.sequence(F.lit(0).cast("long"), F.expr("(until - 1) div source_size")))
    rows = rows.withColumn("pass", F.explode_outer(passes)).withColumn("from", F.col("a") + F.col("pass") * F.col("source_size")).withColumn("to", F.least(F.col("from") + F.col("size"), F.col("until")))
    first, last = F.expr(f"`from` div {block}"), F.expr(f"(`to` - 1) div {block}")
    taken = F.col("from") < F.col("to")
    # a pass that its source's end cuts off leaves no row but the document's first
    rows = rows.where("`pass` IS NULL OR `pass` = 0 OR `from` < `to`").withColumn("rank", F.when(taken, first) if heads else F.explode_outer(F.when(taken, F.sequence(first, last))))
    met = rows.join(slots, ["sid", "rank"], "left")
    if heads:
        return met.select("sid", "bucket", "rn", "doc_id", "size", "source_size", "target", "pass", "slot", F.lit(0).cast("long").alias("start"), (F.col("to") - F.col("from")).alias("end"))
    start = F.greatest(F.col("from"), F.col("rank") * block) - F.col("from")
    end = F.least(F.col("to"), (F.col("rank") + 1) * block) - F.col("from")
    return met.select("sid", "bucket", "rn", "doc_id", "size", "source_size", "target", "pass", "slot", start.alias("start"), end.alias("end"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, block_tokens: int | None = None) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, first_slot)`` per row of ``docs(doc_id,
    text, source)``: ``taken`` counts the words that the mix takes of the document, and
    ``first_slot`` is where the first of them stand.

    Null and empty texts have size 0 and are never taken; texts of any length are counted
    whole; null sources are a source of their own, the last; repeated rows each have their
    own place, and ties in the shuffle are broken by id and size.  Further columns are not
    read.  An empty table gives an empty result.  Runs agree, as the shuffle is a digest order."""
    words = F.when(F.col("slot").isNotNull(), F.col("end") - F.col("start"))
    out = pieces(docs, weights, share, cap, block_tokens, heads=True).groupBy("sid", "bucket", "rn", "doc_id", "size", "source_size", "target")
    return out.agg(F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("taken"), F.min("slot").alias("first_slot")).drop("sid", "bucket", "rn")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][(sid - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS most, 2.0::DOUBLE * source_size / [3.0, 1.0, 2.0][(sid - 1) % 3 + 1]::DOUBLE AS ratio FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY ratio, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
targets AS (
  SELECT sid, source, source_size, least(most, w * (SELECT arg_min(level, (ratio, sid)) FROM levels WHERE level <= ratio)) AS target FROM levels),
whole AS (SELECT greatest(1, least(64, floor(sum(target) / 262144)::BIGINT)) AS block, sum(target) AS total FROM targets),
shares AS (SELECT sid, sum(target / (SELECT total FROM whole)) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) AS hi FROM targets WHERE target > 0),
bounds AS (SELECT sid, coalesce(lag(hi) OVER (ORDER BY sid), 0.0) AS lo, CASE WHEN lead(sid) OVER (ORDER BY sid) IS NULL THEN 2.0 ELSE hi END AS hi FROM shares),
points AS (
  SELECT n AS slot, (n + 1) * 0.6180339887498949::DOUBLE - floor((n + 1) * 0.6180339887498949::DOUBLE) AS u
  FROM (SELECT unnest(range(0, (SELECT ceil(total / block)::BIGINT FROM whole))) AS n)),
slots AS (SELECT slot, sid, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS rank FROM points JOIN bounds ON lo <= u AND u < hi),
given AS (SELECT sid, count(*) AS blocks FROM slots GROUP BY sid),
placed AS (
  SELECT doc_id, size, t.sid, source_size, target, least(coalesce(blocks, 0) * (SELECT block FROM whole), 2 * source_size)::BIGINT AS until,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN given g ON g.sid = t.sid)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
    (until // source_size) * size + greatest(0, least(a + size, until % source_size) - a) END::BIGINT AS taken,
  CASE WHEN size > 0 AND a < until THEN s.slot END AS first_slot
FROM placed p LEFT JOIN slots s ON s.sid = p.sid AND s.rank = p.a // (SELECT block FROM whole)
"""
