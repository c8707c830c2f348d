"""I-Match fingerprints of documents, on built-in expressions only.

Terms count their documents in one grouped aggregation; those within a band of
inverse document frequency form the lexicon.  Each lexicon term belongs to some of
SUBSETS randomised subsets, told by a hash of the term and the subset.  A
fingerprint holds, for each subset, a hash of the sequence of the document's distinct
terms in it, sorted, and last a hash of all distinct terms in order, which alone speaks
for texts without lexicon terms.  Dense subsets tell near texts apart; sparse ones, which
hold a term or two of a text, outlive large edits.

The band is relative to the number of documents, so at most (mean distinct terms /
least share) terms are in it at any corpus size; that bound is checked before the
lexicon is broadcast, and beyond ``BROADCAST_TERMS`` it is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored, words

#: Share of documents that hold a lexicon term: the band of document frequency.
LEAST_SHARE, MOST_SHARE = 0.001, 0.1
#: Share of the lexicon in each subset.
RATES = (1 / 8,) * 4 + (1 / 32,) * 4 + (1 / 64,) * 8 + (1 / 128,) * 8 + (1 / 256,) * 8
SUBSETS = len(RATES)
BROADCAST_TERMS = 2_000_000
#: Ids are dealt to runs by this many quantiles, each cut into equal steps.
QUANTILES, RUN_ROWS = 256, 20_000


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-case words of a text."""
    return F.array_distinct(F.transform(words(F.lower(text)), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", n_docs: int | None = None) -> DataFrame:
    """``(term, subsets)``: hashes of the terms within the band, and a bit for each
    subset that a term belongs to; the hash 0 stands for no term and has no bits."""
    n_docs = docs.count() if n_docs is None else n_docs
    held = docs.select(F.explode(terms(F.coalesce(F.col(text_col), F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    within = held.where(F.col("df").between(LEAST_SHARE * n_docs, max(1.0, MOST_SHARE * n_docs))).where("term <> 0")
    bit = lambda j: F.when(F.pmod(F.xxhash64("term", F.lit(j)), F.lit(1 << 20)) < int(RATES[j] * (1 << 20)), F.lit(1 << j).cast("long")).otherwise(F.lit(0).cast("long"))
    bits = bit(0)
    for j in range(1, SUBSETS):
        bits = bits.bitwiseOR(bit(j))
    none = docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("term"), F.lit(0).cast("long").alias("subsets"))
    return within.select("term", bits.alias("subsets")).unionByName(none)


def fingerprints(rows: DataFrame, keys: list[str], text_cols: list[str], lex: DataFrame, lex_size: int) -> DataFrame:
    """``keys`` and ``which`` (place in ``text_cols``) with ``parts``: the SUBSETS + 1
    hashes of a fingerprint; 0 where a subset has none of the terms."""
    # the hash of all terms is made before the terms become rows: behind the generator Spark would make it for each
    whole = lambda x: F.when(F.size(x) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.sort_array(x)))
    text = lambda i, c: let(terms(F.col(c)), lambda x: F.struct(F.lit(i).alias("which"), F.concat(F.array(F.lit(0).cast("long")), x).alias("terms"), whole(x).alias("whole")))
    texts = rows.select(*keys, F.explode(F.array(*(text(i, c) for i, c in enumerate(text_cols)))).alias("e"))
    long = texts.select(*keys, "e.which", "e.whole", F.explode("e.terms").alias("term"))
    met = long.join(F.broadcast(lex) if lex_size <= BROADCAST_TERMS else lex, "term")
    # a text's own lexicon terms come together, no more than it has words
    held = F.sort_array(F.collect_list(F.when(F.col("subsets") != 0, F.struct("term", "subsets")))).alias("held")
    within = lambda j: F.filter("held", lambda x: x["subsets"].bitwiseAND(F.lit(1 << j).cast("long")) != 0)
    hashed = lambda j: let(within(j), lambda x: F.when(F.size(x) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(x["term"])))
    return met.groupBy(*keys, "which", "whole").agg(held).select(*keys, "which", F.array(*(hashed(j) for j in range(SUBSETS)), "whole").alias("parts"))


def text_of(parts: Column) -> Column:
    """A fingerprint as text: a hexadecimal number for each subset, then for all terms."""
    return F.array_join(F.transform(parts, lambda x: F.lower(F.hex(x))), "-")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those that aren't empty on both sides."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: ((x == y) & (x != 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    full = F.aggregate(F.zip_with(a, b, lambda x, y: ((x != 0) | (y != 0)).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(full == 0, F.lit(1.0)).otherwise(same / full)


def runs_of(ids: DataFrame, id_col: str, n_docs: int, n_null: int):
    """A Column that numbers runs of neighbouring ids: quantiles of the ids, each cut
    into equal steps so that a run has about RUN_ROWS ids; null ids come last, cut by the
    digest of their texts."""
    bounds = sorted(set(ids.approxQuantile(id_col, [i / QUANTILES for i in range(QUANTILES + 1)], 0.0005))) if n_docs else []
    steps = max(1, n_docs // (QUANTILES * RUN_ROWS))
    last = (len(bounds) + 1) * steps
    null_run = F.lit(last) + F.floor((F.shiftrightunsigned("digest", 16) / float(1 << 48)) * max(1, n_null // RUN_ROWS))
    if len(bounds) < 2:
        return F.when(F.col(id_col).isNull(), null_run).otherwise(F.lit(0)).cast("long")
    edges = F.array(*map(F.lit, bounds))
    cell = F.size(F.filter(edges, lambda b: b <= F.col(id_col)))
    low, high = F.get(edges, cell - 1), F.get(edges, cell)
    step = F.when(low.isNull() | high.isNull(), 0).otherwise(F.least(F.lit(steps - 1), F.floor((F.col(id_col) - low) / (high - low) * steps)))
    return F.when(F.col(id_col).isNull(), null_run).otherwise(cell * steps + step).cast("long")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(run, rn, id, text, next_text)``: each document and the text of the next by
    ascending id (equal ids by digest of the text, null ids last), after the last the
    first.  Runs are ordered apart from each other; a run's last row gets the first text
    of the next run, of which there is one for each run."""
    n_docs, n_null = docs.agg(F.count("*"), F.count_if(F.col(id_col).isNull())).first()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("digest", F.xxhash64("text"))
    base = base.withColumn("run", runs_of(base.select("id"), "id", n_docs, n_null))
    rows = base.withColumn("digest", F.shiftrightunsigned("digest", 1))
    order = Window.partitionBy("run").orderBy(F.col("id").asc_nulls_last(), "digest")
    placed = rows.withColumn("rn", F.row_number().over(order)).withColumn("lead", F.lead("text").over(order)).drop("digest")
    heads = stored(base.select("run", "id").groupBy("run").agg(F.min("id").alias("head")), "heads")
    all_heads = Window.orderBy("run")
    # of the heads' texts the one with the least digest comes first
    first = rows.withColumnRenamed("run", "own").join(heads.select(F.col("run").alias("h_run"), F.col("head").alias("h")), (F.col("own") == F.col("h_run")) & F.col("id").eqNullSafe(F.col("h")))
    first = first.groupBy("own").agg(F.min_by("text", "digest").alias("head_text"))
    order_of = heads.select(F.col("run"), F.coalesce(F.lead("run").over(all_heads), F.first("run").over(all_heads)).alias("own"))
    fetch = order_of.join(first, "own").select("run", "head_text")
    return placed.join(fetch, "run").select("run", "rn", "id", "text", F.coalesce("lead", "head_text").alias("next_text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)`` per row of ``docs``.

    The edited text replaces the last floor(n_chars / 2) code points by the first as
    many of the next document.  Null texts are empty; texts without any word have a
    fingerprint of zeros, and two such are alike (1.0).  Texts of any length are hashed
    whole.  Rows of one id are ordered by digest of the text, so repeated rows follow each
    other; null ids come last.  Further columns are not read; an empty table gives an
    empty result."""
    lex = stored(lexicon(docs, text_col), "lexicon")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = with_next(docs, id_col, text_col)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = pairs.select("run", "rn", "id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["run", "rn", "id", "n_chars", "edited_sha256"]
    hashed = fingerprints(rows, keys, ["text", "edited"], lex, lex.count())
    side = lambda i: F.max(F.when(F.col("which") == i, F.col("parts"))).alias(f"f{i}")
    both = stored(hashed.groupBy(*keys).agg(side(0), side(1)), "fingerprints")
    order = Window.partitionBy("run").orderBy("rn")
    heads = both.where("rn = 1").select("run", "f0")
    all_heads = Window.orderBy("run")
    following = heads.select("run", F.coalesce(F.lead("f0").over(all_heads), F.first("f0").over(all_heads)).alias("after"))
    done = both.withColumn("lead", F.lead("f0").over(order)).join(following, "run").withColumn("next", F.coalesce("lead", "after"))
    return done.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        text_of(F.col("f0")).alias("fingerprint"),
        text_of(F.col("f1")).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1")).alias("near_edited"),
        likeness(F.col("f0"), F.col("next")).alias("near_next"),
    )
