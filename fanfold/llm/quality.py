"""Quality rules of texts, and lines that many documents of a host share.

Everything runs on built-in expressions.  The counts inside one text (repeated
lines, five-word windows) never leave its row.  The line rule hashes normalised
lines, counts the distinct documents of each (host, line) in a two-step
aggregation, and takes away lines above the limit; a document that keeps too
little is rejected.  Copies of one text count as one document: a page stored twice
is a matter for duplicate removal and doesn't make its lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, let, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Fixed values of the base rules.
MIN_WORDS, REPEAT_PERCENT = 10, 20
#: A line is boilerplate on a host if more distinct documents than this hold it.
MAX_DOCS_PER_LINE = 10
#: A document is depleted if fewer words than this are left, or less than this share.
MIN_WORDS_LEFT, MIN_SHARE_LEFT = 5, 0.3


def without(text: Column, chars: str) -> Column:
    for c in chars:  # one scan of the bytes each, much faster than a look-up per character
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def duplicate_lines(lines: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    full = F.filter(lines, lambda x: without(x, SPACE_CHARS) != "")
    return let(full, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def window_hashes(h: Column) -> Column:
    """Hashes of the five-element windows of a bound array of hashed words, by way
    of windows of two and of four."""
    pair = lambda a, b: F.xxhash64(a, b)
    joined = lambda x, y, by, body: let(F.zip_with(F.slice(x, 1, F.size(y) - by), F.slice(y, by + 1, F.size(y)), pair), body)
    two = lambda body: joined(h, h, 1, body)
    return two(lambda x: joined(x, x, 2, lambda y: F.zip_with(F.slice(y, 1, F.size(h) - 4), F.slice(h, 5, F.size(h)), pair)))


def repeated_words(h: Column) -> Column:
    """``h``: a bound array of hashed words.  Number of words inside five-word windows
    that it holds twice or more.  Where windows repeat at all, sort (hash, place), keep
    the places with an equal neighbour, and add up what they cover in order."""
    places = lambda w: F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    shared = lambda s: F.filter(
        F.transform(s, lambda x, i: F.when((F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"])), lambda x: x.isNotNull()
    )
    covered = lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    repeated = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(let(let(places(w), lambda s: F.sort_array(shared(s))), lambda p: covered(p)))
    return F.when(F.size(h) > WINDOW, let(window_hashes(h), repeated)).otherwise(0)


def base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and
    base_failed to ``docs``.  A null text has no words, and fails."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumn(
        "_w", let(words(t), lambda w: F.struct(F.size(w).alias("n"), let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: repeated_words(h)).alias("r")))
    )
    long = lambda c: c.cast("long")
    out = counted.select(
        *docs.columns,
        long(F.col("_w.n")).alias("n_words"),
        long(F.length(without(t, SPACE_CHARS))).alias("word_chars"),
        long(F.length(t) - F.length(without(t, SYMBOLS))).alias("n_symbols"),
        long(duplicate_lines(F.split(t, "\n"))).alias("n_dup_lines"),
        long(F.col("_w.r")).alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``(id, doc, host, line, n, pos)``: each normalised line that isn't empty, with
    its number of words; ``doc`` is the digest of the whole text."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.transform(F.split(t, "\n"), normal_line), lambda x: x != "")
    hashed = F.transform(lines, lambda x, i: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n"), i.alias("pos")))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("doc"), F.xxhash64(host_col).alias("host"), F.explode(hashed).alias("l"))
    return base.select("id", "doc", "host", "l.line", "l.n", "l.pos")


def words_in_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """``(id, doc, lost)``: words of each text that stand in lines held by more than
    ``max_docs`` distinct texts of its host; texts that lose none are left out."""
    rows = stored(line_rows(docs, id_col, text_col, host_col), "lines")
    # one row for each (host, line, text), then one for each (host, line): copies count once
    frequent = rows.select("host", "line", "doc").distinct().groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > max_docs).select("host", "line")
    met = rows.join(frequent, ["host", "line"]).select("id", "doc", "pos", "n")
    # repeated rows bring each line again
    return met.repartition("id", "doc").dropDuplicates(["id", "doc", "pos"]).groupBy("id", "doc").agg(F.sum("n").alias("lost"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_docs: int = MAX_DOCS_PER_LINE) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_words_left, kept)`` per row of ``docs``.

    ``kept`` is false where the base rules fail and where the line rule leaves fewer
    than MIN_WORDS_LEFT words or less than MIN_SHARE_LEFT of them.  A null text has no
    words and fails; repeated rows get the same verdict; null hosts are one host; rows
    with a null id keep their counts by their text."""
    per_row = base_rules(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "t")
    per_row = per_row.withColumn("doc", F.xxhash64(F.coalesce("t", F.lit("")))).drop("t")
    lost = words_in_boilerplate(docs, id_col, text_col, host_col, max_docs).withColumnsRenamed({"id": "lost_id", "doc": "lost_doc"})
    met = per_row.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("doc") == F.col("lost_doc")), "left")
    out = met.withColumn("n_words_left", F.col("n_words") - F.least(F.col("n_words"), F.coalesce("lost", F.lit(0))))
    enough = (F.col("n_words_left") >= MIN_WORDS_LEFT) & (F.col("n_words_left") >= MIN_SHARE_LEFT * F.col("n_words"))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_left", (~F.col("base_failed") & enough).alias("kept"))


JUDGE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, ws[i:i+4] AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d),
full_lines AS (SELECT rid, x FROM raw WHERE translate(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') <> ''),
dl AS (SELECT rid, (count(*) - count(DISTINCT x))::BIGINT AS n FROM full_lines GROUP BY rid),
norm AS (SELECT rid, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS x FROM raw),
lines AS (SELECT rid, source, t, x, len(regexp_extract_all(x, '[^ ]+')) AS n FROM norm JOIN d USING (rid) WHERE x <> ''),
freq AS (SELECT source, x FROM lines GROUP BY source, x HAVING count(DISTINCT t) > 10),
lost AS (SELECT rid, sum(n)::BIGINT AS n FROM lines l JOIN freq f ON l.x = f.x AND l.source IS NOT DISTINCT FROM f.source GROUP BY rid),
base AS (
  SELECT d.rid, d.doc_id, len(ws)::BIGINT AS n_words,
    length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS lost
  FROM d JOIN w USING (rid) LEFT JOIN dl USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_words - least(n_words, lost) AS n_words_left FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_words_left,
  NOT base_failed AND n_words_left >= 5 AND n_words_left >= 0.3 * n_words AS kept
FROM judged
"""
