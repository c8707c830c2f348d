"""Five stages over ``documents``: language, near copies, secrets, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fanfold.llm import byte_bpe, jaccard, language_id, mixing, secrets
from fanfold.llm.common import stored, words
from fanfold.llm.registry import RANK_FILE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _digest(text: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _met(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """``docs`` with the rows of ``verdicts(v_id, v_doc, ...)`` of the same id and text."""
    return docs.join(verdicts, F.col("doc_id").eqNullSafe(F.col("v_id")) & (_digest() == F.col("v_doc")), how)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; ``lang`` becomes the language found.

    Null and empty texts and texts without letters have no language and go; texts of any
    length are scored whole; repeated rows each get their verdict; null labels and hosts
    say nothing.  An empty table stays empty."""
    model = language_id.fit(docs, "doc_id", "text", "lang")
    found = language_id.identify(docs.select(*COLUMNS), model, with_rows=True).where("kept")
    return found.select(*(F.col("language").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, that with the least id, nulls last, then
    the least text digest; of a text without words one row for each id.

    Rows are told by id and text, so null ids and ids with several texts stay by their
    texts; of repeated rows one stays.  An empty table stays empty."""
    groups = stored(jaccard.grouped(docs), "groups")
    alone = lambda c: F.when(F.col("root").isNull(), F.col(c))
    least = F.min(F.struct(F.col("id").isNull(), "id", "doc")).alias("row")
    stay = groups.groupBy("root", alone("id"), alone("doc")).agg(least).select(F.col("row.id").alias("v_id"), F.col("row.doc").alias("v_doc"))
    gone = stored(groups.join(stay, F.col("id").eqNullSafe(F.col("v_id")) & (F.col("doc") == F.col("v_doc")), "left_anti").select(F.col("id").alias("v_id"), F.col("doc").alias("v_doc")).distinct(), "gone")
    # what goes is a small part as a rule, and then the texts needn't be shuffled to meet it
    left = _met(docs, F.broadcast(gone) if gone.count() <= jaccard.BROADCAST_ROWS else gone, "left_anti")
    if groups.count() != groups.select("id", "doc").distinct().count():
        left = left.withColumn("doc", _digest()).dropDuplicates(["doc_id", "doc"])  # repeated rows of one document
    return left.select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes.

    Null and empty texts stay as they are; texts of any length are searched whole;
    overlapping spans are masked once; repeated rows and null ids are masked by their
    texts.  An empty table stays empty."""
    found = secrets.find_secrets(docs).where("size(found) > 0").select(F.col("doc_id").alias("v_id"), F.col("doc").alias("v_doc"), "found").dropDuplicates(["v_id", "v_doc"])
    met = _met(docs, found, "left").withColumn("text", F.when(F.col("found").isNotNull(), secrets.masked(F.col("text"), F.col("found"))).otherwise(F.col("text")))
    return met.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def row_key():
    """The id of a row with a digest of all its columns: equal for repeated rows only."""
    return F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64(*COLUMNS).cast("string"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the order of its slots: a row each time that the mix takes a document.

    The words taken are those of the mix; a document that the end of its source's share
    cuts short keeps its first words, joined by spaces.  Null and empty texts have no
    words to take and go, as do documents beyond their source's share; repeated rows are
    each taken in their own place."""
    key = row_key()
    mix = mixing.pieces(docs.select(key.alias("doc_id"), "text", "source"), heads=True).where("slot IS NOT NULL")
    taken = mix.select(F.col("doc_id").alias("key"), "size", "slot", F.col("end").cast("int").alias("n"))
    once = docs.withColumn("k", key).dropDuplicates(["k"])
    met = once.join(taken, F.col("k") == F.col("key"))
    cut = F.array_join(F.slice(words(F.col("text")), F.lit(1), F.col("n")), " ")
    met = met.withColumn("text", F.when(F.col("n") < F.col("size"), cut).otherwise(F.col("text")))
    met = met.withColumn("n_chars", F.when(F.col("n") < F.col("size"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return met.orderBy("slot", "k").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)``: packed token ids, and the
    digest of what they decode to.  Null and empty texts have no tokens; texts of any
    length are encoded whole; repeated rows and null ids stay, a row each."""
    path = public_tokenizers.path(RANK_FILE)
    ids = byte_bpe.encode(docs, path, public_tokenizers.PATTERN, with_decoded=True)
    return ids.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed_sources),
    ("byte-level BPE encoding and decoding", tokens),
]
#: SQL can't express the language model or the token merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "stage")
    return docs
