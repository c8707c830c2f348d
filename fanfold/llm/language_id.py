"""Language of documents by Bayesian fusion of evidence.

Log evidence adds up per language: the likelihood of the text (hashed byte trigrams,
multinomial, weighed as at most ``TEXT_WEIGHT`` trigrams so that long texts don't drown
the rest), the declared language of the markup (right with probability
``DECLARED_RIGHT``), and the prior of the host.  Priors come from grouped aggregation of
the text decisions: a host is smoothed towards its address suffix, a suffix towards all
documents.

The likelihoods are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, by
hash of the id); priors count every document.  Labels and declarations are compared by
their primary part: ``en-US`` and ``EN`` are ``en``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BUCKETS = 1 << 14
SAMPLE_ROWS = 20_000
#: Different labels that a model takes at most; beyond, fitting is refused.
MAX_LANGUAGES = 1000
TEXT_WEIGHT = 200.0
DECLARED_RIGHT = 0.9
#: Documents that a suffix's or the global distribution counts as in a prior.
STRENGTH = 20.0
#: Priors are broadcast up to this number of hosts (some 100 bytes each).
BROADCAST_HOSTS = 200_000
#: A document is kept if its language has at least this posterior.
MIN_POSTERIOR = 0.5
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
#: All that isn't a letter (or part of one) is one symbol; lead and trail bytes stay.
_FOLD[:65] = _FOLD[91:97] = _FOLD[123:128] = 32


def trigrams(text: str | None) -> np.ndarray:
    """Bucket numbers of the byte trigrams of a text that hold a letter."""
    b = _FOLD[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    if len(b) < 2:
        b = np.pad(b, (0, 2 - len(b)), constant_values=32)
    b = np.concatenate(([np.uint32(32)], b, [np.uint32(32)]))
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    code = code[(code != 0x202020)]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


@dataclass
class Model:
    """Languages and the log probabilities of trigram buckets, a row for each."""

    languages: list[str]
    logs: np.ndarray


def primary(label: Column) -> Column:
    """The primary part of a language label, in lower case; null if it has none."""
    part = F.lower(F.trim(F.substring_index(F.translate(label.cast("string"), "_", "-"), "-", 1)))
    return F.when(part != "", part)


def pages_as_documents(pages: DataFrame) -> DataFrame:
    """``(page_id, text, lang, source)`` of ``pages(page_id, url, html)``: the visible text,
    the language that ``<html lang=...>`` declares, and the host of the url."""
    hidden = r"(?is)<(script|style|nav|footer)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;"
    found = lambda c, pattern: F.when(F.regexp_extract(c, pattern, 1) != "", F.regexp_extract(c, pattern, 1))
    return pages.select(
        "page_id",
        F.regexp_replace("html", hidden, " ").alias("text"),
        found("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\x22\x27]?([a-z0-9_-]+)").alias("lang"),
        F.lower(found("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")).alias("source"),
    )


def fit(labelled: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """Fit the likelihoods by counting trigrams of a bounded sample of labelled rows.

    What reaches the driver is one number per language and bucket, so more than
    MAX_LANGUAGES different labels are an error: such a column doesn't hold languages.
    Rows without a label aren't fitted on, null and empty texts add nothing, texts of any
    length are counted whole, repeated rows count as often as they stand there, further
    columns aren't read, and without labelled rows no language is known."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), primary(F.col(label_col)).alias("label")).where("label IS NOT NULL")
    counts = rows.groupBy("label").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels in {label_col}, as {sorted(r[0] for r in counts)[:5]}")
    languages = sorted(r[0] for r in counts)
    share = min(1.0, SAMPLE_ROWS / max(1, sum(r[1] for r in counts)))
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            total: dict[str, np.ndarray] = {}
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total.setdefault(label, np.zeros(BUCKETS, dtype=np.int64))
                total[label] += np.bincount(trigrams(text), minlength=BUCKETS)
            for label, n in total.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["label", "bucket", "n"])

    pairs = chosen.select("label", "t").mapInArrow(run, "label string, bucket long, n long")
    table = pairs.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.full((len(languages), BUCKETS), 0.5)
    row = {x: i for i, x in enumerate(languages)}
    np.add.at(n, (table["label"].map(row).to_numpy(dtype=np.int64), table["bucket"].to_numpy(dtype=np.int64)), table["n"].to_numpy(dtype=np.float64))
    return Model(languages, np.log(n / n.sum(axis=1, keepdims=True)))


def text_evidence(df: DataFrame, model: Model, text_col: str) -> DataFrame:
    """Add ``grams``, the number of trigrams, and ``text_logs``, the weighed log likelihood
    of the text under each language."""
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.logs.T))

    def score(texts):
        import pandas as pd

        logs, out = shared.value, []
        for t in texts:
            at = trigrams(t)
            out.append((len(at), logs[at].sum(axis=0) * min(1.0, TEXT_WEIGHT / max(1, len(at)))))
        return pd.DataFrame({"grams": [x[0] for x in out], "logs": [x[1] for x in out]})

    # not to be copied into the filters above it: each copy scores the texts anew, in a worker of its own
    scored = df.withColumn("_s", F.pandas_udf(score, "grams long, logs array<double>").asNondeterministic()(F.col(text_col)))
    return scored.select(*df.columns, F.col("_s.grams").alias("grams"), F.col("_s.logs").alias("text_logs"))


def _best(values: Column, languages: Column) -> Column:
    return F.when(F.size(values) > 0, F.get(languages, (F.array_position(values, F.array_max(values)) - 1).cast("int")))


def host_priors(scored: DataFrame, n_languages: int) -> DataFrame:
    """``(host, suffix, prior)`` from ``scored(host, suffix, text_logs, grams)``: smoothed
    shares of the languages among the documents of each host, from the text alone.
    Counts are partial sums per task first, so a host of any size is one row a task for
    each language."""
    found = scored.where("grams > 0").withColumn("l", (F.array_position("text_logs", F.array_max("text_logs")) - 1).cast("int"))
    counts = stored(found.groupBy("host", "suffix", "l").agg(F.count("*").cast("double").alias("n")), "hosts")
    by_language = lambda name: (F.map_from_entries(F.collect_list(F.struct("l", "n"))).alias(name), F.sum("n").alias(f"{name}_all"))
    hosts = counts.groupBy("host", "suffix").agg(*by_language("own"))
    near = counts.groupBy("suffix", "l").agg(F.sum("n").alias("n")).groupBy("suffix").agg(*by_language("near")).withColumnRenamed("suffix", "sfx")
    whole = {r.l: r.n for r in counts.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    total = sum(whole.values())
    world = F.array(*(F.lit((whole.get(i, 0.0) + 1.0) / (total + n_languages)) for i in range(n_languages)))
    n = lambda name, i: F.coalesce(F.element_at(name, i), F.lit(0.0))
    smooth = lambda name, i, prior: (n(name, i) + STRENGTH * prior) / (F.col(f"{name}_all") + STRENGTH)
    both = hosts.join(near, F.col("suffix").eqNullSafe(F.col("sfx")))
    prior = F.transform(world, lambda w, i: smooth("own", i, smooth("near", i, w)))
    return both.select(F.col("host").alias("p_host"), F.col("suffix").alias("p_suffix"), prior.alias("prior"))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang", host_col: str = "source", with_rows: bool = False) -> DataFrame:
    """``(id, doc, language, posterior, text_language, kept)`` per row of ``docs``; ``doc``
    is the digest of the text.  ``with_rows`` adds the row itself as the struct ``row``, so
    that a verdict needs no join to meet its text; texts are then scored twice and not
    stored.

    A text without letters is not kept, nor one whose best posterior is under
    MIN_POSTERIOR.  A null declaration or one that the model doesn't know says nothing;
    null hosts are one host; repeated rows stay; without any labelled row nothing is
    known: language null, posterior 0, not kept."""
    k = len(model.languages)
    declared = primary(F.col(declared_col)) if declared_col else F.lit(None).cast("string")
    host = F.col(host_col)
    base = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("doc"),
        F.col(text_col).alias("t"),
        declared.alias("declared"),
        host.alias("host"),
        F.when(host.contains("."), F.substring_index(host, ".", -1)).alias("suffix"),
        *((F.struct(*docs.columns).alias("row"),) if with_rows else ()),
    )
    row = ("row",) if with_rows else ()
    if not k:
        none = F.lit(None).cast("string")
        return base.select(F.col("id").alias(id_col), "doc", none.alias("language"), F.lit(0.0).alias("posterior"), none.alias("text_language"), F.lit(False).alias("kept"), *row)
    if with_rows:
        # the evidence isn't stored with the rows, as that copy of all texts would stay on disk
        priors = stored(host_priors(text_evidence(base.drop("row"), model, "t"), k), "priors")
        scored = text_evidence(base, model, "t").drop("t")
    else:
        scored = stored(text_evidence(base, model, "t").drop("t"), "evidence")
        priors = stored(host_priors(scored, k), "priors")
    # hosts are few as a rule, and then the rows needn't be shuffled to meet them
    priors = F.broadcast(priors) if priors.count() <= BROADCAST_HOSTS else priors
    met = scored.join(priors, F.col("host").eqNullSafe(F.col("p_host")) & F.col("suffix").eqNullSafe(F.col("p_suffix")), "left")
    names = F.array(*map(F.lit, model.languages))
    prior = F.coalesce("prior", F.array_repeat(F.lit(1.0 / k), k))
    logs = F.zip_with("text_logs", prior, lambda a, p: a + F.log(p))
    wrong = (1 - DECLARED_RIGHT) / max(1, k - 1)
    said = F.transform(names, lambda x: F.when(F.col("declared").isNull() | ~F.array_contains(names, F.col("declared")), 0.0).when(x == F.col("declared"), float(np.log(DECLARED_RIGHT))).otherwise(float(np.log(wrong or 1e-9))))
    out = met.withColumn("logs", F.zip_with(logs, said, lambda a, b: a + b)).withColumn("top", F.array_max("logs"))
    mass = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    out = out.select("id", "doc", _best(F.col("logs"), names).alias("language"), (1.0 / mass).alias("posterior"), F.when(F.col("grams") > 0, _best(F.col("text_logs"), names)).alias("text_language"), "grams", *row)
    return out.select(F.col("id").alias(id_col), "doc", "language", "posterior", "text_language", ((F.col("grams") > 0) & (F.col("posterior") >= MIN_POSTERIOR)).alias("kept"), *row)
