"""URL rules looked up in a sorted array of digests.

A rule is a host followed by a path, such as ``example.org/en/``; it fits its host
and every subdomain if the path of the url starts with the rule's.  The rules
become two memory-mapped files: the sorted 64-bit xxhash digests of the rule
strings, and the strings themselves in that order.  Each url proposes its host
suffixes joined with as much of its path as some rule has; one vectorised binary
search over a whole batch finds the digests, and the stored string confirms every
hit, so a digest collision can't decide.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import lru_cache

from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (rule, verdict): the most rules that are shipped to executors as files.
MAX_INDEX_RULES = 5_000_000
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; both empty for null or without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_LOWER), path


def build_index(rules: list[tuple[str, str]], folder: str) -> list[str]:
    """Write the digest array, the string offsets, the strings, the verdicts and
    the path lengths of the rules to ``folder``; returns the paths.  Of several
    rules with one string ``block`` counts."""
    import numpy as np
    import xxhash

    if len(rules) > MAX_INDEX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_INDEX_RULES} fit the shipped index, use filter_urls_by_join")
    says: dict[str, str] = {}
    for rule, verdict in rules:
        says[rule] = max(verdict, says.get(rule, verdict))
    texts = sorted(says)
    keys = np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], dtype=np.uint64)
    order = np.argsort(keys, kind="stable")
    raw = [texts[i].encode() for i in order]
    paths = sorted({len(t) - (t + "/").index("/") for t in texts})
    name = uuid.uuid4().hex
    parts = {
        "keys": keys[order],
        "ends": np.cumsum([0, *map(len, raw)], dtype=np.int64),
        "text": np.frombuffer(b"".join(raw) or b"\0", dtype=np.uint8),
        "allow": np.array([says[texts[i]] == "allow" for i in order], dtype=np.bool_),
        "paths": np.array(paths, dtype=np.int64),
    }
    out = []
    for part, values in parts.items():
        out.append(os.path.join(folder, f"{name}-{part}.npy"))
        np.save(out[-1], values)
    return out


@lru_cache(maxsize=4)
def open_index(paths: tuple[str, ...]):
    """The five arrays of an index, memory-mapped where they aren't empty."""
    import numpy as np

    return [np.load(p, mmap_mode="r" if os.path.getsize(p) > 128 else None) for p in paths]


def probe(index, urls: list[str | None]) -> list[tuple[str, str, str | None, bool]]:
    """(host, path, longest rule or null, rule allows) of each url of a batch."""
    import numpy as np
    import xxhash

    keys, ends, text, allow, lengths = index
    parsed = [split_url(u) for u in urls]
    owner, tried = [], []
    for i, (host, path) in enumerate(parsed):
        cuts = [n for n in lengths if n <= len(path)]
        while host:
            for n in cuts:
                owner.append(i)
                tried.append(host + path[:n])
            _, dot, host = host.partition(".")
    found: list[tuple[str, bool] | None] = [None] * len(parsed)
    if tried and len(keys):
        want = np.array([xxhash.xxh64_intdigest(t.encode()) for t in tried], dtype=np.uint64)
        first, last = np.searchsorted(keys, want, "left"), np.searchsorted(keys, want, "right")
        for j in np.flatnonzero(first < last):
            for k in range(first[j], last[j]):
                if bytes(text[ends[k] : ends[k + 1]]) == tried[j].encode():
                    best = found[owner[j]]
                    if best is None or len(tried[j]) > len(best[0]):
                        found[owner[j]] = (tried[j], bool(allow[k]))
    return [(h, p, f and f[0], bool(f and f[1])) for (h, p), f in zip(parsed, found, strict=True)]


def filter_urls(df: DataFrame, rules: list[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict)`` per row of ``df``.

    The longest fitting rule decides, ``default`` where none fits; a null or empty url
    has an empty host and path and the default verdict.  Repeated rows and null ids stay;
    an empty table stays empty; urls of any length are judged whole; other columns aren't
    looked at.  The files go to the executors through ``SparkContext.addFile``."""
    kind = df.schema[id_col].dataType.simpleString()
    sc = df.sparkSession.sparkContext
    names = []
    # a folder of the driver's Spark context, which serves it to executors and removes it at the end
    for p in build_index(rules, tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())):
        sc.addFile(p)
        names.append(os.path.basename(p))

    def run(batches):
        import pyarrow as pa

        index = open_index(tuple(SparkFiles.get(n) for n in names))
        for batch in batches:
            rows = probe(index, batch.column(1).to_pylist())
            host, path, rule, allows = (list(c) for c in zip(*rows, strict=True)) if rows else ([], [], [], [])
            verdict = [("allow" if a else "block") if r is not None else default for r, a in zip(rule, allows, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in (host, path, rule, verdict))], ["key", "host", "path", "rule", "verdict"])

    return df.select(F.col(id_col).alias("key"), F.col(url_col).alias("u")).mapInArrow(run, f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", id_col)


def filter_urls_by_join(df: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The same result for a rule table of any size: urls propose their strings as
    rows, which meet ``rules(rule, verdict)`` in a shuffled join on digest and
    string."""
    lengths = rules.select((F.length("rule") - F.instr(F.concat("rule", F.lit("/")), "/") + 1).alias("n")).distinct()
    cuts = F.broadcast(lengths.agg(F.coalesce(F.array_sort(F.collect_set("n")), F.array().cast("array<int>")).alias("cuts")))
    rest = F.when(F.instr(url_col, "://") > 0, F.split(F.substring_index(F.expr(f"substring({url_col}, instr({url_col}, '://') + 3)"), "#", 1), r"\?", 2)[0]).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    base = (
        df.select(F.col(id_col).alias("key"), rest.alias("rest"), F.monotonically_increasing_id().alias("row"))
        .withColumn("h", F.substring_index("rest", "/", 1))
        .select("key", "row", F.translate("h", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), F.expr("substring(rest, length(h) + 1)").alias("path"))
    )
    labels = F.split("host", r"\.")
    tried = (
        base.crossJoin(cuts)
        .withColumn("suffix", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
        .withColumn("cut", F.explode(F.filter("cuts", lambda n: n <= F.length("path"))))
        .where("suffix <> ''")
        .select("key", "row", "host", "path", F.expr("concat(suffix, substring(path, 1, cut))").alias("rule"))
    )
    keyed = rules.groupBy("rule").agg(F.max("verdict").alias("verdict")).withColumn("digest", F.xxhash64("rule"))
    hits = tried.withColumn("digest", F.xxhash64("rule")).join(keyed, ["digest", "rule"])
    out = base.select("key", "row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")).unionByName(hits.select("key", "row", "host", "path", "rule", "verdict"))
    best = F.max_by(F.struct("rule", "verdict"), F.coalesce(F.length("rule"), F.lit(-1)))
    return out.groupBy("key", "row", "host", "path").agg(best.alias("b")).select(F.col("key").alias(id_col), "host", "path", "b.rule", "b.verdict")
