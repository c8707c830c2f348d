"""op12: fingerprints and components against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from fanfold.llm import registry, simhash


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fps):
    """Least id reachable, by comparing all pairs of fingerprints."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, f in zip(ids, fps):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for f in fps]


def test_fingerprints_equal_brute_force(monkeypatch):
    random.seed(12)
    texts = [None, "", " \n", "One", "one TWO", "É é a b", "a\x1cb c d e\x85f", " x" * 5000, "one long" + "g" * 9000]
    texts += ["".join(random.choice("abAB  \n\té") for _ in range(random.randrange(300))) for _ in range(200)]
    for piece in (7, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", piece)
        for t in texts:
            assert simhash.fingerprint(None if t is None else t.encode()) & (2**64 - 1) == plain(t), t


def test_balls_give_the_components_of_all_pairs(spark, monkeypatch, tmp_path):
    random.seed(3)
    fps = [0, 1, 3, 1 << 63, (1 << 63) | 6]
    for _ in range(40):
        f = random.getrandbits(64)
        fps.append(f)
        for _ in range(random.randrange(4)):
            f ^= 1 << random.randrange(64)
            f ^= 1 << random.randrange(64)
            fps.append(f)
        fps.append(f ^ 7)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    ids = [None if i % 9 == 0 else 500 - i for i in range(len(fps))]
    df = spark.createDataFrame(list(zip(ids, signed)), "id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: df)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == sorted((str(i), f"{f:016x}", str(c)) for i, f, c in zip(ids, fps, components(ids, fps)))


def test_a_full_ball_is_one_component(spark):
    fps = [5, *(5 ^ 1 << b for b in range(64))]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.ball_links(df).collect()
    assert {r.a for r in links} | {r.b for r in links} == {r.fp for r in df.collect()}
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in links)


def test_documents_equal_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], [f"{f:016x}" for f in fps], components([r.doc_id for r in rows], fps)))
    assert sorted(tuple(r) for r in registry.op12_simhash(spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()) == want


def test_very_long_texts(spark):
    texts = ["w" * 5_000_000, "a b " * 1_250_000, " " * 5_000_000]
    df = spark.createDataFrame([(i,) for i in range(3)], "doc_id long").withColumn("text", F.when(F.col("doc_id") == 0, F.repeat(F.lit("w"), 5_000_000)).when(F.col("doc_id") == 1, F.repeat(F.lit("a b "), 1_250_000)).otherwise(F.repeat(F.lit(" "), 5_000_000)))
    got = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
