"""The pipeline against a plain version of its stages."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm import base_spans, groups

import corpus_pipeline
from fanfold.llm import byte_bpe, registry


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_groups_leave_one_and_repeats_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.unionByName(docs.where("doc_id < 20"))
    left = corpus_pipeline.one_of_each_group(spark, twice, sf_dir)
    want = {i for i, (_, root) in groups([tuple(r) for r in docs.select("doc_id", "text").collect()]).items() if i == root}
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)


def test_rows_of_null_and_shared_ids_are_kept_by_their_texts(spark, sf_dir, monkeypatch):
    from fanfold.llm import jaccard

    copies, plain = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, texts: copies.append(texts.count() - texts.select("node").distinct().count()) or plain(pairs, texts))
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, text("a")), (None, text("a") + " more"), (None, text("b")), (None, text("c")), (None, text("c")), (2, text("d")), (2, text("e")), (2, text("e"))]
    rows += [(None, text("f")), (None, text("f") + " more"), (3, " "), (3, " "), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = [(r.doc_id, r.text.removesuffix(" more")) for r in corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()]
    want = {(1, text("a")), (None, text("b")), (None, text("c")), (2, text("d")), (2, text("e")), (None, text("f")), (3, " "), (None, "")}
    assert len(left) == len(want) and set(left) == want
    assert not any(copies)


def test_secrets_are_masked_and_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.without_secrets(spark, docs, sf_dir).collect()
    assert len(out) == docs.count() and not any(base_spans(r.text) for r in out)
    clean = {r.doc_id: r.text for r in docs.collect() if not base_spans(r.text)}
    assert all(r.text == clean[r.doc_id] for r in out if r.doc_id in clean)


def test_the_mix_is_of_the_targets_and_in_slot_order(spark, sf_dir):
    from fanfold.llm import mixing

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.unionByName(docs.where("doc_id < 9"))
    out = [(r.doc_id, len((r.text or "").split()), r.text) for r in corpus_pipeline.mixed_sources(spark, twice, sf_dir).collect()]
    pieces = mixing.pieces(twice.select(corpus_pipeline.row_key().alias("doc_id"), "text", "source")).where("slot IS NOT NULL").withColumn("doc_id", F.substring_index("doc_id", ":", 1).cast("long")).collect()
    words, texts = {}, {r.doc_id: r.text for r in docs.collect()}
    for p in pieces:
        words[p.doc_id] = words.get(p.doc_id, 0) + p.end - p.start
    got = {}
    for i, n, text in out:
        got[i] = got.get(i, 0) + n
        assert text == texts[i] or texts[i].split()[:n] == text.split()
    assert got == words
    first = {}
    for p in pieces:
        first[p.doc_id] = min(first.get(p.doc_id, 1 << 60), p.slot)
    seen = list(dict.fromkeys(i for i, _, _ in out))
    assert [first[i] for i in seen] == sorted(first[i] for i in seen)


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir).collect()
    enc = byte_bpe.encoder(public_tokenizers.path(registry.RANK_FILE), public_tokenizers.PATTERN)
    assert len(out) > 50 and corpus_pipeline.ORACLE_SQL is None
    for r in out[:20]:
        text = enc.decode_bytes([int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)])
        assert hashlib.sha256(text).hexdigest() == r.decoded_sha256 and r.n_tokens == len(r.ids) // 4


def test_odd_rows_pass(spark, sf_dir, tmp_path):
    from test_llm import ODD, SCHEMA

    spark.createDataFrame(ODD, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and {r.doc_id for r in out} <= {r[0] for r in ODD if (r[1] or "").strip()}
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("name", ["pipeline", *registry.QUERIES])
def test_registered(name):
    import __spark_entry__ as e

    assert name in e.queries()
