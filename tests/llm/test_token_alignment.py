"""op11: alignment of two tokenizers against a plain version, and the perfect hash."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fanfold.llm import registry, token_alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(texts):
    """The figures of each text, token by token and pair by pair."""
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=PATHS[1])
    letters = {}
    for b in range(256):
        letters[chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else chr(256 + sum(1 for x in range(b) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255)))] = b
    b_bytes = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    docs = []
    for t in texts:
        if not t:
            docs.append(([], [], []))
            continue
        e = first.encode(" " + t, add_special_tokens=False)
        a = [(i, bytes(letters[c] for c in x)) for i, x in zip(e.ids, (first.id_to_token(i) for i in e.ids))]
        b = [(i, b_bytes(i)) for i in second.encode(t)]
        raw = (" " + t).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append(([], [], []))
            continue
        groups, i, j = [], 0, 0
        while i < len(a):
            ga, gb, la, lb = [a[i][0]], [b[j][0]], len(a[i][1]), len(b[j][1])
            i, j = i + 1, j + 1
            while la != lb:
                if la < lb:
                    ga, la, i = [*ga, a[i][0]], la + len(a[i][1]), i + 1
                else:
                    gb, lb, j = [*gb, b[j][0]], lb + len(b[j][1]), j + 1
            groups.append((ga, gb))
        docs.append((a, b, groups))
    links = [[(x, y) for ga, gb in groups for x in ga for y in gb] for _, _, groups in docs]
    count = Counter(p for ps in links for p in set(ps))
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for (a, b, groups), ps in zip(docs, links):
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(ps), sum(count[p] == most[p[0]] for p in ps), sum(count[p] for p in ps), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


ODD = [None, "", " ", "\n", "a", "  lead  two   three ", "▁x", "x ▁ y", "tab\tand\r\nnew", "<|endoftext|> <s> </s> <unk> <0x41>", "é ﬁ １ 漢字テスト 😀😀", "x　y a b", "word" * 300, "a.b,c;d 12345 it's We'll", "same text here", "same text here", "\x00 nul \x1c", "ünï cödé wörds", " ".join(["the cat"] * 200)]


@pytest.mark.parametrize("most_pairs", [1 << 22, 3])
def test_odd_texts_equal_plain(spark, monkeypatch, most_pairs):
    monkeypatch.setattr(token_alignment, "MAX_PAIRS", most_pairs)
    monkeypatch.setattr(token_alignment, "BUCKET_PAIRS", 16)
    random.seed(11)
    texts = ODD + ["".join(random.choice("ab é▁ \n.1漢") for _ in range(random.randrange(40))) for _ in range(150)]
    ids = [None if i % 50 == 49 else i for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids, texts)], "doc_id long, text string, pairs string, row string").repartition(4)
    got = sorted(map(str, ((r.doc_id, *(r[c] for c in FIGURES)) for r in token_alignment.align(df, *PATHS).collect())))
    assert got == sorted(map(str, ((i, *x) for i, x in zip(ids, plain(texts)))))


def test_documents_equal_plain(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in FIGURES) for r in registry.op11_token_alignment(spark, sf_dir).collect()}
    assert got == {r.doc_id: x for r, x in zip(rows, plain([r.text for r in rows]))}


def test_large_groups_count_links_by_distinct_ids(monkeypatch):
    tok = token_alignment.tokenizers_of(*PATHS)
    packed = tok.encode(["word" * 300, "漢字" * 50 + "テスト", "a b c"])
    aligned = token_alignment.Aligned(tok, packed)
    want = token_alignment._by_document(aligned, len(tok.b_bytes))
    for limit in (1, 3, 50):
        monkeypatch.setattr(token_alignment, "LINKS", limit)
        for x, y in zip(want, token_alignment._by_document(aligned, len(tok.b_bytes))):
            assert (x == y).all()


def test_long_texts_and_a_small_table_of_units(monkeypatch):
    monkeypatch.setattr(token_alignment, "UNITS", 10)
    tok = token_alignment.Pair(*PATHS)
    texts = [" " * 300_000, "\n" * 300_000, "a" * 300_000, "漢字" * 100_000, "ab cd " * 100_000]
    first = Tokenizer.from_file(PATHS[0])
    second = SentencePieceProcessor(model_file=PATHS[1])
    for t, (a, b) in zip(texts, tok.encode(texts)):
        assert token_alignment.unpacked(a).tolist() == first.encode(" " + t, add_special_tokens=False).ids
        assert token_alignment.unpacked(b).tolist() == second.encode(t)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 20_000])
def test_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 31, n))
    by_slot, displacement = token_alignment.perfect_hash(keys)
    assert sorted(by_slot.tolist()) == keys.tolist()
    index = token_alignment.Index([(0, by_slot.astype("<i8").tobytes(), displacement.astype("<i4").tobytes())])
    assert (index.keys[index.slots(keys, 1)] == keys).all()
    if n > 3:
        with pytest.raises(KeyError):
            index.slots(np.setdiff1d(np.arange(100), keys)[:5], 1)


def test_byte_letters_cover_the_vocabulary():
    with open(PATHS[0], encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    letters = token_alignment.byte_letters()
    assert len(letters) == 256 and all(set(t) <= set(letters) for t in vocab)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.align(df, *PATHS).collect() == []
