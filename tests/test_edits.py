"""Edit scripts against a plain longest common subsequence."""

import random

from fanfold.operators import edits
from fanfold.plans import queries as plans


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def applied(a, b, gone, come):
    kept = [x for i, x in enumerate(a) if i not in set(gone)]
    for i in come:
        kept.insert(i, b[i])
    return kept


def test_scripts_are_right_and_shortest():
    random.seed(8)
    for n in range(3000):
        a = [random.choice("abc") for _ in range(random.randrange(12))]
        b = [random.choice("abc") for _ in range(random.randrange(12))]
        gone, come = edits.edits(a, b)
        assert applied(a, b, gone, come) == b
        assert len(gone) + len(come) == len(a) + len(b) - 2 * longest(a, b), (a, b)


def test_long_texts_with_few_differences():
    a = [str(i % 977) for i in range(100_000)]
    b = a[:50] + ["new"] + a[50:70_000] + a[70_010:]
    gone, come = edits.edits(a, b)
    assert (len(gone), len(come)) == (10, 1) and applied(a, b, gone, come) == b


def test_rows_of_odd_texts(spark):
    texts = [(1, None, None), (2, "", "a\n"), (3, "a\nb", "a\nb\n"), (4, "a\nb\nc", "a\nx\nc\n\n"), (5, "a", None), (5, "a", None)]
    df = spark.createDataFrame([(*r, 0) for r in texts], "id int, left string, right string, seq int")
    got = [tuple(r) for r in edits.diff_lines(df, ["id"]).orderBy("id", "seq").collect()]
    assert got == [(2, 0, ">", 0, "a"), (4, 0, "<", 1, "b"), (4, 1, ">", 1, "x"), (4, 2, ">", 3, ""), (5, 0, "<", 0, "a"), (5, 0, "<", 0, "a")]
    assert edits.diff_lines(df.limit(0), ["id"]).collect() == []


def test_documents_become_the_next_ones(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    lines = {k: (t or "").removesuffix("\n").split("\n") if t else [] for k, t in texts.items()}
    scripts = {}
    for r in plans.diff_documents(spark, sf_dir).orderBy("seq").collect():
        scripts.setdefault((r.doc_id, r.next_id), ([], []))[r.side == ">"].append(r.line_no)
    heads = {}
    for k in sorted(k for k, t in texts.items() if t is not None):
        heads.setdefault(texts[k][:40], []).append(k)
    pairs = {p for ks in heads.values() for p in zip(ks, ks[1:])}
    assert set(scripts) == {(a, b) for a, b in pairs if lines[a] != lines[b]} and scripts
    for (a, b), (gone, come) in scripts.items():
        assert applied(lines[a], lines[b], gone, come) == lines[b]
        assert len(gone) + len(come) == len(lines[a]) + len(lines[b]) - 2 * longest(lines[a], lines[b])
