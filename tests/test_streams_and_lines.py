"""Numbered lines of split files, and bounded rounds."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fanfold.sources import listing, text
from fanfold.streaming import rounds


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_of_split_files_are_numbered(spark, tmp_path, small_splits):
    random.seed(5)
    files = {
        "short": b"a\n\nb",
        "ends": b"one\r\ntwo\t2\r\n",
        "empty lines": b"\n" * 300,
        "one line": b"x" * 5000,
        "long then short": b"y" * 1000 + b"\n" + b"z\n" * 200,
        "mixed": b"\n".join(bytes(random.choice(b"ab\t") for _ in range(random.choice([0, 1, 5, 200]))) for _ in range(150)),
    }
    for name, data in files.items():
        (tmp_path / f"{name}.txt").write_bytes(data)
    seen = text.read_lines(spark, str(tmp_path), numbered=True)
    got = {}
    for r in seen.collect():
        got.setdefault(r.file.rsplit("/", 1)[1].replace("%20", " ")[:-4], []).append((r.line_no, r.line))
    for name, data in files.items():
        lines = data.decode().split("\n")
        lines = lines[:-1] if lines[-1] == "" else lines
        assert sorted(got[name]) == list(enumerate(x.removesuffix("\r") for x in lines)), name
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    cells = {r.row: r.cells for r in text.read_tsv(spark, str(tmp_path / "ends.txt")).collect()}
    assert cells == {0: ["one"], 1: ["two", "2"]}


def test_no_reader_takes_a_file_whole(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a\n")
    plan = text.read_tsv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan.lower()


def test_rounds_hold_exactly_n_items_in_several_tasks(spark, tmp_path):
    fn = lambda df: df.withColumn("task", F.spark_partition_id())
    out = rounds.scatter_items(spark.range(103).repartition(3), [F.desc("id")], fn, str(tmp_path), 25).collect()
    assert [(r.seq, r.id, r.batch_id) for r in out] == [(i, 102 - i, i // 25) for i in range(103)]
    assert all(len({r.task for r in out if r.batch_id == b}) > 1 for b in range(4))


def test_a_round_reads_the_files_of_its_micro_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rounds, "BATCH_ROUNDS", 3)
    seen = []

    def fn(df):
        seen.append(len(df.inputFiles()))
        return df.withColumn("n", F.count("*").over(Window.partitionBy()))

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    out = rounds.scatter_items(spark.range(200), ["id"], fn, str(tmp_path), 5).collect()
    assert [(r.seq, r.batch_id, r.n) for r in out] == [(i, i // 5, 5) for i in range(200)]
    assert len(seen) == 41 and max(seen[1:]) <= 2  # of 14 micro-batches; the first call is for the schema
    assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive


def test_empty_tables_have_no_rounds(spark, tmp_path):
    fn = lambda df: df.withColumn("twice", F.col("id") * 2)
    out = rounds.scatter_items(spark.range(0), ["id"], fn, str(tmp_path / "items"), 5)
    assert out.columns == ["id", "seq", "twice", "batch_id"] and out.collect() == []
    (tmp_path / "none").mkdir()
    out = rounds.chunked_scatter(spark, str(tmp_path / "none"), spark.range(1).schema, fn, str(tmp_path / "files"))
    assert out.columns == ["id", "twice", "batch_id"] and out.collect() == []


def test_a_restart_goes_on_behind_the_last_round(spark, tmp_path):
    calls = []

    def failing(df):
        calls.append(1)
        return df.withColumn("x", F.when(F.col("id") == 12, F.raise_error(F.lit("stop here"))).otherwise(F.lit("first")))

    with pytest.raises(Exception, match="stop here"):
        rounds.scatter_items(spark.range(20), ["id"], failing, str(tmp_path), 5)
    out = rounds.scatter_items(spark.range(20), ["id"], lambda df: df.withColumn("x", F.lit("second")), str(tmp_path), 5).collect()
    assert [r.id for r in out] == list(range(20))
    assert [r.x for r in out] == ["first"] * 10 + ["second"] * 10
    again = rounds.scatter_items(spark.range(20), ["id"], lambda df: df.withColumn("x", F.lit("third")), str(tmp_path), 5).collect()
    assert [r.x for r in again] == [r.x for r in out]


def test_listing_sees_every_file_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "FOLDERS", 3)
    want = {}
    for folder in ("", "a", "a/b", "a/b/c", "d e", "f"):
        (tmp_path / folder).mkdir(exist_ok=True, parents=True)
        for name, size in (("x.txt", 0), ("y.csv", 5), ("z.bam", 7), (".hidden.txt", 1), ("_SUCCESS", 0)):
            path = tmp_path / folder / name
            path.write_bytes(b"-" * size)
            if not name.startswith((".", "_")):
                want[f"file:{path}"] = size
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "x.txt").write_text("")
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        found = text.glob_files(spark, root, "*")
        assert {r.path: r.size for r in found.collect()} == want
        assert found.count() == len(want) and found.rdd.getNumPartitions() > 1
    assert {r.path for r in text.glob_files(spark, str(tmp_path), "*.{txt,bam}").collect()} == {p for p in want if p.endswith(("txt", "bam"))}
    assert text.glob_files(spark, str(tmp_path), "*.none").collect() == []
    # the same as Spark's own scan gives, but for empty files
    own = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("length", "modificationTime").collect()
    seen = text.glob_files(spark, str(tmp_path), "*").where("size > 0").select("size", "modified").collect()
    trimmed = lambda rows: sorted((n, t.replace(microsecond=t.microsecond // 1000 * 1000)) for n, t in rows)
    assert trimmed(seen) == trimmed(own)


def test_listing_leaves_other_stores_to_spark():
    assert listing.store_of("viewfs://store/in") is None
    assert listing.patterns("a{b,c}d[^e]") == ["abd[!e]", "acd[!e]"]
