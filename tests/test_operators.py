"""Literal results and properties of the table operators."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows_of

from fanfold.operators import catalog, filters, gather, merge, offers, pairs, positions, reads, tasks
from fanfold.plans import graph, sets
from fanfold.sources import sinks
from fanfold.sources import text as text_sources
from fanfold.streaming import rounds


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_gather_is_the_inverse_of_scatter(spark):
    df = spark.createDataFrame([(1, [3, None, 1]), (2, [7])], "k int, a array<int>")
    for n in (1, 2, 7):
        assert rows(gather.gather(gather.scatter(df, "a").repartition(n), ["k"], name="a")) == rows(df)


def test_gather_results(spark):
    df = spark.createDataFrame([("p", 2, {"x": "b"}), ("p", 0, {"x": "a", "y": "1"}), ("p", 1, {"x": "c", "y": None})], "parent_id string, seq int, outputs map<string,string>")
    r = gather.gather_results(df, {"x": "required", "y": "optional"}).first()
    assert (r.x, r.y) == (["a", "c", "b"], ["1", None])
    assert gather.gather_results(df, {"y": "optional"}, absent="null").first().y == ["1", None, None]
    with pytest.raises(PySparkException):
        gather.gather_results(df, {"z": "required"}).collect()


def test_zip_tables(spark):
    a, b = spark.range(3).toDF("seq").withColumn("a", F.col("seq")), spark.range(2).toDF("seq").withColumn("b", F.col("seq"))
    with pytest.raises(PySparkException):
        pairs.zip_tables(a, b, []).collect()
    assert pairs.zip_tables(a, b, [], strict=False).count() == 2
    assert pairs.pair_chunks(a, a.withColumnRenamed("a", "c"), key="seq").count() == 3


def test_transpose_twice(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 2), (1, 0, 3)], "r int, c int, value int")
    assert rows(pairs.transpose(pairs.transpose(df))) == rows(df)
    assert pairs.check_rectangular(df).count() == 2


def test_positions_equal_a_global_window(spark):
    df = spark.range(500).select((F.xxhash64("id") % 1000).alias("k"), "id").repartition(7)
    got = rows(positions.with_positions(df, [F.col("k"), F.col("id")]).select("id", "seq"))
    want = sorted((r.id, i) for i, r in enumerate(df.orderBy("k", "id").collect()))
    assert sorted(got) == want
    assert positions.with_positions(df.limit(0), [F.col("k")]).count() == 0
    with pytest.raises(ValueError):
        positions.chunk(df, 5000, "id")


OFFERS = [("mem3_ssd1_x32", 245751, 597, 32, 13.0, False), ("mem4_ssd1_x128", 1967522, 3573, 128, 14.0, False)]
SCHEMA = "name string, memory_mb int, disk_gb int, cpu int, price double, gpu boolean"


@pytest.mark.parametrize("memory,answer", [(239 * 1024, "mem3_ssd1_x32"), (240 * 1024, "mem4_ssd1_x128")])
def test_cheapest_by_memory(spark, memory, answer):
    r = spark.createDataFrame([(memory, 18, 32)], "memory_mb int, disk_gb int, cpu int")
    assert offers.cheapest_offer(r, spark.createDataFrame(OFFERS, SCHEMA)).first().offer == answer


def test_cheapest_ties_gpu_and_names(spark):
    o = spark.createDataFrame([("mem1_ssd1_v2_x4", 1, 1, 4, 0.2, False), ("mem1_ssd1_x4", 1, 1, 4, 0.2, False), ("mem3_ssd1_gpu_x8", 1, 1, 8, 1.0, True)], SCHEMA)
    ask = lambda *r: spark.createDataFrame([r], "memory_mb int, disk_gb int, cpu int, gpu boolean, offer_name string")
    best = lambda r: offers.cheapest_offer(r, o, equal=("gpu",)).first().offer
    assert best(ask(None, None, 4, None, None)) == "mem1_ssd1_v2_x4"
    assert best(ask(None, None, 4, True, None)) == "mem3_ssd1_gpu_x8"
    assert best(ask(None, None, 4, None, "mem1_ssd1_x4")) == "mem1_ssd1_x4"
    for bad in (ask(None, None, 8, False, None), ask(None, None, 1, None, "nope")):
        with pytest.raises(PySparkException):
            best(bad)


def test_cheapest_equals_brute_force(spark):
    random.seed(3)
    o = [(f"o{i}" + "_v2" * (i % 3 == 0), random.randrange(5), random.randrange(5), random.randrange(5), float(random.randrange(4)), False) for i in range(60)]
    r = [(i, *(random.choice([None, *range(6)]) for _ in range(3))) for i in range(80)]
    got = offers.cheapest_offer(spark.createDataFrame(r, "id int, memory_mb int, disk_gb int, cpu int"), spark.createDataFrame(o, SCHEMA), mode="report")
    for x in got.collect():
        fits = [y for y in o if all(w is None or h >= w for h, w in zip(y[1:4], (x.memory_mb, x.disk_gb, x.cpu), strict=True))]
        assert x.offer == min(((y[4], "_v2" not in y[0], y[0]) for y in fits), default=(0, 0, None))[2]


def test_offer_filters(spark):
    df = spark.createDataFrame([("a", [("u", "16.04")]), ("a_hdd", [("u", "16.04")]), ("b", [("u", "14.04")])], "name string, os array<struct<distribution:string,release:string>>")
    assert [r.name for r in offers.offer_filter(df).collect()] == ["a"]


def test_catalog(spark):
    c = spark.createDataFrame([("p", "file-1", "file", "a", "/x", {"k": "v"}), ("p", "file-2", "file", "a.b", "/x/y", {}), ("p", "file-3", "record", "aXb", "/xy", {})], "project string, id string, class string, name string, folder string, properties map<string,string>")
    assert catalog.scan_catalog(c, "p", "/x").count() == 2 and catalog.scan_catalog(c, folder="/x", recurse=False).count() == 1
    assert catalog.scan_catalog(c, klass="record", fields=["id"]).columns == ["id"]
    assert catalog.scan_catalog(c, with_properties=["k"]).count() == 1
    assert catalog.scan_catalog(c, ids=[f"file-{i}" for i in range(2000)]).count() == 3
    assert rows(catalog.match_names(c, spark.createDataFrame([("a.b",)], "name string")).select("id")) == [("file-2",)]
    paths = spark.createDataFrame([("dx://p:/x/a",), ("dx://p:/x/none",), ("dx://p:file-9",)], "url string")
    got = rows(catalog.resolve_paths(paths, c, mode="report"))
    assert got == [("dx://p:/x/a", "file-1", 1), ("dx://p:/x/none", None, 0), ("dx://p:file-9", "file-9", 1)]
    with pytest.raises(PySparkException):
        catalog.resolve_paths(paths, c).collect()
    assert len(catalog.manifest_by_container(c).first().files) == 3


def test_merges(spark):
    kv = lambda *r: spark.createDataFrame(list(r), "k string, value string")
    assert rows(merge.merge_overrides(kv(("a", "1"), ("b", "2")), kv(("a", "3"), ("c", None)), kv(("b", None)), key="k")) == [("a", "3"), ("b", "2"), ("c", None)]
    assert rows(merge.unused_keys(kv(("a", "1"), ("z", "1")), kv(("a", "1")), "k").select("k")) == [("z",)]
    g = spark.createDataFrame([("x", "VIEW", None, None, True, ["b"]), ("x", "ADMINISTER", None, False, None, ["a", "b"])], "key string, project string, all_projects string, developer boolean, project_creation boolean, network array<string>")
    assert rows(merge.merge_access(g)) == [("x", "ADMINISTER", None, False, True, ["a", "b"])]
    d = spark.createDataFrame([("n", "1"), ("n", "1"), ("m", "2"), ("m", "3")], "name string, definition string")
    assert rows(merge.merge_definitions(d, "report")) == [("m",)]
    with pytest.raises(PySparkException):
        merge.merge_definitions(d).collect()


def test_refs(spark):
    df = spark.createDataFrame([(1, ["a://1", None, "a://2"], {"k": "a://3"}), (2, None, None)], "id int, a array<string>, m map<string,string>")
    assert rows(merge.find_refs(df, ["a", "m"], ["id"]).select("ref")) == [("a://1",), ("a://2",), ("a://3",)]
    table = spark.createDataFrame([("a://1", "x")], "ref string, target string")
    assert rows(merge.translate_refs(df, "a", table, ["id"], required=False).select("id", "a")) == [(1, ["x", None, None]), (2, None)]
    with pytest.raises(PySparkException):
        merge.translate_refs(df, "a", table, ["id"]).collect()
    twice = merge.translate_refs(df.unionByName(df), "a", table, ["id"], required=False)
    assert twice.count() == 4 and twice.where("a[0] = 'x'").count() == 2
    nested = spark.sql("SELECT 1 AS id, named_struct('s', named_struct('r', 'a://1', 'n', 5), 'm', map('a://1', array('note', 'a://9'), 'k', null)) AS c UNION ALL SELECT 2, null")
    out = merge.translate_refs(nested, "c", table, ["id"], required=False, is_ref=lambda c: F.startswith(c, F.lit("a://")))
    got = {r.id: r.c for r in out.collect()}
    assert got[2] is None and got[1].s == ("x", 5) and got[1].m == {"x": ["note", None], "k": None}
    assert merge.translate_refs(nested.select("id"), "id", table, ["id"]).count() == 2


def test_filters(spark):
    df = spark.createDataFrame([("a", ["x", "z"]), (None, None)], "s string, t array<string>")
    assert filters.choices(df, "t", ["x"], "report").count() == 1 and filters.choices(df, "s", ["a"]).count() == 2
    with pytest.raises(TypeError):
        filters.choices(df, "s", [1])
    with pytest.raises(ValueError):
        filters.constraint_tree({"and": [], "or": []}, F.col)
    files = spark.createDataFrame([("a.bam", "file", ["t"]), ("b.bai", "file", [])], "name string, class string, tags array<string>")
    assert rows(files.where(filters.patterns(["*.bam"], "file", ["t"])).select("name")) == [("a.bam",)]
    assert rows(filters.typed_defaults(df, {"s": "d"}).select("s")) == [("a",), ("d",)]
    with pytest.raises(TypeError):
        filters.typed_defaults(df, {"s": 1})
    assert filters.live_only(spark.createDataFrame([("live",), ("archived",)], "archival_state string"), mode="report").count() == 1


def test_sets(spark):
    ids = lambda *x: spark.createDataFrame([(i, f"/t/{i}", i) for i in x], "id int, path string, created int")
    assert rows(sets.real_outputs(ids(1, 2, 3), ids(1), 3).select("id")) == [(3,)]
    assert sets.real_outputs(ids(1, 2, 3), ids(1), 0, most=1).count() == 0
    assert rows(sets.to_upload(ids(1, 2, 3), ids(1), ids(2)).select("id")) == [(3,)]
    assert sets.with_urls(ids(1), ids(2).withColumn("url", F.lit("u"))).first().url is None
    plan = sets.archive_plan(spark.createDataFrame([("n", "/a", "applet")], "name string, folder string, class string").withColumn("created", F.to_timestamp(F.lit("2020-03-01 04:05:06"))))
    assert tuple(plan.select("target", "archived_as").first()) == ("/a/.Applet_archive", "n Sun Mar 01 04:05:06 2020")


def test_graphs(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "node string")
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c")], "node string, dep string")
    assert rows(graph.dependency_levels(nodes, edges)) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    cycle = edges.union(spark.createDataFrame([("a", "d")], "node string, dep string"))
    with pytest.raises(ValueError, match="d waits for b, c"):
        graph.dependency_levels(nodes, cycle)
    assert {r.level for r in graph.dependency_levels(nodes, cycle, "report").collect()} == {None}
    assert len(rows(graph.ancestors(cycle))) == 16 and len(rows(graph.ancestors(edges))) == 5


def test_graphs_of_any_shape_equal_plain_walks(spark):
    random.seed(21)
    for n, cyclic in ((30, False), (30, True)):
        edges = {(f"n{i}", f"n{random.randrange(i) if not cyclic or i % 9 else random.randrange(n)}") for i in range(1, n) for _ in range(random.choice([1, 1, 1, 2, 3]))}
        deps = {f"n{i}": {d for a, d in edges if a == f"n{i}"} for i in range(n)}
        levels, left = {}, dict(deps)
        while now := [k for k, d in left.items() if all(x in levels for x in d)]:
            levels |= {k: max([levels[x] + 1 for x in left[k]], default=0) for k in now}
            for k in now:
                del left[k]
        nodes = spark.createDataFrame([(k,) for k in deps], "node string")
        df = spark.createDataFrame(sorted(edges), "node string, dep string")
        assert {r.node: r.level for r in graph.dependency_levels(nodes, df, "report").collect()} == {k: levels.get(k) for k in deps}
        reach = {k: set(d) for k, d in deps.items()}
        for _ in range(n):
            reach = {k: d | {y for x in d for y in reach[x]} for k, d in reach.items()}
        assert {tuple(r) for r in graph.ancestors(df).collect()} == {(k, x) for k, d in reach.items() for x in d}


def test_a_long_chain_takes_few_rounds(spark):
    nodes = spark.range(1, 100_001).toDF("node")
    levels = graph.dependency_levels(nodes, nodes.where("node > 1").withColumn("dep", F.col("node") - 1))
    assert levels.where("level <> node - 1 OR level IS NULL").count() == 0 and levels.count() == 100_000


def test_tree_paths_of_nested_roots_cycles_and_deep_trees(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("alone", "gone")], "node string, parent string")
    roots = spark.createDataFrame([("a",), ("c",), ("top",)], "node string")
    got = sorted((r.node, r.depth, "/".join(r.path)) for r in graph.tree_paths(edges, roots).collect())
    assert got == [("a", 0, "a"), ("b", 1, "a/b"), ("c", 0, "c"), ("c", 2, "a/b/c"), ("d", 1, "c/d"), ("d", 3, "a/b/c/d"), ("top", 0, "top")]
    assert graph.tree_paths(edges, roots, 3).count() == 7
    for bad, depth in ((roots, 2), (spark.createDataFrame([("x",)], "node string"), 5)):
        with pytest.raises(ValueError, match="deeper than"):
            graph.tree_paths(edges, bad, depth).collect()


def test_refs_in_json_are_whole_texts_at_any_depth(spark):
    deep = "[" * 60 + '{"k": "file-deep"}' + "]" * 60
    texts = [
        None,
        "{}",
        '"file-1"',
        '{"file-key": "no", "a": ["file-2", "x file-3", "file-4 ", "\\\\"], "b": {"c": "file-5"}}',
        r'{"q": "say \"file-6\", \"", "r": "\\", "s": "file-7", "u": "\u0066ile-8", "n": 1.5, "t": true, "z": null}',
        deep,
        '["file-9", "file-9"]',
        '{"x": "file-10\\n"}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string")
    got = rows(merge.find_refs_in_json(df, "j", ["id"]))
    assert got == [(2, "file-1"), (3, "file-2"), (3, "file-5"), (4, "file-7"), (4, "file-8"), (5, "file-deep"), (6, "file-9"), (6, "file-9")]
    assert (3, "file-key") in rows(merge.find_refs_in_json(df, "j", ["id"], in_keys=True))
    with pytest.raises(Exception, match="(?i)malformed"):
        merge.find_refs_in_json(spark.createDataFrame([(1, "{")], "id int, j string"), "j", ["id"]).collect()


def test_reads(spark):
    r = spark.createDataFrame([(1, 1, "AC", [30, 30], "u", "g"), (2, 1, "AG", [30, 2], "u", "g"), (3, 1, "TT", [30, 30], "u", "g"), (4, 1, None, None, "u", "g"), (5, 1, "AC", [30, 30], "u", "g")], "read_id long, gem_group int, barcode string, barcode_qual array<int>, umi string, gene string")
    listed = spark.createDataFrame([("AC",), ("GG",)], "barcode string")
    counts = reads.barcode_counts(r, listed)
    assert rows(counts) == [(1, "AC", 2)]
    fixed = {x.read_id: x.corrected for x in reads.correct_barcodes(r, listed, counts, 0.9).collect()}
    assert fixed == {1: "AC", 2: "AC", 3: None, 4: None, 5: "AC"}
    assert {x.read_id for x in reads.mark_duplicates(r).where("duplicate").collect()} == {5}
    assert rows(reads.count_genes(r).select("barcode", "umis")) == [("AC", 1), ("AG", 1), ("TT", 1)]


def test_duplicates_tell_equal_ids_apart(spark):
    r = spark.createDataFrame([(1, 1, "A", "u", "g"), (1, 1, "A", "u", "g"), (2, 1, "A", "u", "g"), (3, 1, None, "u", "g"), (4, 1, None, "u", "g"), (5, None, "A", "u", "g"), (6, None, "A", "u", "g")], "read_id long, gem_group int, barcode string, umi string, gene string")
    got = reads.mark_duplicates(r).groupBy("read_id").agg(F.sum(F.col("duplicate").cast("int"))).collect()
    assert dict(map(tuple, got)) == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_barcodes_weigh_by_their_own_group(spark):
    rows_ = [(1, 1, "AA", [30, 30]), (2, 2, "AA", [30, 30]), (3, 1, "AA", [3, 30])]
    r = spark.createDataFrame(rows_, "read_id long, gem_group int, barcode string, barcode_qual array<int>")
    listed = spark.createDataFrame([("CA",), ("AC",), ("AAC",), ("",)], "barcode string")
    counts = spark.createDataFrame([(1, "CA", 9), (2, "AC", 9)], "gem_group int, barcode string, n long")
    assert {x.read_id: x.corrected for x in reads.correct_barcodes(r, listed, counts, 0.9).collect()} == {1: "CA", 2: "AC", 3: "CA"}
    assert {x.read_id: x.corrected for x in reads.correct_barcodes(r, listed, counts, 0.95).collect()} == {1: None, 2: None, 3: "CA"}


def test_an_environment_has_one_row(spark):
    items, env = spark.range(3), spark.createDataFrame([(7, None)], "bar int, other string")
    assert rows(pairs.scatter_env(items, env)) == [(i, 7, None) for i in range(3)]
    for bad in (env.limit(0), env.union(env)):
        with pytest.raises(Exception, match="one row, not"):
            pairs.scatter_env(items, bad).collect()


def test_nested_scatter_checks_its_inner_side(spark, monkeypatch):
    monkeypatch.setattr(pairs, "MOST_INNER", 3)
    assert pairs.nested_scatter(spark.range(2), spark.range(3).toDF("j"), F.lit(1)).count() == 6
    with pytest.raises(ValueError, match="more than 3"):
        pairs.nested_scatter(spark.range(2), spark.range(4).toDF("j"), F.lit(1))


def test_ranks_of_a_hot_key_are_spread(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("k"), (F.col("id") % 50).alias("o"), "id")
    ranked = positions.with_ranks(df, ["k"], [F.col("o")]).withColumn("part", F.spark_partition_id()).collect()
    by_key = {}
    for x in ranked:
        by_key.setdefault(x.k, []).append(x)
    assert len(ranked) == 2000 and len(by_key) == 8
    for found in by_key.values():
        found.sort(key=lambda x: x["rank"])
        assert [x["rank"] for x in found] == list(range(len(found))) and [x.o for x in found] == sorted(x.o for x in found)


def test_tasks(spark):
    df = spark.createDataFrame([("b",), ("a",)], "line string")
    assert rows(tasks.pipe_task(df, "tr ab xy")) == [("x",), ("y",)]
    with pytest.raises(Exception):
        tasks.pipe_task(df, "false").collect()
    with pytest.raises(PySparkException):
        tasks.map_task(df, lambda f: f.assign(line=None), "line string", ("line",)).collect()


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("11\t12\n21\n")
    (tmp_path / "b.txt").write_text("7\n")
    (tmp_path / "empty.txt").write_text("")
    root = str(tmp_path)
    assert rows(text_sources.read_tsv(spark, f"{root}/a.txt").select("row", "cells")) == [(0, ["11", "12"]), (1, ["21"])]
    assert text_sources.read_scalar(spark, f"{root}/b.txt", "int").first().value == 7
    seen = text_sources.glob_files(spark, root, "*.txt")
    assert rows(seen.select("name", "size")) == [("a.txt", 9), ("b.txt", 2), ("empty.txt", 0)] and text_sources.glob_files(spark, root, "*.none").count() == 0
    files = spark.createDataFrame([("a.txt",), ("empty.txt",)], "name string")
    assert rows(text_sources.file_size(files, seen, path="name")) == [("a.txt", 9.0), ("empty.txt", 0.0)]
    lines = text_sources.read_lines(spark, f"{root}/*.txt").withColumn("file", F.regexp_extract("file", "[^/]*$", 0))
    assert rows(text_sources.line_count(lines, files.withColumnRenamed("name", "file"))) == [("a.txt", 2), ("empty.txt", 0)]
    assert rows(text_sources.literal_array(spark, ["x", "y"])) == [(0, "x"), (1, "y")] and text_sources.range_rows(spark, 0).count() == 0
    assert text_sources.read_gz_text(spark, f"{root}/b.txt", 2).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["3", "4"], {"k": 1}, None), (0, ["1"], {"j": 2}, "x")], "seq int, cells array<string>, m map<string,int>, n string")
    read = lambda name: [r.value for r in spark.read.text(str(tmp_path / name)).collect()]
    sinks.write_tsv(df, "cells", str(tmp_path / "tsv"), [F.col("seq")])
    assert "\n".join(read("tsv")) == "1\n3\t4"
    sinks.write_map(df, "m", str(tmp_path / "map"))
    assert sorted(read("map")) == ["j\t2", "k\t1"]
    sinks.write_outputs(df.select("seq", "n"), str(tmp_path / "out"), True)
    assert sorted(read("out")) == ['{"seq":0,"n":"x"}', '{"seq":1}']
    sinks.split_slices(df.select("seq", "n"), "seq", str(tmp_path / "slices"))
    assert spark.read.parquet(str(tmp_path / "slices")).where("seq = 1").count() == 1
    sinks.sort_lines(spark.createDataFrame([("b",), ("a",)], "line string"), str(tmp_path / "sorted"))
    assert read("sorted") == ["a", "b"]


def test_pipe_task_fails_with_its_command(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("line"))
    with pytest.raises(Exception, match="exit code"):
        tasks.pipe_task(df, "false").collect()
    assert tasks.pipe_task(df.where("line > '9'"), "cat").collect() == []


def test_pipe_task_command_may_end_early(spark):
    df = spark.range(0, 200_000, 1, 1).select(F.col("id").cast("string").alias("line"))
    assert [r.line for r in tasks.pipe_task(df, "head -n 2").collect()] == ["0", "1"]


def test_parse_request_of_bad_and_missing_text(spark):
    schema = "memory string, disks string, cpu string, gpu string"
    row = offers.parse_request(spark.createDataFrame([(None, None, None, None)], schema)).first()
    assert tuple(row) == (None, None, None, None)
    with pytest.raises(Exception, match="bad memory"):
        offers.parse_request(spark.createDataFrame([("much", None, None, None)], schema)).collect()


def test_rounds_of_items(spark, tmp_path):
    fn = lambda d: d.select("seq", (F.col("id") + 1).alias("next"))
    out = rounds.scatter_items(spark.range(25).repartition(3), [F.desc("id")], fn, str(tmp_path / "work"), 4)
    assert [(r.seq, r.next) for r in out.collect()] == [(i, 25 - i) for i in range(25)]
    assert out.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 4
    with pytest.raises(ValueError):
        rounds.scatter_items(spark.range(1), ["id"], fn, str(tmp_path / "other"), 1001)


def test_large_pairs_are_dealt_to_more_tasks(spark, sf_dir, duck, monkeypatch):
    from fanfold.plans import queries

    monkeypatch.setattr(offers, "PART_ROWS", 1000)
    out = queries.dominated(spark, sf_dir)
    assert rows_of(out.toPandas()) == rows_of(duck.execute(queries.ORACLE_SQL["dominated"]).df())
    assert out.rdd.getNumPartitions() > 10  # the session has 4 shuffle partitions
