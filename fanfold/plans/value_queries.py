"""Registered queries over sources, sinks, arrays, requests and checks, with their SQL.

Queries of sources and sinks write the given tables to the shared folder in the format at
hand, read them back and return what they read."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs, scalars
from ..operators import catalog, filters, gather, offers, pairs, positions, reads
from ..sources import sinks, typed
from ..sources import text as text_sources
from . import sets
from .queries import FILES, OFFERS, READS, event_reads, offer_name, page_files, part_offers, query, t


def folder(spark, label: str) -> str:
    """A new place in the shared folder."""
    return os.path.join(positions.shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def customers_written(spark, sf_dir, text, fmt: dict | None = None) -> str:
    """A file of ``text`` for the customers of each nation, below one folder."""
    path = folder(spark, "customers")
    rows = t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), text.alias("value"))
    rows.repartition("nation").write.options(**(fmt or {})).partitionBy("nation").text(path)
    return path


def nation_of(path):
    return F.regexp_extract(path, "nation=([0-9]+)/", 1).cast("int")


# sources and sinks


@query("SELECT c_nationkey AS nation, c_custkey || ' ' || c_name AS line FROM customer")
def read_lines(spark, sf_dir):
    path = customers_written(spark, sf_dir, F.concat_ws(" ", "c_custkey", "c_name"))
    return text_sources.read_lines(spark, path).select(nation_of("file").alias("nation"), "line")


@query("SELECT c_nationkey AS nation, count(*) AS n, max(c_custkey) AS last FROM customer GROUP BY 1")
def read_numbered_lines(spark, sf_dir):
    path = customers_written(spark, sf_dir, F.col("c_custkey").cast("string"))
    rows = text_sources.read_lines(spark, path, numbered=True)
    return rows.groupBy(nation_of("file").alias("nation")).agg((F.max("line_no") + 1).cast("long").alias("n"), F.max(F.col("line").cast("long")).alias("last"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 2 END AS width, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS last FROM customer")
def read_tsv(spark, sf_dir):
    path = folder(spark, "tsv")
    c = t(spark, sf_dir, "customer")
    cells = F.when(F.col("c_custkey") % 2 == 0, F.array(F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")).otherwise(F.array(F.col("c_custkey").cast("string"), "c_name"))
    sinks.write_tsv(c.select("c_custkey", cells.alias("cells")), "cells", path, [F.col("c_custkey")])
    rows = text_sources.read_tsv(spark, path)
    return rows.select(F.get("cells", F.lit(0)).cast("long").alias("id"), F.size("cells").alias("width"), F.element_at("cells", -1).alias("last"))


@query("SELECT o_custkey AS key, max(o_orderkey) AS value FROM orders GROUP BY 1")
def write_map(spark, sf_dir):
    path = folder(spark, "map")
    g = t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("last"))
    sinks.write_map(g.select(F.create_map("o_custkey", "last").alias("m")), "m", path)
    cells = spark.read.text(path).select(F.split("value", "\t").alias("c"))
    return cells.select(F.get("c", F.lit(0)).cast("long").alias("key"), F.get("c", F.lit(1)).cast("long").alias("value"))


@query("SELECT c_nationkey AS nation, sum(c_custkey)::BIGINT AS value FROM customer GROUP BY 1")
def read_scalar(spark, sf_dir):
    path = folder(spark, "scalar")
    sums = t(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.sum("c_custkey").cast("string").alias("value"))
    sums.write.partitionBy("nation").text(path)
    return text_sources.read_scalar(spark, path, "long").select(nation_of("file").alias("nation"), "value")


@query("SELECT c_nationkey AS nation, sum(length(c_name) + 1)::DOUBLE / 1000 AS size FROM customer GROUP BY 1 UNION ALL SELECT 99, 0")
def file_sizes(spark, sf_dir):
    path = customers_written(spark, sf_dir, F.col("c_name"))
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/nation=99/empty.txt")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    found = text_sources.glob_files(spark, path, "*.txt")
    known = found.select("path")
    sized = text_sources.file_size(known, found).withColumn("nation", nation_of("path"))
    total = text_sources.total_size(sized, ["nation"])
    return total.select("nation", text_sources.in_unit(F.col("size"), "KB").alias("size"))


@query("SELECT c_nationkey AS nation, count(*) AS n FROM customer WHERE contains(c_name, '1') GROUP BY 1")
def read_gz_text(spark, sf_dir):
    path = customers_written(spark, sf_dir, F.concat_ws(" ", "c_nationkey", "c_name"), {"compression": "gzip"})
    lines = text_sources.read_gz_text(spark, path, 8).where(F.contains("line", F.lit(" ")) & F.contains(F.split_part("line", F.lit(" "), F.lit(2)), F.lit("1")))
    return lines.groupBy(F.split_part("line", F.lit(" "), F.lit(1)).cast("int").alias("nation")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price, o_orderstatus = 'F' AS absent FROM orders")
def write_outputs(spark, sf_dir):
    path = folder(spark, "outputs")
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"))
    sinks.write_outputs(o, path, drop_nulls=True)
    back = spark.read.text(path)
    price = F.get_json_object("value", "$.price")
    return back.select(F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"), price.cast("double").alias("price"), (~F.contains("value", F.lit("price"))).alias("absent"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'")
def split_slices(spark, sf_dir):
    path = folder(spark, "slices")
    sinks.split_slices(t(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "event_type", path)
    return spark.read.parquet(path).where("event_type = 'click'")


@query("""
SELECT c_custkey, c_nationkey AS nation, c_name AS "left", c_custkey + 1 AS "right", c_mktsegment || ';' || c_name AS tags FROM customer""")
def read_inputs(spark, sf_dir):
    kind = T.StructType([T.StructField("nation", T.IntegerType()), T.StructField("pair", T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.LongType())])), T.StructField("tags", T.ArrayType(T.StringType()))])
    both = F.struct(F.col("c_name").alias("left"), (F.col("c_custkey") + 1).alias("right"))
    raw = F.to_json(F.struct(F.lit("a comment").alias("##note"), F.col("c_nationkey").alias("nation"), both.alias("pair"), F.array("c_mktsegment", "c_name").alias("tags")))
    rows = typed.read_inputs(t(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw")), "raw", kind)
    return rows.select("c_custkey", "nation", "pair.left", "pair.right", F.array_join("tags", ";").alias("tags"))


# arrays and values


@query("""
SELECT conv_id, count(*)::INT AS n, (count(*) * (count(*) - 1) // 2)::BIGINT AS positions, string_agg((turn - least_turn) || ':' || role, ',' ORDER BY turn) AS zipped,
  arg_max(role, turn) AS last, string_agg(role, ',' ORDER BY turn) || ',' || string_agg(role, ',' ORDER BY turn) AS twice,
  string_agg(role || '/' || length(text), ',' ORDER BY turn) AS columns
FROM (SELECT *, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) + 1 AS least_turn FROM conversations) GROUP BY conv_id""")
def array_functions(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("size", F.length("text").cast("string"))
    g = c.groupBy("conv_id").agg(gather.gathered("turn", "role").alias("roles"), gather.gathered("turn", "size").alias("sizes"))
    roles, places = scalars.non_empty("roles"), scalars.range_(F.size("roles"))
    text = lambda sep: lambda p: F.concat_ws(sep, p["left"].cast("string"), p["right"])
    columns = F.transform(scalars.transpose(F.array("roles", "sizes")), lambda pair: F.array_join(pair, "/"))
    return g.select(
        "conv_id",
        scalars.length("roles").alias("n"),
        F.aggregate(places, F.lit(0).cast("long"), lambda a, x: a + x).alias("positions"),
        F.array_join(F.transform(scalars.zip_(places, roles), text(":")), ",").alias("zipped"),
        scalars.item_at("roles", F.size("roles") - 1).alias("last"),
        F.array_join(scalars.flatten(F.array("roles", F.lit(None).cast("array<string>"), "roles")), ",").alias("twice"),
        F.array_join(columns, ",").alias("columns"),
    )


@query("SELECT conv_id, string_agg(turn || '=' || role, ',' ORDER BY turn) AS pairs FROM conversations GROUP BY conv_id")
def map_pairs(spark, sf_dir):
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("turn", "role"))))
    g = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(entries.alias("m"))
    return g.select("conv_id", F.array_join(F.transform(F.array_sort(scalars.as_pairs("m")), lambda p: F.concat_ws("=", p["left"].cast("string"), p["right"])), ",").alias("pairs"))


@query("""
SELECT o_orderkey, 9007199254740993 + o_orderkey AS big, 9007199254740993 + o_orderkey AS pointed, floor(o_totalprice)::BIGINT AS cut, o_totalprice AS price, o_orderkey::VARCHAR AS key_text, o_orderstatus = 'F' AS done FROM orders""")
def coerce(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    big = (F.lit(9007199254740993) + F.col("o_orderkey")).cast("string")
    return o.select(
        "o_orderkey",
        exprs.coerce(big, "long").alias("big"),
        exprs.coerce(F.concat(big, F.lit(".0")), "long").alias("pointed"),
        exprs.coerce(F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("e0")), "long").alias("cut"),
        exprs.coerce(F.col("o_totalprice").cast("string"), "double").alias("price"),
        exprs.coerce("o_orderkey", "string").alias("key_text"),
        exprs.coerce(F.when(F.col("o_orderstatus") == "F", "true").otherwise("false"), "boolean").alias("done"),
    )


@query("SELECT c_custkey AS key___id, c_name AS key___name FROM customer")
def rename_flat(spark, sf_dir):
    nested = t(spark, sf_dir, "customer").toDF("key.id", "key.name", "nation", "balance", "segment")
    flat = exprs.rename_flat(exprs.unrename(exprs.rename_flat(nested)))
    return exprs.export_only(flat, ["key___id", "key___name"])


@query("""
SELECT page_id, regexp_replace(url, '[\\x00-\\x1F\\x7F"''`\\\\]', ' ', 'g') AS clean, regexp_extract(url, '([^.]*)$', 1) AS last,
  CASE WHEN contains(url, '/') THEN regexp_replace(url, '/[^/]*$', '') ELSE '' END = CASE WHEN contains(url, '/') THEN regexp_replace(url || '?x', '/[^/]*$', '') ELSE '' END AS same FROM pages""")
def url_texts(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", scalars.clean_text("url").alias("clean"), scalars.unqualified("url").alias("last"), scalars.same_folder("url", F.concat("url", F.lit("?x"))).alias("same"))


@query("SELECT event_id, (user_id % 5)::INT AS days, (event_id % 24)::INT AS hours, (event_id % 60)::INT AS minutes, ((user_id % 5) * 1440 + (event_id % 24) * 60 + event_id % 60)::INT AS total FROM events")
def durations(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    text = F.concat(F.col("user_id") % 5, F.lit("D"), F.col("event_id") % 24, F.lit("H"), F.col("event_id") % 60, F.lit("M"))
    return e.select("event_id", scalars.duration(text).alias("d")).select("event_id", "d.*")


@query("""
SELECT o_orderkey, '/old/.Record_archive' AS target, 'order-' || o_orderkey || ' ' || strftime(o_orderdate + INTERVAL 1 HOUR, '%a %b %d %H:%M:%S %Y') AS archived_as FROM orders""")
def archive_plan(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("order-"), F.col("o_orderkey")).alias("name"), F.lit("/old/").alias("folder"), F.lit("record").alias("class"), (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("created")
    )
    return sets.archive_plan(o).select("o_orderkey", "target", "archived_as")


@query("SELECT p_partkey, p_size * 1024 AS memory_mb, (p_partkey % 64)::INT AS disk_gb, (p_size % 8)::INT AS cpu, p_size % 2 = 0 AS gpu FROM part")
def parse_request(spark, sf_dir):
    size = F.col("p_size")
    asked = t(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 2 == 0, F.concat(size, F.lit(" GiB"))).otherwise(F.concat(size * 1024, F.lit("MiB"))).alias("memory"),
        F.concat(F.lit("local-disk "), F.col("p_partkey") % 64, F.lit(" HDD")).alias("disks"),
        F.concat(size % 8, F.lit(".7")).alias("cpu"),
        F.when(size % 2 == 0, "true").otherwise("false").alias("gpu"),
    )
    return offers.parse_request(asked)


# scatter, gather and checks


@query("""
SELECT conv_id, string_agg(role, ',' ORDER BY turn) AS role, string_agg(CASE WHEN turn % 2 = 0 THEN length(text)::VARCHAR END, ',' ORDER BY turn) AS even,
  string_agg(CASE WHEN turn % 2 = 0 THEN length(text)::VARCHAR ELSE '-' END, ',' ORDER BY turn) AS padded FROM conversations GROUP BY conv_id""")
def gather_results(spark, sf_dir):
    size = F.length("text").cast("string")
    some = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("role"), F.col("role"), F.lit("even"), size)).otherwise(F.create_map(F.lit("role"), F.col("role")))
    r = t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("parent_id"), F.col("turn").alias("seq"), some.alias("outputs"))
    out = gather.gather_results(gather.order_by_seq(r), {"role": "required", "even": "optional"})
    padded = gather.gather_results(r, {"even": "optional"}, absent="null").withColumnRenamed("even", "padded")
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, ",", "-")).alias(c)
    return out.join(padded, "parent_id").select(F.col("parent_id").alias("conv_id"), text("role"), text("even"), text("padded"))


@query("SELECT l_orderkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY 1")
def sum_values(spark, sf_dir):
    return gather.sum_values(t(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity")


@query("SELECT o_orderkey, o_totalprice > bar AS over FROM orders, (SELECT avg(c_acctbal) * 20 AS bar FROM customer)")
def scatter_env(spark, sf_dir):
    env = t(spark, sf_dir, "customer").agg((F.avg("c_acctbal") * 20).alias("bar"))
    return pairs.scatter_env(t(spark, sf_dir, "orders"), env).select("o_orderkey", (F.col("o_totalprice") > F.col("bar")).alias("over"))


@query("SELECT conv_id, turn AS seq, role, length(text) AS size FROM conversations")
def zip_strict(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumnRenamed("turn", "seq")
    return pairs.zip_tables(c.select("conv_id", "seq", "role"), c.select("conv_id", "seq", F.length("text").cast("long").alias("size")), ["conv_id"])


@query(f"SELECT gem_group AS chunk_id, count(*) AS reads, count(DISTINCT barcode) AS barcodes, count(umi) AS umis FROM ({READS}) GROUP BY 1")
def pair_chunks(spark, sf_dir):
    r = event_reads(spark, sf_dir).withColumnRenamed("gem_group", "chunk_id").groupBy("chunk_id")
    return pairs.pair_chunks(r.agg(F.count("*").alias("reads")), r.agg(F.count_distinct("barcode").alias("barcodes")), r.agg(F.count("umi").alias("umis")))


@query("SELECT c_custkey AS id FROM customer UNION ALL SELECT s_suppkey FROM supplier UNION ALL SELECT p_partkey FROM part")
def flatten_union(spark, sf_dir):
    return gather.flatten_union(*(t(spark, sf_dir, table).select(F.col(key).alias("id")) for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"))))


@query("SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(n_chars, 0) AS n_chars, coalesce(source, 'unknown') AS source FROM documents")
def typed_defaults(spark, sf_dir):
    return filters.typed_defaults(t(spark, sf_dir, "documents"), {"lang": "none", "n_chars": 0, "source": "unknown"}).select("doc_id", "lang", "n_chars", "source")


@query("SELECT event_id, event_type AS archival_state FROM events WHERE event_type <> 'view'")
def live_only(spark, sf_dir):
    state = F.when(F.col("event_type") == "view", "live").otherwise(F.col("event_type"))
    return filters.live_only(t(spark, sf_dir, "events").select("event_id", state.alias("archival_state")), mode="report")


# offers


def machine_offers(spark, sf_dir) -> DataFrame:
    """Parts as offers with a release, whole gigabytes of memory and names to bar."""
    p = t(spark, sf_dir, "part")
    release = F.when(F.col("p_partkey") % 3 > 0, offers.RELEASE).otherwise("14.04")
    name = F.concat_ws("_", offer_name(), F.when(F.col("p_partkey") % 5 == 0, "hdd").when(F.col("p_partkey") % 7 == 0, "test"))
    return p.select("p_partkey", name.alias("name"), (F.col("p_size") * 1024).alias("memory_mb"), (F.col("p_size") % 8).alias("cpu"), F.array(F.struct(release.alias("release"))).alias("os"))


@query("SELECT p_partkey, p_size >= 3 AND p_size % 8 >= 2 AND p_partkey % 7 <> 0 AS standard FROM part WHERE p_partkey % 3 > 0 AND p_partkey % 5 <> 0")
def offer_filter(spark, sf_dir):
    fit = offers.offer_filter(machine_offers(spark, sf_dir))
    standard = offers.default_filter(fit).select("p_partkey", F.lit(True).alias("standard"))
    return fit.select("p_partkey").join(standard, "p_partkey", "left").withColumn("standard", F.coalesce("standard", F.lit(False)))


@query(f"SELECT name, price FROM ({OFFERS})")
def order_offers(spark, sf_dir):
    return offers.order_offers(part_offers(spark, sf_dir)).select("name", "price")


@query(f"""
WITH o AS (SELECT *, cpu % 2 = 0 AS gpu, CASE WHEN contains(name, '_v2') THEN 0 ELSE 1 END AS v1 FROM ({OFFERS})),
r AS (SELECT c_custkey, c_custkey % 50 AS m, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 60 END AS d, c_custkey % 7 AS c, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 2 = 0 END AS g FROM customer),
q AS (SELECT DISTINCT m, d, c, g FROM r), k AS (SELECT m, d, c, g, arg_min(name, (price, v1, name)) AS best FROM q JOIN o ON memory_mb >= m AND (d IS NULL OR disk_gb >= d) AND cpu >= c AND (g IS NULL OR gpu = g) GROUP BY ALL)
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN name ELSE best END AS offer FROM r LEFT JOIN k ON r.m = k.m AND r.d IS NOT DISTINCT FROM k.d AND r.c = k.c AND r.g IS NOT DISTINCT FROM k.g
LEFT JOIN o ON name = 'p' || c_custkey OR name = 'p' || c_custkey || '_v2'""")
def cheapest_of_all_axes(spark, sf_dir):
    k = F.col("c_custkey")
    named = F.when(k % 10 == 0, F.concat(F.lit("p"), k, F.when(k % 2 == 0, "_v2").otherwise("")))
    asked = t(spark, sf_dir, "customer").select(
        "c_custkey", (k % 50).alias("memory_mb"), F.when(k % 4 > 0, k % 60).alias("disk_gb"), (k % 7).alias("cpu"), F.when(k % 3 > 0, k % 2 == 0).alias("gpu"), named.alias("offer_name")
    )
    with_gpu = part_offers(spark, sf_dir).withColumn("gpu", F.col("cpu") % 2 == 0)
    return offers.cheapest_offer(asked, with_gpu, equal=("gpu",), mode="report").select("c_custkey", "offer")


# catalog and sets


@query(f"SELECT page_id, name FROM ({FILES}) WHERE project = 'project-1' AND (folder = '/www.example.org' OR starts_with(folder, '/') AND length(folder) > 1) AND page_id IN (SELECT item_id FROM benchmark)")
def scan_catalog(spark, sf_dir):
    f = page_files(spark, sf_dir).where("length(folder) > 1").withColumn("class", F.lit("file")).withColumn("properties", F.create_map(F.lit("page"), F.col("page_id")))
    wanted = t(spark, sf_dir, "benchmark").select(F.concat(F.lit("file-"), F.col("item_id")).alias("id"))
    return catalog.scan_catalog(f, project="project-1", folder="/", klass="file", with_properties=["page"], ids=wanted, fields=["page_id", "name"])


@query(f"SELECT page_id, name FROM ({FILES}) WHERE name IN (SELECT name FROM ({FILES}) WHERE project = 'project-2')")
def match_names(spark, sf_dir):
    f = page_files(spark, sf_dir)
    return catalog.match_names(f, f.where("project = 'project-2'")).select("page_id", "name")


@query(f"SELECT project, string_agg(id || '@' || name || '@' || folder, ',' ORDER BY id) AS files FROM ({FILES}) GROUP BY 1")
def manifest_by_container(spark, sf_dir):
    m = catalog.manifest_by_container(page_files(spark, sf_dir))
    return m.select("project", F.array_join(F.transform("files", lambda f: F.concat_ws("@", f["id"], f["name"], f["folder"])), ",").alias("files"))


@query("SELECT DISTINCT url FROM pages")
def distinct_refs(spark, sf_dir):
    return catalog.distinct_refs(t(spark, sf_dir, "pages").select("url"))


@query("SELECT url AS path FROM pages WHERE url IS NOT NULL AND page_id NOT IN (SELECT item_id FROM benchmark) AND url NOT IN (SELECT url FROM pages WHERE page_id IN (SELECT item_id FROM benchmark)) AND url NOT IN (SELECT url FROM pages WHERE url LIKE 'https:%')")
def to_upload(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    came = p.join(t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("page_id")), "page_id", "left_semi")
    return sets.to_upload(p, came, p.where("path LIKE 'https:%'")).select("path")


@query("SELECT event_id, 'few' AS kind FROM events WHERE value > 50 AND (SELECT count(*) FROM events WHERE value > 50) <= 1000000 UNION ALL SELECT event_id, 'many' FROM events WHERE value > 50 AND (SELECT count(*) FROM events WHERE value > 50) <= 10")
def outputs_up_to(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    start = F.lit("1970-01-01").cast("timestamp")
    some = lambda most, kind: sets.real_outputs(e, e.where("value <= 50"), start, "event_id", "ts", most).select("event_id", F.lit(kind).alias("kind"))
    return some(1_000_000, "few").unionByName(some(10, "many"))


# reads


@query(f"SELECT ((row_number() OVER (ORDER BY read_id) - 1) // 1500)::BIGINT AS chunk, read_id FROM ({READS})")
def chunk_reads(spark, sf_dir):
    return reads.chunk_reads(event_reads(spark, sf_dir), 1500).select("chunk", "read_id")


BASE4 = "array_to_string(list_transform(range(6), lambda i: substr('ACGT', 1 + ((user_id // (4 ** (5 - i))::BIGINT) % 4)::INT, 1)), '')"


@query(f"""
WITH r AS (SELECT event_id AS read_id, user_id % 2 AS g, {BASE4} AS barcode FROM events), l AS (SELECT DISTINCT barcode FROM r WHERE right(barcode, 1) <> 'T'),
n AS (SELECT g, barcode, count(*) + 1 AS w FROM r JOIN l USING (barcode) GROUP BY ALL),
near AS (SELECT DISTINCT r.g, r.barcode, l.barcode AS candidate, coalesce(n.w, 1) AS w FROM (SELECT DISTINCT g, barcode FROM r) r JOIN l ON hamming(r.barcode, l.barcode) = 1 LEFT JOIN n ON n.g = r.g AND n.barcode = l.barcode
  WHERE r.barcode NOT IN (SELECT barcode FROM l)),
place AS (SELECT *, list_position(list_transform(range(1, 7), lambda i: substr(barcode, i, 1) = substr(candidate, i, 1)), false) - 1 AS i FROM near),
p AS (SELECT read_id, candidate, w * pow(10.0::DOUBLE, -(10 + (read_id + i) % 25) / 10.0::DOUBLE) AS p FROM r JOIN place USING (g, barcode)),
best AS (SELECT read_id, CASE WHEN max(p) / sum(p) >= 0.3 THEN arg_max(candidate, (p, candidate)) END AS best FROM p GROUP BY 1)
SELECT read_id, CASE WHEN barcode IN (SELECT barcode FROM l) THEN barcode ELSE best END AS corrected FROM r LEFT JOIN best USING (read_id)""")
def correct_barcodes(spark, sf_dir):
    digit = lambda i: F.substring(F.lit("ACGT"), (F.floor(F.col("user_id") / 4 ** (5 - i)) % 4 + 1).cast("int"), F.lit(1))
    quality = F.array(*((10 + (F.col("event_id") + i) % 25).cast("int") for i in range(6)))
    r = t(spark, sf_dir, "events").select(F.col("event_id").alias("read_id"), (F.col("user_id") % 2).alias("gem_group"), F.concat(*map(digit, range(6))).alias("barcode"), quality.alias("barcode_qual"))
    listed = r.where(~F.col("barcode").endswith("T")).select("barcode").distinct()
    return reads.correct_barcodes(r, listed, reads.barcode_counts(r, listed), 0.3).select("read_id", "corrected")


@query("""
SELECT o_orderkey, upper(md5('{"m":{"a' || o_custkey % 3 || '":1,"z":null},"n":{"a":["' || o_orderstatus || '",null],"b":{"x":' || o_custkey || ',"y":"' || o_orderpriority || '"}}}')) AS digest FROM orders
UNION ALL SELECT o_orderkey, upper(md5('{"m":{"a' || o_custkey % 3 || '":1,"z":null},"n":{"a":["' || o_orderstatus || '",null],"b":{"x":' || o_custkey || ',"y":"' || o_orderpriority || '"}}}')) FROM orders""")
def row_digest_nested(spark, sf_dir):
    """Two layouts of one nested value have one digest."""
    o, none = t(spark, sf_dir, "orders"), F.lit(None)
    key = F.concat(F.lit("a"), (F.col("o_custkey") % 3).cast("string"))
    x, y, status = F.col("o_custkey").alias("x"), F.col("o_orderpriority").alias("y"), F.array("o_orderstatus", none.cast("string"))
    one = o.select("o_orderkey", F.create_map(key, F.lit(1), F.lit("z"), none.cast("int")).alias("m"), F.struct(F.struct(y, x).alias("b"), status.alias("a")).alias("n"))
    other = o.select("o_orderkey", F.struct(status.alias("a"), F.struct(x, y).alias("b")).alias("n"), F.create_map(F.lit("z"), none.cast("int"), key, F.lit(1)).alias("m"))
    return one.select("o_orderkey", scalars.row_digest("m", "n").alias("digest")).union(other.select("o_orderkey", scalars.row_digest("n", "m").alias("digest")))


@query("SELECT page_id AS path, CASE WHEN page_id IN (SELECT item_id FROM benchmark) THEN url END AS url FROM pages")
def with_urls(spark, sf_dir):
    """Outputs with their urls; those that weren't stored have none."""
    p = t(spark, sf_dir, "pages").select(F.col("page_id").alias("path"), "url")
    kept = p.join(t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("path")), "path", "left_semi")
    return sets.with_urls(p.select("path"), kept)


# order that the result can show


@query("SELECT row_number() OVER (ORDER BY c_name) - 1 AS place, c_name AS line FROM customer")
def sorted_sink(spark, sf_dir):
    """The lines of the sorted sink's files, in the order of files and of lines."""
    path = folder(spark, "sorted")
    sinks.sort_lines(t(spark, sf_dir, "customer").repartition(8).select(F.col("c_name").alias("line")), path)
    lines = text_sources.read_lines(spark, path, numbered=True)
    return positions.with_positions(lines, [F.col("file"), F.col("line_no")], "place").select("place", "line")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS place, o_orderkey::VARCHAR AS key_text, o_orderstatus AS status FROM orders")
def ordered_tsv(spark, sf_dir):
    """The rows of an ordered TSV sink, in the order of files and of lines."""
    path = folder(spark, "ordered")
    o = t(spark, sf_dir, "orders").repartition(8, "o_custkey").select("o_orderkey", F.array(F.col("o_orderkey").cast("string"), "o_orderstatus").alias("cells"))
    sinks.write_tsv(o, "cells", path, [F.col("o_orderkey")])
    rows = positions.with_positions(text_sources.read_tsv(spark, path), [F.col("file"), F.col("row")], "place")
    return rows.select("place", F.get("cells", F.lit(0)).alias("key_text"), F.get("cells", F.lit(1)).alias("status"))


@query(f"SELECT row_number() OVER (ORDER BY substr(barcode, 1, 5) NULLS LAST, barcode) - 1 AS place, barcode FROM ({READS})")
def ordered_buckets(spark, sf_dir):
    """Barcodes in the order in which bucket_sort_merge leaves its rows."""
    ordered, _ = positions.bucket_sort_merge(event_reads(spark, sf_dir), reads.bucket(5), "barcode")
    left = positions.stored(ordered.select("barcode", F.monotonically_increasing_id().alias("at")), "ordered")
    return positions.with_positions(left, [F.col("at")], "place").select("place", "barcode")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price, true AS present FROM orders")
def write_outputs_with_nulls(spark, sf_dir):
    """Records of a fragment keep their null fields."""
    path = folder(spark, "outputs")
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("price"))
    sinks.write_outputs(o, path, drop_nulls=False)
    back = spark.read.text(path)
    return back.select(F.get_json_object("value", "$.o_orderkey").cast("long").alias("o_orderkey"), F.get_json_object("value", "$.price").cast("double").alias("price"), F.contains("value", F.lit('"price":')).alias("present"))
