"""The registered queries over the library's operators, with their SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs, scalars
from ..operators import catalog, edits, filters, gather, merge, offers, pairs, positions, reads, tasks
from ..sources import text as text_sources
from ..sources import typed
from ..streaming.rounds import chunked_scatter as run_rounds
from ..streaming.rounds import scatter_items as run_items
from . import graph, sets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if SQL can express it."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def doc_lines(spark, sf_dir) -> DataFrame:
    """Documents as files of numbered lines."""
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), F.coalesce("text", F.lit("")).alias("t"))
    return d.select("file", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))


LINES = "SELECT doc_id AS file, unnest(range(len(string_split(coalesce(text, ''), chr(10)))))::INT AS line_no, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents"


# gather and scatter


@query("SELECT conv_id, count(*) AS n_turns, string_agg(role, ',' ORDER BY turn) AS roles, string_agg(length(text)::VARCHAR, ',' ORDER BY turn) AS sizes FROM conversations GROUP BY conv_id")
def gather_turns(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("size", F.length("text"))
    g = c.groupBy("conv_id").agg(gather.gathered("turn", "role").alias("roles"), gather.gathered("turn", "size").alias("sizes"))
    return g.select("conv_id", F.size("roles").cast("long").alias("n_turns"), scalars.join_str("roles", ",").alias("roles"), scalars.join_str("sizes", ",").alias("sizes"))


@query("""
SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN length(text)::VARCHAR ELSE 'null' END, ',' ORDER BY turn) AS kept,
  count(*) FILTER (role = 'user') AS present FROM conversations GROUP BY conv_id""")
def gather_null_kept(spark, sf_dir):
    c = exprs.bool_if(t(spark, sf_dir, "conversations"), F.col("role") == "user", {"size": F.length("text")})
    g = gather.gather(c, ["conv_id"], "turn", "size")
    kept = F.array_join(F.transform("size", lambda x: x.cast("string")), ",", "null")
    return g.select("conv_id", kept.alias("kept"), F.size(scalars.select_all("size")).cast("long").alias("present"))


@query("""
SELECT c_custkey, string_agg(row_text, ';' ORDER BY n_nationkey) AS cells FROM (
  SELECT c_custkey, n_nationkey, string_agg((100 * c_custkey + n_nationkey + k)::VARCHAR, ',' ORDER BY k) AS row_text
  FROM customer, nation, range(3) AS x(k) GROUP BY c_custkey, n_nationkey) GROUP BY c_custkey""")
def nested_scatter(spark, sf_dir):
    outer = pairs.nested_scatter(t(spark, sf_dir, "customer").select("c_custkey"), t(spark, sf_dir, "nation"), 100 * F.col("c_custkey") + F.col("n_nationkey"))
    cells = pairs.nested_scatter(outer, text_sources.range_rows(spark, 3, "k"), F.col("value") + F.col("k"))
    g = gather.gather_nested(cells, ["c_custkey"], ["n_nationkey", "k"], "value")
    return g.select("c_custkey", F.array_join(F.transform("value", lambda row: scalars.join_str(row, ",")), ";").alias("cells"))


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1 AS seq FROM conversations)
SELECT u.conv_id, u.seq::INT AS seq, u.turn AS asked, a.turn AS answered FROM r u JOIN r a ON u.conv_id = a.conv_id AND u.seq = a.seq AND u.role = 'user' AND a.role = 'assistant'""")
def zip_positions(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("seq", F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn")) - 1)
    side = lambda role, name: c.where(F.col("role") == role).select("conv_id", "seq", F.col("turn").alias(name))
    return pairs.zip_tables(side("user", "asked"), side("assistant", "answered"), ["conv_id"], strict=False)


@query("SELECT d::INT AS r, vec_id AS c, embedding[d + 1]::DOUBLE AS value FROM embeddings, unnest(range(len(embedding))) AS x(d)")
def transpose_matrix(spark, sf_dir):
    first = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("r"), F.posexplode("embedding").alias("c", "value"))
    return pairs.transpose(first.withColumn("value", F.col("value").cast("double")), "r", "c").select("r", "c", "value")


# expressions


@query("""
SELECT o_orderkey, (o_orderkey // 7)::INT AS part, ((o_orderkey % 7 + 7) % 7)::BIGINT AS rest, ceil(o_totalprice)::INT AS up, floor(o_totalprice)::INT AS down,
  round(o_totalprice)::INT AS near, 'order ' || o_orderkey || ':' || o_orderstatus AS label, regexp_replace(o_orderpriority, '[0-9]-', '#', 'g') AS priority,
  (o_orderkey // 7)::INT * 2 AS twice, (o_orderkey // 7)::INT * 2 + 1 AS more FROM orders""")
def expr_basics(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select(
        "o_orderkey",
        scalars.divide_int("o_orderkey", F.lit(7)).alias("part"),
        scalars.modulo("o_orderkey", F.lit(7)).alias("rest"),
        scalars.ceil("o_totalprice").alias("up"),
        scalars.floor("o_totalprice").alias("down"),
        scalars.round_("o_totalprice").alias("near"),
        scalars.interpolate("order ~{k}:${s}", k="o_orderkey", s="o_orderstatus").alias("label"),
        scalars.sub("o_orderpriority", "[0-9]-", "#").alias("priority"),
    )
    return exprs.with_exprs(o, [("more", "twice + 1", "int"), ("twice", "part * 2", "int")])


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS done_by, CASE WHEN o_totalprice > 100000 THEN 'large' END AS size,
  coalesce(CASE WHEN o_totalprice > 100000 THEN 'large' END, CASE WHEN o_orderstatus = 'F' THEN 'done' END, 'open') AS label FROM orders""")
def branch_null(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    o = exprs.bool_if(o, F.col("o_orderstatus") == "F", {"done_by": F.col("o_custkey"), "done": F.lit("done")})
    o = exprs.bool_if(o, F.col("o_totalprice") > 100000, {"size": F.lit("large")})
    return o.select("o_orderkey", "done_by", "size", scalars.select_first("size", "done", F.lit("open")).alias("label"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_brand) || '/' || p_size END AS costly FROM part")
def branch_rows(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    fn = lambda d: d.withColumn("costly", scalars.concat_text(F.upper("p_brand"), F.lit("/"), "p_size"))
    return exprs.row_if(p, F.col("p_size") > 25, fn, ["p_partkey"]).select("p_partkey", "costly")


@query("""
SELECT event_id, user_id::INT AS who, coalesce(CASE WHEN event_type <> 'click' THEN value END, user_id * 0.5)::DOUBLE AS amount,
  CASE WHEN user_id % 2 = 0 THEN event_type END AS note, 7 AS version FROM events""")
def bind_inputs(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn(
        "supplied",
        F.map_concat(
            F.create_map(F.lit("who"), F.col("user_id").cast("string")),
            F.when(F.col("event_type") != "click", F.create_map(F.lit("amount"), F.col("value").cast("string"))).otherwise(F.create_map().cast("map<string,string>")),
            F.when(F.col("user_id") % 2 == 0, F.create_map(F.lit("note"), F.col("event_type"))).otherwise(F.create_map().cast("map<string,string>")),
        ),
    )
    spec = [("who", "int", "required", None), ("amount", "double", "default", "who * 0.5D"), ("note", "string", "optional", None), ("version", "int", "fixed", "7")]
    return exprs.bind_inputs(e, "supplied", spec).select("event_id", "who", "amount", "note", "version")


@query("""
SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey END AS total, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END::BIGINT AS n,
  o_orderpriority AS label, o_custkey % 7 AS level, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS inner_id FROM orders""")
def bind_nested_inputs(spark, sf_dir):
    """Arrays, pairs in both forms, maps and structs in structs, supplied as JSON text;
    a default array is made of an input before it."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    none = F.create_map().cast("map<string,string>")
    pair = F.when(key % 2 == 0, F.format_string('{"left":"%s","right":%d}', "o_orderpriority", customer % 7)).otherwise(F.format_string('["%s",%d]', "o_orderpriority", customer % 7))
    orders = t(spark, sf_dir, "orders").withColumn(
        "supplied",
        F.map_concat(
            F.create_map(F.lit("who"), customer.cast("string"), F.lit("pair"), pair),
            F.when(key % 3 != 0, F.create_map(F.lit("parts"), F.format_string("[%d, %d]", customer, "o_orderkey"))).otherwise(none),
            F.create_map(F.lit("tags"), F.when(key % 2 == 0, F.format_string('{"status":"%s","##":"a comment"}', "o_orderstatus")).otherwise("null")),
            F.when(key % 5 == 0, F.create_map(F.lit("deep"), F.format_string('{"inner":{"ids":[%d]}}', customer))).otherwise(none),
        ),
    )
    spec = [
        ("who", "bigint", "required", None),
        ("parts", "array<bigint>", "default", "array(who)"),
        ("pair", "struct<left:string,right:bigint>", "required", None),
        ("tags", "map<string,string>", "optional", None),
        ("deep", "struct<inner:struct<ids:array<bigint>>>", "optional", None),
    ]
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x)
    return exprs.bind_inputs(orders, "supplied", spec).select(
        "o_orderkey", total.alias("total"), F.size("parts").cast("long").alias("n"), F.col("pair.left").alias("label"), F.col("pair.right").alias("level"),
        F.try_element_at("tags", F.lit("status")).alias("status"), F.get("deep.inner.ids", F.lit(0)).alias("inner_id"),
    )


@query("""
SELECT c_custkey AS key, coalesce(max(CASE WHEN o_orderstatus = 'P' THEN 'pending' END), max(o_orderpriority), c_mktsegment) AS value
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_mktsegment""")
def merge_layers(spark, sf_dir):
    o = t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key"))
    base = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("value"))
    known = lambda d: d.join(base.select("key"), "key", "left_semi")
    first, second = o.agg(F.max("o_orderpriority").alias("value")), o.agg(F.max(F.when(F.col("o_orderstatus") == "P", F.lit("pending"))).alias("value"))
    return merge.merge_overrides(base, known(first), known(second), key="key")


# filters


@query(f"SELECT file, p AS pattern, count(*) FILTER (regexp_matches(line, p)) AS n FROM ({LINES}), (VALUES ('the'), ('[0-9]+'), ('^[A-Z].*[.]$')) AS x(p) GROUP BY file, p")
def grep_counts(spark, sf_dir):
    return filters.grep_count(doc_lines(spark, sf_dir), ["the", "[0-9]+", "^[A-Z].*[.]$"])


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def choices(spark, sf_dir):
    return filters.choices(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", ["1-URGENT", "2-HIGH"], mode="report")


@query("SELECT page_id, url FROM pages WHERE (regexp_matches(url, '^https://.*[.]html$') OR regexp_matches(url, '^http://www[.].*/$')) AND contains(html, 'lang=\"en\"')")
def patterns(spark, sf_dir):
    p = t(spark, sf_dir, "pages").withColumn("class", F.when(F.contains("html", F.lit('lang="en"')), "en"))
    return p.where(filters.patterns(["https://*.html", "http://www.*/"], "en", name_col="url")).select("page_id", "url")


@query("SELECT p_partkey FROM part WHERE contains(p_type, 'A') AND (contains(p_brand, '1') OR contains(p_brand, '2'))")
def constraint_tree(spark, sf_dir):
    leaf = lambda tag: F.contains(tag.split(":")[0], F.lit(tag.split(":")[1]))
    return t(spark, sf_dir, "part").where(filters.constraint_tree({"and": ["p_type:A", {"or": ["p_brand:1", "p_brand:2"]}]}, leaf)).select("p_partkey")


@query("""
SELECT o_orderstatus, 'price' AS rule, count(*) AS n FROM orders WHERE NOT coalesce(o_totalprice < 200000, false) GROUP BY 1
UNION ALL SELECT o_orderstatus, 'urgent' AS rule, count(*) AS n FROM orders WHERE NOT coalesce(o_orderpriority <> '1-URGENT', false) GROUP BY 1""")
def validate_rows(spark, sf_dir):
    return filters.validate_rows(t(spark, sf_dir, "orders"), {"price": F.col("o_totalprice") < 200000, "urgent": F.col("o_orderpriority") != "1-URGENT"}, "o_orderstatus")


# text


@query("SELECT doc_id AS file, sum(len(string_split(coalesce(text, ''), chr(10))) - 1)::BIGINT AS n FROM documents GROUP BY doc_id")
def line_counts(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), F.split(F.coalesce("text", F.lit("")), "\n").alias("parts"))
    ended = d.select("file", F.explode(F.slice("parts", F.lit(1), F.size("parts") - 1)).alias("line"))  # as in files, a newline ends a line
    return text_sources.line_count(ended, d.select("file").distinct())


@query(f"SELECT file, line_no, line FROM ({LINES}) WHERE line_no < 2")
def head_lines(spark, sf_dir):
    return positions.head(doc_lines(spark, sf_dir), 2)


@query(f"SELECT (row_number() OVER (ORDER BY line) - 1)::BIGINT AS seq, line FROM ({LINES})")
def sort_lines(spark, sf_dir):
    return positions.with_positions(doc_lines(spark, sf_dir).select("line"), [F.col("line")]).select("seq", "line")


# catalog


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem)")
def lookup_bulk(spark, sf_dir):
    ids = t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return catalog.lookup_bulk(ids, t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), ["p_partkey"])


def page_files(spark, sf_dir) -> DataFrame:
    """Pages as files: host as folder, the path's last part as name."""
    p = t(spark, sf_dir, "pages")
    path = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/$", "")
    return p.select(
        F.concat(F.lit("project-"), (F.col("page_id") % 3).cast("string")).alias("project"),
        F.concat(F.lit("file-"), F.col("page_id").cast("string")).alias("id"),
        F.concat(F.lit("/"), F.regexp_extract("url", "://([^/]*)", 1)).alias("folder"),
        F.regexp_replace(scalars.basename(path), "[.]html$", "").alias("name"),
        "page_id",
    )


FILES = r"""
SELECT 'project-' || (page_id % 3) AS project, 'file-' || page_id AS id, '/' || regexp_extract(url, '://([^/]*)', 1) AS folder,
  regexp_replace(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', ''), '([^/]*)$', 1), '[.]html$', '') AS name, page_id FROM pages"""


@query(f"""
WITH f AS ({FILES}), c AS (SELECT project, folder, name, count(*) AS hits, min(id) AS one FROM f GROUP BY ALL)
SELECT page_id, 'dx://' || project || ':' || folder || '/' || name AS url, CASE WHEN hits = 1 THEN one END AS found_id, hits FROM f JOIN c USING (project, folder, name)""")
def resolve_urls(spark, sf_dir):
    f = page_files(spark, sf_dir)
    urls = f.select("page_id", scalars.logical_url("project", F.lit(None).cast("string"), "folder", "name").alias("url"))
    return catalog.resolve_paths(urls, f, mode="report")


@query(f"SELECT page_id, 'dx' AS protocol, project, id AS file_id, folder, name FROM ({FILES})")
def split_url(spark, sf_dir):
    f = page_files(spark, sf_dir).select("page_id", scalars.logical_url("project", "id", "folder", "name").alias("url"))
    return f.select("page_id", scalars.split_url("url").alias("p")).select("page_id", "p.*")


@query("""
SELECT conv_id, turn, '/root/' || CASE WHEN rn = 1 THEN '' ELSE (rn - 1) || '/' END || 'talk-' || conv_id AS path FROM (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)""")
def unique_paths(spark, sf_dir):
    f = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("talk-"), F.col("conv_id").cast("string")).alias("name"))
    return positions.unique_paths(f, "/root", order="turn").select("conv_id", "turn", "path")


@query(f"SELECT page_id, ((row_number() OVER (PARTITION BY project ORDER BY page_id) - 1) // 100)::BIGINT AS batch FROM ({FILES})")
def batches(spark, sf_dir):
    return positions.batches(page_files(spark, sf_dir), "project", "page_id", 100).select("page_id", "batch")


@query(f"SELECT folder, string_agg(name || '@' || project, ',' ORDER BY page_id) AS versions, count(*) AS n FROM ({FILES}) GROUP BY folder")
def group_versions(spark, sf_dir):
    g = catalog.group_versions(page_files(spark, sf_dir).select("folder", "page_id", "name", "project"), "folder", "page_id")
    return g.select("folder", F.array_join(F.transform("versions", lambda v: F.concat(v["name"], F.lit("@"), v["project"])), ",").alias("versions"), "n")


# offers


def offer_name(key="p_partkey"):
    """The name of a part's offer: every other one is of the second version."""
    return F.concat(F.lit("p"), F.col(key).cast("string"), F.when(F.col(key) % 2 == 0, "_v2").otherwise(""))


def part_offers(spark, sf_dir) -> DataFrame:
    """Parts as offers, with size as memory."""
    return t(spark, sf_dir, "part").select(offer_name().alias("name"), F.col("p_size").alias("memory_mb"), (F.col("p_partkey") % 64).alias("disk_gb"), (F.col("p_size") % 8).alias("cpu"), F.col("p_retailprice").alias("price"))


OFFERS = "SELECT 'p' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_v2' ELSE '' END AS name, p_size AS memory_mb, p_partkey % 64 AS disk_gb, p_size % 8 AS cpu, p_retailprice AS price FROM part"


@query("""
WITH o AS (SELECT 'p' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_v2' ELSE '' END AS name, p_size, p_retailprice AS price, p_partkey % 2 AS v1 FROM part),
q AS (SELECT DISTINCT l_quantity FROM lineitem),
c AS (SELECT l_quantity, arg_min(name, (price, v1, name)) AS offer FROM q JOIN o ON p_size >= l_quantity GROUP BY l_quantity)
SELECT l_orderkey, l_linenumber, offer FROM lineitem LEFT JOIN c USING (l_quantity)""")
def cheapest_offer(spark, sf_dir):
    r = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("memory_mb"))
    return offers.cheapest_offer(r, part_offers(spark, sf_dir), ("memory_mb",), mode="report").select("l_orderkey", "l_linenumber", "offer")


@query(f"""
WITH o AS ({OFFERS}), s AS (SELECT *, floor(memory_mb / 1024) + floor(disk_gb / 16) + cpu AS cost, CASE WHEN contains(name, '_v2') THEN 0 ELSE 1 END AS v1 FROM o),
r AS (SELECT c_custkey, c_custkey % 50 AS m, c_custkey % 60 AS d, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 7 END AS c FROM customer)
SELECT c_custkey, arg_min(name, (cost, v1, name)) AS offer FROM r LEFT JOIN s ON memory_mb >= m AND disk_gb >= d AND (c IS NULL OR cpu >= c) GROUP BY c_custkey""")
def minimal_offer(spark, sf_dir):
    k = F.col("c_custkey")
    r = t(spark, sf_dir, "customer").select("c_custkey", (k % 50).alias("memory_mb"), (k % 60).alias("disk_gb"), F.when(k % 3 > 0, k % 7).alias("cpu"))
    return offers.minimal_offer(r, part_offers(spark, sf_dir), mode="report").select("c_custkey", "offer")


@query(f"""
WITH o AS (SELECT memory_mb, disk_gb, cpu, min((price, CASE WHEN contains(name, '_v2') THEN 0 ELSE 1 END, name)) AS k FROM ({OFFERS}) GROUP BY ALL)
SELECT k[3] AS name, memory_mb, disk_gb, cpu, k[1] AS price FROM o a
WHERE NOT EXISTS (SELECT 1 FROM o b WHERE b.memory_mb >= a.memory_mb AND b.disk_gb >= a.disk_gb AND b.cpu >= a.cpu AND b.k < a.k)""")
def skyline(spark, sf_dir):
    return offers.skyline(part_offers(spark, sf_dir)).select("name", "memory_mb", "disk_gb", "cpu", "price")


@query(f"SELECT name, row_number() OVER (ORDER BY price, name) AS price FROM ({OFFERS})")
def mask_prices(spark, sf_dir):
    return offers.mask_prices(part_offers(spark, sf_dir)).select("name", "price")


@query(f"""
SELECT name, memory_mb, disk_gb, cpu, paid AS price FROM ({OFFERS})
JOIN (SELECT 'p' || l_partkey || CASE WHEN l_partkey % 2 = 0 THEN '_v2' ELSE '' END AS name, min(l_extendedprice) AS paid FROM lineitem GROUP BY l_partkey) USING (name)""")
def price_join(spark, sf_dir):
    """Parts with the least price that was paid for them; parts that nobody bought go."""
    paid = t(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_extendedprice").alias("price"))
    return offers.price_join(part_offers(spark, sf_dir), paid.select(offer_name().alias("name"), "price")).select("name", "memory_mb", "disk_gb", "cpu", "price")


@query(f"SELECT memory_mb, arg_min(name, (price, CASE WHEN contains(name, '_v2') THEN 0 ELSE 1 END, name)) AS name FROM ({OFFERS}) GROUP BY memory_mb")
def best_per_key(spark, sf_dir):
    return positions.best_per_key(part_offers(spark, sf_dir), ["memory_mb"], offers.choice_order()).select("memory_mb", "name")


@query(f"""
WITH o AS ({OFFERS}), p AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), q AS (SELECT DISTINCT a.l_partkey AS x, b.l_partkey AS y FROM p a JOIN p b USING (l_orderkey)),
n AS (SELECT p_partkey, 'p' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '_v2' ELSE '' END AS name FROM part)
SELECT a.name AS a, b.name AS b, a.memory_mb <= b.memory_mb AND a.disk_gb <= b.disk_gb AND a.cpu <= b.cpu AS leq
FROM q JOIN n na ON na.p_partkey = x JOIN n nb ON nb.p_partkey = y JOIN o a ON a.name = na.name JOIN o b ON b.name = nb.name""")
def dominated(spark, sf_dir):
    """Pairs are told by the parts' numbers until each is there once, and then get names."""
    part = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    lines = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    met = positions.stored(offers.dealt(lines, lines.count(), "l_partkey").distinct().join(part.distinct(), "l_partkey"), "met")
    made = met.groupBy("l_orderkey").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
    met = offers.dealt(met, made, "l_orderkey")
    both = met.withColumnRenamed("l_partkey", "x").join(met.withColumnRenamed("l_partkey", "y"), "l_orderkey").select("x", "y")
    both = offers.dealt(both, made, "x").distinct().select(offer_name("x").alias("a"), offer_name("y").alias("b"))
    return offers.dominated(both, part_offers(spark, sf_dir), n_pairs=made)


# sets and changes


@query("SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'click') AND ts >= (SELECT min(ts) FROM events) + INTERVAL 1 HOUR")
def real_outputs(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    start = F.lit(e.agg(F.min("ts")).first()[0]) + F.expr("INTERVAL 1 HOUR")
    return sets.real_outputs(e, e.where("event_type = 'click'"), start, "event_id", "ts").select("event_id")


@query("SELECT event_id, '/out/intermediate' AS target FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE value > 50)")
def intermediates(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return sets.intermediates(e, e.where("value > 50"), "/out/", "event_id").select("event_id", "target")


@query("SELECT n_name AS name FROM nation JOIN customer ON n_nationkey = c_nationkey INTERSECT SELECT n_name FROM nation JOIN supplier ON n_nationkey = s_nationkey")
def intersect_names(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), "n_nationkey")
    side = lambda table, key: n.join(t(spark, sf_dir, table), F.col("n_nationkey") == F.col(key))
    return sets.used_directly(side("customer", "c_nationkey"), side("supplier", "s_nationkey"))


@query(f"""
WITH a AS (SELECT line FROM ({LINES})), b AS (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
SELECT '<' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT '>' AS side, count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def diff_tables(spark, sf_dir):
    b = t(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "\n")).alias("line"))
    both = sets.diff_rows(doc_lines(spark, sf_dir).select("line"), b).groupBy("side").agg(F.count("*").alias("n"))
    every = text_sources.literal_array(spark, ["<", ">"], "side").select("side")
    return every.join(both, "side", "left").select("side", F.coalesce("n", F.lit(0)).alias("n"))


@query()
def diff_documents(spark, sf_dir):
    """Edit scripts between documents that begin alike, each and the next by id."""
    d = t(spark, sf_dir, "documents").select("doc_id", F.left("text", F.lit(40)).alias("head"), "text")
    ranked = positions.stored(positions.with_ranks(d.where("head IS NOT NULL"), ["head"], [F.col("doc_id")]), "heads")
    after = ranked.select("head", (F.col("rank") - 1).alias("rank"), F.col("doc_id").alias("next_id"), F.col("text").alias("right"))
    pairs_ = ranked.withColumnRenamed("text", "left").join(after, ["head", "rank"])
    return edits.diff_lines(pairs_, ["doc_id", "next_id"])


@query("""
SELECT conv_id, turn, a.size AS left, b.size AS right FROM (SELECT conv_id, turn, length(text) AS size FROM conversations WHERE turn % 2 = 0) a
FULL JOIN (SELECT conv_id, turn - 1 AS turn, length(text) AS size FROM conversations WHERE turn % 2 = 1) b USING (conv_id, turn) WHERE a.size IS DISTINCT FROM b.size""")
def diff_positions(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("size"))
    return sets.diff_by_position(c.where("turn % 2 = 0"), c.where("turn % 2 = 1").withColumn("turn", F.col("turn") - 1), ["conv_id", "turn"], "size")


@query("""
SELECT event_id, user_id FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')
  AND event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'view')""")
def union_children(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    return sets.union_children(e, e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), "user_id", "event_id").select("event_id", "user_id")


@query("""
SELECT o_orderkey, upper(md5('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}')) AS digest FROM orders""")
def row_digest(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", scalars.row_digest("o_orderkey", "o_orderpriority", "o_custkey").alias("digest"))


@query("""
WITH new AS (SELECT o_custkey AS name, max(o_orderstatus) AS digest FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1),
old AS (SELECT o_custkey AS name, count(*) AS n, max(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END) AS d FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT name, digest, CASE WHEN n IS NULL THEN 'new' WHEN n > 1 THEN 'ambiguous' WHEN d IS NULL THEN 'foreign' WHEN d = digest THEN 'unchanged' ELSE 'changed' END AS change
FROM new LEFT JOIN old USING (name)""")
def detect_changes(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    new = o.where("o_orderdate >= TIMESTAMP '1998-01-01'").groupBy(F.col("o_custkey").alias("name")).agg(F.max("o_orderstatus").alias("digest"))
    old = o.where("o_orderdate < TIMESTAMP '1998-01-01'").select(F.col("o_custkey").alias("name"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("digest"))
    return sets.detect_changes(new, old)


@query("""
WITH d AS (SELECT doc_id AS id, md5(coalesce(text, '')) AS digest, source AS name FROM documents)
SELECT n.id, n.name, n.digest, min(k.id) AS reuse FROM d n LEFT JOIN (SELECT id, digest, name || '_x' AS name FROM d WHERE id % 2 = 1) k
ON n.digest = k.digest AND starts_with(k.name, n.name) WHERE n.id % 2 = 0 GROUP BY ALL""")
def reuse_by_digest(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), F.col("source").alias("name"))
    return sets.reuse_by_digest(d.where("id % 2 = 0"), d.where("id % 2 = 1").withColumn("name", F.concat("name", F.lit("_x"))))


# aggregations


@query("""
SELECT user_id AS key, ['NONE', 'VIEW', 'UPLOAD', 'CONTRIBUTE', 'ADMINISTER'][max(user_id % 3 + CASE WHEN event_type = 'view' THEN 1 ELSE 2 END)] AS project,
  bool_or(value > 90) AS developer, array_to_string(list_sort(list_distinct(list(event_type))), ',') AS network FROM events GROUP BY user_id""")
def merge_access(spark, sf_dir):
    rank = F.col("user_id") % 3 + F.when(F.col("event_type") == "view", 0).otherwise(1)
    level = F.get(F.array(*map(F.lit, merge.LEVELS)), rank.cast("int"))
    g = t(spark, sf_dir, "events").select(F.col("user_id").alias("key"), level.alias("project"), (F.col("value") > 90).alias("developer"), F.array("event_type").alias("network"))
    return merge.merge_access(g, levels=("project",), flags=("developer",)).withColumn("network", F.array_join("network", ","))


@query("SELECT name FROM (SELECT c_custkey AS name, c_mktsegment AS d FROM customer UNION ALL SELECT o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE c_mktsegment END FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY name HAVING count(DISTINCT d) > 1")
def merge_definitions(spark, sf_dir):
    one = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("definition"))
    used = t(spark, sf_dir, "orders").join(one, F.col("o_custkey") == F.col("name"))
    two = used.select("name", F.when(F.col("o_orderstatus") == "P", "other").otherwise(F.col("definition")).alias("definition"))
    return merge.merge_definitions(one.unionByName(two), mode="report")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def merge_counts(spark, sf_dir):
    part = t(spark, sf_dir, "events").groupBy((F.col("event_id") % 10).alias("part"), "event_type").agg(F.count("*").alias("n"))
    return gather.merge_counts(part, "event_type")


@query("SELECT c_custkey AS slice, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def count_per_slice(spark, sf_dir):
    """Orders of each customer, 0 for those without."""
    rows = t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("slice"))
    return gather.count_per_key(rows, "slice", t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("slice")))


@query("SELECT ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 500)::BIGINT AS chunk, o_orderkey FROM orders")
def chunks(spark, sf_dir):
    seq = positions.with_positions(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")])
    return positions.chunk(seq).select("chunk", "o_orderkey")


@query("""
WITH c AS (SELECT conv_id, turn, role, row_number() OVER w AS k, sum(length(role) + 2) OVER w - 2 AS total FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, '[' || string_agg(role, ', ' ORDER BY turn) || ']' AS label FROM c WHERE k = 1 OR total <= 25 GROUP BY conv_id""")
def limited_label(spark, sf_dir):
    g = gather.gather(t(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")
    return g.select("conv_id", scalars.limited_label("role", 25).alias("label"))


@query("SELECT conv_id, '(' || arg_min(role, turn) || ', ' || max(turn) || ')' AS label FROM conversations GROUP BY conv_id")
def item_label(spark, sf_dir):
    kind = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.LongType())])
    g = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.struct(F.min_by("role", "turn").alias("left"), F.max("turn").alias("right")).alias("p"))
    return g.select("conv_id", scalars.item_label("p", kind).alias("label"))


# typed values


@query("SELECT conv_id, string_agg(turn || '=' || role, ',' ORDER BY turn) AS entries FROM conversations GROUP BY conv_id")
def typed_json_roundtrip(spark, sf_dir):
    kind = T.MapType(T.LongType(), T.StringType())
    g = t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("turn", "role")))).alias("m"))
    for style in ("internal", "platform"):
        g = g.withColumn("json", typed.encode_typed("m", kind, style)).withColumn("m", typed.decode_typed("json", kind, style))
    entries = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]))
    return g.select("conv_id", F.array_join(entries, ",").alias("entries"))


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS ref FROM pages")
def find_refs(spark, sf_dir):
    return merge.find_refs_in_text(t(spark, sf_dir, "pages"), "html", ["page_id"], 'href="([^"]+)"')


@query("""
SELECT o_orderkey, 'file-' || o_orderkey AS ref FROM orders UNION ALL SELECT o_orderkey, 'file-' || o_custkey || 'x' FROM orders WHERE o_custkey % 2 = 0
UNION ALL SELECT o_orderkey, 'file-deep' || o_custkey FROM orders WHERE o_orderkey % 3 = 0""")
def find_refs_json(spark, sf_dir):
    """Ids in JSON, beside the same ids in longer texts, behind escaped quotes and as names."""
    o = t(spark, sf_dir, "orders")
    order, customer = F.concat(F.lit("file-"), F.col("o_orderkey").cast("string")), F.concat(F.lit("file-"), F.col("o_custkey").cast("string"))
    quoted = F.concat(F.lit('said "'), customer, F.lit('" \\'))
    deep = F.array(F.struct(F.array(F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("file-deep"), F.col("o_custkey").cast("string"))), quoted).alias("in")))
    json = F.to_json(F.struct(order.alias("id"), quoted.alias("said"), F.concat(order, F.lit(" ")).alias("longer"), F.create_map(customer, F.when(F.col("o_custkey") % 2 == 0, F.concat(customer, F.lit("x")))).alias("named"), deep.alias("deep")))
    return merge.find_refs_in_json(o.select("o_orderkey", json.alias("json")), "json", ["o_orderkey"])


@query("SELECT c_custkey AS id, string_agg(CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'order-' || o_orderkey END, ',' ORDER BY o_orderkey) AS refs FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def translate_refs(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    arrays = gather.gather(o.withColumn("ref", F.col("o_orderkey").cast("string")), ["o_custkey"], "o_orderkey", "ref", "refs").withColumnRenamed("o_custkey", "id")
    arrays = arrays.join(t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), "id", "left_semi")
    table = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").cast("string").alias("ref"), F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("target"))
    out = merge.translate_refs(arrays, "refs", table, ["id"], required=False)
    return out.select("id", F.array_join("refs", ",", "").alias("refs"))


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'P' THEN 'file-' || o_orderkey ELSE '' END AS target FROM orders)
SELECT o_custkey AS id, string_agg(target || '/' || status, ',' ORDER BY o_orderkey) AS items, (array_agg(target ORDER BY o_orderkey DESC))[1] AS last, count(*) AS size FROM o GROUP BY 1""")
def translate_nested(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    ref = F.concat(F.lit("order://"), F.col("o_orderkey").cast("string"))
    item = F.struct(F.col("o_orderkey").alias("key"), ref.alias("ref"), F.col("o_orderstatus").alias("status"))
    kept = o.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    nested = kept.select("id", F.struct("items", F.create_map(F.lit("last"), F.element_at("items", -1)["ref"]).alias("named"), F.size("items").alias("size")).alias("data"))
    table = o.where("o_orderstatus <> 'P'").select(ref.alias("ref"), F.concat(F.lit("file-"), F.col("o_orderkey").cast("string")).alias("target"))
    out = merge.translate_refs(nested, "data", table, ["id"], required=False, is_ref=lambda c: F.startswith(c, F.lit("order://")))
    joined = F.array_join(F.transform("data.items", lambda x: F.concat(F.coalesce(x["ref"], F.lit("")), F.lit("/"), x["status"])), ",")
    return out.select("id", joined.alias("items"), F.coalesce(F.col("data.named")["last"], F.lit("")).alias("last"), F.col("data.size").cast("long").alias("size"))


# graphs


def part_edges(spark, sf_dir) -> DataFrame:
    p = t(spark, sf_dir, "part").where("p_partkey > 1")
    return p.select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("dep"))


@query("""
WITH RECURSIVE up AS (SELECT p_partkey AS node, p_partkey AS place, 0 AS level FROM part UNION ALL SELECT node, place // 2, level + 1 FROM up WHERE place // 2 IN (SELECT p_partkey FROM part) AND place > 1)
SELECT node, max(level)::INT AS level FROM up GROUP BY node""")
def dependency_levels(spark, sf_dir):
    nodes = t(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    edges = part_edges(spark, sf_dir).join(nodes.withColumnRenamed("node", "dep"), "dep", "left_semi")
    return graph.dependency_levels(nodes, edges)


@query("""
WITH RECURSIVE up AS (SELECT p_partkey AS node, p_partkey // 2 AS ancestor FROM part WHERE p_partkey > 1 UNION ALL SELECT node, ancestor // 2 FROM up WHERE ancestor > 1 AND ancestor IN (SELECT p_partkey FROM part))
SELECT node, ancestor FROM up""")
def ancestors(spark, sf_dir):
    return graph.ancestors(part_edges(spark, sf_dir))


@query("""
SELECT 'world' AS node, 0 AS depth, 'world' AS path UNION ALL SELECT r_name, 1, 'world/' || r_name FROM region
UNION ALL SELECT n_name, 2, 'world/' || r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'c' || c_custkey, 3, 'world/' || r_name || '/' || n_name || '/c' || c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def tree_paths(spark, sf_dir):
    r, n = t(spark, sf_dir, "region"), t(spark, sf_dir, "nation")
    edges = r.select(F.col("r_name").alias("node"), F.lit("world").alias("parent")).unionByName(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("node"), F.col("r_name").alias("parent")))
    c = t(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    edges = edges.unionByName(c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.col("n_name").alias("parent")))
    roots = r.select(F.lit("world").alias("node")).distinct()
    return graph.tree_paths(edges, roots).withColumn("path", F.array_join("path", "/"))


# reads


def event_reads(spark, sf_dir) -> DataFrame:
    """Events as reads: the user as barcode, the type as gene, tenths of the value as UMI."""
    return t(spark, sf_dir, "events").select(
        F.col("event_id").alias("read_id"),
        (F.col("user_id") % 3).alias("gem_group"),
        F.when(F.col("user_id") % 11 > 0, F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("barcode"),
        F.floor(F.col("value")).cast("string").alias("umi"),
        (F.col("event_id") % 40).alias("umi_min_qual"),
        F.col("event_type").alias("gene"),
    )


READS = "SELECT event_id AS read_id, user_id % 3 AS gem_group, CASE WHEN user_id % 11 > 0 THEN lpad(user_id::VARCHAR, 6, '0') END AS barcode, floor(value)::BIGINT::VARCHAR AS umi, event_id % 40 AS umi_min_qual, event_type AS gene FROM events"
MATRIX = f"SELECT gem_group, barcode, gene, count(DISTINCT umi) AS umis FROM ({READS}) WHERE umi_min_qual >= 4 AND barcode IS NOT NULL AND gene IS NOT NULL GROUP BY ALL"


@query(f"SELECT read_id, barcode, substr(barcode, 1, 5) AS bucket, count(*) OVER (PARTITION BY substr(barcode, 1, 5)) AS n FROM ({READS})")
def bucket_sort_merge(spark, sf_dir):
    ordered, counts = positions.bucket_sort_merge(event_reads(spark, sf_dir), reads.bucket(5), "barcode")
    counts = counts.withColumnRenamed("bucket", "_bucket")
    return ordered.join(counts, F.col("bucket").eqNullSafe(F.col("_bucket"))).select("read_id", "barcode", "bucket", "n")


@query(MATRIX)
def umi_matrix(spark, sf_dir):
    return reads.count_genes(reads.filter_umis(event_reads(spark, sf_dir), 4))


@query(f"""
WITH m AS ({MATRIX}), s AS (SELECT gem_group, barcode, sum(umis) AS total FROM m GROUP BY ALL), top AS (SELECT total FROM s ORDER BY total DESC LIMIT 50)
SELECT gem_group, barcode, gene, umis FROM m JOIN s USING (gem_group, barcode) WHERE total >= (SELECT quantile_cont(total, 0.99) / 10 FROM top)""")
def filter_barcodes(spark, sf_dir):
    return reads.filter_barcodes(umi_matrix(spark, sf_dir), 50)


@query(f"SELECT read_id, barcode IS NOT NULL AND gene IS NOT NULL AND row_number() OVER (PARTITION BY gem_group, barcode, umi, gene ORDER BY read_id) > 1 AS duplicate FROM ({READS})")
def mark_duplicates(spark, sf_dir):
    return reads.mark_duplicates(event_reads(spark, sf_dir)).select("read_id", "duplicate")


@query(f"SELECT gem_group, barcode, count(*) AS n FROM ({READS}) WHERE barcode IN (SELECT lpad(c_custkey::VARCHAR, 6, '0') FROM customer) GROUP BY ALL")
def barcode_counts(spark, sf_dir):
    listed = t(spark, sf_dir, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("barcode"))
    return reads.barcode_counts(event_reads(spark, sf_dir), listed)


@query(f"SELECT * FROM ({READS}) WHERE ('0x' || left(md5('7:' || read_id), 8))::BIGINT < 1073741824")
def subsample(spark, sf_dir):
    return reads.subsample(event_reads(spark, sf_dir), 0.25, seed=7)


@query(f"SELECT 'all' AS stage, count(*) AS n FROM ({READS}) UNION ALL SELECT 'good', count(*) FROM ({READS}) WHERE umi_min_qual >= 4 UNION ALL SELECT 'matrix', count(*) FROM ({MATRIX})")
def stage_summary(spark, sf_dir):
    r = event_reads(spark, sf_dir)
    good = reads.filter_umis(r, 4)
    return reads.stage_summary(all=r, good=good, matrix=reads.count_genes(good))


# user functions and rounds


@query("SELECT conv_id, turn, length(text)::BIGINT * 2 AS twice FROM conversations")
def map_task(spark, sf_dir):
    fn = lambda f: f.assign(twice=f["text"].str.len() * 2)[["conv_id", "turn", "twice"]]
    return tasks.map_task(t(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), fn, "conv_id long, turn long, twice long", required=("twice",))


@query("SELECT conv_id, count(*) AS n, max(turn) - min(turn) AS span FROM conversations GROUP BY conv_id")
def group_task(spark, sf_dir):
    def fn(frame):
        import pandas as pd

        return pd.DataFrame({"conv_id": [frame["conv_id"].iloc[0]], "n": [len(frame)], "span": [frame["turn"].max() - frame["turn"].min()]})

    return tasks.group_task(t(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id"], fn, "conv_id long, n long, span long")


@query("SELECT role || '!' AS line FROM conversations")
def pipe_task(spark, sf_dir):
    return tasks.pipe_task(t(spark, sf_dir, "conversations"), "sed s/$/!/", "role")


@query("SELECT o_orderkey, o_totalprice > 1000 AS over, o_orderstatus = 'F' AS done FROM orders")
def sub_flow(spark, sf_dir):
    flow = lambda d, status="F", bar=0: d.select("o_orderkey", (F.col("o_totalprice") > bar).alias("over"), (F.col("o_orderstatus") == status).alias("done"))
    return pairs.sub_flow(t(spark, sf_dir, "orders"), flow, bar=1000)


@query("SELECT event_id, user_id * 2 AS twice FROM events")
def chunked_scatter(spark, sf_dir):
    events = t(spark, sf_dir, "events")
    work = os.path.join(positions.shared_folder(spark), f"rounds-{uuid.uuid4().hex}")
    fn = lambda d: d.select("event_id", (F.col("user_id") * 2).alias("twice"))
    events.repartition(4, "event_id").write.parquet(f"{work}/source")  # four files, four rounds
    return run_rounds(spark, f"{work}/source", events.schema, fn, work).select("event_id", "twice")


@query("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS seq, c_custkey, c_acctbal * 2 AS twice FROM customer")
def scatter_items(spark, sf_dir):
    work = os.path.join(positions.shared_folder(spark), f"rounds-{uuid.uuid4().hex}")
    fn = lambda d: d.select("seq", "c_custkey", (F.col("c_acctbal") * 2).alias("twice"))
    return run_items(t(spark, sf_dir, "customer"), ["c_custkey"], fn, work, 1000).select("seq", "c_custkey", "twice")
