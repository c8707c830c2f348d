"""Inventory search, bulk look-ups and path resolution over a file catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fail_unless, split_url

#: Classes of stored objects.
CLASSES = ("record", "file", "applet", "workflow")
#: Literal lists longer than this are joined, not compared one by one.
LITERALS = 1000


def scan_catalog(catalog: DataFrame, project=None, folder=None, recurse=True, klass=None, with_properties=(), names=None, ids=None, fields=None) -> DataFrame:
    """Catalog rows by project, folder (with what is below it), class, existing properties,
    exact names and ids; all filters that reach the scan are pushed to it."""
    if klass is not None and klass not in CLASSES:
        raise ValueError(f"class {klass}: not one of {CLASSES}")
    df = catalog
    if project is not None:
        df = df.where(F.col("project") == project)
    if folder is not None:
        below = F.col("folder").startswith(folder.rstrip("/") + "/") if recurse else F.lit(False)
        df = df.where((F.col("folder") == folder) | below)
    if klass is not None:
        df = df.where(F.col("class") == klass)
    for p in with_properties:
        df = df.where(F.map_contains_key("properties", p))
    for column, wanted in (("name", names), ("id", ids)):
        if isinstance(wanted, DataFrame):
            df = df.join(wanted.select(column).distinct(), column, "left_semi")
        elif wanted is not None and len(wanted) > LITERALS:
            keys = df.sparkSession.createDataFrame([(x,) for x in set(wanted)], f"{column} string")
            df = df.join(keys, column, "left_semi")
        elif wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    return df if fields is None else df.select(*fields)


def match_names(catalog: DataFrame, names: DataFrame) -> DataFrame:
    """Rows whose name is exactly one of ``names(name)``."""
    return catalog.join(names.select("name").distinct(), "name", "left_semi")


def lookup_bulk(ids: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows of ids, each looked up once; unknown ids are left out."""
    return ids.select(*keys).distinct().join(catalog, keys)


def resolve_paths(paths: DataFrame, catalog: DataFrame, url: str = "url", mode: str = "fail") -> DataFrame:
    """``paths`` with ``found_id``: ids in urls pass through, a project, folder and name meet
    the catalog.  None or several hits are an error, or have ``hits`` in a report."""
    parts = paths.withColumn("_p", split_url(F.col(url)))
    place = parts.select(F.col("_p.project").alias("project"), F.col("_p.folder").alias("folder"), F.col("_p.name").alias("name")).where("name IS NOT NULL").distinct()
    hit = place.join(catalog.select("project", "folder", "name", "id"), ["project", "folder", "name"]).groupBy("project", "folder", "name").agg(F.min("id").alias("_id"), F.count("*").alias("_n"))
    on = (F.col("_p.project") == F.col("project")) & (F.col("_p.folder") == F.col("folder")) & (F.col("_p.name") == F.col("name"))
    out = parts.join(hit, on, "left").withColumn("hits", F.when(F.col("_p.file_id").isNotNull(), F.lit(1)).otherwise(F.coalesce("_n", F.lit(0))))
    found = F.coalesce(F.col("_p.file_id"), F.when(F.col("hits") == 1, F.col("_id")))
    if mode == "fail":
        found = fail_unless(F.col("hits") == 1, found, F.concat(F.lit("not exactly one file: "), F.col(url)))
    return out.select(*(F.col(c) for c in paths.columns), found.alias("found_id"), F.col("hits").cast("long").alias("hits"))


def group_versions(catalog: DataFrame, name: str = "name", order: str = "created") -> DataFrame:
    """Per name its versions in order, and their number."""
    row = F.struct(order, *(c for c in catalog.columns if c not in (name, order)))
    return catalog.groupBy(name).agg(F.array_sort(F.collect_list(row)).alias("versions"), F.count("*").alias("n"))


def manifest_by_container(files: DataFrame) -> DataFrame:
    """Per project the files as ``array<struct<id, name, folder>>``, by id."""
    return files.groupBy("project").agg(F.array_sort(F.collect_list(F.struct("id", "name", "folder"))).alias("files"))


def distinct_refs(df: DataFrame, url: str = "url") -> DataFrame:
    return df.dropDuplicates([url])
