"""Set differences over files, and change detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def real_outputs(outputs: DataFrame, inputs: DataFrame, started, key: str = "id", created: str = "created", most: int | None = None) -> DataFrame:
    """Outputs that aren't inputs and were made since ``started``.  With ``most``, nothing if
    more remain."""
    out = outputs.join(inputs.select(key), key, "left_anti").where(F.col(created) >= started)
    if most is None:
        return out
    n = F.broadcast(out.agg(F.count("*").alias("_n")))
    return out.crossJoin(n).where(F.col("_n") <= most).drop("_n")


def intermediates(real: DataFrame, exported: DataFrame, folder: str, key: str = "id") -> DataFrame:
    """What wasn't exported, with ``target``, the folder it moves to."""
    return real.join(exported.select(key), key, "left_anti").withColumn("target", F.lit(folder.rstrip("/") + "/intermediate"))


def to_upload(outputs: DataFrame, local_inputs: DataFrame, on_cloud: DataFrame, path: str = "path") -> DataFrame:
    """Local outputs that neither came as inputs nor are stored."""
    return outputs.where(F.col(path).isNotNull()).join(local_inputs.select(path), path, "left_anti").join(on_cloud.select(path), path, "left_anti")


def with_urls(outputs: DataFrame, stored_files: DataFrame, path: str = "path") -> DataFrame:
    """Every output with its url; an absent optional file has none."""
    return outputs.join(stored_files.select(path, "url"), path, "left")


def used_directly(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    return inputs.select("name").intersect(outputs.select("name"))


def union_children(results: DataFrame, parents: list | DataFrame, excluded: DataFrame, parent: str = "parent_id", key: str = "id") -> DataFrame:
    """Results of all parents, without the excluded jobs.  ``parents`` is a list, or a
    frame with a column named as ``parent`` of any size; a parent named twice counts once,
    and null is nobody's parent."""
    if isinstance(parents, DataFrame):
        children = results.join(parents.select(parent), parent, "left_semi")
    else:
        children = results.where(F.col(parent).isin(*parents))
    return children.join(excluded.select(key), key, "left_anti")


def diff_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side that the other lacks, as often as they are over: ``side`` and columns."""
    return a.exceptAll(b).withColumn("side", F.lit("<")).unionByName(b.exceptAll(a).withColumn("side", F.lit(">")))


def diff_by_position(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Positions at which values differ or one side has none."""
    right = b.withColumnRenamed(value, "_b").withColumn("_in_b", F.lit(True))
    both = a.withColumn("_in_a", F.lit(True)).join(right, keys, "full")
    same = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull() & F.col(value).eqNullSafe(F.col("_b"))
    return both.where(~same).select(*keys, F.col(value).alias("left"), F.col("_b").alias("right"))


def detect_changes(new: DataFrame, existing: DataFrame, name: str = "name", digest: str = "digest", mode: str = "report") -> DataFrame:
    """``new(name, digest)`` with ``change``: *new* without versions, *unchanged* or *changed*
    with one, *ambiguous* with several, *foreign* with one that has no digest (an error in
    mode ``fail``)."""
    old = existing.groupBy(name).agg(F.count("*").alias("_n"), F.max(digest).alias("_old"))
    change = (
        F.when(F.col("_n").isNull(), "new")
        .when(F.col("_n") > 1, "ambiguous")
        .when(F.col("_old").isNull(), "foreign")
        .when(F.col("_old") == F.col(digest), "unchanged")
        .otherwise("changed")
    )
    if mode == "fail":
        change = F.when(change == "foreign", F.raise_error(F.concat(F.lit("no digest on "), F.col(name)))).otherwise(change)
    return new.join(old, name, "left").withColumn("change", change).drop("_n", "_old")


def reuse_by_digest(new: DataFrame, known: DataFrame, name: str = "name", digest: str = "digest", key: str = "id") -> DataFrame:
    """``new`` with ``reuse``: the least id among stored objects of the same digest whose name
    starts with the wanted one; null if there is none."""
    old = known.select(F.col(digest).alias("_d"), F.col(name).alias("_name"), F.col(key).alias("_id"))
    met = new.join(old, (F.col(digest) == F.col("_d")) & F.startswith(F.col("_name"), F.col(name)), "left")
    return met.groupBy(*new.columns).agg(F.min("_id").alias("reuse"))


def archive_plan(superseded: DataFrame, name: str = "name", folder: str = "folder", klass: str = "class", created: str = "created") -> DataFrame:
    """Where superseded objects move to, and their names there."""
    from ..functions.scalars import archive_name

    target = F.concat(F.rtrim(F.col(folder), F.lit("/")), F.lit("/."), F.initcap(klass), F.lit("_archive"))
    return superseded.withColumn("target", target).withColumn("archived_as", archive_name(name, created))
