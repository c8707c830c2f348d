"""Bounded rounds over a stream of files or of positions, with one ordered gather at the end."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import with_positions

#: Rounds of items that the stream's log notes together.
BATCH_ROUNDS = 64


def chunked_scatter(spark: SparkSession, source: str, schema, fn: Callable[[DataFrame], DataFrame], work: str, files_per_round: int = 1, fmt: str = "parquet") -> DataFrame:
    """Run ``fn`` on at most ``files_per_round`` files a round until the source is read, and
    return all rounds with their ``batch_id``.

    A round writes its own partition, so one that runs again after a failure replaces
    what it wrote; a restart with the same ``work`` folder goes on behind the last round.
    Without files the result is empty."""
    sink = os.path.join(work, "rounds")
    empty = fn(spark.createDataFrame([], schema)).withColumn("batch_id", F.lit(0).cast("long"))

    def round_(batch: DataFrame, batch_id: int) -> None:
        out = fn(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sink)

    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_round).load(source)
    query = stream.writeStream.foreachBatch(round_).option("checkpointLocation", os.path.join(work, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    written = spark._jvm.org.apache.hadoop.fs.Path(sink)
    if not written.getFileSystem(spark._jsc.hadoopConfiguration()).exists(written):
        return empty
    return spark.read.schema(empty.schema).parquet(sink)


def scatter_items(df: DataFrame, order: list, fn: Callable[[DataFrame], DataFrame], work: str, items_per_round: int = 500, most: int = 1000, tasks: int = 4) -> DataFrame:
    """Run ``fn`` on ``items_per_round`` rows a round (the last may have fewer), in ``tasks``
    tasks; the next round starts when one is done.  Rows are numbered by ``order`` in a column
    ``seq``, which ``fn`` keeps; the result is all rounds' rows in that order with their
    ``batch_id``.  An empty table gives an empty result with its schema.

    The stream is one of positions, ``BATCH_ROUNDS`` rounds a micro-batch, one after another,
    and its checkpoint in ``work`` tells how far it came: a restart goes on behind the last
    round that ended, and a round that runs again replaces what it wrote.  The numbered rows
    are written once, by micro-batch and position, and a round reads only the files of its
    micro-batch and of these the row groups that hold its positions, so what a round costs
    doesn't grow with the table.  The number of items can't change on a restart."""
    if not 0 < items_per_round <= most:
        raise ValueError(f"{items_per_round} items a round: must be 1 to {most}")
    spark, base = df.sparkSession, os.path.join(work, f"rounds-of-{items_per_round}")
    source, sink = os.path.join(base, "source"), os.path.join(base, "rounds")
    rows = with_positions(df, order)

    def there(path: str, *names: str) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, *names))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    if not there(source, "_SUCCESS"):  # a write that broke off has none and is done anew
        batch = F.floor(F.col("seq") / (items_per_round * BATCH_ROUNDS)).alias("_micro_batch")
        rows.select("*", batch).repartitionByRange("seq").sortWithinPartitions("seq").write.mode("overwrite").partitionBy("_micro_batch").parquet(source)
    rounds = -(-spark.read.schema(rows.schema).parquet(source).count() // items_per_round)
    batches = -(-rounds // BATCH_ROUNDS)

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id >= batches:
            return
        own = batch.sparkSession  # the stream's; planning anew within a round costs more than it saves
        own.conf.set("spark.sql.adaptive.enabled", "false")
        met = own.read.schema(rows.schema).parquet(os.path.join(source, f"_micro_batch={batch_id}"))
        for i in range(batch_id * BATCH_ROUNDS, min(rounds, (batch_id + 1) * BATCH_ROUNDS)):
            path = os.path.join(sink, f"batch_id={i}")
            if not there(path, "_SUCCESS"):
                items = met.where(F.col("seq").between(i * items_per_round, (i + 1) * items_per_round - 1))
                fn(items.repartition(tasks, "seq")).write.mode("overwrite").parquet(path)

    schema = fn(rows.where("false")).withColumn("batch_id", F.lit(0).cast("long")).schema
    ended = ("progress", "commits", str(batches - 1))
    if rounds and not there(base, *ended):
        stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", items_per_round * BATCH_ROUNDS).option("numPartitions", 1).load()
        query = stream.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(base, "progress")).start()
        while not query.awaitTermination(0.2):  # a round that fails raises here
            if there(base, *ended):
                query.stop()
                break
    if not rounds:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(sink).orderBy("seq")
