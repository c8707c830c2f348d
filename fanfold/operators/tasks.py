"""User functions over rows, partitions and groups."""

from __future__ import annotations

import contextlib
import itertools
import shlex
import subprocess
import threading
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines of a command in a batch of rows.
LINES_OUT = 10_000


def map_task(df: DataFrame, fn: Callable, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """``fn`` maps a pandas frame of rows to a frame with ``schema``; a null in a required
    output is an error."""

    def run(frames: Iterator):
        for frame in frames:
            yield fn(frame)

    out = df.mapInPandas(run, schema)
    for c in required:
        out = out.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"missing output: {c}"))))
    return out


def pipe_task(df: DataFrame, command: str, column: str = "line") -> DataFrame:
    """Send the lines of each partition through a command, one process a partition; a
    non-zero exit fails the job.  Lines out are rows ``(line)``."""

    def run(batches: Iterator):
        with subprocess.Popen(shlex.split(command), stdin=subprocess.PIPE, stdout=subprocess.PIPE) as child:
            failed = []

            def feed():
                try:
                    for batch in batches:
                        child.stdin.writelines((x or "").encode() + b"\n" for x in batch.column(0).to_pylist())
                except BrokenPipeError:  # the command may end before its input does
                    for _ in batches:
                        pass
                except Exception as e:
                    failed.append(e)
                finally:
                    with contextlib.suppress(BrokenPipeError):
                        child.stdin.close()

            feeder = threading.Thread(target=feed)
            feeder.start()
            while lines := list(itertools.islice(child.stdout, LINES_OUT)):
                yield pa.record_batch({"line": pa.array([x.decode().removesuffix("\n") for x in lines], pa.string())})
            feeder.join()
        if failed:
            raise failed[0]
        if child.returncode:
            raise RuntimeError(f"{command}: exit code {child.returncode}")

    return df.select(F.col(column).cast("string")).mapInArrow(run, "line string")


def group_task(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``fn`` on the pandas frame of each group; a group must fit one task, so use it on keys
    whose groups are bounded."""
    return df.groupBy(*keys).applyInPandas(fn, schema)
