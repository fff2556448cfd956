"""Written intermediate tables, global ranks and joins with groups of any size."""

from __future__ import annotations

import atexit
import contextlib
import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.session import checkpoint_dir

#: Fewer than HOT groups can each hold more than a HOT-th of all rows.
HOT = 10_000


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by the file system that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """The tables that one run of an operator writes in the shared folder, which also cut its lineage.

    A lost executor costs a re-read of finished files, never a replay of earlier rounds. ``drop`` deletes tables after
    their last reader, and lets Spark's cleaner free the shuffle files of plans that are gone. What a lazy
    result still reads goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}
        atexit.register(self._end)

    def written(self, df: DataFrame, label: str, slim: bool = False) -> DataFrame:
        """``df`` as a table. ``slim``: its rows are a few numbers, so four files a core (at most) will do."""
        if slim:
            df = df.coalesce(4 * self.spark.sparkContext.defaultParallelism)
        path = self.folder(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, label: str) -> str:
        """A new folder's name, to be deleted like a table."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/{self.label}-{label}-{uuid.uuid4().hex}"
        self.paths.setdefault(label, []).append(path)
        return path

    def drop(self, *labels: str, but_last: bool = False, collect: bool = True) -> None:
        """Delete the tables of these labels, or all but each label's last one."""
        for label in labels:
            paths = self.paths.pop(label, [])
            keep = paths[-1:] if but_last else []
            for path in paths[:len(paths) - len(keep)]:
                remove(self.spark, path)
            if keep:
                self.paths[label] = keep
        if collect:
            gc.collect()
            self.spark._jvm.System.gc()

    def _end(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone
            for paths in self.paths.values():
                for path in paths:
                    remove(self.spark, path)


def attach(rows: DataFrame, groups: DataFrame, on: list[str], size: str, how: str = "inner", most: int = HOT) -> DataFrame:
    """Join of rows with one row for each group of them, however many rows a group holds.

    ``size`` is the group's number of rows (at least 0). Fewer than ``most`` groups can each hold more than that
    part of all rows; these are broadcast, so only rows of other groups are shuffled. ``how``: inner or left.
    ``groups`` is read three times, so it should be a written table; null keys match nothing.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) * most > total)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups, on, how)
    return rows.join(F.broadcast(hot), on).unionByName(others)


def ranked(df: DataFrame, order: list[Column], rank: str, s: Scratch) -> DataFrame:
    """``df`` with each row's 0-based place in the whole order, without one task that sees all rows.

    Rows are dealt out by ranges of the order (bounds from Spark's sample), sorted inside each and written; a range's
    rows come after those of the ranges before it, whose counts (one number a range) the driver adds up.
    """
    # the id's upper bits are the range's number, the lower 33 the place inside it; both are written, so they stay
    placed = s.written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", 33).cast("int")
    counts = sorted(tuple(r) for r in placed.groupBy(part.alias("p")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _before long"))
    place = F.col("_at") - F.shiftleft(part.cast("long"), 33)
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(rank, F.col("_before") + place).drop("_part", "_before", "_at")
