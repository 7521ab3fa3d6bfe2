"""Tables that a stream writes batch by batch: replaced when a batch runs again, folded together from time to time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _children(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """N of the complete folders ``prefix=N``: those whose writer has finished."""
    names = [n for n in _children(spark, path) if n.startswith(f"{prefix}=")]
    return sorted(int(n.split("=")[1]) for n in names if "_SUCCESS" in _children(spark, f"{path}/{n}"))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class BatchTable:
    """Rows by batch in ``batches/batch_id=N``, and everything up to a batch folded into ``folded/upto=N``.

    ``fold`` merges rows of several batches into fewer that mean the same (sums, latest values). Batches that have been
    folded are left until the next fold, so the batch after it can run again and still read what it read before.
    """

    def __init__(self, path: str, schema: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
        self.path, self.schema, self.fold = path, schema, fold

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def _parts(self, spark: SparkSession, before: int | None) -> tuple[list[int], list[int]]:
        """(the fold to start from, if any, and the batches behind it)."""
        limit = float("inf") if before is None else before
        folds = [n for n in _numbers(spark, f"{self.path}/folded", "upto") if n < limit][-1:]
        after = folds[0] if folds else -1
        return folds, [n for n in _numbers(spark, f"{self.path}/batches", "batch_id") if after < n < limit]

    def unmerged(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows of the batches below ``before``, as far as they have not been folded."""
        folds, batches = self._parts(spark, before)
        return self._read(spark, [f"{self.path}/folded/upto={n}" for n in folds] + [f"{self.path}/batches/batch_id={n}" for n in batches])

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        rows = self.unmerged(spark, before)
        return self.fold(rows) if self.fold else rows

    def compact(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """Before batch ``batch_id`` is written: fold what lies below it once ``every`` batches have come together."""
        folds, batches = self._parts(spark, batch_id)
        if self.fold is None or len(batches) < every:
            return
        self.read(spark, batch_id).write.mode("overwrite").parquet(f"{self.path}/folded/upto={batch_id - 1}")
        for n in _numbers(spark, f"{self.path}/folded", "upto"):
            if folds and n < folds[0]:
                _delete(spark, f"{self.path}/folded/upto={n}")
        for n in _numbers(spark, f"{self.path}/batches", "batch_id"):
            if folds and n <= folds[0]:
                _delete(spark, f"{self.path}/batches/batch_id={n}")


def latest_by(keys: list[str], value: list[str], order: str) -> Callable[[DataFrame], DataFrame]:
    """Folds to the row with the largest ``order`` of each key."""
    def fold(rows: DataFrame) -> DataFrame:
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*value), order).alias("__newest"))
        return newest.select(*keys, "__newest.*")
    return fold
