"""A small table that grows by a few rows with every micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import children, exists, remove


class BatchLog:
    """Rows of micro-batches below ``path``; ``fields`` are the columns without batch_id.

    Nothing is overwritten: each attempt of a micro-batch is a folder of its own, and the
    last complete one counts. Folding puts the rows up to a micro-batch into one table;
    the folders it replaces are removed by the folding after it, so that readers that
    have begun can end.
    """

    def __init__(self, path: str, fields: str):
        self.live, self.history = f"{path}/live", f"{path}/history"
        self.fields = fields
        self.schema = f"{fields}, batch_id BIGINT"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.parquet(f"{self.live}/batch_id={batch_id}/attempt={time.time_ns():020d}")

    def _batches(self, spark: SparkSession) -> list[int]:
        names = children(spark, self.live)
        return sorted(int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id="))

    def _attempt(self, spark: SparkSession, batch_id: int) -> str | None:
        """Folder of the last complete attempt of a micro-batch."""
        folder = f"{self.live}/batch_id={batch_id}"
        for name in reversed(children(spark, folder)):
            if exists(spark, f"{folder}/{name}/_SUCCESS"):
                return f"{folder}/{name}"
        return None

    def _folds(self, spark: SparkSession) -> list[int]:
        names = [n for n in children(spark, self.history) if exists(spark, f"{self.history}/{n}/_SUCCESS")]
        return sorted(int(name.removeprefix("through=")) for name in names)

    def _rows(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        folder = self._attempt(spark, batch_id)
        if folder is None:
            return None
        found = spark.read.schema(self.fields).parquet(folder)
        return found.withColumn("batch_id", F.lit(batch_id).cast("bigint"))

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows with their ``batch_id``."""
        folds = self._folds(spark)
        folded = folds[-1] if folds else None
        paths = [self._attempt(spark, n) for n in self._batches(spark) if folded is None or n > folded]
        table = spark.createDataFrame([], self.schema)
        if any(paths):
            reader = spark.read.schema(self.schema).option("basePath", self.live)
            table = reader.parquet(*filter(None, paths)).select(*table.columns)
        if folded is not None:
            table = table.unionByName(spark.read.schema(self.schema).parquet(f"{self.history}/through={folded}"))
        return table

    def last(self, spark: SparkSession, before: int | None = None):
        """The row of the last micro-batch, or of the last one before ``before``."""
        for number in reversed(self._batches(spark)):
            if before is None or number < before:
                rows = self._rows(spark, number)
                if rows is not None:
                    return rows.first()
        rows = self.read(spark)
        if before is not None:
            rows = rows.filter(F.col("batch_id") < before)
        return rows.orderBy(F.desc("batch_id")).first()

    def fold(
        self, spark: SparkSession, through: int, merge: Callable[[DataFrame], DataFrame] | None = None
    ) -> None:
        """Put the rows up to a micro-batch into one table, merged if ``merge`` is given."""
        folds = self._folds(spark)
        if folds and folds[-1] >= through:
            return
        rows = self.read(spark).filter(F.col("batch_id") <= through)
        merged = rows if merge is None else merge(rows).withColumn("batch_id", F.lit(through).cast("bigint"))
        merged.write.mode("overwrite").parquet(f"{self.history}/through={through}")
        if folds:
            for number in self._batches(spark):
                if number <= folds[-1]:
                    remove(spark, f"{self.live}/batch_id={number}")
            for number in folds[:-1]:
                remove(spark, f"{self.history}/through={number}")
