"""Keyed Parquet table with last-write-wins upserts.

The table is a Parquet folder partitioned by ``date`` (UTC date of the key's
time column). An upsert rewrites the dates that it touches and no others, with
plain Spark writes:

1. the updates are stored under ``incoming``, by date: the folder names are the
   touched dates;
2. the rows of these dates that no update replaces (an anti join on the keys)
   and the updates are stored under ``staged`` (updates of dates that the table
   does not have need no such step);
3. ``staged`` replaces the touched dates of ``data`` by a dynamic partition
   overwrite.

``staged`` holds whole dates, so an upsert that was cut short during step 3 is
finished by the next one, before its own; one that was cut short earlier has
changed nothing. Replaying an update changes nothing. One writer at a time.
Where the caller's catalog has a table format with ``MERGE INTO``,
``sinks.jdbc.merge_statement`` gives the statement instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.schemas import OUTPUT_KEYS
from tickwise.session import delete_path, list_names

PARTITION_COLUMN = "date"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # folder name of rows without a time


class KeyedTable:
    def __init__(
        self, spark: SparkSession, path: str, *, keys: Sequence[str] = OUTPUT_KEYS, time_column: str = "timestamp"
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.data, self.staged, self.incoming = (f"{self.path}/{x}" for x in ("data", "staged", "incoming"))
        self.keys = list(keys)
        self.time_column = time_column

    def _dates(self, folder: str) -> set[str]:
        names = list_names(self.spark, folder)
        return {n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION_COLUMN}=")}

    def exists(self) -> bool:
        return bool(self._dates(self.data))

    def read(self, with_partition: bool = False) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no finished upsert in {self.path}")
        df = self.spark.read.parquet(self.data)
        return df if with_partition else df.drop(PARTITION_COLUMN)

    def _write(self, df: DataFrame, folder: str, mode: str) -> None:
        spread = df.hint("rebalance", PARTITION_COLUMN)  # few files a date; a large date is split
        writer = spread.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(PARTITION_COLUMN).parquet(folder)

    def _publish(self) -> None:
        """Replace the staged dates, if a staging was finished."""
        if "_SUCCESS" in list_names(self.spark, self.staged) and self._dates(self.staged):
            self._write(self.spark.read.parquet(self.staged), self.data, "dynamic")
        delete_path(self.spark, self.staged)

    def upsert(self, updates: DataFrame) -> None:
        """Apply ``updates`` (unique on the keys)."""
        self._publish()
        dated = updates.withColumn(PARTITION_COLUMN, F.to_date(F.col(self.time_column)))
        self._write(dated, self.incoming, "static")
        touched = self._dates(self.incoming)
        if touched:
            new = self.spark.read.schema(dated.schema).parquet(self.incoming)
            known = sorted(touched & self._dates(self.data))
            if known:
                name = F.coalesce(F.col(PARTITION_COLUMN).cast("string"), F.lit(NO_DATE))
                old = self.read(with_partition=True).where(name.isin(known))
                self._write(old.join(new.select(*self.keys), self.keys, "left_anti").unionByName(new), self.staged, "static")
                self._publish()
            else:
                self._write(new, self.data, "dynamic")
        delete_path(self.spark, self.incoming)
