"""Streams into stored tables: exactly-once upserts, and a guard that sets late rows aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.times import instant
from tickloom.operators.load import upsert
from tickloom.session import path_exists, remove_path


def _ledger_entry(spark: SparkSession, path: str, batch_id: int, **values) -> None:
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} long" for k in values)) if values else spark.range(1)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/batch={batch_id}")


def _finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    return path_exists(spark, f"{path}/ledger/batch={batch_id}/_SUCCESS")


class MonthlyUpsert:
    """foreachBatch handler that merges a stream into a monthly table, each batch once.

    Below `path` lie the table (`rows/month=...`), the merged partitions of the batch at work (`merged/batch=<id>`) and a
    ledger of finished batches. A batch first writes what its months will hold, then replaces them, then enters the
    ledger. Repeated after a failure it starts again where it was: a batch in the ledger is skipped, and one whose merged
    rows are complete only replaces the months again, without reading a table that may be half replaced. Rows with the
    greatest `order` win per key, whichever batch brought them. A month is dealt over `files` tasks by key.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], files: int = 8):
        self.spark, self.path, self.schema, self.keys, self.order, self.files = spark, path.rstrip("/"), schema, tuple(keys), tuple(order), files

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Write the months that the batch touches as they will be."""
        merged, new = f"{self.path}/merged/batch={batch_id}", batch.select(*self.schema.names)
        if path_exists(self.spark, f"{self.path}/rows"):
            months = [r[0] for r in new.select("month").distinct().collect()]  # bounded by the calendar
            rows = upsert(self.rows().where(F.col("month").isin(months)), new, self.keys, self.order, newest_wins=True)
        else:
            rows = upsert(new.limit(0), new, self.keys, self.order, newest_wins=True)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(merged)

    def replace(self, batch_id: int) -> None:
        """Put the merged months into the table."""
        merged = self.spark.read.schema(self.schema).parquet(f"{self.path}/merged/batch={batch_id}")
        dealt = merged.repartition("month", F.pmod(F.xxhash64(*self.keys), F.lit(self.files)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{self.path}/rows")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if _finished(self.spark, self.path, batch_id):
            return
        if not path_exists(self.spark, f"{self.path}/merged/batch={batch_id}/_SUCCESS"):
            self.merge(batch, batch_id)
        self.replace(batch_id)
        _ledger_entry(self.spark, self.path, batch_id)
        remove_path(self.spark, f"{self.path}/merged/batch={batch_id}")


class LateGuard:
    """foreachBatch handler that stores rows in time and sets aside, with a reason, those that are not.

    The mark of a batch is the greatest time that earlier batches brought; rows more than `delay` seconds behind it are
    late, rows without a time have none. Both kinds go to one write, parted by reason (`rows/reason=.../batch=<id>`), and the batch
    enters the ledger with its counts and the new mark; the counts are observed while the rows are written. A batch
    repeated after a failure overwrites its own folders. stored + set aside = sent.
    """

    STORED, LATE, TIMELESS = "stored", "behind mark", "no time"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str, delay: int):
        self.spark, self.path, self.schema, self.ts, self.delay = spark, path.rstrip("/"), schema, ts, delay

    def rows(self, reason: str = STORED) -> DataFrame:
        return self.outcomes().where(F.col("reason") == reason).drop("reason", "batch")

    def outcomes(self) -> DataFrame:
        """All rows with reason and batch."""
        return self.spark.read.schema(StructType([*self.schema, *StructType().add("batch", "integer").add("reason", "string")])).parquet(f"{self.path}/rows")

    def ledger(self) -> DataFrame:
        """batch, mark (microseconds), and rows stored, late and without a time."""
        return self.spark.read.parquet(f"{self.path}/ledger")

    def _mark(self, batch_id: int) -> int | None:
        known = f"{self.path}/ledger"
        if not path_exists(self.spark, known):
            return None
        return self.spark.read.schema("mark long, batch int").parquet(known).where(F.col("batch") < batch_id).agg(F.max("mark")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        mark = self._mark(batch_id)
        micros = F.unix_micros(instant(F.col(self.ts)))
        behind = F.lit(False) if mark is None else micros < mark - self.delay * 1_000_000
        reason = F.when(micros.isNull(), self.TIMELESS).when(behind, self.LATE).otherwise(self.STORED)
        seen = Observation(f"batch-{batch_id}")
        judged = batch.select(*self.schema.names, reason.alias("reason"), micros.alias("__micros"))
        counts = [F.count_if(F.col("reason") == r).alias(n) for n, r in (("stored", self.STORED), ("late", self.LATE), ("timeless", self.TIMELESS))]
        watched = judged.observe(seen, F.max("__micros").alias("mark"), *counts).drop("__micros").withColumn("batch", F.lit(batch_id))
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "reason").parquet(f"{self.path}/rows")
        got = seen.get
        marks = [m for m in (mark, got["mark"]) if m is not None]
        _ledger_entry(self.spark, self.path, batch_id, mark=max(marks) if marks else None, stored=got["stored"], late=got["late"], timeless=got["timeless"])
