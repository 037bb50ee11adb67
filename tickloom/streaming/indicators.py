"""Incremental indicators: every micro-batch continues from a carry table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.indicators import momentum, momentum_state
from tickloom.operators.load import incremental, upsert
from tickloom.session import cut_lineage, remove_path
from tickloom.vocab import CANDLE_STEP_SECONDS


class MomentumStream:
    """foreachBatch handler that appends candles with rsi_14 and macd.

    The carry table has one row per symbol (last close, four means, last time). Batch n reads
    the version written by batch n-1 and writes version n; both outputs are overwritten by
    batch id, so a batch repeated after a failure gives the same files. The last two versions
    are kept. Rows at or behind a symbol's last time are late and dropped, and of rows delivered
    twice in a batch one is used.
    """

    def __init__(self, spark: SparkSession, path: str, step: int = CANDLE_STEP_SECONDS):
        self.spark, self.path, self.step = spark, path.rstrip("/"), step

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows").drop("batch")

    def _carry(self, version: int) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/carry/v{version}") if version >= 0 else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self._carry(batch_id - 1)
        batch = batch.dropDuplicates(["symbol", "open_time"])
        fresh = batch if before is None else incremental(
            batch, before.withColumnRenamed("last_time", "open_time"), ["symbol"], "open_time"
        )
        out = cut_lineage(momentum(fresh, step=self.step, carry=before, keep_means=True))
        state = momentum_state(out).join(
            out.groupBy("symbol").agg(F.max("open_time").alias("last_time")), "symbol"
        )
        if before is not None:
            state = upsert(before, state, ["symbol"])
        out.drop("avg_gain", "avg_loss", "ema_fast", "ema_slow").write.mode("overwrite").parquet(
            f"{self.path}/rows/batch={batch_id}"
        )
        state.write.mode("overwrite").parquet(f"{self.path}/carry/v{batch_id}")
        if batch_id > 1:
            remove_path(self.spark, f"{self.path}/carry/v{batch_id - 2}")
