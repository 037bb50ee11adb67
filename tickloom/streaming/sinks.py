"""Running a stream to completion over what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_new_files(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    """Parquet file source; the query checkpoint remembers which files were read."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process all files present, append finished rows to `out`, stop.

    Any scheduler can call this every minute; the checkpoint makes runs exactly-once.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_batches(stream: DataFrame, handle, checkpoint: str) -> None:
    """Process all files present through `handle(batch, batch_id)`, stop."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
