"""Work tables of one run, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import remove_path, work_path


class WorkTables:
    """Parquet tables below the shared folder: a lost executor costs the tasks that read them, not the steps that made them."""

    def __init__(self, spark: SparkSession, owner: str):
        self.spark, self.owner, self.paths = spark, owner, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written and read back."""
        path = work_path(self.spark, f"{self.owner}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append((path, df.schema))
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *kept: DataFrame) -> None:
        """Delete all tables but those that `kept` read."""
        live = {f for df in kept for f in df.inputFiles()}
        for path, _ in self.paths:
            if not any(path.removeprefix("file:").rstrip("/") in f for f in live):
                remove_path(self.spark, path)
        self.paths = []
