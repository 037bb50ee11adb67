"""Incremental tables that keep their marks: each load appends its rows and advances the marks in one step.

Below a table's path lie `rows/load=<n>/month=<yyyy-MM>` and `marks/<n>-from-<m>`. A load writes its rows, then the new
marks; it counts once its marks are complete, and readers take the loads m ... n of the newest marks. A load that broke
off left rows that nobody reads, and the next one overwrites them. No load reads stored rows: the marks tell what is new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tickloom.operators.load import advance_marks, incremental, watermarks
from tickloom.session import list_names, path_exists, remove_path


def _committed(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(last, first) load of every complete version, oldest first."""
    found = []
    for name in list_names(spark, f"{path}/marks"):
        last, _, first = name.partition("-from-")
        if first and path_exists(spark, f"{path}/marks/{name}/_SUCCESS"):
            found.append((int(last), int(first)))
    return sorted(found)


def _forget(spark: SparkSession, path: str, versions: Sequence[tuple[int, int]]) -> None:
    for last, first in versions:
        remove_path(spark, f"{path}/marks/{last}-from-{first}")


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest mark per key, or None before the first load."""
    versions = _committed(spark, path)
    return spark.read.parquet("{}/marks/{}-from-{}".format(path, *versions[-1])) if versions else None


def fresh_rows(new: DataFrame, path: str, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows of `new` behind no stored mark; with no keys there is one mark for the whole table."""
    marks = read_marks(new.sparkSession, path)
    return new if marks is None else incremental(new, marks, keys, ts)


def load_into(new: DataFrame, path: str, keys: Sequence[str], ts: str) -> int:
    """Append the fresh rows of `new` (with `month`) to the table at `path` and advance its marks; the number of the last load.

    A second run with the same rows appends nothing. Rows without a key or time load with the others but move no mark. One load
    of a table runs at a time. The marks of a first load come from its rows, of later ones from the stored marks and the
    rows just written.
    """
    spark = new.sparkSession
    versions = _committed(spark, path)
    last, first = versions[-1] if versions else (0, 1)
    at = f"{path}/rows/load={last + 1}"
    fresh_rows(new, path, keys, ts).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month").parquet(at)
    written = spark.read.schema(new.schema).parquet(at)
    if written.isEmpty():
        remove_path(spark, at)
        return last
    marks = read_marks(spark, path)
    marks = watermarks(written, keys, ts, ts) if marks is None else advance_marks(marks, written, keys, ts)
    marks.write.mode("overwrite").parquet(f"{path}/marks/{last + 1}-from-{first}")
    _forget(spark, path, versions[:-1])  # a reader may still hold the version before
    return last + 1


def read_loaded(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of all complete loads; `schema` is the stored one, with `month`, by which reads are pruned."""
    versions = _committed(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    last, first = versions[-1]
    rows = spark.read.schema(StructType([*schema, *StructType().add("load", IntegerType())])).parquet(f"{path}/rows")
    return rows.where(F.col("load").between(first, last)).drop("load")


def fold_loads(spark: SparkSession, path: str, schema: StructType) -> int:
    """Rewrite all loads as one, month by month, so that many small loads do not become many small files; the number of that load.

    Readers see the old loads until the new one is complete; the old files go once it is.
    """
    versions = _committed(spark, path)
    if not versions:
        return 0
    (last, first), at = versions[-1], f"{path}/rows/load={versions[-1][0] + 1}"
    rows = read_loaded(spark, path, schema)
    rows.repartition("month", F.pmod(F.xxhash64(*(c for c in schema.names if c != "month")), F.lit(8))).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("month").parquet(at)
    read_marks(spark, path).write.mode("overwrite").parquet(f"{path}/marks/{last + 1}-from-{last + 1}")
    _forget(spark, path, versions)
    for load in range(first, last + 1):
        remove_path(spark, f"{path}/rows/load={load}")
    return last + 1
