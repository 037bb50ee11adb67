"""Lake layout: base and delta files per month, append, upsert, discovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.times import MONTH_PATTERN, epoch_millis, instant
from tickloom.operators.load import delete_where, union_evolving, upsert
from tickloom.session import cut_lineage, remove_path

MONTH_SOURCES = ("open_time", "timestamp", "extracted_at")
# <month>_delta_<epoch ms>[_<hex>].parquet, as a file or as a folder of part files
ANY_DELTA = r"/[^/]+_delta_[^/]*\.parquet(?:/|$)"
TIMED_DELTA = r"/[^/]+_delta_([0-9]+)(?:_[^/]*)?\.parquet(?:/|$)"


def month_of(ts: Column, kind: str) -> Column:
    """UTC 'yyyy-MM' of a timestamp or an epoch number; a NULL raises."""
    at = F.timestamp_millis(epoch_millis(ts)) if kind in ("bigint", "double", "int") else instant(ts)
    return F.when(ts.isNotNull(), F.date_format(at, "yyyy-MM")).otherwise(
        F.raise_error(F.lit("Cannot derive month from null timestamp")).cast("string")
    )


def derive_month(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add `month` from the first of open_time, timestamp, extracted_at; else from `as_of`."""
    kinds = dict(df.dtypes)
    for name in MONTH_SOURCES:
        if name in kinds:
            return df.withColumn("month", month_of(F.col(name), kinds[name]))
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumn("month", F.date_format(now, "yyyy-MM"))


def append_delta(df: DataFrame, path: str, keys: Sequence[str] = ("symbol",)) -> None:
    """Append rows below path/<key>=/month=; no read, no merge."""
    derive_month(df).write.mode("append").partitionBy(*keys, "month").parquet(path)


#: Files that one partition is written to, so that a hot key's month is not one task's work.
FILES_PER_PARTITION = 8


def _prints(df: DataFrame, partitions: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per partition the row count and two sums over the rows' hashes, the same for the same rows in any order."""
    low = F.lit(1 << 32)
    hashes = [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]
    return df.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(part) for h in hashes for part in (F.pmod(h, low), F.shiftrightunsigned(h, 32))]).alias("sums"),
    )


def changed_partitions(stored: DataFrame, merged: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The partitions whose rows differ between the two frames; columns that only `merged` has count as NULL in `stored`."""
    columns = sorted(merged.columns)
    missing = {c: F.lit(None).cast(merged.schema[c].dataType) for c in columns if c not in stored.columns}
    old = _prints(stored.withColumns(missing) if missing else stored, partitions, columns)
    new = _prints(merged, partitions, columns)
    return new.join(old, [*partitions, "n", "sums"], "left_anti").select(*partitions)


def upsert_months(
    df: DataFrame, path: str, keys: Sequence[str], partitions: Sequence[str], order=(),
    months: Sequence[str] | None = None, schema: StructType | None = None,
) -> None:
    """Merge `df` (with its partition columns) into the touched partitions of `path`.

    `months`, the values of the first partition column that `df` holds, keep the other partitions from being
    listed and read; without them Spark may read all. `schema` is the stored one; without it every file's footer
    is opened to merge theirs. A partition's rows are dealt over several tasks by their keys. The merged rows are checkpointed to the shared
    folder before the dynamic overwrite, so a lost executor cannot make a task re-read a
    partition that is already being replaced. Partitions whose rows the merge leaves as they are stay untouched, so a
    repeated delivery writes nothing.
    """
    spark = df.sparkSession
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    old = reader.parquet(path)
    if months is not None:
        old = old.where(F.col(partitions[0]).isin(list(months)))
    touched = old.join(df.select(*partitions).distinct(), list(partitions), "left_semi")
    merged = cut_lineage(upsert(touched, df, [*partitions, *keys], order))
    # one row per changed partition, settled before any of them is replaced
    changed = cut_lineage(changed_partitions(touched, merged, partitions))
    if changed.isEmpty():
        return
    (
        merged.join(changed, list(partitions), "left_semi")
        .repartition(*partitions, F.pmod(F.xxhash64(*keys), F.lit(FILES_PER_PARTITION)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def delete_from(spark: SparkSession, path: str, condition: Column, schema: StructType, partition: str = "month") -> None:
    """Rewrite the partitions of the table at `path` that hold rows where `condition` is true, without those rows.

    The rows that stay are checkpointed before the overwrite; a partition left without rows is removed.
    """
    stored = spark.read.schema(schema).parquet(path)
    touched = [r[0] for r in stored.where(condition).select(partition).distinct().collect()]  # bounded by the calendar
    kept = cut_lineage(delete_where(stored.where(F.col(partition).isin(touched)), condition))
    filled = {r[0] for r in kept.select(partition).distinct().collect()}
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for value in touched:
        if value not in filled:
            remove_path(spark, f"{path}/{partition}={value}")


def delta_millis() -> Column:
    """Write time in a delta's name; NULL for other files and unparsable names."""
    return F.regexp_extract(F.col("_metadata.file_path"), TIMED_DELTA, 1).try_cast("bigint")


def read_deltas(
    spark: SparkSession, paths: Sequence[str], since_ms: int | None = None, schema: str | None = None
) -> DataFrame:
    """Delta rows, optionally only of files written after `since_ms`.

    The filter is on file metadata, so skipped files are not opened.
    """
    reader = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
    if schema:
        reader = reader.schema(schema)
    rows = reader.parquet(*paths).where(F.col("_metadata.file_path").rlike(ANY_DELTA))
    return rows if since_ms is None else rows.where(delta_millis() > since_ms)


def scan_base_delta(
    spark: SparkSession,
    deltas: Sequence[str],
    base_csv: str | None = None,
    base_parquet: str | None = None,
    since_ms: int | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Base month (skipped on an incremental read) plus deltas, columns aligned by name."""
    frames = []
    if since_ms is None and base_csv:
        frames.append(spark.read.option("header", "true").schema(schema).csv(base_csv))
    if since_ms is None and base_parquet:
        frames.append(spark.read.parquet(base_parquet))
    frames.append(read_deltas(spark, deltas, since_ms, schema))
    return union_evolving(*frames)


def discover_months(names: DataFrame, column: str, extension: str = ".parquet") -> DataFrame:
    """Distinct valid months of base and delta file names; other names are ignored."""
    file = F.element_at(F.split(column, "/"), -1)
    is_delta = file.contains("_delta_") & file.endswith(".parquet")
    is_base = file.endswith(extension) & ~file.contains("_delta_")
    month = F.when(is_delta, F.substring_index(file, "_delta_", 1)).when(
        is_base, F.substring(file, F.lit(1), F.length(file) - len(extension))
    )
    return names.select(month.alias("month")).where(F.col("month").rlike(MONTH_PATTERN)).distinct()


def dim_from_symbols(df: DataFrame, quote: str = "USDT") -> DataFrame:
    """symbol, base_asset, quote_asset of distinct symbols; the base is the symbol without its quote."""
    quoted = F.col("symbol").endswith(quote)
    return df.select("symbol").distinct().select(
        "symbol",
        F.when(quoted, F.left("symbol", F.length("symbol") - len(quote))).otherwise(F.col("symbol")).alias("base_asset"),
        F.when(quoted, quote).otherwise("").alias("quote_asset"),
    )


def registry(spark: SparkSession) -> DataFrame:
    """The registered symbols as a dimension with status and break date."""
    from tickloom.vocab import DELISTED_ON, REGISTERED_SYMBOLS

    rows = [
        (s, "BREAK" if s in DELISTED_ON else "TRADING", DELISTED_ON.get(s)) for s in REGISTERED_SYMBOLS
    ]
    listed = spark.createDataFrame(rows, "symbol string, status string, break_date string")
    return dim_from_symbols(listed).join(listed, "symbol")
