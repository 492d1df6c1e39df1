"""Sources, sinks and load control.

Writes go to paths under the shared folder; a load is an overwrite, so
re-running it gives the same table (idempotent). Row counts are taken with
``DataFrame.observe`` during the write itself: no second scan.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOAD_LOG_SCHEMA = ("load_id string, target_table string, source_file string, rows_loaded long, "
                   "warehouse_name string, load_started_at timestamp_ntz, load_ended_at timestamp_ntz, "
                   "duration_seconds double, credits_used double")


def utc_now() -> datetime.datetime:
    """The time now, taken once on the driver (UTC, as the session's zone): a column of it never moves on a reread."""
    return datetime.datetime.now(datetime.UTC).replace(tzinfo=None)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             mode: str = "FAILFAST") -> DataFrame:
    """Typed CSV scan. Header names are checked against the schema (a
    reordered file fails instead of loading silently wrong); empty fields are
    NULL; ``"`` quotes allow commas inside values."""
    return (spark.read.schema(schema)
            .option("header", header)
            .option("enforceSchema", False)
            .option("mode", mode)
            .option("quote", '"')
            .option("escape", '"')
            .csv(path))


def load_table(df: DataFrame, target: str, partition_by: Sequence[str] = (),
               fmt: str = "parquet") -> DataFrame:
    """Truncate-and-load. Partitioned targets overwrite only the partitions written."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(target)
    return df.sparkSession.read.format(fmt).load(target)


def load_bucketed(df: DataFrame, table_name: str, keys: Sequence[str], buckets: int, path: str,
                  sort: bool = True) -> DataFrame:
    """S2 for large join partners: write bucketed (and sorted) by the join key as a
    catalog table stored at ``path`` (the shared folder). Two tables bucketed on
    the same key with the same bucket count join without a shuffle of either side
    (e.g. lineitem and orders on the order key)."""
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table_name)
    return df.sparkSession.table(table_name)


def load_with_log(df: DataFrame, target: str, target_table: str, source_file: str,
                  log_path: str | None = None, partition_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """S3: load plus one audit row (rows counted by ``observe`` during the write).

    Returns (loaded table, log row). The log row is appended to ``log_path``.
    """
    spark = df.sparkSession
    obs = Observation(f"load_{uuid.uuid4().hex}")
    started = time.time()
    t0 = utc_now()
    loaded = load_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), target, partition_by)
    rows = int(obs.get["rows"])
    duration, ended = time.time() - started, utc_now()
    log = spark.createDataFrame(
        [(uuid.uuid4().hex, target_table, source_file, rows, spark.sparkContext.appName, t0, ended, duration, None)],
        LOAD_LOG_SCHEMA)
    if log_path:
        log.write.mode("append").parquet(log_path)
    return loaded, log


def align_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Additive evolution: missing columns appear as typed NULLs, in schema order;
    columns the schema does not know are kept at the end. Re-runnable."""
    have = set(df.columns)
    cols = [F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols, *extra)


def assert_source(df: DataFrame, source: str, columns: Sequence[str], min_rows: int,
                  strict: bool = False) -> DataFrame:
    """Exact header list and a row-count floor; returns one status row.

    With ``strict`` a failing contract raises at run time (``raise_error``).
    """
    header_ok = list(df.columns) == list(columns)
    status = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(source).alias("source"), F.lit(header_ok).alias("header_ok"), "row_count",
        F.lit(min_rows).alias("min_rows"),
        (F.lit(header_ok) & (F.col("row_count") >= min_rows)).alias("passed"))
    if strict:
        status = status.withColumn(
            "passed", F.when(F.col("passed"), F.col("passed")).otherwise(
                F.raise_error(F.lit(f"source contract failed for {source}"))))
    return status


def write_sorted_csv(df: DataFrame, keys: Sequence[str], path: str, num_partitions: int | None = None) -> None:
    """Stable sorted export: range-partitioned on the keys and sorted in
    each partition, so the part files concatenate in key order (no single-task sort)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("header", True).csv(path))


def write_results(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a result table."""
    return load_table(df, path)


def rebuild(spark: SparkSession, root: str,
            steps: Sequence[tuple],
            checks: Callable[[dict[str, DataFrame]], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Build tables in dependency order; each step sees the tables written
    before it (read back from storage, so lineage is cut at every table).

    A step is ``(name, fn)`` or ``(name, fn, partition_by)``; a fact written
    partitioned by its cohort key gets partition pruning on cohort filters.
    ``checks`` returns a frame with a boolean ``passed`` column. Its failing
    rows are all written, with their labels, to ``root/_failed_checks``; any of
    them raises after the build (the written tables stay for inspection).
    """
    tables: dict[str, DataFrame] = {}
    for step in steps:
        name, fn = step[0], step[1]
        part = step[2] if len(step) > 2 else ()
        tables[name] = load_table(fn(tables), f"{root}/{name}", partition_by=part)
    if checks is not None:
        failed = load_table(checks(tables).where(~F.col("passed")), f"{root}/_failed_checks")
        if not failed.isEmpty():
            raise AssertionError(f"integrity checks failed, see {root}/_failed_checks")
    return tables
