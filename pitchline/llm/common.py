"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.session import scratch_path

#: White space of every contract here: the ASCII blanks, as a Java regular expression.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame, max_bytes: int = 4 << 20) -> DataFrame:
    """``df``, with Arrow batches of its session held to ``max_bytes`` (a row at least).

    Spark's own bound of 64 MB counts twice in the JVM and again, as Python
    strings, in every worker; whole texts make batches of that size.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", conf.get(key, "64m").lower()).groups()
    size = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    if size > max_bytes:
        conf.set(key, str(max_bytes))
    return df


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc32_fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (NULL ids count as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def row_slices(batches: Iterable[pa.RecordBatch], max_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no slice of several rows holds more than ``max_bytes``."""
    for batch in batches:
        if batch.num_rows <= 1 or batch.nbytes <= max_bytes:
            yield batch
            continue
        step = max(1, batch.num_rows * max_bytes // batch.nbytes)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
