"""Curated publishing (H1): only allow-listed marts are written under the
publish root, each under its own name; nothing else is reachable there."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(marts: Mapping[str, Callable[[], DataFrame]], allowlist: Sequence[str], root: str) -> dict[str, str]:
    """Write every allow-listed mart to ``root/<name>`` (overwrite); refuse unknown names.

    Marts are passed as thunks so that nothing outside the allow-list is even
    planned.
    """
    unknown = [n for n in allowlist if n not in marts]
    if unknown:
        raise KeyError(f"not a mart: {unknown}")
    paths = {}
    for name in allowlist:
        path = f"{root}/{name}"
        marts[name]().write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def published_names(spark: SparkSession, root: str) -> list[str]:
    """Names reachable under the publish root (directory listing through Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def publish_report(spark: SparkSession, root: str, allowlist: Sequence[str]) -> DataFrame:
    """One row per published name with its row count; raises if the root holds anything else."""
    names = published_names(spark, root)
    if sorted(names) != sorted(allowlist):
        raise AssertionError(f"publish root holds {names}, expected {sorted(allowlist)}")
    out = None
    for n in names:
        part = read_published(spark, root, n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("view_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out


def access_report(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """One row per name: can a consumer of the publish root read it? (Raw and unlisted tables must come out false.)"""
    def reachable(name: str) -> bool:
        try:
            read_published(spark, root, name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True
    return spark.createDataFrame([(n, reachable(n)) for n in names], "name string, reachable boolean")
