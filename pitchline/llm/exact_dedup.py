"""Exact dedup: 128-bit content hash, smallest id stays, bytes compared inside the groups.

Texts are equal when they are identical after every run of ASCII white space
became one space. The grouping key is (content hash, normalised text), so two
texts that collide on the hash are still told apart by their bytes. The
aggregation combines on the map side: a group of copies that holds a third of
all rows reaches the shuffle as one row per task, not as its copies.

Members then look up their class by (content hash, SHA-256 of the normalised
text), 48 narrow bytes per document, through a join that Spark can split where
one key is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import BLANKS, text_or_empty


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_or_empty(text_col), BLANKS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    NULL texts count as empty; all empty texts form one group. Rows that
    repeat the smallest id are one document, so each of them is kept; NULL ids
    never win over an id, and a group of only NULL ids keeps its rows
    (keep_id NULL). Other columns of ``docs`` are ignored, whatever their
    names; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    keyed = rows.withColumn("h", content_hash(F.col("norm")))
    classes = (keyed.groupBy("h", "norm")
               .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("h", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"))
    members = keyed.select("id", "h", F.unhex(F.sha2("norm", 256)).alias("sha"))
    return (members.join(classes, ["h", "sha"])
            .select(F.col("id").alias(id_col), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact dedup keeps, with their columns unchanged.

    The dropped members' (id, content hash) pairs are the narrow side of an
    anti join, so a repeated id with another text stays.
    """
    losers = (exact_dedup(docs, id_col, text_col).where(~F.col("kept"))
              .select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")).distinct())
    here = F.sha2(normalised(text_col), 256)
    return docs.join(losers, docs[id_col].eqNullSafe(losers["__id"]) & (here == losers["__sha"]), "left_anti")
