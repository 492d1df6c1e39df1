"""Incremental consumption of change files with Structured Streaming.

A file stream of change rows feeds ``foreachBatch``. The target is Parquet
that is only added to: the initial rows (``base``), and per micro-batch N the
changes it accepted and those it refused, in folders named batch_id=N. Batch N
is judged by the state that the batches before it left, and writing it means
overwriting its own two folders, so a batch that comes again after a crash
changes nothing, and one that failed has left nothing. The state is derived:
base and accepted inserts, with each key's latest accepted update. ``fold``
writes it as the next base once the changes have grown.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pitchline.operators.cdc import DELETE, INSERT, UPDATE, apply_updates

#: (state, net changes) -> (accepted changes: the state's columns and change_type, rejects: keys, change_type, reason)
AcceptFn = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def bootstrap(root: str, initial: DataFrame, keys: Sequence[str]) -> None:
    """Write the initial state."""
    initial.write.parquet(f"{root}/base/upto=-1")
    tagged = initial.limit(0).withColumn("change_type", F.lit(UPDATE))
    tagged.write.parquet(f"{root}/accepted/batch_id=-1")
    tagged.select(*keys, "change_type", F.lit("").alias("reason")).write.parquet(f"{root}/rejects/batch_id=-1")


def _folded(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/base").select(F.max("upto")).first()[0]  # folder names only decide


def state(spark: SparkSession, root: str, keys: Sequence[str], update_cols: Sequence[str], below: int | None = None) -> DataFrame:
    """Current rows, or those that the batches below ``below`` left."""
    upto = _folded(spark, root)
    base = spark.read.parquet(f"{root}/base").where(F.col("upto") == upto).drop("upto")
    changes = spark.read.parquet(f"{root}/accepted").where(F.col("batch_id") > upto)
    changes = changes if below is None else changes.where(F.col("batch_id") < below)
    rows = base.unionByName(changes.where(F.col("change_type") == INSERT).select(*base.columns))
    latest = (changes.where(F.col("change_type") == UPDATE).groupBy(*keys)
              .agg(F.max_by(F.struct(*update_cols), "batch_id").alias("_last"))
              .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in update_cols], F.lit(UPDATE).alias("change_type")))
    return apply_updates(rows, latest, keys, update_cols)


def fold(spark: SparkSession, root: str, keys: Sequence[str], update_cols: Sequence[str]) -> None:
    """Write the current state as the next base. Readers take it once it is complete; run it between batches."""
    newest = spark.read.parquet(f"{root}/accepted").select(F.max("batch_id")).first()[0]
    if newest > _folded(spark, root):
        state(spark, root, keys, update_cols).write.parquet(f"{root}/base/upto={newest}")


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Refused changes of every batch, with its id."""
    return spark.read.parquet(f"{root}/rejects")


def counts(spark: SparkSession, root: str) -> DataFrame:
    """I4's result: per batch the number of net changes, rows corrected, inserted and rejected."""
    done = spark.read.parquet(f"{root}/accepted").select("batch_id", F.col("change_type").alias("what"))
    both = done.unionByName(rejects(spark, root).select("batch_id", F.lit(DELETE).alias("what")))
    number = lambda kind: F.count_if(F.col("what") == kind)
    return both.groupBy(F.col("batch_id").cast("long").alias("version")).agg(
        F.count(F.lit(1)).alias("changes"), number(UPDATE).alias("corrected"), number(INSERT).alias("inserted"),
        number(DELETE).alias("rejected"))


def consume_changes(spark: SparkSession, source_dir: str, schema: StructType | str, checkpoint: str, root: str, accept: AcceptFn,
                    keys: Sequence[str], update_cols: Sequence[str], net: Callable[[DataFrame], DataFrame],
                    every: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Judge every new change file once, on demand (what is there, then stop) or on a schedule such as "60 minutes".

    ``net`` reduces a batch to one change per key.
    """
    description = spark.sparkContext.getLocalProperty("spark.job.description")

    def process(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if description:  # the batch's jobs belong to the job that started the stream
            session.sparkContext.setJobDescription(description)
        if batch_id <= _folded(session, root):
            return  # already part of the base
        parts = accept(state(session, root, keys, update_cols, below=batch_id), net(batch))
        for part, name in zip(parts, ("accepted", "rejects")):
            part.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(source_dir).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    q = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        q.awaitTermination()
    return q


def drain_changes(spark: SparkSession, source_dir: str, schema: StructType | str, checkpoint: str) -> None:
    """Advance the stream offset over the backlog without applying it
    (after a bulk reload made those changes redundant)."""
    q = (spark.readStream.schema(schema).parquet(source_dir).writeStream
         .foreachBatch(lambda batch, batch_id: None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
