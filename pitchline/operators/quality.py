"""Data-quality operators.

Row-level checks return the failing rows as ``(key columns..., detail)``.
Checks that compare whole tables return one row per finding. No check pulls
rows to the driver; counts come from aggregates. Any number of checks of one
table can run in one scan of it (``run_checks``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.functions.columns import broadcast_if_small, count_if
from pitchline.operators.cdc import row_text
from pitchline.session import cut_lineage, default_partitions
from pitchline.sources.files import utc_now


def _keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def _txt(c: Column) -> Column:
    """Text of a value; 'NULL' for NULL so a detail never becomes NULL."""
    return F.coalesce(c.cast("string"), F.lit("NULL"))


def find_duplicates(df: DataFrame, keys: Sequence[str], detail: str | None = None) -> DataFrame:
    """V1: every row whose key occurs more than once (all copies).

    Key counts are pre-aggregated map-side; the repeated keys then filter
    the rows with a semi join (split by AQE when one key is hot), instead of
    a window that would put a whole key group in one task.
    """
    keys = list(keys)
    det = detail or f"duplicate key ({'+'.join(keys)})"
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).drop("count")
    return df.join(dup, keys, "left_semi").select(*keys, F.lit(det).alias("detail"))


@dataclass(frozen=True)
class Check:
    """A check of the rows of one table.

    ``attach`` joins what the check looks up; ``failing`` and ``detail`` are
    columns of the frame it returns. With ``repeated`` the row fails if its
    keys occur again (V1), whatever ``failing`` says.
    """

    name: str
    keys: tuple[str, ...]
    failing: Column
    detail: Column
    attach: Callable[[DataFrame], DataFrame] = lambda df: df
    repeated: bool = False

    def rows(self, df: DataFrame) -> DataFrame:
        """The failing rows: keys and detail."""
        return self.attach(df).where(self.failing).select(*self.keys, self.detail.alias("detail"))

    def record_key(self) -> Column:
        return F.concat_ws("|", *[_txt(F.col(k)) for k in self.keys])


def duplicate_check(name: str, keys: Sequence[str], detail: str | None = None) -> Check:
    """V1 for ``run_checks``: keys that occur more than once (all copies)."""
    det = detail or f"duplicate key ({'+'.join(keys)})"
    return Check(name, tuple(keys), F.lit(True), F.lit(det), repeated=True)


def mismatch_check(name: str, lookup: DataFrame, k1: str, k2: str, lookup_key: str, attr: str, row_attr: str,
                   keys: Sequence[str], cond: Column | None = None, null_safe: bool = True, label: str = "group") -> Check:
    """V2: see ``find_mismatches``."""
    def attach(df: DataFrame) -> DataFrame:
        lk = broadcast_if_small(lookup.select(F.col(lookup_key).alias("_lk"), F.col(attr).alias("_la")))
        h = lk.select(F.col("_lk").alias(f"_{name}_hk"), F.col("_la").alias(f"_{name}_ha"))
        a = lk.select(F.col("_lk").alias(f"_{name}_ak"), F.col("_la").alias(f"_{name}_aa"))
        return (df.join(h, df[k1] == F.col(f"_{name}_hk"), "left")
                .join(a, df[k2] == F.col(f"_{name}_ak"), "left"))

    ha, aa, ra = F.col(f"_{name}_ha"), F.col(f"_{name}_aa"), F.col(row_attr)
    same = (ha.eqNullSafe(aa) & aa.eqNullSafe(ra)) if null_safe else ((ha == aa) & (aa == ra))
    bad = ~same if cond is None else (cond & ~same)
    shown = lambda c: F.coalesce(c, F.lit("none"))
    detail = F.concat(F.lit(f"{label}: expected "), shown(ra), F.lit(", found "), shown(ha), F.lit(" / "), shown(aa))
    return Check(name, tuple(keys), bad, detail, attach)


def find_mismatches(df: DataFrame, lookup: DataFrame, k1: str, k2: str, lookup_key: str, attr: str,
                    row_attr: str, keys: Sequence[str], cond: Column | None = None,
                    null_safe: bool = True, label: str = "group") -> DataFrame:
    """V2: on rows where ``cond`` holds, report unless lookup[k1] = lookup[k2] = row_attr.

    ``null_safe=False`` is SQL three-valued logic (a missed lookup makes the
    predicate NULL and the row is *not* reported); ``null_safe=True`` uses
    null-safe equality and reports it.
    """
    return mismatch_check("mismatch", lookup, k1, k2, lookup_key, attr, row_attr, keys, cond, null_safe, label).rows(df)


def missing_check(name: str, cols: Sequence[str], roster: DataFrame, roster_col: str, keys: Sequence[str],
                  null_aware: bool = False, detail: str = "value not found in roster") -> Check:
    """V3: see ``find_missing``."""
    cols = list(cols)

    def attach(df: DataFrame) -> DataFrame:
        members = roster.select(F.col(roster_col).alias("_m")).where(F.col("_m").isNotNull()).distinct()
        for i, c in enumerate(cols):
            m = broadcast_if_small(members.select(F.col("_m").alias(f"_{name}_m{i}"), F.lit(True).alias(f"_{name}_hit{i}")))
            df = df.join(m, df[c] == F.col(f"_{name}_m{i}"), "left")
        if null_aware:
            has_null = roster.agg(F.max(F.col(roster_col).isNull().cast("int")).alias(f"_{name}_null"))
            df = df.crossJoin(F.broadcast(has_null))  # one row
        return df

    miss = F.lit(False)
    for i, c in enumerate(cols):
        this = F.col(f"_{name}_hit{i}").isNull()
        miss = miss | (this & F.col(c).isNotNull() if null_aware else this)
    if null_aware:
        miss = miss & (F.coalesce(F.col(f"_{name}_null"), F.lit(0)) == 0)
    return Check(name, tuple(keys), miss, F.lit(detail), attach)


def find_missing(df: DataFrame, cols: Sequence[str], roster: DataFrame, roster_col: str,
                 keys: Sequence[str], null_aware: bool = False,
                 detail: str = "value not found in roster") -> DataFrame:
    """V3: rows where any of ``cols`` is not in the roster.

    Default: plain membership (a NULL in the roster is ignored). With
    ``null_aware`` it follows SQL ``NOT IN``: a NULL anywhere in the roster
    suppresses every failure, and a NULL value is never reported.
    """
    return missing_check("missing", cols, roster, roster_col, keys, null_aware, detail).rows(df)


def range_check(name: str, cols: Sequence[str], lo, hi, keys: Sequence[str], label: str = "invalid value") -> Check:
    """V4: see ``find_out_of_range``."""
    bad = None
    parts = [F.lit(f"{label}:")]
    for c in cols:
        t = (F.col(c) < lo) | (F.col(c) > hi)
        bad = t if bad is None else (bad | t)
        parts += [F.lit(f" {c}="), _txt(F.col(c))]
    return Check(name, tuple(keys), bad, F.concat(*parts))


def find_out_of_range(df: DataFrame, cols: Sequence[str], lo, hi, keys: Sequence[str],
                      label: str = "invalid value") -> DataFrame:
    """V4: any column < lo or > hi; the detail names every column (NULL shown as 'NULL')."""
    return range_check("range", cols, lo, hi, keys, label).rows(df)


def window_check(name: str, col: str, lo: str, hi: str, keys: Sequence[str]) -> Check:
    """V5: see ``find_outside_window``."""
    outside = ~F.to_date(F.col(col)).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return Check(name, tuple(keys), outside, F.lit(f"{col} outside the window {lo} to {hi}"))


def find_outside_window(df: DataFrame, col: str, lo: str, hi: str, keys: Sequence[str]) -> DataFrame:
    """V5: date (of a date or timestamp) outside the inclusive [lo, hi] window."""
    return window_check("window", col, lo, hi, keys).rows(df)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """V8/V9: all ``checks`` of one table in one scan of it.

    Each row yields an array with an entry per check that it fails (and one
    per duplicate check, whose keys must be counted); one ``inline`` and one
    map-side combined aggregation turn them into findings: check_name,
    table_name, record_key, detail, copies. The row without a check_name
    counts the table's rows. The findings are written once, as rejects and
    summary both read them.
    """
    kind = "struct<check:int,key:string,same:string,detail:string>"
    none = F.lit(None).cast("string")

    def entry(number: int) -> Column:
        check = checks[number]
        if not check.repeated:
            return F.when(check.failing, F.struct(F.lit(number), check.record_key(), none, check.detail).cast(kind))
        # only copies of one key may be counted together; keys of numbers and dates never print alike
        plain = all(isinstance(df.schema[k].dataType, (T.NumericType, T.DateType, T.BooleanType)) for k in check.keys)
        return F.struct(F.lit(number), check.record_key(), none if plain else row_text(df, check.keys), none).cast(kind)

    rows = df
    for check in checks:
        rows = check.attach(rows)
    every = F.struct(F.lit(-1), none, none, none).cast(kind)
    entries = F.array(every, *[entry(k) for k in range(len(checks))])
    found = (rows.select(F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("e.*")
             .groupBy("check", "key", "same", "detail").agg(F.count(F.lit(1)).alias("copies")))
    # the row count of an empty table
    found = found.unionByName(df.sparkSession.range(1).select(every.alias("e"), F.lit(0).cast("long").alias("copies")).select("e.*", "copies"))
    counted = [k for k, c in enumerate(checks) if c.repeated]
    if counted:
        found = found.where(~F.col("check").isin(counted) | (F.col("copies") > 1))
    name, detail = none, F.col("detail")
    for k, check in enumerate(checks):
        name = F.when(F.col("check") == k, F.lit(check.name)).otherwise(name)
        if check.repeated:
            detail = F.when(F.col("check") == k, check.detail).otherwise(detail)
    return cut_lineage(found.select(name.alias("check_name"), F.lit(table).alias("table_name"), F.col("key").alias("record_key"),
                                    detail.alias("detail"), "copies"))


def compare_counts(df: DataFrame, col: str, expected: DataFrame, exp_col: str = "category",
                   exp_count: str = "expected_count") -> DataFrame:
    """V6: per category, actual vs expected count; one failure row per differing category.

    Full outer comparison: categories missing from the data count 0, and
    categories not in the expected list are reported too.
    """
    actual = df.groupBy(F.col(col).alias("category")).agg(F.count(F.lit(1)).alias("actual_count"))
    exp = expected.select(F.col(exp_col).alias("category"), F.col(exp_count).cast("long").alias("expected_count"))
    j = actual.join(exp, "category", "full_outer").select(
        "category", F.coalesce("expected_count", F.lit(0)).alias("expected_count"),
        F.coalesce("actual_count", F.lit(0)).alias("actual_count"))
    return (j.where(F.col("expected_count") != F.col("actual_count"))
            .select("category", "expected_count", "actual_count",
                    F.concat(F.lit(f"{col}="), _txt(F.col("category")), F.lit(" expected="),
                             F.col("expected_count").cast("string"), F.lit(" actual="),
                             F.col("actual_count").cast("string")).alias("detail")))


def assert_absent(spark: SparkSession, df: DataFrame, names: Sequence[str], table_name: str) -> DataFrame:
    """V7: one failure row per forbidden column present (case-insensitive)."""
    present = {c.lower() for c in df.schema.names}
    hits = [(table_name, n, f"unverified column {n} present") for n in names if n.lower() in present]
    return spark.createDataFrame(hits, "table_name string, column_name string, detail string")


def collect_rejects(checks: Sequence[tuple[str, str, DataFrame, Sequence[str]]],
                    run_id: str | None = None, stamp: bool = True, at: datetime | None = None,
                    sink: str | None = None) -> DataFrame:
    """V8: every failing row of every check, one shape, one distributed write.

    ``checks``: (check_name, table_name, failing rows, key columns). ``at`` is
    the time of the run (now, taken once, if not given). With ``sink`` the rows
    are appended to that table and the rows of this run are read back from it.
    """
    out = None
    for name, table, rows, keys in checks:
        key = F.concat_ws("|", *[_txt(F.col(k)) for k in keys])
        part = rows.select(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                           key.alias("record_key"), F.col("detail"))
        out = part if out is None else out.unionByName(part)
    if stamp:
        run_id = run_id or uuid.uuid4().hex
        out = _stamped(out, run_id, "rejected_at", at)
    return _appended(out, sink, run_id) if sink else out


def rejects_of(runs: Sequence[DataFrame], run_id: str | None = None, stamp: bool = True, at: datetime | None = None,
               sink: str | None = None) -> DataFrame:
    """V8 of ``run_checks`` findings: one row per failing row; ``at`` and ``sink`` as in ``collect_rejects``."""
    out = None
    for run in runs:
        part = (run.where(F.col("check_name").isNotNull())
                .select("check_name", "table_name", "record_key", "detail", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
                .drop("_copy"))
        out = part if out is None else out.unionByName(part)
    if stamp:
        run_id = run_id or uuid.uuid4().hex
        out = _stamped(out, run_id, "rejected_at", at)
    return _appended(out, sink, run_id) if sink else out


def summary_of(runs: Sequence[tuple[DataFrame, Sequence[Check]]], extra: DataFrame | None = None, run_id: str | None = None,
               stamp: bool = True, at: datetime | None = None, sink: str | None = None) -> DataFrame:
    """V9 of ``run_checks`` findings: one row per check, failed or not.

    ``runs``: (findings, their checks). ``extra``: rows (check_name,
    table_name, rows_failed) of checks that read no rows, such as V7's.
    """
    out = None
    for run, checks in runs:
        total = run.where(F.col("check_name").isNull()).agg(F.first("table_name").alias("table_name"),
                                                            F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("rows_checked"))
        failed = run.groupBy("check_name").agg(F.sum("copies").alias("_failed"))
        names = F.explode(F.array(*[F.lit(c.name) for c in checks])).alias("check_name")
        part = total.select("table_name", "rows_checked", names).join(failed, "check_name", "left").select(
            "check_name", "table_name", "rows_checked", F.coalesce("_failed", F.lit(0)).cast("long").alias("rows_failed"))
        out = part if out is None else out.unionByName(part)
    if extra is not None:
        sizes = out.groupBy("table_name").agg(F.max("rows_checked").alias("rows_checked"))
        out = out.unionByName(extra.join(sizes, "table_name").select("check_name", "table_name", "rows_checked", "rows_failed"))
    out = out.select("*", (F.col("rows_failed") == 0).alias("passed"),
                     F.when(F.col("rows_failed") > 0, F.concat(F.col("rows_failed").cast("string"), F.lit(" failing rows"))).alias("notes"))
    if stamp:
        run_id = run_id or uuid.uuid4().hex
        out = _stamped(out, run_id, "checked_at", at)
    return _appended(out, sink, run_id) if sink else out


def _stamped(df: DataFrame, run_id: str, time_col: str, at: datetime | None) -> DataFrame:
    return df.withColumn("run_id", F.lit(run_id)).withColumn(
        time_col, F.lit(at or utc_now()).cast("timestamp_ntz"))


def _appended(df: DataFrame, sink: str, run_id: str | None) -> DataFrame:
    df.write.mode("append").parquet(sink)
    written = df.sparkSession.read.schema(df.schema).parquet(sink)
    return written.where(F.col("run_id") == run_id) if "run_id" in df.columns else written


def summarize_checks(checks: Sequence[tuple[str, str, DataFrame, DataFrame]],
                     run_id: str | None = None, stamp: bool = True, at: datetime | None = None,
                     sink: str | None = None) -> DataFrame:
    """V9: one row per check: rows checked, rows failed, passed, notes.

    ``checks``: (check_name, table_name, checked table, failing rows). Each
    table is counted once, whatever number of checks read it. ``at`` and
    ``sink`` as in ``collect_rejects``.
    """
    sizes: dict[str, DataFrame] = {}
    out = None
    for name, table, src, rows in checks:
        checked = sizes.setdefault(table, src.agg(F.count(F.lit(1)).alias("rows_checked")))
        failed = rows.agg(F.count(F.lit(1)).alias("rows_failed"))
        part = checked.crossJoin(failed).select(
            F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
            "rows_checked", "rows_failed", (F.col("rows_failed") == 0).alias("passed"),
            F.when(F.col("rows_failed") > 0, F.concat(F.col("rows_failed").cast("string"), F.lit(" failing rows")))
            .alias("notes"))
        out = part if out is None else out.unionByName(part)
    if stamp:
        run_id = run_id or uuid.uuid4().hex
        out = _stamped(out, run_id, "checked_at", at)
    return _appended(out, sink, run_id) if sink else out


def reconcile(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Source rows vs loaded rows per table."""
    out = None
    for name, src, tgt in pairs:
        part = (src.agg(F.count(F.lit(1)).alias("source_rows"))
                .crossJoin(tgt.agg(F.count(F.lit(1)).alias("target_rows")))
                .select(F.lit(name).alias("table_name"), "source_rows", "target_rows",
                        (F.col("source_rows") == F.col("target_rows")).alias("passed")))
        out = part if out is None else out.unionByName(part)
    return out


def orphan_counts(fact: DataFrame, fks: Sequence[tuple[str, str, DataFrame, str, bool]]) -> DataFrame:
    """Per foreign key, rows that do not resolve (nullable keys only when populated).

    ``fks``: (fk column, dim name, dim frame, dim key, nullable). Each key is
    first counted per distinct value (map-side partial aggregation), so the
    join to the dimension moves distinct keys, not fact rows.
    """
    out = None
    for fk, dim_name, dim, key, nullable in fks:
        per_key = fact.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
        if nullable:
            per_key = per_key.where(F.col("_fk").isNotNull())
        keys = dim.select(F.col(key).alias("_fk")).distinct()
        orphans = per_key.join(keys, "_fk", "left_anti")
        part = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_rows")).select(
            F.lit(fk).alias("fk_column"), F.lit(dim_name).alias("dim_name"), "orphan_rows",
            (F.col("orphan_rows") == 0).alias("passed"))
        out = part if out is None else out.unionByName(part)
    return out


def assert_zero(invariants: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """One row per invariant: rows where the predicate holds must be zero."""
    out = None
    for label, df, pred in invariants:
        part = df.agg(count_if(pred).alias("violations")).select(
            F.lit(label).alias("invariant"), "violations", (F.col("violations") == 0).alias("passed"))
        out = part if out is None else out.unionByName(part)
    return out


def range_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V12 beside its zero checks: per measure the smallest and largest value, missing and negative ones; one pass."""
    aggs, rows = [], []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"_{c}_low"), F.max(v).alias(f"_{c}_high"), F.count_if(v.isNull()).alias(f"_{c}_none"),
                 F.count_if(v < 0).alias(f"_{c}_below")]
        rows.append(F.struct(F.lit(c).alias("measure"), F.col(f"_{c}_low").alias("smallest"), F.col(f"_{c}_high").alias("largest"),
                             F.col(f"_{c}_none").alias("missing"), F.col(f"_{c}_below").alias("negative")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def fact_loss(raw: DataFrame, fact: DataFrame, label: str = "star join") -> DataFrame:
    """V12 extension: rows in vs rows out of a star join (loss or fan-out)."""
    return (raw.agg(F.count(F.lit(1)).alias("rows_in"))
            .crossJoin(fact.agg(F.count(F.lit(1)).alias("rows_out")))
            .select(F.lit(label).alias("invariant"), "rows_in", "rows_out",
                    (F.col("rows_in") == F.col("rows_out")).alias("passed")))


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: type, null count, distinct count, an example (the minimum), whether its values are unique.

    One scan, whatever the number of columns; the single row of results is
    turned into a row per column. With ``exact=False`` distinct counts are
    HyperLogLog sketches and numbers, dates and timestamps get their quartiles
    from a quantile sketch; both merge map-side in bounded memory. The exact
    form reads all its figures from (column, value) groups with their counts.
    """
    fields = df.schema.fields
    if exact:
        return _exact_profile(df)
    aggs, entries = [F.count(F.lit(1)).alias("_rows")], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"_null{i}"), F.min(c).cast("string").alias(f"_min{i}"),
                 F.approx_count_distinct(c).alias(f"_distinct{i}")]
        shown = [F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_null{i}").cast("long").alias("null_count"), F.col(f"_distinct{i}").cast("long").alias("distinct_count"),
                 F.col(f"_min{i}").alias("example"), (F.col(f"_distinct{i}") == F.col("_rows")).alias("is_unique")]
        measured = isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        if measured:
            aggs.append(F.percentile_approx(c, [0.25, 0.5, 0.75]).cast("array<string>").alias(f"_quart{i}"))
        shown.append((F.col(f"_quart{i}") if measured else F.lit(None).cast("array<string>")).alias("quartiles"))
        entries.append(F.struct(*shown))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def _exact_profile(df: DataFrame) -> DataFrame:
    """``profile`` from (column, value, rows) groups.

    The rows are dealt evenly over a fixed number of tasks first, however the
    table's files are cut, and become one narrow row per column that is
    grouped by hash: no task holds or sorts the values of the whole table, and
    a column of few values is counted where its rows lie. Grouping takes -0.0
    for 0.0, so the minimum of floating columns is kept beside the key.
    """
    fields = df.schema.fields
    plain = df.select(*[F.col(f"`{f.name}`").alias(f"_v{i}") for i, f in enumerate(fields)])
    cells = [F.struct(F.lit(i).alias("_column"), *[(F.col(f"_v{k}") if k == i else F.lit(None).cast(f.dataType)).alias(f"_v{k}")
                                                   for k, f in enumerate(fields)]) for i in range(len(fields))]
    floating = [i for i, f in enumerate(fields) if isinstance(f.dataType, T.FractionalType)]
    groups = (plain.repartition(default_partitions(df.sparkSession)).select(F.inline(F.array(*cells)))
              .groupBy("_column", *plain.columns)
              .agg(F.count(F.lit(1)).alias("_n"), *[F.min(f"_v{i}").alias(f"_low{i}") for i in floating]))
    aggs, entries = [], []
    for i, f in enumerate(fields):
        here, null = F.col("_column") == i, F.col(f"_v{i}").isNull()
        low = F.min(f"_low{i}" if i in floating else f"_v{i}")
        count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
        aggs += [count(here & null).alias(f"_null{i}"), count(here).alias(f"_rows{i}"),
                 low.cast("string").alias(f"_min{i}"), F.count_if(here & ~null).alias(f"_distinct{i}")]
        entries.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                                F.col(f"_null{i}").alias("null_count"), F.col(f"_distinct{i}").alias("distinct_count"),
                                F.col(f"_min{i}").alias("example"), (F.col(f"_distinct{i}") == F.col(f"_rows{i}")).alias("is_unique")))
    return groups.agg(*aggs).select(F.inline(F.array(*entries)))


def cross_check(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per key: MATCH / DIFFER / ONLY_A / ONLY_B with both values."""
    keys, cols = list(keys), list(cols)
    aa = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(True).alias("_ina"))
    bb = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("_inb"))
    j = aa.join(bb, keys, "full_outer")
    same = None
    for c in cols:
        t = F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        same = t if same is None else (same & t)
    status = (F.when(F.col("_inb").isNull(), "ONLY_A").when(F.col("_ina").isNull(), "ONLY_B")
              .when(same, "MATCH").otherwise("DIFFER"))
    return j.select(*keys, *[F.col(f"a_{c}") for c in cols], *[F.col(f"b_{c}") for c in cols],
                    status.alias("status"))
