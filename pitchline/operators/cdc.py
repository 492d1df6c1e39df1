"""Change data capture and incremental apply.

Changes are DataFrames of rows tagged INSERT / UPDATE / DELETE. Applying them
to a fact is a set of joins on the natural key, never row-by-row DML; rows
that cannot be applied (deletes, key-changing updates, unknown dimension
members) are routed to a reject frame instead of vanishing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.functions.columns import broadcast_if_small
from pitchline.operators.keys import append_keys
from pitchline.session import cut_lineage, default_partitions

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the ``prefix``-ed keys of ``right``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[prefix + k])
    return cond


def diff_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Net changes from ``old`` to ``new`` on ``keys`` (null-safe in keys and ``cols``).

    Output: keys, cols (new values; old values for a DELETE), change_type.
    Unchanged rows produce nothing. First only keys and a 120-bit digest of
    ``cols`` are shuffled, both sides in one aggregation; the columns then
    come from the snapshots for the changed keys alone, by a broadcast where
    those are few. NULL is a key like others. A key held by several rows of a
    snapshot is compared as a multiset; if it changed, all its old rows are
    DELETEs and all its new rows INSERTs.
    """
    keys, cols = list(keys), list(cols)

    def narrow(df: DataFrame, side: str) -> DataFrame:
        digest = F.md5(row_text(df, cols).cast("binary"))
        return df.select(*keys, F.lit(side).alias("_side"), *[_hex_number(digest, 15 * k + 1).alias(f"_d{k}") for k in range(2)])

    def of(side: str, c: Column | None = None) -> Column:
        return F.sum(F.when(F.col("_side") == side, F.lit(1) if c is None else c).otherwise(F.lit(0)))

    both = narrow(old, "old").unionByName(narrow(new, "new")).groupBy(*keys).agg(
        of("old").alias("_old"), of("new").alias("_new"),
        *[(of("old", F.col(f"_d{k}")) == of("new", F.col(f"_d{k}"))).alias(f"_e{k}") for k in range(2)])
    same = (F.col("_old") == F.col("_new")) & F.col("_e0") & F.col("_e1")
    single = (F.col("_old") <= 1) & (F.col("_new") <= 1)
    changed = cut_lineage(both.where(~same).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.when(F.col("_new") > 0, F.when((F.col("_old") == 0) | ~single, F.lit(INSERT)).otherwise(F.lit(UPDATE))).alias("_new_kind"),
        F.when((F.col("_old") > 0) & ((F.col("_new") == 0) | ~single), F.lit(DELETE)).alias("_old_kind")))

    def rows(df: DataFrame, kind: str) -> DataFrame:
        wanted = broadcast_if_small(changed.where(F.col(kind).isNotNull()))
        return df.join(wanted, _on(df, wanted, keys, "_k_")).select(*[df[c] for c in (*keys, *cols)], F.col(kind).alias("change_type"))
    return rows(new, "_new_kind").unionByName(rows(old, "_old_kind"))


def net_changes(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """At most one change per key: the net effect of its changes in ``sequence`` order.

    The last change gives the values; a key that was inserted within the set
    stays an INSERT (updates of it are folded in) and disappears if the set
    also deletes it; a key that existed before is an UPDATE, also when it was
    deleted and inserted again. Changes of one key with equal sequence numbers
    follow each other as INSERT, UPDATE, DELETE, then in order of their
    values, so the result never depends on the order of rows. Aggregation
    only: no key's changes are held in one task beyond its first and last. The
    output has no sequence column.
    """
    keys = list(keys)
    rest = [c for c in changes.columns if c not in (*keys, "change_type", sequence)]
    life = F.when(F.col("change_type") == INSERT, 0).when(F.col("change_type") == UPDATE, 1).otherwise(2)
    order = F.struct(F.col(sequence).alias("_at"), life.alias("_life"), F.struct(F.lit(0).alias("_none"), *rest).alias("_values"))
    g = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*rest, "change_type"), order).alias("_last"),
        F.min_by("change_type", order).alias("_first"))
    new = F.col("_first") == INSERT
    gone = F.col("_last.change_type") == DELETE
    kind = F.when(gone, F.lit(DELETE)).when(new, F.lit(INSERT)).otherwise(F.lit(UPDATE))
    return (g.where(~(new & gone))
            .select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest], kind.alias("change_type")))


def apply_updates(fact: DataFrame, changes: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                  sequence: str | None = None) -> DataFrame:
    """Overwrite ``update_cols`` of fact rows whose key has an UPDATE change.

    With ``sequence`` the changes are first reduced to their net effect; a
    change set without it must hold one change per key. A small set is
    broadcast, so the fact is not shuffled for it.
    """
    keys, update_cols = list(keys), list(update_cols)
    if sequence:
        changes = net_changes(changes, keys, sequence)
    u = (changes.where(F.col("change_type") == UPDATE)
         .select(*keys, *[F.col(c).alias(f"_u_{c}") for c in update_cols], F.lit(True).alias("_hit")))
    out = fact.join(broadcast_if_small(u), keys, "left")
    for c in update_cols:
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)))
    return out.select(*fact.columns)


def resolve_inserts(changes: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """Resolve INSERT rows' natural attributes to surrogate keys.

    ``lookups``: (dim, natural column in change, dim natural column, dim key).
    Returns (resolved rows, unresolved rows with a reason).
    """
    ins = changes.where(F.col("change_type") == INSERT)
    flags = []
    for i, (dim, ncol, dcol, dkey) in enumerate(lookups):
        d = broadcast_if_small(dim.select(F.col(dcol).alias(f"_d{i}"), F.col(dkey).alias(dkey)))
        ins = ins.join(d, ins[ncol] == F.col(f"_d{i}"), "left").drop(f"_d{i}")
        flags.append((ncol, F.col(dkey).isNull()))
    miss = None
    reason = None
    for ncol, f in flags:
        miss = f if miss is None else (miss | f)
        r = F.when(f, F.lit(f"unknown {ncol}"))
        reason = r if reason is None else F.coalesce(reason, r)
    if miss is None:
        return ins, ins.limit(0).withColumn("reason", F.lit(None).cast("string"))
    return ins.where(~miss), ins.where(miss).withColumn("reason", reason)


def apply_inserts(fact: DataFrame, resolved: DataFrame, key_col: str, order_cols: Sequence[str],
                  keys: Sequence[str] | None = None, numbered: DataFrame | None = None) -> DataFrame:
    """Append resolved INSERT rows with ids continuing after max(fact.key).

    ``numbered`` is the frame whose ids are continued if ``fact`` is only a
    part of it.

    With ``keys`` an INSERT whose natural key the fact already has is not
    appended (``reject_changes`` reports it), so a replayed set adds nothing.
    """
    if keys:
        resolved = resolved.join(fact.select(*keys), list(keys), "left_anti")
    new = append_keys(resolved, fact if numbered is None else numbered, list(order_cols), key_col)
    return fact.unionByName(new.select(*fact.columns))


def reject_changes(fact: DataFrame, changes: DataFrame, keys: Sequence[str], unresolved: DataFrame) -> DataFrame:
    """Changes the apply cannot take: deletes, updates whose key is not in the fact, inserts whose
    key is already there or whose dimension members are unknown. One row each: keys, change_type, reason."""
    keys = list(keys)
    deletes = changes.where(F.col("change_type") == DELETE).select(
        *keys, "change_type", F.lit("delete not applied").alias("reason"))
    upd = changes.where(F.col("change_type") == UPDATE)
    lost = upd.join(fact.select(*keys), keys, "left_anti").select(
        *keys, "change_type", F.lit("update key not found").alias("reason"))
    again = changes.where(F.col("change_type") == INSERT).join(fact.select(*keys), keys, "left_semi").select(
        *keys, "change_type", F.lit("insert key already there").alias("reason"))
    unk = unresolved.join(again.select(*keys), keys, "left_anti").select(*keys, "change_type", "reason")
    return deletes.unionByName(lost).unionByName(again).unionByName(unk)


def canonical_text(c: Column, kind: T.DataType) -> Column:
    """A text that differs for values that differ; NULL for NULL.

    Timestamps have microseconds, doubles their shortest digits that give the
    value back (both zeros are one value, as they are to a comparison), bytes
    are hexadecimal, and nested values are made of the fields of ``field_text``.
    """
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(c, lambda e: field_text(e, kind.elementType)), "")
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.concat(*[field_text(c[f.name], f.dataType) for f in kind.fields]))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: field_text(e, entry))), "")
    return c.cast("string")


def field_text(c: Column, kind: T.DataType) -> Column:
    """Length and text of a value, ``~`` for NULL: fields side by side can be read in one way only."""
    text = canonical_text(c, kind)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_text(df: DataFrame, cols: Sequence[str]) -> Column:
    """One text per row, different for rows that differ in ``cols``."""
    return F.concat(F.lit(""), *[field_text(df[c], df.schema[c].dataType) for c in cols])


def _hex_number(digest: Column, start: int) -> Column:
    """The 15 hexadecimal digits (60 bits) from ``start``."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")


#: Columns of a fingerprint: the row count and four sums of 60 bits of the rows' SHA-256.
FINGERPRINT = ("rows", "h0", "h1", "h2", "h3")


def _fingerprint(digest: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(_hex_number(F.col(digest), 15 * k + 1)), F.lit(0)).cast("decimal(38,0)")
                                               .alias(f"h{k}") for k in range(4)]]


def content_hash(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Order-insensitive, duplicate-aware content fingerprint: one row.

    Every row's ``row_text`` goes through SHA-256; the fingerprint is the row
    count and the sums of the four 60-bit quarters of the leading 240 bits.
    Any engine with SHA-256 computes the same; no sort and no collect.
    """
    return df.select(F.sha2(row_text(df, cols), 256).alias("_d")).agg(*_fingerprint("_d"))


# Digest tree ---------------------------------------------------------------------------

def leaf_of(df: DataFrame, keys: Sequence[str], leaves: int) -> Column:
    """The leaf (0 to ``leaves`` - 1) of a row, from the SHA-256 of its keys' text."""
    return (_hex_number(F.sha2(row_text(df, keys), 256), 1) % leaves).cast("int")


def digest_tree(df: DataFrame, keys: Sequence[str], cols: Sequence[str], fanout: int = 16, depth: int = 2) -> DataFrame:
    """I7 as a tree: (level, node, rows, h0..h3) for level 0 (one node: the table) to ``depth`` (fanout^depth leaves).

    A row belongs to the leaf of its keys; node n of a level holds the nodes
    n * fanout to n * fanout + fanout - 1 of the next. The rows are read once
    and aggregated to leaves; the levels above are sums of leaf rows. Empty
    nodes have no row.
    """
    leaves = df.select(leaf_of(df, keys, fanout ** depth).alias("node"), F.sha2(row_text(df, cols), 256).alias("_d")).groupBy(
        "node").agg(*_fingerprint("_d"))
    up = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), F.floor(F.col("node") / fanout ** (depth - level)).cast("int").alias("at"))
                             for level in range(depth + 1)]))
    return (leaves.select(up.alias("_up"), *FINGERPRINT).groupBy(F.col("_up.level").alias("level"), F.col("_up.at").alias("node"))
            .agg(*[F.sum(c).cast("long" if c == "rows" else "decimal(38,0)").alias(c) for c in FINGERPRINT]))


def differing_leaves(a: DataFrame, b: DataFrame, fanout: int = 16, depth: int = 2) -> list[int]:
    """Leaves whose digests differ between two trees, found from the root down: only children of differing nodes are read."""
    nodes = [0]
    for level in range(depth + 1):
        x, y = (t.where((F.col("level") == level) & F.col("node").isin(nodes)) for t in (a, b))
        y = y.select(F.col("node").alias("_node"), *[F.col(c).alias(f"_{c}") for c in FINGERPRINT])
        same = F.lit(True)
        for c in FINGERPRINT:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        off = x.join(y, F.col("node") == F.col("_node"), "full_outer").where(~same).select(F.coalesce("node", "_node").alias("n"))
        nodes = sorted(r["n"] for r in off.collect())  # fanout^level at most
        if not nodes or level == depth:
            return nodes
        nodes = [n * fanout + k for n in nodes for k in range(fanout)]
    return nodes


def write_digested(df: DataFrame, path: str, keys: Sequence[str], cols: Sequence[str], fanout: int = 16, depth: int = 2) -> None:
    """Write ``df`` laid out by leaf (``path``/rows) with its digest tree beside it (``path``/tree)."""
    spark, leaves = df.sparkSession, fanout ** depth
    placed = df.withColumn("_leaf", leaf_of(df, keys, leaves))
    placed.repartition(min(leaves, default_partitions(spark)), "_leaf").write.partitionBy("_leaf").parquet(f"{path}/rows")
    digest_tree(df, keys, cols, fanout, depth).coalesce(1).write.parquet(f"{path}/tree")


def _leaf_rows(spark: SparkSession, path: str, leaves: Sequence[int]) -> DataFrame:
    """Rows of the given leaves of a digested table; only their folders are read."""
    return spark.read.parquet(f"{path}/rows").where(F.col("_leaf").isin(list(leaves))).drop("_leaf")


def changed_rows(spark: SparkSession, a: str, b: str, cols: Sequence[str], fanout: int = 16, depth: int = 2) -> DataFrame:
    """Rows of ``cols`` in one of two digested tables and not the other (side 'a' or 'b'), as multisets.

    The trees name the differing leaves; equal ones are never read.
    """
    leaves = differing_leaves(*(spark.read.parquet(f"{p}/tree") for p in (a, b)), fanout, depth)
    x, y = (_leaf_rows(spark, p, leaves).select(*cols) for p in (a, b))
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))


def assert_same(a: DataFrame, b: DataFrame, cols: Sequence[str], label: str, keys: Sequence[str] | None = None,
                fanout: int = 16, depth: int = 2) -> DataFrame:
    """I8: one row: are ``a`` and ``b`` equal as multisets of ``cols``?

    Digest trees decide, each from one pass over its table. Only rows of
    differing leaves are then compared and counted. ``keys`` name the leaf of
    a row (all of ``cols`` if absent).
    """
    cols = list(cols)
    keys = list(keys or cols)
    leaves = fanout ** depth
    ta, tb = (cut_lineage(digest_tree(t, keys, cols, fanout, depth)) for t in (a, b))
    off = differing_leaves(ta, tb, fanout, depth)
    rows = [t.where("level = 0").agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long")).first()[0] for t in (ta, tb)]
    head = [F.lit(label).alias("scenario"), F.lit(rows[0]).cast("long").alias("rows_incremental"),
            F.lit(rows[1]).cast("long").alias("rows_rebuild"), F.lit(not off).alias("equal")]
    if not off:
        return a.sparkSession.range(1).select(*head, F.lit(0).cast("long").alias("only_a"), F.lit(0).cast("long").alias("only_b"))
    both = None
    for t, sign in ((a, 1), (b, -1)):
        part = t.where(leaf_of(t, keys, leaves).isin(off)).select(row_text(t, cols).alias("_text"), F.lit(sign).alias("_sign"))
        both = part if both is None else both.unionByName(part)
    left = both.groupBy("_text").agg(F.sum("_sign").alias("_n"))
    count = lambda n: F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).cast("long")
    return left.agg(count(F.col("_n")).alias("only_a"), count(-F.col("_n")).alias("only_b")).select(*head, "only_a", "only_b")


def assert_clean(pending: DataFrame, raw: DataFrame, marker: Column) -> DataFrame:
    """One status row: no pending changes and no synthetic marker rows left."""
    p = pending.agg(F.count(F.lit(1)).alias("pending_changes"))
    m = raw.agg(F.count_if(marker).cast("long").alias("marker_rows"))
    return p.crossJoin(m).withColumn(
        "clean", (F.col("pending_changes") == 0) & (F.col("marker_rows") == 0))


def first_without_match(df: DataFrame, other: DataFrame, keys: Sequence[str], other_keys: Sequence[str],
                        order: Sequence[str | Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows (in ``order``) with no counterpart in ``other`` (top-k)."""
    cond = None
    for a, b in zip(keys, other_keys):
        t = df[a] == other[b]
        cond = t if cond is None else (cond & t)
    return df.join(other, cond, "left_anti").orderBy(*order).limit(k)


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows (by name)."""
    return df.unionByName(rows.select(*df.columns))


def update_where(df: DataFrame, cond: Column, assignments: dict[str, Column]) -> DataFrame:
    """Keyed update."""
    out = df
    for c, v in assignments.items():
        out = out.withColumn(c, F.when(cond, v).otherwise(F.col(c)))
    return out


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Keyed delete (NULL condition keeps the row, like SQL DELETE)."""
    return df.where(~F.coalesce(cond, F.lit(False)))
