"""Queries for change capture, incremental apply and streaming.

The events table plays the landing table; the events fact carries a
surrogate key, the event-type key (D2) and the measures. A second snapshot is
derived from the whole table: values changed where event_id % 7 = 0, rows
removed where event_id % 10 = 0, and new rows (the first free event_id +
event_id, so no key is used twice at any size) where event_id % 13 = 0, a few
with an event type the dimension does not know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.operators import cdc as I
from pitchline.operators.dimensions import distinct_dimension
from pitchline.operators.keys import append_keys, assign_keys
from pitchline.plans import contests as C
from pitchline.plans.registry import query
from pitchline.session import cut_lineage, scratch_path, written
from pitchline.sources.files import load_table
from pitchline.streaming import changes as ST

# Fixed parameters of the derived second snapshot.
UPDATE_MOD, DELETE_MOD, INSERT_MOD, UNKNOWN_MOD = 7, 10, 13, 39
KEYS = ["event_id"]
TRACKED = ["ts", "user_id", "event_type", "value"]
FACT_COLS = ["event_sk", "event_id", "ts", "user_id", "type_id", "value"]
BUSINESS = ["event_id", "ts", "user_id", "type_id", "value"]
CHANGE_SCHEMA = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, change_type string, "
                 "seq long")


def raw_events(spark, sf_dir) -> DataFrame:
    return C.table(spark, sf_dir, "events").select("event_id", *TRACKED)


def free_key(raw: DataFrame):
    """The first event_id above all given ones, as a scalar subquery column."""
    return raw.select(F.max("event_id") + 1).scalar()


def new_snapshot(raw: DataFrame) -> DataFrame:
    e = F.col("event_id")
    kept = raw.where(e % DELETE_MOD != 0).withColumn(
        "value", F.when(e % UPDATE_MOD == 0, F.col("value") + 1).otherwise(F.col("value")))
    added = raw.where(e % INSERT_MOD == 0).select(
        (e + free_key(raw)).alias("event_id"), "ts", "user_id",
        F.when(e % UNKNOWN_MOD == 0, F.lit("unknown")).otherwise(F.col("event_type")).alias("event_type"), "value")
    return kept.unionByName(added)


def type_dim(raw: DataFrame) -> DataFrame:
    """Event-type dimension, written as a table (real size statistics for the joins)."""
    spark = raw.sparkSession
    return load_table(distinct_dimension(raw, ["event_type"], "type_id"), scratch_path(spark, "dim_event_type"))


def build_events_fact(raw: DataFrame, types: DataFrame) -> DataFrame:
    f = raw.join(broadcast_if_small(types), "event_type")
    return assign_keys(f, ["ts", "event_id"], "event_sk").select(*FACT_COLS)


def apply_changes(fact: DataFrame, changes: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """I2 + I3 with rejects: the body of one incremental run over net changes."""
    updated = I.apply_updates(fact, changes, KEYS, ["value"])
    resolved, unresolved = I.resolve_inserts(changes, [(types, "event_type", "event_type", "type_id")])
    out = I.apply_inserts(updated, resolved, "event_sk", ["ts", "event_id"], KEYS)
    rejects = I.reject_changes(fact, changes, KEYS, unresolved)
    return out, rejects


def _setup(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    types = type_dim(raw)
    fact = build_events_fact(raw, types)
    changes = I.diff_snapshots(raw, new_snapshot(raw), KEYS, TRACKED)
    return raw, types, fact, changes


def _setup_written(spark, sf_dir):
    """The same for jobs that read fact and changes several times: both are computed once."""
    raw, types, fact, changes = _setup(spark, sf_dir)
    return raw, types, written(fact, "events-fact"), cut_lineage(changes)


NEW_SQL = f"""
new AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % {UPDATE_MOD} = 0 THEN value + 1 ELSE value END AS value
  FROM events WHERE event_id % {DELETE_MOD} <> 0
  UNION ALL
  SELECT event_id + (SELECT MAX(event_id) + 1 FROM events), ts, user_id,
         CASE WHEN event_id % {UNKNOWN_MOD} = 0 THEN 'unknown' ELSE event_type END, value
  FROM events WHERE event_id % {INSERT_MOD} = 0
),
types AS (SELECT event_type, CAST(ROW_NUMBER() OVER (ORDER BY event_type) AS BIGINT) AS type_id
          FROM (SELECT DISTINCT event_type FROM events) t),
fact AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY e.ts, e.event_id) AS BIGINT) AS event_sk, e.event_id, e.ts, e.user_id,
         t.type_id, e.value
  FROM events e JOIN types t ON t.event_type = e.event_type
),
changes AS (
  SELECT COALESCE(o.event_id, n.event_id) AS event_id,
         CASE WHEN n.event_id IS NULL THEN o.ts ELSE n.ts END AS ts,
         CASE WHEN n.event_id IS NULL THEN o.user_id ELSE n.user_id END AS user_id,
         CASE WHEN n.event_id IS NULL THEN o.event_type ELSE n.event_type END AS event_type,
         CASE WHEN n.event_id IS NULL THEN o.value ELSE n.value END AS value,
         CASE WHEN o.event_id IS NULL THEN 'INSERT' WHEN n.event_id IS NULL THEN 'DELETE'
              WHEN NOT (o.ts IS NOT DISTINCT FROM n.ts AND o.user_id IS NOT DISTINCT FROM n.user_id
                        AND o.event_type IS NOT DISTINCT FROM n.event_type AND o.value IS NOT DISTINCT FROM n.value)
              THEN 'UPDATE' END AS change_type
  FROM (SELECT event_id, ts, user_id, event_type, value FROM events) o
  FULL OUTER JOIN new n ON o.event_id = n.event_id
),
changed AS (SELECT * FROM changes WHERE change_type IS NOT NULL),
updated AS (
  SELECT f.event_sk, f.event_id, f.ts, f.user_id, f.type_id,
         CASE WHEN u.event_id IS NOT NULL THEN u.value ELSE f.value END AS value
  FROM fact f LEFT JOIN (SELECT * FROM changed WHERE change_type = 'UPDATE') u ON u.event_id = f.event_id
),
inserted AS (
  SELECT CAST((SELECT MAX(event_sk) FROM fact) + ROW_NUMBER() OVER (ORDER BY c.ts, c.event_id) AS BIGINT) AS event_sk,
         c.event_id, c.ts, c.user_id, t.type_id, c.value
  FROM changed c JOIN types t ON t.event_type = c.event_type WHERE c.change_type = 'INSERT'
),
applied AS (SELECT * FROM updated UNION ALL SELECT * FROM inserted)"""


@query("snapshot_diff", "WITH " + NEW_SQL +
       "\nSELECT event_id, ts, user_id, event_type, value, change_type FROM changed")
def snapshot_diff(spark, sf_dir):
    return _setup(spark, sf_dir)[3]


@query("apply_updates", "WITH " + NEW_SQL + "\nSELECT * FROM updated")
def q_apply_updates(spark, sf_dir):
    _, _, fact, changes = _setup(spark, sf_dir)
    return I.apply_updates(fact, changes, KEYS, ["value"])


@query("apply_inserts", "WITH " + NEW_SQL + "\nSELECT * FROM applied")
def q_apply_inserts(spark, sf_dir):
    _, types, fact, changes = _setup_written(spark, sf_dir)
    return apply_changes(fact, changes, types)[0]


@query("apply_rejects", "WITH " + NEW_SQL + """
SELECT event_id, change_type, 'delete not applied' AS reason FROM changed WHERE change_type = 'DELETE'
UNION ALL
SELECT c.event_id, c.change_type, 'update key not found' FROM changed c
WHERE c.change_type = 'UPDATE' AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.event_id = c.event_id)
UNION ALL
SELECT c.event_id, c.change_type, 'unknown event_type' FROM changed c
WHERE c.change_type = 'INSERT' AND NOT EXISTS (SELECT 1 FROM types t WHERE t.event_type = c.event_type)""")
def q_apply_rejects(spark, sf_dir):
    _, types, fact, changes = _setup_written(spark, sf_dir)
    return apply_changes(fact, changes, types)[1]


# net changes ---------------------------------------------------------------------------

def change_log(raw: DataFrame) -> DataFrame:
    """Several changes per key: two updates, insert then update, update then delete, insert then delete."""
    e = F.col("event_id")
    cols = ["ts", "user_id", "event_type"]

    def changes(where, kind, seq, key=e, value=F.col("value")):
        return raw.where(where).select(key.alias("event_id"), *cols, value.alias("value"),
                                       F.lit(kind).alias("change_type"), F.lit(seq).cast("long").alias("seq"))

    v, new = F.col("value"), e + free_key(raw)
    parts = [changes(e % 7 == 0, "UPDATE", 1, value=v + 1), changes(e % 14 == 0, "UPDATE", 2, value=v + 2),
             changes(e % 21 == 0, "DELETE", 3), changes(e % 13 == 0, "INSERT", 1, new),
             changes(e % 26 == 0, "UPDATE", 2, new, v + 3), changes(e % 39 == 0, "DELETE", 3, new)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


LOG_SQL = """
tops AS (SELECT MAX(event_id) + 1 AS top FROM events),
log AS (
  SELECT event_id, ts, user_id, event_type, value + 1 AS value, 'UPDATE' AS change_type, 1 AS seq FROM events WHERE event_id % 7 = 0
  UNION ALL SELECT event_id, ts, user_id, event_type, value + 2, 'UPDATE', 2 FROM events WHERE event_id % 14 = 0
  UNION ALL SELECT event_id, ts, user_id, event_type, value, 'DELETE', 3 FROM events WHERE event_id % 21 = 0
  UNION ALL SELECT event_id + top, ts, user_id, event_type, value, 'INSERT', 1 FROM events, tops WHERE event_id % 13 = 0
  UNION ALL SELECT event_id + top, ts, user_id, event_type, value + 3, 'UPDATE', 2 FROM events, tops WHERE event_id % 26 = 0
  UNION ALL SELECT event_id + top, ts, user_id, event_type, value, 'DELETE', 3 FROM events, tops WHERE event_id % 39 = 0
),
ordered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY seq DESC) AS back,
                   FIRST_VALUE(change_type) OVER (PARTITION BY event_id ORDER BY seq) AS opened FROM log),
net AS (SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN change_type = 'DELETE' THEN 'DELETE' WHEN opened = 'INSERT' THEN 'INSERT' ELSE 'UPDATE' END AS change_type
        FROM ordered WHERE back = 1 AND NOT (opened = 'INSERT' AND change_type = 'DELETE'))"""


@query("net_changes", "WITH " + LOG_SQL + "\nSELECT * FROM net")
def q_net_changes(spark, sf_dir):
    return I.net_changes(change_log(raw_events(spark, sf_dir)), KEYS, "seq")


@query("apply_net_updates", "WITH " + LOG_SQL + """
SELECT e.event_id, e.ts, e.user_id, e.event_type, CASE WHEN n.event_id IS NULL THEN e.value ELSE n.value END AS value
FROM events e LEFT JOIN (SELECT * FROM net WHERE change_type = 'UPDATE') n ON n.event_id = e.event_id""")
def q_apply_net_updates(spark, sf_dir):
    raw = raw_events(spark, sf_dir)
    return I.apply_updates(raw, change_log(raw), KEYS, ["value"], sequence="seq")


# I4-I6 -------------------------------------------------------------------------------

def _write_change_files(changes: DataFrame, path: str) -> None:
    """Two change files, one landed after the other (two micro-batches with one file a trigger)."""
    e = F.col("event_id")
    sequenced = changes.withColumn("seq", F.lit(1).cast("long"))
    sequenced.where(e % 2 == 0).coalesce(1).write.mode("append").parquet(path)
    sequenced.where(e % 2 == 1).coalesce(1).write.mode("append").parquet(path)


def _net(batch: DataFrame) -> DataFrame:
    return I.net_changes(batch, KEYS, "seq")


def _accept(types: DataFrame):
    """One micro-batch: updates of known keys, and inserts of new keys with their type and next ids."""
    def accept(state: DataFrame, net: DataFrame) -> tuple[DataFrame, DataFrame]:
        net = cut_lineage(net)
        resolved, unresolved = I.resolve_inserts(net, [(types, "event_type", "event_type", "type_id")])
        known = state.select(*KEYS).join(broadcast_if_small(net.select(*KEYS)), KEYS, "left_semi")
        fresh = append_keys(resolved.join(known, KEYS, "left_anti"), state, ["ts", "event_id"], "event_sk")
        blank = [F.lit(None).cast(state.schema[c].dataType).alias(c) for c in FACT_COLS if c not in ("event_id", "value")]
        fixed = net.where(F.col("change_type") == I.UPDATE).join(known, KEYS, "left_semi").select("event_id", "value", *blank, "change_type")
        accepted = fresh.select(*FACT_COLS, "change_type").unionByName(fixed)
        return accepted, I.reject_changes(known, net, KEYS, unresolved)
    return accept


def _stream(spark, sf_dir, drain: bool = False):
    _, types, fact, changes = _setup(spark, sf_dir)
    src, root, ckpt = (scratch_path(spark, n) for n in ("changes", "events-fact", "stream-ckpt"))
    _write_change_files(cut_lineage(changes), src)  # the diff runs once and in many tasks; only its rows go to one file
    ST.bootstrap(root, fact, KEYS)
    if drain:
        ST.drain_changes(spark, src, CHANGE_SCHEMA, ckpt)

    def run(checkpoint: str = ckpt) -> None:
        ST.consume_changes(spark, src, CHANGE_SCHEMA, checkpoint, root, _accept(types), KEYS, ["value"], _net, max_files_per_trigger=1)
    run()
    return root, run


def _state(spark, root) -> DataFrame:
    return ST.state(spark, root, KEYS, ["value"]).select(*BUSINESS)


@query("stream_apply", "WITH " + NEW_SQL + "\nSELECT event_id, ts, user_id, type_id, value FROM applied")
def stream_apply(spark, sf_dir):
    root, _ = _stream(spark, sf_dir)
    return _state(spark, root)


@query("stream_replay", "WITH " + NEW_SQL + "\nSELECT event_id, ts, user_id, type_id, value FROM applied")
def stream_replay(spark, sf_dir):
    """The stream loses its checkpoint after both batches, then once more after a fold: batches that come again change nothing."""
    root, run = _stream(spark, sf_dir)
    run(scratch_path(spark, "stream-ckpt"))
    ST.fold(spark, root, KEYS, ["value"])
    run(scratch_path(spark, "stream-ckpt"))  # and once more over the folded base
    return _state(spark, root)


@query("stream_counts", "WITH " + NEW_SQL + """
, c AS (SELECT CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS version, change_type,
               event_type IN (SELECT event_type FROM types) AS known FROM changed)
SELECT CAST(version AS BIGINT) AS version, COUNT(*) AS changes,
       CAST(SUM(CASE WHEN change_type = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS corrected,
       CAST(SUM(CASE WHEN change_type = 'INSERT' AND known THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN change_type = 'DELETE' OR (change_type = 'INSERT' AND NOT known) THEN 1 ELSE 0 END) AS BIGINT) AS rejected
FROM c GROUP BY version""")
def stream_counts(spark, sf_dir):
    root, _ = _stream(spark, sf_dir)
    return ST.counts(spark, root).select("version", "changes", "corrected", "inserted", "rejected")


@query("stream_drain", "WITH " + NEW_SQL + "\nSELECT event_id, ts, user_id, type_id, value FROM fact")
def stream_drain(spark, sf_dir):
    # same checkpoint: the drained backlog is not applied again
    root, _ = _stream(spark, sf_dir, drain=True)
    return _state(spark, root)


# I7-I9 ----------------------------------------------------------------------------------

def _text_sql(*values: str) -> str:
    """Length-prefixed fields of a row; the given doubles print alike in both engines."""
    return " || ".join(f"coalesce(length({v}) || ':' || {v}, '~')" for v in values)


_KEY_TEXT = "CAST(event_id AS VARCHAR)"
_ROW_TEXT = _text_sql(_KEY_TEXT, "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", "CAST(user_id AS VARCHAR)",
                      "CAST(type_id AS VARCHAR)", "CAST(value + 0.0 AS VARCHAR)")


def _hex_sql(digest: str, k: int) -> str:
    return f"CAST('0x' || substr({digest}, {15 * k + 1}, 15) AS HUGEINT)"


_SUMS = ", ".join(f"CAST(SUM({_hex_sql('d', k)}) AS DECIMAL(38,0)) AS h{k}" for k in range(4))
#: Digest tree of the registered case: 4 x 4 leaves.
TREE = {"fanout": 4, "depth": 2}


@query("content_hash", "WITH " + NEW_SQL + f"""
, d AS (SELECT sha256({_ROW_TEXT}) AS d FROM fact)
SELECT COUNT(*) AS rows, {_SUMS} FROM d""")
def q_content_hash(spark, sf_dir):
    _, _, fact, _ = _setup(spark, sf_dir)
    return I.content_hash(fact, BUSINESS)


_LEAF = f"CAST({_hex_sql(f'sha256({_text_sql(_KEY_TEXT)})', 0)} % 16 AS INTEGER)"


@query("digest_tree", "WITH " + NEW_SQL + f"""
, d AS (SELECT {_LEAF} AS leaf, sha256({_ROW_TEXT}) AS d FROM fact),
up AS (SELECT 0 AS level, 0 AS node, d FROM d UNION ALL SELECT 1, leaf // 4, d FROM d UNION ALL SELECT 2, leaf, d FROM d)
SELECT level, CAST(node AS INTEGER) AS node, COUNT(*) AS rows, {_SUMS} FROM up GROUP BY level, node""")
def q_digest_tree(spark, sf_dir):
    _, _, fact, _ = _setup(spark, sf_dir)
    return I.digest_tree(fact, KEYS, BUSINESS, **TREE)


@query("changed_rows", "WITH " + NEW_SQL + """
, one AS (SELECT event_id, ts, user_id, type_id, value FROM fact WHERE event_id = (SELECT MAX(event_id) FROM fact))
SELECT 'a' AS side, * FROM one UNION ALL SELECT 'b', event_id, ts, user_id, type_id, value + 0.001953125 FROM one""")
def q_changed_rows(spark, sf_dir):
    """One value of the fact is off by 1/512: the trees name its leaf, and only that leaf is read and compared."""
    _, _, fact, _ = _setup(spark, sf_dir)
    a, b = (scratch_path(spark, f"digested-{k}") for k in "ab")
    I.write_digested(fact, a, KEYS, BUSINESS, **TREE)
    fact = spark.read.parquet(f"{a}/rows").drop("_leaf")
    off = F.when(F.col("event_id") == fact.select(F.max("event_id")).scalar(), F.lit(0.001953125)).otherwise(F.lit(0.0))
    I.write_digested(fact.withColumn("value", F.col("value") + off), b, KEYS, BUSINESS, **TREE)
    return I.changed_rows(spark, a, b, BUSINESS, **TREE).select("side", *BUSINESS)


def _marker_row(raw: DataFrame) -> DataFrame:
    """A synthetic new event: a copy of the latest event under a fresh key."""
    top = raw.agg(F.max_by(F.struct(*raw.columns), F.struct("ts", "event_id")).alias("r"),
                  F.max("event_id").alias("mx"))
    return top.select((F.col("mx") + 1).alias("event_id"), "r.ts", "r.user_id", "r.event_type", "r.value")


@query("incremental_equals_rebuild", "WITH " + NEW_SQL + """
, sizes AS (SELECT (SELECT COUNT(*) FROM events) AS n, (SELECT COUNT(*) FROM applied) AS a,
                   (SELECT COUNT(*) FROM events WHERE event_id % 7 = 0) AS u)
SELECT 'new row' AS scenario, n + 1 AS rows_incremental, n + 1 AS rows_rebuild, TRUE AS equal, CAST(0 AS BIGINT) AS only_a,
       CAST(0 AS BIGINT) AS only_b FROM sizes
UNION ALL SELECT 'correction', n, n, TRUE, 0, 0 FROM sizes
UNION ALL SELECT 'rerun over the applied state', n, n, TRUE, 0, 0 FROM sizes
UNION ALL SELECT 'cleanup restores the baseline', n, n, TRUE, 0, 0 FROM sizes
UNION ALL SELECT 'snapshot', a, a, TRUE, 0, 0 FROM sizes
UNION ALL SELECT 'correction against the old rebuild', n, n, FALSE, u, u FROM sizes""")
def incremental_equals_rebuild(spark, sf_dir):
    """I8: incremental runs against rebuilds, and one comparison that must fail."""
    raw, types, fact, _ = _setup(spark, sf_dir)
    fact = load_table(fact, scratch_path(spark, "events-fact"))

    # every state is a table, as the next run reads it several times, and so is a rebuild that two checks read
    def run(state, old_raw, new_raw):
        changes = cut_lineage(I.diff_snapshots(old_raw, new_raw, KEYS, TRACKED))
        return written(apply_changes(state, changes, types)[0], "events-state")

    def rebuilt(new_raw):
        return written(build_events_fact(new_raw, types), "events-rebuilt")

    def same(label, incremental, rebuild):
        return I.assert_same(incremental, rebuild, BUSINESS, label, KEYS)

    with_new = raw.unionByName(_marker_row(raw))
    corrected = raw.withColumn("value", F.when(F.col("event_id") % UPDATE_MOD == 0, F.col("value") * 2 + 1)
                               .otherwise(F.col("value")))
    snap = new_snapshot(raw)
    # deletes and unknown types are rejected by the apply, so the rebuild side
    # uses the snapshot restricted the same way (kept rows + resolvable inserts)
    snap_applied = (raw.join(snap.select("event_id"), "event_id", "left_anti")
                    .unionByName(snap.join(types.select("event_type"), "event_type", "left_semi")))
    fixed = run(fact, raw, corrected)
    # cleanup: the corrections are taken back, and the synthetic row is deleted by its key
    grown = run(fact, raw, with_new)
    added = run(grown, raw, corrected)
    back = run(added, corrected, raw)
    cleaned = I.delete_where(back, F.col("event_id") >= free_key(raw))
    baseline, correct = rebuilt(raw), rebuilt(corrected)
    checks = [same("new row", grown, rebuilt(with_new)), same("correction", fixed, correct),
              same("rerun over the applied state", run(fixed, corrected, corrected), correct),
              same("cleanup restores the baseline", cleaned, baseline),
              same("snapshot", run(fact, raw, snap_applied), rebuilt(snap_applied)),
              same("correction against the old rebuild", fixed, baseline)]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


@query("clean_start", """
SELECT 'clean' AS state, CAST(0 AS BIGINT) AS pending_changes, CAST(0 AS BIGINT) AS marker_rows, TRUE AS clean
UNION ALL SELECT 'marker left', 0, 1, FALSE
UNION ALL SELECT 'changes pending', COUNT(*) FILTER (WHERE event_id % 7 = 0), 0, COUNT(*) FILTER (WHERE event_id % 7 = 0) = 0
FROM events""")
def clean_start(spark, sf_dir):
    """I9 on a clean start, with a synthetic row left over, and with corrections pending."""
    raw = raw_events(spark, sf_dir).withColumn("synthetic", F.lit(False))
    left = raw.unionByName(_marker_row(raw.drop("synthetic")).withColumn("synthetic", F.lit(True)))
    corrected = raw.withColumn("value", F.when(F.col("event_id") % UPDATE_MOD == 0, F.col("value") * 2 + 1)
                               .otherwise(F.col("value")))
    marker = F.col("synthetic")

    def state(label, new, table):
        return I.assert_clean(I.diff_snapshots(raw, new, KEYS, TRACKED), table, marker).select(
            F.lit(label).alias("state"), "*")

    return (state("clean", raw, raw).unionByName(state("marker left", raw, left))
            .unionByName(state("changes pending", corrected, raw)))


# I10, I11 --------------------------------------------------------------------------------

def _first_unmatched(spark, sf_dir) -> DataFrame:
    o = C.table(spark, sf_dir, "orders")
    l = C.table(spark, sf_dir, "lineitem")
    return I.first_without_match(o, l, ["o_orderkey"], ["l_orderkey"],
                                 [F.col("o_orderdate"), F.col("o_orderkey")], 1)


FIRST_SQL = """
first AS (SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
          ORDER BY o_orderdate, o_orderkey LIMIT 1)"""


@query("first_without_match", "WITH " + FIRST_SQL + "\nSELECT * FROM first")
def q_first_without_match(spark, sf_dir):
    return _first_unmatched(spark, sf_dir)


@query("point_mutations", "WITH " + FIRST_SQL + """
, ins AS (SELECT * FROM orders
          UNION ALL SELECT (SELECT MAX(o_orderkey) FROM orders) + 1, o_custkey, 'S', o_totalprice, o_orderdate,
                           o_orderpriority FROM first),
upd AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderkey IN (SELECT o_orderkey FROM first) THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
        FROM ins)
SELECT * FROM upd WHERE NOT (o_orderstatus = 'P')""")
def point_mutations(spark, sf_dir):
    o = C.table(spark, sf_dir, "orders")
    first = _first_unmatched(spark, sf_dir)
    new_row = first.crossJoin(o.agg(F.max("o_orderkey").alias("_mx"))).select(
        (F.col("_mx") + 1).alias("o_orderkey"), "o_custkey", F.lit("S").alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority")
    out = I.insert_rows(o, new_row)
    hit = out.join(first.select(F.col("o_orderkey").alias("_k")), F.col("o_orderkey") == F.col("_k"), "left")
    out = I.update_where(hit, F.col("_k").isNotNull(), {"o_orderpriority": F.lit("1-URGENT")}).drop("_k")
    return I.delete_where(out, F.col("o_orderstatus") == "P")
