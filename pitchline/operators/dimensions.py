"""Dimensional build (D1-D11) with deterministic surrogate keys (K1/K2).

Dimension frames are small relative to the fact; joins to them use
``broadcast_if_small`` (plan-size check, shuffle join beyond the bound).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.operators.keys import append_keys, assign_keys
from pitchline.operators.transform import normalize_values


def date_dimension(ranges: DataFrame, min_col: str = "min_date", max_col: str = "max_date",
                   key_col: str = "date_id") -> DataFrame:
    """Every day from min to max of each range, distinct across ranges, keyed in date order.

    No cap on the span; gap years between ranges stay absent.
    """
    days = (ranges.select(F.explode(F.sequence(F.to_date(min_col), F.to_date(max_col))).alias("full_date"))
            .distinct())
    # one row per calendar day of the covered span: bounded by the span, not the data
    keyed = assign_keys(days, ["full_date"], key_col, bounded=True)
    d = F.col("full_date")
    return keyed.select(key_col, "full_date", F.year(d).alias("year"), F.month(d).alias("month"),
                        F.dayofmonth(d).alias("day"), F.dayname(d).alias("day_of_week"))


def distinct_dimension(df: DataFrame, cols: Sequence[str], key_col: str) -> DataFrame:
    """DISTINCT values + surrogate key in value order."""
    cols = list(cols)
    return assign_keys(df.select(*cols).distinct(), cols, key_col).select(key_col, *cols)


def ordered_dimension(df: DataFrame, col: str, order: DataFrame, name_col: str, order_col: str,
                      date_col: str, key_col: str) -> DataFrame:
    """D3: categories that occur, with their fixed order and first/last date.

    ``order`` is the (name, order) list; the key is the order value.
    """
    return (df.join(broadcast_if_small(order), df[col] == order[name_col])
            .groupBy(order[order_col].alias(order_col), df[col].alias(name_col))
            .agg(F.min(F.to_date(date_col)).alias("date_window_start"),
                 F.max(F.to_date(date_col)).alias("date_window_end"))
            .select(F.col(order_col).cast("long").alias(key_col), name_col, order_col,
                    "date_window_start", "date_window_end"))


def canonical_dimension(df: DataFrame, cols: Sequence[str], mapping: dict[str, str],
                        map_col: str, key_col: str, null_attrs: dict[str, str] | None = None) -> DataFrame:
    """Canonicalise (T7), DISTINCT, key; unknown attributes start NULL."""
    cols = list(cols)
    canon = normalize_values(df.select(*cols), map_col, mapping).distinct()
    keyed = assign_keys(canon, cols, key_col)
    extra = [F.lit(None).cast(t).alias(n) for n, t in (null_attrs or {}).items()]
    return keyed.select(key_col, *cols, *extra)


def entity_dimension(role_sources: Sequence[tuple[DataFrame, str]], key_col: str, name_col: str,
                     crosswalks: Sequence[tuple[DataFrame, str, str]] = (),
                     group_dim: tuple[DataFrame, DataFrame, str, str, str] | None = None) -> DataFrame:
    """Set-union of role columns, then crosswalk attributes (first non-null wins).

    ``role_sources``: (frame, column) pairs whose values are entity names.
    ``crosswalks``: (frame, name column, attribute column) in priority order;
    the coalesced attribute is returned as ``attribute``.
    ``group_dim``: (membership frame, group dim, member col, group col, group key col).
    """
    names = None
    for frame, c in role_sources:
        part = frame.select(F.col(c).alias(name_col))
        names = part if names is None else names.union(part)
    ents = names.where(F.col(name_col).isNotNull()).distinct()
    attrs = []
    for i, (cw, ncol, acol) in enumerate(crosswalks):
        cwi = cw.select(F.col(ncol).alias(f"_n{i}"), F.col(acol).alias(f"_a{i}")).distinct()
        ents = ents.join(broadcast_if_small(cwi), F.col(name_col) == F.col(f"_n{i}"), "left").drop(f"_n{i}")
        attrs.append(F.col(f"_a{i}"))
    if attrs:
        ents = ents.withColumn("attribute", F.coalesce(*attrs)).drop(*[f"_a{i}" for i in range(len(attrs))])
    if group_dim is not None:
        members, gdim, mcol, gcol, gkey = group_dim
        m = members.select(F.col(mcol).alias("_m"), F.col(gcol).alias("_g"))
        ents = (ents.join(broadcast_if_small(m), F.col(name_col) == F.col("_m"), "left")
                .join(broadcast_if_small(gdim.select(F.col(gcol).alias("_g"), gkey)), "_g", "left")
                .drop("_m", "_g"))
    return assign_keys(ents, [name_col], key_col)


def cohort_dimension(matches: DataFrame, cohort_col: str = "cohort", roles: Sequence[str] = ("home_team_id", "away_team_id"),
                     key_col: str | None = "tournament_id") -> DataFrame:
    """Per cohort, distinct teams over both roles and a '<n>-team' label.

    ``key_col=None`` skips the surrogate key (marts only need the label), so
    the dimension stays in the same job as its consumer.
    """
    teams = matches.select(cohort_col, F.explode(F.array(*[F.col(r) for r in roles])).alias("_team"))
    sized = teams.groupBy(cohort_col).agg(F.count_distinct("_team").alias("team_count"))
    label = F.concat(F.col("team_count").cast("string"), F.lit("-team")).alias("format_label")
    if key_col is None:
        return sized.select(cohort_col, "team_count", label)
    keyed = assign_keys(sized, [cohort_col], key_col, bounded=True)  # one row per cohort (year)
    return keyed.select(key_col, cohort_col, "team_count", label)


def build_fact(raw: DataFrame, *, date_dim: DataFrame, team_dim: DataFrame, tournament_dim: DataFrame,
               order_cols: Sequence[str], stage_dim: DataFrame | None = None, venue_dim: DataFrame | None = None,
               venue_mapping: dict[str, str] | None = None, shootouts: DataFrame | None = None,
               shootout_keys: Sequence[str] = (), key_col: str = "match_id",
               existing: DataFrame | None = None) -> DataFrame:
    """D7 (and D8 with ``existing``): resolve natural names to surrogate keys.

    raw columns: match_date, home_team, away_team, home_score, away_score,
    tournament_year and optionally stage, venue_city, venue_country,
    neutral_site. Inner joins drop unresolvable rows exactly like the
    reference; ``fact_loss`` (V12) reports how many went missing.
    A left join to ``shootouts`` on ``shootout_keys`` gives went_to_so and
    the winner's key. With ``existing``, ids continue after its maximum.
    """
    f = raw.join(broadcast_if_small(date_dim.select("date_id", F.col("full_date").alias("match_date"))), "match_date")
    f = f.join(broadcast_if_small(tournament_dim.select("tournament_id", "tournament_year")), "tournament_year")
    teams = team_dim.select("team_id", "team_name")
    f = (f.join(broadcast_if_small(teams.select(F.col("team_id").alias("home_team_id"),
                                                  F.col("team_name").alias("home_team"))), "home_team")
         .join(broadcast_if_small(teams.select(F.col("team_id").alias("away_team_id"),
                                                 F.col("team_name").alias("away_team"))), "away_team"))
    if stage_dim is not None:
        f = f.join(broadcast_if_small(stage_dim.select("stage_id", F.col("stage_name").alias("stage"))), "stage")
    else:
        f = f.withColumn("stage_id", F.lit(None).cast("long"))
    if venue_dim is not None:
        f = normalize_values(f, "venue_city", venue_mapping or {})
        v = venue_dim.select("venue_id", F.col("city").alias("venue_city"), F.col("country").alias("venue_country"))
        f = f.join(broadcast_if_small(v), ["venue_city", "venue_country"])
    else:
        f = f.withColumn("venue_id", F.lit(None).cast("long"))
    neutral = F.col("neutral_site") if "neutral_site" in raw.columns else F.lit(None).cast("boolean")
    f = f.withColumn("neutral_site", neutral)
    # keys first: their splitters read the order columns beforehand, and the shootout join, which shuffles,
    # neither drops nor adds rows, so it runs once and after them
    if existing is None:
        f = assign_keys(f, list(order_cols), key_col)
    else:
        f = append_keys(f, existing, list(order_cols), key_col)
    if shootouts is not None:
        keys = list(shootout_keys)
        so = shootouts.select(*keys, F.lit(True).alias("_so"), F.col("winner").alias("_winner"))
        f = (f.join(so, keys, "left")
             .join(broadcast_if_small(teams.select(F.col("team_id").alias("so_winner_id"),
                                                     F.col("team_name").alias("_winner"))), "_winner", "left")
             .withColumn("went_to_so", F.col("_so").isNotNull()))
    else:
        f = f.withColumn("went_to_so", F.lit(False)).withColumn("so_winner_id", F.lit(None).cast("long"))
    return f.select(key_col, "tournament_id", "date_id", "stage_id", "venue_id", "home_team_id", "away_team_id",
                    F.col("home_score").cast("int"), F.col("away_score").cast("int"),
                    F.lit(None).cast("boolean").alias("went_to_et"), "went_to_so", "so_winner_id",
                    "neutral_site")


def _agreed(source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per source key: its values and whether all of its rows agree on them (NULL is a value)."""
    values = F.struct(*cols)
    return source.groupBy(*keys).agg(F.min(values).alias("_src"), (F.min(values) == F.max(values)).alias("_agreed"))


def backfill(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """UPDATE target SET cols FROM source on keys; idempotent, unmatched rows unchanged.

    Repeated source rows that agree are one update. A key whose source rows
    differ is not applied; ``backfill_conflicts`` reports it.
    """
    keys, cols = list(keys), list(cols)
    j = target.join(broadcast_if_small(_agreed(source, keys, cols).where("_agreed")), keys, "left")
    for c in cols:
        j = j.withColumn(c, F.when(F.col("_agreed"), F.col(f"_src.{c}")).otherwise(F.col(c)))
    return j.select(*target.columns)


def backfill_conflicts(source: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """D9 rejects: source keys whose rows disagree, with the reason."""
    return _agreed(source, list(keys), list(cols)).where("NOT _agreed").select(
        *keys, F.lit("source rows disagree").alias("reason"))


def snapshot_bridge(snap: DataFrame, team_dim: DataFrame, tournament_dim: DataFrame,
                    name_col: str = "team", year_col: str = "tournament_year") -> DataFrame:
    """(name, year, value, as-of) -> (team_id, tournament_id, value, as-of)."""
    t = broadcast_if_small(team_dim.select("team_id", F.col("team_name").alias(name_col)))
    y = broadcast_if_small(tournament_dim.select("tournament_id", F.col("tournament_year").alias(year_col)))
    return snap.join(t, name_col).join(y, year_col).select(
        "team_id", "tournament_id", "fifa_ranking", "ranking_as_of_date")


def natural_view(fact: DataFrame, date_dim: DataFrame, tournament_dim: DataFrame, team_dim: DataFrame,
                 stage_dim: DataFrame, venue_dim: DataFrame) -> DataFrame:
    """Fact back to names: 4 inner joins (date, tournament, 2 teams) + 3 left (stage, venue, winner)."""
    t = team_dim.select("team_id", "team_name")
    v = (fact.join(broadcast_if_small(date_dim.select("date_id", F.col("full_date").alias("match_date"))), "date_id")
         .join(broadcast_if_small(tournament_dim.select("tournament_id", "tournament_year")), "tournament_id")
         .join(broadcast_if_small(t.select(F.col("team_id").alias("home_team_id"), F.col("team_name").alias("home_team"))), "home_team_id")
         .join(broadcast_if_small(t.select(F.col("team_id").alias("away_team_id"), F.col("team_name").alias("away_team"))), "away_team_id")
         .join(broadcast_if_small(stage_dim.select("stage_id", F.col("stage_name").alias("stage"))), "stage_id", "left")
         .join(broadcast_if_small(venue_dim.select("venue_id", F.col("city").alias("venue_city"))), "venue_id", "left")
         .join(broadcast_if_small(t.select(F.col("team_id").alias("so_winner_id"), F.col("team_name").alias("so_winner"))), "so_winner_id", "left"))
    return v.select("tournament_year", "match_date", "home_team", "away_team", "home_score", "away_score",
                    "stage", "venue_city", "went_to_so", "so_winner")
