"""Mixing sources to target weights: iterative proportional fitting, in DataFrame functions only.

Documents are first added up by cell (source, language, topic), so everything
that iterates works on cells and not on documents. Each round rakes the cells'
token weights to the source, then the language, then the topic marginal:
one map-side combined sum per marginal and a join with its targets. A round is
a written table; rounds end when every marginal lies within ``tolerance``.
Marginals that conflict (a source that is the only one of its language, with
another share there) cannot all be met: rounds then end when the weights have
settled, and a warning names the gap that remains in each marginal.

A cell's ratio is its raked weight over its tokens. Documents are kept with
probability ratio / largest ratio (times ``keep_share`` of what that yields),
so the expected tokens of the sample have exactly the target marginals, and a
hash of the id decides, so a rerun keeps the same documents.
"""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import BLANKS, land, text_or_empty

DIMENSIONS = ("source", "lang", "topic")
#: Default targets: token shares to these powers. Sources and languages are evened out a little, topics stay as they
#: are, so that most documents can stay: the sample holds about the smallest over the largest lift of all tokens.
POWERS = {"source": 0.9, "lang": 0.9, "topic": 1.0}
#: Raking has settled if a round's factors differ from those of the round before by this part of the gap at most.
SETTLED = 1e-3
#: Notices that make a text a licence or a legal page.
NOTICES = ("Licensed under", "All rights reserved", "Terms of use", "Terms of service")


def topic_of(text: Column, n_tokens: Column) -> Column:
    """Coarse content type of a text, the default topic."""
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    notice = F.lit(False)
    for words in NOTICES:
        notice = notice | text.contains(words)
    return (F.when(n_tokens == 0, "empty")
            .when(bars * 10 > n_tokens, "table")
            .when(notice, "notice")
            .when(n_tokens < 100, "short")
            .when(n_tokens >= 1000, "long")
            .otherwise("article"))


def count_tokens(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def described(docs: DataFrame, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
              topic: Column | None = None) -> DataFrame:
    """``docs`` plus the struct ``__mix``(source, lang, topic, n_tokens); NULL dimensions become ''."""
    text = text_or_empty(text_col)
    tokens = F.col("__tokens")  # a column of its own, so it is counted once and not in every branch that asks for it
    kind = topic if topic is not None else topic_of(text, tokens)
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return (docs.withColumn("__tokens", count_tokens(text))
            .withColumn("__mix", F.struct(named(F.col(source_col)).alias("source"), named(F.col(lang_col)).alias("lang"),
                                          named(kind).alias("topic"), tokens.alias("n_tokens")))
            .drop("__tokens"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(dimension, share): token shares to the ``power``, normalised. Below 1 this lifts small groups."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("t"))
    total = sums.agg(F.sum(F.pow(F.col("t").cast("double"), F.lit(power)))).first()[0] or 1.0
    return sums.select(dimension, (F.pow(F.col("t").cast("double"), F.lit(power)) / total).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = 1e-5,
         max_rounds: int | None = 100) -> DataFrame:
    """``cells`` plus ``weight``: tokens raked until each marginal has its target share.

    Target values without cells are left out and the others share their part.
    Raises if the marginals cannot be met within ``max_rounds``. With None
    there is no such bound: marginals that conflict end with the weights that
    further rounds no longer change, and a warning with the remaining gaps.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    total = now.agg(F.sum("weight")).first()[0] or 0.0
    goals = {}
    for d in targets:
        there = targets[d].join(now.select(d).distinct(), d)
        share = there.agg(F.sum("share")).first()[0] or 1.0
        goals[d] = land(there.select(d, (F.col("share") * (total / share)).alias("goal")), "mix-targets")
    now = now.select("*", *[F.lit(1.0).alias(f"f_{d}") for d in goals])
    for n in itertools.count(1):
        now = now.withColumn("last", F.col("weight")).withColumnsRenamed({f"f_{d}": f"last_{d}" for d in goals})
        off = change = F.lit(0.0)
        for d, goal in goals.items():
            factor = (now.groupBy(d).agg(F.sum("weight").alias("have")).join(goal, d)
                      .select(d, F.when(F.col("have") > 0, F.col("goal") / F.col("have")).otherwise(1.0).alias(f"f_{d}")))
            now = now.join(factor, d).withColumn("weight", F.col("weight") * F.col(f"f_{d}"))
            off = F.greatest(off, F.abs(F.col(f"f_{d}") - 1))
            change = F.greatest(change, F.abs(F.col(f"f_{d}") - F.col(f"last_{d}")))
        measured = [F.max(off), F.max(change), F.sum(F.abs(F.col("weight") - F.col("last")))]
        now = land(now, "mix-weights")
        gap, changed, moved = (x or 0.0 for x in now.agg(*measured).first())
        now = now.drop("last", *[f"last_{d}" for d in goals])
        if gap <= tolerance:
            break
        if max_rounds is None and changed <= SETTLED * gap and moved <= tolerance * total:
            left = remaining_gaps(now, goals)
            warnings.warn("the target marginals conflict; the remaining relative gaps are "
                          + ", ".join(f"{d} {x:.3g}" for d, x in left.items()), stacklevel=2)
            break
        if n == max_rounds:
            raise ValueError(f"raking did not reach the target marginals in {max_rounds} rounds (gap {gap:g})")
    return now.drop(*[f"f_{d}" for d in goals])


def remaining_gaps(weights: DataFrame, goals: Mapping[str, DataFrame]) -> dict[str, float]:
    """The largest relative distance of each marginal of ``weights`` from its ``goal`` column."""
    far = F.when(F.col("goal") > 0, F.abs(F.col("have") / F.col("goal") - 1)).otherwise(F.lit(0.0))
    return {d: weights.groupBy(d).agg(F.sum("weight").alias("have")).join(goal, d).agg(F.max(far)).first()[0] or 0.0
            for d, goal in goals.items()}


def decided(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            lang_col: str = "lang", topic: Column | None = None,
            targets: Mapping[str, Mapping[str, float]] | None = None,
            powers: Mapping[str, float] = POWERS, keep_share: float = 1.0, seed: int = 8, tolerance: float = 1e-5) -> DataFrame:
    """``docs`` plus the struct ``__mix`` (source, lang, topic, n_tokens, ratio, probability, kept).

    ``targets`` maps a dimension to {value: share}; a dimension without one
    gets its own token shares to the power in ``powers``. Targets that conflict
    are met as far as raking settles, with a warning. Values missing in a given
    target are not wanted: their documents get probability 0. Documents
    without tokens carry no weight and take the probability of their cell, 1
    where the cell has no tokens at all. NULL source or language is the value
    ''. Repeated rows and rows of one id share a decision; an empty table
    gives an empty result.
    """
    spark, rows = docs.sparkSession, described(docs, text_col, source_col, lang_col, topic)
    cells = land(rows.groupBy(*[F.col(f"__mix.{d}").alias(d) for d in DIMENSIONS])
                 .agg(F.sum("__mix.n_tokens").alias("tokens")), "mix-cells")
    given = targets or {}
    shares = {d: (spark.createDataFrame([(k, float(v)) for k, v in given[d].items()], f"{d} string, share double")
                  if d in given else tempered(cells, d, powers[d])) for d in DIMENSIONS}
    wanted = cells.where("tokens > 0")
    for d in given:
        wanted = wanted.join(shares[d].where("share > 0").select(d), d, "left_semi")
    raked = rake(wanted, shares, tolerance, max_rounds=None).withColumn("ratio", F.col("weight") / F.col("tokens"))
    largest = raked.agg(F.max("ratio")).first()[0] or 1.0
    empty = cells.where("tokens = 0").select(*DIMENSIONS, F.lit(largest).alias("ratio"))
    plan = land(raked.select(*DIMENSIONS, "ratio").unionByName(empty), "mix-plan").select(
        *[F.col(d).alias(f"__{d}") for d in DIMENSIONS], F.col("ratio").alias("__ratio"))
    same = [F.col(f"__mix.{d}") == F.col(f"__{d}") for d in DIMENSIONS]
    # 53 leading bits of the hash as a number in [0, 1)
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11).cast("double") / float(1 << 53)
    p = F.coalesce(F.col("__ratio"), F.lit(0.0)) * (keep_share / largest)
    return (rows.join(broadcast_if_small(plan), same, "left")
            .withColumn("__mix", F.col("__mix").withField("ratio", F.col("__ratio")).withField("probability", p)
                        .withField("kept", draw < p))
            .drop("__ratio", *[f"__{d}" for d in DIMENSIONS]))


def mix(docs: DataFrame, id_col: str = "doc_id", **params) -> DataFrame:
    """(id, source, lang, topic, n_tokens, ratio, probability, kept) of every row; see ``decided``."""
    return decided(docs, id_col, **params).select(id_col, "__mix.*")


def sample(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps, with their columns unchanged; see ``decided``."""
    return decided(docs, **params).where("__mix.kept").drop("__mix")
