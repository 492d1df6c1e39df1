"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Trusted positives are labelled good documents, the unlabelled side is the
corpus as it is. With class prior p and logistic loss l, training minimises

    p * E_P[l(f)] + max(0, E_U[l(-f)] - p * E_P[l(-f)])

(the non-negative unbiased risk); the bias then moves to the cut with the least
unbiased error. For the prior, plain positive-versus-unlabelled models rank
texts, and p is the smallest ratio of the unlabelled to the positive share
above any threshold, with a confidence margin on both shares. Labels of bad
documents are not used.

f is additive over quantile bins of text statistics (character classes,
repetition, lengths). Weights are fitted on two bounded samples (``sample``
rows each, the smallest hashes of the id), of which only statistics come to
the driver, one row an id. Prior and cut are taken from all documents: their
bin numbers are written once (a byte a statistic), and a histogram of scores
on a fixed grid, combined map-side, comes to the driver. Scoring covers every
whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import bounded_batches, crc32_fold, land, row_slices, text_or_empty

#: Byte classes of the character statistics.
_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:'\"?()-", b"!",
            b"#*$%&|<>@^~=+_\\/{}[]`", bytes(range(0x80, 0x100)), bytes(range(0x00, 0x09)) + bytes(range(0x0E, 0x20)))
_MEMBER = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES):
    _MEMBER[list(_bytes), _k] = 1
N_FEATURES = len(_CLASSES) + 9


def statistics(text: str) -> np.ndarray:
    """Numbers that describe the form of one text; an empty text gives zeros."""
    out = np.zeros(N_FEATURES)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    if not words:
        return out
    n, k = len(words), len(_CLASSES)
    out[:k] = np.bincount(data, minlength=256) @ _MEMBER / len(data)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split("\n") if x]
    distinct = len(set(words))
    out[k:] = (np.log1p(n), lengths.mean(), lengths.std(), (lengths <= 3).mean(), distinct / n,
               np.log1p(distinct) / np.log1p(n), sum(map(eq, words, words[1:])) / n,
               1 - len(set(lines)) / len(lines), np.log1p(len(data) / len(lines)))
    return out


@dataclass
class AdditiveModel:
    edges: np.ndarray   # (features, bins - 1)
    weight: np.ndarray  # (features, bins)
    bias: float
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.bias + sum(self.weight[j][np.searchsorted(self.edges[j], x[:, j], "right")]
                               for j in range(x.shape[1]))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(pos: np.ndarray, unl: np.ndarray, shape: tuple[int, int], gradient, rounds: int, step: float,
             l2: float) -> tuple[np.ndarray, float]:
    """Adam on bin weights; ``gradient(f(P), f(U))`` gives dRisk/df for both samples."""
    both = np.concatenate([pos, unl])
    flat = both + np.arange(shape[0]) * shape[1]
    w, bias, m, v = np.zeros(shape[0] * shape[1]), 0.0, np.zeros(shape[0] * shape[1] + 1), np.zeros(shape[0] * shape[1] + 1)
    for t in range(1, rounds + 1):
        f = w[flat].sum(axis=1) + bias
        d = np.concatenate(gradient(f[:len(pos)], f[len(pos):]))
        g = np.append(np.bincount(flat.ravel(), np.repeat(d, shape[0]), len(w)) + l2 * w, d.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        change = step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w, bias = w - change[:-1], bias - change[-1]
    return w.reshape(shape), float(bias)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, confidence: float = 0.5) -> float:
    """Smallest U(score >= t) / P(score >= t), each share moved by its DKW margin against a too small value.

    Both samples are counts per cell of one score grid.
    """
    (p, u), sizes = _shares_above(pos, unl)
    margin = [np.sqrt(np.log(2 / confidence) / (2 * size)) for size in sizes]
    bound = np.where(pos > 0, (u + margin[1]) / np.maximum(p - margin[0], 1e-9), np.inf)
    best = int(np.argmin(bound))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.02, 0.98))


def best_cut(pos: np.ndarray, unl: np.ndarray, prior: float, slack: float = 0.3) -> int:
    """The grid cell with the least unbiased error: p * P(below) + U(above) - p * P(above).

    It lies where the densities cross, so it hardly moves with the prior. Of
    cells whose error is within the noise of the positive sample (``slack`` /
    sqrt of its size) of the least, the lowest is taken: in doubt a document
    stays.
    """
    (p, u), sizes = _shares_above(pos, unl)
    error = np.where(pos + unl > 0, u - 2 * prior * p, np.inf)
    return int(np.flatnonzero(error <= error.min() + slack / np.sqrt(sizes[0]))[0])


def _shares_above(*counts: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """(share of each sample in a cell or above it, sizes of the samples)."""
    return [np.cumsum(c[::-1])[::-1] / c.sum() for c in counts], [int(c.sum()) for c in counts]


#: Scores before the sigmoid are counted in this many cells an integer step, from -GRID_END to GRID_END.
GRID_STEPS, GRID_END = 64, 32
#: Random halvings of the documents; each text is ranked by models of the other half.
SPLITS = 5


def to_grid(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + GRID_END) * GRID_STEPS), 0, 2 * GRID_END * GRID_STEPS - 1).astype(np.int64)


def place(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin number of every statistic."""
    return np.stack([np.searchsorted(edges[j], x[:, j], "right") for j in range(len(edges))], axis=1).astype(np.uint8)


def score_counts(placed: np.ndarray, split: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(splits, cells): how many rows fall into each cell of the score grid.

    ``weights[s, h]`` scores the rows whose bit s of ``split`` is h.
    """
    k = np.arange(placed.shape[1])
    out = np.zeros((len(weights), 2 * GRID_END * GRID_STEPS), np.int64)
    for s, by_half in enumerate(weights):
        half = (split >> s) & 1
        for h in (0, 1):
            raw = by_half[h][k, placed[half == h]].sum(axis=1)
            out[s] += np.bincount(to_grid(raw), minlength=out.shape[1])
    return out


def fit(pos: np.ndarray, unl: np.ndarray, split_pos: np.ndarray | None = None, split_unl: np.ndarray | None = None,
        count_all: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, bins: int = 12, rounds: int = 400,
        step: float = 0.05, l2: float = 1e-3, prior: float | None = None) -> AdditiveModel:
    """Weights from the samples ``pos`` and ``unl``, prior and cut from ``count_all(edges, weights)``.

    ``count_all`` gives ``score_counts`` of all documents (default: of
    ``unl``); ``split_*`` are the halvings of the rows as bits (default:
    drawn). Fewer than two positives or unlabelled rows give the constant
    score 0.5.
    """
    k = N_FEATURES
    if len(pos) < 2 or len(unl) < 2:
        return AdditiveModel(np.zeros((k, bins - 1)), np.zeros((k, bins)), 0.0, 0.5)
    edges = np.quantile(np.concatenate([pos, unl]), np.linspace(0, 1, bins + 1)[1:-1], axis=0).T
    p, u = place(pos, edges), place(unl, edges)
    n, m = len(p), len(u)
    drawn = np.random.default_rng(0).integers(0, 1 << SPLITS, n + m)
    split_pos = drawn[:n] if split_pos is None else split_pos
    split_unl = drawn[n:] if split_unl is None else split_unl
    if count_all is None:
        def count_all(_, weights):
            return score_counts(u, split_unl, weights)

    def plain(fp, fu):
        return -_sigmoid(-fp) / len(fp), _sigmoid(fu) / len(fu)

    def with_bias(w, b):  # each row takes one weight of the first statistic
        return np.concatenate([w[:1] + b, w[1:]])

    if prior is None:  # every text is ranked by a model that has not seen it, for several splits
        crossed = np.zeros((SPLITS, 2, k, bins))
        for s in range(SPLITS):
            for half in (0, 1):
                in_p, in_u = (split_pos >> s) & 1 != half, (split_unl >> s) & 1 != half
                crossed[s, half] = with_bias(*_descend(p[in_p], u[in_u], (k, bins), plain, rounds, step, l2))
        prior = float(np.median([estimate_prior(*both) for both in zip(
            score_counts(p, split_pos, crossed), count_all(edges, crossed))]))

    def non_negative(fp, fu):
        loss = lambda z: np.logaddexp(0, -z)
        negative = loss(-fu).mean() - prior * loss(-fp).mean()
        on_p, on_u = -prior * _sigmoid(-fp) / n, np.zeros(m)
        sign = 1.0 if negative >= 0 else -1.0  # a negative estimate is pushed back up instead of followed down
        if sign < 0:
            on_p = np.zeros(n)
        return on_p - sign * prior * _sigmoid(fp) / n, on_u + sign * _sigmoid(fu) / m

    w, b = _descend(p, u, (k, bins), non_negative, rounds, step, l2)
    final = np.broadcast_to(with_bias(w, b), (1, 2, k, bins))
    cut = best_cut(score_counts(p, split_pos, final)[0], count_all(edges, final)[0], prior)
    return AdditiveModel(edges, w, b - (cut / GRID_STEPS - GRID_END), prior)


def _described(rows: DataFrame) -> DataFrame:
    """rows(id, trusted, unlabelled, split, text) -> the same with the statistics of the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            x = [statistics(t) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(x, pa.list_(pa.float64()))],
                                             ["id", "trusted", "unlabelled", "split", "x"])
    return bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, trusted boolean, "
                                                 "unlabelled boolean, split int, x array<double>")


def _placed(rows: DataFrame, edges: np.ndarray) -> DataFrame:
    """rows(split, text) -> (split, bin numbers of the text's statistics, a byte each)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in place(x, edges)], pa.binary())],
                                             ["split", "placed"])
    return bounded_batches(rows).mapInArrow(run, "split int, placed binary")


def _count_scores(placed: DataFrame, weights: np.ndarray) -> np.ndarray:
    """``score_counts`` of a table (split, placed): at most one row a split and cell comes to the driver."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), 2 * GRID_END * GRID_STEPS), np.int64)
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, N_FEATURES)
            total += score_counts(bins, batch.column(0).to_numpy(), weights)
        s, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(cell, pa.int64()), pa.array(total[s, cell])],
                                         ["s", "cell", "n"])
    out = np.zeros((len(weights), 2 * GRID_END * GRID_STEPS), np.int64)
    for r in placed.mapInArrow(run, "s long, cell long, n long").groupBy("s", "cell").agg(F.sum("n").alias("n")).collect():
        out[r.s, r.cell] = r.n
    return out


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", folds: int = 3, held_out: int = 1, sample: int = 6000, **options) -> AdditiveModel:
    """Weights from at most ``sample`` trusted positives outside the held-out fold and ``sample`` corpus texts;
    class prior and cut from all rows of ``docs``.

    Labels other than 1, NULL ids and repeated label rows are left out of the
    samples, and of rows that share an id one stands for it there. NULL texts
    count as empty. An empty table gives the constant score 0.5.
    """
    trusted = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
               .where((F.col("label") == 1) & F.col("id").isNotNull() & (crc32_fold(F.col("id"), folds) != held_out))
               .select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
               .select("id", F.lit(True).alias("trusted"), F.lit(False).alias("unlabelled")))
    corpus = (docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL")
              .orderBy(F.xxhash64(F.col("id"), F.lit("corpus")), "id").limit(sample)
              .select("id", F.lit(False).alias("trusted"), F.lit(True).alias("unlabelled")))
    chosen = (trusted.unionByName(corpus).groupBy("id")
              .agg(F.bool_or("trusted").alias("trusted"), F.bool_or("unlabelled").alias("unlabelled")))
    chosen = broadcast_if_small(land(chosen, "quality-sample"))  # 2 * sample rows at most
    split = (F.xxhash64(F.col("id"), F.lit("split")).bitwiseAND((1 << SPLITS) - 1)).cast("int").alias("split")
    every = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = every.join(chosen, "id").select("id", "trusted", "unlabelled", split, "text")
    # repeated ids: one row each, so that 2 * sample rows at most come to the driver
    rows = (_described(texts).groupBy("id").agg(F.min(F.struct("x", "trusted", "unlabelled", "split")).alias("r"))
            .select("r.*").toArrow())
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, N_FEATURES)
    order = np.lexsort([rows["split"].to_numpy(), *x.T])  # rows arrive in any order
    x, split_of = x[order], rows["split"].to_numpy()[order]
    trusted_rows, other_rows = (np.array(rows[c].to_pylist(), bool)[order] for c in ("trusted", "unlabelled"))
    tables: list[DataFrame] = []

    def count_all(edges: np.ndarray, weights: np.ndarray) -> np.ndarray:
        if not tables:
            tables.append(land(_placed(every.select(split, "text"), edges), "quality-bins"))
        return _count_scores(tables[0], weights)

    return fit(x[trusted_rows], x[other_rows], split_of[trusted_rows], split_of[other_rows], count_all, **options)


def score_column(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> Column:
    """The model's score of every whole text, as a column of ``docs``."""
    sent = bounded_batches(docs).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(-1, N_FEATURES)
        return pd.Series(sent.value.score(x))

    return of(text_or_empty(text_col))


def score(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row.

    NULL texts count as empty; empty texts get the score of their (zero)
    statistics. Rows are independent: repeated rows and NULL ids pass
    through; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return (rows.select("id", score_column(rows, model).alias("score"))
            .select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: AdditiveModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model accepts, with their columns unchanged, whatever their names.

    NULL texts count as empty; each row is judged by itself, so repeated rows
    and ties go or stay together; texts of any length are read whole; an
    empty table gives an empty result.
    """
    return docs.where(score_column(docs, model, text_col) >= 0.5)
