"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>) over the distinct hashed
terms of a text. The pairwise part learns what additive weights miss, such as
an insult together with the mention of a group.

Training reads a bounded, documented sample of labelled rows
(``per_class`` of each label, the rows with the smallest hash of the id);
their hashed terms, not their texts, come to the driver. Scoring covers every
whole text in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import bounded_batches, crc32_fold, land, row_slices, text_or_empty

TERM = re.compile(r"[^\W_]+")


class Terms:
    """Distinct hashed terms of a text; hashes are kept in a bounded store."""

    def __init__(self, buckets: int, keep: int = 200_000):
        self.buckets, self.keep, self.known = buckets, keep, {}

    def of(self, text: str) -> np.ndarray:
        words = set(TERM.findall(text.lower()))
        known, out = self.known, []
        if len(known) > self.keep:
            known.clear()
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % self.buckets
            out.append(h)
        return np.unique(np.array(out, np.int32))


@dataclass
class FactorizationMachine:
    bias: float
    weight: np.ndarray  # (buckets,)
    factor: np.ndarray  # (buckets, k)

    def raw(self, terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid for rows of terms lying side by side, row r ending at ``ends[r]``."""
        sums = _row_sums(np.concatenate([self.weight[terms][:, None], self.factor[terms],
                                         (self.factor[terms] ** 2).sum(axis=1, keepdims=True)], axis=1), ends)
        return self.bias + sums[:, 0] + 0.5 * ((sums[:, 1:-1] ** 2).sum(axis=1) - sums[:, -1])

    def score(self, terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(terms, ends), -30, 30)))


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of runs of rows of ``values``; empty runs give zeros."""
    total = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)])
    return np.diff(total[np.concatenate([[0], ends])], axis=0)


def learnable(terms: np.ndarray, rows_of: np.ndarray, labels: np.ndarray, buckets: int, min_z: float,
              common_share: float, common_rows: int) -> np.ndarray:
    """Terms that may get a weight and factors.

    Those that tell by themselves (their share of rows differs between the
    classes by ``min_z`` standard errors), and those of at least
    ``common_share`` of all and ``common_rows`` rows: a term such as a group's
    name tells nothing alone, but there are rows enough to learn its pairs.
    """
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    c1 = np.bincount(terms, labels[rows_of], buckets)
    c0 = np.bincount(terms, 1 - labels[rows_of], buckets)
    share = (c1 + c0 + 1) / (len(labels) + 2)
    telling = np.abs(c1 / n1 - c0 / n0) >= min_z * np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return (telling & (c1 + c0 > 0)) | (c1 + c0 >= max(common_rows, common_share * len(labels)))


def fit(terms: np.ndarray, ends: np.ndarray, labels: np.ndarray, buckets: int, base_rate: float, k: int = 8,
        rounds: int = 60, step: float = 0.1, l2: float = 1.0, min_z: float = 4.0, common_share: float = 0.05,
        common_rows: int = 250, seed: int = 7) -> FactorizationMachine:
    """Full-batch Adam on the logistic loss, the classes weighted equally.

    Only ``learnable`` terms get weights and factors: the rare words of long
    texts, each with a little noise, would add up to false alarms. No rows, or
    rows of one class only, give a constant score: ``base_rate``, or 0.5
    without rows.
    """
    model = FactorizationMachine(0.0, np.zeros(buckets, np.float32), np.zeros((buckets, k), np.float32))
    rate = min(max(base_rate, 1e-4), 1 - 1e-4)
    if not len(labels) or labels.min() == labels.max():
        model.bias = float(np.log(rate / (1 - rate))) if len(labels) else 0.0
        return model
    row = np.repeat(np.arange(len(labels)), np.diff(np.concatenate([[0], ends])))
    keep = learnable(terms, row, labels, buckets, min_z, common_share, common_rows)
    used = np.flatnonzero(keep)
    place = np.where(keep, np.cumsum(keep) - 1, -1)[terms]
    row, col = row[place >= 0], place[place >= 0]
    n, m = len(labels), len(used)
    ends = np.cumsum(np.bincount(row, minlength=n))
    rng = np.random.default_rng(seed)
    p = [np.zeros(1), np.zeros(m), rng.normal(0, 0.02, (m, k))]
    first = [np.zeros_like(x) for x in p]
    second = [np.zeros_like(x) for x in p]
    balance = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    for t in range(1, rounds + 1):
        v = p[2][col]
        s = _row_sums(v, ends)
        z = (p[0][0] + np.bincount(row, p[1][col], n)
             + 0.5 * ((s ** 2).sum(axis=1) - np.bincount(row, (v ** 2).sum(axis=1), n)))
        g = balance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        per = g[row]
        dv = np.stack([np.bincount(col, per * (s[row, f] - v[:, f]), m) for f in range(k)], axis=1)
        grads = [np.array([g.sum()]), np.bincount(col, per, m) + l2 * p[1] / n, dv + l2 * p[2] / n]
        for x, d, a, b in zip(p, grads, first, second):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            x -= step * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    model.bias = float(p[0][0])
    model.weight[used], model.factor[used] = p[1], p[2]
    return model


def _hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """rows(label, text) -> (label, terms)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(buckets)
        for batch in row_slices(batches):
            lists = [terms.of(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))],
                                             ["label", "terms"])
    return bounded_batches(rows).mapInArrow(run, "label int, terms array<int>")


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", folds: int = 5, held_out: int = 0, per_class: int = 4000,
          buckets: int = 1 << 18, **options) -> FactorizationMachine:
    """Fit on at most ``per_class`` labelled rows of each class outside the held-out fold.

    Labels other than 0 and 1, NULL ids and repeated label rows are left out.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & (crc32_fold(F.col("id"), folds) != held_out))
             .distinct())
    seen = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not seen:
        return fit(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0), buckets, 0.5)
    pick = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)]
    sample = broadcast_if_small(land(pick[0].unionByName(pick[1]), "toxicity-sample"))  # 2 * per_class rows at most
    texts = (docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
             .join(sample, "id").select("label", "text"))
    rows = _hashed(texts, buckets).toArrow()
    lists = rows["terms"].combine_chunks()
    y = rows["label"].to_numpy()
    counts = np.array(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64) if len(y) else np.zeros(0, np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False) if len(y) else np.zeros(0, np.int32)
    # rows arrive in any order: sort, so that sums and the model do not depend on it
    order = _stable_order(flat, counts, y)
    starts = np.cumsum(counts) - counts
    flat = np.concatenate([flat[starts[r]:starts[r] + counts[r]] for r in order]) if len(y) else flat
    return fit(flat, np.cumsum(counts[order]), y[order].astype(float), buckets,
               seen.get(1, 0) / sum(seen.values()), **options)


def _stable_order(flat: np.ndarray, counts: np.ndarray, y: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    keys = [(int(label), flat[e - c:e].tobytes()) for label, e, c in zip(y, ends, counts)]
    return np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)


def score(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row; NULL texts count as empty and get the bias's score.

    Rows are independent: repeated rows and NULL ids pass through; other
    columns are ignored; an empty table gives an empty result.
    """
    buckets = len(model.weight)
    used = np.flatnonzero((model.weight != 0) | (model.factor != 0).any(axis=1)).astype(np.int32)
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, used, model.weight[used], model.factor[used]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, at, weight, factor = sent.value
        # terms without weight add nothing, so rows keep only the places of those that have some
        place = np.full(buckets, -1, np.int32)
        place[at] = np.arange(len(at))
        small = FactorizationMachine(bias, weight, factor)
        terms = Terms(buckets)
        for batch in row_slices(batches):
            lists = []
            for t in batch.column(1).to_pylist():
                p = place[terms.of(t)]
                lists.append(p[p >= 0])
            ends = np.cumsum(np.array([len(x) for x in lists], np.int64))
            flat = np.concatenate([np.zeros(0, np.int32), *lists])
            s = small.score(flat, ends) if lists else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return (bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
            .select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))
