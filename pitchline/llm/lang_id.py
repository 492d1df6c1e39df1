"""Language ID by cross-parsing entropy over suffix automata.

Each language has the suffix automaton of a sample of its labelled text. A
text is cut into phrases, each the longest match that the automaton still
accepts; text of the automaton's own language has long matches and so few
phrases. A language's cost is phrases * log2(sample length) / text length,
the cross entropy in bits per byte; the smallest cost wins.

Only the samples are learnt: ``blocks`` blocks of ``block`` code points a
language at most, spread by a hash over all labelled text of the language.
Parsing runs in step over all stretches of a batch, for all languages at
once, by table look-ups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_batches, crc32_fold, row_slices

#: The answer for texts without a letter.
UNKNOWN = "und"
#: A phrase ends at the latest where a stretch of so many bytes ends (one phrase more in some 50).
STRETCH = 256


def spoken(text: Column) -> Column:
    """Letters in lower case, each run of others as one space, a space at both ends; '' without a letter."""
    words = F.trim(F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}]+", " "))
    return F.when(F.length(words) > 0, F.concat(F.lit(" "), words, F.lit(" "))).otherwise(F.lit(""))


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """States of the automaton that accepts the substrings of ``text``: byte -> state; the first one is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = twin
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
        last = new
    return moves


@dataclass(frozen=True)
class LanguageModel:
    """The automata of all languages in one table: row = state, column = symbol, -1 where no match goes on.

    ``symbols`` maps bytes to columns (0: in no sample); ``first`` holds, per
    language and symbol, the state after a phrase's first byte; ``bits`` is
    log2 of the sample lengths. The last row, ``dead``, continues nothing.
    """

    langs: tuple[str, ...]
    symbols: np.ndarray
    table: np.ndarray
    first: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, samples: dict[str, bytes]) -> LanguageModel:
        langs = tuple(sorted(samples))
        symbols = np.zeros(256, np.int32)
        seen = sorted(set(b"".join(samples.values())))
        symbols[seen] = np.arange(1, len(seen) + 1)
        automata = [suffix_automaton(samples[lang]) for lang in langs]
        dead = sum(map(len, automata))
        table = np.full((dead + 1, len(seen) + 1), -1, np.int32)
        first = np.full((len(langs), len(seen) + 1), dead, np.int32)
        base = 0
        for k, moves in enumerate(automata):
            for state, to in enumerate(moves):
                for c, after in to.items():
                    table[base + state, symbols[c]] = base + after
            start = table[base]
            first[k] = np.where(start >= 0, start, dead)
            base += len(moves)
        return cls(langs, symbols, table, first, np.log2([len(samples[lang]) + 1.0 for lang in langs]))

    def phrases(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases per (text, language) for texts lying side by side in ``data``, text r ending at ``ends[r]``."""
        starts = np.concatenate([[0], ends[:-1]])
        cuts = -(-(ends - starts) // STRETCH)
        row = np.repeat(np.arange(len(ends)), cuts)
        begin = starts[row] + STRETCH * (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        size = np.minimum(STRETCH, ends[row] - begin)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        symbol = self.symbols[data]
        flat, width = self.table.reshape(-1), self.table.shape[1]
        state = np.full((len(self.langs), len(row)), len(self.table) - 1, np.int64)  # dead: the first byte starts a phrase
        count = np.zeros((len(self.langs), len(row)), np.int32)
        for k in range(STRETCH):
            live = int(np.searchsorted(-size, -k, "left"))  # stretches longer than k
            if not live:
                break
            s = symbol[begin[:live] + k]
            to = flat[state[:, :live] * width + s]
            ended = to < 0
            count[:, :live] += ended
            state[:, :live] = np.where(ended, self.first[:, s], to)
        out = np.zeros((len(ends), len(self.langs)), np.int64)
        np.add.at(out, row[order], count.T)
        return out

    def judge(self, data: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, its phrases) per text. The score is 1 - best cost / second-best cost; 1 if only one
        language is known. Of equal costs the first language wins, with score 0."""
        sizes = np.diff(ends, prepend=0)
        counts = self.phrases(data, ends)
        cost = counts * self.bits
        best = np.argmin(cost, axis=1)
        at = np.arange(len(ends))
        low = cost[at, best]
        cost[at, best] = np.inf
        score = np.where(sizes > 0, 1 - low / np.maximum(cost.min(axis=1), 1e-300), 0.0)
        langs = [self.langs[b] if n else UNKNOWN for b, n in zip(best, sizes)]
        return langs, score, counts[at, best]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4,
          held_out: int = 2, block: int = 1000, blocks: int = 40) -> LanguageModel | None:
    """Sample the labelled texts outside the held-out fold and build the automata.

    NULL languages, texts without letters and ids of the held-out fold teach
    nothing; a NULL id counts as the empty text. Every block of every labelled
    text has the same chance; equal blocks count once. The driver receives
    ``blocks`` * ``block`` code points a language at most, and the table grows
    with the languages alone. None where there is nothing to learn from.
    """
    known = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(id_col).cast("string").alias("id"),
                         F.col(text_col).cast("string").alias("text"))
             .where(F.col("lang").isNotNull() & (F.length("text") > 0) & (crc32_fold(F.col("id"), folds) != held_out)))
    count = F.ceil(F.length("text") / block).cast("int")
    sizes = known.groupBy("lang").agg(F.sum(count).alias("n")).collect()  # a row per language
    if not sizes:
        return None
    # twice the wanted number passes the hash, so that equal blocks and chance leave enough
    share = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], min(1.0, 2.0 * blocks / r["n"]))])
    drawn = known.withColumn("limit", F.lit(2.0 ** 63) * (2 * share[F.col("lang")] - 1))
    at = F.filter(F.sequence(F.lit(0), count - 1), lambda b: F.xxhash64(F.col("id"), b) <= F.col("limit"))
    pieces = (drawn.select("lang", "id", "text", F.explode(at).alias("b"))
              .select("lang", F.xxhash64("id", "b").alias("h"), F.expr(f"substring(text, b * {block} + 1, {block})").alias("piece"))
              .select("lang", "h", spoken(F.col("piece")).alias("piece")).where("piece <> ''")
              .groupBy("lang", "piece").agg(F.min("h").alias("h")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    rows = pieces.withColumn("rank", rank).where(F.col("rank") <= blocks).orderBy("lang", "rank").collect()
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r["lang"], []).append(r["piece"])
    return LanguageModel.of({lang: "\n".join(p).encode("utf-8", "replace") for lang, p in samples.items()}) if samples else None


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, phrases) for every row, from its whole text alone.

    NULL texts and texts without a letter get ``und``, score 0 and no phrase,
    as every text does without a model. Repeated rows and NULL ids pass
    through; other columns are ignored, whatever their names; an empty table
    gives an empty result. A long text is parsed stretch by stretch, all of it.
    """
    rows = docs.select(F.col(id_col).alias("id"), spoken(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
                       .cast("binary").alias("said"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("long").alias("phrases"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 4 << 20):
            texts = batch.column(1).to_pylist()
            ends = np.cumsum(np.array([len(t) for t in texts], np.int64))
            langs, score, phrases = sent.value.judge(np.frombuffer(b"".join(texts), np.uint8), ends)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(phrases, pa.int64())], ["id", "lang_pred", "score", "phrases"])

    kind = rows.schema["id"].dataType.simpleString()
    return (bounded_batches(rows).mapInArrow(run, f"id {kind}, lang_pred string, score double, phrases long")
            .withColumnRenamed("id", id_col))
