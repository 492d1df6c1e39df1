"""Spelling variant grouping: words one edit apart, found by asymmetric q-chunks.

Of two words the shorter one contributes two disjoint chunks, its halves; the
longer one contributes its positional grams of those lengths. One inserted,
deleted or replaced letter leaves one of the two chunks whole, at its place or
moved by one, so a join of chunks with grams at shift 0 or 1 finds every pair;
only grams at those places are emitted, as no others can meet a chunk.

A common half ("under", "tion") is a hot group. The same edit also leaves
whole the other half but for one of its ``PARTS`` parts, so that rest joins
the key. It only removes pairs that the check would refuse, and bounds a group
by the spellings of one part instead of those of half a word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_batches, land, row_slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = re.compile("[A-Z]+")
#: Parts into which the half that holds the edit is cut.
PARTS = 4


def runs(doc_id: str, text: str, every: int, shortest: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text: runs of letters, A-Z lower-cased, a letter lost where the crc32 says so."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(UPPER.sub(lambda m: m[0].lower(), text))).items():
        h = zlib.crc32(run.encode(), seed)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= shortest:
            yield run, n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31, shortest: int = 7,
               min_count: int = 2) -> DataFrame:
    """(word, n) of words of ``shortest`` code points and ``min_count`` occurrences or more.

    NULL texts have no words; a NULL id counts as the empty text.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            seen: Counter[str] = Counter()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in runs(doc_id, text, every, shortest):
                    seen[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             ["word", "n"])

    return (bounded_batches(rows).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def piece(word: Column, begin: Column, end: Column | None = None) -> Column:
    """Code points ``begin`` (from 0) to before ``end``."""
    return F.substring(word, begin + 1, F.lit(2147483647) if end is None else end - begin)


def cuts(size: Column) -> list[tuple[int, Column, Column, Column]]:
    """(side, middle, begin, end) of the parts in which an edit of a word of ``size`` letters can lie.

    Side 0: the first half is the whole chunk and the edit is in the second; side 1 the other way round.
    """
    middle = F.floor(size / 2).cast("int")
    out = []
    for side, low, length in ((1, F.lit(0), middle), (0, middle, size - middle)):
        for k in range(PARTS):
            out.append((side, middle, low + F.floor(length * k / PARTS).cast("int"),
                        low + F.floor(length * (k + 1) / PARTS).cast("int")))
    return out


def chunk_rows(words: DataFrame) -> DataFrame:
    """Each word's two disjoint chunks, once per part of the other half."""
    w, size = F.col("word"), F.col("size")
    rows = []
    for number, (side, middle, begin, end) in enumerate(cuts(size)):
        rest = F.concat(piece(w, middle, begin), F.lit(" "), piece(w, end)) if side == 0 else \
            F.concat(piece(w, F.lit(0), begin), F.lit(" "), piece(w, end, middle))
        chunk = piece(w, F.lit(0), middle) if side == 0 else piece(w, middle)
        rows.append(F.struct(size.alias("size"), F.lit(number).alias("part"), chunk.alias("chunk"), rest.alias("rest"),
                             begin.alias("begin"), end.alias("end")))
    return words.withColumn("size", F.length("word")).select("word", "n", F.inline(F.array(*rows))).where("begin < end")


def gram_rows(words: DataFrame) -> DataFrame:
    """Each word's positional grams that can meet a chunk of a word as long (shift 0) or one letter shorter (shift 1)."""
    w = F.col("word")
    rows = []
    for shift in (0, 1):
        size = F.col("length") - shift
        for number, (side, middle, begin, end) in enumerate(cuts(size)):
            rest = F.concat(piece(w, middle, begin), F.lit(" "), piece(w, end + shift)) if side == 0 else \
                F.concat(piece(w, F.lit(0), begin), F.lit(" "), piece(w, end + shift, middle + shift))
            gram = piece(w, F.lit(0), middle) if side == 0 else piece(w, middle + shift)
            rows.append(F.struct(size.alias("size"), F.lit(number).alias("part"), gram.alias("chunk"), rest.alias("rest"),
                                 F.lit(shift).alias("shift"), begin.alias("begin"), end.alias("end")))
    return words.withColumn("length", F.length("word")).select("word", "n", F.inline(F.array(*rows))).where("begin < end")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of distinct words exactly one edit apart, once, the shorter as ``word``
    (of equal lengths the smaller). ``words`` holds distinct (word, n).

    The join is asked to sort and merge: the planner sizes both sides by the
    words, of which they are a multiple, and would broadcast one.
    """
    a = chunk_rows(words).alias("a")
    b = gram_rows(words).hint("merge").alias("b")
    s, t, begin, shift = F.col("a.word"), F.col("b.word"), F.col("a.begin"), F.col("b.shift")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("size", "part", "chunk", "rest")]
    # an insertion at a part's end fits two parts: only the first counts, where all from ``begin`` on does not agree yet
    first = (begin == 0) | (piece(s, begin) != piece(t, begin + shift))
    checked = ((shift == 1) | (s < t)) & first & (F.levenshtein(s, t, 1) == 1)
    return a.join(b, [*on, checked]).select(s.alias("word"), F.col("a.n").alias("n"), t.alias("other"), F.col("b.n").alias("other_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last of each word's chain of forms.

    A chain doubles its reach in every round and a form is ``ratio`` times as
    frequent as its word, so a few rounds end it. Each round is a written table.
    """
    reach = land(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = reach.join(onward, "root", "left")
        if step.where(F.col("further").isNotNull()).isEmpty():
            return reach
        reach = land(step.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31, shortest: int = 7,
             min_count: int = 2, ratio: int = 10) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest n (of equals the smallest) if that is
    at least ``ratio`` times the word's n. Every repeated row and text counts;
    NULL texts have no words; very long runs are words like others; other
    columns are ignored, whatever their names; an empty table gives an empty
    result.
    """
    words = land(vocabulary(docs, id_col, text_col, every, shortest, min_count), "spelling-words")
    pairs = near_pairs(words)
    sides = F.array(F.struct("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
                    F.struct(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = (pairs.select(F.inline(sides)).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top")))
    enough = (-F.col("top.less")).cast("decimal(38,0)") >= F.col("n").cast("decimal(19,0)") * ratio
    judged = land(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("top.near")).alias("form"), F.when(enough, -F.col("top.less")).alias("form_n")), "spelling-forms")
    last = roots(judged.where(F.col("form").isNotNull()).select("word", "form"))
    return judged.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
