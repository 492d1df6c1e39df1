"""Quality rules by distribution divergence, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated three-word
windows. The verdict of the method compares two histograms of a document with
those of its language, both by Jensen-Shannon distance (base 2, so 0 to 1):

* character classes (letters, capitals, digits, blanks, symbols, the rest);
* common words: the words that make up at least ``min_share`` of the
  language's words, and one bin for all others.

References are counted over all documents of a language. A language has at
most ``1 / min_share`` common words, which bounds its reference row. A
document is judged only with enough words and against a reference of enough
words, and short documents get the slack that sampling noise needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import BLANKS, land, text_or_empty

#: The symbols of the contract. Fixed values.
SYMBOLS = r"[#*$%&|<>]+"
_BLANK_CHARS = " \t\n\x0b\f\r"
CLASSES = ("letters", "capitals", "digits", "blanks", "symbols", "others")
#: Common words are looked up by length; those of this many code points or more share the last list.
LONGEST_LIST = 16


def _words(text: str) -> Column:
    trimmed = F.btrim(F.col(text), F.lit(_BLANK_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def _classes(text: str) -> list[Column]:
    """Code points of each class; what is left after the letters is short, so later passes are cheap."""
    t, rest = F.col(text), F.col("__rest")
    letters = F.length(t) - F.length(rest)
    capitals = F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))
    gone = lambda pattern: F.length(rest) - F.length(F.regexp_replace(rest, pattern, ""))
    digits, blanks, symbols = gone(r"\p{Nd}+"), gone(BLANKS), gone(SYMBOLS)
    return [(letters - capitals).alias("letters"), capitals.alias("capitals"), digits.alias("digits"),
            blanks.alias("blanks"), symbols.alias("symbols"),
            (F.length(rest) - digits - blanks - symbols).alias("others")]


def _with_classes(rows: DataFrame) -> DataFrame:
    bare = rows.withColumn("__rest", F.regexp_replace("text", r"\p{L}+", ""))
    return bare.select(*rows.columns, F.struct(*_classes("text")).alias("classes"))


def language_references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                        min_share: float = 0.002) -> DataFrame:
    """(lang, class_share, word_share, known, n_words): one row per language, counted over all of its documents.

    ``known[n - 1]`` lists the common words of n code points, the last one also all longer ones. Words of every
    length are counted; a language without common words keeps its classes and has one bin of words, the others.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       text_or_empty(text_col).alias("text"))
    totals = (_with_classes(rows).select("lang", "classes.*")
              .groupBy("lang").agg(*[F.sum(c).alias(c) for c in CLASSES]))
    all_chars = sum(F.col(c) for c in CLASSES)
    classes = totals.select("lang", F.array(*[F.col(c) / F.greatest(all_chars, F.lit(1)) for c in CLASSES])
                            .alias("class_share"))
    spoken = (rows.select("lang", F.explode(_words("text")).alias("w"))
              .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    spoken = land(spoken, "language-words")
    sizes = land(spoken.groupBy("lang").agg(F.sum("n").alias("n_words")), "language-sizes")
    common = (spoken.join(broadcast_if_small(sizes), "lang").where(F.col("n") >= min_share * F.col("n_words"))
              .groupBy("lang")
              .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("w", F.col("n") / F.col("n_words")))))
                   .alias("word_share")))
    none = F.create_map().cast("map<string,double>")
    words = sizes.join(common, "lang", "left").withColumn("word_share", F.coalesce("word_share", none))
    by_length = F.transform(F.sequence(F.lit(1), F.lit(LONGEST_LIST)), lambda n: F.filter(
        F.map_keys("word_share"), lambda w: F.least(F.length(w), F.lit(LONGEST_LIST)) == n))
    return classes.join(words.withColumn("known", by_length), "lang")


def _js_terms(p: Column, q: Column) -> Column:
    """What one bin of shares p and q adds to the Jensen-Shannon divergence (bits)."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m) / 2).otherwise(0.0)
    return part(p) + part(q)


def _sum(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


#: Repeated windows. One long per window, the leading bits of its hash and then its position, is sorted, which brings
#: equal windows together; windows that meet an equal hash are compared again as strings, so the count is exact.
_SORTED = """
    CASE WHEN n_words < 4 THEN CAST(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, n_words - 3),
        i -> (xxhash64(words[i], words[i + 1], words[i + 2]) & shiftleft(-1L, bits)) | i)) END"""
_MEETS = """
    zip_with(slice(sorted, 1, greatest(size(sorted) - 1, 0)), slice(sorted, 2, greatest(size(sorted) - 1, 0)),
             (a, b) -> shiftrightunsigned(a ^ b, bits) = 0)"""
_NEAR = """
    CASE WHEN array_contains(meets, true) THEN
        transform(filter(sequence(0, size(meets)), k -> get(meets, k - 1) OR get(meets, k)),
                  k -> CAST(sorted[k] & ~shiftleft(-1L, bits) AS INT))
    ELSE CAST(array() AS array<int>) END"""
_EXACT = """
    array_sort(transform(near, i -> struct(concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS g, i AS i)))"""
_COVERED = """
    size(array_distinct(flatten(transform(
        filter(exact, (x, k) -> (k > 0 AND x.g = exact[k - 1].g) OR (k < size(exact) - 1 AND x.g = exact[k + 1].g)),
        x -> array(x.i, x.i + 1, x.i + 2)))))"""


def measures(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) plus words, the base counts, classes and ``n_chars``."""
    out = _with_classes(rows).withColumn("words", _words("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK_CHARS)) != "")
    out = (out.withColumn("n_words", F.size("words"))
           .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
           .withColumn("lines", lines)
           .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
           .drop("lines"))
    return (out.withColumn("bits", F.length(F.bin(F.col("n_words").cast("long"))))
            .withColumn("sorted", F.expr(_SORTED)).withColumn("meets", F.expr(_MEETS))
            .withColumn("near", F.expr(_NEAR)).drop("sorted", "meets", "bits")
            .withColumn("exact", F.expr(_EXACT)).drop("near")
            .withColumn("n_repeat_words", F.expr(_COVERED).cast("long")).drop("exact"))


def _word_divergence() -> list[tuple[str, Column]]:
    """Columns in order: common words of the text sorted, where each run starts, and the distance.

    A reference word that is missing in the text adds half its share; so only
    the words that are there are visited.
    """
    common = F.expr(f"sort_array(filter(words, w -> array_contains(get(known, least(length(w), {LONGEST_LIST}) - 1), w)))")
    common = F.when(F.col("word_share").isNotNull(), common)
    starts = F.expr("filter(sequence(0, size(common)), k -> k = size(common) OR k = 0 OR common[k] <> common[k - 1])")
    runs = F.expr("""
        transform(slice(starts, 1, size(starts) - 1), (s, j) ->
            struct((starts[j + 1] - s) / n_words AS p, word_share[common[s]] AS q))""")
    present = _sum(F.transform("runs", lambda r: _js_terms(r["p"], r["q"])))
    missing = (_sum(F.map_values("word_share")) - _sum(F.transform("runs", lambda r: r["q"]))) / 2
    others = _js_terms(1 - F.size("common") / F.col("n_words"), 1 - _sum(F.map_values("word_share")))
    return [("common", common),
            ("starts", F.when(F.size("common") > 0, starts).otherwise(F.array(F.lit(0)))),
            ("runs", runs), ("word_distance", F.sqrt(F.greatest(present + missing + others, F.lit(0.0))))]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          min_share: float = 0.002, min_words: int = 50, min_reference: int = 1000,
          word_limit: float = 0.36, word_slack: float = 1.0, class_limit: float = 0.30,
          class_slack: float = 0.5) -> DataFrame:
    """One row per input row: id, the base counts, both distances, base_failed and kept.

    A document with fewer than ``min_words`` words, or with over half of its
    words in repeated windows, fails the base rules. Another is dropped if
    its word or class distance lies above ``limit + slack / sqrt(n_words)``;
    against a reference of fewer than ``min_reference`` words the distances
    are NULL and drop nothing. NULL texts have no words; a NULL language is a
    language of its own (shared with the empty one). Rows are judged one by
    one, so repeated rows and NULL ids are all returned; columns other than
    id, text and language are ignored; an empty table gives an empty result.
    """
    references = (land(language_references(docs, lang_col, text_col, min_share), "language-references")
                  .where(F.col("n_words") >= min_reference)
                  .select(F.col("lang").alias("ref_lang"), "class_share", "word_share", "known"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       text_or_empty(text_col).alias("text"))
    out = rows.join(broadcast_if_small(references), F.col("lang") == F.col("ref_lang"), "left")
    out = measures(out).drop("text")
    for name, column in _word_divergence():
        out = out.withColumn(name, F.when(F.col("n_words") >= min_words, column) if name == "common" else column)
    n_chars = sum(F.col(f"classes.{c}") for c in CLASSES)
    class_terms = [_js_terms(F.col(f"classes.{c}") / n_chars, F.col("class_share")[k]) for k, c in enumerate(CLASSES)]
    class_distance = F.when(n_chars > 0, F.sqrt(F.greatest(sum(class_terms, F.lit(0.0)), F.lit(0.0))))
    root = F.sqrt(F.col("n_words"))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    diverges = (F.coalesce(F.col("word_distance") > word_limit + word_slack / root, F.lit(False))
                | F.coalesce(F.col("class_distance") > class_limit + class_slack / root, F.lit(False)))
    return (out.withColumn("class_distance", F.when(F.col("n_words") >= min_words, class_distance))
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), "word_chars",
                    F.col("classes.symbols").cast("long").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
                    "word_distance", "class_distance", base_failed.alias("base_failed"),
                    (~base_failed & ~diverges).alias("kept")))
