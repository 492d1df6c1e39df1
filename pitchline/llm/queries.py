"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import (bpe, collocations, common, exact_dedup, lang_id, mixing, pu_quality, quality_rules, secrets, simhash,
                           spelling, toxicity, url_rules, wrapper)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(common.table(spark, sf_dir, "documents"))


_SPAM = "|".join(p.name for p in url_rules.SPAM_PATTERNS)


@query("op2_url_filter", f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
     r AS (SELECT *, '.' || host AS dotted FROM p),
     m AS (SELECT page_id, host, path,
                  CASE WHEN ends_with(dotted, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                       WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                       WHEN ends_with(dotted, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
                       WHEN ends_with(dotted, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                       WHEN ends_with(dotted, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
                  regexp_matches(host, '(^|[^a-z0-9])({_SPAM})([^a-z0-9]|$)') AS spam FROM r)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN spam THEN 'block' ELSE 'allow' END AS verdict
FROM m
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(common.table(spark, sf_dir, "pages")).drop("matched_pattern")


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract_main_text(common.table(spark, sf_dir, "pages"))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return secrets.scan(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *[secrets.count_kind(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (common.crc32_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    return bpe.digests(bpe.round_trip(common.table(spark, sf_dir, "documents"), path))


@query("op7_exact_dedup", """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
     g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(common.table(spark, sf_dir, "documents"))


@query("op8_mix_to_targets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def _half(p: str, q: str) -> str:
    return f"CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) / 2 ELSE 0 END"


def _term(p: str, q: str) -> str:
    """What one bin adds to the Jensen-Shannon divergence."""
    return f"({_half(p, q)} + {_half(q, p)})"


_GONE = {"letters": "\\p{L}", "capitals": "\\p{Lu}", "digits": "\\p{Nd}", "blanks": "[\\x20\\x09-\\x0D]",
         "symbols": "[#*$%&|<>]"}
_CLASS_SQL = ", ".join(f"length(text) - length(regexp_replace(text, '{p}', '', 'g')) AS all_{c}" for c, p in _GONE.items())
_BINS = ("all_letters - all_capitals", "all_capitals", "all_digits", "all_blanks", "all_symbols",
         "length(text) - all_letters - all_digits - all_blanks - all_symbols")


@query("op9_quality_rules", f"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
                  list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
           FROM documents),
c AS (SELECT *, len(words) AS n, {_CLASS_SQL} FROM d),
windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
            FROM (SELECT doc_id, words, unnest(range(1, n - 1)) AS i FROM c) x),
again AS (SELECT doc_id, i FROM (SELECT *, COUNT(*) OVER (PARTITION BY doc_id, g) AS k FROM windows) y WHERE k > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS repeated FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) z
            GROUP BY doc_id),
spoken AS (SELECT doc_id, lang, unnest(words) AS w FROM c),
sizes AS (SELECT lang, SUM(n) AS total FROM c GROUP BY lang HAVING SUM(n) >= 1000),
ref AS (SELECT s.lang, s.w, COUNT(*) / CAST(any_value(z.total) AS DOUBLE) AS q FROM spoken s JOIN sizes z ON z.lang = s.lang
        GROUP BY s.lang, s.w HAVING COUNT(*) >= 0.002 * any_value(z.total)),
own AS (SELECT s.doc_id, s.w, COUNT(*) AS k FROM spoken s JOIN ref r ON r.lang = s.lang AND r.w = s.w GROUP BY s.doc_id, s.w),
pairs AS (SELECT c.doc_id, c.n, coalesce(o.k, 0) AS k, coalesce(o.k, 0) / CAST(c.n AS DOUBLE) AS p, r.q
          FROM c JOIN ref r ON r.lang = c.lang LEFT JOIN own o ON o.doc_id = c.doc_id AND o.w = r.w WHERE c.n >= 50),
rest AS (SELECT doc_id, SUM({_term('p', 'q')}) AS s, 1 - SUM(k) / CAST(any_value(n) AS DOUBLE) AS p, 1 - SUM(q) AS q
         FROM pairs GROUP BY doc_id),
far AS (SELECT doc_id, sqrt(greatest(0.0, s + {_term('p', 'q')})) AS word_distance FROM rest),
shares AS (SELECT c.lang, {', '.join(f'SUM({b}) / CAST(SUM(length(text)) AS DOUBLE) AS q{k}' for k, b in enumerate(_BINS))}
           FROM c JOIN sizes z ON z.lang = c.lang GROUP BY c.lang),
mine AS (SELECT c.doc_id, {', '.join(f'({b}) / CAST(length(text) AS DOUBLE) AS p{k}, q{k}' for k, b in enumerate(_BINS))}
         FROM c JOIN shares s ON s.lang = c.lang WHERE c.n >= 50),
apart AS (SELECT doc_id, sqrt(greatest(0.0, {' + '.join(_term(f'p{k}', f'q{k}') for k in range(len(_BINS)))})) AS class_distance
          FROM mine),
judged AS (SELECT c.doc_id, c.n AS n_words, len(array_to_string(c.words, '')) AS word_chars, c.all_symbols AS n_symbols,
                  len(c.lines) - len(list_distinct(c.lines)) AS n_dup_lines, coalesce(v.repeated, 0) AS n_repeat_words,
                  coalesce(f.word_distance > 0.36 + 1 / sqrt(c.n), FALSE)
                  OR coalesce(a.class_distance > 0.30 + 0.5 / sqrt(c.n), FALSE) AS diverges
           FROM c LEFT JOIN covered v ON v.doc_id = c.doc_id LEFT JOIN far f ON f.doc_id = c.doc_id
           LEFT JOIN apart a ON a.doc_id = c.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT diverges AS kept
FROM judged""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(common.table(spark, sf_dir, "documents")).drop("word_distance", "class_distance")


@query("op10_pu_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = pu_quality.train(docs, common.table(spark, sf_dir, "labels"))
    return pu_quality.score(docs, model).select(
        "doc_id", (common.crc32_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return lang_id.predict(docs, lang_id.train(docs)).select(
        "doc_id", (common.crc32_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(common.table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_collocations", """WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
grams AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase
          FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i
                FROM (SELECT lang, words, unnest([1, 2, 3, 4]) AS m FROM w) x) y),
total AS (SELECT lang, CAST(SUM(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, m, phrase, COUNT(*) AS a FROM grams GROUP BY lang, m, phrase HAVING COUNT(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE m >= 2),
cuts AS (SELECT lang, phrase, m, a, words, unnest(range(1, m)) AS k FROM c),
scored AS (SELECT u.lang, u.phrase, u.a, u.k, l.a AS l, r.a AS r,
                  CAST(CAST(2000000 AS HUGEINT) * u.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
           FROM cuts u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.words[1:u.k], ' ')
                JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.words[u.k + 1:u.m], ' ')),
lowest AS (SELECT * FROM scored QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, a, array_to_string(words[i:i + s - 1], ' ') AS phrase
           FROM (SELECT lang, a, words, s, unnest(range(1, m - s + 2)) AS i
                 FROM (SELECT lang, a, words, m, unnest(range(2, m)) AS s FROM c) x) y),
longer AS (SELECT lang, phrase, MAX(a) AS a FROM inside GROUP BY lang, phrase),
kept AS (SELECT w.* FROM lowest w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
         WHERE g.a IS NULL OR CAST(100 AS HUGEINT) * g.a < CAST(80 AS HUGEINT) * w.a),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score FROM ranked k JOIN total t ON t.lang = k.lang WHERE k.rank <= 2000
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(common.table(spark, sf_dir, "documents"))
