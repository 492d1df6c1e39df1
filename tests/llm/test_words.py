"""Language ID (11), spelling variants (12) and collocations (13) against brute-force versions."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitchline.llm import collocations, common, lang_id, queries, spelling

SF = "/root/testdata/sf0.01"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- Language ID -------------------------------------------------------------------------------------------------

def naive_phrases(sample, text):
    total = 0
    for start in range(0, len(text), lang_id.STRETCH):
        rest = text[start:start + lang_id.STRETCH]
        while rest:
            size = 1
            while size < len(rest) and rest[:size + 1] in sample:
                size += 1
            total, rest = total + 1, rest[size if rest[:1] in sample else 1:]
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc ", min_size=1, max_size=40), min_size=1, max_size=3), st.lists(st.text("abcd ", max_size=700), max_size=4))
def test_phrases_are_greedy_longest_matches(samples, texts):
    samples = {f"l{k}": s.encode() for k, s in enumerate(samples)}
    model = lang_id.LanguageModel.of(samples)
    data = [t.encode() for t in texts]
    got = model.phrases(np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(t) for t in data]).astype(np.int64))
    assert got.tolist() == [[naive_phrases(samples[lang], t) for lang in model.langs] for t in data]


def test_suffix_automaton_accepts_just_the_substrings():
    text = b"abcbcabab"
    moves = lang_id.suffix_automaton(text)

    def accepts(s):
        state = 0
        for c in s:
            state = moves[state].get(c)
            if state is None:
                return False
        return True

    for size in range(1, 5):
        for k in range(3 ** size):
            s = bytes(b"abc"[k // 3 ** i % 3] for i in range(size))
            assert accepts(s) == (s in text)


def test_languages_of_held_out_documents(spark):
    docs = common.table(spark, SF, "documents")
    got = queries.QUERIES["op11_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0
    assert got.count() == docs.count()


def test_odd_rows_for_language_id(spark):
    teach = [(k, t * 9, lang, "x") for k, (t, lang) in enumerate([("the house and the dog ", "en"), ("das haus und der hund ", "de")] * 6)]
    schema = "doc_id long, text string, lang string, score string"
    rows = [(100, None, None, ""), (101, "", "en", ""), (102, "12 -- ²", "en", ""), (103, "the dog", None, ""), (103, "the dog", None, ""),
            (None, "Der Hund", "fr", ""), (104, "the house and " * 20_000, None, "")]
    docs = spark.createDataFrame(teach + rows, schema)
    model = lang_id.train(docs.where("coalesce(lang, '') <> 'fr'"))
    got = lang_id.predict(docs, model).where("doc_id >= 100 or doc_id is null")
    assert sorted(((r.doc_id or 0), r.lang_pred) for r in got.collect()) == [
        (0, "de"), (100, "und"), (101, "und"), (102, "und"), (103, "en"), (103, "en"), (104, "en")]
    empty = spark.createDataFrame([], schema)
    assert lang_id.train(empty) is None and lang_id.predict(empty, model).collect() == []
    assert {(r.lang_pred, r.score) for r in lang_id.predict(docs, None).collect()} == {("und", 0.0)}
    # held-out rows and rows without a language teach nothing
    fold = spark.createDataFrame([(k, "abc", "xx") for k in range(40) if zlib.crc32(str(k).encode()) % 4 == 2], "doc_id long, text string, lang string")
    assert lang_id.train(fold) is None
    assert lang_id.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None


def test_language_sample_is_bounded_and_keeps_no_copies(spark):
    docs = spark.createDataFrame([(k, f"wort{chr(97 + k % 20)} " * 300, "de") for k in range(400)], "doc_id long, text string, lang string")
    model = lang_id.train(docs, block=100, blocks=5)
    assert 5 * 90 < 2 ** model.bits[0] <= 5 * 110


# --- Spelling variants -------------------------------------------------------------------------------------------

def brute_variants(rows, shortest=7, min_count=2, every=31):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    n = {w: k for w, k in seen.items() if k >= min_count and len(w) >= shortest}
    letters = sorted({c for w in n for c in w})
    form, near_n = {}, {}
    for w in n:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        near = sorted((-n[x], x) for x in edits - {w} if x in n)
        near_n[w] = len(near)
        form[w] = near[0][1] if near and -near[0][0] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], near_n[w], n[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_spelling_variants_equal_brute_force(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    want = brute_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = queries.QUERIES["op12_spelling_variants"](spark, "/root/testdata/sf0.001")
    assert got.count() == len(want) and rows_of(got) == want


def test_spelling_variants_of_crowded_halves(spark):
    rng = random.Random(5)
    words = {"under" + "".join(rng.choice("abÉ") for _ in range(rng.randint(2, 6))) for _ in range(300)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(2, 5))) + "ation" for _ in range(60)}
    rows = [(k, " ".join([w, w] * rng.choice([1, 1, 15, 300]))) for k, w in enumerate(sorted(words))]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_variants(rows)
    assert got.count() == len(want) and rows_of(got) == want
    assert any(r[1] and r[2] != r[1] for r in want)  # chains longer than one


@settings(max_examples=8, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=5), min_size=1, max_size=40))
def test_pairs_of_short_words_come_once(spark, words):
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = sorted((r.word, r.other) for r in spelling.near_pairs(df).collect())
    want = []
    for s in words:
        for t in words:
            edits = {t[:i] + t[i + 1:] for i in range(len(t))} if len(t) == len(s) + 1 else \
                {t[:i] + c + t[i + 1:] for i in range(len(t)) for c in "ab"} if len(t) == len(s) and s < t else set()
            if s in edits:
                want.append((s, t))
    assert got == sorted(want)


def test_odd_rows_for_spelling(spark):
    schema = "doc_id long, text string, word string, n string"
    rows = [(1, None, "", ""), (None, "Straßen straßen", "", ""), (2, "", "", ""), (4, "a×bcdefg " * 3, "", ""), (4, "a×bcdefg " * 3, "", "")]
    got = spelling.variants(spark.createDataFrame(rows, schema))
    assert rows_of(got) == brute_variants([r[:2] for r in rows])
    long = "x" * 20_000
    got = spelling.variants(spark.createDataFrame([(3, f"{long} {long}y " * 2, "", "")], schema))
    assert sorted((len(r.word), r.n, r.n_near, r.form) for r in got.collect()) == [(20_000, 2, 1, None), (20_001, 2, 1, None)]
    assert spelling.variants(spark.createDataFrame([], schema)).collect() == []


# --- Collocations ------------------------------------------------------------------------------------------------

def brute_collocations(rows, min_count=30, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        f = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low(text or "")):
            words = re.findall(r"[^ \t]+", piece)
            total[lang or "und" if lang is None else lang] += len(words)
            for m in range(1, 5):
                f.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        covered = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    covered[p[i:i + m]] = max(covered[p[i:i + m]], a)
        kept = []
        for p, a in found.items():
            if 100 * covered[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.add((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return out


def test_collocations_equal_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "of", "New", "york", "é", "É", "a b", "x" * 300]
    rows = [(rng.choice(["en", "de", None, ""]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!"])
                                                         for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    rows += [("en", None), ("en", ""), ("en", "go " * 20_000), ("en", "no stop here " * 500)] + [("de", "fixed phrase of five words")] * 40
    docs = spark.createDataFrame([(k, t, lang, "clash") for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, phrase string")
    for top in (2000, 3):
        got = collocations.mine(docs, top=top)
        assert [c for c, _ in got.dtypes] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        rows_got = [tuple(r) for r in got.collect()]
        assert len(set(rows_got)) == len(rows_got) and set(rows_got) == brute_collocations(rows, top=top)
    assert collocations.mine(docs.limit(0)).collect() == []


def test_a_full_filter_and_other_triggers_change_no_count(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    want = {tuple(r) for r in collocations.mine(docs).collect()}
    assert want == {tuple(r) for r in collocations.mine(docs, every=1).collect()} == {tuple(r) for r in collocations.mine(docs, every=10 ** 6).collect()}
    parsed = common.land(collocations.parse(docs), "t")
    full = [f.collect() for f in collocations.frequent(parsed, 30, max_filter_bytes=1024)]
    free = [f.collect() for f in collocations.frequent(parsed, 30)]
    assert [sorted(map(str, f)) for f in full] == [sorted(map(str, f)) for f in free]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab .\t", max_size=60), max_size=5), st.integers(1, 4))
def test_chunks_own_every_word_once_and_hold_its_phrases(texts, every):
    row, words, own = collocations.chunks(pa.array([t.encode() for t in texts], pa.binary()), every)
    got = Counter()
    for r, chunk, n in zip(row.tolist(), words.to_pylist(), own.tolist()):
        w = chunk.split()
        for i in range(n):
            for m in range(1, 5):
                if i + m <= len(w):
                    got[(r, *w[i:i + m])] += 1
    want = Counter()
    for r, t in enumerate(texts):
        for piece in t.encode().split(b"."):
            w = piece.split()
            for m in range(1, 5):
                want.update((r, *w[i:i + m]) for i in range(len(w) - m + 1))
    assert got == want


@pytest.mark.parametrize("a,l,r", [(31, 62, 31), (2 ** 62, 2 ** 62, 2 ** 62 + 1), (1, 3, 4), (10 ** 18, 10 ** 18, 10 ** 18), (7, 7, 2 ** 62)])
def test_scores_are_exact(spark, a, l, r):  # noqa: E741
    got = spark.range(1).select(collocations.ratio_floor(F.lit(a), F.lit(l), F.lit(r))).first()[0]
    assert got == 2000000 * a // (l + r)


def test_short_words_are_hashed_together(monkeypatch):
    import numpy as np
    import pyarrow as pa
    words = [b"", b"a", b"a\0", b"abcdefgh", b"abcdefgh\0", b"abcdefghi", b"x" * 64, b"\xff" * 9]
    with monkeypatch.context() as m:
        m.setattr(collocations, "xxhash", None)  # only longer ones are hashed one by one
        h = collocations.hashes(pa.array(words, pa.binary()))
        many = collocations.hashes(pa.array([f"w{i}".encode() for i in range(20_000)], pa.binary()))
    assert len(set(h.tolist())) == len(words) and len(set(many.tolist())) == 20_000
    assert np.bincount((many % np.uint64(16)).astype(int)).min() > 1000
    mixed = pa.array([b"y" * 65, *words, b"y" * 300], pa.binary())
    assert (collocations.hashes(mixed)[1:-1] == h).all() and (collocations.hashes(mixed.slice(1, len(words))) == h).all()
    assert len(set(collocations.hashes(mixed).tolist())) == len(words) + 2 and len(collocations.hashes(pa.array([], pa.binary()))) == 0


def test_chunks_and_phrases_travel_in_packs(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice(["en", "d\ne", None]), " ".join(rng.choice("a b c dd ee ff. gg hh ii jj".split()) for _ in range(30))) for _ in range(400)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    parsed = common.land(collocations.parse(docs), "t")
    assert parsed.count() == 1  # one block of numbered words, not a row a chunk
    assert {r.lang: r.n for r in collocations.mine(docs).collect()} == {lang: n for lang, *_, n, _ in brute_collocations(rows)}
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 6400)  # many buckets: equal phrases of all blocks still meet
    assert common.land(collocations.parse(docs), "t").count() > 50
    assert {tuple(r) for r in collocations.mine(docs).collect()} == brute_collocations(rows)


def test_packs_keep_texts_and_sums_and_grow_in_proportion():
    import numpy as np
    import pyarrow as pa
    langs, texts = pa.array(["x", "y"]), pa.array([b"a b", b"c", b"d", b"e"], pa.binary())
    lang, h = np.array([1, 0, 1, 1]), np.array([3, 7, 1, 5], np.uint64)
    pack = collocations.packed(langs, lang, h, 2, texts.take, [np.array([5, 6, 7, 8], np.int64)])
    assert pack.select(["bucket", "lang"]).to_pylist() == [{"bucket": 1, "lang": "x"}, {"bucket": 1, "lang": "y"}]
    of, found = collocations.unpacked(pa.Table.from_batches([pack, pack]))
    got = {(of[int(i)].as_py(), t, n) for i, t, n in zip(found["lang"], found["text"].to_pylist(), found["n"].tolist())}
    assert got == {("y", b"a b\n", 10), ("x", b"c\n", 12), ("y", b"d\n", 14), ("y", b"e\n", 16)}
    small, large = collocations.dealt_over(150 << 20), collocations.dealt_over(900 << 20)
    assert small == large == collocations.BUCKETS  # rows a block stay the same, so packs grow with the blocks
    assert collocations.dealt_over(0) == 1 and collocations.dealt_over(64 << 30) == 4096
