"""Phrase collocation mining over a prefix-free parse.

Every piece of text (between punctuation marks) is cut where three consecutive
words hash to a trigger. A chunk runs from one trigger to the end of the next,
so neighbours overlap by the three words of a trigger and every phrase of up
to four words lies whole in the chunk that holds its first word. The distinct
chunks with their frequencies are the dictionary, written once; all counting
runs inside its chunks, weighted by frequency, and a phrase counts in the
chunk that owns its first word, so overlaps count once.

Counting goes by length. A phrase found ``min_count`` times has only parts
found as often, so positions whose parts fail a Bloom filter of the shorter
phrases are passed over before the shuffle. The filter has a bounded size and
only ever passes too much, which costs rows and changes no count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import bounded_batches, land, row_slices

#: Longest phrase in words; a trigger has one word less.
LONGEST = 4
TRIGGER = LONGEST - 1
#: The language of rows without one.
NO_LANGUAGE = "und"

#: Most bytes of text for each bucket that chunks and phrases are dealt over; up to ``BUCKETS`` of them may hold less.
BUCKET_BYTES, BUCKETS = 16 << 20, 256

#: Bytes of text cut into words at a time; arrays of larger slices leave the caches.
SLICE_BYTES = 1 << 19

#: Bytes of a word up to which words are hashed together.
SHORT = 64

WORD, BLANK, STOP = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = BLANK
KIND[list(b".,;:!?\n\x0b\x0c\r")] = STOP
KIND = KIND.tobytes()
LOWER = bytes(range(256)).lower()

#: A row holds some megabytes of chunks: the distinct ``words`` joined by blanks, the word number of every position
#: (``code``, int32), and for each chunk the place of its language in ``langs``, its words, its own words (int32) and
#: its frequency (int64). ``positions`` is their number, ``totals`` holds the own words of each language, weighted.
BLOCK = "positions long, langs array<string>, totals array<long>, words binary, code binary, lang binary, size binary, own binary, freq binary"


def numbered(begins: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The part each of the sorted places ``at`` lies in, by the sorted ``begins`` of the parts."""
    return np.repeat(np.arange(len(begins)), np.diff(np.searchsorted(at, begins), append=len(at)))


def scan(texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """(words, row of each word, piece of each word) of binary ``texts``; A-Z come out in lower case."""
    texts = pa.array(texts.to_pylist(), pa.binary()) if texts.offset or texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
    word = kind == WORD
    first = np.zeros(len(data) + 1, bool)  # first byte of a row; one more, so that a row of no bytes at the end fits
    first[offsets[:-1]] = True
    first = first[:-1]
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (first | ~before))
    after = np.concatenate([word[1:] & ~first[1:], [False]])
    ends = np.flatnonzero(word & ~after) + 1
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[word].tobytes().translate(LOWER))])
    return words, numbered(offsets[:-1], starts), numbered(np.flatnonzero(first | (kind == STOP)), starts)


def mixed(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """64-bit hash of a sequence from the hash of its beginning and that of its next word."""
    out = (h ^ (more + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash per value: eight bytes a step for all short values at once, XXH3 for the few longer ones."""
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + values.offset + 1)[values.offset:].astype(np.int64)
    data = np.concatenate([np.frombuffer(values.buffers()[2] or b"", np.uint8)[:offsets[-1]], np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    size = np.diff(offsets)
    out = mixed(np.zeros(len(size), np.uint64), size.astype(np.uint64))
    short = np.flatnonzero((size > 0) & (size <= SHORT))
    for start in range(0, SHORT, 8):
        short = short[size[short] > start]
        if not len(short):
            break
        block = np.ascontiguousarray(eight[offsets[short] + start]).view("<u8").ravel()
        left = np.minimum(size[short] - start, 8).astype(np.uint64)
        out[short] = mixed(out[short], block & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left)))
    for i in np.flatnonzero(size > SHORT):
        out[i] = xxhash.xxh3_64_intdigest(data[offsets[i]:offsets[i + 1]].tobytes())
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code per word, distinct words)."""
    e = words.dictionary_encode()
    return e.indices.to_numpy(zero_copy_only=False), e.dictionary


def join_words(words: pa.Array, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The ``size`` words from each ``begin``, joined by spaces."""
    ends = np.cumsum(size)
    at = np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), words.take(pa.array(at)))
    return pc.binary_join(lists, b" ")


def phrases_at(words: pa.Array, code: np.ndarray, begin: np.ndarray, length: int) -> pa.Array:
    """The ``length`` words numbered by ``code`` from each ``begin``, joined by spaces."""
    parts = [words.take(pa.array(code[begin + k])) for k in range(length)]
    return pc.binary_join_element_wise(*parts, b" ") if length > 1 else parts[0]


def chunks(texts: pa.Array, every: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, words, number of own words) of every chunk of ``texts``; one window in ``every`` is a trigger."""
    words, row, piece = scan(texts)
    n = len(words)
    h = hashes(words)
    window = np.full(n, False)
    if n >= TRIGGER:
        seen = h[:n - TRIGGER + 1]
        for k in range(1, TRIGGER):
            seen = mixed(seen, h[k:n - TRIGGER + 1 + k])
        window[:n - TRIGGER + 1] = (seen % np.uint64(every) == 0) & (piece[:n - TRIGGER + 1] == piece[TRIGGER - 1:])
    opens = np.concatenate([[True], piece[1:] != piece[:-1]]) if n else window
    begin = np.flatnonzero(opens | window)
    after = np.concatenate([begin[1:], [n]]).astype(np.int64)[:len(begin)]
    ends_piece = np.concatenate([opens[begin[1:]], [True]])[:len(begin)]
    size = after - begin + np.where(ends_piece, 0, TRIGGER)
    return row[begin], join_words(words, begin, size), after - begin


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", every: int = 12) -> DataFrame:
    """The dictionary of distinct (lang, chunk, own) with their frequencies as rows of ``BLOCK``, chunks as UTF-8 bytes.

    NULL texts are empty, NULL languages ``und``.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    buckets = dealt_over(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, 4 << 20):
            lang, langs = coded(batch.column(0))
            parts, start = [], 0
            for part in row_slices([batch], SLICE_BYTES):
                row, words, own = chunks(part.column(1), every)
                parts.append((lang[start + row], words, own.astype(np.int32)))
                start += part.num_rows
            of, words, own = zip(*parts)
            own = np.concatenate(own)
            found = added_up(np.concatenate(of), pa.concat_arrays(words), own, np.ones(len(own), np.int64))
            yield packed(langs, found["lang"], hashes(found["text"]), buckets, found["text"].take, [found["own"], found["n"]])

    return (bounded_batches(rows).mapInArrow(run, "bucket long, lang string, texts binary, own binary, n binary")
            .groupBy("bucket").applyInArrow(blocks, BLOCK))


def dealt_over(size: int) -> int:
    """Number of buckets for ``size`` bytes of text."""
    return max(min(BUCKETS, 1 + size // (BUCKET_BYTES // 64)), size // BUCKET_BYTES)


def added_up(lang: np.ndarray, texts: pa.Array, own: np.ndarray, n: np.ndarray) -> dict:
    """The distinct (lang, text, own) with the sums of ``n``."""
    t = pa.table({"lang": lang, "text": texts, "own": own, "n": n}).group_by(["lang", "text", "own"], use_threads=False)
    t = t.aggregate([("n", "sum")]).combine_chunks()
    return {"lang": t["lang"].to_numpy(), "text": pa.concat_arrays(t["text"].chunks) if t.num_rows else pa.array([], pa.binary()),
            "own": t["own"].to_numpy(), "n": t["n_sum"].to_numpy()}


def packed(langs: pa.Array, lang: np.ndarray, h: np.ndarray, buckets: int, texts: Callable[[pa.Array], pa.Array],
           numbers: list[np.ndarray]) -> pa.RecordBatch:
    """(bucket, lang, texts, one column for each of ``numbers``): a row for each bucket and language.

    ``texts`` gives the texts at some places; they are joined by \\n, which no word holds.
    """
    group = lang * np.int64(buckets) + (h % np.uint64(buckets)).view(np.int64)
    order = np.argsort(group)
    group = group[order]
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    bounds = np.append(heads, len(group)).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), texts(pa.array(order))), b"\n")
    cut = [pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(bounds * np.int32(a.itemsize)), pa.py_buffer(a[order])])
           for a in numbers]
    bucket, of = group[heads] % buckets, langs.take(pa.array(group[heads] // buckets))
    return pa.RecordBatch.from_arrays([pa.array(bucket), of, joined, *cut], ["bucket", "lang", "texts", *("own", "n")[-len(cut):]])


def unpacked(bucket: pa.Table) -> tuple[pa.Array, dict]:
    """(languages, distinct (lang, text, own) with the sums of n) of a bucket's rows; texts end with \\n."""
    data = b"\n".join(bucket["texts"].to_pylist()) + b"\n"
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n")) + 1
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    texts = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    counts = bucket["n"].to_pylist()
    n = np.frombuffer(b"".join(counts), np.int64)
    own = np.frombuffer(b"".join(bucket["own"].to_pylist()), np.int32) if "own" in bucket.column_names else np.zeros(len(n), np.int32)
    code, langs = coded(bucket["lang"].combine_chunks())
    return langs, added_up(np.repeat(code, [len(c) // 8 for c in counts]), texts, own, n)


def blocks(bucket: pa.Table) -> pa.Table:
    """The distinct chunks of a bucket as rows of ``BLOCK``: texts are cut into words and these numbered only once."""
    langs, found = unpacked(bucket)
    rows = pa.RecordBatch.from_arrays([pa.array(found["lang"]), found["text"], pa.array(found["own"]), pa.array(found["n"])],
                                      ["lang", "text", "own", "n"])
    out = []
    for part in row_slices([rows], 4 << 20):
        words, row, _ = scan(part.column(1))
        code, distinct = coded(words)
        lang, own, freq = (part.column(k).to_numpy() for k in (0, 2, 3))
        totals = np.zeros(len(langs), np.int64)
        np.add.at(totals, lang, own * freq)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct), b" ")
        numbers = [a.tobytes() for a in (code, lang, np.bincount(row, minlength=part.num_rows).astype(np.int32), own, freq)]
        out.append([len(code), langs.to_pylist(), totals, joined[0].as_py(), *numbers])
    schema = pa.schema([("positions", pa.int64()), ("langs", pa.list_(pa.string())), ("totals", pa.list_(pa.int64())),
                        *((c, pa.binary()) for c in ("words", "code", "lang", "size", "own", "freq"))])
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)


class Bloom:
    """Membership filter over 64-bit hashes: 3 bits a member, never a false no."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(h: np.ndarray, size: int) -> np.ndarray:
        """Three bit numbers per hash; ``size`` is a power of two."""
        step = (h >> np.uint64(17)) | np.uint64(1)
        return np.stack([(h + np.uint64(k) * step) & np.uint64(64 * size - 1) for k in range(3)])

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h, len(self.words)):
            out &= (self.words[(p >> np.uint64(6)).view(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def phrase_hash(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    h = lang
    for w in words:
        h = mixed(h, w)
    return h


def bloom(phrases: DataFrame, max_bytes: int) -> Bloom:
    """Filter of the (lang, phrase) rows: 16 bits a row, ``max_bytes`` in all at most."""
    n = phrases.count()
    size = 1 << max(6, min((n * 16 // 64).bit_length(), (max_bytes // 8).bit_length() - 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, row, _ = scan(batch.column(1).cast(pa.binary()))
            h = hashes(words)
            code, langs = coded(batch.column(0).cast(pa.binary()))
            lang = hashes(langs)[code]
            count = np.bincount(row, minlength=batch.num_rows)
            begin = np.cumsum(count) - count
            for length in np.unique(count):  # all phrases of a call have one length
                of = np.flatnonzero(count == length)
                p = Bloom.places(phrase_hash(lang[of], [h[begin[of] + k] for k in range(length)]), size).ravel()
                place, group = np.unique(p >> np.uint64(6), return_inverse=True)
                bits = np.zeros(len(place), np.uint64)
                np.bitwise_or.at(bits, group, np.uint64(1) << (p & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(bits.view(np.int64))], ["place", "bits"])

    got = (phrases.select("lang", "phrase").mapInArrow(run, "place long, bits long")
           .groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow())  # ``size`` rows at most
    words = np.zeros(size, np.uint64)
    words[got["place"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return Bloom(words)


def counted(parsed: DataFrame, length: int, min_count: int, buckets: int, parts: Bloom | None = None) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``length`` words found ``min_count`` times whose two longest parts ``parts`` may hold."""
    sent = parsed.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = sent.value
        for block in (b.slice(i, 1).to_pydict() for b in batches for i in range(b.num_rows)):
            langs = pa.array(block["langs"][0], pa.string())
            words, _, _ = scan(pa.array(block["words"], pa.binary()))
            code, lang, size, own = (np.frombuffer(block[c][0], np.int32) for c in ("code", "lang", "size", "own"))
            freq = np.frombuffer(block["freq"][0], np.int64)
            ends = np.cumsum(size)
            row = np.repeat(np.arange(len(size), dtype=np.int32), size)
            left = np.repeat(ends, size) - np.arange(len(code))  # words from here to the chunk's end
            mine = left >= length
            mine &= left > np.repeat(size - own, size)
            h, lang_hash = hashes(words), hashes(langs.cast(pa.binary()))
            if filled is not None:
                part = np.flatnonzero(left >= length - 1)
                held = np.zeros(len(code) + 1, bool)
                held[part] = filled.may_hold(phrase_hash(lang_hash[lang[row[part]]], [h[code[part + k]] for k in range(length - 1)]))
                mine &= held[:-1] & held[1:]
            at = np.flatnonzero(mine)
            key, width, top = lang[row[at]].astype(np.int64), len(words), len(langs)
            for k in range(length):
                if top * width >= 1 << 63:  # dense numbers, where the next product would pass 64 bits
                    _, key = np.unique(key, return_inverse=True)
                    top = len(key)
                key, top = key * width + code[at + k], top * width
            order = np.argsort(key)
            heads = np.flatnonzero(np.diff(key[order], prepend=-1))
            n = np.add.reduceat(freq[row[at[order]]], heads) if len(heads) else np.zeros(0, np.int64)
            one = at[order[heads]]
            of = lang[row[one]]
            yield packed(langs, of, phrase_hash(lang_hash[of], [h[code[one + k]] for k in range(length)]), buckets,
                         lambda order: phrases_at(words, code, one[order.to_numpy()], length), [n])

    def add(bucket: pa.Table) -> pa.Table:
        langs, found = unpacked(bucket)
        kept = np.flatnonzero(found["n"] >= min_count)
        phrases = pc.binary_replace_slice(found["text"].take(pa.array(kept)), -1, 1 << 30, b"")
        return pa.table({"lang": langs.take(pa.array(found["lang"][kept])), "phrase": phrases, "n": found["n"][kept]})

    return (parsed.mapInArrow(run, "bucket long, lang string, texts binary, n binary")
            .groupBy("bucket").applyInArrow(add, "lang string, phrase binary, n long"))


def frequent(parsed: DataFrame, min_count: int, max_filter_bytes: int = 16 << 20) -> list[DataFrame]:
    """Per length 1 to 4 the phrases found ``min_count`` times or more, as written tables (lang, phrase, n)."""
    found, parts = [], None
    buckets = dealt_over(4 * (parsed.agg(F.sum("positions")).first()[0] or 0))
    for length in range(1, LONGEST + 1):
        found.append(land(counted(parsed, length, min_count, buckets, parts), f"phrases-{length}"))
        if length < LONGEST:
            parts = bloom(found[-1], max_filter_bytes)
    return found


def ratio_floor(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)) in decimals of 38 digits (no rounding, no overflow of 64 bits)."""
    wide = a.cast("decimal(19,0)") * F.lit(2000000).cast("decimal(7,0)")
    under = l.cast("decimal(19,0)") + r.cast("decimal(19,0)")
    return ((wide - wide % under) / under).cast("long")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, top: int = 2000,
         cover_percent: int = 80, every: int = 12) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n, score.

    A candidate has 2 to 4 words and ``a`` >= ``min_count`` occurrences. Its
    score is the lowest over its cuts (the smallest first part of equals); a
    candidate lying in a longer one with ``cover_percent`` of its occurrences
    is dropped. Ties rank by ``a``, then by the phrase's bytes. Repeated rows
    count again; a NULL text is empty, a NULL language ``und``; other columns
    are ignored, whatever their names; an empty table gives an empty result.
    Texts of any length are cut into chunks, so none is held as a whole beyond
    its own row.
    """
    parsed = land(parse(docs, text_col, lang_col, every), "phrase-chunks")
    total = (parsed.select(F.explode(F.arrays_zip("langs", "totals")).alias("of")).groupBy(F.col("of.langs").alias("lang"))
             .agg(F.sum("of.totals").alias("total")))
    levels = [f.withColumn("phrase", F.col("phrase").cast("string")) for f in frequent(parsed, min_count)]
    known = levels[0]
    for f in levels[1:]:
        known = known.unionByName(f)
    candidates = levels[1].unionByName(levels[2]).unionByName(levels[3]).withColumn("words", F.split("phrase", " "))
    cuts = (candidates.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
            .select("lang", "phrase", F.col("n").alias("a"), "k",
                    F.expr("array_join(slice(words, 1, k), ' ')").alias("head"),
                    F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("tail")))
    # a part of a candidate is found at least as often, so it is among the known
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    scored = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
              .withColumn("score", ratio_floor(F.col("a"), F.col("l"), F.col("r")))
              .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = F.expr("""filter(flatten(transform(sequence(2, greatest(2, size(words) - 1)), m ->
                             transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' ')))),
                             p -> p <> phrase)""")
    covers = (candidates.where(F.size("words") > 2).select("lang", "n", F.explode(F.array_distinct(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    hidden = F.col("longer").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * cover_percent
    left = (scored.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(hidden, F.lit(False)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return (best.join(broadcast_if_small(total), "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
