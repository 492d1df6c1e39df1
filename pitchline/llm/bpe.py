"""BPE encoding and decoding with a pair occurrence index.

Texts are cut at special tokens and then into pieces by the vocabulary's
pre-tokenizer. The distinct pieces that a partition has not met yet are
merged together: an index maps each mergeable pair to all its positions in
those pieces, the active ranks are applied in ascending order, and every merge
updates the lists of the two neighbouring pairs. A merged token's pairs always
rank after it (checked when the vocabulary is loaded), so applying a rank once
to all pieces equals merging every piece on its own.

Encoded pieces are kept in a bounded store in the worker; when it is full it
starts anew, which costs time and changes no result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_batches, row_slices, text_or_empty

#: Pre-tokenizer pattern of byte-level BPE vocabularies. Fixed value.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of encoded chunks kept per worker before the store starts anew; it grows past them by one slice at most.
STORE_BYTES = 100 << 20
#: What a chunk takes in the store beside its characters and ids.
CHUNK_BYTES = 200
#: Bytes of text encoded at a time and ids decoded at a time: what a worker needs beside its store grows with them.
SLICE_BYTES, DECODE_BLOCK = 1 << 21, 1 << 16
#: Pairs ranked before this are merged by array steps; the rest, whose lists are short, position by position.
BULK_RANKS = 4000
_GAP, _DEAD = -1, -2


def byte_characters() -> dict[str, int]:
    """The printable stand-in character of every byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _by_rank(at: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(at):
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(ranks)) + 1, [len(at)]]).tolist()
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield int(ranks[lo]), at[lo:hi]


class Vocabulary:
    """A byte-level BPE tokenizer file: merges by rank, special tokens, bytes of every id."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"], pre["type"]) != ("BPE", "ByteLevel") or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space is supported")
        ids: dict[str, int] = model["vocab"]
        of_byte = byte_characters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = (regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None)
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in of_byte.items():
            self.byte_id[byte] = ids[char]
        size = max([*ids.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in [*ids.items(), *self.special.items()]:
            # the decoder maps stand-in characters to bytes and leaves a token with any other character as it is
            known = all(c in of_byte for c in token)
            spelled[i] = bytes(of_byte[c] for c in token) if known else token.encode()
        self.spelled = spelled
        self.rank: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        made = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, new = ids[left], ids[right], ids[left + right]
            if max(made.get(a, -1), made.get(b, -1)) >= rank or new in made:
                raise ValueError(f"merge {rank} is not in order of its parts")
            made[new] = rank
            self.rank[a << 20 | b] = rank
            self.merges.append((a, b, new))
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.fromiter(self.rank.values(), np.int64, len(keys))[order]
        self.pattern = regex.compile(BYTE_LEVEL_PATTERN)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces side by side, number of ids of each piece)."""
        # symbols of all pieces in one array, a gap before, between and after them
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        start = np.cumsum(lens + 1) - lens
        sym = np.full(int(lens.sum()) + len(pieces) + 1, _GAP, np.int64)
        inside = np.ones(len(sym), bool)
        inside[0] = False
        inside[start + lens] = False
        sym[inside] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        # the index: rank of a pair -> its positions
        index: dict[int, list] = {}
        nxt, prv = np.arange(1, len(sym) + 1), np.arange(-1, len(sym) - 1)
        at, ranks = self._ranked(sym[:-1], sym[1:], np.arange(len(sym) - 1))
        for r, positions in _by_rank(at, ranks):
            index[r] = [positions]
        active = list(index)
        heapify(active)
        while active and active[0] < BULK_RANKS:  # these pairs have long lists: one array step a rank
            r = heappop(active)
            a, b, new = self.merges[r]
            p = np.unique(np.concatenate(index.pop(r)))
            p = p[sym[p] == a]
            p = p[sym[nxt[p]] == b]
            if a == b and len(p):  # of pairs that overlap every second one merges, from the left
                chained = np.concatenate([[False], nxt[p[:-1]] == p[1:]])
                here = np.arange(len(p))
                p = p[(here - np.maximum.accumulate(np.where(chained, 0, here))) % 2 == 0]
            q = nxt[p]
            sym[p], sym[q] = new, _DEAD
            after = nxt[q]
            nxt[p], prv[after] = after, p
            before = prv[p]
            at, ranks = self._ranked(np.concatenate([sym[before], sym[p]]), np.concatenate([sym[p], sym[after]]),
                                     np.concatenate([before, p]))
            for k, positions in _by_rank(at, ranks):
                if k in index:
                    index[k].append(positions)
                else:
                    index[k] = [positions]
                    heappush(active, k)
        index = {r: np.concatenate(parts).tolist() for r, parts in index.items()}
        sym, nxt, prv = sym.tolist(), nxt.tolist(), prv.tolist()
        rank_of, merges = self.rank.get, self.merges
        while active:
            r = heappop(active)
            positions = index.pop(r)
            positions.sort()  # pairs that overlap merge from the left
            a, b, new = merges[r]
            for p in positions:
                if sym[p] != a:
                    continue
                q = nxt[p]
                if sym[q] != b:
                    continue
                sym[p], sym[q] = new, _DEAD
                n = nxt[q]
                nxt[p], prv[n] = n, p
                after = sym[n]
                if after >= 0 and (k := rank_of(new << 20 | after)) is not None:
                    if k in index:
                        index[k].append(p)
                    else:
                        index[k] = [p]
                        heappush(active, k)
                n = prv[p]
                before = sym[n]
                if before >= 0 and (k := rank_of(before << 20 | new)) is not None:
                    if k in index:
                        index[k].append(n)
                    else:
                        index[k] = [n]
                        heappush(active, k)
        done = np.array(sym, np.int64)
        live = done >= 0
        ends = np.cumsum(live)
        counts = ends[start + lens - 1] - ends[start - 1] if len(pieces) else lens
        return done[live].astype(np.int32), counts.astype(np.int64)

    def _ranked(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, rank) of the pairs that can merge, by rank."""
        key = np.where((left >= 0) & (right >= 0), left << 20 | right, -1)
        found = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        hit = np.flatnonzero(self._keys[found] == key)
        ranks = self._ranks[found[hit]]
        order = np.argsort(ranks, kind="stable")
        return at[hit[order]], ranks[order]

    def pieces(self, text: str) -> Iterator[str]:
        """Special tokens and pre-tokenized pieces, in order."""
        parts = self.special_split.split(text) if self.special_split else [text]
        for part in parts:
            if part in self.special:
                yield part
            elif part:
                yield from self.pattern.findall(part)


class _Rows(dict):
    """Row of every chunk in the store; an unknown chunk gets the next row and waits to be encoded."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []
        self.characters = 0

    def __missing__(self, chunk: str) -> int:
        self[chunk] = row = len(self)
        self.waiting.append(chunk)
        self.characters += len(chunk)
        return row


class Encoder:
    """Encodes batches of texts; keeps encoded chunks (a space and what follows up to the next) in a store."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocab = vocabulary
        self.clear()

    def clear(self) -> None:
        self.rows = _Rows()
        self.count = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def held(self) -> int:
        """Bytes of the store, four a character."""
        return 4 * self.rows.characters + CHUNK_BYTES * len(self.rows) + self.ids.nbytes

    def chunks(self, text: str) -> list[str]:
        """``text`` cut where a space comes before something visible: always a border between pieces."""
        if not text:
            return []
        first, *parts = text.split(" ")
        if first and not _ODD_SPACE.search(text):
            return [first, *[" " + p for p in parts]]
        out = [first] if first else []
        for part in parts:
            # a blank after the space, or the text's end: the run of blanks stays with the chunk before it
            if out and (not part or _BLANK.match(part)):
                out[-1] += " " + part
            else:
                out.append(" " + part)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts side by side, offsets of the texts in them)."""
        if self.held() > STORE_BYTES:
            self.clear()
        special, split = self.vocab.special, self.vocab.special_split
        per_text, row_parts = [], []
        row_of = self.rows.__getitem__
        for text in texts:
            if split and any(s in text for s in special):
                parts = [c for part in split.split(text) for c in ([part] if part in special else self.chunks(part))]
            else:
                parts = self.chunks(text)
            per_text.append(len(parts))
            row_parts.append(np.fromiter(map(row_of, parts), np.int32, len(parts)))
        if self.rows.waiting:
            self._add(self.rows.waiting)
            self.rows.waiting.clear()
        rows = np.concatenate(row_parts) if row_parts else np.zeros(0, np.int32)
        counts = self.count[rows]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[rows] - (ends - counts), counts) + np.arange(total)]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(np.array(per_text, np.int64))])]
        return ids, offsets

    def _add(self, chunks: list[str]) -> None:
        """Encode unknown chunks together and append them to the store in their order."""
        findall = self.vocab.pattern.findall
        piece_row = _Rows()
        row_of = piece_row.__getitem__
        rows: list[int] = []
        per_chunk = np.zeros(len(chunks), np.int64)
        special: dict[int, int] = {}
        for k, chunk in enumerate(chunks):
            if chunk in self.vocab.special:
                special[k] = self.vocab.special[chunk]
                continue
            pieces = findall(chunk)
            per_chunk[k] = len(pieces)
            rows += map(row_of, pieces)
        ids, counts = self.vocab.merge([p.encode("utf-8", "surrogatepass") for p in piece_row.waiting])
        starts = np.cumsum(counts) - counts
        rows = np.array(rows, np.int64)
        of_piece = counts[rows]
        ends = np.cumsum(of_piece)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(starts[rows] - (ends - of_piece), of_piece) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_chunk)])]
        count, start = np.diff(bounds), bounds[:-1] + len(self.ids)
        for at, (k, i) in enumerate(special.items(), len(self.ids) + len(flat)):
            start[k], count[k] = at, 1
        self.ids = np.concatenate([self.ids, flat, np.fromiter(special.values(), np.int32, len(special))])
        self.start = np.concatenate([self.start, start])
        self.count = np.concatenate([self.count, count])


#: A space before a blank or the end. The class holds more than any library's \s, which only makes chunks longer.
_BLANKS = r"[\s\x1c-\x1f\x85᠎​﻿]"
_ODD_SPACE = re.compile(f" (?:{_BLANKS}|$)")
_BLANK = re.compile(_BLANKS)


@lru_cache(maxsize=2)
def _encoder(source: str) -> Encoder:
    return Encoder(Vocabulary(source))


@lru_cache(maxsize=2)
def _decoder(source: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    spelled = _encoder(source).vocab.spelled
    lens = np.fromiter(map(len, spelled), np.int64, len(spelled))
    return np.frombuffer(b"".join(spelled), np.uint8), lens, np.cumsum(lens) - lens


def decode_flat(source: str, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of the id runs ``ids[offsets[k]:offsets[k + 1]]``; broken UTF-8 becomes U+FFFD."""
    data, lens, starts = _decoder(source)
    blocks = []
    for at in range(0, len(ids), DECODE_BLOCK):
        part = ids[at:at + DECODE_BLOCK]
        counts = lens[part]
        ends = np.cumsum(counts)
        blocks.append(data[np.repeat(starts[part] - (ends - counts), counts) + np.arange(ends[-1])].tobytes())
    spelled = b"".join(blocks)
    cut = np.concatenate([[0], np.cumsum(lens[ids])])[offsets].tolist()
    return [spelled[a:b].decode("utf-8", "replace") for a, b in zip(cut[:-1], cut[1:])]


def _list_array(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def vocabulary_source(path: str) -> str:
    """The tokenizer file's text: one file of fixed size, sent to the tasks with the job."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): every whole text encoded without added special tokens.

    ``vocabulary`` is the path of a byte-level BPE tokenizer file. NULL and
    empty texts have no ids. Special tokens spelled out in a text get their
    own id. Rows are independent, so repeated rows and NULL or repeated ids
    pass through; other columns are ignored.
    """
    source = docs.sparkSession.sparkContext.broadcast(vocabulary_source(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in row_slices(batches, SLICE_BYTES):
            ids, offsets = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), _list_array(ids, offsets)], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return (bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")
            .withColumnRenamed("id", id_col))


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, text): ``decode(encode(docs))`` in one pass over the rows, the text decoded from the ids."""
    source = docs.sparkSession.sparkContext.broadcast(vocabulary_source(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        for batch in row_slices(batches, SLICE_BYTES):
            ids, offsets = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _list_array(ids, offsets), pa.array(decode_flat(source.value, ids, offsets), pa.string())],
                ["id", "ids", "text"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return (bounded_batches(rows)
            .mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, text string")
            .withColumnRenamed("id", id_col))


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): the text of every id list, special tokens kept; NULL or empty lists give ''."""
    source = encoded.sparkSession.sparkContext.broadcast(vocabulary_source(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, SLICE_BYTES):
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64)
            texts = decode_flat(source.value, ids, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())],
                                             ["id", "ids", "text"])

    empty = F.array().cast("array<int>")
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), empty).alias("ids"))
    return (bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, text string")
            .withColumnRenamed("id", id_col))


def digests(decoded: DataFrame, *more: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) and the columns ``more`` of a decoded frame."""
    return decoded.select(id_col, *more, F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
