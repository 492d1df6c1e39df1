"""Secret scans: fixed patterns, then dictionary-primed zstandard novelty.

Base spans come from three patterns. For the rest, every string of 8 or more
letters, digits and symbols that stands in a sensitive context is a candidate:
a word such as ``key`` or ``bearer`` shortly before it, or after it on its
line, or a secret right before it with nothing but blanks, quotes and
connecting signs between (the further lines of a key). Its marginal cost is
the number of bytes by which a zstandard frame grows when the candidate joins
the text around it, with the compressor primed by the corpus's most frequent
identifiers. Ordinary names, paths and repeated constants cost little there;
a string that stays incompressible is reported as a ``novel`` span.

How many bytes a character are asked for goes by what the string is made of
(``Novelty.asked``), since a few bytes of a frame are noise: least for long
strings with digits, most for letters alone. Not judged are numbers, plain
words of fewer than 16 letters, which no byte count tells from a rare word,
and mail addresses.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import bounded_batches, row_slices, text_or_empty

#: Kinds in the order that breaks ties of equal starts. Fixed values.
KINDS = ("assign", "access", "hex", "novel")
#: Base patterns: leftmost matches, then those too short are dropped. Fixed values.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: The same hex matches: a maximal run that is long enough is what remains of the runs.
HEX_LONG = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")

SENSITIVE = re.compile(r"(?ai:key|secret|token|passw|passphrase|pwd|credential|auth|bearer|private|signature|session"
                       r"|login|cookie|webhook|license)")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.!@#$%^&*~-])[A-Za-z0-9+/_.!@#$%^&*~-]{8,}(?:={1,2}(?![A-Za-z0-9]))?")
ADDRESS = re.compile(r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: What may stand between a secret and its continuation.
JOINT = re.compile(r"""[\s"'`\\+,;|>-]{1,16}""")
MIN_WORD = 16


@dataclass(frozen=True)
class Novelty:
    """``reach``: code points before a candidate, or after it on its line, in which a sensitive word makes it one;
    ``around``: code points of surrounding text that the compressor has seen; marginal bytes a character:
    ``min_ratio`` of strings of 16 or more with a digit, ``short_ratio`` of shorter ones with a digit,
    ``word_ratio`` of plain words, ``letter_ratio`` of other strings without a digit."""
    identifiers: bytes = b""
    reach: int = 48
    around: int = 2048
    min_ratio: float = 0.55
    short_ratio: float = 0.8
    word_ratio: float = 0.85
    letter_ratio: float = 0.9
    level: int = 3
    _tools: dict = field(default_factory=dict, compare=False, repr=False)

    def _size(self, data: bytes) -> int:
        if "z" not in self._tools:
            primed = (zstandard.ZstdCompressionDict(self.identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                      if len(self.identifiers) >= 8 else None)
            self._tools["z"] = zstandard.ZstdCompressor(level=self.level, dict_data=primed, write_checksum=False,
                                                        write_content_size=False)
        return len(self._tools["z"].compress(data))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_tools"} | {"_tools": {}}

    def marginal(self, text: str, start: int, end: int) -> int:
        """Bytes that ``text[start:end]`` adds to the compressed text around it."""
        before = text[max(0, start - self.around):start].encode("utf-8", "replace")
        after = text[end:end + self.around].encode("utf-8", "replace")
        return self._size(after + before + text[start:end].encode()) - self._size(after + before)

    def asked(self, string: str) -> float | None:
        """Marginal bytes a character that make ``string`` a secret; None if it is not judged."""
        if not any("A" <= c <= "Z" or "a" <= c <= "z" for c in string) or ADDRESS.fullmatch(string):
            return None
        core = string.strip("+/_.!@#$%^&*~-=")
        if any("0" <= c <= "9" for c in core):
            return self.min_ratio if len(string) >= MIN_WORD else self.short_ratio
        plain = all(w.islower() or w.isupper() or w[1:].islower() for w in re.split(r"[/_.-]+", core) if w.isalpha())
        if plain and not any(c in "+!@#$%^&*~" for c in core):  # a word, or words in a row
            return self.word_ratio if len(core) >= MIN_WORD else None
        return self.letter_ratio

    def spans(self, text: str, taken: list[tuple[int, int]], secret: Iterable[int] = ()) -> Iterator[tuple[int, int]]:
        """Novel spans outside ``taken``; ``secret``: ends of spans that pass their context on."""
        named = [m.span() for m in SENSITIVE.finditer(text)]
        ends, passing = [b for _, b in named], set(secret)
        if not named and not passing:
            return
        taken, at, reached, last = sorted(taken), 0, 0, -1
        passed_on = sorted(passing)
        for m in CANDIDATE.finditer(text):
            start = m.start()
            end = start + len(m[0].rstrip("."))
            while at < len(taken) and taken[at][0] < end:
                reached = max(reached, taken[at][1])
                at += 1
            if reached > start or end - start < 8:
                continue
            k = bisect_right(passed_on, start) - 1
            before = max(last, passed_on[k] if k >= 0 else -1)
            if not (before >= 0 and JOINT.fullmatch(text, before, start)) and not self._named(text, start, end, named, ends):
                continue
            ratio = self.asked(text[start:end])
            if ratio is not None and self.marginal(text, start, end) >= ratio * (end - start):
                last = end
                yield start, end

    def _named(self, text: str, start: int, end: int, named: list[tuple[int, int]], ends: list[int]) -> bool:
        """Whether a sensitive word lies in reach, wholly before the string or wholly after it on its line."""
        k = bisect_right(ends, start)
        if k and named[k - 1][0] >= start - self.reach:
            return True
        while k < len(named) and named[k][0] < end:
            k += 1
        return k < len(named) and ends[k] <= end + self.reach and "\n" not in text[end:named[k][0]]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return found


def scan_text(text: str, novelty: Novelty) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans in code points, by start, then kind."""
    found = base_spans(text)
    passing = [b for kind, _, b in found if kind != "hex"]  # a hex string is often a checksum
    found += [("novel", a, b) for a, b in novelty.spans(text, [(a, b) for _, a, b in found], passing)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def identifier_dictionary(docs: DataFrame, text_col: str = "text", size: int = 2000) -> bytes:
    """The ``size`` most frequent identifiers of all texts, the most frequent last (nearest for zstandard).

    Counted over the whole corpus with map-side combining; only the fixed
    number of winners comes to the driver (ties by the identifier itself).
    """
    words = F.explode(F.split(text_or_empty(text_col), r"[^A-Za-z_]+"))
    top = (docs.select(words.alias("w")).where(F.length("w").between(4, 40)).groupBy("w").count()
           .orderBy(F.desc("count"), "w").limit(size).collect())
    return " ".join(r["w"] for r in reversed(top)).encode()


SPANS = "array<struct<kind: string, start: bigint, `end`: bigint>>"


def scan(docs: DataFrame, novelty: Novelty | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): all spans of every whole text, sorted by start, then kind.

    ``novelty`` defaults to one primed by the identifiers of ``docs``. NULL
    and empty texts have no spans; texts of any length are read whole, in time
    linear in their strings and spans. Rows are independent: repeated rows and
    NULL ids pass through; other columns are ignored; an empty table gives an
    empty result.
    """
    novelty = novelty or Novelty(identifier_dictionary(docs, text_col))
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t, novelty)]
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, shape)], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return (bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")
            .withColumnRenamed("id", id_col))


def count_kind(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                      s["end"].cast("string"))))
