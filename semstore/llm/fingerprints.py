"""Fingerprints of documents: a Merkle tree over paragraphs and sections.

A paragraph is a line; a section ends at a blank line, and after about one paragraph in eight, chosen by its digest. The
digests of paragraphs make those of sections, and these make the root. So that edits within a paragraph can be located
too, a paragraph also has short hashes of its phrases: it is cut at the ends of sentences, and after a pair of words
whose hash is the smallest among its neighbours, which depends on the words around the cut only.

The fingerprint holds the root (128 bits, equal for equal texts only), the sections (64 bits), the paragraphs (48) and
the phrases (24), in that order and nested: `root/section;paragraph:phrases;paragraph:phrases/section...`. Two
fingerprints are compared from the top: equal roots end it, equal branches are left out, and what remains below the
differing ones locates the edits. The likeness is the share of phrases that the two have in common (Dice).

Every document is also compared with the next one in the order of ids. Rows are dealt to ranges of ids, each with the
first row of the next range behind it, and streamed over in order; a text travels once. Ranges begin at rows chosen by a
hash, at most MOST_RANGES of them, so the table of beginnings that every task gets is bounded.

Defined cases: null is an empty text, whose fingerprint is its root alone; two empty texts are alike. Texts of any length
are read whole. Rows with the same id are ordered by their text; rows with the same id and text are one document, with
one next document, returned as often as they occur. Rows without an id come last. The document after the last is the
first, so a single document is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import id_and_text, mix, slices, staged, texts_of

#: A phrase ends after a pair of words whose hash is the smallest of so many before and after it.
REACH = 2
#: One paragraph in so many ends a section.
SECTION = 8
#: Bytes of text in a range, and the most ranges.
RANGE_BYTES, MOST_RANGES = 4 << 20, 1 << 20
#: Hashes of words that a worker remembers.
REMEMBERED = 1 << 19

_WORD = re.compile(r"\S+[^\S\n]*\n?|[^\S\n]+\n?|\n")
_PARAGRAPH = re.compile(r"[^\n]*\n|[^\n]+")
_STOPS, _CLOSING = (".", "!", "?", "\u3002", "\uff01", "\uff1f"), "\"')]"
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", dtype=np.uint8)


class _Hashes(dict):
    """By word with what follows it: a hash, then a bit for the end of a line, then one for the end of a sentence."""

    def __missing__(self, word: str) -> int:
        bare = word.strip()
        line = word[-1] == "\n"
        end = line or len(bare) < len(word) and bare.rstrip(_CLOSING).endswith(_STOPS)
        found = xxhash.xxh3_64_intdigest(bare.encode(errors="replace")) & ~3 | line << 1 | end
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


_hashes = _Hashes()


def _cut(lines: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words of lines (all but the last end with a line break), their hashes, phrases' ends and lines as word numbers."""
    words = _WORD.findall("".join(lines))
    n = len(words)
    value = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=n)
    cut = (value & np.uint64(1)).astype(bool)
    cut[-1] = True
    breaks = (value >> np.uint64(1) & np.uint64(1)).astype(np.int64)
    line = np.cumsum(breaks) - breaks
    if n > 2 * REACH + 1:
        with np.errstate(over="ignore"):
            pair = value[1:] * np.uint64(0x9E3779B97F4A7C15) + value[:-1] * np.uint64(0xD6E8FEB86659FD93)
        pair ^= pair >> np.uint64(31)
        inner = pair[REACH : n - 1 - REACH]
        least = line[: n - 1 - 2 * REACH] == line[2 * REACH + 1 :]  # neighbours in the same line only
        for i in range(1, REACH + 1):
            # of equal ones the last
            least &= (inner <= pair[REACH - i : REACH - i + len(inner)]) & (inner < pair[REACH + i : REACH + i + len(inner)])
        cut[REACH + 1 : n - REACH] |= least
    return words, value, np.flatnonzero(cut) + 1, line


def phrases(paragraph: str) -> list[str]:
    """Consecutive phrases that together are the paragraph."""
    if not paragraph:
        return []
    words, _, ends, _ = _cut([paragraph])
    return ["".join(words[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass
class Paragraph:
    digest: bytes
    phrases: str  # four characters each


def _paragraphs(lines: list[str]) -> list[Paragraph]:
    _, value, ends, line = _cut(lines)
    sizes = np.diff(ends, prepend=0)
    starts = ends - sizes
    place = np.arange(1, len(value) + 1, dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = (value >> np.uint64(2)) * np.uint64(0x9E3779B97F4A7C15) ^ place * np.uint64(0xD6E8FEB86659FD93)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        short = mix(np.add.reduceat(mixed, starts)) >> np.uint64(40)
    shifts = np.array([18, 12, 6, 0], dtype=np.uint64)
    text = _DIGITS[(short[:, None] >> shifts & np.uint64(63)).astype(np.int64)].tobytes().decode()
    last = (4 * np.cumsum(np.bincount(line[ends - 1], minlength=len(lines)))).tolist()
    return [Paragraph(_digest(t.encode(errors="replace")), text[a:b]) for t, a, b in zip(lines, [0, *last], last, strict=False)]


def fingerprint(text: str, known: dict[str, Paragraph] | None = None) -> str:
    """The fingerprint of a text; `known` remembers paragraphs of texts that are close to it."""
    known = {} if known is None else known
    sections: list[tuple[bytes, str]] = []
    own: list[Paragraph] = []

    def end_section() -> None:
        made = _digest(b"s" + b"".join(p.digest for p in own))
        body = "".join(f";{p.digest[:6].hex()}:{p.phrases}" for p in own)
        sections.append((made, f"/{made[:8].hex()}{body}"))
        own.clear()

    lines = _PARAGRAPH.findall(text)
    unknown = [line for line in dict.fromkeys(lines) if line not in known]
    if unknown:
        # only the last line of the text can lack its break
        unknown.sort(key=lambda line: line[-1] != "\n")
        known.update(zip(unknown, _paragraphs(unknown), strict=True))
    for line in lines:
        made = known[line]
        own.append(made)
        if made.digest[15] % SECTION == 0 or not line.strip():
            end_section()
    if own:
        end_section()
    root = _digest(b"r" + b"".join(d for d, _ in sections)).hex()
    return root + "".join(body for _, body in sections)


def likeness(a: str, b: str) -> float:
    """Share of phrases in common, 0 to 1; equal branches are counted without a look into them."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = Counter(a.split("/")[1:]), Counter(b.split("/")[1:])
    total = sum(n * _size(s) for side in (left, right) for s, n in side.items())
    equal = left & right
    common = sum(n * _size(s) for s, n in equal.items())
    left, right = _below(left - equal), _below(right - equal)
    equal = left & right
    common += sum(n * len(_phrases(p)) for p, n in equal.items())
    left, right = (Counter(c for p in side.elements() for c in _phrases(p)) for side in (left - equal, right - equal))
    common += sum((left & right).values())
    return 2 * common / total if total else 0.0


def _size(section: str) -> int:
    return sum(len(p) - 13 for p in section.split(";")[1:]) // 4


def _below(sections: Counter) -> Counter:
    return Counter(p for s in sections.elements() for p in s.split(";")[1:])


def _phrases(paragraph: str) -> list[str]:
    return [paragraph[i : i + 4] for i in range(13, len(paragraph), 4)]


def edited_spans(text: str, other: str) -> list[tuple[int, int]]:
    """Where the phrases of a text stand that the text with the fingerprint `other` lacks; neighbours are one span."""
    own = fingerprint(text)
    if own[:32] == other[:32]:
        return []
    sections = Counter(other.split("/")[1:])
    equal = Counter(own.split("/")[1:]) & sections
    have = Counter(c for s in (sections - equal).elements() for p in s.split(";")[1:] for c in _phrases(p))
    lines = iter(_PARAGRAPH.findall(text))
    at, out = 0, []
    for section in own.split("/")[1:]:
        held = equal[section] > 0
        equal[section] -= held
        for paragraph in section.split(";")[1:]:
            line = next(lines)
            if held:
                at += len(line)
                continue
            for part, short in zip(phrases(line), _phrases(paragraph), strict=True):
                end = at + len(part)
                if have[short] > 0:
                    have[short] -= 1
                elif out and out[-1][1] == at:
                    out[-1] = (out[-1][0], end)
                else:
                    out.append((at, end))
                at = end
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                made = [fingerprint(t) for t in texts_of(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def compare(old: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, likeness and spans (begin, end in the new text) of the documents of two versions; null likeness: in one only.

    The old version is read as fingerprints (doc_id, fingerprint); its texts are not needed. Ids are unique in both.
    """
    now = id_and_text(new, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = old.select("doc_id", "fingerprint").join(now, "doc_id", "full")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                alike, spans = [], []
                for text, print_ in zip(part.column("text").to_pylist(), part.column("fingerprint").to_pylist(), strict=True):
                    known = text is not None and print_ is not None
                    alike.append(likeness(fingerprint(text), print_) if known else None)
                    spans.append([{"begin": a, "end": b} for a, b in edited_spans(text, print_)] if known else None)
                span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(alike, pa.float64()), pa.array(spans, pa.list_(span))], names=["doc_id", "likeness", "spans"]
                )

    return both.mapInArrow(run, "doc_id long, likeness double, spans array<struct<begin:long,end:long>>")


# --- every document next to the one after it

ROW = "range int, halo boolean, none int, id long, hash long, text string, n long"


def _beginnings(keys: DataFrame, range_bytes: int, most_ranges: int) -> list[tuple[int, int, int]]:
    """Sorted keys (no id, id, hash of the text) of the rows that ranges begin with, the first row's among them."""
    n, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n:
        return []
    every = max(1, n // min(most_ranges, max(1, size // range_bytes)))
    chosen = keys.where(F.pmod(F.xxhash64("none", "id", "hash", F.lit("begin")), F.lit(every)) == 0)
    first = keys.agg(F.min(F.struct("none", "id", "hash")).alias("k")).select("k.*")
    found = chosen.select("none", "id", "hash").unionByName(first).distinct().collect()
    return sorted((r["none"], r["id"], r["hash"]) for r in found)


def next_to_each_other(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES, most_ranges: int = MOST_RANGES) -> DataFrame:
    """The rows in order within each task, by range; a range ends with the row that follows it (`halo`)."""
    source = id_and_text(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    rows = source.select(
        F.col("doc_id").isNull().cast("int").alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    keys = staged(rows.select("none", "id", "hash", F.octet_length("text").cast("long").alias("size")), "keys")
    starts = source.sparkSession.sparkContext.broadcast(_beginnings(keys, range_bytes, most_ranges))

    def deal(batches):
        begin = starts.value
        known = {key: i for i, key in enumerate(begin)}
        for batch in batches:
            for part in slices(batch):
                columns = [part.column(c).to_pylist() for c in ("none", "id", "hash")]
                index: dict[tuple, int] = {}
                take, copies, ranges, halo = [], [], [], []
                for i, key in enumerate(zip(*columns, strict=True)):
                    seen = index.get(key)
                    if seen is not None and part.column("text")[take[seen]].equals(part.column("text")[i]):
                        copies[seen] += 1  # repeated rows travel once a batch
                        continue
                    index[key] = len(take)
                    take.append(i)
                    copies.append(1)
                    ranges.append(bisect.bisect_right(begin, key) - 1)
                    halo.append(False)
                    if key in known:
                        take.append(i)
                        copies.append(1)
                        ranges.append((known[key] or len(begin)) - 1)
                        halo.append(True)
                own = part.take(pa.array(take, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges, pa.int32()), pa.array(halo), *(own.column(c) for c in ("none", "id", "hash", "text")), pa.array(copies, pa.int64())],
                    names=["range", "halo", "none", "id", "hash", "text", "n"],
                )

    return rows.mapInArrow(deal, ROW).repartition("range").sortWithinPartitions("range", "halo", "none", "id", "hash", "text")


@dataclass
class _Document:
    range: int
    none: int
    id: int
    text: str
    n: int

    def __post_init__(self) -> None:
        self.known: dict[str, Paragraph] = {}
        self.print = fingerprint(self.text, self.known)

    def row(self, after: _Document) -> tuple:
        half = len(self.text) // 2
        edited = self.text[: len(self.text) - half] + after.text[:half]
        changed = fingerprint(edited, self.known)
        digest = hashlib.sha256(edited.encode(errors="replace")).hexdigest()
        alike = likeness(self.print, changed), likeness(self.print, after.print)
        return None if self.none else self.id, len(self.text), digest, self.print, changed, *alike, self.n


PAIR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n long"
)
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())


def _with_next(batches):
    before: _Document | None = None
    names = [field.split()[0] for field in PAIR.split(", ")]
    for batch in batches:
        for part in slices(batch):
            out = []
            columns = (part.column(c).to_pylist() for c in ("range", "halo", "none", "id", "text", "n"))
            for place, halo, none, number, text, n in zip(*columns, strict=True):
                if before is not None and not halo and (before.none, before.id, before.text) == (none, number, text):
                    before.n += n
                    continue
                if before is None and halo:
                    continue
                own = _Document(place, none, number, text, n)
                if before is not None:
                    if before.range != place:
                        raise RuntimeError(f"range {before.range} has no end")
                    out.append(before.row(own))
                before = None if halo else own
            columns = list(zip(*out, strict=True)) or [()] * len(_TYPES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=names)
    if before is not None:
        raise RuntimeError(f"range {before.range} has no end")


def with_edits(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES, most_ranges: int = MOST_RANGES
) -> DataFrame:
    """The fingerprint of every document, of an edit of it, and how alike it is to its edit and to the next document.

    The edit replaces the last half of the code points (rounded down) by as many from the beginning of the next one.
    """
    dealt = next_to_each_other(docs, id_col, text_col, range_bytes, most_ranges)
    found = dealt.mapInArrow(_with_next, PAIR)
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.drop("n", "copy")
