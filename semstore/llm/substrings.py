"""Exact substring deduplication with external suffix arrays.

Every byte covered by a string of `length` bytes that also starts earlier (in a smaller document, or earlier in the same
one) is removed.

Strings that could be equal are brought together first. Each string of `length` bytes has a minimizer, the run of GRAM
bytes in it with the smallest hash; equal strings have equal minimizers. Neighbouring strings with the same minimizer
form a segment, and a minimizer that occurs once cannot stand in a repeated string. Of equal segments only the first is
sorted; the others are covered as a whole. Segments of one minimizer that differ go to one shard, where the suffix array
of all its segments is built by external induced sorting; neighbours that share `length` bytes are the repeated strings,
and all but the first of each are covered. Minimizers with very many different segments (a passage that many documents
share, each with its own surroundings) are cut into single strings before that, so that equal ones meet by their hash.

Defined cases: null and empty texts have no bytes; texts of any length are read whole; matches never cross documents.
Rows without an id come after all ids below 2**62. Rows with the same id are ordered by a hash of their text; those with
the same id and text are one document, returned as often as they occur.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import bytes_of, keyed, mix, release, slices, staged
from semstore.llm.induced import suffix_array

LENGTH, GRAM = 100, 20
#: Different segments of one minimizer, beyond which they are cut into single strings.
MANY = 20_000
#: Bytes of segments in a shard.
SHARD_BYTES = 2 << 20
#: Parts of a text that are hashed at once, with `length` - 1 bytes in common.
PART = 4 << 20


def segments_of(text: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """Rows (hash of the minimizer, first start, last start) of the segments of a text, as unsigned 64-bit integers."""
    out = []
    for begin in range(0, max(len(text) - length + 1, 0), PART):
        part = text[begin : begin + PART + length - 1]
        hashes = _gram_hashes(part, gram)
        # the upper 40 bits of the hash decide, then the place
        keyed = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_minimum(keyed, length - gram + 1)
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        new = np.r_[0, np.flatnonzero(place[1:] != place[:-1]) + 1]
        last = np.r_[new[1:] - 1, len(place) - 1]
        out.append(np.column_stack([hashes[place[new]], (new + begin).astype(np.uint64), (last + begin).astype(np.uint64)]))
    return np.concatenate(out) if out else np.empty((0, 3), dtype=np.uint64)


def _gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of `gram` bytes, from runs of doubling length."""
    own = mix(text.astype(np.uint64))
    made, width, out = own, 1, None
    done = 0
    rest = gram
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                n = len(text) - gram + 1
                piece = made[done : done + n]
                out = piece.copy() if out is None else out * np.uint64(0x9E3779B97F4A7C15) + piece
                done += width
            rest >>= 1
            made = made[:-width] * np.uint64(0xD6E8FEB86659FD93) + made[width:]
            width *= 2
    return mix(out)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    made, have = values, 1
    while have * 2 <= width:
        made = np.minimum(made[:-have], made[have:])
        have *= 2
    n = len(values) - width + 1
    return np.minimum(made[:n], made[width - have : width - have + n])


def minimizer_counts(docs: DataFrame, length: int) -> DataFrame:
    """Minimizers that occur more than once."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [segments_of(np.frombuffer(t, dtype=np.uint8), length)[:, 0] for t in bytes_of(part.column("text"))]
                kinds, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], names=["minimizer", "n"])

    counted = docs.select("text").mapInArrow(run, "minimizer long, n long")
    return counted.groupBy("minimizer").agg(F.sum("n").alias("n")).where("n > 1").select("minimizer")


def segments(docs: DataFrame, length: int) -> DataFrame:
    """minimizer, id, content, start, last (starts of the first and last string) and digest of every segment."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = bytes_of(part.column("text"))
                found = [segments_of(np.frombuffer(t, dtype=np.uint8), length).astype(np.int64) for t in texts]
                digest = [
                    xxhash.xxh3_64_intdigest(t[a : b + length]) for t, rows in zip(texts, found, strict=True) for a, b in rows[:, 1:].tolist()
                ]
                owner = pa.array(np.repeat(np.arange(len(texts)), [len(f) for f in found]))
                table = np.concatenate(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(table[:, 0]),
                        part.column("id").take(owner),
                        part.column("content").take(owner),
                        pa.array(table[:, 1].astype(np.int32)),
                        pa.array(table[:, 2].astype(np.int32)),
                        pa.array(np.array(digest, dtype=np.uint64).view(np.int64)),
                    ],
                    names=["minimizer", "id", "content", "start", "last", "digest"],
                )

    return docs.select("id", "content", "text").mapInArrow(run, SEGMENT)


SEGMENT = "minimizer long, id long, content long, start int, last int, digest long"


def single_strings(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Each string of the segments as a segment of its own."""

    def cut(text: bytes, part: dict) -> list[tuple]:
        places = range(part["start"], part["last"] + 1)
        return [(part["minimizer"], i, i, xxhash.xxh3_64_intdigest(text[i : i + length])) for i in places]

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                texts = bytes_of(piece.column("text"))
                for i, (text, parts) in enumerate(zip(texts, piece.column("parts").to_pylist(), strict=True)):
                    made = [row for p in parts for row in cut(text, p)]
                    owner = pa.array([i] * len(made), pa.int32())
                    columns = list(zip(*made, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(columns[0], pa.int64()), piece.column("id").take(owner), piece.column("content").take(owner),
                            pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()),
                            pa.array(np.array(columns[3], dtype=np.uint64).view(np.int64)),
                        ],
                        names=["minimizer", "id", "content", "start", "last", "digest"],
                    )

    return _with_texts(rows, docs).mapInArrow(run, SEGMENT)


def _with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """id, content, text and parts (start, last, minimizer) of the documents that hold the segments.

    Rows with the same id and text are one document: it comes once.
    """
    parts = rows.groupBy("id", "content").agg(F.collect_list(F.struct("start", "last", "minimizer")).alias("parts"))
    joined = docs.select("id", "content", "text").join(parts, ["id", "content"])
    return joined.dropDuplicates(["id", "content"])


def repeated_in_shards(different: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Covered stretches (id, content, begin, end) among segments of one minimizer that differ, by suffix arrays."""
    total = different.agg(F.coalesce(F.sum(F.col("last") - F.col("start") + length), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / SHARD_BYTES))

    def cut(batches):
        for batch in batches:
            for piece in slices(batch):
                texts = bytes_of(piece.column("text"))
                parts = piece.column("parts").to_pylist()
                rows = [(i, p["minimizer"], p["start"], texts[i][p["start"] : p["last"] + length]) for i, own in enumerate(parts) for p in own]
                owner = pa.array([r[0] for r in rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[1] % shards for r in rows], pa.int32()), piece.column("id").take(owner), piece.column("content").take(owner),
                        pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary()),
                    ],
                    names=["shard", "id", "content", "start", "bytes"],
                )

    def sort(frame):
        frame = frame.sort_values(["id", "content", "start"], ignore_index=True)
        which, offset = repeated_strings([bytes(b) for b in frame["bytes"]], length)
        begin = frame["start"].to_numpy()[which] + offset
        columns = {"id": frame["id"].to_numpy()[which], "content": frame["content"].to_numpy()[which], "begin": begin, "end": begin + length}
        return type(frame)(columns)

    cuts = _with_texts(different, docs).mapInArrow(cut, "shard int, id long, content long, start int, bytes binary")
    return cuts.groupBy("shard").applyInPandas(sort, "id long, content long, begin int, end int")


def repeated_strings(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and offset of every string of `length` bytes that also starts in an earlier part, or earlier in the same.

    Strings whose hash occurs once are left out before anything is sorted; what is equal is decided by the sorting.
    """
    owner, begin, stretches = _may_repeat(parts, length)
    if not stretches:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    which, offset = _sorted_repeats(stretches, length)
    return owner[which], begin[which] + offset


def _may_repeat(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Stretches of the parts, in order, that hold all strings whose hash occurs more than once: part, offset, bytes."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
    if len(flat) < length:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), []
    hashes = _gram_hashes(flat, length)
    part = np.searchsorted(starts, np.arange(len(hashes)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(hashes)) + length <= (starts + sizes)[part])
    order = inside[np.argsort(hashes[inside], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    often = np.zeros(len(hashes) + 1, dtype=bool)
    often[order[1:][same]] = often[order[:-1][same]] = True
    at = np.flatnonzero(often)
    if not len(at):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), []
    new = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (part[at[1:]] != part[at[:-1]])])
    first, last = at[new], at[np.r_[new[1:] - 1, len(at) - 1]]
    data = flat.tobytes()
    stretches = [data[a : b + length] for a, b in zip(first.tolist(), last.tolist(), strict=True)]
    return part[first], first - starts[part[first]], stretches


def _sorted_repeats(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and offset of every string that also starts earlier, by the suffix array of all parts."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    flat = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    text = flat.astype(np.int64) + 2
    text[starts + sizes] = 1  # between parts
    order = suffix_array(text)
    part = np.searchsorted(starts, order, side="right") - 1
    whole = order + length <= starts[part] + sizes[part]
    order, part = order[whole], part[whole]
    # suffixes that share `length` bytes stand next to each other
    same = np.zeros(len(order), dtype=bool)
    for a in range(1, len(order), 200_000):
        b = min(a + 200_000, len(order))
        equal = np.ones(b - a, dtype=bool)
        for i in range(0, length, 10):
            at = np.flatnonzero(equal)
            j = np.arange(i, min(i + 10, length))
            equal[at] = (flat[order[a + at][:, None] + j] == flat[order[a + at - 1][:, None] + j]).all(axis=1)
        same[a:b] = equal
    group = np.cumsum(~same)
    first = np.full(int(group[-1]) + 1 if len(group) else 1, len(flat), dtype=np.int64)
    np.minimum.at(first, group, order)
    later = order != first[group]
    return part[later], (order - starts[part])[later]


def remove_repeated(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) of every row."""
    if length < GRAM + 2:
        raise ValueError(f"strings of fewer than {GRAM + 2} bytes have no minimizer")
    rows_of = keyed(docs, id_col, text_col)
    # tables that are joined are written first: Spark can then split the large partitions of a frequent key
    shared = staged(minimizer_counts(rows_of, length), "minimizers")
    rows = staged(segments(rows_of, length).join(shared, "minimizer", "left_semi"), "segments")
    release(shared)
    first = staged(_first_of_equal(rows), "first-segments")
    covered = [staged(_copies(rows, first, length), "copies")]
    release(rows)
    kinds = staged(first.groupBy("minimizer").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    several = staged(first.join(kinds, "minimizer"), "different-segments")
    release(first, kinds)
    covered.append(staged(repeated_in_shards(several.where(F.col("kinds") <= MANY), rows_of, length), "repeated"))
    crowded = several.where(F.col("kinds") > MANY)
    if not crowded.isEmpty():
        strings = staged(single_strings(crowded, rows_of, length), "single-strings")
        first = staged(_first_of_equal(strings), "first-strings")
        covered.append(staged(_copies(strings, first, length), "repeated-strings"))
        release(strings, first)
    release(several)
    marks = covered[0]
    for more in covered[1:]:
        marks = marks.unionByName(more)
    marks = marks.groupBy("id", "content").agg(F.collect_list(F.struct("begin", "end")).alias("marks"))
    marks = staged(marks, "marks")
    release(*covered)
    marked = rows_of.join(marks, ["id", "content"], "left").select("doc_id", "text", "marks")
    return marked.mapInArrow(_cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def _first_of_equal(rows: DataFrame) -> DataFrame:
    place = F.min(F.struct("id", "content", "start", "last")).alias("at")
    return rows.groupBy("minimizer", "digest").agg(place).select("minimizer", "digest", "at.*")


def _copies(rows: DataFrame, first: DataFrame, length: int) -> DataFrame:
    """What the segments equal to an earlier one cover."""
    known = first.select("minimizer", "digest", F.struct("id", "content", "start").alias("at"))
    later = rows.join(known, ["minimizer", "digest"]).where(F.struct("id", "content", "start") != F.col("at"))
    return later.select("id", "content", F.col("start").alias("begin"), (F.col("last") + length).cast("int").alias("end"))


def covered_spans(marks: np.ndarray) -> np.ndarray:
    """Maximal runs of bytes inside any mark; touching marks are one run."""
    marks = marks[np.argsort(marks[:, 0], kind="stable")]
    end = np.maximum.accumulate(marks[:, 1])
    new = np.flatnonzero(np.r_[True, marks[1:, 0] > end[:-1]])
    return np.column_stack([marks[new, 0], end[np.r_[new[1:] - 1, len(marks) - 1]]])


def _cut_out(batches):
    for batch in batches:
        for part in slices(batch):
            rows = []
            for text, marks in zip(bytes_of(part.column("text")), part.column("marks").to_pylist(), strict=True):
                if not marks:
                    rows.append((len(text), 0, 0, text))
                    continue
                spans = covered_spans(np.array([(m["begin"], m["end"]) for m in marks], dtype=np.int64))
                edges = [0, *spans.reshape(-1).tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((len(text), len(text) - len(kept), len(spans), kept))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def report(found: DataFrame) -> DataFrame:
    """The result with the digest of the bytes left instead of the bytes."""
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
