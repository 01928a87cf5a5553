"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is cut where no piece of the vocabulary reaches across: before each run of spaces. In a segment, all adjacent
symbol pairs that form a piece stand in an agenda ordered by score, then by place; the first is merged until none is
left. Short segments of a batch are merged together, one step of each at a time, by array operations; long ones use a
heap. What the vocabulary does not have becomes bytes.

Every distinct segment of an Arrow batch is checked against the sentencepiece library. Where the two differ, the
library's ids are used and `n_differs` counts the segments. Decoding is the library's.

Defined cases: null and empty texts have only the begin and end ids; texts of any length are encoded whole; repeated
rows are encoded row by row. The vocabulary must use the identity normalisation with a leading space.
"""

from __future__ import annotations

import heapq
import re
import zlib
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from semstore.llm.common import id_and_text, sha256, slices, texts_of

SPACE = "▁"
#: Longest segment, in characters, that is merged by array operations.
SHORT = 32
#: Distinct segments remembered by a Python worker.
REMEMBERED = 300_000

RESULT = "doc_id long, n_tokens long, ids array<int>, decoded string, n_differs long"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_differs long"


class Vocabulary:
    """The merges of a model. Symbols are piece ids, then characters that occur in pieces only, then minus a code point."""

    def __init__(self, library: sentencepiece.SentencePieceProcessor) -> None:
        size = library.get_piece_size()
        plain = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        pieces = {library.id_to_piece(i): i for i in plain}
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.byte = {int(library.id_to_piece(i)[3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.unknown = library.unk_id()
        symbols = dict(pieces)
        self.extra: list[str] = []
        for char in sorted(set("".join(pieces)) - pieces.keys()):
            symbols[char] = size + len(self.extra)
            self.extra.append(char)
        self.size, self.total = size, size + len(self.extra)
        pairs = [
            (symbols[p[:i]] * self.total + symbols[p[i:]], number, library.get_score(number))
            for p, number in pieces.items()
            for i in range(1, len(p))
            if p[:i] in symbols and p[i:] in symbols
        ]
        pairs.sort()
        self.pair = np.array([x[0] for x in pairs], dtype=np.int64)
        self.merged = np.array([x[1] for x in pairs], dtype=np.int64)
        self.score = np.array([x[2] for x in pairs], dtype=np.float64)
        self.merges = {x[0]: (x[1], x[2]) for x in pairs}
        self.chars = {c: s for c, s in symbols.items() if len(c) == 1}
        self._bmp = np.array([self.chars.get(chr(c), -c) if c else 0 for c in range(0x10000)], dtype=np.int64)
        self._bmp[0] = self.chars.get("\0", -0x110000)

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        out = self._bmp[np.minimum(points, 0xFFFF)]
        for i in np.flatnonzero(points > 0xFFFF).tolist():
            out[i] = self.chars.get(chr(points[i]), -int(points[i]))
        return out

    def scores(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each pair, minus infinity where it forms no piece, and the piece."""
        key = np.where((left >= 0) & (right >= 0), left * self.total + right, -1)
        at = np.minimum(np.searchsorted(self.pair, key), max(len(self.pair) - 1, 0))
        found = self.pair[at] == key if len(self.pair) else np.zeros(key.shape, dtype=bool)
        return np.where(found, self.score[at], -np.inf), np.where(found, self.merged[at], 0)

    def expand(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final ids of symbols, and how many each has."""
        odd = (flat < 0) | (flat >= self.size)
        kinds, which = np.unique(flat[odd], return_inverse=True)
        lists = [self._fallback(s) for s in kinds.tolist()]
        counts = np.ones(len(flat), dtype=np.int64)
        starts = np.arange(len(flat))
        if len(kinds):
            sizes = np.array([len(x) for x in lists])
            counts[odd] = sizes[which]
            starts[odd] = len(flat) + (np.cumsum(sizes) - sizes)[which]
            flat = np.concatenate([flat, *(np.array(x, dtype=np.int64) for x in lists)])
        return _gather(flat, starts, counts), counts

    def _fallback(self, symbol: int) -> list[int]:
        char = self.extra[symbol - self.size] if symbol >= 0 else "\0" if symbol == -0x110000 else chr(-symbol)
        return [self.byte[b] for b in char.encode()] if self.byte else [self.unknown]


def _gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of `flat` that begin at `starts`, one after the other."""
    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


def merge_one(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """The agenda as a heap: pairs by score, then by place; entries whose symbols have changed are passed over."""
    merges, total = vocabulary.merges, vocabulary.total
    following = [*range(1, len(symbols)), -1]
    previous = [*range(-1, len(symbols) - 1)]
    alive = list(symbols)
    gone = -(1 << 40)
    agenda: list[tuple[float, int, int, int]] = []

    def add(left: int, right: int) -> None:
        a, b = alive[left], alive[right]
        if a >= 0 and b >= 0 and (made := merges.get(a * total + b)):
            heapq.heappush(agenda, (-made[1], left, right, a * total + b))

    for i in range(len(symbols) - 1):
        add(i, i + 1)
    while agenda:
        _, left, right, key = heapq.heappop(agenda)
        if following[left] != right or alive[left] < 0 or alive[left] * total + alive[right] != key:
            continue
        alive[left], alive[right] = merges[key][0], gone
        after = following[left] = following[right]
        if after >= 0:
            previous[after] = left
            add(left, after)
        if previous[left] >= 0:
            add(previous[left], left)
    return [s for s in alive if s != gone]


def merge_together(rows: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge all rows of symbols (each padded) step by step; the symbols left, in place, and how many there are."""
    rows, lengths = rows.copy(), lengths.copy()
    width = rows.shape[1]
    inside = np.arange(width - 1) < (lengths - 1)[:, None]
    score, piece = vocabulary.scores(rows[:, :-1], rows[:, 1:])
    score[~inside] = -np.inf
    open_ = np.arange(len(rows))
    columns = np.arange(width)
    while len(open_) and width > 1:
        best = score[open_].argmax(axis=1)
        usable = score[open_, best] > -np.inf
        open_, best = open_[usable], best[usable]
        if not len(open_):
            break
        own, own_score, own_piece = rows[open_], score[open_], piece[open_]
        every = np.arange(len(open_))
        own[every, best] = own_piece[every, best]
        shift = np.minimum(columns + (columns > best[:, None]), width - 1)
        own = np.take_along_axis(own, shift, axis=1)
        gap = shift[:, :-1].clip(max=width - 2)
        own_score, own_piece = np.take_along_axis(own_score, gap, axis=1), np.take_along_axis(own_piece, gap, axis=1)
        left = lengths[open_] - 1
        for place in (best - 1, best):
            fits = (place >= 0) & (place + 1 < left)
            at, j = every[fits], place[fits]
            own_score[at, j], own_piece[at, j] = vocabulary.scores(own[at, j], own[at, j + 1])
        own_score[columns[:-1] >= (left - 1)[:, None]] = -np.inf
        rows[open_], score[open_], piece[open_], lengths[open_] = own, own_score, own_piece, left
    return rows, lengths


class Encoder:
    """One model with the segments seen so far."""

    def __init__(self, model: bytes, remembered: int = REMEMBERED) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.vocabulary = Vocabulary(self.library)
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = np.empty(0, dtype=np.int32)
        self._starts = np.empty(0, dtype=np.int64)
        self._counts = np.empty(0, dtype=np.int64)
        self._differs = np.empty(0, dtype=bool)

    def segments(self, text: str) -> list[str]:
        """Segments without their leading space mark."""
        if not text:
            return []
        if self.vocabulary.crossing:
            return [text.replace(" ", SPACE)]
        if "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [s[1:] for s in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))]

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after the other, and how many each has."""
        vocabulary = self.vocabulary
        marked = [SPACE + s for s in segments]
        lengths = np.array([len(s) for s in marked])
        flat = vocabulary.symbols("".join(marked))
        starts = np.cumsum(lengths) - lengths
        symbols: list = [None] * len(marked)
        parts, owners, counts = [], [], np.zeros(len(marked), dtype=np.int64)
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, SHORT)):
            own = np.flatnonzero((lengths > low) & (lengths <= high))
            if not len(own):
                continue
            width = int(lengths[own].max())
            at = np.minimum(starts[own][:, None] + np.arange(width), len(flat) - 1)
            rows, left = merge_together(np.where(np.arange(width) < lengths[own][:, None], flat[at], -1), lengths[own], vocabulary)
            parts.append(rows[np.arange(width) < left[:, None]])
            owners.append(own)
            counts[own] = left
        for i in np.flatnonzero(lengths > SHORT).tolist():
            symbols = merge_one(flat[starts[i] : starts[i] + lengths[i]].tolist(), vocabulary)
            parts.append(np.array(symbols, dtype=np.int64))
            owners.append(np.array([i]))
            counts[i] = len(symbols)
        # back into the order of the segments
        order = np.concatenate(owners)
        placed = np.empty(len(marked), dtype=np.int64)
        sizes = counts[order]
        placed[order] = np.cumsum(sizes) - sizes
        merged = _gather(np.concatenate(parts), placed, counts)
        ids, each = vocabulary.expand(merged)
        bounds = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(counts)]]
        return ids, np.diff(bounds)

    def learn(self, segments: list[str]) -> None:
        """Encode new segments and check them against the library."""
        ids, counts = self.merge(segments)
        expected = self.library.encode(segments, num_threads=1)
        sizes = np.array([len(x) for x in expected])
        theirs = np.fromiter(chain.from_iterable(expected), dtype=np.int64, count=int(sizes.sum()))
        differs = np.zeros(len(segments), dtype=bool)
        empty = np.array([not s for s in segments])  # the library has no leading space for an empty text
        if not np.array_equal(np.where(empty, 0, counts), np.where(empty, 0, sizes)) or not np.array_equal(
            ids[~np.repeat(empty, counts)], theirs[~np.repeat(empty, sizes)]
        ):
            own = np.split(ids, np.cumsum(counts)[:-1])
            for i, them in enumerate(expected):
                if segments[i] and own[i].tolist() != them:
                    differs[i], own[i] = True, np.array(them, dtype=np.int64)
            ids, counts = np.concatenate(own), np.array([len(x) for x in own])
        first = len(self._known)
        self._known.update(zip(segments, range(first, first + len(segments)), strict=True))
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(counts) - counts])
        self._counts = np.concatenate([self._counts, counts])
        self._differs = np.concatenate([self._differs, differs])
        self._ids = np.concatenate([self._ids, ids.astype(np.int32)])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of each text with begin and end, and how many of its segments differ from the library's."""
        split = [self.segments(t) for t in texts]
        used = set(chain.from_iterable(split))
        new = used - self._known.keys()
        if len(self._known) + len(new) > self.remembered and self._known:
            self._forget()
            new = used
        if new:
            self.learn(sorted(new))
        sizes = np.array([len(s) for s in split])
        place = np.fromiter(map(self._known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
        ids = _gather(self._ids, self._starts[place], self._counts[place])
        bounds = np.r_[0, np.cumsum(self._counts[place])][np.r_[0, np.cumsum(sizes)]]
        wrong = np.r_[0, np.cumsum(self._differs[place])][np.r_[0, np.cumsum(sizes)]]
        begin, end = [self.library.bos_id()], [self.library.eos_id()]
        whole = [np.concatenate([begin, ids[a:b], end]) for a, b in zip(bounds, bounds[1:], strict=False)]
        return whole, np.diff(wrong).tolist()


_ENCODERS: dict[int, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The worker's encoder for a model; later tasks of the worker find its segments again."""
    key = zlib.crc32(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def encode(docs: DataFrame, model_path: str, *, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, decoded and n_differs for each row; with `digest`, SHA-256 of ids and decoded text instead."""
    source = id_and_text(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches):
        own = encoder(model.value)
        for batch in batches:
            for part in slices(batch):
                ids, differs = own.encode(texts_of(part.column("text")))
                decoded = own.library.decode([x.tolist() for x in ids], num_threads=1)
                columns = [part.column("doc_id"), pa.array([len(x) for x in ids], pa.int64())]
                if digest:
                    columns.append(pa.array([sha256(x.astype("<u4").tobytes()) for x in ids], pa.string()))
                    columns.append(pa.array([sha256(x.encode()) for x in decoded], pa.string()))
                else:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    columns.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, pa.array(differs, pa.int64())], names=names)

    schema = DIGEST if digest else RESULT
    names = [c.split()[0] for c in schema.split(", ")]
    return source.mapInArrow(run, schema)
