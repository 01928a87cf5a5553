"""Substring deduplication by sliding sentence spans.

A text is cut into sentences at end marks and line breaks. Where WINDOW words in a row have no such end, the sentence is
also cut after the one with the smallest hash (winnowing), so that a cut depends on the WINDOW - 1 words around it only,
and the same passage is cut alike wherever it stands. The shortest run of at least `run` sentences and `least_words`
words that begins at a sentence, and the shortest that ends there, are spans. They are hashed and counted over the whole
corpus; a sentence is removed if it is covered by a repeated span that is not the first of its kind (by doc_id, then
place).

Any 50 words in a row hold a whole span: cuts are alike from the 8th word on, one is among the words 8 to 15, the span
that begins there ends 20 to 27 words later, and cuts are alike up to the 43rd word. What is left of a repeated passage
are the cut sentences at its edges, at most 2 * WINDOW - 1 words each. In scripts without spaces a character is a word.

Defined cases: null and empty texts have no sentences; texts of any length are cut whole; sentences of punctuation only
belong to the one before. Rows without an id come after all ids below 2**62. Rows with the same id and text are one document, returned as often as they occur; rows with the same id and different texts are ordered by a hash of the text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import keyed, mix, release, slices, staged, texts_of

RUN, LEAST_WORDS = 3, 20
#: Of so many words in a row, at least one ends a sentence or is cut after.
WINDOW = 8
#: Hashes of words that a worker remembers.
REMEMBERED = 1 << 18

#: Characters of scripts without spaces: Thai to Tibetan, Myanmar, Khmer, kana, Han, and their wide forms.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ENDS = ".!?\u3002\uff01\uff1f"
#: A word, or a character without spaces, with the end marks and the white space after it.
_WORD = re.compile(rf"\s*(?:[{_UNSPACED}][{_ENDS}]*|[^\s{_ENDS}{_UNSPACED}]+[{_ENDS}]*|[{_ENDS}]+)\s*")
_END = re.compile(rf"[{_ENDS}]\s*$|\n")
#: Odd multiplier of the hashes of spans, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C17
_INVERSE = pow(_BASE, -1, 1 << 64)
_LAST = 0x632BE59BD9B4E018


class _Hashes(dict):
    """By word with what follows it: a hash whose lowest bit is 1 for one that ends a sentence."""

    def __missing__(self, word: str) -> int:
        # of line breaks, only those after the word are ends
        ends = _END.search(word.lstrip()) is not None
        found = xxhash.xxh3_64_intdigest(word.strip().lower().encode(errors="replace")) & ~1 | ends
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


_hashes = _Hashes()


class _Powers:
    """Powers of the base of spans' hashes and of its inverse, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 4096)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, dtype=np.uint64)]) for b in (_BASE, _INVERSE))
        return self.up, self.down


_powers = _Powers()


def cut(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, their hashes, and the numbers of words up to the end of each sentence, long ones cut further."""
    words = _WORD.findall(text)
    n = len(words)
    value = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=n)
    if not n:
        return words, value, np.empty(0, dtype=np.int64)
    ends = (value & np.uint64(1)).astype(bool)
    if n >= WINDOW:
        # an end is the smallest; of equal words the last
        small = np.where(ends, np.uint64(0), (value >> np.uint64(34)) + np.uint64(1))
        least = (small << np.uint64(33)) | np.arange(n - 1, -1, -1, dtype=np.uint64)
        have = 1
        while have < WINDOW:
            step = min(have, WINDOW - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        ends[n - 1 - (least & np.uint64((1 << 33) - 1)).astype(np.int64)] = True
    ends[-1] = True
    return words, value, np.flatnonzero(ends) + 1


def pieces(text: str) -> list[str]:
    """Sentences, long ones cut further; together they are the text."""
    words, _, ends = cut(text)
    if not words:
        return [text] if text else []
    at = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))[ends - 1].tolist()
    return [text[a:b] for a, b in zip([0, *at], at, strict=False)]


def spans(value: np.ndarray, sizes: np.ndarray, run: int = RUN, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows (hash, first sentence, end) of the shortest spans that begin, and that end, at each sentence.

    From the hashes of the words, and the numbers of words up to the end of each sentence.
    """
    n = len(sizes)
    sizes = np.r_[0, sizes]
    every = np.arange(n)
    ends = np.maximum(every + run, np.searchsorted(sizes, sizes[:-1] + least_words))
    starts = np.minimum(every + 1 - run, np.searchsorted(sizes, sizes[1:] - least_words, side="right") - 1)
    forward, backward = ends <= n, starts >= 0
    # as one number each, start first
    both = np.unique(np.concatenate([(every << 32 | ends)[forward], (starts << 32 | every + 1)[backward]]))
    start, end = both >> 32, both & 0xFFFFFFFF
    # sums of the hashes times powers of a base; those before a span are taken off and the power of its start is divided out
    up, down = _powers.of(len(value) + 1)
    with np.errstate(over="ignore"):
        before = np.zeros(len(value) + 1, dtype=np.uint64)
        # equal spans are cut alike: the last word of a sentence is another one than the same word inside
        own = value | np.uint64(1)
        own[sizes[1:] - 1] ^= np.uint64(_LAST)
        np.cumsum(own * up[: len(value)], out=before[1:])
        hashes = mix((before[sizes[end]] - before[sizes[start]]) * down[sizes[start]])
    return np.column_stack([hashes.view(np.int64), start, end])


def hashed_spans(docs: DataFrame, run: int, least_words: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for part in slices(batch):
                found, sizes = [], []
                for text in texts_of(part.column("text")):
                    _, value, ends = cut(text)
                    found.append(spans(value, ends, run, least_words))
                    sizes.append(len(ends))
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                table = np.concatenate(found)
                # after the spans, a row without a hash for each text: how many sentences it has
                owner = pa.array(np.r_[rows, np.arange(len(found))])
                counted = np.r_[table[:, 2], np.array(sizes, dtype=np.int64)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[table[:, 0], np.zeros(len(found), dtype=np.int64)], mask=np.r_[np.zeros(len(table), bool), np.ones(len(found), bool)]),
                        part.column("id").take(owner), part.column("content").take(owner),
                        pa.array(np.r_[table[:, 1], np.zeros(len(found), dtype=np.int64)].astype(np.int32)), pa.array(counted),
                    ],
                    names=["span", "id", "content", "start", "end"],
                )

    return docs.select("id", "content", "text").mapInArrow(work, "span long, id long, content long, start int, end int")


def remove_repeated(
    docs: DataFrame, *, run: int = RUN, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_removed_words, kept_text of every row."""
    rows_of = keyed(docs, id_col, text_col)
    cut_once = staged(hashed_spans(rows_of, run, least_words), "spans")
    found = cut_once.where(F.col("span").isNotNull())
    place = F.struct("id", "content", "start")
    # tables that are joined are written first: Spark can then split the large partitions of a frequent span
    often = staged(found.groupBy("span").agg(F.count("*").alias("n")).where("n > 1").select("span"), "often")
    again = staged(found.join(often, "span", "left_semi"), "repeated-spans")
    sizes = cut_once.where(F.col("span").isNull()).select("id", "content", F.lit(None).cast("int").alias("start"), "end")
    sizes = staged(sizes, "sentences")
    release(cut_once, often)
    first = staged(again.groupBy("span").agg(F.min(place).alias("first")), "first-spans")
    later = again.join(first, "span").where(place != F.col("first"))
    mark = F.when(F.col("start").isNotNull(), F.struct("start", "end"))
    size = F.max(F.when(F.col("start").isNull(), F.col("end")))
    marks = later.select("id", "content", "start", "end").unionByName(sizes).groupBy("id", "content")
    marks = staged(marks.agg(F.collect_set(mark).alias("marks"), size.alias("size")), "marks")
    release(again, first, sizes)
    marked = rows_of.join(marks, ["id", "content"], "left")

    def work(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                columns = (part.column(c).to_pylist() for c in ("marks", "size"))
                for text, own, size in zip(texts_of(part.column("text")), *columns, strict=True):
                    rows.append(_without(text, own) if own else (size, 0, 0, text))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                    names=["doc_id", "n_sentences", "n_removed", "n_removed_words", "kept_text"],
                )

    schema = "doc_id long, n_sentences long, n_removed long, n_removed_words long, kept_text string"
    return marked.select("doc_id", "text", "marks", "size").mapInArrow(work, schema)


def _without(text: str, marks: list[dict]) -> tuple[int, int, int, str]:
    """Number of sentences, of those in any mark and of their words, and the text without them."""
    words, _, ends = cut(text)
    gone = np.zeros(len(ends), dtype=bool)
    for mark in marks:
        gone[mark["start"] : mark["end"]] = True
    counts = np.diff(ends, prepend=0)
    kept = "".join(w for w, out in zip(words, np.repeat(gone, counts).tolist(), strict=True) if not out)
    return len(ends), int(gone.sum()), int(counts[gone].sum()), kept


def report(found: DataFrame) -> DataFrame:
    """The result with the digest of the kept text instead of the text."""
    return found.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")
