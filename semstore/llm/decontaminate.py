"""Benchmark decontamination by winnowing.

A benchmark window is `n` consecutive words of an item (a shorter item is one window). The fingerprint of a window is
the smallest hash of its `k`-word runs. Two equal windows have equal fingerprints, so the join of document and
benchmark fingerprints finds every shared span of `n` words; each hit is then compared word by word, and equal windows
mark their words in the document.

Defined cases: null and empty texts have no words; items without words are left out; items without an id mark words but
are not listed; items with the same id count once; documents are handled row by row, so repeated rows and ids stay.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.llm.common import bytes_of, id_and_text, ship_package, slices, staged, window_hashes

#: Benchmark text in one block: a block is what a task holds at once. More text makes more blocks.
BLOCK_BYTES = 16 << 20
WINDOW, GRAM = 13, 5

#: A-Z become small, all other ASCII characters but letters and digits become spaces; UTF-8 bytes of others stay.
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

RESULT = "doc_id long, n_words long, n_hit long, items array<string>"
PARTIAL = "row long, doc_id long, n_words long, spans array<int>, items array<string>"


def words(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


@dataclass
class Windows:
    """The distinct benchmark windows of one length, by hash, with the items in which they occur."""

    length: int
    gram: int
    fingerprints: np.ndarray
    hashes: np.ndarray
    content: np.ndarray
    first: np.ndarray
    items: np.ndarray

    @classmethod
    def build(cls, length: int, gram: int, content: np.ndarray, item: np.ndarray) -> Windows:
        pairs = np.unique(np.column_stack([content, item]), axis=0)
        content, item = pairs[:, :-1], pairs[:, -1]
        new = np.r_[True, (content[1:] != content[:-1]).any(axis=1)]
        distinct = content[new]
        bounds = np.r_[np.flatnonzero(new), len(content)]
        hashes = _rows_hash(distinct, length)[:, 0]
        order = np.argsort(hashes, kind="stable")
        if (np.diff(hashes[order].astype(object)) == 0).any():
            raise ValueError("two benchmark windows have one hash")
        counts = np.diff(bounds)[order]
        first = np.r_[0, np.cumsum(counts)]
        rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in order]) if len(order) else order
        return cls(length, gram, np.unique(_fingerprint(distinct, gram)), hashes[order], distinct[order], first, item[rows])

    def find(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The starts at which a benchmark window occurs, and which window that is."""
        found, which = [], []
        for part in np.array_split(starts, max(1, math.ceil(len(starts) / 200_000))):
            content = ids[part[:, None] + np.arange(self.length)]
            hit = np.isin(_fingerprint(content, self.gram), self.fingerprints)
            part, content = part[hit], content[hit]
            hashes = _rows_hash(content, self.length)[:, 0]
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = (self.content[at] == content).all(axis=1)
            found.append(part[same])
            which.append(at[same])
        return np.concatenate(found), np.concatenate(which)


def _rows_hash(content: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` in each row."""
    n, length = content.shape
    flat = window_hashes(np.concatenate([content.reshape(-1), np.zeros(width - 1, dtype=content.dtype)]), width)
    return flat[: n * length].reshape(n, length)[:, : length - width + 1]


def _fingerprint(content: np.ndarray, gram: int) -> np.ndarray:
    return _rows_hash(content, gram).min(axis=1) if len(content) else np.empty(0, dtype=np.uint64)


@dataclass
class Index:
    """One block of the benchmark."""

    names: list[str | None]
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    windows: list[Windows] = field(default_factory=list)

    @classmethod
    def build(cls, items: list[tuple[str | None, str | None]], n: int, gram: int) -> Index:
        names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(names)} | {None: -1}
        out = cls(names)
        by_length: dict[int, list] = defaultdict(list)
        for name, text in items:
            ids = np.array([out.vocabulary.setdefault(w, len(out.vocabulary)) for w in words((text or "").encode())], dtype=np.int32)
            if len(ids):
                width = min(n, len(ids))
                content = np.lib.stride_tricks.sliding_window_view(ids, width)
                by_length[width].append((content, np.full(len(content), number[name], dtype=np.int32)))
        for width, parts in sorted(by_length.items()):
            content, item = (np.concatenate(x) for x in zip(*parts, strict=True))
            out.windows.append(Windows.build(width, min(gram, width), content, item))
        return out

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        """For each text: number of words, hit spans as (start, end) rows, names of the items found."""
        tokens = [words(t) for t in texts]
        counts = np.array([len(t) for t in tokens], dtype=np.int64)
        first = np.r_[0, np.cumsum(counts)]
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for t in tokens for w in t), dtype=np.int32, count=int(first[-1]))
        unknown = np.r_[0, np.cumsum(ids < 0)]
        left = np.repeat(first[1:], counts) - np.arange(len(ids))  # words from here to the end of the document
        spans: list[np.ndarray] = []
        pairs: list[np.ndarray] = []
        for w in self.windows:
            usable = np.flatnonzero(left >= w.length)
            usable = usable[unknown[usable + w.length] == unknown[usable]]
            starts, which = w.find(ids, usable)
            spans.append(np.column_stack([starts, starts + w.length]))
            doc = np.searchsorted(first, starts, side="right") - 1
            seen = np.unique(np.column_stack([doc, which]), axis=0)
            size = w.first[seen[:, 1] + 1] - w.first[seen[:, 1]]
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            pairs.append(np.column_stack([np.repeat(seen[:, 0], size), w.items[np.repeat(w.first[seen[:, 1]], size) + offset]]))
        spans_all = np.concatenate(spans) if spans else np.empty((0, 2), dtype=np.int64)
        spans_all = spans_all[np.argsort(spans_all[:, 0], kind="stable")]
        named = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), dtype=np.int64)
        named = named[named[:, 1] >= 0]
        cut = np.searchsorted(spans_all[:, 0], first)
        item_cut = np.searchsorted(named[:, 0], np.arange(len(texts) + 1))
        for i in range(len(texts)):
            items = [self.names[j] for j in named[item_cut[i] : item_cut[i + 1], 1].tolist()]
            yield int(counts[i]), merged(spans_all[cut[i] : cut[i + 1]] - first[i]), items


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping or touching spans, in order of their starts, as one each."""
    if len(spans) < 2:
        return spans
    end = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > end[:-1]]
    return np.column_stack([spans[new, 0], end[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]])


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The items, dealt by hash to blocks of about `block_bytes` of text."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / block_bytes))
    if n == 1:
        return [items]
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(block == i) for i in range(n)]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    n: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurring benchmark window), items (ids of the items found, sorted).

    The benchmark is the query set: it goes to the tasks in blocks of a fixed size, one pass over the documents each.
    """
    spark = docs.sparkSession
    source = id_and_text(docs, id_col, text_col)
    indexes = [
        spark.sparkContext.broadcast(Index.build([tuple(r) for r in block.toLocalIterator()], n, min(gram, n)))
        for block in benchmark_blocks(benchmark, item_id_col, item_text_col, block_bytes)
    ]
    if len(indexes) == 1:
        return source.mapInArrow(_whole(indexes[0]), RESULT)
    keyed = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = [keyed.mapInArrow(_partial(index, i == 0), PARTIAL) for i, index in enumerate(indexes)]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    rows = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return rows.mapInArrow(_join_spans, RESULT)


def _whole(index):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = list(index.value.scan(bytes_of(part.column("text"))))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([int((x[1][:, 1] - x[1][:, 0]).sum()) for x in found], pa.int64()),
                        pa.array([x[2] for x in found], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "n_hit", "items"],
                )

    return run


def _partial(index, everything: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = list(index.value.scan(bytes_of(part.column("text"))))
                out = pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([x[1].reshape(-1).tolist() for x in found], pa.list_(pa.int32())),
                        pa.array([x[2] for x in found], pa.list_(pa.string())),
                    ],
                    names=["row", "doc_id", "n_words", "spans", "items"],
                )
                yield out if everything else out.filter(pa.array([len(x[1]) > 0 for x in found], pa.bool_()))

    return run


def _join_spans(batches):
    for batch in batches:
        hits = []
        for flat in batch.column("spans").to_pylist():
            spans = np.array(flat, dtype=np.int64).reshape(-1, 2)
            spans = merged(spans[np.argsort(spans[:, 0], kind="stable")])
            hits.append(int((spans[:, 1] - spans[:, 0]).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(hits, pa.int64()), batch.column("items")],
            names=["doc_id", "n_words", "n_hit", "items"],
        )


def is_contaminated(n_hit, n_words, percent: int = 5):
    """The rule as a Column: some words are hit, and they are at least `percent` of all."""
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)


def contamination_report(found: DataFrame) -> DataFrame:
    """Digest columns of find_contamination()."""
    items = F.array_sort("items")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", percent: int = 5, n: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` of whose words fewer than `percent` in a hundred are hit, with all their columns.

    With a benchmark of one block, rows are judged where they are read. With more blocks each leaves its hit spans in a
    list that travels with the row, which is judged at the end.
    """
    blocks = benchmark_blocks(benchmark, "item_id", "text", block_bytes)
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)] + [T.StructField("spans", T.ArrayType(T.IntegerType()))])
    rows = docs.toDF(*schema.names[:-1]).withColumn("spans", F.array().cast("array<int>"))
    for i, block in enumerate(blocks):
        index = docs.sparkSession.sparkContext.broadcast(Index.build([tuple(r) for r in block.toLocalIterator()], n, min(gram, n)))
        rows = rows.mapInArrow(_add_spans(index, f"c{place}", percent if i == len(blocks) - 1 else None), schema)
        if i < len(blocks) - 1:
            rows = staged(rows, "spans")  # one block in a task at a time
    return rows.drop("spans").toDF(*docs.columns)


def _add_spans(index, text: str, percent: int | None):
    """Add the spans of this block; with `percent`, keep only the rows below it."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                joined, kept = [], []
                found = index.value.scan(bytes_of(part.column(text)))
                for (n_words, spans, _), before in zip(found, part.column("spans").to_pylist(), strict=True):
                    whole = np.concatenate([spans.reshape(-1, 2), np.array(before, dtype=np.int64).reshape(-1, 2)])
                    whole = merged(whole[np.argsort(whole[:, 0], kind="stable")])
                    hit = int((whole[:, 1] - whole[:, 0]).sum())
                    joined.append(whole.reshape(-1).tolist())
                    kept.append(percent is None or hit == 0 or 100 * hit < percent * n_words)
                columns = [*part.columns[:-1], pa.array(joined, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names).filter(pa.array(kept, pa.bool_()))

    return run
