"""Text to vector, through a provider chosen by the caller.

A provider either builds a Column (:class:`ColumnProvider`), or transforms a DataFrame, or runs a model in Python on
Arrow batches (:class:`PythonProvider`). The texts are checked first; one bad text never fails the others.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import EmbeddingError
from semstore.functions import vectors
from semstore.operators.quality import text_reason
from semstore.plans import sizing, workspace


class Provider:
    """Turns the text column of a DataFrame into ``vector``, and ``error`` where that failed.

    ``sound`` says that every vector made is one of finite numbers, which saves the check.
    """

    sound = False

    def apply(self, df: DataFrame, text_col: str) -> DataFrame:
        """Add ``vector`` and ``error``; rows whose ``error`` is set already are passed on as they are."""
        raise NotImplementedError

    def embed_one(self, spark: SparkSession, text: str) -> DataFrame:
        """The vector of a single text, as a one-row DataFrame."""
        one = spark.range(1).select(F.lit(text).alias("text"))
        return embed(one, self, "text", spread=False).select("vector")


class ColumnProvider(Provider):
    """A provider written as a Column expression; it runs in the JVM with the rest of the plan."""

    def column(self, text: Column) -> Column:
        raise NotImplementedError

    def apply(self, df: DataFrame, text_col: str) -> DataFrame:
        vector = F.when(F.col("error").isNull(), self.column(F.col(text_col)))
        # Filters are not pushed through a generator: the vector is computed once, whatever is asked of it later.
        return df.select("*", F.explode(F.array(vector)).alias("vector"))


NO_WORDS = "text_without_known_words"
#: Texts to vectors: a matrix with a row per text, and the errors of the texts that have no vector.
Model = Callable[[Sequence[str]], tuple[list | np.ndarray, list[str | None]]]


def _in_arrow(df: DataFrame, text_col: str, load: Callable[[], Model], batch_size: int) -> DataFrame:
    """Add what a model makes of the texts without an error; it is loaded once per task.

    Rows go on as soon as the model has seen ``batch_size`` texts, so a task holds no more results than that.
    """
    workspace.ship_package(df.sparkSession)
    names = [c for c in df.columns if c != "error"]
    schema = T.StructType(
        [df.schema[c] for c in names]
        + [T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            model = load() if model is None else model
            texts = batch.column(batch.schema.get_field_index(text_col))
            errors = batch.column(batch.schema.get_field_index("error")).to_pylist()
            open_ = [i for i, error in enumerate(errors) if error is None]
            done = 0
            for start in range(0, max(1, len(open_)), batch_size):
                part = open_[start : start + batch_size]
                end = open_[start + batch_size] if start + batch_size < len(open_) else batch.num_rows
                made: list = [None] * (end - done)
                vectors_, failed = model(texts.take(pa.array(part)).to_pylist()) if part else ([], [])
                for i, vector, error in zip(part, vectors_, failed, strict=True):
                    made[i - done], errors[i] = vector if error is None else None, error
                rows = batch.slice(done, end - done)
                columns = [rows.column(batch.schema.get_field_index(c)) for c in names]
                columns += [pa.array(made, pa.list_(pa.float64())), pa.array(errors[done:end], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "vector", "error"])
                done = end

    return df.select(*names, "error").mapInArrow(work, schema)


#: Words that a worker remembers the places of.
_REMEMBERED = 1 << 17
#: Texts hashed together.
_TEXTS = 1_024
#: About how many characters are cut into words together.
_TOGETHER = 1 << 21
_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")


class _Places(dict):
    """The place of every word met so far: a number from its MD5, modulo the dimension."""

    def __init__(self, dim: int) -> None:
        super().__init__()
        self.dim = dim
        self._in_word = np.zeros(sys.maxunicode + 1, dtype=np.int8)  # of a character: 1 or -1 once it is known

    def __missing__(self, word: str) -> int:
        place = int.from_bytes(hashlib.md5(word.encode(errors="replace"), usedforsecurity=False).digest()[:4]) % self.dim
        if len(word) <= 64:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = place
        return place

    def counts(self, texts: Sequence[str]) -> np.ndarray:
        """How many words of each text fall on each place, a row per text."""
        found = np.zeros((len(texts), self.dim), dtype=np.int64)
        rows: list[int] = []
        pieces: list[str] = []
        size = 0
        for row, text in enumerate(texts):
            for piece in _pieces(text.lower()):
                if pieces and size + len(piece) > _TOGETHER:
                    self._add(found, rows, pieces)
                    rows, pieces, size = [], [], 0
                rows.append(row)
                pieces.append(piece)
                size += len(piece)
        if pieces:
            self._add(found, rows, pieces)
        return found

    def _add(self, found: np.ndarray, rows: list[int], pieces: list[str]) -> None:
        """Add the words of pieces of texts, whose rows do not descend; each distinct word is looked up once."""
        joined = "\n".join(pieces)
        try:
            codec, unit = "latin-1", np.uint8
            chars = np.frombuffer(joined.encode(codec), dtype=unit)
        except UnicodeEncodeError:
            codec, unit = "utf-32-le", np.uint32
            chars = np.frombuffer(joined.encode(codec, "surrogatepass"), dtype=unit)
        inside = self._inside(chars)
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return
        kept = chars[inside]
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * kept.itemsize
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)]).dictionary_encode()
        _, offsets, content = words.dictionary.buffers()
        bounds = (np.frombuffer(offsets, dtype=np.int64, count=len(words.dictionary) + 1) // kept.itemsize).tolist()
        distinct = content.to_pybytes().decode(codec, "surrogatepass")
        places = np.array([self[distinct[i:j]] for i, j in itertools.pairwise(bounds)], dtype=np.int64)
        # a piece and the line feed behind it
        piece = np.searchsorted(np.cumsum([len(p) + 1 for p in pieces]), starts, side="right")
        first, last = rows[0], rows[-1]
        cells = (np.asarray(rows)[piece] - first) * self.dim + places[words.indices.to_numpy()]
        found[first : last + 1] += np.bincount(cells, minlength=(last - first + 1) * self.dim).reshape(-1, self.dim)

    def _inside(self, chars: np.ndarray) -> np.ndarray:
        """Which characters belong to words; the pattern of a word is asked once per character."""
        known = self._in_word[chars]
        for char in np.unique(chars[known == 0]).tolist():
            self._in_word[char] = 1 if _WORD.match(chr(char)) else -1
        return self._in_word[chars] > 0


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of some length that end between words."""
    start = 0
    while len(text) - start > _TOGETHER:
        gap = _GAP.search(text, start + _TOGETHER)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end
    yield text[start:] if start else text


class HashingProvider(Provider):
    """Hashed bag of all words of a text, weighted by inverse document frequency and normalised; needs no outside model.

    The place of a word is the number in the first eight hexadecimal digits of its MD5, modulo the dimension; a worker
    works it out once per word. A text whose vector would be zero (no word, or only words that every document has) gets
    an error instead.
    """

    sound = True

    def __init__(self, weights: Sequence[float]) -> None:
        self.weights = np.asarray(weights, dtype=np.float64)
        self.dim = len(self.weights)

    @classmethod
    def fit(cls, df: DataFrame, text_col: str = "text", dim: int = 256) -> HashingProvider:
        """Learn the weights of the places from a corpus, in one pass over it."""
        if dim < 1:
            raise EmbeddingError("dimensions must be a positive number")
        workspace.ship_package(df.sparkSession)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places, found = _Places(dim), np.zeros(dim + 1, dtype=np.int64)
            for batch in batches:
                found[dim] += batch.num_rows
                for start in range(0, batch.num_rows, _TEXTS):
                    texts = batch.column(0).slice(start, _TEXTS).drop_null().to_pylist()
                    found[:dim] += (places.counts(texts) > 0).sum(axis=0)
            # a row per place and task
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1)), pa.array(found)], names=["place", "n"])

        docs = sizing.spread(df.select(F.col(text_col).cast("string").alias("text")))
        counted = docs.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
        found = {r["place"]: r["n"] for r in counted}
        total = found.get(dim, 0)
        return cls([math.log((total + 1) / (found.get(i, 0) + 1)) for i in range(dim)])

    def apply(self, df: DataFrame, text_col: str) -> DataFrame:
        weights = self.weights

        def load() -> Model:
            places = _Places(len(weights))

            def embed_all(texts: Sequence[str]) -> tuple[np.ndarray, list[str | None]]:
                made = places.counts(texts) * weights
                norms = np.sqrt((made**2).sum(axis=1))
                unit = np.divide(made, norms[:, None], out=made, where=norms[:, None] > 0)
                return unit, [None if n > 0 else NO_WORDS for n in norms]

            return embed_all

        return _in_arrow(df, text_col, load, _TEXTS)


class PythonProvider(Provider):
    """A model run in Python. ``load`` is called once per task and returns a function from texts to vectors."""

    def __init__(self, load: Callable[[], Callable[[Sequence[str]], Sequence]], batch_size: int = 100) -> None:
        if batch_size < 1:
            raise EmbeddingError("the batch size must be a positive number")
        self._load = load
        self._batch_size = batch_size

    def apply(self, df: DataFrame, text_col: str) -> DataFrame:
        load = self._load

        def careful() -> Model:
            model = load()
            return lambda texts: tuple(zip(*_attempt(model, list(texts)), strict=True))

        return _in_arrow(df, text_col, careful, self._batch_size)


def _attempt(model: Callable, texts: list[str]) -> list[tuple[list[float] | None, str | None]]:
    """Embed together; when that fails, half by half, so that only the bad texts get an error."""
    try:
        made = model(texts)
        if len(made) != len(texts):
            raise ValueError(f"{len(made)} vectors for {len(texts)} texts")
        return [(np.asarray(v, dtype=np.float64).tolist(), None) for v in made]
    except Exception as failure:  # noqa: BLE001 - whatever a model raises becomes the error of its text
        if len(texts) == 1:
            return [(None, str(failure) or type(failure).__name__)]
        half = len(texts) // 2
        return _attempt(model, texts[:half]) + _attempt(model, texts[half:])


def embed(
    df: DataFrame, provider: Provider, text_col: str = "text", *, spread: bool = True, max_length: int | None = None
) -> DataFrame:
    """Add ``vector`` (NULL on failure) and ``error`` (NULL on success) to every row; by default texts of any length."""
    df = sizing.spread(df) if spread else df
    made = provider.apply(df.withColumn("error", text_reason(F.col(text_col), max_length)), text_col)
    if provider.sound:
        return made.select(*[c for c in made.columns if c not in ("vector", "error")], "vector", "error")
    v = F.col("vector")
    broken = (
        F.when(v.isNull() | (F.size(v) < 1), F.lit("no_vector"))
        .when(vectors.has_bad_element(v), F.lit("vector_not_finite"))
        .otherwise(F.lit(None))
    )
    made = made.withColumn("error", F.coalesce("error", broken))
    return made.withColumn("vector", F.when(F.col("error").isNull(), v))


def embed_once(
    df: DataFrame, provider: Provider, store: str, text_col: str = "text", *, max_length: int | None = None
) -> DataFrame:
    """Like ``embed``, but every distinct text is embedded once, over all batches that share the folder ``store``.

    Texts are told apart by their SHA-256. The vectors of new texts are added to the store; those of texts that failed
    are not, so that they are tried again. Two batches at a time may embed a text twice, which changes no result.
    A store belongs to one provider.
    """
    key = F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)).alias("_key")
    hashed = workspace.staged(df.select("*", key), "hashed-texts")
    # one row per text and task before anything is shuffled, however often a text occurs
    texts = hashed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.first(text_col).alias("text"))
    known = _stored(df.sparkSession, store)
    made = embed(texts.join(known.select("_key"), "_key", "left_anti"), provider, "text", spread=False, max_length=max_length)
    made = workspace.staged(made.select("_key", "vector", "error"), "new-vectors")
    good = made.where(F.col("error").isNull()).select("_key", "vector")
    good.sortWithinPartitions("_key").write.mode("append").option("parquet.bloom.filter.enabled#_key", "true").parquet(store)
    wanted = _stored(df.sparkSession, store).join(hashed.select("_key").distinct(), "_key", "left_semi").dropDuplicates(["_key"])
    # written before the join, so that the many rows of a frequent text can be split
    found = wanted.select("_key", "vector", F.lit(None).cast("string").alias("error"))
    found = workspace.staged(found.unionByName(made.where(F.col("error").isNotNull())), "vectors-of-batch")
    joined = hashed.join(found, "_key", "left")
    reason = F.coalesce("error", F.when(F.col("_key").isNull(), text_reason(F.col(text_col), max_length)))
    return joined.select(*[f"`{c}`" for c in df.columns], "vector", reason.alias("error"))


def _stored(spark: SparkSession, store: str) -> DataFrame:
    """The vectors of a store; none before the first batch."""
    schema = "_key binary, vector array<double>"
    return spark.read.schema(schema).parquet(store) if workspace.exists(spark, store) else spark.createDataFrame([], schema)
