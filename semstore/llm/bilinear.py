"""Language-model scores by a log-bilinear neural model, trained by noise-contrastive estimation.

Two context words, each through its own matrix, predict a vector; its product with the vector of every word of the
model's vocabulary, plus a bias, gives the score, and the softmax over the vocabulary the probability. Words outside
the vocabulary share one entry; its probability is divided among them by their smoothed counts, so that the whole is a
distribution over all words.

For two context words the counts of word triples (as vocabulary entries) say everything the model can learn from a
corpus. They are counted over all training documents, dealt to shards, and in each round every shard goes on from the
same weights with gradient steps on its triples against noise words; the shards' weights are averaged. The normaliser
of a context is a product of matrices over the whole vocabulary, computed once per worker.

Counts of the most frequent words go to every task (a fixed number of words); those of all other words are joined by a
shuffle, in which no word is frequent.

Defined cases: null is an empty text, whose only token is the end; rows without an id are learned from and not held out;
repeated rows are scored row by row; with no training documents every count is 0.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import bytes_of, id_and_text, ship_package, slices, staged

#: Words of the model; words whose counts every task knows.
VOCABULARY, HEAD = 1_024, 1 << 17
#: Words or triples that a task counts before it passes them on.
HELD = 1 << 20
#: Triples are dealt to one shard for so many of them, and to SHARDS at most.
SHARD_TRIPLES, SHARDS = 1 << 16, 32
ROUNDS, PASSES = 3, 2
#: Least steps of a shard in a round.
LEAST_STEPS = 150
WIDTH, BATCH, NOISE = 24, 1_024, 64
RATE = 0.5
ADDED = 0.1


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 10, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word and n over all texts; tasks count before they shuffle."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in bytes_of(batch.column("text")):
                counts.update(tokens(text))
                if len(counts) >= HELD:
                    yield from _count_rows(counts)
                    counts = Counter()
        yield from _count_rows(counts)

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _count_rows(counts: Counter):
    names, values = list(counts), list(counts.values())
    for i in range(0, len(names), 50_000):
        words = pa.array(names[i : i + 50_000], pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(values[i : i + 50_000], pa.int64())], names=["word", "n"])


@dataclass
class Counts:
    """The head of the word counts, most frequent first, and what is needed of the rest."""

    words: list[bytes]
    n: np.ndarray
    ends: int
    total: int
    distinct: int
    vocabulary: int

    @classmethod
    def of(cls, counted: DataFrame, documents: int, vocabulary: int, head: int) -> Counts:
        rows = counted.orderBy(F.desc("n"), "word").limit(head).toPandas()
        total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        words = [w.encode() for w in rows["word"]]
        ends = int(documents)
        return cls(words, rows["n"].to_numpy(dtype=np.int64), ends, total + ends, distinct + (ends > 0), min(vocabulary, len(words)))

    @property
    def base_divisor(self) -> float:
        return self.total + ADDED * (self.distinct + 1)

    @property
    def rare_divisor(self) -> float:
        """The divisor among words outside the vocabulary."""
        rare = self.total - self.ends - int(self.n[: self.vocabulary].sum())
        kinds = self.distinct - (self.ends > 0) - self.vocabulary
        return rare + ADDED * (kinds + 1)

    # entries of the model: its words, then these
    @property
    def rare(self) -> int:
        return self.vocabulary

    @property
    def end(self) -> int:
        return self.vocabulary + 1

    @property
    def begin(self) -> int:
        """Stands before the text, in contexts only."""
        return self.vocabulary + 2

    def shares(self) -> np.ndarray:
        """Smoothed share of each entry that can be predicted."""
        own = np.r_[self.n[: self.vocabulary], self.total - self.ends - self.n[: self.vocabulary].sum(), self.ends] + 1.0
        return own / own.sum()

    def entries(self, parts: list[list[bytes]], place: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the head (-1 beyond) of all tokens with ends (-2), and the first of each text."""
        sizes = np.array([len(p) + 1 for p in parts])
        flat = np.fromiter((x for p in parts for x in (*map(place.get, p, [-1] * len(p)), -2)), dtype=np.int64, count=int(sizes.sum()))
        return flat, np.r_[0, np.cumsum(sizes)]

    def model_entries(self, head: np.ndarray) -> np.ndarray:
        return np.where(head == -2, self.end, np.where((head < 0) | (head >= self.vocabulary), self.rare, head))

    def contexts(self, own: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last and the second last entry before each token."""
        last = np.r_[self.begin, own[:-1]]
        last[first[:-1]] = self.begin
        before = np.r_[self.begin, last[:-1]]
        before[first[:-1]] = self.begin
        return last, before


def triple_counts(texts: DataFrame, counts) -> DataFrame:
    """code (second last, last, next entry) and n over all texts."""

    def run(batches):
        own = counts.value
        place = {w: i for i, w in enumerate(own.words[: own.vocabulary])}
        width = own.vocabulary + 3
        codes, sums = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                head, first = own.entries([tokens(t) for t in bytes_of(part.column("text"))], place)
                word = own.model_entries(head)
                last, before = own.contexts(word, first)
                kinds, n = np.unique((before * width + last) * width + word, return_counts=True)
                codes, sums = _merged(np.r_[codes, kinds], np.r_[sums, n])
                if len(codes) >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], names=["code", "n"])
                    codes, sums = codes[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], names=["code", "n"])

    return texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _merged(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, which = np.unique(codes, return_inverse=True)
    return kinds, np.bincount(which, weights=n, minlength=len(kinds)).astype(np.int64)


class LogBilinear:
    """Weights: context vectors, target vectors, a matrix for each context place, biases; with Adagrad's sums."""

    def __init__(self, entries: int, width: int, shares: np.ndarray, seed: int = 0) -> None:
        random = np.random.default_rng(seed)
        self.context = random.normal(0, 0.1, (entries, width))
        self.target = random.normal(0, 0.1, (len(shares), width))
        self.near, self.far = np.eye(width), np.eye(width) * 0.5
        self.bias = np.log(shares)
        self.sums = [np.full_like(w, 0.1) for w in self.weights]

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.context, self.target, self.near, self.far, self.bias]

    def pack(self) -> np.ndarray:
        return np.concatenate([w.reshape(-1) for w in (*self.weights, *self.sums)])

    def unpack(self, flat: np.ndarray) -> LogBilinear:
        start = 0
        for w in (*self.weights, *self.sums):
            w[...] = flat[start : start + w.size].reshape(w.shape)
            start += w.size
        return self

    def train(self, codes: np.ndarray, n: np.ndarray, shares: np.ndarray, steps: int, seed: int) -> None:
        """Noise-contrastive steps on triples drawn by their counts; a batch shares its noise words."""
        random = np.random.default_rng(seed)
        width = len(self.context)
        log_noise = np.log(NOISE * shares)
        chance, noise_chance = np.cumsum(n) / n.sum(), np.cumsum(shares)
        for _ in range(steps):
            drawn = codes[np.minimum(np.searchsorted(chance, random.random(BATCH)), len(codes) - 1)]
            far, near, word = drawn // width // width, drawn // width % width, drawn % width
            noise = np.minimum(np.searchsorted(noise_chance, random.random(NOISE)), len(shares) - 1)
            context_near, context_far = self.context[near], self.context[far]
            made = context_near @ self.near + context_far @ self.far
            right = 1 - _sigmoid((made * self.target[word]).sum(axis=1) + self.bias[word] - log_noise[word])
            wrong = -_sigmoid(made @ self.target[noise].T + self.bias[noise] - log_noise[noise])
            back = right[:, None] * self.target[word] + wrong @ self.target[noise]
            places = np.concatenate([word, noise])
            self._step(1, places, np.concatenate([right[:, None] * made, wrong.T @ made]))
            self._step(4, places, np.concatenate([right, wrong.sum(axis=0)]))
            self._step(0, np.concatenate([near, far]), np.concatenate([back @ self.near.T, back @ self.far.T]))
            self._step(2, None, context_near.T @ back)
            self._step(3, None, context_far.T @ back)

    def _step(self, which: int, places: np.ndarray | None, gradient: np.ndarray) -> None:
        weights, sums = self.weights[which], self.sums[which]
        if places is None:
            gradient = gradient / BATCH
            sums += gradient**2
            weights += RATE * gradient / np.sqrt(sums)
            return
        order = np.argsort(places, kind="stable")
        ordered = places[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        kinds, total = ordered[starts], np.add.reduceat(gradient[order], starts, axis=0) / BATCH
        sums[kinds] += total**2
        weights[kinds] += RATE * total / np.sqrt(sums[kinds])

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Score of each entry (column) after each near and far context entry (row); biases are in the first."""
        near = self.context @ self.near @ self.target.T + self.bias
        return near.astype(np.float32), (self.context @ self.far @ self.target.T).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _shard_work(shared, shares: np.ndarray, width: int, steps: int, turn: int):
    def run(frame):
        own = LogBilinear(len(shares) + 1, width, shares).unpack(shared.value)
        frame = frame.sort_values("code")
        seed = turn * SHARDS + int(frame["shard"].iloc[0])
        own.train(frame["code"].to_numpy(), frame["n"].to_numpy(dtype=np.float64), shares, steps, seed)
        return type(frame)({"rows": [len(frame)], "weights": [own.pack().astype(np.float32).tobytes()]})

    return run


def fit(triples: DataFrame, counts: Counts, *, rounds: int = ROUNDS, passes: int = PASSES, width: int = WIDTH) -> LogBilinear:
    """Rounds of training on shards from common weights, averaged by the shards' triples."""
    shares = counts.shares()
    model = LogBilinear(counts.vocabulary + 3, width, shares)
    size = len(model.pack())
    spark = triples.sparkSession
    n_triples = triples.count()
    n_shards = min(SHARDS, max(1, math.ceil(n_triples / SHARD_TRIPLES)))
    steps = max(LEAST_STEPS, math.ceil(passes * n_triples / n_shards / BATCH))
    # frequent triples are shared out to all shards in equal parts, so that all see about the same language
    everywhere = F.col("n") >= n_shards
    places = F.when(everywhere, F.sequence(F.lit(0), F.lit(n_shards - 1)))
    own = F.array(F.pmod(F.xxhash64("code"), F.lit(n_shards)).cast("int"))
    part = F.when(everywhere, F.col("n") / n_shards).otherwise(F.col("n").cast("double"))
    shards = triples.select("code", part.alias("n"), F.explode(F.coalesce(places, own)).alias("shard"))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model.pack())

        made = shards.repartition(n_shards, "shard").groupBy("shard").applyInPandas(_shard_work(shared, shares, width, steps, turn), "rows long, weights binary")
        total, rows = np.zeros(size), 0
        for n, weights in made.collect():  # at most SHARDS rows of a fixed size
            total += n * np.frombuffer(weights, dtype=np.float32)
            rows += n
        if rows:
            model.unpack(total / rows)
        shared.unpersist()
    return model


class Scorer:
    """What a task needs to score texts; normalisers are computed when their context first occurs."""

    def __init__(self, counts: Counts, near: np.ndarray, far: np.ndarray) -> None:
        self.counts, self.near, self.far = counts, near, far
        self.place = {w: i for i, w in enumerate(counts.words)}
        self.width = len(near)
        self.log_sum = np.full(self.width * self.width, np.nan, dtype=np.float64)
        log = np.log10(np.r_[counts.n, counts.ends] + ADDED)
        self.base = log - math.log10(counts.base_divisor)
        self.rare = log - math.log10(counts.rare_divisor)

    def normalise(self, contexts: np.ndarray) -> None:
        new = np.unique(contexts)
        new = new[np.isnan(self.log_sum[new])]
        for part in np.array_split(new, max(1, math.ceil(len(new) / 2_048))):
            score = self.near[part % self.width] + self.far[part // self.width]
            most = score.max(axis=1, keepdims=True) if len(part) else score
            self.log_sum[part] = np.log(np.exp(score - most).sum(axis=1, dtype=np.float64)) + most[:, 0] if len(part) else 0

    def score(self, texts: list[bytes]):
        """Per text: tokens, known tokens, base score and model score without the words beyond the head; and those words."""
        counts = self.counts
        parts = [tokens(t) for t in texts]
        head, first = counts.entries(parts, self.place)
        word = counts.model_entries(head)
        last, before = counts.contexts(word, first)
        context = before * self.width + last
        self.normalise(context)
        log = (self.near[last, word] + self.far[before, word] - self.log_sum[context]) / math.log(10)
        inside = head != -1
        at = np.where(head == -2, len(counts.n), np.maximum(head, 0))
        base = np.where(inside, self.base[at], 0.0)
        log += np.where(inside & (word == counts.rare), self.rare[at], 0.0)
        known = inside & ((head >= 0) | (counts.ends > 0))
        cut = first[:-1]
        sums = [np.add.reduceat(x, cut) for x in (known.astype(np.int64), base, log)]
        beyond = np.flatnonzero(~inside)
        owner = np.searchsorted(first, beyond, side="right") - 1
        rest: list[list[bytes]] = [[] for _ in texts]
        for i, j in zip(owner.tolist(), (beyond - first[owner]).tolist(), strict=True):
            rest[i].append(parts[i][j])
        return np.diff(first), *sums, rest


def score(docs: DataFrame, *, vocabulary: int = VOCABULARY, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    source = id_and_text(docs, id_col, text_col)
    training = source.where(~held_out()).select("text")
    counted = staged(word_counts(training), "word-counts")
    counts = Counts.of(counted, training.count(), vocabulary, head)
    shared = spark.sparkContext.broadcast(counts)
    model = fit(staged(triple_counts(training, shared), "triples"), counts)
    tables = spark.sparkContext.broadcast(model.tables())
    ship_package(spark)

    def run(batches):
        scorer = Scorer(shared.value, *tables.value)
        for batch in batches:
            for part in slices(batch):
                n, known, base, log, rest = scorer.score(bytes_of(part.column("text")))
                words = [pa.array(x, pa.binary()).cast(pa.string()) for x in rest]
                offsets = np.r_[0, np.cumsum([len(w) for w in words])]
                beyond = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(n), pa.array(known), pa.array(base), pa.array(log), beyond],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "log", "beyond"],
                )

    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, log double, beyond array<string>"
    rows = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out().alias("held_out"), "text")
    partial = staged(rows.mapInArrow(run, schema), "scores")
    rare = partial.select("row", F.explode("beyond").alias("word")).groupBy("row", "word").agg(F.count("*").alias("tf"))
    n = F.coalesce("n", F.lit(0))
    log = F.log10(n + ADDED)
    tail = (
        rare.join(counted, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("tail_known"),
            F.sum(F.col("tf") * (log - math.log10(counts.base_divisor))).alias("tail_base"),
            F.sum(F.col("tf") * (log - math.log10(counts.rare_divisor))).alias("tail_log"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return partial.drop("beyond").join(tail, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + zero("tail_known")).alias("n_known"),
        F.lit(int(counts.total)).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail_base")).alias("base_score"),
        (F.col("log") + zero("tail_log")).alias("score"),
    )
