"""Quality rules: rule statistics of a document, and an isolation forest over them.

A forest is grown in numpy for each group of statistics, from random splits of small subsamples; a document that few
splits set apart has a short path and a high anomaly score. The score of each forest above which a document is rejected
is calibrated on all labelled rows; a forest whose anomalies are no worse than other documents rejects nothing.

Defined cases: null and empty texts have no words, so they fail the base rule; texts of any length are read whole;
repeated rows and ids are judged row by row; with an empty table the result is empty; with too few labelled rows of
either kind nothing is rejected beyond the base rule.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import id_and_text, slices, staged, texts_of, window_hashes

WINDOW = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\v\f\r"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_distinct")
STATISTICS = f"doc_id long, {', '.join(f'{c} long' for c in (*BASE, *EXTRA))}"


def statistics_of(texts: list[str]) -> np.ndarray:
    """A row of BASE + EXTRA for each text."""
    out = np.zeros((len(texts), len(BASE) + len(EXTRA)), dtype=np.int64)
    number = defaultdict(count().__next__)
    ids: list[int] = []
    first = [0]
    for i, text in enumerate(texts):
        tokens = text.encode().split()
        ids.extend(map(number.__getitem__, tokens))
        first.append(len(ids))
        spaces = sum(map(text.count, SPACES))
        seen: set[str] = set()
        repeated = lines = 0
        for line in text.split("\n"):
            if line.strip(SPACES):
                lines += 1
                repeated += line in seen
                seen.add(line)
        out[i] = (
            len(tokens), len(text) - spaces, sum(map(text.count, SYMBOLS)), repeated, 0, lines, len(set(tokens)),
        )
    out[:, 4] = repeated_words(np.array(ids, dtype=np.int64), np.array(first))
    return out


def repeated_words(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each document in windows of five that occur twice or more in it."""
    docs = len(first) - 1
    total = np.zeros(docs, dtype=np.int64)
    hashes = window_hashes(ids, WINDOW)
    doc = np.repeat(np.arange(docs), np.diff(first))
    starts = np.flatnonzero(doc[: len(hashes)] == doc[WINDOW - 1 : WINDOW - 1 + len(hashes)])
    if not len(starts):
        return total
    keys = window_hashes(np.column_stack([hashes[starts].view(np.int64), doc[starts]]).reshape(-1), 2)[::2]
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(marks, starts[twice], 1)
    np.add.at(marks, starts[twice] + WINDOW, -1)
    covered = np.cumsum(marks)[:-1] > 0
    np.add.at(total, doc[covered], 1)
    return total


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of every document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = statistics_of(texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c) for c in rows.T)], names=["doc_id", *BASE, *EXTRA]
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, STATISTICS)


def features_of(rows: np.ndarray) -> np.ndarray:
    """Ratios that do not depend on the length of a text, from rows of BASE + EXTRA."""
    words, chars, symbols, dup, repeat, lines, distinct = rows.T.astype(np.float64)
    some = np.maximum(words, 1)
    return np.column_stack(
        [
            chars / some,
            symbols / some,
            dup / np.maximum(lines, 1),
            repeat / some,
            np.log(some) - np.log(np.maximum(distinct, 1)),
        ]
    )


#: Columns of features_of() that a forest sees together.
GROUPS = {"word length": (0,), "symbols": (1,), "length and symbols": (0, 1), "repetition": (2, 3, 4)}


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1 in a leaf), cut, left child (the right one follows), path length of a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    length: np.ndarray
    sample: int

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int, sample: int, seed: int = 0) -> IsolationForest:
        random = np.random.default_rng(seed)
        sample = min(sample, len(rows))
        depth = max(1, math.ceil(math.log2(max(sample, 2))))
        size = 2 ** (depth + 1)
        feature = np.full((trees, size), -1, dtype=np.int32)
        cut, left = np.zeros((trees, size)), np.zeros((trees, size), dtype=np.int32)
        length = np.zeros((trees, size))
        for t in range(trees):
            used = 1
            todo = [(0, rows[random.choice(len(rows), sample, replace=False)], 0)]
            while todo:
                node, own, level = todo.pop()
                low, high = own.min(axis=0), own.max(axis=0)
                usable = np.flatnonzero(high > low)
                if level == depth or len(own) < 2 or not len(usable):
                    length[t, node] = level + average_path(len(own))
                    continue
                f = int(random.choice(usable))
                at = random.uniform(low[f], high[f])
                below = own[:, f] <= at
                feature[t, node], cut[t, node], left[t, node] = f, at, used
                todo += [(used, own[below], level + 1), (used + 1, own[~below], level + 1)]
                used += 2
        return cls(feature, cut, left, length, sample)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over the usual one: near 1 is anomalous."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, length in zip(self.feature, self.cut, self.left, self.length, strict=True):
            node = np.zeros(len(rows), dtype=np.int32)
            while (inner := feature[node] >= 0).any():
                right = rows[every, np.maximum(feature[node], 0)] > cut[node]
                node = np.where(inner, left[node] + right, node)
            total += length[node]
        return 2.0 ** (-total / len(self.feature) / max(average_path(self.sample), 1e-9))


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n keys."""
    if n < 2:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def thresholds(scored: DataFrame, names: list[str], max_loss: float) -> list[float]:
    """For each column of scores the lowest above which at most `max_loss` of the good rows lie, by all labelled rows.

    Infinite where that catches hardly any bad row, or with fewer than 20 rows of either kind. `scored` has _quality.
    """
    good, bad = F.col("_quality") == 1, F.col("_quality") == 0
    n_good, n_bad = scored.agg(F.count_if(good), F.count_if(bad)).first()
    if n_good < 20 or n_bad < 20:
        return [math.inf] * len(names)
    most = math.floor(max_loss * n_good)
    # the score of rank `most` from above, in the order of all good rows
    highest = [scored.where(good).select(name).orderBy(F.desc(name)).limit(most + 1).agg(F.min(name)).first()[0] for name in names]
    above = [F.count_if(kind & (F.col(name) > at)) for name, at in zip(names, highest, strict=True) for kind in (good, bad)]
    counts = scored.agg(*above).first()
    shares = [(lost / n_good, caught / n_bad) for lost, caught in zip(counts[::2], counts[1::2], strict=True)]
    return [at if caught > max(0.01, 10 * lost) else math.inf for at, (lost, caught) in zip(highest, shares, strict=True)]


@dataclass
class QualityModel:
    """For each group of features: its columns, its forest, and the score above which a document is rejected."""

    parts: list[tuple[tuple[int, ...], IsolationForest, float]]

    def judge(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest anomaly score of each row, and whether no forest rejects it."""
        highest, usual = np.zeros(len(features)), np.ones(len(features), dtype=bool)
        for columns, forest, at in self.parts:
            score = forest.score(features[:, columns])
            highest = np.maximum(highest, score)
            usual &= score <= at
        return highest, usual


def fit(
    statistics: DataFrame,
    labels: DataFrame,
    *,
    trees: int = 100,
    sample: int = 64,
    max_loss: float = 0.0005,
    quality_col: str = "quality",
) -> QualityModel:
    """Grow the forests and calibrate their thresholds.

    The forests see `trees * sample` rows at most, chosen by hash among all that pass the base rule: subsampling is
    what the method does. All labelled rows are scored where they are; `max_loss` is the share of the good ones that a
    forest may reject.
    """
    usable = statistics.where(~base_failed())
    columns = [F.col(c) for c in (*BASE, *EXTRA)]
    rows = usable.select(*columns).orderBy(F.xxhash64("doc_id", *columns)).limit(trees * sample).toPandas().to_numpy()
    marked = labels.where(F.col(quality_col).isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(quality_col).cast("int").alias("_quality")
    )
    if len(rows) < 2:
        return QualityModel([])
    grown = features_of(rows)
    forests = [IsolationForest.grow(grown[:, group], trees, sample) for group in GROUPS.values()]
    grouped = list(zip(GROUPS.values(), forests, strict=True))
    shared = statistics.sparkSession.sparkContext.broadcast(grouped)
    names = [f"_score{i}" for i in range(len(forests))]

    def run(batches):
        for batch in batches:
            features = features_of(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*BASE, *EXTRA)]))
            scores = [pa.array(forest.score(features[:, group])) for group, forest in shared.value]
            yield pa.RecordBatch.from_arrays([batch.column("_quality"), *scores], names=["_quality", *names])

    labelled = usable.join(marked, "doc_id").select(*columns, "_quality")
    scored = labelled.mapInArrow(run, f"_quality int, {', '.join(f'{n} double' for n in names)}")
    limits = thresholds(staged(scored, "labelled-scores"), names, max_loss)
    return QualityModel([(*part, at) for part, at in zip(grouped, limits, strict=True)])


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def judge(statistics: DataFrame, model: QualityModel) -> DataFrame:
    """Add base_failed, anomaly (0 to 1) and kept."""
    spark = statistics.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*BASE, *EXTRA)])
            scores, usual = own.judge(features_of(rows))
            failed = (rows[:, 0] < MIN_WORDS) | (100 * rows[:, 4] > MAX_REPEATED_PERCENT * rows[:, 0])
            added = [pa.array(failed), pa.array(scores), pa.array(usual & ~failed)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *RESULT])

    schema = f"{STATISTICS}, base_failed boolean, anomaly double, kept boolean"
    return statistics.select("doc_id", *BASE, *EXTRA).mapInArrow(run, schema)


RESULT = ("base_failed", "anomaly", "kept")


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics, base_failed, anomaly and kept for every row of `docs`, in one pass over the texts."""
    statistics = staged(rule_statistics(docs), "quality-statistics")
    return judge(statistics, fit(statistics, labels, **options))


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that pass the base rule and that no forest rejects, with all their columns.

    Statistics are taken twice (to grow the forests, and where a row is judged), so that no text is shuffled.
    """
    statistics = staged(rule_statistics(docs, text_col=text_col), "quality-statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit(statistics, labels, **options))
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in slices(named, f"c{place}"):
                rows = statistics_of(texts_of(part.column(place)))
                failed = (rows[:, 0] < MIN_WORDS) | (100 * rows[:, 4] > MAX_REPEATED_PERCENT * rows[:, 0])
                kept = part.filter(pa.array(model.value.judge(features_of(rows))[1] & ~failed))
                yield kept.rename_columns(batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
