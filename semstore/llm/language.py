"""Language identification by rank-order profiles.

The profile of a language is the list of its most frequent letter n-grams in the training texts. A document's own most
frequent n-grams are compared to each profile: every n-gram costs the difference of its two ranks, or the length of the
profile where it is missing (the out-of-place distance). The nearest language wins; ties go to the smaller name.

Defined cases: a null text, and a text without a letter, is `und` with score 0; rows without a language or without an
id are not learned from; without any profile every text is `und`; whole texts are counted, however long; repeated rows
are predicted row by row.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from semstore.llm.common import ship_package, slices, texts_of

LONGEST = 3
PROFILE = 300
#: Most languages; the profiles go to every task.
MAX_LANGUAGES = 2_000
UNKNOWN = "und"

_LETTER = np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], dtype=bool)
_GAP = 1  # stands for anything between words


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of up to three characters of the words, each word with a gap on both sides."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    letter = _LETTER[points]
    padded = np.full(len(points) + 2, _GAP, dtype=np.int64)
    padded[1:-1][letter] = points[letter]
    padded = padded[np.r_[True, (padded[1:] != _GAP) | (padded[:-1] != _GAP)]]
    inner = padded != _GAP
    two = padded[:-1] << 21 | padded[1:]
    three = two[:-1] << 21 | padded[2:]
    return np.concatenate([padded[inner], two[inner[:-1] | inner[1:]], three[inner[1:-1]]])


def ranked(text: str, size: int) -> np.ndarray:
    """The text's `size` most frequent n-grams, most frequent first, ties by code."""
    kinds, counts = np.unique(grams(text), return_counts=True)
    return kinds[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    def __init__(self, ranks: dict[str, dict[int, int]], size: int) -> None:
        self.size = size
        self.names = sorted(ranks)
        self.codes = np.array(sorted({code for own in ranks.values() for code in own}), dtype=np.int64)
        self.rank = np.full((len(self.codes), len(self.names)), -1, dtype=np.int64)
        for j, name in enumerate(self.names):
            for code, rank in ranks[name].items():
                self.rank[np.searchsorted(self.codes, code), j] = rank

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, and one minus its distance as a share of the largest possible."""
        own = ranked(text, self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        rank = np.where((self.codes[at] == own)[:, None], self.rank[at], -1)
        cost = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))[:, None]))
        total = cost.sum(axis=0)
        best = int(total.argmin())
        return self.names[best], float(1 - total[best] / (self.size * len(own)))


def remainder(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3: remainder 1 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def gram_counts(training: DataFrame) -> DataFrame:
    """lang, gram and n over rows of lang and text; each slice is counted before anything is shuffled."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                names = np.array(part.column("lang").to_pylist(), dtype=object)
                texts = texts_of(part.column("text"))
                for name in sorted(set(names)):
                    own = [grams(texts[i]) for i in np.flatnonzero(names == name)]
                    kinds, counts = np.unique(np.concatenate(own), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(kinds), pa.string()), pa.array(kinds), pa.array(counts)],
                        names=["lang", "gram", "n"],
                    )

    ship_package(training.sparkSession)
    counted = training.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(training: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from rows of lang and text."""
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # compared as it is, Spark cuts each task's rows to `size` a language before they meet
    top = gram_counts(training).withColumn("place", F.row_number().over(first)).where(F.col("place") <= size)
    ranks: dict[str, dict[int, int]] = {}
    for lang, gram, rank in top.select("lang", "gram", F.col("place") - 1).toLocalIterator():
        ranks.setdefault(lang, {})[gram] = rank
        if len(ranks) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Profiles(ranks, size)


def identify(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows that are not held out."""
    ship_package(docs.sparkSession)
    rest = remainder(id_col)
    training = docs.where((rest != 1) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    profiles = docs.sparkSession.sparkContext.broadcast(
        learn(training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")), size)
    )

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = [profiles.value.predict(t) for t in texts_of(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array([x[0] for x in found], pa.string()),
                        pa.array([x[1] for x in found], pa.float64()),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(rest == 1, F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
