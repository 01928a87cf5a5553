"""Spelling variants of the words of a corpus, by permuterm rotations.

Words are runs of Latin letters. Each word of the vocabulary is marked with a terminator, and its rotations are made:
`color$` gives `color$`, `olor$c`, `lor$co` and so on. The rotation that starts behind a letter, without that letter at
its end, is a prefix that does not know the letter: words that differ by a replaced letter share it. A whole rotation is
the same prefix for the word that has one letter less. So all words at one edit meet under a prefix, whichever edit it
is, and the rotations, sorted by their prefix, are scanned group by group. A group holds at most one word per letter of
the alphabet and the one without it, whatever the size of the corpus; each member gets the number of its neighbours there
and the best of them, never a row per pair.

Two words are found under one prefix only, with one exception: of a letter repeated in a row any one can be the inserted
one. Only the last of the row counts, whose prefix does not end with the same letter again.

A word's form is its most frequent neighbour if that is `ratio` times as frequent. Forms are followed to the last one by
doubling: as counts grow by `ratio` at each step, a path is at most log(most occurrences) / log(ratio) long.

Defined cases: null and empty texts have no words; texts of any length are read whole; repeated rows and ids count as
often as they occur; of equally frequent neighbours the smallest in code-point order is the form. A row without an id
has the empty text for its id where typing errors are drawn. Without any words the result is empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import id_and_text, staged

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
#: One in so many of the runs of a document loses a letter, as a typing error would take it; 0: none.
DROPPED = 199
#: Letters of words, after A-Z are lower-cased.
LETTERS = "a-zÀ-ÿ"
#: Sorts before every letter.
MARK = "$"


def occurrences(
    docs: DataFrame, *, least_letters: int = LEAST_LETTERS, dropped: int = DROPPED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`word` for each occurrence with `least_letters` or more; one in `dropped` runs of a document lacks a letter."""
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # shorter runs cannot become words, so they are left out by the pattern
    runs = F.regexp_extract_all(small, F.lit(f"([{LETTERS}]{{{least_letters},}})"), F.lit(1))
    found = id_and_text(docs, id_col, text_col).select("doc_id", F.explode(runs).alias("run"))
    if not dropped:
        return found.select(F.col("run").alias("word"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    drawn = found.withColumn("drawn", F.crc32(F.encode(F.concat(name, F.lit(":"), F.col("run")), "UTF-8")))
    place = (F.col("drawn") % F.char_length("run")).cast("int")
    torn = F.concat(F.substring("run", F.lit(1), place), F.substr("run", place + 2))
    word = F.when(F.col("drawn") % dropped == 0, torn).otherwise(F.col("run"))
    return drawn.select(word.alias("word")).where(F.char_length("word") >= least_letters)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n (long), for words with `least_count` occurrences or more."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(vocab: DataFrame) -> DataFrame:
    """prefix, letter (the one that the prefix skips; empty for the word that lacks it), word, n."""
    marked = vocab.select("word", "n", F.concat("word", F.lit(MARK)).alias("marked"))
    place = F.explode(F.sequence(F.lit(1), F.char_length("marked")))
    turned = marked.select("word", "n", "marked", place.alias("place"))
    rotation = F.concat(F.substr("marked", F.col("place")), F.substring("marked", F.lit(1), F.col("place") - 1))
    turned = turned.select("word", "n", rotation.alias("rotation"))
    last = F.char_length("rotation")
    skipped = F.struct(F.substring("rotation", F.lit(1), last - 1).alias("prefix"), F.substr("rotation", last).alias("letter"))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit("").alias("letter"))
    rows = turned.select("word", "n", F.explode(F.array(skipped, whole)).alias("row")).select("row.*", "word", "n")
    return rows.where(F.col("letter") != MARK)


def neighbours(vocab: DataFrame) -> DataFrame:
    """word, n_near (how many words are one edit away) and best (its n, negative, and the word), for words that have any."""
    member = F.struct((-F.col("n")).alias("less"), "word", "letter")
    groups = rotations(vocab).groupBy("prefix").agg(F.sort_array(F.collect_list(member)).alias("members"))
    groups = groups.where(F.size("members") > 1)
    # the letter before the skipped one: with it skipped, the same pair is found under another prefix too
    again = F.substr("prefix", F.char_length("prefix"))
    groups = groups.withColumn("again", again).withColumn("first", F.slice("members", 1, 3))
    pair = F.exists("members", lambda m: m["letter"] == "") & F.exists("members", lambda m: m["letter"] == F.col("again"))
    groups = groups.withColumn("pair", pair)
    each = groups.select("first", "again", "pair", F.size("members").alias("size"), F.explode("members").alias("own"))
    # a member and at most one more are no neighbours of it, so the best one is among the first three
    meets = lambda m: (m["letter"] != F.col("own.letter")) & ~_twice(m["letter"], F.col("own.letter"), F.col("again"))
    best = F.try_element_at(F.filter("first", meets), F.lit(1))
    in_pair = F.col("pair") & F.col("own.letter").isin("", F.col("again"))
    found = each.select(
        F.col("own.word").alias("word"),
        (F.col("size") - 1 - in_pair.cast("int")).alias("n_near"),
        F.struct(best["less"].alias("less"), best["word"].alias("word")).alias("best"),
    )
    found = found.where("n_near > 0")
    return found.groupBy("word").agg(F.sum("n_near").cast("long").alias("n_near"), F.min("best").alias("best"))


def _twice(a: Column, b: Column, again: Column) -> Column:
    return ((a == "") & (b == again)) | ((b == "") & (a == again))


def last_forms(forms: DataFrame, longest: int) -> DataFrame:
    """word and root (the last form on the way from it), for words with a form; no way is longer than `longest`."""
    ways = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(longest - 1, 0).bit_length()):
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = staged(
            ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variant-ways"
        )
    return ways


def group_variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of a table of distinct words and their counts."""
    # joined and read several times: written first
    vocab = staged(vocab.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    most = vocab.agg(F.max("n")).first()[0] or 1
    near = vocab.join(neighbours(vocab), "word", "left")
    common = -F.col("best.less") >= ratio * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best.word")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    )
    near = staged(near, "variants")
    roots = last_forms(near.where("form is not null"), math.ceil(math.log(most, ratio)) if ratio > 1 else most)
    rooted = near.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", dropped: int = DROPPED) -> DataFrame:
    """The words of a corpus, grouped by spelling."""
    return group_variants(vocabulary(occurrences(docs, dropped=dropped, id_col=id_col, text_col=text_col)))
