"""Licence families by a sparse n-gram classifier, in DataFrame and SQL functions only.

Comment marks are taken off the beginnings of lines. A text is cut into lines, and these at sentence ends; sentences that
go on over line breaks within a paragraph (up to a blank line) are passages too, with their lines joined. A multinomial
logistic regression with an L1 penalty over words and word pairs is trained on notices of each family, as their
publishers word them, and on all passages of the corpus that are none. A passage gets
the most probable family if that probability passes the calibrated threshold, and is unknown otherwise; the prediction
counts if the passage also holds `share` of the word pairs of one of the family's notices. As every notice has a word of
licensing (CUES), passages without one cannot be confirmed and are not classified.

The threshold is that which few of the passages with a cue that hold no notice reach; these are not those trained on.

Defined cases: null and empty texts have no passages and no licence; texts of any length are scanned whole, passages of
more than WINDOW words in windows; rows with the same id and text are one document, returned as often as they occur;
without any passage to calibrate on the threshold is `least`.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semstore.llm.common import staged

#: Short notices and standard headers of well-known licences, as their publishers word them.
NOTICES = {
    "agpl-3.0": (
        "licensed under the gnu affero general public license, version 3",
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu affero general "
        "public license as published by the free software foundation, either version 3 of the license, or (at your option) "
        "any later version",
    ),
    "all-rights-reserved": ("all rights reserved", "copyright all rights reserved"),
    "apache-2.0": (
        "licensed under the apache license, version 2.0",
        "licensed under the apache license, version 2.0 (the license); you may not use this file except in compliance with "
        "the license",
        "you may not use this file except in compliance with the license",
        "distributed under the terms of the apache license 2.0",
    ),
    "bsd": (
        "released under the bsd license",
        "licensed under the bsd 3-clause license",
        "redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "cc-by": ("licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license"),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "licensed under a creative commons attribution-noncommercial 4.0 international license",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "licensed under a creative commons attribution-sharealike 4.0 international license",
    ),
    "cc0": (
        "dedicated to the public domain under cc0 1.0",
        "no rights reserved, cc0 1.0 universal public domain dedication",
        "to the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide",
    ),
    "epl-2.0": ("made available under the terms of the eclipse public license 2.0",),
    "gpl-2.0": (
        "licensed under the gnu general public license, version 2",
        "released under the gpl version 2 license",
        "this program is free software; you can redistribute it and/or modify it under the terms of the gnu general public "
        "license as published by the free software foundation; either version 2 of the license, or (at your option) any "
        "later version",
    ),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license, version 3",
        "released under the gpl version 3 license",
        "this program is free software: you can redistribute it and/or modify it under the terms of the gnu general public "
        "license as published by the free software foundation, either version 3 of the license, or (at your option) any "
        "later version",
    ),
    "isc": (
        "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license, version 3",
        "you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the software), to deal in the software without restriction",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "mpl-2.0": (
        "this source code form is subject to the terms of the mozilla public license, version 2.0",
        "this source code form is subject to the terms of the mozilla public license, v. 2.0",
    ),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}
#: Identifiers that files name their licence by, one line each.
SPDX = {
    "agpl-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "apache-2.0": ("Apache-2.0",),
    "bsd": ("BSD-2-Clause", "BSD-3-Clause"),
    "cc-by": ("CC-BY-4.0",),
    "cc-by-nc": ("CC-BY-NC-4.0",),
    "cc-by-sa": ("CC-BY-SA-4.0",),
    "cc0": ("CC0-1.0",),
    "epl-2.0": ("EPL-2.0",),
    "gpl-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "gpl-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "isc": ("ISC",),
    "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",),
    "mpl-2.0": ("MPL-2.0",),
    "unlicense": ("Unlicense",),
}
for _family, _names in SPDX.items():
    NOTICES[_family] += tuple(f"spdx-license-identifier: {name.lower()}" for name in _names)
UNKNOWN = "unknown"
#: Parts of words of which every notice has one.
CUES = ("licen", "copyright", "rights reserved", "public domain", "hereby granted", "redistribution")

FAMILIES = (UNKNOWN, *sorted(NOTICES))
NEGATIVE_WEIGHT, LEAST, SHARE = 2_000, 0.5, 0.7
#: A probability that passes any threshold: single odd passages must not shut out notices word for word.
CERTAIN = 0.95
#: Words of a window of a longer passage; windows overlap by half.
WINDOW = 120
#: Marks of comments at the beginning of a line.
_COMMENT = r"(?m)^[ \t]*(?:/\*+|\*+/?|//+!?|#+|;+|--+|<!--|%+|(?:dnl|rem|REM)(?=[ \t]))[ \t]*"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.+-]+"), lambda w: F.regexp_replace(w, r"[.+-]", "") != "")


def grams(tokens: Column) -> Column:
    """Words without marks at their ends, then pairs of neighbours."""
    plain = F.transform(tokens, lambda w: F.regexp_replace(w, r"^[.+-]+|[.+-]+$", ""))
    return F.concat(plain, pairs(plain))


def pairs(tokens: Column) -> Column:
    both = F.arrays_zip(tokens.alias("a"), F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))).alias("b"))
    made = F.transform(both, lambda x: F.concat_ws(" ", x["a"], x["b"]))
    return F.when(F.size(tokens) < 2, F.array().cast("array<string>")).otherwise(F.slice(made, 1, F.greatest(F.size(tokens) - 1, F.lit(0))))


def notices(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(FAMILIES.index(f)).cast("double").alias("label"), F.lit(t).alias("passage")) for f, own in NOTICES.items() for t in own]
    return spark.range(1).select(F.inline(F.array(*rows)))


def passages(docs: DataFrame) -> DataFrame:
    """key columns and passage: lines cut at sentence ends, and sentences over several lines, joined; blank ones left out."""
    bare = F.regexp_replace("text", _COMMENT, "")
    lines = F.split(bare, r"\n+|(?<=[.!?])\s+")
    sentences = F.filter(F.split(bare, r"\n[ \t]*\n\s*|(?<=[.!?])\s+"), lambda p: F.trim(p).contains("\n"))
    joined = F.transform(sentences, lambda p: F.regexp_replace(p, r"\s*\n\s*", " "))
    cut = F.filter(F.concat(lines, joined), lambda p: F.trim(p) != "")
    each = docs.select("doc_id", "content", F.explode(cut).alias("passage"))
    # a long passage in windows, so that what stands far apart in it is not taken for a notice
    parts = F.split("passage", r"\s+")
    starts = F.sequence(F.lit(1), F.greatest(F.size(parts) - WINDOW // 2, F.lit(1)), F.lit(WINDOW // 2))
    windows = F.transform(starts, lambda i: F.array_join(F.slice(parts, i, F.lit(WINDOW)), " "))
    short = F.char_length("passage") <= 2 * WINDOW  # cannot have more words than that
    return each.select("doc_id", "content", F.explode(F.when(short, F.array("passage")).otherwise(windows)).alias("passage"))


def has_cue(passage: Column) -> Column:
    small = F.lower(passage)
    found = F.lit(False)
    for cue in CUES:
        found = found | small.contains(cue)
    return found


class LicenceModel:
    def __init__(self, vectorizer, regression, threshold: float) -> None:
        self.vectorizer, self.regression, self.threshold = vectorizer, regression, threshold

    def classify(self, df: DataFrame) -> DataFrame:
        """Add family (with unknown) and probability, the highest of any family."""
        scored = self.regression.transform(self.vectorizer.transform(df.withColumn("grams", grams(words(F.col("passage"))))))
        chances = F.slice(vector_to_array("probability"), 2, len(FAMILIES) - 1)
        scored = scored.withColumn("chances", chances).withColumn("probability", F.array_max("chances"))
        names = F.array(*map(F.lit, FAMILIES[1:]))
        best = F.element_at(names, F.array_position("chances", F.col("probability")).cast("int"))
        family = F.when(F.col("probability") >= self.threshold, best).otherwise(F.lit(UNKNOWN))
        return scored.withColumn("family", family).drop("features", "rawPrediction", "prediction", "chances")


def known_grams(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """grams: of the words and pairs of neighbours of each passage those in the vocabulary, each once and in order."""
    tokens = F.filter(F.transform(F.split(F.lower("passage"), r"[^a-z0-9.+-]+"), lambda w: F.btrim(w, F.lit(".+-"))), lambda w: w != "")
    # pairs are made of neighbours that both occur in the vocabulary, other words only keep them apart
    parts = sorted({w for gram in vocabulary for w in gram.split(" ")})
    # a column of its own, so that it is worked out once
    marked = rows.select(F.transform(tokens, lambda w: F.when(w.isin(parts), w)).alias("m"))
    both = F.arrays_zip(F.col("m").alias("a"), F.slice("m", 2, F.greatest(F.size("m"), F.lit(1))).alias("b"))
    paired = F.transform(both, lambda x: F.when(x["a"].isNotNull() & x["b"].isNotNull(), F.concat(x["a"], F.lit(" "), x["b"])))
    return marked.select(F.array_sort(F.array_distinct(F.filter(F.concat("m", paired), lambda g: g.isin(vocabulary)))).alias("grams"))


def fit(
    spark: SparkSession, corpus: DataFrame, cued: DataFrame, *, weight: float = NEGATIVE_WEIGHT, least: float = LEAST, exceeded: float = 0.001
) -> LicenceModel:
    """Train on notices (whole, and in a sentence's company) and negatives; calibrate the threshold.

    Negatives are all passages of `corpus` without a cue, and one half of those with a cue (`cued`) that hold no notice; of
    the other half, the share `exceeded` may pass the threshold. Negatives of either kind weigh `weight` together at most,
    so that notices count the same in a corpus of any size. Passages without a cue that the model cannot tell apart, having
    the same words and pairs of the notices, are one row.
    """
    own = notices(spark)
    shorter = own.select("label", F.concat_ws(" ", F.slice(words(F.col("passage")), 1, 12)).alias("passage"))
    # a header of twelve words may not say yet which of several licences it is
    shorter = shorter.groupBy("passage").agg(F.min("label").alias("label"), F.count_distinct("label").alias("n")).where("n = 1").select("label", "passage")
    longer = own.select("label", F.concat(F.lit("this work is "), "passage").alias("passage"))
    positives = own.unionByName(shorter).unionByName(longer)
    # words of notices without a notice: the second half of the hash order has them one by one
    singles = own.select(F.explode(words(F.col("passage"))).alias("passage")).distinct()
    vectorizer = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=20_000).fit(
        positives.withColumn("grams", grams(words(F.col("passage"))))
    )
    plain = known_grams(corpus.where(~has_cue(F.col("passage"))), vectorizer.vocabulary).groupBy("grams").agg(F.count(F.lit(1)).alias("n"))
    plain = staged(plain, "plain-negatives")
    none = cued.where(~holds_any()).select("passage").distinct()
    none = staged(none.withColumn("held_out", F.pmod(F.xxhash64("passage", F.lit("half")), F.lit(2)) == 1), "cued-negatives")
    own_grams = grams(words(F.col("passage")))
    training = positives.select("label", own_grams.alias("grams"), F.lit(20.0).alias("weight"))
    training = training.unionByName(singles.select(F.lit(0.0).alias("label"), own_grams.alias("grams"), F.lit(1.0).alias("weight")))
    learned = none.where("NOT held_out").select(own_grams.alias("grams"), F.lit(1).alias("n"))
    for rows in (plain, learned):
        each = min(1.0, weight / (rows.agg(F.sum("n")).first()[0] or 1))
        training = training.unionByName(rows.select(F.lit(0.0).alias("label"), "grams", (F.col("n") * each).alias("weight")))
    weighted = staged(vectorizer.transform(training).select("label", "features", "weight"), "licence-training")
    regression = LogisticRegression(
        family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=60, weightCol="weight", probabilityCol="probability"
    ).fit(weighted)
    model = LicenceModel(vectorizer, regression, least)
    reached = model.classify(none.where("held_out")).agg(F.percentile("probability", 1 - exceeded)).first()[0]
    model.threshold = max(least, min(float(reached or 0.0), CERTAIN))
    return model


def _covers(share: float) -> list[tuple[str, Column]]:
    """For each notice its family, and whether the passage's word pairs hold `share` of its own."""
    own = F.array_distinct(pairs(F.transform(words(F.col("passage")), lambda w: F.regexp_replace(w, r"^[.+-]+|[.+-]+$", ""))))
    out = []
    for family, texts in NOTICES.items():
        for text in texts:
            tokens = [t for t in (w.strip(".+-") for w in _plain_words(text)) if t]
            wanted = list(dict.fromkeys(f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False)))
            out.append((family, F.size(F.array_intersect(F.array(*map(F.lit, wanted)), own)) >= share * len(wanted)))
    return out


def confirmed(share: float = SHARE) -> Column:
    """Whether the passage's pairs hold `share` of those of a notice of the predicted family."""
    found = F.lit(False)
    for family, covered in _covers(share):
        found = found | ((F.col("family") == family) & covered)
    return found


def holds_any(share: float = SHARE) -> Column:
    """Whether the passage's pairs hold `share` of those of any notice."""
    found = F.lit(False)
    for _, covered in _covers(share):
        found = found | covered
    return found


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or c in ".+-" else " " for c in text.lower()).split()


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_passages (with a cue), n_licensed, families (sorted, comma-joined) and probability (the highest)."""
    spark = docs.sparkSession
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("content"), F.col(text_col).cast("string").alias("text")
    )
    # a document without a cue has no passage with one
    likely = passages(source.where(has_cue(F.col("text")))).where(has_cue(F.col("passage")))
    likely = staged(likely, "passages-with-a-cue")
    model = fit(spark, passages(source), likely)
    found = model.classify(likely).withColumn("licensed", (F.col("family") != UNKNOWN) & confirmed())
    by_document = found.groupBy("doc_id", "content").agg(
        F.count("*").alias("n_passages"),
        F.count_if("licensed").alias("n_licensed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("licensed"), F.col("family")))), ",").alias("families"),
        F.max(F.when(F.col("licensed"), F.col("probability"))).alias("probability"),
    )
    keys = source.select("doc_id", "content")
    joined = keys.join(by_document.withColumnRenamed("doc_id", "_id"), keys["doc_id"].eqNullSafe(F.col("_id")) & (keys["content"] == by_document["content"]), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return joined.select(
        keys["doc_id"], zero("n_passages").alias("n_passages"), zero("n_licensed").alias("n_licensed"), F.coalesce("families", F.lit("")).alias("families"), "probability"
    )
