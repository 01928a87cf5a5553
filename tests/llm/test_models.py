"""Language-model scores, languages, licences and pieces."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from semstore.llm import bilinear, language, licences, pieces
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_base_scores_match_brute_force(documents, pairs, monkeypatch):
    found = {r.doc_id: r for r in bilinear.score(documents, vocabulary=50, head=200).collect()}
    tokens = {i: [*brute.words(brute.lower(t)), "\n"] for i, t in pairs}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(w for i, own in tokens.items() if not out[i] for w in own)
    total, kinds = sum(counts.values()), len(counts)
    for i, own in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        row = found[i]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out[i], len(own), sum(counts[w] > 0 for w in own), total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0


def test_model_learns_what_follows(spark):
    random.seed(1)
    following = {"a": "bc", "b": "cd", "c": "da", "d": "ab"}
    texts = []
    for _ in range(600):
        own = ["a"]
        for _ in range(40):
            own.append(random.choices(following[own[-1]], (9, 1))[0])
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in bilinear.score(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.65 * sum(r.base_score for r in rows)


def test_probabilities_sum_to_one():
    counts = bilinear.Counts([b"a", b"b", b"c"], np.array([5, 3, 1]), 2, 12, 5, 2)
    model = bilinear.LogBilinear(5, 4, counts.shares(), seed=3)
    model.train(np.array([(4 * 5 + 4) * 5 + 0, (4 * 5 + 0) * 5 + 1]), np.array([3.0, 1.0]), counts.shares(), 150, 0)
    scorer = bilinear.Scorer(counts, *model.tables())
    contexts = np.arange(25)
    scorer.normalise(contexts)
    rows = scorer.near[contexts % 5] + scorer.far[contexts // 5] - scorer.log_sum[contexts][:, None]
    assert np.exp(rows.astype(np.float64)).sum(axis=1) == pytest.approx(np.ones(25), rel=1e-5)
    # words outside the vocabulary share their entry: c, one known beyond the head with count 1, and one new word
    rare = (1 + 0.1, 1 + 0.1, 0.1)
    assert sum(rare) / counts.rare_divisor == pytest.approx(1.0)


def test_scores_of_odd_rows(odd, nothing):
    rows = bilinear.score(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (2, 3, 4))
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert bilinear.score(nothing).count() == 0
    alone = bilinear.score(odd.where("doc_id = 2 AND crc32(cast(cast(doc_id AS string) AS binary)) % 10 = 0")).collect()
    assert all(r.base_score == 0 and r.score == 0 for r in alone)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in language.identify(docs).collect())


def test_rank_distance_by_hand():
    # "ab ab b": the words with gaps have a, b, _a, ab, b_, _b, ...
    own = language.ranked("ab ab b", 300)
    counts = Counter()
    for word in ("ab", "ab", "b"):
        padded = f"_{word}_"
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    assert len(own) == len(counts)
    profiles = language.Profiles({"x": {int(c): r for r, c in enumerate(own)}, "y": {}}, 300)
    assert profiles.predict("ab ab b") == ("x", 1.0)
    assert profiles.predict("12 !") == ("und", 0.0)


def test_languages_of_odd_rows(odd, nothing):
    rows = language.identify(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3, 4, 9))
    assert {r.lang_pred for r in rows} <= {"und", "en", "de"}
    assert language.identify(nothing).count() == 0
    assert {r.lang_pred for r in language.identify(odd.where("lang IS NULL")).collect()} == {"und"}


def test_pieces_equal_the_library(spark, pairs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = pieces.Encoder(library.serialized_model_proto(), remembered=2_000)
    random.seed(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "▁", "é", "日本", "😀", "\0", "<s>", "<0x0A>", "▁▁", "aaaa", "x" * 50, "ing"]
    odd = ["", " ", "  ", "\n", "▁", "a ", "  a  b   ", "z" * 3_000, "▁" * 40]
    odd += ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(2_000)]
    texts = odd + [t for _, t in pairs]
    for start in range(0, len(texts), 700):
        ids, differs = own.encode(texts[start : start + 700])
        assert [x.tolist() for x in ids] == library.encode(texts[start : start + 700], add_bos=True, add_eos=True, num_threads=1)
        assert not any(differs)


def test_pieces_of_whole_documents(documents, pairs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = {r.doc_id: r for r in pieces.encode(documents, MODEL, digest=True).collect()}
    for i, text in pairs:
        ids = library.encode(text, add_bos=True, add_eos=True)
        want = (len(ids), brute.sha(np.array(ids, dtype="<u4").tobytes()), brute.sha(library.decode(ids)), 0)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256, rows[i].n_differs) == want


def test_pieces_of_odd_rows(odd, nothing):
    rows = pieces.encode(odd, MODEL).collect()
    assert len(rows) == odd.count()
    assert all((r["ids"], r.decoded) == ([1, 2], "") for r in rows if r.doc_id in (2, 3))
    assert pieces.encode(nothing, MODEL).count() == 0


def test_licences(spark):
    notice = {
        0: ("Some words.\nReleased under the MIT License. And more words", "mit"),
        1: ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        2: ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        3: ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        4: ("All rights reserved.", "all-rights-reserved"),
        5: ("The driver lost his licence in the version of the story that we know", ""),
        6: ("a licence to print money and nothing else", ""),
        7: ("Released under the MIT License.\n\nLicensed under CC BY 4.0.", "cc-by,mit"),
    }
    filler = [(100 + i, f"The {w} of the work is under a {w}. You may use this in the terms.") for i, w in enumerate("river house garden table".split())]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in notice.items()] + filler, "doc_id long, text string")
    rows = {r.doc_id: r.families for r in licences.scan(docs).collect()}
    assert {i: rows[i] for i in notice} == {i: f for i, (_, f) in notice.items()}
    assert all(not rows[i] for i, _ in filler)


HEADERS = {
    "agpl-3.0": "Licensed under the GNU Affero General\nPublic License, version 3",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
    'files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use it.',
    "mpl-2.0": " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not\n * distributed",
    "gpl-3.0": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as "
    "published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "gpl-2.0": "// This program is free software; you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as "
    "published by\n// the Free Software Foundation; either version 2 of the License, or\n// (at your option) any later version.",
    "apache-2.0": "// SPDX-License-Identifier: Apache-2.0",
    "lgpl": "SPDX-License-Identifier: LGPL-2.1-or-later",
    "cc-by-nc": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
}


def test_wrapped_and_commented_notices(spark):
    plain = "Nothing here is said about the terms of the work, and you may read it as you like"
    rows = [(i, f"/*\n{t}\n */\nint main;") for i, t in enumerate(HEADERS.values())]
    rows += [(100 + i, f"{plain} {w}.\nIt goes on over\nlines about a licence to {w}") for i, w in enumerate("sing print drive marry go".split())]
    rows += [(200, "word " * 5_000 + "Licensed under the MIT\nLicense " + "word " * 5_000)]
    found = {r.doc_id: r.families for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in range(len(HEADERS))] == list(HEADERS)
    assert found[200] == "mit" and not any(f for i, f in found.items() if 100 <= i < 200)


def shares(text):
    """By plain Python: for each family the largest share of a notice's word pairs that a passage holds."""
    def tokens(t):
        own = [w for w in re.split(r"[^a-z0-9.+-]+", t.lower()) if re.sub(r"[.+-]", "", w)]
        return [re.sub(r"^[.+-]+|[.+-]+$", "", w) for w in own]

    pairs = lambda t: set(zip(t, t[1:], strict=False))
    bare = re.sub(licences._COMMENT, "", text or "")
    cut = re.split(r"\n+|(?<=[.!?])\s+", bare)
    cut += [re.sub(r"\s*\n\s*", " ", p) for p in re.split(r"\n[ \t]*\n\s*|(?<=[.!?])\s+", bare) if "\n" in p.strip(" ")]
    best = {}
    for passage in cut:
        if any(c in passage.lower() for c in licences.CUES):
            own = pairs(tokens(passage))
            for family, notices in licences.NOTICES.items():
                for notice in notices:
                    wanted = pairs(tokens(notice))
                    best[family] = max(best.get(family, 0), len(wanted & own) / len(wanted))
    return best


def test_licences_match_brute_force(spark):
    """Whatever a notice is held by word for word is found, and nothing that no notice confirms."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: set(r.families.split(",")) - {""} for r in licences.scan(docs).collect()}
    some = 0
    for i, text in texts.items():
        best = shares(text)
        whole = {f for f, s in best.items() if s == 1}
        # a notice that is part of another family's does not count against it
        assert found[i] <= {f for f, s in best.items() if s >= licences.SHARE}
        assert len(found[i]) >= min(1, len(whole)) and (len(whole) != 1 or whole <= found[i])
        some += bool(whole)
    assert some >= 10


def test_licences_are_native(spark, sf_dir, documents):
    plan = licences.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_licences_of_odd_rows(odd, nothing):
    rows = licences.scan(odd).collect()
    assert len(rows) == odd.count() and all(r.n_licensed == 0 and r.families == "" for r in rows)
    assert licences.scan(nothing).count() == 0


def test_known_grams_are_those_of_the_notices(spark):
    """What all passages are learned from says the same as their words and pairs, cut to the vocabulary."""
    texts = ["Licensed under the -Apache- License, Version 2.0.", "the the .. the license", "", "a+ --", "of ++ the Terms of"]
    vocabulary = ["the", "license", "the license", "under the", "of the", "terms of", "version 2.0", "2.0", "apache"]
    rows = spark.createDataFrame([(t,) for t in texts], "passage string").coalesce(1)
    own = rows.select(licences.grams(licences.words(F.col("passage")))).collect()
    known = [r.grams for r in licences.known_grams(rows, vocabulary).collect()]
    assert known == [sorted(set(r[0]) & set(vocabulary)) for r in own]


def test_a_licence_model_learns_from_all_passages(spark):
    """Beyond any number of passages, the last one counts as much as the first."""
    docs = spark.range(9_000).select(F.col("id").alias("doc_id"), F.col("id").alias("content"), F.concat(F.lit("the work number "), F.col("id")).alias("passage"))
    odd = spark.range(1_000).select((F.col("id") + 9_000).alias("doc_id"), F.col("id").alias("content"), F.lit("public terms of the foundation").alias("passage"))
    seen = []
    whole = licences.staged
    try:
        licences.staged = lambda df, name: seen.append((name, whole(df, name))) or seen[-1][1]
        licences.fit(spark, docs.unionByName(odd), docs.limit(0))
    finally:
        licences.staged = whole
    (plain,) = (df for name, df in seen if name == "plain-negatives")
    assert plain.agg(F.sum("n")).first()[0] == 10_000
    (training,) = (df for name, df in seen if name == "licence-training")
    weights = sorted(r.weight for r in training.where("label = 0").collect())
    assert weights[-1] == pytest.approx(0.9 * licences.NEGATIVE_WEIGHT, rel=0.02) and weights[-2] == pytest.approx(0.1 * licences.NEGATIVE_WEIGHT)
