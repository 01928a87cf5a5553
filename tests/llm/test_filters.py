"""Quality rules, decontamination and personal data."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from semstore.llm import decontaminate, pii, quality
from tests.llm import brute


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_statistics_and_base_rule(spark, sf_dir, documents, pairs):
    found = quality.quality(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = by_id(found, *quality.BASE, "base_failed", "kept")
    for i, text in pairs:
        want = brute.rule_statistics(text)
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert rows[i][:6] == (*want, failed)
        assert not (failed and rows[i][6])


def test_forests_catch_bad_rows_and_keep_good_ones(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality(docs, labels).where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg({"*": "count"})
    kept = quality.quality(docs, labels).where("kept").join(labels, "doc_id").groupBy("quality").agg({"*": "count"})
    total, left = dict(map(tuple, judged.collect())), dict(map(tuple, kept.collect()))
    assert left[1] >= 0.98 * total[1] and left.get(0, 0) <= 0.2 * total[0]
    filtered = {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()}
    assert filtered == {r.doc_id for r in quality.quality(docs, labels).where("kept").select("doc_id").collect()}


def test_path_lengths_set_outliers_apart():
    random = np.random.default_rng(1)
    rows = np.vstack([random.normal(0, 1, (500, 2)), [[9.0, 9.0]]])
    score = quality.IsolationForest.grow(rows, 100, 64).score(rows)
    assert score.argmax() == 500 and score[500] > 0.6 > np.median(score)


def test_thresholds_come_from_all_labelled_rows(spark):
    """More labelled rows than a driver should hold: the thresholds are those of all of them."""
    n, noise = 30_000, lambda i: F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(1_000))
    words = F.lit(200) + noise(1)
    made = {"n_words": words, "word_chars": words * 5 + noise(2), "n_symbols": F.when(F.col("doc_id") % 50 == 0, 90).otherwise(noise(3) / 300),
            "n_dup_lines": noise(4) / 200, "n_repeat_words": noise(5) / 100, "n_lines": 20 + noise(6) / 100, "n_distinct": words - noise(7) / 8}
    statistics = spark.range(n).withColumnRenamed("id", "doc_id").withColumns({c: v.cast("long") for c, v in made.items()})
    labels = statistics.select("doc_id", (F.col("doc_id") % 50 != 0).cast("int").alias("quality"))
    model = quality.fit(statistics, labels, max_loss=0.01)
    table = statistics.select("doc_id", *quality.BASE, *quality.EXTRA).toPandas().to_numpy()
    features, good = quality.features_of(table[:, 1:]), table[:, 0] % 50 != 0
    assert len(model.parts) == len(quality.GROUPS) and any(np.isfinite(at) for _, _, at in model.parts)
    for group, forest, at in model.parts:
        if np.isfinite(at):
            score = np.sort(forest.score(features[good][:, group]))
            assert at == score[len(score) - 1 - int(0.01 * len(score))]


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    rows = quality.quality(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (2, 3, 4))
    assert all(r.kept for r in rows if r.doc_id in (1, 7))
    assert quality.quality(nothing, labels).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.quality(odd, labels.where("false")).count() == odd.count()


@pytest.mark.parametrize("block_bytes", [1 << 20, 2_000])
def test_contamination_matches_brute_force(spark, sf_dir, documents, pairs, block_bytes):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").union(
        spark.createDataFrame([(900, "the of and"), (901, ""), (902, None), (903, "Of, THE and!"), (904, "de")], "item_id long, text string")
    )
    found = decontaminate.contamination_report(decontaminate.find_contamination(documents, benchmark, block_bytes=block_bytes))
    rows = by_id(found, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.contamination(pairs, [tuple(r) for r in benchmark.select("item_id", "text").collect()])
    assert rows == want
    left = decontaminate.without_contaminated(documents, benchmark, block_bytes=block_bytes)
    assert {r.doc_id for r in left.collect()} == {i for i, r in want.items() if not r[4]}


def test_every_shared_window_is_found():
    random.seed(5)
    for _ in range(50):
        item = [f"w{random.randint(0, 5)}" for _ in range(random.randint(13, 40))]
        at = random.randint(0, len(item) - 13)
        text = ["x"] * random.randint(0, 4) + item[at : at + 13] + ["y"] * random.randint(0, 4)
        index = decontaminate.Index.build([("q", " ".join(item))], 13, 5)
        ((count, spans, names),) = index.scan([" ".join(text).encode()])
        assert count == len(text) and names == ["q"] and (spans[:, 1] - spans[:, 0]).sum() >= 13


def test_contamination_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([("a", "seven eight nine ten eleven twelve"), (None, "one two"), ("a", "fünf"), ("b", None)], "item_id string, text string")
    rows = decontaminate.find_contamination(odd, items).collect()
    assert len(rows) == odd.count()
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows if r.doc_id == 1] == [(12, 8, ["a"])] * 2
    assert [(r.n_words, r.n_hit, r["items"]) for r in rows if r.doc_id in (2, 3, 4)] == [(0, 0, [])] * 3
    assert decontaminate.find_contamination(nothing, items).count() == 0
    assert decontaminate.find_contamination(odd, items.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.without_contaminated(odd, items).columns == odd.columns


def plain_spans(text):
    out = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_patterns_match_their_plain_form(pairs):
    random.seed(2)
    alphabet = ["a", "1", "4", "@", ".", "-", "+", " ", "(", ")", "é", "x.y@b.c", "10.0.0.1", "4111 1111 1111 1111", "+1 (555) 010-0000", "\n"]
    made = ["".join(random.choices(alphabet, k=random.randint(0, 30))) for _ in range(3_000)]
    for text in [*made, *(t for _, t in pairs)]:
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_classifier_adds_secrets(spark):
    secret = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    texts = [f'the token = "{secret(i)}" and password={secret(-i)[:18]} here' for i in range(1, 40)]
    texts += ["plain text about nothing: something else = nothingness"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert all(rows[i].n_other == 2 for i in range(39)) and all(rows[i].n_other == 0 for i in range(39, 79))
    cleaned = [r.text for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert cleaned[0] == 'the token = "[other]" and password=[other] here' and cleaned[-1] == texts[-1]


def test_names_after_every_title():
    for title in pii.TITLES:
        for sign in (" ", ". ", "."):
            for name in ("Smith", "Ng", "Weber-Krüger", "Ángel Brown"):
                text = f"then {title}{sign}{name} spoke"
                assert [text[a:b] for a, b, _, _ in pii.candidates(text, [])] == [name]
    assert [s[:2] for s in pii.candidates("Frau Prof. Dr. Weber said", [])] == [(15, 20)]
    assert pii.candidates("a Dr. Prof. was there", []) == []


def test_names_and_long_secrets_are_redacted(spark):
    secret = lambda i: "".join(hashlib.sha1(f"{i} {k}".encode()).hexdigest() for k in range(12))
    texts = [f"a letter of Dr. Smith{i}son and of Mrs. Walker to Herr Klein" for i in range(30)]
    texts += [f'the token = "{secret(i)}" here' for i in range(30)]
    texts += ["plain text about nothing: something else = nothingness"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cleaned = [r.text for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert set(cleaned[:30]) == {"a letter of Dr. [other] and of Mrs. [other] to Herr [other]"}
    assert set(cleaned[30:60]) == {'the token = "[other]" here'} and cleaned[60:] == texts[60:]


def test_reliabilities():
    votes = np.array([[1, 1, 0], [1, 0, 0], [2, 2, 1], [2, 2, 0], [0, 0, 1]])
    model = pii.aggregate_votes(votes, np.array([50.0, 20.0, 10.0, 200.0, 5.0]))
    share = model.posterior(votes)
    assert share[0] > 0.9 and share[1] > 0.8 and share[3] < 0.1


def test_personal_data_of_odd_rows(odd, nothing):
    rows = pii.find_personal_data(odd).collect()
    assert len(rows) == odd.count()
    assert {r.spans for r in rows if r.doc_id in (2, 3, 4)} == {""}
    assert pii.find_personal_data(nothing).count() == 0
    kept = pii.redact(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 2").first().text is None


def plain_base(text):
    found = [("email", *m.span()) for m in pii.EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in pii.IP.finditer(text) if all(int(p.lstrip("0")[:9] or 0) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in pii.CARD.finditer(text) if pii._is_card(m[0])]
    return found + [("phone", *m.span()) for m in pii.PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


def test_patterns_in_odd_places():
    parts = ["@", ".", "a", "b1", "1", "25", "256", "0255", ".", "-", "+", "(", "0", "%", " ", "é", "@x.y", "4111 1111 1111 1111", "1.2.3." + "4" * 5000]
    drawn = random.Random(1)
    for _ in range(5000):
        text = "".join(drawn.choice(parts[:-1] if drawn.random() < 0.99 else parts) for _ in range(drawn.randint(0, 40)))
        assert pii.base_spans(text) == plain_base(text)


@pytest.mark.parametrize("unit", ["1", "1.", "1.2.3.4", "a", "a@", "@", "+1(((((", "1 ", "Mr. ", "a@b.c ", "x-", "....", "DE12 ABCD ", "key=a1 "])
def test_a_megabyte_of_one_thing(unit):
    """Work in proportion to the text: ten times the text takes no more than about ten times as long."""
    import time

    def seconds(n):
        text = "a.b 1.2.3." + unit * (n // len(unit)) + "@b 1"
        start = time.process_time()
        pii.candidates(text, pii.base_spans(text))
        return time.process_time() - start

    short = seconds(100_000)
    assert seconds(1_000_000) < 30 * max(short, 0.05)


def spans_by_hand(text, model):
    """Base spans, then every candidate that touches none of them and that the classifier takes for personal data."""
    base = plain_base(text)
    weights, out = model.weights, list(base)
    for start, end, _, features in pii.candidates(text, []):
        if any(s < end and start < e for _, s, e in base):
            continue
        # features that look at a base span do not exist: the same candidate has the same ones
        total = weights[-1] + sum(w for i, w in enumerate(weights[:-1]) if features >> i & 1)
        if 1 / (1 + np.exp(-total)) >= model.threshold:
            out.append(("other", start, end))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_spans_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.fit(docs.select("doc_id", "text"))
    assert model.weights is not None
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = pii.find_personal_data(docs).collect()
    assert any(r.n_other for r in found)
    for r in found:
        assert r.spans == spans_by_hand(texts[r.doc_id], model)
