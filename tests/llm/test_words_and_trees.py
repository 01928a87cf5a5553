"""Spelling variants, Merkle manifests and document fingerprints."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from semstore.llm import fingerprints, manifest, variants
from tests.llm import brute

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def words_of(df):
    rows = df.select(*COLUMNS).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def test_variants_match_brute_force(documents, pairs):
    assert words_of(variants.spelling_variants(documents)) == brute.variants(pairs)
    assert words_of(variants.spelling_variants(documents, dropped=0)) == brute.variants(pairs, dropped=0)


@pytest.mark.parametrize("seed", range(3))
def test_words_of_few_letters(spark, seed):
    """Repeated letters, long chains of forms, equal counts, groups under one prefix."""
    drawn = random.Random(seed)
    words = {"".join(drawn.choices("abé", k=drawn.randint(1, 7))) for _ in range(500)} | {"a" * k for k in range(1, 12)}
    counts = {w: 5 ** drawn.randint(0, 9) + drawn.randint(0, 1) for w in words}
    found = variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert words_of(found) == brute.group_variants(counts)


def test_a_pair_meets_once(spark):
    vocab = spark.createDataFrame([("aaaa", 9), ("aaa", 5), ("aaba", 5), ("bbbb", 1)], "word string, n long")
    near = {r.word: (r.n_near, r.best["word"]) for r in variants.neighbours(vocab).collect()}
    assert near == {"aaaa": (2, "aaa"), "aaa": (2, "aaaa"), "aaba": (2, "aaaa")}
    assert variants.rotations(vocab).groupBy("prefix", "letter").count().where("count > 1").count() == 0


def test_variants_of_odd_rows(spark, odd, nothing):
    pairs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = words_of(variants.spelling_variants(odd))
    assert found == brute.variants(pairs) and "twelve" not in found
    assert variants.spelling_variants(nothing).collect() == []


def audited(df):
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def rows_of(df):
    return [tuple(r) for r in df.select(*manifest.COLUMNS).collect()]


def test_manifest_matches_brute_force(documents):
    assert audited(manifest.audit(documents)) == sorted(brute.merkle(rows_of(documents)), key=repr)


def test_manifest_of_odd_rows(odd, nothing):
    assert audited(manifest.audit(odd)) == sorted(brute.merkle(rows_of(odd)), key=repr)
    assert manifest.audit(nothing).collect() == []
    one = odd.where("doc_id = 7")
    (row,) = manifest.audit(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == brute.sha("")


@pytest.mark.parametrize("fan_out", [2, 3])
def test_trees_of_any_size(spark, fan_out):
    """One source with half of all rows, many small ones; binary and ternary trees of different heights."""
    sizes = {"big": 300, **{f"s{i}": i for i in range(1, 20)}, None: 5}
    rows = [(i, s, None, i, f"Text {s} {i}") for s, n in sizes.items() for i in range(n)]
    rows += [(7, "big", None, 7, "Text big 7")] * 20
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert audited(manifest.audit(docs, fan_out=fan_out)) == sorted(brute.merkle(rows, fan_out), key=repr)
    with pytest.raises(ValueError):
        manifest.grow(docs.select(F.lit(0).alias("tree"), F.lit(0).alias("at"), F.lit(1).alias("of"), F.lit("").alias("digest")), 1)


def test_a_change_anywhere_changes_the_root(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"text {i}") for i in range(60)]
    names = "doc_id long, source string, lang string, n_chars long, text string"
    root = manifest.build(spark.createDataFrame(rows, names)).root
    assert root == manifest.build(spark.createDataFrame(rows[::-1], names).repartition(4)).root
    for changed in ((30, "s0", "en", 30, "text 31"), (30, "s0", None, 30, "text 30"), (61, "s0", "en", 30, "text 30")):
        assert manifest.build(spark.createDataFrame([*rows[:30], changed, *rows[31:]], names)).root != root


# --- fingerprints

LINES = "One line of some words. Another sentence follows it, longer than the first one was.\n"


def text_of(seed, n=200):
    drawn = random.Random(seed)
    words = (f"w{drawn.randint(0, 4000)}{drawn.choice(['', '', '', '.', chr(10)])}" for _ in range(n))
    return " ".join(words)


def next_and_edit(pairs):
    """By plain Python: (n_chars, digest of the edit, likeness to the edit, to the next) of rows in order."""
    order = sorted(set((i is None, i or 0, t or "") for i, t in pairs), key=lambda r: (r[0], r[1]))
    out = {}
    for (none, i, text), after in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        edit = text[: len(text) - half] + after[2][:half]
        alike = (plain_likeness(text, edit), plain_likeness(text, after[2]))
        out[None if none else i] = (len(text), hashlib.sha256(edit.encode()).hexdigest(), *alike)
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    one, two = ([p for line in t.splitlines(keepends=True) for p in fingerprints.phrases(line)] for t in (a, b))
    rest, common = list(two), 0
    for p in one:
        if p in rest:
            rest.remove(p)
            common += 1
    return 2 * common / (len(one) + len(two)) if one or two else 1.0


@pytest.mark.parametrize("range_bytes", [fingerprints.RANGE_BYTES, 2_000])
def test_next_documents_and_edits(spark, range_bytes):
    pairs = [(i * 3 % 101, text_of(i, i * 4 % 150)) for i in range(101)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    want = next_and_edit(pairs)
    rows = fingerprints.with_edits(docs, range_bytes=range_bytes).collect()
    assert len(rows) == 101
    for r in rows:
        n, digest, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert r.near_edited == pytest.approx(edited, abs=0.03) and r.near_next == pytest.approx(after, abs=0.03)


def test_fingerprints_of_documents(documents, pairs):
    rows = fingerprints.with_edits(documents).collect()
    want = next_and_edit(pairs)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == {i: v[:2] for i, v in want.items()}
    texts = dict(pairs)
    by_text, by_print = {}, {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert by_print.setdefault(r.fingerprint, texts[r.doc_id]) == texts[r.doc_id]
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
    # half of a text of some length is kept, and the next one is another text
    long = [r for r in rows if r.n_chars >= 400]
    assert sum(0.3 <= r.near_edited <= 0.95 for r in long) >= 0.95 * len(long)
    assert sum(r.near_next < 0.2 for r in long) >= 0.9 * len(long)


def test_fingerprints_of_odd_rows(spark, odd, nothing):
    rows = fingerprints.with_edits(odd).collect()
    assert len(rows) == odd.count()
    one, again = (r for r in rows if r.doc_id == 1)
    assert one == again
    assert {r.n_chars for r in rows if r.doc_id in (2, 3)} == {0}
    assert next(r.near_next for r in rows if r.doc_id == 5) == 1.0
    assert next(r.near_next for r in rows if r.doc_id == 2) == 1.0
    assert [r.n_chars for r in rows if r.doc_id is None] == [len("no id here, but some words and a few more of them to make it longer")]
    assert fingerprints.with_edits(nothing).collect() == []
    (alone,) = fingerprints.with_edits(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).collect()
    assert alone.edited_sha256 == brute.sha("abab") and alone.near_next == 1.0
    copies = spark.createDataFrame([(4, "same text")] * 300 + [(5, "x")], "doc_id long, text string").repartition(3)
    found = fingerprints.with_edits(copies).collect()
    assert len(found) == 301 and {r.edited_sha256 for r in found if r.doc_id == 4} == {brute.sha("same x")}


def test_edits_are_located(spark):
    text = "".join(f"{LINES}Paragraph {i} has {i * 7} words of its own.\n" + ("\n" if i % 5 == 4 else "") for i in range(40))
    print_ = fingerprints.fingerprint(text)
    at = text.index("Paragraph 17")
    changed = text[:at] + "Section" + text[at + 9 :]
    spans = fingerprints.edited_spans(changed, print_)
    assert len(spans) == 1 and spans[0][0] <= at < spans[0][1] <= at + 60
    assert fingerprints.edited_spans(text, print_) == []
    assert 0.97 < fingerprints.likeness(print_, fingerprints.fingerprint(changed)) < 1
    old = fingerprints.fingerprints(spark.createDataFrame([(1, text), (2, "gone"), (4, None)], "doc_id long, text string"))
    new = spark.createDataFrame([(1, changed), (3, "new"), (4, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprints.compare(old, new).collect()}
    assert [(s.begin, s.end) for s in rows[1].spans] == spans and rows[4].likeness == 1.0 and rows[4].spans == []
    assert rows[2].likeness is None and rows[3].spans is None


def test_phrases_are_the_text():
    for seed in range(20):
        text = text_of(seed, seed * 10)
        assert "".join(p for line in text.split("\n") for p in fingerprints.phrases(line)) == text.replace("\n", "")
    long = "word " * 300_000
    assert "".join(fingerprints.phrases(long)) == long
    assert fingerprints.fingerprint("") == fingerprints.fingerprint("", {}) and len(fingerprints.fingerprint("")) == 32
    assert len({fingerprints.fingerprint(t) for t in ("", " ", "a", "a ", "a\n", "a\n\n", "a b", "b a", "a\nb")}) == 9
