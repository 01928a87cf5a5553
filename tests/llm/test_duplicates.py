"""Near duplicates, repeated sentences and repeated substrings."""

import random

import numpy as np
import pytest

from semstore.llm import components, induced, sentences, setsketch, substrings
from tests.llm import brute


def test_near_duplicates_match_brute_force(documents, pairs):
    found = setsketch.near_duplicates(documents, shingle=4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_duplicates(pairs)


def test_chains_and_large_groups(spark, monkeypatch):
    """Variants of one text, some linked only through others; blocks of a few rows."""
    monkeypatch.setattr(setsketch, "BLOCK", 7)
    random.seed(4)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(80):
        own = list(base)
        for j in range(i // 8):
            own[(j * 11 + i // 8) % 120] = f"v{i // 8}-{j}"
        texts.append(" ".join(own) + (f" x{i}" if i % 3 else ""))
    texts += [" ".join(random.choices(base, k=60)) for _ in range(20)]
    order = list(range(len(texts)))
    random.shuffle(order)
    docs = [(100 + n, texts[k]) for n, k in enumerate(order)]
    found = setsketch.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=4)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == brute.near_duplicates(docs)


def test_sketches_merge_and_estimate():
    random = np.random.default_rng(3)
    a, b = np.unique(random.integers(0, 2**63, 900).astype(np.uint64)), np.unique(random.integers(0, 2**63, 300).astype(np.uint64))
    both = np.unique(np.r_[a, b])
    one, two, union = setsketch.sketch([a, b, both])
    assert (np.maximum(one, two) == union).all()
    share = setsketch.estimate(one[None], union[None], np.array([900.0]), np.array([1200.0]))[0]
    assert abs(share - 0.75) < 0.12
    assert setsketch.estimate(one[None], one[None], np.array([900.0]), np.array([900.0]))[0] > 0.99


def test_near_duplicates_of_odd_rows(odd, nothing):
    rows = setsketch.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True) for r in rows if r.doc_id in (2, 3, 4))
    assert [(r.component_id, r.kept) for r in rows if r.doc_id == 6] == [(5, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert setsketch.near_duplicates(nothing).count() == 0


def test_components(spark):
    random.seed(1)
    links = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links + [(5, None)], "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert got == brute.components([x for x in links if x[0] != x[1]], nodes)


def sentence_marks(docs, run=3, least=20):
    """The rule with plain tuples of words in place of hashes."""
    first, out = {}, {}
    for i, text in sorted(docs):
        parts = sentences.pieces(text or "")
        assert "".join(parts) == (text or "")
        own, gone = [tuple(p.lower().split()) for p in parts], set()
        fits = lambda a, b: b - a >= run and sum(map(len, own[a:b])) >= least  # noqa: E731, B023
        size = len(parts)
        bounds = {(a, next((b for b in range(a, size + 1) if fits(a, b)), None)) for a in range(size)}
        bounds |= {(next((a for a in range(b, -1, -1) if fits(a, b)), None), b) for b in range(1, size + 1)}
        for a, b in sorted(x for x in bounds if None not in x):
            span = tuple(own[a:b])
            if first.setdefault(span, (i, a)) != (i, a):
                gone |= set(range(a, b))
        out[i] = (len(parts), len(gone), "".join(p for n, p in enumerate(parts) if n not in gone))
    return out


def test_sentence_spans_match_brute_force(documents, pairs):
    found = sentences.remove_repeated(documents).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, r.kept_text) for r in found} == sentence_marks(pairs)


def test_passages_are_removed_wherever_they_stand(spark):
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefgh", k=6))
    passage = " ".join(word() for _ in range(60))  # no end mark in it
    texts = [" ".join(word() for _ in range(30)) + f" {passage} " + " ".join(word() for _ in range(30)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in sentences.remove_repeated(docs).collect()}
    assert rows[0].n_removed_words == 0
    assert all(25 <= rows[i].n_removed_words <= 80 for i in range(1, 6))


@pytest.mark.parametrize("space, marks", [(" ", 0), (" ", 20), (" ", 32), ("", 0)])
def test_any_51_words_hold_a_span(space, marks):
    """A passage inside other words: never missed, and all but the cut sentences at its edges goes."""
    for seed in range(400):
        rng = random.Random(seed)
        word = lambda: "".join(rng.choices("abcdefgh", k=5)) if space else chr(rng.randint(0x4E00, 0x9FFF))  # noqa: E731, B023
        words = lambda n: [word() + ("." if marks and rng.random() < 1 / marks else "") for _ in range(n)]  # noqa: E731, B023
        passage = words(51)
        one, two = (space.join([*words(rng.randint(1, 40)), *passage, *words(rng.randint(1, 40))]) for _ in range(2))
        known = set(sentences.spans(*sentences.cut(one)[1:])[:, 0].tolist())
        repeated = [{"start": a, "end": b} for h, a, b in sentences.spans(*sentences.cut(two)[1:]).tolist() if h in known]
        _, _, n_words, kept = sentences._without(two, repeated)
        assert n_words >= 51 - 2 * (2 * sentences.WINDOW - 1)
        head, tail = two[: len(two) - len(kept)], two[len(kept) :]
        assert kept != two and any(two[:i] + two[i + len(two) - len(kept) :] == kept for i in range(len(kept) + 1)) and head and tail


def test_sentence_spans_of_odd_rows(odd, nothing):
    rows = sentences.remove_repeated(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.n_sentences, r.n_removed, r.kept_text) == (0, 0, "") for r in rows if r.doc_id in (2, 3))
    assert [r.kept_text for r in rows if r.doc_id == 6] == [""]
    assert sentences.remove_repeated(nothing).count() == 0


@pytest.fixture(scope="module")
def twins(spark):
    """Two unrelated texts whose 32-bit hashes agree."""
    words = "array_join(transform(sequence(1, 40), i -> substr(md5(concat(id, ' ', i)), 1, 7)), ' ')"
    made = spark.range(200_000).selectExpr(f"{words} AS text").selectExpr("text", "hash(text) AS h")
    pair = made.groupBy("h").agg({"text": "collect_list"}).toDF("h", "t").where("size(t) > 1").orderBy("h").first()
    return pair.t[:2]


def test_rows_without_an_id_are_told_apart(spark, twins):
    """Texts without an id whose 32-bit hashes agree: only the one that is a copy goes."""
    one, other = twins
    docs = spark.createDataFrame([(1, one), (None, one), (None, other), (None, None)], "doc_id long, text string")
    found = substrings.remove_repeated(docs).collect()
    assert sorted((r.n_removed, bytes(r.kept)) for r in found if r.doc_id is None) == [(0, b""), (0, other.encode()), (len(one), b"")]
    found = sentences.remove_repeated(docs).collect()
    assert sorted(r.kept_text for r in found if r.doc_id is None) == ["", "", other]
    assert [r.kept_text for r in found if r.doc_id == 1] == [one]


def naive(text):
    text = list(text)
    return sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("block, names, memory", [(1 << 18, 1 << 22, 1 << 20), (1 << 18, 5, 1 << 20), (7, 5, 10)])
def test_suffix_arrays(monkeypatch, block, names, memory):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "IN_MEMORY", names)
    random.seed(3)
    for k in range(150):
        text = np.array([random.randint(1, random.choice([1, 2, 3, 9])) for _ in range(random.randint(1, 70))])
        if k % 5 == 0:
            text = np.tile(text[: random.randint(1, 5)], 9)
        assert induced.suffix_array(text, memory).tolist() == naive(text)


@pytest.mark.parametrize("many", [20_000, 1])
def test_substrings_match_brute_force(documents, pairs, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY", many)
    found = substrings.report(substrings.remove_repeated(documents)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute.repeated_bytes(pairs)


@pytest.mark.parametrize("many", [20_000, 1])
def test_repeated_rows_are_one_document(spark, monkeypatch, many):
    """A long repeated row that shares a passage, in other surroundings, with other documents."""
    monkeypatch.setattr(substrings, "MANY", many)
    random.seed(9)
    letters = lambda n: "".join(random.choices("abcdefgh ", k=n))
    passage = letters(150)
    docs = [(i, letters(200) + passage + letters(200)) for i in range(4)]
    want = brute.repeated_bytes(docs)
    repeated = docs + [docs[0]] * 2 + [docs[2]]
    found = substrings.report(substrings.remove_repeated(spark.createDataFrame(repeated, "doc_id long, text string"))).collect()
    assert len(found) == 7
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in found)


def test_short_strings_and_overlaps(spark):
    random.seed(6)
    docs = [(i, "".join(random.choices("ab", k=random.randint(0, 300))) + "abcabc" * random.randint(0, 20)) for i in range(40)]
    docs += [(50, "é" * 80), (51, "x" + "é" * 80), (52, None)]
    found = substrings.report(substrings.remove_repeated(spark.createDataFrame(docs, "doc_id long, text string"), length=30))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.collect()}
    assert got == brute.repeated_bytes(docs, 30)


def test_segments_cover_every_string_once(monkeypatch):
    monkeypatch.setattr(substrings, "PART", 64)
    text = np.random.default_rng(1).integers(97, 100, 900).astype(np.uint8)
    rows = substrings.segments_of(text, 40)
    starts = [s for _, a, b in rows.tolist() for s in range(a, b + 1)]
    assert starts == list(range(len(text) - 39))


def test_substrings_of_odd_rows(odd, nothing):
    rows = substrings.remove_repeated(odd).collect()
    assert len(rows) == odd.count()
    assert all((r.n_bytes, r.n_removed, r.n_spans) == (0, 0, 0) for r in rows if r.doc_id in (2, 3))
    assert [len(r.kept) for r in rows if r.doc_id == 6] == [0]
    assert substrings.remove_repeated(nothing).count() == 0
