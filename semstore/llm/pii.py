"""Personal data: fixed patterns, and more spans by aggregated weak labels.

Candidates beyond the patterns are words and runs of words that could be personal data: key-like strings, numbers after
a cue, handles, addresses of sites with a user part, names after a title. Labelers of three kinds (regular expressions,
gazetteers, words before the candidate) each vote yes, no or nothing. Expectation-maximisation over the vote patterns of
the whole corpus estimates how reliable every labeler is, and with it the probability that a candidate is personal data.
A logistic span classifier is then trained on the candidates' features with these probabilities as targets, and decides.

Votes and features are small numbers, so the corpus reaches the driver as counts of their patterns only, at most
2**(2 * labelers + features) of them in theory, and MAX_PATTERNS by check.

Defined cases: null is an empty text; texts of any length are searched whole, in time proportional to it; rows are handled one by one, so repeated
rows and ids stay; without any candidate only the patterns' spans are returned.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import id_and_text, slices, texts_of

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
MAX_PATTERNS = 100_000

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


#: Runs of characters that hold every match of the card pattern with 13 digits or more.
_DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
#: Numbers joined by single dots: every address lies in one, and the addresses in it are its numbers four by four.
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by kind, then start; offsets in code points, the end exclusive.

    The work is in proportion to the text whatever it holds: where a pattern tried at each place would read a long run
    again and again, the run is read once.
    """
    found = _emails(text)
    if text.count(".") >= 3:
        found += _addresses(text)
    found += [("card", m.start(), m.end()) for m in _DIGIT_RUN.finditer(text) if _is_card(m[0])]
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def _emails(text: str) -> list[Span]:
    """Matches of EMAIL: a domain behind an `@`, and all that can be its user before it."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append(("email", start, domain.end()))
                done = domain.end()
        done = max(done, at + 1)
        at = text.find("@", done)
    return found


def _addresses(text: str) -> list[Span]:
    """Matches of IP whose parts are at most 255."""
    found = []
    for match in _DOTTED.finditer(text):
        numbers = match[0].split(".")
        at = match.start()
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(_at_most_255(number) for number in four):
                found.append(("ip", at, end))
            at = end + 1
    return found


def _at_most_255(number: str) -> bool:
    short = number.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def _is_card(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


#: Words that announce a secret or an identity, titles before names, and first names: fixed gazetteers.
SECRET_CUES = (
    "password passwd pwd passcode secret token api_key apikey access_key key credential credentials passphrase "
    "bearer signature session_id"
).split()
IDENTITY_CUES = (
    "ssn social iban bic swift passport account phone tel telephone mobile fax call licence license insurance birth born dob "
    "tax vat national patient customer member"
).split()
TITLES = (
    "Mr Mrs Ms Miss Mx Dr Prof Professor Sir Madam Rev Hon Herr Frau Doktor Monsieur Madame Mademoiselle Maître "
    "Señor Señora Señorita Don Doña Signor Signora"
).split()
FIRST_NAMES = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas "
    "Sarah Charles Karen Christopher Lisa Daniel Nancy Matthew Betty Anthony Margaret Mark Sandra Donald Ashley Steven Kimberly "
    "Paul Emily Andrew Donna Joshua Michelle Kenneth Carol Kevin Amanda Brian Melissa George Deborah Anna Peter Maria Hans Klaus "
    "Sabine Jürgen Wolfgang Ursula Monika Petra Stefan Andreas Heike Birgit Uwe Dieter Helga Ingrid Matthias Katharina Pierre "
    "Marie Jean Sophie Nicolas Camille François Françoise Jacques Nathalie Isabelle Laurent Julien Chloé Thierry Sylvie Carlos "
    "Carmen José Lucía Antonio Ana Manuel Josefa Francisco Isabel Javier Pilar Miguel Dolores Alejandro Teresa Fernando Rosa "
    "Sergio Elena"
).split()
_FIRST = frozenset(FIRST_NAMES)
#: Prefixes that issuers give their keys.
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "xoxb-", "xoxp-", "sk_live_", "sk_test_", "AIza", "eyJ")



def _one_of(words: list[str]) -> str:
    """A pattern for any of the words, by first letter: one comparison settles most places of a text."""
    letters = sorted({w[0] for w in words})
    longest_first = lambda c: sorted((w[1:] for w in words if w[0] == c), key=len, reverse=True)
    return "(?:" + "|".join(f"{c}(?:{'|'.join(longest_first(c))})" for c in letters) + ")"


_TITLE = _one_of(TITLES)
_NAME = r"[A-ZÀ-ÖØ-Þ][\w-]+"
CANDIDATE = re.compile(
    r"(?P<key>(?<![\w-])(?=[A-Za-z0-9_-]{16})(?=[\w-]*[0-9])[A-Za-z0-9_-]{16,}(?![\w-]))"
    rf"|(?P<cued>(?<=[=:])\s?[\"']?(?P<value>[^\s\"'=:]{{6,}}))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?!\w))"
    rf"|\b(?:{_TITLE}(?:\.\s{{0,2}}|\s{{1,2}})){{1,4}}(?P<name>(?!{_TITLE}\b){_NAME}(?:\s{_NAME})?)"
    rf"|(?P<known>\b{_one_of(FIRST_NAMES)}\s{_NAME})"
)
_SECRET_BEFORE = re.compile(rf"(?:{'|'.join(SECRET_CUES)})[\"']?\s{{0,2}}[=:]?\s{{0,2}}[\"']?$", re.IGNORECASE)
_IDENTITY_BEFORE = re.compile(rf"\b(?:{'|'.join(IDENTITY_CUES)})\w{{0,6}}\W{{0,4}}(?:is|no|number|nr)?\W{{0,3}}$", re.IGNORECASE)
_TITLE_BEFORE = re.compile(rf"\b{_TITLE}(?:\.\s{{0,2}}|\s{{1,2}})$")
_HEX = re.compile(r"[0-9a-fA-F-]+")

LABELERS = ("pattern_key", "pattern_number", "pattern_plain", "pattern_digits", "gazetteer_prefix", "gazetteer_name", "context_secret", "context_identity", "context_title")
FEATURES = ("digits", "mixed_case", "long", "high_entropy", "after_sign", "quoted", "prefix", "secret_cue", "identity_cue", "name_shape", "plain_word", "only_digits")


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, int, int]]:
    """Start, end, votes (two bits a labeler: 1 yes, 2 no) and features (one bit each) of the candidate spans."""
    begins, ends = _merged(taken)
    out = []
    for match in CANDIDATE.finditer(text):
        start, end = match.span("value" if match["value"] else "name" if match["name"] else 0)
        while end > start and text[end - 1] in ".,;!?)":
            end -= 1
        # after a title, short words are names too
        if end - start < 4 and not match["name"]:
            continue
        last = bisect.bisect_left(begins, end) - 1  # of what begins before the end, only the last can reach over the start
        if last >= 0 and ends[last] > start:
            continue
        value, before = text[start:end], text[max(0, start - 32) : start]
        digits = sum(c.isdigit() for c in value)
        letters = sum(c.isalpha() for c in value)
        secret, identity = bool(_SECRET_BEFORE.search(before)), bool(_IDENTITY_BEFORE.search(before))
        prefix = value.startswith(KEY_PREFIXES)
        known = match["known"] is not None or match["name"] is not None and value.split()[0] in _FIRST
        name = match["name"] is not None or known
        entropy = _entropy(value)
        hexadecimal = len(value) >= 16 and _HEX.fullmatch(value) is not None and 0 < digits < len(value)
        keyed = hexadecimal or (len(value) >= 16 and digits >= 3 and letters >= 6 and entropy >= 3.2)
        plain = digits == 0 and not name
        votes = (
            1 if keyed else 2 if plain else 0,
            1 if match["ssn"] or match["iban"] else 0,
            2 if plain else 0,
            2 if digits == len(value) and not identity else 0,
            1 if prefix else 0,
            1 if known else 2 if plain else 0,
            1 if secret else 2 if plain else 0,
            1 if identity else 0,
            1 if name and _TITLE_BEFORE.search(before) else 0,
        )
        features = (
            digits > 0, value != value.lower() and value != value.upper(), len(value) >= 16, entropy >= 3.2,
            before[-1:] in "=:" or before[-2:-1] in "=:", before[-1:] in "\"'", prefix, secret, identity, name, plain, digits == len(value),
        )
        out.append((start, end, sum(v << 2 * i for i, v in enumerate(votes)), sum(bool(f) << i for i, f in enumerate(features))))
    return out


def _merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Begins and ends of the stretches that spans cover, in order."""
    begins: list[int] = []
    ends: list[int] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(start)
            ends.append(end)
    return begins, ends


def _entropy(value: str) -> float:
    counts = np.unique(np.frombuffer(value.encode("utf-32-le"), dtype=np.uint32), return_counts=True)[1] / len(value)
    return float(-(counts * np.log2(counts)).sum())


@dataclass
class Reliability:
    """What each labeler says (columns: nothing, yes, no) of personal data and of other candidates."""

    prior: float
    yes: np.ndarray
    other: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a candidate is personal data; 0 for one that no labeler supports."""
        places = np.arange(votes.shape[1])
        a = math.log(self.prior) + np.log(self.yes[places, votes]).sum(axis=1)
        b = math.log(1 - self.prior) + np.log(self.other[places, votes]).sum(axis=1)
        return np.where((votes == 1).any(axis=1), 1 / (1 + np.exp(np.clip(b - a, -50, 50))), 0.0)


def votes_of(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] >> 2 * np.arange(len(LABELERS))) & 3


def features_of(codes: np.ndarray) -> np.ndarray:
    return ((codes[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float64)


def aggregate_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> Reliability:
    """Expectation-maximisation of a two-class model with independent labelers, from vote patterns and their counts.

    It starts from the majority of votes. One pseudo-count a cell keeps labelers that never spoke neutral; a labeler's
    yes never counts against, nor its no for, personal data.
    """
    places = np.arange(votes.shape[1])
    balance = (votes == 1).sum(axis=1) - (votes == 2).sum(axis=1)
    share = np.where(balance > 0, 0.9, np.where(balance < 0, 0.1, 0.4))
    model = Reliability(0.5, np.ones((len(places), 3)), np.ones((len(places), 3)))
    for _ in range(rounds):
        tables = []
        for weight in (counts * share, counts * (1 - share)):
            table = np.ones((len(places), 3))
            for v in range(3):
                table[:, v] += (weight[:, None] * (votes == v)).sum(axis=0)
            tables.append(table / table.sum(axis=1, keepdims=True))
        yes, other = tables
        for v, sign in ((1, 1), (2, -1)):
            wrong = sign * (yes[:, v] - other[:, v]) < 0
            both = (yes[wrong, v] + other[wrong, v]) / 2
            yes[wrong, v] = other[wrong, v] = both
        prior = float(np.clip((counts * share).sum() / counts.sum(), 0.01, 0.99))
        model = Reliability(prior, yes, other)
        updated = model.posterior(votes)
        if np.abs(updated - share).max() < 1e-6:
            break
        share = updated
    return model


def train_classifier(features: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic regression on probabilities as targets (Newton steps); the last weight is the intercept."""
    x = np.column_stack([features, np.ones(len(features))])
    share = counts / counts.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (share * (p - target)) + ridge * weights
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights


@dataclass
class SpanModel:
    reliability: Reliability | None
    weights: np.ndarray | None
    threshold: float = 0.5

    def accepts(self, features: int) -> bool:
        if self.weights is None:
            return False
        row = np.append(features_of(np.array([features]))[0], 1.0)
        return float(1 / (1 + np.exp(-np.clip(row @ self.weights, -30, 30)))) >= self.threshold


def fit(source: DataFrame) -> SpanModel:
    """Vote patterns of the whole corpus, the labelers' reliabilities, and the span classifier."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                pairs = [(v, f) for t in texts_of(part.column("text")) for _, _, v, f in candidates(t, base_spans(t))]
                kinds, counts = np.unique(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds[:, 0]), pa.array(kinds[:, 1]), pa.array(counts)], names=["votes", "features", "n"]
                )

    counted = source.mapInArrow(run, "votes long, features long, n long").groupBy("votes", "features").agg(F.sum("n").alias("n"))
    rows = np.array(counted.limit(MAX_PATTERNS + 1).collect(), dtype=np.int64).reshape(-1, 3)
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} vote patterns")
    if not len(rows):
        return SpanModel(None, None)
    rows = rows[np.lexsort(rows.T)]
    votes, counts = votes_of(rows[:, 0]), rows[:, 2].astype(np.float64)
    reliability = aggregate_votes(votes, counts)
    return SpanModel(reliability, train_classifier(features_of(rows[:, 1]), reliability.posterior(votes), counts))


def find_all(text: str, model: SpanModel, accepted: dict[int, bool]) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and those that the classifier adds (kind `other`)."""
    base = base_spans(text)
    added = []
    for start, end, _, features in candidates(text, base):
        if features not in accepted:
            accepted[features] = model.accepts(features)
        if accepted[features]:
            added.append(("other", start, end))
    return base, added


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in square brackets; of overlapping spans the first stands for all."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{kind}]"]
            last = end
        elif end > last:
            last = end
    return "".join([*out, text[last:]])


REPORT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_other long"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, the digest of the patterns' spans, and all spans of each row."""
    source = id_and_text(docs, id_col, text_col)
    model = source.sparkSession.sparkContext.broadcast(fit(source))

    def run(batches):
        accepted: dict[int, bool] = {}
        for batch in batches:
            for part in slices(batch):
                found = [find_all(t, model.value, accepted) for t in texts_of(part.column("text"))]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                digest = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *counts,
                        pa.array(digest, pa.string()),
                        pa.array([joined(base + added) for base, added in found], pa.string()),
                        pa.array([len(added) for _, added in found], pa.int64()),
                    ],
                    names=[c.split()[0] for c in REPORT.split(", ")],
                )

    return source.mapInArrow(run, REPORT)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with all personal data in `text_col` replaced; null stays null."""
    source = id_and_text(docs, text_col, text_col).select("text")
    model = source.sparkSession.sparkContext.broadcast(fit(source))
    names, place = docs.columns, docs.columns.index(text_col)

    def run(batches):
        accepted: dict[int, bool] = {}
        for batch in batches:
            for part in slices(batch, text_col):
                texts = [None if t is None else redacted(t, sum(find_all(t, model.value, accepted), [])) for t in part.column(place).to_pylist()]
                columns = [pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
