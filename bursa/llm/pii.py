"""Personal data by weak supervision.

Regexes propose candidates: strict ones (the base spans, which always stay) and loose
ones (failed checks, written-out e-mail addresses, telephone numbers without a country
code). Four labelers vote on each candidate: the strict pattern with its check, a
gazetteer (domain endings, card issuers, country codes, address ranges), cue words
before it, and its shape. Spark counts the vote patterns over all documents; the number
of patterns is bounded by the labelers, not by the corpus. Expectation-maximisation on
these counts estimates each labeler's reliability per kind, and a logistic span
classifier is trained on the resulting posteriors. A loose candidate that the classifier
accepts and that overlaps no base span is added.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm.common import doc_texts, give_back, rows_of, text_slices

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
CUE_CHARS = 40
VOTE_WEIGHTS = np.array([2.4, 1.2, 1.2, 1.2])  # log odds of a vote before any estimate: strict, gazetteer, context, shape

# What a span's surroundings and parts are compared with.
DOMAIN_ENDINGS = frozenset("com org net edu gov io co info biz de fr es uk eu us ch at it nl".split())
CUES = {
    "email": frozenset("mail e-mail email contact write address".split()),
    "ip": frozenset("ip address host server addr from client".split()),
    "card": frozenset("card visa mastercard amex credit debit pay payment".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell contact".split()),
}
COUNTER_CUES = frozenset("version release license token sha hash isbn order serial build id key".split())

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# No start inside a run of digits can match where the run's own start does not.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"(?:\(at\)|\[at\]) ?")
_SPELLED_AT = re.compile(r" at (?=[A-Za-z0-9-]+ dot )")
_DOTTED = re.compile(r"[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]+)+")
_PHONE_END = re.compile(r"[0-9]{3}[-. ][0-9]{4}(?![0-9])")
_PHONE_AREA = re.compile(r"(?<![0-9+.])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])$")
_DIGIT, _WORD = re.compile("[0-9]"), re.compile(r"[a-z][a-z-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, in time linear in the text."""
    end, at = 0, text.find("@")
    low = 0
    while at >= 0:
        local = text[max(low, end):at]
        start = max(low, end) + len(local.rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        low = at + 1
        at = text.find("@", low)


def strict_candidates(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passed) of every leftmost match of the base patterns."""
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b, True
    for m in _IP.finditer(text):
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                                            for p in m.group().split("."))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19:
                yield "card", m.start(), m.end(), luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 9 <= len(_DIGIT.findall(m.group())) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    return sorted((a, KINDS.index(k), b) for k, a, b, ok in strict_candidates(text) if ok)


def _loose(text: str) -> Iterator[tuple[str, int, int]]:
    found = [*_AT.finditer(text)] if "at)" in text or "at]" in text else []
    for m in found + ([*_SPELLED_AT.finditer(text)] if " dot " in text else []):
        head = text[max(0, m.start() - 64):m.start()].rstrip(" ")
        start = max(0, m.start() - 64) + len(head.rstrip(_LOCAL))
        if head != head.rstrip(_LOCAL) and (d := _DOTTED.match(text, m.end())):
            yield "email", start, d.end()
    for m in _PHONE_END.finditer(text):
        at = max(0, m.start() - 7)
        if area := _PHONE_AREA.search(text[at:m.start()]):
            yield "phone", at + area.start(), m.end()


def _gazetteer(kind: str, span: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.split(r"[^a-z0-9]", span.lower())[-1] in DOMAIN_ENDINGS else -1
    if kind == "ip":
        first = int(span.split(".")[0][:6])
        return 1 if 0 < first < 224 and first != 127 else -1
    if kind == "card":
        return 1 if digits[0] in "3456" and digits[:2] not in ("30", "31", "32", "33", "39") else -1
    return 1 if span[0] == "+" and digits[0] != "0" else 0 if digits[0] not in "01" else -1


def _context(kind: str, before: str) -> int:
    words = set(_WORD.findall(before.lower()))
    return 1 if words & CUES[kind] else -1 if words & COUNTER_CUES else 0


def _shape(kind: str, span: str, digits: str, before: str) -> int:
    if before[-1:].isalnum() or before[-1:] in ('"', "_"):
        return -1
    if kind == "email":
        return 1 if "@" in span else 0
    if kind == "ip":
        return 1 if not any(p != "0" and p.startswith("0") for p in span.split(".")) else -1
    if kind == "card":
        groups = re.split("[ -]", span)
        return 1 if len(groups) == 1 and len(digits) in (15, 16) or [*map(len, groups)] == [4] * 4 else -1
    return 1 if 10 <= len(digits) <= 12 else 0


def votes(text: str, kind: str, start: int, end: int, strict: int) -> tuple[int, int, int, int]:
    """1 for, -1 against, 0 abstains, of the four labelers."""
    span, before = text[start:end], text[max(0, start - CUE_CHARS):start]
    digits = "".join(_DIGIT.findall(span))
    return strict, _gazetteer(kind, span, digits), _context(kind, before), _shape(kind, span, digits, before)


# What the classifier sees besides the votes: (feature, values it can take).
LOOKS = (("length", 8), ("digits", 8), ("breaks", 4), ("before", 5), ("after", 5), ("repeats", 3), ("words", 4))
_LOOK_SIZES = np.array([n for _, n in LOOKS])
N_LOOKS = int(_LOOK_SIZES.sum())


def _beside(char: str) -> int:
    """Kind of the character beside a span: none, space, letter or digit, bracket or quote, other."""
    return 0 if not char else 1 if char.isspace() else 2 if char.isalnum() else 3 if char in "()[]<>\"'`" else 4


def looks(text: str, start: int, end: int) -> int:
    """The span's and its surroundings' features as one number: length, digits, kinds of
    breaks, the characters on both sides, how far one digit prevails, words before it."""
    span = text[start:end]
    digits = _DIGIT.findall(span)
    most = max(map(digits.count, set(digits)), default=0)
    values = (min(7, len(span) // 4), min(7, len(digits) // 3), min(3, len({c for c in span if not c.isalnum()})),
              _beside(text[start - 1:start]), _beside(text[end:end + 1]),
              0 if not digits else 1 if 2 * most < len(digits) else 2,
              min(3, len(_WORD.findall(text[max(0, start - CUE_CHARS):start]))))
    number = 0
    for v, n in zip(values, _LOOK_SIZES.tolist()):
        number = number * n + v
    return number


def candidates(text: str) -> Iterator[tuple[int, int, int, bool, int, int]]:
    """(kind number, start, end, base, vote pattern, looks); the pattern is a base-3 number."""
    found = [(k, a, b, 1 if ok else -1) for k, a, b, ok in strict_candidates(text)]
    strict = sorted((a, b) for _, a, b, _ in found)
    found += [(k, a, b, 0) for k, a, b in _loose(text) if all(b <= x or y <= a for x, y in strict)]
    for kind, a, b, vote in found:
        pattern = 0
        for v in votes(text, kind, a, b, vote):
            pattern = pattern * 3 + v + 1
        yield KINDS.index(kind), a, b, vote == 1, pattern, looks(text, a, b)


def _digits3(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // np.array([27, 9, 3, 1]) % 3


def pattern_counts(docs: DataFrame) -> DataFrame:
    """(kind, pattern, looks, n) over all candidates of all documents.

    Rows are at most the product of what these can be (4 * 81 and 8 * 8 * 4 * 5 * 5 * 3 *
    4 looks), however many documents there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for _, texts in rows_of(batches):
            for t in texts:
                n.update((c[0], *c[4:]) for c in candidates(t.decode()))
        if n:
            rows = sorted((*k, v) for k, v in n.items())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             ["kind", "pattern", "looks", "n"])

    return doc_texts(docs).mapInArrow(run, "kind int, pattern int, looks int, n long") \
        .groupBy("kind", "pattern", "looks").agg(F.sum("n").alias("n"))


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each vote pattern of one kind: labelers are independent given the truth.

    Starts from the weighted vote, the strict labeler counting twice; one unit of that
    start is kept as a prior count, so that a rare pattern is not left to chance. An
    abstention says nothing, and no vote is taken for its opposite: otherwise a group of
    candidates on which some labelers abstain would pass for the bad ones.
    """
    v = _digits3(patterns)
    start = 1 / (1 + np.exp(-((v - 1) @ VOTE_WEIGHTS)))
    post = start
    for _ in range(rounds):
        prior = (post @ n + 1) / (n.sum() + 2)
        logit = np.full(len(n), np.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            yes = np.array([(post * n)[v[:, j] == k].sum() + 0.5 * (1 + (k == 2)) for k in (0, 2)])
            no = np.array([((1 - post) * n)[v[:, j] == k].sum() + 0.5 * (1 + (k == 0)) for k in (0, 2)])
            against, pro = np.log((yes / yes.sum()) / (no / no.sum()))
            logit += np.array([min(0.0, against), 0.0, max(0.0, pro)])[v[:, j]]
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return (post * n + start) / (n + 1)


def _features(kind: np.ndarray, patterns: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Votes and looks one-hot and a constant, for each kind apart."""
    hot = np.eye(3)[_digits3(patterns)].reshape(len(patterns), 3 * len(VOTE_WEIGHTS))
    steps = np.cumprod(np.append(1, _LOOK_SIZES[:0:-1]))[::-1]
    value = seen[:, None] // steps % _LOOK_SIZES
    shown = np.zeros((len(seen), N_LOOKS))
    np.put_along_axis(shown, value + np.cumsum(_LOOK_SIZES) - _LOOK_SIZES, 1, axis=1)
    own = np.c_[hot, shown, np.ones(len(hot))]
    return (np.eye(len(KINDS))[kind][:, :, None] * own[:, None, :]).reshape(len(hot), len(KINDS) * own.shape[1])


class Classifier:
    """Logistic regression on the votes and the looks of a candidate."""

    def __init__(self, beta: np.ndarray, accept: float):
        self.beta, self.accept, self.memo = beta, accept, {}

    def __call__(self, kind: int, pattern: int, seen: int) -> bool:
        key = kind, pattern, seen
        if key not in self.memo:
            x = _features(*(np.array([v]) for v in key))
            self.memo[key] = float(1 / (1 + np.exp(-x @ self.beta))[0]) >= self.accept
        return self.memo[key]


def train(docs: DataFrame, accept: float = ACCEPT, rounds: int = 400) -> Classifier:
    """The span classifier: it learns the truth that the labelers' votes make likely.

    The posterior of a candidate comes from its votes alone; the classifier sees the looks
    as well, so candidates with equal votes part by what else tells good from bad ones."""
    rows = pattern_counts(docs).sort("kind", "pattern", "looks").collect()
    kind, pattern, seen, n = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4).T
    post = np.zeros(len(rows))
    for k in range(len(KINDS)):
        if (own := kind == k).any():
            of, at = np.unique(pattern[own], return_inverse=True)
            post[own] = estimate(of, np.bincount(at, n[own], len(of)))[at]
    # Weights start at, and are drawn towards, the plain vote: what was never seen is judged by it.
    vote = (VOTE_WEIGHTS[:, None] * np.array([-1, 0, 1])).ravel()
    start = np.tile(np.concatenate((vote, np.zeros(N_LOOKS + 1))), len(KINDS))
    x, w, beta = _features(kind, pattern, seen), np.sqrt(n.astype(float)), start.copy()
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= 0.5 * ((x * (w * (p - post))[:, None]).sum(0) / w.sum() + 0.01 * (beta - start))
    return Classifier(beta, accept)


def all_spans(text: str, accept: Classifier) -> tuple[list, list]:
    """Base spans, and base with added ones; both (start, kind number, end), sorted."""
    found = [*candidates(text)]
    base = sorted((a, k, b) for k, a, b, ok, _, _ in found if ok)
    out = [*base]
    for k, a, b, ok, pattern, seen in found:
        if not ok and accept(k, pattern, seen) and all(b <= x or y <= a for x, _, y in out):
            out.append((a, k, b))
    return base, sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added per input row.

    The counts and the digest are those of the base spans; ``spans`` lists all, in code
    points. A null or empty text has none. Repeated rows give repeated result rows.
    """
    good = docs.sparkSession.sparkContext.broadcast(train(docs, accept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_of(batches):
            counts, shas, spans, added = [], [], [], []
            for t in texts:
                base, every = all_spans(t.decode(), good.value)
                n = Counter(k for _, k, _ in base)
                counts.append([n[k] for k in range(len(KINDS))])
                shas.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
                added.append(len(every) - len(base))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in zip(*counts)),
                 pa.array(shas, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                           "base_sha256 string, spans string, n_added long")


def masked_text(text: str, accept: Classifier) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for a, k, b in all_spans(text, accept)[1]:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """All rows and columns of ``docs``, spans in ``text`` masked; ``n_chars``, where there
    is such a column, follows a changed text. A null text stays null."""
    good = docs.sparkSession.sparkContext.broadcast(train(docs, accept))

    @F.arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = [masked_text(t.decode(), good.value) for part in text_slices(texts) for t in part]
        give_back()
        return pa.array(out, pa.string(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    new = masked(F.col("text").cast("string").cast("binary"))
    out = docs.withColumn("text", new)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out
