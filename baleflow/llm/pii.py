"""Personal data: base patterns, and spans that a weakly supervised classifier adds.

Four labelers vote on every candidate span: its shape (regular expressions), gazetteers of domains,
issuers and area codes, words of the context before it, and validity (checksum, ranges, digits).
Candidates are the matches of the base patterns and of looser ones (mail addresses with "(at)",
numbers without a plus, card numbers that fail, IPv6). The votes of all documents are counted by
pattern, expectation-maximisation over these counts estimates each labeler's reliability, and the
posteriors train a logistic span classifier on votes and surroundings. A candidate that overlaps no
base span is added where the classifier is sure and no labeler holds it for invalid.

Counts are taken over all documents. What reaches the driver is one row per distinct combination of
votes and surroundings, of which there are at most 4 * 81 * 24.

Defined results: a null text is empty and has no span; rows that repeat, or without doc_id, are
scanned each for itself; an empty table gives no rows and a classifier that adds nothing; columns
other than doc_id and text are not read. All patterns run in time linear in the text.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import ids_and_texts, one_array, ready, slices, to_batches

#: In the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone")
#: A candidate is added from this probability on.
SURE = 0.95
#: Characters before a candidate that count as its context.
CONTEXT = 40

# The base patterns, written so that they take linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser patterns of candidates.
MASKED_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[({]at[\])}] ?"
    r"[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z0-9-]{1,63}){1,4}"
)
PLAIN_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z.-])"
)
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
ANY_SIGN = r"[0-9@]|[\[({]at[\])}]"

# Gazetteers and context words.
TOP_DOMAINS = frozenset("com org net edu gov info biz io co de fr es uk us eu ch at".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38")
FICTIVE_AREAS = ("000", "111", "123", "999")
WORDS_FOR = {
    "email": ("mail", "contact", "write to", "reach"),
    "ip": ("ip", "host", "server", "address", "login from"),
    "card": ("card", "visa", "credit", "payment", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "numéro"),
}
WORDS_AGAINST = ("version", "isbn", "order no", "invoice", "serial", "section", "total", "page")

SCANNED = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, n_added long"
)
COUNTED = "kind int, votes int, around int, n long"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(char for char in text if "0" <= char <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def card_digits(text: str) -> str:
    """The digits of a possible card number, or nothing."""
    if not 12 <= len(text) <= 37:
        return ""
    digits = only_digits(text)
    return digits if 12 <= len(digits) <= 19 else ""


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all base matches, in that order."""
    found = [(start, 0, end) for start, end in emails(text)]
    for match in IP.finditer(text):
        if all(map(small_part, match.group().split("."))):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        digits = card_digits(match.group()) if match.end() - match.start() <= 37 else ""
        if digits and luhn(digits):
            found.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= len(only_digits(match.group())) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of candidates that the base patterns leave out."""
    found = []
    if "at" in text:
        found += [(m.start(), 0, m.end()) for m in MASKED_EMAIL.finditer(text)]
    found += [
        (m.start(), 1, m.end())
        for m in IP.finditer(text)
        if m.end() - m.start() <= 40 and not all(map(small_part, m.group().split(".")))
    ]
    if ":" in text:
        found += [(m.start(), 1, m.end()) for m in IPV6.finditer(text)]
    for match in CARD.finditer(text):
        digits = card_digits(match.group()) if match.end() - match.start() <= 37 else ""
        if digits and not luhn(digits):
            found.append((match.start(), 2, match.end()))
    found += [(m.start(), 3, m.end()) for m in PLAIN_PHONE.finditer(text)]
    return found


def vote_shape(kind: int, span: str, is_base: bool) -> int:
    if is_base:
        return 1
    return 1 if kind == 0 or (kind == 1 and ":" in span) else 0


def vote_gazetteer(kind: int, span: str) -> int:
    if kind == 0:
        last = re.split(r"[^A-Za-z0-9-]+", span.rstrip("])}"))[-1].lower()
        return 1 if last in TOP_DOMAINS else -1
    if kind == 1:
        return -1 if span.startswith(("0.", "127.", "255.")) else 0
    digits = only_digits(span)
    if kind == 2:
        return 1 if digits.startswith(ISSUERS) else -1
    return -1 if digits.startswith(FICTIVE_AREAS) else 0


def vote_context(kind: int, before: str) -> int:
    before = before.lower()
    if any(word in before for word in WORDS_AGAINST):
        return -1
    return 1 if any(word in before for word in WORDS_FOR[KINDS[kind]]) else 0


def vote_valid(kind: int, span: str) -> int:
    if kind == 0:
        return 1
    if kind == 1:
        return 1 if ":" in span or all(map(small_part, span.split("."))) else -1
    digits = only_digits(span)
    if kind == 2:
        return 1 if luhn(digits) else -1
    return 1 if 9 <= len(digits) <= 15 else -1


def described(text: str, start: int, kind: int, end: int, is_base: bool) -> tuple[int, int, int]:
    """Numbers for the kind, the votes (base 3) and the surroundings of a candidate."""
    span = text[start:end]
    votes = (
        vote_shape(kind, span, is_base),
        vote_gazetteer(kind, span),
        vote_context(kind, text[max(0, start - CONTEXT) : start]),
        vote_valid(kind, span),
    )
    number = 0
    for vote in votes:
        number = 3 * number + vote + 1
    left = start > 0 and text[start - 1].isalnum()
    right = end < len(text) and text[end].isalnum()
    size = min((end - start) // 8, 2)
    separated = any(char in " -().[]" for char in span)
    around = ((size * 2 + separated) * 2 + left) * 2 + right
    return kind, number, around


def count_candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[int, int, int], int] = {}
    for part in slices(batches):
        texts = one_array(part, "text")
        for text in texts.filter(pc.match_substring_regex(texts, ANY_SIGN)).to_pylist():
            for is_base, spans in ((True, base_spans(text)), (False, loose_spans(text))):
                for start, kind, end in spans:
                    key = described(text, start, kind, end, is_base)
                    counts[key] = counts.get(key, 0) + 1
    keys = np.array(list(counts), np.int32).reshape(-1, 3)
    yield from to_batches(
        {
            "kind": keys[:, 0],
            "votes": keys[:, 1],
            "around": keys[:, 2],
            "n": np.array(list(counts.values()), np.int64),
        }
    )


def reliabilities(votes: np.ndarray, kinds: np.ndarray, weights: np.ndarray, rounds: int = 50):
    """Expectation-maximisation over vote patterns: the posterior of each pattern, and P(vote).

    votes: patterns x labelers, each 0 (against), 1 (abstains) or 2 (for).
    """
    posterior = 1 / (1 + np.exp(-(votes - 1).sum(1).astype(float)))
    labelers = votes.shape[1]
    table = np.zeros((labelers, 2, 3))
    for _ in range(rounds):
        both = np.column_stack([1 - posterior, posterior]) * weights[:, None]
        for labeler in range(labelers):
            for vote in range(3):
                table[labeler, :, vote] = both[votes[:, labeler] == vote].sum(0) + 0.5
            table[labeler] /= table[labeler].sum(1, keepdims=True)
        prior = np.zeros((len(KINDS), 2))
        for kind in range(len(KINDS)):
            prior[kind] = both[kinds == kind].sum(0) + 1
        prior /= prior.sum(1, keepdims=True)
        log = np.log(prior)[kinds]
        for labeler in range(labelers):
            log = log + np.log(table[labeler][:, votes[:, labeler]]).T
        posterior = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return posterior, table


def features(kinds: np.ndarray, votes: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Kind, votes and surroundings as columns of zeros and ones."""
    columns = [np.ones(len(kinds))]
    columns += [kinds == kind for kind in range(len(KINDS))]
    for labeler in range(votes.shape[1]):
        columns += [votes[:, labeler] == 0, votes[:, labeler] == 2]
    columns += [around // 8 == size for size in range(3)]
    columns += [around // 4 % 2, around // 2 % 2, around % 2]
    return np.column_stack(columns).astype(float)


def unpacked(votes: np.ndarray) -> np.ndarray:
    return np.column_stack([votes // 27 % 3, votes // 9 % 3, votes // 3 % 3, votes % 3])


def fit(counted: np.ndarray) -> np.ndarray:
    """The weights of the span classifier, from rows (kind, votes, around, n)."""
    if not len(counted):
        return np.zeros(0)
    kinds, votes, around = counted[:, 0], unpacked(counted[:, 1]), counted[:, 2]
    weights = counted[:, 3].astype(float)
    posterior, _ = reliabilities(votes, kinds, weights)
    x = features(kinds, votes, around)
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (posterior - p)) - w
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        w += np.linalg.solve(curve + np.eye(len(w)), slope)
    return w


def probability(weights: np.ndarray, key: tuple[int, int, int]) -> float:
    if not len(weights):
        return 0.0
    x = features(np.array([key[0]]), unpacked(np.array([key[1]])), np.array([key[2]]))[0]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ weights)))))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(text: str, weights: np.ndarray, sure: float, known: dict) -> tuple[list, list]:
    """Base spans, and those the classifier adds."""
    base = base_spans(text)
    by_start = sorted(base)
    starts = [start for start, _, _ in by_start]
    # The furthest end of the base spans up to each: one of them reaches into a later span, or none.
    reach = list(itertools.accumulate((end for _, _, end in by_start), max))
    added: list[tuple[int, int, int]] = []
    last = 0  # the end of the last span that was added, as these come by their starts
    for start, kind, end in sorted(loose_spans(text)):
        before = bisect.bisect_left(starts, end)
        if start < last or (before and reach[before - 1] > start):
            continue
        key = described(text, start, kind, end, False)
        if key not in known:
            invalid = (unpacked(np.array([key[1]]))[0, [1, 2, 3]] == 0).any()
            known[key] = 0.0 if invalid else probability(weights, key)
        if known[key] >= sure:
            added.append((start, kind, end))
            last = end
    return base, added


def scan(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """Per document the number of base spans by kind, and base and all spans as text."""
    ready(docs.sparkSession)
    rows = ids_and_texts(docs)
    patterns = rows.select("text").mapInArrow(count_candidates, COUNTED)
    counted = patterns.groupBy("kind", "votes", "around").agg(F.sum("n").alias("n")).orderBy(
        "kind", "votes", "around"
    )
    weights = fit(np.array(counted.collect(), np.int64).reshape(-1, 4))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for part in slices(batches):
            texts = one_array(part, "text")
            n = len(texts)
            counts = np.zeros((n, len(KINDS)), np.int64)
            digests, spans, added_counts = [nothing] * n, [""] * n, np.zeros(n, np.int64)
            places = np.flatnonzero(pc.match_substring_regex(texts, ANY_SIGN).to_numpy(False))
            for place, text in zip(places.tolist(), texts.take(pa.array(places)).to_pylist()):
                base, added = find(text, weights, sure, known)
                for _, kind, _ in base:
                    counts[place, kind] += 1
                digests[place] = hashlib.sha256(joined(base).encode()).hexdigest()
                spans[place] = joined(sorted(base + added))
                added_counts[place] = len(added)
            columns = {"doc_id": one_array(part, "doc_id")}
            columns |= {f"n_{kind}": counts[:, number] for number, kind in enumerate(KINDS)}
            columns |= {
                "base_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(spans, pa.string()),
                "n_added": added_counts,
            }
            yield from to_batches(columns)

    return rows.mapInArrow(run, SCANNED)
