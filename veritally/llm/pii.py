"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base spans (``email``, ``ip``, ``card``, ``phone``) are the leftmost non-overlapping matches of fixed
patterns that pass their check; a failing match is dropped without another try inside it. The
method adds ``iban`` (mod-97), ``ssn`` and ``local`` (a phone number without country code), the last two
only with a telling word before them. Positions count code points, the end is exclusive.

A NULL text has no span, like an empty one. Texts are searched whole; a search starts only in
texts that hold the sign it needs (``@``, a digit). Repeated rows get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import in_arrow, sliced, texts_of

CONTEXT = 48  # code points before a span, and half as many after it, that are looked at
THRESHOLD = 0.5
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local")
KINDS = BASE + ADDED

# The patterns of the base kinds. (A match of IP never starts inside a run of digits; saying so keeps long runs cheap.)
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
LOCAL = re.compile(r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
MAIL_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")

WORDS = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "fono"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "local": ("phone", "tel", "call", "mobile", "fax", "telefon", "fono"),
}
AGAINST = ("example", "sample", "dummy", "version", "isbn", "beispiel", "exemple", "ejemplo")
CONTEXT_WORDS = {k: re.compile(rf"\b(?:{'|'.join(v)})", re.IGNORECASE) for k, v in WORDS.items()}
AGAINST_WORDS = re.compile(rf"\b(?:{'|'.join(AGAINST)})\b", re.IGNORECASE)
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local": 0.4}


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    text: str
    score: float


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an account number, its first four signs moved to the end and letters as 10 to 35, is 1 modulo 97."""
    text = iban.replace(" ", "")
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _valid_card(text: str) -> bool:
    digits = _digits(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def _valid_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _matches(pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: ((m.start(), m.end()) for m in pattern.finditer(text) if valid(m.group()))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``EMAIL``, found from each ``@``: the name before it starts as early as its letters go,
    and not before the end of the match before."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in MAIL_NAME:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers. A match may have taken in words that follow; if its check fails, groups at its end are left out in turn."""
    m = IBAN.search(text)
    while m:
        start, end = m.span()
        while end > start and not mod97(text[start:end]):
            end = max(start, text.rfind(" ", start, end))
        if end > start:
            yield start, end
        m = IBAN.search(text, max(end, start + 1))


FINDERS = {
    "email": ("@", _emails),
    "ip": (".", _matches(IP, _valid_ip)),
    "card": ("", _matches(CARD, _valid_card)),
    "phone": ("+", _matches(PHONE, _valid_phone)),
    "iban": ("", _ibans),
    "ssn": ("-", _matches(SSN, lambda _: True)),
    "local": ("", _matches(LOCAL, lambda _: True)),
}
DIGIT = re.compile("[0-9]")


def score_of(text: str, start: int, end: int, kind: str) -> float:
    """The prior of a confirmed span, raised by a telling word nearby and lowered by one that speaks against it."""
    score = PRIOR[kind]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT // 2]
    if CONTEXT_WORDS[kind].search(before) or CONTEXT_WORDS[kind].search(after):
        score += 0.5 * (1 - score)
    if AGAINST_WORDS.search(before):
        score *= 0.6
    return score


def _free_of(spans: list[Span]) -> Callable[[int, int], bool]:
    """Whether a place overlaps none of ``spans``: of those that start before its end, the furthest end decides."""
    starts = sorted(s.start for s in spans)
    furthest = [0, *accumulate((s.end for s in sorted(spans, key=lambda s: s.start)), max)]
    return lambda start, end: furthest[bisect_left(starts, end)] <= start


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by start and then in the order of ``KINDS``. Base spans stay whatever their
    score; an added one needs ``threshold`` and may not overlap a span of an earlier kind."""
    if not text:
        return []
    found: list[Span] = []
    digit = DIGIT.search(text) is not None
    for kind, (sign, spans) in FINDERS.items():
        if sign not in text or not (digit or kind == "email"):
            continue
        free = _free_of(found)
        for start, end in spans(text):
            score = score_of(text, start, end, kind)
            if kind in BASE or (score >= threshold and free(start, end)):
                found.append(Span(start, end, kind, text[start:end], score))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, found) for every row, ``found`` an array of (start, end, kind, text, score)."""
    kept = docs.select(F.col(key), F.col(text).alias("_text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("text", pa.string()), ("score", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "_text"):
            found = [[s._asdict() for s in find_spans(t, threshold)] for t in texts_of(batch, "_text")]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.list_(span))], names=[key, "found"])

    kind = kept.schema[key].dataType.simpleString()
    return in_arrow(
        kept, run, f"`{key}` {kind}, found array<struct<start: bigint, end: bigint, kind: string, text: string, score: double>>"
    )


def mask(text: str | None, spans: Iterable[Span]) -> str | None:
    """The text with ``<kind>`` in place of each span; of overlapping ones the first counts."""
    if text is None:
        return None
    out, done = [], 0
    for s in spans:
        if s.start >= done:
            out += [text[done : s.start], f"<{s.kind}>"]
            done = s.end
    return "".join(out) + text[done:]


def digest(found: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def document_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digests of the personal data of every row of ``documents``."""
    spans = personal_data(docs)
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, line), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return spans.select(
        "doc_id",
        *(count(k) for k in BASE),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        *(count(k) for k in ADDED),
    )
