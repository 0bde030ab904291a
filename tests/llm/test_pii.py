import hashlib
import random
import re
import time

import pytest

from veritally.llm import pii
from veritally.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    """As the contract says it, pattern by pattern."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                twice = [d * 2 if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d - 9 if d > 9 else d for d in twice) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_of_random_texts():
    rng = random.Random(4)
    signs = list("ab.@+-% 10()4é😀") + ["4111 1111 1111 1111", "+1 (743) 555-3824", "10.0.0.1", "a@b.c"]
    for _ in range(20_000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 25)))
        found = [(s.kind, s.start, s.end) for s in pii.find_spans(text) if s.kind in pii.BASE]
        assert found == base_spans(text), text


def test_whole_table(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op8_personal_data"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        base = base_spans(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        lines = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(lines).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in PATTERNS] == lines
    assert sum(r["n_email"] + r["n_phone"] for r in got) > 0


@pytest.mark.parametrize("text, kinds", [
    ("iban GB82 WEST 1234 5698 7654 32 ok", ["iban"]),
    ("iban GB82 WEST 1234 5698 7654 33 ok", []),
    ("my social security number 123-45-6789", ["ssn"]),
    ("part 123-45-6789", []),
    ("please call 555-123-4567", ["local"]),
    ("room 555-123-4567", []),
    ("example version: call 000-12-3456", []),
])
def test_context_and_checksums(text, kinds):
    assert [s.kind for s in pii.find_spans(text)] == kinds


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE89 3704 0044 0532 0130 01")


def test_mask():
    text = "mail a@b.co or 10.0.0.1."
    assert pii.mask(text, pii.find_spans(text)) == "mail <email> or <ip>."
    assert pii.mask(None, []) is None


def test_odd_rows(spark):
    rows = [(1, "a@b.co", "x"), (1, "a@b.co", "y"), (None, "a@b.co", None), (2, None, None), (3, "", None), (4, "1" * 200_000 + "@" * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = sorted(((r["doc_id"], r["spans"]) for r in pii.document_personal_data(docs).collect()), key=str)
    assert got == sorted([(1, "email:0:6"), (1, "email:0:6"), (2, ""), (3, ""), (4, ""), (None, "email:0:6")], key=str)
    assert pii.document_personal_data(docs.where("false")).count() == 0


def test_account_numbers_before_other_words():
    one = "ES91 2100 0418 4502 0005 1332"
    for number in (one, one.replace(" ", "")):
        for tail in ("", " BIC", " A", " 12", " X1 Y2", " end", f" {one}"):
            found = [s.text for s in pii.find_spans(f"iban {number}{tail}") if s.kind == "iban"]
            assert found == [number] + [one] * (tail == f" {one}"), (number, tail, found)


def test_many_spans_in_one_text():
    """Added spans are compared with a sorted list: time grows with the text, not with its square."""
    line = "call +49 30 1234567 or 10.1.2.3, account DE89 3704 0044 0532 0130 00, phone 030-1234567 \n"
    start = time.perf_counter()
    few = pii.find_spans(line * 200)
    assert len(few) == 200 * len(pii.find_spans(line))
    many = pii.find_spans(line * 60_000)
    assert len(many) == 60_000 * len(pii.find_spans(line)) and len(line) * 60_000 > 5_000_000
    assert time.perf_counter() - start < 30


def test_overlap_with_earlier_kinds():
    rng = random.Random(8)
    for _ in range(300):
        spans = [pii.Span(a, a + rng.randint(1, 9), "ip", "", 1.0) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 8)))]
        start = rng.randint(0, 60)
        end = start + rng.randint(1, 9)
        assert pii._free_of(spans)(start, end) == all(end <= s.start or s.end <= start for s in spans)
