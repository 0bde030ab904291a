import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from veritally.llm import secrets
from veritally.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def scan(text):
    """Base and added spans as the contract and the method say it."""
    text, base = text or "", []
    base += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    base += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    added = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        s = m.group()
        if any(a < m.end() and m.start() < b for a, _, _, b in base) or any(re.search(p, s) for p in secrets.ALLOWED):
            continue
        w = secrets.WINDOW
        best = max(-sum(c / w * math.log2(c / w) for c in Counter(s[i : i + w]).values()) for i in range(len(s) - w + 1))
        if round(best, 6) >= next(bits for _, p, bits in secrets.CLASSES if re.search(p, s)):
            added.append((m.start(), 3, "entropy", m.end()))
    join = lambda spans: ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))
    return join(base), join(base + added), [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = secrets.document_secrets(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        base, spans, counts = scan(texts[r["doc_id"]])
        assert (r["base_sha256"], r["spans"]) == (hashlib.sha256(base.encode()).hexdigest(), spans), texts[r["doc_id"]]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
    return got


def test_random_texts(spark):
    rng = random.Random(9)
    signs = ["token", "Secret", "API_KEY", "apikey", " = ", ":", '"', "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "x", " ", "é😀", "Zk9+", "Qw/", "example", "\n"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 14))) for _ in range(1500)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts += ["a😀 " + "".join(rng.choices(letters[: rng.randint(2, 64)], k=rng.randint(18, 60))) + " b" for _ in range(300)]
    got = check(spark, texts)
    assert sum(r["n_entropy"] for r in got) > 50


def test_odd_texts(spark):
    check(spark, [None, "", "token=token: abcdef", "AKIA" * 12, "token", "password:", "a" * 200_000, "secret=abcdefg " * 300])
    rows = [(1, "token=abcdef", "x"), (1, "token=abcdef", "y"), (None, "token=abcdef", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string")
    assert [r["spans"] for r in secrets.document_secrets(docs).collect()] == ["assign:0:12"] * 3
    assert secrets.document_secrets(docs.where("false")).count() == 0


def test_cover_signs_and_neighbours(spark):
    """A cover sign in the text itself, candidates that touch base spans, and values too short to be one."""
    token = "Zk9pQw7LmX2vBn4RtY8sHd"
    check(spark, [f"\u0001{token}\u0001", f"token=abc {token}", f"{token}token=abcdefgh{token}", f"token=abcdefgh,{token}", "0" * 24 + "g" + token, f"AKIA{'Z' * 16}{token} {token}"])


def test_many_hits_in_one_text(spark):
    """5 MB of checksums, keys and tokens: time grows with the text, not with its square."""
    rng = random.Random(4)
    kinds = [lambda: "%032x" % rng.getrandbits(128), lambda: "token=abcdefgh", lambda: "AKIA" + "Q7" * 8, lambda: "".join(rng.choices("abcXYZ0123456789+/", k=24))]
    text = "\n".join(rng.choices(kinds, [12, 2, 1, 1])[0]() for _ in range(170_000))
    assert len(text) > 4_900_000
    start = time.perf_counter()
    (r,) = secrets.document_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert time.perf_counter() - start < 60
    counts = [len(ASSIGN.findall(text)), len(re.findall("AKIA[A-Z0-9]{16}", text)), len(re.findall("[0-9a-f]{24,}", text))]
    assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts and counts[2] > 100_000
    hexes = [f"hex:{m.start()}:{m.end()}" for m in re.finditer("[0-9a-f]{24,}", text)]
    assert [x for x in r["spans"].split(",") if x.startswith("hex")] == hexes


def test_entropy_by_incremental_counts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abAB01+/", k=n)) for n in range(1, 60)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", secrets.window_entropy(F.col("t")).alias("h")).collect()
    for r in rows:
        w = secrets.WINDOW
        windows = [Counter(r["t"][i : i + w]) for i in range(len(r["t"]) - w + 1)]
        assert abs(r["h"] - max((-sum(c / w * math.log2(c / w) for c in x.values()) for x in windows), default=0.0)) < 1e-9


def test_share_of_random_tokens_found(spark):
    """Of random tokens of each alphabet nearly all are found, of names and prose none."""
    rng = random.Random(5)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alphabets = {"lower": lower + digits, "upper": lower.upper() + digits, "base32": lower.upper() + "234567", "base62": lower + lower.upper() + digits}
    tokens = [(f"{k} {n}", "".join(rng.choices(a, k=n))) for k, a in alphabets.items() for n in (20, 24, 32) for _ in range(500)]
    names = [
        "getHttp2ConnectionPoolFactory", "readMultipleBlocksConfigurationV3", "ISO8859EncodingDetectorFactory", "internationalization-of-names",
        "section1section2section3", "see the 20 long words of chapter 11 and nothing else",
    ]
    rows = [(k, f"key {t} end") for k, t in tokens] + [("names", f"name {n} end") for n in names]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = Counter(r["doc_id"] for r in secrets.find_secrets(docs).collect() if r["added"])
    rates = {k: found[k] / 500 for k in dict(tokens)}
    print(rates)
    assert min(rates.values()) >= 0.9, rates
    assert found["names"] == 0


def test_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op10_secrets"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    assert all(r["spans"] == scan(texts[r["doc_id"]])[1] for r in got)
