import hashlib
import random

from pyspark.sql import functions as F

from veritally.llm import merkle

SCHEMA = "doc_id long, text string"


def expected(docs):
    """(doc_id, n_chars, edited_sha256) by sorting in Python."""
    rows = sorted(((d if d is not None else -(1 << 63), t or "", d) for d, t in docs), key=lambda r: (-r[0], [-ord(c) for c in r[1]] + [0]))
    out = []
    for (_, t, d), (_, u, _) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out.append((d, len(t), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, docs):
    got = merkle.document_fingerprints(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == expected(docs)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    return got


def random_text(rng):
    return "".join(rng.choices(["A clause, ", "one more. ", "\n", "é😀", "word ", "end.\n"], k=rng.randint(0, 30)))


def test_ids_of_all_kinds(spark):
    rng = random.Random(1)
    for ids in (range(300), [i * 7919 for i in range(60)], [rng.getrandbits(63) - (1 << 62) for _ in range(200)], [*range(50), *range(10**12, 10**12 + 50), -5]):
        check(spark, [(i, random_text(rng)) for i in ids])


def test_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_PER_BUCKET", 1)
    rng = random.Random(2)
    check(spark, [(i, random_text(rng)) for i in [*range(90), *range(10**6, 10**6 + 9)]])
    monkeypatch.setattr(merkle, "is_small", lambda df: False)
    check(spark, [(i * 3, random_text(rng)) for i in range(80)])


def test_odd_rows(spark):
    check(spark, [(1, "alone")])
    check(spark, [(None, "no id")])
    check(spark, [(1, "x"), (1, "x"), (1, "y"), (2, None), (3, ""), (None, "z"), (None, None), (4, "long. " * 50_000)])
    docs = spark.createDataFrame([(1, "a", "b")], SCHEMA + ", root string")
    assert merkle.document_fingerprints(docs).count() == 1
    assert merkle.document_fingerprints(docs.where("false")).count() == 0


def test_fingerprints_tell_texts_apart(spark):
    rng = random.Random(3)
    texts = list({random_text(rng) for _ in range(200)} | {"a. b", "a.\nb", "a.b", "a. \nb", "x" * 64 + ". b", "x" * 63 + ". b", "x" * 63 + ".b", "", "\n"})
    rows = merkle.with_tree(spark.createDataFrame([(t,) for t in texts + texts[:50]], "text string"), "text").select("text", "root").collect()
    assert len({r["root"] for r in rows}) == len({r["text"] for r in rows}) == len(texts)


def test_roots_cover_whole_digests(spark):
    """Texts whose nodes agree as they are written differ in their roots, and are not wholly alike; user columns keep apart."""
    df = spark.createDataFrame([("one. two", "mine"), ("one.\ntwo", "mine")], "text string, _grouped string").withColumn("root", F.lit(1))
    rows = merkle.with_tree(df, "text").collect()
    assert rows[0].asDict().keys() == {"text", "_grouped", "root", "sections", "leaves"} and rows[0]["_grouped"] == "mine"
    assert len({r["root"] for r in rows}) == 2 and all(len(n) == merkle.NODE for r in rows for n in (*r["sections"], *r["leaves"]))
    pair = [merkle.with_tree(df, "text").select(merkle.fingerprint().alias("f")).collect()[i]["f"] for i in (0, 1)]
    near = spark.createDataFrame([tuple(pair)], "a string, b string").select(merkle.likeness(F.col("a"), F.col("b")), merkle.likeness(F.col("a"), F.col("a"))).first()
    assert 0 < near[0] < 1 and near[1] == 1


def test_edits_are_located(spark):
    lines = [f"Line {i} has a clause, and another one." for i in range(60)]
    after = lines[:30] + ["Line 30 was changed, and another one."] + lines[31:]
    before = spark.createDataFrame([(1, "\n".join(lines)), (2, "same"), (3, "only before")], SCHEMA)
    changed = spark.createDataFrame([(1, "\n".join(after)), (2, "same"), (4, "only after")], SCHEMA)
    (row,) = merkle.edited_branches(before, changed).collect()
    assert row["doc_id"] == 1 and row["leaves"] == [60] and len(row["sections"]) <= 2


def test_likeness_follows_the_edit(spark):
    rng = random.Random(5)
    text = lambda: " ".join(f"{rng.getrandbits(40):x}," for _ in range(200))
    got = merkle.document_fingerprints(spark.createDataFrame([(i, text()) for i in range(20)], SCHEMA)).agg(F.min("near_edited"), F.max("near_edited"), F.max("near_next")).first()
    assert 0.25 < got[0] <= got[1] < 0.45 and got[2] < 0.05  # half of the leaves of either are shared: a third of all
