import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from veritally.llm import audit

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(text):
    w = WORD.findall(text)
    return (
        ("A" if len(w) < 100 else "")
        + ("B" if 100 * len(set(w)) < 80 * len(w) else "")
        + ("C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else "")
        + ("D" if any(c in "#$%&*|" for c in text) else "")
    )


def by_hand(docs, labels):
    """Every order applied to every document, left to right."""
    ids = defaultdict(list)
    for d, text, _ in docs:
        if d is not None:
            ids[text or ""].append(d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for d, text, lang in docs:
        copy = d is not None and min(ids[text or ""]) < d
        rows.append((lang or "", set(failed(text or "") + ("E" if copy else "")), d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        inside = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = inside
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                failing = [r for r in inside if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(removed)
                alone = sum(r[1] == {f} for r in inside)
                out[part, order, step] = [len(left), len(removed), len(failing) - len(removed), alone, sum(r[2] for r in removed), sum(r[3] for r in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def corpus(seed, n=300):
    rng = random.Random(seed)
    texts = [None, "", "A" * 30, "x # y"] + [" ".join(rng.choice(["w%d" % rng.randint(0, 300), "Up", "a&b"][: rng.choice([1, 1, 3])]) for _ in range(rng.choice([20, 99, 100, 150]))) for _ in range(80)]
    docs = [(rng.choice([i, i, i, rng.randint(0, n), None]), rng.choice([texts[4], rng.choice(texts)]), rng.choice(["en", "de", "", None])) for i in range(n)]
    labels = [(rng.randint(0, n), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(n // 2)] + [(None, 1, 1)]
    return docs, labels


def write(spark, docs, path, files):
    for i in range(files):
        spark.createDataFrame(docs[i::files], DOCS).coalesce(1).withColumn("mask", F.lit("clash")).write.mode("append").parquet(path)


def table(df):
    return {tuple(r[:3]): list(r[3:]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_hand(spark, tmp_path, seed, monkeypatch):
    """Smaller ids arrive late as well as early: the files come in the order they were written."""
    monkeypatch.setattr(audit, "HEAP_ROWS", 0 if seed == 1 else audit.HEAP_ROWS)
    docs, labels = corpus(seed)
    docs.sort(key=lambda r: r[0] or 0, reverse=seed == 1)
    third = len(docs) // 3
    path = str(tmp_path / "documents")
    for part in (docs[:third], docs[third : 2 * third], docs[2 * third :]):
        write(spark, part, path, 1)
    assert table(audit.document_audit(spark, path, spark.createDataFrame(labels, LABELS))) == by_hand(docs, labels)


@pytest.mark.parametrize("store", [audit.IN_HEAP, audit.ON_DISK])
def test_smaller_ids_retract_what_was_counted(spark, tmp_path, store):
    """The counters are right after each arrival, and the stream goes on where it stopped."""
    text, path, out = "same text", str(tmp_path / "in"), str(tmp_path / "out")
    labels = spark.createDataFrame([(3, 1, 0)], LABELS)
    arrivals = [[(5, text, "en"), (7, text, "en")], [(3, text, "de"), (3, text, "fr"), (5, text, "en")], [(4, text, "en"), (1, "other", "en")]]
    seen = []
    for rows in arrivals:
        write(spark, rows, path, 1)
        seen += rows
        stream = audit.read_documents_stream(spark, path)
        audit.start_audit(stream, labels, out, str(tmp_path / "checkpoint"), 2, store).awaitTermination()
        assert table(audit.audit(audit.counters(spark, out))) == by_hand(seen, [(3, 1, 0)])
    changes = spark.read.parquet(out)
    assert changes.where("n < 0").count() > 0  # the text's first holder was taken back


def test_copies_meet_before_the_shuffle(spark):
    rows = [("t", 0, i, "00en") for i in range(5000)] + [("u", 0, None, "00en")] * 3
    df = spark.createDataFrame(rows, "digest string, mask int, id long, facts string").coalesce(1)
    got = sorted(tuple(r) for r in audit.bring_copies_together(df).collect())
    assert got == [("t", 0, True, 0, "00en", 1), ("t", audit.COPY, False, 0, "00en", 4999), ("u", 0, False, 0, "00en", 3)]
    split = audit.bring_copies_together(df.repartition(7), most=1)
    assert split.agg(F.sum("n")).first()[0] == 5003


def test_odd_tables(spark, tmp_path):
    labels = spark.createDataFrame([], LABELS)
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "none"))
    assert audit.document_audit(spark, str(tmp_path / "none"), labels).count() == 0
    long_text = "W " * 200_000 + "#"
    write(spark, [(2, long_text, None), (1, long_text, None)], str(tmp_path / "long"), 1)
    assert table(audit.document_audit(spark, str(tmp_path / "long"), labels)) == by_hand([(2, long_text, None), (1, long_text, None)], [])


def test_session_settings_stay(spark, sf_dir):
    before = {name: spark.conf.get(name, None) for name in audit.ON_DISK}
    audit.document_audit(spark, f"{sf_dir}/documents.parquet", spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert {name: spark.conf.get(name, None) for name in audit.ON_DISK} == before
