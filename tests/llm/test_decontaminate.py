import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from veritally.llm import decontaminate

LONGEST = max(map(len, decontaminate.MASKS))


def by_all_places(docs, items):
    """(doc, item) that agree in enough of SPAN neighbouring words and share a seed there, by trying all offsets."""
    found = set()
    for d, text in docs:
        w = (text or "").lower().split()
        for i, item in items:
            v = (item or "").lower().split()
            if len(v) < LONGEST:  # whole items, word by word
                if v and any(w[k : k + len(v)] == v for k in range(len(w))):
                    found.add((d, i))
                continue
            for shift in range(-len(v), len(w)):
                same = [0 <= shift + j < len(w) and w[shift + j] == x for j, x in enumerate(v)]
                need = min(decontaminate.SPAN, len(v))
                most = max(sum(same[k : k + need]) for k in range(len(v) - need + 1))
                seeded = any(
                    all(same[k + o] for o, bit in enumerate(m) if bit == "1") and 0 <= shift + k and shift + k + len(m) <= len(w)
                    for m in decontaminate.MASKS for k in range(len(v) - len(m) + 1)
                )
                if seeded and most >= decontaminate.AGREE * need:
                    found.add((d, i))
    return found


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 8, 9, 12, 15, 30, 60])))) for i in range(12)]
    docs = []
    for d in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 80))
        if d % 2:
            piece = rng.choice(items)[1].split()
            piece = piece[: rng.choice([len(piece), max(1, len(piece) - 4)])]
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                piece[rng.randrange(len(piece))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [x.upper() for x in piece]
        docs.append((d, "  ".join(words)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_places(spark, seed):
    docs, items = corpus(seed)
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == by_all_places(docs, items)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got}) > 10


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, items = corpus(3)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    broadcast = sorted(decontaminate.find_leaks(*frames).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 1)
    assert sorted(decontaminate.find_leaks(*frames).collect()) == broadcast


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, passage, "x"), (1, passage, "y"), (2, None, "z"), (3, "", None), (None, passage, None), (4, "clean words only", "k"), (5, "w " * 200_000 + passage, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _listed string").withColumn("seed", F.lit(1))
    items = spark.createDataFrame([(7, passage), (7, passage), (8, None), (9, "too short"), (10, "")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()), key=str)
    assert got == [(1, 7), (5, 7), (None, 7)]
    kept = decontaminate.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "4"]
    assert decontaminate.drop_leaks(docs, items.where("false")).count() == len(rows)
    assert decontaminate.find_leaks(docs.where("false"), items).count() == 0


def test_rows_are_dropped_by_their_own_text(spark):
    """Ids that are missing or shared name no row: the leaks go, the clean rows stay."""
    passage = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, "x " + passage), (None, "clean"), (5, passage), (5, "clean too"), (5, passage), (6, "clean too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = sorted((tuple(r) for r in decontaminate.drop_leaks(docs, items).collect()), key=str)
    assert kept == sorted([(None, "clean"), (5, "clean too"), (6, "clean too")], key=str)


def test_short_items(spark):
    items = spark.createDataFrame([(1, "Alpha"), (2, "beta gamma"), (3, "a b c d e f g h")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x ALPHA y"), (2, "beta x gamma"), (3, "beta\tgamma"), (4, "a b c d e f g"), (5, "z a b c d e f g h")], "doc_id long, text string")
    found = lambda least: sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items, least=least).collect())
    assert found(1) == [(1, 1), (3, 2), (5, 3)]
    assert found(3) == [(5, 3)]
    assert found(20) == []


def test_plan_does_not_spell_out_the_bitmap(spark):
    docs, items = corpus(7)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(*frames)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == by_all_places(docs, items)
    assert len(plan(found, "extended")) < 200_000
