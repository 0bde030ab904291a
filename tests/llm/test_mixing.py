import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from conftest import plan
from pyspark.sql import functions as F

from veritally.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def targets_by_rounds(sizes, weights=(5, 2, 1), cap=3):
    """Share, stop what is above its limit, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, done = Fraction(sum(sizes.values())), {}
    while len(done) < len(names):
        left = total - sum(done.values())
        free = [s for s in names if s not in done]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return done | share
        done |= {s: Fraction(cap * sizes[s]) for s in above}
    return done


def corpus(seed, n=400):
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(9)] + [None, "", "Z"]
    shares = [40, 1, 1, 3, 20, 1, 2, 2, 9, 3, 1, 1]
    return [(i, " \n".join("w" * rng.randint(0, 30)) or None, rng.choices(sources, shares)[0]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_copies(spark, seed):
    docs = corpus(seed)
    rows = {r["doc_id"]: r for r in mixing.plan_mix(spark.createDataFrame(docs, SCHEMA)).collect()}
    size, by_source = defaultdict(int), defaultdict(list)
    for d, text, s in docs:
        assert rows[d]["size"] == len((text or "").split())
        size[s] += rows[d]["size"]
        by_source[s].append((hashlib.md5(str(d).encode()).hexdigest(), d))
    expected = targets_by_rounds(size)
    for s, members in by_source.items():
        at, taken = 0, 0
        for _, d in sorted(members):
            r = rows[d]
            middle = at + Fraction(r["size"], 2)
            copies = [k for k in range(3) if middle + k * size[s] < expected[s]] if size[s] else [0]
            assert r["source_size"] == size[s] and abs(r["target"] - expected[s]) < 1e-6
            assert r["copies"] == len(copies) == len(r["positions"]) and r["taken"] == len(copies) * r["size"]
            at, taken = at + r["size"], taken + r["taken"]
        assert abs(taken - expected[s]) <= max(rows[d]["size"] for _, d in members) / 2 + 1e-6


def test_positions_invert_the_demand(spark):
    """The integral of the schedule up to a copy's position is the copy's share of the demand."""
    docs = spark.createDataFrame(corpus(3), SCHEMA)
    ranked = {r["source"]: r["source_rank"] for r in mixing.source_targets(docs.select("source", mixing.word_count(F.col("text")).alias("size"))).collect()}
    by_source = defaultdict(list)
    for r in mixing.plan_mix(docs).collect():
        a, b = mixing.SLOPES[ranked[r["source"]] % len(mixing.SLOPES)]
        for t in r["positions"]:
            assert 0 <= t <= 1
            by_source[r["source"]].append(((a * t + (b - a) * t * t / 2) * r["target"], r["size"]))
    for placed in by_source.values():
        placed = sorted(p for p in placed if p[1])
        for (x, n), (y, m) in zip(placed, placed[1:]):
            assert abs(y - x - (n + m) / 2) < 1e-3  # one document after another, without gap


def test_training_order(spark):
    docs = spark.createDataFrame([(d, t, s, "mine") for d, t, s in corpus(4, 100)], SCHEMA + ", row string")
    out = mixing.training_order(docs)
    assert out.columns == docs.columns
    planned = {r["doc_id"]: r for r in mixing.plan_mix(docs).collect()}
    order = [t for t, _ in sorted((t, d) for d, r in planned.items() for t in r["positions"])]
    place = {d: iter(sorted(r["positions"])) for d, r in planned.items()}
    assert [next(place[r["doc_id"]]) for r in out.collect()] == order


def test_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (2, None, "y"), (3, "", "y"), (4, "w " * 100_000, "z")]
    got = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["source_size"]) for r in got} == {(1, 4), (None, 1), (2, 0), (3, 0), (4, 100_000)}
    assert mixing.plan_mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.training_order(spark.createDataFrame([], SCHEMA)).count() == 0


def test_same_on_other_partitions(spark):
    docs = spark.createDataFrame(corpus(5), SCHEMA)
    one, two = (sorted(map(str, mixing.document_mix(docs.repartition(n)).collect())) for n in (1, 7))
    assert one == two


def test_repeated_rows_in_training_order(spark):
    """Equal rows are taken for each other, rows that share an id are not."""
    rows = [(1, "a b", "x"), (1, "a b", "x"), (1, "a b c", "x"), (None, "d", "x"), (None, "d", "x"), (2, "e f g h", "y")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_row", F.lit(1)).withColumn("positions", F.lit("kept"))
    taken = defaultdict(int)
    for r in mixing.plan_mix(docs, mark="_row").collect():
        taken[r["doc_id"], r["size"]] += r["copies"]
    out = mixing.training_order(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], len(r["text"].split())) for r in out.collect())
    assert got == Counter({k: n for k, n in taken.items() if n})


def test_one_scan_and_more_parts(spark):
    docs = spark.createDataFrame(corpus(6, 50), SCHEMA)
    assert "regexp_count" not in plan(mixing.plan_mix(docs))  # the texts were read when their sizes were stored
    assert [mixing.part_digits(n) for n in (0, 10**6, 16**3 * 65_536, 16**3 * 65_536 + 1, 10**12)] == [3, 3, 3, 4, 6]


def test_digest_counts_the_range_sorted_mix(spark, monkeypatch):
    """The query's figures come from the copies in training order, not from the plan of the mix."""
    stored = {}

    def store(df, name):
        stored[name] = df
        return materialize(df, name)

    materialize = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", store)
    docs = spark.createDataFrame([*corpus(7, 200), (3, "twice", "x"), (3, "twice", "x")], SCHEMA)
    got = mixing.document_mix(docs)
    mix = stored["mix"]
    assert "rangepartitioning(_position" in plan(mix) and "Sort [_position" in plan(mix)
    copies = [r for part in mix.select("_position", "_words").rdd.glom().collect() for r in part]
    assert [r["_position"] for r in copies] == sorted(r["_position"] for r in copies)
    planned = mixing.plan_mix(docs).collect()
    assert len(copies) == sum(r["copies"] for r in planned) and len(planned) == 202
    expected = Counter((r["doc_id"], r["size"], r["taken"], round(r["positions"][0], 9) if r["positions"] else None) for r in planned)
    assert Counter((r["doc_id"], r["size"], r["taken"], r["position"]) for r in got.collect()) == expected


def test_rows_that_differ_by_the_place_of_a_null(spark):
    docs = spark.createDataFrame([(1, "a b", None), (1, None, "a b"), (2, "c d e", "z")], SCHEMA)
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.document_mix(docs).collect()}
    assert taken == {(r["doc_id"], r["size"]): r["taken"] for r in mixing.plan_mix(docs).collect()} and len(taken) == 3
