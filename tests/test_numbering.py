"""Running sums and row numbers against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from veritally.operators import batching, metrics, numbering
from veritally.operators.numbering import number_rows, running_sums, store_in_order, with_position


def test_running_sums_over_blocks(spark):
    rng = random.Random(3)
    data = [(g, p, rng.randrange(10)) for g in (0, 1) for p in rng.sample(range(-400, 400), 120)]
    df = spark.createDataFrame(data, "g int, p long, v long")
    want = sorted((g, p, v, sum(w for h, q, w in data if h == g and q < p)) for g, p, v in data)
    for levels in (0, 1, 2):
        got = running_sums(df, "p", ["v"], ["g"], levels, block=7)
        assert rows(got.select("g", "p", "v", "v_before")) == want


def test_positions_close_gaps(spark):
    ids = [3, 10, 11, 500, 70000, 70001, 10**10]
    df = spark.createDataFrame([(i,) for i in ids], "row_idx long")
    assert rows(with_position(df, "row_idx").select("row_idx", "pos")) == list(zip(ids, range(len(ids))))
    batched = batching.assign_batches(df, 3).select("row_idx", "batch_id")
    assert rows(batched) == [(i, n // 3) for n, i in enumerate(ids)]


def test_positions_of_sparse_and_clustered_ids(spark, monkeypatch):
    """However the ids lie, no task gets more than twice the mean."""
    stored = []
    plain = numbering.materialize
    monkeypatch.setattr(numbering, "materialize", lambda df, name: stored.append(plain(df, name)) or stored[-1])
    rng = random.Random(5)
    hashed = [rng.getrandbits(63) - (1 << 62) for _ in range(6000)]
    clustered = [*range(3000), *range(10**15, 10**15 + 2900), *(10**16 * i for i in range(1, 101))]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for ids in (hashed, clustered):
            df = spark.createDataFrame([(i,) for i in ids], "row_idx long").repartition(4)
            got = rows(with_position(df, "row_idx").select("row_idx", "pos"))
            assert got == [(x, i) for i, x in enumerate(sorted(ids))]
            sizes = [r["count"] for r in stored.pop().groupBy(F.input_file_name()).count().collect()]
            assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert with_position(df.where("false"), "row_idx").count() == 0


def test_number_rows_within_groups(spark):
    data = [(g, v) for g in ("a", "b") for v in range(50)]
    df = spark.createDataFrame(data, "g string, v int")
    got = number_rows(df, -F.floor(F.col("v") / 8), [F.desc("v")], "at", ["g"])
    assert rows(got.select("g", "v", "at")) == [(g, v, 49 - v) for g, v in data]


def test_shuffle_is_a_seeded_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "row_idx")
    order = lambda seed, epoch: {
        r.row_idx: r.shuffle_pos for r in batching.seeded_shuffle(df, "row_idx", seed, epoch).collect()
    }
    first = order(1, 0)
    assert sorted(first.values()) == list(range(500))
    assert order(1, 0) == first
    assert order(1, 1) != first and order(2, 0) != first


def test_regroup_and_back(spark):
    df = spark.range(23).select(F.col("id").alias("pos"), F.col("id").alias("kept"))
    grouped = batching.regroup(df, 4)
    assert rows(grouped.select("kept", "group_id", "place")) == [(i, i // 4, i % 4) for i in range(23)]
    assert rows(batching.flatten_groups(grouped, 4).select("kept", "pos")) == [(i, i) for i in range(23)]


def test_running_reward(spark):
    data = [(e, b, float((b * 7 + e) % 5)) for e in (0, 1) for b in range(40)]
    df = spark.createDataFrame(data, "epoch int, batch_id long, reward double")
    got = rows(metrics.running_reward(df).select("epoch", "batch_id", "avg_reward"))
    for e, b, avg in got:
        so_far = [r for f, c, r in data if f == e and c <= b]
        assert abs(avg - sum(so_far) / len(so_far)) < 1e-12


def test_accuracy_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "reward double")
    assert rows(metrics.accuracy(empty)) == [(0.0, 0, None)]


def test_epoch_mean_counts_every_batch_alike(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 1.0), (0, 1, 3.0, 0.0)], "epoch int, batch_id long, loss double, reward double")
    assert rows(metrics.epoch_mean_of_means(df)) == [(0, 2, 2.0, 0.5)]


def test_rows_stored_in_order(spark):
    """Clustered values, ties told apart by an id, and NULLs first."""
    rng = random.Random(3)
    rows = [(rng.choice([None, 5, 5, 5, 7, 10**15 + rng.randint(0, 50)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v long, id long")
    for parts in ("3", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = store_in_order(df, [F.col("v").desc_nulls_last(), "id"], "at")
            placed = {r["id"]: r["at"] for r in got.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        assert placed == {i: at for at, (_, i) in enumerate(order)}
    assert store_in_order(df.limit(0), ["v"], "at").count() == 0


def test_rows_stored_in_order_of_their_group(spark):
    rows = [(g, i) for g in (None, "a", "b") for i in range(700 if g == "a" else 40)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(9)
    got = store_in_order(df, ["id"], "at", group=["g"]).collect()
    assert len(got) == len(rows) and all(r["at"] == r["id"] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 17, 100, 1000, 1025, 30_000])
def test_permutation_is_a_bijection(spark, n):
    df = spark.range(n).withColumnRenamed("id", "pos")
    orders = []
    for seed, epoch in ((1, 0), (1, 1), (2, 0)):
        got = rows(batching.permuted_batches(df, "pos", n, 7, seed, epoch))
        assert sorted(p for _, p, _ in got) == list(range(n)) and all(b == p // 7 for _, p, b in got)
        assert got == rows(batching.permuted_batches(df, "pos", n, 7, seed, epoch))
        orders.append([p for _, p, _ in got])
    if n >= 100:
        assert len(set(map(tuple, orders))) == 3
        for order in orders:  # about half of the steps go up, and neighbours do not stay close
            ups = sum(x < y for x, y in zip(order, order[1:])) / n
            near = sum(abs(x - y) < n / 50 for x, y in zip(order, order[1:])) / n
            assert 0.4 < ups < 0.6 and near < 0.15


def test_permutation_is_one_projection(spark):
    text = plan(batching.permuted_batches(spark.range(10**6), "id", 10**6, 32, 5))
    assert "Exchange" not in text and "Sort" not in text and "Window" not in text
    with pytest.raises(ValueError):
        batching.permuted_position(F.col("id"), 1 << 60, 1)
