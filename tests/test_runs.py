"""Rows of one key that lie together are shuffled as one row."""

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from veritally.operators import policy, runs
from veritally.plans import training
from veritally.sources import bucketed
from veritally.workspace import fresh_path

ODD = [(1, 0, None), (1, 0, 2.0), (1, 0, 2.0), (None, 1, 3.0), (None, 2, 4.0), (2, None, 5.0), (1, 1, float("nan")), (2, 3, -0.0)]


def scores(spark, sequences=40, length=6):
    """(old, new, advantages) of sequences whose tokens lie together, but for one that comes in two parts."""
    old = [(s, p, -0.1 * ((s + p) % 7 + 1)) for s in range(sequences) for p in range(length)]
    old.append(old.pop(3))
    new = [(e, s, p, x + 0.05 * e) for s, p, x in old for e in range(3)]
    return (
        spark.createDataFrame(old, "seq_id long, pos int, lp double").coalesce(1),
        spark.createDataFrame(new, "ppo_epoch int, seq_id long, pos int, lp double").coalesce(1),
        spark.createDataFrame([(s, s // 4, s % 5 / 2 - 1.0) for s in range(sequences)], "seq_id long, batch_id long, advantage double"),
    )


def losses(old, new, advantages):
    weighted = policy.broadcast_advantage(old, advantages, ())
    return policy.policy_loss(policy.align_logprobs(weighted, new), ["batch_id", "ppo_epoch"], F.lit(1.0), exact=True)


@pytest.mark.parametrize("key", ["seq_id", ["seq_id", "pos"]])
def test_rows_come_out_as_they_were(spark, key):
    df = spark.createDataFrame(ODD, "seq_id long, pos int, lp double")
    for some in (df, df.coalesce(1), df.limit(0)):
        got = runs.deal_runs(some, key, 3)
        assert got.columns == some.columns and sorted(map(str, got.collect())) == sorted(map(str, some.collect()))
    assert runs.pack_runs(df.coalesce(1), "seq_id").count() == 6  # 1, NULL, NULL, 2, 1, 2


def test_only_numbers_are_packed(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "seq_id long, word string")
    assert not runs.can_pack(df, "seq_id") and not runs.can_pack(df.select("seq_id"), "seq_id")
    assert "MapInArrow" not in plan(runs.deal_runs(df, "seq_id", 2)) and runs.deal_runs(df, "seq_id", 2).count() == 2


def test_a_sequence_is_moved_as_one_row(spark, monkeypatch):
    old, new, advantages = scores(spark)
    packed = []
    pack = runs.pack_runs
    for module in (runs, policy):
        monkeypatch.setattr(module, "pack_runs", lambda df, key: packed.append(pack(df, key)) or packed[-1])
    found = losses(old, new, advantages)
    assert [p.count() for p in packed] == [41, 41]  # of 240 and 720 tokens
    text = plan(found)
    assert text.count("Exchange hashpartitioning(seq_id") == 3 and text.count("MapInArrow") == 2
    for module in (runs, policy):
        monkeypatch.setattr(module, "can_pack", lambda df, key: False)
    assert rows(found) == rows(losses(old, new, advantages))


def test_a_token_task_has_a_bounded_share(spark, monkeypatch):
    """Six tokens a sequence: 40 sequences are 240 tokens."""
    old, new, advantages = scores(spark)
    monkeypatch.setattr(policy, "TOKENS_PER_TASK", 12)
    assert policy.token_tasks(old, advantages) == 20
    weighted = policy.broadcast_advantage(old, advantages, ())
    assert runs.parts_by(weighted, "seq_id") == 20 and runs.parts_by(policy.align_logprobs(weighted, new), "seq_id") == 20


def test_long_sequences_are_still_spread(spark):
    old, new, advantages = scores(spark)
    weighted = policy.broadcast_advantage(old, advantages, policy.long_sequences(old, rows_per_task=2))
    assert runs.parts_by(weighted, "seq_id") is None
    found = policy.align_logprobs(weighted, new)
    assert "MapInArrow" not in plan(found) and found.count() == 720


def test_training_moves_sequences_of_each_epoch_as_one_row(spark, monkeypatch):
    """Sequence numbers come again in each epoch."""
    old, new, advantages = scores(spark)
    twice = lambda df: df.crossJoin(spark.range(2).select(F.col("id").cast("int").alias("epoch"))).orderBy("epoch", "seq_id", "pos")
    old, new = twice(old), twice(new)
    scored = advantages.crossJoin(spark.range(2).select(F.col("id").cast("int").alias("epoch"))).withColumn("reward", F.lit(1.0))
    plans = []
    logged = training._logged_metrics
    monkeypatch.setattr(training, "_logged_metrics", lambda s, t, *rest, **kw: plans.append(plan(t)) or logged(s, t, *rest, **kw))
    found = rows(training.training_metrics(scored, old, new, F.lit(2), sequence=["epoch", "seq_id"], exact=True))
    assert plans[0].count("MapInArrow") == 2 and plans[0].count("Exchange hashpartitioning(epoch") >= 3
    for module in (runs, policy):
        monkeypatch.setattr(module, "can_pack", lambda df, key: False)
    assert found == rows(training.training_metrics(scored, old, new, F.lit(2), sequence=["epoch", "seq_id"], exact=True)) and len(found) == 20


def test_buckets_are_filled_with_whole_runs(spark, monkeypatch):
    _, new, _ = scores(spark)
    packed = []
    pack = runs.pack_runs
    monkeypatch.setattr(runs, "pack_runs", lambda df, key: packed.append(pack(df, key)) or packed[-1])
    stored = bucketed.write_bucketed(new, fresh_path(spark, "test-runs"), bucketed.Layout(["seq_id"], 4, ["pos"], ["ppo_epoch"]))
    assert packed[0].count() == 41 and rows(stored) == rows(new) and stored.columns == new.columns
    assert runs.parts_by(stored, "seq_id") == 4


@pytest.mark.parametrize("late", [False, True])
def test_tokens_meet_their_batch_only_if_last_ppo_epochs_differ(spark, monkeypatch, late):
    """Sequences 0 to 3 are batch 0; sequence 2 has a later PPO epoch than the others, or not."""
    old, new, advantages = scores(spark, sequences=8, length=3)
    if late:
        new = new.unionByName(new.where("seq_id = 2 and ppo_epoch = 2").withColumns({"ppo_epoch": F.lit(5), "lp": F.col("lp") - 0.3}))
    scored = advantages.withColumns({"reward": F.lit(1.0), "epoch": F.lit(0)})
    met = []
    plain = training._last_ppo_epochs
    monkeypatch.setattr(training, "_last_ppo_epochs", lambda *a: met.append(1) or plain(*a))
    found = rows(training.training_metrics(scored, old, new, F.lit(2), exact=True).select("batch_id", "loss"))
    assert len(met) == late
    monkeypatch.setattr(training, "_one_last_ppo_epoch", lambda _: None)
    assert found == rows(training.training_metrics(scored, old, new, F.lit(2), exact=True).select("batch_id", "loss"))
    assert [b for b, _ in found] == [0, 1] and all(x is not None for _, x in found)
