"""Hot keys: the spread plan gives the rows of the plain plan."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from veritally.operators import policy, scoring, sequences, skew
from veritally.plans import score
from veritally.plans.score import score_rollouts

N = 3000


@pytest.fixture(scope="module")
def rollouts(spark):
    """Problem 7 has a third of all rows."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("problem_id"),
        F.col("id").cast("int").alias("sample_idx"),
        F.concat(F.lit("the answer is "), F.col("id") % 5).alias("completion"),
    )


@pytest.fixture(scope="module")
def problems(spark):
    return spark.range(100).select(
        F.col("id").alias("problem_id"),
        F.concat(F.lit("#### "), F.when(F.col("id") % 9 != 0, F.col("id") % 5).cast("string")).alias("answer"),
    )


def test_find_hot_keys(rollouts):
    hot = skew.find_hot_keys(rollouts, "problem_id", rows_per_task=200)
    assert rows(hot) == [(7, 6)]
    assert skew.find_hot_keys(rollouts, "problem_id") == skew.NO_HOT
    assert skew.find_hot_keys(rollouts.where("false"), "problem_id") == skew.NO_HOT


def test_any_number_of_hot_keys(spark):
    """No cap: every hot key is found and split, one of them being the last."""
    df = spark.range(8000).select((F.col("id") % 2000).alias("problem_id"), F.col("id").cast("int").alias("sample_idx"))
    df = df.withColumn("reward", (F.col("sample_idx") % 3).cast("double"))
    hot = skew.find_hot_keys(df, "problem_id", rows_per_task=2)
    assert hot.count() == 2000 and hot.agg(F.min("_salts"), F.max("_salts")).first() == (2, 2)
    plain, spread = (scoring.group_advantage(df, 4, h) for h in (skew.NO_HOT, hot))
    pick = ["problem_id", "sample_idx", F.round("advantage", 9).alias("a")]
    assert rows(plain.select(pick)) == rows(spread.select(pick))


def test_keys_of_two_columns(rollouts):
    df = rollouts.withColumn("epoch", F.col("sample_idx") % 2)
    hot = skew.find_hot_keys(df, ["epoch", "problem_id"], rows_per_task=200)
    assert rows(hot) == [(0, 7, 3), (1, 7, 3)]
    stats = dict(sums={"total": F.col("sample_idx")})
    plain, spread = (skew.with_group_stats(df, ["epoch", "problem_id"], ["sample_idx"], hot=h, **stats) for h in ((), hot))
    assert rows(plain.select("epoch", "sample_idx", "total")) == rows(spread.select("epoch", "sample_idx", "total"))


def test_string_keys(rollouts):
    named = rollouts.withColumn("name", F.concat(F.lit("k"), F.col("problem_id")))
    hot = skew.find_hot_keys(named, "name", rows_per_task=200)
    assert rows(hot) == [("k7", 6)]
    stats = dict(sums={"total": F.col("sample_idx")})
    plain = skew.with_group_stats(named.drop("completion"), "name", ["sample_idx"], hot=(), **stats)
    spread = skew.with_group_stats(named.drop("completion"), "name", ["sample_idx"], hot=hot, **stats)
    assert rows(plain.select("name", "sample_idx", "total")) == rows(spread.select("name", "sample_idx", "total"))


@pytest.mark.parametrize("small", [True, False])
def test_scores_are_the_same(rollouts, problems, small, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: small)
    hot = skew.find_hot_keys(rollouts, "problem_id", rows_per_task=200)
    plain = score_rollouts(rollouts, problems, hot=())
    spread = score_rollouts(rollouts, problems, hot=hot)
    assert spread.columns == plain.columns
    assert plain.count() == N
    cols = ["problem_id", "sample_idx", "pred", "gt", "reward", F.round("advantage", 9).alias("advantage")]
    assert rows(plain.select(cols)) == rows(spread.select(cols))


def test_hot_rows_are_spread(rollouts, problems):
    hot = skew.find_hot_keys(rollouts, "problem_id", rows_per_task=200)
    salted = skew.add_salt(rollouts, "problem_id", hot, ["sample_idx"]).where("problem_id = 7")
    sizes = [r["count"] for r in salted.groupBy(skew.SALT).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 300
    copies = skew.replicate(problems, "problem_id", hot).groupBy("problem_id").count().where("count > 1")
    assert [tuple(r) for r in copies.collect()] == [(7, 6)]


def test_maxima_for_batches(spark):
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 7).alias("batch_id"),
        F.sequence(F.lit(1), (F.col("id") % 9 + 1).cast("int")).alias("input_ids"),
    ).withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    hot = skew.find_hot_keys(df, "batch_id", rows_per_task=50)
    assert hot
    plain = sequences.pad_to_batch_max(df, 0, ["id"], hot=())
    spread = sequences.pad_to_batch_max(df, 0, ["id"], hot=hot)
    pick = ["id", "batch_id", "input_ids", "attention_mask"]
    assert rows(plain.select(pick)) == rows(spread.select(pick))
    widths = plain.groupBy("batch_id").agg(F.count_distinct(F.size("input_ids")).alias("w"))
    assert {r.w for r in widths.collect()} == {1}


def test_long_sequences(spark):
    tokens = spark.range(1000).select(
        F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("seq_id"),
        F.when(F.col("id") < 600, F.col("id")).otherwise(0).cast("int").alias("pos"),
    )
    hot = policy.long_sequences(tokens, rows_per_task=100)
    assert rows(hot) == [(1, 6)]
    adv = tokens.select("seq_id").distinct().withColumn("advantage", F.col("seq_id") / 4)
    plain = policy.broadcast_advantage(tokens, adv, ())
    spread = policy.broadcast_advantage(tokens, adv, hot)
    assert rows(plain.select("seq_id", "pos", "advantage")) == rows(spread.select("seq_id", "pos", "advantage"))


def test_fits_broadcast(spark):
    assert skew.fits_broadcast(spark.range(10), 10)
    assert not skew.fits_broadcast(spark.range(11), 10)
    assert not skew.fits_broadcast(spark.range(3).withColumn("s", F.lit("text")), 10)


def test_incomplete_group_fails_on_request(spark):
    scored = spark.createDataFrame([(1, 0, 1.0), (1, 1, 0.0), (2, 0, 1.0)], "problem_id long, sample_idx int, reward double")
    assert scoring.group_size_violations(scored, 2).collect() == [(2, 1)]
    with pytest.raises(Exception, match="group 2 has 1 rows, not 2"):
        scoring.group_advantage(scored, 2, ()).collect()


def test_groups_of_an_epoch_share_out_their_rows_by_number(spark, monkeypatch):
    """The tasks of the join and of the group mean grow with the rows, and the join runs once: hot groups show in the rollouts."""
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    problems = spark.range(300).select(F.col("id").alias("problem_id"), F.lit("#### 5").alias("answer"))
    sampled = problems.select("problem_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("sample_idx"), F.lit("the answer is 5").alias("completion"))
    rollouts = sampled.withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1))))
    parts = []
    monkeypatch.setattr(score, "tasks_for", lambda df: parts.append(skew.tasks_for(df, 100)) or parts[-1])
    looked = []
    plain = skew.find_hot_keys
    for module in (skew, score):
        monkeypatch.setattr(module, "find_hot_keys", lambda df, *a, **kw: looked.append(df.columns) or plain(df, *a, **kw))
    for small in (False, True):
        got = score.score_rollouts(rollouts, problems, group_size=4, carry=["epoch"], group=["epoch", "problem_id"], small=small)
        assert got.count() == 2400 and got.where("reward = 1 and advantage = 0").count() == 2400
        assert got.rdd.getNumPartitions() == 24
    assert parts == [24, 24] and all("gt" not in columns for columns in looked)


def test_a_task_gets_half_a_million_dealt_rows_at_most(spark):
    slots = spark.sparkContext.defaultParallelism
    assert skew.tasks_for(spark.range(slots * 500_000 + 1)) == slots + 1
