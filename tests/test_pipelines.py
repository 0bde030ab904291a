"""Pipelines, reports, sinks and streams, with their plans."""

import math
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from veritally import fixed_values as V
from veritally import workspace
from veritally.functions.text import extract_prediction
from veritally.operators import batching, compare, metrics, policy, scoring
from veritally.plans.compare import compare_models
from veritally.plans.evaluate import evaluate_split
from veritally.plans import training as training_plan
from veritally.plans.score import score_rollouts
from veritally.plans.training import training_metrics, training_metrics_from_arrays
from veritally.schemas import ROLLOUTS, require_columns
from veritally.sources import problems as source
from veritally.sources import sinks
from veritally.sources.tables import read_records
from veritally.streaming import scores as streaming
from veritally.verification import views


@pytest.fixture(scope="module")
def problems(spark, sf_dir):
    return views.problems(spark, sf_dir)


@pytest.fixture(scope="module")
def rollouts(spark, sf_dir):
    return views.rollouts(spark, sf_dir)


@pytest.fixture(scope="module")
def stored(spark, problems, rollouts, tmp_path_factory):
    """Problems and rollouts as tables of several files."""
    folder = str(tmp_path_factory.mktemp("stored"))
    source.write_problems(problems, f"{folder}/problems")
    rollouts.repartition(5, "problem_id").write.parquet(f"{folder}/rollouts")
    return folder


# --- scoring ---------------------------------------------------------------


def test_advantages_of_a_group_sum_to_zero(rollouts, problems):
    groups = score_rollouts(rollouts, problems).groupBy("problem_id").agg(
        F.sum("advantage").alias("total"), F.count_distinct("reward").alias("kinds"), F.max(F.abs("advantage")).alias("top")
    )
    got = groups.collect()
    assert all(abs(r.total) < 1e-12 for r in got)
    assert all(r.top == 0 for r in got if r.kinds == 1)


def test_score_plan_has_one_exchange_per_side(spark, stored, problems):
    """Large problem table: the window reuses the partitioning of the join."""
    from veritally.operators import skew

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.read.parquet(f"{stored}/rollouts")
        stored_problems = source.read_problems(spark, f"{stored}/problems")
        paired = skew.join_unique(
            facts.select("problem_id", "sample_idx", extract_prediction(F.col("completion")).alias("pred")),
            stored_problems.select("problem_id", "answer"),
            "problem_id",
            ["sample_idx"],
            hot=(),
            small=False,
        ).withColumn("reward", F.lit(1.0))
        text = plan(scoring.group_advantage(paired, hot=()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("SortMergeJoin") == 1 and text.count("Window [") == 1
    assert "Python" not in text


def test_each_token_table_is_shuffled_once(spark):
    """Sequence advantages, old scores and new scores meet in one partitioning."""
    old = spark.range(100).select((F.col("id") / 10).cast("long").alias("seq_id"), (F.col("id") % 10).cast("int").alias("pos"), F.lit(-1.0).alias("lp"))
    new = old.crossJoin(spark.range(3).select(F.col("id").cast("int").alias("ppo_epoch")))
    adv = spark.range(10).select(F.col("id").alias("seq_id"), F.lit(0).alias("batch_id"), F.lit(0.5).alias("advantage"))
    weighted = policy.broadcast_advantage(old, adv, ())
    text = plan(policy.policy_loss(policy.align_logprobs(weighted, new), ["batch_id", "ppo_epoch"], F.lit(1.0)))
    assert text.count("Exchange hashpartitioning(seq_id") == 3
    assert text.count("SortMergeJoin") == 2


def test_small_problem_table_is_broadcast(rollouts, problems):
    text = plan(score_rollouts(rollouts, problems, hot=()))
    assert "BroadcastHashJoin" in text and "BuildRight" in text and "SortMergeJoin" not in text


def test_evaluation_is_the_mean_reward_of_one_sample_each(spark, sf_dir, problems):
    greedy = views.model_completions(spark, sf_dir, 0)
    ((correct, total, share),) = rows(evaluate_split(greedy, problems, "test"))
    test = source.load_split(problems, "test")
    scored = scoring.add_reward(scoring.attach_gold(greedy, test))
    assert share == pytest.approx(scored.agg(F.avg("reward")).first()[0])
    assert total == test.count() and correct == share * total


def test_null_golds_get_no_reward(rollouts, problems):
    bad = scoring.null_golds(problems)
    assert bad.count() > 0
    scored = score_rollouts(rollouts, problems).join(bad.select("problem_id"), "problem_id", "left_semi")
    assert scored.agg(F.sum("reward")).first()[0] == 0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="sample_idx.*completion"):
        require_columns(spark.range(1).withColumnRenamed("id", "problem_id"), ROLLOUTS)


# --- sources and sinks -----------------------------------------------------


def test_split_is_pruned_to_its_folder(spark, stored, problems):
    test = source.read_problems(spark, f"{stored}/problems", "test")
    assert "PartitionFilters: [isnotnull(split" in plan(test, "formatted")
    pick = ["problem_id", "row_idx", "split", "question", "answer"]
    assert rows(test.select(pick)) == rows(source.load_split(problems, "test").select(pick))


def test_filter_and_columns_reach_the_scan(spark, stored):
    stored_rollouts = read_records(spark, f"{stored}/rollouts", ROLLOUTS)
    golds = stored_rollouts.where("sample_idx = 0").select("problem_id")
    text = plan(golds, "formatted")
    assert "EqualTo(sample_idx,0)" in text and "ReadSchema: struct<problem_id:bigint,sample_idx:int>" in text


def test_lookup_with_repeats(spark, problems):
    wanted = spark.createDataFrame([(3,), (3,), (5,), (10**9,)], "i int")
    assert [r[1] for r in rows(source.row_lookup(problems, wanted).select("problem_id", "row_idx"))] == [3, 5]


def test_metrics_log(spark, tmp_path):
    df = spark.createDataFrame([(0, 1, 0.5, 1.0), (1, 1, 0.25, 0.0)], "epoch int, batch_id long, loss double, reward double")
    path = str(tmp_path / "log")
    logged = metrics.running_reward(df)
    sinks.log_metrics(logged, path)
    sinks.log_metrics(logged, path)  # again, as after a failure
    sinks.log_metrics(logged.where("epoch = 1").withColumn("loss", F.lit(9.0)), path)
    assert sorted(p for p in os.listdir(path) if p.startswith("epoch")) == ["epoch=0", "epoch=1"]
    stored = spark.read.parquet(path).select("epoch", "batch_id", "loss", "reward", "avg_reward")
    assert rows(stored) == [(0, 1, 0.5, 1.0, 1.0), (1, 1, 9.0, 0.0, 0.0)]
    shown = sinks.metric_lines(metrics.running_reward(df))
    assert rows(shown) == [(0, 1, "0.5000", "1.0000", "1.0000"), (1, 1, "0.2500", "0.0000", "0.0000")]


# --- comparison ------------------------------------------------------------


def test_published_verdicts(spark):
    """Verdicts of the ten published questions: 2 and 5 right, one by both."""
    base, trained = {0, 1}, {1, 3, 5, 7, 9}
    df = spark.createDataFrame([(i in base, i in trained) for i in range(10)], "baseline_ok boolean, trained_ok boolean")
    assert rows(compare.model_tally(df)) == [(False, False, 4), (False, True, 4), (True, False, 1), (True, True, 1)]
    assert rows(compare.model_totals(df)) == [("baseline", 2, 10), ("trained", 5, 10)]


@pytest.fixture(scope="module")
def tiny(spark):
    problems = spark.createDataFrame(
        [(i, i, "test", f"Question {i} " + "long " * 20 * (i % 2), f"#### {i}") for i in range(12)],
        "problem_id long, row_idx long, split string, question string, answer string",
    )
    base = spark.createDataFrame([(i, f"a|b\n = {i}") for i in range(12)], "problem_id long, completion string")
    trained = spark.createDataFrame([(i, f"the answer is {i + i % 2}") for i in range(12)], "problem_id long, completion string")
    return problems, base, trained


def test_report(tiny, tmp_path):
    report = compare_models(*tiny)
    got = rows(report, "idx")
    assert len(got) == V.REPORT_ROWS and got[3][4] == "Yes" and got[3][6] == "No"
    assert got[3][1] == ("Question 3 " + "long " * 20)[:50] + "..."
    assert got == rows(compare_models(*tiny, n=None), "idx")[: V.REPORT_ROWS]
    lines = [r[1] for r in rows(compare.markdown_lines(report))]
    assert lines[:2] == [V.MARKDOWN_TITLE, ""] and len(lines) == 14
    assert lines[4] == "| 0 | Question 0  | 0.0 | a\\|b<br> = 0 | Yes | the answer is 0 | Yes |"
    raw = [r[1] for r in rows(compare.markdown_lines(report, escape=False))]
    assert raw[4] == "| 0 | Question 0  | 0.0 | a|b\n = 0 | Yes | the answer is 0 | Yes |"
    fixed = [r[1] for r in rows(compare.fixed_width_lines(report))]
    padded = lambda cells: V.REPORT_SEPARATOR.join(str(c).ljust(w) for c, w in zip(cells, V.REPORT_WIDTHS))
    assert fixed[0] == padded(V.REPORT_COLUMNS) and fixed[1] == "-" * V.REPORT_RULE_WIDTH
    assert fixed[2:] == [padded(r) for r in got]
    sinks.write_report(compare.markdown_lines(report), str(tmp_path / "md"), single_file=True)
    (part,) = [f for f in os.listdir(tmp_path / "md") if f.startswith("part")]
    assert (tmp_path / "md" / part).read_text().splitlines() == lines


def test_report_of_a_whole_split_in_parts(spark, tiny, tmp_path):
    lines = compare.markdown_lines(compare_models(*tiny, n=None))
    sinks.write_report(lines, str(tmp_path / "md"))
    parts = sorted(f for f in os.listdir(tmp_path / "md") if f.startswith("part"))
    text = "".join((tmp_path / "md" / p).read_text() for p in parts)
    assert text.splitlines() == [r[1] for r in rows(lines)]


def test_unanswered_gold_prints_none(spark, tiny):
    problems = tiny[0].withColumn("answer", F.lit("no number"))
    lines = [r[1] for r in rows(compare.markdown_lines(compare_models(problems, *tiny[1:])))]
    assert "| None |" in lines[4] and "Yes" not in lines[4]


# --- streams ---------------------------------------------------------------


def stream(spark, stored, files):
    schema = spark.read.parquet(f"{stored}/rollouts").schema
    return streaming.read_rollout_stream(spark, f"{stored}/rollouts", schema, files)


def test_stream_in_many_micro_batches_equals_the_batch_result(spark, stored, rollouts, problems, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    found = streaming.batch_metrics_stream(stream(spark, stored, 1), problems)
    query = streaming.start_batch_metrics(found, out, state)
    query.awaitTermination()
    assert len([p for p in os.listdir(out) if p.startswith("micro_batch")]) == 5
    paired = scoring.attach_gold(rollouts, problems, ["batch_id"])
    want = scoring.add_reward(paired).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.avg("reward").alias("reward"))
    first = rows(streaming.latest_batch_metrics(spark, out))
    assert first == rows(want)
    again = streaming.start_batch_metrics(streaming.batch_metrics_stream(stream(spark, stored, 1), problems), out, state)
    again.awaitTermination()
    assert rows(streaming.latest_batch_metrics(spark, out)) == first


def test_stream_advantages(spark, stored, rollouts, problems, tmp_path):
    out = str(tmp_path / "out")
    streaming.start_advantages(stream(spark, stored, 2), problems, out, str(tmp_path / "state"), V.GROUP_SIZE).awaitTermination()
    cols = ["problem_id", "sample_idx", "pred", "gt", "reward", "advantage"]
    assert rows(spark.read.parquet(out).select(cols)) == rows(score_rollouts(rollouts, problems).select(cols))


def test_split_groups_need_the_late_pass(spark, rollouts, problems, tmp_path):
    """Samples of each problem in different files: the stream alone refuses them, the late pass gives the batch result."""
    path = str(tmp_path / "rollouts")
    rollouts.repartition(3, "sample_idx").write.parquet(path)
    arrivals = lambda: streaming.read_rollout_stream(spark, path, rollouts.schema, 1)
    with pytest.raises(Exception, match="rows, not 4"):
        streaming.start_advantages(arrivals(), problems, str(tmp_path / "a"), str(tmp_path / "b"), V.GROUP_SIZE).awaitTermination()
    out = str(tmp_path / "out")
    streaming.start_scores(arrivals(), problems, out, str(tmp_path / "state")).awaitTermination()
    got = streaming.late_advantages(spark, out, group_size=V.GROUP_SIZE)
    assert rows(got) == rows(score_rollouts(rollouts, problems).select(got.columns))


def test_nothing_arrived(spark, problems, tmp_path):
    path = tmp_path / "none"
    path.mkdir()
    schema = "problem_id long, sample_idx int, batch_id long, completion string"
    arrivals = lambda: spark.readStream.schema(schema).parquet(str(path))
    out = str(tmp_path / "out")
    streaming.start_batch_metrics(streaming.batch_metrics_stream(arrivals(), problems), out, str(tmp_path / "s")).awaitTermination()
    assert rows(streaming.latest_batch_metrics(spark, out)) == []
    streaming.start_scores(arrivals(), problems, out + "2", str(tmp_path / "s2")).awaitTermination()
    assert rows(streaming.late_advantages(spark, out + "2")) == []


def test_queries_read_folders_of_parts(spark, sf_dir, tmp_path):
    from veritally.verification.registry import QUERIES

    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("streaming_scores", "streaming_advantages", "score_rollouts"):
        assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, sf_dir))


# --- epochs ----------------------------------------------------------------


def test_groups_of_each_epoch(spark):
    """All wrong in the first epoch, all right in the second: nothing to learn in either."""
    problems = spark.createDataFrame([(1, "#### 5")], "problem_id long, answer string")
    data = [(e, 1, s, f"the answer is {5 if e else 6}") for e in (0, 1) for s in range(4)]
    rollouts = spark.createDataFrame(data, "epoch int, problem_id long, sample_idx int, completion string")
    scored = score_rollouts(rollouts, problems, group_size=4, carry=["epoch"], group=["epoch", "problem_id"])
    assert rows(scored.select("epoch", "reward", "advantage").distinct()) == [(0, 0.0, 0.0), (1, 1.0, 0.0)]
    assert rows(scoring.group_mean_reward(scored, ["epoch", "problem_id"])) == [(0, 1, 0.0), (1, 1, 1.0)]
    assert rows(scoring.group_size_violations(scored, 4, ["epoch", "problem_id"])) == []
    with pytest.raises(Exception, match="group 1 has 8 rows, not 4"):
        score_rollouts(rollouts, problems, group_size=4).collect()


def test_groups_by_stored_position(spark):
    """Rewards that come with a position only."""
    data = spark.createDataFrame([(i, float(i % 4 == 0)) for i in range(8)], "pos long, reward double")
    grouped = batching.regroup(data, 4).withColumnRenamed("place", "sample_idx")
    got = scoring.group_advantage(grouped, 4, group="group_id").select("pos", "advantage")
    assert rows(got) == [(i, 0.75 if i % 4 == 0 else -0.25) for i in range(8)]


@pytest.mark.parametrize("arrays", [False, True])
def test_last_ppo_epoch_of_each_batch(spark, arrays):
    """Batch 0 ends with PPO epoch 1, batch 1 with 4, batch 2 has no token in the loss."""
    scored = spark.createDataFrame(
        [(10, 0, 0, 1.0, 0.5), (11, 0, 1, 0.0, -1.0), (12, 0, 2, 1.0, 1.0)],
        "seq_id long, epoch int, batch_id long, reward double, advantage double",
    )
    old = {10: [-1.0, -2.0, -3.0], 11: [-1.0, -1.5], 12: [-1.0]}
    new = {(0, 10): [-1.0, -1.0, -1.0], (1, 10): [-1.0, -2.1, -2.9], (2, 11): [-5.0, -5.0], (4, 11): [-1.0, -1.4]}
    if arrays:
        frames = (
            spark.createDataFrame(list(old.items()), "seq_id long, lps array<double>"),
            spark.createDataFrame([(*k, v) for k, v in new.items()], "ppo_epoch int, seq_id long, lps array<double>"),
        )
        got = training_metrics_from_arrays(scored, *frames, F.lit(2))
    else:
        frames = (
            spark.createDataFrame([(s, i, x) for s, v in old.items() for i, x in enumerate(v)], "seq_id long, pos int, lp double"),
            spark.createDataFrame([(p, s, i, x) for (p, s), v in new.items() for i, x in enumerate(v)], "ppo_epoch int, seq_id long, pos int, lp double"),
        )
        got = training_metrics(scored, *frames, F.lit(2))
    ratio = lambda a, b: math.exp(b - a)
    first = -(ratio(-2.0, -2.1) * 0.5 + ratio(-3.0, -2.9) * 0.5) / 2
    second = -min(ratio(-1.5, -1.4) * -1.0, min(ratio(-1.5, -1.4), 1.2) * -1.0)
    found = rows(got.select("batch_id", "loss"))
    assert [b for b, _ in found] == [0, 1, 2] and found[2][1] is None
    assert found[0][1] == pytest.approx(first) and found[1][1] == pytest.approx(second)


@pytest.mark.parametrize("late", [False, True])
def test_sequences_meet_their_batch_only_if_last_ppo_epochs_differ(spark, monkeypatch, late):
    """Sequence 11 has a later PPO epoch than 10, or the same; batch 2 has no token in the loss."""
    scored = spark.createDataFrame(
        [(10, 0, 0, 1.0, 0.5), (11, 0, 1, 0.0, -1.0), (12, 0, 2, 1.0, 1.0)],
        "seq_id long, epoch int, batch_id long, reward double, advantage double",
    )
    old = spark.createDataFrame([(10, [-1.0, -2.0]), (11, [-1.0, -1.5]), (12, [-1.0])], "seq_id long, lps array<double>")
    scores = [(0, 10, [-1.0, -5.0]), (1, 10, [-1.0, -2.1]), (1, 11, [-1.0, -1.4]), (1, 12, [-1.0])]
    scores += [(4, 11, [-1.0, -1.5])] if late else []
    new = spark.createDataFrame(scores, "ppo_epoch int, seq_id long, lps array<double>")
    met = []
    plain = training_plan._last_ppo_epochs
    monkeypatch.setattr(training_plan, "_last_ppo_epochs", lambda *a: met.append(1) or plain(*a))
    got = dict(rows(training_metrics_from_arrays(scored, old, new, F.lit(2)).select("batch_id", "loss")))
    assert got[0] == pytest.approx(-math.exp(-0.1) * 0.5) and got[1] == pytest.approx(1.0 if late else math.exp(0.1))
    assert got[2] is None and len(met) == late


def test_earlier_ppo_epochs_stay_out_of_the_joins(spark, tmp_path, monkeypatch):
    """The filter on the PPO epoch is below the exchange; stored by PPO epoch it rules out folders."""
    spark.createDataFrame([(p, 1, i, -1.0) for p in range(3) for i in range(3)], "ppo_epoch int, seq_id long, pos int, lp double").write.partitionBy("ppo_epoch").parquet(f"{tmp_path}/new")
    new = spark.read.parquet(f"{tmp_path}/new")
    old = new.where("ppo_epoch = 0").drop("ppo_epoch")
    scored = spark.createDataFrame([(1, 0, 0, 1.0, 0.5)], "seq_id long, epoch int, batch_id long, reward double, advantage double")
    plans = []
    monkeypatch.setattr(training_plan, "_logged_metrics", lambda s, tokens, eps: plans.append(plan(tokens, "formatted")) or tokens)
    training_metrics(scored, old, new, F.lit(2))
    assert "PartitionFilters: [" in plans[0] and "(ppo_epoch" in plans[0].split("PartitionFilters: [", 1)[1] and " = 2)" in plans[0]


def test_workspace_is_emptied(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path / "shared"))
    with workspace.workspace(spark):
        kept = workspace.materialize(spark.range(5), "numbers")
        assert kept.count() == 5 and len(os.listdir(tmp_path / "shared")) == 1
    assert os.listdir(tmp_path / "shared") == []
    workspace.materialize(spark.range(5), "numbers")
    assert len(os.listdir(tmp_path / "shared")) == 1


def test_custom_reward_reaches_the_pipeline(rollouts, problems):
    half = lambda pred, gold: F.when(pred.isNotNull(), F.lit(0.5)).otherwise(F.lit(0.0))
    got = score_rollouts(rollouts, problems, reward_fn=half).select("reward").distinct()
    assert rows(got) == [(0.0,), (0.5,)]


def test_tokens_are_shuffled_once_in_any_session(spark, sf_dir):
    """With Spark's own settings too, old scores stay with their sequence when they meet the new ones."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    weighted = policy.broadcast_advantage(views.old_logprobs(plain, sf_dir), views.sequence_advantages(plain, sf_dir), hot=())
    losses = policy.policy_loss(policy.align_logprobs(weighted, views.new_logprobs(plain, sf_dir)), ["batch_id", "ppo_epoch"], F.lit(1.0))
    text = plan(losses)
    assert text.count("Exchange hashpartitioning(seq_id") == 3 and ", pos#" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", text))


def test_a_sequence_moves_to_its_batch_once(spark, sf_dir, monkeypatch):
    """Of the first tokens of all PPO epochs only the last one of a sequence is moved."""
    stored = {}
    keep = training_plan.materialize
    monkeypatch.setattr(training_plan, "materialize", lambda df, name: stored.setdefault(name, plan(df)) and keep(df, name))
    scored = spark.createDataFrame([(1, 0, 0, 1.0, 0.5), (2, 0, 0, 0.0, -0.5)], "seq_id long, epoch int, batch_id long, reward double, advantage double")
    starts = spark.createDataFrame([(1, 0), (1, 3), (2, 1), (2, 1)], "seq_id long, ppo_epoch int")
    sequences, _ = training_plan._last_ppo_epochs(starts, scored, ["seq_id"])
    assert rows(sequences.select("seq_id", "_last")) == [(1, 3), (2, 3)]
    assert "partial_max(ppo_epoch" in stored["last-ppo-epochs"] and "HashAggregate(keys=[seq_id" in stored["last-ppo-epochs"]
