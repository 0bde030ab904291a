"""Groups that are completed inside the stream."""

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from veritally import fixed_values as V
from veritally.plans.score import score_rollouts
from veritally.streaming import scores as streaming
from veritally.verification import views

K = V.GROUP_SIZE


@pytest.fixture(scope="module")
def problems(spark, sf_dir):
    return views.problems(spark, sf_dir)


@pytest.fixture(scope="module")
def rollouts(spark, sf_dir):
    return views.rollouts(spark, sf_dir)


def arrive(rollouts, path, *filters):
    for f in filters:
        rollouts.where(f).coalesce(1).write.mode("append").parquet(path)


def run(spark, schema, problems, folder, **options):
    arrivals = streaming.read_rollout_stream(spark, f"{folder}/in", schema, 1)
    options = {"group_size": K, "carry": ["batch_id", "seq_id"]} | options
    query = streaming.start_group_advantages(arrivals, problems, f"{folder}/out", f"{folder}/state", **options)
    query.awaitTermination()
    return query


def test_groups_over_files_leave_once_and_equal_the_batch_result(spark, rollouts, problems, tmp_path):
    """Samples arrive in four files, then the stream is started again for the last one."""
    want = score_rollouts(rollouts, problems, carry=["batch_id", "seq_id"])
    arrive(rollouts, f"{tmp_path}/in", "sample_idx = 2", "sample_idx = 0 or sample_idx = 1 and problem_id % 2 = 0")
    run(spark, rollouts.schema, problems, tmp_path)
    assert rows(streaming.group_advantages(spark, f"{tmp_path}/out")) == []
    waiting = {r["problem_id"]: r["n"] for r in streaming.unfinished_groups(spark, f"{tmp_path}/state", K).collect()}
    assert set(waiting.values()) == {2, 3} and len(waiting) == problems.count()
    arrive(rollouts, f"{tmp_path}/in", "sample_idx = 3", "sample_idx = 1 and problem_id % 2 = 1 and problem_id % 3 = 0")
    run(spark, rollouts.schema, problems, tmp_path)
    got = streaming.group_advantages(spark, f"{tmp_path}/out")
    ready = "problem_id % 2 = 0 or problem_id % 3 = 0"
    assert rows(got.select(want.columns)) == rows(want.where(ready))
    assert {r["n"] for r in streaming.unfinished_groups(spark, f"{tmp_path}/state", K).collect()} == {3}
    arrive(rollouts, f"{tmp_path}/in", "sample_idx = 1 and problem_id % 2 = 1 and problem_id % 3 <> 0")
    run(spark, rollouts.schema, problems, tmp_path)
    assert rows(streaming.group_advantages(spark, f"{tmp_path}/out").select(want.columns)) == rows(want)
    assert streaming.unfinished_groups(spark, f"{tmp_path}/state", K).isEmpty()


def test_group_of_several_columns(spark, sf_dir, problems, tmp_path):
    """A problem is sampled anew in each epoch; the epoch's samples are spread over the files."""
    sampled = views.rollouts_by_epoch(spark, sf_dir)
    group = ["epoch", "problem_id"]
    arrive(sampled, f"{tmp_path}/in", "(epoch + sample_idx) % 2 = 0", "(epoch + sample_idx) % 2 = 1")
    run(spark, sampled.schema, problems, tmp_path, group=group)
    got = streaming.group_advantages(spark, f"{tmp_path}/out", group)
    want = score_rollouts(sampled, problems, carry=["epoch", "batch_id", "seq_id"], group=group)
    assert rows(got.select(want.columns)) == rows(want)


def test_a_sample_too_many_ends_the_stream(spark, rollouts, problems, tmp_path):
    arrive(rollouts, f"{tmp_path}/in", "true", "problem_id = 7 and sample_idx = 0")
    with pytest.raises(Exception, match="group 7 has 5 rows, not 4"):
        run(spark, rollouts.schema, problems, tmp_path)


def test_nothing_arrived(spark, rollouts, problems, tmp_path):
    (tmp_path / "in").mkdir()
    run(spark, rollouts.schema, problems, tmp_path)
    assert rows(streaming.group_advantages(spark, f"{tmp_path}/out")) == []


def test_state_is_built_in(spark, rollouts, problems):
    """The same aggregates over a batch: no Python, and no completion in what is grouped."""
    text = plan(streaming.group_state(rollouts, problems, carry=["batch_id"]), "extended").split("Physical Plan")[1]
    assert "Python" not in text and "ObjectHashAggregate" in text
    assert all("completion" not in line for line in text.splitlines() if "collect_list" in line)


def test_late_pass_keeps_what_is_carried(spark, rollouts, problems, tmp_path):
    arrive(rollouts, f"{tmp_path}/in", "sample_idx < 2", "sample_idx >= 2")
    keyed = rollouts.withColumn("epoch", F.lit("first"))
    keyed.write.parquet(f"{tmp_path}/keyed")
    arrivals = streaming.read_rollout_stream(spark, f"{tmp_path}/keyed", keyed.schema, 1)
    streaming.start_scores(arrivals, problems, f"{tmp_path}/o", f"{tmp_path}/s", carry=["epoch", "batch_id"]).awaitTermination()
    got = streaming.late_advantages(spark, f"{tmp_path}/o", ["epoch", "problem_id"], K)
    want = score_rollouts(keyed, problems, carry=["epoch", "batch_id"])
    assert rows(got.select(want.columns)) == rows(want)


@pytest.mark.parametrize("name", ["streaming_scores", "streaming_advantages", "streaming_advantages_split_groups", "streaming_group_advantages"])
def test_many_rows_arrive_in_many_files(spark, sf_dir, monkeypatch, name):
    """A file, hence a task that writes or reads it, has a bounded number of rows; micro-batches stay four."""
    from veritally.verification import registry

    want = rows(registry.QUERIES[name](spark, sf_dir))
    paths = {}
    fresh = registry.fresh_path
    monkeypatch.setattr(registry, "fresh_path", lambda s, n: paths.setdefault(n, fresh(s, n)))
    monkeypatch.setattr(registry, "ARRIVAL_ROWS", 100)
    assert rows(registry.QUERIES[name](spark, sf_dir)) == want
    arrived = spark.read.parquet(paths["arrivals"]).withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in arrived.groupBy("file").count().collect()]
    assert len(sizes) > 4 * registry.STREAM_FILES and max(sizes) < 4 * registry.ARRIVAL_ROWS
    apart = arrived.groupBy("problem_id").agg(F.countDistinct("file").alias("n")).agg(F.min("n"), F.max("n"), F.avg("n")).first()
    if name == "streaming_advantages":
        assert apart[1] == 1
    elif name != "streaming_scores":
        assert apart[0] >= 2 and apart[2] > 3.5
