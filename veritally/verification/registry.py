"""One query per operator over the given tables; SQL twins are in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions import rewards, surrogate, text, tokens
from veritally.operators import batching, compare, metrics, policy, scoring, sequences
from veritally.operators.numbering import with_position
from veritally.operators.skew import find_hot_keys
from veritally.plans.compare import compare_models
from veritally.plans.evaluate import evaluate_split
from veritally.plans.examples import PAD_ID, example_records, prepare_examples, prompt_vocabulary
from veritally.plans.score import score_rollouts
from veritally.plans.training import (
    batched_scores,
    batched_scores_by_epoch,
    training_metrics,
    training_metrics_from_arrays,
)
from veritally.sources import problems as problem_source
from veritally.sources.bucketed import Layout, write_bucketed
from veritally.sources.sinks import accuracy_line, metric_lines, summary_lines
from veritally.streaming import scores as streaming
from veritally.verification import views
from veritally.workspace import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]

SEED = 7
SHAPE_LENGTH = 64
PROMPT_LENGTH = 16  # some prompts are longer, so that the cut happens
EPOCHS = (0, 1)
BUCKETS = 8
BUCKET_SEQUENCES = 100_000  # in a bucket of tokens, about, so that a task can sort it in memory
CHUNK = 24  # ids per chunk of a vocabulary; the last one is shorter
STREAM_FILES = 4  # that arrive one after another; each is several files if there are many rows
ARRIVAL_ROWS = 500_000  # of a file, about
SPREAD = 64  # pieces of a file's rows that are dealt apart


def r6(c: Column | str) -> Column:
    """Six decimals and no negative zero, so that sums in another order compare equal."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def _scored(spark: SparkSession, d: str, **kw) -> DataFrame:
    return score_rollouts(views.rollouts(spark, d), views.problems(spark, d), **kw)


def _paired(spark: SparkSession, d: str) -> DataFrame:
    return scoring.attach_gold(views.rollouts(spark, d), views.problems(spark, d))


def _rewarded(spark: SparkSession, d: str) -> DataFrame:
    return scoring.add_reward(_paired(spark, d))


# --- sources and sinks -----------------------------------------------------


def load_split(spark, d):
    return problem_source.load_split(views.problems(spark, d), "train")


def split_head(spark, d):
    return problem_source.split_head(views.problems(spark, d), "train", 100)


def split_count(spark, d):
    return problem_source.split_count(views.problems(spark, d))


def row_lookup(spark, d):
    wanted = views.table(spark, d, "lineitem").select("l_partkey")
    return problem_source.row_lookup(views.problems(spark, d), wanted)


def _aligned(spark, d):
    return compare.align_models(
        views.problems(spark, d),
        views.model_completions(spark, d, 0),
        views.model_completions(spark, d, 1),
    )


def _report(spark, d, n):
    return compare_models(
        views.problems(spark, d),
        views.model_completions(spark, d, 0),
        views.model_completions(spark, d, 1),
        n=n,
    )


def report_fixed_width(spark, d):
    return compare.fixed_width_lines(_report(spark, d, None))


def report_markdown(spark, d):
    return compare.markdown_lines(_report(spark, d, None))


def _batched_scores(spark, d):
    train = problem_source.load_split(views.problems(spark, d), "train")
    return batched_scores(views.rollouts(spark, d), train, SEED, carry=["seq_id"])


def _training(spark, d):
    return training_metrics(
        _batched_scores(spark, d),
        views.old_logprobs(spark, d),
        views.new_logprobs(spark, d),
        F.lit(views.PROMPT_TOKENS),
    )


def _training_by_epoch(spark, d):
    train = problem_source.load_split(views.problems(spark, d), "train")
    return training_metrics(
        batched_scores_by_epoch(views.rollouts_by_epoch(spark, d), train, SEED, EPOCHS, carry=["seq_id"]),
        views.old_logprobs(spark, d, by_epoch=True),
        views.new_logprobs(spark, d, by_epoch=True),
        F.lit(views.PROMPT_TOKENS),
        sequence=["epoch", "seq_id"],
    )


def epoch_metrics(spark, d):
    summary = metrics.epoch_mean_of_means(_training_by_epoch(spark, d))
    return summary.select("epoch", "num_batches", r6("avg_loss").alias("avg_loss"), r6("avg_reward").alias("avg_reward"))


def metrics_log(spark, d):
    """The metrics log as text lines."""
    return metric_lines(_rounded_metrics(_training_by_epoch(spark, d)))


def epoch_summary_lines(spark, d):
    """Epoch summary as text."""
    return summary_lines(epoch_metrics(spark, d))


def accuracy_text(spark, d):
    return accuracy_line(evaluate_split(views.model_completions(spark, d, 0), views.problems(spark, d)))


# --- projections and extraction -------------------------------------------


def build_prompt(spark, d):
    return views.problems(spark, d).select("problem_id", text.build_prompt(F.col("question")).alias("prompt"))


def example_record(spark, d):
    problems = views.problems(spark, d)
    return example_records(problems, prompt_vocabulary(problems), PROMPT_LENGTH)


def truncate_text(spark, d):
    return views.table(spark, d, "documents").select("doc_id", text.truncate_text(F.col("text")).alias("short"))


def verdict_label(spark, d):
    match = rewards.tolerance_match(F.col("pred"), F.col("gt"))
    return _paired(spark, d).select("problem_id", "sample_idx", text.verdict_label(match).alias("verdict"))


def extract_gold(spark, d):
    return views.problems(spark, d).select("problem_id", text.extract_gold(F.col("answer")).alias("gt"))


def extract_prediction(spark, d):
    return views.rollouts(spark, d).select(
        "problem_id", "sample_idx", text.extract_prediction(F.col("completion")).alias("pred")
    )


def extract_prediction_unicode(spark, d):
    """Completions written with digits and spaces of another script."""
    other = F.translate("completion", "0123456789 ", "٠١٢٣٤٥٦٧٨٩\u3000")
    # The words of the patterns have a space of their own.
    other = F.regexp_replace(other, "(?i)(answer)\u3000(is)", "$1 $2")
    return views.rollouts(spark, d).select(
        "problem_id", "sample_idx", text.extract_prediction(other, unicode=True).alias("pred")
    )


def normalize_number(spark, d):
    captured = F.regexp_extract("answer", V.GOLD_PATTERN, 1)
    return views.problems(spark, d).select(
        "problem_id", captured.alias("captured"), text.normalize_number(captured).alias("number")
    )


def pattern_coverage(spark, d):
    return (
        views.rollouts(spark, d)
        .select("sample_idx", text.matched_pattern(F.col("completion")).alias("pattern"))
        .groupBy("sample_idx", "pattern")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- predicates, rewards, joins -------------------------------------------


def tolerance_match(spark, d):
    match = rewards.tolerance_match(F.col("pred"), F.col("gt"))
    return _paired(spark, d).select("problem_id", "sample_idx", match.alias("is_match"))


def binary_reward(spark, d):
    return _rewarded(spark, d).select("problem_id", "sample_idx", "reward")


def custom_reward(spark, d):
    def within_one_percent(pred: Column, gold: Column) -> Column:
        return F.when(F.abs(pred - gold) <= F.abs(gold) * 0.01, F.lit(1.0)).otherwise(F.lit(0.0))

    scored = scoring.add_reward(_paired(spark, d), within_one_percent)
    return scored.select("problem_id", "sample_idx", "reward")


def group_size_violations(spark, d):
    return scoring.group_size_violations(views.table(spark, d, "lineitem"), V.GROUP_SIZE, "l_orderkey")


def null_gold_quarantine(spark, d):
    return scoring.null_golds(views.problems(spark, d))


def attach_gold(spark, d):
    return _paired(spark, d)


def fan_out_samples(spark, d):
    return scoring.fan_out_samples(views.problems(spark, d)).select("problem_id", "sample_idx", "question")


def align_models(spark, d):
    return _aligned(spark, d)


def _tokens(spark, d):
    return policy.align_logprobs(views.old_logprobs(spark, d), views.current_logprobs(spark, d))


def _token_losses(spark, d):
    weighted = policy.broadcast_advantage(views.old_logprobs(spark, d), views.sequence_advantages(spark, d))
    return policy.align_logprobs(weighted, views.current_logprobs(spark, d))


def align_logprobs(spark, d):
    return _tokens(spark, d).select("seq_id", "pos", r6("old_lp").alias("old_lp"), r6("new_lp").alias("new_lp"))


def broadcast_advantage(spark, d):
    return policy.broadcast_advantage(
        views.old_logprobs(spark, d).select("seq_id", "pos"), views.sequence_advantages(spark, d)
    )


def broadcast_advantage_long(spark, d):
    """As with sequences too long for one task."""
    rows = views.old_logprobs(spark, d).select("seq_id", "pos")
    hot = policy.long_sequences(rows, rows_per_task=3)
    assert hot, "no sequence has more than three tokens"
    return policy.broadcast_advantage(rows, views.sequence_advantages(spark, d), hot)


def sequence_logprobs(spark, d):
    found = policy.sequence_logprobs(views.logit_sequences(spark, d))
    return found.select("seq_id", "pos", r6("lp").alias("lp"))


def sequence_logprobs_chunked(spark, d):
    """Vectors cut into chunks of the vocabulary and stored in buckets of the sequence, labels joined in these."""
    layout = Layout(["seq_id"], BUCKETS, ["pos"])
    vectors = views.logit_sequences(spark, d)
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.size("logits") - 1) / F.lit(CHUNK)).cast("int"))).alias("chunk")
    cut = F.slice("logits", F.col("chunk") * F.lit(CHUNK) + 1, F.lit(CHUNK)).alias("logits")
    chunks = vectors.select("seq_id", "pos", "logits", chunk).select("seq_id", "pos", "chunk", cut)
    stored = write_bucketed(chunks, fresh_path(spark, "logit-chunks"), layout)
    labels = policy.following_labels(vectors.select("seq_id", "pos", "token"))
    found = policy.chunked_logprobs(stored, labels, CHUNK, small=False)
    return found.select("seq_id", "pos", r6("lp").alias("lp"))


# --- aggregates and windows -----------------------------------------------


def group_mean_reward(spark, d):
    return scoring.group_mean_reward(_rewarded(spark, d))


def masked_mean(spark, d):
    mask = tokens.in_loss(F.col("pos"), F.lit(views.PROMPT_TOKENS))
    return (
        views.old_logprobs(spark, d)
        .groupBy((F.col("seq_id") % 16).alias("batch_id"))
        .agg(r6(policy.masked_mean(F.col("lp"), mask)).alias("masked_mean"))
    )


def accuracy(spark, d):
    paired = scoring.attach_gold(views.rollouts(spark, d), views.problems(spark, d), problem_columns=["split"])
    by = ["split", "sample_idx"]
    found = metrics.accuracy(scoring.add_reward(paired), by)
    return found.select(*by, "correct", "total", r6("accuracy").alias("accuracy"))


def _batch_rewards(spark, d):
    paired = scoring.attach_gold(
        views.epoch_rollouts(spark, d), views.problems(spark, d), ["epoch", "batch_id"]
    )
    return metrics.batch_mean_reward(scoring.add_reward(paired))


def batch_mean_reward(spark, d):
    return _batch_rewards(spark, d)


def epoch_mean_of_means(spark, d):
    means = metrics.epoch_mean_of_means(_batch_rewards(spark, d), ["reward"])
    return means.select("epoch", "num_batches", r6("avg_reward").alias("avg_reward"))


def running_reward(spark, d):
    found = metrics.running_reward(_batch_rewards(spark, d))
    return found.select("epoch", "batch_id", "reward", r6("avg_reward").alias("avg_reward"))


def _losses(spark, d):
    weighted = policy.broadcast_advantage(views.old_logprobs(spark, d), views.sequence_advantages(spark, d))
    return policy.policy_loss(
        policy.align_logprobs(weighted, views.new_logprobs(spark, d)),
        ["batch_id", "ppo_epoch"],
        tokens.in_loss(F.col("pos"), F.lit(views.PROMPT_TOKENS)),
    )


def policy_loss(spark, d):
    return _losses(spark, d).select("batch_id", "ppo_epoch", r6("loss").alias("loss"))


def policy_loss_from_arrays(spark, d):
    aligned = policy.align_arrays(
        views.old_logprob_arrays(spark, d),
        views.new_logprob_arrays(spark, d),
        views.sequence_advantages(spark, d),
    )
    mask = tokens.in_loss(F.col("pos"), F.lit(views.PROMPT_TOKENS))
    found = policy.policy_loss(aligned, ["batch_id", "ppo_epoch"], mask)
    return found.select("batch_id", "ppo_epoch", r6("loss").alias("loss"))


def last_ppo_epoch_loss(spark, d):
    return policy.last_ppo_epoch_loss(_losses(spark, d)).select("batch_id", r6("loss").alias("loss"))


def model_tally(spark, d):
    return compare.model_tally(_aligned(spark, d))


def model_totals(spark, d):
    return compare.model_totals(_aligned(spark, d))


def group_advantage(spark, d):
    hot = find_hot_keys(views.rollouts(spark, d), "problem_id")
    scored = scoring.group_advantage(_rewarded(spark, d), V.GROUP_SIZE, hot)
    return scored.select("problem_id", "sample_idx", "reward", "advantage")


def assign_batches(spark, d):
    test = problem_source.load_split(views.problems(spark, d), "test")
    return batching.assign_batches(test, V.EVAL_BATCH_SIZE).select("problem_id", "row_idx", "batch_id")


def positional_regroup(spark, d):
    stored = views.rollouts(spark, d).select(F.col("seq_id").alias("pos"))
    grouped = batching.regroup(stored.withColumn("stored", F.col("pos")), V.GROUP_SIZE)
    return batching.flatten_groups(grouped.withColumn("grp", F.col("group_id")).withColumn("at", F.col("place")), V.GROUP_SIZE).select(
        "stored", F.col("grp").alias("group_id"), F.col("at").alias("place"), "pos"
    )


def seeded_shuffle(spark, d):
    ids = views.problems(spark, d).select("problem_id")
    return batching.seeded_shuffle(ids, "problem_id", SEED, epoch=1)


def permuted_batches(spark, d):
    """Batches in a random order by arithmetic on stored positions: no sort, no shuffle."""
    problems = with_position(views.problems(spark, d).select("problem_id", "row_idx"), "row_idx")
    return batching.permuted_batches(problems, "pos", problems.count(), V.EVAL_BATCH_SIZE, SEED).select(
        "problem_id", "shuffle_pos", "batch_id"
    )


def ordered_eval(spark, d):
    test = problem_source.load_split(views.problems(spark, d), "test")
    return batching.ordered_eval(test).select("row_idx", "question")


# --- token sequences -------------------------------------------------------


SHORT_HEAD = 50


def _encoded(spark, d, **options):
    vocabulary = materialize(sequences.build_vocabulary(views.document_words(spark, d)))
    documents = views.table(spark, d, "documents")
    return sequences.encode_rows(documents, "doc_id", F.col("text"), vocabulary, **options), vocabulary


def vocab_encode(spark, d):
    return _encoded(spark, d)[0]


def vocab_encode_rows_short_head(spark, d):
    """With a head of 50 words, so that most rows have words past it."""
    return _encoded(spark, d, head_words=SHORT_HEAD)[0]


def vocab_encode_short_head(spark, d):
    """Words as rows, with a head of 50 words, so that most take the shuffle join of the tail."""
    found = views.document_words(spark, d)
    vocabulary = materialize(sequences.build_vocabulary(found))
    return sequences.encode_words(found, vocabulary, "doc_id", head_words=SHORT_HEAD)


def vocabulary(spark, d):
    return sequences.build_vocabulary(views.document_words(spark, d))


def _decoded(spark, d, **options):
    encoded, vocabulary = _encoded(spark, d)
    padded = encoded.withColumn("ids", tokens.pad_left(F.col("ids"), PAD_ID, SHAPE_LENGTH))
    return sequences.decode_rows(padded, vocabulary, "doc_id", [PAD_ID], **options)


def vocab_decode(spark, d):
    return _decoded(spark, d)


def vocab_decode_short_head(spark, d):
    return _decoded(spark, d, head_words=SHORT_HEAD)


def _turns(spark, d):
    return views.turn_word_lengths(spark, d)


def truncate_tokens(spark, d):
    return _turns(spark, d).select("seq_id", tokens.truncate_tokens(F.col("ids"), SHAPE_LENGTH).alias("ids"))


def pad_left(spark, d):
    return _turns(spark, d).select(
        "seq_id", tokens.pad_left(tokens.truncate_tokens(F.col("ids")), PAD_ID).alias("ids")
    )


def attention_mask(spark, d):
    return _turns(spark, d).select(
        "seq_id", tokens.attention_mask(tokens.truncate_tokens(F.col("ids"))).alias("mask")
    )


def mask_from_ids(spark, d):
    return _turns(spark, d).select("seq_id", tokens.mask_from_ids(F.col("ids"), PAD_ID).alias("mask"))


def pad_to_batch_max(spark, d):
    rows = _turns(spark, d).select(
        "seq_id",
        "batch_id",
        F.col("ids").alias("input_ids"),
        tokens.attention_mask(F.col("ids"), 0).alias("attention_mask"),
    )
    return sequences.pad_to_batch_max(rows, PAD_ID, ["seq_id"])


def _prompt_length() -> Column:
    return (F.col("seq_id") % 7).cast("int")


def completion_slice(spark, d):
    return _turns(spark, d).select(
        "seq_id", tokens.completion_slice(F.col("ids"), _prompt_length()).alias("ids")
    )


def log_softmax(spark, d):
    rounded = F.transform(tokens.log_softmax(F.col("logits")), lambda x: F.round(x, 6))
    return views.logits(spark, d).select("vec_id", rounded.alias("logprobs"))


def gather_logprob(spark, d):
    return views.logits(spark, d).select(
        "vec_id", r6(tokens.label_logprob(F.col("logits"), F.col("label"))).alias("logprob")
    )


def shift_labels(spark, d):
    scored = F.transform("ids", lambda x: x / F.lit(-8.0) - 1.0)
    shifted = tokens.shift_labels(scored, F.col("ids"))
    return _turns(spark, d).select(
        "seq_id", shifted["score"].alias("score"), shifted["label"].alias("label")
    )


def loss_mask(spark, d):
    length = F.size("ids") - 1
    return _turns(spark, d).select("seq_id", tokens.loss_mask(length, _prompt_length()).alias("mask"))


# --- surrogate arithmetic --------------------------------------------------


def _ratio() -> Column:
    return surrogate.importance_ratio(F.col("new_lp"), F.col("old_lp"))


def importance_ratio(spark, d):
    return _tokens(spark, d).select("seq_id", "pos", r6(_ratio()).alias("ratio"))


def clip_ratio(spark, d):
    return _tokens(spark, d).select("seq_id", "pos", r6(surrogate.clip_ratio(_ratio())).alias("clipped"))


def clipped_surrogate(spark, d):
    loss = surrogate.clipped_surrogate(_ratio(), F.col("advantage"))
    return _token_losses(spark, d).select("seq_id", "pos", r6(loss).alias("loss"))


# --- streams ---------------------------------------------------------------


def arrival_files(rows: int) -> int:
    """How many files arrive together."""
    return max(1, ceil(rows / (STREAM_FILES * ARRIVAL_ROWS)))


def _rollout_stream(spark, d, *by: str) -> DataFrame:
    """Rollouts as a table of files, read as a stream of ``STREAM_FILES`` micro-batches. ``by`` names the columns by which rows
    are dealt to files; with many rows a micro-batch has several files, and rows are dealt by pieces of the problems as well."""
    path = fresh_path(spark, "arrivals")
    rows = views.rollouts(spark, d)
    each = arrival_files(views.problems(spark, d).count() * V.GROUP_SIZE)
    piece = F.pmod(F.xxhash64("problem_id"), F.lit(SPREAD * each))
    dealt = [*by, piece] if by and each > 1 and "problem_id" not in by else by
    rows.repartition(STREAM_FILES * each, *dealt).write.parquet(path)
    return streaming.read_rollout_stream(spark, path, rows.schema, files_per_trigger=each)


def streaming_scores(spark, d):
    out = fresh_path(spark, "streaming-scores")
    found = streaming.batch_metrics_stream(_rollout_stream(spark, d), views.problems(spark, d))
    streaming.start_batch_metrics(found, out, fresh_path(spark, "streaming-state")).awaitTermination()
    return streaming.latest_batch_metrics(spark, out)


def streaming_advantages(spark, d):
    out = fresh_path(spark, "streaming-advantages")
    streaming.start_advantages(
        _rollout_stream(spark, d, "problem_id"),
        views.problems(spark, d),
        out,
        fresh_path(spark, "streaming-state"),
        V.GROUP_SIZE,
    ).awaitTermination()
    return spark.read.parquet(out).select("problem_id", "sample_idx", "reward", "advantage")


def streaming_advantages_split_groups(spark, d):
    """Every problem's samples are spread over the files; advantages come from the late pass."""
    out = fresh_path(spark, "streaming-split")
    streaming.start_scores(
        _rollout_stream(spark, d, "sample_idx"), views.problems(spark, d), out, fresh_path(spark, "streaming-state")
    ).awaitTermination()
    found = streaming.late_advantages(spark, out, group_size=V.GROUP_SIZE)
    return found.select("problem_id", "sample_idx", "reward", "advantage")


def streaming_group_advantages(spark, d):
    """The same arrivals; each group leaves the stream when its last sample is there."""
    out = fresh_path(spark, "streaming-groups")
    streaming.start_group_advantages(
        _rollout_stream(spark, d, "sample_idx"),
        views.problems(spark, d),
        out,
        fresh_path(spark, "streaming-state"),
        V.GROUP_SIZE,
        carry=["batch_id"],
    ).awaitTermination()
    return streaming.group_advantages(spark, out).select("problem_id", "sample_idx", "batch_id", "reward", "advantage")


# --- pipelines -------------------------------------------------------------


def scored_rollouts(spark, d):
    return _scored(spark, d)


def scored_rollouts_bucketed(spark, d):
    """Both tables stored in buckets of the problem: neither the join nor the group mean moves a row."""
    layout = Layout(["problem_id"], BUCKETS)
    rollouts = write_bucketed(views.rollouts(spark, d), fresh_path(spark, "bucketed-rollouts"), layout)
    problems = write_bucketed(views.problems(spark, d), fresh_path(spark, "bucketed-problems"), layout)
    return score_rollouts(rollouts, problems, small=False)


def scored_rollouts_epochs(spark, d):
    return score_rollouts(
        views.rollouts_by_epoch(spark, d),
        views.problems(spark, d),
        group_size=V.GROUP_SIZE,
        carry=["epoch"],
        group=["epoch", "problem_id"],
    )


def scored_rollouts_shuffled(spark, d):
    """As for a problem table too large to broadcast."""
    return _scored(spark, d, small=False)


def _hot_problems(spark, d) -> DataFrame:
    """Every problem taken for a hot one."""
    hot = find_hot_keys(views.rollouts(spark, d), "problem_id", rows_per_task=2)
    assert hot, "no problem has more than two rows"
    return hot


def scored_rollouts_hot(spark, d):
    """As with hot problems and a problem table too large to broadcast."""
    return _scored(spark, d, small=False, hot=_hot_problems(spark, d))


def scored_rollouts_float_gold(spark, d):
    return _scored(spark, d, gold_precision="float")


def evaluated_split(spark, d):
    found = evaluate_split(views.rollouts(spark, d), views.problems(spark, d), by=["sample_idx"])
    return found.withColumn("accuracy", r6("accuracy"))


def evaluated_split_float_gold(spark, d):
    found = evaluate_split(
        views.rollouts(spark, d), views.problems(spark, d), by=["sample_idx"], gold_precision="float"
    )
    return found.withColumn("accuracy", r6("accuracy"))


def evaluated_split_known_golds(spark, d):
    found = evaluate_split(views.rollouts(spark, d), views.problems(spark, d), "train", by=["sample_idx"], skip_null_golds=True)
    return found.withColumn("accuracy", r6("accuracy"))


def compared_models(spark, d):
    return _report(spark, d, V.REPORT_ROWS)


def compared_models_whole_split(spark, d):
    return _report(spark, d, None)


def _rounded_metrics(found):
    return found.withColumns({c: r6(c) for c in ("loss", "reward", "avg_reward")})


def training(spark, d):
    return _rounded_metrics(_training(spark, d))


def training_bucketed(spark, d):
    """Token scores stored in buckets of the sequence: no token is moved."""
    buckets = max(BUCKETS, ceil(views.problems(spark, d).count() * V.GROUP_SIZE / BUCKET_SEQUENCES))
    layout = Layout(["seq_id"], buckets, ["pos"])
    by_epoch = Layout(["seq_id"], buckets, ["pos"], ["ppo_epoch"])
    old = write_bucketed(views.old_logprobs(spark, d), fresh_path(spark, "bucketed-old"), layout)
    new = write_bucketed(views.new_logprobs(spark, d), fresh_path(spark, "bucketed-new"), by_epoch)
    return _rounded_metrics(training_metrics(_batched_scores(spark, d), old, new, F.lit(views.PROMPT_TOKENS)))


def training_from_arrays(spark, d):
    found = training_metrics_from_arrays(
        _batched_scores(spark, d),
        views.old_logprob_arrays(spark, d),
        views.new_logprob_arrays(spark, d),
        F.lit(views.PROMPT_TOKENS),
    )
    return _rounded_metrics(found)


def training_epochs(spark, d):
    return _rounded_metrics(_training_by_epoch(spark, d))


def prepared_examples(spark, d):
    return prepare_examples(views.problems(spark, d), max_length=PROMPT_LENGTH)


QUERIES: dict[str, Query] = {
    "load_split": load_split,
    "split_head": split_head,
    "split_count": split_count,
    "row_lookup": row_lookup,
    "report_fixed_width": report_fixed_width,
    "report_markdown": report_markdown,
    "epoch_metrics": epoch_metrics,
    "metrics_log": metrics_log,
    "epoch_summary_lines": epoch_summary_lines,
    "accuracy_line": accuracy_text,
    "build_prompt": build_prompt,
    "example_record": example_record,
    "truncate_text": truncate_text,
    "verdict_label": verdict_label,
    "extract_gold": extract_gold,
    "extract_prediction": extract_prediction,
    "extract_prediction_unicode": extract_prediction_unicode,
    "normalize_number": normalize_number,
    "pattern_coverage": pattern_coverage,
    "tolerance_match": tolerance_match,
    "binary_reward": binary_reward,
    "custom_reward": custom_reward,
    "group_size_violations": group_size_violations,
    "null_gold_quarantine": null_gold_quarantine,
    "attach_gold": attach_gold,
    "fan_out_samples": fan_out_samples,
    "align_models": align_models,
    "align_logprobs": align_logprobs,
    "broadcast_advantage": broadcast_advantage,
    "broadcast_advantage_long": broadcast_advantage_long,
    "sequence_logprobs": sequence_logprobs,
    "sequence_logprobs_chunked": sequence_logprobs_chunked,
    "group_mean_reward": group_mean_reward,
    "masked_mean": masked_mean,
    "accuracy": accuracy,
    "batch_mean_reward": batch_mean_reward,
    "epoch_mean_of_means": epoch_mean_of_means,
    "last_ppo_epoch_loss": last_ppo_epoch_loss,
    "model_tally": model_tally,
    "model_totals": model_totals,
    "group_advantage": group_advantage,
    "running_reward": running_reward,
    "assign_batches": assign_batches,
    "positional_regroup": positional_regroup,
    "seeded_shuffle": seeded_shuffle,
    "permuted_batches": permuted_batches,
    "ordered_eval": ordered_eval,
    "vocabulary": vocabulary,
    "vocab_encode": vocab_encode,
    "vocab_encode_short_head": vocab_encode_short_head,
    "vocab_decode": vocab_decode,
    "vocab_encode_rows_short_head": vocab_encode_rows_short_head,
    "vocab_decode_short_head": vocab_decode_short_head,
    "truncate_tokens": truncate_tokens,
    "pad_left": pad_left,
    "attention_mask": attention_mask,
    "mask_from_ids": mask_from_ids,
    "pad_to_batch_max": pad_to_batch_max,
    "completion_slice": completion_slice,
    "log_softmax": log_softmax,
    "shift_labels": shift_labels,
    "gather_logprob": gather_logprob,
    "loss_mask": loss_mask,
    "importance_ratio": importance_ratio,
    "clip_ratio": clip_ratio,
    "clipped_surrogate": clipped_surrogate,
    "policy_loss": policy_loss,
    "policy_loss_from_arrays": policy_loss_from_arrays,
    "streaming_scores": streaming_scores,
    "streaming_advantages": streaming_advantages,
    "streaming_advantages_split_groups": streaming_advantages_split_groups,
    "streaming_group_advantages": streaming_group_advantages,
    "score_rollouts": scored_rollouts,
    "score_rollouts_float_gold": scored_rollouts_float_gold,
    "score_rollouts_epochs": scored_rollouts_epochs,
    "score_rollouts_shuffled": scored_rollouts_shuffled,
    "score_rollouts_hot": scored_rollouts_hot,
    "score_rollouts_bucketed": scored_rollouts_bucketed,
    "evaluate_split": evaluated_split,
    "evaluate_split_float_gold": evaluated_split_float_gold,
    "evaluate_split_known_golds": evaluated_split_known_golds,
    "compare_models": compared_models,
    "compare_models_whole_split": compared_models_whole_split,
    "training_metrics": training,
    "training_metrics_bucketed": training_bucketed,
    "training_metrics_from_arrays": training_from_arrays,
    "training_metrics_epochs": training_epochs,
    "prepare_examples": prepared_examples,
}
