"""Problems, rollouts and token scores derived from the given tables.

The tables hold no worked solutions, so these views write them from order data.
They are projections and per-row expansions: no shuffle, and as many rows as the
tables allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.operators.scoring import fan_out_samples
from veritally.operators.sequences import words
from veritally.sources.tables import read_table

BATCHES_OF = 2
PROMPT_TOKENS = 2
PPO_STEPS = (0.0, 0.5, 1.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _whole() -> Column:
    return F.floor("o_totalprice").cast("bigint")


def _cents() -> Column:
    hundredths = F.round(F.col("o_totalprice") * 100).cast("bigint") % 100
    return F.lpad(hundredths.cast("string"), 2, "0")


def problems_of(orders: DataFrame) -> DataFrame:
    """One problem per order. One in ten has no gold number, one in three has decimals."""
    key = F.col("o_orderkey")
    whole = _whole()
    grouped = F.when(
        F.col("o_totalprice") >= 1000,
        F.concat(
            F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string"),
            F.lit(","),
            F.lpad((whole % 1000).cast("string"), 3, "0"),
        ),
    ).otherwise(whole.cast("string"))
    decimals = F.when(key % 3 == 0, F.concat(F.lit("."), _cents())).otherwise(F.lit(""))
    return orders.select(
        key.alias("problem_id"),
        key.alias("row_idx"),
        F.when(key % 5 == 0, "test").otherwise("train").alias("split"),
        F.concat(
            F.lit("Order "),
            key.cast("string"),
            F.lit(" has priority "),
            F.col("o_orderpriority"),
            F.lit(". What is its total price?"),
        ).alias("question"),
        F.when(key % 10 == 9, "No final line here.")
        .otherwise(F.concat(F.lit("Add the lines up.\n#### "), grouped, decimals))
        .alias("answer"),
    )


def rollouts_of(orders: DataFrame, epochs: int = 1) -> DataFrame:
    """Four completions per problem and epoch that go through every branch of the extraction. Each epoch has
    completions of its own."""
    w = _whole().cast("string")
    branch = (F.col("o_orderkey") * 7 + F.col("sample_idx") * 3 + F.col("epoch") * 5) % 8
    completion = (
        F.when(branch == 0, F.concat(F.lit("Therefore the answer is "), w))
        .when(branch == 1, F.concat(F.lit("step 1 = 2 then #### "), w))
        .when(branch == 2, F.concat(F.lit("total = "), w, F.lit("\ndone")))
        .when(branch == 3, F.concat(F.lit("a = 5 and b = "), w))
        .when(branch == 4, F.concat(F.lit("THE ANSWER IS -"), w, F.lit(".")))
        .when(branch == 5, F.lit("I am not sure."))
        .when(branch == 6, F.concat(F.lit("the answer is $"), w))
        .otherwise(F.concat(F.lit("rate = "), w, F.lit("% so = "), w, F.lit("."), _cents()))
    )
    fanned = fan_out_samples(orders).withColumn("epoch", F.explode(F.array(*(F.lit(e) for e in range(epochs)))))
    return fanned.select(
        *(["epoch"] if epochs > 1 else []),
        F.col("o_orderkey").alias("problem_id"),
        "sample_idx",
        (F.col("o_orderkey") * 4 + F.col("sample_idx")).alias("seq_id"),
        F.floor(F.col("o_orderkey") / BATCHES_OF).cast("bigint").alias("batch_id"),
        completion.alias("completion"),
    )


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return problems_of(table(spark, sf_dir, "orders"))


def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollouts_of(table(spark, sf_dir, "orders"))


def model_completions(spark: SparkSession, sf_dir: str, sample_idx: int) -> DataFrame:
    """One completion per problem: sample 0 plays the baseline model, sample 1 the trained one."""
    return rollouts(spark, sf_dir).where(F.col("sample_idx") == sample_idx)


def rollouts_by_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollouts of two epochs, sampled anew in each."""
    return rollouts_of(table(spark, sf_dir, "orders"), epochs=2)


def rollout_tokens(spark: SparkSession, sf_dir: str, by_epoch: bool = False) -> DataFrame:
    """Words of each rollout after a two-word prompt, with a score and a score change.

    Changes run from -0.32 to 0.4, so ratios pass both clip bounds.
    """
    text = F.concat(F.lit("Answer: now "), F.col("completion"))
    epoch = ["epoch"] if by_epoch else []
    return (
        (rollouts_by_epoch if by_epoch else rollouts)(spark, sf_dir)
        .select(*epoch, "problem_id", "seq_id", F.posexplode(F.split(text, " ")).alias("pos", "word"))
        .select(
            *epoch,
            "seq_id",
            "pos",
            (F.lit(0.0) - F.length("word") / F.lit(10.0)).alias("lp"),
            (((F.col("problem_id") + F.col("pos") * 3 + F.length("word")) % 19 - 8) / F.lit(25.0)).alias(
                "delta"
            ),
        )
    )


def old_logprobs(spark: SparkSession, sf_dir: str, by_epoch: bool = False) -> DataFrame:
    return rollout_tokens(spark, sf_dir, by_epoch).drop("delta")


def new_logprobs(spark: SparkSession, sf_dir: str, by_epoch: bool = False) -> DataFrame:
    """Scores of each PPO epoch: the change grows from nothing to its full size."""
    step = F.array(*(F.lit(s) for s in PPO_STEPS))
    epoch = ["epoch"] if by_epoch else []
    return (
        rollout_tokens(spark, sf_dir, by_epoch)
        .select(*epoch, "seq_id", "pos", "lp", "delta", F.posexplode(step).alias("ppo_epoch", "step"))
        .select(
            *epoch, "ppo_epoch", "seq_id", "pos", (F.col("lp") + F.col("delta") * F.col("step")).alias("lp")
        )
    )


def _rollout_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of ``rollout_tokens`` as two arrays per rollout."""
    words_of = F.split(F.concat(F.lit("Answer: now "), F.col("completion")), " ")
    lp = F.transform("ws", lambda w: F.lit(0.0) - F.length(w) / F.lit(10.0))
    delta = F.transform(
        "ws", lambda w, i: ((F.col("problem_id") + i * 3 + F.length(w)) % 19 - 8) / F.lit(25.0)
    )
    rows = rollouts(spark, sf_dir).select("problem_id", "seq_id", words_of.alias("ws"))
    return rows.select("seq_id", lp.alias("lps"), delta.alias("deltas"))


def old_logprob_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rollout_arrays(spark, sf_dir).select("seq_id", "lps")


def new_logprob_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.array(*(F.lit(s) for s in PPO_STEPS))
    return (
        _rollout_arrays(spark, sf_dir)
        .select("seq_id", "lps", "deltas", F.posexplode(step).alias("ppo_epoch", "step"))
        .select(
            "ppo_epoch",
            "seq_id",
            F.zip_with("lps", "deltas", lambda lp, d: lp + d * F.col("step")).alias("lps"),
        )
    )


def sequence_advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in advantage and batch per rollout, for the token operators on their own."""
    return rollouts(spark, sf_dir).select(
        "seq_id", "batch_id", ((F.col("problem_id") % 5 - 2) / F.lit(2.0)).alias("advantage")
    )


def current_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores after the full change, without the PPO epoch axis."""
    return rollout_tokens(spark, sf_dir).select(
        "seq_id", "pos", (F.col("lp") + F.col("delta")).alias("lp")
    )


def epoch_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rollouts in two epochs whose batches are cut one problem apart."""
    epoch = F.explode(F.array(F.lit(0), F.lit(1)))
    return (
        rollouts(spark, sf_dir)
        .withColumn("epoch", epoch)
        .withColumn(
            "batch_id", F.floor((F.col("problem_id") + F.col("epoch")) / BATCHES_OF).cast("bigint")
        )
    )


def turn_word_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer sequences from conversation turns: the length of each word, 0 for an empty one."""
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("seq_id"),
        F.col("conv_id").alias("batch_id"),
        ids.alias("ids"),
    )


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(table(spark, sf_dir, "documents"), "doc_id", F.col("text"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("logits"), "label"
    )


def logit_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors numbered into sequences of 16 positions, the label as the token of the position."""
    return logits(spark, sf_dir).select(
        F.floor(F.col("vec_id") / 16).alias("seq_id"),
        (F.col("vec_id") % 16).cast("int").alias("pos"),
        "logits",
        F.col("label").alias("token"),
    )
