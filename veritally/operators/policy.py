"""Token-level joins and the masked surrogate loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally import fixed_values as V
from veritally.functions.surrogate import clipped_surrogate, importance_ratio
from veritally.functions.tokens import gather_label, label_logprob
from veritally.operators.runs import can_pack, deal_runs, pack_runs, parts_by, unpack_runs
from veritally.operators.skew import NO_HOT, ROWS_PER_TASK, SALTS, Hot, Keys, fits_broadcast, is_hot, join_unique, names, tasks_for
from veritally.session import ALL_KEYS
from veritally.workspace import materialize

EXACT = "decimal(38,18)"
EXACT_BELOW = 1e9  # sums of up to 10^11 such values fit
TOKENS_PER_TASK = 300_000  # of the old scores, about; new ones come once per PPO epoch, and both are sorted
SAMPLE_TOKENS = 4_000


def align_logprobs(old: DataFrame, new: DataFrame, sequence: Keys = "seq_id", strict: bool = False) -> DataFrame:
    """Pair old and new scores token by token.

    ``old`` and ``new`` have the sequence's columns, pos and lp, and may have further columns, such as
    the advantage or the PPO epoch. Both sides have every token, so neither is ever worth a broadcast: the
    sort-merge hint keeps a low size estimate from choosing one. On tables that arrive partitioned by
    sequence the join stays so: the session's ``spark.sql.requireAllClusterKeysForCoPartition`` is turned off for that.
    New scores are then brought there in runs of a sequence's tokens (``operators.runs``), unless they are there already.
    Otherwise both key columns are hashed, which spreads even one very long sequence.

    With ``strict`` a token that only one side has ends the query with an error instead of being left out.
    """
    old.sparkSession.conf.set(ALL_KEYS, "false")
    keys = [*names(sequence), "pos"]
    parts = parts_by(old, sequence)
    if parts and parts_by(new, sequence) is None:
        new = deal_runs(new, sequence, parts)
    left, right = old.withColumnRenamed("lp", "old_lp").hint("merge"), new.withColumnRenamed("lp", "new_lp")
    if not strict:
        return left.join(right, keys)
    both = left.withColumn("_old", F.lit(True)).join(right.withColumn("_new", F.lit(True)), keys, "full")
    lonely = F.col("_old").isNull() | F.col("_new").isNull()
    message = F.concat(F.lit("token without partner: "), F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)))
    checked = F.when(lonely, F.raise_error(message)).otherwise(F.col("old_lp"))
    return both.withColumn("old_lp", checked).drop("_old", "_new")


def long_sequences(tokens: DataFrame, rows_per_task: int = ROWS_PER_TASK, sequence: Keys = "seq_id") -> Hot:
    """Sequences with too many tokens for one task, as a stored table of keys and salts.

    Positions count up from 0, so a long sequence shows by its positions: on a
    stored table the filter reaches the scan and file statistics rule out nearly
    everything.
    """
    salts = (F.floor(F.max("pos") / rows_per_task) + 1).cast("int").alias(SALTS)
    longest = tokens.where(F.col("pos") >= rows_per_task).groupBy(*names(sequence)).agg(salts)
    hot = materialize(longest, "long-sequences")
    return NO_HOT if hot.isEmpty() else hot


def token_tasks(tokens: DataFrame, sequences: DataFrame, sequence: Keys = "seq_id") -> int:
    """How many tasks share ``tokens``, so that one can sort its share in memory: the number of ``sequences`` times the mean length
    among the first tokens. It decides about the plan only."""
    first = tokens.select(*names(sequence)).take(SAMPLE_TOKENS)
    length = max(1.0, len(first) / max(1, len(set(first))))
    return tasks_for(sequences, max(1, int(TOKENS_PER_TASK / length)))


def broadcast_advantage(
    tokens: DataFrame, advantages: DataFrame, hot: Hot | None = None, sequence: Keys = "seq_id", parts: int | None = None
) -> DataFrame:
    """Give each token the columns of its sequence. There are as many sequences as
    rollouts, so they are never broadcast.

    Tokens of a sequence that lie together are shuffled and joined as one row (``operators.runs``) and are rows again behind
    the join; ``parts`` is the number of tasks that share them, by default that of ``token_tasks``. Tables that arrive partitioned by
    sequence stay where they are, and tokens of long sequences are spread one by one.
    """
    hot = long_sequences(tokens, sequence=sequence) if hot is None else hot
    if is_hot(hot) or not can_pack(tokens, sequence) or parts_by(tokens, sequence):
        return join_unique(tokens, advantages, sequence, ["pos"], hot=hot, small=False)
    keys = names(sequence)
    parts = token_tasks(tokens, advantages, sequence) if parts is None else parts
    rest = [c for c in tokens.columns if c not in keys]
    more = [c for c in advantages.columns if c not in keys]
    joined = join_unique(pack_runs(tokens, keys), advantages, keys, ["pos"], hot=hot, small=False, parts=parts)
    return unpack_runs(joined, rest).select(*keys, *rest, *more)


def align_arrays(
    old: DataFrame, new: DataFrame, sequences: DataFrame, sequence: Keys = "seq_id", start: Column | None = None
) -> DataFrame:
    """The same pairing for scores stored as one array per sequence.

    ``old`` is (*sequence, lps), ``new`` is (*sequence, lps, ...) and ``sequences`` has one
    row per sequence. Rows meet whole, so each table is shuffled once by sequence, and
    tokens become rows (pos, old_lp, new_lp) only where they are summed up. ``start`` is the first position
    that is wanted: what lies before it is cut off before the shuffle. Arrays of unequal length end the query with an error.
    """
    keys = names(sequence)
    left, right = old.withColumnRenamed("lps", "_old"), new.withColumnRenamed("lps", "_new")
    sizes, place = (F.size("_old"), F.size("_new")), F.col("_place")
    if start is not None:
        first = F.greatest(F.lit(0), start).cast("int")
        rest = lambda c: F.slice(c, first + F.lit(1), F.greatest(F.size(c) - first, F.lit(0)))
        left = left.withColumns({"_old_size": F.size("_old"), "_first": first, "_old": rest("_old")})
        right = right.withColumns({"_new_size": F.size("_new"), "_new": rest("_new")})
        sizes, place = (F.col("_old_size"), F.col("_new_size")), F.col("_first") + F.col("_place")
    rows = left.hint("merge").join(sequences, keys).hint("merge").join(right, keys)
    message = F.format_string("%s: %d old and %d new scores", F.concat_ws(", ", *(F.col(k).cast("string") for k in keys)), *sizes)
    even = F.when(sizes[0] == sizes[1], F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    kept = [c for c in rows.columns if c not in ("_old", "_new", "_old_size", "_new_size", "_first")]
    grid = F.arrays_zip(F.col("_old").alias("old_lp"), F.col("_new").alias("new_lp"))
    tokens = rows.where(even).select(*kept, *(["_first"] if start is not None else []), F.posexplode(grid).alias("_place", "_token"))
    return tokens.select(*kept, place.alias("pos"), "_token.old_lp", "_token.new_lp")


def exact_sum(x: Column) -> Column:
    """A sum that does not depend on the order or the partitions of the rows: values are rounded to ``EXACT`` and added as
    decimals. NaN and infinities come out as in a plain sum; so do values from ``EXACT_BELOW`` on, which are added apart."""
    small = F.abs(x) < F.lit(EXACT_BELOW)
    fixed = F.sum(F.when(small, x).cast(EXACT)).cast("double")
    rest = F.sum(F.when(~small, x))
    return F.when(rest.isNull(), fixed).otherwise(F.coalesce(fixed, F.lit(0.0)) + rest)


def masked_mean(value: Column, mask: Column, exact: bool = False) -> Column:
    """``sum(value * mask) / sum(mask)``; NULL for an empty mask. With ``exact`` the bits of the result are the same on any
    number of partitions."""
    add = exact_sum if exact else F.sum
    return F.try_divide(add(value * mask), add(mask))


def policy_loss(
    tokens: DataFrame,
    by: Sequence[str],
    mask: Column,
    clip_eps: float = V.CLIP_EPS,
    exact: bool = False,
) -> DataFrame:
    """Token-weighted loss per ``by`` group from (old_lp, new_lp, advantage); ``exact`` as in ``masked_mean``."""
    ratio = importance_ratio(F.col("new_lp"), F.col("old_lp"))
    loss = clipped_surrogate(ratio, F.col("advantage"), clip_eps)
    return tokens.groupBy(*by).agg(masked_mean(loss, mask, exact).alias("loss"))


def last_ppo_epoch_loss(losses: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """The loss of the last PPO epoch of each batch: the one that is logged."""
    return losses.groupBy(*by).agg(F.max_by("loss", "ppo_epoch").alias("loss"))


def following_labels(tokens: DataFrame, sequence: Keys = "seq_id") -> DataFrame:
    """(*sequence, pos, label): the token after each position of (*sequence, pos, token)."""
    return tokens.select(*names(sequence), (F.col("pos") - 1).alias("pos"), F.col("token").alias("label"))


def sequence_logprobs(logits: DataFrame, sequence: Keys = "seq_id") -> DataFrame:
    """(*sequence, pos, lp): the log-probability that the scores at each position give to the next token.

    ``logits`` has (*sequence, pos, logits, token) with one row per position; the token of a position is scored by the row
    before it, so the last row of a sequence scores nothing. Only ids are read of the following row, and no full vector is
    kept past the gather. Store the table in buckets of the sequence (``sources.bucketed``): then no vector is moved either.
    For vocabularies too long for a row see ``chunked_logprobs``.
    """
    keys = [*names(sequence), "pos"]
    joined = logits.select(*keys, "logits").hint("merge").join(following_labels(logits, sequence), keys)
    return joined.select(*keys, label_logprob(F.col("logits"), F.col("label")).alias("lp"))


def chunked_logprobs(
    chunks: DataFrame, labels: DataFrame, chunk_size: int, sequence: Keys = "seq_id", small: bool | None = None
) -> DataFrame:
    """(*sequence, pos, lp) from scores that are split over the vocabulary.

    ``chunks`` is (*sequence, pos, chunk, logits): chunk ``c`` of a position has the scores of the ids from
    ``c * chunk_size`` on. ``labels`` is (*sequence, pos, label); a position without a label scores nothing, a label that no chunk
    has gives NULL.

    Where it is read, a chunk becomes three numbers: its maximum, its sum of exponentials scaled by that, and the label's score if the
    chunk has it. Those of a position are merged by scaling to the common maximum; there are as many as chunks, and no
    vector is among them. Labels meet the chunks by a broadcast if they are few (``small``; None has it checked), else in
    buckets of the sequence, in which ``chunks`` is then to be stored: otherwise the join has to move it.
    """
    keys = [*names(sequence), "pos"]
    wanted = labels.select(*keys, F.col("label").alias("_label"))
    small = fits_broadcast(wanted) if small is None else small
    read = chunks.select(*keys, "chunk", "logits")
    joined = read.join(F.broadcast(wanted), keys) if small else read.hint("merge").join(wanted, keys)
    mine = F.floor(F.col("_label") / F.lit(chunk_size)) == F.col("chunk")
    at = (F.col("_label") - F.col("chunk") * F.lit(chunk_size)).cast("int")
    top = F.array_max("logits").cast("double")
    parts = joined.select(*keys, top.alias("_top"), "logits", F.when(mine, gather_label(F.col("logits"), at)).cast("double").alias("_score"))
    scaled = F.aggregate("logits", F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - F.col("_top")))
    merged = (
        parts.select(*keys, "_score", F.when(F.col("_top").isNotNull(), F.struct(F.col("_top").alias("top"), scaled.alias("sum"))).alias("_part"))
        .groupBy(*keys)
        .agg(F.collect_list("_part").alias("_parts"), F.max("_score").alias("_score"))
        .withColumn("_most", F.array_max(F.transform("_parts", lambda p: p["top"])))
    )
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + p["sum"] * F.exp(p["top"] - F.col("_most")))
    return merged.select(*keys, (F.col("_score") - F.col("_most") - F.ln(total)).alias("lp"))
