"""Token shaping, the vocabulary and the surrogate loss."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from veritally.functions import surrogate, tokens
from veritally.operators import blocks, policy, sequences
from veritally.plans.examples import prepare_examples
from veritally.workspace import materialize


@pytest.fixture(scope="module")
def seqs(spark):
    data = [(i, list(range(1, n + 1))) for i, n in enumerate([0, 1, 3, 8, 12])]
    return spark.createDataFrame(data, "seq_id int, ids array<int>")


def column(df, c):
    return [r[0] for r in df.orderBy("seq_id").select(c).collect()]


def test_pad_then_mask_gives_the_truncated_input(seqs):
    cut = tokens.truncate_tokens(F.col("ids"), 8)
    padded, mask = tokens.pad_left(cut, 0, 8), tokens.attention_mask(cut, 8)
    assert {len(x) for x in column(seqs, padded)} == {8}
    kept = F.filter(F.arrays_zip(padded.alias("i"), mask.alias("m")), lambda x: x["m"] == 1)["i"]
    assert column(seqs, kept) == column(seqs, cut)
    assert column(seqs, tokens.mask_from_ids(padded, 0)) == column(seqs, mask)


def test_mask_from_ids_hides_genuine_pad_tokens(spark):
    df = spark.createDataFrame([(1, [5, 0, 0])], "seq_id int, ids array<int>")
    assert column(df, tokens.mask_from_ids(F.col("ids"), 0)) == [[1, 0, 0]]
    assert column(df, tokens.attention_mask(F.col("ids"), 4)) == [[0, 1, 1, 1]]


def test_completion_slice(seqs):
    assert column(seqs, tokens.completion_slice(F.col("ids"), F.lit(2))) == [[], [], [3], [3, 4, 5, 6, 7, 8], list(range(3, 13))]


def test_drop_special(seqs):
    assert column(seqs, tokens.drop_special(F.col("ids"), [1, 3]))[:3] == [[], [], [2]]


def test_shift(seqs):
    scores = F.transform("ids", lambda x: x * 10)
    pairs = [[(r.score, r.label) for r in p] for p in column(seqs, tokens.shift_labels(scores, F.col("ids")))]
    assert pairs[:3] == [[], [], [(10, 2), (20, 3)]]


def test_loss_mask_keeps_positions_from_the_last_prompt_token(seqs):
    got = column(seqs, tokens.loss_mask(F.lit(5), F.lit(3)))
    assert got[0] == [0, 0, 1, 1, 1]
    assert column(seqs, tokens.loss_mask(F.lit(2), F.lit(9)))[0] == [0, 0]
    assert column(seqs, tokens.loss_mask(F.lit(2), F.lit(0)))[0] == [1, 1]


def test_loss_mask_option_leaves_out_padding(spark):
    df = spark.range(6).select(F.col("id").alias("seq_id"))
    pos = F.col("seq_id")
    assert column(df, tokens.in_loss(pos, F.lit(3))) == [0, 0, 1, 1, 1, 1]
    assert column(df, tokens.in_loss(pos, F.lit(3), F.lit(4))) == [0, 0, 1, 1, 0, 0]


def test_log_softmax(spark):
    logits = [[1.0, 2.0, 3.0], [1000.0, 1000.0], [0.0]]
    df = spark.createDataFrame(list(enumerate(logits)), "seq_id int, l array<float>")
    for x, got in zip(logits, column(df, tokens.log_softmax(F.col("l")))):
        norm = max(x) + math.log(sum(math.exp(v - max(x)) for v in x))
        assert got == pytest.approx([v - norm for v in x], abs=1e-12)
    label = F.lit(1)
    full = column(df, tokens.gather_label(tokens.log_softmax(F.col("l")), label))
    assert column(df, tokens.label_logprob(F.col("l"), label)) == full
    assert full[2] is None


def test_vocabulary_round_trip(spark, monkeypatch):
    """With a head of four words, most tokens take the shuffled way; texts come back whole."""
    monkeypatch.setattr(sequences, "HEAD_WORDS", 4)
    rng = random.Random(5)
    long_word = "x" * 90
    pool = ["the", "a", "b", "", "é", "c\nd", long_word, long_word + "y"] + [f"w{i}" for i in range(40)]
    data = [(i, " ".join(rng.choices(pool, k=rng.randrange(1, 30)))) for i in range(60)]
    data += [(60, ""), (61, None), (62, " "), (63, " ".join([long_word] * 50)), (64, " ".join(["the"] * 200))]
    df = spark.createDataFrame(data, "id long, text string")
    found = sequences.words(df, "id", F.col("text"))
    vocab = sequences.build_vocabulary(found).cache()
    ranked = vocab.orderBy("token_id").collect()
    assert [r.token_id for r in ranked] == list(range(1, len(ranked) + 1))
    assert [r.n for r in ranked] == sorted((r.n for r in ranked), reverse=True)
    encoded = sequences.encode_words(found, vocab, "id").cache()
    ids = {r.word: r.token_id for r in ranked}
    want = sorted((i, [ids[w] for w in t.split(" ")] if t is not None else []) for i, t in data)
    assert rows(encoded, "id") == want
    decoded = sequences.decode_ids(encoded, vocab, "id", [0])
    assert rows(decoded, "id") == sorted((i, t or "") for i, t in data)


WORDS = ["the", "a", "b", "", "é", "c\nd", "x" * 90, "x" * 90 + "y"] + [f"w{i}" for i in range(40)]


@pytest.mark.parametrize("head", [0, 4, 20, sequences.HEAD_WORDS])
def test_rows_are_encoded_and_decoded_in_place(spark, head):
    """Words past the head go out and come back; ids that no word has, and NULL ones, are left out of texts."""
    rng = random.Random(6)
    data = [(i, " ".join(rng.choices(WORDS, k=rng.randrange(1, 30)))) for i in range(60)]
    data += [(60, ""), (61, None), (62, " "), (63, " ".join([WORDS[6]] * 50)), (64, "never-seen the never-seen"), (None, "a w1")]
    df = spark.createDataFrame(data, "id long, text string").withColumn("n", F.lit(1))
    vocab = materialize(sequences.build_vocabulary(sequences.words(df.where("id is null or id <> 64"), "id", F.col("text"))))
    ids = {r.word: r.token_id for r in vocab.collect()}
    encoded = sequences.encode_rows(df, "id", F.col("text"), vocab, ["n"], head_words=head)
    want = sorted(((i, 1, [ids.get(w) for w in t.split(" ")] if t is not None else []) for i, t in data), key=str)
    assert sorted((tuple(r) for r in encoded.collect()), key=str) == want
    short = sequences.encode_rows(df, "id", F.col("text"), vocab, max_words=3, head_words=head)
    assert sorted((tuple(r) for r in short.collect()), key=str) == sorted(((i, x[:3]) for i, _, x in want), key=str)
    padded = encoded.select("id", F.concat(F.lit([0, 10**12, -5]), "ids").alias("ids"))
    decoded = sequences.decode_rows(padded, vocab, "id", [0], head_words=head)
    texts = [(i, " ".join(w for w in (t or "").split(" ") if w in ids) if t else "") for i, t in data]
    assert sorted((tuple(r) for r in decoded.collect()), key=str) == sorted(texts, key=str)


def test_only_words_past_the_head_are_shuffled(spark, monkeypatch):
    texts = [(i, "the " * 500 + (f"rare{i}" if i % 10 == 0 else "a")) for i in range(200)]
    df = spark.createDataFrame(texts, "id long, text string")
    vocab = materialize(sequences.build_vocabulary(sequences.words(df, "id", F.col("text"))))
    joined = []
    plain = sequences.join_unique
    monkeypatch.setattr(sequences, "join_unique", lambda rows, *a, **kw: joined.append(rows) or plain(rows, *a, **kw))
    encoded = sequences.encode_rows(df, "id", F.col("text"), vocab, head_words=2)
    assert encoded.count() == 200 and [r.count() for r in joined] == [20]  # words that are joined by a shuffle
    exchanged = [e for e in plan(encoded, "formatted").split("\n\n") if "Exchange\n" in e]
    assert exchanged and all("text" not in e and "_parts" not in e for e in exchanged)
    sequences.encode_rows(df, "id", F.col("text"), vocab).count()
    assert joined[1].count() == 0


def test_a_word_past_the_head_is_looked_up_once_per_block(spark, monkeypatch):
    """However often it comes in the rows of a block, both ways."""
    texts = [(i, "the " * 9 + "one two three " * 20 + "four") for i in range(50)]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    vocab = materialize(sequences.build_vocabulary(sequences.words(df, "id", F.col("text"))))
    joined = []
    plain = sequences.join_unique
    monkeypatch.setattr(sequences, "join_unique", lambda rows, *a, **kw: joined.append(rows) or plain(rows, *a, **kw))
    encoded = materialize(sequences.encode_rows(df, "id", F.col("text"), vocab, head_words=1))
    decoded = sequences.decode_rows(encoded.coalesce(1), vocab, "id", [], head_words=1)
    assert rows(decoded) == texts
    assert [r.count() for r in joined] == [4, 4]  # not 50 x 61, which is moved twice


@pytest.mark.parametrize("most", [1, 40, 10**6])
def test_blocks_are_cut_off_by_tokens(spark, monkeypatch, most):
    monkeypatch.setattr(blocks, "BLOCK_TOKENS", most)
    texts = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(1, 30)]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    starts = np.concatenate([[0], np.cumsum([i for i, _ in texts])])
    cuts = list(blocks._cuts(starts))
    assert [a for a, _ in cuts] == [0, *(b for _, b in cuts[:-1])] and cuts[-1][1] == 29
    assert all(starts[b] - starts[a] <= most or b == a + 1 for a, b in cuts)
    vocab = materialize(sequences.build_vocabulary(sequences.words(df, "id", F.col("text"))))
    encoded = sequences.encode_rows(df, "id", F.col("text"), vocab, head_words=3)
    assert rows(sequences.decode_rows(encoded, vocab, "id", [], head_words=3)) == texts


def test_words_outside_the_vocabulary_stay_as_null(spark):
    known = sequences.words(spark.createDataFrame([(1, "a b")], "id long, text string"), "id", F.col("text"))
    other = sequences.words(spark.createDataFrame([(1, "b z a")], "id long, text string"), "id", F.col("text"))
    vocab = sequences.build_vocabulary(known)
    (ids,) = [r.ids for r in sequences.encode_words(other, vocab, "id").collect()]
    assert len(ids) == 3 and ids[1] is None and None not in (ids[0], ids[2])


def test_examples(spark):
    df = spark.createDataFrame(
        [(i, i, "train", f"q {i}", f"#### {i}") for i in range(5)],
        "problem_id long, row_idx long, split string, question string, answer string",
    )
    got = prepare_examples(df, max_length=20, batch_size=2).orderBy("problem_id").collect()
    assert [r.batch_id for r in got] == [0, 0, 1, 1, 2]
    assert [r.gt for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert all(len(r.input_ids) == len(r.attention_mask) == 20 for r in got)
    assert all([int(i != 0) for i in r.input_ids] == r.attention_mask for r in got)


# --- surrogate -------------------------------------------------------------


@pytest.fixture(scope="module")
def scored_tokens(spark):
    rng = random.Random(11)
    data = [
        (b, s, p, rng.uniform(-3, 0), rng.uniform(-3, 0), rng.choice([-0.75, -0.25, 0.0, 0.25, 0.75]), rng.randrange(2))
        for b in range(4)
        for s in range(5)
        for p in range(rng.randrange(1, 20))
    ]
    return data, spark.createDataFrame(
        data, "batch_id int, seq_id int, pos int, old_lp double, new_lp double, advantage double, mask int"
    )


def brute_loss(data, batch, eps, clip=True):
    num = den = 0.0
    for b, _, _, old, new, adv, m in data:
        if b == batch:
            r = math.exp(new - old)
            c = min(max(r, 1 - eps), 1 + eps) if clip else r
            num += -min(r * adv, c * adv) * m
            den += m
    return num / den


def test_loss_against_loop(scored_tokens):
    data, df = scored_tokens
    for b, loss in rows(policy.policy_loss(df, ["batch_id"], F.col("mask"))):
        assert loss == pytest.approx(brute_loss(data, b, 0.2), abs=1e-12)
        assert loss >= brute_loss(data, b, 0.2, clip=False) - 1e-12


def test_equal_policies_give_minus_the_mean_advantage(scored_tokens):
    _, df = scored_tokens
    same = df.withColumn("new_lp", F.col("old_lp"))
    mean = df.groupBy("batch_id").agg((-policy.masked_mean(F.col("advantage"), F.col("mask"))).alias("m"))
    got = policy.policy_loss(same, ["batch_id"], F.col("mask"))
    for (b, x), (c, y) in zip(rows(got), rows(mean)):
        assert b == c and x == pytest.approx(y, abs=1e-12)


def test_empty_mask_gives_null(scored_tokens):
    _, df = scored_tokens
    got = policy.policy_loss(df, ["batch_id"], F.lit(0))
    assert [r[1] for r in rows(got)] == [None] * 4


def test_zero_clip_range_is_one(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 1.0), (2, 9.0)], "seq_id int, r double")
    assert column(df, surrogate.clip_ratio(F.col("r"), 0.0)) == [1.0, 1.0, 1.0]
    assert column(df, surrogate.clip_ratio(F.col("r"))) == [0.8, 1.0, 1.2]


def test_last_ppo_epoch(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 2, 3.0), (0, 1, 2.0), (1, 0, 5.0)], "batch_id int, ppo_epoch int, loss double")
    assert rows(policy.last_ppo_epoch_loss(df)) == [(0, 3.0), (1, 5.0)]


def test_broken_numbers_show(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, nan, 1.0), (1, 2.0, nan), (2, inf, 0.0), (3, inf, 1.0), (4, inf, -1.0), (5, 1.0, 1.0)], "seq_id int, r double, a double")
    clipped = column(df, surrogate.clip_ratio(F.col("r")))
    assert math.isnan(clipped[0]) and clipped[1:] == [1.2, 1.2, 1.2, 1.2, 1.0]
    loss = column(df, surrogate.clipped_surrogate(F.col("r"), F.col("a")))
    assert all(map(math.isnan, loss[:3])) and loss[3:] == [-1.2, inf, -1.0]


def test_ragged_arrays_are_refused(spark):
    sequences = spark.createDataFrame([(1, 0, 1.0)], "seq_id long, batch_id long, advantage double")
    old = spark.createDataFrame([(1, [-1.0, -2.0, -3.0])], "seq_id long, lps array<double>")
    new = spark.createDataFrame([(0, 1, [-1.0, -2.0])], "ppo_epoch int, seq_id long, lps array<double>")
    with pytest.raises(Exception, match="1: 3 old and 2 new scores"):
        policy.align_arrays(old, new, sequences).collect()
    even = policy.align_arrays(old, new.withColumn("lps", F.array(F.lit(-1.0), F.lit(-2.5), F.lit(-3.0))), sequences, start=F.lit(1))
    assert rows(even.select("pos", "old_lp", "new_lp")) == [(1, -2.0, -2.5), (2, -3.0, -3.0)]


def test_strict_alignment(spark):
    old = spark.createDataFrame([(1, 0, -1.0), (1, 1, -2.0)], "seq_id long, pos int, lp double")
    same = old.withColumn("lp", F.col("lp") - 1)
    assert rows(policy.align_logprobs(old, same, strict=True)) == [(1, 0, -1.0, -2.0), (1, 1, -2.0, -3.0)]
    for a, b in ((old, same.where("pos = 0")), (old.where("pos = 1"), same)):
        with pytest.raises(Exception, match="token without partner: 1, "):
            policy.align_logprobs(a, b, strict=True).collect()


def test_logprobs_of_sequences_feed_the_loss(spark):
    data = [(1, 0, [0.0, 1.0], 0), (1, 1, [2.0, 0.0], 1), (1, 2, [0.0, 0.0], 0), (2, 0, [1.0, 1.0], 1)]
    logits = spark.createDataFrame(data, "seq_id long, pos int, logits array<double>, token int")
    lps = policy.sequence_logprobs(logits)
    expected = [(1, 0, 1.0 - math.log(1 + math.e)), (1, 1, 2.0 - math.log(1 + math.e**2))]
    assert [(s, p, pytest.approx(x)) for s, p, x in expected] == rows(lps)
    tokens = policy.align_logprobs(lps, lps).withColumn("advantage", F.lit(2.0))
    assert rows(policy.policy_loss(tokens, ["seq_id"], F.lit(1.0))) == [(1, -2.0)]


def test_ids_are_long(spark):
    vocabulary = sequences.build_vocabulary(sequences.words(spark.createDataFrame([(1, "a b a")], "k long, t string"), "k", F.col("t")))
    assert dict(vocabulary.dtypes)["token_id"] == "bigint"


def test_align_is_an_inner_join(spark):
    old = spark.createDataFrame([(1, 0, -1.0), (1, 1, -2.0)], "seq_id long, pos int, lp double")
    new = spark.createDataFrame([(1, 1, -3.0), (2, 0, -4.0)], "seq_id long, pos int, lp double")
    assert rows(policy.align_logprobs(old, new)) == [(1, 1, -2.0, -3.0)]


def test_exact_losses_do_not_depend_on_partitions(spark):
    rng = random.Random(3)
    data = [(i % 3, rng.gauss(0, 1), rng.gauss(0, 1) * 10 ** rng.randint(-9, 3), rng.gauss(0, 1)) for i in range(20_000)]
    df = spark.createDataFrame(data, "g int, old_lp double, new_lp double, advantage double")

    def loss(parts, exact):
        dealt = df.repartition(parts, F.rand(parts))
        return [r["loss"].hex() for r in policy.policy_loss(dealt, ["g"], F.lit(1.0), exact=exact).orderBy("g").collect()]

    one = loss(4, True)
    assert one == loss(211, True) == loss(7, True)
    assert [float.fromhex(x) for x in one] == [pytest.approx(float.fromhex(x), rel=1e-9) for x in loss(4, False)]


def test_exact_sums_of_odd_values(spark):
    cases = {1: [1e300, 1.0], 2: [float("nan"), 1.0], 3: [float("inf"), 2.0], 4: [None], 5: [0.1] * 10, 6: [-1e10, 0.5]}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "k int, v double")
    got = dict(rows(df.groupBy("k").agg(policy.exact_sum(F.col("v")).alias("s"))))
    assert got[1] == 1e300 and math.isnan(got[2]) and got[3] == math.inf and got[4] is None and got[5] == 1.0 and got[6] == -1e10 + 0.5
