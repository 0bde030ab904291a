import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from veritally.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = [*chat.TEMPLATE.controls, "\\", "\\\\", "<", "[", "]", ">", "/", "s>", "</", "[\\INST]", "<\\s>", "a\nb", "é😀", " ", "$1", "INST]"]
ROLES = ["system", "user", "assistant", "assistant", "tool", "to[SAYS]ol", "", None]


def corpus(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 7)):
            text = rng.choice([None, "", *["".join(rng.choices(PIECES, k=rng.randint(1, 8))) for _ in range(6)]])
            rows.append((c, t, rng.choice(ROLES), text))
    rng.shuffle(rows)
    return rows


def in_order(rows):
    by_id = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by_id[c].append((role or "", text or ""))
    return by_id


def walk(roles):
    state, error = "begin", None
    for i, role in enumerate(roles):
        to = chat.TEMPLATE.transitions.get((state, role))
        if to is None and error is None:
            error = i
        state = to or state
    return error is None and state in chat.TEMPLATE.final, error


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_what_is_read_back_is_what_was_said(spark, seed):
    rows = corpus(seed)
    done = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    done = done.withColumn("formatted", chat.formatted_text(F.col("segments")))
    done = done.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))})
    expected = in_order(rows)
    got = done.collect()
    assert len(got) == len(expected)
    for r in got:
        turns = expected[r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(text for role, text in turns if role == "assistant")
        assert (r["complete"], r["error_at"]) == walk([role for role, _ in turns])
        assert len(r["segments"]) == 1 + 3 * len(turns) and not r["segments"][0]["learned"]
        for i, (role, _) in enumerate(turns):
            assert [s["learned"] for s in r["segments"][1 + 3 * i : 4 + 3 * i]] == [False, role == "assistant", False]
            for c in chat.TEMPLATE.controls:
                assert c not in r["segments"][2 + 3 * i]["text"]


def test_digests(spark):
    rows = corpus(3, 40)
    got = {r["conv_id"]: r for r in chat.conversation_digests(spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit(1))).collect()}
    expected = in_order(rows + [(-1, 0, "user", chat.FORGED), (-1, 1, "assistant", chat.FORGED)])
    assert set(got) == set(expected)
    for c, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))


def test_odd_rows(spark):
    rows = [(None, None, "user", "a"), (None, 1, "assistant", "b"), (5, 1, "user", "x"), (5, 1, "user", "x"), (6, 0, "user", "w " * 100_000)]
    got = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[None]["complete"], got[None]["error_at"]) == (True, None)
    assert len(got[5]["segments"]) == 7 and got[5]["error_at"] == 1
    assert len(got[6]["segments"][2]["text"]) == 200_000 and not got[6]["complete"]
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_conversations(empty).count() == 0
    assert [r["conv_id"] for r in chat.conversation_digests(empty).collect()] == [-1]


def test_many_turns(spark):
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>").alias("text"))
    (r,) = chat.format_conversations(turns).withColumn("n", F.size(chat.read_turns(chat.formatted_text(F.col("segments"))))).collect()
    assert r["complete"] and r["n"] == 20_000


def test_another_template(spark):
    mark = chat.Marks
    template = chat.Template("{b}", {"q": mark("{q}", "{e}"), "a": mark("{a}", "{e}", True)}, mark("{o}", "{e}"), "{:}", "s", {("s", "q"): "t", ("t", "a"): "s"}, frozenset({"s"}))
    rows = [(1, 0, "q", "{a}x{\\e}"), (1, 1, "a", "{e}"), (1, 2, "z", "{:}")]
    done = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), template)
    (r,) = done.select(chat.read_turns(chat.formatted_text(F.col("segments")), template).alias("t"), chat.loss_text(F.col("segments"), template).alias("l"), "error_at").collect()
    assert [tuple(t) for t in r["t"]] == [x[2:] for x in rows] and r["l"] == "{e}" and r["error_at"] == 2
    with pytest.raises(ValueError):
        chat.Template("{b{", {}, mark("{", "}"), ":", "s", {})
