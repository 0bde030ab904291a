"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from veritally import fixed_values as V
from veritally.operators import batching
from veritally.verification.registry import PROMPT_LENGTH, SEED, SHAPE_LENGTH


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _number(text: str, pattern: str) -> str:
    return f"try_cast(replace(regexp_extract({text}, {_quoted(pattern)}, 1), ',', '') as double)"


GOLD = _number("answer", V.GOLD_PATTERN)
PRED = "coalesce(" + ", ".join(_number("completion", "(?i)" + p) for p in V.COMPLETION_PATTERNS) + ")"
PROMPT = (
    f"{_quoted(V.PROMPT_PREFIX)} || question || chr(10) || "
    f"{_quoted(V.PROMPT_SUFFIX.strip())} || chr(10)"
)
MATCH = f"coalesce(abs(pred - gt) < {V.TOLERANCE!r}, false)"
FLOAT_MATCH = f"coalesce(abs(pred - cast(cast(gt as float) as double)) < {V.TOLERANCE!r}, false)"
WORD_LENGTHS = "list_transform(string_split({}, ' '), lambda w: cast(length(w) as integer))"


def _short(text: str) -> str:
    n = V.ELLIPSIS_LENGTH
    return f"case when length({text}) > {n} then substr({text}, 1, {n}) || {_quoted(V.ELLIPSIS)} else {text} end"


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def _permuted() -> str:
    """The permutation of row positions, each walk cut after four steps: the tables here need fewer."""
    a = "(cast(ceil(sqrt(n)) as bigint))"
    b = f"((n + {a} - 1) // {a})"

    def once(x: str) -> str:
        one, two = f"({x} % {a})", f"({x} // {a})"
        for i, (first, second) in enumerate(batching.permutation_keys(SEED, 0)):
            scrambled = lambda v: f"(({v} + {first}) * ({v} + {second}) % {batching.PRIME})"  # noqa: E731, B023
            if i % 2:
                one = f"(({one} + {scrambled(two)}) % {a})"
            else:
                two = f"(({two} + {scrambled(one)}) % {b})"
        return f"({two} * {a} + {one})"

    rows = "select problem_id, row_number() over (order by row_idx) - 1 as x, count(*) over () as n from problems"
    rows = f"select problem_id, n, {once('x')} as x from ({rows})"
    for _ in range(4):
        rows = f"select problem_id, n, case when x < n then x else {once('x')} end as x from ({rows})"
    return f"select problem_id, x::bigint as shuffle_pos, x // {V.EVAL_BATCH_SIZE} as batch_id from ({rows})"


# --- derived views as common table expressions ----------------------------

CTE: dict[str, str] = {
    "problems": """
select o_orderkey as problem_id, o_orderkey as row_idx,
 case when o_orderkey % 5 = 0 then 'test' else 'train' end as split,
 'Order ' || o_orderkey || ' has priority ' || o_orderpriority || '. What is its total price?' as question,
 case when o_orderkey % 10 = 9 then 'No final line here.'
  else 'Add the lines up.' || chr(10) || '#### ' ||
   case when o_totalprice >= 1000
    then cast(floor(o_totalprice / 1000) as bigint) || ',' || lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as varchar), 3, '0')
    else cast(cast(floor(o_totalprice) as bigint) as varchar) end ||
   case when o_orderkey % 3 = 0
    then '.' || lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as varchar), 2, '0')
    else '' end end as answer
from orders""",
    "rollouts": "select * exclude (epoch) from all_rollouts where epoch = 0",
    "all_rollouts": """
select epoch, problem_id, sample_idx, problem_id * 4 + sample_idx as seq_id, problem_id // 2 as batch_id,
 case (problem_id * 7 + sample_idx * 3 + epoch * 5) % 8
  when 0 then 'Therefore the answer is ' || w
  when 1 then 'step 1 = 2 then #### ' || w
  when 2 then 'total = ' || w || chr(10) || 'done'
  when 3 then 'a = 5 and b = ' || w
  when 4 then 'THE ANSWER IS -' || w || '.'
  when 5 then 'I am not sure.'
  when 6 then 'the answer is $' || w
  else 'rate = ' || w || '% so = ' || w || '.' || c end as completion
from (select o_orderkey as problem_id, cast(unnest([0, 1, 2, 3]) as integer) as sample_idx,
       cast(cast(floor(o_totalprice) as bigint) as varchar) as w,
       lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as varchar), 2, '0') as c
      from orders) cross join (select cast(unnest([0, 1]) as integer) as epoch)""",
    "golds": f"select problem_id, row_idx, split, question, {GOLD} as gt from problems",
    "preds": f"select problem_id, sample_idx, seq_id, batch_id, completion, {PRED} as pred from rollouts",
    "paired": "select p.problem_id, sample_idx, seq_id, batch_id, pred, gt, split from preds p join golds g on p.problem_id = g.problem_id",
    "rewarded": f"select *, case when {MATCH} then 1.0e0 else 0.0e0 end as reward from paired",
    "rewarded_float": f"select *, case when {FLOAT_MATCH} then 1.0e0 else 0.0e0 end as reward from paired",
    "scored": "select *, reward - avg(reward) over (partition by problem_id) as advantage from rewarded",
    "epoch_batches": """
select epoch, (problem_id + epoch) // 2 as batch_id, avg(reward) as reward
from rewarded cross join (select cast(unnest([0, 1]) as integer) as epoch) group by all""",
    "tokens": f"""
select seq_id, pos, 0.0e0 - length(word) / 10.0e0 as lp,
 ((problem_id + pos * 3 + length(word)) % 19 - 8) / 25.0e0 as delta
from (select problem_id, seq_id, cast(unnest(generate_series(0, len(ws) - 1)) as integer) as pos, unnest(ws) as word
      from (select problem_id, seq_id, string_split('Answer: now ' || completion, ' ') as ws from rollouts))""",
    "pairs": "select seq_id, pos, lp as old_lp, lp + delta as new_lp from tokens",
    "sequences": "select seq_id, batch_id, (problem_id % 5 - 2) / 2.0e0 as advantage from rollouts",
    "token_losses": f"""
select p.seq_id, pos, batch_id,
 -least(exp(new_lp - old_lp) * advantage, least(greatest(exp(new_lp - old_lp), 1 - {V.CLIP_EPS!r}), 1 + {V.CLIP_EPS!r}) * advantage) as loss
from pairs p join sequences s on p.seq_id = s.seq_id""",
    "steps": "select unnest([0, 1, 2]) as ppo_epoch, unnest([0.0e0, 0.5e0, 1.0e0]) as step",
    "losses": f"""
select batch_id, ppo_epoch,
 sum(-least(ratio * advantage, least(greatest(ratio, 1 - {V.CLIP_EPS!r}), 1 + {V.CLIP_EPS!r}) * advantage)) / count(*) as loss
from (select batch_id, cast(ppo_epoch as integer) as ppo_epoch, advantage, exp(lp + delta * step - lp) as ratio
      from tokens t join sequences s on t.seq_id = s.seq_id cross join steps where pos >= 1)
group by all""",
    "shuffled": f"""
select problem_id, (row_number() over (order by md5('{SEED}:0:' || problem_id), problem_id) - 1) // 2 as batch_id
from problems where split = 'train'""",
    "batch_losses": f"""
select batch_id,
 sum(-least(ratio * advantage, least(greatest(ratio, 1 - {V.CLIP_EPS!r}), 1 + {V.CLIP_EPS!r}) * advantage)) / count(*) as loss
from (select h.batch_id, advantage, exp(lp + delta - lp) as ratio
      from tokens t join scored s on t.seq_id = s.seq_id join shuffled h on h.problem_id = s.problem_id where pos >= 1)
group by all""",
    "training": """
select cast(0 as integer) as epoch, r.batch_id, loss, reward, avg(reward) over (order by r.batch_id) as avg_reward
from (select h.batch_id, avg(reward) as reward from scored s join shuffled h on h.problem_id = s.problem_id group by all) r
left join batch_losses b on b.batch_id = r.batch_id""",
    "epoch_scored": f"""
select *, reward - avg(reward) over (partition by epoch, problem_id) as advantage
from (select *, case when {MATCH} then 1.0e0 else 0.0e0 end as reward
      from (select epoch, r.problem_id, sample_idx, seq_id, {PRED} as pred, gt, split
            from all_rollouts r join golds g on r.problem_id = g.problem_id))""",
    "epoch_tokens": """
select epoch, seq_id, pos, 0.0e0 - length(word) / 10.0e0 as lp,
 ((problem_id + pos * 3 + length(word)) % 19 - 8) / 25.0e0 as delta
from (select epoch, problem_id, seq_id, cast(unnest(generate_series(0, len(ws) - 1)) as integer) as pos, unnest(ws) as word
      from (select epoch, problem_id, seq_id, string_split('Answer: now ' || completion, ' ') as ws from all_rollouts))""",
    "epoch_shuffled": f"""
select problem_id, epoch,
 (row_number() over (partition by epoch order by md5('{SEED}:' || epoch || ':' || problem_id), problem_id) - 1) // {V.TRAIN_BATCH_SIZE} as batch_id
from problems cross join (select cast(unnest([0, 1]) as integer) as epoch) where split = 'train'""",
    "epoch_losses": f"""
select epoch, batch_id,
 sum(-least(ratio * advantage, least(greatest(ratio, 1 - {V.CLIP_EPS!r}), 1 + {V.CLIP_EPS!r}) * advantage)) / count(*) as loss
from (select h.epoch, h.batch_id, advantage, exp(lp + delta - lp) as ratio
      from epoch_tokens t join epoch_scored s on t.seq_id = s.seq_id and t.epoch = s.epoch
      join epoch_shuffled h on h.problem_id = s.problem_id and h.epoch = s.epoch where pos >= 1)
group by all""",
    "epoch_training": """
select r.epoch, r.batch_id, loss, reward, avg(reward) over (partition by r.epoch order by r.batch_id) as avg_reward
from (select h.epoch, h.batch_id, avg(reward) as reward from epoch_scored s
      join epoch_shuffled h on h.problem_id = s.problem_id and h.epoch = s.epoch group by all) r
left join epoch_losses b on b.batch_id = r.batch_id and b.epoch = r.epoch""",
    "aligned": f"""
select g.problem_id, split, row_idx, {_short('question')} as question, gt,
 {_short('a.completion')} as baseline_response, a.pred as baseline_pred,
 {_short('b.completion')} as trained_response, b.pred as trained_pred,
 {MATCH.replace('pred', 'a.pred')} as baseline_ok, {MATCH.replace('pred', 'b.pred')} as trained_ok
from golds g join preds a on a.problem_id = g.problem_id and a.sample_idx = 0
join preds b on b.problem_id = g.problem_id and b.sample_idx = 1""",
    "report": """
select row_number() over (order by row_idx) - 1 as idx, question, gt,
 baseline_response, case when baseline_ok then 'Yes' else 'No' end as baseline_correct,
 trained_response, case when trained_ok then 'Yes' else 'No' end as trained_correct
from aligned where split = 'test'""",
    "cells": """
select idx, cast(idx as varchar) as c0, question as c1, coalesce(cast(gt as varchar), 'None') as c2,
 baseline_response as c3, baseline_correct as c4, trained_response as c5, trained_correct as c6 from report""",
    "turns": f"""
select conv_id * 100 + turn as seq_id, conv_id as batch_id, {WORD_LENGTHS.format('text')} as ids,
 cast((conv_id * 100 + turn) % 7 as integer) as p from conversations""",
    "document_words": """
select doc_id, unnest(generate_series(0, len(ws) - 1)) as pos, unnest(ws) as word
from (select doc_id, string_split(text, ' ') as ws from documents)""",
    "vocabulary": """
select word, count(*) as n, cast(row_number() over (order by count(*) desc, md5(word), word) as bigint) as token_id
from document_words group by word""",
    "prompt_words": f"""
select problem_id, prompt, gt, unnest(generate_series(0, len(ws) - 1)) as pos, unnest(ws) as word
from (select problem_id, {PROMPT} as prompt, gt, string_split({PROMPT}, ' ') as ws from golds)""",
    "prompt_vocabulary": """
select word, cast(row_number() over (order by count(*) desc, md5(word), word) as bigint) as token_id
from prompt_words group by word""",
    "logits": "select vec_id, list_transform(embedding, lambda x: cast(x as double)) as l, label from embeddings",
    "norms": "select *, list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l))))) as z from logits",
}
NEEDS = {
    "rollouts": ["all_rollouts"],
    "epoch_scored": ["all_rollouts", "golds"],
    "epoch_tokens": ["all_rollouts"],
    "epoch_shuffled": ["problems"],
    "epoch_losses": ["epoch_tokens", "epoch_scored", "epoch_shuffled"],
    "epoch_training": ["epoch_losses"],
    "golds": ["problems"],
    "preds": ["rollouts"],
    "paired": ["golds", "preds"],
    "rewarded": ["paired"],
    "rewarded_float": ["paired"],
    "scored": ["rewarded"],
    "epoch_batches": ["rewarded"],
    "tokens": ["rollouts"],
    "pairs": ["tokens"],
    "sequences": ["rollouts"],
    "token_losses": ["pairs", "sequences"],
    "losses": ["tokens", "sequences", "steps"],
    "shuffled": ["problems"],
    "batch_losses": ["tokens", "scored", "shuffled"],
    "training": ["batch_losses"],
    "aligned": ["golds", "preds"],
    "report": ["aligned"],
    "cells": ["report"],
    "vocabulary": ["document_words"],
    "prompt_words": ["golds"],
    "prompt_vocabulary": ["prompt_words"],
    "norms": ["logits"],
}


def sql(select: str, *views: str) -> str:
    """``select`` behind the common table expressions it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    head = ",\n".join(f"{v} as ({CTE[v].strip()})" for v in ordered)
    return f"with {head}\n{select.strip()}" if head else select.strip()


def _report_sql(head: list[str], line: str) -> str:
    heading = " union all ".join(
        f"select cast({i} as bigint) as line_no, {_quoted(h)} as line" for i, h in enumerate(head, start=1)
    )
    return sql(f"{heading} union all select idx + {len(head) + 1} as line_no, {line} as line from cells", "cells")


def _fixed_width() -> str:
    head = [
        V.REPORT_SEPARATOR.join(n.ljust(w) for n, w in zip(V.REPORT_COLUMNS, V.REPORT_WIDTHS)),
        "-" * V.REPORT_RULE_WIDTH,
    ]
    padded = [f"c{i} || repeat(' ', greatest(0, {w} - length(c{i})))" for i, w in enumerate(V.REPORT_WIDTHS)]
    return _report_sql(head, f" || {_quoted(V.REPORT_SEPARATOR)} || ".join(padded))


def _markdown() -> str:
    header = "| " + " | ".join(V.REPORT_COLUMNS) + " |"
    cells = [f"replace(replace(c{i}, chr(10), '<br>'), '|', '\\|')" for i in range(7)]
    return _report_sql(
        [V.MARKDOWN_TITLE, "", header, V.MARKDOWN_RULE], "'| ' || " + " || ' | ' || ".join(cells) + " || ' |'"
    )


def _zeros(n: str) -> str:
    return f"list_transform(generate_series(1, {n}), lambda i: cast(0 as integer))"


def _ones(n: str) -> str:
    return f"list_transform(generate_series(1, {n}), lambda i: cast(1 as integer))"


def _padded(ids: str, n: int | str) -> str:
    return f"list_concat({_zeros(f'greatest(0, {n} - len({ids}))')}, {ids})"


def _mask(ids: str, n: int | str) -> str:
    return f"list_concat({_zeros(f'greatest(0, {n} - len({ids}))')}, {_ones(f'len({ids})')})"


RATIO = "exp(new_lp - old_lp)"
HIDDEN = "least(len(ids) - 1, greatest(0, p - 1))"

ORACLE: dict[str, str] = {
    "load_split": sql("select * from problems where split = 'train'", "problems"),
    "split_head": sql("select * from problems where split = 'train' order by row_idx limit 100", "problems"),
    "split_count": sql("select split, count(*) as n from problems group by split", "problems"),
    "row_lookup": sql("select * from problems where row_idx in (select l_partkey from lineitem)", "problems"),
    "report_fixed_width": _fixed_width(),
    "report_markdown": _markdown(),
    "epoch_metrics": sql(
        f"select epoch, count(*) as num_batches, {r6('avg(loss)')} as avg_loss, {r6('avg(reward)')} as avg_reward "
        "from epoch_training group by epoch",
        "epoch_training",
    ),
    "metrics_log": sql(
        f"select epoch, batch_id, printf('%.{V.DECIMALS}f', {r6('loss')}) as loss, printf('%.{V.DECIMALS}f', {r6('reward')}) as reward, "
        f"printf('%.{V.DECIMALS}f', {r6('avg_reward')}) as avg_reward from epoch_training",
        "epoch_training",
    ),
    "epoch_summary_lines": sql(
        f"""select epoch, cast(unnest([0, 1, 2]) as integer) as line_no,
unnest(['Epoch ' || (epoch + 1) || ' Summary:', {_quoted(V.LOSS_LABEL)} || printf('%.{V.DECIMALS}f', loss), {_quoted(V.REWARD_LABEL)} || printf('%.{V.DECIMALS}f', reward)]) as line
from (select epoch, {r6('avg(loss)')} as loss, {r6('avg(reward)')} as reward from epoch_training group by epoch)""",
        "epoch_training",
    ),
    "accuracy_line": sql(
        f"select {_quoted(V.ACCURACY_LABEL)} || printf('%.4f', sum(reward) / count(*)) as line "
        "from rewarded where split = 'test' and sample_idx = 0",
        "rewarded",
    ),
    "build_prompt": sql(f"select problem_id, {PROMPT} as prompt from problems", "problems"),
    "example_record": sql(
        f"""select problem_id, prompt, {_padded('ids', PROMPT_LENGTH)} as input_ids, {_mask('ids', PROMPT_LENGTH)} as attention_mask, gt
from (select problem_id, any_value(prompt) as prompt, any_value(gt) as gt,
       list_slice(list(token_id order by pos), 1, {PROMPT_LENGTH}) as ids
      from prompt_words w join prompt_vocabulary v on w.word = v.word group by problem_id)""",
        "prompt_vocabulary",
    ),
    "truncate_text": f"select doc_id, {_short('text')} as short from documents",
    "verdict_label": sql(
        f"select problem_id, sample_idx, case when {MATCH} then 'Yes' else 'No' end as verdict from paired", "paired"
    ),
    "extract_gold": sql("select problem_id, gt from golds", "golds"),
    "extract_prediction": sql("select problem_id, sample_idx, pred from preds", "preds"),
    "normalize_number": sql(
        f"select problem_id, regexp_extract(answer, {_quoted(V.GOLD_PATTERN)}, 1) as captured, {GOLD} as number from problems",
        "problems",
    ),
    "pattern_coverage": sql(
        "select sample_idx, cast(case "
        + " ".join(
            f"when regexp_matches(completion, {_quoted('(?i)' + p)}) then {i}"
            for i, p in enumerate(V.COMPLETION_PATTERNS, start=1)
        )
        + " end as integer) as pattern, count(*) as n from rollouts group by all",
        "rollouts",
    ),
    "tolerance_match": sql(f"select problem_id, sample_idx, {MATCH} as is_match from paired", "paired"),
    "binary_reward": sql("select problem_id, sample_idx, reward from rewarded", "rewarded"),
    "custom_reward": sql(
        "select problem_id, sample_idx, case when abs(pred - gt) <= abs(gt) * 0.01e0 then 1.0e0 else 0.0e0 end as reward from paired",
        "paired",
    ),
    "group_size_violations": "select l_orderkey, count(*) as n from lineitem group by l_orderkey having count(*) <> 4",
    "null_gold_quarantine": sql(
        f"select * from problems where {GOLD} is null", "problems"
    ),
    "attach_gold": sql("select problem_id, sample_idx, pred, gt from paired", "paired"),
    "fan_out_samples": sql(
        "select problem_id, cast(unnest([0, 1, 2, 3]) as integer) as sample_idx, question from problems", "problems"
    ),
    "align_models": sql("select * from aligned", "aligned"),
    "align_logprobs": sql(f"select seq_id, pos, {r6('old_lp')} as old_lp, {r6('new_lp')} as new_lp from pairs", "pairs"),
    "broadcast_advantage": sql(
        "select t.seq_id, pos, batch_id, advantage from tokens t join sequences s on t.seq_id = s.seq_id",
        "tokens",
        "sequences",
    ),
    "group_mean_reward": sql(
        "select problem_id, avg(reward) as mean_reward from rewarded group by problem_id", "rewarded"
    ),
    "masked_mean": sql(
        f"select seq_id % 16 as batch_id, {r6('avg(lp)')} as masked_mean from tokens where pos >= 1 group by all", "tokens"
    ),
    "accuracy": sql(
        f"select split, sample_idx, sum(reward) as correct, count(*) as total, {r6('sum(reward) / count(*)')} as accuracy "
        "from rewarded group by all",
        "rewarded",
    ),
    "batch_mean_reward": sql("select epoch, batch_id, reward from epoch_batches", "epoch_batches"),
    "epoch_mean_of_means": sql(
        f"select epoch, count(*) as num_batches, {r6('avg(reward)')} as avg_reward from epoch_batches group by epoch",
        "epoch_batches",
    ),
    "last_ppo_epoch_loss": sql(
        f"select batch_id, {r6('loss')} as loss from losses where ppo_epoch = 2", "losses"
    ),
    "model_tally": sql(
        "select baseline_ok, trained_ok, count(*) as n from aligned group by all", "aligned"
    ),
    "model_totals": sql(
        "select 'baseline' as model, count(*) filter (baseline_ok) as correct, count(*) as total from aligned "
        "union all select 'trained', count(*) filter (trained_ok), count(*) from aligned",
        "aligned",
    ),
    "group_advantage": sql("select problem_id, sample_idx, reward, advantage from scored", "scored"),
    "running_reward": sql(
        f"select epoch, batch_id, reward, {r6('avg(reward) over (partition by epoch order by batch_id)')} as avg_reward "
        "from epoch_batches",
        "epoch_batches",
    ),
    "permuted_batches": sql(_permuted(), "problems"),
    "assign_batches": sql(
        f"select problem_id, row_idx, (row_number() over (order by row_idx) - 1) // {V.EVAL_BATCH_SIZE} as batch_id "
        "from problems where split = 'test'",
        "problems",
    ),
    "positional_regroup": sql(
        "select seq_id as stored, seq_id // 4 as group_id, cast(seq_id % 4 as integer) as place, seq_id as pos from rollouts",
        "rollouts",
    ),
    "seeded_shuffle": sql(
        f"select problem_id, row_number() over (order by md5('{SEED}:1:' || problem_id), problem_id) - 1 as shuffle_pos from problems",
        "problems",
    ),
    "ordered_eval": sql("select row_idx, question from problems where split = 'test' order by row_idx", "problems"),
    "vocabulary": sql("select * from vocabulary", "vocabulary"),
    "vocab_encode": sql(
        "select doc_id, list(token_id order by pos) as ids from document_words d join vocabulary v on d.word = v.word group by doc_id",
        "vocabulary",
    ),
    "vocab_decode": "select doc_id, text from documents",
    "truncate_tokens": sql(f"select seq_id, list_slice(ids, 1, {SHAPE_LENGTH}) as ids from turns", "turns"),
    "pad_left": sql(
        f"select seq_id, {_padded('ids', V.MAX_LENGTH)} as ids from "
        f"(select seq_id, list_slice(ids, 1, {V.MAX_LENGTH}) as ids from turns)",
        "turns",
    ),
    "attention_mask": sql(
        f"select seq_id, {_mask('ids', V.MAX_LENGTH)} as mask from "
        f"(select seq_id, list_slice(ids, 1, {V.MAX_LENGTH}) as ids from turns)",
        "turns",
    ),
    "mask_from_ids": sql(
        "select seq_id, list_transform(ids, lambda x: cast(x <> 0 as integer)) as mask from turns", "turns"
    ),
    "pad_to_batch_max": sql(
        f"""select seq_id, batch_id, list_concat(ids, {_zeros('room')}) as input_ids,
list_concat({_ones('len(ids)')}, {_zeros('room')}) as attention_mask
from (select *, max(len(ids)) over (partition by batch_id) - len(ids) as room from turns)""",
        "turns",
    ),
    "completion_slice": sql("select seq_id, list_slice(ids, p + 1, len(ids)) as ids from turns", "turns"),
    "log_softmax": sql(
        "select vec_id, list_transform(l, lambda x: round(x - z, 6)) as logprobs from norms", "norms"
    ),
    "shift_labels": sql(
        "select seq_id, list_transform(list_slice(ids, 1, len(ids) - 1), lambda x: x / -8.0e0 - 1) as score, "
        "list_slice(ids, 2, len(ids)) as label from turns",
        "turns",
    ),
    "gather_logprob": sql(f"select vec_id, {r6('l[label + 1] - z')} as logprob from norms", "norms"),
    "loss_mask": sql(
        f"select seq_id, list_concat({_zeros(HIDDEN)}, {_ones(f'len(ids) - 1 - {HIDDEN}')}) as mask from turns", "turns"
    ),
    "importance_ratio": sql(f"select seq_id, pos, {r6(RATIO)} as ratio from pairs", "pairs"),
    "clip_ratio": sql(
        f"select seq_id, pos, {r6(f'least(greatest({RATIO}, 1 - {V.CLIP_EPS!r}), 1 + {V.CLIP_EPS!r})')} as clipped from pairs", "pairs"
    ),
    "clipped_surrogate": sql(f"select seq_id, pos, {r6('loss')} as loss from token_losses", "token_losses"),
    "policy_loss": sql(f"select batch_id, ppo_epoch, {r6('loss')} as loss from losses", "losses"),
    "policy_loss_from_arrays": sql(f"select batch_id, ppo_epoch, {r6('loss')} as loss from losses", "losses"),
    "streaming_scores": sql(
        "select batch_id, count(*) as n, avg(reward) as reward from rewarded group by batch_id", "rewarded"
    ),
    "streaming_advantages": sql("select problem_id, sample_idx, reward, advantage from scored", "scored"),
    "streaming_advantages_split_groups": sql("select problem_id, sample_idx, reward, advantage from scored", "scored"),
    "streaming_group_advantages": sql("select problem_id, sample_idx, batch_id, reward, advantage from scored", "scored"),
    "score_rollouts_epochs": sql(
        "select problem_id, sample_idx, epoch, pred, gt, reward, advantage from epoch_scored", "epoch_scored"
    ),
    "score_rollouts_shuffled": sql("select problem_id, sample_idx, pred, gt, reward, advantage from scored", "scored"),
    "score_rollouts_hot": sql("select problem_id, sample_idx, pred, gt, reward, advantage from scored", "scored"),
    "training_metrics_epochs": sql(
        f"select epoch, batch_id, {r6('loss')} as loss, {r6('reward')} as reward, {r6('avg_reward')} as avg_reward from epoch_training",
        "epoch_training",
    ),
    "vocab_encode_short_head": sql(
        "select doc_id, list(token_id order by pos) as ids from document_words d join vocabulary v on d.word = v.word group by doc_id",
        "vocabulary",
    ),
    "broadcast_advantage_long": sql(
        "select t.seq_id, pos, batch_id, advantage from tokens t join sequences s on t.seq_id = s.seq_id",
        "tokens",
        "sequences",
    ),
    "sequence_logprobs": sql(
        f"select a.vec_id // 16 as seq_id, cast(a.vec_id % 16 as integer) as pos, {r6('a.l[b.label + 1] - a.z')} as lp "
        "from norms a join norms b on b.vec_id = a.vec_id + 1 and b.vec_id % 16 > 0",
        "norms",
    ),
    "score_rollouts": sql("select problem_id, sample_idx, pred, gt, reward, advantage from scored", "scored"),
    "score_rollouts_float_gold": sql(
        "select problem_id, sample_idx, pred, gt, reward, reward - avg(reward) over (partition by problem_id) as advantage "
        "from rewarded_float",
        "rewarded_float",
    ),
    "evaluate_split": sql(
        f"select sample_idx, sum(reward) as correct, count(*) as total, {r6('sum(reward) / count(*)')} as accuracy "
        "from rewarded where split = 'test' group by all",
        "rewarded",
    ),
    "evaluate_split_known_golds": sql(
        f"select sample_idx, sum(reward) as correct, count(*) as total, {r6('sum(reward) / count(*)')} as accuracy "
        "from rewarded where split = 'train' and gt is not null group by all",
        "rewarded",
    ),
    "evaluate_split_float_gold": sql(
        f"select sample_idx, sum(reward) as correct, count(*) as total, {r6('sum(reward) / count(*)')} as accuracy "
        "from rewarded_float where split = 'test' group by all",
        "rewarded_float",
    ),
    "compare_models": sql(f"select * from report where idx < {V.REPORT_ROWS}", "report"),
    "compare_models_whole_split": sql("select * from report", "report"),
    "training_metrics": sql(
        f"select epoch, batch_id, {r6('loss')} as loss, {r6('reward')} as reward, {r6('avg_reward')} as avg_reward from training",
        "training",
    ),
    "training_metrics_from_arrays": sql(
        f"select epoch, batch_id, {r6('loss')} as loss, {r6('reward')} as reward, {r6('avg_reward')} as avg_reward from training",
        "training",
    ),
    "prepare_examples": sql(
        f"""select problem_id, (row_number() over (order by problem_id) - 1) // {V.TRAIN_BATCH_SIZE} as batch_id, prompt,
{_padded('ids', PROMPT_LENGTH)} as input_ids, {_mask('ids', PROMPT_LENGTH)} as attention_mask, gt
from (select problem_id, any_value(prompt) as prompt, any_value(gt) as gt,
       list_slice(list(token_id order by pos), 1, {PROMPT_LENGTH}) as ids
      from prompt_words w join prompt_vocabulary v on w.word = v.word group by problem_id)""",
        "prompt_vocabulary",
    ),
}

# The same rows by another way or from tables that are stored in another way.
SAME_AS = {
    "extract_prediction_unicode": "extract_prediction",
    "vocab_encode_rows_short_head": "vocab_encode",
    "vocab_decode_short_head": "vocab_decode",
    "sequence_logprobs_chunked": "sequence_logprobs",
    "score_rollouts_bucketed": "score_rollouts",
    "training_metrics_bucketed": "training_metrics",
}
ORACLE |= {name: ORACLE[twin] for name, twin in SAME_AS.items()}
