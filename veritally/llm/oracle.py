"""SQL twins of the queries that SQL can express, for one database that holds all tables."""

from __future__ import annotations

import re

from veritally.llm import audit, chat, merkle, mixing, secrets, urls
from veritally.llm.common import WORD


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _source_mix() -> str:
    pick = lambda values: f"[{', '.join(f'{v}::double' for v in values)}][(source_rank % {len(values)}) + 1]"
    return f"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as ord
  from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, row_number() over (order by source nulls last) - 1 as source_rank from totals),
filled as (select *, {pick(mixing.WEIGHTS)} as weight, source_size * {mixing.CAP}::double as lim from ranked),
levels as (
  select *, (sum(source_size) over ()
             - coalesce(sum(lim) over (order by lim / weight, source_rank rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by lim / weight, source_rank rows between current row and unbounded following) as level
  from filled),
targets as (
  select *, least(lim, weight * max(case when level <= lim / weight then level end) over ()) as target from levels),
placed as (
  select s.*, t.source_size, t.target, {pick([a for a, _ in mixing.SLOPES])} as a, {pick([b for _, b in mixing.SLOPES])} as b,
         coalesce(sum(s.size) over (partition by s.source order by s.ord, s.size, s.doc_id
                                    rows between unbounded preceding and 1 preceding), 0) + s.size / 2.0::double as middle
  from sized s join targets t on s.source is not distinct from t.source),
counted as (
  select *, case when source_size > 0 then least(3, greatest(0, ceil((target - middle) / source_size)))::bigint else 1 end as copies,
         case when target > 0 then middle / target else 0 end as share
  from placed)
select doc_id, size, source_size, round(target, 6) as target, (copies * size)::bigint as taken,
       case when copies > 0 then round(least(1.0,
         case when abs(b - a) < 1e-12 then share else (sqrt(a * a + 2 * (b - a) * share) - a) / (b - a) end), 9) end as position
from counted"""


def _parts(table: str) -> str:
    return f"""
  select *, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select *, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from {table})"""


def _url_filter() -> str:
    rules = sorted(urls.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for _, h, p in rules]
    case = lambda values: "case " + " ".join(f"when {f} then '{v}'" for f, v in zip(fits, values)) + " end"
    weakest, strongest = urls.STRENGTHS
    low, high = 1 / (strongest + 1), 1 / (weakest + 1)

    def level(name: str, keys: str, prior: tuple[str, str], source: str) -> str:
        inside = "prior > 0 and prior < 1"
        return f"""
{name}_groups as (select {keys}, sum(n)::double as n, sum(bad)::double as bad from hosts group by {keys}),
{name}_priors as (select g.*, {prior[0]} as prior, {prior[1]} as doubt from {name}_groups g {source}),
{name}_strength as (
  select 1 / coalesce(least(greatest(
    sum(case when {inside} then n * pow(bad / n - prior, 2) / (prior * (1 - prior)) - 1 end)
    / nullif(sum(case when {inside} then n - 1 end), 0), {low!r}), {high!r}), {low!r}) - 1 as k from {name}_priors),
{name}_means as (select p.*, (k * prior + bad) / (k + n) as mean, k + n as total from {name}_priors p, {name}_strength),
{name}_variances as (
  select *, mean * (1 - mean) / (total + 1) + pow((total - n) / total, 2) * doubt as variance from {name}_means),
{name}_posterior as (select *, mean - {urls.Z!r} * sqrt(variance) as bound from {name}_variances)"""

    hierarchy = f"""
  select *, case when paired <> '' then paired else split_part(plain, '.', -1) end as suffix,
         array_to_string(string_split(plain, '.')[(case when paired <> '' then -3 else -2 end):], '.') as domain
  from (select *, regexp_extract(plain, '{urls.PAIRED_SUFFIX}', 1) as paired
        from (select *, regexp_replace(host, '^[^@]*@|:[0-9]*$', '') as plain from parts))"""
    return f"""
with parts as ({_parts("pages")}),
known as ({hierarchy}),
outcome as (
  select doc_id::varchar as doc, max(case when coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) as bad
  from labels group by 1),
hosts as (
  select suffix, domain, host, count(*)::double as n, sum(bad)::double as bad
  from known join outcome on regexp_extract(path, '/([0-9]+)', 1) = doc group by all),
overall as (select rate, rate * (1 - rate) / (n + 1) as doubt
            from (select coalesce(sum(bad) / sum(n), 0) as rate, coalesce(sum(n), 0) as n from hosts)),
{level("suffix", "suffix", ("o.rate", "o.doubt"), "cross join overall o")},
{level("domain", "suffix, domain", ("p.mean", "p.variance"), "join suffix_posterior p using (suffix)")},
{level("host", "suffix, domain, host", ("p.mean", "p.variance"), "join domain_posterior p using (suffix, domain)")},
judged as (
  select k.page_id, k.host, k.path, coalesce(h.mean, d.mean, s.mean, o.rate) as rate, coalesce(h.bound, d.bound, s.bound, o.rate) as bound
  from known k left join host_posterior h on k.host = h.host left join domain_posterior d on k.domain = d.domain
  left join suffix_posterior s on k.suffix = s.suffix cross join overall o)
select page_id, host, path, {case([h + p for _, h, p in rules])} as rule,
       coalesce({case([v for v, _, _ in rules])}, case when bound > {urls.BLOCK_ABOVE} then 'block' else 'allow' end) as verdict,
       round(rate, 6) as bad_rate, round(bound, 6) as bad_bound
from judged"""


def _tree(table: str, text: str, prefix: str) -> str:
    node = lambda x: f"md5({x})"
    short = lambda nodes: f"list_transform({nodes}, lambda n: substr(n, 1, {merkle.NODE}))"
    end = "|".join(merkle.SECTION_ENDS)
    cut = f"regexp_replace(regexp_replace(p, '{merkle.CLAUSE_END}', '\\1' || chr(10), 'g'), '{merkle.CLAUSE_LIMIT}', '\\1' || chr(10), 'g')"
    return f"""
  select *, sha256(array_to_string({prefix}sections, ',')) || ':' || array_to_string({short(prefix + "sections")}, ',') || ':'
            || array_to_string({short(prefix + "leaves")}, ',') as {prefix}fingerprint
  from (select *, list_transform(string_split({prefix}marked, '|'), lambda s: {node("s")}) as {prefix}sections,
               flatten({prefix}grouped) as {prefix}leaves
        from (select *, array_to_string(list_transform({prefix}grouped, lambda g: (
                       {node("array_to_string(g, ',')")} ||
                       case when regexp_matches({node("array_to_string(g, ',')")}, '^({end})') then '|' else ',' end)), '') as {prefix}marked
              from (select *, list_transform(string_split({text}, chr(10)), lambda p: list_transform(string_split({cut}, chr(10)), lambda c: {node("c")})) as {prefix}grouped
                    from {table})))"""


def _fingerprints() -> str:
    leaves = lambda x: f"string_split(string_split({x}, ':')[3], ',')"

    def likeness(a: str, b: str) -> str:
        shared = f"len(list_intersect({leaves(a)}, {leaves(b)}))"
        every = f"len(list_distinct(list_concat({leaves(a)}, {leaves(b)})))"
        return f"case when string_split({a}, ':')[1] = string_split({b}, ':')[1] then 1.0::double else {shared}::double / ({every} + ({shared} = {every})::int) end"

    return f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
own as ({_tree("texts", "text", "")}),
pairs as (
  select doc_id, text, fingerprint, length(text)::bigint as n_chars,
         coalesce(lead(text) over w, first_value(text) over w) as next_text,
         coalesce(lead(fingerprint) over w, first_value(fingerprint) over w) as next_fingerprint
  from own window w as (order by doc_id desc nulls last, text desc)),
edited as (
  select *, substr(text, 1, n_chars - n_chars // 2) || substr(next_text, 1, n_chars // 2) as edited_text from pairs),
trees as ({_tree("edited", "edited_text", "edited_")})
select doc_id, n_chars, sha256(edited_text) as edited_sha256, fingerprint, edited_fingerprint,
       {likeness("fingerprint", "edited_fingerprint")} as near_edited, {likeness("fingerprint", "next_fingerprint")} as near_next
from trees"""


def _secrets() -> str:
    def spans(pattern: str, kind: str, keep: str = "true") -> str:
        found, between = f"regexp_extract_all(t, {_quoted(pattern)})", f"string_split_regex(t, {_quoted(pattern)})"
        lengths = lambda a: f"coalesce(list_sum(list_transform({a}, lambda x: length(x))), 0)"
        start = f"({lengths('b[1:i]')} + {lengths('m[1:i - 1]')})::bigint"
        span = f"{{'start': {start}, 'end': {start} + length(m[i]), 'rank': {secrets.KINDS.index(kind)}, 'kind': '{kind}', 'text': m[i]}}"
        return f"""(select list_filter(list_transform(range(1, len(m) + 1), lambda i: {span}), lambda s: {keep})
                    from (select {found} as m, {between} as b))"""

    value = f"length(regexp_extract(s.text, {_quoted(secrets.ASSIGN)}, 1)) >= {secrets.ASSIGN_VALUE}"
    w = secrets.WINDOW
    window = f"list_aggregate(string_split(substr(s.text, i::bigint, {w}), ''), 'entropy')"
    bits = f"round(list_max(list_transform(range(1, length(s.text) - {w} + 2), lambda i: {window})), 6)"
    needed = "case " + " ".join(f"when regexp_matches(s.text, '{p}') then {b}" for _, p, b in secrets.CLASSES) + " end"
    allowed = " or ".join(f"regexp_matches(s.text, '{p}')" for p in secrets.ALLOWED)
    apart = "len(list_filter(base, lambda b: b.start < s.end and s.start < b.end)) = 0"
    line = lambda a: f"array_to_string(list_transform({a}, lambda s: s.kind || ':' || s.start || ':' || s.end), ',')"
    count = lambda kind: f"len(list_filter(base, lambda s: s.kind = '{kind}'))::bigint as n_{kind}"
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as (
  select doc_id, list_sort(list_concat(list_concat({spans(secrets.ASSIGN, "assign", value)}, {spans(secrets.ACCESS, "access")}), {spans(secrets.HEX, "hex")})) as base,
         {spans(secrets.CANDIDATE, "entropy")} as candidates
  from texts),
judged as (
  select *, list_filter(candidates, lambda s: {apart} and not ({allowed}) and {bits} >= {needed}) as added from found)
select doc_id, {count("assign")}, {count("access")}, {count("hex")}, sha256({line("base")}) as base_sha256,
       {line("list_sort(list_concat(base, added))")} as spans, len(added)::bigint as n_entropy
from judged"""


def _jaccard_join(width: int = 4, threshold: int = 85) -> str:
    return f"""
with recursive words as (
  select row_number() over () as row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) as w
  from documents),
sets as (
  select row, doc_id, case when len(w) = 0 then [] when len(w) < {width} then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) end as s
  from words),
shingles as (select row, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.row as x, b.row as y from shingles a join shingles b on a.shingle = b.shingle and a.row <> b.row
  group by a.row, b.row, a.n, b.n having 100 * count(*) >= {threshold} * (a.n + b.n - count(*))),
reach(row, other) as (
  select row, row from sets union select r.row, l.y from reach r join links l on r.other = l.x)
select any_value(s.doc_id) as doc_id, any_value(len(s.s))::bigint as n_shingles, min(o.doc_id) as component_id
from reach r join sets s on r.row = s.row join sets o on r.other = o.row group by r.row"""


def _filter_audit() -> str:
    bits = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(audit.FILTERS))
    return f"""
with recursive labelled as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
texts as (
  select d.doc_id, coalesce(d.lang, '') as part, coalesce(d.text, '') as text, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
  from documents d left join labelled l using (doc_id)),
found as (
  select *, regexp_extract_all(text, '{WORD}') as words, len(regexp_replace(text, '[^A-Z]+', '', 'g')) as capitals,
         coalesce(doc_id > min(doc_id) over (partition by text), false) as copied
  from texts),
masks as (
  select part, good, toxic, (len(words) < 100)::int + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::int
         + 4 * (100 * capitals > 10 * len(text))::int + 8 * regexp_matches(text, '[#$%&*|]')::int + 16 * copied::int as mask
  from found),
counted as (
  select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masks group by part, mask),
bits(letter, bit) as (values {bits}),
grown(filter_order, used, step) as (
  select letter, bit, 1 from bits
  union all select g.filter_order || b.letter, g.used + b.bit, g.step + 1 from grown g join bits b on (g.used & b.bit) = 0 where g.step < 5),
steps as (
  select o.filter_order, s.i as step, b.bit,
         coalesce((select sum(c.bit) from bits c where instr(o.filter_order, c.letter) < s.i), 0)::int as earlier
  from (select filter_order from grown where step = 5) o, range(1, 6) s(i), bits b
  where b.letter = substr(o.filter_order, s.i::int, 1)),
result as (
  select part, filter_order, step::int as step, bit,
         coalesce(sum(n) filter ((mask & (earlier | bit)) = 0), 0)::bigint as kept,
         coalesce(sum(n) filter ((mask & bit) <> 0 and (mask & earlier) = 0), 0)::bigint as removed,
         coalesce(sum(n) filter ((mask & bit) <> 0 and (mask & earlier) <> 0), 0)::bigint as redundant,
         coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
         coalesce(sum(good) filter ((mask & bit) <> 0 and (mask & earlier) = 0), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter ((mask & bit) <> 0 and (mask & earlier) = 0), 0)::bigint as toxic_lost
  from counted, steps group by part, filter_order, step, bit)
select * exclude (bit), (sum(removed) over (partition by part, bit))::bigint as shapley from result"""


def _chat_format() -> str:
    t = chat.TEMPLATE
    escaped = lambda column: (
        "regexp_replace(" * len({c[0] for c in t.controls})
        + column
        + "".join(
            ", "
            + _quoted(rf"({re.escape(first)})(\\*(?:" + "|".join(re.escape(c[1:]) for c in t.controls if c[0] == first) + "))")
            + r", '\1\\\2', 'g')"
            for first in sorted({c[0] for c in t.controls})
        )
    )
    size = lambda m: len(m.before) + len(m.after)
    marks = " ".join(f"when {_quoted(role)} then {size(m)}" for role, m in t.roles.items())
    learned = ", ".join(_quoted(role) for role, m in t.roles.items() if m.learned)
    # Each state follows from the role before it.
    before = {t.start: "begin"} | {to: role for (_, role), to in t.transitions.items()}
    allowed = ", ".join(f"({_quoted(before[state])}, {_quoted(role)})" for state, role in t.transitions)
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', {_quoted(chat.FORGED)}), (-1, 1, 'assistant', {_quoted(chat.FORGED)})),
placed as (
  select *, row_number() over w - 1 as place, coalesce(lag(role) over w, 'begin') as before,
         lead(role) over w is null as is_last
  from turns window w as (partition by conv_id order by turn nulls first, role, text)),
judged as (
  select *, (before, role) in ({allowed}) as allowed,
         case role {marks} else {size(t.other) + len(t.role_after)} + len({escaped("role")}) end + len({escaped("text")}) as chars
  from placed)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       coalesce(sum(len(text)) filter (role in ({learned})), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter (role in ({learned})), '')) as loss_sha256,
       ({len(t.begin)} + sum(chars))::bigint as formatted_chars,
       bool_and(allowed) and bool_or(is_last and role in ({learned})) as complete,
       min(place) filter (not allowed)::int as error_at
from judged group by conv_id"""


ORACLE: dict[str, str] = {
    "op4_jaccard_join": _jaccard_join(),
    "op6_source_mix": _source_mix(),
    "op7_url_filter": _url_filter(),
    "op9_fingerprints": _fingerprints(),
    "op10_secrets": _secrets(),
    "op11_filter_audit": _filter_audit(),
    "op12_chat_format": _chat_format(),
}
