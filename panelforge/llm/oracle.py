"""DuckDB SQL for the queries of ``queries`` that SQL can express."""

from __future__ import annotations

from . import quality as Q

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quality_sql(docs: str = "documents") -> str:
    """Verdicts of ``quality`` over the relation ``docs``: table ``judged``."""
    rates = {"word_len": "100 * word_chars // greatest(n_words, 1)",
             "symbol_rate": "1000 * n_symbols // greatest(n_words, 1)",
             "dup_line_rate": "1000 * n_dup_lines // greatest(n_lines, 1)"}
    pairs = " union all ".join(
        f"select lang, source, '{r}' as rate, {r} as v from q_rates where not base_failed"
        for r in rates)
    least = "case rate " + " ".join(f"when '{r}' then {x}" for r, x in Q.LEAST.items()) + " end"
    quart = ", ".join(
        f"min(case when 4 * cum >= {k} * total then value end) as q{k}" for k in (1, 3))
    wide = ", ".join(
        f"max(case when rate = '{r}' then {e} end) as {r}_{c}" for r in rates
        for c, e in (("lo", "q1 - step"), ("hi", "q3 + step")))

    def quartiles(keys: str, rel: str) -> str:
        return f"""select {keys}, {quart}, max(total) as total from (
            select *, sum(n) over (partition by {keys} order by value) as cum,
                   sum(n) over (partition by {keys}) as total from {rel}) group by {keys}"""

    return rf"""
q_raw as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    coalesce(text, '') as text, {_WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls,
    row_number() over () as rid from {docs}),
q_gram as (select rid, i, list_aggregate(w[i:i+4], 'string_agg', ' ') as g
    from (select rid, w, unnest(generate_series(1, len(w) - 4)) as i from q_raw
          where len(w) >= 5)),
q_twice as (select rid, i from q_gram qualify count(*) over (partition by rid, g) > 1),
q_rep as (select rid, sum(least(5, coalesce(nxt - i, 5))) as n from (
    select rid, i, lead(i) over (partition by rid order by i) as nxt from q_twice) group by rid),
q_meas as (select doc_id, lang, source, len(w)::bigint as n_words,
    length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, len(ls) as n_lines,
    coalesce(q_rep.n, 0)::bigint as n_repeat_words
    from q_raw left join q_rep using (rid)),
q_rates as (select *, n_words < {Q.MIN_WORDS}
        or 100 * n_repeat_words > {Q.MAX_REPEAT_PCT} * n_words as base_failed,
    {", ".join(f"({e})::bigint as {r}" for r, e in rates.items())} from q_meas),
q_sketch as (select lang, source, rate, v - v % m as value, count(*) as n from (
    select *, case when length(bin(v)) > 6 then 1::bigint << (length(bin(v)) - 6) else 1 end as m
    from ({pairs})) group by all),
q_own as ({quartiles("lang, source, rate", "q_sketch")}),
q_merged as ({quartiles("lang, rate", "(select lang, rate, value, sum(n) as n from q_sketch group by all)")}),
q_fence as (select lang, source, {wide} from (
    select *, {Q.REACH} * greatest(q3 - q1, {least}) as step from (
        select o.lang, o.source, o.rate,
            case when o.total >= {Q.MIN_GROUP} then o.q1 else m.q1 end as q1,
            case when o.total >= {Q.MIN_GROUP} then o.q3 else m.q3 end as q3
        from q_own o join q_merged m on o.lang = m.lang and o.rate = m.rate)) group by lang, source),
q_judged as (select r.*, not (base_failed
        or coalesce(symbol_rate > symbol_rate_hi, false)
        or coalesce(dup_line_rate > dup_line_rate_hi, false)
        or coalesce(n_words >= {Q.MIN_WORDS_MEAN}
                    and (word_len < word_len_lo or word_len > word_len_hi), false)) as kept
    from q_rates r left join q_fence f on r.lang = f.lang and r.source = f.source)"""


def quality_rules_sql() -> str:
    return f"""with {_quality_sql()}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, kept from q_judged"""


def chat_sql() -> str:
    marks, ann = r"^(?: ?>)+ ?", r"wrote:\s*$"
    key = "lpad(({}::hugeint + 9223372036854775808)::varchar, 20, '0')"
    norm = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'))"
    return rf"""with recursive
m as (select conv_id, turn, role, coalesce(text, '') as text,
    string_split(coalesce(text, ''), chr(10)) as raw, row_number() over () as rid
    from conversations),
l as (select *, length(mk) - length(replace(mk, '>', '')) as level,
        regexp_replace(line, '{marks}', '') as said from (
    select conv_id, turn, rid, i as ln, raw[i] as line, regexp_extract(raw[i], '{marks}', 0) as mk
    from (select *, unnest(generate_series(1, len(raw))) as i from m))),
l2 as (select *, coalesce(lead(level) over (partition by rid order by ln), 0) as next_level from l),
b as (select m.rid, m.conv_id, m.turn, m.role, m.text, q.n_quoted, case when q.n_quoted = 0 then m.text
        else coalesce(trim(q.own), '') end as body
    from m join (select rid, count(*) filter (where level > 0) as n_quoted,
        string_agg(said, chr(10) order by ln) filter (where level = 0
            and not (regexp_matches(said, '{ann}') and next_level > 0)) as own
        from l2 group by rid) q using (rid)),
runs as (select *, sum(new) over (partition by rid order by ln) as run from (
    select *, case when level = lag(level) over (partition by rid order by ln) then 0 else 1 end as new
    from l)),
asked0 as (select conv_id, turn, rid, level, said from runs where level > 0
    union all select conv_id, turn, rid, level, string_agg(said, chr(10) order by ln) from runs
    where level > 0 group by conv_id, turn, rid, run, level),
twins as (select min(rid) as rid from m group by conv_id, turn, text),
asked as (select conv_id, turn, level, {norm.format("said")} as u from asked0
    join twins using (rid)),
parts as (select distinct conv_id, turn, rid, unnest(list_concat([body],
    regexp_split_to_array(body, '\n\s*\n'), string_split(body, chr(10)))) as part from b),
orig as (select conv_id, u, min(turn) as first_turn from (
    select conv_id, turn, {norm.format("part")} as u from parts) where u <> '' group by all),
found as (select a.conv_id, a.turn, a.level, o.first_turn, sum(length(a.u)) as weight
    from asked a join orig o on a.conv_id = o.conv_id and a.u = o.u
    where a.u <> '' and o.first_turn < a.turn group by all),
link as (select conv_id, turn, first_turn as parent_turn from found
    qualify row_number() over (partition by conv_id, turn
                               order by level, weight desc, first_turn desc) = 1),
walk as (select conv_id, turn, parent_turn, parent_turn as root_turn, 1::bigint as depth,
        {key.format("parent_turn")} as above from link
    union all select w.conv_id, w.turn, w.parent_turn, k.parent_turn, w.depth + 1,
        {key.format("k.parent_turn")} || '/' || w.above
    from walk w join link k on k.conv_id = w.conv_id and k.turn = w.root_turn),
tree as (select * from walk qualify row_number() over (
    partition by conv_id, turn order by depth desc) = 1)
select b.conv_id, b.turn, b.role, t.parent_turn, coalesce(t.root_turn, b.turn) as root_turn,
    coalesce(t.depth, 0)::bigint as depth, b.n_quoted::bigint as n_quoted,
    coalesce(t.above || '/', '') || {key.format("b.turn")} as path, b.body,
    '<|' || coalesce(b.role, '') || '|>' || chr(10) || b.body as chat
from b left join tree t on t.conv_id = b.conv_id and t.turn = b.turn"""


def exact_dedup_sql() -> str:
    return r"""with t as (select doc_id, length(coalesce(text, '')) as n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as bare from documents)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from (
    select doc_id, bare, count(*) over (partition by bare)::bigint as group_size,
        first_value(doc_id) over (partition by bare order by n desc, doc_id) as keep_id from t)"""


def audit_sql() -> str:
    return rf"""with
d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, {_WORDS} as w
    from documents),
f as (select part, coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic,
    [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
     100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
     regexp_matches(text, '[#$%&*|]'),
     d.doc_id > min(d.doc_id) over (partition by text)] as fails
    from d left join labels l on d.doc_id = l.doc_id),
cell as (select part, fails, count(*) as n, count(*) filter (where good) as good,
    count(*) filter (where toxic) as toxic from f group by all),
abc as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order
    from abc a join abc b on b.x <> a.x join abc c on c.x not in (a.x, b.x)
    join abc d on d.x not in (a.x, b.x, c.x) join abc e on e.x not in (a.x, b.x, c.x, d.x)),
step as (select filter_order, s::int as step, filter_order[s] as letter,
    ascii(filter_order[s]) - 64 as i from orders, generate_series(1, 5) as g(s)),
walk as (select part, fails, n, good, toxic, filter_order, step, letter, fails[i] as here,
    coalesce(sum(fails[i]::int) over (partition by part, fails, filter_order order by step
        rows between unbounded preceding and 1 preceding), 0) as earlier,
    len(list_filter(fails, lambda z: z)) as n_fails
    from cell, step),
sums as (select part, filter_order, step, letter,
    sum(case when earlier = 0 and not here then n else 0 end)::bigint as kept,
    sum(case when earlier = 0 and here then n else 0 end)::bigint as removed,
    sum(case when earlier > 0 and here then n else 0 end)::bigint as redundant,
    sum(case when here and n_fails = 1 then n else 0 end)::bigint as unique_fails,
    sum(case when earlier = 0 and here then good else 0 end)::bigint as good_lost,
    sum(case when earlier = 0 and here then toxic else 0 end)::bigint as toxic_lost
    from walk group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, letter))::bigint as shapley from sums"""


def oracle_sql() -> dict[str, str]:
    return {"op9_quality_rules": quality_rules_sql(), "op10_chat_quotation": chat_sql(),
            "op11_tree_merge": exact_dedup_sql(), "op12_filter_audit": audit_sql()}
