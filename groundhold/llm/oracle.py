"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from math import log, log1p

from . import mixing, risk_quality

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

CONTENT_SORT = rf"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = min(doc_id) over same as kept, sha256(norm) as text_sha256
from n window same as (partition by norm)
"""

_MEASURES = rf"""
texts as (
  select doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORDS}') as w from documents
), windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as three
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from texts)
), twice as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, three) > 1
), covered as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by doc_id
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct l) as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as l from texts) where regexp_matches(l, '{WORDS}') group by doc_id
), m as (
  select t.doc_id, lang, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_lines, 0) as n_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from texts t left join covered c on c.doc_id = t.doc_id left join lines l on l.doc_id = t.doc_id
), b as (
  select *, n_words < {risk_quality.MIN_WORDS}
            or 100 * n_repeat_words > {risk_quality.MAX_REPEAT_PERCENT} * n_words as base_failed from m
)"""


def _risk() -> str:
    def duck(expression: str) -> str:
        return expression.replace(" div ", " // ").replace("0L", "0").replace("1L", "1")

    alpha = risk_quality.ALPHA / len(risk_quality.RULES)
    scores = " union all ".join(
        f"select doc_id, lang, '{rule}' as rule, cast({duck(e)} as bigint) as score from b where n_words > 0"
        for rule, e in risk_quality.RULES.items()
    )
    return f"""
with {_MEASURES}, scores as ({scores}),
marks as (select doc_id, max(quality) = 1 as good from labels where quality is not null group by doc_id),
cells as (
  select s.lang, rule, score, count(*) filter (good) as good, count(*) filter (not good) as bad
  from scores s join marks k on k.doc_id = s.doc_id join b on b.doc_id = s.doc_id and not b.base_failed group by all
), tried as (
  select lang, rule, score, coalesce(sum(good) over above, 0) as lost, coalesce(sum(bad) over above, 0) as caught,
         sum(good) over (partition by lang, rule) as n
  from cells
  window above as (partition by lang, rule order by score desc rows between unbounded preceding and 1 preceding)
), families as (select count(distinct (lang, rule)) as f from tried
), chances as (
  select n, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * {log(alpha)} + (n - k) * {log1p(-alpha)}))
               over (partition by n order by k) as p
  from (select n, unnest(range(0, cast(least(n, ceil(n * {alpha})) as bigint) + 1)) as k
        from (select distinct n from tried where n > 0))
), allowed as (select n, max(k) as k from chances, families where p <= {risk_quality.DELTA} / f group by n
), best as (
  select lang, rule, max_by(score, (caught - lost, score)) as cutoff
  from tried t join allowed a on a.n = t.n where lost <= a.k and caught > lost group by all
), rejected as (
  select distinct doc_id from scores s join best c on c.lang is not distinct from s.lang and c.rule = s.rule and score > cutoff
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       not base_failed and doc_id not in (select doc_id from rejected) as kept
from b
"""


def _mix(seed: int = 11) -> str:
    weights, passes, block, steps = list(mixing.WEIGHTS), mixing.MAX_PASSES, mixing.BLOCK_WORDS, list(mixing.STEPS)
    return rf"""
with sizes as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) as bigint) as size,
         md5('{seed}|' || coalesce(cast(doc_id as varchar), 'null')) as draw
  from documents
), per as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as no from sizes group by source
), weighed as (select *, {weights}[no % {len(weights)} + 1] as weight, {passes} * source_size as cap from per
), levels as (
  select *, ((select sum(source_size) from per) - coalesce(sum(cap) over before, 0))
            / ((select sum(weight) from weighed) - coalesce(sum(weight) over before, 0)) as level,
         row_number() over (order by cap / weight, source nulls last) as turn
  from weighed
  window before as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
), first_open as (select min(turn) as turn from levels where level * weight <= cap
), goals as (
  select l.source, source_size, no, greatest(cast(ceil(source_size / {mixing.SHARD_WORDS}) as bigint), 1) as shards,
         cast(case when l.turn >= f.turn then least((select level from levels where turn = f.turn) * weight, cap)
              else cap end as double) as target
  from levels l, first_open f
), dealt as (
  select s.*, no, source_size, target, cast('0x' || left(draw, 8) as bigint) % shards as shard
  from sizes s join goals g on g.source is not distinct from s.source
), shards as (
  select no, shard, cast(sum(size) as bigint) as words, cast(ceil(sum(size) / {block}) as bigint) as blocks,
         any_value(target) * cast(ceil(sum(size) / {block}) as bigint) / any_value(source_size) as votes,
         md5('{seed}|' || no || '|' || shard) as key
  from dealt group by no, shard having sum(size) > 0
), quotients as (
  select no, shard, seat, votes / (2 * seat + 1) as quotient
  from (select *, unnest(range(0, {passes} * blocks)) as seat from shards)
), seats as (
  select no, shard, count(*) as quota from (
    select *, row_number() over (order by quotient desc, no, shard, seat) as turn from quotients
  ) where turn <= (select round(sum(votes)) from shards) group by no, shard
), chosen as (
  select no, shard, words, block, block * words // blocks as low, (block + 1) * words // blocks as high,
         quota // blocks + case when ({steps}[cast('0x' || key[9:12] as bigint) % {len(steps)} + 1] * block
                                      + cast('0x' || left(key, 8) as bigint) % blocks) % blocks < quota % blocks then 1 else 0 end as times
  from (select *, unnest(range(0, blocks)) as block from shards join seats using (no, shard))
), placed as (
  select *, coalesce(sum(size) over (partition by no, shard order by draw, doc_id, size
                     rows between unbounded preceding and 1 preceding), 0) as pos
  from dealt
), taken as (
  select doc_id, sum((least(high, pos + size) - greatest(low, pos)) * times) as taken
  from placed p join chosen c on c.no = p.no and c.shard = p.shard and c.low < pos + size and c.high > pos
  where size > 0 group by doc_id
)
select p.doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from placed p left join taken t on t.doc_id = p.doc_id
"""


# crc32 of the ASCII text in a column, from the table of its 256 bytes' remainders; ``crc_table`` is a table of one row.
CRC_TABLE = """
remainders as (
  select i, 0 as step, cast(i as bigint) as c from range(256) r(i) union all
  select i, step + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from remainders where step < 8
), crc_table as (select list(c order by i) as remainder from remainders where step = 8)"""


def _crc32(text: str) -> str:
    digits = f"list_transform(range(1, length({text}) + 1), lambda j: cast(ord({text}[j]) as bigint))"
    step = "xor(acc // 256, remainder[xor(acc % 256, b) + 1])"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {digits}), lambda acc, b: {step}), 4294967295)"


def _leaf(n_chars: str) -> str:
    def sized(text: str) -> str:
        return f"coalesce(cast(octet_length(encode({text})) as varchar) || ':' || {text}, '-')"

    values = ("cast(doc_id as varchar)", "source", "lang", f"cast({n_chars} as varchar)", "text")
    return f"sha256({' || '.join(map(sized, values))})"


# One level after the other: a run's digest, each row's siblings, and the fold of each tampered row.
MERKLE = f"""
with recursive {CRC_TABLE},
leaves as (
  select doc_id, lang, {_leaf("n_chars")} as h,
         {_leaf("n_chars + case when hit then 1 else 0 end")} as claimed
  from (select *, coalesce({_crc32("cast(doc_id as varchar)")} % 7 = 0, false) as hit from documents, crc_table)
), rowed as (
  select *, row_number() over own - 1 as i, count(*) over (partition by lang) as n from leaves
  window own as (partition by lang order by doc_id nulls first, h)
), below as (
  select lang, 0 as level, i, h, n from rowed union all
  select lang, level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from below where n > 1
  group by lang, level, i // 2, n
), subroots as (
  select lang, h, level as height, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from below where n = 1
), above as (
  select 0 as level, i, h, n from subroots union all
  select level + 1, i // 2, sha256(string_agg(h, '' order by i)), (n + 1) // 2 from above where n > 1 group by level, i // 2, n
), steps as (
  select r.lang, r.i, b.level, b.i as sibling, b.h from rowed r join below b
    on b.lang is not distinct from r.lang and b.n > 1 and b.i = xor(r.i >> b.level, 1)
  union all
  select r.lang, r.i, s.height + a.level, a.i, a.h from rowed r join subroots s on s.lang is not distinct from r.lang
    join above a on a.n > 1 and a.i = xor(s.i >> a.level, 1)
), proofs as (select lang, i, string_agg(h, '' order by level) as proof from steps group by lang, i),
folds as (
  select r.lang, r.i, 0 as level, claimed as h, s.height, s.i as top, a.levels
  from rowed r join subroots s on s.lang is not distinct from r.lang, (select max(level) as levels from above) a
  union all
  select f.lang, f.i, f.level + 1,
         sha256(case when x.sibling % 2 = 0 then coalesce(x.h, '') || f.h else f.h || coalesce(x.h, '') end),
         height, top, levels
  from folds f left join steps x on x.lang is not distinct from f.lang and x.i = f.i and x.level = f.level
  where f.level < height + levels
)
select r.doc_id, r.h as leaf, s.h as subroot, t.h as root, sha256(coalesce(proof, '')) as proof_sha256, f.h as folded_root,
       f.h = t.h as verified
from rowed r join subroots s on s.lang is not distinct from r.lang join (select h from above where n = 1) t on true
left join proofs p on p.lang is not distinct from r.lang and p.i = r.i
join folds f on f.lang is not distinct from r.lang and f.i = r.i and f.level = f.height + f.levels
"""

# Backward costs (states: nothing yet, after system, user, assistant), then the edits letter by letter.
REPAIR = rf"""
with recursive {CRC_TABLE},
named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc32("(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))")} % 20 as hit
  from conversations, crc_table
), damaged as (
  select conv_id, turn, case when hit = 4 then 'user' else role end as role,
         case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(range(case when hit = 3 then 2 else 1 end)) from named where hit <> 0)
), ordered as (
  select *, row_number() over own - 1 as i, count(*) over (partition by conv_id) as n, lag(left(role, 1)) over own as before,
         regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) as final
  from damaged window own as (partition by conv_id order by turn nulls first, sha256(cast(octet_length(encode(role)) as varchar) || ':' || role || text))
), faulty as (
  select *, final = '' as blank, final <> '' and again as duplicate,
         final <> '' and not again and final not in ('.', '!', '?') as truncated, left(role, 1) as c
  from (select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again from ordered)
), priced as (
  select *, blank or duplicate as must, case when truncated then 3 else 0 end as t from faulty
), cost as (
  select conv_id, n as i, 0 as v0, 6 as v1, 3 as v2, 0 as v3 from priced where i = 0
  union all
  select conv_id, i, least(w0, 3 + w2, 6 + w3), least(w1, 3 + w2, 6 + w3), least(w2, 3 + w3), least(w3, 3 + w2) from (
    select p.conv_id, p.i,
           least(4 + v0, case when must then null else t + least(3 + v2, case c when 's' then v1 when 'u' then v2 end) end) as w0,
           least(4 + v1, case when must then null else t + v2 + case c when 'u' then 0 else 3 end end) as w1,
           least(4 + v2, case when must then null else t + v3 + case c when 'a' then 0 else 3 end end) as w2,
           least(4 + v3, case when must then null else t + v2 + case c when 'u' then 0 else 3 end end) as w3
    from cost x join priced p on p.conv_id is not distinct from x.conv_id and p.i = x.i - 1
  )
), held as (select conv_id, i, [v0, v1, v2, v3] as v from cost
), steps as (
  select conv_id, n, 0 as i, 0 as s, '' as audit, cast(null as varchar) as made from priced where i = 0
  union all
  select conv_id, n, i + case when e = 'I' then 0 else 1 end, case e when 'D' then s when 'K' then kept else follows end, audit || e,
         case when e = 'D' then made else coalesce(made || chr(10), '') ||
           case e when 'K' then role || ':' || text else case follows when 2 then 'user:' else 'assistant:' end ||
                case when e = 'R' then text else '' end end end
  from (
    select q.*, role, text, case c when 's' then 1 when 'u' then 2 when 'a' then 3 end as kept,
           case when q.i < q.n and 4 + b.v[s + 1] = a.v[s + 1] then 'D'
                when 3 + a.v[follows + 1] = a.v[s + 1] then 'I'
                when not must and (c = 's' and s = 0 or c = 'u' and s <> 2 or c = 'a' and s = 2)
                     and t + b.v[case c when 's' then 2 when 'u' then 3 else 4 end] = a.v[s + 1] then 'K' else 'R' end as e
    from (select *, case s when 2 then 3 else 2 end as follows from steps where i < n or s in (1, 2)) q
    join held a on a.conv_id is not distinct from q.conv_id and a.i = q.i
    left join held b on b.conv_id is not distinct from q.conv_id and b.i = q.i + 1
    left join (select conv_id as of, i as at, role, text, c, must, t from priced) p on p.of is not distinct from q.conv_id and p.at = q.i
  )
), done as (select conv_id, audit, made from steps where i = n and s in (0, 3)
), faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
         count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
         count(*) filter (i > 0 and before || c not in ('su', 'ua', 'au')) as illegal
  from priced group by conv_id
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(v[1], 0) as bigint) as cost,
       coalesce(audit, '') as audit, sha256(coalesce(made, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join faults f on f.conv_id is not distinct from o.conv_id left join done d on d.conv_id is not distinct from o.conv_id
left join held h on h.conv_id is not distinct from o.conv_id and h.i = 0
"""

ORACLE = {"op11_conversation_repair": REPAIR, "op13_merkle_manifest": MERKLE, "op5_content_sort": CONTENT_SORT, "op6_risk_quality": _risk(), "op8_sainte_lague_mix": _mix()}
