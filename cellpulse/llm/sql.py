"""DuckDB SQL that states the same results independently."""

from __future__ import annotations

from cellpulse.llm.license_scan import MIN_COSINE, STOP_WORDS, TEMPLATES

QUALITY_RULES = r"""
with texts as (
  select row_number() over () as row_id, doc_id, source, coalesce(text, '') as text from documents
), words as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from texts
), line_counts as (
  select row_id, count(*) as n_lines, count(distinct line) as n_kinds
  from (select row_id, unnest(string_split(text, chr(10))) as line from texts)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by row_id
), positions as (
  select row_id, unnest(generate_series(1, len(w) - 4)) as pos, w from words where len(w) >= 5
), windows as (
  select row_id, pos, array_to_string(w[pos:pos + 4], ' ') as win from positions
), again as (
  select row_id, pos from windows
  qualify count(*) over (partition by row_id, win) >= 2
), covered as (
  select row_id, count(distinct p) as n from (select row_id, unnest(generate_series(pos, pos + 4)) as p from again)
  group by row_id
), measured as (
  select row_id, doc_id, source, len(w) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_lines, 0) as n_lines, coalesce(n_lines - n_kinds, 0) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from words left join covered using (row_id) left join line_counts using (row_id)
), failed as (
  select *, n_words < 10 as r1, 100 * n_repeat_words > 20 * n_words as r2, 10 * n_symbols > n_words as r3,
    10 * n_dup_lines > 3 * n_lines as r4, word_chars > 15 * n_words or word_chars < 2 * n_words as r5
  from measured
), hosts as (
  select source, rule, count(*) as n, count(*) filter (where bad) as bad
  from (select source, unnest([1, 2, 3, 4, 5]) as rule, unnest([r1, r2, r3, r4, r5]) as bad from failed)
  group by source, rule
), prior as (
  select rule, avg(bad / n) as m, coalesce(var_samp(bad / n), 0) as v from hosts group by rule
), rates as (
  select source, rule,
    case when v > 0 then (bad + m * greatest(0, m * (1 - m) / v - 1)) / (n + greatest(0, m * (1 - m) / v - 1)) else m end as rate
  from hosts join prior using (rule)
), marks as (
  select source, list(rule) as marked from rates where rate > 0.5 group by source
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, r1 or r2 as base_failed,
  not (r1 or r2) and not coalesce(r3 and list_contains(marked, 3) or r4 and list_contains(marked, 4)
    or r5 and list_contains(marked, 5), false) as kept
from failed left join marks on failed.source is not distinct from marks.source
"""

CHAT_FORMATTING = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped as (
  select *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\])', '\1\\\2\3', 'g') as esc,
    regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\])', '\1\\\2\3', 'g') as esc_role
  from turns
)
select conv_id::bigint as conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(esc) + 7 + case role when 'assistant' then 0 when 'user' then 13 when 'system' then 15
    else 13 + length(esc_role) end)::bigint as formatted_chars
from escaped group by conv_id
"""

MIXING = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('mix-1:' || coalesce(doc_id::varchar, '')) || md5(coalesce(text, '')) as h
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
    [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
  from sized group by source
), filled as (
  select *, coalesce(sum(2 * source_size) over w, 0) as below, coalesce(sum(weight) over w, 0) as weight_below,
    sum(weight) over () as all_weight, 1.5 * sum(source_size) over () as goal
  from sources
  window w as (order by 2 * source_size / weight, source rows between unbounded preceding and 1 preceding)
), levels as (
  select max((goal - below) / (all_weight - weight_below))
    filter (where 2 * source_size / weight >= (goal - below) / (all_weight - weight_below)) as level
  from filled
), targets as (
  select source, source_size, least(2.0 * source_size, weight * level)::double as target from filled, levels
), split as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from targets
), goals as (
  select *, round(target)::bigint - whole * source_size as extra from split
), tied as (
  select source, h, sum(size) as size, count(*) as n from sized group by source, h
), ordered as (
  select *, coalesce(sum(size) over (partition by source order by h rows between unbounded preceding and 1 preceding), 0) as start
  from tied
)
select d.doc_id, d.size::bigint as size, g.source_size, g.target,
  (g.whole * d.size + case when g.extra >= g.source_size or o.start + o.size <= g.extra then d.size
    when o.start <= g.extra then least(d.size, (g.extra - o.start) // o.n) else 0 end)::bigint as taken
from sized d
join ordered o on d.source is not distinct from o.source and d.h = o.h
join goals g on d.source is not distinct from g.source
"""

WARC = r"""
with payloads as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages
), firsts as (
  select html, max(page_id) as first from payloads where n >= 1000 group by html
)
select page_id, n::bigint as payload_bytes, sha1(html) as payload_digest,
  case when first <> page_id then 'revisit' else 'response' end as record_type,
  case when first <> page_id then first end as refers_to
from payloads left join firsts using (html)
"""


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


LICENSE_SCAN = rf"""
with files as (
  select doc_id, coalesce(source, 'none') || '/' || coalesce(lang, 'none') as base, doc_id // 64 as folder, text
  from documents
), placed as (
  select doc_id, text, base || case when doc_id % 4096 = 0 then '' else '/' || folder end as dir,
    case when doc_id % 4096 = 0 then '/LICENSE-' || doc_id when doc_id % 64 = 0 then '/LICENSE' else '/' || doc_id || '.txt' end as name
  from files
), texts as (
  select distinct dir || name as path, string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) as parts
  from placed
), numbered as (
  select path, unnest(generate_series(1, len(parts))) as place, parts from texts
), statements as (
  select distinct path, place, parts[place] as statement from numbered
), notes as (
  select * from (values {", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())}) t(license, note)
), note_terms as (
  select license, term, count(*) as tf
  from (select license, unnest(regexp_extract_all(lower(note), '[a-z0-9]+')) as term from notes)
  where term not in ({_listed(STOP_WORDS)}) group by all
), terms as (
  select path, place, statement, term, count(*) as tf
  from (select *, unnest(regexp_extract_all(lower(statement), '[a-z0-9]+')) as term from statements)
  where term not in ({_listed(STOP_WORDS)}) group by all
), near as (
  select distinct path, place, statement from terms where term in (select term from note_terms)
), tf as (
  select * from terms semi join near using (path, place, statement)
), df as (
  select term, count(*) as df from tf group by term
), size as (
  select count(*) as n from near
), vectors as (
  select path, place, statement, term, tf * (ln((1 + n) / (1 + df)) + 1) as weight from tf join df using (term), size
), note_vectors as (
  select license, term, tf * (ln((1 + n) / (1 + coalesce(df, 0))) + 1) as weight
  from note_terms left join df using (term), size
), norms as (
  select path, place, statement, sqrt(sum(weight * weight)) as norm from vectors group by all
), note_norms as (
  select license, sqrt(sum(weight * weight)) as norm from note_vectors group by all
), dots as (
  select path, place, statement, license, sum(v.weight * w.weight) as dot
  from vectors v join note_vectors w using (term) group by all
), cosines as (
  select path, license, round(dot / norms.norm / note_norms.norm, 9) as cosine
  from dots join norms using (path, place, statement) join note_norms using (license)
), own as (
  select path, license, cosine from cosines where cosine >= {MIN_COSINE}
  qualify row_number() over (partition by path order by cosine desc, license) = 1
), granted as (
  select dir, license from (select distinct dir, dir || name as path from placed where name like '/LICENSE%')
  join own using (path)
  qualify row_number() over (partition by dir order by cosine desc, license, path) = 1
), rows as (
  select doc_id, dir || name as path, dir, regexp_replace(dir, '/[0-9]+$', '') as above from placed
)
select doc_id, path, coalesce(o.license, g.license, a.license) as license,
  case when o.license is not null then 'stated' when coalesce(g.license, a.license) is not null then 'inherited' else 'none' end as origin,
  round(o.cosine, 6) as cosine,
  case when o.license is null then coalesce(g.dir, a.dir) end as inherited_from
from rows left join own o using (path) left join granted g on g.dir = rows.dir
  left join granted a on a.dir = rows.above and rows.above <> rows.dir
"""

COLLOCATIONS = r"""
with recursive docs as (
    select row_number() over () as d, coalesce(lang, 'und') as lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from docs
), worded as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), sizes as (
    select lang, sum(len(w))::bigint as n from worded group by lang
), grams as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase
    from worded, range(1, 6) as s(k), range(1, len(w) - k + 2) as p(i)
), counts as (
    select lang, k, phrase, count(*) as f from grams group by lang, k, phrase having count(*) >= 100
), cand as (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k >= 2
), cuts as (
    select c.lang, c.phrase, c.a, c.k as len, cut, l.f as l, r.f as r, n,
           (1000 * c.a::hugeint * n) // (l.f::hugeint * r.f) as score
    from cand c, range(1, c.k) as s(cut), counts l, counts r, sizes z
    where z.lang = c.lang and l.lang = c.lang and l.k = cut and l.phrase = array_to_string(c.w[1 : cut], ' ')
      and r.lang = c.lang and r.k = c.k - cut and r.phrase = array_to_string(c.w[cut + 1 : c.k], ' ')
), weakest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inside as (
    select c.lang, array_to_string(c.w[i : i + m - 1], ' ') as phrase, max(c.a) as longer
    from cand c, range(2, c.k) as s(m), range(1, c.k - m + 2) as p(i) group by 1, 2
), stays as (
    select w.* from weakest w left join inside i on i.lang = w.lang and i.phrase = w.phrase
    where i.longer is null or i.longer < w.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank,
       phrase, a, l, r, n, score::bigint as score
from stays qualify rank <= 2000
"""

FILTER_AUDIT = r"""
with docs as (
    select row_number() over () as row_id, doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
), worded as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs
), firsts as (
    select text as same, min(doc_id) as first_id from docs group by text
), flagged as (
    select d.row_id, d.part,
        len(w) < 50 as a,
        100 * len(list_distinct(w)) < 65 * len(w) as b,
        100 * (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g'))) > 5 * length(text) as c,
        regexp_matches(text, '[#$%&*|]') as d,
        coalesce(doc_id > first_id, false) as e,
        exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1) as good,
        exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1) as toxic
    from worded d join firsts on same = text
), fails as (
    select row_id, part, good, toxic,
        (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end)
        || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as failed
    from flagged
), patterns as (
    select part, failed, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
    from fails group by part, failed
), letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where b.x <> a.x and c.x not in (a.x, b.x) and d.x not in (a.x, b.x, c.x) and e.x not in (a.x, b.x, c.x, d.x)
), steps as (
    select filter_order, step, filter_order[step] as f, filter_order[1 : step - 1] as before
    from orders, range(1, 6) as s(step)
), parts as (select distinct part from docs),
counted as (
    select q.part, filter_order, step, f,
        coalesce(sum(n) filter (translate(failed, before || f, '') = failed), 0)::bigint as kept,
        coalesce(sum(n) filter (contains(failed, f) and translate(failed, before, '') = failed), 0)::bigint as removed,
        coalesce(sum(n) filter (contains(failed, f) and translate(failed, before, '') <> failed), 0)::bigint as redundant,
        coalesce(sum(n) filter (failed = f), 0)::bigint as unique_fails,
        coalesce(sum(n_good) filter (contains(failed, f) and translate(failed, before, '') = failed), 0)::bigint as good_lost,
        coalesce(sum(n_toxic) filter (contains(failed, f) and translate(failed, before, '') = failed), 0)::bigint as toxic_lost
    from parts q join patterns p on p.part = q.part, steps group by q.part, filter_order, step, f
)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) over (partition by part, f)::bigint as shapley
from counted
"""

NEAR_DEDUP = r"""
with recursive docs as (
    select row_number() over () as row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
), keyed as (
    select row_id, doc_id, w, md5(array_to_string(w, ' ')) as k from docs
), texts as (
    select k, any_value(w) as w, min(doc_id) as rep from keyed where len(w) > 0 group by k
), shingles as (
    select distinct k, hash(array_to_string(w[i : i + 3], ' '), len(w[i : i + 3])) as s
    from texts, range(1, greatest(len(w) - 3, 1) + 1) as p(i)
), sizes as (
    select k, count(*) as n from shingles group by k
), shared as (
    select a.k as a, b.k as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.k < b.k group by all
), links as (
    select a, b from shared join sizes x on x.k = a join sizes y on y.k = b where 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), ways as (
    select a, b from links union all select b, a from links
), reach as (
    select a, b from ways
    union
    select r.a, w.b from reach r join ways w on w.a = r.b
), least_of as (
    select t.k, least(min(t.rep), min(o.rep)) as component_id
    from texts t left join reach r on r.a = t.k left join texts o on o.k = r.b group by t.k
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, doc_id) as component_id,
    doc_id is not distinct from coalesce(component_id, doc_id) as kept
from keyed left join sizes using (k) left join least_of using (k)
"""

ORACLES = {
    "op4_quality_rules": QUALITY_RULES,
    "op5_license_scan": LICENSE_SCAN,
    "op7_chat_formatting": CHAT_FORMATTING,
    "op9_warc": WARC,
    "op10_mixing": MIXING,
    "op11_near_dedup": NEAR_DEDUP,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_collocations": COLLOCATIONS,
}
