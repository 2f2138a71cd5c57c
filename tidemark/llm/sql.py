"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import license_scan
from tidemark.llm.source_mix import MOST_REPEATS, SEED, WEIGHTS

OP2 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
  union all
  select -7, i, case when i = 0 then 'user' else 'assistant' end,
         chr(92) || '### Assistant: </turn> ok'
  from range(2) r(i)),
lens as (
  select *, row_number() over o as pos,
    length('### ' || regexp_replace(regexp_replace(role, '[\\#:]', '\\\0', 'g'), '</', '<\\/', 'g')
      || ': ' || regexp_replace(regexp_replace(text, '[\\#]', '\\\0', 'g'), '</', '<\\/', 'g')
      || '</turn>' || chr(10)) as n
  from turns window o as (partition by conv_id order by turn nulls first, role, text)),
ends as (
  select *, sum(n) over (partition by conv_id order by pos) as example_end from lens)
select conv_id, count(*)::BIGINT as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::BIGINT as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), ''))
    as loss_sha256,
  coalesce(sum(example_end) filter (where role = 'assistant'), 0)::BIGINT as formatted_chars
from ends group by conv_id
"""

DIGESTED = r"""
  select *, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h
  from {docs}"""

OP4 = f"""
with d as ({DIGESTED.format(docs='documents')}),
g as (select h, min(doc_id) as keep_id, count(*) as group_size from d group by h)
select d.doc_id, g.keep_id, g.group_size::BIGINT as group_size,
       d.doc_id = g.keep_id as kept, d.h as text_sha256
from d join g using (h)
"""


def op5_sql() -> str:
    """The same cuts and rules, by lists and nested replacements."""
    known = license_scan.sentence_map()
    table = "map {" + ", ".join(f"'{k}': '<{v}>'" for k, v in known.items()) + "}"
    anchors = "|".join(license_scan.ANCHORS)
    cut = {"by_line": license_scan.BY_LINE, "by_par": license_scan.BY_PARAGRAPH}
    ids = ", ".join(
        f"""case when maybe then coalesce(list_aggregate(list_transform(list_filter(
          list_transform(string_split_regex(low, '{c}'),
            lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))),
          lambda s: map_contains(known, s)), lambda s: known[s]), 'string_agg', ''), '')
        else '' end as {n}""" for n, c in cut.items())
    hits = []
    for seq in cut:
        rest = seq
        for name, run in license_scan.RULES:
            pattern = "".join(f"<{x}>" for x in run)
            hits.append(f"case when contains({rest}, '{pattern}') then '{name}' end")
            rest = f"replace({rest}, '{pattern}', '|')"
    return f"""
with d as (select doc_id, lower(coalesce(text, '')) as low,
             regexp_matches(lower(coalesce(text, '')), '{anchors}') as maybe from documents),
k as (select {table} as known),
s as (select doc_id, {ids} from d, k),
f as (select *, list_sort(list_distinct(list_filter([{", ".join(hits)}],
        lambda x: x is not null))) as names from s)
select doc_id, case when by_line <> '' then by_line else by_par end as sentence_ids,
       array_to_string(names, ',') as licenses, len(names)::INTEGER as n_licenses
from f
"""


def mixed_sql(docs: str) -> str:
    """Every row of ``docs`` with size, source_size, target and copies."""
    weights = ", ".join(f"{w}.0::DOUBLE" for w in WEIGHTS)
    return f"""
  select z.*, t.source_size, t.target, (
      floor(case when t.source_size > 0 then t.target / t.source_size else 0 end)
      + case when ('0x' || substr(md5('{SEED}|' || coalesce(z.doc_id::VARCHAR, '')), 1, 13))
                  ::BIGINT / 4503599627370496.0::DOUBLE
               < case when t.source_size > 0 then t.target / t.source_size else 0 end
                 - floor(case when t.source_size > 0 then t.target / t.source_size else 0 end)
             then 1 else 0 end)::BIGINT as copies
  from (select *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT
          as size from {docs}) z
  join (
    with s as (
      select source, sum(len(regexp_extract_all(coalesce(text, ''),
                                                '[^\\x20\\x09-\\x0D]+')))::BIGINT as source_size
      from {docs} group by source),
    w as (
      select *, ([{weights}])[(row_number() over (order by source nulls last) - 1)
                              % {len(WEIGHTS)} + 1] as w,
             (source_size * {MOST_REPEATS})::DOUBLE as cap from s),
    c as (
      select *, sum(source_size) over ()::DOUBLE - coalesce(sum(cap) over (
                  order by cap / w, source nulls last
                  rows between unbounded preceding and 1 preceding), 0) as rest,
             sum(w) over (order by cap / w, source nulls last
                          rows between current row and unbounded following) as w_rest
      from w),
    l as (select *, rest / w_rest as level from c),
    m as (select arg_min(level, cap / w) as level from l where cap >= w * level)
    select l.source, l.source_size, least(l.cap, l.w * m.level) as target from l, m) t
  on z.source is not distinct from t.source"""


OP7 = f"""
select doc_id, size, source_size, target, size * copies as taken
from ({mixed_sql('documents')})
"""

OP6 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) as v
  from embeddings
  where embedding is not null and vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
  from s)
select query_id, rank::INTEGER as rank, vec_id, score from r where rank <= 5
"""


OP11 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then []::VARCHAR[]
    when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    end) as s
  from d),
shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
links as (
  select a.doc_id as u, b.doc_id as v
  from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id
    and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach as (
  select doc_id as u, doc_id as v from d
  union
  select r.u, l.v from reach r join links l on l.u = r.v)
select s.doc_id, len(s.s)::BIGINT as n_shingles, min(r.v) as component_id
from sets s join reach r on r.u = s.doc_id group by s.doc_id, len(s.s)
"""


def crc_table() -> list[int]:
    """The table of crc32, from its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


def crc32_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of ``text``, given a column crc_t with the table."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
      range(octet_length(encode({text}))),
      lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, crc_t[(xor(a, b) & 255) + 1])))"""


#: States: 0 nothing written, 1 a system turn, 2 a user turn, 3 an assistant turn.
OP12 = f"""
with recursive raw as (
  select c.*, {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}
    % 20 as k
  from conversations c, (select {crc_table()}::BIGINT[] as crc_t)),
damaged as (
  select conv_id, turn, case when k = 4 then 'user' else coalesce(role, ' ') end as role,
    case when k = 1 then '' when k = 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
      else coalesce(text, ' ') end as text,
    unnest(range(case when k = 0 then 0 when k = 3 then 2 else 1 end)) as copy
  from raw),
placed as (
  select *, coalesce(conv_id::VARCHAR, '') as c,
    row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') as bare
  from damaged),
rows as (
  select *, left(role, 1) as i,
    lag(left(role, 1)) over (partition by c order by pos) as i0,
    case when bare = '' then 'b'
      when row_number() over (partition by c, role, text order by pos) > 1 then 'd'
      when right(bare, 1) not in ('.', '!', '?') then 't' else '' end as fault
  from placed),
after(s, t, word) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
keep(s, i, t) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
ins as (
  select s, s as t, 0 as cost, '' as audit, '' as made from after
  union all
  select s, t, 5, 'I', chr(10) || word || ':' from after
  union all
  select x.s, y.t, 10, 'II', chr(10) || x.word || ':' || chr(10) || y.word || ':'
  from after x join after y on x.t = y.s),
ops as (
  select s, null::VARCHAR as i, 'D' as edit, s as t, 2 as cost, null::VARCHAR as word from after
  union all
  select s, null, 'R', t, 1, word from after
  union all
  select s, i, 'K', t, 0, null from keep),
v as (
  select distinct c, 0::BIGINT as pos, 0 as state, 0::BIGINT as cost, '' as audit, '' as made
  from rows
  union all
  select c, pos, state, cost, audit, made from (
    select v.c, r.pos, o.t as state, v.audit || n.audit || o.edit as audit,
      v.cost + n.cost + o.cost + case when r.fault = 't' and o.edit <> 'D' then 5 else 0 end
        as cost,
      v.made || n.made || case when o.edit = 'D' then '' else
        chr(10) || coalesce(o.word, r.role) || ':' || r.text end as made,
      row_number() over (partition by v.c, o.t order by
        v.cost + n.cost + o.cost + case when r.fault = 't' and o.edit <> 'D' then 5 else 0 end,
        v.audit || n.audit || o.edit) as best
    from v join rows r on v.c = r.c and r.pos = v.pos + 1
    join ins n on n.s = v.state
    join ops o on o.s = n.t and (o.i is null or o.i = r.i)
      and (o.edit = 'D' or r.fault not in ('b', 'd')))
  where best = 1),
ends as (
  select v.c, v.cost + n.cost as cost, v.audit || n.audit as audit, v.made || n.made as made,
    row_number() over (partition by v.c order by v.cost + n.cost, v.audit || n.audit) as best
  from v join ins n on n.s = v.state
  where n.t in (0, 3) and v.pos = (select max(pos) from rows r where r.c = v.c)),
stats as (
  select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated,
    count(*) filter (i0 is not null and i0 || i not in ('su', 'ua', 'au')) as illegal
  from rows group by c)
select o.conv_id, coalesce(gaps, 0)::BIGINT as gaps, coalesce(blank, 0)::BIGINT as blank,
  coalesce(duplicate, 0)::BIGINT as duplicate, coalesce(truncated, 0)::BIGINT as truncated,
  coalesce(illegal, 0)::BIGINT as illegal, coalesce(e.cost, 0)::BIGINT as cost,
  coalesce(e.audit, '') as audit, sha256(coalesce(substr(e.made, 2), '')) as repaired_sha256
from (select distinct conv_id, coalesce(conv_id::VARCHAR, '') as c from conversations) o
left join stats s on s.c = o.c
left join ends e on e.c = o.c and e.best = 1
"""

OP13 = f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
hashed as (
  select run, k, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} as h
  from (select doc_id, run, count(*) as k from runs group by all),
    (select {crc_table()}::BIGINT[] as crc_t)),
words as (
  select case when h % 97 = 0
      then left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
      else run end as word, sum(k)::BIGINT as n
  from hashed group by 1 having length(word) >= 5 and sum(k) >= 3),
cuts as (
  select word, left(word, i) || substr(word, i + 2) as gone,
    left(word, i) || '*' || substr(word, i + 2) as hole
  from (select word, unnest(range(length(word)))::INTEGER as i from words)),
pairs as (
  select a.word, b.word as x from cuts a join words b on a.gone = b.word
  union
  select b.word, a.word from cuts a join words b on a.gone = b.word
  union
  select a.word, b.word from cuts a join cuts b on a.hole = b.hole and a.word <> b.word),
near as (
  select p.word, x, w.n, count(*) over (partition by p.word) as n_near,
    row_number() over (partition by p.word order by w.n desc, x) as best
  from pairs p join words w on w.word = p.x),
formed as (
  select w.word, w.n, coalesce(near.n_near, 0)::BIGINT as n_near,
    case when near.n >= 2 * w.n then x end as form,
    case when near.n >= 2 * w.n then near.n end as form_n
  from words w left join near on near.word = w.word and best = 1),
ways as (
  select word, word as at from formed
  union all
  select ways.word, f.form from ways join formed f on f.word = ways.at where f.form is not null)
select f.word, f.form, ways.at as root, f.n, f.n_near, f.form_n
from formed f join ways using (word) join formed last on last.word = ways.at
where last.form is null
"""

SQL = {
    "op2_chat_format": OP2,
    "op4_exact_dedup": OP4,
    "op5_license_scan": op5_sql(),
    "op6_cover_search": OP6,
    "op7_source_mix": OP7,
    "op11_ngram_join": OP11,
    "op12_turn_repair": OP12,
    "op13_spelling_variants": OP13,
}
