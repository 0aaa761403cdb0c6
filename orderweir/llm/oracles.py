"""DuckDB SQL for the dealt operators that SQL can express.

The others are fitted models, sketches or graph searches; tests hold them against brute force.
"""

from __future__ import annotations

# The remainders of the sixteen half-bytes for the CRC-32 polynomial 0xEDB88320.
CRC_NIBBLES = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384,"
    " 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)

#: Unsigned CRC-32 of the column t: half-bytes, the low one of each byte first, are taken in one by one.
CRC32 = f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, 2 * strlen(t) + 1),
  lambda k: strpos('123456789ABCDEF', h[k + if(k % 2 = 1, 1, -1)])::BIGINT)),
  lambda c, x: xor(c >> 4, ({CRC_NIBBLES})[((xor(c, x)) & 15) + 1])))"""

RANKED = """
measured as (
  select doc_id, source, coalesce('=' || source, '') as s, coalesce(text, '') as t,
    string_split(hex(encode(coalesce(text, ''))), '') as h from documents),
summed as (select doc_id, source, s, strlen(t) + 8 as size, {crc} as text_crc32 from measured),
ranked as (
  select *, ('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || text_crc32::VARCHAR), 1, 15))::BIGINT as x
  from summed),
placed as (
  select *, row_number() over (partition by s order by x, doc_id, text_crc32) as r,
    count(*) over (partition by s) as n from ranked)"""

SHARDS = (
    "with "
    + RANKED.format(crc=CRC32, seed="shards")
    + """,
spread as (
  select *, (r - (('0x' || substr(md5('shards|' || s), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / n as f
  from placed),
positions as (
  select *, row_number() over (order by f, s, x, doc_id, text_crc32) - 1 as p, count(*) over () as total from spread)
select doc_id, size, text_crc32, 'rows' as law, (p * 24 // total)::INT as shard,
  p - ((p * 24 // total) * total + 23) // 24 as slot, null::INT as grown_shard
from positions"""
)

#: Slot by slot from the first to the last: of the blocks released by now, the one due first. When the first source's share
#: reaches its last block, what is left of such sources follows, and the others go on as if they started there.
MIX = (
    "with recursive "
    + RANKED.format(crc=CRC32, seed="mix")
    + """,
strata as (
  select list(s order by s) as names, list(a order by s) as a, list(m order by s) as m from (
    select s, greatest(floor(sqrt(count(*)::DOUBLE) * 1000)::BIGINT, 1) as a, (count(*) + 63) // 64 as m from ranked group by s)),
walk as (
  select -1::BIGINT as slot, 0::BIGINT as t, list_transform(m, lambda x: 0::BIGINT) as done,
    list_transform(m, lambda x: 0::BIGINT) as before, null::BIGINT as i, null::BIGINT as j from strata
  union all
  select slot + 1, if(over, 0, t + 1), after, if(over, after, before), i, done[i] from (
    select *, t + 1 >= span and len(list_filter(ending, lambda k: after[k] < m[k])) = 0 as over from (
      select *, list_transform(done, lambda x, k: x + (k = i)::INT) as after from (
        select *, case when t < span then list_min(list_transform(
            list_filter(active, lambda k: done[k] < m[k] and ((done[k] - before[k]) * w) // a[k] <= t),
            lambda k: {'due': ((done[k] - before[k] + 1) * w + a[k] - 1) // a[k], 'k': k})).k
          else list_min(list_filter(ending, lambda k: done[k] < m[k])) end as i from (
          select *, list_filter(active, lambda k: ((m[k] - before[k]) * w) // a[k] = span) as ending from (
            select *, list_min(list_transform(active, lambda k: ((m[k] - before[k]) * w) // a[k])) as span from (
              select *, list_sum(list_transform(active, lambda k: a[k]))::BIGINT as w from (
                select slot, t, done, before, a, m, list_filter(range(1, len(m) + 1), lambda k: before[k] < m[k]) as active
                from walk, strata) where len(active) > 0)))))))
select doc_id, source, slot as mix_block, ((r - 1) % 64)::INT as mix_row
from placed join (select names[i] as s, j, slot from walk, strata where i is not null) using (s) where j = (r - 1) // 64"""
)

#: Components of the undirected links (a, b): smallest id that each one reaches.
REACHED = """
both_ways as (select a, b from links union select b, a from links),
reach(id, other) as (
  select a, b from both_ways
  union
  select reach.id, both_ways.b from reach join both_ways on reach.other = both_ways.a),
comps as (select id, least(id, min(other)) as comp from reach group by id)"""

NEAR = f"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as w from documents),
runs as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) as g
  from words where len(w) > 0),
sizes as (select doc_id, count(*) as n from runs group by doc_id),
links as (
  select a, b from (
    select x.doc_id as a, y.doc_id as b, count(*) as c from runs x join runs y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2)
  join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 100 * c >= 75 * (p.n + q.n - c)),
{REACHED}
select w.doc_id, coalesce(n, 0) as n_shingles, coalesce(comp, w.doc_id) as component_id, coalesce(comp, w.doc_id) = w.doc_id as kept
from words w left join sizes using (doc_id) left join comps on comps.id = w.doc_id"""

LINES = f"""
with recursive occ as (
  select doc_id, line_no, line, length(line) as n from (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 as line_no from documents)
  where length(line) > 0),
texts as (select row_number() over (order by line) as id, line, n from (select distinct line, n from occ)),
links as (
  select x.id as a, y.id as b from texts x join texts y on x.id < y.id and x.n >= 20 and y.n between x.n - 2 and x.n + 2 and y.n >= 20
  where levenshtein(x.line, y.line) <= case when least(x.n, y.n) >= 40 then 2 else 1 end),
{REACHED},
counts as (select a as id, count(*) as n_links from both_ways group by a),
classed as (
  select doc_id, line_no, occ.n, coalesce(comp, texts.id) as class, coalesce(n_links, 0) as n_links
  from occ join texts using (line) left join comps on comps.id = texts.id left join counts on counts.id = texts.id),
firsts as (select *, min({{'d': doc_id, 'l': line_no}}) over (partition by class) as f from classed)
select doc_id, line_no::INT as line_no, n::INT as n_chars, f.d as class_doc, f.l::INT as class_line, n_links,
  doc_id = f.d and line_no = f.l as kept from firsts"""

#: Lloyd's rounds written out one after another; every distance is computed.
ROUND = """
near{i} as materialized (
  select r, min({{'d': list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - c.v[i]) ** 2))::BIGINT, 'k': c.k}}) as best
  from kept, centroids{i} c group by r),
moved{i} as (
  select k, list(x order by i) as v from (
    select best.k as k, i, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT as x
    from (select r, unnest(v) as x, generate_subscripts(v, 1) as i from kept) join near{i} using (r) group by 1, 2) group by k),
centroids{j} as materialized (select c.k, coalesce(m.v, c.v) as v from centroids{i} c left join moved{i} m using (k)),"""

CLUSTERS = (
    """
with kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) as v
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: isfinite(x))) = 64),
centroids0 as materialized (
  select (row_number() over (order by h, v) - 1)::INT as k, v from (
    select sha256('3:' || vec_id::VARCHAR) as h, v from kept where vec_id is not null order by h, v limit 8)),"""
    + "".join(ROUND.format(i=i, j=i + 1) for i in range(11))
    + """
placed as (select vec_id, best.k as cluster, best.d as distance from kept join near10 using (r))
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::BIGINT as cluster_inertia,
  (sum(distance) over ())::BIGINT as inertia, sha256(array_to_string(v, ',')) as centroid_sha256
from placed join centroids10 on k = cluster"""
)

MIDDLE = """
with drawn as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) as h,
    list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]'), lambda x: length(x)) as ends from documents),
numbers as (
  select *, len(ends)::BIGINT as n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) as d from drawn),
cuts as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as one, greatest(d[1] % (n + 1), d[2] % (n + 1)) as two,
    case when n = 0 or t like '%<P>%' or t like '%<S>%' or t like '%<M>%' or d[3] % 100 >= 90 then 'plain'
      when d[4] % 100 < 20 then 'spm' else 'psm' end as form from numbers),
parts as (
  select *, coalesce(list_sum(ends[1:one]), 0)::BIGINT as low, coalesce(list_sum(ends[1:two]), 0)::BIGINT as high from cuts),
texts as (
  select *, substr(t, 1, low) as prefix, substr(t, low + 1, high - low) as middle, substr(t, high + 1) as suffix from parts)
select doc_id, n, form, case when form <> 'plain' then low end as prefix_chars,
  case when form <> 'plain' then high - low end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256, sha256(t) as restored_sha256
from texts"""

CHAT = r"""
with recursive turns as (
  select conv_id, turn, role, text from conversations
  union all select -7, i, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) as v(i, r)),
written as (
  select conv_id, coalesce('=' || conv_id::VARCHAR, '') as c, turn, coalesce(role, '') as role, coalesce(text, '') as t,
    '<|im_start|>' || coalesce(role, '') || chr(10) || regexp_replace(coalesce(text, ''),
      '([<\[])(\\*)((?:\|[A-Za-z0-9_]+\|>)|(?:/?s>)|(?:</?SYS>>)|(?:/?INST\]))', '\1\\\2\3', 'g') || '<|im_end|>' || chr(10) as piece,
    len(regexp_extract_all(coalesce(text, ''), ' ?[A-Za-z]+| ?[0-9]+|[^A-Za-z0-9]')) + 8 as tokens from turns),
placed as (
  select *, length(piece) as chars, row_number() over w as i, sum(tokens) over w - tokens as p_before, sum(tokens) over w as p_end
  from written window w as (partition by c order by turn nulls last, piece)),
tops as (select c, (role = 'system' and tokens <= 128)::INT as s, if(role = 'system' and tokens <= 128, tokens, 0) as s_tokens, chars from placed where i = 1),
walk as (
  select p.c, i, i as f, p_before as base from placed p join tops on tops.c = p.c where i = s + 1
  union all
  select w.c, p.i, if(p.p_end - w.base > 384 - s_tokens, p.i, w.f), if(p.p_end - w.base > 384 - s_tokens, p.p_before, w.base)
  from walk w join placed p on p.c = w.c and p.i = w.i + 1 join tops on tops.c = w.c),
spans as (select c, f, min(base) as base from walk group by c, f),
repeated as (
  select sp.c, sum(coalesce(h.chars, 0)) as chars from spans sp join tops t on t.c = sp.c
  join placed h on h.c = sp.c and h.i > t.s and h.i < sp.f and sp.base - h.p_before <= 128 group by sp.c),
heads as (select sp.c, greatest(count(*) - 1, 0) * any_value(if(s = 1, t.chars, 0)) as chars from spans sp join tops t on t.c = sp.c group by sp.c),
sums as (
  select c, any_value(conv_id) as conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' order by i)) as turns_sha256,
    coalesce(sum(length(t)) filter (role = 'assistant'), 0)::BIGINT as loss_chars,
    sha256(coalesce(string_agg(t, '' order by i) filter (role = 'assistant'), '')) as loss_sha256, sum(chars) as chars from placed group by c)
select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
  (sums.chars + coalesce(repeated.chars, 0) + coalesce(heads.chars, 0))::BIGINT as formatted_chars
from sums left join repeated using (c) left join heads using (c)"""

ORACLES: dict[str, str] = {
    "op1_pfair_mix": MIX,
    "op8_odd_sketch_dedup": NEAR,
    "op9_stratified_shards": SHARDS,
    "op10_line_edit_dedup": LINES,
    "op11_orchard_clusters": CLUSTERS,
    "op12_fill_in_middle": MIDDLE,
    "op13_budgeted_chat": CHAT,
}
