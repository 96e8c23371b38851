"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from rootwise.llm.licenses import BASE, SENTENCES

_WORDS = r"""regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), 'ÿ')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _template_rows() -> str:
    """The fixed texts as rows; where a phrase begins is for the SQL to find."""
    texts = [(label, phrase, phrase, True) for phrase, label in BASE.items()]
    texts += [(label, text, phrase, False) for label, text, phrase in SENTENCES]
    return ",\n    ".join(
        f"('{label}', {text.split()}, {phrase.split()}, {str(base).lower()})" for label, text, phrase, base in texts
    )


def license_sql() -> str:
    return f"""
with split as (select doc_id, {_WORDS} as w from documents),
texts(label, phrase, key, base) as (values
    {_template_rows()}),
templates as (
    select *, list_filter(range(1, len(phrase) + 1), lambda i: phrase[i:i + len(key) - 1] = key)[1] - 1 as key_at
    from texts),
vocabulary as (select distinct unnest(phrase) as word from templates),
df as (
    select word, count(*) as n from (select unnest(list_distinct(w)) as word from split)
    where word in (select word from vocabulary) group by word),
rarity as (
    select v.word, ln((1 + (select count(*) from split)) / (1 + coalesce(df.n, 0))) + 1 as r
    from vocabulary v left join df using (word)),
weighted as (
    select t.label, t.base, u.k, t.phrase[u.k] as word, r.r / sum(r.r) over (partition by t.label, t.base) as weight
    from templates t, unnest(range(1, len(t.phrase) + 1)) as u(k), rarity r where r.word = t.phrase[u.k]),
starts as (
    select doc_id, w, label, base, key_at,
        unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] = key[1] and w[i:i + len(key) - 1] = key)) - key_at as start
    from split, templates where list_has_all(w, key)),
shares as (
    select s.doc_id, s.label, s.base, s.start, sum(case when s.w[s.start - 1 + x.k] = x.word then x.weight else 0 end) as share
    from starts s join weighted x on s.label = x.label and s.base = x.base
    where s.start >= 1 group by all),
places as (select * from shares where base or share >= 0.7),
found as (
    select doc_id, count(*) filter (base) as n_base, min(start - 1) filter (base) as first_word,
        max(start - 1) filter (base) as last_word,
        string_agg(distinct label, ',' order by label) filter (base) as base_labels,
        string_agg(distinct label, ',' order by label) as labels, max(least(1, share)) as score
    from places group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
    round(coalesce(score, 0), 6)::double as score
from split left join found using (doc_id)
"""


SHARDING_SQL = """
with recursive steps(i, n, c) as (
    select r, 0, r from range(256) as x(r) union all
    select i, n + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where n < 8),
crc as (select list(c order by i) as t from steps where n = 8),
rows as (select doc_id, coalesce(text, '') as text, strlen(coalesce(text, '')) + 16 as size from documents),
bytes as (
    select doc_id, size, list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)) as b from rows),
sums as (
    select doc_id, size, xor(4294967295, list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) as text_crc32
    from bytes, crc),
ordered as (
    select *, sum(size) over (order by doc_id) as upto, sum(size) over () as everything,
        row_number() over (order by doc_id) as nth from sums),
placed as (select *, ((2 * upto - size) * 40 // (2 * everything))::int as shard from ordered)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'bytes' as law, shard,
    nth - min(nth) over (partition by shard) as slot, null::int as grown_shard
from placed
"""

EXACT_DEDUP_SQL = r"""
with texts as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = min(doc_id) over same as kept, text_sha256
from texts window same as (partition by text_sha256)
"""

DECONTAMINATION_SQL = r"""
with items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null),
windows as (
    select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as phrase
    from items, unnest(range(1, greatest(1, len(w) - 12) + 1)) as u(i) where len(w) > 0),
lengths as (select distinct n from windows),
docs as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
places as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, lengths),
hits as (
    select p.doc_id, p.i, p.n, x.item_id
    from (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as phrase from places) p join windows x using (n, phrase)),
covered as (
    select doc_id, count(distinct k) as n_hit
    from (select distinct doc_id, i, n from hits) h, unnest(range(i, i + n)) as u(k) group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct doc_id, item_id::varchar as item_id from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join covered using (doc_id) left join named using (doc_id)
"""

WARC_SQL = """
with texts as (
    select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (
    select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first
    from texts)
select page_id, payload_bytes, payload_digest,
    case when page_id > first then 'revisit' else 'response' end as record_type,
    case when page_id > first then first end as refers_to
from firsts
"""

JACCARD_SQL = r"""
with recursive split as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents),
sets as (
    select distinct doc_id, array_to_string(w[i:i + 2], ' ') as shingle
    from split, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as u(i) where len(w) > 0),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from sets x join sets y on x.shingle = y.shingle and x.doc_id < y.doc_id group by x.doc_id, y.doc_id),
links as (
    select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
    where 100 * common >= 90 * (p.n + q.n - common)),
ways as (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
    select a, b from ways union select r.doc_id, w.b from reached r join ways w on w.a = r.other)
select s.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, least(s.doc_id, coalesce(min(other), s.doc_id)) as component_id
from split s left join sizes z on z.doc_id = s.doc_id left join reached r on r.doc_id = s.doc_id group by s.doc_id
"""

LINE_DEDUP_SQL = r"""
with split as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as nth
    from documents),
keyed as (
    select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from split),
common as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(common.key) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by nth) filter (common.key is null), '')) as kept_sha256
from keyed left join common using (key) group by doc_id
"""

COLLOCATION_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
grams as (
    select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, m, count(*) as a
    from split, unnest([1, 2, 3]) as s(m), unnest(range(1, len(w) - m + 2)) as u(i) group by all),
totals as (select lang, sum(len(w)) as n from split group by lang),
candidates as (select lang, phrase, m, a, string_split(phrase, ' ') as w from grams where m >= 2 and a >= 10),
cuts as (
    select c.lang, c.phrase, c.a, k, p.a as l, q.a as r, (1000000::hugeint * c.a * c.a) // (p.a::hugeint * q.a) as score
    from (select *, unnest(range(1, m)) as k from candidates) c
    join grams p on p.lang = c.lang and p.phrase = array_to_string(c.w[1:k], ' ')
    join grams q on q.lang = c.lang and q.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a from candidates where m = 3),
holders as (select lang, phrase, max(a) as longer from inside group by all),
kept as (
    select x.* from weakest x left join holders h on h.lang = x.lang and h.phrase = x.phrase
    where longer is null or 100 * longer < 50 * x.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
    n::bigint as n, score::bigint as score
from kept join totals using (lang) qualify rank <= 2000
"""

CONVERSATION_SQL = r"""
with recursive steps(i, n, c) as (
    select r, 0, r from range(256) as x(r) union all
    select i, n + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where n < 8),
crc as (select list(c order by i) as t from steps where n = 8),
named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        regexp_extract_all(hex(encode(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))), '..') as digits
    from conversations),
marked as (
    select conv_id, turn, role, text, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(digits, lambda x: ('0x' || x)::bigint)),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) % 20 as kind
    from named, crc),
turns as (
    select conv_id, turn, case kind when 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from marked, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end))),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as nth from turns),
seen as (
    select *, row_number() over (partition by conv_id, role, text order by nth) > 1 as again,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') as body, lag(role) over (partition by conv_id order by nth) as before
    from placed),
faulty as (
    select *, case when body = '' then 1 when again then 2 when right(body, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
        before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au') as illegal from seen),
rules(p, q, symbol) as (values (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (2, 3, 'a'), (3, 2, 'u')),
inserts(p, q, cost, edits, more) as (
    select s, s, 0, '', '' from range(4) as x(s) union all
    select i.p, r.q, i.cost + 5, i.edits || 'I', i.more || case r.symbol when 'u' then chr(10) || 'user:' else chr(10) || 'assistant:' end
    from inserts i join rules r on r.p = i.q where r.symbol <> 's' and i.cost < 15),
edits as (
    select conv_id, nth, s as p, s as q, 2 as cost, 'D' as edit, '' as made from faulty, range(4) as x(s) union all
    select conv_id, nth, p, q, (case when fault = 3 then 5 else 0 end) + (case when symbol = left(role, 1) then 0 else 1 end),
        case when symbol = left(role, 1) then 'K' else 'R' end,
        chr(10) || case when symbol = left(role, 1) then role when symbol = 'u' then 'user' else 'assistant' end || ':' || text
    from faulty, rules where fault not in (1, 2) and (symbol = left(role, 1) or symbol <> 's')),
moves as (
    select e.conv_id, e.nth, i.p, e.q, i.cost + e.cost as cost, i.edits || e.edit as edit, i.more || e.made as made
    from edits e join inserts i on i.q = e.p),
ways(conv_id, nth, state, best) as (
    select conv_id, 0::bigint, 0::bigint, {'cost': 0, 'audit': '', 'made': ''} from (select distinct conv_id from turns) union all
    select w.conv_id, m.nth, m.q, min({'cost': w.best.cost + m.cost, 'audit': w.best.audit || m.edit, 'made': w.best.made || m.made})
    from ways w join moves m on m.conv_id is not distinct from w.conv_id and m.nth = w.nth + 1 and m.p = w.state
    group by w.conv_id, m.nth, m.q),
lengths as (select conv_id, count(*) as size from turns group by conv_id),
finished as (
    select w.conv_id, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.edits, 'made': w.best.made || i.more}) as best
    from ways w join lengths l on l.conv_id is not distinct from w.conv_id and l.size = w.nth
    join inserts i on i.p = w.state and i.q in (0, 3) group by w.conv_id),
counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
        count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated, count(*) filter (illegal) as illegal
    from faulty group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
    coalesce(best.audit, '') as audit, sha256(coalesce(substr(best.made, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join finished f on f.conv_id is not distinct from o.conv_id
"""

OPERATOR_ORACLES = {
    "op11_conversation_repair": CONVERSATION_SQL,
    "op12_line_dedup": LINE_DEDUP_SQL,
    "op13_collocations": COLLOCATION_SQL,
    "op3_jaccard_join": JACCARD_SQL,
    "op1_decontaminate": DECONTAMINATION_SQL,
    "op2_license_scan": license_sql(),
    "op4_balanced_shards": SHARDING_SQL,
    "op7_warc": WARC_SQL,
    "op9_exact_dedup": EXACT_DEDUP_SQL,
}
