"""The result of a query as DuckDB SQL, where SQL can express it."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rest(url: str) -> str:
    return f"coalesce(case when instr({url}, '://') > 0 then substr({url}, instr({url}, '://') + 3) end, '')"


def _address(url: str) -> str:
    host = f"translate(regexp_extract({_rest(url)}, '^[^/?#]*'), {_AZ})"
    return f"case when {host} <> '' then {host} || regexp_extract({_rest(url)}, '^[^/?#]*([^#]*)', 1) end"


ORACLES["op2_url_filter"] = rf"""
with recursive rules(host, path, rule, verdict) as (
  values ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
         ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
rows as (
  select row_number() over () as row_no, page_id, html, url, {_rest("url")} as rest, {_address("url")} as address from pages),
split as (
  select *, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rows),
targets as (
  select url, address, regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as target
  from (select url, address, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) as tag from rows)
  where regexp_matches(tag, '(?i)\brel\s*=\s*["'']?canonical\b')
  union all
  select url, address, regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
  from (select url, address, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) as tag from rows)
  where regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')),
whole as (
  select address as a, case when target like '//%' then 'http:' || target
    when target like '/%' then 'http://' || split_part(address, '/', 1) || target else target end as b from targets),
edges as (select a, b from (select a, {_address("b")} as b from whole) where a is not null and b is not null and a <> b),
both_ways as (select a, b from edges union select b, a from edges),
reached(node, other) as (
  select a, a from both_ways union select r.node, e.b from reached r join both_ways e on e.a = r.other),
places as (
  select host, path, null as address, row_no from split
  union all
  select split_part(node, '/', 1), regexp_extract(node, '^[^/?#]*([^?#]*)', 1), node, null
  from (select distinct node from reached)),
judged as (
  select p.address, p.row_no, r.rule, r.verdict,
         row_number() over (partition by p.address, p.row_no
                            order by length(r.rule) desc, r.verdict = 'allow' desc, r.rule desc) as best
  from places p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)),
own as (select row_no, rule, verdict from judged where best = 1 and row_no is not null),
shared as (
  select c.node, case when bool_or(j.verdict = 'allow') then 'allow' when bool_or(j.verdict = 'block') then 'block' end as verdict
  from reached c join judged j on j.address = c.other and j.best = 1 group by c.node)
select s.page_id, s.host, s.path, o.rule, coalesce(o.verdict, h.verdict, 'allow') as verdict,
       o.verdict is null and h.verdict is not null as by_alias
from split s left join own o using (row_no) left join shared h on h.node = s.address
"""


def _choice(count: int, name: str) -> str:
    """The shard among ``count`` of every key, level by level."""
    return f"""
{name}_tree as (
  select i as number, i // 10 as region, i % 10 // 2 as rack from range({count}) t(i)),
{name}_levels as (
  select '' as path, region as child, count(*)::double as weight from {name}_tree group by region
  union all select region::varchar, rack, count(*) from {name}_tree group by region, rack
  union all select region || '.' || rack, number, count(*) from {name}_tree group by region, rack, number),
{name}_region as (
  select key, arg_min(child, -ln({_draw("key", "path || '.' || child")}) / weight)::varchar as path
  from keys, {name}_levels where path = '' group by key),
{name}_rack as (
  select r.key, r.path || '.' || arg_min(l.child, -ln({_draw("r.key", "l.path || '.' || l.child")}) / weight) as path
  from {name}_region r join {name}_levels l on l.path = r.path group by r.key, r.path),
{name}_of as (
  select r.key, arg_min(l.child, -ln({_draw("r.key", "l.path || '.' || l.child")}) / weight)::int as {name}
  from {name}_rack r join {name}_levels l on l.path = r.path group by r.key)"""


def _draw(key: str, path: str) -> str:
    return f"((('0x' || substr(md5({key} || '/' || {path}), 1, 13))::bigint + 0.5) / 4503599627370496.0::double)"


_CRC_STEP = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"


def _crc_table() -> str:
    steps = "i::bigint"
    for _ in range(8):
        steps = f"(select {_CRC_STEP} from (select {steps} as c))"
    return f"(select list({steps} order by i) from range(256) t(i))"


ORACLES["op3_sharding"] = f"""
with rows as (select row_number() over () as row_no, doc_id, coalesce(doc_id::varchar, 'null') as key, text from documents),
keys as (select distinct key from rows),
crc as (select {_crc_table()} as entry),
sums as (
  select row_no, coalesce(xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)),
    lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295::bigint), 0)::bigint as text_crc32
  from rows, crc),
{_choice(40, "shard")},
{_choice(41, "grown_shard")},
placed as (
  select r.doc_id, (coalesce(octet_length(encode(r.text)), 0) + 16)::bigint as size, s.text_crc32, r.key,
         a.shard, g.grown_shard, floor({_draw("r.key", "'slot'")} * 4096) as part
  from rows r join sums s using (row_no) join shard_of a using (key) join grown_shard_of g using (key))
select doc_id, size, text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by part, doc_id nulls first, size, text_crc32) - 1 as slot, grown_shard
from placed
"""

_LOWERED = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES["op5_benchmark_decontamination"] = f"""
with docs as (select row_number() over () as row_no, doc_id, {_LOWERED} as w from documents),
items as (select item_id::varchar as item, {_LOWERED} as w from benchmark where item_id is not null),
phrases as (
  select distinct item, least(len(w), 13) as size, array_to_string(w[p : p + least(len(w), 13) - 1], ' ') as phrase
  from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as p from items where len(w) > 0)),
windows as (
  select row_no, p, size, array_to_string(w[p : p + size - 1], ' ') as phrase
  from (select row_no, w, size, unnest(range(1, len(w) - size + 2)) as p
        from docs, (select distinct size from phrases) where len(w) >= size)),
found as (select row_no, p, f.size, item from windows w join phrases f on w.phrase = f.phrase and w.size = f.size),
hits as (select row_no, count(distinct place) as n from (select row_no, unnest(range(p, p + size)) as place from found) group by row_no),
named as (
  select row_no, count(*) as n, string_agg(item, ',' order by item) as names
  from (select distinct row_no, item from found) group by row_no),
places as (select row_no, unnest(w) as term, unnest(range(1, len(w) + 1)) as place from docs),
counts as (select term, count(*) as n from places group by term),
rarest as (
  select item_no, item, term, row_number() over (partition by item_no order by n, term) as rank
  from (select item_no, item, unnest(list_distinct(w)) as term from (select row_number() over () as item_no, * from items))
  join counts using (term)),
usable as (select item_no, count(*) - 1 as others from rarest where rank <= 4 group by item_no having count(*) >= 2),
anchors as (
  select a.item_no, a.item, u.others, p.row_no, p.place
  from rarest a join usable u using (item_no) join places p using (term) where a.rank = 1),
close_by as (
  select a.item_no, a.item, a.row_no, a.place from anchors a
  join rarest o on o.item_no = a.item_no and o.rank between 2 and 4
  join places p on p.term = o.term and p.row_no = a.row_no and p.place between a.place - 20 and a.place + 20
  group by a.item_no, a.item, a.others, a.row_no, a.place having count(distinct o.term) = a.others),
near as (select row_no, count(distinct item) as n from close_by group by row_no)
select doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(n.n, 0)::bigint as n_items,
       sha256(coalesce(n.names, '')) as items_sha256,
       coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) as contaminated,
       coalesce(c.n, 0)::bigint as n_near_items
from docs d left join hits h using (row_no) left join named n using (row_no) left join near c using (row_no)
"""

ORACLES["op6_substring_dedup"] = """
with docs as (
  select row_number() over () as row_no, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
windows as (
  select row_no, doc_id, p, array_to_string(w[p : p + 12], ' ') as phrase
  from (select row_no, doc_id, w, unnest(range(1, len(w) - 11)) as p from docs where len(w) >= 13)),
least_of as (select phrase, min(doc_id) as first_id from windows group by phrase),
gone as (
  select distinct row_no, unnest(range(p, p + 13)) as place
  from windows join least_of using (phrase) where first_id < coalesce(doc_id, 9223372036854775807)),
words as (select row_no, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from docs),
kept as (
  select row_no, string_agg(word, ' ' order by place) as text
  from words anti join gone using (row_no, place) group by row_no),
removed as (select row_no, count(*) as n from gone group by row_no)
select doc_id, len(w)::bigint as n_words, coalesce(r.n, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from docs left join removed r using (row_no) left join kept k using (row_no)
"""


def _base_counts() -> str:
    return r"""
docs as (
  select row_number() over () as row_no, doc_id, lang, coalesce(text, '') as text, text is null as missing,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
lines as (
  select row_no, line, count(*) as n from (select row_no, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by all),
dup_lines as (select row_no, sum(n - 1)::bigint as n from lines group by row_no),
triples as (
  select row_no, p, array_to_string(w[p : p + 2], ' ') as triple
  from (select row_no, w, unnest(range(1, len(w) - 1)) as p from docs where len(w) >= 3)),
repeated as (
  select row_no, count(distinct place) as n from (
    select row_no, unnest(range(p, p + 3)) as place from triples
    join (select row_no, triple from triples group by all having count(*) > 1) using (row_no, triple))
  group by row_no)"""


_CLASS = r"""case when c between 'a' and 'z' then 0 when c between 'A' and 'Z' then 1 when c between '0' and '9' then 2
  when c in (' ', chr(9), chr(11), chr(12), chr(13)) then 3 when c = chr(10) then 4
  when contains('.,;:?''"()-', c) then 5 when contains('!#*$%&', c) then 6 when contains('|<>', c) then 7
  when ord(c) < 128 then 8 else 9 end"""


def _distance(own: str, reference: str) -> str:
    """Terms of the divergence in bits, to be added up."""
    middle = f"(({own} + {reference}) / 2)"
    part = lambda x: f"case when {x} > 0 then {x} * log2({x} / {middle}) else 0 end"
    return f"({part(own)} + {part(reference)}) / 2"


def _nearest(name: str, own: str, total: str, reference: str) -> str:
    """(row_no, distance) from the closest language, where ``own`` (row_no, bin, n) counts the bins of a text."""
    return f"""
{name}_parts as (
  select t.row_no, r.lang, {_distance("(coalesce(o.n, 0) / t.n)", "r.share")} as part
  from {total} t cross join {reference} r left join {own} o on o.row_no = t.row_no and o.lang = r.lang and o.bin = r.bin),
{name} as (
  select row_no, min(distance) as distance from (
    select row_no, lang, sqrt(greatest(sum(part), 0)) as distance from {name}_parts group by all) group by row_no)"""


ORACLES["op4_quality_rules"] = rf"""
with {_base_counts()},
characters as (
  select row_no, {_CLASS} as bin, count(*) as n from (select row_no, unnest(string_split(text, '')) as c from docs where text <> '')
  group by all),
character_total as (select row_no, sum(n)::double as n from characters group by row_no),
plain as (
  select row_no, lang, missing, regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from docs),
spoken as (select row_no, lang, unnest(w) as word from plain),
word_total as (select row_no, count(*)::double as n from spoken group by row_no),
languages as (
  select lang, count(*)::double as n from spoken where lang is not null group by lang having count(*) >= 1000),
counted as (select s.lang, word, count(*)::double as n from spoken s join languages using (lang) group by all),
common as (
  select lang, word, n from (
    select *, count(*) over (partition by lang order by n desc range between unbounded preceding and current row) as place
    from counted) where place <= 50),
word_reference as (
  select lang, word as bin, c.n / l.n as share from common c join languages l using (lang)
  union all
  select lang, null, (l.n - coalesce(c.n, 0)) / l.n from languages l
  left join (select lang, sum(n) as n from common group by lang) c using (lang)),
character_counts as (
  select lang, bin, sum(characters.n)::double as n from characters join docs using (row_no) join languages using (lang) group by all),
character_reference as (
  select lang, bin, coalesce(c.n, 0) / sum(coalesce(c.n, 0)) over (partition by lang) as share
  from (select lang, unnest(range(10)) as bin from languages) left join character_counts c using (lang, bin)),
own_words as (
  select s.row_no, l.lang, c.word as bin, count(*)::double as n
  from spoken s cross join languages l left join common c on c.lang = l.lang and c.word = s.word group by all),
own_characters as (select row_no, lang, bin, characters.n::double as n from characters cross join languages),
{_nearest("character_near", "own_characters", "character_total", "character_reference")},
word_parts as (
  select t.row_no, r.lang, {_distance("(coalesce(o.n, 0) / t.n)", "r.share")} as part
  from word_total t cross join word_reference r
  left join own_words o on o.row_no = t.row_no and o.lang = r.lang and o.bin is not distinct from r.bin),
word_near as (
  select row_no, min(distance) as distance from (
    select row_no, lang, sqrt(greatest(sum(part), 0)) as distance from word_parts group by all) group by row_no),
measured as (
  select doc_id, len(w)::bigint as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(l.n, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words,
         coalesce(c.distance, 0) as character_distance, coalesce(s.distance, 0) as word_distance
  from docs left join dup_lines l using (row_no) left join repeated r using (row_no)
  left join character_near c using (row_no) left join word_near s using (row_no))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and character_distance <= 0.21 and word_distance <= 0.5 as kept
from measured
"""

ORACLES["op12_exact_dedup"] = r"""
with texts as (
  select doc_id, length(coalesce(text, '')) as points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256 from documents),
ranked as (
  select doc_id, text_sha256, first_value(doc_id) over best as keep_id, row_number() over best as place,
         count(*) over (partition by text_sha256) as group_size
  from texts window best as (partition by text_sha256 order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size::bigint as group_size, place = 1 as kept, text_sha256 from ranked
"""


def _vector_codes(rounds: int = 4) -> str:
    nearest = lambda n: f"""
near{n} as materialized (
  select row_no, part, min((p.square - 2 * list_inner_product(p.piece, c.piece) + c.square)::bigint * 256 + c.entry) as best
  from pieces p join book{n} c using (part) group by row_no, part)"""
    improved = lambda n: f"""
moved{n} as (
  select part, entry, list(mean order by pos) as piece from (
    select part, entry, pos, (total - ((total % n + n) % n)) // n as mean from (
      select part, best % 256 as entry, pos, sum(piece[pos]::bigint)::bigint as total, count(*) as n
      from near{n} join pieces using (row_no, part), (select unnest(range(1, (select width + 1 from size))) as pos) group by all))
  group by part, entry),
book{n + 1} as materialized (
  select part, entry, coalesce(m.piece, b.piece)::double[] as piece, list_inner_product(coalesce(m.piece, b.piece)::double[], coalesce(m.piece, b.piece)::double[]) as square
  from book{n} b left join moved{n} m using (part, entry))"""
    steps = ",".join(nearest(n) + "," + improved(n) for n in range(rounds)) + "," + nearest(rounds)
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id nulls last, v) - 1 as row_no, vec_id, label, v from (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * 1024)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
size as (select (max(len(v)) // 4)::bigint as width from kept),
pieces as materialized (
  select row_no, part, piece, list_inner_product(piece, piece) as square from (
    select row_no, part, v[part * width + 1 : part * width + width] as piece from kept, size, range(4) parts(part))),
book0 as materialized (select part, row_no as entry, piece, square from pieces where row_no < 256),{steps},
codes as (
  select row_no, string_agg(lower(printf('%02x', best % 256)), '' order by part) as code, sum(best // 256)::bigint as error
  from near{rounds} group by row_no),
digest as (
  select sha256(string_agg(array_to_string(piece::bigint[], ','), ',' order by part, entry)) as codebooks_sha256 from book{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from codes join kept using (row_no), digest
"""


ORACLES["op11_vector_codes"] = _vector_codes()

ORACLES["op13_conversation_trie"] = f"""
with crc as (select {_crc_table()} as entry),
turns as (
  select conv_id, turn, sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as turn_key,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words
  from conversations where conv_id is not null),
placed as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, turn_key) as d,
         dense_rank() over (order by turn_key) as id, words from turns),
convs as (
  select conv_id, count(*) as n, conv_id - conv_id % 20 as base, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(conv_id::varchar)), '..'), lambda x: ('0x' || x)::bigint)),
    lambda c, b: xor(c >> 8, any_value(entry)[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 4 as h
  from turns, crc group by conv_id),
rebuilt as (
  select c.conv_id, p.d, p.id, p.words from convs c join placed p on p.conv_id = c.base and p.d <= c.h
  union all
  select c.conv_id, least(c.h, coalesce(b.n, 0)) + p.d - c.h, p.id, p.words
  from convs c left join convs b on b.conv_id = c.base join placed p on p.conv_id = c.conv_id and p.d > c.h),
paths as materialized (
  select conv_id, d, list(id) over (partition by conv_id order by d) as path, words from rebuilt
  union all select conv_id, 0, [], 0 from convs),
whole as (select conv_id, max_by(path, d) as path from paths group by conv_id),
finished as (select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256 from whole group by path),
nodes as materialized (select path, d, min(conv_id) as conv_id, count(*) as n, max(words) as words from paths group by path, d),
parents as (select path[1:d - 1] as path, count(*) as n_children from nodes where d > 0 group by all),
own as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join parents using (path)),
sums as (
  select path[1:k] as path, sum((n_children = 0)::bigint) as n_leaves, sum((n - 1) * words) as saved_tokens
  from (select path, n, words, n_children, unnest(range(d + 1)) as k from own) group by all)
select o.conv_id, o.d::bigint as depth, p.conv_id as parent_conv_id, o.n::bigint as n_convs, o.n_children::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, coalesce(f.ends_sha256, sha256('')) as ends_sha256
from own o join sums s using (path) left join finished f using (path) left join nodes p on o.d > 0 and p.path = o.path[1:o.d - 1]
"""
