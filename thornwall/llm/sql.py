"""The registered queries in DuckDB SQL, where it can express them."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_MIXING = rf"""
with recursive rows as (
  select row_number() over () as row, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size,
         ('0x' || md5(coalesce(cast(doc_id as varchar), 'null') || '|' || md5(coalesce(text, '')))[:15])::bigint as h
  from documents),
sources as (
  select source, sum(size)::bigint as n, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
  from rows group by source),
-- Filled like water: sources are capped in the order of cap per weight.
filled as (
  select *, 3 * n as cap,
         sum(n) over () - coalesce(sum(3 * n) over (order by 3 * n / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as rest,
         sum(w) over (order by 3 * n / w, source nulls last rows between current row and unbounded following) as open_w
  from sources),
level as (
  select arg_min(rest, 3 * n / w) filter (where not (cap * open_w < rest * w)) as rest,
         arg_min(open_w, 3 * n / w) filter (where not (cap * open_w < rest * w)) as open_w
  from filled),
goals as (
  select f.source, f.n, case when l.open_w is null or f.cap * l.open_w < l.rest * f.w then cast(f.cap as double)
                             else cast(l.rest * f.w as double) / l.open_w end as target
  from filled f, level l),
parts as (
  select *, case when n > 0 then cast(floor(target / n) as bigint) else 0 end as rounds,
         target - (case when n > 0 then floor(target / n) else 0 end) * n as rest
  from goals),
hashes as (
  select r.source, h, sum(size) as g, count(*) as n, sum(sum(size)) over (partition by r.source order by h) - sum(size) as before
  from rows r group by r.source, h),
numbered as (select *, row_number() over (partition by source, h order by row) as nth from rows)
select r.doc_id, r.size, p.n as source_size, p.target,
       cast(r.size * (p.rounds + cast(r.nth <= coalesce(floor((p.rest - k.before) * k.n / nullif(k.g, 0) + 0.5), 0) as int)) as bigint) as taken
from numbered r join parts p on r.source is not distinct from p.source
join hashes k on r.source is not distinct from k.source and r.h = k.h
"""

_QUALITY = rf"""
with texts as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words from documents),
lines as (
  select doc_id, text, words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines from texts),
places as (select doc_id, words, unnest(range(1, len(words) - 1)) as i from texts where len(words) >= 3),
windows as (
  select doc_id, i, count(*) over (partition by doc_id, words[i], words[i + 1], words[i + 2]) as n from places),
covered as (select distinct doc_id, i + unnest([0, 1, 2]) as i from windows where n > 1),
repeats as (select doc_id, count(*) as n from covered group by doc_id),
counts as (
  select l.doc_id, len(words) as n_words, coalesce(length(array_to_string(words, '')), 0) as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
         length(text) - length(replace(text, '!', '')) as n_exclaims
  from lines l left join repeats r using (doc_id)),
based as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or 2 * n_dup_lines > n_lines or word_chars < 3 * n_words
            or word_chars > 10 * n_words or 2 * n_exclaims > n_words) as kept
from based
"""

_URLS = r"""
with rules(rhost, rpath, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
hosts as (select page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') as raw from cut),
parts as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(coalesce(rest, ''), length(raw) + 1), '^[^?#]*') as path from hosts),
fits as (
  select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(verdict, length(rhost || rpath)) as verdict
  from parts, rules where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join fits using (page_id)
"""

_EXACT = r"""
with texts as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
marked as (
  select *, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size, row_number() over (partition by t, doc_id) as nth from texts)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id and nth = 1 as kept, sha256(t) as text_sha256 from marked
"""


_WARC = r"""
with pages_ as (select page_id, coalesce(url, '') as url, html from pages),
copies as (
  select page_id, url, html,
         case when page_id % 97 = 5 then '~' || substr(html, 2)
              when page_id % 389 = 7 then left(html, cast(floor(length(html) / 2) as int)) else html end as other,
         page_id % 1009 is distinct from 11 as there
  from pages_),
written as (
  select page_id, there,
         'WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:' || coalesce(cast(page_id as varchar), '') || '>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: ' || url
           || '\r\nContent-Type: text/html\r\nContent-Length: ' as head,
         coalesce(html, '') as html, coalesce(other, '') as other from copies),
whole as (
  select page_id, there, replace(replace(head || strlen(html) || '\r\n\r\n', '\r', chr(13)), '\n', chr(10)) || html || chr(13) || chr(10) || chr(13) || chr(10) as record,
         replace(replace(head || strlen(other) || '\r\n\r\n', '\r', chr(13)), '\n', chr(10)) || other || chr(13) || chr(10) || chr(13) || chr(10) as copy
  from written),
placed as (
  select *, strlen(record) as length, (row_number() over (order by page_id nulls first) - 1) // 1000 as file from whole)
select page_id, file, cast(sum(length) over (partition by file order by page_id nulls first) - length as bigint) as start, length, sha256(record) as sha256,
       case when not there then 'missing' when record = copy then 'intact' when strlen(copy) < length then 'truncated' else 'altered' end as status
from placed
"""

_CHAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized as (
  select *, length(role) + length(text) + (length(role) - length(replace(role, '\', ''))) + (length(text) - length(replace(text, '\', '')))
    + (length(role) - length(replace(role, chr(10), '')))
    + 2 * len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<\|startoftext\|>|<\|system\|>|<\|user\|>|<\|assistant\|>|<s>|</s>|<unk>|<pad>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
    + length('<|im_start|>') + length('<|im_end|>') + 2 as chars
  from turns),
joined as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text) as whole,
         coalesce(string_agg(text, '' order by turn nulls last, text) filter (where role = 'assistant'), '') as loss, cast(sum(chars) as bigint) as formatted_chars
  from sized group by conv_id)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars from joined
"""

_PHRASES = r"""
with folded as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from folded),
cut as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
totals as (select lang, sum(len(words))::bigint as n from cut group by lang),
counts as (
  select lang, phrase, count(*) as f from (
    select lang, unnest(flatten([[array_to_string(words[i:i + k - 1], ' ') for i in range(1, len(words) - k + 2)] for k in [1, 2, 3]])) as phrase from cut)
  group by lang, phrase),
candidates as (select lang, phrase, f as a, string_split(phrase, ' ') as w from counts where f >= 10 and contains(phrase, ' ')),
cuts as (
  select lang, phrase, a, k, array_to_string(w[:k], ' ') as head, array_to_string(w[k + 1:], ' ') as rest
  from (select *, unnest(range(1, len(w))) as k from candidates)),
scored as (
  select c.*, x.f as l, y.f as r, ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = c.head join counts y on y.lang = c.lang and y.phrase = c.rest),
weakest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, part as phrase, max(a) as longer
  from (select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as part from candidates where len(w) = 3) group by all),
kept as (select w.* from weakest w left join longer g using (lang, phrase) where g.longer is null or 100 * g.longer < 50 * w.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join totals using (lang)
qualify rank <= 2000
"""

_LEAKS = r"""
with docs as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
starts as (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from items where len(words) > 0),
windows as (select distinct item_id, array_to_string(words[i:i + 9], ' ') as w, least(len(words), 10) as n from starts),
lengths as (select distinct n from windows),
places as (select row, words, unnest(range(1, len(words) + 1)) as i from docs),
grams as (select row, i, n, array_to_string(words[i:i + n - 1], ' ') as w from places, lengths where i + n - 1 <= len(words)),
found as (select g.row, g.i, g.n, w.item_id from grams g join windows w on g.w = w.w and g.n = w.n),
hits as (select row, count(distinct pos) as n_hit from (select row, unnest(range(i, i + n)) as pos from found) group by row),
held as (select row, list_sort(list(distinct item_id::varchar)) as ids from found where item_id is not null group by row)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(ids), 0) as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row) left join held using (row)
"""

_TRIE = r"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as nth,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
-- CRC-32: a byte is mixed in, then eight shifts (-1) follow.
convs as (
  select conv_id, conv_id - conv_id % 100 as base,
         xor(list_reduce(list_concat([4294967295::bigint], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(conv_id::varchar, '')])),
           lambda x, y: case when y >= 0 then xor(x, y::bigint) else xor(x >> 1, 3988292384 * (x & 1)) end), 4294967295) % 6 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, 0 as part, t.nth, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.nth <= c.h
  union all select c.conv_id, 1, t.nth, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.nth > c.h),
paths as (
  select conv_id, list(sha256(length(role) || ':' || role || text) order by part, nth) as path, list(length(text) order by part, nth) as sizes from rebuilt group by conv_id),
whole as (select conv_id, coalesce(path, []) as path, coalesce(sizes, []) as sizes from convs left join paths using (conv_id)),
steps as (select conv_id, path, sizes, unnest(range(0, len(path) + 1)) as depth from whole),
members as (
  select conv_id, depth, depth = len(path) as ends, sha256(array_to_string(path[1:depth], ',')) as node,
         case when depth > 0 then sha256(array_to_string(path[1:depth - 1], ',')) end as above, case when depth > 0 then sizes[depth] else 0 end as chars
  from steps),
nodes as (
  select node, depth, above, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by node, depth, above),
children as (select above as node, count(*) as n_children from nodes where above is not null group by above),
pairs as (select distinct a.node, b.node as other from members a join members b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (
  select p.node, count(*) filter (where c.node is null) as n_leaves, sum((n.n_convs - 1) * n.chars)::bigint as saved_tokens
  from pairs p join nodes n on n.node = p.other left join children c on c.node = p.other group by p.node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
from nodes n join sums s using (node) left join children c using (node) left join nodes p on p.node = n.above
"""


def all_sql() -> dict[str, str]:
    return {
        "op10_chat_formatting": _CHAT,
        "op11_phrase_collocations": _PHRASES,
        "op12_benchmark_decontamination": _LEAKS,
        "op13_conversation_prefix_trie": _TRIE,
        "op2_mixing": _MIXING,
        "op3_warc_fixity": _WARC,
        "op4_quality_rules": _QUALITY,
        "op7_url_filters": _URLS,
        "op9_exact_dedup": _EXACT,
    }
