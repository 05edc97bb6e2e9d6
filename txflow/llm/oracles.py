"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

_ESCAPED = r"replace(replace(replace(replace({0}, '\', '\s'), '[', '\l'), ']', '\r'), '<', '\a')"
_CONFLICT = r"regexp_matches({0}, '[\[<]|\\[slra]')"

CHAT = f"""
with source as (
  select conv_id, case when conv_id is null then turn end as t0, case when conv_id is null then role end as r0,
         case when conv_id is null then text end as x0, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         role is null as no_role, text is null as no_text
  from (select conv_id, turn, role, text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
  select *, case when {_CONFLICT.format('text')} or {_CONFLICT.format('role')} or contains(role, ']')
                 then length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})
                 else length(role) + length(text) end + 5 as size
  from source
), joined as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, no_role desc, role, no_text desc, text) as told,
         coalesce(string_agg(text, '' order by turn nulls first, no_role desc, role, no_text desc, text)
                  filter (where role = 'assistant'), '') as loss,
         sum(size) + 7 as formatted_chars
  from sized group by conv_id, t0, r0, x0
)
select conv_id, n_turns, sha256(told) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       cast(formatted_chars as bigint) as formatted_chars, true as round_trip
from joined
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def benchmark_words(text: str) -> str:
    return rf"regexp_extract_all({_LOWER.format(f'coalesce({text}, {chr(39) * 2})')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontamination(docs: str = "documents") -> str:
    """doc_id, n_words, n_hit and the sorted item ids of the documents in ``docs``."""
    return f"""
with dw as (select distinct doc_id, text, {benchmark_words('text')} as w from {docs}),
d as (select row_number() over () as k, * from dw),
i as (select distinct item_id, {benchmark_words('text')} as w from benchmark),
win as (
  select distinct item_id, least(13, len(w)) as size, array_to_string(list_slice(w, p, p + least(13, len(w)) - 1), ' ') as s
  from i, unnest(range(1, len(w) - least(13, len(w)) + 2)) as u(p) where len(w) > 0
),
sizes as (select distinct size from win),
dwin as (
  select k, p, size, array_to_string(list_slice(w, p, p + size - 1), ' ') as s
  from d, sizes, unnest(range(1, len(w) - size + 2)) as u(p)
),
hits as (select k, p, dwin.size, item_id from dwin join win on dwin.size = win.size and dwin.s = win.s),
words as (select k, count(distinct q) as n_hit from hits, unnest(range(p, p + size)) as u(q) group by k),
items as (
  select k, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct k, cast(item_id as varchar) as id from hits) group by k
)
select d.doc_id, d.text, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(ids, '') as ids
from d left join words using (k) left join items using (k)
"""


DECONTAMINATION = f"""
select doc_id, n_words, n_hit, n_items, sha256(ids) as items_sha256, n_hit > 0 and 20 * n_hit >= n_words as contaminated
from ({decontamination()})
"""


_SPACES = r"[^\x20\x09-\x0D]+"


def substring_dedup(docs: str = "documents") -> str:
    """doc_id, n_words, the kept words and the removed number of words of ``docs``."""
    return rf"""
with d as (select row_number() over () as k, doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACES}') as w from {docs}),
win as (
  select k, p, array_to_string(list_slice(w, p, p + 34), ' ') as s from d, unnest(range(1, len(w) - 33)) as u(p)
  where len(w) >= 35
),
twice as (select s from win group by s having count(*) > 1),
hit as (select distinct k, q from win join twice using (s), unnest(range(p, p + 35)) as u(q)),
word as (select k, q, w[q] as word from d, unnest(range(1, len(w) + 1)) as u(q)),
kept as (
  select k, string_agg(word, ' ' order by q) as kept from word anti join hit using (k, q) group by k
),
removed as (select k, count(*) as n from hit group by k)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed, coalesce(kept, '') as kept
from d left join kept using (k) left join removed using (k)
"""


SUBSTRING_DEDUP = f"select doc_id, n_words, n_removed, sha256(kept) as kept_sha256 from ({substring_dedup()})"


#: For each byte what eight steps of the reversed polynomial make of it.
_CRC_TABLE = """
crc_table as (
  select list(list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, step: xor(c >> 1, 3988292384 * (c & 1)), i) order by i) as crc_of
  from (select unnest(range(0, 256))::bigint as i)
)"""


def _crc32(text: str) -> str:
    h = f"hex(encode({text}))"
    return f"""xor(4294967295, list_reduce(
  list_transform(range(0, len({h}) // 2), lambda i: ('0x' || substr({h}, 2 * i + 1, 2))::bigint),
  lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1]), 4294967295::bigint))"""


RESAMPLING = f"""
with {_CRC_TABLE},
w as (
  select 'd' as side, row_number() over () as k, doc_id, {benchmark_words('text')} as w from documents
  union all select 'b', row_number() over (), null, {benchmark_words('text')} from benchmark
),
f as (
  select side, k, doc_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as feature from w
),
b as (select feature, {_crc32('feature')} % 10000 as bucket from (select distinct feature from f), crc_table),
counted as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t
  from f join b using (feature) group by bucket
),
gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
                                 / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
  from counted
),
weights as (
  select k, count(*) as n_features, floor(sum(gain)::bigint / count(*))::bigint as weight
  from f join b using (feature) join gains using (bucket) where side = 'd' group by k
),
scored as (
  select w.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, len(w) >= 20 as fit,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || w.doc_id)[1:8])::bigint + 0.5::double) / 4294967296)))::bigint as score
  from w left join weights using (k) where side = 'd'
),
ranked as (
  select *, row_number() over (partition by fit order by score desc, doc_id) as r, count(*) over (partition by fit) as n from scored
)
select doc_id, n_features, weight, score, case when fit and r <= 25 * n // 100 then r end as rank from ranked
"""


#: Bytes are pairs of hex digits, read from pieces of texts; a window's place is its document and start in one number.
SUFFIX_ARRAY_DEDUP = """
with d as (select row_number() over (order by doc_id) as k, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
piece as (
  select k, p0, substr(h, 2 * p0 + 1, 2198) as c from d, unnest(range(0, len(h) // 2, 1000)) as u(p0)
),
win as (
  select k * 1000000000 + p0 + p as place, substr(c, 2 * p + 1, 200) as s
  from piece, unnest(range(0, least(1000, len(c) // 2 - 99))) as u(p) where len(c) >= 200
),
twice as (select s, min(place) as first from win group by s having count(*) > 1),
later as (select place // 1000000000 as k, place % 1000000000 as p from win join twice using (s) where place > first),
hit as (select distinct k, q from later, unnest(range(p, p + 100)) as u(q)),
removed as (
  select k, count(*) as n, count(*) filter (where before is null or q - 1 <> before) as spans
  from (select k, q, lag(q) over (partition by k order by q) as before from hit) group by k
),
byte as (
  select k, p0 + p as q, substr(c, 2 * p + 1, 2) as b
  from piece join removed using (k), unnest(range(0, least(1000, len(c) // 2))) as u(p)
),
kept as (select k, string_agg(b, '' order by q) as h from byte anti join hit using (k, q) group by k)
select doc_id, len(d.h) // 2 as n_bytes, coalesce(n, 0) as n_removed, coalesce(spans, 0) as n_spans,
       sha256(unhex(case when n is null then d.h else coalesce(kept.h, '') end)) as kept_sha256
from d left join removed using (k) left join kept using (k)
"""


def oracles() -> dict[str, str]:
    return {
        "op2_substring_dedup": SUBSTRING_DEDUP,
        "op7_chat_formatting": CHAT,
        "op9_decontamination": DECONTAMINATION,
        "op11_importance_resampling": RESAMPLING,
        "op13_suffix_array_dedup": SUFFIX_ARRAY_DEDUP,
    }
