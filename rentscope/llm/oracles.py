"""Comparison SQL (DuckDB) for the queries that SQL can express."""

WARC = """
with p as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages),
g as (select html, max(page_id) as original from p where n >= 1000 group by html having count(*) > 1)
select p.page_id, p.n as payload_bytes, sha1(p.html) as payload_digest,
       case when g.original is not null and p.page_id is distinct from g.original then 'revisit' else 'response' end
         as record_type,
       case when p.page_id is distinct from g.original then g.original end as refers_to
from p left join g on p.html = g.html and p.n >= 1000
"""

EXACT_DEDUP = """
with d as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.text) as text_sha256
from d join g on d.text = g.text
"""

# Words in lower case, four in a row; links are counted over shared shingles, so this joins
# documents on shingles, which is only meant for small tables.
NEAR_DEDUP = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(words) = 0 then []
             when len(words) < 4 then [array_to_string(words, ' ')]
             else [array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)] end) as shingle
    from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by 1, 2),
links as (
  select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
reach(doc_id, r) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, links.b from reach join links on reach.r = links.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join n on n.doc_id = d.doc_id
join (select doc_id, min(r) as component_id from reach group by doc_id) c on c.doc_id = d.doc_id
"""

_U = "('0x' || substr(md5(doc_id::varchar || ':' || {i}), 1, 13))::bigint"


def _best(shards: int) -> str:
    scores = ", ".join(_U.format(i=i) for i in range(shards))
    return f"list_position([{scores}], list_max([{scores}])) - 1"


# CRC-32 byte by byte: the table is made by its rule (polynomial 0xEDB88320), each text folded over it.
SHARDING = f"""
with recursive bits(i, c, k) as (
  select range::bigint, range::bigint, 0 from range(256)
  union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by i) as tab from bits where k = 8),
d as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)),
             lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295::bigint) as text_crc32,
         {_best(16)} as shard, {_best(17)} as grown_shard
  from documents, crc)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard::int as shard,
       row_number() over (partition by shard order by doc_id) - 1 as slot, grown_shard::int as grown_shard
from d
"""

QUALITY_RULES = r"""
with d as (
  select doc_id, nullif(source, '') as host, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
w as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from d where len(words) >= 8)),
r as (select doc_id, win from w group by doc_id, win having count(*) > 1),
p as (select distinct w.doc_id, w.i + k.k as place from w join r using (doc_id, win), range(8) k(k)),
n as (select doc_id, count(*) as n_repeat_words from p group by doc_id),
l as (
  select doc_id, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
s as (
  select d.doc_id, d.host, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
         coalesce(l.n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n.n_repeat_words, 0)::bigint as n_repeat_words
  from d left join n on n.doc_id = d.doc_id left join l on l.doc_id = d.doc_id),
f as (
  select *, n_words < 20 as short, 100 * n_repeat_words > 30 * n_words as repeated from s),
h as (
  select host, count(*)::double as n, sum(short::int)::double as fs, sum(repeated::int)::double as fr
  from f where host is not null group by host),
t as (
  select count(*) as hosts, sum(n) as n, sum(fs) / sum(n) as ms, sum(fr) / sum(n) as mr,
         sum(fs * fs / n) as qs, sum(fr * fr / n) as qr from h),
v as (
  select *, qs / n - ms * ms - ms * (1 - ms) * hosts / n as bs, qr / n - mr * mr - mr * (1 - mr) * hosts / n as br
  from t),
k as (
  select ms, mr,
         least(greatest(case when bs > 0 then ms * (1 - ms) / bs - 1 else n end, 1), greatest(n, 1)) as ws,
         least(greatest(case when br > 0 then mr * (1 - mr) / br - 1 else n end, 1), greatest(n, 1)) as wr
  from v),
bad as (
  select host from h, k
  where (fs + ms * ws) / (n + ws) > 0.5 or (fr + mr * wr) / (n + wr) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeated as base_failed,
       not (short or repeated) and bad.host is null as kept
from f left join bad on bad.host = f.host
"""

SUBSTRING_DEDUP = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as (
  select doc_id, i, array_to_string(words[i:i + 34], ' ') as win
  from (select doc_id, words, unnest(range(1, len(words) - 33)) as i from d where len(words) >= 35)),
r as (select win from w group by win having count(*) > 1),
p as (select distinct w.doc_id, w.i + k.k as place from w join r using (win), range(35) k(k)),
g as (select doc_id, count(*) as n_removed from p group by doc_id),
x as (
  select doc_id, word, place from (
    select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from d)),
t as (
  select x.doc_id, string_agg(x.word, ' ' order by x.place) as kept
  from x left join p on p.doc_id = x.doc_id and p.place = x.place where p.place is null group by x.doc_id)
select d.doc_id, len(words)::bigint as n_words, coalesce(g.n_removed, 0)::bigint as n_removed,
       sha256(coalesce(t.kept, '')) as kept_sha256
from d left join g on g.doc_id = d.doc_id left join t on t.doc_id = d.doc_id
"""

HARD_NEGATIVES = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda c: floor(256 * c::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and list_sum(list_transform(embedding, lambda c: coalesce(isfinite(c), false)::int)) = len(embedding)),
s as (
  select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from e a join e b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
       (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id))::int as rank
from p join s on s.anchor_id = p.anchor_id and not s.same
where 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
qualify rank <= 5
"""

ORACLES = {
    "op1_warc": WARC,
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_near_dedup": NEAR_DEDUP,
    "op7_sharding": SHARDING,
    "op8_quality_rules": QUALITY_RULES,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op12_hard_negatives": HARD_NEGATIVES,
}
