"""The same results as SQL, where SQL can express them."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"

op8_urls = f"""
with p as (
  select page_id, url, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{_UP}', '{_LOW}') host,
    coalesce(regexp_extract(url, '{_PARTS}', 2), '') path,
    regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\\?([^#]*)', 1), '(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&', '') q
  from pages),
c as (select *, regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/$', '') || case when q <> '' then '?' || q else '' end canon from p),
listed as (select distinct canon from c where regexp_matches(host, '(^|[.])(cheap-pills|casino-win|free-bets|ads-track)[.]'))
select page_id, host, path,
  case when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end rule,
  case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
    when canon in (select canon from listed) then 'block' else 'allow' end verdict,
  canon in (select canon from listed) is_listed
from c
"""

_BLOCKS = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|tr|ul"
_CRLF = "chr(13) || chr(10)"


def _text(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for e in ("script", "style", "head"):
        out = f"regexp_replace({out}, '(?is)<{e}\\b[^>]*>.*?</{e}\\s*>', '', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)</?(?:{_BLOCKS})\\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')"
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{char}')"
    out = f"regexp_replace(regexp_replace({out}, '[ \\t\\r\\f]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({out}, '^[ \\n]+|[ \\n]+$', '', 'g')"


def _urn(seed: str) -> str:
    d = f"md5({seed})"
    return " || '-' || ".join(f"substr({d}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


op10_warc = f"""
with r as (
  select page_id, coalesce(url, '') uri, coalesce(html, '') html,
    'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: ' || strlen(coalesce(html, '')) head
  from pages),
i as (select *, head || {_CRLF} || {_CRLF} || html block, 'sha256:' || sha256(html) pay,
  {_urn("'response|' || coalesce(cast(page_id as varchar), '') || '|' || uri || '|' || sha256(html)")} rid from r),
m as (select *, {_urn("'metadata|' || rid")} mid, {_urn("'conversion|' || rid")} tid,
  'source-record-id: <urn:uuid:' || rid || '>' || {_CRLF} || 'source-status: 200' || {_CRLF} || 'source-content-type: text/html; charset=utf-8' || {_CRLF}
  || 'source-content-length: ' || strlen(block) || {_CRLF} || 'source-block-digest: sha256:' || sha256(block) || {_CRLF}
  || 'source-payload-digest: ' || pay || {_CRLF}
  || 'title: ' || regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '[\\r\\n]+', ' ', 'g') || {_CRLF}
  || 'outlinks: ' || len(regexp_extract_all(html, '(?i)<a\\s[^>]*href')) || {_CRLF} meta, {_text("html")} txt from i),
k as (
  select page_id, 'metadata' warc_type, mid id, null conc, 'application/warc-fields' content_type, meta as content, rid, uri, pay, head from m
  union all
  select page_id, 'conversion', tid, mid, 'text/plain; charset=utf-8', txt, rid, uri, pay, head from m)
select page_id, warc_type, '<urn:uuid:' || id || '>' warc_record_id, '<urn:uuid:' || rid || '>' warc_refers_to,
  '<urn:uuid:' || conc || '>' warc_concurrent_to, uri warc_target_uri, '2024-06-01T00:00:00Z' warc_date, content_type,
  pay source_payload_digest, 'sha256:' || sha256(content) warc_block_digest, cast(strlen(content) as bigint) content_length,
  head source_headers, content
from k
"""

_LOWERED = f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')"

op4_neardup = f"""
with recursive w as (
  select row_number() over () rid, doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') w from documents),
s as (
  select distinct rid, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end g
  from w, unnest(range(1, greatest(len(w) - 3, 2))) t(i) where len(w) > 0),
n as (select rid, count(*) n from s group by rid),
linked as (
  select a.rid x, b.rid y from s a join s b on a.g = b.g and a.rid < b.rid join n na on na.rid = a.rid join n nb on nb.rid = b.rid
  group by a.rid, b.rid having 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))),
e as (select x, y from linked union all select y, x from linked),
reach(rid, other) as (select rid, rid from w union select r.rid, e.y from reach r join e on e.x = r.other),
c as (select r.rid, min(d.doc_id) component_id from reach r join w d on d.rid = r.other group by r.rid)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) n_shingles, c.component_id, w.doc_id = c.component_id kept
from w join c using (rid) left join n using (rid)
"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

op5_decontam = f"""
with i as (select item_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') w from benchmark),
g as (
  select distinct item_id, least(len(w), 10) n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') g
  from i, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(p) where len(w) > 0),
d as (select row_number() over () rid, doc_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') w from documents),
h as (
  select rid, p, z.n, array_to_string(w[p:p + z.n - 1], ' ') g
  from d, (select distinct n from g) z, unnest(range(1, greatest(len(w) - z.n + 2, 1))) t(p)),
m as (select h.rid, h.p, h.n, g.item_id from h join g on g.n = h.n and g.g = h.g),
words as (select rid, count(distinct q) n_hit from m, unnest(range(p, p + n)) t(q) group by rid),
items as (select rid, list_sort(list(distinct cast(item_id as varchar)) filter (item_id is not null)) items from m group by rid)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(len(items), 0) as bigint) n_items,
  sha256(coalesce(array_to_string(items, ','), '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (rid) left join items using (rid)
"""

_CRC_TABLE = """
crc as materialized (select list_transform(range(256), lambda i : list_reduce(range(8), lambda c, b :
  case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) t)"""


def _crc32(text: str) -> str:
    """Over the bytes of a text, with the table ``crc``."""
    numbers = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h : ('0x' || h)::bigint)"
    return f"xor(list_reduce({numbers}, lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


# Runs of eight at a time up to the subroots, then up to the root; the climb takes a leaf through the same runs
op11_merkle = f"""
with recursive {_CRC_TABLE},
f as (
  select row_number() over () rid, doc_id, coalesce('=' || lang, '-') tree,
    {{}} head, text,
    doc_id is not null and ({_crc32("cast(doc_id as varchar)")}) % 3 = 0 tampered
  from documents, crc),
l as (
  select rid, doc_id, tree, sha256(head || {{}}) leaf, sha256(head || {{}}) changed from (
    select *, case when tampered then translate(text, '{_UP}', '{_LOW}') else text end other from f)),
p as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 idx, count(*) over (partition by tree) n from l),
up(tree, level, idx, n, hash) as (
  select tree, 0, idx, n, leaf from p
  union all
  select tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' order by idx))
  from up where n > 1 group by tree, level, idx // 8, (n + 7) // 8),
sub as (select tree, hash, row_number() over (order by encode(tree)) - 1 idx, count(*) over () n from up where n = 1),
top(tree, level, idx, n, hash) as (
  select '', 0, idx, n, hash from sub
  union all
  select '', level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' order by idx))
  from top where n > 1 group by level, idx // 8, (n + 7) // 8),
nodes as (select * from up union all select * from top),
runs as (select tree, level, idx // 8 run, list(hash order by idx) kids from nodes where n > 1 group by all),
climb(rid, tree, level, idx, folded, proof) as (
  select rid, tree, 0, idx, changed, '' from p
  union all
  select c.rid, c.tree, c.level + 1, c.idx // 8,
    sha256(array_to_string(kids[:c.idx % 8], '') || c.folded || array_to_string(kids[c.idx % 8 + 2:], '')),
    proof || array_to_string(kids[:c.idx % 8], '') || array_to_string(kids[c.idx % 8 + 2:], '')
  from climb c join runs r on r.tree = c.tree and r.level = c.level and r.run = c.idx // 8),
low as (select * from climb qualify row_number() over (partition by rid order by level desc) = 1),
high(rid, level, idx, folded, proof) as (
  select rid, 0, s.idx, folded, proof from low join sub s using (tree)
  union all
  select c.rid, c.level + 1, c.idx // 8,
    sha256(array_to_string(kids[:c.idx % 8], '') || c.folded || array_to_string(kids[c.idx % 8 + 2:], '')),
    proof || array_to_string(kids[:c.idx % 8], '') || array_to_string(kids[c.idx % 8 + 2:], '')
  from high c join runs r on r.tree = '' and r.level = c.level and r.run = c.idx // 8),
done as (select * from high qualify row_number() over (partition by rid order by level desc) = 1)
select p.doc_id, p.leaf, s.hash subroot, t.hash root, sha256(d.proof) proof_sha256, d.folded folded_root, d.folded = t.hash verified
from p join done d using (rid) join sub s using (tree) join (select hash from top where n = 1) t on true
"""


def _sized(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


op11_merkle = op11_merkle.format(
    " || ".join(_sized(f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars")), _sized("text"), _sized("other")
)

op12_collocations = f"""
with p as (
  select lang, w from (
    select coalesce(lang, 'und') lang, regexp_extract_all(unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from documents)),
g as materialized ({" union all ".join(f"""
  select lang, {m} m, phrase, count(*) a from (
    select lang, unnest(list_transform(range(1, len(w) - {m - 2}), lambda i : array_to_string(w[i:i + {m - 1}], ' '))) phrase from p) group by all""" for m in (1, 2, 3, 4))}),
c as materialized (select lang, m, phrase, a, string_split(phrase, ' ') w from g where m >= 2 and a >= 30),
parts as (select c.lang, c.phrase, c.a, k, array_to_string(w[:k], ' ') p1, array_to_string(w[k + 1:], ' ') p2 from c, unnest(range(1, m)) z(k)),
lefts as materialized (select parts.*, g.a l from parts join g on g.lang = parts.lang and g.phrase = p1),
cuts as materialized (
  select s.lang, s.phrase, k, l, g.a r, cast(cast(2000000 as hugeint) * s.a // (l + g.a) as bigint) score
  from lefts s join g on g.lang = s.lang and g.phrase = p2),
least as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
within as (
  select lang, array_to_string(w[i:i + n - 1], ' ') phrase, max(a) most
  from c, unnest(range(2, m)) x(n), unnest(range(1, c.m - n + 2)) y(i) group by all),
total as (select lang, sum(a) n from g where m = 1 group by lang)
select c.lang, row_number() over (partition by c.lang order by score desc, c.a desc, encode(c.phrase)) as rank, c.phrase, cast(c.a as bigint) a,
  cast(l as bigint) l, cast(r as bigint) r, cast(n as bigint) n, score
from c join least using (lang, phrase) join total using (lang) left join within using (lang, phrase)
where most is null or 100 * cast(most as hugeint) < 80 * c.a
qualify rank <= 2000
"""

op13_sharding = f"""
with {_CRC_TABLE},
x as (
  select doc_id, coalesce(strlen(text), 0) + 1 size, {_crc32("coalesce(text, '')")} crc,
    coalesce(('0x' || substr(md5(text), 1, 15))::bigint, -1) k1, ('0x' || substr(md5(coalesce('=' || doc_id, '-')), 1, 15))::bigint k2
  from documents, crc),
o as (
  select *, sum(size) over (order by k1, k2, doc_id nulls first rows unbounded preceding) - size begins,
    row_number() over (order by k1, k2, doc_id nulls first) - 1 pos, sum(size) over () total from x),
g as (select *, min(begins) over (partition by k1) g_at, sum(size) over (partition by k1) g_size from o),
b as (select *, g_size * 25 * 8 <= total whole from g join range(1, 8) b(k) on begins * 8 <= total * k and total * k < (begins + size) * 8),
c as (select k, case when whole then g_at else begins end c_at, case when whole then g_size else size end c_size, total from b),
cut as (select k, case when 2 * total * k < 8 * (2 * c_at + c_size) then c_at else c_at + c_size end cut from c),
s as (select o.*, (select count(*) from cut where cut <= begins) shard from o)
select doc_id, cast(size as bigint) size, cast(crc as bigint) text_crc32, 'bytes' law, cast(shard as int) shard,
  cast(pos - min(pos) over (partition by shard) as bigint) slot, cast(null as int) grown_shard
from s
"""

ORACLES = {"op4_neardup": op4_neardup, "op5_decontam": op5_decontam, "op8_urls": op8_urls, "op10_warc": op10_warc, "op11_merkle": op11_merkle, "op12_collocations": op12_collocations, "op13_sharding": op13_sharding}
