"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# Windows of 35 words that start at two places; their words go.
ORACLES["op1_substring_dedup"] = r"""
with split as (
    select row_number() over () as r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from documents
), windows as (
    select r, s, md5(array_to_string(words[s:s + 34], ' ')) as key
    from (select r, words, unnest(range(1, len(words) - 33)) as s from split)
), twice as (
    select key from windows group by key having count(*) > 1
), gone as (
    select distinct r, unnest(range(s, s + 35)) as p from windows join twice using (key)
), places as (
    select r, unnest(words) as w, unnest(range(1, len(words) + 1)) as p from split
), kept as (
    select r, count(gone.p) as n_removed, string_agg(w, ' ' order by p) filter (where gone.p is null) as t
    from places left join gone using (r, p) group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from split left join kept using (r)
"""

_OP4_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES["op4_decontaminate_fm_index"] = rf"""
with d as (select row_number() over () as r, doc_id, {_OP4_WORDS} as words from documents),
b as (select coalesce(item_id::varchar, '') as item_id, {_OP4_WORDS} as words from benchmark),
phrases as (
    select distinct item_id, len(part) as n, array_to_string(part, ' ') as phrase
    from (select item_id, words[s:s + 9] as part
          from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as s
                from b where len(words) > 0))
), sizes as (
    select distinct n from phrases
), windows as (
    select r, s, n, array_to_string(words[s:s + n - 1], ' ') as phrase
    from (select r, words, n, unnest(range(1, len(words) - n + 2)) as s from d, sizes where len(words) >= n)
), found as (
    select r, s, windows.n, item_id from windows join phrases using (phrase)
), hits as (
    select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + n)) as p from found) group by r
), items as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct r, item_id from found) group by r
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (r) left join items using (r)
"""

ORACLES["op3_topk_nra"] = """
with v as (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as vec
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), pairs as (
    select q.r, q.vec_id as query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.vec, c.vec), lambda z: z[1] * z[2]))::bigint as score
    from v q join v c on q.r <> c.r and len(q.vec) = len(c.vec) and q.vec_id % 50 = 0
), ranked as (
    select *, row_number() over (partition by r order by score desc, vec_id)::integer as rank from pairs
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

ORACLES["op7_url_reputation"] = r"""
with split as (
    select page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), marks as (
    select doc_id as doc_number, min(quality) as mark from labels
    where quality in (0, 1) and doc_id is not null group by doc_id having min(quality) = max(quality)
), hosts as (
    select host, array_to_string(list_reverse(list_reverse(string_split(host, '.'))[1:2]), '.') as domain,
           list_reverse(string_split(host, '.'))[1] as suffix,
           count(mark)::double as n, coalesce(sum(mark), 0)::double as good
    from split left join marks on try_cast(nullif(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1), '') as bigint) = doc_number
    group by host
), suffixes as (
    select suffix, sum(n) as n, sum(good) as good,
           (sum(sum(good)) over () + 0.5) / (sum(sum(n)) over () + 1.0) as parent
    from hosts group by suffix
), s1 as (
    select case when over > 0 then greatest(2.0, least(1000.0, 1 / over - 1)) else 1000.0 end as strength
    from (select (sum(n * (good / n - parent) ** 2) - sum(parent * (1 - parent)))
                 / nullif(sum(n * parent * (1 - parent) * (1 - 1 / n)), 0) as over from suffixes where n > 0)
), suffix_rate as (
    select suffix, (good + strength * parent) / (n + strength) as parent from suffixes, s1
), domains as (
    select domain, n, good, parent from (
        select domain, suffix, sum(n) as n, sum(good) as good from hosts group by domain, suffix) join suffix_rate using (suffix)
), s2 as (
    select case when over > 0 then greatest(2.0, least(1000.0, 1 / over - 1)) else 1000.0 end as strength
    from (select (sum(n * (good / n - parent) ** 2) - sum(parent * (1 - parent)))
                 / nullif(sum(n * parent * (1 - parent) * (1 - 1 / n)), 0) as over from domains where n > 0)
), domain_rate as (
    select domain, (good + strength * parent) / (n + strength) as parent from domains, s2
), h as (
    select host, n, good, parent from hosts join domain_rate using (domain)
), s3 as (
    select case when over > 0 then greatest(2.0, least(1000.0, 1 / over - 1)) else 1000.0 end as strength
    from (select (sum(n * (good / n - parent) ** 2) - sum(parent * (1 - parent)))
                 / nullif(sum(n * parent * (1 - parent) * (1 - 1 / n)), 0) as over from h where n > 0)
), bounds as (
    select host, rate - 1.64 * sqrt(rate * (1 - rate) / (n + strength + 1)) as bound
    from (select host, n, strength, (good + strength * parent) / (n + strength) as rate from h, s3)
), ruled as (
    select page_id, host, path, bound, case
        when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
        when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
    from split join bounds using (host)
)
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when bound >= 0.5 then 'allow' else 'block' end as verdict
from ruled
"""

# The checksum is taken byte by byte over the table of its polynomial.
ORACLES["op10_byte_shards"] = """
with crc as (
    select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda c, x: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as steps
    from (select unnest(range(0, 256)) as n)
), sized as (
    select doc_id, coalesce(octet_length(encode(text)), 0)::bigint + 8 as size, hex(encode(coalesce(text, ''))) as digits
    from documents
), summed as (
    select *, sum(size) over (order by doc_id rows unbounded preceding) - size as before, sum(size) over () as whole
    from sized
), cut as (
    select *, least(floor((2 * before + size) * 24 / (2 * whole))::integer, 23) as shard from summed
), checked as (
    select doc_id, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(0, length(digits) // 2),
            lambda i: (strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
        lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as text_crc32
    from sized, crc
)
select doc_id, size, text_crc32::bigint as text_crc32, 'bytes' as law, shard,
       (row_number() over (partition by shard order by doc_id) - 1)::bigint as slot, null::integer as grown_shard
from cut join checked using (doc_id)
"""

# Cuts at two drawn ranks; the parts are put together again from the output alone.
ORACLES["op12_infilling"] = r"""
with drawn as (
    select doc_id, coalesce(text, '') as t, length(coalesce(text, ''))::bigint as n,
           sha256('1:' || coalesce(doc_id::varchar, '')) as d
    from documents
), numbers as (
    select doc_id, t, n, ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2,
           ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4 from drawn
), cut as (
    select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                when h4 % 100 < 20 then 'spm' else 'psm' end as form
    from numbers
), parts as (
    select *, substring(t, 1, a) as p, substring(t, a + 1, b - a) as m, substring(t, b + 1) as s from cut
), made as (
    select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                        else '<S>' || s || '<P>' || p || '<M>' || m end as output from parts
), found as (
    select *, strpos(output, '<P>') as ip, strpos(output, '<S>') as ins, strpos(output, '<M>') as im from made
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars, sha256(output) as output_sha256,
       sha256(case form when 'plain' then output
              when 'psm' then substring(output, ip + 3, ins - ip - 3) || substring(output, im + 3)
                              || substring(output, ins + 3, im - ins - 3)
              else substring(output, ip + 3, im - ip - 3) || substring(output, im + 3)
                   || substring(output, ins + 3, ip - ins - 3) end) as restored_sha256
from found
"""

_OP13_FEATURES = f"""
    select r, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) as f
"""

# Checksums are taken byte by byte over the table of their polynomial, once per distinct feature.
ORACLES["op13_importance_resampling"] = f"""
with d as (select row_number() over () as r, doc_id, {_OP4_WORDS} as words from documents),
b as (select row_number() over () as r, {_OP4_WORDS} as words from benchmark),
fd as ({_OP13_FEATURES} from d where len(words) > 0),
fb as ({_OP13_FEATURES} from b where len(words) > 0),
crc as (
    select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda c, x: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by n) as steps
    from (select unnest(range(0, 256)) as n)
), named as (
    select f, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(0, length(digits) // 2),
            lambda i: (strpos('0123456789ABCDEF', digits[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', digits[2 * i + 2]) - 1)),
        lambda c, x: xor(steps[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
    from (select f, hex(encode(f)) as digits from (select f from fd union select f from fb)), crc
), s as (select bucket, count(*) as n from fd join named using (f) group by bucket),
t as (select bucket, count(*) as n from fb join named using (f) group by bucket),
sums as (select (select count(*) from fd) as s_all, (select count(*) from fb) as t_all),
gains as (
    select k.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (s_all + 10000) / ((coalesce(s.n, 0) + 1) * (t_all + 10000))))::bigint as gain
    from (select distinct bucket from named) k left join s using (bucket) left join t using (bucket), sums
), weights as (
    select r, count(*) as n_features, floor(sum(gain) / count(*))::bigint as weight
    from fd join named using (f) join gains using (bucket) group by r
), scored as (
    select r, doc_id, len(words) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double)
                                                      / 4294967296))))::bigint as score
    from d left join weights using (r)
), drawn as (
    select r, row_number() over (order by score desc, doc_id) as rank, floor(25 * count(*) over () / 100) as k
    from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when rank <= k then rank end::bigint as rank
from scored left join drawn using (r)
"""
