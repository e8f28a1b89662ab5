"""SQL for the operators whose results SQL can express."""

from __future__ import annotations

from recordmill.llm import resampling, substring

# The five filters, cells counted per part, and every order and step as a filter on the cells.
FILTER_AUDIT = r"""
with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), flags as (
    select doc_id, part, t,
        len(w) < 200 as a,
        100 * len(list_distinct(w)) < 50 * len(w) as b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) as c,
        regexp_matches(t, '[#$%&*|]') as d,
        coalesce(doc_id > min(doc_id) over (partition by t), false) as e
    from texts
), labelled as (
    select flags.*, coalesce(good, false) as good, coalesce(toxic, false) as toxic
    from flags left join (
        select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic
        from labels group by doc_id
    ) as l using (doc_id)
), cells as (
    select part, (a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int) as cell, count(*) as n,
        count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
    from labelled group by all
), letter as (select range as i, substr('ABCDE', range + 1, 1) as name from range(5)),
orders as (
    select p.name || q.name || r.name || s.name || t.name as filter_order, [p.i, q.i, r.i, s.i, t.i] as axes
    from letter p, letter q, letter r, letter s, letter t
    where len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5
), steps as (
    select filter_order, step::int as step, (1 << axes[step])::int as own,
        list_sum(list_transform(axes[:step - 1], lambda x: 1 << x))::int as before
    from orders, range(1, 6) as s(step)
), figures as (
    select part, filter_order, step, own,
        sum(n) filter (cell & own = 0 and cell & coalesce(before, 0) = 0) as kept,
        sum(n) filter (cell & own > 0 and cell & coalesce(before, 0) = 0) as removed,
        sum(n) filter (cell & own > 0 and cell & coalesce(before, 0) > 0) as redundant,
        sum(n) filter (cell = own) as unique_fails,
        sum(n_good) filter (cell & own > 0 and cell & coalesce(before, 0) = 0) as good_lost,
        sum(n_toxic) filter (cell & own > 0 and cell & coalesce(before, 0) = 0) as toxic_lost
    from cells, steps group by all
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
    coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
    coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
    coalesce(sum(removed) over (partition by part, own), 0)::bigint as shapley
from figures
"""

# crc32 by bytes, with the table made by its rule; it is computed once per different word.
RESAMPLING = rf"""
with crc_table as (
    select list(v order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
        from range(256) as r(i)
    )
), texts as (
    select 'd' as kind, doc_id, text from documents union all select 'b', null, text from benchmark
), rows as (
    select row_number() over () as row, kind, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from texts
), counted as (
    select row, kind, word, count(*) as n from (select row, kind, unnest(w) as word from rows) group by all
), bytes as (
    select word, list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::bigint) as b
    from (select distinct word from counted)
), buckets as (
    select word, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)
        % {resampling.BUCKETS} as bucket
    from bytes, crc_table
), totals as (
    select bucket, coalesce(sum(n) filter (kind = 'd'), 0)::double as s, coalesce(sum(n) filter (kind = 'b'), 0)::double as t
    from counted join buckets using (word) group by bucket
), gains as (
    select bucket, floor(1000 * ln((t + 1) * (all_s + {resampling.BUCKETS}) / ((s + 1) * (all_t + {resampling.BUCKETS}))))::bigint as gain
    from totals, (select sum(s) as all_s, sum(t) as all_t from totals)
), weights as (
    select row, sum(n)::bigint as n_features, floor(sum(n * gain) / sum(n))::bigint as weight
    from counted join buckets using (word) join gains using (bucket) where kind = 'd' group by row
), scores as (
    select rows.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('{resampling.SEED}:' || coalesce(rows.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296
        )))::bigint as score
    from rows left join weights using (row) where kind = 'd'
), placed as (
    select *, n_features >= {resampling.MIN_WORDS} as eligible, row_number() over (
        partition by n_features >= {resampling.MIN_WORDS} order by score desc, doc_id nulls last, n_features
    ) as place, count(*) filter (n_features >= {resampling.MIN_WORDS}) over () as n
    from scores
)
select doc_id, n_features, weight, score, case when eligible and place <= {resampling.PERCENT} * n // 100 then place end as rank from placed
"""

# One record per page; of equal large payloads the largest page is the response.
WARC = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), firsts as (select payload_digest, max(page_id) as response from payloads where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
    case when response <> page_id then 'revisit' else 'response' end as record_type,
    case when response <> page_id then response end as refers_to
from payloads left join firsts using (payload_digest)
"""

# Windows by their digests; a word goes if the last repeated window that starts at or before it reaches it.
SUBSTRING = rf"""
with texts as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), windows as (
    select r, unnest(range(1, len(w) - {substring.WINDOW - 2})) as i,
        unnest(list_transform(range(1, len(w) - {substring.WINDOW - 2}), lambda i: md5(array_to_string(w[i:i + {substring.WINDOW - 1}], ' ')))) as digest
    from texts where len(w) >= {substring.WINDOW}
), repeated as (
    select r, i from windows qualify count(*) over (partition by digest) > 1
), words as (
    select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from texts
), marked as (
    select r, i, word, coalesce(i - max(s) over (partition by r order by i) < {substring.WINDOW}, false) as gone
    from words left join (select r, i, i as s from repeated) as s using (r, i)
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join (
    select r, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept
    from marked group by r
) as k using (r)
"""

# All pairs of different shingle sets that share a shingle, and what can be reached by links.
NGRAM_JOIN = r"""
with recursive texts as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select r, list_sort(list_distinct(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: md5(array_to_string(w[i:i + 4], ' '))))) as s
    from texts where len(w) > 0
), named as (select r, md5(array_to_string(s, '')) as class, s from sets
), classes as (
    select class, any_value(s) as s, len(any_value(s)) as n, count(*) as n_rows, min(doc_id) as first
    from named join texts using (r) group by class
), shingles as (select class, n, unnest(s) as shingle from classes
), links as (
    select a.class as one, b.class as other from shingles a join shingles b on a.shingle = b.shingle and a.class <> b.class
    group by a.class, b.class, a.n, b.n having 10 * count(*) >= 8 * (a.n + b.n - count(*))
), reach as (
    select class as one, class as other from classes
    union
    select reach.one, links.other from reach join links on reach.other = links.one
), lowest as (select one as class, min(first) as class_id from reach join classes on other = class group by one
), linked as (select one as class, sum(n_rows) as linked from links join classes on other = class group by one)
select doc_id, case when class is null then doc_id else class_id end as class_id,
    (coalesce(linked, 0) + coalesce(n_rows, 1) - 1)::bigint as n_links, coalesce(n_rows, 1)::bigint as n_copies
from texts left join named using (r) left join classes using (class) left join lowest using (class) left join linked using (class)
"""

ORACLE = {"op3_ngram_join": NGRAM_JOIN, "op4_substring": SUBSTRING, "op7_warc": WARC, "op11_resampling": RESAMPLING, "op13_filter_audit": FILTER_AUDIT}
