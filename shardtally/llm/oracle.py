"""DuckDB SQL for those registered queries that SQL can express, written from the contracts alone."""

from __future__ import annotations

_FIM = r"""
with source as (
    select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), 'null')) as digest from documents
), diced as (
    select doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units,
        [cast('0x' || substr(digest, 8 * i + 1, 8) as bigint) for i in range(4)] as h
    from source
), cut as (
    select *, len(units) as n,
        case
            when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 100 then 'plain'
            when h[4] % 100 < 50 then 'spm'
            else 'psm'
        end as form,
        least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a,
        greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b
    from diced
), parts as (
    select *,
        coalesce(array_to_string(units[1:a], ''), '') as prefix,
        coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
        coalesce(array_to_string(units[b + 1:], ''), '') as suffix
    from cut
)
select doc_id, n, form,
    case when form <> 'plain' then length(prefix) end as prefix_chars,
    case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form
        when 'plain' then text
        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""

_AUDIT = r"""
with source as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), least_ids as (
    select text, min(doc_id) as least from source group by text
), known as (
    select doc_id, max(coalesce(quality, 0)) as quality, max(coalesce(toxic, 0)) as toxic from labels group by doc_id
), flags as (
    select part, coalesce(quality, 0) as good, coalesce(toxic, 0) as toxic,
        cast(len(words) < 50 as integer)
        + 2 * cast(100 * len(list_distinct(words)) < 65 * len(words) as integer)
        + 4 * cast(100 * length(regexp_replace(s.text, '[^A-Z]', '', 'g')) > 5 * length(s.text) as integer)
        + 8 * cast(regexp_matches(s.text, '[#$%&*|]') as integer)
        + 16 * cast(coalesce(s.doc_id > least, false) as integer) as mask
    from source s join least_ids l on s.text = l.text left join known k on s.doc_id = k.doc_id
), classes as (
    select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from flags group by part, mask
), letters as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as f, unnest([1, 2, 4, 8, 16]) as bit
), orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e
    where a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps as (
    select filter_order, step, bits[step] as bit, cast(coalesce(list_sum(bits[1:step - 1]), 0) as integer) as before
    from orders, (select unnest([1, 2, 3, 4, 5]) as step)
), counted as (
    select part, filter_order, step, bit,
        sum(case when mask & before = 0 and mask & bit = 0 then n else 0 end) as kept,
        sum(case when mask & before = 0 and mask & bit > 0 then n else 0 end) as removed,
        sum(case when mask & before > 0 and mask & bit > 0 then n else 0 end) as redundant,
        sum(case when mask = bit then n else 0 end) as unique_fails,
        sum(case when mask & before = 0 and mask & bit > 0 then good else 0 end) as good_lost,
        sum(case when mask & before = 0 and mask & bit > 0 then toxic else 0 end) as toxic_lost
    from steps, classes
    group by part, filter_order, step, bit
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
    cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
    cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from counted
"""

_TOPK = r"""
with vectors as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from vectors q join vectors c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)
), ranked as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""


def _base32(digest: str) -> str:
    """Base32 of a hexadecimal digest of 40 digits: five digits are four letters."""
    letters = [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (cast('0x' || substr({digest}, {5 * i + 1}, 5) as bigint) >> {shift}) % 32 + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0)]
    return " || ".join(letters)


_WARC = f"""
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), firsts as (
    select payload, max(page_id) as first_id from payloads group by payload
), typed as (
    select page_id, p.payload, digest, first_id, first_id is not null and (page_id is null or page_id <> first_id) as revisit
    from payloads p join firsts f on p.payload = f.payload
)
select page_id, cast(strlen(payload) as bigint) as payload_bytes, {_base32('digest')} as payload_digest,
    case when revisit then 'revisit' else 'response' end as record_type,
    case when revisit then first_id end as refers_to
from typed
"""

_REPEATS = r"""
with texts as (
    select row_number() over (order by doc_id, text) as row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
    select row, unnest(range(1, len(words) - 33)) as first, words from texts where len(words) >= 35
), spelled as (
    select row, first, array_to_string(words[first:first + 34], ' ') as spelling from windows
), again as (
    select row, first from (select row, first, count(*) over (partition by spelling) as n from spelled) where n > 1
), gone as (
    select row, list(distinct place) as places from (select row, unnest(range(first, first + 35)) as place from again) group by row
), kept as (
    select t.row, doc_id, words, coalesce(places, []) as places from texts t left join gone g on t.row = g.row
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(places) as bigint) as n_removed,
    sha256(coalesce((select string_agg(word, ' ' order by place) from (select unnest(words) as word, unnest(range(1, len(words) + 1)) as place) w
        where not list_contains(places, place)), '')) as kept_sha256
from kept
"""

_NEAR = r"""
with recursive texts as (
    select row_number() over (order by doc_id, text) as row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
    from documents
), shingles as (
    select distinct row, words[i] || ' ' || words[i + 1] as shingle from (select row, words, unnest(range(1, len(words))) as i from texts)
    union select row, words[1] from texts where len(words) = 1
), sizes as (
    select row, count(*) as n from shingles group by row
), shared as (
    select a.row as a, b.row as b, count(*) as shared from shingles a join shingles b on a.shingle = b.shingle and a.row <> b.row group by a.row, b.row
), links as (
    select a, b from shared s join sizes x on x.row = a join sizes y on y.row = b where 100 * s.shared >= 80 * (x.n + y.n - s.shared)
), reached as (
    select row as a, row as b from texts
    union
    select r.a, l.b from reached r join links l on r.b = l.a
), components as (
    select a as row, min(doc_id) as component_id from reached join texts on row = b group by a
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id is not distinct from component_id as kept
from texts t join components c on t.row = c.row left join sizes s on t.row = s.row
"""

SQL = {
    "op3_exact_topk": _TOPK,
    "op4_arc_to_warc": _WARC,
    "op7_substring_dedup": _REPEATS,
    "op9_minhash_near_dedup": _NEAR,
    "op12_fill_in_middle": _FIM,
    "op13_filter_audit": _AUDIT,
}
