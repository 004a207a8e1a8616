"""SQL that must give the same rows as a query, where SQL can express it."""

from __future__ import annotations

from rowgraft.llm.licenses import COPYRIGHT, SPELLINGS, variants
from rowgraft.llm.line_dedup import PASSAGE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    spellings = "map {" + ", ".join(f"{_text(a)}: {_text(b)}" for a, b in SPELLINGS.items()) + "}"
    plain = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT}', ' ', 'g')"
    words = f"string_split(trim(regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: coalesce({spellings}[w], w)), ' ')"


def _crc32(text: str) -> str:
    """crc32 of an ASCII text: each byte goes into the state, then eight steps (-1)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    state = f"list_reduce(list_prepend(4294967295::bigint, {steps}), lambda s, x: case when x >= 0 then xor(s, x) else xor(s >> 1, 3988292384 * (s & 1)) end)"
    return f"xor({state}, 4294967295)"


_KNOWN = ", ".join(f"({_text(a)}, {_text(b)})" for a, b in variants())

ORACLES = {
    "op1_line_dedup": rf"""
with split as (
    select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as k
    from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\n]*?(?:[.!?]+[ \t]+|[。！？]+)|[^\n]+|\n') as parts from documents)
), placed as (
    select doc_id, k, part, length(part) as n, sum(length(part)) over (partition by doc_id order by k) - length(part) as pos,
        trim(regexp_replace(lower(part), '[ \t\r\f\v]+', ' ', 'g'), ' ') as plain
    from split
), counted as (
    select *, row_number() over (partition by plain order by doc_id, k) as nth, count(*) over (partition by plain) as times, row_number() over (partition by doc_id order by k) as u
    from placed where plain not in ('', chr(10))
), runs as (
    select doc_id, sum(len(string_split(plain, ' '))) as words
    from (select *, u - row_number() over (partition by doc_id order by u) as run from counted where times > 1) group by doc_id, run
), passages as (select doc_id, max(words) as words from runs where words >= {PASSAGE} group by doc_id),
told as (
    select doc_id, count(*) as n_units, count(*) filter (nth > 1) as n_removed, coalesce(sum(n) filter (nth > 1), 0) as n_chars_removed,
        coalesce(string_agg(pos || '-' || (pos + n), ',' order by k) filter (nth > 1), '') as removed_spans
    from counted group by doc_id
)
select d.doc_id, coalesce(n_units, 0) as n_units, coalesce(n_removed, 0) as n_removed, coalesce(n_chars_removed, 0)::bigint as n_chars_removed, coalesce(removed_spans, '') as removed_spans,
    coalesce(words, 0)::bigint as n_passage_words
from documents d left join told using (doc_id) left join passages using (doc_id)""",
    "op3_license_digest": f"""
with known as (
    select sha256({_canonical("text")}) as digest, min(license_id) as license_id from (values {_KNOWN}) as v(license_id, text) group by 1
)
select doc_id, d.digest, license_id from (select doc_id, sha256({_canonical("text")}) as digest from documents) d left join known using (digest)""",
    "op4_benchmark_index": """
with words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark
), windows as (
    select distinct item_id, array_to_string(w[k:k + 9], ' ') as phrase, least(10, len(w)) as size
    from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as k from item_words where len(w) > 0)
), sizes as (select distinct size from windows),
found as (
    select distinct doc_id, k, x.size, item_id
    from (select doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') as phrase from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k from words, sizes)) x
    join windows y on x.phrase = y.phrase and x.size = y.size
), hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(k, k + size)) as p from found) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names from (select distinct doc_id, item_id from found) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hits using (doc_id) left join items using (doc_id)""",
    "op9_cover_tree": """
with fit as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, d.vec_id, list_inner_product(q.v, d.v)::bigint as score
    from fit q join fit d on q.vec_id <> d.vec_id and len(q.v) = len(d.v) where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5""",
    "op11_prefix_trie": f"""
with turns as (
    select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
    from conversations where conv_id is not null
), convs as (
    select distinct c, c - c % 20 as base, {_crc32("c::varchar")} % 4 as h from turns
), placed as (
    select v.c, 0 as own, k, role, text from convs v join turns t on t.c = v.base where k <= h
    union all
    select v.c, 1 as own, k, role, text from convs v join turns t on t.c = v.c where k > h
), seqs as (
    select c, coalesce(list(md5(length(role) || ':' || role || text) order by own, k) filter (k is not null), []) as turns,
        coalesce(list(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) order by own, k) filter (k is not null), []) as words
    from convs left join placed using (c) group by c
), members as (
    select c, d, array_to_string(turns[1:d], '') as key, coalesce(words[d], 0) as words, len(turns) = d as ends
    from (select *, unnest(range(0, len(turns) + 1)) as d from seqs)
), nodes as (
    select key, d, min(c) as conv_id, count(*) as n_convs, any_value(words) as words, string_agg(c::varchar, ',' order by c) filter (ends) as ends from members group by key, d
), down as (
    select a.key, count(*) filter (not exists (select 1 from nodes x where x.d = b.d + 1 and starts_with(x.key, b.key))) as n_leaves,
        sum((b.n_convs - 1) * b.words) as saved_tokens, count(*) filter (b.d = a.d + 1) as n_children
    from nodes a join nodes b on starts_with(b.key, a.key) group by a.key
)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens::bigint as saved_tokens, sha256(coalesce(n.ends, '')) as ends_sha256
from nodes n join down using (key) left join nodes p on p.d = n.d - 1 and p.key = left(n.key, 32 * (n.d - 1)::int)""",
    "op12_fill_middle": f"""
with cut as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as u,
        list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), k, 8))::bigint) as h
    from documents
), picked as (
    select *, len(u) as n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form
    from cut
), parts as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from picked)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
    sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
    sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
from parts""",
}
