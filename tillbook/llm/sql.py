"""DuckDB statements for the operators that SQL expresses over whole tables."""

from __future__ import annotations

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256


def _vector_codes() -> str:
    """Every distance of every part to every entry, once for each round and once for the codes."""
    steps = [
        f"""
kept as (
  select row_number() over (order by vec_id, embedding) as v, vec_id, label,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as q
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
parts as materialized (
  select v, vec_id, label, p, q[1 + p * (len(q) // {PARTS}) : (p + 1) * (len(q) // {PARTS})] as part
  from kept, range({PARTS}) r(p)),
book0 as materialized (select p, v - 1 as e, part as entry from parts where v <= {ENTRIES})"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""
near{i} as materialized (
  select v, p, part, min(d) as d, min_by(e, (d::hugeint << 8) + e) as e from (
    select v, p, part, e, list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from parts join book{i} using (p))
  group by all)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""
book{i + 1} as materialized (
  select p, e, coalesce(moved, entry) as entry from book{i} left join (
    select p, e, list(floor_div order by i) as moved from (
      select p, e, i, ((s - ((s % n) + n) % n) // n)::bigint as floor_div from (
        select p, e, i, sum(part[i])::bigint as s, count(*) as n
        from near{i}, range(1, 1 + (select max(len(part)) from parts)) r(i) group by all))
    group by all) using (p, e))"""
            )
    return f"""
with {",".join(steps)},
coded as (
  select v, string_agg(lpad(printf('%x', e), 2, '0'), '' order by p) as code, sum(d)::bigint as error
  from near{ROUNDS} group by v),
named as (select vec_id, label, code, error from kept join coded using (v)),
digest as (
  select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) as codebooks_sha256 from book{ROUNDS})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from named, digest
"""


# crc32 of a decimal number: a byte is followed by eight shifts.
CRC = """
xor(list_reduce(
  list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(conv_id::varchar, ''), lambda c: list_prepend(ord(c)::bigint, [-1::bigint, -1, -1, -1, -1, -1, -1, -1])))),
  lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a >> 1, 3988292384::bigint) else a >> 1 end), 4294967295::bigint)
"""

CONVERSATION_TRIE = f"""
with own as (
  select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first, role, text) as turns
  from conversations where conv_id is not null group by conv_id),
shaped as (select conv_id, turns, ({CRC} % 6)::bigint as h from own),
rebuilt as materialized (
  select s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) as turns
  from shaped s left join own b on b.conv_id = s.conv_id - s.conv_id % 100),
visits as materialized (select conv_id, d, turns[1:d] as prefix, d = len(turns) as ends from rebuilt, unnest(range(0, len(turns) + 1)) r(d)),
nodes as materialized (
  select prefix, min(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from visits group by prefix),
parents as (
  select c.prefix, p.prefix as above, p.conv_id as parent_conv_id from nodes c join nodes p on p.prefix = c.prefix[1:c.depth - 1] and c.depth > 0),
children as (select above as prefix, count(*) as n_children from parents group by above),
weighed as (
  select n.prefix, n.depth, (n_children is null)::bigint as leaf,
         case when n.depth = 0 then 0 else (n_convs - 1) * length(n.prefix[n.depth].t) end as saved
  from nodes n left join children using (prefix)),
sums as (
  select w.prefix[1:d] as prefix, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
  from weighed w, unnest(range(0, w.depth + 1)) r(d) group by 1)
select n.conv_id, n.depth::bigint as depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, ends_sha256
from nodes n join sums using (prefix) left join parents using (prefix) left join children using (prefix)
"""

ARCHIVE_RECORDS = """
with payloads as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
responses as (select payload_digest, max(page_id) as response from payloads where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when page_id <> response then 'revisit' else 'response' end as record_type,
       case when page_id <> response then response end as refers_to
from payloads left join responses using (payload_digest)
"""

STATEMENTS = {
    "op11_vector_codes": _vector_codes(),
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_archive_records": ARCHIVE_RECORDS,
}
