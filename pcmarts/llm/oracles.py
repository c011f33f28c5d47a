"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

import string

from pcmarts.llm.pii import IBAN_LENGTHS

SPACES = r"\x20\x09-\x0D"

QUALITY_RULES = rf"""
with w as (select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+') as ws from documents),
grams as (select r, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3),
named as (select g.r, g.i, [w.ws[g.i], w.ws[g.i + 1], w.ws[g.i + 2]] as g from grams g join w using (r)),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as n from named) where n > 1),
covered as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from twice) group by r),
m as (
  select doc_id, len(ws)::bigint as n_words, length(regexp_replace(t, '[{SPACES}]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACES}]')) as lines,
    coalesce(c.n, 0)::bigint as n_repeat_words,
    length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) as n_upper, length(regexp_replace(t, '[^|!]', '', 'g')) as n_bars
  from w left join covered c using (r)
),
f as (
  select *, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines from m
),
b as (
  select *, (case when n_words < 50 then 1 else 0 end
    + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    + case when word_chars < 2 * n_words then 4 else 0 end
    + case when word_chars > 25 * n_words then 8 else 0 end
    + case when 10 * n_symbols > n_words then 16 else 0 end
    + case when n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines then 32 else 0 end
    + case when 10 * n_upper > 4 * word_chars then 64 else 0 end
    + case when 10 * n_bars > 3 * n_words then 128 else 0 end)::bigint as failed
  from f
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed, failed = 0 as kept, failed from b
"""

WARC = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, octet_length(encode(h))::bigint as payload_bytes, sha256(h) as payload_digest from p),
f as (select *, min(page_id) over (partition by payload_digest) as first from d)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and first is not null and page_id is distinct from first then first end as refers_to
from f
"""

# The mix: targets by water-filling, then whole blocks, documents and one more document in the order of md5 keys.
MIX_SOURCES = rf"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+'))::bigint as size,
    md5('7|=doc|' || coalesce('=' || doc_id, '') || '|=' || len(regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+'))) as key
  from documents
),
s as (select source, sum(size)::bigint as source_size, (row_number() over (order by source is null, encode(source)) - 1) % 3 + 1 as weight from d group by source),
c as (select *, 3 * source_size as cap, sum(source_size) over () as total from s),
l as (
  select *, (total - coalesce(sum(cap) over (order by cap / weight, source is null, encode(source) rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, source is null, encode(source) rows between current row and unbounded following) as unit
  from c
),
h as (select *, min(struct_pack(a := cap / weight, b := unit)) filter (where cap / weight >= unit) over () as share from l),
t as (select source, source_size, least(cap::double, coalesce(share.b * weight, cap::double)) as target from h),
p as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::int as passes, greatest(1, ceil(source_size / 262144))::bigint as blocks from t
),
r as (
  select d.*, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as rest, ('0x' || substr(d.key, 1, 12))::bigint % p.blocks as block
  from d join p on d.source is not distinct from p.source
),
b as (
  select source, block, sum(size) as words, first(rest) as rest, md5('7|=block|' || coalesce('=' || source, '') || '|=' || block) as bkey
  from r group by source, block
),
n as (select *, rest - (sum(words) over (partition by source order by bkey, block) - words) as need from b),
i as (
  select r.*, n.words, n.need, sum(r.size) over (partition by r.source, r.block order by r.key, r.doc_id, r.size rows between unbounded preceding and current row) as upto
  from r join n on r.source is not distinct from n.source and r.block = n.block
),
j as (select *, need - coalesce(max(case when upto <= need then upto end) over (partition by source, block), 0) as room from i),
k as (
  select *, max(case when upto <= need then key end) over (partition by source, block) as last_key,
    min(case when not upto <= need and abs(size - room) < room then struct_pack(off := abs(size - room), key := key) end) over (partition by source, block) as one
  from j
)
select doc_id, size, source_size, target, (size * (passes + case
  when words = 0 then 0 when need >= words then 1 when need > 0 and (coalesce(key <= last_key, false) or coalesce(key = one.key, false)) then 1 else 0 end))::bigint as taken
from k
"""

# Places: what lies between the matches and the matches before, summed.
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"),
    ("card", r"[0-9](?:[ -]?[0-9])+"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
    ("iban", r"[A-Z]{2}[0-9]{2}"),  # how one begins; how long it is depends on the country
)
_COUNTRIES = " ".join(IBAN_LENGTHS.values()).split()
_KNOWN = "|".join(f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
_OTHER = "[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?|[A-Z0-9]{11,30})"


def personal_data() -> str:
    found = " union all ".join(
        f"select r, t, {no} as no, '{kind}' as kind, regexp_extract_all(t, '{pattern}') as ms, regexp_split_to_array(t, '{pattern}') as ps from d" for no, (kind, pattern) in enumerate(_KINDS)
    )
    countries = ", ".join(f"'{c}'" for c in _COUNTRIES)
    end = "(?:[^A-Za-z0-9]|$)"
    return rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
f as ({found}),
e as (select r, t, no, kind, unnest(range(1, len(ms) + 1)) as i, ms, ps from f where len(ms) > 0),
m as (
  select r, t, no, kind, i, ms[i] as m, list_sum([length(x) for x in ps[1:i]]) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) as start,
    right(case when i > 1 and ps[i] = '' then '0' else ps[i] end, 1) as ahead
  from e
),
o as (
  select r, no, kind, start, ahead, case when kind <> 'iban' then m
    when substr(t, start::bigint + 1, 2) in ({countries}) then regexp_extract(substr(t, start::bigint + 1, 72), '^({_KNOWN}){end}', 1)
    else regexp_extract(substr(t, start::bigint + 1, 72), '^({_OTHER}){end}', 1) end as m
  from m
),
n as (select *, regexp_replace(m, '[^0-9]', '', 'g') as digits, replace(m, ' ', '') as plain from o),
v as (
  select r, no, kind, start::bigint as start, (start + length(m))::bigint as stop from n
  where kind = 'email'
    or kind = 'ip' and list_bool_and([length(ltrim(x, '0')) <= 3 and ('0' || right(ltrim(x, '0'), 3))::int <= 255 for x in string_split(m, '.')])
    or kind = 'card' and length(digits) between 14 and 19 and list_sum([
        case when k % 2 = 0 then digits[length(digits) - k]::int else 2 * digits[length(digits) - k]::int - case when digits[length(digits) - k]::int > 4 then 9 else 0 end end
        for k in range(0, length(digits))]) % 10 = 0
    or kind = 'phone' and length(digits) between 10 and 15
    or kind = 'iban' and not regexp_matches(ahead, '[A-Za-z0-9]') and length(plain) between 15 and 34 and list_reduce(
        list_prepend(0, [case when ascii(c) < 58 then ascii(c) - 48 else ascii(c) - 55 end for c in string_split(plain[5:] || plain[:4], '')]),
        lambda a, x: (case when x < 10 then a * 10 + x else a * 100 + x end) % 97) = 1
),
g as (
  select r, string_agg(kind || ':' || start || ':' || stop, ',' order by start, no) as spans,
    string_agg(kind || ':' || start || ':' || stop, ',' order by start, no) filter (where no < 4) as base,
    count(*) filter (where kind = 'email') as n_email, count(*) filter (where kind = 'ip') as n_ip,
    count(*) filter (where kind = 'card') as n_card, count(*) filter (where kind = 'phone') as n_phone
  from v group by r
)
select doc_id, coalesce(n_email, 0)::bigint as n_email, coalesce(n_ip, 0)::bigint as n_ip, coalesce(n_card, 0)::bigint as n_card, coalesce(n_phone, 0)::bigint as n_phone,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (r)
"""


HARD_NEGATIVES = """
with e as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.r, a.vec_id as anchor_id, b.vec_id as id, a.label is not distinct from b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from e a join e b on a.r <> b.r where a.vec_id % 50 = 0
),
p as (select * from s where same qualify row_number() over (partition by r order by score desc, id) <= 5),
n as (
  select p.anchor_id, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.r, p.id order by s.score desc, s.id)::int as rank
  from p join s on s.r = p.r and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
"""


# All pairs of different sets that share a shingle, then the least id that links reach.
MINHASH = rf"""
with recursive w as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^{SPACES}]+') as ws from documents
),
s as (
  select r, doc_id, case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_sort(list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)])) end as sh
  from w
),
k as (select sh, len(sh)::bigint as n, row_number() over () as node, min(doc_id) as first from s group by sh),
e as materialized (select node, unnest(sh) as g from k),
p as (select a.node as x, b.node as y, count(*) as common from e a join e b on a.g = b.g and a.node < b.node group by a.node, b.node),
l as materialized (
  select x, y from p join k a on a.node = x join k b on b.node = y where 100 * common >= 85 * (a.n + b.n - common)
),
u as (select x, y from l union all select y, x from l),
c(node, root) as (select node, node from k union select u.y, c.root from c join u on u.x = c.node),
i as (select c.node, min(k.first) as least from c join k on k.node = c.root group by c.node),
f as (select s.doc_id, k.n as n_shingles, case when k.n = 0 then s.doc_id else i.least end as component_id from s join k on k.sh = s.sh join i on i.node = k.node)
select *, doc_id is not distinct from component_id as kept from f
"""


def merkle_manifest(below: int = 7, above: int = 3) -> str:
    """The manifest for trees of up to 8**below leaves and up to 8**above trees: a step per level, window by window."""

    def step(k: int, tree: str) -> str:
        run = f"partition by {tree}, pos // 8 order by pos rows between"
        # A node's run, the others of it on both sides, and what it folds to; a tree of one node stays as it is.
        return f"""
g{k} as (select *, count(*) over (partition by {tree}) as n,
    coalesce(string_agg(node, '') over ({run} unbounded preceding and 1 preceding), '') as lhs,
    coalesce(string_agg(node, '') over ({run} 1 following and unbounded following), '') as rhs from n{k}),
h{k} as (select *, case when n = 1 then node else sha256(lhs || node || rhs) end as up from g{k}),
n{k + 1} as (select {tree}, pos // 8 as pos, any_value(up) as node from h{k} group by {tree}, pos // 8),"""

    def climb(k: int, start: str, tree: str) -> str:
        return f"""
{start} as (select p.* exclude (spot, proof, folded), p.spot // 8 as spot, p.proof || case when h.n = 1 then '' else h.lhs || h.rhs end as proof,
    case when h.n = 1 then p.folded else sha256(h.lhs || p.folded || h.rhs) end as folded
  from p{k} p join h{k} h on h.{tree} is not distinct from p.{tree} and h.pos = p.spot),"""

    field = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}, '-')".format
    fields = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, [ascii(x)::bigint for x in string_split(doc_id::varchar, '')]), lambda c, b: {byte}), 4294967295)"
    return f"""
with d as (select doc_id, lang, sha256({fields} || {field("text")}) as leaf,
    sha256({fields} || {field("lowered")}) as low from (select *, translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') as lowered from documents)),
l as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as spot from d),
n0 as (select lang, spot as pos, leaf as node from l),{"".join(step(k, "lang") for k in range(below))}
s as (select lang, node as subroot, row_number() over (order by lang is not null, encode(lang)) - 1 as pos from n{below}),
n{below + 1} as (select 1 as one, pos, subroot as node from s),{"".join(step(k, "one") for k in range(below + 1, below + 1 + above))}
r as (select node as root from n{below + 1 + above}),
p0 as (select doc_id, lang, 1 as one, leaf, spot, '' as proof, case when {crc} % 3 = 0 then low else leaf end as folded from l),{"".join(climb(k, f"p{k + 1}", "lang") for k in range(below))}
p{below + 1} as (select p.* exclude (spot), s.subroot, s.pos as spot from p{below} p join s on s.lang is not distinct from p.lang),{"".join(climb(k, f"p{k + 1}", "one") for k in range(below + 1, below + 1 + above))}
z as (select 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified from p{below + 1 + above}, r
"""


ORACLES: dict[str, str] = {
    "op3_quality_rules": QUALITY_RULES,
    "op6_warc": WARC,
    "op8_mix_sources": MIX_SOURCES,
    "op10_personal_data": personal_data(),
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_minhash": MINHASH,
    "op13_merkle_manifest": merkle_manifest(),
}
