"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from bazaarline.llm.queries import CODES, LINE_MIN_DOCS, REVISIT_BYTES, TAMPERED_EVERY, URL_RULES
from bazaarline.llm.quality import SYMBOLS, QualityRules
from bazaarline.llm.shared import SPACE

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(value: str) -> str:
    return f"translate({value}, '{UPPER}', '{UPPER.lower()}')"


def _url_rules() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return f"""
with rules(rule_host, rule_path, rule_verdict) as (values {rules}),
parsed as (
    select page_id, coalesce(url, '') as u, position('://' in coalesce(url, '')) as mark from pages
),
rest as (
    select page_id, case when mark > 0 then substr(u, mark + 3) else '' end as r from parsed
),
split as (
    select row_number() over () as n, page_id,
        {_lower("regexp_extract(r, '^[^/?#]*')")} as host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
    from rest
),
fits as (
    select n, rule_host || rule_path as rule, rule_verdict,
        row_number() over (partition by n order by length(rule_host || rule_path) desc) as k
    from split join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
from split left join fits on split.n = fits.n and k = 1"""


def _line_dedup() -> str:
    return f"""
with docs as (
    select row_number() over () as n, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
),
lines as (
    select n, doc_id, unnest(parts) as line, unnest(range(len(parts))) as position from docs
),
keyed as (
    select n, doc_id, line, position,
        {_lower("regexp_replace(line, '^[" + SPACE + "]+|[" + SPACE + "]+$', '', 'g')")} as key
    from lines
),
frequent as (
    select key from keyed where key <> ''
    group by key having count(distinct coalesce(doc_id, -9223372036854775808)) >= {LINE_MIN_DOCS}
),
marked as (
    select n, doc_id, line, position, frequent.key is not null as gone
    from keyed left join frequent on keyed.key = frequent.key
)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by position) filter (not gone), '')) as kept_sha256
from marked group by n"""


def _quality() -> str:
    limits = QualityRules()
    symbols = SYMBOLS.replace("$", "\\$").replace("|", "\\|")
    return f"""
with docs as (
    select row_number() over () as n, doc_id, source, coalesce(text, '') as t from documents
),
split as (
    select n, doc_id, source, t,
        list_filter(regexp_split_to_array(t, '[{SPACE}]+'), lambda x: x <> '') as words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) as lines
    from docs
),
grams as (
    select n, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
    from (select n, words, unnest(range(1, len(words) - 1)) as i from split)
),
twice as (
    select n, unnest([i, i + 1, i + 2]) as spot
    from (select n, i, count(*) over (partition by n, gram) as c from grams) where c > 1
),
repeats as (select n, count(distinct spot) as n_repeat_words from twice group by n),
measured as (
    select n, doc_id, source, len(words) as n_words,
        length(regexp_replace(t, '[{SPACE}]+', '', 'g')) as word_chars,
        length(regexp_replace(t, '[^{symbols}]+', '', 'g')) as n_symbols,
        len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words
    from split left join repeats using (n)
),
failed as (
    select *, n_words < {limits.min_words}
        or 100 * n_repeat_words > {limits.max_repeat_percent} * n_words as base_failed
    from measured
),
hosts as (
    select source, count(*)::double as c, (count(*) filter (base_failed))::double as f
    from failed where source is not null group by source
),
sums as (
    select sum(f) / sum(c) as m, sum(c) as n, count(*) - 1 as by_chance, sum(f * f / c) as squares,
        sum(c) - sum(c * c) / sum(c) - (count(*) - 1) as spread
    from hosts
),
shares as (
    select m, case when m > 0 and m < 1 and spread > 1e-9
        then least(greatest(((squares - n * m * m) / (m * (1 - m)) - by_chance) / spread, 0), 1) else 0 end as share
    from sums
),
verdicts as (
    select source,
        case when share < 1e-9 then m else (f + m * (1 / share - 1)) / (c + 1 / share - 1) end
            > {limits.max_host_rate} as rejected
    from hosts cross join shares
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
    not base_failed and not coalesce(rejected, false) as kept
from failed left join verdicts on failed.source = verdicts.source"""


def _warc() -> str:
    return f"""
with p as (
    select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as payload_bytes from pages
),
first as (
    select h, min(page_id) as first_page from p where payload_bytes >= {REVISIT_BYTES} group by h
)
select page_id, payload_bytes::bigint as payload_bytes, sha256(p.h) as payload_digest,
    case when first_page is not null and page_id is distinct from first_page
        then 'revisit' else 'response' end as record_type,
    case when page_id is distinct from first_page then first_page end as refers_to
from p left join first on p.h = first.h"""


def _vector_codes() -> str:
    """Every round written out: integers only, so the order of sums does not matter."""
    spec = CODES
    near = f"""select p.*, e.entry, list_sum(list_transform(range(1, len(ints) + 1), lambda k: (ints[k] - comps[k]) ** 2))::bigint as d
        from pieces p join books_{{k}} e using (part)"""
    steps = []
    for k in range(spec.rounds + 1):
        steps += [
            f"near_{k} as ({near.format(k=k)})",
            f"""codes_{k} as (select vec_id, label, part, ints, entry, d from near_{k}
                qualify row_number() over (partition by vec_id, part order by d, entry) = 1)""",
        ]
        if k < spec.rounds:
            steps += [
                f"""sums_{k} as (select part, entry, pos, sum(ints[pos])::hugeint as s, count(*) as c
                    from codes_{k}, unnest(range(1, len(ints) + 1)) as u(pos) group by all)""",
                f"""books_{k + 1} as (
                    select b.part, b.entry, coalesce(m.comps, b.comps) as comps from books_{k} b left join (
                        select part, entry, list(((s - ((s % c) + c) % c) // c)::bigint order by pos) as comps
                        from sums_{k} group by all) m using (part, entry))""",
            ]
    last = spec.rounds
    return f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: floor(x::double * {spec.scale})::bigint) as ints
    from embeddings
    where embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
pieces as (
    select vec_id, label, part, ints[part * (len(ints) // {spec.parts}) + 1 : (part + 1) * (len(ints) // {spec.parts})] as ints
    from kept, unnest(range({spec.parts})) as u(part)
),
books_0 as (
    select part, row_number() over (partition by part order by vec_id) - 1 as entry, ints as comps from pieces
    qualify entry < {spec.entries}
),
{", ".join(steps)},
coded as (
    select vec_id, label, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(d)::bigint as error
    from codes_{last} group by all
),
digest as (
    select sha256(string_agg(array_to_string(comps, ','), ',' order by part, entry)) as codebooks_sha256 from books_{last}
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded, digest"""


def _merkle() -> str:
    def value(name: str) -> str:
        return f"coalesce(strlen({name}::varchar)::varchar || ':' || {name}::varchar, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(value, ("doc_id", "source", "lang", n_chars, "text"))) + ")"

    up = "list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))"
    step = """row(case when xor(place >> level, 1) < len(nodes) then nodes[xor(place >> level, 1) + 1] else '' end,
        (place >> level) % 2 = 1)"""
    crc = "xor(list_reduce(list_prepend(4294967295, codes), lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295)"
    return f"""
with recursive crc_table as (
    select list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda a, z: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as crcs
),
hashed as (
    select row_number() over () as rid, doc_id, lang, {leaf("n_chars")} as leaf, {leaf("(n_chars + 1)")} as other,
        list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint) as codes
    from documents
),
ordered as (
    select rid, doc_id, lang, leaf, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
        case when doc_id is not null and {crc} % {TAMPERED_EVERY} = 0 then other else leaf end as start
    from hashed, crc_table
),
levels as (
    select lang, 0 as level, list(leaf order by place) as nodes from ordered group by lang
    union all
    select lang, level + 1, {up} from levels where len(nodes) > 1
),
subroots as (
    select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as place
    from levels where len(nodes) = 1
),
tops as (
    select 0 as level, list(subroot order by place) as nodes from subroots
    union all
    select level + 1, {up} from tops where len(nodes) > 1
),
steps as (
    select rid, level, {step} as step from ordered o join levels l on o.lang is not distinct from l.lang where len(nodes) > 1
    union all
    select rid, 1000 + level, {step.replace("place", "s.place")}
    from ordered o join subroots s on o.lang is not distinct from s.lang, tops where len(nodes) > 1
),
paths as (
    select o.rid, any_value(start) as start, list(step order by level) filter (step is not null) as path
    from ordered o left join steps using (rid) group by o.rid
),
fold as (
    select rid, 0 as k, start as node, coalesce(path, []) as path from paths
    union all
    select rid, k + 1, sha256(case when path[k + 1][2] then path[k + 1][1] || node else node || path[k + 1][1] end), path
    from fold where k < len(path)
)
select doc_id, leaf, subroot, nodes[1] as root,
    sha256(coalesce(list_reduce(list_prepend('', list_transform(path, lambda s: s[1])), lambda a, b: a || b), '')) as proof_sha256,
    node as folded_root, node = nodes[1] as verified
from fold join ordered using (rid) join subroots s on ordered.lang is not distinct from s.lang, tops
where k = len(path) and len(nodes) = 1"""


ORACLES: dict[str, str] = {
    "op1_url_rules": _url_rules(),
    "op3_line_dedup": _line_dedup(),
    "op6_warc": _warc(),
    "op9_quality_rules": _quality(),
    "op11_vector_codes": _vector_codes(),
    "op12_merkle": _merkle(),
}
