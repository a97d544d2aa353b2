"""SQL that gives the rows of the registered queries, for the operators that SQL can express."""

from __future__ import annotations

from quayside.llm import chat, collocations, decontaminate, divergence, repeats, secret_scan

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATE = f"""
with docs as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
items as (select item_id::varchar as item, {_WORDS} as w from benchmark where item_id is not null),
sized as (select item, w, least({decontaminate.WINDOW}, len(w)) as n from items where len(w) > 0),
places as (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from sized),
windows as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as win from places),
sizes as (select distinct n from windows),
doc_places as (
    select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from docs join sizes on len(w) >= n),
doc_windows as (select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as win from doc_places),
hits as (select rid, d.n, i, item from doc_windows d join windows using (win, n)),
covered as (
    select rid, count(distinct p) as n_hit
    from (select rid, unnest(range(i, i + n)) as p from hits) group by rid),
named as (
    select rid, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct rid, item from hits) group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (rid) left join named using (rid)
"""

PERSPECTIVES = f"""
with turns as (select distinct conv_id, turn, role, text from conversations),
placed as (
    select *, row_number() over (
        partition by conv_id order by turn nulls first, role nulls first, text nulls first) - 1 as place
    from turns),
seen as (
    select p.conv_id, s.participant, place // {chat.BLOCK} as block, place,
        p.role is not distinct from s.participant as own,
        case when p.role is not distinct from s.participant then '{chat.BEGIN}assistant' || chr(10)
            else '{chat.BEGIN}user' || coalesce(' name=' || replace(p.role, '<|', '< |'), '') || chr(10)
            end as head,
        replace(coalesce(p.text, ''), '<|', '< |') || '{chat.END}' as body
    from placed p
    join (select distinct conv_id, role as participant from turns where role is not null) s
        on p.conv_id is not distinct from s.conv_id),
summed as (
    select *, sum(length(head) + length(body) + 1) over (
        partition by conv_id, participant, block order by place) - length(body) - 1 as start
    from seen)
select conv_id, participant, block, count(*) as n_turns, count(*) filter (own) as n_targets,
    string_agg(head || body || chr(10), '' order by place) as text,
    coalesce(string_agg(start::bigint || '-' || (start + length(body))::bigint, ',' order by place)
        filter (own), '') as mask
from summed group by conv_id, participant, block
"""

REPEATS = rf"""
with docs as (
    select row_number() over () as rid, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents),
places as (
    select rid, doc_id, w, unnest(range(1, len(w) - {repeats.WINDOW - 2})) as i
    from docs where len(w) >= {repeats.WINDOW} and doc_id is not null),
windows as (
    select rid, doc_id, i, array_to_string(w[i:i + {repeats.WINDOW - 1}], ' ') as win from places),
firsts as (select win, min(doc_id) as first_doc from windows group by win),
gone as (
    select distinct rid, unnest(range(i, i + {repeats.WINDOW})) as p
    from windows join firsts using (win) where doc_id > first_doc),
words as (select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs),
kept as (
    select rid, string_agg(word, ' ' order by p) as text, count(*) as n
    from words anti join gone using (rid, p) group by rid)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
    sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (rid)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: str, pattern: str) -> str:
    """Rows (rid, kind, place of the kind, start, match) by the lengths of matches and of what is between."""
    order = (*secret_scan.KINDS, "candidate").index(kind)
    p = _quoted(pattern)
    return f"""
select rid, '{kind}' as kind, {order} as ord, found[i] as match,
    list_sum(list_transform(between[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as start
from (select *, unnest(range(1, len(found) + 1)) as i from (
    select rid, regexp_extract_all(text, {p}, 0) as found, string_split_regex(text, {p}) as between
    from docs))"""


def _unguarded(pattern: str) -> str:
    """Without the look at the character before, which only saves time: runs match from their start."""
    return pattern[pattern.index(")") + 1 :] if pattern.startswith("(?<!") else pattern


_W = secret_scan.WINDOW
_UUID = _quoted(secret_scan.UUID)
_SEGMENT = f"""regexp_matches(x, {_UUID}) or len(list_filter(
    string_split_regex(x, '[_-]'), lambda y: not regexp_matches(y, {_quoted(secret_scan.PATH_WORD)}))) = 0"""
_LIMIT = " ".join(
    f"when regexp_matches(match, '{pattern}') then {least}" for _, pattern, least in secret_scan.CLASSES[:-1]
)

SECRETS = f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
found as ({" union all ".join(
    _matches(kind, _unguarded(pattern))
    for kind, pattern in zip(
        (*secret_scan.KINDS, "candidate"),
        (secret_scan.ASSIGN, secret_scan.ACCESS, secret_scan.HEX, secret_scan.CANDIDATE % _W),
    ))}),
base as (
    select rid, kind, ord, start, start + length(match) as stop from found
    where kind <> 'candidate' and (kind <> 'assign'
        or length(regexp_extract(match, {_quoted(secret_scan.ASSIGN)}, 2)) >= {secret_scan.ASSIGN_LEAST})),
candidates as (
    select rid, start, match, case {_LIMIT} else {secret_scan.CLASSES[-1][2]} end as least
    from found
    where kind = 'candidate' and regexp_matches(match, '[0-9]') and regexp_matches(match, '[A-Za-z]')
        and not regexp_matches(match, {_UUID})
        and not (contains(match, '/')
            and len(list_filter(string_split(match, '/'), lambda x: not ({_SEGMENT}))) = 0)),
slid as (
    select rid, start as begin, least, unnest(range(1, length(match) - {_W - 2})) as i, match
    from candidates),
parts as (select *, substr(match, i, {_W}) as part from slid),
rated as (
    select *, log2({_W}) - list_sum(list_transform(list_distinct(string_split(part, '')),
            lambda x: ({_W} - length(replace(part, x, ''))) * log2({_W} - length(replace(part, x, ''))))) / {_W} as bits
    from parts),
high as (
    select *, lag(i) over (partition by rid, begin order by i) as last from rated
    where bits >= least - 1e-9 and not regexp_matches(part, '(?i){secret_scan.EXAMPLES}')
        and len(list_filter(list_distinct(string_split(part, '')),
            lambda x: contains(part, repeat(x, {secret_scan.RUN})))) = 0),
islands as (
    select *, count(*) filter (last is null or i - 1 > last - 1 + {_W})
        over (partition by rid, begin order by i) as island from high),
added as (
    select rid, 'entropy' as kind, {len(secret_scan.KINDS)} as ord, begin + min(i) - 1 as start,
        begin + max(i) - 1 + {_W} as stop
    from islands group by rid, begin, island),
spans as (
    select * from base union all
    select a.* from added a where not exists (
        select 1 from base b where b.rid = a.rid and b.start <= a.start and a.stop <= b.stop)),
listed as (
    select rid, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in secret_scan.KINDS)},
        string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, ord)
            filter (kind <> 'entropy') as base,
        string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ',' order by start, ord) as spans
    from spans group by rid)
select doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in secret_scan.KINDS)},
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join listed using (rid)
"""

_SHARE = "1 + (1000000000::hugeint * ({0} + 1)) // ({1} + {2})"

DIVERGENCE = f"""
with docs as (
    select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{divergence.TERM}') as w
    from documents),
places as (select rid, lang, source, unnest(w) as term from docs),
kept as (
    select lang, term from places group by lang, term
    having count(distinct rid) >= {divergence.LEAST_DOCUMENTS}),
counts as (select lang, source, term, count(*) as n from places join kept using (lang, term) group by all),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (
    select g.lang, g.source, coalesce(v, 0) as v,
        coalesce((select sum(n) from counts c where c.lang = g.lang and c.source = g.source), 0) as total
    from (select distinct lang, source from docs) g left join sizes using (lang)),
grid as (
    select g.lang, g.source, term, coalesce(n, 0) as n, {_SHARE.format("coalesce(n, 0)", "total", "v")} as p
    from groups g join kept using (lang) left join counts using (lang, source, term)),
pairs as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all),
all_pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source),
expected as (
    select lang, term, {_SHARE.format("sum(n)", "max(total)", "max(v)")} as q
    from counts join (select lang, sum(total) as total, max(v) as v from groups group by lang) using (lang)
    group by lang, term),
terms as (
    select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value
    from grid join expected using (lang, term) where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from all_pairs union all select * from terms))
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= {divergence.TERM_RANKS}
"""

COLLOCATIONS = f"""
with docs as (
    select row_number() over () as rid, coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents),
pieces as (select rid, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from docs),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
sizes as (select unnest(range(1, {collocations.LONGEST + 1})) as m),
places as (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from worded join sizes on len(w) >= m),
counts as (
    select lang, m, w[i:i + m - 1] as words, count(*) as f from places group by all),
totals as (select lang, sum(f) as n from counts where m = 1 group by lang),
candidates as (select * from counts where m > 1 and f >= {collocations.SUPPORT}),
cuts as (select lang, m, words, f, unnest(range(1, m)) as k from candidates),
rated as (
    select c.lang, c.m, c.words, c.f as a, k, l.f as l, r.f as r,
        ({collocations.SCORE_UNIT}::hugeint * c.f) // (l.f + r.f) as score
    from cuts c join counts l on l.lang = c.lang and l.words = c.words[1:k]
    join counts r on r.lang = c.lang and r.words = c.words[k + 1:]),
lowest as (
    select lang, m, words, a, min(row(score, k, l, r)) as cut from rated group by all),
longer as (
    select lang, f, words, m, unnest(range(2, m)) as part from candidates where m > 2),
inside as (
    select lang, f, words[i:i + part - 1] as words
    from (select *, unnest(range(1, m - part + 2)) as i from longer)),
around as (select lang, words, max(f) as f from inside group by all),
named as (
    select c.lang, array_to_string(c.words, ' ') as phrase, a, cut[1] as score, cut[3] as l, cut[4] as r
    from lowest c left join around on around.lang = c.lang and around.words = c.words
    where around.f is null or 100 * around.f < {collocations.ABSORBED_PERCENT} * a),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named)
select lang, rank::int as rank, phrase, a, l, r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= {collocations.REPORTED}
"""
