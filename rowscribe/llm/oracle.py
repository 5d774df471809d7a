"""SQL that the queries of the operators must equal, where SQL can express them.

Lists are folded with DuckDB's lambdas; bytes are handled as pairs of hex digits.
"""

from __future__ import annotations

from rowscribe.llm.quality_rules import STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = """
with docs as (
    select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), windows as (
    select r, doc_id, place, substr(h, place * 2 + 1, 100) as w
    from (select r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) as place from docs where length(h) >= 100)
), least as (
    select w, min(doc_id) as first from windows group by w
), repeated as (
    select r, place, place + 50 as stop from windows join least using (w) where doc_id > first
), islands as (
    select r, place, stop,
           sum(case when place <= coalesce(reach, -1) then 0 else 1 end) over (partition by r order by place) as island
    from (select r, place, stop, max(stop) over (partition by r order by place rows between unbounded preceding and 1 preceding) as reach from repeated)
), spans as (
    select r, min(place) as b, max(stop) as e from islands group by r, island
), gaps as (
    select r, b, e, coalesce(lag(e) over (partition by r order by b), 0) as kept_from from spans
), cut as (
    select r, sum(e - b) as n_removed, count(*) as n_spans, max(e) as last_end,
           string_agg(substr(h, kept_from * 2 + 1, (b - kept_from) * 2), '' order by b) as kept
    from gaps join docs using (r) group by r
)
select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(case when cut.r is null then h else kept || substr(h, last_end * 2 + 1) end)) as kept_sha256
from docs left join cut using (r)
"""

_OP7 = """
with v as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
    where q.vec_id % 50 = 0
), ranked as (
    select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

_OP8 = f"""
with split as (
    select doc_id, coalesce(text, '') as text, {_WORDS} as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
    from documents
), windowed as (
    select *, list_transform(range(1, greatest(len(words) - 3, 1)), lambda i: array_to_string(words[i:i + 4], ' ')) as windows from split
), twice as (
    select doc_id, list_sort(flatten(list(places) filter (n > 1))) as places
    from (select doc_id, w, count(*) as n, list(place) as places
          from (select doc_id, unnest(windows) as w, unnest(range(1, len(windows) + 1)) as place from windowed) group by doc_id, w)
    group by doc_id
), measured as (
    select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
           (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
           coalesce(list_sum(list_transform(range(1, len(places) + 1),
               lambda k: least(5, coalesce(places[k + 1] - places[k], 5)))), 0)::bigint as n_repeat_words,
           len(lines)::bigint as n_lines,
           (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::bigint as n_capitals,
           (length(text) - length(translate(text, '!', '')))::bigint as n_exclamations,
           len(list_filter(words, lambda w: list_contains({STOP_WORDS}, lower(w))))::bigint as n_stop_words
    from windowed left join twice using (doc_id)
), based as (
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured
)
select *, not base_failed
          and 100 * word_chars >= 150 * n_words and 100 * word_chars <= 3000 * n_words
          and 100 * n_symbols <= 10 * n_words
          and (n_words < 10 or 100 * n_capitals <= 30 * word_chars)
          and (n_words < 10 or 100 * n_exclamations <= 30 * n_words)
          and (n_words < 50 or 100 * n_stop_words >= 3 * n_words)
          and 100 * n_dup_lines <= 50 * n_lines as kept
from based
"""

_OP9 = f"""
with recursive words as (
    select doc_id, list_transform(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), lambda w: w) as words
    from documents
), sets as (
    select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) = 1 then [words[1]]
                   else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as s
    from words
), items as (
    select doc_id, len(s) as n, unnest(s) as item from sets
), shared as (
    select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as common
    from items a join items b on a.item = b.item and a.doc_id < b.doc_id
    where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by all
), links as (
    select a, b from shared where 100 * common >= 80 * (na + nb - common)
), both_ways as (
    select a, b from links union all select b, a from links
), reach as (
    select a, b from both_ways union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a
), least_of as (
    select a as doc_id, min(b) as b from reach group by a
)
select doc_id, len(s)::bigint as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id,
       doc_id = least(doc_id, coalesce(b, doc_id)) as kept
from sets left join least_of using (doc_id)
"""

# The crc32 goes bit by bit over the digits of the id. A run is an island of places whose
# five words equal those a lag further on; of equal stretches the smallest lag is the period.
_OP11 = r"""
with split as (
    select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as own, len(own) as n,
           xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
               lambda crc, x: xor(xor(crc, x) >> 1, 3988292384 * (xor(crc, x) & 1))), 4294967295) as h
    from documents
), planned as (
    select *, (h // 10) % greatest(n, 1) as a, 1 + (n - a) // (3 + (h // 10) % 8) as p from split
), texts as (
    select r, doc_id, n, case when h % 10 = 0 and n > 0
        then list_transform(range(0, n), lambda i: own[1 + case when i < a then i else a + (i - a) % p end]) else own end as words
    from planned
), grams as (
    select r, i, array_to_string(words[i + 1:i + 5], ' ') as gram from (select r, words, unnest(range(0, n - 4)) as i from texts where n >= 6)
), pairs as (
    select x.r, x.i, y.i - x.i as lag from grams x join grams y on x.r = y.r and x.gram = y.gram and x.i < y.i
), islands as (
    select r, lag, min(i) as start, max(i) - min(i) + 5 + lag as length
    from (select *, i - row_number() over (partition by r, lag order by i) as island from pairs) group by r, lag, island
), runs as (
    select r, start, length, min(lag) as period from islands where length >= greatest(6, 4 * lag) group by r, start, length
), dropped as (
    select distinct r, unnest(range(start + period, start + length)) as i from runs
), kept as (
    select r, string_agg(word, ' ' order by i) as text
    from (select r, unnest(words) as word, unnest(range(0, n)) as i from texts) anti join dropped using (r, i) group by r
), listed as (
    select r, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from runs group by r
), best as (
    select * from runs x
    where not exists (from runs y where y.r = x.r and (y.length * x.period > x.length * y.period
        or (y.length * x.period = x.length * y.period and (y.start, y.period) < (x.start, x.period))))
)
select doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length, period::bigint as period,
       (1000 * length // period)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from texts left join listed using (r) left join best using (r) left join kept using (r)
"""

_OP13 = r"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents
), words as (
    select r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from docs
), kept as (
    select lang, term, count(*) as n from words group by all having count(distinct r) >= 30
), langs as (
    select lang, count(term) as v, coalesce(sum(n), 0) as total from (select distinct lang from docs) left join kept using (lang) group by lang
), own as (
    select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all
), sources as (
    select lang, source, coalesce(sum(n), 0) as total from (select distinct lang, source from docs) left join own using (lang, source) group by all
), prices as (
    select s.lang, s.source, k.term, coalesce(o.n, 0) as n,
           1 + (1000000000::hugeint * (coalesce(o.n, 0) + 5)) // (s.total + 5 * l.v)::hugeint as p, 1 + (1000000000::hugeint * (k.n + 5)) // (l.total + 5 * l.v)::hugeint as q
    from sources s join langs l using (lang) join kept k using (lang) left join own o on o.lang = s.lang and o.source = s.source and o.term = k.term
), pairs as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from prices a join prices b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), listed as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from sources a join sources b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    union all select lang, source, 'term', term, p - q from prices where n > 0 and p > q
), ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from listed
)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 50
"""

ORACLE: dict[str, str] = {
    "op1_suffix_dedup": _OP1,
    "op7_top_k": _OP7,
    "op8_quality_rules": _OP8,
    "op9_near_dedup": _OP9,
    "op11_periodic_runs": _OP11,
    "op13_source_audit": _OP13,
}
