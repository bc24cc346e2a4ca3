"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from fundspark.llm.licenses import COVER, GRAM, NEIGHBOUR, NOTICES, PHRASES, notice_words

_ASCII_LOWER = (
    "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

NEAR_DEDUP = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_ASCII_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') as w
  from documents
), grams as (
  select distinct doc_id, unnest(case
    when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g
  from words
), sizes as (select doc_id, count(*) as n from grams group by doc_id
), pairs as (
  select x.doc_id as a, y.doc_id as b, count(*) as shared
  from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by all
), links as (
  select a, b from pairs join sizes sa on sa.doc_id = a join sizes sb on sb.doc_id = b
  where 100 * shared >= 80 * (sa.n + sb.n - shared)
), edges as (select a, b from links union all select b, a from links
), reach(a, b) as (
  select doc_id, doc_id from documents
  union select r.a, e.b from reach r join edges e on e.a = r.b
), roots as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.component_id, d.doc_id = r.component_id as kept
from documents d join roots r using (doc_id) left join sizes s using (doc_id)
"""

TOP_PRODUCTS = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""


def _license_sql() -> str:
    grams = []
    for template, (label, text) in enumerate(NOTICES):
        words = notice_words(text)
        size = len(words) - GRAM + 1
        for at in range(size):
            grams.append(f"({template}, '{label}', {size}, {at}, '{' '.join(words[at : at + GRAM])}')")
    phrases = [f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES.items()]
    return f"""
with words as (
  select doc_id, regexp_extract_all({_ASCII_LOWER.format("text")},
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents
), grams(template, label, grams, place, g) as (values {", ".join(grams)}
), phrases(phrase, k, label) as (values {", ".join(phrases)}
), starts as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words
), places as (
  select doc_id, i - 1 as start, label from starts join phrases
  on w[i] = split_part(phrase, ' ', 1) and array_to_string(w[i:i + k - 1], ' ') = phrase
), base as (
  select doc_id, count(*) as n_base, min(start) as first_word, max(start) as last_word,
    list_sort(list_distinct(list(label))) as labels from places group by doc_id
), hits as (
  select doc_id, template, label, grams, place, i, i - 1 - place as diagonal
  from starts join grams on array_to_string(w[i:i + {GRAM} - 1], ' ') = g and i + {GRAM} - 1 <= len(w)
), opened as (
  select *, case when diagonal - lag(diagonal) over o <= {NEIGHBOUR} then 0 else 1 end as opens
  from hits window o as (partition by doc_id, template order by diagonal)
), numbered as (
  select *, sum(opens) over (partition by doc_id, template order by diagonal
    range between unbounded preceding and current row) as span from opened
), spans as (
  select doc_id, template, label, count(distinct place) as met, min(i) as low, max(i) + {GRAM} - 1 as high,
    count(distinct place) / any_value(grams) as cover from numbered
  group by doc_id, template, label, span having cover >= {COVER}
), touching as (
  select a.doc_id, a.template, a.label, a.low, a.cover, a.met,
    max(case when b.label <> a.label then 1000 * b.cover + b.met / 1000 else 0 end) as rival
  from spans a join spans b on a.doc_id = b.doc_id and a.low <= b.high and b.low <= a.high
  group by all
), found as (
  select doc_id, list(distinct label) as labels, max(cover) as cover from touching
  where 1000 * cover + met / 1000 >= rival - 1e-9 group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base,
  cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(array_to_string(b.labels, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(
    list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') as labels,
  cast(case when n_base > 0 then 1.0 else coalesce(cover, 0.0) end as double) as score
from words left join base b using (doc_id) left join found f using (doc_id)
"""


WARC = """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), keepers as (
  select h, payload_bytes, max(page_id) as keeper from payloads group by all
)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((
    cast('0x' || substr(h, cast(1 + 5 * (i // 4) as int), 5) as int) >> (15 - 5 * (i % 4))) & 31) as int), 1)), '')
    as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type,
  case when page_id <> keeper then keeper end as refers_to
from payloads join keepers using (h, payload_bytes)
"""

MIXING = """
with counted as (
  select source, count(*) as n, sqrt(count(*)) as weight from documents group by source
), totals as (select sum(n) as documents, sum(weight) as weights from counted
), rates as (
  select source, weight * (documents / weights) / n as rate from counted, totals
), parts as (
  select d.doc_id, d.source, rate / ceil(rate / 16) as mean,
    unnest(range(1, cast(greatest(ceil(rate / 16), 1) as bigint) + 1)) as part
  from documents d join rates r on d.source is not distinct from r.source
), drawn as (
  select doc_id, source, mean, part,
    cast('0x' || substr(md5('20:' || doc_id || ':' || part), 1, 13) as bigint) / 4503599627370496.0 as u
  from parts
), ladder as (
  select doc_id, source, part, u,
    sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) over (partition by doc_id, part order by k) as below
  from drawn, range(0, 64) as t(k)
), counts as (
  select doc_id, source, count(*) filter (below <= u) as copies from ladder group by doc_id, source
), copies as (select doc_id, source, unnest(range(0, copies)) as copy from counts)
select doc_id, c.source, cast(copy as int) as copy, md5('place20:' || doc_id || ':' || copy) as position,
  cast(coalesce(length(text), 0) as bigint) as n_chars, md5(coalesce(text, '')) as text_md5
from copies c join documents using (doc_id)
"""

COLLOCATIONS = f"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array({_ASCII_LOWER.format("text")}, '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), lists as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), grams as (
  select lang, 1 as m, unnest(w) as phrase from lists
  union all
  select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from lists
  union all
  select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  from lists
), counted as (select lang, m, phrase, cast(count(*) as bigint) as f from grams group by all
), totals as (select lang, cast(sum(f) as bigint) as n from counted where m = 1 group by lang
), frequent as (select *, string_split(phrase, ' ') as w from counted where f >= 10
), cuts as (
  select lang, m, phrase, f as a, w, unnest(range(1, m)) as k from frequent where m > 1
), priced as (
  select c.lang, c.m, c.phrase, c.a, c.k, x.f as l, y.f as r,
    cast((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as bigint) as score
  from cuts c
  left join frequent x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  left join frequent y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest as (
  select * from priced
  qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
  select lang, part as phrase, max(f) as held from (
    select lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as part from frequent where m = 3
  ) group by all
), ranked as (
  select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as bigint) as rank,
    phrase, a, l, r, n, score
  from lowest left join inside using (lang, phrase) join totals using (lang)
  where held is null or 100 * held < 50 * a
)
select * from ranked where rank <= 2000
"""

LEXICAL = """
with terms as (
  select doc_id, row_number() over () as row, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as t
  from documents
), counts as (select doc_id, row, t, cast(count(*) as bigint) as tf from terms group by all
), sizes as (select row, cast(sum(tf) as bigint) as n from counts group by row
), corpus as (select cast(count(*) as bigint) as d, cast(sum(n) as bigint) as l from sizes
), weights as (
  select t, cast(floor(1000 * ln((2 * d + 2) / (2 * count(*) + 1))) as bigint) as w
  from counts, corpus group by t, d
), asked as (
  select item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as t
  from benchmark
), wanted as (select item_id, t, cast(count(*) as bigint) as times from asked group by all
), scored as (
  select a.item_id, c.doc_id, c.row, cast(sum(
    a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 75 + (75 * s.n * d) // l)))) as bigint) as score
  from wanted a join weights w using (t) join counts c using (t) join sizes s using (row), corpus
  group by a.item_id, c.doc_id, c.row
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 10
"""

ORACLES = {
    "op11_collocations": COLLOCATIONS,
    "op12_lexical": LEXICAL,
    "op1_near_dedup": NEAR_DEDUP,
    "op6_topk": TOP_PRODUCTS,
    "op8_licenses": _license_sql(),
    "op9_warc": WARC,
    "op10_mixing": MIXING,
}
