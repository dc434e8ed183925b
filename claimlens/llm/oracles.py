"""What the dealt operators should give, as DuckDB SQL over the same tables, where SQL can say it."""

SUBSTRING_DEDUP = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
),
windows as (
  select doc_id, p, array_to_string(ws[p : p + 19], ' ') as words
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as p from docs where len(ws) >= 20)
),
later as (
  select doc_id, p from (
    select doc_id, p, row_number() over (partition by words order by doc_id, p) as n from windows
  ) where n > 1
),
gone as (select distinct doc_id, unnest(range(p, p + 20)) as p from later),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from docs),
kept as (
  select w.doc_id, count(g.p) as n_removed, string_agg(w.word, ' ' order by w.p) filter (where g.p is null) as text
  from words w left join gone g on w.doc_id = g.doc_id and w.p = g.p group by w.doc_id
)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(k.text, '')) as kept_sha256
from docs d left join kept k on d.doc_id = k.doc_id
"""

WARC = r"""
with payloads as (select page_id, encode(coalesce(html, '')) as payload from pages),
hashed as (select page_id, octet_length(payload) as n, sha1(payload) as hex from payloads),
firsts as (select *, min(page_id) over (partition by hex) as first from hashed)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 +
    ((cast(('0x' || substr(hex, cast(1 + 10 * (i // 8) as integer), 10)) as bigint) >> cast(35 - 5 * (i % 8) as bigint)) & 31) as integer), 1)), '')
    as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from firsts
"""

AUDIT = r"""
with docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws
  from documents
),
flags as (
  select part, coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic,
    len(ws) < 200 as a, 100 * len(list_distinct(ws)) < 50 * len(ws) as b,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
    coalesce(min(d.doc_id) over (partition by t) < d.doc_id, false) as e
  from docs d left join labels l on d.doc_id = l.doc_id
),
tally as (select part, good, toxic, a, b, c, d, e, count(*) as n from flags group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || r.x || s.x || u.x as filter_order, p.x as p, q.x as q, r.x as r, s.x as s, u.x as u
  from letters p, letters q, letters r, letters s, letters u
  where len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5
),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as x, substr(filter_order, 1, step - 1) as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step)
),
met as (
  select part, filter_order, step, x, n, good, toxic,
    (x = 'A' and a) or (x = 'B' and b) or (x = 'C' and c) or (x = 'D' and d) or (x = 'E' and e) as fails,
    (contains(before, 'A') and a) or (contains(before, 'B') and b) or (contains(before, 'C') and c)
      or (contains(before, 'D') and d) or (contains(before, 'E') and e) as gone,
    a::int + b::int + c::int + d::int + e::int = 1 as one
  from tally, steps
),
told as (
  select part, filter_order, step, x,
    coalesce(sum(n) filter (where not fails and not gone), 0) as kept, coalesce(sum(n) filter (where fails and not gone), 0) as removed,
    coalesce(sum(n) filter (where fails and gone), 0) as redundant, coalesce(sum(n) filter (where fails and one), 0) as unique_fails,
    coalesce(sum(n) filter (where fails and not gone and good), 0) as good_lost,
    coalesce(sum(n) filter (where fails and not gone and toxic), 0) as toxic_lost
  from met group by all
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, x) as bigint) as shapley
from told
"""

ORACLES = {"op1_substring_dedup": SUBSTRING_DEDUP, "op7_warc": WARC, "op13_filters": AUDIT}
