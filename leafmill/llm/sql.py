"""SQL for the check, for the queries of this subpackage that SQL can express."""

from leafmill.llm.licenses import TEMPLATES

OP7 = """
with u as (
  select page_id, case when instr(coalesce(url, ''), '://') > 0
    then regexp_extract(substr(url, instr(url, '://') + 3), '^([^?#]*)', 1) else '' end as rest
  from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^([^/]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    as host, regexp_extract(rest, '^[^/]*(.*)$', 1, 's') as path
  from u),
rules(rule, rule_host, rule_path, verdict) as (values
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
hits as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from p join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id)
select p.page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join hits using (page_id)
"""

OP6 = """
with d as (select doc_id, lang, source, coalesce(text, '') as text from documents),
w as (
  select doc_id, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as word,
    generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) as i
  from d),
wc as (select doc_id, count(*) as n_words, sum(length(word)) as word_chars from w group by doc_id),
win as (
  select doc_id, i, concat_ws(' ', word, w1, w2, w3, w4) as win from (
    select *, lead(word, 1) over o as w1, lead(word, 2) over o as w2, lead(word, 3) over o as w3,
      lead(word, 4) over o as w4 from w window o as (partition by doc_id order by i))
  where w4 is not null),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, win) as c from win) where c > 1),
rep as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest(range(5)) as k) group by doc_id),
lines as (
  select doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from d)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
lc as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id),
c as (
  select d.doc_id, lang, source, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(n_lines, 0)::bigint as n_lines
  from d left join wc using (doc_id) left join rep using (doc_id) left join lc using (doc_id)),
m as (
  select doc_id, lang, source, unnest(['word_len', 'symbols', 'dup_lines', 'repeats']) as measure,
    unnest([100 * word_chars // greatest(n_words, 1), 10000 * n_symbols // greatest(n_words, 1),
            10000 * n_dup_lines // greatest(n_lines, 1), 10000 * n_repeat_words // greatest(n_words, 1)]) as v
  from c),
b as (select m.*, greatest(length(bin(v)) - 7, 0) as s from m join c using (doc_id)
  where not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)),
sk as (select lang, source, measure, s * 64 + (v >> s) as bucket, any_value((((v >> s) + 1) << s) - 1) as top,
    any_value((v >> s) << s) as bottom, count(*) as docs
  from b group by lang, source, measure, s * 64 + (v >> s)),
levels as (
  select 1 as level, lang, source, measure, bucket, top, bottom, docs from sk
  union all select 2, lang, null, measure, bucket, any_value(top), any_value(bottom), sum(docs) from sk group by lang, measure, bucket
  union all select 3, null, null, measure, bucket, any_value(top), any_value(bottom), sum(docs) from sk group by measure, bucket),
run as (
  select *, sum(docs) over (partition by level, lang, source, measure) as total,
    sum(docs) over (partition by level, lang, source, measure order by bucket) as upto from levels),
q as (
  select level, lang, source, measure, max(total) as docs, min(top) filter (upto * 4 >= total) as low,
    min(top) filter (upto * 4 >= total * 3) as high, min(top) filter (upto * 1000 >= total * 990) as tail,
    min(bottom) filter (upto * 1000 >= total * 10) as head from run group by level, lang, source, measure),
f as (
  select level, lang, source, measure, docs, case when high = low then tail else high + 3 * (high - low) end as top,
    case when high = low then head else low - 3 * (high - low) end as bottom from q),
verdict as (
  select m.doc_id, bool_and(coalesce(m.v <= case when a.docs >= 200 then a.top when l.docs >= 200 then l.top
      when g.docs >= 200 then g.top end, true)
    and (m.measure <> 'word_len' or coalesce(m.v >= case when a.docs >= 200 then a.bottom when l.docs >= 200 then l.bottom
      when g.docs >= 200 then g.bottom end, true))) as inside
  from m left join f a on a.level = 1 and a.lang is not distinct from m.lang and a.source is not distinct from m.source
      and a.measure = m.measure
    left join f l on l.level = 2 and l.lang is not distinct from m.lang and l.measure = m.measure
    left join f g on g.level = 3 and g.measure = m.measure
  group by m.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and inside as kept
from c join verdict using (doc_id)
"""

OP10 = """
with t as (
  select 'd' as kind, doc_id as id, text from documents where doc_id is not null
  union all select 'i', item_id, text from benchmark where item_id is not null),
w as (select kind, id, list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as w from t),
s as (
  select distinct kind, id, unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) as s
  from w where len(w) >= 5),
n as (select id, count(*) as n_item from s where kind = 'i' group by id),
hits as (select d.id as doc_id, i.id as item_id, count(*) as n_shared from s d join s i on d.s = i.s
  where d.kind = 'd' and i.kind = 'i' group by d.id, i.id)
select doc_id, item_id, n_shared, n_item, n_shared::double / n_item as containment
from hits join n on n.id = item_id where n_shared::double / n_item >= 0.8
"""


def op1() -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())

    def words(text: str) -> str:
        return f"list_filter(string_split_regex({text}, '[ \\n]+'), lambda x: x <> '')"

    pairs = "list_distinct(list_transform(list_zip(w[1:-2], w[2:]), lambda p: p[1] || ' ' || p[2]))"

    def clean(text: str) -> str:
        return f"regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"

    return f"""
with d as (select doc_id, {clean("coalesce(text, '')")} as t from documents),
p as (select doc_id, t, string_split_regex(t, '\\n( ?\\n)+') as p from d),
u as (
  select doc_id, 'line' as unit, unnest(string_split(t, chr(10))) as x,
    unnest(range(len(string_split(t, chr(10))))) as unit_no from d
  union all select doc_id, 'paragraph', unnest(p), unnest(range(len(p))) from p
  union all select doc_id, 'text', t, 0 from p where len(p) > 1),
uw as (select doc_id, unit, unit_no, {words("x")} as w from u
  where (unit = 'line' and trim(x) <> '') or unit = 'text' or (unit = 'paragraph' and contains(trim(x), chr(10)))),
h as (select doc_id, unit, unit_no, {pairs} as have from uw where len(w) > 1),
k(license, template) as (values {rows}),
kw as (select license, {words(clean("template"))} as w from k),
w as (select license, {pairs} as want from kw where len(w) > 1),
j as (select h.*, license, len(list_intersect(have, want)) as n_common, len(have) as n_unit, len(want) as n_template
  from h join w on len(have) between 1 and 3 * len(want))
select doc_id, unit, unit_no, license, n_common, n_unit, n_template, n_common * 2.0::double / (n_unit + n_template) as dice
from j where n_common * 2.0::double / (n_unit + n_template) >= 0.8
"""

# Cosines of all pairs of a label; components by following links.
OP11 = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
), u as (
  select vec_id, label, e from v
  where label is not null and e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from u a join u b
    on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.98
), reached(a, b) as (
  select vec_id, vec_id from v union select r.a, l.b from reached r join links l on r.b = l.a
), least as (select a, min(b) as component_id from reached group by a),
n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from v join least on least.a = vec_id left join n on n.a = vec_id
"""

# The checksum runs over the bytes of the text with a table made from its polynomial.
OP12 = r"""
with recursive steps(c, v, k) as (
  select range, range, 0 from range(256)
  union all select c, case when v & 1 = 1 then xor(3988292384, v >> 1) else v >> 1 end, k + 1 from steps where k < 8
), crc as (select list(v order by c) as t from steps where k = 8),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents) group by all
), coded as (
  select *, hex(encode(concat(doc_id, ':', run))) as x from runs
), summed as (
  select run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(len(x) // 2), lambda i: cast('0x' || x[2 * i + 1 : 2 * i + 2] as bigint))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) as h
  from coded, crc
), words as (
  select case when h % 97 = 0 then run[: h % length(run)] || run[h % length(run) + 2 :] else run end as word, n from summed
), vocab as (
  select word, cast(sum(n) as bigint) as n from words where length(word) >= 5 group by word having sum(n) >= 3
), cut as (
  select word, n, i, word[: i - 1] || word[i + 1 :] as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from vocab)
), pairs as (
  select a.word, b.word as near from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select c.word, v.word from cut c join vocab v on c.rest = v.word
  union select v.word, c.word from cut c join vocab v on c.rest = v.word
), best as (
  select p.word, count(*) as n_near, max(v.n) as most, arg_min(p.near, (-v.n, encode(p.near))) as near
  from pairs p join vocab v on v.word = p.near group by p.word
), told as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when most >= 2 * v.n then near end as form,
    case when most >= 2 * v.n then most end as form_n
  from vocab v left join best b on b.word = v.word
), ways(word, here, k) as (
  select word, word, 0 from told
  union all select w.word, t.form, k + 1 from ways w join told t on t.word = w.here where t.form is not null
), ends as (select word, arg_max(here, k) as root from ways group by word)
select t.word, form, root, n, n_near, form_n from told t join ends e on e.word = t.word
"""

OP13 = r"""
with pieces as (
  select row_number() over () as piece, * from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as t
    from documents)
), words as (
  select lang, piece, unnest(w) as w, unnest(range(len(w))) as pos
  from (select lang, piece, regexp_extract_all(t, '[^\x20\x09]+') as w from pieces)
), f1 as (select lang, w as p, count(*) as f from words group by all),
totals as (select lang, cast(sum(f) as bigint) as n from f1 group by lang),
next as (
  select lang, w as w1, lead(w) over x as w2, lead(w, 2) over x as w3 from words window x as (partition by piece order by pos)
), f2 as (
  select lang, w1, w2, w1 || ' ' || w2 as p, count(*) as f from next where w2 is not null group by all having count(*) >= 10
), f3 as (
  select lang, w1, w2, w3, w1 || ' ' || w2 || ' ' || w3 as p, count(*) as f
  from next where w3 is not null group by all having count(*) >= 10
), cuts as (
  select lang, p, f as a, 1 as k, w1 as x, w2 as y from f2
  union all select lang, p, f, 1, w1, w2 || ' ' || w3 from f3
  union all select lang, p, f, 2, w1 || ' ' || w2, w3 from f3
), parts as (select lang, p, f from f1 union all select lang, p, f from f2),
scored as (
  select c.lang, c.p, a, k, l.f as l, r.f as r, (1000000::hugeint * a * a) // (l.f::hugeint * r.f) as score
  from cuts c join parts l on l.lang = c.lang and l.p = x join parts r on r.lang = c.lang and r.p = y
), lowest as (
  select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1
), held as (
  select lang, p, max(f) as f from (
    select lang, w1 || ' ' || w2 as p, f from f3 union all select lang, w2 || ' ' || w3, f from f3) group by all
), ranked as (
  select s.lang, row_number() over (partition by s.lang order by score desc, a desc, encode(s.p)) as rank, s.p as phrase, a, l, r,
    cast(score as bigint) as score
  from lowest s left join held h on h.lang = s.lang and h.p = s.p where h.f is null or 100 * h.f < 50 * a
)
select k.lang, rank, phrase, a, l, r, n, score from ranked k join totals t on t.lang = k.lang where rank <= 2000
"""
