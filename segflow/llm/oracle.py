"""DuckDB SQL for the registered queries that SQL can express."""

OP2 = """
with u as (
  select page_id, case when position('://' in url) > 0
                       then substr(url, position('://' in url) + 3) else '' end as rest
  from pages
), p as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, coalesce(rest, '') as rest from u)
), rules(verdict, rhost, rpath) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), best as (
  select page_id, max(struct_pack(n := length(rhost || rpath), verdict := verdict, rule := rhost || rpath)) as b
  from p join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by page_id
)
select p.page_id, host, path, b.rule as rule, coalesce(b.verdict, 'allow') as verdict
from p left join best using (page_id)
"""

OP10 = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

# conv of eight hex digits: DuckDB reads 0x... text as a number.
_HASH = ", ".join(f"cast('0x' || substr(d, {8 * i + 1}, 8) as bigint) as h{i + 1}" for i in range(4))
OP11 = f"""
with t as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents
), h as (select doc_id, text, n, {_HASH} from t),
c as (
  select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as z,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from h
), p as (select *, substr(text, 1, a) as pre, substr(text, a + 1, z - a) as mid, substr(text, z + 1) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then z - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
              else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""

OP12 = """
with l as (
  select doc_id, i, lines[i] as line,
         translate(trim(lines[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, lines, unnest(generate_series(1, len(lines))) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))
), hot as (select k from l where k <> '' group by k having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(hot.k) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where hot.k is null), '')) as kept_sha256
from l left join hot on l.k = hot.k group by doc_id
"""

# RE2 classes hold code points, so everything outside ASCII is a letter here too.
_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP13 = f"""
with d as (select doc_id, len(ts) as n, ts from (select doc_id, {_TERMS} as ts from documents) where len(ts) > 0),
s as (select count(*) as big_n, cast(sum(n) as bigint) as big_l from d),
q as (select distinct item_id, unnest({_TERMS}) as t from benchmark),
tf as (select doc_id, n, t, count(*) as tf from (select doc_id, n, unnest(ts) as t from d)
       where t in (select t from q) group by doc_id, n, t),
w as (select t, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double)) as bigint) as w
      from (select t, count(*) as df from tf group by t), s),
p as (select doc_id, t, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l)) as part from tf, s),
r as (select item_id, doc_id, cast(sum(w * part) as bigint) as score
      from q join p using (t) join w using (t) group by item_id, doc_id),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from k where rank <= 50
"""

ORACLE = {
    "op2_url_filters": OP2,
    "op10_exact_dedup": OP10,
    "op11_fill_in_middle": OP11,
    "op12_line_dedup": OP12,
    "op13_lexical_search": OP13,
}
