"""DuckDB SQL of those registered queries that SQL can express. It is
written from the definitions in the operators' docstrings, with other means
than the operators where there are any (recursion, whole windows)."""

from __future__ import annotations

_HOST = "translate(regexp_extract(after, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _warc() -> str:
    seen = "rows between unbounded preceding and 1 preceding"
    return f"""
with p as (select page_id, url, md5(coalesce(html, '')) digest from pages where url is not null),
bare as (select *, regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''),
                                  '(?is)^[a-z][a-z0-9+.-]*://', '') rest from p),
parts as (select *, regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', '') host,
    regexp_replace(regexp_extract(rest, '(?s)^[^/?]*([^?]*)', 1), '/+$', '') path,
    list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\\?(.*)$', 1), '&'), lambda x:
      x <> '' and string_split(x, '=')[1] not in ('utm_source', 'utm_medium', 'utm_campaign',
                                                  'utm_term', 'utm_content', 'ref'))) q from bare),
canon as (select page_id, digest, 'https://' || host || path || case when len(q) > 0
    then '?' || array_to_string(q, '&') else '' end canonical_url from parts),
records as (
  select page_id * 4 record_id, canonical_url, 1700000000 + page_id * 60 as ts, 'response' kind, digest,
    '"' || substr(digest, 1, 16) || '"' tag, page_id from canon
  union all
  select page_id * 4 + 1, canonical_url, 1700000000 + page_id * 60
      + case when page_id % 5 = 0 then -3600 else 25200 end, 'revisit', null,
    case when page_id % 4 = 0 then '"changed"' else '"' || substr(digest, 1, 16) || '"' end, page_id
  from canon where page_id % 3 <> 0),
joined as (select *, last_value(case when kind = 'response' then {{'id': record_id, 'd': digest, 't': tag, 'p': page_id}} end ignore nulls) over (partition by canonical_url order by ts, record_id {seen}) o
  from records),
judged as (select *, case when o is null then 'no_original' when o.t = tag then 'resolved'
    else 'validator_mismatch' end status from joined where kind = 'revisit')
select record_id, canonical_url, status, o.id response_id,
  case when status = 'resolved' then o.d end digest,
  'cache-control: max-age=600' || chr(10)
    || case when status = 'resolved' then 'content-type: text/html' || chr(10) else '' end
    || 'date: ' || ts || chr(10) || 'etag: ' || case when page_id % 4 = 0 then '' else 'W/' end || tag
    || chr(10) || 'set-cookie: s=' || case when status = 'resolved' then o.p::varchar else 'other' end
    as headers
from judged"""


def _mixing() -> str:
    return """
with n as (select source, count(*) n, sqrt(count(*)) w from documents group by source),
r as (select source, (w * (select sum(n) from n)::double) / ((select sum(w) from n) * n) rate from n),
parts as (select *, greatest(1, ceil(rate / 16.0))::bigint parts from r),
terms as (select source, k, exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) p
          from parts, range(0, 96) t(k)),
cdf as (select source, list(c order by k) cdf from (select source, k, sum(p) over (
          partition by source order by k) c from terms) group by source),
drawn as (select d.doc_id, d.source, rate, list_sum(list_transform(range(1, parts + 1), lambda j:
      len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('42:' || coalesce(d.doc_id::varchar, '')
        || ':' || j), 1, 13))::bigint / 4503599627370496.0)))) copies
  from documents d join parts on d.source is not distinct from parts.source
  join cdf on d.source is not distinct from cdf.source),
each_copy as (select *, unnest(range(1, copies::bigint + 1)) as copy from drawn),
keyed as (select *, ('0x' || substr(md5('42s:' || coalesce(doc_id::varchar, '') || ':' || copy), 1, 15))::bigint
  shuffle_key from each_copy)
select doc_id, source, rate, copies::int copies, copy::int copy, shuffle_key,
  row_number() over (order by shuffle_key, doc_id, copy, source) - 1 place from keyed"""


def _url_templates(depth: int = 8) -> str:
    """All levels on which paths of a host can part, up to ``depth``."""
    def differs(bad: str, lab: str, of_bad: str, of_lab: str) -> str:
        rate = f"(({of_bad} + 4.0::double * 0.1::double) / ({of_lab} + 4.0::double))"
        off = f"({bad} - {lab} * {rate})"
        return f"{off} * {off} > 3.84::double * ({lab} * ({rate} * (1.0::double - {rate})))", f"{off} > 0"

    out = f"""
with a as (select page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') after,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path from pages),
b as (select page_id, {_HOST} host, path from a),
c as (select *, '.' || host h from b),
r as (select *, case
    when h like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
    when h like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
    when h like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
    when h like '%.com' and starts_with(path, '/de/') then 'com/de/'
    when h like '%.org' and starts_with(path, '/') then 'org/' end rule from c),
s as (select page_id, host, path, rule, case when rule is null then null when rule in ('org/', 'com/fr/')
      then 0 else 1 end bad, string_split(path, '/') parts from r),
base as (select *, list_transform(parts[2:], lambda x: case
      when regexp_full_match(x, '[0-9]+(\\.[A-Za-z0-9]+)?') then regexp_replace(x, '^[0-9]+', '{{n}}')
      when regexp_full_match(x, '[0-9A-Fa-f-]{{8,}}') then '{{h}}' else x end) segs from s),
l0 as (select host, segs, count(*)::double pages, count(bad)::double lab, coalesce(sum(bad), 0)::double bad, '' tpl
      from base group by host, segs)"""
    for i in range(depth):
        first, above = differs("bad", "lab", "p_bad", "p_lab")
        again, _ = differs("bad", "lab", "g_bad", "g_lab")
        out += f""",
n{i} as (select host, tpl, segs[{i + 1}] seg, sum(lab) lab, sum(bad) bad, sum(pages) pages from l{i}
      where len(segs) > {i} group by 1, 2, 3),
k{i} as (select *, sum(lab) over w p_lab, sum(bad) over w p_bad, sum(pages) over w p_pages from n{i}
      window w as (partition by host, tpl)),
e{i} as (select *, case when not ({first}) then '~' when {above} then '~+' else '~-' end side from k{i}
      where lab >= 4 or pages * 16 >= p_pages),
g{i} as (select *, sum(lab) over v g_lab, sum(bad) over v g_bad from e{i}
      window v as (partition by host, tpl, side)),
h{i} as (select *, side = '~' or not ({again}) alike from g{i}),
m{i} as (select *, count(*) over (partition by host, tpl, side, alike) many from h{i}),
l{i + 1} as (select x.host, x.segs, x.pages, x.lab, x.bad, x.tpl || case when len(x.segs) <= {i} then ''
      when m.seg is null then '/*' when alike and many > 1 then '/' || side else '/' || m.seg end tpl
      from l{i} x left join m{i} m on m.host = x.host and m.tpl = x.tpl and m.seg = x.segs[{i + 1}])"""
    return out + f""",
tree as (select host, segs, tpl || array_to_string(list_transform(segs[{depth + 1}:], lambda x: '/' || x), '') tpl,
      lab, bad from l{depth}),
p as (select host, segs, tpl, sum(lab) over g g_lab, sum(bad) over g g_bad, sum(lab) over t t_lab,
      sum(bad) over t t_bad from tree
      window g as (partition by segs), t as (partition by host, tpl)),
u as (select host, segs, tpl, (t_bad + 4.0::double * ((g_bad + 4.0::double * 0.1::double) / (g_lab + 4.0::double)))
      / (t_lab + 4.0::double) purity from p)
select page_id, host, path, rule, case when base.bad = 1 then 'block' when base.bad = 0 then 'allow'
  when purity >= 0.5 then 'block' else 'allow' end verdict, tpl as "template", purity
from base join u using (host, segs)"""


def _tool_calls() -> str:
    return """
with recursive c as (select conv_id, turn, role, coalesce(text, '') tx,
    md5(conv_id || ':' || turn) id from conversations),
calls as (select conv_id, turn, id, tx, turn % 3 kind from c where role = 'assistant'),
answers as (select conv_id, turn, md5(conv_id || ':' || (turn - 1)) id, tx from c
            where role = 'user' and turn > 0),
lv as (select conv_id, turn, id, 0 lvl from calls x where not exists (select 1 from calls y
         where y.conv_id = x.conv_id and y.turn = x.turn - 2)
       union all select x.conv_id, x.turn, x.id, lvl + 1 from lv join calls x
         on x.conv_id = lv.conv_id and x.turn = lv.turn + 2),
f as (select coalesce(x.conv_id, a.conv_id) conv_id, coalesce(x.id, a.id) call_id, x.turn,
    a.turn result_turn, lvl, x.id cid, a.id aid, kind, x.tx ctx, a.tx atx,
    case when x.turn >= 2 then md5(x.conv_id || ':' || (x.turn - 2)) end parent
  from (select calls.*, lvl from calls join lv using (conv_id, id)) x
  full join answers a on a.conv_id = x.conv_id and a.id = x.id),
g as (select *, case when cid is not null and kind = 1 and conv_id % 5 <> 0 then 'limit: not integer'
    else '' end errors,
  case when cid is null then 'null'
    when kind = 0 then '{"ratio":0.5,"text":' || to_json(ctx) || '}'
    when kind = 1 then '{"limit":' || case when conv_id % 5 = 0 then length(ctx)::varchar
      else '"' || length(ctx) || '"' end || ',"query":' || to_json(ctx) || '}'
    else '{"exact":true,"id":' || length(ctx) || ',"note":' || to_json(ctx) || '}' end args,
  case when cid is null then 'null' else to_json(['summarise', 'search', 'lookup'][kind + 1])::varchar end nm
  from f),
h as (select *, case when cid is null then 'stray_result' when errors <> '' then 'invalid'
    when aid is null then 'no_result' when lvl = 0 and turn >= 2 then 'missing_parent'
    else 'linked' end status from g)
select conv_id, call_id, turn, result_turn, lvl::bigint as "level", status, errors, 0::bigint repeats,
  '{"arguments":' || args || ',"call_id":"' || call_id || '","name":' || nm || ',"parent_id":'
  || coalesce('"' || parent || '"', 'null') || ',"result":' || coalesce(to_json(atx)::varchar, 'null')
  || ',"status":"' || status || '"}' as line from h"""


def _topk() -> str:
    return """
with e as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) v from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1),
        lambda i: q.v[i] * c.v[i]))::bigint score
      from e q join e c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20"""


def _line_dedup(min_words: int = 10) -> str:
    """Equal lines, later and earlier, are strung together along the diagonals of two
    documents: maximal runs. Those of enough words go from the later place."""
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
with d as (select doc_id, coalesce(text, '') tx from documents),
l as (select doc_id, tx, unnest(range(len(string_split(tx, chr(10))))) k,
        unnest(string_split(tx, chr(10))) raw from d where tx <> ''),
s as (select doc_id, tx, k, regexp_replace(raw, '^{blank}+|{blank}+$', '', 'g') line, raw from l),
w as (select *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) words from s),
f as (select *, row_number() over (partition by doc_id order by k) r from w where words > 0),
met as (select a.doc_id, a.k, a.r, a.words, b.doc_id of, a.r - b.r diagonal from f a join f b on a.line = b.line
        and (b.doc_id < a.doc_id or b.doc_id = a.doc_id and b.k < a.k)),
strung as (select *, r - row_number() over (partition by doc_id, of, diagonal order by r) run from met),
runs as (select doc_id, min(k) first, max(k) last from strung group by doc_id, of, diagonal, run
         having sum(words) >= {min_words}),
gone as (select distinct w.doc_id, w.k from w join (select distinct * from runs) t on t.doc_id = w.doc_id
         and w.k between t.first and t.last),
kept as (select w.doc_id, count(*) n_lines, count(g.k) n_deleted,
           coalesce(string_agg(raw, chr(10) order by w.k) filter (where g.k is null), '') body
         from w left join gone g on g.doc_id = w.doc_id and g.k = w.k group by 1)
select d.doc_id, coalesce(n_lines, 0)::int n_lines, coalesce(n_deleted, 0)::int n_deleted,
  length(coalesce(body, ''))::int kept_chars, md5(coalesce(body, '')) kept_md5
from d left join kept k on k.doc_id = d.doc_id"""


def _ngram_join() -> str:
    return """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5
    then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' '))) end) sh from w),
n as (select doc_id, count(*) n from s group by doc_id),
met as (select a.doc_id x, b.doc_id y, count(*) k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id
         group by 1, 2),
links as (select x, y from met join n a on a.doc_id = x join n b on b.doc_id = y
          where 100 * k >= 75 * (a.n + b.n - k)),
edges as (select x, y from links union all select y, x from links),
reached as (select doc_id, doc_id root from w
            union select edges.y, root from reached join edges on edges.x = reached.doc_id)
select w.doc_id, coalesce(any_value(n), 0) n_shingles, min(root) component_id
from w join reached using (doc_id) left join n using (doc_id) group by w.doc_id"""


def _merkle() -> str:
    def leaf(text: str) -> str:
        said = [f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')"
                for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(said)})"

    upwards = """select tree, lvl + 1, pos // 16, (many + 15) // 16, sha256(string_agg(digest, '' order by pos))
        from {0} where many > 1 group by tree, lvl, pos // 16, many"""
    return f"""
with recursive crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) t),
crc as (select doc_id, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) crc from (select distinct doc_id from documents
      where doc_id is not null), crc_table),
d as (select documents.*, case when crc % 5 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') else text end changed from documents left join crc using (doc_id)),
l as (select doc_id, source, {leaf('text')} leaf, {leaf('changed')} held from d),
p as (select *, row_number() over () rn, row_number() over (partition by source order by doc_id nulls first, leaf, held) - 1 pos,
    count(*) over (partition by source) many, dense_rank() over (order by source nulls first) - 1 tree from l),
n as (select tree, 0 lvl, pos, many, leaf digest from p union all {upwards.format('n')}),
m as (select -1 tree, 0 lvl, tree pos, count(*) over () many, digest from n where many = 1
      union all {upwards.format('m')}),
steps as (select p.rn, lvl, n.pos, n.digest, p.pos // (16 ** lvl)::bigint own from p join n on n.tree = p.tree and n.many > 1
        and n.pos // 16 = p.pos // (16 ** (lvl + 1))::bigint
      union all select p.rn, 1000 + lvl, m.pos, m.digest, p.tree // (16 ** lvl)::bigint from p join m on m.many > 1
        and m.pos // 16 = p.tree // (16 ** (lvl + 1))::bigint),
each_level as (select rn, lvl, coalesce(string_agg(digest, '' order by pos) filter (pos < own), '') lft,
      coalesce(string_agg(digest, '' order by pos) filter (pos > own), '') rgt from steps group by rn, lvl),
path as (select rn, list(lft || '|' || rgt order by lvl) sides, string_agg(lft || rgt, '' order by lvl) others
      from each_level group by rn)
select doc_id, leaf, s.digest subroot, r.digest root, sha256(coalesce(others, '')) proof_sha256,
  list_reduce(list_prepend(held, coalesce(sides, [])), lambda acc, x: sha256(split_part(x, '|', 1) || acc
    || split_part(x, '|', 2))) folded_root, folded_root = root verified
from p left join path using (rn) join n s on s.tree = p.tree and s.many = 1 join m r on r.many = 1"""


ORACLE_SQL = {
    "op1_exact_topk": _topk(),
    "op2_warc_revisits": _warc(),
    "op3_poisson_mix": _mixing(),
    "op4_line_dedup": _line_dedup(),
    "op7_ngram_join": _ngram_join(),
    "op9_url_templates": _url_templates(),
    "op10_tool_calls": _tool_calls(),
    "op11_merkle_manifest": _merkle(),
}
