"""SQL for DuckDB that says from the contracts what some of the queries return, without the operators' methods."""

from __future__ import annotations

from rollbook.llm import licenses, urls
from rollbook.llm.common import WORD

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text},''),'{_UPPER}','{_LOWER}'),'{WORD}')"


def _list(values) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


WINNOWING = f"""
    with d as (select row_number() over () rid, doc_id, {_words("text")} ws from documents),
    i as (select cast(item_id as varchar) item, {_words("text")} ws from benchmark where item_id is not null),
    wins as (select distinct item, least(len(ws),10) n, array_to_string(ws[k+1:k+least(len(ws),10)],' ') span
      from i, unnest(range(0,greatest(len(ws)-9,1))) as r(k) where len(ws)>0),
    sizes as (select distinct n from wins),
    spans as (select rid, k, n, array_to_string(ws[k+1:k+n],' ') span
      from (select rid, ws, n, unnest(range(0,len(ws)-n+1)) k from d, sizes where len(ws)>=n)),
    hits as (select rid, k, spans.n, item from spans join wins on wins.n=spans.n and wins.span=spans.span),
    places as (select rid, count(distinct p) n_hit from (select rid, unnest(range(k,k+n)) p from hits) group by rid),
    named as (select rid, count(*) n_items, string_agg(item,',' order by item) items
      from (select distinct rid, item from hits) group by rid)
    select doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_hit,0) as bigint) n_hit,
      cast(coalesce(n_items,0) as bigint) n_items, sha256(coalesce(items,'')) items_sha256,
      coalesce(n_hit,0)>0 contaminated
    from d left join places using (rid) left join named using (rid)
    """

_STRIDE = max(len(t.words) for t in licenses.TEMPLATES)
_NEEDS = {t: -(-int(round(t.threshold * len(set(t.words)) * 1000)) // 1000) for t in licenses.TEMPLATES}
_NOTICES = ",".join(f"('{t.label}',{_list(sorted(set(t.words)))},{_NEEDS[t]})" for t in licenses.TEMPLATES if not t.phrase)
_PHRASES = ",".join(f"('{t.label}',{_list(t.words)})" for t in licenses.TEMPLATES if t.phrase)

LICENSES = f"""
    with d as (select row_number() over () rid, doc_id, {_words("text")} ws from documents),
    phrases as (select * from (values {_PHRASES}) as p(label, pw)),
    places as (select rid, label, k from (select rid, ws, label, pw,
        unnest(range(0,greatest(len(ws)-len(pw)+1,0))) k from d, phrases) where ws[k+1:k+len(pw)]=pw),
    based as (select rid, count(*) n_base, min(k) first_word, max(k) last_word,
      string_agg(distinct label,',' order by label) base_labels from places group by rid),
    blocks as (select rid, list_distinct(ws[b*{_STRIDE}+1:b*{_STRIDE}+{2 * _STRIDE}]) block
      from (select rid, ws, unnest(range(0,cast(ceil(len(ws)/{_STRIDE}.0) as bigint))) b from d)),
    notices as (select * from (values {_NOTICES}) as n(label, tw, need)),
    found as (select rid, label, len(list_intersect(block,tw))/len(tw) share from blocks, notices
        where len(list_intersect(block,tw))>=need
      union all select rid, label, 1.0 from places),
    labelled as (select rid, string_agg(distinct label,',' order by label) labels, max(share) score
      from found group by rid)
    select doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(n_base,0) as bigint) n_base, first_word, last_word,
      coalesce(base_labels,'') base_labels, coalesce(labels,'') labels, cast(coalesce(score,0) as double) score
    from d left join based using (rid) left join labelled using (rid)
    """

_RULES = ",".join(f"('{a}','{h}','{p}')" for a, h, p in urls.RULES)

URLS = f"""
    with u as (select row_number() over () rid, page_id,
        case when instr(url,'://')>0 then substr(url,instr(url,'://')+3) else '' end rest from pages),
    p as (select rid, page_id, translate(regexp_extract(rest,'^[^/?#]*'),'{_UPPER}','{_LOWER}') host,
        regexp_extract(rest,'^[^/?#]*([^?#]*)',1) path from u),
    rules as (select * from (values {_RULES}) as r(action, rule_host, rule_path)),
    fits as (select rid, action, rule_host||rule_path rule, row_number() over (partition by rid
          order by length(rule_host||rule_path) desc, action desc) place
      from p join rules on (host=rule_host or suffix(host,'.'||rule_host)) and starts_with(path,rule_path)),
    listed as (select distinct rid from p, (select unnest({_list(urls.LISTED_HOSTS)}) held)
      where host=held or suffix(host,'.'||held))
    select page_id, host, path, rule,
      coalesce(action, case when rid in (select rid from listed) then 'block' else 'allow' end) verdict
    from p left join (select * from fits where place=1) using (rid)
    """

JACCARD = f"""
    with recursive d as (select row_number() over () rid, doc_id,
        regexp_extract_all(translate(coalesce(text,''),'{_UPPER}','{_LOWER}'),'[^\\x20\\x09-\\x0D]+') ws from documents),
    s as (select distinct rid, array_to_string(ws[k+1:k+3],' ') gram
      from d, unnest(range(0,greatest(len(ws)-2,1))) as r(k) where len(ws)>0),
    n as (select rid, count(*) n from s group by rid),
    o as (select a.rid a, b.rid b, count(*) o from s a join s b using (gram) where a.rid<>b.rid group by a.rid, b.rid),
    links as (select a, b from o join n x on x.rid=a join n y on y.rid=b where 100*o>=90*(x.n+y.n-o)),
    reach as (select rid a, rid b from d union select reach.a, links.b from reach join links on reach.b=links.a),
    least as (select a rid, min(doc_id) component_id from reach join d on d.rid=reach.b group by a)
    select doc_id, cast(coalesce(n,0) as bigint) n_shingles, component_id from d left join n using (rid) join least using (rid)
    """

SEARCH = f"""
    with d as (select row_number() over () rid, doc_id, {_words("text")} ws from documents),
    i as (select row_number() over () item, item_id, {_words("text")} ws from benchmark),
    it as (select distinct item, item_id, unnest(ws) term from i),
    totals as (select count(*) n_docs, sum(len(ws)) n_terms from d where len(ws)>0),
    tf as (select rid, doc_id, n, term, count(*) tf from (select rid, doc_id, len(ws) n, unnest(ws) term from d)
      where term in (select term from it) group by rid, doc_id, n, term),
    df as (select term, count(*) df from tf group by term),
    parts as (select item, item_id, rid, doc_id, cast(floor(1000*ln((2*n_docs+2)/(2*df+1))) as bigint)
        * ((1000000000*tf) // (1000*tf+8*(100-90+((90*n*n_docs) // n_terms)))) part
      from tf join df using (term) join it using (term), totals),
    scored as (select item, item_id, doc_id, cast(sum(part) as bigint) score from parts group by item, item_id, rid, doc_id)
    select item_id, cast(place as int) "rank", doc_id, score
    from (select *, row_number() over (partition by item order by score desc, doc_id) place from scored where score>0)
    where place<=10
    """

ORACLES = {
    "op3_winnowing": WINNOWING,
    "op7_license_join": LICENSES,
    "op9_bloom_cascade": URLS,
    "op11_jaccard_join": JACCARD,
    "op12_reversed_search": SEARCH,
}
