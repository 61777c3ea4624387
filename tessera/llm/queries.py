"""The contract's queries: each applies its operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import align, decontaminate, langid, linededup, lm, mixing, neardup, quality, repair, secrets, shard, tokens, topk


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.find_components(_read(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_and_read(_read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.assign(_read(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(_read(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damage_and_repair(_read(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_near_duplicates, op2_tokens, op3_mixing, op4_lm_scores, op5_decontamination, op6_topk, op7_secrets, op8_quality, op9_language_id, op10_sharding,
        op11_line_dedup, op12_conversation_repair, op13_token_alignment,
    )
    return {f.__name__: f for f in found}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = rf"""with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
  i as (select doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) as i from w),
  s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as shingle from i),
  n as (select doc_id, count(*) as n from s group by 1),
  both_in as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
  links as (select a, b from both_in join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
  reach as (select doc_id as root, doc_id as node from documents union select root, b from reach join links on node = a)
  select d.doc_id, coalesce(n.n, 0) as n_shingles, r.component_id, d.doc_id = r.component_id as kept
  from documents d left join n using (doc_id) join (select root, min(node) as component_id from reach group by 1) r on r.root = d.doc_id"""

_OP5 = rf"""with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
  b as (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
  bi as (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from (select *, least(len(w), 13) as n from b where len(w) > 0)),
  windows as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as k from bi),
  di as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from windows) where len(w) >= n),
  hits as (select doc_id, i, n, item_id from (select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as k from di) join windows using (n, k)),
  covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
  items as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names from hits group by 1)
  select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
  from d left join covered using (doc_id) left join items using (doc_id)"""

_OP6 = """with v as (select vec_id, row_number() over () as pos, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  p as (select q.pos, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score from v q join v c on q.pos <> c.pos where q.vec_id % 20 = 0)
  select query_id, cast(r as int) as rank, vec_id, score from (select *, row_number() over (partition by pos order by score desc, vec_id) as r from p) where r <= 20"""

_OP11 = """with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
  e as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from l),
  k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from e),
  g as (select key, max(doc_id) as top from k where length(key) >= 20 group by 1 having count(distinct doc_id) >= 3),
  f as (select k.*, coalesce(doc_id < top, false) as gone from k left join g using (key))
  select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256 from f group by 1"""

_OP12 = r"""with recursive
  crc as (select list(v order by i) as tab from (select i, list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) t(i))),
  k as (select conv_id, turn, coalesce(cast(conv_id as varchar), ' ') as c, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
  h as (select k.*, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: ascii(x)::bigint), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 as kind from k, crc),
  dmg as (select c, turn, case when kind = 4 then 'user' else role end as role, case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy from h where kind <> 0),
  o as (select *, row_number() over (partition by c order by turn nulls first, role, sha256(text), copy) as i, substr(role, 1, 1) as x, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from dmg),
  f as (select *, case when bare = '' then 'b' when row_number() over (partition by c, role, text order by i) > 1 then 'd' when right(bare, 1) not in ('.', '!', '?') then 't' else '' end as fault, lag(x) over (partition by c order by i) as before from o),
  ins(p, q, k, extra) as (values (0, 0, '', []::varchar[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (3, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:'])),
  step(q, y, e) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
  dp as (select distinct c, 0::bigint as i, 0 as e, {'cost': 0::bigint, 'audit': '', 'rep': []::varchar[]} as w from f
    union all
    select c, i, e, min(w) from (
      select f.c, f.i, dp.e, {'cost': w.cost + 2, 'audit': w.audit || 'D', 'rep': w.rep} as w from dp join f on f.c = dp.c and f.i = dp.i + 1
      union all
      select f.c, f.i, s.e, {'cost': w.cost + 5 * length(n.k) + case when f.x = s.y then 0 else 1 end + case when fault = 't' then 5 else 0 end, 'audit': w.audit || n.k || case when f.x = s.y then 'K' else 'R' end,
        'rep': list_concat(list_concat(w.rep, n.extra), [case when f.x = s.y then f.role when s.y = 'u' then 'user' else 'assistant' end || ':' || f.text])}
      from dp join f on f.c = dp.c and f.i = dp.i + 1 join ins n on n.p = dp.e join step s on s.q = n.q and (s.y <> 's' or f.x = 's') where fault not in ('b', 'd')) group by c, i, e),
  t as (select c, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (before is not null and before || x not in ('su', 'ua', 'au')) as illegal,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, max(i) as n from f group by c),
  e as (select dp.c, min({'cost': w.cost + 5 * length(k), 'audit': w.audit || k, 'rep': list_concat(w.rep, extra)}) as w from dp join t on t.c = dp.c and t.n = dp.i join ins on ins.p = dp.e and (ins.q = 3 or ins.q = 0) group by dp.c)
  select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(w.cost, 0) as cost, coalesce(w.audit, '') as audit,
    sha256(coalesce(array_to_string(w.rep, chr(10)), '')) as repaired_sha256
  from (select distinct conv_id, c from k) i left join t using (c) left join e using (c)"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators whose results it can say; the others are tested against brute force or held-out rows."""
    return {"op1_near_duplicates": _OP1, "op5_decontamination": _OP5, "op6_topk": _OP6, "op11_line_dedup": _OP11, "op12_conversation_repair": _OP12}
