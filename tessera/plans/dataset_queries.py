"""Queries over pages, records, packages and states that are made of the test tables, each with SQL for the same rows.

Records are made of ``part``, some of them broken in a known way, so that the SQL can say which rules they break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import html, pages, recipes, text
from tessera.operators import gates, history, nested, records, resolve, rules
from tessera.plans import identity
from tessera.plans.queries import joined, query, read
from tessera.sources import io


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type", F.col("p_size").alias("n"))


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts with numbers from 1."""
    return _part(spark, sf_dir).withColumn("k", F.col("k") + 1)


def _dealt(parts: DataFrame) -> DataFrame:
    """The parts in as many tasks as the session has: a file of a few MB has a million of them and is one task's to read, long before pages are made of them."""
    spark = parts.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return parts.repartition(tasks, "k")


def said(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def K() -> Column:
    return F.col("k")


def N() -> Column:
    return F.col("n")



# --- pages ---------------------------------------------------------------------------------------


@query("""with p as (select p_partkey as k, unnest(list_value(p_name || '。', '「' || p_brand || '。x」' || p_type || '！', case when p_size % 2 = 0 then 'a (b。' || p_size || ') c' else 'y' end, case when p_size % 2 = 0 then 'z! ok' else '「open。' || p_size end)) as sentence, unnest(range(4)) as pos from part) select k, cast(pos as int) as pos, sentence from p""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences outside of brackets; ASCII marks end none, a bracket that never closes holds the rest."""
    value = said(F.col("p_name"), "。「", F.col("p_brand"), "。x」", F.col("p_type"), "！", F.when(N() % 2 == 0, said("a (b。", N(), ") c")).otherwise("y"), "\n", F.when(N() % 2 == 0, F.lit("z! ok")).otherwise(said("「open。", N())))
    return _part(spark, sf_dir).select("k", F.posexplode(text.split_sentences(value)).alias("pos", "sentence"))


@query("""with l as (select p_partkey as k, unnest(list_value('one', p_name, 'top')) as text, unnest(list_value('https://a.example/x/' || p_partkey, 'https://b.example/' || p_size, 'https://a.example/')) as href, unnest(range(3)) as pos from part) select k, cast(pos as int) as pos, text, href from l""")
def link_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages, absolute, each once."""
    page = said("<p><a href='", K(), "'>one</a> <a href='https://b.example/", N(), "'><b>", F.col("p_name"), "</b></a><a>no</a><a href='./", K(), "'>one</a><a href=' / '>top</a>")
    return _part(spark, sf_dir).select("k", F.posexplode(html.page_links(page, F.lit("https://a.example/x/"))).alias("pos", "link")).select("k", "pos", "link.text", "link.href")


@query("""with c as (select p_partkey as k, p_size + 1 as id, p_brand as name, 'https://a.example/w/' || p_partkey as href, 'first' as state from part union all select p_partkey, p_size + 1, 'other', 'https://a.example/w/other', 'conflict' from part union all select p_partkey, p_size + 100, 'page' || p_size, 'https://a.example/w/page' || p_size, 'first' from part) select k, cast(id as int) as id, name, href, state from c""")
def item_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of a catalog page by item; the first address of an item is taken, another is a conflict."""
    page = said("<a href='/w/", K(), "' title='No.0", N() + 1, ": ", F.col("p_brand"), "'>x</a><a href='/w/", K(), "'>", N() + 1, "：again</a><a href='/w/other'>", N() + 1, ":other</a><a href='/w/page", N(), "'><img src='/i/weapon", N() + 100, "b.png'></a><a href='/w/none'>no number</a>")
    return _part(spark, sf_dir).select("k", F.explode(html.page_cards(page, F.lit("https://a.example/"))).alias("c")).select("k", "c.*")


@query("""with c as (select p_partkey as k, p_brand as name, '/s/' || p_partkey as href from part union all select p_partkey, p_brand, '/s/twin' from part where p_size % 3 = 0 union all select p_partkey, 'alt ' || p_size, '/s/' || p_size from part) select k, name, string_agg(href, ' ' order by href) as hrefs, count(*) > 1 as ambiguous from c group by 1, 2""")
def card_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a card list with their addresses; several make a name ambiguous."""
    twin = F.when(N() % 3 == 0, said("<a href='/s/twin' title='", F.col("p_brand"), "'></a>")).otherwise("")
    page = said("<ul><li><a href='/s/", K(), "'>", F.col("p_brand"), "</a>", twin, "<a href='/s/", K(), "'>", F.col("p_brand"), "</a><a href='/s/", N(), "'><img alt='alt ", N(), "'></a><a href=''>x</a>")
    found = _part(spark, sf_dir).select("k", F.explode(html.card_list(page)).alias("c")).select("k", "c.name", "c.href")
    return found.groupBy("k", "name").agg(F.array_join(F.array_sort(F.collect_set("href")), " ").alias("hrefs"), (F.count_distinct("href") > 1).alias("ambiguous"))


_UNITS = """with u as (select p_partkey as k, p_size as n, unnest(list_value('list-item', 'list-item', 'paragraph', 'table-row', 'paragraph')) as kind, unnest(list_value('development', 'quest', 'event', 'ship', 'purchase')) as kinds,
    unnest(list_value('current-or-summary', case when p_size % 2 = 0 then 'historical' else 'current' end, 'historical', 'current-or-summary', 'current')) as availability,
    unnest(list_value('開発で ' || p_name, case when p_size % 2 = 0 then '以前は' else '恒常' end || '任務', 'イベント ' || p_size, p_brand || ' | ' || p_type, '購入 恒常')) as text,
    unnest(list_value(null, null, '過去の入手方法', '艦名 | 初期装備', '別')) as context, unnest(range(5)) as pos from part)"""


def _acquisition(inner: bool = True) -> Column:
    """A section with a list, a fold of what is past, a table under a label, and a heading below it."""
    body = said("<ul><li>開発で ", F.col("p_name"), "</li><li>", F.when(N() % 2 == 0, "以前は").otherwise("恒常"), "任務</li></ul><div class='a fold-container'><div class='fold-summary'>過去の入手方法</div><div class='fold-content'><blockquote>イベント ", N(), "</blockquote></div></div>")
    table = said("<div><table><tr><th>艦名</th><th>初期装備</th></tr><tr><td>", F.col("p_brand"), "</td><td>", F.col("p_type"), "</td></tr></table></div><h4>別</h4><p>購入 恒常</p>")
    return said(body, table) if inner else body


@query(f"{_UNITS} select k, cast(pos as int) as pos, kind, kinds, availability, text, context from u")
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of evidence by what lists, folds, tables and headings say of them."""
    found = _part(spark, sf_dir).select("k", F.explode(pages.page_units(_acquisition())).alias("u"))
    return found.select("k", "u.pos", "u.kind", joined("u.kinds").alias("kinds"), "u.availability", "u.text", "u.context")


@query("""select p_partkey as k, cast(case when p_size % 5 = 0 then 7 else p_partkey end as bigint) as page_id, case when p_size % 7 > 0 and (p_size % 5 > 0 or p_partkey = 7) then p_size % 3 = 0 end as flag, case when p_size % 11 = 0 then 'page-fallback' else 'section' end as scope,
  concat_ws(',', case when p_size % 7 = 0 or (p_size % 5 = 0 and p_partkey <> 7) then 'flag-unresolved' end, case when p_size % 5 = 0 and p_partkey <> 7 then 'id-mismatch' end, case when p_size % 11 = 0 then 'missing-section' end) as issues,
  case when p_size % 7 = 0 or (p_size % 5 = 0 and p_partkey <> 7) then 'rejected' when p_size % 11 = 0 then 'fallback' else 'parsed' end as coverage,
  case when p_size % 11 = 0 then 'improvement' when p_size % 2 = 0 then 'development,purchase,ship' else 'development,purchase,quest,ship' end as current, case when p_size % 11 = 0 then '' when p_size % 2 = 0 then 'event,quest' else 'event' end as historical from part""")
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of item pages; without a section the comparison table speaks."""
    number = F.when(N() % 5 == 0, F.lit(7)).otherwise(K())
    box = said("<table><tr><th>NO.00", number, "</th></tr>", F.when(N() % 7 > 0, said("<tr><th>備考</th><td>", F.when(N() % 3 == 0, "開発可能").otherwise("開発不可"), "</td></tr>")).otherwise(""), "</table>")
    compare = said("<table><tr><th>名前</th><th>入手方法</th></tr><tr><td>", F.col("p_name"), "</td><td>改修</td></tr><tr><td>z</td><td>開発</td></tr></table>")
    heading = F.when(N() % 11 == 0, "入手方法の歴史").otherwise(" 入手 方法について")
    page = said(box, compare, "<h2>", heading, "</h2>", F.when(N() % 11 == 0, "<p>nothing</p>").otherwise(_acquisition()), "<h2>他</h2><p>建造</p>")
    found = _dealt(_part(spark, sf_dir)).select("k", pages.page_records(page, K(), F.col("p_name")).alias("r"))
    return found.select("k", "r.page_id", "r.flag", "r.scope", joined("r.issues").alias("issues"), "r.coverage", joined("r.current").alias("current"), joined("r.historical").alias("historical"))


@query("""with g as (select p_partkey as k, unnest(list_value(0, 1, 2)) as index, unnest(list_value(p_name || '|' || p_name || '|' || p_size, p_brand || '|' || p_name || '|x', p_brand || '|' || p_name || '|')) as cells, unnest(list_value('<b>' || p_name || '</b>', p_brand, p_brand)) as first from part) select k, cast(index as int) as index, cells, first from g""")
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H2: tables of pages as grids, with cells over rows and columns, and the HTML of the cells."""
    page = said("<table><tr><td colspan=2><b>", F.col("p_name"), "</b></td><td>", N(), "</td></tr><tr><th rowspan='2'>", F.col("p_brand"), "<td rowspan=2>", F.col("p_name"), "<td>x</tr><tr><td></td></tr></table>")
    found = _part(spark, sf_dir).select("k", F.explode(html.table_grids(page)).alias("r"))
    return found.select("k", "r.index", F.array_join("r.cells", "|").alias("cells"), F.get("r.html", F.lit(0)).alias("first"))


@query("""with r as (select p_partkey as k, unnest(list_value('resource', 'improve', 'improve', 'upgrade')) as action, unnest(list_value(null, null, 'B' || p_size, null)) as only, unnest(list_value(p_size || ',20,0,5', '1,2,3,4', '1,2,3,4', p_size || ',9,8,8')) as costs,
  unnest(list_value('', 'Tube:' || p_size, 'Radar:3', 'Tube:2,Medal:' || p_size)) as materials, unnest(list_value(null, null, null, p_brand)) as target, unnest(list_value(null, null, null, 3)) as target_level from part) select * from r""")
def recipe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a recipe page: resources, a stage, its alternative for one assistant, the upgrade."""
    page = said(
        "<div class='resource-table'><table><tr><th>h</th></tr><tr><th>h</th></tr><tr><th class='title resource-title'>r</th></tr><tr><td><span>", N(), "</span><span>20</span><span>0</span><span>5</span></td></tr>",
        "<tr><th class='border-right'>0 ～ 5</th><td>1/2</td><td>3/4</td><td>Tube × ", N(), "<div class='sub'>二番艦：B", N(), " 限定</div><div title='1:Radar'>Radar × 3</div></td></tr>",
        "<tr><th class='kind1'><span class='remodel-info'>x</span></th></tr><tr><th class='border-right' rowspan=2>MAX</th><td>", N(), "/9</td><td>8/8</td><td><div><figure title='3:Tube'></figure><figcaption>× 2</figcaption><figure title='Medal'></figure><figcaption>x ", N(), "</figcaption></div></td></tr>",
        "<tr><td><div><a title='t'><div>", F.col("p_brand"), " ★3</div></a></div></td></tr></table></div>",
    )
    found = _part(spark, sf_dir).select("k", F.explode(recipes.recipes(page)).alias("r"))
    named = F.transform("r.materials", lambda m: F.concat_ws(":", m["name"], m["count"].cast("string")))
    return found.select("k", "r.action", "r.only", joined("r.costs").alias("costs"), joined(named).alias("materials"), "r.target", "r.target_level")


@query("""select p_partkey as k, 0 as source_order, 'kind1' as group, p_brand as name, p_size || '.png' as picture, p_size % 8 as mask from part union all select p_partkey, 1, 'kind2', null, null, 1 from part""")
def page_assistants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assistants of a recipe page with their days."""
    days = said(*(F.when((N() % 8).bitwiseAND(1 << d) > 0, "<span class='enable'></span>").otherwise("<span></span>") if d < 3 else F.lit("<span></span>") for d in range(7)))
    one = said("<td><div class='support-ship'><img src='", N(), ".png'><div class='kind1'>", days, "</div>", F.col("p_brand"), "</div></td>")
    page = said("<div class='support-ship-table'><table><tr>", one, "<td><div class='support-ship'><div class='kind2'><span class='enable'></span></div>-</div></td></tr></table></div>")
    return _part(spark, sf_dir).select("k", F.explode(recipes.assistants(page)).alias("a")).select("k", "a.*")


# --- scalar functions ----------------------------------------------------------------------------


@query("""select p_partkey as k, lower(replace(p_name, ' ', '')) || 'ab1' as narrow, lower(replace(p_name, ' ', '')) || 'ab' as catalog, lower(replace(p_name, ' ', '')) || '''x' as reference, p_name || ' A!' as exact, p_name || '  A!' as page, lower(replace(p_name, ' ', '')) || 'a!' as lookup from part""")
def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms of a name, of full-width letters, footnotes, brackets and blanks."""
    name = F.col("p_name")
    wide = said(name, "　ＡＢ*１")
    return _part(spark, sf_dir).select(
        "k", text.normalize_name(wide).alias("narrow"), text.normalize_catalog_name(said(name, " ＡＢ ※2")).alias("catalog"), text.normalize_reference_name(said("「", name, "」・’X*—")).alias("reference"),
        text.normalize_exact(said(" ", name, "　 Ａ！ ")).alias("exact"), text.normalize_page_name(said(" ", name, "　 Ａ！ ")).alias("page"), text.normalize_lookup(said(name, "　Ａ！")).alias("lookup"),
    )


@query("""select p_partkey as k, '{"a":' || p_size || ',"b":{"c":"é","z":[' || p_partkey || ',null]}}' as canonical, sha256('{"a":' || p_size || ',"metadata":{"k":1}}' || chr(10)) as digest, p_size % 2 = 0 as declared from part""")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON with sorted keys, its digest without volatile metadata, and whether the declared one is that."""
    document = said('{ "b": {"z": [', K(), ', null], "c": "\\u00e9"}, "a": ', N(), " }")
    body = said('{"a":', N(), ',"metadata":{"k":1}}\n')
    listed = said('{"metadata": {"generatedAt": "', K(), '", "contentDigest": "sha256:', F.when(N() % 2 == 0, F.sha2(body.cast("binary"), 256)).otherwise("0"), '", "k": 1}, "a": ', N(), "}")
    return _part(spark, sf_dir).select("k", text.to_canonical_json(document).alias("canonical"), text.content_digest(listed).alias("digest"), text.digest_is_declared(listed).alias("declared"))


@query("""select p_partkey as k, '{"a":{"c":[null,{}]},"n":' || p_size || '}' as pruned, p_name || '＋x+' as c from part""")
def pruned_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects without their null entries at any depth; names that a page may have."""
    value = said('{"a": {"b": null, "c": [null, {"d": null}]}, "n": ', N(), ', "z": null}')
    name = text.page_name_candidates(said(F.col("p_name"), "+x＋"))
    return _part(spark, sf_dir).select("k", text.prune_nulls(value).alias("pruned"), F.replace(F.replace(F.get(name, F.lit(1)), F.lit("＋x＋"), F.lit("＋x+")), F.lit("\n"), F.lit("")).alias("c"))


@query(f"""with t as (select list_value({", ".join(map(str, text._ASSET_CODES))}) as t) select p_partkey as k, cast(17 * (p_partkey + 7) * t[1 + ({sum(map(ord, "slot_card"))} + p_partkey * 9) % 100] % 8973 + 1000 as varchar) as code from part, t""")
def asset_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the codes of pictures' addresses."""
    return _part(spark, sf_dir).select("k", text.asset_code(K(), "slot_card").alias("code"))


@query("""select p_partkey as k, case when p_size % 2 = 0 and (p_size % 3 = 0 or p_size * 100 <= 2000) then 'cache' when p_size % 2 = 0 then 'ask' else 'fetch' end as decision,
  case when p_size % 2 = 0 and (p_size % 3 = 0 or p_size * 100 <= 2000) then 'cached' when p_size % 5 = 0 and p_size % 2 = 0 then 'revalidated' when p_size % 5 = 1 then 'updated' when p_size % 2 = 0 then 'fallback' else 'failed' end as outcome,
  case when p_size % 7 = 0 then least(p_size, 8.0) else least(pow(2, greatest(p_size % 5 - 1, 0)), 8.0) end as delay, case when p_size <= 20 then 'keep' when p_size % 3 = 0 and p_size % 4 > 0 then 'keep-stale' when p_size % 3 = 0 then 'stop' when p_size % 4 > 0 and p_size % 3 = 1 then 'keep' else 'refresh' end as master from (select p_partkey, p_size from part) where p_size > 20 or p_size % 4 > 0
  union all select p_partkey, case when p_size % 2 = 0 and (p_size % 3 = 0 or p_size * 100 <= 2000) then 'cache' when p_size % 2 = 0 then 'ask' else 'fetch' end,
  case when p_size % 2 = 0 and (p_size % 3 = 0 or p_size * 100 <= 2000) then 'cached' when p_size % 5 = 0 and p_size % 2 = 0 then 'revalidated' when p_size % 5 = 1 then 'updated' when p_size % 2 = 0 then 'fallback' else 'failed' end,
  case when p_size % 7 = 0 then least(p_size, 8.0) else least(pow(2, greatest(p_size % 5 - 1, 0)), 8.0) end, case when p_size % 3 = 0 then 'stop' else 'refresh' end from part where p_size <= 20 and p_size % 4 = 0""")
def cache_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to do for an address or the master data, what becomes of it, and how long to wait."""
    cached = N() % 2 == 0
    decision = io.cache_decision(cached=cached, validated=N() % 3 == 0, validated_at=F.lit(0), now=N() * 100, ttl=2000)
    status = F.when(N() % 5 == 0, 304).when(N() % 5 == 1, 200).when(N() % 5 == 2, 503)
    delay = io.retry_delay(N() % 5, F.when(N() % 7 == 0, N().cast("string")).when(N() % 7 == 1, "soon"))
    master = io.master_state(age_hours=N(), local_version=F.lit(1), remote_version=F.when(N() % 3 == 1, 1).when(N() % 3 == 2, 2), valid=N() % 4 > 0, most_hours=20)
    return _part(spark, sf_dir).select("k", decision.alias("decision"), io.cache_outcome(decision=decision, status=status, cached=cached).alias("outcome"), delay.alias("delay"), master.alias("master"))


@query("""select p_brand as cache_key, arg_max(p_size, p_partkey) as fetched_at from part where p_size % 5 > 0 group by 1""")
def cache_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest metadata of each key; broken lines are set aside."""
    line = F.when(N() % 5 == 0, said('{"cache_key": "', F.col("p_brand"))).otherwise(said('{"cache_key": "', F.col("p_brand"), '", "fetched_at": ', N(), "}"))
    found, _ = io.read_cache_index(_part(spark, sf_dir).select(K().alias("pos"), line.alias("value")))
    return found.select("cache_key", "fetched_at")


# --- routes and records --------------------------------------------------------------------------


@query("""with s as (select p_partkey as k, p_size as n, unnest(range(3)) as stage from part), g as (select p_partkey as k, p_size as n, g from part, range(2) t(g) where p_size % 4 > g),
  r as (select k, n, 'default' as kind, '' as g, case n % 4 when 0 then '' when 1 then '1,2' else '1,2,3' end as excluded from (select p_partkey as k, p_size as n from part) where n % 4 < 2 or n % 3 > 0
    union all select k, n, 'assistant-specific', case g when 0 then '1,2' else '3' end, '' from g where (g = 0 and n % 5 > 0) or (g = 1 and n % 6 > 0))
  select r.k, kind, g as group, excluded, cast(stage as int) as stage, cast(case when kind = 'default' then r.n * 10 + stage when g = '1,2' and stage = 1 then -r.n when g = '3' and stage = 2 then -r.n - 1 else r.n * 10 + stage end as int) as cost from r join s using (k)""")
def recipe_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes with the stages that a group of assistants has of its own; groups without an open day are left out."""
    part = _part(spark, sf_dir)
    ids = lambda *x: F.array(*(F.lit(i).cast("long") for i in x))
    stages = part.select(K().alias("route"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("stage"), "n").select("route", "stage", (N() * 10 + F.col("stage")).alias("cost"))
    first = part.where("n % 4 > 0").select(K().alias("route"), F.lit(1).alias("stage"), F.lit("only 1 and 2").alias("condition"), ids(1, 2, 1).alias("assistants"), (-N()).alias("cost"))
    second = part.where("n % 4 > 1").select(K(), F.lit(2), F.lit("only 3"), ids(3), -N() - 1)
    rule = lambda a, mask: F.struct(F.lit(a).cast("long").alias("assistant"), mask.cast("int").alias("mask"))
    listed = F.array(rule(1, F.when(N() % 5 > 0, 1).otherwise(0)), rule(2, F.lit(0)), rule(3, F.when(N() % 6 > 0, 4).otherwise(0)), F.when((N() % 3 > 0) | (N() % 4 == 0), rule(9, F.lit(8))))
    rules_ = part.select(K().alias("route"), F.explode(F.array_compact(listed)).alias("r")).select("route", "r.*")
    routes, planned, _ = nested.recipe_routes(stages, first.union(second), rules_)
    # the default of a route whose rules are all of groups is not there
    out = planned.join(routes.select("route", "kind", "group", "excluded"), ["route", "kind", "group"])
    return out.select(F.col("route").alias("k"), "kind", joined("group").alias("group"), joined("excluded").alias("excluded"), "stage", "cost")


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Improvement records (pos, json), sound but for what is made wrong where the size is a multiple of some number."""
    label = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: text.level_label(i))
    effect = F.array(F.struct(F.lit("fire").alias("name"), F.lit("+1").alias("valueText"), F.lit(1.0).alias("value"), F.when(N() % 13 == 0, -1).otherwise(3).alias("sourceRow")))
    none = F.array().cast("array<struct<name:string,valueText:string,value:double,sourceRow:int>>")
    available = N() % 4 > 0
    levels = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.struct(i.alias("level"), F.get(label, i).alias("label"), F.when(available & (i > 0), effect.cast("array<struct<name:string,valueText:string,value:double,sourceRow:int>>")).otherwise(none).alias("effects")))
    item = F.struct(F.lit(1).alias("type"), (N() % 9 - 1).alias("id"))
    made = F.struct(F.lit(0).alias("type"), (K() + 1000).alias("id"))
    up = N() % 3 == 0

    def step(i: Column) -> Column:
        last = i == 10
        level = F.struct(F.lit("level").alias("kind"), (i + 1).alias("level"), text.level_label(i + 1).alias("label"), F.lit(None).cast("struct<id:bigint,name:string>").alias("targetWeapon"))
        weapon = F.struct(F.lit("weapon").alias("kind"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("string").alias("label"), F.struct((K() + 1).alias("id"), F.when(N() % 15 == 0, "").otherwise("up").alias("name")).alias("targetWeapon"))
        return F.struct(
            i.alias("fromLevel"), F.get(label, i).alias("fromLabel"), F.when(last, "upgrade").otherwise("improve").alias("action"), F.when(last, up).otherwise((N() % 17 > 0) | (i != 4)).alias("available"), F.when(~last, i + 1).alias("effectExpectationLevel"),
            F.array(*map(F.lit, (10, 20, 0, 5))).alias("industryResource"), F.lit("s").alias("sourceStageText"), F.array(made).alias("consumables"), F.when(last & up, weapon).when(~last, level).alias("expectedResult"),
        )

    stage = F.struct(F.struct((K() + 1).alias("id"), F.lit("up").alias("name")).alias("targetWeapon"), F.array(item, made).alias("consumables"))
    route = F.struct(said("r", N()).alias("routeId"), F.when(N() % 2 == 0, "").otherwise("special").alias("routeType"), F.lit("t").alias("routeSourceText"), F.array(stage).alias("stageList"), F.transform(F.sequence(F.lit(0), F.when(N() % 19 == 0, 9).otherwise(10)), step).alias("stepList"))
    record = F.struct(
        F.when(N() % 23 == 0, 5).otherwise(K()).alias("id"), F.when(N() % 11 == 0, " ").otherwise(F.col("p_name")).alias("name"), F.struct(F.when(available, "ok").when(N() % 8 == 0, "lost").otherwise("unavailable").alias("status")).alias("effectSource"),
        levels.alias("levelExpectations"), F.array(route).alias("improvementList"),
    )
    return _numbered(spark, sf_dir).select(K().alias("pos"), F.to_json(record).alias("json"))


_IDS = "with p as (select p_partkey + 1 as k, p_size as n, case when p_size % 23 = 0 then 5 else p_partkey + 1 end as id from part)"


@query(f"""{_IDS}, v as (select 'detail.name' as rule, cast(id as varchar) as key from p where n % 11 = 0 union all select 'detail.effect-source', cast(id as varchar) from p where n % 8 = 0 union all select 'detail.effects', cast(id as varchar) from p where n % 13 = 0 and n % 4 > 0
  union all select 'route.steps', id || '/0' from p where n % 19 = 0 union all select 'route.consumables', id || '/0' from p where n % 9 <= 1 union all select 'step.recipe', id || '/0/4' from p where n % 17 = 0 union all select 'step.target', id || '/0/10' from p where n % 15 = 0 and n % 19 > 0
  union all select 'detail.unique-id', cast(id as varchar) from p group by id having count(*) > 1) select rule, key, count(*) as times from v group by all""")
def detail_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: rules of improvement records that some break."""
    return rules.detail_violations(_details(spark, sf_dir)).groupBy("rule", "key").agg(F.count("*").alias("times"))


@query(f"""{_IDS} select 'equipment' as kind, id from p union select 'equipment', k + 1 from p union select 'equipment', k + 1000 from p union select 'useitem', n % 9 - 1 from p where n % 9 > 1""")
def required_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and use-items that records need."""
    return nested.required_ids(rules._typed(_details(spark, sf_dir), nested.RECORD))


@query(f"""{_IDS} select distinct id, 'r' || n as "routeId", case when n % 2 = 0 then 'default' else 'special' end as "routeType", 't' as "routeSourceText" from p""")
def route_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routes of records in short."""
    return nested.route_summaries(rules._typed(_details(spark, sf_dir), nested.RECORD))


@query("""with n as (select p_partkey as k, p_name as name, 'link-text' as evidence from part union all select p_partkey, 'b' || p_size, 'link-page' from part) select k, name, evidence, 2 as links from n""")
def candidate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of methods, each once, and the names that they offer."""
    link = lambda t, page: F.struct(t.alias("text"), said("https://a.example/w/", page).alias("href"))
    methods = _part(spark, sf_dir).select(K().alias("key"), F.lit(0).alias("pos"), F.array(link(said(" ", F.col("p_name")), said("b", N())), link(F.lit("任務"), F.lit("")), link(F.col("p_name"), said("b", N()))).alias("links"))
    links, names = nested.candidate_links(methods, "/w/", generic=("任務",))
    return names.join(links.groupBy("key").agg(F.count("*").cast("int").alias("links")), "key").select(F.col("key").alias("k"), "name", "evidence", "links")


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.when(N() % 6 == 0, F.array(K() + 1, K())).otherwise(F.array(K(), K() + 1))
    body = F.struct(ids.alias("shipIds"), F.array(N() % 5).alias("upgradeFromItemIds"), F.array().cast("array<long>").alias("questKey"), F.when(N() % 7 > 0, N() % 2 == 0).alias("developmentAvailable"), F.when(N() % 10 == 0, 1).alias("extra"))
    return _numbered(spark, sf_dir).select(K().alias("pos"), F.to_json(F.struct(K().alias("equipmentId"), F.col("p_name").alias("equipmentName"), body.alias("source"))).alias("json"))


def _drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.struct((K() + 1).alias("shipId"), F.lit("s").alias("shipName"), F.when(N() % 5 == 0, "gift").otherwise("initial").alias("method"), (N() % 4).alias("quantity"))
    return _numbered(spark, sf_dir).select(K().alias("pos"), F.to_json(F.struct(K().alias("equipmentId"), F.col("p_name").alias("equipmentName"), F.when(N() % 9 > 0, F.array(source, source)).otherwise(F.array().cast(f"array<{'struct<shipId:bigint,shipName:string,method:string,quantity:int>'}>")).alias("sources"))).alias("json"))


def _bonuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = N() % 2 == 0
    bonus = F.when(N() % 5 > 0, F.create_map(F.lit("firepower"), F.when(N() % 9 == 0, "x").otherwise("1"))).otherwise(F.create_map().cast("map<string,string>"))
    rule = F.struct(bonus.alias("bonus"), F.when(N() % 7 == 0, F.create_map(F.lit("odd"), F.lit("1"))).alias("sourceBonusFields"), F.create_map(F.lit("level"), F.lit("1")).alias("conditions"))
    target = F.struct(F.when(one, "equipment").otherwise("equipment-type").alias("kind"), F.when(one, F.array(K())).alias("equipmentIds"), F.when(~one, F.array(K() + 1)).alias("equipmentTypeIds"))
    record = F.struct(target.alias("target"), F.when(one, K()).alias("equipmentId"), F.when(one, F.col("p_name")).alias("equipmentName"), F.when(~one, F.array(K(), N())).alias("equipmentTypeIds"), F.array(rule).alias("rules"))
    return _numbered(spark, sf_dir).select(K().alias("pos"), F.to_json(record).alias("json"))


@query("""with p as (select p_partkey + 1 as k, p_size as n from part), t as (select *, case when n % 2 = 0 then 'equipment:' || k else 'types:' || k || ',' || n end as target from p)
  select 'source.shipIds' as rule, cast(k as varchar) as key from p where n % 6 = 0 union all select 'source.upgradeFromItemIds', cast(k as varchar) from p where n % 5 = 0 union all select 'source.contract', cast(k as varchar) from p where n % 10 = 0 or n % 7 = 0 union all select 'source.flag', cast(k as varchar) from p where n % 7 = 0
  union all select 'drop.sources', cast(k as varchar) from p where n % 9 = 0 union all select 'drop.methods', cast(k as varchar) from p where n % 5 = 0 and n % 9 > 0 union all select 'drop.quantities', cast(k as varchar) from p where n % 4 = 0 and n % 9 > 0
  union all select 'bonus.types', target from t where n % 2 = 1 union all select 'bonus.stats', target from t where n % 5 = 0 union all select 'bonus.unknown-stats', target from t where n % 7 = 0 union all select 'bonus.numbers', target from t where n % 9 = 0 and n % 5 > 0""")
def dataset_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: rules of item sources, drops and bonuses that some records break."""
    found = rules.source_violations(_sources(spark, sf_dir)).union(rules.drop_violations(_drops(spark, sf_dir)))
    return found.union(rules.bonus_violations(_bonuses(spark, sf_dir))).select("rule", "key")


@query("""with p as (select p_partkey as k, p_size as n from part) select 'list.views' as rule, cast(k as varchar) as key from p where n % 5 = 0 union all select 'list.digest', cast(k as varchar) from p where n % 3 = 0 union all select 'list.item-count', cast(k as varchar) from p where n % 7 = 0
  union all select 'list.row', k || '/0/x' from p where n % 11 = 0 union all select 'list.unique-items', k || '/1/' || n from p where n % 2 = 0""")
def list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: rules of list documents that some break."""
    row = said("[", N(), ',["a"]]')
    more = said(F.when(N() % 2 == 0, said(row, ",")).otherwise(""), row)
    views = said("[[", F.when(N() % 11 == 0, F.lit('["x",[]]')).otherwise(row), "],[", more, "],[],[],[],[],[]", F.when(N() % 5 > 0, ",[]").otherwise(""), "]")
    meta = lambda digest: said('{"contentDigest":"', digest, '","contentDigestSchemaVersion":1,"itemCount":', F.when(N() % 7 == 0, 2).otherwise(1), ',"rowSchema":["itemId","assistantTexts"],"schemaVersion":2}')
    whole = lambda digest: said('{"data":', views, ',"metadata":', meta(digest), "}")
    digest = said("sha256:", text.content_digest(whole(F.lit(""))))
    documents = _part(spark, sf_dir).select(K().alias("pos"), whole(F.when(N() % 3 == 0, "sha256:0").otherwise(digest)).alias("json"))
    return rules.list_violations(documents)


@query("""with p as (select p_partkey + 1 as k, p_size as n from part) select 'asset.name' as rule, 'assets/' || k || '.jpg' as key from p where n % 4 = 0 union all select 'asset.kind', 'assets/' || k || case when n % 4 = 0 then '.jpg' else '.png' end from p where n % 5 = 0 union all select 'asset.size', 'assets/' || k || case when n % 4 = 0 then '.jpg' else '.png' end from p where n % 3 = 0""")
def asset_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: names, kinds and sizes of pictures."""
    head = F.when(N() % 5 == 0, "00504E470D0A1A0A").otherwise("89504E470D0A1A0A")
    content = F.unhex(said(head, "0000000D49484452", "00000186", F.when(N() % 3 == 0, "00000000").otherwise("00000186")))
    files = _numbered(spark, sf_dir).select(said("assets/", K(), F.when(N() % 4 == 0, ".jpg").otherwise(".png")).alias("path"), content.alias("content"))
    return rules.asset_violations(files, kind="png", size=(390, 390))


@query(f"""{_IDS}, f as (select 'assets/useitem/' || n || '.webp' as path, k as bytes from p union all select 'assets/equip/' || k || '.webp', n from p union all select 'compat/x/' || k || '.png', 1 from p), need as (select distinct n % 9 - 1 as id from p where n % 9 > 1), m as (
  select 'improvement.listViewCount' as metric, count(distinct n % 8) as value from p union all select 'improvement.listAllCount', count(*) filter (n % 8 = 0) from p union all select 'improvement.detailRecordCount', count(*) from p union all select 'improvement.effectExpectationAvailableCount', count(*) filter (n % 4 > 0) from p
  union all select 'improvement.effectExpectationUnavailableCount', count(*) filter (n % 4 = 0 and n % 8 > 0) from p union all select 'improvement.routeCount', count(*) from p union all select 'improvement.stepCount', sum(case when n % 19 = 0 then 10 else 11 end) from p union all select 'improvement.upgradeAvailableCount', count(*) filter (n % 3 = 0 and n % 19 > 0) from p
  union all select 'compat.detailRecordCount', count(*) from p union all select 'compat.routeCount', count(*) from p union all select 'equipmentDropFrom.recordCount', count(*) from p union all select 'equipmentDropFrom.relationCount', sum(case when n % 9 > 0 then 2 * (n % 4) else 0 end) from p
  union all select 'equipmentSources.recordCount', count(*) from p union all select 'equipmentSources.shipRelationCount', 2 * count(*) from p union all select 'equipmentSources.upgradeRelationCount', count(*) from p union all select 'equipmentSources.questRelationCount', 0
  union all select 'equipmentSpecialBonuses.recordCount', count(*) from p union all select 'equipmentSpecialBonuses.equipmentRecordCount', count(*) filter (n % 2 = 0) from p union all select 'equipmentSpecialBonuses.equipmentTypeRecordCount', count(*) filter (n % 2 = 1) from p union all select 'equipmentSpecialBonuses.ruleCount', count(*) from p
  union all select 'useitemIcons.requiredCount', count(*) from need union all select 'useitemIcons.missingCount', count(*) from need where id not in (select n from p) union all select 'useitemIcons.count', count(*) filter (path like 'assets/useitem/%') from f union all select 'useitemIcons.totalBytes', sum(bytes) filter (path like 'assets/useitem/%') from f
  union all select 'compat.useitemPngCount', count(*) filter (path like 'compat/%') from f union all select 'equipmentImages.count', count(*) filter (path like 'assets/equip/%') from f union all select 'equipmentImages.totalBytes', sum(bytes) filter (path like 'assets/equip/%') from f union all select 'publicData.totalBytes', sum(bytes) from f)
  select metric, cast(value as double) as value from m""")
def package_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a package."""
    part, details = _numbered(spark, sf_dir), _details(spark, sf_dir)
    files = part.select(said("assets/useitem/", N(), ".webp").alias("path"), K().alias("bytes")).union(part.select(said("assets/equip/", K(), ".webp"), N().cast("long"))).union(part.select(said("compat/x/", K(), ".png"), F.lit(1).cast("long")))
    views = part.select((N() % 8).alias("view"), K().alias("item"))
    return rules.package_counts(views=views, details=details, compat=details, drops=_drops(spark, sf_dir), sources=_sources(spark, sf_dir), bonuses=_bonuses(spark, sf_dir), files=files)


@query(f"""{_IDS} select k as pos, '{{"id":' || id || ',"name":"' || case when n % 11 = 0 then ' ' else p_name end || '","improvementList":[{{"routeId":"r' || n || '"}}]}}' as json from p join part on p_partkey + 1 = k""")
def narrow_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: records with the fields of a narrower dataset only; a wrong type stops."""
    return rules.projected(_details(spark, sf_dir), "id long, name string, improvementList array<struct<routeId:string>>")


# --- resolution ----------------------------------------------------------------------------------


@query("""with recursive e as (select n_nationkey as node, case when n_nationkey % 6 <> 5 then (n_nationkey * 7 + 3) % 25 end as next, 100 - n_nationkey as rank from nation),
  w as (select node as root, node, 0 as distance, list_value(node) as path from e union all select w.root, next, distance + 1, list_append(path, next) from w join e on e.node = w.node where next is not null and not list_contains(path, next)),
  ends as (select root, arg_max(node, distance) as last from w group by 1), ring as (select w.root, w.node as member from w join ends on ends.root = w.root join e on e.node = ends.last where e.next = w.root),
  ordered as (select root, list(member order by rank, member) as ring from ring join e on e.node = member group by 1), known as (select w.*, o.ring from w left join ordered o on o.root = w.node),
  entry as (select root, min(distance) as d, arg_min(node, distance) as met, arg_min(ring, distance) as ring from known where ring is not null group by 1)
  select w.root, w.node, cast(distance as int) as distance from w left join entry on entry.root = w.root where d is null or distance < d union all select root, ring[i], cast(d + i - list_position(ring, met) as int) from (select *, unnest(range(list_position(ring, met), len(ring) + 1)) as i from entry)""")
def ordered_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Successors, a cycle's members in the cycle's own order from where it is met."""
    return resolve.ordered_closure(_successors(spark, sf_dir))


def _successors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey").cast("long")
    return read(spark, sf_dir, "nation").select(n.alias("node"), F.when(n % 6 != 5, (n * 7 + 3) % 25).alias("next"), (100 - n).alias("rank"))


@query("""with recursive e as (select n_nationkey as node, case when n_nationkey % 5 < 4 then n_nationkey + 1 end as next from nation), up as (select node as root, node, 0 as place from e union all select root, next, place + 1 from up join e on e.node = up.node where next is not null and next < 25)
  select root, node, cast(place as int) as place from up union all select node, root, cast(-place as int) from up where place > 0""")
def family_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear families, predecessors and successors of each member."""
    n = F.col("n_nationkey").cast("long")
    return resolve.family_chain(read(spark, sf_dir, "nation").select(n.alias("node"), F.when(n % 5 < 4, n + 1).alias("next"), F.lit(0).alias("rank")))


@query("""with recursive e as (select n_nationkey as node, case when n_nationkey % 5 < 4 then n_nationkey + 1 end as next from nation), w as (select node as root, node, 0 as distance from e union all select root, next, distance + 1 from w join e on e.node = w.node where next is not null),
  named as (select n_nationkey as rule, unnest(case n_nationkey % 4 when 2 then list_value(n_nationkey) else list_value(n_nationkey, (n_nationkey + 5) % 25) end) as anchor from nation), spread as (select rule, node as id, min(distance) as distance from named join w on root = anchor where rule % 4 <> 2 or distance = 0 group by 1, 2)
  select rule, id, cast(distance as int) as distance from spread where not (rule % 4 = 0 and id = (rule + 1) % 25) and not (rule % 4 = 1 and id in (select node from w where root = (rule + 1) % 25)) """)
def selector_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in a list with exclusions, of one or of all successors, only the first, or what is allowed anyway."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    name = lambda i: said("m", i % 25)
    inside = F.when(K() % 4 == 0, said(name(K() + 1), "不可")).when(K() % 4 == 1, said(name(K() + 1), "~不可")).when(K() % 4 == 2, F.lit("のみ")).otherwise(said(name(K() + 1), "・x可"))
    parts = resolve.selectors(nation.select(K().alias("rule"), said(name(K()), "/", name(K() + 5), "(", inside, ")").alias("text")), "text")
    edges = nation.select(K().alias("node"), F.when(K() % 5 < 4, K() + 1).alias("next"), F.lit(0).alias("rank"))
    return resolve.select_ids(parts, nation.select(name(K()).alias("name"), K().alias("id")), resolve.forward_closure(edges))


@query("""select p_partkey as k, case when c = 1 then m when p_size % 3 = 0 then p_partkey when p_size % 3 = 1 then hi else lo end as id from part join (select p_brand, count(*) as c, min(p_partkey) as m, max(p_partkey) as hi, arg_min(p_partkey, (p_size, p_partkey)) as lo from part group by 1) using (p_brand)""")
def exact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that several have, by its picture, by a fallback, or by the least rank."""
    part = _part(spark, sf_dir)
    high = part.groupBy("p_brand").agg(F.max("k").alias("hi"))
    wanted = part.join(high, "p_brand").select("k", F.col("p_brand").alias("name"), F.when(N() % 3 == 0, K()).otherwise(-1).alias("image"), F.when(N() % 3 == 1, F.col("hi")).otherwise(-2).alias("fallback"))
    return resolve.choose_exact(wanted, part.select(F.col("p_brand").alias("name"), K().alias("id"), N().alias("rank")), lambda c: F.lower(c)).select("k", "id")


@query("""with f as (select n_nationkey as k, n_nationkey - n_nationkey % 5 as family from nation) select 'exact' as fragment, k as anchor, k as id, 'resolved' as state from f where k % 5 = 0 union all select 'exact', k, cast(null as bigint), 'unresolved' from f where false
  union all select 'X' || i, k, family + i, 'resolved' from f, range(1, 4) t(i) union all select 'tail', k, case when k % 5 = 4 then k end, case when k % 5 = 4 then 'resolved' else 'ambiguous' end from f union all select 'nowhere', k, null, 'unresolved' from f""")
def name_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of names within a family: whole names, the family's root with them, the best scored; ties and nothing."""
    k = F.col("n_nationkey").cast("long")
    nation = read(spark, sf_dir, "nation").select(k.alias("id"), (k - k % 5).alias("family"), (k % 5).alias("i"))
    name = F.when(F.col("i") == 0, said("base", F.col("family"))).when(F.col("i") == 4, said("base", F.col("family"), "longtailx")).otherwise(said("base", F.col("family"), "X", F.col("i")))
    again = F.when(F.col("i") == 1, said(name)).otherwise(name)
    catalog = nation.select(again.alias("name"), "id")
    # two names of each family that hold the same part, alike as to their beginnings
    extra = nation.where("i = 4").select(said("base", F.col("family"), "longtaily").alias("name"), (F.col("id") + 100).alias("id"), "family")
    families = nation.select(F.col("id").alias("node"), "family").union(extra.select("id", "family"))
    pick = F.explode(F.array(*map(F.lit, ("X1", "X2", "X3", "tail", "nowhere")))).alias("fragment")
    whole = nation.where("i = 0").select(said("base", F.col("family")).alias("fragment"), F.col("id").alias("anchor"))
    wanted = nation.select(pick, F.col("id").alias("anchor")).union(whole)
    found = resolve.resolve_fragments(wanted, catalog.union(extra.select("name", "id")), families, lambda c: c)
    return found.select(F.when(F.col("fragment").startswith("base"), "exact").otherwise(F.col("fragment")).alias("fragment"), "anchor", "id", "state")


@query("""select 'explicit' as kind, n_name || '(b)' as name, n_nationkey as id, 'shown ' || n_nationkey as shown, 0 as bad from nation where n_nationkey % 3 > 0 union all select 'link', n_name, n_nationkey, 'shown ' || n_nationkey, 0 from nation where n_nationkey % 3 > 0
  union all select 'issue', 'X' || n_nationkey, n_nationkey, null, 1 from nation where n_nationkey % 3 = 0""")
def ambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for names that several share, checked against the catalog."""
    k = F.col("n_nationkey").cast("long")
    nation = read(spark, sf_dir, "nation").select(k.alias("id"), F.col("n_name").alias("name"))
    base = F.when(F.col("id") % 3 == 0, said("X", F.col("id"))).otherwise(F.col("name"))
    rule = lambda kind, name: nation.select(base.alias("base"), F.lit(kind).alias("kind"), name.alias("name"), "id")
    made = rule("explicit", said(F.col("name"), "(b)")).union(rule("link", F.col("name"))).union(rule("display", said("shown ", F.col("id"))))
    made = made.union(made.where("kind = 'link'").select("base", "kind", "name", F.col("id") + 1000))
    names, issues = records.ambiguous_names(made, nation)
    return names.select("kind", "name", "id", "shown", F.lit(0).alias("bad")).union(issues.select(F.lit("issue"), "base", "id", F.lit(None).cast("string"), F.lit(1)))


@query("""select 'name' as by, 'Quest ' || (p_size % 7) as ref, case when count(*) = 1 then min(p_partkey) + 1 end as key, case when count(*) = 1 then 'resolved' else 'ambiguous' end as state, count(*) as candidates from part group by p_size % 7
  union all select 'code', 'c' || (p_partkey + 1), p_partkey + 1, 'resolved', 1 from part union all select 'name', 'Quest x', null, 'unresolved', 0""")
def quest_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quests by their exact name or their code; several of a name are candidates."""
    part = _numbered(spark, sf_dir)
    documents = part.select(said('{"', K(), '": {"code": "C', K(), '", "name": "Quest　', N() % 7, '"}, "no": 1}').alias("j"))
    quests, _ = records.quest_catalog(documents, "j")
    refs = part.select(said("Quest ", N() % 7).alias("ref"), F.lit("name").alias("by")).union(part.select(said("c", K()), F.lit("code"))).distinct().union(spark.createDataFrame([("Quest x", "name")], "ref string, by string"))
    return records.resolve_quests(refs, quests).select("by", "ref", "key", "state", F.size("candidates").cast("long").alias("candidates"))


@query("""select p_partkey as k, p_size as n from part where p_name like '%a%' and p_size % 3 = 1 and p_partkey % 2 = 0""")
def catalog_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a catalog by a part of their name, a slot of their types and any predicate."""
    catalog = _part(spark, sf_dir).select("k", "n", F.col("p_name").alias("name"), F.array(N() % 2, N() % 3).alias("types"))
    return resolve.find_entries(catalog, contains="a", slot=1, value=1, where=K() % 2 == 0).select("k", "n")


@query("""select p_brand as alias, p_type as target from part where p_size % 2 = 0 and p_size % 3 <> 1 and p_size % 5 > 0 group by all""")
def scoped_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted aliases of one source, or of all, for one mode of use."""
    entries = _part(spark, sf_dir).select(
        F.col("p_brand").alias("alias"), F.col("p_type").alias("target"), F.when(N() % 3 == 0, "a").when(N() % 3 == 1, "b").otherwise("*").alias("source"), F.when(N() % 5 == 0, F.array(F.lit("scan"))).otherwise(F.array(F.lit("exact"), F.lit("scan"))).alias("modes"), F.when(N() % 2 == 0, "accepted").otherwise("draft").alias("status")
    )
    return records.alias_table(entries, source="a", mode="exact")


# --- packages and states -------------------------------------------------------------------------


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _part(spark, sf_dir)
    document = part.select(said("data/", K(), ".json").alias("path"), said('{"b": ', N(), ', "a": {"generatedAt": 1}, "metadata": {"generatedAt": "', K(), '", "v": 1}}').cast("binary").alias("content"))
    return document.union(part.select(said("docs/", K(), ".txt"), F.col("p_name").cast("binary")))


@query("""with f as (select 'data/' || p_partkey || '.json' as path, sha256('{"a":{"generatedAt":1},"b":' || p_size || ',"metadata":{"v":1}}' || chr(10)) as d from part), g as (select * from f union all select 'docs/' || p_partkey || '.txt', sha256(p_name) from part)
  select 'small' as variant, sha256('v1' || chr(0) || 'small' || chr(0) || string_agg(path || chr(0) || d || chr(10), '' order by path)) as digest from f union all select 'all', sha256('v1' || chr(0) || 'all' || chr(0) || string_agg(path || chr(0) || d || chr(10), '' order by path)) from g""")
def package_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities of a package's variants, whatever the layout of its JSON and its volatile metadata."""
    files = _files(spark, sf_dir)
    digest = lambda variant, *prefixes: identity.identity(files, label="v1", variant=variant, prefixes=prefixes, volatile=text.VOLATILE)[0].select(F.lit(variant).alias("variant"), "digest")
    return digest("small", "data/").union(digest("all", "data/", "docs/"))


@query("""select 'main' as variant, 'data/' || p_partkey || '.json' as path, 'data/' || p_partkey || '.json' as source from part union all select 'compat', 'old/' || p_partkey || '.json', 'data/' || p_partkey || '.json' from part union all select 'compat', 'docs/' || p_partkey || '.txt', 'docs/' || p_partkey || '.txt' from part""")
def release_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the variants of a release are built of."""
    rules_ = spark.createDataFrame([("main", "data/", "data/"), ("compat", "data/", "old/"), ("compat", "docs/", "docs/")], "variant string, source string, target string")
    return identity.variants(_files(spark, sf_dir).select("path"), rules_)


@query("""select p_brand as variant, case when min(p_size) % 3 = 0 then 'publish' when min(p_size) % 3 = 1 then 'reuse' else 'retire' end as action from part group by 1 union all select p_brand || ' new', 'publish' from part group by 1""")
def variant_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which variants to publish, reuse or retire against what is published."""
    brands = _part(spark, sf_dir).groupBy("p_brand").agg(F.min("n").alias("n"))
    built = brands.where("n % 3 < 2").select(F.col("p_brand").alias("variant"), N().cast("string").alias("digest")).union(brands.select(said(F.col("p_brand"), " new"), F.lit("x")))
    published = brands.select(F.col("p_brand").alias("variant"), F.when(N() % 3 == 0, "old").otherwise(N().cast("string")).alias("digest"))
    return identity.plan_variants(built, published)


@query("""with p as (select p_partkey as k, p_size as n from part) select 'data/' || k || '.json' as path, case n % 4 when 0 then 'copy' when 1 then 'delete' when 2 then 'replace' else 'keep' end as action from p""")
def state_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What makes a project's files those of a state; what lies outside of its paths is left alone."""
    row = lambda keep, sha: _part(spark, sf_dir).where(keep).select(said("data/", K(), ".json").alias("path"), N().cast("long").alias("bytes"), sha.cast("string").alias("sha256"))
    other = _part(spark, sf_dir).select(said("work/", K()), N().cast("long"), F.lit("x"))
    return identity.sync_plan(row(N() % 4 != 1, N()).union(other), row(N() % 4 != 0, F.when(N() % 4 == 2, -N()).otherwise(N())), ("data",))


@query("""with f as (select 'data/' || p_partkey || '.json' as path, '{"b": ' || p_size || ', "a": {"generatedAt": 1}, "metadata": {"generatedAt": "' || p_partkey || '", "v": 1}}' as c from part) select 's' as state, 'b1' as build, count(*) as files, cast(sum(strlen(c)) as bigint) as bytes, sha256(string_agg(path || chr(0) || sha256(c) || chr(10), '' order by path)) as digest from f""")
def state_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state's manifest, without excluded files."""
    return identity.state_manifest(identity.exported(_files(spark, sf_dir), ("data", "docs"), ("*.txt",)), state="s", built="b1")[0]


@query("""select 'data/' || p_partkey as path, case when p_size % 3 = 0 then 'missing' else 'unused' end as state from part where p_size % 3 < 2""")
def bundle_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: entries that a build used and its bundle lacks, and the other way round."""
    part = _part(spark, sf_dir).select(said("data/", K()).alias("path"), "n")
    return identity.cache_closure(part.where("n % 3 > 0").select("path"), part.where("n % 3 <> 1").select("path"))


@query("""with v as (select p_size % 3 || '.' || p_size || '.0' as version, max(p_partkey) as pos from part group by 1) select version, pos, cast(row_number() over (order by cast(split_part(version, '.', 1) as int) desc, cast(split_part(version, '.', 2) as int) desc) as int) as rank from v""")
def release_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases, of one version the last, the newest first."""
    return identity.release_history(_part(spark, sf_dir).select(said(N() % 3, ".", N(), ".0").alias("version"), K().alias("pos")))


@query("""select p_partkey as k, case p_size % 4 when 0 then 'added' when 1 then 'removed' when 2 then 'changed' else 'unchanged' end as change from part""")
def text_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of records kept as JSON text in other layouts; of repeated keys the last counts."""
    row = lambda keep, value, pos: _part(spark, sf_dir).where(keep).select("k", value.alias("json"), F.lit(pos).alias("pos"))
    old = row(N() % 4 > 0, said('{"b": 1, "a": [', N(), "]}"), 1).union(row(N() % 4 > 0, F.lit("{}"), 0))
    new = row(N() % 4 != 1, said('{"a":[', F.when(N() % 4 == 2, -N()).otherwise(N()), '], "b":1}'), 0)
    return history.text_diff(old, new, "k", "json")


@query("""with p as (select p_partkey as k, p_size as n from part) select 'missing-key' as problem, '' as key from p where n % 10 = 0 union all select 'repeated-key', cast(n as varchar) from p where n % 10 > 0 group by n having count(*) > 1 union all select 'other-count', 'rows' union all select 'pending-stop', 'r1'""")
def snapshot_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a snapshot."""
    rows = _part(spark, sf_dir).select(F.when(N() % 10 > 0, N()).alias("n"))
    return gates.snapshot_problems(rows, "n", {"rows": -5, "none": 0}, {"rows": F.count("*"), "none": F.count_if(F.col("n") < 0)}, spark.createDataFrame([("r1",)], "reason string"))


@query("""select p_partkey as k, case when p_size % 2 = 0 and p_size % 3 > 0 then 'fresh' when p_size % 5 = 0 then 'reuse' when p_size % 7 = 0 then 'restore' else 'stop' end as choice, sha1(p_name) as sha1 from part""")
def source_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a step takes of what is there, and digests."""
    choice = gates.source_choice(fresh=N() % 2 == 0, cached=N() % 5 == 0, placeholder=N() % 3 == 0, legacy=N() % 7 == 0)
    return _part(spark, sf_dir).select("k", choice.alias("choice"), F.sha1(F.col("p_name").cast("binary")).alias("sha1"))
