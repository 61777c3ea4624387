"""Records made of foreign catalogs: owners of items, bonus rules, item sources, facts of routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import nested
from tessera.operators.contain import cut_lineage

# Names of the known stats and conditions of bonus rules.
STATS = {"houg": "firepower", "raig": "torpedo", "baku": "bombing", "tyku": "antiair", "souk": "armor", "tais": "asw", "houk": "evasion", "houm": "accuracy", "saku": "los", "leng": "range"}
CONDITIONS = ("shipId", "shipBase", "shipClass", "shipType", "shipCountry", "level", "num")


def as_list(value: str) -> Column:
    """A variant that is a list of ids or one id, as distinct positive whole numbers in input order."""
    many = F.expr(f"try_variant_get({value}, '$', 'array<string>')")
    one = F.expr(f"try_variant_get({value}, '$', 'string')")
    return nested.int_list(F.coalesce(many, F.array(one)))


def bonus_entries(documents: DataFrame, column: str) -> DataFrame:
    """Entries (pos, entry) of bonus documents in any of their layouts: a list, ``data``, one entry, a map of entries or of lists.

    ``pos`` is the entry's place: of its document, in it, and in a list within.
    """
    parsed = documents.select(F.monotonically_increasing_id().alias("document"), F.try_parse_json(column).alias("d"))
    return documents.sparkSession.sql("""
      with roots as (select document, coalesce(try_variant_get(d, '$.data', 'variant'), d) as r from {parsed}),
      marked as (select *, try_variant_get(r, '$.bonuses', 'variant') is not null or try_variant_get(r, '$.bonus', 'variant') is not null as single from roots),
      many as (select document, x.pos as p, x.value as v from marked, lateral variant_explode(r) x where not single)
      select struct(document, 0 as p, 0 as q) as pos, r as entry from marked where single
      union all select struct(document, p, y.pos as q), y.value from many, lateral variant_explode(v) y where schema_of_variant(v) like 'ARRAY%'
      union all select struct(document, p, 0 as q), v from many where schema_of_variant(v) like 'OBJECT%'""", parsed=parsed)


def bonus_rules(entries: DataFrame) -> DataFrame:
    """(pos, ids, types, bonus, unknown, conditions) of each rule of the entries; rules without any stat are left out.

    ``bonus`` has the known stats renamed, ``unknown`` what is left over.
    """
    rules = entries.sparkSession.sql(f"""
      select b.pos as pos, coalesce(try_variant_get(entry, '$.ids', 'variant'), try_variant_get(entry, '$.id', 'variant')) as ids,
        coalesce(try_variant_get(entry, '$.types', 'variant'), try_variant_get(entry, '$.type', 'variant')) as types, r.pos as rule_pos,
        coalesce(try_variant_get(r.value, '$.bonus', 'map<string,double>'), map()) as stats, try_variant_get(r.value, '$', 'map<string,variant>') as all_keys
      from (select *, coalesce(try_variant_get(entry, '$.bonuses', 'array<variant>'), array(entry)) as list from {{entries}}) b, lateral posexplode(list) as r(pos, value)""", entries=entries)
    bonus, unknown = nested.rename_keys(F.col("stats"), STATS)
    conditions = F.transform_values(F.map_filter("all_keys", lambda k, v: k.isin(*CONDITIONS) | k.startswith("requires")), lambda k, v: F.to_json(v))
    shaped = rules.select("pos", "rule_pos", as_list("ids").alias("ids"), as_list("types").alias("types"), bonus.alias("bonus"), unknown.alias("unknown"), conditions.alias("conditions"))
    return shaped.where((F.size("bonus") > 0) | (F.size("unknown") > 0))


def owner_nodes(documents: DataFrame, column: str) -> DataFrame:
    """Slots (owner_ref, remodel_from, slot, item_ref, size) of all nodes of nested JSON, however deep, that have an ``_equipment`` list.

    One stage goes some levels down and writes the slots found on its way and the nodes below its last level; the next goes on with these.
    Nodes without slots are not carried along, and no level is gone through twice.
    """
    pending = "struct<owner_ref:string,remodel_from:string,equipment:variant>"
    get = lambda value, path, kind: f"try_variant_get({value}, '{path}', '{kind}')"
    owner = f"coalesce({get('v', '$._api_id', 'string')}, {get('v', '$._japanese_name', 'string')})"
    listed = lambda value: f"coalesce({get(value, '$', 'array<variant>')}, map_values({get(value, '$', 'map<string,variant>')}), array())"
    each = f"transform({listed('equipment')}, (e, i) -> struct(i as slot, {get('e', '$.equipment', 'string')} as item_ref, coalesce({get('e', '$.size', 'int')}, 0) as size))"
    found = f"struct({owner} as owner_ref, {get('v', '$._remodel_from', 'string')} as remodel_from, {get('v', '$._equipment', 'variant')} as equipment)"
    below = f"transform({listed('v')}, c -> struct(c as v, cast(null as {pending}) as o))"
    step = f"if(o is not null, array(struct(v, o)), concat(if({owner} is not null and {get('v', '$._equipment', 'variant')} is not null, array(struct(cast(null as variant) as v, {found} as o)), array()), {below}))"
    ahead = documents.select(F.try_parse_json(column).alias("v"), F.lit(None).cast(pending).alias("o")).where("v is not null")
    slots = None
    while True:
        for _ in range(nested.WALKED):
            ahead = ahead.selectExpr(f"explode({step}) as n").selectExpr("n.v", "n.o").where("v is not null or o is not null")
        rows = ahead.selectExpr("v", "o.owner_ref", "o.remodel_from", "o.equipment")
        rows = rows.selectExpr("v", "owner_ref", "remodel_from", f"explode(if(owner_ref is null, array(cast(null as struct<slot:int,item_ref:string,size:int>)), {each})) as s")
        rows = cut_lineage(rows.selectExpr("v", "owner_ref", "remodel_from", "s.slot", "s.item_ref", "s.size"))
        own = rows.where("owner_ref is not null").drop("v")
        slots = own if slots is None else slots.unionAll(own)
        ahead = rows.where("owner_ref is null").select("v", F.lit(None).cast(pending).alias("o"))
        if not ahead.limit(1).count():
            return slots


def owned_items(slots: DataFrame, owners: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records by item, issues) of slots whose references the catalogs (ref, id) resolve; an empty slot is no issue."""
    own = owners.select(F.col("ref").alias("owner_ref"), F.col("id").alias("owner"))
    of = items.select(F.col("ref").alias("item_ref"), F.col("id").alias("item_id"))
    real = slots.where("item_ref is not null and item_ref <> 'false'")
    joined = real.join(own, "owner_ref", "left").join(of, "item_ref", "left")
    method = F.when(F.col("remodel_from").isNotNull() & ~F.col("remodel_from").isin("false", ""), "remodel").otherwise("initial")
    good = joined.where("owner is not null and item_id is not null").withColumn("method", method)
    issues = joined.where("owner is null or item_id is null").select(F.when(F.col("owner").isNull(), "unknown-owner").otherwise("unknown-item").alias("kind"), "owner_ref", "item_ref").distinct()
    return nested.group_slots(good.select("item_id", "owner", "method", "slot", "size")), issues


def item_sources(spine: DataFrame, owners: DataFrame, upgrades: DataFrame, quests: DataFrame, flags: DataFrame, check: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, issues): every item of the spine (id) with its owners, upgrade origins, quests and flag.

    ``owners``, ``upgrades``, ``quests``: (id, source); ``flags``: (id, flag), required; ``check``: (id, flag), compared only.
    """
    out = spine.select("id").distinct()
    for name, index in (("owners", owners), ("upgrades", upgrades), ("quests", quests)):
        own = index.groupBy("id").agg(F.sort_array(F.collect_set("source")).alias(name))
        out = out.join(own, "id", "left").withColumn(name, F.coalesce(name, F.array().cast("array<long>")))
    out = out.join(flags.select("id", F.col("flag")), "id", "left").join(check.select("id", F.col("flag").alias("_check")), "id", "left")
    issue = F.when(F.col("flag").isNull(), "missing-flag").when(F.col("_check").isNull(), "unchecked-flag").when(F.col("flag") != F.col("_check"), "conflicting-flag")
    issues = out.select("id", issue.alias("issue")).where("issue is not null")
    return out.where("flag is not null").drop("_check"), issues


def facts_of_routes(routes: DataFrame, source: str) -> DataFrame:
    """Facts of routes (item_id, route, days, targets, anchors): to improve, and one upgrade for each target.

    A fact is explicit if its assistant is an anchor of the route, or stands for anyone.
    """
    week = nested.week_by_assistant(routes.select("route", "days")).withColumnRenamed("assistant", "assistant_id")
    joined = routes.select("item_id", "route", "targets", "anchors").join(week, "route")
    explicit = F.col("assistant_id").isNull() | F.coalesce(F.array_contains("anchors", F.col("assistant_id")), F.lit(False))
    base = joined.withColumn("source", F.lit(source)).withColumn("evidence_status", F.when(explicit, "explicit").otherwise("inferred"))
    columns = ["source", "item_id", "assistant_id", "capability", "target_id", "route", "mask", "evidence_status"]
    improve = base.withColumn("capability", F.lit("improve")).withColumn("target_id", F.lit(None).cast("long"))
    upgrade = base.withColumn("capability", F.lit("upgrade")).withColumn("target_id", F.explode(F.array_distinct("targets")))
    return improve.select(columns).union(upgrade.select(columns))


def alias_table(entries: DataFrame, *, source: str, mode: str) -> DataFrame:
    """(alias, target) of accepted entries (alias, target, source, modes, status) for one source, or for all, and one mode of use."""
    fits = (F.col("status") == "accepted") & (F.col("source").isin(source, "*")) & F.array_contains("modes", mode)
    return entries.where(fits).select("alias", "target").distinct()


def ambiguous_names(rules: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, issues) of rules (base, kind, name, id) for names that several entries of a catalog share.

    ``kind`` is ``explicit`` (a text that means one of them), ``link`` (a page that does) or ``display`` (how one is
    shown). Ids that the catalog lacks are left out; an id whose name is not the base is an issue. ``names`` has
    (kind, name, id, shown).
    """
    known = catalog.select("id", F.col("name").alias("official"))
    shown = rules.where("kind = 'display'").groupBy("id").agg(F.min("name").alias("shown"))
    joined = rules.join(known, "id")
    issues = joined.where("official <> base").select("base", "id", F.lit("rule-conflicts-with-catalog").alias("issue")).distinct()
    names = joined.where("kind <> 'display' and official = base").join(shown, "id", "left")
    return names.select("kind", "name", "id", F.coalesce("shown", "official").alias("shown")).distinct(), issues


def quest_catalog(documents: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(quests, issues) of documents that are one object by quest number: (key, code, name); keys that are no positive number are issues."""
    parsed = documents.select(F.try_parse_json(column).alias("d"))
    each = documents.sparkSession.sql("select x.key as raw, schema_of_variant(x.value) as kind, try_variant_get(x.value, '$.code', 'string') as code, try_variant_get(x.value, '$.name', 'string') as name from {parsed}, lateral variant_explode(d) x", parsed=parsed)
    sound = F.col("raw").rlike(r"^\d+$") & (F.col("raw").try_cast("long") > 0) & F.col("kind").startswith("OBJECT")
    quests = each.where(sound).select(F.col("raw").cast("long").alias("key"), F.nullif(F.trim("code"), F.lit("")).alias("code"), F.nullif(F.trim("name"), F.lit("")).alias("name"))
    return quests, each.where(~sound | F.col("raw").isNull()).select(F.col("raw").alias("ref"), F.lit("bad-quest-key").alias("issue"))


def resolve_quests(refs: DataFrame, quests: DataFrame) -> DataFrame:
    """Refs (ref, by) with (key, state, candidates): ``by`` name, exactly but for width and blanks, or by code in any case."""
    from tessera.functions.text import normalize_exact

    names = quests.where("name is not null").select(F.lit("name").alias("by"), normalize_exact(F.col("name")).alias("_form"), "key")
    codes = quests.where("code is not null").select(F.lit("code"), F.lower("code"), "key")
    known = names.union(codes).groupBy("by", "_form").agg(F.sort_array(F.collect_set("key")).alias("candidates"))
    asked = refs.withColumn("_form", F.when(F.col("by") == "code", F.lower("ref")).otherwise(normalize_exact(F.col("ref"))))
    joined = asked.join(known, ["by", "_form"], "left")
    state = F.when(F.col("candidates").isNull(), "unresolved").when(F.size("candidates") == 1, "resolved").otherwise("ambiguous")
    return joined.select(*refs.columns, F.when(state == "resolved", F.col("candidates")[0]).alias("key"), state.alias("state"), F.coalesce("candidates", F.array().cast("array<long>")).alias("candidates"))


def reference_aliases(owners: DataFrame) -> DataFrame:
    """(alias, id) of owners (id, path, name, suffix): path, slash, suffix forms, each once."""
    forms = F.array(F.col("name"), F.concat_ws("/", "path", "name"), F.concat_ws(" ", "name", "suffix"), F.concat("name", F.coalesce("suffix", F.lit(""))))
    return owners.select(F.explode(F.array_distinct(F.filter(forms, lambda x: x.isNotNull() & (x != "")))).alias("alias"), "id").distinct()


def check_aliases(aliases: DataFrame, catalog: DataFrame) -> DataFrame:
    """Issues of an alias table (alias, target, required): collisions, unknown targets, names that lack a required part."""
    clash = aliases.groupBy("alias").agg(F.count_distinct("target").alias("n")).where("n > 1").select("alias", F.lit("collision").alias("issue"))
    joined = aliases.join(catalog.select(F.col("id").alias("target"), "name"), "target", "left")
    lost = joined.where("name is null").select("alias", F.lit("unknown-target").alias("issue"))
    part = joined.where(F.col("required").isNotNull() & ~F.col("name").contains(F.col("required"))).select("alias", F.lit("required-part-missing").alias("issue"))
    return clash.union(lost).union(part).distinct()


def resolve_references(records: DataFrame, catalogs: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(ids by record and kind, issues) of records' references (record, kind, ref), each kind by its catalog (ref, id).

    Of several ids for a reference all are listed with an issue, none is taken.
    """
    known = None
    for kind, catalog in catalogs.items():
        own = catalog.groupBy("ref").agg(F.sort_array(F.collect_set("id")).alias("ids")).select(F.lit(kind).alias("kind"), "ref", "ids")
        known = own if known is None else known.union(own)
    joined = records.dropDuplicates(["record", "kind", "ref"]).join(known, ["kind", "ref"], "left")
    ids = joined.where(F.size("ids") == 1).groupBy("record", "kind").agg(F.sort_array(F.collect_set(F.col("ids")[0])).alias("ids"))
    issues = joined.where("ids is null or size(ids) > 1").select("record", "kind", "ref", F.when(F.col("ids").isNull(), "unresolved").otherwise("ambiguous").alias("issue"), F.coalesce("ids", F.array().cast("array<long>")).alias("candidates"))
    return ids, issues
