"""Expanding, regrouping and projecting nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.contain import cut_lineage

LEVELS = 10
LATER = 1_000_000_000
DAY_ALL = 0


def int_list(value: Column, *, ordered: bool = False) -> Column:
    """Positive whole numbers of a list of strings, each once: in input order, or sorted."""
    numbers = F.filter(F.transform(value, positive_int), lambda x: x.isNotNull())
    return F.array_sort(F.array_distinct(numbers)) if ordered else F.array_distinct(numbers)


def positive_int(value: Column) -> Column:
    number = value.try_cast("long")
    return F.when(number > 0, number)


def expand_steps(stages: DataFrame, upgrades: DataFrame | None = None) -> DataFrame:
    """Eleven steps for each id: ten to improve, taken from the last stage that covers the level, and an upgrade.

    ``stages``: (id, pos, first, last, cost); ``upgrades``: (id, target). Levels without a stage are there, not available.
    """
    kind = stages.schema["cost"].dataType
    rows = stages.select("id", "pos", "first", "last", "cost", F.lit(None).cast("long").alias("target"), F.lit(True).alias("own"))
    if upgrades is not None:
        rows = rows.unionByName(upgrades.select("id", F.col("target").cast("long").alias("target"), F.lit(False).alias("own")), allowMissingColumns=True)
    covers = lambda level: (F.col("first") <= level) & (F.col("last") >= level)
    costs = F.array(*(F.max_by("cost", F.when(covers(level), F.col("pos"))) for level in range(LEVELS)))
    known = F.col("id").isNotNull()  # what has no id has no stages to look up
    # all of an id meets in one aggregate, a row an id; steps are told apart after it, so no side of a join is held anywhere
    each = rows.groupBy("id").agg(F.when(known, costs).alias("costs"), F.when(known, F.max("target")).alias("target"), F.max("own").alias("own")).where("own")
    nothing = F.lit(None).cast("long")

    def improve(level: int) -> Column:
        cost = F.get("costs", F.lit(level))
        return F.struct(F.lit(level).alias("level"), F.lit("improve").alias("action"), cost.isNotNull().alias("available"), cost.alias("cost"), nothing.alias("target"))

    upgrade = F.struct(F.lit(LEVELS).alias("level"), F.lit("upgrade").alias("action"), F.col("target").isNotNull().alias("available"), F.lit(None).cast(kind).alias("cost"), F.col("target").alias("target"))
    return each.select("id", F.explode(F.array(*map(improve, range(LEVELS)), upgrade)).alias("s")).select("id", "s.*")


def list_views(rules: DataFrame) -> DataFrame:
    """Views of rules (item_id, seq, source_order, text, mask): (view, item_id, texts), view 0 for all days, 1 to 7 for each.

    A view has the item if any rule is enabled there, with or without a text. Texts stand by (source order or
    last, seq, text), each once.
    """
    enabled = rules.where("mask > 0")
    days = F.array(*(F.when(F.col("mask").bitwiseAND(1 << d) > 0, F.lit(d + 1)) for d in range(7)))
    views = F.filter(F.concat(F.array(F.lit(DAY_ALL)), days), lambda v: v.isNotNull())
    order = F.when(F.col("source_order") >= 0, F.col("source_order")).otherwise(LATER)
    text = F.trim(F.coalesce("text", F.lit("")))
    entry = F.when(text != "", F.struct(order.alias("o"), F.col("seq"), text.alias("t")))
    exploded = enabled.withColumn("view", F.explode(views)).withColumn("entry", entry)
    # a text's first place before the texts meet: a group holds each text once
    first = exploded.groupBy("view", "item_id", "entry.t").agg(F.min("entry").alias("entry"))
    grouped = first.groupBy("view", "item_id").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    return grouped.select("view", "item_id", F.transform("entries", lambda e: e["t"]).alias("texts"))


def most_specific(rules: DataFrame) -> DataFrame:
    """(route, assistant, day) open or not: only the rules at the least distance count, any of them opens.

    ``rules``: (route, assistant, distance, mask). A missing distance is the farthest.
    """
    distance = F.coalesce("distance", F.lit(LATER))
    # two aggregations over the same keys share one exchange; no window has to sort a hot key
    nearest = rules.groupBy("route", "assistant", distance.alias("distance")).agg(F.bit_or("mask").alias("mask"))
    best = nearest.groupBy("route", "assistant").agg(F.min(F.struct("distance", "mask")).alias("best"))
    return best.select("route", "assistant", F.col("best.distance").alias("distance"), F.col("best.mask").cast("int").alias("mask"))


def assistants_by_day(rules: DataFrame) -> DataFrame:
    """Three states for each route and view: null, not available; empty, available to anyone; ids.

    Takes rules as ``most_specific`` does, a null assistant meaning anyone. View 0 is the union of the days.
    """
    named = most_specific(rules.where("assistant is not null"))
    open_days = rules.groupBy("route").agg(F.bit_or("mask").cast("int").alias("open"))
    on = named.withColumn("view", F.explode(_days(F.col("mask"))))
    ids = on.groupBy("route", "view").agg(F.sort_array(F.collect_set("assistant")).alias("ids"))
    everywhere = on.groupBy("route").agg(F.sort_array(F.collect_set("assistant")).alias("ids")).select("route", F.lit(DAY_ALL).alias("view"), "ids")
    views = open_days.select("route", "open", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("view"))
    available = F.when(F.col("view") == DAY_ALL, F.col("open") > 0).otherwise(F.expr("(open >> (view - 1)) & 1") > 0)
    joined = views.join(ids.union(everywhere), ["route", "view"], "left")
    return joined.select("route", "view", F.when(available, F.coalesce("ids", F.array().cast("array<long>"))).alias("ids"))


def _days(mask: Column) -> Column:
    return F.filter(F.array(*(F.when(mask.bitwiseAND(1 << d) > 0, F.lit(d + 1)) for d in range(7))), lambda v: v.isNotNull())


def week_by_assistant(routes: DataFrame) -> DataFrame:
    """(route, assistant, mask) of ``days``, an array of lists by view: closed days count for nobody, empty ones for anyone (null)."""
    days = routes.select("route", F.posexplode(F.slice("days", 2, 7)).alias("day", "ids")).where("ids is not null")
    named = days.select("route", "day", F.explode_outer("ids").alias("assistant"))
    return named.groupBy("route", "assistant").agg(F.expr("cast(bit_or(cast(pow(2, day) as int)) as int)").alias("mask"))


def expand_routes(routes: DataFrame, special: DataFrame) -> DataFrame:
    """Routes (route, assistants) as a default without the special assistants, and one route for each special group.

    ``special``: (route, group, assistants).
    """
    taken = special.groupBy("route").agg(F.array_distinct(F.flatten(F.collect_list("assistants"))).alias("taken"))
    default = routes.join(taken, "route", "left").select("route", F.lit("default").alias("kind"), F.array_sort(F.array_except("assistants", F.coalesce("taken", F.array().cast("array<long>")))).alias("assistants"))
    own = special.select("route", F.concat(F.lit("assistant-specific:"), F.col("group")).alias("kind"), F.array_sort("assistants").alias("assistants"))
    return default.union(own)


def recipe_routes(stages: DataFrame, alternatives: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(routes, stages of the routes, issues): a default route, and one for each group of assistants that has recipes of its own.

    ``stages``: (route, stage, cost); ``alternatives``: (route, stage, condition, assistants, cost), the recipe that a
    stage has for exactly these assistants; ``rules``: (route, assistant, mask), a null assistant standing for anyone.
    A group's route has the default's stages but where it has its own; it is left out if none of its assistants has an
    open day, and the default, which no assistant of a group takes, if no rule is left to it. An assistant in
    two groups of a route is an issue.
    """
    groups = alternatives.where(F.size("assistants") > 0).select("route", "stage", "condition", F.array_distinct("assistants").alias("group"), "cost")
    members = groups.select("route", "group", F.explode("group").alias("assistant")).distinct()
    issues = members.groupBy("route", "assistant").agg(F.count("*").alias("groups")).where("groups > 1").select("route", "assistant", F.lit("overlapping-groups").alias("issue"))
    special = members.groupBy("route").agg(F.sort_array(F.collect_set("assistant")).alias("excluded"))
    left = rules.join(members.select("route", "assistant").distinct(), ["route", "assistant"], "left_anti").groupBy("route").agg(F.count("*").alias("_rules"))
    whole = F.array().cast("array<long>")
    default = stages.select("route").distinct().join(special, "route", "left").join(left, "route", "left")
    default = default.where("excluded is null or _rules > 0").select("route", F.lit("default").alias("kind"), whole.alias("group"), F.coalesce("excluded", whole).alias("excluded"), F.lit("").alias("condition"))
    # a rule for anyone opens its days to the assistants of groups too
    mask = rules.groupBy("route", "assistant").agg(F.bit_or("mask").alias("mask"))
    anyone = mask.where("assistant is null").select("route", F.col("mask").alias("_any"))
    opened = members.join(mask.where("assistant is not null"), ["route", "assistant"], "left").join(anyone, "route", "left")
    opened = opened.groupBy("route", "group").agg(F.max(F.coalesce("mask", "_any", F.lit(0))).alias("open")).where("open > 0").select("route", "group")
    text = groups.groupBy("route", "group").agg(F.min_by("condition", "stage").alias("condition"))
    own = opened.join(text, ["route", "group"]).select("route", F.lit("assistant-specific").alias("kind"), "group", whole.alias("excluded"), "condition")
    routes = default.union(own)
    replaced = groups.groupBy("route", "group", "stage").agg(F.max("cost").alias("_cost"))
    planned = routes.select("route", "kind", "group").join(stages, "route").join(replaced, ["route", "group", "stage"], "left")
    return routes, planned.select("route", "kind", "group", "stage", F.coalesce("_cost", "cost").alias("cost")), issues


# The nested form of improvement records, as far as these operators look at it.
RECORD = (
    "id long, name string, effectSource struct<status:string>, levelExpectations array<struct<level:int,label:string,effects:array<struct<name:string,valueText:string,value:double,sourceRow:int,conditional:boolean>>>>, "
    "improvementList array<struct<routeId:string,routeType:string,routeSourceText:string,"
    "stageList:array<struct<targetWeapon:struct<id:long,name:string>,consumables:array<struct<type:int,id:long>>>>,"
    "stepList:array<struct<fromLevel:int,fromLabel:string,action:string,available:boolean,effectExpectationLevel:int,industryResource:array<int>,sourceStageText:string,consumables:array<struct<type:int,id:long>>,"
    "expectedResult:struct<kind:string,level:int,label:string,targetWeapon:struct<id:long,name:string>>>>>>"
)


def required_ids(records: DataFrame) -> DataFrame:
    """(kind, id), distinct: items that records (``RECORD``) have, aim at or use up (type 0), and use-items that they use up (type 1)."""
    stages = records.select("id", F.explode("improvementList").alias("r")).select(F.explode("r.stageList").alias("s"))
    used = stages.select(F.explode("s.consumables").alias("c")).select(F.when(F.col("c.type") == 0, "equipment").when(F.col("c.type") == 1, "useitem").alias("kind"), F.col("c.id").alias("id"))
    own = records.select(F.lit("equipment").alias("kind"), "id").union(stages.select(F.lit("equipment"), "s.targetWeapon.id"))
    return own.union(used.where("kind is not null")).where("id > 0").distinct()


def route_summaries(records: DataFrame) -> DataFrame:
    """(id, routeId, routeType, routeSourceText) of the routes of records, each once."""
    routes = records.select("id", F.explode("improvementList").alias("r"))
    part = lambda name, otherwise: F.coalesce(F.nullif(f"r.{name}", F.lit("")), F.lit(otherwise)).alias(name)
    return routes.select("id", part("routeId", ""), part("routeType", "default"), part("routeSourceText", "")).distinct()


def candidate_links(methods: DataFrame, marker: str, generic: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Links (text, page, href) of methods (key, pos, links), each once in order, and the names (name, evidence) that they offer.

    A link's text and its page are names, unless they are empty or generic.
    """
    from tessera.functions.text import page_name

    each = methods.select("key", "pos", F.posexplode("links").alias("at", "link"))
    each = each.select("key", F.struct("pos", "at").alias("place"), F.trim("link.text").alias("text"), F.trim("link.href").alias("href")).withColumn("page", page_name(F.col("href"), marker))
    links = each.groupBy("key", "text", "page", "href").agg(F.min("place").alias("place"))
    names = each.select("key", "place", F.explode(F.array(F.struct(F.col("text").alias("name"), F.lit("link-text").alias("evidence")), F.struct(F.col("page").alias("name"), F.lit("link-page").alias("evidence")))).alias("n")).select("key", "place", "n.*")
    names = names.where((F.col("name") != "") & ~F.col("name").isin(*generic) if generic else F.col("name") != "")
    return links, names.groupBy("key", "name", "evidence").agg(F.min("place").alias("place"))


def group_slots(slots: DataFrame) -> DataFrame:
    """Slots (item_id, owner, method, slot, size) grouped twice: by item, a sorted array of its owners with their slots."""
    entries = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("size", F.lit(0)).alias("size"))))
    inner = slots.groupBy("item_id", "owner", "method").agg(F.count("*").alias("quantity"), entries.alias("e"))
    inner = inner.select("item_id", F.struct("owner", "method", F.transform("e", lambda x: x["slot"]).alias("slots"), F.transform("e", lambda x: x["size"]).alias("sizes"), "quantity").alias("source"))
    return inner.groupBy("item_id").agg(F.array_sort(F.collect_list("source")).alias("sources"))


def fan_out(rules: DataFrame) -> DataFrame:
    """Rules (pos, ids, types, rule) collected for each id, and for each sorted set of types, in the order of ``pos``."""
    by_id = rules.select("pos", F.explode(F.array_distinct("ids")).alias("id"), "rule").select("pos", F.concat(F.lit("id:"), "id").alias("target"), "rule")
    by_type = rules.where(F.size("types") > 0).select("pos", F.concat(F.lit("types:"), F.array_join(F.array_sort(F.array_distinct("types")), ",")).alias("target"), "rule")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "rule")))
    return by_id.union(by_type).groupBy("target").agg(F.transform(ordered, lambda x: x["rule"]).alias("rules"))


def reverse_index(relations: DataFrame, source: str, target: str) -> DataFrame:
    """For each target its distinct sources, sorted, and how many relations it has."""
    return relations.groupBy(target).agg(F.sort_array(F.collect_set(source)).alias("sources"), F.count("*").alias("relations"))


def merge_routes(routes: DataFrame, signature: list[str]) -> DataFrame:
    """Routes of one signature as one: rules in order, ids each once, the first text that is not empty; none without an open day."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda x: x[c])
    texts = F.filter(ordered("text"), lambda t: t.isNotNull() & (t != ""))
    grouped = routes.groupBy(*signature).agg(ordered("rule").alias("rules"), F.array_distinct(F.flatten(ordered("ids"))).alias("ids"), F.get(texts, F.lit(0)).alias("text"), F.bit_or("mask").cast("int").alias("mask"))
    return grouped.where("mask > 0")


def day_index(facts: DataFrame, *, expected: int = 3) -> DataFrame:
    """How many distinct items an assistant has on each day, and whether these are fewer or more than expected.

    ``facts``: (day, assistant, item).
    """
    counted = facts.groupBy("day", "assistant").agg(F.count_distinct("item").alias("items"))
    return counted.withColumn("state", F.when(F.col("items") < expected, "under").when(F.col("items") > expected, "over").otherwise("expected"))


def day_items(facts: DataFrame, names: DataFrame, *, expected: int = 3) -> DataFrame:
    """(day, assistant, name, items, count, delta): what each assistant has on each day, regrouped: items in order, each with its routes.

    ``facts``: (day, assistant, item, item_name, route, route_type, text, pos); day 0, the view of all days, is left out. A route of an item, by its
    id, type and text, is evidence once, at its first place. ``names``: (assistant, name).
    """
    real = facts.where("day > 0 and assistant is not null")
    each = real.groupBy("day", "assistant", "item", "route", "route_type", "text").agg(F.min("pos").alias("pos"), F.min_by("item_name", "pos").alias("item_name"))
    evidence = F.transform(F.array_sort(F.collect_list(F.struct("pos", "route", "route_type", "text"))), lambda r: F.struct(r["route"].alias("route"), r["route_type"].alias("route_type"), r["text"].alias("text")))
    items = each.groupBy("day", "assistant", "item").agg(F.min_by("item_name", "pos").alias("name"), evidence.alias("routes"))
    grouped = items.groupBy("day", "assistant").agg(F.array_sort(F.collect_list(F.struct("item", "name", "routes"))).alias("items"))
    counted = grouped.join(names, "assistant", "left").withColumn("count", F.size("items").cast("long"))
    return counted.select("day", "assistant", "name", "items", "count", (F.col("count") - expected).alias("delta"))


#: Levels of nesting that one stage of a walk goes down.
WALKED = 8
_SELF = "array(struct(path, node, true as done))"
_CHILDREN = """concat(
  transform(coalesce(map_entries(try_variant_get(node, '$', 'map<string,variant>')), array()), e -> struct(concat(path, '.', e.key) as path, coalesce(e.value, parse_json('null')) as node, false as done)),
  transform(coalesce(try_variant_get(node, '$', 'array<variant>'), array()), (v, i) -> struct(concat(path, '[', i, ']') as path, coalesce(v, parse_json('null')) as node, false as done)))"""


def walk_nodes(documents: DataFrame, column: str) -> DataFrame:
    """Every node of JSON texts, however deep: the other columns, ``path`` and the variant ``node``.

    One stage takes what is not done some levels down, each an explode of a node into itself and its children; only what is left below is
    written and gone on with, so documents of usual depth are read once more to see that nothing is. Texts that are no JSON have no nodes.
    """
    others = [c for c in documents.columns if c != column]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(None).cast("string")
    ahead = documents.select(rest.alias("_rest"), F.lit("$").alias("path"), F.try_parse_json(F.col(column)).alias("node"), F.lit(False).alias("done")).where("node is not null")
    found = None
    while True:
        for _ in range(WALKED):
            ahead = ahead.selectExpr("_rest", f"explode(if(done, {_SELF}, concat({_SELF}, {_CHILDREN}))) as n").selectExpr("_rest", "n.path", "n.node", "n.done")
        found = ahead.where("done") if found is None else found.unionAll(ahead.where("done"))
        ahead = cut_lineage(ahead.where("not done"))
        if not ahead.limit(1).count():
            return found.select(*(F.col(f"_rest.`{c}`").alias(c) for c in others), "path", "node")


def walk(documents: DataFrame, column: str) -> DataFrame:
    """Every node of JSON texts, however deep: (path, kind, value)."""
    nodes = walk_nodes(documents, column)
    return nodes.select(*(c for c in nodes.columns if c != "node"), F.schema_of_variant("node").alias("kind"), F.to_json("node").alias("value"))


def rename_keys(column: Column, names: dict[str, str]) -> tuple[Column, Column]:
    """A map with known keys renamed, and another of what is left over."""
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    known = F.transform_keys(F.map_filter(column, lambda k, v: k.isin(list(names))), lambda k, v: table[k])
    return known, F.map_filter(column, lambda k, v: ~k.isin(list(names)))
