"""Entity resolution: names to catalog ids, in order of preference, and graphs of successors.

Catalogs are small tables beside the facts, but not of a proven size: joins with them are left to the planner,
which broadcasts what is below its threshold.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.contain import cut_lineage

LATER = 1_000_000_000


def last_of_name(catalog: DataFrame, name: str = "name") -> DataFrame:
    """Of rows of one name the last, by ``pos``."""
    others = [c for c in catalog.columns if c != name]
    return catalog.groupBy(name).agg(F.max_by(F.struct(*others), "pos").alias("_r")).select(name, "_r.*")


def unique_name(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, id, state): resolved if exactly one row of the catalog has the name, else missing or ambiguous."""
    counted = catalog.groupBy("name").agg(F.count("*").alias("_n"), F.min("id").alias("_id"))
    joined = wanted.join(counted, "name", "left")
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").otherwise("resolved")
    return joined.withColumn("state", state).withColumn("id", F.when(F.col("state") == "resolved", F.col("_id"))).drop("_n", "_id")


def checked_flag(flags: DataFrame) -> Column:
    """State of a resolved flag that has to be a boolean, given as JSON text."""
    return F.when(F.col("state") != "resolved", F.col("state")).when(F.col("flag").isin("true", "false"), "ok").otherwise("invalid")


def id_and_name(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """(id, name) checked against the catalog: ok, missing-id, unknown-id or name-mismatch. Of several rows of an id each may have the name."""
    known = catalog.select("id", F.lit(True).alias("_known")).distinct()
    named = catalog.select("id", "name", F.lit(True).alias("_named")).distinct()
    joined = wanted.join(known, "id", "left").join(named, ["id", "name"], "left")
    state = F.when(F.col("id").isNull(), "missing-id").when(F.col("_known").isNull(), "unknown-id").when(F.col("name").isNotNull() & F.col("_named").isNull(), "name-mismatch").otherwise("ok")
    return joined.select(*wanted.columns, state.alias("state"))


def first_match(wanted: DataFrame, *catalogs: tuple[str, DataFrame]) -> DataFrame:
    """(name, id, kind) by the first of several catalogs (name, id) that has the name."""
    out = wanted
    for kind, catalog in catalogs:
        found = catalog.groupBy("name").agg(F.min("id").alias(f"_{kind}"))
        out = out.join(found, "name", "left")
    ids = [F.col(f"_{kind}") for kind, _ in catalogs]
    kinds = [F.when(i.isNotNull(), F.lit(kind)) for i, (kind, _) in zip(ids, catalogs)]
    return out.withColumn("id", F.coalesce(*ids)).withColumn("kind", F.coalesce(*kinds)).drop(*(f"_{kind}" for kind, _ in catalogs))


def match_ladder(wanted: DataFrame, catalog: DataFrame, aliases: DataFrame, exclusions: DataFrame, normalize: Callable[[Column], Column]) -> DataFrame:
    """(name, id, state, step): exact name, then normalized, then alias; excluded names resolve to nothing.

    ``aliases``: (alias, name), ``exclusions``: (name). Several ids at the first step that has any are ambiguous.
    """
    ids = lambda df, key: df.groupBy(key).agg(F.collect_set("id").alias("ids"))
    exact = ids(catalog, "name").select(F.col("name").alias("_n1"), F.col("ids").alias("_exact"))
    norm = ids(catalog.withColumn("_n2", normalize(F.col("name"))), "_n2").select("_n2", F.col("ids").alias("_norm"))
    alias = ids(aliases.join(catalog, "name"), "alias").select(F.col("alias").alias("_n3"), F.col("ids").alias("_alias"))
    out = exclusions.select(F.col("name").alias("_n4")).distinct()
    joined = wanted.withColumn("_key", normalize(F.col("name")))
    joined = joined.join(exact, F.col("name") == F.col("_n1"), "left").join(norm, F.col("_key") == F.col("_n2"), "left")
    joined = joined.join(alias, F.col("name") == F.col("_n3"), "left").join(out, F.col("name") == F.col("_n4"), "left")
    found = F.coalesce("_exact", "_norm", "_alias")
    step = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_norm").isNotNull(), "normalized").when(F.col("_alias").isNotNull(), "alias")
    state = F.when(F.col("_n4").isNotNull(), "excluded").when(found.isNull(), "unresolved").when(F.size(found) > 1, "ambiguous").otherwise("resolved")
    named = joined.withColumn("state", state).withColumn("step", F.when(F.col("_n4").isNull(), step)).withColumn("id", F.when(F.col("state") == "resolved", F.get(found, F.lit(0))))
    return named.select(*wanted.columns, "id", "state", "step")


def cross_check_links(links: DataFrame, names: DataFrame) -> DataFrame:
    """Links (text, page) by what both their sides name: (.., id, state).

    Agreeing sides resolve; a page whose name strictly extends the text is more specific and wins; other
    conflicts are ambiguous; one side alone is enough. ``names``: (name, id), unique.
    """
    by_text = names.select(F.col("name").alias("_t"), F.col("id").alias("_text_id"))
    by_page = names.select(F.col("name").alias("_p"), F.col("id").alias("_page_id"))
    joined = links.join(by_text, F.col("text") == F.col("_t"), "left").join(by_page, F.col("page") == F.col("_p"), "left")
    t, p = F.col("_text_id"), F.col("_page_id")
    specific = (F.col("text") != "") & (F.col("page") != F.col("text")) & F.col("page").startswith(F.col("text"))
    conflict = t.isNotNull() & p.isNotNull() & (t != p)
    state = F.when(t.isNull() & p.isNull(), "unresolved").when(conflict & ~specific, "ambiguous").when(conflict, "page-more-specific").otherwise("resolved")
    return joined.withColumn("state", state).withColumn("id", F.when(state != "ambiguous", F.coalesce(p, t))).select(*links.columns, "id", "state")


class Jumps:
    """For each power of two the table (node, to) of where that many steps lead; nodes whose walk ends before are not in it.

    Of several successors of a node the least is taken. Tables are made when they are asked for, each from the one before by one join,
    and written to the shared folder; every row is a pair of nodes, however long a walk is.
    """

    def __init__(self, edges: DataFrame):
        step = edges.groupBy("node").agg(F.min("next").alias("to")).where("to is not null")
        self.tables = [cut_lineage(step)]

    def __getitem__(self, k: int) -> DataFrame:
        while len(self.tables) <= k:
            last = self.tables[-1]
            on = last.select(F.col("node").alias("to"), F.col("to").alias("_to"))
            self.tables.append(cut_lineage(last.join(on, "to").select("node", F.col("_to").alias("to"))))
        return self.tables[k]

    def on_rings(self) -> DataFrame:
        """(node): what is in a cycle. Where twice as many steps lead to as many nodes, all of these are in cycles, and no others are."""
        k, reached = 0, -1
        while True:
            image = self[k].select(F.col("to").alias("node")).distinct()
            count = image.count()
            if count == reached or not count:
                return cut_lineage(image)
            k, reached = k + 1, count


def rings(edges: DataFrame, jumps: Jumps | None = None) -> DataFrame:
    """(ring, place, node, size): the cycles of successor edges (node, next, rank), each named after its least node, in the order (rank, node)."""
    from pyspark.sql import Window

    jumps = jumps or Jumps(edges)
    state, k = jumps.on_rings().withColumn("ring", F.col("node")), 0
    while True:  # the least node of so many steps, then of twice as many
        ahead = jumps[k].join(state.select(F.col("node").alias("to"), F.col("ring").alias("_ring")), "to")
        joined = state.join(ahead.select("node", "_ring"), "node")
        state = cut_lineage(joined.select("node", F.least("ring", "_ring").alias("ring"), (F.col("_ring") < F.col("ring")).alias("moved")))
        if not state.where("moved").limit(1).count():
            break
        state, k = state.drop("moved"), k + 1
    ranks = edges.groupBy("node").agg(F.coalesce(F.min("rank"), F.lit(LATER)).alias("rank")) if "rank" in edges.columns else edges.select("node", F.lit(0).alias("rank")).distinct()
    sizes = state.groupBy("ring").agg(F.count("*").alias("size"))
    place = F.row_number().over(Window.partitionBy("ring").orderBy("rank", "node")) - 1
    return state.select("node", "ring").join(ranks, "node").join(sizes, "ring").select("ring", place.alias("place"), "node", "size")


def walk_ends(edges: DataFrame, found: DataFrame) -> DataFrame:
    """(node, end, distance, ring, size): where each node's walk ends or first meets a cycle of ``found`` (ring, node, size), after how many steps.

    Walks that have not come to an end take over what the node that they have come to knows, so they double.
    """
    members = found.select(F.col("node").alias("end"), "ring", "size")
    step = edges.groupBy("node").agg(F.min("next").alias("next"))
    start = step.join(found.select("node", F.lit(True).alias("_in")), "node", "left").withColumn("_stays", F.col("_in").isNotNull() | F.col("next").isNull())
    state = cut_lineage(start.select("node", F.when(F.col("_stays"), F.col("node")).otherwise(F.col("next")).alias("end"), F.when(F.col("_stays"), 0).otherwise(1).cast("long").alias("distance"), (~F.col("_stays")).alias("open")))
    while state.where("open").limit(1).count():
        # what has been reached and goes on: a step further; all that goes nowhere is closed
        on = state.where("distance > 0").select(F.col("node").alias("end"), F.col("end").alias("_end"), F.col("distance").alias("_more"), F.col("open").alias("_open"))
        further = state.where("open").join(on, "end", "left").select("node", F.coalesce("_end", "end").alias("end"), (F.col("distance") + F.coalesce("_more", F.lit(0))).alias("distance"), F.coalesce("_open", F.lit(False)).alias("open"))
        state = cut_lineage(state.where("not open").unionAll(further))
    return state.drop("open").join(members, "end", "left")


def walks(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, node, distance) along successors from the roots (root), all nodes if not given; on the first repeat of a node a walk stops.

    Rows of a walk double with each jump, so rounds are as the logarithm of the longest and the work is in proportion to the result.
    """
    jumps = Jumps(edges)
    ends = walk_ends(edges, rings(edges, jumps))
    wanted = ends if roots is None else ends.join(roots.select(F.col("root").alias("node")).distinct(), "node", "left_semi")
    length = F.col("distance") + F.coalesce("size", F.lit(1))
    state = cut_lineage(wanted.select(F.col("node").alias("root"), "node", F.lit(0).cast("long").alias("distance"), length.alias("length")))
    longest, k = state.agg(F.max("length")).first()[0] or 0, 0
    while 1 << k < longest:
        ahead = state.where(F.col("distance") + (1 << k) < F.col("length")).join(jumps[k], "node")
        state = state.unionAll(cut_lineage(ahead.select("root", F.col("to").alias("node"), (F.col("distance") + (1 << k)).alias("distance"), "length")))
        k += 1
    return state.drop("length")


def forward_closure(edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, distance, node) along successors (node, next, ...); each node once, at its least distance; cycles end."""
    return walks(edges, roots).select("root", F.col("distance").cast("int").alias("distance"), "node")


def ordered_closure(edges: DataFrame) -> DataFrame:
    """(root, node, distance): successors up to the first node of a cycle, then the cycle's members from that node on in the cycle's order."""
    jumps = Jumps(edges)
    found = cut_lineage(rings(edges, jumps))
    ends = cut_lineage(walk_ends(edges, found))
    met = ends.where("ring is not null").select(F.col("node").alias("root"), "ring", "end", F.col("distance").alias("entry"))
    before = walks(edges).join(met.select("root", "entry"), "root", "left").where("entry is null or distance < entry").select("root", "node", F.col("distance").cast("int").alias("distance"))
    first = met.join(found.select(F.col("node").alias("end"), F.col("place").alias("_first")), "end").select("root", "ring", "entry", "_first")
    after = first.join(found.select("ring", "place", "node"), "ring").where("place >= _first")
    return before.unionAll(after.select("root", "node", (F.col("entry") + F.col("place") - F.col("_first")).cast("int").alias("distance")))


def family_chain(edges: DataFrame) -> DataFrame:
    """(root, node, place): a linear family, predecessors before the root at negative places, successors after it.

    Of several predecessors the smallest is taken; a cycle is gone through once.
    """
    after = forward_closure(edges)
    back = edges.where("next is not null").groupBy(F.col("next").alias("node")).agg(F.min("node").alias("next"))
    nodes = edges.select("node").distinct()
    back = nodes.join(back, "node", "left").select("node", "next", F.lit(0).alias("rank"))
    before = forward_closure(back).where("distance > 0")
    ahead = after.join(before.select("root", "node"), ["root", "node"], "left_anti")
    return before.select("root", "node", (-F.col("distance")).alias("place")).union(ahead.select("root", "node", F.col("distance").alias("place")))


def families(edges: DataFrame) -> DataFrame:
    """(node, family): the smallest node that undirected edges (node, next) connect with it."""
    both = edges.where("next is not null").select("node", "next").union(edges.where("next is not null").select(F.col("next").alias("node"), F.col("node").alias("next")))
    state = edges.select("node").union(both.select("node")).distinct().withColumn("family", F.col("node"))
    while True:
        seen = both.join(state.select(F.col("node").alias("next"), F.col("family").alias("_f")), "next").groupBy("node").agg(F.min("_f").alias("_f"))
        near = state.join(seen, "node", "left").select("node", F.least("family", "_f").alias("_near"), (F.col("_f") < F.col("family")).alias("_moved"))
        near = cut_lineage(near)
        # a node takes over what the node that it is named after has come to, so labels run ahead of the edges
        ahead = near.select(F.col("node").alias("_near"), F.col("_near").alias("_far"))
        state = cut_lineage(near.join(ahead, "_near").select("node", F.col("_far").alias("family")))
        if not near.where("_moved").limit(1).count():
            break
    return state


def choose(candidates: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The best candidate of each key; ties at the top are no choice (null id)."""
    from pyspark.sql import Window

    window = Window.partitionBy(*key).orderBy(*order)
    ranked = candidates.withColumn("_rank", F.rank().over(window)).where("_rank = 1")
    return ranked.groupBy(*key).agg(F.when(F.count("*") == 1, F.min("id")).alias("id"), F.count("*").alias("candidates"))


def choose_exact(wanted: DataFrame, catalog: DataFrame, normalize: Callable[[Column], Column]) -> DataFrame:
    """(.., id) of wanted (name, image, fallback) by normalized name: the only match, else the image's, the fallback, the least (rank, id).

    ``catalog``: (name, id, rank).
    """
    known = catalog.select(normalize(F.col("name")).alias("_form"), "id", F.coalesce("rank", F.lit(LATER)).alias("rank"))
    # a row for a name however many have it; whether an id is among them is asked of rows, not of a list beside each that asks
    least = known.groupBy("_form").agg(F.count("*").alias("_n"), F.min(F.struct("rank", "id"))["id"].alias("_least"))
    joined = wanted.withColumn("_form", normalize(F.col("name"))).join(least, "_form", "left")
    for c in ("image", "fallback"):
        has = known.select("_form", F.col("id").alias(c), F.col("id").alias(f"_{c}")).distinct()
        joined = joined.join(has, ["_form", c], "left")
    only = F.when(F.col("_n") == 1, F.col("_least"))
    return joined.select(*wanted.columns, F.coalesce(only, "_image", "_fallback", "_least").alias("id"))


def resolve_fragments(wanted: DataFrame, catalog: DataFrame, family: DataFrame, normalize: Callable[[Column], Column]) -> DataFrame:
    """(fragment, anchor, id, state): a part of a name, beside an anchor of which the family (node, family) is known.

    In this order: the fragment as a whole name; the family's shortest name with it, and the anchor's, if that is
    one of the family; the best scored name of the family. No score is ``unresolved``, a tie ``ambiguous``.
    """
    names = catalog.join(family.select(F.col("node").alias("id"), "family"), "id").select("id", "family", normalize(F.col("name")).alias("form"))
    root = names.groupBy("family").agg(F.min(F.struct(F.length("form").alias("n"), "id", "form")).alias("_r")).select("family", F.col("_r.form").alias("root_form"))
    asked = wanted.select("fragment", "anchor").distinct()
    own = names.select(F.col("id").alias("anchor"), F.col("form").alias("anchor_form"), "family").join(root, "family")
    asked = asked.join(own, "anchor").withColumn("part", normalize(F.col("fragment")))
    # a whole name: the anchor itself where it has it, else the least id
    same = asked.join(names.select(F.col("form").alias("part"), F.col("id").alias("hit")), "part").groupBy("fragment", "anchor").agg(F.coalesce(F.max(F.when(F.col("hit") == F.col("anchor"), F.col("hit"))), F.min("hit")).alias("exact"))
    inside = asked.join(names.withColumnRenamed("id", "hit"), "family")
    made = [F.min(F.when(F.col("form") == F.concat(c, "part"), F.col("hit"))).alias(n) for c, n in (("root_form", "by_root"), ("anchor_form", "by_anchor"))]
    score = fragment_score(F.col("form"), F.col("part"), F.col("anchor_form"))
    scored = inside.withColumn("score", score)
    best = scored.groupBy("fragment", "anchor").agg(*made, F.max("score").alias("top"))
    ties = scored.join(best.select("fragment", "anchor", "top"), ["fragment", "anchor"]).where("score = top").groupBy("fragment", "anchor").agg(F.count_distinct("hit").alias("ties"), F.min("hit").alias("by_score"))
    out = best.join(same, ["fragment", "anchor"], "left").join(ties, ["fragment", "anchor"], "left")
    sure = F.coalesce("exact", "by_root", "by_anchor")
    state = F.when(sure.isNotNull() | (F.col("ties") == 1), "resolved").when(F.col("ties") > 1, "ambiguous").otherwise("unresolved")
    return out.select("fragment", "anchor", F.when(state == "resolved", F.coalesce(sure, "by_score")).alias("id"), state.alias("state"))


def find_entries(catalog: DataFrame, *, contains: str | None = None, slot: int | None = None, value: int | None = None, where: Column | None = None) -> DataFrame:
    """Entries of a catalog whose name contains a text, whose ``types`` have a value in a slot, or that satisfy any predicate."""
    if contains is not None:
        catalog = catalog.where(F.col("name").contains(contains))
    if slot is not None:
        catalog = catalog.where(F.get("types", F.lit(slot)) == value)
    return catalog if where is None else catalog.where(where)


def fragment_score(name: Column, fragment: Column, anchor: Column) -> Column:
    """80 for a name that ends in the fragment, 60 for one that contains it, and a point for each letter shared with the anchor's beginning."""
    base = F.when(name.endswith(fragment), 80).when(name.contains(fragment), 60)
    letters = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length(name), F.length(anchor))))
    common = F.size(F.filter(letters, lambda n: F.substring(name, F.lit(1), n) == F.substring(anchor, F.lit(1), n)))
    return base + common


# The suffixes of the selector grammar, and what separates names in it.
ONLY, NOT, ALLOWED, ONWARDS = "のみ", "不可", "可", ("～", "~")
_SEPARATORS, _INSIDE_SEPARATORS = r"[/・\n]", r"[/,，・]"
_MODIFIED = re.compile(r"(?P<names>.*)[(（](?P<inside>[^()（）]*)[)）]", re.DOTALL)


def parse_selector(text: str | None) -> list[dict]:
    """A selector's parts: names, whether only the first is meant, and the names that are excluded (``closure``: with all successors).

    A modifier in parentheses at the end speaks of all names before it; names may have parentheses of their own.
    """
    names, inside = str(text or "").strip(), ""
    found = _MODIFIED.fullmatch(names)
    if found and found["inside"].strip().endswith((ONLY, NOT, ALLOWED)):
        names, inside = found["names"], found["inside"].strip()
    elif names.endswith(ONLY):
        names, inside = names.removesuffix(ONLY), ONLY
    parts = [x for x in (p.strip() for p in re.split(_SEPARATORS, names)) if x and x != "-"]
    body = inside.removesuffix(NOT).strip() if inside.endswith(NOT) else ""
    onwards = body.endswith(ONWARDS)
    banned = [x for x in (p.strip() for p in re.split(_INSIDE_SEPARATORS, body[:-1] if onwards else body)) if x]
    row = {"mode": "only" if inside.endswith(ONLY) else "closure", "exclude": banned, "exclude_closure": onwards}
    return [{"name": p, **row} for p in (parts[:1] if row["mode"] == "only" else parts)]


def selectors(rules: DataFrame, column: str) -> DataFrame:
    """Rules with a row for each part of their selector."""
    kind = "array<struct<name:string,mode:string,exclude:array<string>,exclude_closure:boolean>>"

    @F.pandas_udf(kind)
    def parse(values: pd.Series) -> pd.Series:
        return values.map(parse_selector)

    return rules.withColumn("_part", F.explode(parse(F.col(column)))).select(*rules.columns, "_part.*")


def select_ids(parts: DataFrame, catalog: DataFrame, closure: DataFrame) -> DataFrame:
    """(rule, id, distance) of selector parts: named ids, their successors unless only they are meant, less the excluded ones."""
    ids = catalog.select(F.col("name"), F.col("id"))
    named = parts.join(ids, "name").select("rule", "mode", "id")
    spread = named.join(closure, named["id"] == closure["root"]).where("mode = 'closure' or distance = 0")
    banned = parts.select("rule", F.explode("exclude").alias("exclude"), "exclude_closure").distinct()
    banned = banned.join(ids.withColumnRenamed("name", "exclude"), "exclude").select("rule", "id", "exclude_closure")
    banned = banned.join(closure, banned["id"] == closure["root"]).where("exclude_closure or distance = 0").select("rule", "node").distinct()
    kept = spread.select("rule", F.col("node"), "distance").join(banned, ["rule", "node"], "left_anti")
    return kept.groupBy("rule", F.col("node").alias("id")).agg(F.min("distance").alias("distance"))
