"""What published datasets have to satisfy, as named predicates over their records, and the counts that describe them.

Records come as JSON text, one each. They are read with the typed form of their dataset, in which a value of another
type is null; a rule that is not satisfied, or not known to be, is a violation (rule, key). Nothing is raised
here: ``gates.require_empty`` stops on violations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import content_digest, level_label
from tessera.operators.gates import GateError, image_kind, metrics, violations
from tessera.operators.nested import LEVELS, RECORD, required_ids

DROP = "equipmentId long, equipmentName string, sources array<struct<shipId:long,shipName:string,method:string,quantity:long>>"
SOURCES = "equipmentId long, equipmentName string, source struct<shipIds:array<long>,upgradeFromItemIds:array<long>,questKey:array<long>,developmentAvailable:boolean>"
BONUS = "target struct<kind:string,equipmentIds:array<long>,equipmentTypeIds:array<long>>, equipmentId long, equipmentName string, equipmentTypeIds array<long>, rules array<struct<bonus:map<string,string>,sourceBonusFields:map<string,string>,conditions:map<string,string>>>"
LIST = "metadata struct<schemaVersion:int,rowSchema:array<string>,contentDigestSchemaVersion:int,contentDigest:string,itemCount:long>, data array<array<array<string>>>"
METHODS = ("initial", "remodel")
LIST_KEYS = ("shipIds", "upgradeFromItemIds", "questKey")


def _typed(records: DataFrame, schema: str) -> DataFrame:
    """(pos, json, and the fields): the records in the dataset's typed form."""
    parsed = records.select("pos", "json", F.from_json("json", schema).alias("_r"))
    return parsed.select("pos", "json", "_r.*")


def _filled(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isNotNull() & (F.trim(column) != "")


def _positive(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.isNotNull() & (column > 0)


def _every(column: str | Column, test) -> Column:
    """Whether a list is there and all of it satisfies a test."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNotNull() & F.forall(column, lambda x: F.coalesce(test(x), F.lit(False)))


def _repeated(rows: DataFrame, key: str, rule: str) -> DataFrame:
    """A violation for each key that several records have."""
    counted = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("_n"))
    return counted.where("_n > 1").select(F.lit(rule).alias("rule"), "key")


def list_violations(documents: DataFrame, *, schema: int = 2, digest_schema: int = 1) -> DataFrame:
    """Rules of list documents (pos, json): eight views of rows of an item and its texts, each item once a view, count and digest as declared."""
    rows = _typed(documents, LIST)
    each = rows.select("pos", F.posexplode("data").alias("view", "rows")).select("pos", "view", F.explode("rows").alias("row"))
    item = F.get("row", F.lit(0)).try_cast("long")
    texts = F.from_json(F.get("row", F.lit(1)), "array<string>")
    raw = F.get_json_object("json", "$.metadata.contentDigest")
    whole = violations(
        rows,
        F.col("pos"),
        {
            "list.views": F.size("data") == 8,
            "list.schema": F.col("metadata.schemaVersion") == schema,
            "list.row-schema": F.col("metadata.rowSchema") == F.array(F.lit("itemId"), F.lit("assistantTexts")),
            "list.digest-schema": F.col("metadata.contentDigestSchemaVersion") == digest_schema,
            "list.digest": raw == F.concat(F.lit("sha256:"), content_digest(F.col("json"))),
            "list.item-count": F.col("metadata.itemCount") == F.size(F.get("data", F.lit(0))),
        },
    )
    key = F.concat_ws("/", "pos", "view", F.get("row", F.lit(0)))
    inner = violations(each, key, {"list.row": (F.size("row") == 2) & _positive(item) & texts.isNotNull()})
    again = each.groupBy("pos", "view", item.alias("item")).agg(F.count("*").alias("_n")).where("item is not null and _n > 1")
    return whole.union(inner).union(again.select(F.lit("list.unique-items").alias("rule"), F.concat_ws("/", "pos", "view", "item").alias("key")))


def _step_rules(step: Column) -> dict[str, Column]:
    """Rules of a step; those of improving hold where it is one, those of the last where it is the last."""
    level, result = step["fromLevel"], step["expectedResult"]
    last, up = level == LEVELS, level + 1
    improving = {
        "step.recipe": (step["action"] == "improve") & step["available"],
        "step.result": (result["kind"] == "level") & (result["level"] == up) & (result["label"] == level_label(up)),
        "step.effect-reference": step["effectExpectationLevel"] == up,
        "step.resources": F.size(step["industryResource"]) == 4,
        "step.source": step["consumables"].isNotNull() & _filled(step["sourceStageText"]),
    }
    target = result["targetWeapon"]
    ending = {
        "step.last": step["action"] == "upgrade",
        "step.target": ~step["available"] | ((result["kind"] == "weapon") & _positive(target["id"]) & _filled(target["name"])),
        "step.no-result": step["available"] | result.isNull(),
    }
    rules = {"step.label": step["fromLabel"] == level_label(level), "step.availability": step["available"].isNotNull()}
    rules |= {name: last | F.coalesce(p, F.lit(False)) for name, p in improving.items()}
    return rules | {name: ~last | F.coalesce(p, F.lit(False)) for name, p in ending.items()}


def detail_violations(records: DataFrame) -> DataFrame:
    """Rules of improvement records (pos, json), of their expectations, effects, routes, steps, stages and consumables."""
    rows = _typed(records, RECORD)
    effects = F.flatten(F.transform("levelExpectations", lambda e: F.coalesce(e["effects"], F.array().cast("array<struct<name:string,valueText:string,value:double,sourceRow:int,conditional:boolean>>"))))
    number = F.sequence(F.lit(0), F.lit(LEVELS))
    ok, none = F.col("effectSource.status") == "ok", F.col("effectSource.status") == "unavailable"
    sound_effect = lambda x: _filled(x["name"]) & _filled(x["valueText"]) & (x["sourceRow"] >= 0) & (x["value"].isNull() | ~F.isnan(x["value"]) & (F.abs(x["value"]) < float("inf")))
    whole = violations(
        rows,
        F.coalesce(F.col("id").cast("string"), F.concat(F.lit("#"), "pos")),
        {
            "detail.id": _positive("id"),
            "detail.name": _filled("name"),
            "detail.effect-source": ok | none,
            "detail.levels": F.transform("levelExpectations", lambda e: e["level"]) == number,
            "detail.level-labels": _every(F.arrays_zip(F.col("levelExpectations"), number.alias("n")), lambda x: (x["levelExpectations"]["label"] == level_label(x["n"])) & x["levelExpectations"]["effects"].isNotNull()),
            "detail.first-level-empty": F.size(F.get("levelExpectations", F.lit(0))["effects"]) == 0,
            "detail.effects": _every(effects, sound_effect),
            "detail.unavailable-effects": ~none | (F.size(effects) == 0),
            "detail.missing-effects": ~ok | (F.size(effects) > 0),
            "detail.routes": F.size("improvementList") > 0,
        },
    )
    routes = rows.select("id", F.posexplode("improvementList").alias("route", "r"))
    key = F.concat_ws("/", "id", "route")
    of_routes = violations(
        routes,
        key,
        {"route.stages": F.size("r.stageList") > 0, "route.steps": F.transform("r.stepList", lambda s: s["fromLevel"]) == number, "route.consumables": _every(F.flatten(F.transform("r.stageList", lambda s: F.coalesce(s["consumables"], F.array().cast("array<struct<type:int,id:bigint>>")))), lambda c: (c["type"] != 1) | _positive(c["id"]))},
    )
    steps = routes.select("id", "route", F.explode("r.stepList").alias("step"))
    of_steps = violations(steps, F.concat_ws("/", "id", "route", F.col("step.fromLevel")), _step_rules(F.col("step")))
    return whole.union(of_routes).union(of_steps).union(_repeated(rows, "id", "detail.unique-id"))


def drop_violations(records: DataFrame) -> DataFrame:
    """Rules of drop records (pos, json): an item with a name and at least one source, each of a ship, a method and a quantity."""
    rows = _typed(records, DROP)
    key = F.coalesce(F.col("equipmentId").cast("string"), F.concat(F.lit("#"), "pos"))
    found = violations(
        rows,
        key,
        {
            "drop.id": _positive("equipmentId"),
            "drop.name": _filled("equipmentName"),
            "drop.sources": F.size("sources") > 0,
            "drop.ships": _every("sources", lambda s: _positive(s["shipId"]) & _filled(s["shipName"])),
            "drop.methods": _every("sources", lambda s: s["method"].isin(*METHODS)),
            "drop.quantities": _every("sources", lambda s: _positive(s["quantity"])),
        },
    )
    return found.union(_repeated(rows, "equipmentId", "drop.unique-id"))


def source_violations(records: DataFrame) -> DataFrame:
    """Rules of item-source records (pos, json): three sorted lists of distinct ids and a flag, and nothing else, in ``source``."""
    rows = _typed(records, SOURCES)
    keys = F.array_sort(F.json_object_keys(F.get_json_object("json", "$.source")))
    ordered = {f"source.{k}": _every(f"source.{k}", _positive) & (F.col(f"source.{k}") == F.array_sort(F.array_distinct(f"source.{k}"))) for k in LIST_KEYS}
    found = violations(
        rows,
        F.coalesce(F.col("equipmentId").cast("string"), F.concat(F.lit("#"), "pos")),
        {"source.id": _positive("equipmentId"), "source.name": _filled("equipmentName"), "source.contract": keys == F.array(*map(F.lit, sorted((*LIST_KEYS, "developmentAvailable")))), **ordered, "source.flag": F.col("source.developmentAvailable").isNotNull()},
    )
    return found.union(_repeated(rows, "equipmentId", "source.unique-id"))


def bonus_violations(records: DataFrame) -> DataFrame:
    """Rules of bonus records (pos, json): a target of one item or of types, told twice alike, and rules of known numeric stats."""
    rows = _typed(records, BONUS)
    kind, item, types = F.col("target.kind"), F.col("equipmentId"), F.col("equipmentTypeIds")
    one, many = kind == "equipment", kind == "equipment-type"
    label = F.when(one, F.concat(F.lit("equipment:"), item)).when(many, F.concat(F.lit("types:"), F.array_join(types.cast("array<string>"), ",")))
    rows = rows.withColumn("_target", F.coalesce(label, F.concat(F.lit("#"), "pos")))
    found = violations(
        rows,
        F.col("_target"),
        {
            "bonus.kind": one | many,
            "bonus.item": ~one | _positive(item) & (F.col("target.equipmentIds") == F.array(item)) & _filled("equipmentName"),
            "bonus.types": ~many | (F.size(types) > 0) & _every(types, _positive) & (F.col("target.equipmentTypeIds") == types),
            "bonus.rules": F.size("rules") > 0,
            "bonus.stats": _every("rules", lambda r: F.size(r["bonus"]) > 0),
            "bonus.unknown-stats": _every("rules", lambda r: F.coalesce(F.size(r["sourceBonusFields"]), F.lit(0)) <= 0),
            "bonus.numbers": _every("rules", lambda r: _every(F.map_values(r["bonus"]), lambda v: v.try_cast("double").isNotNull())),
            "bonus.conditions": _every("rules", lambda r: r["conditions"].isNotNull()),
        },
    )
    return found.union(_repeated(rows.where(~F.col("_target").startswith("#")), "_target", "bonus.unique-target"))


def asset_violations(files: DataFrame, *, kind: str, size: tuple[int, int] | None = None) -> DataFrame:
    """Rules of picture files (path, content): a numeric name with the kind's ending, the kind's own first bytes, and its pixels.

    Pixels are read from the headers of PNG and of the extended and lossy forms of WebP.
    """
    content = F.col("content")
    name = F.element_at(F.split("path", "/"), -1)
    rules = {"asset.name": name.rlike(rf"^[1-9]\d*\.{kind}$"), "asset.kind": image_kind(content) == kind}
    if size:
        number = lambda at, n, big: F.conv(F.hex(F.substring(content, at, n)) if big else _little(content, at, n), 16, 10).cast("long")
        if kind == "png":
            width, height = number(17, 4, True), number(21, 4, True)
        else:
            form = F.decode(F.substring(content, 13, 4), "US-ASCII")
            width = F.when(form == "VP8X", number(25, 3, False) + 1).when(form == "VP8 ", number(27, 2, False) % 16384)
            height = F.when(form == "VP8X", number(28, 3, False) + 1).when(form == "VP8 ", number(29, 2, False) % 16384)
        rules["asset.size"] = (width == size[0]) & (height == size[1])
    return violations(files, F.col("path"), rules)


def _little(content: Column, at: int, n: int) -> Column:
    """Hexadecimal digits of a number whose lowest byte is first."""
    return F.concat(*(F.hex(F.substring(content, at + k, 1)) for k in range(n - 1, -1, -1)))


def record_counts(records: DataFrame) -> dict[str, Column]:
    """Measures over improvement records (``RECORD``): records by effects, routes, steps, upgrades that can be had."""
    steps = lambda r: F.coalesce(r["stepList"], F.array().cast(records.selectExpr("improvementList[0].stepList as s").schema["s"].dataType))
    routes = F.coalesce(F.size("improvementList"), F.lit(0))
    flat = F.flatten(F.transform("improvementList", steps))
    return {
        "detailRecordCount": F.count("*"),
        "effectExpectationAvailableCount": F.count_if(F.col("effectSource.status") == "ok"),
        "effectExpectationUnavailableCount": F.count_if(F.col("effectSource.status") == "unavailable"),
        "routeCount": F.sum(F.greatest(routes, F.lit(0))),
        "stepCount": F.sum(F.greatest(F.size(flat), F.lit(0))),
        "upgradeAvailableCount": F.sum(F.size(F.filter(flat, lambda s: (s["action"] == "upgrade") & s["available"]))),
    }


def package_counts(*, views: DataFrame, details: DataFrame, compat: DataFrame, drops: DataFrame, sources: DataFrame, bonuses: DataFrame, files: DataFrame) -> DataFrame:
    """(metric, value) of a package: counts of its datasets, its pictures and their bytes.

    ``views``: (view, item); datasets as JSON records (pos, json); ``files``: (path, bytes).
    """
    typed, old = _typed(details, RECORD), _typed(compat, RECORD)
    icon, card = F.col("path").startswith("assets/useitem/"), F.col("path").startswith("assets/equip/")
    png = F.col("path").startswith("compat/") & F.col("path").endswith(".png")
    number = F.regexp_extract("path", r"([0-9]+)\.[a-z]+$", 1).try_cast("long")
    needed = required_ids(typed).where("kind = 'useitem'").select("id")
    had = files.where(icon).select(number.alias("id")).distinct()
    wanted = needed.join(had.withColumn("_had", F.lit(True)), "id", "left")
    size = lambda c: F.sum(F.greatest(F.size(c), F.lit(0)))
    measures = {
        "improvement.listViewCount": ("views", F.count_distinct("view")),
        "improvement.listAllCount": ("views", F.count_if(F.col("view") == 0)),
        **{f"improvement.{k}": ("details", v) for k, v in record_counts(typed).items()},
        "compat.detailRecordCount": ("compat", F.count("*")),
        "compat.routeCount": ("compat", size("improvementList")),
        "equipmentDropFrom.recordCount": ("drops", F.count("*")),
        "equipmentDropFrom.relationCount": ("drops", F.sum(F.aggregate("sources", F.lit(0).cast("long"), lambda a, s: a + s["quantity"]))),
        "equipmentSources.recordCount": ("sources", F.count("*")),
        "equipmentSources.shipRelationCount": ("sources", size("source.shipIds")),
        "equipmentSources.upgradeRelationCount": ("sources", size("source.upgradeFromItemIds")),
        "equipmentSources.questRelationCount": ("sources", size("source.questKey")),
        "equipmentSpecialBonuses.recordCount": ("bonuses", F.count("*")),
        "equipmentSpecialBonuses.equipmentRecordCount": ("bonuses", F.count_if(F.col("target.kind") == "equipment")),
        "equipmentSpecialBonuses.equipmentTypeRecordCount": ("bonuses", F.count_if(F.col("target.kind") == "equipment-type")),
        "equipmentSpecialBonuses.ruleCount": ("bonuses", size("rules")),
        "useitemIcons.requiredCount": ("wanted", F.count("*")),
        "useitemIcons.missingCount": ("wanted", F.count_if(F.col("_had").isNull())),
        "useitemIcons.count": ("files", F.count_if(icon)),
        "useitemIcons.totalBytes": ("files", F.coalesce(F.sum(F.when(icon, F.col("bytes"))), F.lit(0))),
        "compat.useitemPngCount": ("files", F.count_if(png)),
        "equipmentImages.count": ("files", F.count_if(card)),
        "equipmentImages.totalBytes": ("files", F.coalesce(F.sum(F.when(card, F.col("bytes"))), F.lit(0))),
        "publicData.totalBytes": ("files", F.coalesce(F.sum("bytes"), F.lit(0))),
    }
    tables = {"views": views, "details": typed, "compat": old, "drops": _typed(drops, DROP), "sources": _typed(sources, SOURCES), "bonuses": _typed(bonuses, BONUS), "files": files, "wanted": wanted}
    return metrics(tables, measures)


def projected(records: DataFrame, schema: str) -> DataFrame:
    """(pos, json) of records as a narrower dataset has them: only the fields of its schema, nulls left out; a wrong type stops.

    A field that is there with another type reads as null; that is told from its absence by the record's own text.
    """
    parsed = records.select("pos", "json", F.from_json("json", schema).alias("_r"))
    fields = [f.name for f in parsed.schema["_r"].dataType.fields]
    lost = [F.col(f"_r.{f}").isNull() & F.coalesce(F.get_json_object("json", f"$.{f}").isNotNull(), F.lit(False)) for f in fields]
    wrong = F.array_compact(F.array(*(F.when(bad, F.lit(f)) for f, bad in zip(fields, lost))))
    checked = F.when(F.size(wrong) > 0, F.raise_error(F.concat(F.lit("wrong type of "), F.array_join(wrong, ", "))).cast("string")).otherwise(F.to_json("_r"))
    return parsed.select("pos", checked.alias("json"))


def require_sound(found: DataFrame, *, shown: int = 50) -> None:
    """Stop with the first violations by rule and key."""
    rows = [r.asDict() for r in found.orderBy("rule", "key").limit(shown).collect()]
    if rows:
        raise GateError("datasets break their rules", "mend these records", rows)
