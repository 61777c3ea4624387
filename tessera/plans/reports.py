"""Reports as rows: every line of a Markdown report is a row with its section and what orders it there.

Nothing of a report is gathered: lines are sorted in ranges when they are written, in as many part files as there are ranges, in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.facts import DAYS

# The days' names in the report, and its headings and the lines where a section has nothing.
DAY_NAMES = ("日", "月", "火", "水", "木", "金", "土")
TITLE = "# Improvement assistant day reverse index"
SECTIONS = (
    ("## Under expected", "No ship/day has fewer than the expected equipment count."),
    ("## Over expected", "No ship/day has more than the expected equipment count."),
    ("## All equipment count mismatches", "No named assistant ship/day deviates from the expected equipment count."),
    ("## Full reverse table", "No named assistant ship routes."),
)
_ORDER = ("section", "day", "first", "second", "place")


def _said(*parts) -> Column:
    return F.concat(*(F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts))


def _day(names: tuple[str, ...]) -> Column:
    return F.get(F.array(*map(F.lit, names)), (F.col("day") - 1).cast("int"))


def _lines(rows: DataFrame, section: int, first: Column, second: Column, lines: Column) -> DataFrame:
    """Rows of a section, of each row the ``lines`` in order."""
    return rows.select(F.lit(section).alias("section"), F.col("day").cast("int").alias("day"), first.cast("long").alias("first"), second.cast("long").alias("second"), F.posexplode(lines).alias("place", "line"))


def assistant_day_report(index: DataFrame, counts: dict[str, int | str], *, expected: int = 3) -> DataFrame:
    """(section, day, first, second, place, line) of the report on an index (day, assistant, name, items, count, delta).

    ``counts``: what is known of the run, said at its head. Under the expected count the fewest items come first, over it the most.
    """
    spark = index.sparkSession
    assistant = _said(F.col("assistant"), ":", F.col("name"))
    head = _said("- day=", _day(DAY_NAMES), "(", F.col("day"), ") ship=", assistant, " equipmentCount=", F.col("count"), f" expected={expected} delta=", F.col("delta"))
    items = F.transform("items", lambda i: F.concat(F.lit("  - "), i["item"].cast("string"), F.lit(":"), F.coalesce(i["name"], F.lit("")), _routes(i["routes"])))
    ids = F.array_join(F.transform("items", lambda i: i["item"].cast("string")), ",")
    under, over, odd = index.where("delta < 0"), index.where("delta > 0"), index.where("delta <> 0")
    body = [
        _lines(under, 1, F.col("count"), F.col("assistant"), F.concat(F.array(head), items)),
        _lines(over, 2, -F.col("count"), F.col("assistant"), F.concat(F.array(head), items)),
        _lines(odd, 3, F.col("assistant"), F.col("count"), F.array(head)),
        _lines(index, 4, F.col("assistant"), F.lit(0), F.array(_said("- ship=", assistant, " equipmentCount=", F.col("count"), " equipmentIds=", ids))),
    ]
    sums = index.agg(F.count("*").alias("n"), F.count_if(F.col("delta") != 0).alias("odd"), F.count_if(F.col("delta") < 0).alias("under"), F.count_if(F.col("delta") > 0).alias("over"), F.coalesce(F.max("count"), F.lit(0)).alias("most"))
    told = [f"{k}: {v}" for k, v in counts.items()]
    said = [_said(f"{k}: ", F.col(c)) for k, c in (("shipDayCount", "n"), ("equipmentCountMismatchShipDayCount", "odd"), ("underExpectedShipDayCount", "under"), ("overThresholdShipDayCount", "over"), ("maxEquipmentCount", "most"))]
    top = F.array(F.lit(TITLE), F.lit(""), *(F.lit(x) for x in told[:1]), F.lit(f"expectedEquipmentCount: {expected} equipments per ship per day"), *(F.lit(x) for x in told[1:]), *said)
    body.append(_lines(sums.withColumn("day", F.lit(-1)), 0, F.lit(0), F.lit(0), top))
    for k, (title, nothing) in enumerate(SECTIONS, 1):
        body.append(_lines(spark.range(1).withColumn("day", F.lit(-1)), k, F.lit(0), F.lit(0), F.array(*map(F.lit, ("", title, "")))))
        if k < len(SECTIONS):
            known = {1: under, 2: over, 3: odd}[k].limit(1).select(F.lit(1).alias("_k"))
            body.append(_lines(spark.range(1).withColumn("day", F.lit(0)).join(known, F.lit(True), "left_anti"), k, F.lit(0), F.lit(0), F.array(F.lit(nothing))))
    # all seven days have a heading; one without assistants says so
    days = spark.range(1, 8).select(F.col("id").cast("int").alias("day"))
    there = index.select(F.col("day").cast("int").alias("day")).distinct().withColumn("_there", F.lit(True))
    begin = days.join(there, "day", "left").withColumn("title", _said("### ", _day(DAY_NAMES), " (", _day(DAYS), ")"))
    least, most = F.lit(-(1 << 62)), F.lit(1 << 62)
    body.append(_lines(begin, 4, least, F.lit(0), F.when(F.col("_there"), F.array("title")).otherwise(F.array(F.col("title"), F.lit(""), F.lit(SECTIONS[3][1])))))
    body.append(_lines(begin.where("day < 7"), 4, most, F.lit(0), F.array(F.lit(""))))
    return reduce(DataFrame.unionAll, body)


def _routes(routes: Column) -> Column:
    ids = F.filter(F.transform(routes, lambda r: r["route"].cast("string")), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(ids) > 0, F.concat(F.lit(" routes="), F.array_join(ids, ","))).otherwise("")


def write_report(rows: DataFrame, path: str) -> None:
    """The lines in order, as text in part files whose names are in that order too."""
    rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select("line").write.mode("overwrite").text(path)
