import pytest

from tessera.operators.gates import GateError
from tessera.plans import package


def test_bundles(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "sub/b.txt").write_text("x")
    first = package.write_manifest(spark, folder, version="1.0.0")
    assert [f["path"] for f in first["files"]] == ["a.json", "sub/b.txt"] and first["version"] == "1.0.0"
    assert package.write_manifest(spark, folder, version="1.0.0") == first
    with pytest.raises(GateError, match="not ready"):
        package.check_lock(spark, folder)
    package.lock(spark, folder)
    package.check_lock(spark, folder)
    (tmp_path / "a.json").write_text("{ }")
    with pytest.raises(GateError, match="differ"):
        package.check_lock(spark, folder)
    package.write_manifest(spark, folder, version="1.0.1")
    with pytest.raises(GateError, match="after the lock"):
        package.check_lock(spark, folder)


def test_reuse(spark, tmp_path):
    (tmp_path / "out").write_text("x")
    there, gone = [str(tmp_path / "out")], [str(tmp_path / "none")]
    old = {"inputHashes": {"a": "1", "b": "2"}}
    assert package.reusable(spark, {"a": "1"}, old, there)
    assert not package.reusable(spark, {"a": "2"}, old, there) and not package.reusable(spark, {"a": "1"}, old, gone)
    assert not package.reusable(spark, {}, old, there) and not package.reusable(spark, {"c": ""}, None, there)


def test_versions():
    assert package.plan_version("1.2.3", None, changed=True) == "1.2.4"
    assert package.plan_version("1.2.3", "1.4.0", changed=True, part="minor") == "1.5.0"
    assert package.plan_version("1.2.3", None, changed=False) is None
    assert package.plan_version("1.2.3", None, changed=False, wanted="2.0.0") == "2.0.0"
    for bad in ("1.2", "01.2.3", "1.2.3\n"):
        with pytest.raises(ValueError, match="version"):
            package.parse_version(bad)
    with pytest.raises(ValueError, match="not above"):
        package.plan_version("1.2.3", "2.0.0", changed=True, wanted="2.0.0")


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "i int, s string").orderBy("i")
    assert package.markdown_table(df) == "| i | s |\n|---|---|\n| 1 | a\\|b |\n| 2 |  |\n"
    assert package.markdown_table(df, most=1).endswith("There are more rows.\n")
    assert package.write_stops(spark, str(tmp_path), [GateError("x"), GateError("x"), GateError("y")]) == 2
    assert package.read_document(spark, f"{tmp_path}/{package.STOP}")[0]["reason"] == "x"


def test_the_day_report_is_in_order(spark, tmp_path):
    """Sections, days and rows come in the report's order, however many files they are in; days and sections without rows say so."""
    from tessera.operators import nested
    from tessera.plans import reports

    told = [(1, 5, 30, "c", "r1", 0), (1, 5, 10, "a", "r2", 1), (1, 5, 10, "a", "r1", 2), (1, 5, 10, "a", "r2", 3), (1, 4, 10, "a", "r1", 4), (0, 9, 1, "z", "r1", 5), (7, 4, 10, "a", "", 6)] + [(7, 8, i, f"n{i}", "r", 9) for i in range(4)]
    facts = spark.createDataFrame([(d, a, i, n, r, "default", "", p) for d, a, i, n, r, p in told], "day long, assistant long, item long, item_name string, route string, route_type string, text string, pos long")
    names = spark.createDataFrame([(5, "Five"), (4, "Four")], "assistant long, name string")
    index = nested.day_items(facts, names).repartition(3)
    reports.write_report(reports.assistant_day_report(index, {"generatedAt": "T", "recordCount": 9, "routeCount": 8}), str(tmp_path / "r"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("part-*")))
    day7 = ["- day=土(7) ship=8: equipmentCount=4 expected=3 delta=1", "  - 0:n0 routes=r", "  - 1:n1 routes=r", "  - 2:n2 routes=r", "  - 3:n3 routes=r"]
    under = ["- day=日(1) ship=4:Four equipmentCount=1 expected=3 delta=-2", "  - 10:a routes=r1", "- day=日(1) ship=5:Five equipmentCount=2 expected=3 delta=-1", "  - 10:a routes=r2,r1", "  - 30:c routes=r1", "- day=土(7) ship=4:Four equipmentCount=1 expected=3 delta=-2", "  - 10:a"]
    middle = [x for n, k in zip("月火水木金", ("monday", "tuesday", "wednesday", "thursday", "friday")) for x in (f"### {n} ({k})", "", "No named assistant ship routes.", "")]
    wanted = [
        "# Improvement assistant day reverse index", "", "generatedAt: T", "expectedEquipmentCount: 3 equipments per ship per day", "recordCount: 9", "routeCount: 8", "shipDayCount: 4", "equipmentCountMismatchShipDayCount: 4",
        "underExpectedShipDayCount: 3", "overThresholdShipDayCount: 1", "maxEquipmentCount: 4", "", "## Under expected", "", *under, "", "## Over expected", "", *day7, "", "## All equipment count mismatches", "",
        under[0], under[2], under[5], day7[0], "", "## Full reverse table", "", "### 日 (sunday)", "- ship=4:Four equipmentCount=1 equipmentIds=10", "- ship=5:Five equipmentCount=2 equipmentIds=10,30", "", *middle,
        "### 土 (saturday)", "- ship=4:Four equipmentCount=1 equipmentIds=10", "- ship=8: equipmentCount=4 equipmentIds=0,1,2,3",
    ]
    assert text.splitlines() == wanted
    empty = reports.assistant_day_report(index.limit(0), {"generatedAt": "T"}).orderBy(*reports._ORDER)
    assert [r["line"] for r in empty.collect()][6:17] == ["underExpectedShipDayCount: 0", "overThresholdShipDayCount: 0", "maxEquipmentCount: 0", *(x for k, (t, n) in enumerate(reports.SECTIONS[:2]) for x in ("", t, "", n))]


def test_configuration_as_tables(spark, tmp_path):
    import json

    from tessera.operators import facts, gates
    from tessera.operators.gates import GateError
    from tessera.plans import config

    def write(name, document):
        (tmp_path / name).write_text(json.dumps(document))
        return str(tmp_path / name)

    quality = {"minimums": {"a": 3, "b": 10}, "relativeMinimumRatios": {"a": 0.8, "c": 0.7}, "fileSizeMinimumRatio": 0.7, "fileSizePaths": ["x/list.json", "y"]}
    floors, files = config.quality_floors(spark, write("q.json", quality))
    assert sorted(map(tuple, floors.collect()), key=str) == [("a", 3.0, 0.8), ("b", 10.0, None), ("c", None, 0.7)] and sorted(map(tuple, files.collect())) == [("x/list.json", 0.7), ("y", 0.7)]
    now, before = (spark.createDataFrame(x, "metric string, value double") for x in ([("a", 7.0), ("b", 10.0), ("c", 6.0)], [("a", 10.0), ("c", 10.0)]))
    assert {r["metric"]: (r["floor"], r["passed"]) for r in gates.gate(now, before, floors).collect()} == {"a": (8.0, False), "b": (10.0, True), "c": (7.0, False)}
    with pytest.raises(GateError):
        config.quality_floors(spark, write("q.json", quality | {"relativeMinimumRatios": {"a": 1.5}}))
    settings = {
        "currentSignals": {"pairwiseAgreement": 0.65, "peerConsensusAgreement": 0.35}, "historyContribution": 0.2, "minimumHistoricalEvaluableChanges": 5, "relativeWeightRange": [0.75, 1.25],
        "minimumPairwiseEvidenceForFullConfidence": 500, "minimumPeerConsensusEvidenceForFullConfidence": 200, "minimumHistoricalEvidenceForFullConfidence": 20,
    }
    assert config.reliability_settings(spark, write("r.json", settings)) == facts.Reliability()
    evidence = spark.createDataFrame([("a", 0.9, 100, 0.5, 50, 1.0, 6), ("b", 0.2, 100, 0.1, 50, None, 0)], "source string, pair_rate double, pair_comparable long, vote_rate double, vote_comparable long, history_rate double, evaluable long")
    other = config.reliability_settings(spark, write("r.json", settings | {"historyContribution": 0.5, "relativeWeightRange": [0.9, 1.1], "minimumPairwiseEvidenceForFullConfidence": 100}))
    score = lambda s: {r["source"]: (r["score"], r["confidence"], r["relative_weight"]) for r in facts.reliability(evidence, s).collect()}
    assert score(facts.Reliability()) == {"a": (0.808, 0.24, 1.25), "b": (0.165, 0.165, 0.75)}
    assert score(other) == {"a": (0.88, 0.6, 1.1), "b": (0.165, 0.525, 0.9)}
    for bad in ({"relativeWeightRange": [2, 1]}, {"historyContribution": None}, {"currentSignals": None}):
        with pytest.raises(GateError):
            config.reliability_settings(spark, write("r.json", settings | bad))
