"""Cases with results that follow from the operators' rules."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import evidence, html, pages, text
from tessera.operators import contain, facts, gates, history, nested, records, resolve, rules
from tessera.plans import identity, observe
from tessera.operators.gates import GateError
from tessera.sources import io, published
from tessera.streaming.observe import FACTS, observe_stream

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FACT = "source string, item_id long, assistant_id long, capability string, target_id long, route string, pos long, mask int"


def fact_rows(spark, rows):
    return spark.createDataFrame([(*r[:5], r[6] if len(r) > 6 else "r", i, r[5]) for i, r in enumerate(rows)], FACT)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


# --- facts ---------------------------------------------------------------------------------------


def test_comparison(spark):
    a = fact_rows(spark, [("a", 1, None, "improve", None, 1)])
    b = fact_rows(spark, [("b", 1, None, "improve", None, 2), ("b", 1, 2, "improve", None, 1)])
    compared = facts.compare(a, b)
    assert rows(compared, "assistant_id", "status") == [(2, "extra-in-candidate"), (None, "weekday-mismatch")]
    summary = facts.summarise(compared).first()
    assert (summary["matches"], summary["mismatches"], summary["extra"], summary["comparable"], summary["agreement_rate"]) == (0, 1, 1, 1, 0.0)


def test_capabilities_that_a_source_cannot_speak_of_are_not_missing(spark):
    a = fact_rows(spark, [("a", 1, None, "upgrade", 5, 1), ("a", 2, None, "improve", None, 1)])
    b = fact_rows(spark, [("b", 2, None, "improve", None, 1)])
    assert rows(facts.compare(a, b), "item_id", "status") == [(2, "match")]
    assert rows(facts.compare(a, b, declared=[" upgrade ", "improve"]), "item_id", "status") == [(1, "missing-in-candidate"), (2, "match")]


@SLOW
@given(st.lists(st.tuples(st.integers(1, 3), st.none() | st.integers(1, 2), st.integers(0, 127)), min_size=1, max_size=12), st.randoms())
def test_merging_is_idempotent_and_free_of_order(spark, given_rows, random):
    made = [("a", i, s, "improve", None, m) for i, s, m in given_rows]
    shuffled = random.sample(made, len(made))
    once = rows(facts.merge_facts(fact_rows(spark, made)), "item_id", "assistant_id", "mask")
    assert once == rows(facts.merge_facts(fact_rows(spark, shuffled + made)), "item_id", "assistant_id", "mask")


def test_routes_keep_their_order(spark):
    df = fact_rows(spark, [("a", 1, None, "x", None, 1, "z"), ("a", 1, None, "x", None, 1, "b"), ("a", 1, None, "x", None, 1, "z")])
    assert facts.merge_facts(df).first()["routes"] == ["z", "b"]


def test_week(spark):
    df = spark.createDataFrame([([True, False, False, False, False, False, True],)], "w array<boolean>").select(facts.week_mask(F.col("w")).alias("m"))
    assert df.first()["m"] == 65 and df.select(facts.week_days(F.col("m")).alias("d")).first()["d"] == ["sunday", "saturday"]
    with pytest.raises(Exception, match="seven days"):
        spark.createDataFrame([([True],)], "w array<boolean>").select(facts.week_mask(F.col("w"))).collect()


def test_consensus_needs_two_votes_and_breaks_ties_by_the_first_peer(spark):
    df = spark.createDataFrame([(s, "k", m) for s, m in (("a", 1), ("b", 2), ("c", 2), ("d", 1), ("e", 1))] + [("a", "l", 1), ("b", "l", 1)], "source string, fact_key string, mask int")
    found = {r["source"]: (r["comparable"], r["agreements"]) for r in facts.consensus(df).collect()}
    # a's peers are two against two, and b comes first; d's are too, and a comes first
    assert found == {"a": (1, 0), "b": (1, 0), "c": (1, 0), "d": (1, 1), "e": (1, 1)}


def test_reliability(spark):
    schema = "source string, pair_rate double, pair_comparable long, vote_rate double, vote_comparable long, history_rate double, evaluable long"
    df = spark.createDataFrame([("a", 0.9, 500, 0.8, 200, 0.5, 20), ("b", 0.5, 10, None, None, None, 0), ("c", None, 0, None, 0, 1.0, 9)], schema)
    found = {r["source"]: r for r in facts.reliability(df).collect()}
    assert found["a"]["score"] == round(0.8 * (0.9 * 0.65 + 0.8 * 0.35) + 0.2 * 0.5, 6) and found["a"]["confidence_label"] == "high"
    assert found["b"]["score"] == 0.5 and found["b"]["confidence_label"] == "low"
    assert found["c"]["state"] == "insufficient-evidence" and found["c"]["relative_weight"] == 1.0


# --- history -------------------------------------------------------------------------------------


@SLOW
@given(st.dictionaries(st.integers(0, 6), st.integers(0, 2)), st.dictionaries(st.integers(0, 6), st.integers(0, 2)))
def test_differences_mirror(spark, a, b):
    left, right = (spark.createDataFrame(list(x.items()), "k int, v int") for x in (a, b))
    there, back = (dict(rows(history.record_diff(x, y, "k"))) for x, y in ((left, right), (right, left)))
    mirror = {"added": "removed", "removed": "added", "changed": "changed", "unchanged": "unchanged"}
    assert there == {k: mirror[v] for k, v in back.items()}
    assert set(dict(rows(history.record_diff(left, left, "k"))).values()) <= {"unchanged"}


def test_record_diff(spark):
    before, after = (spark.createDataFrame(x, "id int, v string") for x in ([(1, "a"), (2, "a")], [(2, "b"), (3, None)]))
    assert rows(history.record_diff(before, after, "id")) == [(1, "removed"), (2, "changed"), (3, "added")]


def state(spark, *items):
    return facts.aggregate_facts(fact_rows(spark, [(s, i, None, "improve", None, m) for s, i, m in items]))


def test_observation(spark, tmp_path):
    root = str(tmp_path / "h")
    ok = {"a": "ok", "b": "ok", "c": "ok"}
    first = observe.observe(spark, root, state(spark, ("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("c", 1, 1)), ok, observed_at="1")
    assert {k: (v["state"], v["events"]) for k, v in first.items()} == dict.fromkeys("abc", ("baseline", 0))
    second = observe.observe(spark, root, state(spark, ("a", 1, 2), ("b", 1, 1), ("c", 1, 1)), ok | {"b": "partial"}, observed_at="2")
    assert second["a"]["events"] == 2 and second["b"]["state"] == "skipped" and second["c"]["state"] == "unchanged"
    third = observe.observe(spark, root, state(spark, ("a", 1, 1), ("a", 2, 1), ("b", 1, 1), ("c", 1, 1)), ok, observed_at="3")
    assert third["a"]["events"] == 2
    log = observe.events(spark, root, "a")
    assert rows(log, "observed_at", "change", "assessment") == [("2", "modified", "unconfirmed"), ("2", "removed", "unconfirmed"), ("3", "modified", "corroborated"), ("3", "reappeared", "unconfirmed")]
    assert observe.observe(spark, root, state(spark, ("a", 1, 1), ("a", 2, 1)), {"a": "ok"}, observed_at="4")["a"]["state"] == "unchanged"
    assert observe.facts_hash(state(spark, ("a", 1, 1), ("a", 2, 2))).first() == observe.facts_hash(state(spark, ("a", 2, 2), ("a", 1, 1))).first()


def test_an_outlier_has_two_peers_against_it(spark):
    events = spark.createDataFrame([("a", "k", "modified", "old", "x"), ("a", "l", "removed", "x", None)], "source string, fact_key string, change string, before string, after string")
    peers = spark.createDataFrame([(s, k, "y") for s in "bc" for k in "kl"] + [("a", "k", "x")], "source string, fact_key string, signature string")
    assert rows(history.assess(events, peers), "fact_key", "assessment") == [("k", "outlier"), ("l", "outlier")]


def test_a_stream_of_files_is_observed(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "h")
    for mask in (1, 3):
        spark.createDataFrame([("a", 1, None, "improve", None, "r", 0, mask, "explicit", "x")], FACTS).coalesce(1).write.mode("append").parquet(folder)
        observe_stream(spark, folder, root, str(tmp_path / "c")).awaitTermination()
    assert rows(observe.events(spark, root, "a"), "change") == [("modified",)]


def test_a_run_that_comes_again_changes_nothing(spark, tmp_path, monkeypatch):
    root, ok = str(tmp_path / "h"), {"a": "ok", "b": "ok"}
    states = [state(spark, ("a", 1, 1), ("a", 2, 1), ("b", 1, 1)), state(spark, ("a", 1, 2), ("b", 1, 1)), state(spark, ("a", 1, 2), ("a", 2, 1), ("b", 1, 1)), state(spark, ("a", 1, 2), ("b", 1, 1))]
    log = lambda: rows(observe.events(spark, root, "a"), "observed_at", "change", "fact_key", "pos")
    for k, facts_now in enumerate(states):
        report = observe.observe(spark, root, facts_now, ok, observed_at=str(k), run_id=f"r{k}")
        seen, kept = log(), published.manifest(spark, f"{root}/a")
        for j in range(k + 1):
            assert observe.observe(spark, root, states[j], ok, observed_at="again", run_id=f"r{j}")["a"]["observed_at"] == str(j)
        assert log() == seen and published.manifest(spark, f"{root}/a") == kept and report["a"]["observed_at"] == str(k)
    assert [r[1] for r in sorted(seen)] == ["modified", "removed", "reappeared", "removed"]
    # what has been removed is what the whole log says
    gone = spark.read.parquet(f"{root}/a/{kept['gone']}")
    assert rows(gone) == rows(history.removed_keys(observe.events(spark, root, "a"))) and gone.count() == 1
    # a run that is cut off before its manifest counts for nothing; done again it counts once
    with monkeypatch.context() as patch:
        patch.setattr(published, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            observe.observe(spark, root, states[2], ok, observed_at="4", run_id="r4")
    assert log() == seen
    assert observe.observe(spark, root, states[2], ok, observed_at="4", run_id="r4")["a"]["events"] == 1 and len(log()) == len(seen) + 1
    assert published.tidy(spark, f"{root}/a") and len(log()) == len(seen) + 1 and not published.tidy(spark, f"{root}/a")


# --- sinks that publish --------------------------------------------------------------------------


def test_a_killed_task_leaves_the_old_content(spark, tmp_path):
    root = str(tmp_path / "t")
    published.overwrite(spark.range(100).select("id"), root)

    @F.udf("long")
    def dies(x):
        if x == 77:
            raise RuntimeError("lost")
        return x

    for write in (published.overwrite, published.append):
        with pytest.raises(Exception, match="lost"):
            write(spark.range(200).repartition(8).select(dies("id").alias("id")), root)
        assert published.read(spark, root, "id long").count() == 100
    assert len(published.tidy(spark, root)) == 2
    published.overwrite(published.read(spark, root, "id long").where("id < 10"), root)
    published.append(spark.range(3).select("id"), root)
    assert published.read(spark, root, "id long").count() == 13 and published.tidy(spark, root)


def test_ten_thousand_captures_are_one_write(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    batch = spark.range(10_000).selectExpr("concat('h/', id, '.html') as cache_key", "concat('http://h/', id) as url", "id as fetched_at", "cast(concat('page ', id) as binary) as content")
    assert len(published.install_captures(spark, root, batch)["segments"]) == 1
    newer = spark.createDataFrame([("h/5.html", 7, b"older"), ("h/5.html", 9, b"newest"), ("x/\u00e9.html", 1, "\u00e9".encode())], "cache_key string, fetched_at long, content binary")
    published.install_captures(spark, root, newer)
    found = published.read_captures(spark, root)
    assert found.count() == 10_001 and rows(found.where("cache_key in ('h/5.html', 'h/6.html')"), "cache_key", "content", "state") == [("h/5.html", "newest", "ok"), ("h/6.html", "page 6", "ok")]
    plan = found.where("cache_key = 'h/6.html'").select("content")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(cache_key,h/6.html)" in plan
    narrow = found.select("cache_key", "url")._jdf.queryExecution().executedPlan().toString()
    assert "content:binary" not in narrow
    for bad in ({"cache_key": "../x"}, {"cache_key": "/x"}, {"content_sha256": "0"}):
        row = {"cache_key": "k", "content_sha256": None, "content": b"x"} | bad
        with pytest.raises(GateError):
            published.install_captures(spark, root, spark.createDataFrame([tuple(row.values())], "cache_key string, content_sha256 string, content binary"))
    monkeypatch.setattr(published, "MOST_SEGMENTS", 2)
    state_now = published.install_captures(spark, root, newer.limit(1))
    assert len(state_now["segments"]) == 1 and published.read_captures(spark, root).count() == 10_001


def test_only_changed_records_are_computed(spark, tmp_path):
    """One page of a thousand changed is one page parsed; what can't be had keeps what it had."""
    root, schema = str(tmp_path / "r"), "page string, word string"
    parsed = spark.sparkContext.accumulator(0)

    def compute(rows_):
        def words(batches):
            for frame in batches:
                parsed.add(len(frame))
                yield frame.assign(word=frame["text"].str.split()).explode("word").dropna()[["page", "word"]]

        return rows_.mapInPandas(words, schema)

    def inputs(**changed):
        texts = {f"p{i}": f"one{i} two" if i else "" for i in range(1000)} | changed
        return spark.createDataFrame([(k, t) for k, t in texts.items()], "page string, text string").withColumn("input_hash", F.sha2("text", 256))

    run = lambda **c: (published.refresh(spark, root, inputs(**c), "page", compute, schema), parsed.value)
    assert run() == ({"computed": 1000}, 1000)
    assert run() == ({"reused": 1000}, 1000)
    assert run(p7="seven") == ({"computed": 1, "reused": 999}, 1001)
    found = published.outputs(spark, root, "page", schema)
    assert found.count() == 1998 - 1 and rows(found.where("page in ('p6', 'p7')")) == [("p6", "one6", "reused"), ("p6", "two", "reused"), ("p7", "seven", "computed")]
    # it changes back; another can't be had; a new one never could be
    assert run(p8=None, new=None) == ({"reused": 999, "stale": 1, "placeholder": 1}, 1001)
    found = published.outputs(spark, root, "page", schema)
    assert rows(found.where("page in ('p7', 'p8', 'new')")) == [("p7", "one7", "reused"), ("p7", "two", "reused"), ("p8", "one8", "stale"), ("p8", "two", "stale")]
    with pytest.raises(ZeroDivisionError):
        published.refresh(spark, root, inputs(p9="x"), "page", lambda r: 1 / 0, schema)
    assert rows(published.outputs(spark, root, "page", schema).where("page = 'p9'")) == [("p9", "one9", "reused"), ("p9", "two", "reused")]


@pytest.mark.parametrize("count", [0, 1, 50_000])
def test_a_digest_of_many_paths_is_a_running_hash(spark, count):
    frame = spark.range(count).select(F.concat(F.lit("é/"), (F.col("id") * 7919 % 1_000_003).cast("string")).alias("path"), F.md5(F.col("id").cast("string")).alias("d")).repartition(5)
    found = gates.fold_digest(frame.union(spark.createDataFrame([(None, "x"), ("y", None)], "path string, d string")), "path", "d", header="h\n")
    lines = sorted((f"é/{i * 7919 % 1_000_003}".encode(), hashlib.md5(str(i).encode()).hexdigest().encode()) for i in range(count))
    assert [r[0] for r in found.collect()] == [hashlib.sha256(b"h\n" + b"".join(p + b"\0" + d + b"\n" for p, d in lines)).hexdigest()]
    assert "collect_list" not in found._jdf.queryExecution().toString()


def test_lines_are_numbered_across_splits(spark, tmp_path):
    """Files of many splits, some in one task, with empty lines and one without an end; none is read whole."""
    texts = {"a.jsonl": ['{"k": %d, "pad": "%s"}' % (i, "x" * (i % 50)) for i in range(5000)], "b.jsonl": ["{}", "", "no", "[1]", '"s"', "{}"], "c.jsonl": ["{}"] * 3}
    texts["a.jsonl"][4321] = "not json"
    texts["a.jsonl"][7] = "{"
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if name != "b.jsonl" else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert spark.read.text(f"{tmp_path}/a.jsonl").rdd.getNumPartitions() > 15
        found = [(r["file"].rsplit("/", 1)[1], r["line"], r["text"]) for r in io.numbered_lines(spark, str(tmp_path)).collect()]
        assert sorted(found) == sorted((n, k, x) for n, lines in texts.items() for k, x in enumerate(lines, 1))
        bad = sorted((r["file"].rsplit("/", 1)[1], r["line"]) for r in io.bad_json_lines(spark, str(tmp_path)).collect())
        assert bad == [("a.jsonl", 8), ("a.jsonl", 4322), ("b.jsonl", 3), ("b.jsonl", 4), ("b.jsonl", 5)]
        with pytest.raises(GateError, match="no JSON"):
            io.read_json_lines(spark, f"{tmp_path}/a.jsonl", "k long", strict=True)
        assert io.read_json_lines(spark, f"{tmp_path}/c.jsonl", "k long", strict=True).count() == 3
        assert "wholetext" not in io.numbered_lines(spark, str(tmp_path))._jdf.queryExecution().toString().lower()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# --- nested --------------------------------------------------------------------------------------


def test_three_states_of_a_day(spark):
    rules = spark.createDataFrame([("r", None, 0, 1)], "route string, assistant long, distance int, mask int")
    assert [r["ids"] for r in nested.assistants_by_day(rules).orderBy("view").collect()] == [[], [], None, None, None, None, None, None]


def test_the_specific_rule_wins(spark):
    rules = spark.createDataFrame([("r", 1, 0, 127), ("r", 2, 1, 127), ("r", 2, 0, 0), ("s", 1, 0, 1), ("s", 1, 0, 2), ("t", 1, None, 4)], "route string, assistant long, distance int, mask int")
    assert rows(nested.most_specific(rules), "route", "assistant", "mask") == [("r", 1, 127), ("r", 2, 0), ("s", 1, 3), ("t", 1, 4)]


def test_steps(spark):
    stages = spark.createDataFrame([(1, 1, 0, 5, "a"), (1, 2, 6, 6, "b"), (1, 3, 5, 5, "c")], "id long, pos int, first int, last int, cost string")
    found = {r["level"]: (r["available"], r["cost"], r["target"]) for r in nested.expand_steps(stages, spark.createDataFrame([(1, 9)], "id long, target long")).collect()}
    assert len(found) == 11 and found[4] == (True, "a", None) and found[5] == (True, "c", None) and found[6] == (True, "b", None) and found[7] == (False, None, None) and found[10] == (True, None, 9)


def test_steps_need_no_join(spark):
    """Steps of an id come of one aggregate: nothing is broadcast, whatever the planner thinks of sizes; ids without stages, and null, have their defined rows."""
    stages = spark.createDataFrame([(1, 1, 0, 20, 5), (1, 2, 3, 2, 6), (2, 1, -4, 0, None), (None, 1, 0, 9, 7)], "id long, pos int, first int, last int, cost int")
    df = nested.expand_steps(stages, spark.createDataFrame([(1, 4), (1, 9), (3, 1)], "id long, target long"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan
    found = {(r["id"], r["level"]): (r["available"], r["cost"], r["target"]) for r in df.collect()}
    assert len(found) == 33 and found[1, 9] == (True, 5, None) and found[1, 10] == (True, None, 9)
    assert found[2, 0] == (False, None, None) and found[None, 0] == (False, None, None) and found[None, 10] == (False, None, None)


def test_json_walk(spark):
    docs = spark.createDataFrame([('{"a": [1, {"b": null}]}',), ("bad",), (None,)], "j string")
    assert ("$.a[1].b", "null") in rows(nested.walk(docs, "j"), "path", "value")


def test_json_is_walked_to_any_depth(spark):
    """Every node once, of documents of 0 to 200 levels in one table; owners are found at the bottom."""

    def nodes(value, path="$"):
        yield path, json.dumps(value, separators=(",", ":"))
        for k, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
            yield from nodes(v, f"{path}.{k}" if isinstance(value, dict) else f"{path}[{k}]")

    deep = {"_api_id": 5, "_equipment": [{"equipment": 7, "size": 2}]}
    for k in range(100):
        deep = {"x": [deep, k]} if k % 9 == 0 else {"x": [deep]}
    texts = [deep, {}, [], 3, "s", None, [[], {}, [1, {"a": None, "b.c": [True]}]], {"a": {"_api_id": 1, "_equipment": []}}]
    docs = spark.createDataFrame([(i, json.dumps(t), "p") for i, t in enumerate(texts)] + [(90, "{", "p"), (91, None, "p")], "n int, j string, path0 string")
    found = nested.walk(docs, "j")
    assert found.columns == ["n", "path0", "path", "kind", "value"]
    assert sorted((r["n"], r["path"], r["value"]) for r in found.collect()) == sorted((i, *x) for i, t in enumerate(texts) for x in nodes(t))
    assert rows(records.owner_nodes(docs, "j"), "owner_ref", "slot", "item_ref", "size") == [("5", 0, "7", 2)]


# --- resolution ----------------------------------------------------------------------------------


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (4, None)], "node int, next int")
    found = {}
    for root, distance, node in sorted(tuple(r) for r in resolve.forward_closure(edges).collect()):
        found.setdefault(root, []).append(node)
    assert found == {1: [1, 2, 3], 2: [2, 3], 3: [3, 2], 4: [4]}
    assert dict(rows(resolve.families(edges))) == {1: 1, 2: 1, 3: 1, 4: 4}


def test_long_chains_are_followed_to_their_end(spark):
    edges = spark.createDataFrame([(i, i + 1 if i < 69 else None) for i in range(70)], "node int, next int").coalesce(1)
    assert dict(rows(resolve.families(edges))) == dict.fromkeys(range(70), 0)
    found = {tuple(r) for r in resolve.forward_closure(edges.where("node >= 30")).select("root", "distance", "node").collect()}
    assert found == {(a, b - a, b) for a in range(30, 70) for b in range(a, 70)}


def test_unique_names_and_flags(spark):
    catalog = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "name string, id long")
    wanted = spark.createDataFrame([("a", "true"), ("a", "1"), ("b", "true"), ("c", "true")], "name string, flag string")
    found = resolve.unique_name(wanted, catalog)
    assert rows(found.withColumn("check", resolve.checked_flag(found)), "name", "flag", "check") == [("a", "1", "invalid"), ("a", "true", "ok"), ("b", "true", "ambiguous"), ("c", "true", "missing")]


def test_links(spark):
    names = spark.createDataFrame([("one", 1), ("one new", 2), ("two", 3)], "name string, id long")
    links = spark.createDataFrame([("one", "one new"), ("one", "two"), ("one", "none"), ("x", "y")], "text string, page string")
    assert rows(resolve.cross_check_links(links, names), "page", "id", "state") == [("none", 1, "resolved"), ("one new", 2, "page-more-specific"), ("two", None, "ambiguous"), ("y", None, "unresolved")]


def test_the_longest_alias_is_taken_first(spark):
    texts = spark.createDataFrame([("big cat and cat",), ("big cat",), (None,)], "t string")
    found = contain.scan_aliases(texts, "t", spark.createDataFrame([("big cat", 1), ("cat", 2), ("", 3), (None, 4)], "alias string, id long"))
    assert {r["t"]: r["found"] for r in found.collect()} == {"big cat and cat": [1, 2], "big cat": [1], None: []}


def plain_scan(text, aliases):
    """All occurrences by search, longest alias first, then by alias and place; those over an accepted one are left out."""
    met = sorted(((-len(a), a, m.start()) for a in {a for a, _ in aliases if a} for m in re.finditer(f"(?={re.escape(a)})", text or "")))
    taken, out = [], {}
    for n, alias, start in met:
        if all(start - n <= a or b <= start for a, b in taken):
            taken.append((start, start - n))
            out |= dict.fromkeys(sorted(i for a, i in aliases if a == alias))
    return list(out)


def test_grams_do_not_depend_on_where_texts_are_cut(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    offsets = np.concatenate([[0], np.sort(rng.integers(0, 3000, 40)), [3000]])
    for _, size, window in contain.CLASSES:
        whole = contain.sampled_grams(data, offsets, size, window)
        with monkeypatch.context() as patch:
            patch.setattr(contain, "_STEP", 64)
            parts = contain.sampled_grams(data, offsets, size, window)
        assert all((a == b).all() for a, b in zip(whole, parts))


@pytest.mark.parametrize("many", [40, 400])
def test_contained_aliases_are_those_of_brute_force(spark, many):
    """Aliases of all classes, nested and overlapping, in texts with copies, multi-byte letters and runs; at two sizes."""
    rng = random.Random(many)
    stems = ["ab", "a", "é", "ship", "the long name of a ship", "船", "  ", "aaaa", "tanker number one of the fleet of"]
    phrase = lambda n: "".join(rng.choices(stems, k=n))
    aliases = [(phrase(rng.randrange(1, 6)), rng.randrange(50)) for _ in range(many)] + [("", 1), (None, 2), ("a" * 60, 3), ("a" * 59, 4)]
    texts = [phrase(rng.randrange(0, 40)) for _ in range(many)] + ["a" * 200, None, ""]
    texts += [f"x{a}y{a}" for a, _ in aliases if a] + texts[:5] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, t string").repartition(5)
    found = {r["n"]: r["found"] for r in contain.scan_aliases(frame, "t", spark.createDataFrame(aliases, "alias string, id long")).collect()}
    wanted = {n: plain_scan(t, aliases) for n, t in enumerate(texts)}
    assert [(n, found[n], w) for n, w in wanted.items() if found[n] != w] == []


@pytest.mark.parametrize("piece", [0, 7])
def test_aliases_that_reach_beyond_the_bytes_about_a_gram(spark, monkeypatch, piece):
    """They are verified by the text itself, others beside them by the bytes; places at both ends of a text."""
    monkeypatch.setattr(contain, "PIECE", piece)
    rng = random.Random(piece)
    aliases = [("".join(rng.choices("abc é", k=rng.choice([1, 2, 3, 5, 9, 30, 200]))), n) for n in range(40)]
    texts = [f"{rng.choice(aliases)[0]}{rng.choice('ab ')}{rng.choice(aliases)[0]}" for _ in range(60)]
    texts += [a[:-1] + "x" + a for a, _ in aliases] + texts[:20]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, t string")
    found = {r["n"]: r["found"] for r in contain.scan_aliases(frame, "t", spark.createDataFrame(aliases, "alias string, id long")).collect()}
    assert [(n, found[n]) for n, t in enumerate(texts) if found[n] != plain_scan(t, aliases)] == []


def test_tables_of_bits_that_are_full_only_let_more_through(spark, monkeypatch):
    monkeypatch.setattr(contain, "FILTER_BITS", 16)
    texts = spark.range(4000).selectExpr("id as n", "sha2(cast(id as string), 512) as t")
    found = contain.scan_aliases(texts, "t", texts.selectExpr("substring(t, 50, 20) as alias", "n as id"))
    assert found.where("found = array(n)").count() == 4000


def test_bytes_that_no_alias_has_stay_in_their_task(spark, monkeypatch):
    """Short aliases beside long ones: each byte of the texts was a row once."""
    made, kind = spark.sparkContext.accumulator(0), type(spark.range(0))

    def counted(self, func, *rest, plain=kind.mapInArrow, **more):
        def run(batches):
            for batch in func(batches):
                made.add(batch.num_rows)
                yield batch

        return plain(self, run, *rest, **more)

    rng = random.Random(5)
    texts = ["".join(rng.choices("bcdfghjklm ", k=5000)) + "Ed. an alias of some length that is here" for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, t string").repartition(3)
    monkeypatch.setattr(kind, "mapInArrow", counted)
    found = contain.scan_aliases(frame, "t", spark.createDataFrame([("Ed.", 1), ("Der.", 2), ("alias of some length that", 3)], "alias string, id long"))
    assert [r["found"] for r in found.collect()] == [[3, 1]] * 60
    assert made.value < 5000


def test_no_side_of_containment_is_collected(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    plan = contain.scan_aliases(texts, "text", texts.selectExpr("substring(text, 1, 40) as alias", "doc_id as id")).select("doc_id", "found")
    assert "collect" not in plan._jdf.queryExecution().executedPlan().toString().replace("collect_list", "")
    assert plan.where("array_contains(found, doc_id)").count() > 100


def test_selectors(spark):
    rules = spark.createDataFrame([(1, "A/D(C不可)"), (2, "Aのみ"), (3, "A(B～不可)"), (4, None)], "rule int, s string")
    catalog = spark.createDataFrame([(n, i) for i, n in enumerate("ABCD", 1)], "name string, id int")
    closure = resolve.forward_closure(spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, None)], "node int, next int"))
    found = resolve.select_ids(resolve.selectors(rules, "s"), catalog, closure)
    assert rows(found) == [(1, 1, 0), (1, 2, 1), (1, 4, 0), (2, 1, 0), (3, 1, 0)]


@pytest.mark.parametrize(
    ("selector", "names", "mode", "banned", "onwards"),
    [
        ("A(C・D不可)", ["A"], "closure", ["C", "D"], False),
        ("A/B(x,y不可)", ["A", "B"], "closure", ["x", "y"], False),
        ("A・B(C~不可)", ["A", "B"], "closure", ["C"], True),
        ("A(六式)", ["A(六式)"], "closure", [], False),
        ("A(B可)", ["A"], "closure", [], False),
        ("A/B(のみ)", ["A"], "only", [], False),
        ("-", [], "", [], False),
    ],
)
def test_selector_grammar(selector, names, mode, banned, onwards):
    found = resolve.parse_selector(selector)
    assert [p["name"] for p in found] == names
    assert all((p["mode"], p["exclude"], p["exclude_closure"]) == (mode, banned, onwards) for p in found)


def test_long_chains_components_and_cycles(spark):
    chain = spark.createDataFrame([(i, i + 1 if i < 40 else None, i) for i in range(41)], "node long, next long, rank long")
    assert resolve.forward_closure(chain).where("root = 0").count() == 41
    assert resolve.families(spark.createDataFrame([(i, i - 1) for i in range(1, 90)], "node long, next long")).select("family").distinct().count() == 1
    ring = spark.createDataFrame([(1, 2, 9), (2, 3, 8), (3, 4, 7), (4, 2, 6)], "node long, next long, rank long")
    assert rows(resolve.rings(ring), "ring", "place", "node", "size") == [(2, 0, 4, 3), (2, 1, 3, 3), (2, 2, 2, 3)]
    assert rows(resolve.ordered_closure(ring).where("root in (1, 3)")) == [(1, 1, 0), (1, 2, 1), (3, 2, 1), (3, 3, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_walks_of_random_successors(spark, seed):
    """Rings of all sizes, also of one node, trees into them, chains, nodes that only others name, several successors."""
    rng = random.Random(seed)
    edges = [(i, rng.choice([None, i, rng.randrange(60), rng.randrange(60), i + 1])) for i in range(55)] + [(3, 7), (9, 2)]
    step = {}
    for a, b in edges:
        step[a] = min((x for x in (step.get(a), b) if x is not None), default=None)
    wanted = {}
    for root in step:
        walk, at = [], root
        while at is not None and at not in walk:
            walk.append(at)
            at = step.get(at)
        wanted[root] = (walk, at)
    frame = spark.createDataFrame([(a, b, -a) for a, b in edges], "node int, next int, rank int")
    jumps = resolve.Jumps(frame)
    found = resolve.rings(frame, jumps)
    inside = {n: sorted(w[w.index(back) :]) for n, (w, back) in wanted.items() if back is not None and back == n}
    assert sorted(rows(found, "ring", "place", "node", "size")) == sorted((m[0], len(m) - 1 - m.index(n), n, len(m)) for n, m in inside.items())
    ends = {r["node"]: (r["end"], r["distance"], r["ring"]) for r in resolve.walk_ends(frame, found).collect()}
    assert ends == {n: (w[-1], len(w) - 1, None) if back is None else (back, w.index(back), inside[back][0]) for n, (w, back) in wanted.items()}
    assert sorted(rows(resolve.forward_closure(frame))) == sorted((n, k, x) for n, (w, _) in wanted.items() for k, x in enumerate(w))
    some = spark.createDataFrame([(5,), (5,), (11,), (99,)], "root int")
    assert sorted(rows(resolve.walks(frame, some), "root", "distance", "node")) == sorted((n, k, x) for n in (5, 11) for k, x in enumerate(wanted[n][0]))


def test_walks_of_a_hundred_thousand_steps(spark):
    """A chain, and a tail into a ring, both far longer than a row could hold for every node."""
    chain = spark.range(100_000).select(F.col("id").alias("node"), F.when(F.col("id") < 99_999, F.col("id") + 1).alias("next"))
    ring = spark.range(200_000, 210_011).select(F.col("id").alias("node"), F.when(F.col("id") < 210_010, F.col("id") + 1).otherwise(200_010).alias("next"))
    edges = chain.union(ring).repartition(4)
    found = resolve.rings(edges)
    assert found.agg(F.count("*"), F.min("ring"), F.max("ring"), F.max("size"), F.max("place")).first()[:] == (10_001, 200_010, 200_010, 10_001, 10_000)
    ends = resolve.walk_ends(edges, found)
    assert ends.where("node < 100000").agg(F.count("*"), F.sum("distance"), F.min("end"), F.max("end")).first()[:] == (100_000, 99_999 * 50_000, 99_999, 99_999)
    assert ends.where("node >= 200000 and node < 200010").where("end = 200010 and distance = 200010 - node and size = 10001").count() == 10
    walk = resolve.walks(edges, spark.createDataFrame([(0,), (200_000,)], "root long"))
    assert walk.groupBy("root").agg(F.count("*").alias("n"), F.count_distinct("node").alias("nodes"), F.max("distance").alias("d")).orderBy("root").collect() == [(0, 100_000, 100_000, 99_999), (200_000, 10_011, 10_011, 10_010)]
    assert walk.where("root = 0 and node <> distance").count() == 0


def test_last_of_a_name_and_fragments(spark):
    catalog = spark.createDataFrame([("a", 1, 0), ("a", 2, 1)], "name string, id long, pos int")
    assert resolve.last_of_name(catalog).first()["id"] == 2
    df = spark.createDataFrame([("abc new", "new", "abc"), ("xx newer", "new", "abc"), ("zzz", "new", "abc")], "n string, f string, a string")
    assert [r[0] for r in df.select(resolve.fragment_score(F.col("n"), F.col("f"), F.col("a"))).collect()] == [83, 60, None]


# --- gates ---------------------------------------------------------------------------------------


def test_floors(spark):
    thresholds = spark.createDataFrame([("m", None, 0.8)], "metric string, minimum double, ratio double")
    old = spark.createDataFrame([("m", 11.0)], "metric string, value double")
    for value, passed in ((8.0, True), (7.0, False)):
        assert gates.gate(spark.createDataFrame([("m", value)], "metric string, value double"), old, thresholds).first()["passed"] is passed


def test_stops(spark):
    with pytest.raises(gates.GateError) as stop:
        gates.require_empty(spark.range(3), "rows are left", "remove them")
    assert json.loads(str(stop.value))["reason"] == "rows are left" and len(stop.value.details) == 3
    gates.require_counts(spark.range(3), {"n": 3}, {"n": F.count("*")})
    with pytest.raises(gates.GateError):
        gates.require_counts(spark.range(3), {"n": 4}, {"n": F.count("*")})


def test_manifests(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.txt").write_bytes(b"one")
    (tmp_path / "b.png").write_bytes(b"\x89PNG\r\n\x1a\nrest")
    manifest = gates.file_manifest(spark, str(tmp_path))
    assert rows(manifest) == [("b.png", 12, hashlib.sha256(b"\x89PNG\r\n\x1a\nrest").hexdigest()), ("d/a.txt", 3, hashlib.sha256(b"one").hexdigest())]
    manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
    (tmp_path / "d/a.txt").write_bytes(b"two")
    (tmp_path / "new").write_bytes(b"x")
    assert rows(gates.verify_manifest(manifest, gates.file_manifest(spark, str(tmp_path)))) == [("d/a.txt", "modified"), ("new", "unexpected")]
    assert spark.read.format("binaryFile").load(f"{tmp_path}/b.png").select(gates.image_kind(F.col("content"))).first()[0] == "png"


# --- text ----------------------------------------------------------------------------------------


def test_normal_forms():
    assert text.narrow_name("ガ＊Ａ ｂ?パ１") == "ｶﾞabﾊﾟ1"
    assert text.catalog_name("Name *1") == "name" and text.catalog_name(None) == ""
    assert text.reference_name("「Ａ・Ｂ」－ｃ’ß") == "abc'ss".replace("c'", "－c'".replace("－", ""))
    assert text.exact_text(" Ａ　 ｂ。") == "A b。"
    assert text.sentences("一。二（三。四）五！\n六") == ["一。", "二（三。四）五！", "六"]


@settings(max_examples=50, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text(max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8))
def test_canonical_json_is_free_of_key_order(value):
    def turned(x):
        if isinstance(x, dict):
            return {k: turned(x[k]) for k in reversed(list(x))}
        return [turned(y) for y in x] if isinstance(x, list) else x

    assert text.canonical_json(json.dumps(value)) == text.canonical_json(json.dumps(turned(value)))


def test_digests_leave_out_volatile_metadata(spark):
    a, b, c = ({"metadata": {"generatedAt": t, "schemaVersion": v}, "data": [1]} for t, v in (("x", 1), ("y", 1), ("x", 2)))
    df = spark.createDataFrame([(json.dumps(x),) for x in (a, b, c)] + [("bad",), (None,)], "j string")
    digests = [r[0] for r in df.select(text.content_digest(F.col("j"))).collect()]
    assert digests[0] == digests[1] != digests[2] and digests[3] is None and digests[4] is None


def test_cells_and_replacements(spark):
    df = spark.createDataFrame([("+1.00",), ("5%",), ("+1/√2",), ("○",)], "c string")
    value, unit = text.typed_cell(F.col("c"))
    assert [tuple(r) for r in df.select(value, unit, text.day_mark(F.col("c"))).collect()] == [(1.0, None, False), (5.0, "%", False), (None, None, False), (None, None, True)]
    replaced = text.apply_replacements(F.lit("abc ab x"), {"ab": "1", "abc": "2"}, {"": ["x"]})
    assert spark.range(1).select(replaced).first()[0] == "2 1 "
    assert spark.range(1).select(text.page_name(F.lit("https://h/w/a%20b+c/"), "/w/"), text.page_name(F.lit("https://h/x"), "/w/")).first()[:] == ("a b+c", "")


# --- pages ---------------------------------------------------------------------------------------

GRID = "<table><tr><td rowspan=2>x<td>a</tr><tr><td>b</table>"


def test_grids():
    table = html.parse(GRID).find_all("table")[0]
    assert [r["cells"] for r in html.expand_grid(table)] == [["x", "a"], ["x", "b"]]
    wide = html.parse("<table><tr><th colspan=3>h</th></tr><tr class=k><td>1<td rowspan=2>2</tr><tr><td>3</tr></table>").find_all("table")[0]
    assert [r["cells"] for r in html.expand_grid(wide, even=True)] == [["h", "h", "h"], ["1", "2", ""], ["3", "2", ""]]
    inner = html.parse("<table><tr><td><table><tr><td>i</table></table>").find_all("table")[0]
    assert len(html.expand_grid(inner)) == 1 and len(html.expand_grid(inner, nested=True)) == 2


def test_effects_links_and_sections():
    head = "".join(f"<th>★{i}</th>" for i in range(1, 11))
    page = f"<table><tr><th>other</th>{head}</tr></table><table><tr><th>単一</th>{head}</tr><tr class='rbonus-row'><td>fire</td><td>+1</td></tr></table>"
    assert html.effect_levels(page) == [{"level": 1, "name": "fire", "value": "+1", "conditional": True}]
    assert html.links('<a href="/a">t</a><a href="/a">t</a><a>no</a>', "https://h/x/") == [{"text": "t", "href": "https://h/a"}]
    assert html.cards('<a href="b"><img alt="n"></a><a href="a" title="t">x</a>') == [{"name": "n", "href": "b"}, {"name": "t", "href": "a"}]
    assert html.item_cards('<a href="/w/x" title="No.003: gun">a</a><a href="/w/y">3:other</a><a href="/w/z"><img src="i/weapon012.png"></a>', "https://h/") == [
        {"id": 3, "name": "gun", "href": "https://h/w/x", "state": "first"}, {"id": 3, "name": "other", "href": "https://h/w/y", "state": "conflict"}, {"id": 12, "name": "z", "href": "https://h/w/z", "state": "first"}]
    long = html.tables("<table><tr><td rowspan=600>x</td><td>0</td></tr>" + "".join(f"<tr><td>{i}</td></tr>" for i in range(1, 600)) + "</table>")
    assert all(r["cells"] == ["x", str(i)] for i, r in enumerate(long)) and long[0]["html"] == ["x", "0"]


@pytest.mark.parametrize(
    ("text_", "state"),
    [("先行実装で配布された", "historical"), ("恒常で入手可能", "current"), ("以前は任務、現在は建造可能", "mixed-summary"), ("開発", "current-or-summary"), ("入手不能", "historical")],
)
def test_availability(text_, state):
    assert evidence.availability_of(text_) == state


def test_evidence_of_blocks():
    words = evidence.Vocabulary(labels={"任務報酬": "任務"}, markers=frozenset({"昔"}), ignored=frozenset({"広告"}))
    page = "<h2>x</h2><h3>入手方法</h3><p>広告</p><ul><li>任務報酬：<ul><li>一</li></ul></li><li>昔</li><li>開発</li></ul><div>lost<p>建造</p></div><blockquote>購入</blockquote><h3>y</h3><p>交換</p>"
    heading, scope, units = evidence.read_section(page, words=words)
    assert (heading, scope) == ("入手方法", "section")
    assert [(u["text"], u["kinds"], u["availability"], u["context"]) for u in units] == [
        ("一", ["quest"], "current-or-summary", "任務報酬："), ("開発", ["quest", "development"], "historical", "任務報酬："),
        ("建造", ["construction"], "current-or-summary", None), ("購入", ["purchase"], "current-or-summary", None)]
    heading, scope, units = evidence.read_section("<h2>ゲームにおいて</h2><ul><li>任務で入手できる<ul><li>報酬として入手できる建造<li>無</ul><li>無関係</ul><h3>z</h3><p>開発</p>")
    assert (heading, scope, [u["text"] for u in units]) == (None, "page-fallback", ["任務で入手できる", "報酬として入手できる建造"])


def test_page_records(spark):
    page = "<table><tr><th>No.7</th></tr><tr><th>備考</th><td>2020年 開発可能</td></tr></table><h2>入手方法</h2><ul><li>開発で入手。以前はランキング報酬</li><li>謎</li></ul><h2>x</h2>"
    record = pages.page_record(page, 7)
    assert (record["page_id"], record["flag"], record["coverage"], record["accepted"]) == (7, True, "partial", True)
    assert record["current"] == ["other"] and record["historical"] == ["development", "ranking"]
    assert pages.page_record(page, 8)["issues"] == ["id-mismatch"] or "flag-unresolved" in pages.page_record(page, 8)["issues"]
    assert pages.page_record(None, 1)["coverage"] == "rejected"
    assert pages.page_record(page.replace("開発可能", "開発不可"), 7)["flag"] is False
    df = spark.createDataFrame([(page, 7), (None, None)], "h string, i long").select(pages.page_records(F.col("h"), F.col("i")).alias("record"))
    assert ("coverage.partial", 1) in rows(pages.coverage_metrics(df))


def test_weekday_tables():
    days = "".join(f"<th>{d}</th>" for d in pages.WEEKDAYS)
    page = f"<table><tr><th>改修する装備</th>{days}<th>二番艦</th></tr><tr><td>gun</td>{'<td>○</td>' + '<td>×</td>' * 6}<td>A *1<br>B<br>A</td></tr><tr><td>tube</td>{'<td>◯</td>' * 7}<td>-</td></tr></table>"
    assert pages.weekday_facts(page) == [{"item": "gun", "assistant": "A", "mask": 1}, {"item": "gun", "assistant": "B", "mask": 1}, {"item": "tube", "assistant": None, "mask": 127}]


# --- records -------------------------------------------------------------------------------------


def test_bonus_documents_of_any_layout(spark):
    rule = {"bonus": {"houg": 1, "odd": 2}, "shipId": [5], "requiresX": 1}
    layouts = [[{"ids": [1, "2", 1], "bonuses": [rule, {"bonus": {}}]}], {"data": [{"id": 3, "bonus": {"tyku": 1}}]}, {"types": [9, 4], "bonuses": [rule]}, {"k": {"ids": 7, "bonuses": [rule]}}, {"k": [{"ids": 8, "bonuses": [rule]}]}]
    found = []
    for layout in layouts:
        df = records.bonus_rules(records.bonus_entries(spark.createDataFrame([(json.dumps(layout),)], "j string"), "j"))
        found += [(r["ids"] or r["types"], r["bonus"], r["unknown"], r["conditions"]) for r in df.collect()]
    full = ({"firepower": 1.0}, {"odd": 2.0}, {"shipId": "[5]", "requiresX": "1"})
    assert found == [([1, 2], *full), ([3], {"antiair": 1.0}, {}, {}), ([9, 4], *full), ([7], *full), ([8], *full)]


def test_owned_items(spark):
    document = {"x": {"a": {"_api_id": 5, "_equipment": [{"equipment": "gun", "size": 3}, {"equipment": "gun", "size": 1}, {"equipment": False}]}, "b": {"_japanese_name": "B", "_remodel_from": "a", "_equipment": [{"equipment": "none"}]}}}
    slots = records.owner_nodes(spark.createDataFrame([(json.dumps(document),)], "j string"), "j")
    found, issues = records.owned_items(slots, spark.createDataFrame([("5", 5), ("B", 6)], "ref string, id long"), spark.createDataFrame([("gun", 1)], "ref string, id long"))
    record = found.first()
    assert record["item_id"] == 1 and [(s["owner"], s["method"], s["slots"], s["sizes"], s["quantity"]) for s in record["sources"]] == [(5, "initial", [0, 1], [3, 1], 2)]
    assert rows(issues) == [("unknown-item", "B", "none")]


def test_item_sources(spark):
    pairs = lambda x: spark.createDataFrame(x, "id long, source long")
    flags = lambda x: spark.createDataFrame(x, "id long, flag boolean")
    found, issues = records.item_sources(spark.range(1, 4), pairs([(1, 9), (1, 8), (1, 9)]), pairs([(2, 1)]), pairs([]), flags([(1, True), (2, False)]), flags([(1, False)]))
    assert [(r["id"], r["owners"], r["upgrades"], r["quests"], r["flag"]) for r in found.orderBy("id").collect()] == [(1, [8, 9], [], [], True), (2, [], [1], [], False)]
    assert rows(issues) == [(1, "conflicting-flag"), (2, "unchecked-flag"), (3, "missing-flag")]


def test_facts_of_routes(spark):
    df = spark.createDataFrame([(1, "r", [None, [], [5], None, None, None, None, None], [7, 7], [6])], "item_id long, route string, days array<array<long>>, targets array<long>, anchors array<long>")
    found = rows(records.facts_of_routes(df, "s"), "assistant_id", "capability", "target_id", "mask", "evidence_status")
    assert found == [(5, "improve", None, 2, "inferred"), (5, "upgrade", 7, 2, "inferred"), (None, "improve", None, 1, "explicit"), (None, "upgrade", 7, 1, "explicit")]


def test_references_and_aliases(spark):
    refs = spark.createDataFrame([(1, "q", "a"), (1, "q", "a"), (1, "q", "b"), (2, "s", "x")], "record long, kind string, ref string")
    ids, issues = records.resolve_references(refs, {"q": spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "ref string, id long"), "s": spark.createDataFrame([], "ref string, id long")})
    assert rows(ids) == [(1, "q", [1])] and rows(issues, "ref", "issue") == [("b", "ambiguous"), ("x", "unresolved")]
    aliases = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 9, None), ("c", 1, "zz")], "alias string, target long, required string")
    assert rows(records.check_aliases(aliases, spark.createDataFrame([(1, "one"), (2, "two")], "id long, name string"))) == [("a", "collision"), ("b", "unknown-target"), ("c", "required-part-missing")]
    forms = records.reference_aliases(spark.createDataFrame([(1, "p", "n", None)], "id long, path string, name string, suffix string"))
    assert rows(forms, "alias") == [("n",), ("p/n",)]


# --- sources -------------------------------------------------------------------------------------


def test_files_are_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/list.json"
    assert io.append_json_list(spark, path, [{"a": 1}]) == 1 and io.append_json_list(spark, path, [{"b": None}]) == 2
    assert json.loads(open(path).read()) == [{"a": 1}, {"b": None}]
    table = f"{tmp_path}/table"
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    assert io.write_if_changed(df, table, "id") == {"added": 2} and io.write_if_changed(df, table, "id") == {"unchanged": 2}
    (tmp_path / "table").rename(tmp_path / "table.old")  # cut off between the two steps
    assert io.write_if_changed(df, table, "id") == {"unchanged": 2} and (tmp_path / "table").exists()
    assert io.copy_files(spark, str(tmp_path), f"{tmp_path}/copy", "*.json") == ["list.json"]
    assert io.clear_folder(spark, f"{tmp_path}/copy") == ["list.json"] and io.copy_files(spark, f"{tmp_path}/none", str(tmp_path)) == []
    (tmp_path / "cat.json").write_text('[{"id": 2}, {"id": 1}]')
    assert rows(io.read_catalog(spark, f"{tmp_path}/cat.json", "id int"), "id", "pos") == [(1, 1), (2, 0)]
    assert io.read_catalog(spark, f"{tmp_path}/no.json", "id int", optional=True).count() == 0
    with pytest.raises(gates.GateError):
        io.read_catalog(spark, f"{tmp_path}/no.json", "id int")


def test_identity_of_a_folder_and_a_tarball(spark, tmp_path):
    import tarfile

    (tmp_path / "package/data").mkdir(parents=True)
    (tmp_path / "package/data/a.json").write_text('{"b": 1, "a": 2}')
    (tmp_path / "package/data/l.nedb").write_text('{"y": 1, "x": 2}\n\n{"z": 3}\n')
    (tmp_path / "package/README").write_text("r")
    with tarfile.open(tmp_path / "p.tgz", "w:gz") as archive:
        archive.add(tmp_path / "package", "package")
    of = lambda files: identity.identity(files, label="v", variant="x", prefixes=("data/",))
    digest, files = of(identity.folder_files(spark, f"{tmp_path}/package"))
    assert digest.first() == of(identity.tarball_files(spark, f"{tmp_path}/p.tgz"))[0].first()
    lines = "".join(f"{p}\0{hashlib.sha256(t.encode()).hexdigest()}\n" for p, t in (("data/a.json", '{"a":2,"b":1}\n'), ("data/l.nedb", '{"x":2,"y":1}\n{"z":3}\n')))
    assert digest.first()[0] == hashlib.sha256(("v\0x\0" + lines).encode()).hexdigest()
    identity.require_identity(files)
    with pytest.raises(gates.GateError):
        identity.require_identity(files.union(files))
    assert identity.add_release([{"version": "1.0.0"}, {"version": "0.9.0"}], {"version": "0.9.0", "d": 1}) == [{"version": "0.9.0", "d": 1}, {"version": "1.0.0"}]
    assert identity.Paths("/p/").picture("useitem", 3) == "/p/assets/useitem/3.webp"
    assert rows(identity.retired(spark.createDataFrame([("i/1",), ("i/2",), ("x",)], "path string"), spark.createDataFrame([("i/2",)], "path string"), ("i",))) == [("i/1",)]


def test_a_cache_of_pages(spark, tmp_path):
    from tessera.plans import commands
    from tessera.sources import cache

    root = str(tmp_path / "cache")
    page = "<table><tr><th>No.7</th></tr><tr><th>備考</th><td>開発可能</td></tr></table><h2>入手方法</h2><p>開発</p>"
    capture = {"cache_key": "h/a.html", "url": "https://h/a", "fetch_status": "ok", "acquisition_source": "s", "item_id": 7, "item_name": "gun", "validated_at": 5}
    cache.install_capture(spark, root, capture, b"old")
    cache.install_capture(spark, root, capture, page.encode())
    cache.install_capture(spark, root, capture | {"cache_key": "h/b.html", "item_id": 8}, page.encode())
    (tmp_path / "cache/h/b.html").write_text("changed")
    (tmp_path / "cache/h/.b.html.crc").unlink(missing_ok=True)
    with pytest.raises(gates.GateError):
        cache.install_capture(spark, root, capture | {"cache_key": "../x"}, b"")
    with pytest.raises(gates.GateError):
        cache.install_capture(spark, root, capture | {"content_sha256": "0"}, b"x")
    spark.dataSource.register(cache.PageCache)
    found = spark.read.format("page_cache").load(root)
    assert rows(found, "cache_key", "state") == [("h/a.html", "ok"), ("h/b.html", "changed")]
    metadata = spark.read.schema(io.CAPTURE).json(f"{root}/{cache.INDEX}").withColumn("pos", F.monotonically_increasing_id())
    with pytest.raises(gates.GateError):
        commands.offline_parse(spark, root, metadata, source="s")
    records_, issues = commands.offline_parse(spark, root, metadata, str(tmp_path / "out"), source="s", allow_incomplete=True)
    assert rows(records_, "item_id", "record.coverage") == [(7, "parsed")] and rows(issues, "item_id", "issue") == [(8, "changed")]
    assert json.loads((tmp_path / "out/metadata.json").read_text())["counts"] == {"coverage.parsed": 1, "methods.development": 1}
    assert commands.offline_parse(spark, root, metadata, source="s", items=[7])[0].count() == 1


def test_validate_and_build(spark, tmp_path):
    from tessera.plans import commands

    thresholds = spark.createDataFrame([("m", 3.0, None)], "metric string, minimum double, ratio double")
    counts = spark.createDataFrame([("m", 2.0)], "metric string, value double")
    bad = spark.createDataFrame([(0, "{}")], "pos int, json string")
    found = commands.validate({"drop": bad}, counts, counts, thresholds, strict=False)
    assert ("metric", "m") in rows(found) and ("drop.id", "#0") in rows(found)
    with pytest.raises(gates.GateError):
        commands.validate({}, counts, counts, thresholds)
    with pytest.raises(gates.GateError):
        commands.build(spark, {}, str(tmp_path), strict=True, status={"a": "stale"})
    manifest = commands.build(spark, {"x": spark.range(3)}, str(tmp_path / "p"), strict=True, status={"a": "fresh"})
    assert manifest["sources"] == {"a": "fresh"} and manifest["files"]


def test_stops_of_rules(spark):
    found = rules.drop_violations(spark.createDataFrame([(0, '{"equipmentId": 1, "equipmentName": "x", "sources": [{"shipId": 1, "shipName": "s", "method": "initial", "quantity": 1}]}'), (1, "no json")], "pos int, json string"))
    assert {r["key"] for r in found.collect()} == {"#1"}
    with pytest.raises(gates.GateError):
        rules.require_sound(found)
    with pytest.raises(Exception, match="wrong type of id"):
        rules.projected(spark.createDataFrame([(0, '{"id": "x"}')], "pos int, json string"), "id long").collect()


def test_json_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\nnot json\n[1]\n{"a": 2}\n')
    assert rows(io.read_json_lines(spark, str(path), "a int").where("a is not null")) == [(1,), (2,)]
    assert io.read_json_lines(spark, str(tmp_path / "none"), "a int").count() == 0
    with pytest.raises(gates.GateError, match='"line": 3'):
        io.read_json_lines(spark, str(path), "a int", strict=True).collect()
    assert rows(io.bad_json_lines(spark, str(path)), "line", "text") == [(3, "not json"), (4, "[1]")]
    io.write_json_lines(spark.createDataFrame([(1, None)], "a int, b int"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first()[0] == '{"a":1,"b":null}'


def test_documents_and_captures(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"x": [{"i": 1}, {"i": 2}], "y": [{"i": 3}]}')
    assert io.split_master(spark, str(tmp_path / "m.json"), str(tmp_path / "split")) == ["x", "y"]
    assert spark.read.schema("i int").json(str(tmp_path / "split/key=x")).count() == 2
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "p.html").write_text("page")
    sha = hashlib.sha256(b"page").hexdigest()
    meta = spark.createDataFrame([("p.html", sha), ("q.html", sha), ("../r", sha)], "cache_key string, content_sha256 string")
    assert rows(io.read_captures(spark, str(cache), meta), "cache_key", "content", "state") == [("../r", None, "outside"), ("p.html", "page", "ok"), ("q.html", None, "missing")]
    captures = spark.createDataFrame([(1, "s", 5, None, 0), (1, "s", 5, None, 1), (2, "t", 1, 1, 2)], "item_id long, acquisition_source string, fetched_at long, validated_at long, pos int")
    best, more = io.newest_captures(captures, "s")
    assert rows(best, "item_id", "pos") == [(1, 1)] and rows(more, "pos") == [(0,)]


def test_tables_are_rewritten_only_if_they_change(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert io.write_if_changed(df, path, "id") == {"added": 2}
    before = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert io.write_if_changed(df, path, "id") == {"unchanged": 2} and sorted(p.name for p in (tmp_path / "t").iterdir()) == before
    assert io.write_if_changed(df.where("id = 1"), path, "id") == {"unchanged": 1, "removed": 1}
    assert spark.read.schema(df.schema).json(path).count() == 1


def test_ids_with_several_names_and_none(spark):
    """An id that the catalog has under several names, one under none, one that it lacks."""
    catalog = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", None)], "id string, name string")
    wanted = spark.createDataFrame([(0, "1", "a"), (1, "1", "b"), (2, "1", "c"), (3, "2", None), (4, "2", "a"), (5, "3", "a"), (6, None, "a"), (7, "1", None)], "k int, id string, name string")
    found = resolve.id_and_name(wanted, catalog)
    assert found.columns == ["k", "id", "name", "state"]
    assert dict(found.select("k", "state").collect()) == {0: "ok", 1: "ok", 2: "name-mismatch", 3: "ok", 4: "name-mismatch", 5: "unknown-id", 6: "missing-id", 7: "ok"}


def test_exact_names_that_very_many_have(spark):
    """A name of 30,000 ids, each asked for by all of them: no list of a name's ids is made or joined; ties of rank by the least id, ids of null, names unknown."""
    catalog = spark.range(30_000).select(F.lit("A").alias("name"), "id", (F.col("id") % 7).cast("int").alias("rank")).union(spark.createDataFrame([("b", 5, None), ("C", 8, 3), ("c", 7, 3)], "name string, id long, rank int"))
    wanted = spark.range(30_000).select(F.lit("a").alias("name"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("image"), (F.col("id") + 29_000).alias("fallback"))
    odd = spark.createDataFrame([("B", 1, 2), ("c", 9, 8), ("c", 9, 9), ("d", 5, 5), (None, 5, 5)], "name string, image long, fallback long")
    df = resolve.choose_exact(wanted.union(odd), catalog, lambda c: F.lower(c))
    assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.columns == ["name", "image", "fallback", "id"]
    many = df.where("name = 'a'")
    assert many.count() == 30_000 and many.where("id <> case when image is not null then image when fallback < 30000 then fallback else 0 end").count() == 0
    assert sorted(((r["name"], r["fallback"], r["id"]) for r in df.where("name is null or name <> 'a'").collect()), key=repr) == [("B", 2, 5), ("c", 8, 8), ("c", 9, 7), ("d", 5, None), (None, 5, None)]


def test_page_records_are_made_by_all_tasks(spark, sf, tmp_path):
    """The table of parts is one small file and one split; its pages are made and read in as many tasks as the session has."""
    from tessera.plans.queries import QUERIES

    spark.read.parquet(f"{sf}/part.parquet").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    found = QUERIES["page_records"](spark, str(tmp_path))
    tasks = found.select("k", F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 100 and sum(r["count"] for r in tasks) == 200


def test_owners_are_walked_once(spark):
    """What reads the slots doesn't walk the documents again; slots of owners below others, of objects in place of lists, and of owners without a name."""
    inner = {"_japanese_name": "in", "_remodel_from": "out", "_equipment": {"b": {"equipment": "q", "size": 4}, "a": {"equipment": "p"}}}
    document = {"deep": [1, [{"_api_id": 1, "_equipment": [{"equipment": "gun"}, None, 3, {"equipment": "x", "size": 2, "more": inner}]}]], "_equipment": [{"equipment": "nobody's"}], "none": {"_api_id": 2, "_equipment": None}}
    slots = records.owner_nodes(spark.createDataFrame([(json.dumps(document),), ("{",), (None,)], "j string"), "j")
    assert "Generate" not in slots._jdf.queryExecution().executedPlan().toString()
    found = [tuple(r) for r in slots.select("owner_ref", "remodel_from", "slot", "item_ref", "size").collect()]
    assert sorted(found, key=repr) == sorted([("1", None, 0, "gun", 0), ("1", None, 1, None, 0), ("1", None, 2, None, 0), ("1", None, 3, "x", 2), ("in", "out", 0, "p", 0), ("in", "out", 1, "q", 4)], key=repr)
