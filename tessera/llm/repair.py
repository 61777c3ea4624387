"""Repair of the structure of conversations: the cheapest edits after which roles follow the grammar ``(s?(ua)+)?``.

Each row of a conversation is kept (free), given the role of user or assistant (1) or deleted (2; blank rows and repetitions have to
be); empty turns of the user or the assistant can be inserted anywhere (5); a row without an end costs 5 more unless it is
deleted. Of equally cheap ways the one whose edits' initials are least wins.

Rows are cut into pieces of one conversation and a range of ``BLOCK`` turns, and dealt by a hash of both, so that a long
conversation is many pieces. In each partition DuckDB runs one recursive query over a batch of pieces: every round of the recursion takes one
row of all pieces and keeps, for each state of the grammar that a piece may begin in and each that it has come to, the
least cost and its audit (the initials of the edits). Pieces of a conversation are then joined in order: four states each, whatever
their length. The result is right because no audit of the same rows begins another: all end with a row's own edit.

``repaired_rows`` goes through rows and audits in one sorted pass, row by row, with bounded memory.

Order of rows: by turn, nulls first; rows of one turn by role and a hash of the text, so equal rows lie side by side and are
counted, not repeated, up to the last step. Defined cases: null ids, roles and texts are one space; a role of which the grammar
doesn't know the initial, or an empty one, can't be kept; rows of one conversation, turn, role and text are repetitions of the first; a conversation
of which no row is left has an empty audit and costs 0; texts may have any length; an empty table gives an
empty result; other columns are not looked at. Turns below ``BLOCK`` are one piece, as are all rows of one turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, small_batches

BLOCK = 1024
BATCH_ROWS = 20_000
_BLANKS = " \t\n\x0b\x0c\r"
_FIRST = -(1 << 63)
# States of the grammar: nothing yet, after the system's turn, after the user's, after the assistant's.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ENDS = (0, 3)
_INSERT, _DELETE, _REROLE, _UNENDED = 5, 2, 1, 5


def _inserted(state: int) -> dict[int, int]:
    """States that insertions lead to, with how many there are."""
    found, at = {state: 0}, state
    while (at := _NEXT[at, "a" if at == 2 else "u"]) not in found:
        found[at] = len(found)
    return found


def _moves() -> list[tuple[int, int, str, str, int]]:
    """(state, state after, initial of the role or ``*`` for any, edits, cost) of a row; a deletion is ``D``."""
    out = [(p, p, "*", "D", _DELETE) for p in range(4)]
    for p in range(4):
        for q, n in _inserted(p).items():
            for x in "sua":
                if (q, x) in _NEXT:
                    out.append((p, _NEXT[q, x], x, "I" * n + "K", _INSERT * n))
                    if x != "s":
                        out.append((p, _NEXT[q, x], "*", "I" * n + "R", _INSERT * n + _REROLE))
    return out


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """(c, turn, role, text, n): the rows after the damage of the contract, by crc32 of ``conv_id:turn``; ``n`` copies of each."""
    kind = F.pmod(F.crc32(F.concat(_key("conv_id"), F.lit(":"), _key("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(_key("text"), ".!?", "")).otherwise(_key("text"))
    role = F.when(kind == 4, "user").otherwise(_key("role"))
    return conversations.where(kind != 0).select(_key("conv_id").alias("c"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """(c, turn, role, text, n): the rows as they are."""
    return conversations.select(_key("conv_id").alias("c"), F.col("turn").cast("long").alias("turn"), _key("role").alias("role"), _key("text").alias("text"), F.lit(1).cast("long").alias("n"))


def _order(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"place": F.coalesce("turn", F.lit(_FIRST)), "t": F.substring(F.unhex(F.sha2("text", 256)), 1, 16)})


def faults(rows: DataFrame) -> DataFrame:
    """(c, block, place, turn, role, t, n, blank, truncated, seen) of the distinct rows; ``seen``: the first was in an earlier turn."""
    bare = F.btrim("text", F.lit(_BLANKS))
    own = _order(rows).select("c", "place", "turn", "role", "t", "n", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    own = own.groupBy("c", "place", "turn", "role", "t", "blank", "truncated").agg(F.sum("n").alias("n"))
    firsts = own.groupBy("c", "role", "t").agg(F.min("place").alias("first"))
    block = F.greatest(F.floor(F.coalesce("turn", F.lit(0)) / BLOCK), F.lit(0)).cast("long")
    return own.join(firsts, ["c", "role", "t"]).select("c", block.alias("block"), "place", "turn", "role", "t", "n", "blank", "truncated", (F.col("place") > F.col("first")).alias("seen"))


_PREPARE = """
create or replace temp table r as
  select *, substr(role, 1, 1) as x, blank or seen as must, row_number() over (partition by c, block order by place, role, t) as i, dense_rank() over (order by c, block) as f from rows
"""
_PATHS = """
with recursive dp(f, s, e, i, cost, audit) using key (f, s, e) as (
  select f, s, s, 0::bigint, 0::bigint, '' from (select distinct f, block from r), range(4) as starts(s) where s = 0 or block > 0
  union
  select f, s, e2, i, w.cost, w.audit from (
    select dp.f, dp.s, m.e as e2, r.i, min({'cost': dp.cost + case when r.must then 2 * r.n else m.cost + 2 * (r.n - 1) + case when r.truncated and m.edits <> 'D' then 5 else 0 end end,
      'audit': dp.audit || m.edits || repeat('D', r.n - 1)}) as w
    from dp join r on r.f = dp.f and r.i = dp.i + 1 join moves m on m.p = dp.e and (m.x = '*' or m.x = r.x) and (m.edits = 'D' or not r.must)
    group by all))
select r.c, r.block, p.s::int as s, p.e::int as e, p.cost, p.audit from dp p join (select f, any_value(c) as c, any_value(block) as block from r group by f) r using (f)
"""
_STATS = """
select c, block, sum(n) filter (blank)::bigint as blank, sum(case when blank then 0 when seen then n else n - 1 end)::bigint as duplicate,
  count(*) filter (truncated and not must) as truncated,
  sum(n - 1 + (before is not null and before || x not in ('su', 'ua', 'au'))::int)::bigint as illegal,
  arg_min(x, i) as head, arg_max(x, i) as tail, min(turn) as low, max(turn) as high, count(distinct turn) as turns
from (select *, lag(x) over (partition by f order by i) as before from r) group by c, block
"""
_PIECE = "c string, block long, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turns long, paths array<struct<s:int,e:int,cost:long,audit:string>>"


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of about ``size`` rows, cut between pieces; rows come sorted by ``c`` and ``block``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            table = pa.Table.from_batches(held)
            last = table.num_rows - 1
            same = pc.and_(pc.equal(table["c"], table["c"][last]), pc.equal(table["block"], table["block"][last]))
            start = pc.index(same, pa.scalar(True)).as_py()
            if start:
                yield table.slice(0, start)
                held = table.slice(start).combine_chunks().to_batches()
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def pieces(found: DataFrame, *, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """For each piece its counts and, by the states that it begins and ends in, the least cost and audit."""
    small_batches(found.sparkSession)
    moves = pa.table(dict(zip(("p", "e", "x", "edits", "cost"), map(list, zip(*_moves())))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "1GB"}) as duck:
            duck.register("moves", moves)
            for table in _batches(batches, batch_rows):
                duck.register("rows", table)
                duck.execute(_PREPARE)
                names = ["c", "block", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "turns", "paths"]
                joined = duck.sql(f"with p as ({_PATHS}), s as ({_STATS}), l as (select c, block, list({{'s': s, 'e': e, 'cost': cost, 'audit': audit}}) as paths from p group by c, block) select s.*, paths from s join l using (c, block)").to_arrow_table()
                for batch in joined.select(names).set_column(2, "blank", pc.fill_null(joined["blank"], 0)).to_batches(1000):
                    yield batch

    return found.repartition("c", "block").sortWithinPartitions("c", "block").mapInArrow(run, _PIECE)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of whole conversations in order, put together: counts are added, paths go from state to state."""
    names = ("c", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    out: list[tuple] = []
    now, reached, parts, sums, spread, tail = None, {}, [], [0] * 4, [], ""

    def close() -> None:
        options = []
        for e, (cost, _) in reached.items():
            n = 0 if e in _ENDS else _inserted(e)[3]
            options.append((cost + _INSERT * n, audit_of(e) + "I" * n))
        cost, audit = min(options)
        low, high, turns = [x for x, _, _ in spread if x is not None], [x for _, x, _ in spread if x is not None], sum(x for _, _, x in spread)
        out.append((now, max(high) - min(low) + 1 - turns if low else 0, *sums, cost, audit))

    def audit_of(state: int) -> str:
        """The audit of the best way to a state, put together from its pieces' once."""
        found = []
        for step in reversed(parts):
            before, audit = step[state]
            found.append(audit)
            state = before
        return "".join(reversed(found))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out))
        batch = pa.RecordBatch.from_arrays([pa.array(x, pa.string() if n in ("c", "audit") else pa.int64()) for n, x in zip(names, columns)], names=list(names))
        out.clear()
        return batch

    for batch in batches:
        for row in batch.to_pylist():
            if row["c"] != now:
                if now is not None:
                    close()
                now, reached, parts, sums, spread, tail = row["c"], {0: (0, 0)}, [], [0] * 4, [], None
            if tail is not None and tail + row["head"] not in ("su", "ua", "au"):
                sums[3] += 1
            tail = row["tail"]
            for k, n in enumerate(("blank", "duplicate", "truncated", "illegal")):
                sums[k] += row[n]
            spread.append((row["low"], row["high"], row["turns"]))
            # ways to a state are told apart by cost, the order of the audits so far, and the piece's own audit
            ways: dict[int, list] = {}
            for p in row["paths"]:
                if p["s"] in reached:
                    cost, rank = reached[p["s"]]
                    ways.setdefault(p["e"], []).append((cost + p["cost"], rank, p["audit"], p["s"]))
            best = {e: min(w) for e, w in ways.items()}
            ranks = {key: k for k, key in enumerate(sorted({w[1:3] for w in best.values()}))}
            reached = {e: (w[0], ranks[w[1:3]]) for e, w in best.items()}
            parts.append({e: (w[3], w[2]) for e, w in best.items()})
            if len(out) >= 1000:
                yield flush()
    if now is not None:
        close()
    if out:
        yield flush()


def audits(rows: DataFrame, **options) -> DataFrame:
    """(c, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation that has rows (c, turn, role, text, n)."""
    small_batches(rows.sparkSession)
    found = pieces(faults(rows), **options)
    return found.repartition("c").sortWithinPartitions("c", "block").mapInArrow(_joined, "c string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None, str | None]]:
    """(c, edit, role, text) of each edit in order; deleted rows have neither role nor text. An edit of None begins a conversation.

    Each conversation's audit comes before its rows.
    """
    audit, at, state = "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at : at + 1] == "I":
            role = "assistant" if state == 2 else "user"
            state = _NEXT[state, role[0]]
            at += 1
            yield "I", role, ""

    now = None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("c", "kind", "role", "text", "n")]
        for c, kind, role, text, n in zip(*columns):
            if kind == 0:
                if now is not None:
                    yield from ((now, *x) for x in inserted())
                now, audit, at, state = c, text, 0, 0
                yield c, None, None, None
                continue
            for _ in range(n):
                yield from ((c, *x) for x in inserted())
                edit = audit[at]
                at += 1
                if edit == "D":
                    yield c, edit, None, None
                    continue
                own = role if edit == "K" else "assistant" if state == 2 else "user"
                state = _NEXT[state, own[0]]
                yield c, edit, own, text
    if now is not None:
        yield from ((now, *x) for x in inserted())


def _with_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and, before them, the audit of each conversation, in order within a partition."""
    small_batches(rows.sparkSession)
    none = F.lit(None)
    heads = found.select("c", F.lit(0).alias("kind"), none.cast("long").alias("place"), none.cast("string").alias("role"), none.cast("binary").alias("t"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("n"))
    own = _order(rows).select("c", F.lit(1).alias("kind"), "place", "role", "t", "text", "n")
    return heads.unionAll(own).repartition("c").sortWithinPartitions("c", "kind", "place", "role", "t")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[str, str]] = []
    now, running, first = None, None, True

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (0, 1)], names=["c", "repaired_sha256"])
        out.clear()
        return batch

    for c, edit, role, text in _walk(batches):
        if edit is None:
            if now is not None:
                out.append((now, running.hexdigest()))
            now, running, first = c, hashlib.sha256(), True
            if len(out) >= 1000:
                yield flush()
        elif edit != "D":
            running.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
            first = False
    if now is not None:
        out.append((now, running.hexdigest()))
    if out:
        yield flush()


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "place", "edit", "role", "text"]
    out: list[tuple] = []
    place, size = 0, 0

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64() if k == 1 else pa.string()) for k in range(5)], names=names)
        out.clear()
        return batch

    for c, edit, role, text in _walk(batches):
        if edit is None:
            place = 0
        elif edit != "D":
            out.append((c, place, edit, role, text))
            place, size = place + 1, size + len(text)
            if len(out) >= 1000 or size >= 1_000_000:
                size = 0
                yield flush()
    if out:
        yield flush()


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id as text, place, edit, role, text): the repaired conversations; ``edit`` is K, R or I."""
    return _with_audits(rows, found).mapInArrow(_rows_out, "conv_id string, place long, edit string, role string, text string")


def repair(conversations: DataFrame, **options) -> DataFrame:
    """The repaired rows of conversations as they are."""
    rows = as_rows(conversations)
    return repaired_rows(rows, materialise(audits(rows, **options), "audits"))


def damage_and_repair(conversations: DataFrame, **options) -> DataFrame:
    """One row for each original conversation: counts of faults, the cost, the audit and a digest of the repaired rows."""
    rows = damage(conversations)
    found = materialise(audits(rows, **options), "audits")
    digests = _with_audits(rows, found).mapInArrow(_digest, "c string, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct().withColumn("c", _key("conv_id"))
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return ids.join(found, "c", "left").join(digests, "c", "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
