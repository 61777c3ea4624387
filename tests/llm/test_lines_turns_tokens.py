"""Line dedup, conversation repair and token alignment: small cases with defined results, and plain versions."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from tessera.llm import align, linededup, queries, repair
from tests.llm.test_operators import LONG, ODD, PROSE, empty, odd  # noqa: F401

BLANKS = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# --- 11 line dedup -------------------------------------------------------------------------------


def plain_lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    place = lambda i: -(1 << 63) if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(BLANKS))].add(place(i))
    gone = {k: max(d) for k, d in holders.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(lower(x.strip(BLANKS)), place(i)) <= place(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return out


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("sample, hot", [(16, 1024), (1, 1 << 20), (1, 40)])
def test_lines_are_those_of_brute_force(spark, sf, monkeypatch, sample, hot):
    """Also where many keys are told apart as hot, and are put together from several ranges."""
    monkeypatch.setattr(linededup, "SAMPLE", sample)
    monkeypatch.setattr(linededup, "HOT", hot)
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    found = [tuple(r) for r in linededup.line_digests(docs).collect()]
    assert by_key(found) == by_key(r[:4] for r in plain_lines([(r["doc_id"], r["text"]) for r in docs.collect()]))


@pytest.mark.parametrize("min_docs", [1, 2, 3, 5])
def test_lines_of_small_documents(spark, monkeypatch, min_docs):
    monkeypatch.setattr(linededup, "SAMPLE", 1)
    rng = random.Random(min_docs)
    stock = ["", "  ", "short", "A line of twenty char", " a LINE of twenty char\t", "x" * 19, "é" * 20, "É" * 20, "y" * 20, "\x0by" + "y" * 19 + "\r", "tail line that is long enough"]
    rows = [(rng.choice([None, *range(12)]), "\n".join(rng.choices(stock, k=rng.randrange(9))) or None) for _ in range(60)]
    rows += [(100, "\n".join(["y" * 20] * 50)), (101, "y" * 20)]
    wanted = plain_lines(rows, min_docs=min_docs)
    docs = spark.createDataFrame([(i, t, "kept", 7) for i, t in rows], "doc_id long, text string, _text string, pos int").repartition(5)
    assert by_key(tuple(r) for r in linededup.line_digests(docs, min_docs=min_docs).collect()) == by_key(r[:4] for r in wanted)
    out = linededup.drop_lines(docs, min_docs=min_docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"] or "", r["_text"], r["pos"]) for r in out.collect()) == Counter((r[0], r[4], "kept", 7) for r in wanted)


def test_a_line_of_all_documents_is_several_ranges(spark):
    """A third of all lines are one, in files of their own; its key is known to be hot and no task has all of it."""
    rows = [(i, "the very same licence line\n" + f"a line of its own, number {i}\n" * 2) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    occ = linededup.materialise(linededup.occurrences(docs), "t")
    hot = {bytes(r["h"]) for r in linededup._hot_keys(occ).collect()}
    assert hashlib.sha256(b"the very same licence line").digest()[:16] in hot and len(hot) <= linededup.HOT and occ.select("part").distinct().count() >= 2
    found = {r["doc_id"]: r["n_dropped"] for r in linededup.line_digests(docs).collect()}
    assert found == {i: int(i < 2999) for i in range(3000)}


def test_bitmaps_are_runs(spark):
    line = "a line that is in all of them"
    rows = [(i, f"first {i} of the document here\n{line}\n{line}\nlast\n{line}") for i in range(3)]
    maps = linededup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["d"], tuple(r["runs"])) for r in maps.collect()} == {(0, (1, 2, 1, 1)), (1, (1, 2, 1, 1))}


def test_lines_of_odd_rows(odd, empty):  # noqa: F811
    rows = [tuple(r) for r in linededup.line_digests(odd).collect()]
    assert by_key(rows) == by_key(r[:4] for r in plain_lines([(i, t) for i, t, _, _ in ODD]))
    assert linededup.line_digests(empty).count() == 0 and linededup.drop_lines(odd).columns == odd.columns


def test_line_dedup_runs_no_python(spark, sf):
    plan = linededup.line_digests(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 12 conversation repair ----------------------------------------------------------------------


def plain_damage(rows):
    out = defaultdict(list)
    text = lambda x: " " if x is None else str(x)
    for conv, turn, role, words in rows:
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, words = text(role), text(words)
        if kind:
            words = "" if kind == 1 else re.sub("[.!?]", "", words) if kind == 2 else words
            out[conv] += [(turn, "user" if kind == 4 else role, words)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(rows):
    """The cheapest and least of all ways that put up to two turns at each place, by trying them."""
    best = None
    added = ["", "u", "a", "ua", "au"]
    choices = [["D"] if f in ("b", "d") else ["K", "Ru", "Ra", "D"] for f in faults_of(rows)]
    for edits in itertools.product(*choices):
        for places in itertools.product(added, repeat=len(rows) + 1):
            initials, audit, cost, out = "", "", 0, []
            for k in range(len(rows) + 1):
                for x in places[k]:
                    initials, audit, cost = initials + x, audit + "I", cost + 5
                    out.append(("user" if x == "u" else "assistant") + ":")
                if k < len(rows):
                    _, role, text = rows[k]
                    audit += edits[k][0]
                    if edits[k] == "D":
                        cost += 2
                        continue
                    own = role if edits[k] == "K" else "user" if edits[k] == "Ru" else "assistant"
                    initials += own[:1] or "?"
                    cost += (edits[k] != "K") + 5 * (faults_of(rows)[k] == "t")
                    out.append(f"{own}:{text}")
            if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return best


def plain_repair(rows, ways):
    rows = in_order(rows)
    if not rows:
        return (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    turns = [r[0] for r in rows if r[0] is not None]
    found = Counter(faults_of(rows))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found["b"], found["d"], found["t"], illegal, *ways(rows))


def random_conversations(seed, conversations, longest):
    rng = random.Random(seed)
    out = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.1 else t + rng.choice([0, 0, 0, 1])
            out.append((None if c == 0 else c, turn, rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rng.choice(["Yes.", "No", None, " \t", "", "Why?", "Well!", "so it goes."])))
    return out


def found_repairs(spark, rows, **options):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return {r["conv_id"]: tuple(r)[1:] for r in repair.damage_and_repair(frame, **options).collect()}


@pytest.mark.parametrize("block, batch", [(1024, 20_000), (1, 1), (2, 3)])
def test_repairs_are_the_cheapest_and_least_of_all(spark, monkeypatch, block, batch):
    """However conversations are cut into pieces."""
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = random_conversations(3, 40, 3)
    damaged = plain_damage(rows)
    short = {c for c in {r[0] for r in rows} if len(damaged[c]) <= 3}
    found = found_repairs(spark, rows, batch_rows=batch)
    assert found.keys() == {r[0] for r in rows} and len(short) > 30
    for c in short:
        assert found[c] == plain_repair(damaged[c], all_repairs), (c, damaged[c])


def test_pieces_of_any_size_give_the_same(spark, monkeypatch):
    rows = random_conversations(5, 25, 60)
    whole = found_repairs(spark, rows)
    for block, batch in ((1, 5), (7, 50)):
        monkeypatch.setattr(repair, "BLOCK", block)
        assert found_repairs(spark, rows, batch_rows=batch) == whole


def test_repairs_are_those_of_the_sql(spark, sf):
    """The registered SQL goes over whole conversations, on rows with faults of all kinds."""
    rows = [(c, t, r, x) for c, t, r, x in random_conversations(8, 60, 12) if c is not None]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    with duckdb.connect() as duck:
        duck.register("conversations", frame.toArrow())
        wanted = {r[0]: tuple(r[1:]) for r in duck.execute(queries.oracle_sql()["op12_conversation_repair"]).fetchall()}
    assert found_repairs(spark, rows) == wanted


def test_a_long_conversation_is_many_pieces(spark):
    """5,000 turns and 300 copies of one; the audit and the repaired rows fit together."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(5000)] + [(1, 17, "user", "again and again.")] * 300 + [(2, 0, "user", "Alone.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    parts = repair.faults(repair.as_rows(frame))
    assert parts.select("c", "block").distinct().count() == 6
    out = repair.repair(frame).collect()
    one = sorted(((r["place"], r["edit"], r["role"], r["text"]) for r in out if r["conv_id"] == "1"))
    assert [r[2] for r in one] == ["user", "assistant"] * (len(one) // 2) and len(one) == 5000
    assert [(r["role"], r["text"], r["edit"]) for r in sorted(out, key=lambda r: r["place"]) if r["conv_id"] == "2"] == [("user", "Alone.", "K"), ("assistant", "", "I")] or not [r for r in out if r["conv_id"] == "2"]


def test_conversations_of_odd_rows(spark):
    rows = [(None, None, None, None), (1, None, "user", "Hi."), (1, 3, "user", "Hi."), (1, 3, "assistant", LONG + "."), (2, 1, "", ""), (3, -5, "system", "Be good."), (3, -4, "user", "x" * 100_000 + "?"), (3, 9, "assistant", "Yes!")]
    frame = spark.createDataFrame([(*r, "z", 1, "q") for r in rows], "conv_id long, turn long, role string, text string, c string, n int, audit string")
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.damage_and_repair(frame).collect()}
    damaged = plain_damage(rows)
    assert found == {c: plain_repair(damaged[c], all_repairs) for c in (None, 1, 2, 3)}
    assert repair.damage_and_repair(frame.limit(0)).count() == 0 and repair.repair(frame.limit(0)).count() == 0


# --- 13 token alignment --------------------------------------------------------------------------

STRANGE = [
    "<|endoftext|> and <s> </s> <unk> as text", "a\n  b\n\n c\t d  ", "  two spaces  before   and after  ", " ", "\n", "wide　space  nbsp  em  line",
    "low▁mark", "你好 世界 汉字很多很多", "emoji 🙂🙃 👩‍👩‍👧 ok", "nul\x00 byte \x1c sep \x1f end", "é é Å Å", "it's we'll I'd 'quoted' don't", "12345 6,789.01 $5", "x" * 5000, "ab " * 3000,
    "tail   thin", "\u0085 next line \u0085x", "mixed  space", "…” ’quotes’ — dash", "﻿bom � replacement",
]


def plain_alignment(texts):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names, letters = {i: w for w, i in a_model.get_vocab().items()}, align._byte_of_letter()
    counts, rows = Counter(), []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        sides = [[bytes(letters[c] for c in names[i]) for i in a], [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b_model.id_to_piece, b)]]
        if any(b"".join(s) != (" " + text).encode() for s in sides):
            rows.append(None)
            continue
        ends = [list(itertools.accumulate(map(len, s))) for s in sides]
        at = dict(zip(ends[1], b))  # no token is without bytes, so one of B ends at a place
        links = [(x, at[e]) for x, e in zip(a, ends[0]) if e in at]
        cuts, parts = sorted(set(ends[0]) & set(ends[1])), []
        for ids, es in zip((a, b), ends):
            own = defaultdict(list)
            for i, e in zip(ids, es):
                own[bisect.bisect_left(cuts, e)].append(str(i))
            parts.append([",".join(own[k]) for k in range(len(cuts))])
        groups = ["|".join(x) for x in zip(*parts)]
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (0,) * 6 + ("",) if r is None else (r[0], r[1], r[2], len(r[3]), sum(counts[p] == best[p[1]] for p in r[3]), sum(counts[p] for p in r[3]), hashlib.sha256(r[4].encode()).hexdigest())
        for r in rows
    ]


def test_alignments_are_those_of_whole_texts(spark, sf, monkeypatch):
    monkeypatch.setattr(align, "AT_ONCE", 7)
    texts = [r["text"][:3000] if r["text"] else r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()] + STRANGE + [None, "", PROSE, PROSE]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: tuple(r)[1:] for r in align.align(docs).collect()}
    wanted = dict(enumerate(plain_alignment(texts)))
    assert [i for i in wanted if found[i] != wanted[i]] == []
    assert sum(not w[0] for w in wanted.values()) >= 3


def test_random_texts_are_cut_where_nothing_is_joined():
    rng = random.Random(4)
    letters = ["a", "Zz", " ", "  ", "\n", "\t", " ", " ", "'s", "é", "你", "1", ".", "🙂", "́", "\x1d", "　", "​", "▁", "᠎"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(3000)]
    import pyarrow as pa

    aligner = align.Aligner(*align.tokenizer_paths())
    numbers, begins = aligner.read(pa.array(texts))
    for k, (text, row) in enumerate(zip(texts, plain_alignment(texts))):
        own = ";".join(aligner.groups[i] for i in numbers[begins[k] : begins[k + 1]])
        assert (hashlib.sha256(own.encode()).hexdigest() if own else "") == row[6], repr(text)


def test_what_is_remembered_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(align, "MEMO", 50)
    texts = [f"word{i} and other{i % 7} words {i * 31}" for i in range(300)]
    monkeypatch.setattr(align, "_aligners", {})
    aligner = align.Aligner(*align.tokenizer_paths())
    import pyarrow as pa

    parts = []
    for k in range(0, 300, 20):
        if aligner.full:
            aligner.clear()
        numbers, begins = aligner.read(pa.array(texts[k : k + 20]))
        parts += [";".join(aligner.groups[i] for i in numbers[a:b]) for a, b in zip(begins, begins[1:])]
        assert len(aligner.groups) <= 50 + 20 * 5
    assert [hashlib.sha256(p.encode()).hexdigest() for p in parts] == [r[6] for r in plain_alignment(texts)]


def test_alignments_of_odd_rows(odd, empty):  # noqa: F811
    rows = [tuple(r) for r in align.align(odd).collect()]
    wanted = plain_alignment([t for _, t, _, _ in ODD])
    assert by_key(rows) == by_key((i, *w) for (i, *_), w in zip(ODD, wanted))
    assert align.align(empty).count() == 0
    spans = align.groups(odd.where("doc_id = 6")).collect()
    assert [r["place"] for r in spans] == list(range(len(spans))) and sum(len(r["a_ids"]) for r in spans) == [w for (i, *_), w in zip(ODD, wanted) if i == 6][0][0]


def test_other_tokenizers_are_given_whole_texts(monkeypatch):
    import pyarrow as pa

    aligner = align.Aligner(*align.tokenizer_paths())
    texts = [t for t in STRANGE if len(t) < 200]
    wanted = plain_alignment(texts)
    monkeypatch.setattr(aligner.tokenizers, "local", False)
    numbers, begins = aligner.read(pa.array(texts))
    assert [hashlib.sha256(aligner.groups[numbers[a]].encode()).hexdigest() if b > a else "" for a, b in zip(begins, begins[1:])] == [w[6] for w in wanted]
