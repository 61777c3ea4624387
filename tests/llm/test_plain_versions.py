"""Plain versions of what SQL cannot say: language models by loops over all segmentations, secrets of texts whose assignments are known."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import langid, secrets
from tests.llm.test_operators import lower


def plain_pieces():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=langid.piece_model_path())
    texts = {model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    return {t for t in texts if t and re.fullmatch(b" ?[a-z\x80-\xff]+", t)} | {b" "}


def segments(word, probability):
    """(begin, end, piece, probability) of all pieces anywhere in a word; a byte that is no piece stands for itself."""
    out = []
    for a in range(len(word)):
        for b in range(a + 1, min(len(word), a + 40) + 1):
            piece = word[a:b]
            if piece in probability or b == a + 1:
                out.append((a, b, piece, probability.get(piece, langid.FLOOR)))
    return out


def sums(word, probability):
    """Sums over all segmentations of each beginning and each ending of a word."""
    parts = segments(word, probability)
    ahead, behind = [1.0] + [0.0] * len(word), [0.0] * len(word) + [1.0]
    for a, b, _, p in sorted(parts, key=lambda s: s[1]):
        ahead[b] += ahead[a] * p
    for a, b, _, p in sorted(parts, key=lambda s: -s[0]):
        behind[a] += p * behind[b]
    return parts, ahead, behind


def words_of(text):
    return [b" " + w for w in re.findall(b"[a-z\x80-\xff]+", lower(text).encode())]


def plain_model(texts, pieces, rounds=4):
    counts = Counter(w for t in texts for w in words_of(t))
    probability = dict.fromkeys(pieces, 1 / len(pieces))
    for _ in range(rounds):
        expected = defaultdict(float)
        for word, n in counts.items():
            parts, ahead, behind = sums(word, probability)
            for a, b, piece, p in parts:
                if piece in probability:
                    expected[piece] += n * ahead[a] * p * behind[b] / ahead[-1]
        total = sum(expected.values()) + 0.1 * len(pieces)
        probability = {t: max((expected[t] + 0.1) / total, langid.FLOOR / 100) for t in pieces}
    return probability


def test_languages_are_those_of_plain_models(spark):
    """Every piece, every segmentation and all four rounds, by loops; words with bytes that no piece has among them."""
    stock = {"aa": "the water house was old stone and the river ran", "bb": "das wasser haus war alt stein und der fluß lief", "cc": "вода дом был стар камень и река текла 鿕鿖"}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(stock[x].split(), k=9)) + rng.choice(["", " 12", "!"]), x) for i in range(30) for x in [rng.choice(sorted(stock))]]
    rows += [(100, "water stein река", None), (101, "", "aa"), (102, None, None), (103, "42 ?!", "bb"), (104, "鿕鿖 Stone", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    languages, table = langid.train(docs)
    pieces = plain_pieces()
    vocabulary = langid.pieces(langid.piece_model_path())
    assert languages == sorted(stock) and vocabulary.first_byte - 1 == len(pieces)
    models = {x: plain_model([t for _, t, y in rows if y == x and t], pieces) for x in languages}
    number = {t: k for k, t in enumerate(sorted(pieces), 1)}
    for k, x in enumerate(languages):
        assert np.allclose([table[number[t], k] for t in pieces], [models[x][t] for t in pieces], rtol=1e-4)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, languages, table).collect()}
    for i, text, _ in rows:
        logs = [sum(math.log(sums(w, models[x])[1][-1]) for w in words_of(text or "")) for x in languages]
        if not re.search(r"[^\W\d_]", text or ""):
            assert found[i] == ("und", 0.0)
            continue
        best = max(logs)
        assert found[i][0] == languages[logs.index(best)] and math.isclose(found[i][1], 1 / sum(math.exp(v - best) for v in logs), abs_tol=1e-3)


def known_text(rng):
    """A text of assignments in several syntaxes, each name given once, and which literals its names make secrets."""
    sensitive, harmless = ["db_password", "apiSecret", "client-secret", "AUTH_TOKEN", "user.passwd", "signingKey"], ["title", "colour", "page_count", "token_count", "password_hint", "labelText"]
    rng.shuffle(sensitive), rng.shuffle(harmless)
    text, literals, given, refers = "", [], {}, []

    def value():
        return rng.choice(["aB3xK9mQ2w", "hunter2horse", "changeme", "zZ9-kkLm2Qr8", "abcdef", "x9", "p@ssw0rd!Z", "example", "q1w2e3r4t5y6"])

    for k, name in enumerate(sensitive[: rng.randrange(1, 4)] + harmless[: rng.randrange(4)] + [f"c{j}" for j in range(rng.randrange(3))]):
        constants = [c for c in given if re.fullmatch(r"c\d", c)]
        plain = re.fullmatch(r"[A-Za-z_]\w*", name)
        if constants and plain and not name.startswith("c") and rng.random() < 0.4:
            other = rng.choice(constants)
            text += f"{name} = {other}\n"
            refers.append((name, other))
            continue
        literal, quote = value(), rng.choice("\"'")
        lead = rng.choice(["", "  ", "\t"])
        form = rng.choice(["{n} = {q}", "{n}={q}", "{n}: {q}", '"{n}": {q},', "{n} := {q}", "{n} => {q}"])
        head, tail = (lead + form).replace("{n}", name).split("{q}")
        start = len(text) + len(head) + 1
        text += f"{head}{quote}{literal}{quote}{tail}\n" + rng.choice(["", "# a note\n", "\n", "plain words only\n"])
        given[name] = (start, start + len(literal), literal)
        literals.append((start, start + len(literal), literal, name))
    names = {(a, b, x): {n} for a, b, x, n in literals}
    for name, other in refers:
        names[given[other]].add(name)
    return text, sorted((a, b) for (a, b, x), of in names.items() if max(map(secrets.name_score, of)) and max(map(secrets.name_score, of)) * secrets.literal_score(x) >= secrets.THRESHOLD)


@pytest.mark.parametrize("seed", range(4))
def test_secrets_are_those_of_known_assignments(seed):
    rng = random.Random(seed)
    some = 0
    for _ in range(400):
        text, wanted = known_text(rng)
        assert secrets.lex(text.encode()) == wanted, text
        some += len(wanted)
    assert some > 150


def test_short_parts_are_named_and_compared_as_numbers(monkeypatch):
    """Only parts of over eight bytes are gone through byte by byte; parts that differ in any byte are told apart."""
    from tessera.llm import tokens, words

    pieces = [b"a", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefghj", b"abcdefghijklmnopqrstuvw", b"abcdefghijklmnopqrstuvx", b"a", b"abcdefghi"]
    raw = np.frombuffer(b" ".join(pieces), np.uint8)
    units = words.split(raw, np.array([0, len(raw)]), words.NOT_SPACE)
    length, seen = units.ends - units.starts, []
    monkeypatch.setattr(tokens, "fingerprints", lambda t, a, b: seen.extend((b - a).tolist()) or words.fingerprints(t, a, b))
    prints = tokens._prints(units, length)
    assert sorted(seen) == [9, 9, 9, 23, 23] and len(set(prints.tolist())) == 7 and prints[0] == prints[7] and prints[3] == prints[8]
    for others, same in ((list(range(9)), True), ([7, 1, 2, 8, 4, 5, 6, 0, 3], True), ([0, 1, 2, 4, 4, 5, 6, 7, 8], False), ([0, 1, 2, 3, 4, 6, 6, 7, 8], False), ([1, 1, 2, 3, 4, 5, 6, 7, 8], False)):
        assert words.same_bytes(units.text, units.starts, length, np.array(others)) == same
    assert words.same_bytes(units.text, units.starts[:0], length[:0], np.zeros(0, np.int64))
