"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary; each learned language has a probability for each piece.
The likelihood of a word is the sum, over all its segmentations into pieces, of the product of the pieces'
probabilities; a forward pass over the word computes it. The likelihood of a text is the product over its
words, the prediction the language of the largest, its score that language's posterior at equal priors.
Piece probabilities are learned by expectation-maximisation: forward and backward passes over the words of
the training texts give the expected count of each piece.

Words are the maximal runs of ASCII letters (lower-cased) and non-ASCII bytes of the whole text, each with a
word-start mark; they may have any length, and all their segmentations are summed. The sums of long runs are scaled as
they grow; those of very long ones go over stretches, each as a linear map of the sums at its last places. A
byte that no piece covers has a small fixed probability, the same in all languages. All pieces of the vocabulary are
used; those with bytes that no run has never occur.

Training is a classifier fit on a bounded sample: about ``train_docs`` training documents of each language,
chosen by a hash of the id, of each the first ``train_words`` distinct words by hash order; the fit takes runs of
over ``MAX_RUN`` bytes in parts of that size, each of which counts. Everything else covers all rows and whole
texts. Word likelihoods are memoised in each worker, in a table of bounded size.

Defined cases: a null text, an empty one and one without a letter are ``und`` with score 0; where nothing can
be learned (no training row has a language) all rows are ``und``; ties go to the language first in order;
repeated rows and ids are scored row by row; other columns are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, keep_rows, slices, small_batches, text_buffer
from tessera.llm.words import LOWER, byte_values, fingerprints, sealed, split

UNDETERMINED = "und"
MAX_RUN = 48
LONG_RUN = 2048  # from here on a run goes by stretches
STRETCH = 32_768
FLOOR = 1e-6
#: Probabilities are raised by this factor for each byte of their piece, and sums lowered again: all segmentations have the same bytes. So
#: no sum over ``MAX_RUN`` bytes is too small for a float, of unknown characters neither.
RAISED = 1e5
MEMO = 400_000
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(97, 123), *range(128, 256)]] = True


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The pieces of a sentencepiece model, found by fingerprint; numbers from 1, the byte pieces last, 0 for none."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = {model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        inside = sorted(t for t in texts if t and _LETTERS[np.frombuffer(t[t[:1] == b" " :], np.uint8)].all())
        raw = np.frombuffer(b"".join(inside), np.uint8)
        ends = np.cumsum([len(t) for t in inside])
        prints = fingerprints(raw, ends - [len(t) for t in inside], ends)
        order = np.argsort(prints)
        self.prints, self.number = prints[order], order + 1
        self.sizes = sorted({len(t) for t in inside} | {1})
        self.longest = self.sizes[-1]
        self.size = len(inside) + 256  # and a piece for each byte
        self.first_byte = len(inside) + 1
        self.raise_by = RAISED ** np.array([0, *(len(t) for t in inside), *[1] * 256], float)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.prints >> np.uint64(44)).astype(np.int64)] = True

    def find(self, prints: np.ndarray) -> np.ndarray:
        """Numbers of pieces by their fingerprints."""
        out = np.zeros(len(prints), np.int32)
        maybe = np.flatnonzero(self.seen[(prints >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.prints, prints[maybe]), len(self.prints) - 1)
        hit = self.prints[at] == prints[maybe]
        out[maybe[hit]] = self.number[at[hit]]
        return out

    def at(self, text: np.ndarray, left: np.ndarray) -> dict[int, np.ndarray]:
        """By size the pieces that begin at each place of a text, where as many bytes of its run are left; a byte's own where no piece has it."""
        sums, out = np.zeros(len(text), np.uint64), {}
        place = np.arange(len(text))
        for size in range(1, self.longest + 1):
            place = place[left[place] >= size]
            sums[place] += byte_values(text[place + size - 1], size - 1)
            if size in self.sizes:
                out[size] = np.zeros(len(text), np.int32)
                out[size][place] = self.find(sealed(sums[place], size))
        alone = out[1] == 0
        out[1][alone] = self.first_byte + text[alone].astype(np.int32)
        return out

    def raised(self, table: np.ndarray) -> np.ndarray:
        return table * self.raise_by[:, None]


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Runs:
    """The distinct words of a slice, one after the other with their marks, longest first, and the pieces at each place."""

    def __init__(self, vocabulary: Pieces, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray):
        length = ends - starts + marked
        self.order = np.argsort(-length, kind="stable")
        starts, marked, length = starts[self.order], marked[self.order], length[self.order]
        self.length, self.begin = length, np.cumsum(length) - length
        total = int(length.sum())
        word = np.repeat(np.arange(len(length)), length)
        within = np.arange(total) - self.begin[word]
        source = starts[word] + within - marked[word]
        mark = (within == 0) & (marked[word] == 1)
        self.text = np.where(mark, np.uint8(0x20), text[np.minimum(np.maximum(source, 0), max(len(text) - 1, 0))]) if total else np.zeros(0, np.uint8)
        self.vocabulary, self.sizes = vocabulary, vocabulary.sizes
        self.piece = vocabulary.at(self.text, np.repeat(self.begin + length, length) - np.arange(total))
        # how many words have at least so many bytes
        self.alive = np.searchsorted(-length, -np.arange(int(length[0]) + 2 if len(length) else 2), "right")

    def forward(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward sums at each place (place 0 of a word holds 1 before it) and of whole words; a column for each language."""
        longest = int(self.length[0]) if len(self.length) else 0
        alpha = np.zeros((longest + 1, len(self.length), table.shape[1]))
        alpha[0] = 1
        for end in range(1, longest + 1):
            n = self.alive[end]
            into = alpha[end, :n]
            for size in self.sizes:
                if size > end:
                    break
                piece = self.piece[size][self.begin[:n] + end - size]
                at = np.flatnonzero(piece)
                if len(at):
                    into[at] += alpha[end - size, at] * table[piece[at]]
        return alpha, alpha[self.length, np.arange(len(self.length))]

    def _lowered(self, logs: np.ndarray) -> np.ndarray:
        return logs - np.log(RAISED) * self.length[:, None]

    def log_short(self, table: np.ndarray) -> np.ndarray:
        """Logarithms of the sums of whole words of some ``MAX_RUN`` bytes at most."""
        return self._lowered(np.log(self.forward(self.vocabulary.raised(table))[1]))

    def log_forward(self, table: np.ndarray) -> np.ndarray:
        """Logarithms of the sums of whole words of any length: of the forward sums only the last are kept, and scaled."""
        table = self.vocabulary.raised(table)
        places, languages = self.sizes[-1] + 1, table.shape[1]
        ring = np.zeros((places, len(self.length), languages))
        ring[0] = 1
        scale, out = np.zeros((len(self.length), languages)), np.zeros((len(self.length), languages))
        for end in range(1, int(self.length[0]) + 1 if len(self.length) else 1):
            n = self.alive[end]
            into = np.zeros((n, languages))
            for size in self.sizes:
                if size > end:
                    break
                piece = self.piece[size][self.begin[:n] + end - size]
                at = np.flatnonzero(piece)
                if len(at):
                    into[at] += ring[(end - size) % places, at] * table[piece[at]]
            ring[end % places, :n] = into
            done = slice(self.alive[end + 1], n)
            out[done] = np.log(into[done]) + scale[done]
            if end % 16 == 0:
                most = ring[:, :n].max(axis=0)
                ring[:, :n] /= most
                scale[:n] += np.log(most)
        return self._lowered(out)

    def expected(self, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces over words of these weights, for a table of one language."""
        table = self.vocabulary.raised(table)
        alpha, whole = self.forward(table)
        scale = weight[self.order] / whole[:, 0]
        counts = np.zeros(len(table))
        longest = len(alpha) - 1
        beta = np.zeros((longest + 1, len(self.length)))
        beta[self.length, np.arange(len(self.length))] = 1
        for start in range(longest - 1, -1, -1):
            for size in self.sizes:
                if size > longest - start:
                    break
                m = self.alive[start + size]
                piece = self.piece[size][self.begin[:m] + start]
                at = np.flatnonzero(piece)
                if len(at):
                    gain = table[piece[at], 0] * beta[start + size, at]
                    beta[start, at] += gain
                    counts += np.bincount(piece[at], alpha[start, at, 0] * gain * scale[at], minlength=len(table))
        return counts


def _stretch_map(pieces_at: dict[int, np.ndarray], starts: np.ndarray, size: int, table: np.ndarray) -> np.ndarray:
    """What stretches of a run do to the forward sums at the last places before them: (place after, stretch, place before, language)."""
    places = max(pieces_at)
    alpha = np.zeros((places + size, len(starts), places, table.shape[1]))
    alpha[np.arange(places), :, np.arange(places)] = 1
    for step in range(size):
        for piece, numbers in pieces_at.items():
            at = starts + step + 1 - piece
            known = np.where(at >= 0, numbers[np.maximum(at, 0)], 0)
            some = np.flatnonzero(known)
            if len(some):
                alpha[places + step, some] += alpha[places + step - piece, some] * table[known[some]][:, None, :]
    return alpha[size:]


def long_likelihood(vocabulary: Pieces, run: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Logarithm, for each language, of the sum over all segmentations of one run of any length (its mark included)."""
    places, languages, table = vocabulary.longest, table.shape[1], vocabulary.raised(table)
    state, scale = np.zeros((places, languages)), np.zeros(languages)
    state[-1] = 1  # the forward sums at the last places; the newest is last
    for begin in range(0, len(run), STRETCH):
        stop = min(begin + STRETCH, len(run))
        low = max(begin - places + 1, 0)
        window = run[low:stop]
        pieces_at = vocabulary.at(window, len(window) - np.arange(len(window)))
        whole = (stop - begin) // MAX_RUN
        for first in range(0, whole, 64):
            starts = begin - low + MAX_RUN * np.arange(first, min(first + 64, whole))
            maps = _stretch_map(pieces_at, starts, MAX_RUN, table)
            for k in range(len(starts)):
                state = np.einsum("ibl,bl->il", maps[:, k], state)
                most = state.max(axis=0)
                state, scale = state / most, scale + np.log(most)
        rest = stop - begin - whole * MAX_RUN
        if rest:
            state = np.einsum("ibl,bl->il", _stretch_map(pieces_at, np.array([begin - low + whole * MAX_RUN]), rest, table)[:, 0], state)
            most = state.max(axis=0)
            state, scale = state / most, scale + np.log(most)
    return np.log(state[-1]) + scale - np.log(RAISED) * len(run)


def _runs_of(raw: np.ndarray, offsets: np.ndarray, *, cut: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, marked, row) of the words of a slice; for the fit long runs in parts."""
    words = split(raw, offsets, _LETTERS)
    length = words.ends - words.starts
    row = words.rows
    if cut and len(length) and int(length.max()) > MAX_RUN:
        parts = -(-length // MAX_RUN)
        owner = np.repeat(np.arange(len(length)), parts)
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = words.starts[owner] + k * MAX_RUN
        return words.text, starts, np.minimum(starts + MAX_RUN, words.ends[owner]), (k == 0).astype(np.int64), row[owner]
    return words.text, words.starts, words.ends, np.ones(len(length), np.int64), row


def _distinct(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prints = fingerprints(text, starts, ends) ^ marked.astype(np.uint64)
    return np.unique(prints, return_index=True, return_inverse=True)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        text, starts, ends, marked, row = _runs_of(*text_buffer(batch.column("text")), cut=True)
        lang = batch.column("lang").combine_chunks() if isinstance(batch.column("lang"), pa.ChunkedArray) else batch.column("lang")
        code = lang.dictionary_encode()
        own = np.asarray(code.indices)[row].astype(np.int64) if len(row) else np.zeros(0, np.int64)
        for k, name in enumerate(code.dictionary.to_pylist()):
            mine = own == k
            prints = fingerprints(text, starts[mine], ends[mine]) ^ marked[mine].astype(np.uint64)
            _, first, counts = np.unique(prints, return_index=True, return_counts=True)
            data = text.tobytes()
            a, b = starts[mine][first].tolist(), ends[mine][first].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(a), pa.string()), pa.array([data[x:y] for x, y in zip(a, b)], pa.binary()), pa.array(marked[mine][first]), pa.array(counts, pa.int64())],
                names=["lang", "word", "marked", "n"],
            )


def train(docs: DataFrame, *, model_path: str | None = None, train_docs: int = 1500, train_words: int = 60_000, rounds: int = 4) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities by piece and language) learned from the rows with a language.

    One group for each language fits in a worker: it has ``train_words`` distinct words at most. Every
    language is learned, and of a run of over ``MAX_RUN`` bytes every piece is counted.
    """
    small_batches(docs.sparkSession)
    path = model_path or piece_model_path()
    known = docs.where(F.col("lang").isNotNull())
    sizes = known.groupBy("lang").count().select("lang", (F.lit(float(train_docs)) / F.col("count")).alias("share"))
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    sample = known.select("lang", "doc_id", "text").where(F.col("text").isNotNull())
    counts = sample.join(F.broadcast(sizes), "lang").where(bucket < F.col("share")).select("lang", "text").mapInArrow(_count_words, "lang string, word binary, marked long, n long").groupBy("lang", "word", "marked").agg(F.sum("n").alias("n"))
    cut = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word", "marked"))
    counts = counts.withColumn("rank", cut).where(F.col("rank") <= train_words).select("lang", "word", "marked", "n")

    def fit(group: pa.Table) -> pa.Table:
        vocabulary = pieces(path)
        words = group.column("word").to_pylist()
        weight = np.asarray(group.column("n").combine_chunks()).astype(float)
        marked = np.asarray(group.column("marked").combine_chunks())
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        table = np.zeros((vocabulary.size + 1, 1))
        table[1:] = 1 / len(vocabulary.prints)
        table[vocabulary.first_byte :] = FLOOR
        for _ in range(rounds):
            total = np.zeros(len(table))
            for at in range(0, len(words), 10_000):
                stop = min(at + 10_000, len(words))
                starts = ends[at:stop] - [len(w) for w in words[at:stop]]
                total += Runs(vocabulary, raw, starts, ends[at:stop], marked[at:stop]).expected(table, weight[at:stop])
            own = total[1 : vocabulary.first_byte] + 0.1
            table[1 : vocabulary.first_byte, 0] = np.maximum(own / own.sum(), FLOOR / 100)
        return pa.table({"lang": pa.array([group.column("lang")[0].as_py()], pa.string()), "model": pa.array([table[:, 0].astype(np.float32).tobytes()], pa.binary())})

    fitted = sorted((r["lang"], bytes(r["model"])) for r in counts.groupBy("lang").applyInArrow(fit, "lang string, model binary").collect())
    if not fitted:
        return [], np.zeros((1, 0))
    return [k for k, _ in fitted], np.column_stack([np.frombuffer(v, np.float32) for _, v in fitted]).astype(np.float64)


class _Memo:
    """Log likelihoods of words met before, by fingerprint; started anew from the last slice's words when it is full."""

    def __init__(self, languages: int):
        self.prints = np.zeros(0, np.uint64)
        self.values = np.zeros((0, languages), np.float32)

    def find(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.prints):
            return np.zeros(len(prints), bool), np.zeros(len(prints), np.int64)
        at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        return self.prints[at] == prints, at

    def put(self, prints: np.ndarray, values: np.ndarray, fresh: np.ndarray) -> None:
        if len(self.prints) + int(fresh.sum()) > MEMO:
            self.prints, self.values = prints, values
            return
        joined = np.concatenate([self.prints, prints[fresh]])
        order = np.argsort(joined, kind="stable")
        self.prints, self.values = joined[order], np.concatenate([self.values, values[fresh]])[order]


class Scorer:
    """Predictions for slices; it remembers words from one slice to the next."""

    def __init__(self, path: str, languages: list[str], table: np.ndarray):
        self.vocabulary, self.memo, self.languages, self.table = pieces(path), _Memo(len(languages)), languages, table

    def __call__(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text."""
        raw, offsets = text_buffer(column)
        n, languages, memo = len(offsets) - 1, self.languages, self.memo
        if not languages:
            return [UNDETERMINED] * n, np.zeros(n)
        text, starts, ends, marked, row = _runs_of(raw, offsets)
        prints, first, inverse = _distinct(text, starts, ends, marked)
        have, at = memo.find(prints)
        values = np.zeros((len(prints), len(languages)), np.float32)
        values[have] = memo.values[at[have]]
        new = np.flatnonzero(~have)
        size = ends[first] - starts[first]
        short = new[size[new] <= MAX_RUN]
        for k in range(0, len(short), 20_000):
            some = first[short[k : k + 20_000]]
            runs = Runs(self.vocabulary, text, starts[some], ends[some], marked[some])
            values[short[k : k + 20_000][runs.order]] = runs.log_short(self.table)
        long = new[(size[new] > MAX_RUN) & (size[new] <= LONG_RUN)]
        if len(long):
            runs = Runs(self.vocabulary, text, starts[first[long]], ends[first[long]], marked[first[long]])
            values[long[runs.order]] = runs.log_forward(self.table)
        for k in new[size[new] > LONG_RUN].tolist():
            run = np.concatenate([np.full(1, 0x20, np.uint8), text[starts[first[k]] : ends[first[k]]]])
            values[k] = long_likelihood(self.vocabulary, run, self.table)
        memo.put(prints, values, ~have)
        total = np.zeros((n, len(languages)))
        for k in range(len(languages)):
            total[:, k] = np.bincount(row, values[inverse.ravel(), k], minlength=n) if len(row) else 0
        ascii_letters = np.concatenate([[0], np.cumsum((LOWER[raw] >= 97) & (LOWER[raw] <= 122))])
        letter = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
        for i in np.flatnonzero(~letter & (np.bincount(row, minlength=n) > 0)).tolist():
            letter[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
        best = total.argmax(axis=1)
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), letter.tolist())], np.where(letter, posterior, 0.0)


def predict(docs: DataFrame, languages: list[str], table: np.ndarray, *, model_path: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    path = model_path or piece_model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in slices(batches, "text"):
            scorer = scorer or Scorer(path, languages, table)
            told, score = scorer(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(told, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, in which a language is found, however sure that is."""
    path = options.get("model_path") or piece_model_path()
    languages, table = train(docs.where(~held_out()), **options)
    scorers: list[Scorer] = []

    def judge(batch: pa.RecordBatch) -> np.ndarray:
        if not scorers:
            scorers.append(Scorer(path, languages, table))
        told, _ = scorers[0](batch.column("text"))
        return np.array(told, object) != UNDETERMINED

    return keep_rows(docs, judge)


def held_out() -> Column:
    return crc_mod(F.col("doc_id"), 3) == 1


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the rows that are not held out and predict all rows: (doc_id, held_out, lang_pred, score)."""
    path = options.get("model_path")
    languages, table = train(docs.where(~held_out()), **options)
    return predict(docs, languages, table, model_path=path).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
