"""Language identification by unigram models over the pieces of a fixed public vocabulary, summed over all segmentations.

Each language has a probability per piece. A word may be cut into pieces in many ways; its probability is the
sum over all of them, by a forward algorithm over its bytes, so no single segmentation is chosen. A text is scored by
the sum of its words' log probabilities.

Probabilities are learned by expectation maximisation: words are counted by language over all learned documents
(one aggregation with partial counts), and every round spreads each distinct word's count over its pieces by forward and backward
sums, in tasks; what comes to the driver is a number per language and piece of the vocabulary.

A word is a run of letters: bytes of ASCII letters, lower-cased, and of everything outside ASCII, read with one space in front.
Runs of more than ``LONGEST`` bytes are read in stretches of that length, so a text without gaps costs
time in proportion to its length. All single bytes are pieces, so every word has a segmentation.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is everything where nothing was learned;
rows without a language are not learned from; repeated rows are scored each by itself; an empty table gives an empty result; extra
columns are kept and output names that are taken raise an error. Languages are few: more than ``MOST`` raise an error, since the model
(languages times vocabulary) is broadcast.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, saved, untaken

UNKNOWN = "und"
#: Bytes of a word that are segmented together, its space included.
LONGEST = 48
#: Most languages of a model.
MOST = 200
ROUNDS = 2
#: Added to the expected count of every piece, as a share of a language's pieces on average.
SMOOTHING = 0.01
#: Distinct words whose log probabilities a task remembers.
REMEMBERED = 500_000
LETTERS = np.zeros(256, bool)
LETTERS[ord("a") : ord("z") + 1] = LETTERS[0x80:] = True
#: Probabilities are raised by this power of e for each byte, so that products over a word stay within doubles.
_SCALE = 5.0


def held_out(id_col: Column) -> Column:
    """Documents whose language is never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


class Vocabulary:
    """Pieces as byte strings, found at any place of a word by the hash of its bytes."""

    def __init__(self, ranks: str, longest: int = LONGEST) -> None:
        with open(ranks, "rb") as f:
            pieces = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
        word_like = [p for p in pieces if len(p) <= longest and all(LETTERS[c] for c in p[p[:1] == b" " :])]
        alone = [bytes([b]) for b in range(256)]
        self.pieces = sorted(set(word_like) | set(alone))
        self.longest = max(map(len, self.pieces))
        self.by_length: list[tuple[np.ndarray, np.ndarray]] = []
        for n in range(1, self.longest + 1):
            some = [(k, p) for k, p in enumerate(self.pieces) if len(p) == n]
            data = np.frombuffer(b"".join(p for _, p in some), np.uint8).reshape(len(some), n)
            hashes = self.hashes(data)
            order = np.argsort(hashes)
            self.by_length.append((hashes[order], np.array([k for k, _ in some], np.int32)[order]))

    @staticmethod
    def hashes(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            out = _next(out, rows[:, k])
        return out

    def lattice(self, words: np.ndarray) -> list[np.ndarray]:
        """For words of one length (rows of bytes): at n - 1, the piece of n bytes that begins at each place, or -1."""
        out, size = [], words.shape[1]
        running = np.zeros(words.shape, np.uint64)
        for n in range(1, min(self.longest, size) + 1):
            running = _next(running[:, : size - n + 1], words[:, n - 1 :])
            keys, ids = self.by_length[n - 1]
            if not len(keys):
                out.append(np.full(running.shape, -1, np.int32))
                continue
            at = np.minimum(np.searchsorted(keys, running), len(keys) - 1)
            out.append(np.where(keys[at] == running, ids[at], -1))
        return out


def _next(hashes: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Hashes of one byte more."""
    return W.mix(hashes * np.uint64(257) + byte + np.uint64(1))


def _forward(lattice: list[np.ndarray], scaled: np.ndarray) -> np.ndarray:
    """(places + 1, words, languages): the sum over all segmentations up to each place, of probabilities scaled by ``_SCALE``."""
    count, size = lattice[0].shape
    alpha = np.zeros((size + 1, count, scaled.shape[1]))
    alpha[0] = 1
    for end in range(1, size + 1):
        for n in range(1, min(len(lattice), end) + 1):
            piece = lattice[n - 1][:, end - n]
            word = np.flatnonzero(piece >= 0)
            if len(word):
                alpha[end, word] += alpha[end - n, word] * scaled[piece[word]]
    return alpha


def _backward(lattice: list[np.ndarray], scaled: np.ndarray) -> np.ndarray:
    """The same from each place to the end."""
    count, size = lattice[0].shape
    beta = np.zeros((size + 1, count, scaled.shape[1]))
    beta[size] = 1
    for start in range(size - 1, -1, -1):
        for n in range(1, min(len(lattice), size - start) + 1):
            piece = lattice[n - 1][:, start]
            word = np.flatnonzero(piece >= 0)
            if len(word):
                beta[start, word] += beta[start + n, word] * scaled[piece[word]]
    return beta


def word_table(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start, end of every word, with long runs in stretches, and the lower-cased bytes."""
    w = W.words(*W.flat(column), LETTERS)
    size = w.end - w.start
    most = LONGEST - 1
    if not len(size) or size.max() <= most:
        return w.hash, w.row, w.start, w.end, w.data
    parts = -(-size // most)
    at = np.repeat(np.arange(len(size)), parts)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = w.start[at] + nth * most
    end = np.minimum(start + most, w.end[at])
    hashes = w.hash[at]
    cut = np.flatnonzero(parts[at] > 1)
    for n in np.unique(end[cut] - start[cut]).tolist():  # stretches are hashed by their own bytes
        same = cut[end[cut] - start[cut] == n]
        hashes[same] = Vocabulary.hashes(w.data[start[same][:, None] + np.arange(n)])
    return hashes, w.row[at], start, end, w.data


class Model:
    """Log probabilities of pieces by language, and the languages' shares."""

    def __init__(self, vocabulary: Vocabulary, languages: list[str], logs: np.ndarray) -> None:
        self.vocabulary, self.languages, self.logs = vocabulary, languages, logs
        size = np.fromiter(map(len, vocabulary.pieces), np.int64, len(vocabulary.pieces))
        self.scaled = np.exp(logs + _SCALE * size[:, None])

    def _by_length(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[np.ndarray], int]]:
        """Places of words of one length, their lattice and that length, the space in front included."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(size).tolist():
            some = np.flatnonzero(size == n)
            for low in range(0, len(some), 2048):
                at = some[low : low + 2048]
                rows = np.frombuffer(b"".join(b" " + words[k] for k in at.tolist()), np.uint8).reshape(len(at), n + 1)
                yield at, self.vocabulary.lattice(rows), n + 1

    def words(self, words: list[bytes]) -> np.ndarray:
        """(words, languages): log probabilities of words, given without their space."""
        out = np.zeros((len(words), len(self.languages)))
        for at, lattice, size in self._by_length(words):
            out[at] = np.log(_forward(lattice, self.scaled)[-1]) - _SCALE * size
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """(pieces, languages): how often each piece is expected, for words seen ``counts`` (words, languages) times."""
        total = np.zeros_like(self.logs)
        for at, lattice, _ in self._by_length(words):
            alpha, beta = _forward(lattice, self.scaled), _backward(lattice, self.scaled)
            often = counts[at] / alpha[-1]
            pieces, weights = [], []
            for n, found in enumerate(lattice, 1):
                word, start = np.nonzero(found >= 0)
                pieces.append(found[word, start])
                weights.append(alpha[start, word] * beta[start + n, word] * often[word])
            piece, code = np.unique(np.concatenate(pieces), return_inverse=True)
            weight = np.concatenate(weights)
            for k in range(total.shape[1]):
                total[piece, k] += np.bincount(code, weight[:, k], minlength=len(piece))
        return total * self.scaled


def _word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Written (lang, word, n): every distinct word's number by language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            hashes, row, start, end, data = word_table(batch.column("text"))
            code, known = pd.factorize(hashes)
            langs = pc.dictionary_encode(batch.column("lang"))
            kind = langs.indices.to_numpy()[row]
            seen, first, n = np.unique(kind.astype(np.int64) * max(len(known), 1) + code, return_index=True, return_counts=True)
            raw = data.tobytes()
            found = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pc.take(langs.dictionary, pa.array(kind[first], pa.int32())), pa.array(found, pa.binary()), pa.array(n)], ["lang", "word", "n"]
            )

    words = map_arrow(docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")), count, "lang string, word binary, n long")
    return saved(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


def fit(docs: DataFrame, ranks: str, text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS) -> Model:
    """Probabilities by expectation maximisation over the words of all ``docs`` with a language.

    The first round starts from equal probabilities, in which a word's segmentations with fewer pieces weigh most.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(ranks)
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = _word_counts(known, text_col, lang_col)
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MOST + 1).collect())
    if len(languages) > MOST:
        raise ValueError(f"more than {MOST} languages")
    size = len(vocabulary.pieces)
    model = Model(vocabulary, languages, np.full((size, len(languages)), -np.log(size)))
    number = {name: k for k, name in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(model)

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            total = np.zeros((len(known.vocabulary.pieces), len(known.languages)))
            for batch in batches:
                kind = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
                code, words = pd.factorize(np.array([*batch.column("word").to_pylist(), b""], object))
                seen = np.zeros((len(words), len(known.languages)))
                np.add.at(seen, (code[:-1], kind), batch.column("n").to_numpy())
                total += known.expected(list(words), seen)
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "n"])

        found = map_arrow(counts, spread, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        found = found.toArrow()  # a number per language and piece
        total = np.zeros((size, len(languages)))
        total[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
        total += SMOOTHING * np.maximum(total.sum(axis=0), 1) / size
        model = Model(vocabulary, languages, np.log(total / total.sum(axis=0)))
    return model


def _has_letter(column: pa.Array, row: np.ndarray, start: np.ndarray, data: np.ndarray, rows: int) -> np.ndarray:
    """Rows with a letter: ASCII ones are seen in the words' first bytes, other texts are looked through."""
    out = np.zeros(rows, bool)
    out[row[data[start] < 0x80]] = True
    unsure = np.setdiff1d(np.unique(row), np.flatnonzero(out))
    for k in unsure.tolist():
        out[k] = any(map(str.isalpha, column[k].as_py()))
    return out


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its share of the probability of all languages, alike likely beforehand."""
    untaken(docs, lang_col, score_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = pa.array([*known.languages, UNKNOWN], pa.string())
        none, many = len(known.languages), max(1, len(known.languages))
        keys, logs = np.empty(0, np.uint64), np.empty((0, many))
        for batch in (part for whole in batches for part in W.slices(whole, text_col)):
            column, rows = batch.column(text_col), batch.num_rows
            best, score = np.full(rows, none), np.zeros(rows)
            if none:
                hashes, row, start, end, data = word_table(column)
                code, words = pd.factorize(hashes)
                at = np.searchsorted(keys, words)
                new = np.ones(len(words), bool)
                new[at < len(keys)] = keys[at[at < len(keys)]] != words[at < len(keys)]
                if new.any():
                    first = np.empty(len(words), np.int64)
                    first[code[::-1]] = np.arange(len(code))[::-1]
                    raw = data.tobytes()
                    learned = known.words([raw[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
                    if len(keys) + len(learned) > REMEMBERED:  # only this slice's words stay
                        keep = np.isin(keys, words)
                        keys, logs = keys[keep], logs[keep]
                    order = np.argsort(np.append(keys, words[new]), kind="stable")
                    keys, logs = np.append(keys, words[new])[order], np.concatenate([logs, learned])[order]
                    at = np.searchsorted(keys, words)
                of_word = logs[at]
                total = np.stack([np.bincount(row, of_word[code, k], minlength=rows) for k in range(many)], 1)
                share = np.exp(total - total.max(axis=1, keepdims=True))
                share /= share.sum(axis=1, keepdims=True)
                sure = _has_letter(column, row, start, data, rows)
                best = np.where(sure, np.argmax(total, axis=1), none)
                score = np.where(sure, share.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, names.take(pa.array(best)), pa.array(score)], schema.names)

    return map_arrow(docs, add, schema)
