"""Toxicity by multiple-instance learning: documents are bags of sentences, labels are known for documents.

Each sentence has a probability from a logistic model over hashed words and word beginnings; a
document's score is the noisy-or of its sentences: 1 - prod(1 - p). The weights are trained on that score from
document labels alone, so the model learns which sentences offend, and can point at them.

The bias is the chance b of a sentence without any evidence. It explains labels in training; scores leave it out: a
sentence counts with (p - b) / (1 - b), at least 0, so harmless sentences add nothing however many there are.

Training uses a bounded sample of labelled documents (``sample``, half of it for each label as far as there are
enough, chosen by hash); scoring reads every whole text.

Defined cases: null and empty texts have no sentences and score 0; documents with conflicting labels
count as toxic; labels without documents are ignored; without any training label of one kind all scores
are 0; repeated rows are scored each by itself; extra columns are kept, and an output name that is taken raises an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, saved, untaken

BITS = 20
#: Besides whole words, so many of their first bytes are features.
PREFIXES = (4, 5, 6, 8)
#: Most labelled documents that are trained on.
SAMPLE = 6_000
STEPS = 300
#: Share of labels that are taken to be wrong, so that a few of them do not outweigh all others.
NOISE = 0.03
#: A feature is used if toxic documents have it more often by so many standard errors.
CERTAINTY = 4.0
#: Start of a sentence's log odds: without evidence it is almost surely harmless.
START = -7.0
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


def held_out(id_col: Column) -> Column:
    """Documents that labels are never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, W.Words, np.ndarray]:
    """Features of all words, the sentence of each word, the row of each sentence, words, sentence ends."""
    data, offsets = W.flat(column)
    w = W.words(data, offsets, W.ALNUM, PREFIXES)
    both = np.empty((len(w.hash), 1 + len(PREFIXES)), np.int32)
    both[:, 0] = w.hash >> np.uint64(64 - BITS)
    both[:, 1:] = w.prefix >> np.uint64(64 - BITS)
    ends = np.flatnonzero(_END[data])
    mark = np.searchsorted(ends, w.start)
    change = np.ones(len(mark), bool)
    change[1:] = (mark[1:] != mark[:-1]) | (w.row[1:] != w.row[:-1])
    sentence = np.cumsum(change) - 1
    return both, sentence, w.row[change], w, ends


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
    known = known.join(docs.select(id_col).distinct(), id_col, "left_semi")
    order = F.xxhash64(id_col)
    some = [saved(known.where(F.col("_label") == k).orderBy(order, id_col).limit(sample // 2), f"sample-{k}") for k in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # ``sample`` rows at most
    one = F.max(text_col).alias("text")
    return docs.join(chosen, id_col).groupBy(id_col, "_label").agg(one).select("_label", F.coalesce("text", F.lit("")).alias("text"))


class Model:
    """Weights of hashed features and the sentence bias."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def sentences(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, W.Words, np.ndarray, np.ndarray]:
        """Probability beyond the base chance and row of every sentence; with the words, their sentences and the sentence ends."""
        pairs, sentence, row, w, ends = features(column)
        odds = self.bias + np.bincount(sentence, self.weights[pairs].sum(axis=1), minlength=len(row))
        safe, base = (np.logaddexp(0, np.clip(x, -30, 30)) for x in (odds, self.bias))  # -log(1 - p)
        return -np.expm1(np.minimum(base - safe, 0)), row, w, sentence, ends


def noisy_or(p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return 1 - np.exp(np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=rows))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Maximum likelihood of the document labels under the noisy-or, by Adam over the whole sample.

    Only features that toxic documents have surely more often get a weight.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            pairs, sentence, row, _, _ = features(batch.column("text"))
            size = np.bincount(sentence, minlength=len(row)).astype(np.int32)
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            at = np.concatenate([[0], np.cumsum(size)])[cut]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_label"),
                    pa.array([pairs[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary()),
                    pa.array([size[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                ],
                ["label", "features", "sizes"],
            )

    bags = saved(map_arrow(_training(docs, labels, id_col, text_col, label_col, sample), extract, "label int, features binary, sizes binary"), "bags")
    bags = bags.where(F.octet_length("sizes") > 0)
    many = {r["label"]: r["count"] for r in bags.groupBy("label").count().collect()}
    if len(many) < 2:
        return Model(np.zeros(1 << BITS), -30.0)
    kinds = _useful(bags, many)
    y, bag, often, sentence, feature = _uses(bags, kinds)
    # the sample's labels count as often as half and half
    importance = np.where(y == 1, 0.5 / many[1], 0.5 / many[0])
    w, first, second = np.zeros(len(kinds) + 1), np.zeros(len(kinds) + 1), np.zeros(len(kinds) + 1)
    w[-1] = START
    for step in range(1, STEPS + 1):
        odds = w[-1] + np.bincount(sentence, w[feature], minlength=len(bag))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        safe = np.bincount(bag, often * np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        score = 1 - np.exp(safe)
        told = NOISE + (1 - 2 * NOISE) * score  # chance that the label says toxic
        slope = (importance * (1 - 2 * NOISE) * (1 - score) * np.where(y == 1, -1 / told, 1 / (1 - told)))[bag] * p * often
        gradient = np.append(np.bincount(feature, slope[sentence], minlength=len(kinds)), slope.sum())
        gradient[:-1] += 1e-6 * w[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        w -= 0.25 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[kinds] = w[:-1]
    return Model(weights, w[-1])


def _useful(bags: DataFrame, many: dict[int, int]) -> np.ndarray:
    """Features that toxic documents have surely more often than others, by counts of documents."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            for label, used in zip(batch.column("label").to_pylist(), batch.column("features")):
                has[label, np.unique(np.frombuffer(used.as_buffer(), np.int32))] += 1
        label, feature = np.nonzero(has)
        yield pa.RecordBatch.from_arrays([pa.array(feature, pa.int32()), pa.array(label, pa.int32()), pa.array(has[label, feature], pa.int64())], ["feature", "label", "n"])

    counts = map_arrow(bags.select("label", "features"), once, "feature int, label int, n long").groupBy("feature").agg(
        *[F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"_n{k}") for k in (0, 1)]
    )
    clean, toxic = F.col("_n0"), F.col("_n1")
    share = (clean + toxic) / (many[0] + many[1])
    error = F.sqrt(share * (1 - share) * (1 / many[0] + 1 / many[1]) + 1e-12)
    found = counts.where(toxic / many[1] - clean / many[0] > CERTAINTY * error).select("feature").toArrow()  # ``1 << BITS`` at most
    return np.sort(found["feature"].to_numpy())


def _uses(bags: DataFrame, kinds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Labels of the documents; document and number of every kind of sentence; sentence and feature of every use.

    Sentences of a document with the same features come as one with their number, those without any as one of all: what
    comes to the driver is bounded by the useful features and the sample, not by the length of texts.
    """
    shared = bags.sparkSession.sparkContext.broadcast(kinds)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = np.full(1 << BITS, -1, np.int32)
        code[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            out = []
            for used, sizes in zip(batch.column("features"), batch.column("sizes")):
                sizes = np.frombuffer(sizes.as_buffer(), np.int32)
                used = code[np.frombuffer(used.as_buffer(), np.int32)].reshape(-1, 1 + len(PREFIXES))
                where, which = np.nonzero(used >= 0)
                sentence, feature = np.repeat(np.arange(len(sizes)), sizes)[where], used[where, which]
                seen: Counter[bytes] = Counter()
                order = np.lexsort((feature, sentence))
                feature, cuts = feature[order], np.flatnonzero(np.diff(sentence[order], prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(feature)]):
                    seen[feature[a:b].tobytes()] += 1
                seen[b""] = len(sizes) - len(cuts)
                out.append([{"features": x, "n": n} for x, n in sorted(seen.items()) if n])
            kind = pa.list_(pa.struct([("features", pa.binary()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, kind)], ["label", "sentences"])

    found = map_arrow(bags, reduce, "label int, sentences array<struct<features:binary,n:bigint>>").toArrow()
    rows = sorted(zip(found["label"].to_pylist(), found["sentences"].to_pylist()), key=lambda r: (r[0], [(s["features"], s["n"]) for s in r[1]]))
    y, bag, often, sentence, feature = np.array([label for label, _ in rows], float), [], [], [], []
    for k, (_, sentences) in enumerate(rows):
        for s in sentences:
            used = np.frombuffer(s["features"], np.int32)
            sentence.append(np.full(len(used), len(bag)))
            feature.append(used)
            bag.append(k)
            often.append(s["n"])
    empty = [np.empty(0, np.int64)]
    return y, np.array(bag, np.int64), np.array(often, float), np.concatenate(empty + sentence), np.concatenate(empty + feature).astype(np.int64)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", spans_col: str | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with each whole text's score and, on demand, its sentences of ``least`` or more."""
    untaken(docs, score_col, *([spans_col] if spans_col else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    new = [T.StructField(score_col, T.DoubleType()), *([T.StructField(spans_col, T.ArrayType(span))] if spans_col else [])]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (part for whole in batches for part in W.slices(whole, text_col)):
            column = batch.column(text_col)
            p, row, w, sentence, _ = known.sentences(column)
            out = [pa.array(noisy_or(p, row, batch.num_rows))]
            if spans_col:
                offending = np.flatnonzero(p >= least)
                low, high = np.searchsorted(sentence, [offending, offending + 1])
                points = W.code_points(w.data, W.flat(column)[1], row[offending], np.stack([w.start[low], w.end[high - 1]]))
                found = [[] for _ in range(batch.num_rows)]
                for k, s in enumerate(offending.tolist()):
                    found[int(row[s])].append({"start": int(points[0, k]), "end": int(points[1, k]), "score": float(p[s])})
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                out.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], [*batch.schema.names, *(f.name for f in new)])

    return map_arrow(docs, add, T.StructType([*docs.schema.fields, *new]))
