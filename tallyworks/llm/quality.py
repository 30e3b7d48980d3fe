"""Document quality by hierarchical empirical Bayes over sites and paths.

A document classifier (logistic, over hashed words and a few whole-text shares) gives each document its own
evidence. Sites and paths within sites have posteriors: the classifier's mean over ALL documents of a
place and the labels of its training documents, shrunk towards the level above by a prior whose strength
is estimated from how much places differ beyond chance. A place with few documents keeps its parent's value.
The score adds the document's log odds and what its path is worth over the global mean.

All statistics are grouped aggregations with partial sums, so a site with a third of all rows is no burden.
The classifier is trained on a bounded sample (``sample``) of labelled documents chosen by hash.

Defined cases: null and empty texts are judged by their place alone; null sites and paths are places
of their own; documents with conflicting labels count as bad; without labels of one kind the score is
the global mean; repeated rows are judged each by itself; extra columns are not read, and the result has its own five only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, saved

BITS = 16
SAMPLE = 6_000
STEPS = 200
_KINDS = np.zeros(256, np.int64)  # 0 other, 1 lower-case letter, 2 capital, 3 digit, 4 mark, 5 white space
for _kind, _chars in ((1, range(97, 123)), (1, range(128, 256)), (2, range(65, 91)), (3, range(48, 58)), (5, (9, 10, 13, 32))):
    _KINDS[list(_chars)] = _kind
_KINDS[[c for c in range(33, 127) if _KINDS[c] == 0 and chr(c) not in ".,"]] = 4
SHARES = 7


def held_out(id_col: Column) -> Column:
    """Documents that labels are never learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of each word, its row, and shares of each whole text."""
    data, offsets = W.flat(column)
    rows = len(column)
    w = W.words(data, offsets, W.NO_SPACE)
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    kinds = np.bincount(row_of * 6 + _KINDS[data], minlength=rows * 6).reshape(rows, 6) / np.maximum(np.diff(offsets), 1)[:, None]
    count = np.bincount(w.row, minlength=rows)
    again = np.zeros(len(w.hash), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1])
    repeated = np.bincount(w.row[again], minlength=rows) / np.maximum(count, 1)
    return (w.hash >> np.uint64(64 - BITS)).astype(np.int32), w.row, np.column_stack([kinds, repeated])


class Model:
    """A logistic model: words count by their share of the text."""

    def __init__(self, words: np.ndarray, shares: np.ndarray, bias: float) -> None:
        self.words, self.shares, self.bias = words.astype(np.float32), shares, float(bias)

    def odds(self, column: pa.Array) -> np.ndarray:
        word, row, shares = features(column)
        count = np.maximum(np.bincount(row, minlength=len(column)), 1)
        return self.bias + shares @ self.shares + np.bincount(row, self.words[word], minlength=len(column)) / np.sqrt(count)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(id_col).agg(F.min(F.col(label_col).cast("int")).alias("_label"))
    known = known.join(docs.select(id_col).distinct(), id_col, "left_semi")
    order = F.xxhash64(id_col)
    some = [saved(known.where(F.col("_label") == k).orderBy(order, id_col).limit(sample // 2), f"sample-{k}") for k in (0, 1)]
    chosen = F.broadcast(some[0].union(some[1]))  # ``sample`` rows at most
    one = docs.join(chosen, id_col).groupBy(id_col, "_label").agg(F.max(text_col).alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            word, row, shares = features(batch.column("text"))
            cut = np.searchsorted(row, np.arange(batch.num_rows + 1))
            kinds = [np.unique(word[a:b], return_counts=True) for a, b in zip(cut, cut[1:])]
            columns = [
                batch.column("_label"),
                pa.array([k.tobytes() for k, _ in kinds], pa.binary()),
                pa.array([n.astype(np.int32).tobytes() for _, n in kinds], pa.binary()),
                pa.array(list(shares), pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["label", "words", "counts", "shares"])

    found = map_arrow(one.select("_label", F.coalesce("text", F.lit("")).alias("text")), extract, "label int, words binary, counts binary, shares array<double>")
    rows = found.orderBy(F.xxhash64("words", "counts"), "label").collect()
    y = np.array([r["label"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(1 << BITS), np.zeros(SHARES), 0.0)
    word = [np.frombuffer(r["words"], np.int32) for r in rows]
    counts = [np.frombuffer(r["counts"], np.int32) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in word])
    value = np.concatenate([c / np.sqrt(max(c.sum(), 1)) for c in counts])
    word, shares = np.concatenate(word), np.array([r["shares"] for r in rows])
    usable = np.bincount(word, minlength=1 << BITS) >= 3
    keep = usable[word]
    word, row, value = word[keep], row[keep], value[keep]
    importance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    size = 1 << BITS
    theta, first, second = (np.zeros(size + SHARES + 1) for _ in range(3))
    for step in range(1, STEPS + 1):
        odds = theta[-1] + shares @ theta[size:-1] + np.bincount(row, theta[word] * value, minlength=len(y))
        slope = importance * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y)
        gradient = np.concatenate([np.bincount(word, slope[row] * value, minlength=size) + 1e-4 * theta[:size], slope @ shares, [slope.sum()]])
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:size], theta[size:-1], theta[-1])


def with_odds(docs: DataFrame, model: Model, text_col: str = "text", odds_col: str = "odds") -> DataFrame:
    """``docs`` with the classifier's log odds of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, text_col)):
            odds = shared.value.odds(batch.column(text_col))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds)], [*batch.schema.names, odds_col])

    return map_arrow(docs, add, T.StructType([*docs.schema.fields, T.StructField(odds_col, T.DoubleType())]))


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def _strength(places: DataFrame, mean: str) -> float:
    """Pseudo-documents of the prior: the variance of one document over that of the places beyond chance.

    ``places`` has n, hits and ``mean``, the parent's value.
    """
    rate, parent = F.col("hits") / F.col("n"), F.col(mean)
    row = places.agg(
        F.sum(F.col("n") * (rate - parent) * (rate - parent)).alias("between"),
        F.sum(parent * (1 - parent)).alias("chance"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("all"),
        F.sum("n").alias("n"),
    ).first()
    if not row["n"] or not row["all"]:
        return 1.0
    beyond = max((row["between"] - row["chance"]) / row["n"], 1e-4 * row["all"] / row["n"])
    return max(1.0, row["all"] / row["n"] / beyond)


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """(site, path, site_posterior, path_posterior) and the global mean, from (site, path, value)."""
    paths = saved(evidence.groupBy("site", "path").agg(F.count("value").alias("n"), F.sum("value").alias("hits")).where("n > 0"), "paths")
    row = paths.agg(F.sum("hits"), F.sum("n")).first()
    overall = row[0] / row[1] if row[1] else 0.5
    sites = paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).withColumn("overall", F.lit(overall))
    strength = _strength(sites, "overall")
    sites = sites.select("site", ((F.col("hits") + strength * overall) / (F.col("n") + strength)).alias("site_posterior"))
    both = paths.alias("p").join(sites.alias("s"), F.col("p.site").eqNullSafe(F.col("s.site")))
    both = both.select("p.site", "p.path", "p.n", "p.hits", "s.site_posterior")
    inner = _strength(both, "site_posterior")
    path = (F.col("hits") + inner * F.col("site_posterior")) / (F.col("n") + inner)
    return both.select("site", "path", "site_posterior", path.alias("path_posterior")), overall


def score(
    docs: DataFrame,
    labels: DataFrame,
    site: Column,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """(id, classifier, site_posterior, path_posterior, score): score is the chance that the document is good."""
    model = fit(docs.select(id_col, text_col), labels, id_col, text_col, label_col, sample)
    own = docs.select(F.col(id_col).alias("_id"), site.alias("_site"), path.alias("_path"), F.col(text_col).alias("_text"))
    judged = saved(with_odds(own, model, "_text", "_odds").drop("_text"), "judged")
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(label_col).cast("double")).alias("_label"))
    chance = 1 / (1 + F.exp(-F.col("_odds")))
    evidence = judged.join(known, "_id", "left").select(
        F.col("_site").alias("site"), F.col("_path").alias("path"), F.coalesce("_label", chance).alias("value")
    )
    places, overall = posteriors(evidence)
    met = F.col("_site").eqNullSafe(F.col("site")) & F.col("_path").eqNullSafe(F.col("path"))
    odds = F.col("_odds") + _logit(F.col("path_posterior")) - _logit(F.lit(overall))
    return judged.join(places, met).select(
        F.col("_id").alias(id_col), chance.alias("classifier"), "site_posterior", "path_posterior", (1 / (1 + F.exp(-odds))).alias("score")
    )
