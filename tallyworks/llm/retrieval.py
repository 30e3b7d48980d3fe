"""Ranked lexical search with per-term geometric blocking.

1. One pass over the texts keeps, per document, the terms that any query asks for and their frequencies (:func:`vectors`,
   a written table); document frequencies and the collection's length are aggregates of it.
2. Documents are searched in shards of bounded size, within tasks. In a shard each term's posting list is cut into
   blocks of similar documents: some of its documents, evenly spaced, are centres, and each document goes to the one with the
   largest inner product. A block stores the coordinatewise maximum of its documents' vectors.
3. A query visits the lists of its terms, those that can add most first, and stops where the terms that are left
   cannot reach its threshold together. In a list, a block's summary gives an exact bound on the score of its documents, and only
   blocks whose bound fails the threshold are skipped. What remains is scored exactly.
4. The threshold is the score of the k-th best document so far. It starts from a bounded sample of documents (``SEEDS``),
   whose scores are real ones, so it never excludes a result; it grows as a task goes through its shards. Every task returns at most k
   documents per query, and a window takes the best of them.

Lists are built when the first query needs them: a list that no query has to open is never blocked. Queries are taken ``QUERIES`` at a
time, so that the terms asked for, which are broadcast, are bounded; vectors are dense over them within a shard.

Scores: terms are runs of ASCII letters, digits and anything outside ASCII, A-Z lower-cased. With N documents that have a
term, L terms in all, n in the document and df documents with the term, its weight is floor(1000 * ln((2N + 2) / (2 df + 1))), and
it adds weight * (10**9 * tf div (1000 * tf + 8 * m)) with m = 10 + 90 * n * N div L. All but the weight is in whole numbers.

Defined cases: null and empty texts have no terms and are never found; queries without terms have no results; equal scores go by
ascending identifier, nulls last; repeated rows are documents of their own, repeated queries are answered each by itself (rows with
equal query identifiers share ranks by query row); empty tables give an empty result; extra columns are not read. Terms are compared
by 64-bit hash and length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, saved

TOP = 10
#: Queries that are answered in one pass over the vectors.
QUERIES = 1_000
#: Documents of a shard, at most.
SHARD = 4_096
#: Numbers of a shard's dense vectors, at most.
CELLS = 1 << 24
#: Documents in a block on average.
BLOCK_DOCS = 16
#: Documents whose scores the thresholds start from, about.
SEEDS = 20_000


class Queries(NamedTuple):
    """Queries as positions in the sorted terms that any of them asks for."""

    rows: list  # identifiers
    terms: list[np.ndarray]  # of each query
    hashes: np.ndarray  # of all terms, sorted
    lengths: np.ndarray


def _read_queries(rows: list) -> Queries:
    column = pa.array([text for _, text in rows], pa.string())
    w = W.words(*W.flat(column), W.ALNUM)
    hashes, first, code = np.unique(w.hash, return_index=True, return_inverse=True)
    bounds = np.searchsorted(w.row, np.arange(len(rows) + 1))
    terms = [np.unique(code[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return Queries([name for name, _ in rows], terms, hashes, (w.end - w.start)[first])


def vectors(docs: DataFrame, hashes: np.ndarray, lengths: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written (id, n, terms, tf) of every document with a term: its number of terms, and those asked for."""
    asked = docs.sparkSession.sparkContext.broadcast((hashes, lengths))
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tf", T.ArrayType(T.IntegerType())),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = asked.value
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            w = W.words(*W.flat(batch.column("text")), W.ALNUM)
            n = np.bincount(w.row, minlength=batch.num_rows)
            at = np.minimum(np.searchsorted(keys, w.hash), max(len(keys) - 1, 0))
            found = (keys[at] == w.hash) & (sizes[at] == w.end - w.start) if len(keys) else np.zeros(len(w.hash), bool)
            entry, tf = np.unique(w.row[found] * (len(keys) + 1) + at[found], return_counts=True)
            row, term = entry // (len(keys) + 1), entry % (len(keys) + 1)
            cut = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cut, pa.array(x, pa.int32())) for x in (term, tf)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], schema.names)
            yield out.filter(pa.array(n > 0))

    return saved(map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), count, schema), "vectors")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class _Blocks(NamedTuple):
    members: np.ndarray  # documents, block after block
    starts: np.ndarray
    maxima: np.ndarray  # (blocks, columns of the list)
    column: np.ndarray  # place of a term in ``maxima``, -1 if no query that has this term asks for it


class Shard:
    """Vectors of some documents and the blocked lists of the terms that queries open."""

    def __init__(self, terms: np.ndarray, row: np.ndarray, value: np.ndarray, rows: int, asked_with: list[np.ndarray]) -> None:
        self.asked_with = asked_with
        self.dense = np.zeros((rows, len(asked_with)), np.int32)
        self.dense[row, terms] = value
        self.highest = self.dense.max(axis=0, initial=0).astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self.docs, self.first = row[order], np.searchsorted(terms[order], np.arange(len(asked_with) + 1))
        self.lists: dict[int, _Blocks] = {}

    def blocks(self, term: int) -> _Blocks:
        if term not in self.lists:
            docs = self.docs[self.first[term] : self.first[term + 1]]
            columns = self.asked_with[term]
            own = self.dense[np.ix_(docs, columns)]
            near = own.astype(np.float32)
            near /= np.sqrt((near * near).sum(axis=1, keepdims=True)) + 1e-9
            centres = np.linspace(0, len(docs) - 1, -(-len(docs) // BLOCK_DOCS)).astype(np.int64)
            home = np.argmax(near @ near[centres].T, axis=1)
            order = np.argsort(home, kind="stable")
            starts = np.flatnonzero(np.diff(home[order], prepend=-1))
            place = np.full(len(self.asked_with), -1)
            place[columns] = np.arange(len(columns))
            self.lists[term] = _Blocks(docs[order], starts, np.maximum.reduceat(own[order], starts, axis=0), place)
        return self.lists[term]

    def search(self, terms: np.ndarray, weight: np.ndarray, threshold: int, top: "_Top") -> None:
        """Give ``top`` every document that can still be among the best for these terms."""
        most = weight * self.highest[terms]
        order = np.argsort(-most, kind="stable")
        left = most[order][::-1].cumsum()[::-1]  # what a document without the lists before can reach
        seen = np.zeros(len(self.dense), bool)
        for k, at in enumerate(order.tolist()):
            threshold = max(threshold, top.least())
            if left[k] == 0 or left[k] < threshold:
                return
            if most[at] == 0:
                continue
            found = self.blocks(int(terms[at]))
            bounds = found.maxima[:, found.column[terms]].astype(np.int64) @ weight
            ends = np.append(found.starts[1:], len(found.members))
            for block in np.argsort(-bounds, kind="stable").tolist():
                threshold = max(threshold, top.least())
                if bounds[block] < threshold:
                    break
                docs = found.members[found.starts[block] : ends[block]]
                docs = docs[~seen[docs]]
                if len(docs):
                    seen[docs] = True
                    top.offer(docs, self.dense[np.ix_(docs, terms)].astype(np.int64) @ weight, threshold)


class _Top:
    """The best documents of a query so far: (score, order of the identifier, identifier)."""

    def __init__(self, top: int) -> None:
        self.top, self.found, self.ids = top, [], None

    def least(self) -> int:
        return self.found[-1][0] if len(self.found) == self.top else 1

    def offer(self, docs: np.ndarray, scores: np.ndarray, threshold: int) -> None:
        new = [(int(s), self.ids[d]) for d, s in zip(docs.tolist(), scores.tolist()) if s >= threshold]
        if new:
            self.found = sorted(self.found + new, key=lambda x: (-x[0], x[1] is None, x[1]))[: self.top]


def _best(table: DataFrame, queries: Queries, weight: np.ndarray, documents: int, length: int, start: np.ndarray, top: int) -> DataFrame:
    """(query, id, score): the best documents of every task for each query, none below its ``start``."""
    asked_with: list[set] = [set() for _ in weight]
    for terms in queries.terms:
        for t in terms.tolist():
            asked_with[t].update(terms.tolist())
    together = [np.array(sorted(x), np.int64) for x in asked_with]
    shared = table.sparkSession.sparkContext.broadcast((queries.terms, together, weight, start))
    rows = max(64, min(SHARD, CELLS // max(1, len(weight))))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, together, weight, start = shared.value
        best = [_Top(top) for _ in asked]
        kind = None
        for whole in batches:
            kind = whole.schema.field("id").type
            for low in range(0, whole.num_rows, rows):
                batch = whole.slice(low, rows)
                terms = pc.list_flatten(batch.column("terms")).to_numpy().astype(np.int64)
                row = pc.list_parent_indices(batch.column("terms")).to_numpy()
                tf = pc.list_flatten(batch.column("tf")).to_numpy().astype(np.int64)
                m = 10 + (90 * batch.column("n").to_numpy() * documents) // length
                shard = Shard(terms, row, (1_000_000_000 * tf) // (1000 * tf + 8 * m[row]), batch.num_rows, together)
                ids = batch.column("id").to_pylist()
                for query, own in zip(asked, best):
                    own.ids = ids
                for k, query in enumerate(asked):
                    if len(query):
                        shard.search(query, weight[query], int(start[k]), best[k])
        if kind is None:
            return
        rows_out = [(k, name, score) for k, own in enumerate(best) for score, name in own.found]
        query, name, score = zip(*rows_out) if rows_out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(name, kind), pa.array(score, pa.int64())], ["query", "id", "score"])

    schema = T.StructType([T.StructField("query", T.LongType()), table.schema["id"], T.StructField("score", T.LongType())])
    return map_arrow(table, find, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    top: int = TOP, at_once: int = QUERIES, seeds: int = SEEDS,
) -> DataFrame:
    """(item, rank, id, score): the ``top`` best documents with a score above 0 for every row of ``queries``."""
    asked = saved(queries.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).withColumn("part", F.xxhash64("item", "text")), "queries")
    parts = max(1, -(-asked.count() // at_once))
    out = None
    for part in range(parts):
        own = asked.where(F.pmod("part", F.lit(parts)) == part).select("item", "text")  # about ``at_once`` rows
        read = _read_queries([tuple(r) for r in own.orderBy("item", "text").collect()])
        found = _ranked(_search_one(docs, read, id_col, text_col, top, seeds), top)
        names = docs.sparkSession.createDataFrame(
            [(k, name) for k, name in enumerate(read.rows)], T.StructType([T.StructField("query", T.LongType()), asked.schema["item"]])
        )
        found = saved(found.join(F.broadcast(names), "query").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"), "found")
        out = found if out is None else out.union(found)
    return out


def _search_one(docs: DataFrame, read: Queries, id_col: str, text_col: str, top: int, seeds: int) -> DataFrame:
    table = vectors(docs, read.hashes, read.lengths, id_col, text_col)
    documents, length = (x or 0 for x in table.agg(F.count(F.lit(1)), F.sum("n")).first())
    df = np.zeros(len(read.hashes), np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pylist():  # terms asked for
        df[r["term"]] = r["count"]
    weight = weights(df, documents)
    start = np.ones(len(read.rows), np.int64)
    if documents > 2 * seeds:
        some = table.where(F.pmod(F.xxhash64("id", "n"), F.lit(documents // seeds)) == 0)
        for r in _ranked(_best(some, read, weight, documents, length, start, top), top).where(F.col("rank") == top).collect():  # one per query
            start[r["query"]] = r["score"]
    return _best(table, read, weight, documents, length, start, top)
