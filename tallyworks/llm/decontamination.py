"""Benchmark decontamination: a broadcast set of hashed benchmark windows, scanned over whole texts.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one window. A document word inside
any occurrence of a window is hit. Window hashes only nominate; every nominee is compared word by word.

The window table is broadcast in blocks of ``block`` windows on average, and documents pass
``TOGETHER`` blocks one after the other within one stage; then findings are written and the blocks released, so memory is bounded for a
benchmark of any size.

Defined cases: null texts have no words and are never contaminated; an empty benchmark hits nothing; repeated
rows are judged each by itself; a null item id marks words but is not listed; extra columns are kept, and a
``found_col`` that is taken raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyworks.llm import words as W
from tallyworks.llm.common import free_name, map_arrow, saved, untaken

WIDTH = 13
#: Windows in one broadcast block, about 150 bytes each.
BLOCK = 100_000
#: Blocks that a stage holds.
TOGETHER = 4

_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hit_words", T.ArrayType(T.IntegerType())),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(item, width, hash, words): every window of every item once."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            w = W.words(*W.flat(batch.column(1)), W.ALNUM)
            names = batch.column(0).to_pylist()
            starts = np.searchsorted(w.row, np.arange(len(names) + 1))
            out = []
            for name, a, b in zip(names, starts, starts[1:]):
                n = min(width, b - a)
                hashes = W.runs(w.hash[a:b], n) if n else []
                for k, h in enumerate(hashes):
                    out.append((name, int(n), int(h.astype(np.int64)), _phrase(w, a + k, n)))
            out = list(dict.fromkeys(out))
            columns = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.string()))],
                ["item", "width", "hash", "words"],
            )

    picked = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return map_arrow(picked, cut, "item string, width int, hash long, words string")


def _phrase(w: W.Words, at: int, n: int) -> str:
    return " ".join(w.data[w.start[k] : w.end[k]].tobytes().decode("utf-8", "replace") for k in range(at, at + n))


class _Block:
    """Windows by width: a bit table that rejects nearly all words, sorted hashes, words and items."""

    def __init__(self, rows: list) -> None:
        self.widths: dict[int, tuple] = {}
        for width in sorted({r["width"] for r in rows}):
            found: dict[int, dict[str, list]] = {}
            for r in rows:
                if r["width"] == width:
                    found.setdefault(r["hash"] & (2**64 - 1), {}).setdefault(r["words"], []).append(r["item"])
            hashes = np.array(sorted(found), np.uint64)
            bits = np.zeros(1 << 20, bool)
            bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.widths[width] = (bits, hashes, [found[int(h)] for h in hashes])

    def scan(self, w: W.Words) -> Iterator[tuple[int, int, list]]:
        """(first word, width, items) of every verified occurrence."""
        for width, (bits, hashes, phrases) in self.widths.items():
            seen = W.runs(w.hash, width)
            at = np.flatnonzero(bits[(seen >> np.uint64(44)).astype(np.int64)])
            at = at[w.row[at] == w.row[at + width - 1]]
            place = np.searchsorted(hashes, seen[at])
            equal = hashes[np.minimum(place, len(hashes) - 1)] == seen[at]
            for k, p in zip(at[equal].tolist(), place[equal].tolist()):
                items = phrases[p].get(_phrase(w, k, width))
                if items:
                    yield k, width, items


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    block: int = BLOCK,
    found_col: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct: n_words, n_hit, items (sorted strings), hit_words (first and past-the-last
    word of each run, flat), spans (the same runs of text in code points).

    Windows go to the tasks in blocks of ``block``. After ``TOGETHER`` blocks what is found so far is written with the documents and their
    broadcasts are released, so tasks hold so many blocks at once, however large the benchmark is.
    """
    untaken(docs, found_col)
    spark = docs.sparkSession
    windows = saved(benchmark_windows(items, item_col, item_text_col, width), "benchmark-windows")
    parts = max(1, -(-windows.count() // block))
    out, prior, held = docs, None, []
    for k in range(parts):
        if len(held) == TOGETHER:
            out = saved(out, "found")
            for earlier in held:
                earlier.unpersist()
            held = []
        rows = windows.where(F.pmod(F.xxhash64("hash"), F.lit(parts)) == k).collect()
        shared = spark.sparkContext.broadcast(_Block(rows))
        held.append(shared)
        new = free_name(out, f"_found{k}")
        schema = T.StructType([*out.schema.fields, T.StructField(new, _FOUND)])
        out = map_arrow(out, _scanner(shared, text_col, prior, new), schema)
        out, prior = out.drop(prior) if prior else out, new
    return out.withColumnRenamed(prior, found_col)


def _scanner(shared, text_col: str, prior: str | None, new: str):
    kind = to_arrow_type(_FOUND)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for whole in batches:
            for batch in W.slices(whole, text_col):
                data, offsets = W.flat(batch.column(text_col))
                w = W.words(data, offsets, W.ALNUM)
                n = batch.num_rows
                first = np.searchsorted(w.row, np.arange(n + 1))
                edge = np.zeros(len(w.hash) + 1, np.int32)
                items: dict[int, set] = {}
                for k, width, names in block.scan(w):
                    edge[k] += 1
                    edge[k + width] -= 1
                    items.setdefault(int(w.row[k]), set()).update(x for x in names if x is not None)
                if prior:
                    for r, found in enumerate(batch.column(prior).to_pylist()):
                        if found["n_hit"]:
                            items.setdefault(r, set()).update(found["items"])
                            np.add.at(edge, first[r] + np.array(found["hit_words"]), [1, -1] * (len(found["hit_words"]) // 2))
                hit = np.cumsum(edge[:-1]) > 0
                ranges = {r: _ranges(hit[first[r] : first[r + 1]]) for r in items}
                columns = [
                    np.diff(first),
                    np.bincount(w.row[hit], minlength=n),
                    [sorted(items.get(r, ())) for r in range(n)],
                    [ranges[r].ravel().tolist() if r in ranges else [] for r in range(n)],
                    [_spans(w, first[r], ranges[r], data, offsets[r], offsets[r + 1]) if r in ranges else [] for r in range(n)],
                ]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, kind)]
                found = pa.StructArray.from_arrays(arrays, fields=list(kind))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, new])

    return scan


def _ranges(hit: np.ndarray) -> np.ndarray:
    """First and past-the-last word of every run of hit words."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2)


def _spans(w: W.Words, first: int, ranges: np.ndarray, data: np.ndarray, low: int, high: int) -> list[dict]:
    """The runs as code points of the row's text."""
    points = np.concatenate([[0], np.cumsum((data[low:high] & 0xC0) != 0x80)])
    return [
        {"start": int(points[w.start[first + a] - low]), "end": int(points[w.end[first + b - 1] - low])}
        for a, b in ranges.tolist()
    ]


def is_contaminated(found: Column, parts: int = 20) -> Column:
    """At least one hit word, and one in ``parts`` of all words."""
    return (found["n_hit"] > 0) & (parts * found["n_hit"] >= found["n_words"])


def drop_contaminated(docs: DataFrame, items: DataFrame, parts: int = 20, **columns: str) -> DataFrame:
    """Without the documents that are contaminated."""
    name = free_name(docs, "_contamination")
    found = contamination(docs, items, found_col=name, **columns)
    return found.where(~is_contaminated(F.col(name), parts)).drop(name)


def cut_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **columns: str) -> DataFrame:
    """All documents, without the hit spans in their texts."""
    name = free_name(docs, "_contamination")
    found = contamination(docs, items, text_col=text_col, found_col=name, **columns)
    text, spans = F.col(text_col), F.col(name)["spans"]
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a))
    return found.withColumn(text_col, F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)).drop(name)
