"""Near duplicates: an exact Jaccard self-join over word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent. If two sets of a and b shingles share at least o, the first
a - o + l of one and b - o + l of the other have l shingles in common. Each document picks its own l: where
its rare shingles suffice, l = 1; where its prefix reaches into shingles that many documents share, a longer
prefix that must match more often costs less than the candidates it saves. A pair must match
as often as the smaller l of the two says before its whole texts are compared.

The order comes from document frequencies. Shingles far above the usual frequency are told by a table of ``1 << BITS``
counters and stand last, by class. All others are counted exactly: they are dealt out by token, packed by the slice of
documents that has them, and each bucket of tokens returns those that several sets hold, with their number. A shingle that a single set has
goes no further, and a document whose prefix consists of such shingles has no candidates at all. Frequencies
only decide the order and l, never the result.

Equal sets are one vertex. Candidates are not expanded into all pairs: for each shingle, rounds compare
every vertex with one hub and merge what is linked, and only vertices that are then still in different
components are compared with each other. A candidate first has to pass a comparison of 256-byte sketches, the
parities of its shingles in SKETCH buckets: sets differ in at least as many shingles as sketches in
bits, so no link is lost there either. So no link between components is missed, and a group of
thousands of near copies costs about one comparison each.

Vertices are 64-bit hashes of whole sets, shingles 64-bit hashes.

Defined cases: null and empty texts, and texts without words, have an empty set and are linked with nothing;
texts of fewer words than a shingle have one shingle; repeated rows are linked with each other; null
identifiers count as larger than all others; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import free_name, map_arrow, saved
from tallyworks.llm.components import components

SIZE = 5
BITS = 18
#: Shingles of a bucket that is counted at once, about.
BUCKET = 2_000_000
MOST = 8
#: Hubs per shingle in each round before the rest is compared in full. In the last round only vertices outside a
#: shingle's main component look for hubs.
ROUNDS = (3, 3, 16)
#: Bits of a set's sketch.
SKETCH = 2048
_CLASSES = 8
_SALT = np.uint64(0xD6E8FEB86659FD93)


# ---- sets of shingles


def shingle_sets(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each, and where each row's begin and end."""
    hashes, rows = W.shingles(W.words(*W.flat(column), W.NO_SPACE), size)
    hashes = hashes.copy()
    bounds = np.searchsorted(rows, np.arange(len(column) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        hashes[a:b].sort()
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[first], np.concatenate([[0], np.cumsum(first)])[bounds]


def _vertices(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashes ^ _SALT))])
    return W.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def _sketches(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Parities of each set's shingles by bucket, packed."""
    bucket = (hashes & np.uint64(SKETCH - 1)).astype(np.int64)
    out: list[bytes] = []
    for low in range(0, len(bounds) - 1, 1000):
        part = bounds[low : low + 1001]
        row = np.repeat(np.arange(len(part) - 1), np.diff(part))
        odd = np.bincount(row * SKETCH + bucket[part[0] : part[-1]], minlength=(len(part) - 1) * SKETCH) & 1
        out += [x.tobytes() for x in np.packbits(odd.astype(np.uint8).reshape(-1, SKETCH), axis=1)]
    return out


def with_sets(
    docs: DataFrame, text_col: str = "text", size: int = SIZE, vertex: str = "vertex", count: str = "n_shingles", sketch: str | None = None
) -> DataFrame:
    """``docs`` with the number of distinct shingles, a hash of the whole set (null if empty) and, if asked for, its sketch."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, text_col)):
            hashes, bounds = shingle_sets(batch.column(text_col), size)
            n = np.diff(bounds)
            found = [pa.array(_vertices(hashes, bounds), mask=n == 0), pa.array(n)]
            found += [pa.array(_sketches(hashes, bounds), pa.binary())] if sketch else []
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *(f.name for f in new)])

    new = [T.StructField(vertex, T.LongType()), T.StructField(count, T.LongType())]
    new += [T.StructField(sketch, T.BinaryType())] if sketch else []
    return map_arrow(docs, add, T.StructType([*docs.schema.fields, *new]))


# ---- order by frequency


class Order(NamedTuple):
    """What places shingles: a class for each counter, how many documents the first class starts at, buckets to count the others in."""

    classes: np.ndarray
    unit: float
    buckets: int


def shingle_order(docs: DataFrame, text_col: str = "text", size: int = SIZE) -> Order:
    """Classes 0 (usual) to 7 of the counters, from the shingles of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            hashes, _ = W.shingles(W.words(*W.flat(batch.column(0)), W.NO_SPACE), size)
            total += np.bincount((hashes >> np.uint64(64 - BITS)).astype(np.int64), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["slot", "n"])

    counted = map_arrow(docs.select(F.col(text_col).alias("text")), count, "slot int, n long")
    rows = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # 1 << BITS rows at most
    counts = np.zeros(1 << BITS)
    counts[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    usual = max(1.0, float(np.median(counts)))
    above = (counts - usual) / np.sqrt(usual)
    classes = np.where(above < 4, 0, np.minimum(1 + np.log2(np.maximum(above, 4) / 4), _CLASSES - 1)).astype(np.uint8)
    return Order(classes, 4 * float(np.sqrt(usual)), int(max(1, -(-counts.sum() // BUCKET))))


def _tokens(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    kind = classes[(hashes >> np.uint64(64 - BITS)).astype(np.int64)].astype(np.uint64)
    return (kind << np.uint64(60)) | (hashes & np.uint64((1 << 60) - 1))


def _usual(tokens: np.ndarray) -> np.ndarray:
    return tokens < np.uint64(1 << 60)


def members(docs: DataFrame, order, text_col: str = "text", size: int = SIZE) -> DataFrame:
    """``docs`` without its text: ``vertex``, ``n_shingles``, ``_sketch``, how many shingles are of the usual class, and those of
    the other classes that a prefix may reach, in order."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = order.value.classes
        for batch in (part for whole in batches for part in W.slices(whole, text_col)):
            hashes, bounds = shingle_sets(batch.column(text_col), size)
            n = np.diff(bounds)
            tokens = _tokens(hashes, classes)
            usual = _usual(tokens)
            rare = np.concatenate([[0], np.cumsum(usual)])[bounds]
            rare = rare[1:] - rare[:-1]
            reached = np.maximum(n // 4 + MOST - rare, 0)
            rest, cut = tokens[~usual], np.concatenate([[0], np.cumsum(~usual)])[bounds].tolist()
            common = [np.sort(rest[a:b])[:k].tobytes() if k else b"" for a, b, k in zip(cut, cut[1:], reached.tolist())]
            new = [pa.array(_vertices(hashes, bounds), mask=n == 0), pa.array(n), pa.array(_sketches(hashes, bounds), pa.binary())]
            new += [pa.array(rare), pa.array(common, pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept.names), *new], schema.names)

    kept = T.StructType([f for f in docs.schema.fields if f.name != text_col])
    types = dict(vertex=T.LongType(), n_shingles=T.LongType(), _sketch=T.BinaryType(), _rare=T.LongType(), _common=T.BinaryType())
    schema = T.StructType([*kept.fields, *(T.StructField(k, v) for k, v in types.items())])
    return map_arrow(docs, add, schema)


# Rows of packed arrays, dealt out by ``bucket``: one per bucket and slice of documents, instead of one per token.
_PACKED = "bucket int, kind int, vertices binary, sizes binary, tokens binary, counts binary, rare binary"


def _packed(bucket: np.ndarray, buckets: int, kind: int, vertex: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """For each bucket its vertices, how many entries each has in a row, and the entries' columns."""
    at = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[at], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        own = at[cuts[k] : cuts[k + 1]]
        v = vertex[own]
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        sizes = np.diff(np.append(starts, len(v)))
        yield (k, kind, v[starts].tobytes(), sizes.astype(np.int32).tobytes(), *(c[own].tobytes() for c in columns))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    rows = [(*r, *[b""] * (7 - len(r))) for r in rows]
    names = [f.split()[0] for f in _PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of one bucket after the other; they come sorted by bucket."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != at and rows:
                yield rows
                rows = []
            at = row[0]
            rows.append(row)
    if rows:
        yield rows


def _unpack(rows: list[tuple], kind: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The vertex of every entry, and the columns of entries, of the rows of one kind."""
    own = [r for r in rows if r[1] == kind]
    join = lambda k, t: np.frombuffer(b"".join(r[k] for r in own), t)
    return np.repeat(join(2, np.int64), join(3, np.int32)), [join(4, np.uint64), join(5, np.int32), join(6, np.int32)]


def _spread(values: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of 60-bit numbers by their upper bits."""
    return (((values >> np.uint64(28)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _of_vertex(vertex: np.ndarray, buckets: int) -> np.ndarray:
    return _spread(W.mix(vertex.view(np.uint64)) & np.uint64((1 << 60) - 1), buckets)


def _dealt(packed: DataFrame, buckets: int) -> DataFrame:
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")


def repeated(docs: DataFrame, order, buckets: int, size: int = SIZE) -> DataFrame:
    """Packed tokens of the usual class that several sets hold, with their number, dealt by vertex."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = order.value.classes
        for batch in (part for whole in batches for part in W.slices(whole, "text", 2 * W.BLOCK)):
            hashes, bounds = shingle_sets(batch.column(0), size)
            vertex = np.repeat(_vertices(hashes, bounds), np.diff(bounds))
            tokens = _tokens(hashes, classes)
            usual = _usual(tokens)
            tokens, vertex = tokens[usual], vertex[usual]
            yield _batch(list(_packed(_spread(tokens, buckets), buckets, 1, vertex, tokens)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _buckets(batches):
            vertex, (tokens, _, _) = _unpack(rows, 1)
            ordered = np.sort(tokens)
            twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            if not len(twice):
                continue
            at = np.minimum(np.searchsorted(twice, tokens), len(twice) - 1)
            met = twice[at] == tokens
            code, v = _distinct(at[met], vertex[met])
            often = np.bincount(code, minlength=len(twice))
            keep = often[code] > 1
            code, v = code[keep], v[keep]
            by_vertex = np.argsort(v, kind="stable")
            code, v = code[by_vertex], v[by_vertex]
            yield _batch(list(_packed(_of_vertex(v, buckets), buckets, 1, v, twice[code], often[code].astype(np.int32))))

    packed = map_arrow(docs.select("text"), split, _PACKED)
    return saved(map_arrow(_dealt(packed, buckets), count, _PACKED), "repeated")


def _distinct(code: np.ndarray, vertex: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((vertex, code))
    code, vertex = code[order], vertex[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (vertex[1:] != vertex[:-1])
    return code[new], vertex[new]


def _matches(n: np.ndarray, single: np.ndarray, begins: np.ndarray, size: np.ndarray, partners: np.ndarray) -> np.ndarray:
    """Each set's l: the cheapest by tokens to store, partners to count and candidates to compare.

    ``single`` shingles that no other set has come first in the order, then ``size`` others with their ``partners``.
    """
    cost = []
    for wanted in range(1, MOST + 1):
        length = n // 4 + wanted
        # a partner of like size looks at this much of the prefix
        looked = np.clip(n // 7 + wanted - single, 0, size)
        seen = partners[begins + looked] - partners[begins]
        cost.append(np.clip(length - single, 0, size) + seen + (0.05 * n + 5) * seen / wanted)
    return np.minimum(1 + np.argmin(cost, axis=0), np.maximum(n - n // 4, 1))


def prefixes(heads: DataFrame, counted: DataFrame, order, buckets: int) -> DataFrame:
    """(token, vertex, info): each set's prefix without the shingles that it has alone; info holds n, the token's place and l."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vertex = batch.column("vertex").to_numpy()
            common = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("_common")]
            # one entry for the set itself, with its number of shingles as the token, then its common ones
            sizes = np.array([1 + len(c) for c in common], np.int64)
            at = np.repeat(np.arange(len(vertex)), sizes)
            first = np.cumsum(sizes) - sizes
            tokens = np.empty(len(at), np.uint64)
            inner = np.ones(len(at), bool)
            inner[first] = False
            tokens[first] = batch.column("n").to_numpy().astype(np.uint64)
            tokens[inner] = np.concatenate([np.empty(0, np.uint64), *common])
            rare = np.where(inner, -1, batch.column("_rare").to_numpy()[at]).astype(np.int32)
            yield _batch(list(_packed(_of_vertex(vertex[at], buckets), buckets, 0, vertex[at], tokens, np.zeros(len(at), np.int32), rare)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = order.value.unit
        expected = np.where(np.arange(_CLASSES) == 0, 0.0, unit * 2.0 ** (np.arange(_CLASSES) - 1))
        for rows in _buckets(batches):
            vertex, (tokens, _, rare) = _unpack(rows, 0)
            head = rare >= 0
            known = vertex[head]
            by = np.argsort(known)
            known, n, usual = known[by], tokens[head][by].astype(np.int64), rare[head][by].astype(np.int64)
            met, (shared, often, _) = _unpack(rows, 1)
            owner = np.searchsorted(known, np.concatenate([met, vertex[~head]]))
            token = np.concatenate([shared, tokens[~head]])
            often = np.concatenate([often.astype(np.int64), np.zeros(np.count_nonzero(~head), np.int64)])
            place = np.lexsort((token, often, token >> np.uint64(60), owner))
            owner, token, often = owner[place], token[place], often[place]
            size = np.bincount(owner, minlength=len(known))
            begins = np.cumsum(size) - size
            single = usual - np.bincount(owner[often > 0], minlength=len(known))
            partners = np.where(often > 0, often - 1.0, expected[(token >> np.uint64(60)).astype(np.int64)])
            partners = np.concatenate([[0.0], np.cumsum(partners)])
            matches = _matches(n, single, begins, size, partners)
            taken = np.clip(np.minimum(n // 4 + matches, n) - single, 0, size)
            row = np.repeat(np.arange(len(known)), taken)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
            info = (n[row] << 32) | ((single[row] + nth) << 4) | (matches[row] - 1)
            arrays = [pa.array(token[begins[row] + nth].view(np.int64)), pa.array(known[row]), pa.array(info)]
            yield pa.RecordBatch.from_arrays(arrays, ["token", "vertex", "info"])

    packed = map_arrow(heads.select("vertex", "n", "_rare", "_common"), pack, _PACKED)
    return map_arrow(_dealt(packed.union(counted), buckets), cut, "token long, vertex long, info long")


# ---- candidates


def _unpacked(df: DataFrame) -> DataFrame:
    info = F.col("info")
    return df.select(
        "token",
        "vertex",
        F.shiftright(info, 32).alias("n"),
        F.shiftright(info, 4).bitwiseAND(F.lit((1 << 28) - 1)).alias("place"),
        (info.bitwiseAND(F.lit(15)) + 1).alias("matches"),
    )


def _within_reach(a: str, b: str) -> Column:
    """This shared token is among those of which the pair must share ``matches``."""
    col = lambda side, name: F.col(f"{side}.{name}")
    need = F.expr(f"(3 * ({a}.n + {b}.n) + 6) div 7")
    wanted = F.least(col(a, "matches"), col(b, "matches"))
    return (
        (4 * F.least(col(a, "n"), col(b, "n")) >= 3 * F.greatest(col(a, "n"), col(b, "n")))
        & (col(a, "place") < col(a, "n") - need + wanted)
        & (col(b, "place") < col(b, "n") - need + wanted)
    )


def _candidates(met: DataFrame, tried: DataFrame | None, enough: int, slot: str | None = None) -> DataFrame:
    """Pairs (a, b, shared) that share as many tokens as the smaller of their l, or ``enough``, without the tried ones.

    a is the smaller vertex: which one of a pair is x may differ from token to token, and its tokens count together.
    With ``slot``, each slot counts by itself and a is x. In ``tried`` a is the smaller one.
    """
    x, y = F.col("x.vertex"), F.col("y.vertex")
    ends = (x.alias("a"), y.alias("b"), slot) if slot else (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    pairs = (
        met.where(_within_reach("x", "y"))
        .groupBy(*ends)
        .agg(F.sum(F.greatest("x.weight", "y.weight")).alias("shared"), F.min(F.least("x.matches", "y.matches")).alias("wanted"))
        .where(F.col("shared") >= F.least(F.col("wanted"), F.lit(enough)))
    )
    if tried is None:
        return pairs
    done = tried.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    return pairs.join(done, (F.least("a", "b") == F.col("_a")) & (F.greatest("a", "b") == F.col("_b")), "left_anti")


def _linked(pairs: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """The pairs whose whole texts reach the similarity."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(f"sketch_{x}").to_pylist()), np.uint64).reshape(-1, SKETCH // 64) for x in "ab")
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            keep = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64) <= both - 2 * ((3 * both + 6) // 7)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in W.slices(whole, "text_a")):
            one, at = shingle_sets(batch.column("text_a"), size)
            other, to = shingle_sets(batch.column("text_b"), size)
            keep = []
            for k in range(batch.num_rows):
                x, y = one[at[k] : at[k + 1]], other[to[k] : to[k + 1]]
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def joined(rows: DataFrame, *columns: str) -> DataFrame:
        for x in "ab":
            rows = rows.join(sets.select(F.col("vertex").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns)), x)
        return rows

    close = saved(map_arrow(joined(pairs.select("a", "b"), "n", "sketch"), near, "a long, b long"), "close")
    return map_arrow(joined(close, "text").select("a", "b", "text_a", "text_b"), compare, "a long, b long")


def _moved(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """``rows`` with each component replaced by the one it went into."""
    to = moved.select(F.col("u").alias("group"), F.col("v").alias("_to"))
    return rows.join(to, "group", "left").withColumn("group", F.coalesce("_to", "group")).drop("_to")


def _open(entries: DataFrame) -> DataFrame:
    """Entries of tokens that still meet in several components."""
    split = entries.groupBy("token").agg(F.min("group").alias("_low"), F.max("group").alias("_high")).where("_low <> _high")
    return entries.join(split, "token", "left_semi")


def linked_groups(docs: DataFrame, text_col: str = "text", size: int = SIZE, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """(vertex, group): the component of every vertex that is linked with another one of a smaller number."""
    source, order = _source(docs.select(F.col(text_col).alias("text")), size)
    return _groups(source, saved(members(source, order, size=size), "members"), order, size, rounds)


def _source(docs: DataFrame, size: int):
    """``docs`` with a key of its text, and the broadcast order of shingles."""
    order = shingle_order(docs, size=size)
    return docs.withColumn("_key", F.md5("text")), docs.sparkSession.sparkContext.broadcast(order)


def _groups(source: DataFrame, known: DataFrame, order, size: int, rounds: tuple[int, ...]) -> DataFrame:
    columns = {"n": "n_shingles", "sketch": "_sketch", "_rare": "_rare", "_common": "_common", "_key": "_key"}
    heads = known.where("vertex IS NOT NULL").groupBy("vertex").agg(*[F.max(c).alias(name) for name, c in columns.items()])
    heads = saved(heads, "heads")
    buckets = order.value.buckets
    entries = _unpacked(prefixes(heads, repeated(source, order, buckets, size), order, buckets))
    entries = saved(entries.withColumns({"group": F.col("vertex"), "weight": F.lit(1).cast("long")}), "prefixes")
    entries = saved(_open(entries), "entries")
    heads = saved(heads.select("vertex", "n", "sketch", "_key").join(entries.select("vertex").distinct(), "vertex", "left_semi"), "wanted")
    texts = source.select("_key", "text").join(heads.select("_key"), "_key", "left_semi").groupBy("_key").agg(F.max("text").alias("text"))
    sets = saved(heads.join(texts, "_key").drop("_key"), "sets")

    groups = tried = None
    for number, hubs in enumerate(rounds):
        last = number == len(rounds) - 1
        ranked = [F.min(F.struct(F.xxhash64("vertex", F.lit(100 * number + k)), _entry("y"))) for k in range(hubs)]
        each = entries.groupBy("token").agg(F.array(*ranked).alias("_hubs"))
        looking = _sides(entries).where("NOT _in_main") if last else entries.withColumn("_main", F.lit(None))
        met = looking.select("token", "_main", _entry("x")).join(each, "token")
        slots = F.array_distinct(F.transform("_hubs", lambda h: h["y"])) if last else F.transform("_hubs", lambda h: h["y"])
        is_hub = F.exists("_hubs", lambda h: h["y"]["vertex"] == F.col("x.vertex"))
        met = met.select("x", "_main", is_hub.alias("_is_hub"), F.posexplode(slots).alias("_slot", "y")).where("x.group <> y.group")
        # A hub may stand for some of the shared tokens only, so few are enough.
        if last:
            # two hubs outside the main component look for each other
            met = met.where("NOT (_is_hub AND y.group <> _main AND x.vertex > y.vertex)")
            pairs = _candidates(met, tried, 2).select("a", "b")
        else:  # one pair per vertex and slot
            best = F.max_by("b", F.struct("shared", "b")).alias("b")
            pairs = _candidates(met, tried, 2, "_slot").groupBy("a", "_slot").agg(best)
            pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = saved(pairs, "pairs")
        tried = pairs if tried is None else tried.union(pairs)
        moved = components(_as_groups(_linked(pairs, sets, size), groups))
        groups = _relabelled(groups, moved)
        entries = saved(_open(_moved(entries, moved)), "entries")

    # What still meets in several components: all vertices outside a token's main component with all others.
    sides = _sides(_same_lists(entries)).select("token", _entry("y"), "_in_main")
    rest = sides.where("NOT _in_main").select("token", F.col("y").alias("x"))
    met = rest.join(sides, "token").where("x.group <> y.group AND (_in_main OR x.vertex < y.vertex)")
    pairs = saved(_candidates(met, tried, MOST), "pairs")
    moved = components(_as_groups(_linked(pairs, sets, size), groups))
    return _relabelled(groups, moved)


def _same_lists(entries: DataFrame) -> DataFrame:
    """Tokens that exactly the same vertices have, such as those of one passage, as a single one.

    It lies at the first place of any of them and counts for all, so pairs can only be added.
    """
    lists = entries.groupBy("token").agg(F.bit_xor(F.xxhash64("vertex")).alias("_list"))
    one = entries.join(lists, "token").groupBy(F.col("_list").alias("token"), "vertex", "n", "matches", "group")
    return one.agg(F.min("place").alias("place"), F.sum("weight").alias("weight"))


def _sides(entries: DataFrame) -> DataFrame:
    """Entries, and whether they belong to the component that has most entries of their token."""
    size = F.struct("count", "group")
    main = entries.groupBy("token", "group").count().groupBy("token").agg(F.max_by("group", size).alias("_main"))
    return entries.join(main, "token").withColumn("_in_main", F.col("group") == F.col("_main"))


def _entry(name: str) -> Column:
    return F.struct("vertex", "n", "place", "matches", "group", "weight").alias(name)


def _as_groups(pairs: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Linked vertices as linked components."""
    for name in ("a", "b") if groups is not None else ():
        to = groups.select(F.col("vertex").alias(name), F.col("group").alias("_to"))
        pairs = pairs.join(to, name, "left").withColumn(name, F.coalesce("_to", name)).drop("_to")
    return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _relabelled(groups: DataFrame | None, moved: DataFrame) -> DataFrame:
    """Labels of all vertices after components have moved into others."""
    new = moved.select(F.col("u").alias("vertex"), F.col("v").alias("group"))
    if groups is None:
        return new
    old = _moved(groups, moved).select("vertex", "group")
    return saved(old.union(new.join(old, "vertex", "left_anti")), "groups")


# ---- results


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One row per document: identifier, n_shingles, component_id (smallest identifier reachable), vertex, group."""
    source = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    keyed, order = _source(source, size)
    known = saved(members(keyed, order, size=size), "members")
    groups = _groups(keyed, known, order, size, ROUNDS)
    full = known.where("vertex IS NOT NULL").join(groups, "vertex", "left").withColumn("group", F.coalesce("group", "vertex"))
    least = full.groupBy("group").agg(F.min(id_col).alias("component_id"))
    alone = known.where("vertex IS NULL").select(id_col, "n_shingles", F.col(id_col).alias("component_id"), "vertex", "vertex")
    return full.join(least, "group").select(id_col, "n_shingles", "component_id", "vertex", "group").union(alone)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """One document of each component, the one with the smallest identifier, with all its columns.

    Of rows tied in identifier and shingle set the one with the largest text stays; all documents without
    words stay.
    """
    vertex, count = free_name(docs, "_vertex"), free_name(docs, "_count")
    found = near_duplicates(docs, id_col, text_col, size)
    least = F.min(F.struct(F.col(id_col).isNull().alias("_null"), F.col(id_col), "vertex"))
    linked = found.where("vertex IS NOT NULL")
    stay = linked.groupBy("group").agg(least.alias("_stay")).select(f"_stay.{id_col}", F.col("_stay.vertex").alias(vertex))
    keyed = with_sets(docs, text_col, size, vertex, count)
    one = F.max_by(F.struct(*[F.col(c) for c in docs.columns]), F.col(text_col)).alias("_row")
    rows = keyed.where(F.col(vertex).isNotNull()).groupBy(F.col(id_col).alias("_id"), F.col(vertex).alias("_v")).agg(one)
    stay = stay.select(F.col(id_col).alias("_id"), F.col(vertex).alias("_v"))
    met = (rows["_v"] == stay["_v"]) & rows["_id"].eqNullSafe(stay["_id"])
    empty = keyed.where(F.col(vertex).isNull()).select(*docs.columns)
    return rows.join(stay, met, "left_semi").select("_row.*").union(empty)
