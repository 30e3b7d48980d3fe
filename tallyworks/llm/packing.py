"""Best-fit packing of tokenised documents by a linear grouping scheme.

1. Pieces of at most ``capacity`` tokens are counted by length: ``capacity`` numbers at most.
2. Large lengths, sorted downwards, fall into groups of equal cardinality and are rounded up to the
   longest of their group; few sizes remain.
3. Configurations of these sizes (which sizes share a sequence) come from the configuration linear programme,
   solved by column generation with a knapsack for the prices; its floor is used, the rest packed greedily.
4. The actual lengths take the places of their rounded ones, which frees room.
5. Small pieces go, longest first, where they fit best, then into new sequences in the same way.

Steps 2 to 5 see counts by length only, so the plan on the driver has a fixed size however many documents there
are: runs of sequences of equal content. Each piece finds its place by its rank within its length. Ranks
come from counts per (length, bucket) and a row number within; buckets hold about ``bucket_rows``
pieces, so a length that a third of all pieces have is ranked by many tasks.

Defined cases: null texts are empty and give one piece, the end token; an empty table gives an empty result;
repeated rows and null identifiers are packed like any others; extra columns do not matter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm.common import map_arrow, saved
from tallyworks.llm.parts import Memory, Pool
from tallyworks.llm.words import flat, slices, words

CAPACITY = 4096
END = 1
#: (share of the capacity from which a length counts as large, rounded sizes) to try.
CHOICES = ((0.25, 16), (0.25, 24), (0.5, 16), (0.5, 32))
BUCKET_ROWS = 100_000
#: Strings between white space whose ids a task remembers.
REMEMBERED = 500_000
#: Everything but the white space that always separates words.
NO_BLANK = np.ones(256, bool)
NO_BLANK[[0x20, 0x0A, 0x0D, 0x09]] = False


# ---- tokens


class _Encoder:
    """Ids of whole texts, exactly those of the tokenizer file.

    The tokenizer drops white space and never joins over it, so the ids of a text are those of its parts;
    parts repeat, and their ids are remembered by a 64-bit hash. A new part in plain Latin letters is split
    here and merged by tiktoken, with the file's merges as ranks and a zero byte for the file's
    end-of-word mark; any other part goes to the tokenizers library.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in letters]
        as_byte = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(hidden)}
        named = []
        for token, number in vocabulary.items():
            body = token.removesuffix("</w>")
            if all(c in as_byte for c in body) and not token.startswith("<|"):
                named.append((bytes(as_byte[c] for c in body) + b"\0" * (body != token), number))
        # A last byte and its mark join before anything else does.
        named.sort(key=lambda x: (not (len(x[0]) == 2 and x[0][1] == 0 and x[1] < 512), x[1]))
        self.ranks = tiktoken.Encoding(
            "parts", pat_str=r"[^\x00]+\x00", mergeable_ranks={b: k for k, (b, _) in enumerate(named)}, special_tokens={}
        )
        self.number = np.array([n for _, n in named], np.uint32)
        self.ends = np.array([b.endswith(b"\0") for b, _ in named])
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.plain = re.compile(r"[!-~\u00A1-\u012F\u0131-\u024F]+")
        self.memory = Memory(1, REMEMBERED)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and end."""
        w = words(data, offsets, NO_BLANK)
        raw = w.data.tobytes()

        def learn(new: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
            spans = zip(w.start[new].tolist(), w.end[new].tolist())
            return [self._learn([raw[a:b].decode("utf-8", "replace") for a, b in spans])]

        slot = self.memory.slots(w.hash, learn)
        ids, size = self.memory.pools[0].take(slot)
        after = np.concatenate([[0], np.cumsum(size)])
        return ids, after[np.searchsorted(w.row, np.arange(len(offsets)))]

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these parts in a row, and how many each has."""
        words_of = [self._words(p) for p in new]
        tokens = self.ranks.encode_to_numpy("".join([f"{w}\0" for some in words_of if some for w in some]))
        after = np.concatenate([[0], np.flatnonzero(self.ends[tokens]) + 1])
        cuts = after[np.cumsum([0, *(len(some or ()) for some in words_of)])]
        others = [k for k, some in enumerate(words_of) if some is None]
        found = [np.array(self.tokenizer.encode(new[k], add_special_tokens=False).ids, np.uint32) for k in others]
        pool = Pool()
        size = np.append(np.diff(cuts), [len(x) for x in found]).astype(np.int64)
        pool.add(np.concatenate([self.number[tokens], *found]), size)
        place = np.arange(len(new))
        place[others] = len(new) + np.arange(len(others))
        return pool.take(place)

    def _words(self, part: str) -> list[str] | None:
        """The tokenizer's words of a plain part; None for any other."""
        if not self.plain.fullmatch(part) or "<|" in part:
            return None
        if part.isalpha():
            return [part.lower()]
        if part[-1] in ",.;:!?" and part[:-1].isalpha():
            return [part[:-1].lower(), part[-1]]
        return self.split.findall(part.lower())


def pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): each text's ids and the end token, cut at ``capacity``."""
    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(tokenizer)  # goes with the task, and what it remembers with it
        last = np.array([end], np.uint32)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            ids, bounds = encode(*flat(batch.column(1)))
            counts = np.diff(bounds) + 1
            parts = -(-counts // capacity)
            at = np.repeat(np.arange(batch.num_rows), parts)
            number = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = number * capacity
            length = np.minimum(counts[at] - start, capacity)
            low = bounds[at] + start
            high = np.minimum(low + length, bounds[at + 1])
            little = ids.astype("<u4", copy=False)
            cut_ids = [little[a:b] if b - a == n else np.concatenate([little[a:b], last]) for a, b, n in zip(low, high, length)]
            arrays = [
                batch.column(0).take(pa.array(at)),
                pa.array(number, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array([zlib.crc32(x) for x in cut_ids], pa.int64()),
                *([pa.array([x.astype(np.int32) for x in cut_ids], pa.list_(pa.int32()))] if with_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return map_arrow(docs.select(F.col(id_col), F.col(text_col).alias("text")), cut, T.StructType(fields))


# ---- the plan over counts of lengths


def _configurations(sizes: list[int], wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of configurations that hold at least ``wanted`` pieces of each rounded size.

    Column generation: the basis starts with one size per configuration; the best new one is a knapsack
    over the current prices.
    """
    k = len(sizes)
    basis = np.diag([capacity // s for s in sizes]).astype(float)
    for _ in range(40 * k):
        inverse = np.linalg.inv(basis)
        price = inverse.sum(axis=0)
        column, value = _knapsack(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        x, way = inverse @ wanted, inverse @ column
        ratio = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    x = np.floor(np.maximum(np.linalg.solve(basis, wanted), 0) + 1e-6).astype(np.int64)
    chosen = [(basis[:, j].astype(np.int64), int(x[j])) for j in range(k) if x[j]]
    left = np.maximum(wanted - sum((c * n for c, n in chosen), np.zeros(k, np.int64)), 0).astype(np.int64)
    while left.any():
        room, config = capacity, np.zeros(k, np.int64)
        for j in range(k):  # longest first
            config[j] = min(left[j], room // sizes[j])
            room -= config[j] * sizes[j]
        often = int(min(left[j] // config[j] for j in range(k) if config[j]))
        chosen.append((config, often))
        left -= config * often
    return chosen


def _knapsack(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    best = np.zeros(capacity + 1)
    used = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    size, worth = np.array(sizes)[order], price[order]
    for room in range(int(size[0]), capacity + 1):
        n = int(np.searchsorted(size, room, "right"))
        gain = best[room - size[:n]] + worth[:n]
        j = int(np.argmax(gain))
        if gain[j] > best[room - 1] + 1e-12:
            best[room], used[room] = gain[j], j
        else:
            best[room] = best[room - 1]
    column, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if used[room] < 0:
            room -= 1
        else:
            column[order[used[room]]] += 1
            room -= int(size[used[room]])
    return column, float(best[capacity])


class _Plan:
    """Places by rank: rows (length, first rank, ranks, first sequence, pieces in each, offset in the first)."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.taken: dict[int, int] = {}
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = {}  # free room -> runs of (first sequence, sequences)

    def put(self, length: int, first: int, sequences: int, each: int, offset: int) -> None:
        rank = self.taken.get(length, 0)
        self.rows.append((length, rank, sequences * each, first, each, offset))
        self.taken[length] = rank + sequences * each

    def large(self, counts: dict[int, int], groups: int) -> None:
        lengths = sorted(counts, reverse=True)
        total = sum(counts.values())
        size, group_of, seen = max(1, -(-total // groups)), {}, 0
        for length in lengths:  # one length stays in one group
            group_of[length] = seen // size
            seen += counts[length]
        names = sorted(set(group_of.values()))
        members = {g: [x for x in lengths if group_of[x] == g] for g in names}
        rounded = [members[g][0] for g in names]
        wanted = np.array([sum(counts[x] for x in members[g]) for g in names])
        queue = {g: [[x, counts[x]] for x in members[g]] for g in names}
        for config, often in _configurations(rounded, wanted, self.capacity):
            slots = [g for g, n in zip(names, config) for _ in range(int(n))]
            self._substitute(slots, often, queue)

    def _substitute(self, slots: list[int], often: int, queue: dict[int, list]) -> None:
        """Fill ``often`` sequences of these slots with actual lengths: a run for each change of a length."""
        left = often
        while left:
            need = {g: slots.count(g) for g in set(slots)}
            # as many sequences as the current lengths of all groups last for
            now, run = [], left
            for g, n in need.items():
                if queue[g]:
                    length, have = queue[g][0]
                    if have >= n:
                        run = min(run, have // n)
                    else:
                        run = 1
            for g, n in need.items():
                for _ in range(n):
                    if not queue[g]:
                        continue  # the configurations hold more than wanted
                    now.append(self._pop(g, queue, run, n))
            flat: dict[int, int] = {}
            for length in now:
                flat[length] = flat.get(length, 0) + 1
            self._open(flat, run)
            left -= run

    @staticmethod
    def _pop(g: int, queue: dict[int, list], run: int, n: int) -> int:
        entry = queue[g][0]
        entry[1] -= run
        if entry[1] == 0:
            queue[g].pop(0)
        return entry[0]

    def _open(self, content: dict[int, int], sequences: int) -> None:
        if not content:
            return
        offset = 0
        for length, each in sorted(content.items(), reverse=True):
            self.put(length, self.sequences, sequences, each, offset)
            offset += length * each
        self.open.setdefault(self.capacity - offset, []).append((self.sequences, sequences))
        self.sequences += sequences

    def small(self, counts: dict[int, int]) -> None:
        for length in sorted(counts, reverse=True):
            left = counts[length]
            while left:
                fits = [room for room in self.open if room >= length]
                if not fits:
                    each = self.capacity // length
                    if left >= each:
                        self._open({length: each}, left // each)
                    if left % each:
                        self._open({length: left % each}, 1)
                    break
                room = min(fits)
                first, n = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room]
                each = min(room // length, left)
                run = min(n, left // each)
                self.put(length, first, run, each, self.capacity - room)
                rest = room - length * each
                if rest:
                    self.open.setdefault(rest, []).append((first, run))
                if n > run:
                    self.open.setdefault(room, []).append((first + run, n - run))
                left -= run * each


def plan(counts: dict[int, int], capacity: int = CAPACITY, choices: Iterable[tuple[float, int]] = CHOICES) -> _Plan:
    """Places for ``counts`` pieces by length: of several (large share, groups), the plan with fewest sequences."""
    best = None
    for large, groups in choices:
        out = _Plan(capacity)
        if counts.get(capacity):
            out._open({capacity: 1}, counts[capacity])
        least = max(1, int(capacity * large))
        big = {x: n for x, n in counts.items() if least <= x < capacity}
        if big:
            out.large(big, groups)
        out.open.pop(0, None)
        out.small({x: n for x, n in counts.items() if x < least})
        if best is None or out.sequences < best.sequences:
            best = out
        if best.sequences * capacity - sum(x * n for x, n in counts.items()) < capacity:
            break  # no plan has fewer
    return best


# ---- places of pieces


def pack(parts: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``parts`` (from :func:`pieces`) with sequence_id and offset."""
    parts = saved(parts, "pieces")
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # ``capacity`` rows at most
    places = plan(counts, capacity)
    buckets = max(1, -(-sum(counts.values()) // bucket_rows))
    key = F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(buckets))
    bucketed = parts.withColumn("_bucket", key)
    by_length = Window.partitionBy("length").orderBy("_bucket")
    before = bucketed.groupBy("length", "_bucket").count().select(
        "length", "_bucket", (F.sum("count").over(by_length) - F.col("count")).alias("_before")
    )
    within = Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = (
        bucketed.withColumn("_rank", F.row_number().over(within) - 1)
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .select(*parts.columns, "_rank")
    )
    shared = parts.sparkSession.sparkContext.broadcast(np.array(sorted(places.rows), np.int64).reshape(-1, 6))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return map_arrow(ranked, _placer(shared, schema.names), schema)


def _placer(shared, names: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        keys = (rows[:, 0] << 44) + rows[:, 1] if len(rows) else None
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            found = rows[np.searchsorted(keys, (length << 44) + rank, "right") - 1] if len(length) else np.empty((0, 6), np.int64)
            step = rank - found[:, 1]
            sequence = found[:, 3] + step // np.maximum(found[:, 4], 1)
            offset = found[:, 5] + step % np.maximum(found[:, 4], 1) * length
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    return place


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_pieces): the sequences themselves, from pieces packed ``with_ids``."""
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(part.alias("_parts")).select(
        "sequence_id", F.flatten(F.col("_parts.ids")).alias("ids"), F.size("_parts").alias("n_pieces")
    )
