"""Alignment of the tokens of two tokenizers by the byte offsets where both end, and counts of linked ids.

Inside a task everything is Arrow: tokens are list columns, flattened with their parent indices; their ends are
cumulative byte lengths, segmented by document; an Acero hash join on (document, end) finds the offsets where both
tokenizers end, which cut each document into groups; a second one on the group links every token of one
side with every token of the other. ``Table.group_by`` reduces links to distinct id pairs per document.

1. :func:`links` writes one row per document: counts, digest, its distinct id pairs and how often each occurs.
2. :func:`pair_counts` counts in how many documents each pair occurs: ``Table.group_by`` partial counts, summed by Spark.
3. :func:`align` gives the counts back to the documents. The most frequent pairs, ``HOT`` at most, are looked up in a
   broadcast array, so a pair that every document has is never shuffled; all others meet in a join.

Tokenizers are slow and texts repeat their words, so ids of parts are remembered (:mod:`tallyworks.llm.parts`). A part
begins at a space that follows something other than white space: neither tokenizer has a token over such a place, so both
end there. For the same reason texts longer than a block are aligned in stretches of whole parts and their
results added up.

Defined cases: null and empty texts, and texts whose tokens do not give back their bytes, have no tokens: zeros and an
empty digest. An empty table gives an empty result; every row counts as a document of its own, also where rows or identifiers
repeat or are null; extra columns are not read. Memory grows with the longest stretch without such a space and the distinct pairs of a
document.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.llm import words as W
from tallyworks.llm.common import map_arrow, saved
from tallyworks.llm.parts import Memory, Pool

#: Most id pairs that are broadcast with their counts: 16 bytes each.
HOT = 1 << 19
#: Parts whose ids a task remembers.
REMEMBERED = 600_000
#: Links of one group from which on its ids are counted before they are linked.
_WIDE = 1 << 12
#: Links that are expanded at once.
EXPANDED = 1 << 21
#: Bytes of new parts that are encoded as one text.
_JOINED = 1 << 13
_B = 32  # a pair is (first id << 32) + second id
_SPACE = ord(" ")
_DIGEST = "groups_sha256"


@dataclass(frozen=True)
class Files:
    """A byte-level BPE (``ranks``: tiktoken file, with its pattern) and a sentencepiece model."""

    ranks: str
    pattern: str
    pieces: str


class Tokenizers:
    """Ids and token bytes of both tokenizers."""

    def __init__(self, files: Files) -> None:
        import sentencepiece
        import tiktoken

        with open(files.ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = files.pattern
        self.bytes_bpe = tiktoken.Encoding("bytes", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces_bpe = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        first: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            first[number] = token
        second = []
        for k in range(self.pieces_bpe.get_piece_size()):
            piece = self.pieces_bpe.id_to_piece(k)
            second.append(bytes([int(piece[1:-1], 16)]) if self.pieces_bpe.is_byte(k) else piece.replace("▁", " ").encode())
        self.token_bytes = [pa.array(first, pa.binary()), pa.array(second, pa.binary())]
        self.length = [pc.binary_length(t).to_numpy().astype(np.int64) for t in self.token_bytes]
        self.lone_space = self.pieces_bpe.piece_to_id("▁")

    def first_ids(self, part: str) -> list[int]:
        try:
            return self.bytes_bpe.encode_ordinary(part)
        except ValueError:  # a run of white space too long for its pattern matcher
            import regex

            found = regex.findall(self.pattern, part)
            return [k for x in found for k in self.bytes_bpe._encode_single_piece(x.encode())]

    def second_ids(self, parts: list[str]) -> list[list[int]]:
        """The model adds a space in front, so parts lose theirs; it gives nothing for an empty text."""
        found = self.pieces_bpe.encode([p[1:] for p in parts], num_threads=1)
        return [x if len(p) > 1 else [self.lone_space] for p, x in zip(parts, found)]

    def learn(self, parts: list[bytes], joinable: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of parts. ``joinable`` ones end in something other than white space: many are encoded as one text."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.flatnonzero(joinable)
        known = self._learn_joined([parts[k] for k in at.tolist()], size[at])
        if known is None:
            at, known = at[:0], [(np.empty(0, np.uint32), np.empty(0, np.int64))] * 2
        left = np.setdiff1d(np.arange(len(parts)), at, assume_unique=True)
        texts = [parts[k].decode("utf-8", "replace") for k in left.tolist()]
        place = np.empty(len(parts), np.int64)  # where each part is among the known and then the others
        place[np.append(at, left)] = np.arange(len(parts))
        out = []
        for some, (ids, n) in zip(([self.first_ids(x) for x in texts], self.second_ids(texts)), known):
            n = np.append(n, np.fromiter(map(len, some), np.int64, len(some)))
            pool = Pool()
            pool.add(np.concatenate([ids, *(np.array(x, np.uint32) for x in some)]), n)
            out.append(pool.take(place))
        return out

    def _learn_joined(self, parts: list[bytes], size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """None if a token reaches over the end of a part, as a text that does not give back its bytes may have it."""
        if not len(parts) or b"\xe2\x96\x81" in (joined := b"".join(parts)):
            return None
        cuts = np.append(0, np.cumsum(size))
        rows = np.unique(np.searchsorted(cuts, np.arange(0, cuts[-1], _JOINED)).clip(max=len(parts)))
        bounds = cuts[np.unique(np.append(rows, [0, len(parts)]))].tolist()
        texts = [joined[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]
        out = []
        for k in range(2):
            if k == 0:
                try:
                    ids = [self.bytes_bpe.encode_to_numpy(x) for x in texts]
                except ValueError:
                    return None
            else:
                ids = [np.array(x, np.uint32) for x in self.pieces_bpe.encode([x[1:] for x in texts], num_threads=1)]
            ids = np.concatenate(ids).astype(np.uint32)
            ends = np.append(0, np.cumsum(self.length[k][ids]))
            at = np.searchsorted(ends, cuts)
            if ends[-1] != cuts[-1] or not np.array_equal(ends[at], cuts):
                return None
            out.append((ids, np.diff(at)))
        return out


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin: at each text, and at spaces after anything that is surely not white space."""
    space = np.flatnonzero(data[1:] == _SPACE) + 1
    one = data[space - 1]
    two, three = data[np.maximum(space - 2, 0)], data[np.maximum(space - 3, 0)]
    blank = (one <= 0x20) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
    blank |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x9A) | (two == 0x80) | (two == 0x81))
    first = np.zeros(len(data), bool)
    first[space[~blank]] = True
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(first)


def _part_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the parts' bytes and lengths."""
    ends = np.append(starts[1:], len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * W._power("step", len(data)), out=total[1:])
    back = W._power("back", len(data) + 1)[starts]
    return W.mix((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Side:
    """The tokens of one tokenizer over some texts."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, token_bytes: pa.Array) -> None:
        tokens = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(ids, pa.uint32()))
        self.ids, self.doc = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
        length = pc.take(pc.cast(pc.binary_length(token_bytes), pa.int64()), self.ids)
        running = pc.cumulative_sum(length)
        before = np.concatenate([[0], running.to_numpy()])[bounds]  # up to each text: cuts the sum into segments
        self.end = pc.subtract(running, pc.take(pa.array(before[:-1]), self.doc))
        self.size, self.bytes = np.diff(bounds), np.diff(before)
        joined = pc.take(token_bytes.cast(pa.large_binary()), self.ids)
        buffer = joined.buffers()[2] if len(joined) else None
        self.joined = np.frombuffer(buffer, np.uint8)[: int(before[-1])] if buffer is not None else np.empty(0, np.uint8)


def _groups(one: Side, other: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group of every token of both sides, numbered over all texts, and the text of every group."""
    left = pa.table({"doc": one.doc, "end": one.end, "i": np.arange(len(one.ids))})
    right = pa.table({"doc": other.doc, "end": other.end, "j": np.arange(len(other.ids))})
    both = left.join(right, ["doc", "end"], join_type="inner", use_threads=False)
    out = []
    for name, side in (("i", one), ("j", other)):
        closes = np.zeros(len(side.ids), np.int64)
        closes[both[name].to_numpy()] = 1
        out.append(np.cumsum(closes) - closes)
    doc_of = np.empty(both.num_rows, np.int64)
    at = both["i"].to_numpy()
    doc_of[out[0][at]] = one.doc.to_numpy()[at]
    return out[0], out[1], doc_of


def _wide(group: np.ndarray, ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) without repeats."""
    table = pa.table({"group": group, "id": ids})
    table = table.group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")]).sort_by("group")
    return table["group"].to_numpy(), table["id"].to_numpy(), table["count_all"].to_numpy()


def _linked(one: Side, other: Side, groups: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.Table:
    """(doc, pair, times): every distinct pair of linked ids of a text.

    Each token of a group is repeated for every token of the other side; of groups with very many links each distinct id is
    taken once, with its number.
    """
    g, h, doc_of = groups
    n = len(doc_of)
    left, right = np.bincount(g, minlength=n), np.bincount(h, minlength=n)
    wide = left * right > _WIDE
    x, y = one.ids.to_numpy(), other.ids.to_numpy()
    times_x = times_y = None
    if wide.any():
        parts = []
        for group, ids in ((g, x), (h, y)):
            in_wide = wide[group]
            group_w, ids_w, times_w = _wide(group[in_wide], pa.array(ids[in_wide]))
            group, ids = np.append(group[~in_wide], group_w), np.append(ids[~in_wide], ids_w)
            times = np.append(np.ones(len(group) - len(group_w), np.int64), times_w)
            order = np.argsort(group, kind="stable")
            parts.append((group[order], ids[order], times[order]))
        (g, x, times_x), (h, y, times_y) = parts
        left, right = np.bincount(g, minlength=n), np.bincount(h, minlength=n)
    first = np.cumsum(right) - right
    ahead = np.cumsum(right[g])  # links up to each token of the first side
    cuts = np.searchsorted(ahead, np.arange(0, int(ahead[-1]) if len(ahead) else 0, EXPANDED)).tolist()
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(g)]):
        if a == b:
            continue
        each = right[g[a:b]]
        after = np.cumsum(each)
        j = np.repeat(first[g[a:b]] - after + each, each) + np.arange(after[-1])
        pair = (np.repeat(x[a:b].astype(np.int64), each) << _B) + y[j]
        columns = {"doc": np.repeat(doc_of[g[a:b]], each), "pair": pair}
        if times_x is None:
            out.append(summed(pa.table(columns), ([], "count_all")))
        else:
            out.append(summed(pa.table(columns | {"times": np.repeat(times_x[a:b], each) * times_y[j]})))
    return out[0] if len(out) == 1 else summed(pa.concat_tables(out)) if out else _no_links()


def _no_links() -> pa.Table:
    return pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})


def summed(table: pa.Table, how: tuple = ("times", "sum")) -> pa.Table:
    out = table.group_by(["doc", "pair"], use_threads=False).aggregate([how])
    return out.rename_columns(["doc", "pair", "times"])


class _Written:
    """Decimal ids with the character after them, as one string table for ``take``."""

    def __init__(self, tokens: list[int]) -> None:
        self.base = np.cumsum([0, *(2 * n for n in tokens)])
        marks = ((",", "|"), (",", ";"))
        self.strings = pa.array([f"{k}{m}" for n, pair in zip(tokens, marks) for m in pair for k in range(n)], pa.large_string())
        self.tokens = tokens

    def text(self, one: Side, other: Side, groups: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
        """All texts' groups, and where each text's begin; every group ends with a semicolon."""
        g, h, _ = groups
        place = [np.arange(len(g)) + np.searchsorted(h, g), np.arange(len(h)) + np.searchsorted(g, h, "right")]
        code = np.empty(len(g) + len(h), np.int64)
        for k, (side, group) in enumerate(((one, g), (other, h))):
            last = np.ones(len(group), np.int64)
            last[:-1] = group[1:] != group[:-1]
            code[place[k]] = self.base[k] + last * self.tokens[k] + side.ids.to_numpy()
        written = pc.take(self.strings, pa.array(code))
        offsets = np.frombuffer(written.buffers()[1], np.int64)[: len(code) + 1] if len(code) else np.zeros(1, np.int64)
        bounds = np.concatenate([[0], np.cumsum(one.size + other.size)])
        return (written.buffers()[2] if len(code) else b""), offsets[bounds]


class Aligner:
    """Aligns texts; remembers parts as long as it lives."""

    def __init__(self, files: Files) -> None:
        self.tokenizers = Tokenizers(files)
        self.memory = Memory(2, REMEMBERED)
        self.written = _Written([len(t) for t in self.tokenizers.token_bytes])

    def _sides(self, data: np.ndarray, offsets: np.ndarray) -> list[Side]:
        starts = part_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        raw = data.tobytes()

        def learn(new: np.ndarray):
            inner = ~np.isin(ends[new], offsets)  # before another part of its text
            return self.tokenizers.learn([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())], inner)

        slot = self.memory.slots(_part_hashes(data, starts), learn)
        first = np.searchsorted(starts, offsets)
        out = []
        for pool, token_bytes in zip(self.memory.pools, self.tokenizers.token_bytes):
            ids, size = pool.take(slot)
            out.append(Side(ids, np.concatenate([[0], np.cumsum(size)])[first], token_bytes))
        return out

    def stretch(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Table, bytes, np.ndarray]:
        """For texts that begin with a space: (valid, counts, pairs, groups as text, where each text's begin)."""
        one, other = self._sides(data, offsets)
        valid = (one.bytes == np.diff(offsets)) & (other.bytes == np.diff(offsets))
        for side in (one, other):
            if valid.all() and np.array_equal(side.joined, data):
                continue
            at = np.concatenate([[0], np.cumsum(side.bytes)])
            for k in np.flatnonzero(valid):
                valid[k] = np.array_equal(side.joined[at[k] : at[k + 1]], data[offsets[k] : offsets[k + 1]])
        if not valid.all():  # once more without the others
            keep = np.flatnonzero(valid)
            size = np.where(valid, np.diff(offsets), 0)
            data = np.concatenate([np.empty(0, np.uint8), *(data[offsets[k] : offsets[k + 1]] for k in keep)])
            offsets = np.concatenate([[0], np.cumsum(size)])
            one, other = self._sides(data, offsets)
        groups = _groups(one, other)
        pairs = _linked(one, other, groups)
        g, h, doc_of = groups
        n = len(offsets) - 1
        per_group = np.bincount(g, minlength=len(doc_of)) * np.bincount(h, minlength=len(doc_of))
        links = np.zeros(n, np.int64)
        np.add.at(links, doc_of, per_group)
        counts = np.stack([one.size, other.size, np.bincount(doc_of, minlength=n), links], axis=1)
        text, bounds = self.written.text(one, other, groups)
        return valid, counts, pairs, text, bounds

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, list[str], pa.Table]:
        """Counts (n_a, n_b, n_groups, n_links), digest and pairs of every text."""
        data, offsets = W.flat(column)
        size = np.diff(offsets)
        n = len(size)
        spaced = np.full(len(data) + np.count_nonzero(size), _SPACE, np.uint8)
        new = np.concatenate([[0], np.cumsum(np.where(size > 0, size + 1, 0))])
        put = np.ones(len(spaced), bool)
        put[new[:-1][size > 0]] = False
        spaced[put] = data
        if len(spaced) <= 2 * W.BLOCK or n > 1:
            valid, counts, pairs, text, bounds = self.stretch(spaced, new)
            text = memoryview(text)
            digests = [hashlib.sha256(text[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            return counts, digests, pairs
        # one long text: stretches of whole parts
        starts = part_starts(spaced, new)
        cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(spaced), W.BLOCK)).clip(max=len(starts) - 1))]
        cuts = [0, *(c for c in cuts.tolist() if c), len(spaced)]
        digest, counts, pairs, left = hashlib.sha256(), np.zeros((1, 4), np.int64), [], b""
        for a, b in zip(cuts, cuts[1:]):
            valid, some, found, text, _ = self.stretch(spaced[a:b], np.array([0, b - a]))
            if not valid.all():
                return np.zeros((1, 4), np.int64), [""], _no_links()
            counts += some
            pairs = [summed(pa.concat_tables([*pairs, found]))]
            digest.update(left)
            text = memoryview(text)[: len(text)]
            digest.update(text[: _[-1] - 1])
            left = b";"
        return counts, [digest.hexdigest()], pairs[0]


def links(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written rows (row, id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times), one per document."""
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("id", docs.schema[id_col].dataType),
            *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
            T.StructField(_DIGEST, T.StringType()),
            T.StructField("pairs", T.ArrayType(T.LongType())),
            T.StructField("times", T.ArrayType(T.LongType())),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align_texts = Aligner(files)
        at = TaskContext.get().partitionId() << 40
        for batch in (part for whole in batches for part in W.slices(whole, "text")):
            counts, digests, pairs = align_texts(batch.column(1))
            pairs = pairs.sort_by([("doc", "ascending"), ("pair", "ascending")])
            bounds = np.searchsorted(pairs["doc"].to_numpy(), np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(bounds), pairs[c].combine_chunks()) for c in ("pair", "times")]
            arrays = [
                pa.array(at + np.arange(batch.num_rows)),
                batch.column(0),
                *(pa.array(counts[:, k]) for k in range(4)),
                pa.array(digests, pa.string()),
                *lists,
            ]
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return saved(map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), extract, schema), "links")


def pair_counts(linked: DataFrame) -> DataFrame:
    """Written (pair, n, best): how many documents hold a pair, and whether that is its first id's highest count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = pa.table({"pair": pc.list_flatten(batch.column(0))})
            partial = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            yield from partial.rename_columns(["pair", "n"]).to_batches()

    counts = map_arrow(linked.select("pairs"), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = saved(counts.withColumn("first", F.shiftright("pair", _B)), "pair-counts")
    highest = counts.groupBy("first").agg(F.max("n").alias("highest"))  # one row per id of the vocabulary
    best = F.col("n") == F.col("highest")
    return saved(counts.join(F.broadcast(highest), "first").select("pair", "n", best.alias("best")), "pair-best")


def _frequent(counts: DataFrame, most: int) -> int:
    """The smallest power-of-two class of counts from which on at most ``most`` pairs remain."""
    sizes = {r["class"]: r["count"] for r in counts.groupBy(F.floor(F.log2("n")).alias("class")).count().collect()}  # 64 rows at most
    least, total = 64, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        least = k
    return least


def align(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    linked = links(docs, files, id_col, text_col)
    counts = pair_counts(linked)
    frequent = F.col("n") >= F.lit(1 << min(_frequent(counts, hot), 62))
    top = counts.where(frequent).toArrow().sort_by("pair")
    shared = docs.sparkSession.sparkContext.broadcast([top[c].to_numpy() for c in ("pair", "n", "best")])
    columns = ["row", "id", "n_a", "n_b", "n_groups", "n_links", _DIGEST]
    kept = [linked.schema[c] for c in columns]
    rest_kind = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())]))
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), T.StructField("rest", rest_kind)])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            rows = pc.list_parent_indices(batch.column("pairs")).to_numpy()
            pair, times = (pc.list_flatten(batch.column(c)).to_numpy() for c in ("pairs", "times"))
            at = np.searchsorted(keys, pair)
            found = at < len(keys)
            found[found] = keys[at[found]] == pair[found]
            at, seen, weight = at[found], rows[found], times[found]
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, seen, weight * best[at])
            np.add.at(total, seen, weight * n[at])
            cut = np.searchsorted(rows[~found], np.arange(batch.num_rows + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(pair[~found]), pa.array(times[~found])], ["pair", "times"])
            rest = pa.ListArray.from_arrays(pa.array(cut), pairs)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(n_best), pa.array(total), rest], schema.names)

    looked = saved(map_arrow(linked, look_up, schema), "looked-up")
    rare = looked.where(F.size("rest") > 0).select("row", F.inline("rest"))
    more = (
        rare.join(counts.where(~frequent), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    )
    return looked.join(more, "row", "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        _DIGEST,
    )
