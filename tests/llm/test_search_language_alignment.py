"""Ranked search, language identification and token alignment against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyworks.llm import alignment, language, retrieval
from tallyworks.llm import words as W

PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILES = alignment.Files(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item string, rank string, score int, n_a int, row int, lang string, lang_pred string"
OTHER = ("x", "y", 1, 2, 3, "en", "z")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- ranked search


def ranked(docs, items, top=10):
    """(item, its row, rank, doc_id, score) as the contract has it."""
    words = [(name, TERM.findall(lower(text))) for name, text in docs]
    words = [(name, Counter(w), len(w)) for name, w in words if w]
    total = sum(n for _, _, n in words)
    df = Counter(t for _, w, _ in words for t in w)
    out = []
    for item, text in items:
        scored = []
        for name, w, n in words:
            m = 100 - 90 + (90 * n * len(words)) // total
            score = 0
            for t in set(TERM.findall(lower(text))):
                if t in w:
                    weight = math.floor(1000 * math.log((2 * len(words) + 2) / (2 * df[t] + 1)))
                    score += weight * ((1000000000 * w[t]) // (1000 * w[t] + 8 * m))
            if score > 0:
                scored.append((-score, name is None, name, score))
        out += [(item, k, name, score) for k, (_, _, name, score) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return Counter(out)


def some_texts(rng, n):
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "été", "ONE", "two2", "日本"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("shard, seeds, at_once, block", [(4096, 20_000, 1000, 16), (7, 10, 3, 2)])
def test_search(spark, monkeypatch, shard, seeds, at_once, block):
    rng = random.Random(3)
    texts = some_texts(rng, 150)
    rows = [(k, t) for k, t in enumerate(texts)] + [(500 + k, texts[9]) for k in range(40)]  # ties and copies
    rows += [(None, texts[3]), (7, texts[7]), (600, None), (601, ""), (602, " .;"), (603, "w1 " * 30_000), (604, "w2" * 90_000)]
    items = [(k, t) for k, t in enumerate(some_texts(rng, 12))] + [(90, None), (91, ""), (92, "w1"), (93, "never said"), (0, "É two2 two2"), (None, "w3 w4")]
    monkeypatch.setattr(retrieval, "SHARD", shard)
    monkeypatch.setattr(retrieval, "BLOCK_DOCS", block)
    docs = spark.createDataFrame([(a, b, *OTHER) for a, b in rows], DOCS).repartition(4)
    queries = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, doc_id int")
    # the real bound on cells would make one shard of these
    if shard < 10:
        monkeypatch.setattr(retrieval, "CELLS", 1)
    found = retrieval.search(docs, queries, seeds=seeds, at_once=at_once)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == ranked(rows, items)
    assert retrieval.search(docs.limit(0), queries).count() == retrieval.search(docs, queries.limit(0)).count() == 0


def test_blocks_are_skipped_by_bounds_only():
    """Every block that is not opened has a bound below the threshold, and summaries are maxima of their members."""
    rng = np.random.default_rng(2)
    dense = rng.integers(1, 1000, (300, 12)) * (rng.random((300, 12)) < 0.4)
    row, term = np.nonzero(dense)
    shard = retrieval.Shard(term, row, dense[row, term], 300, [np.arange(12)] * 12)
    for t in range(12):
        b = shard.blocks(t)
        assert sorted(b.members.tolist()) == np.flatnonzero(dense[:, t]).tolist()
        for s, e, m in zip(b.starts, [*b.starts[1:], len(b.members)], b.maxima):
            assert (dense[b.members[s:e]].max(axis=0) == m).all()
    weight = np.arange(1, 13)
    top = retrieval._Top(5)
    top.ids = list(range(300))
    offered = []
    offer = top.offer
    top.offer = lambda docs, scores, threshold: (offered.extend(docs.tolist()), offer(docs, scores, threshold))
    shard.search(np.arange(12), weight, 1, top)
    scores = dense @ weight
    assert [x[0] for x in top.found] == sorted(scores.tolist(), reverse=True)[:5]
    assert len(offered) == len(set(offered)) < 300


# ---- language


def test_forward_sums_all_segmentations():
    vocabulary = language.Vocabulary(PIECES)
    rng = np.random.default_rng(1)
    logs = np.log(rng.dirichlet(np.ones(len(vocabulary.pieces)), 2)).T
    model = language.Model(vocabulary, ["a", "b"], logs)
    number = {p: k for k, p in enumerate(vocabulary.pieces)}
    words = [b"the", b"a", "été".encode(), b"thing", b"xqz", "日本".encode(), b"the"]

    def segmentations(rest):
        if not rest:
            yield []
        for n in range(1, len(rest) + 1):
            if rest[:n] in number:
                yield from ([number[rest[:n]], *more] for more in segmentations(rest[n:]))

    found = model.words(words)
    expected = model.expected(words, np.array([[1.0, 0.5]] * len(words)))
    wanted = np.zeros_like(expected)
    for word, log in zip(words, found):
        ways = list(segmentations(b" " + word))
        chance = np.array([np.exp(sum(logs[k] for k in way)) for way in ways])
        assert np.allclose(log, np.log(chance.sum(axis=0)))
        for way, p in zip(ways, chance / chance.sum(axis=0)):
            for k in way:
                wanted[k] += p * [1.0, 0.5]
    assert np.allclose(expected, wanted)


def test_language(spark):
    words = {"en": "the and of with house river", "fr": "le les et avec maison rivière", "de": "der und mit haus fluß straße"}
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(words[lang].split(), k=8)), lang) for k, lang in enumerate(["en", "fr", "de"] * 40)]
    train = spark.createDataFrame([*rows, (900, "the", None), (901, None, "en"), (902, "", "fr")], "doc_id long, text string, lang string").repartition(3)
    model = language.fit(train, PIECES)
    assert model.languages == ["de", "en", "fr"]
    assert np.allclose(np.exp(model.logs).sum(axis=0), 1)
    texts = [None, "", "12 34 ...", "— …", "THE RIVER of", "la rivière et les", "straßenfluß", "é", "the " * 50_000, "q" * 200_000, "the", "the"]
    asked = spark.createDataFrame([(k, t, "s", "s") for k, t in enumerate(texts)] + [(None, "und der", None, None)], "doc_id long, text string, lang string, word string")
    found = {(r.doc_id, r.text): r for r in language.predict(asked, model).collect()}
    got = [found[k, t].lang_pred for k, t in enumerate(texts)]
    assert got[:7] == ["und"] * 4 + ["en", "fr", "de"] and got[8] == got[10] == got[11] == "en" and found[None, "und der"].lang_pred == "de"
    assert all(r.score == 0 if r.lang_pred == "und" else 1 / 3 < r.score <= 1 for r in found.values())
    assert language.predict(asked.limit(0), model).count() == 0
    nothing = language.fit(train.limit(0), PIECES)
    assert {(r.lang_pred, r.score) for r in language.predict(asked, nothing).collect()} == {("und", 0.0)}
    with pytest.raises(ValueError):
        language.predict(asked.withColumn("Score", asked.doc_id), model)


def test_long_runs_are_read_in_stretches():
    text = "ab" * 100 + " ab"
    hashes, row, start, end, data = language.word_table(pa.array([text, None, "ab"]))
    parts = [bytes(data[a:b]).decode() for a, b in zip(start, end)]
    assert "".join(parts[:-2]) == "ab" * 100 and max(map(len, parts)) == language.LONGEST - 1
    assert row.tolist() == [0] * (len(parts) - 1) + [2] and hashes[-1] == hashes[-2] and len(set(hashes[:4:2].tolist())) == 1


def test_words_over_a_block_take_linear_time(monkeypatch):
    monkeypatch.setattr(W, "BLOCK", 1 << 12)
    monkeypatch.setattr(W, "_powers", {})
    rows = ["b" * 50_000, "b c", "b" * 50_000 + " b", *["b"] * 5_000]
    w = W.words(*W.flat(pa.array(rows)), W.ALNUM)
    assert (w.end - w.start).tolist() == [50_000, 1, 1, 50_000, 1, *[1] * 5_000]
    assert w.hash[0] == w.hash[3] and len(set(w.hash[4:].tolist())) == 1 and w.row[-1] == len(rows) - 1


def test_held_out_languages(spark, small):
    docs = spark.read.parquet(small.replace("sf0.001", "sf0.01") + "/documents.parquet")
    model = language.fit(docs.where(~language.held_out(docs.doc_id)), PIECES)
    right = language.predict(docs.where(language.held_out(docs.doc_id)), model).selectExpr("avg(CAST(lang = lang_pred AS INT))").first()[0]
    assert right > 0.98


# ---- alignment


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=FILES.pieces), [t.to_pylist() for t in alignment.Tokenizers(FILES).token_bytes]


def aligned(text, tokenizers):
    """(counts, digest, occurrences of pairs) by the libraries' own ids."""
    first, second, token_bytes = tokenizers
    none = ((0, 0, 0, 0), "", Counter())
    if not text:
        return none
    ids = [first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)]
    whole = (" " + text).encode()
    ends = []
    for some, names in zip(ids, token_bytes):
        if b"".join(names[k] for k in some) != whole:
            return none
        ends.append(np.cumsum([len(names[k]) for k in some]).tolist())
    shared = sorted(set(ends[0]) & set(ends[1]))
    at, pairs, written, links = [0, 0], Counter(), [], 0
    for end in shared:
        group = []
        for k in range(2):
            low = at[k]
            while at[k] < len(ids[k]) and ends[k][at[k]] <= end:
                at[k] += 1
            group.append(ids[k][low : at[k]])
        written.append("|".join(",".join(map(str, g)) for g in group))
        links += len(group[0]) * len(group[1])
        pairs.update((a, b) for a in group[0] for b in group[1])
    return (len(ids[0]), len(ids[1]), len(shared), links), hashlib.sha256(";".join(written).encode()).hexdigest(), pairs


ODD = [
    None, "", " ", "  a ", "a\n", "a\nb", " ▁x", "x▁ y", "\t  b", "a   b", "a　 b", "​ x", "<|endoftext|> <s> hi", "é ñ ó́  z",
    "\x00 a\x00", "日本語 の テスト", "🙂 🙂🙂", "a" * 300 + " b", "x" + " " * 70_000 + "y", "﻿a b", "ﬁ ﬂ", "it's we'll  don't", "12345 6.7\r\n\r\n  end ",
    "é à", "\xa0 x", "\x85  y", "plain words, some more words. 12", "plain words, some more words. 12",
]


@pytest.mark.parametrize("hot", [alignment.HOT, 8, 0])
def test_alignment(spark, small, tokenizers, hot):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[-1]), (0, None), (26, texts[26])]
    docs = spark.createDataFrame([(a, b, *OTHER) for a, b in rows], DOCS).repartition(3)
    wanted = [(name, *aligned(text, tokenizers)) for name, text in rows]
    often = Counter(pair for _, _, _, pairs in wanted for pair in pairs)
    best = defaultdict(int)
    for (a, _), n in often.items():
        best[a] = max(best[a], n)
    out = Counter()
    for name, counts, digest, pairs in wanted:
        n_best = sum(n for (a, b), n in pairs.items() if often[a, b] == best[a])
        out[(name, *counts, n_best, sum(n * often[p] for p, n in pairs.items()), digest)] += 1
    found = alignment.align(docs, FILES, hot=hot)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in found.collect()) == out
    assert alignment.align(docs.limit(0), FILES).count() == 0


def test_alignment_of_long_texts_in_stretches(small, tokenizers, monkeypatch):
    import pyarrow.parquet as pq

    texts = [t for t in pq.read_table(f"{small}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    monkeypatch.setattr(W, "BLOCK", 1 << 12)
    monkeypatch.setattr(alignment, "_WIDE", 2)
    align = alignment.Aligner(FILES)
    for text in (" ".join(texts[:40]), "ab " * 9_000 + "▁", "é" * 9_000, "".join(chr(0x4E00 + k % 997) for k in range(9_000))):
        counts, digest, pairs = align(pa.array([text]))
        n, wanted, some = aligned(text, tokenizers)
        assert tuple(counts[0].tolist()) == n and digest == [wanted]
        found = {(p >> 32, p & 0xFFFFFFFF): k for p, k in zip(pairs["pair"].to_pylist(), pairs["times"].to_pylist())}
        assert found == dict(some)


def test_forgetting_parts_changes_nothing(tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    align = alignment.Aligner(FILES)
    for text in ["one two three four", "five six one", "seven eight nine ten one two", "one two three four"]:
        counts, digest, _ = align(pa.array([text, None, text]))
        n, wanted, _ = aligned(text, tokenizers)
        assert [tuple(c) for c in counts.tolist()] == [n, (0, 0, 0, 0), n] and digest == [wanted, "", wanted]
