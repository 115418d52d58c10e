"""Perspectives, Hilbert shards and word-piece lengths against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from natalis.llm import hilbert, perspectives, wordpiece


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    order = hilbert.hilbert_index(points, bits)
    assert sorted(order) == list(range(side**dims))
    path = points[np.argsort(order)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "ab", "b", None]), rng.choice([None, 1, 5, 9]), "ä" * rng.randint(0, 50), 7) for i in range(300)]
    rows += [(5, "a", 1, None, 0)] * 40 + [(None, None, None, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, n_chars int, text string, shard int")
    for count in (24, 1, 500):
        got = hilbert.shards(docs, ["lang", "n_chars", "size"], count=count).toPandas()
        sizes = got.groupby("shard").size().reindex(range(count), fill_value=0)
        assert sizes.max() - sizes.min() <= 1 and got["shard"].between(0, count - 1).all()
        for _, part in got.groupby("shard"):
            assert sorted(part["slot"]) == list(range(len(part)))
        ordered = got.sort_values(["shard", "slot"])
        assert ordered["curve"].is_monotonic_increasing
    want = Counter((r[0], len((r[3] or "").encode()) + 8, zlib.crc32((r[3] or "").encode())) for r in rows)
    ids = [None if i != i else int(i) for i in got["doc_id"]]
    assert Counter(zip(ids, got["size"], got["text_crc32"])) == want
    assert hilbert.shards(docs.limit(0), ["lang"]).count() == 0


def greedy(word, first, rest):
    at, pieces = 0, 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in (rest if at else first):
                break
        else:
            return 1
        at, pieces = end, pieces + 1
    return pieces


def test_lengths_equal_greedy_pieces():
    rng = random.Random(4)
    for _ in range(300):
        some = lambda: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5)))
        first, rest = {some() for _ in range(rng.randint(1, 8))}, {some() for _ in range(rng.randint(0, 8))}
        automaton = wordpiece.LengthAutomaton(first, rest)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12)))
            assert automaton.length(word) == greedy(word, first, rest)


def test_token_counts(spark):
    import json

    import public_tokenizers as public

    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    letters = {v: k for k, v in wordpiece.byte_letters().items()}
    pieces = {bytes({v: k for k, v in letters.items()}[c] for c in p) for p in vocab if p != "<|endoftext|>"}
    first, rest = {p for p in pieces if p[:1] == b" "}, {p for p in pieces if p[:1] != b" "}
    texts = [None, "", " \n", "the quick brown fox", "naïve 你好 \U0001f600 don't", "A" * 3000, "x y " * 50_000, "tie", "tie"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "null id", 2)], "doc_id int, text string, n_tokens int")
    got = {r.doc_id: (r.n_words, r.n_tokens, r.max_word_tokens) for r in wordpiece.token_counts(docs).collect()}
    for i, text in [*enumerate(texts), (None, "null id")]:
        sizes = [greedy(b" " + w, first, rest) for w in (text or "").encode().split()[:200]]
        if len((text or "").split()) <= 200:
            assert got[i] == (len(sizes), sum(sizes), max(sizes, default=0))
    assert got[6][0] == 100_000
    assert wordpiece.token_counts(docs.filter(F.lit(False))).count() == 0


def test_perspectives(spark):
    rng = random.Random(6)
    people = ["ann", "bob smith", "system", None, "user"]
    rows = [(c, rng.randint(0, 6), rng.choice(people), rng.choice(["hi", "", None, "x<|im_end|>y", "é"]), "r") for c in range(12) for _ in range(9)]
    rows += [(99, i % 700, rng.choice(people[:2]), f"turn {i}", "") for i in range(2000)]
    rows += [(None, 1, "ann", "a", ""), (None, None, "bob", "b", ""), (50, 0, "system", "alone", ""), (51, 0, "ann", "twice", ""), (51, 0, "ann", "twice", "")]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, segment string")
    got = perspectives.perspectives(table).collect()
    views = {}
    for r in got:
        views.setdefault((r.conv_id, r.perspective), []).append(r)
    clean = lambda s: "_".join(s.split()) if s and s.strip() else "unknown"
    want = {(c, clean(s)) for c, _, s, *_ in rows if s != "system"}
    assert set(views) == want
    for (conv, me), parts in views.items():
        parts.sort(key=lambda r: r.position)
        mine = [r for r in rows if r[0] == conv]
        assert [p.position for p in parts] == list(range(len(mine)))
        whole = "".join(p.segment for p in parts)
        turns = [(p.turn is not None, p.turn or 0) for p in parts]
        assert turns == sorted(turns)
        expected = Counter()
        for _, turn, speaker, text, _ in mine:
            s, t = clean(speaker), (text or "").replace("<|im_", "< |im_")
            head = "assistant" if s == me else "system" if s == "system" else f"user name={s}"
            expected[(turn, f"<|im_start|>{head}\n{t}<|im_end|>\n")] += 1
        assert Counter((p.turn, p.segment) for p in parts) == expected
        for p in parts:
            assert whole[p.start : p.stop] == p.segment
            assert (p.mask_start is not None) == (p.role == "assistant") == p.segment.startswith("<|im_start|>assistant\n")
            if p.mask_start is not None:
                assert whole[p.mask_start : p.mask_stop] == p.segment[len("<|im_start|>assistant\n") : -1]
    assert perspectives.perspectives(table.limit(0)).count() == 0


def test_cells_of_whole_values(spark):
    """Texts with a long common beginning, ties, NULLs: the cell is the share of rows with smaller values."""
    rng = random.Random(9)
    texts = [rng.choice([None, *("https://example.org/%03d" % rng.randint(0, 200) for _ in range(9))]) for _ in range(900)] + ["hot"] * 400
    df = spark.createDataFrame([(i, t, float(i % 7)) for i, t in enumerate(texts)], "id int, t string, x double").repartition(5)
    known = sorted(t for t in texts if t is not None)
    below = {t: known.index(t) for t in set(known)}
    got = {r.id: r.c for r in hilbert.quantised(df, "t", "c").collect()}
    assert got == {i: 0 if t is None else below[t] * 32 // len(known) for i, t in enumerate(texts)}
    assert len(set(got.values())) > 15
    assert {r.x: r.c for r in hilbert.quantised(df, "x", "c", bits=1).collect()}[6.0] == 1
    assert hilbert.quantised(df.limit(0), "t", "c").count() == 0


def test_curve_prunes(spark):
    """A box query needs few shards; of shards cut without an order it needs them all."""
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(0, 900), "https://crawl.example/%04d" % rng.randint(0, 400), rng.random()) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string, score double")
    placed = {r.doc_id: r.shard for r in hilbert.shards(df, ["source", "score", "size"]).collect()}

    def share(shard_of):
        edges = {}
        for key, text, source, score in rows:
            point = (source, score, len(text) + 8)
            low, high = edges.setdefault(shard_of(key), [list(point), list(point)])
            for d in range(3):
                low[d], high[d] = min(low[d], point[d]), max(high[d], point[d])
        read = 0
        for _ in range(60):
            a, b, c = rng.randint(0, 360), rng.random() * 0.9, rng.randint(0, 800)
            box = (("https://crawl.example/%04d" % a, b, c), ("https://crawl.example/%04d" % (a + 40), b + 0.1, c + 100))
            read += sum(all(low[d] <= box[1][d] and high[d] >= box[0][d] for d in range(3)) for low, high in edges.values())
        return read / (60 * len(edges))

    assert share(lambda key: key % 24) > 0.95
    assert share(placed.get) < 0.3
