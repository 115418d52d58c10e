import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from natalis.llm import substrings
from natalis.llm.shared import words_of


def plain(rows, length):
    """(id, words, removed, digest) by comparing all windows."""
    least = {}
    split = [(key, words_of(text)) for key, text in rows]
    for key, words in split:
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if key is not None:
                least[window] = min(key, least.get(window, key))
    out = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - length + 1):
            if key is not None and least[tuple(words[i : i + length])] < key:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def order(t):
    return (t[0] is None, t[0] or 0, t[1:])


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["é", "\x1cx", "A", "a"]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [fresh(rng.choice([9, 10, 11, 14, 30, 80])) for _ in range(12)]
    hot = fresh(40)
    texts = []
    for _ in range(160):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += fresh(rng.randint(0, 12)) + (rng.choice(passages) if rng.random() < 0.5 else hot if rng.random() < 0.6 else [])
        texts.append(words)
    texts += [texts[i] for i in (3, 3, 5, 70)] + [["same"] * 300, ["same"] * 90, ["same"] * 9, ["a", "b"] * 60, ["b", "a"] * 30]
    texts.append(sum(texts[:40], []))
    keys = list(range(len(texts)))
    rng.shuffle(keys)
    rows = [(k, rng.choice([" ", "\n", "\t ", "\x0b"]).join(t)) for k, t in zip(keys, texts)]
    rows += [(None, rows[0][1]), (None, " ".join(hot)), (500, None), (501, ""), (502, " \n"), rows[7], rows[7], (rows[9][0], " ".join(hot)), (-1, " ".join(hot[:25]))]
    return rows


@pytest.mark.parametrize("seed, length, wide", [(1, 10, 128), (2, 10, 1), (3, 30, 2), (4, 50, 128)])
def test_against_all_windows(spark, monkeypatch, seed, length, wide):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 200)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _row string, _id int").repartition(3)
    got = substrings.deduplicated(docs, length=length, wide=wide)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = plain(rows, length)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)
    assert sum(w[2] for w in want) > 100


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.deduplicated(none).count() == 0
    alone = spark.range(3).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert {tuple(r)[1:3] for r in substrings.deduplicated(alone).collect()} == {(0, 0)}


def test_statistics_against_listing():
    rng = random.Random(2)
    automaton, kept = substrings.Automaton(), []
    for _ in range(60):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        inside = {tuple(k[i:j]) for k in kept for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        want = [max((n for n in range(1, i + 1) if tuple(words[i - n : i]) in inside), default=0) for i in range(1, len(words) + 1)]
        assert automaton.statistics(words) == want
        automaton.add(words)
        kept.append(words)


def test_segments_cover_all_windows_and_follow_the_words():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    codes[1000:1400] = codes[0]
    starts, sizes, keys = substrings.segments(codes)
    assert starts[0] == 0 and (starts[1:] == (starts + sizes)[:-1]).all() and starts[-1] + sizes[-1] == len(codes) - 49
    assert sizes.max() <= substrings.LONGEST
    key_at = np.repeat(keys, sizes)
    for at in (0, 500, 990, 2000):
        assert substrings.segments(codes[at : at + 50])[2].tolist() == [key_at[at]]
    assert len(substrings.segments(codes[:49])[0]) == 0
