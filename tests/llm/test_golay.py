import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from natalis.llm import golay


def components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_every_word_is_near_one_codeword():
    error = golay._error_of_syndrome()
    words = np.random.default_rng(0).integers(0, 1 << 23, 5000)
    nearest = words ^ error[golay._remainders(words)]
    assert not golay._remainders(nearest).any()
    assert np.bitwise_count(words ^ nearest).max() == 3


def test_close_prints_share_a_bucket():
    code, rng = golay.GolayKeys(), random.Random(0)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        keys, rows = code.buckets(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


@pytest.mark.parametrize("limit", [golay.PAIR_LIMIT, 40, 2])
def test_links_keep_components(spark, limit):
    rng = random.Random(limit)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for seed in list(prints)[:3]:
        at = seed
        for _ in range(90):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            prints.add(at)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    got = golay.links(spark.createDataFrame([(p,) for p in signed], "fp long"), pair_limit=limit).collect()
    mask = (1 << 64) - 1
    near = lambda a, b: ((a ^ b) & mask).bit_count() <= 4
    assert all(near(r.a, r.b) for r in got)
    want = [(a, b) for a, b in combinations(signed, 2) if near(a, b)]
    assert components([(r.a, r.b) for r in got], signed) == components(want, signed)


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_documents(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeäß") for _ in range(rng.randint(1, 6)))
    texts = [None, "", " \n\t", "One", "ONE", "one two", "À É", "à é", "a b c", "x " * 40_000]
    for _ in range(12):
        words = [word() for _ in range(rng.randint(3, 400))]
        texts.append(" ".join(words))
        for _ in range(3):
            words[rng.randrange(len(words))] = word()
            texts.append("\n".join(words))
    rows = [(i, t, "extra", i) for i, t in enumerate(texts)] + [(4, "ONE", "extra", 0), (None, "lonely null id here", "", 0), (None, "one", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, fp string, component_id int")
    got = golay.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    prints = [plain_print(t) for _, t, *_ in rows]
    want = components([(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4], range(len(rows)))
    least = {}
    for i, root in want.items():
        ids = [rows[j][0] for j, r in want.items() if r == root and rows[j][0] is not None]
        least[i] = min(ids) if ids else None
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2] is None, t[2] or 0)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=key) == sorted(
        ((rows[i][0], prints[i], least[i]) for i in range(len(rows))), key=key
    )
    assert golay.near_duplicates(docs.limit(0)).count() == 0
