import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from natalis.llm import packing

ODD = ["", " ", "a  b\r\n\tc", "don't it's", "naïve ÀÉ 你好 \U0001f600‍", "x" * 5000, "1234567890" * 300, "end <|endoftext|> end", "\x00\x0b\x1c"]


def test_encoder_equals_the_tokenizer_file():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    exact, fast = Tokenizer.from_file(public.path("byte_bpe_50k.json")), packing.public_byte_bpe()
    for text in ODD:
        assert fast(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def one_by_one(lengths, window):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= length]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - length)
        else:
            rooms.append(window - length)
    return Counter(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 16, 100])
    lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 300))]
    counts = Counter(lengths)
    plan = sorted(packing.best_fit_plan(counts, window))
    used = {}
    for i, (length, rank, first, each, offset) in enumerate(plan):
        end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else counts[length]
        for r in range(rank, end):
            at = offset + (r - rank) % each * length
            used.setdefault(first + (r - rank) // each, []).append((at, length))
    for parts in used.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert parts[0][0] == 0 and sum(parts[-1]) <= window
    assert sorted(used) == list(range(len(used)))
    assert Counter(window - sum(n for _, n in p) for p in used.values()) == one_by_one(lengths, window)


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(1)
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(None, None, "y", 1), (3, "tie", "z", 2), (3, "tie", "z", 2)]
    rows += [(100 + i, "lorem ipsum dolor " * rng.randint(1, 400), None, i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, length string, start int")
    got = packing.packed_documents(docs).toPandas()
    encode = packing.public_byte_bpe()
    want = Counter()
    for key, text, *_ in rows:
        ids = np.append(encode(text or ""), 0).astype("<u4")
        for s in range(0, len(ids), 1024):
            want[(key, s, len(ids[s : s + 1024]), len(ids), zlib.crc32(ids[s : s + 1024].tobytes()))] += 1
    keys = [None if k != k else int(k) for k in got.doc_id]
    assert Counter(zip(keys, got.start, got.length, got.doc_tokens, got.ids_crc32)) == want
    for _, parts in got.groupby("sequence_id"):
        parts = parts.sort_values("offset")
        assert parts.offset.tolist() == [0, *np.cumsum(parts.length)[:-1]]
        assert parts.length.sum() <= 1024
    whole = packing.sequences(docs).toPandas()
    assert whole.length.sum() == sum(k[2] * n for k, n in want.items())
    assert all(len(ids) == 4 * n for ids, n in zip(whole.ids, whole.length))
    assert packing.packed_documents(docs.filter(F.lit(False))).count() == 0
