import random
import re
from collections import Counter, defaultdict

import pytest

from natalis.llm import collocations


def plain(rows, least, top, percent=80):
    counts, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            size[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in frequent.items():
            longer = [b for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in longer):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, size[lang], -score))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["é", "Zé", "\U0001f600", "￿", "\x1c", " ", "A-b"] + ["w%d" % i for i in range(25)]
    phrases = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 6))] for _ in range(25)]
    rows = []
    for i in range(250):
        words = []
        for _ in range(rng.randint(0, 20)):
            words += rng.choice(phrases) if rng.random() < 0.6 else [rng.choice(vocabulary)]
            if rng.random() < 0.2:
                words.append(rng.choice([".", ",x", "y;z", "\n", "\x0b", "?!"]))
        rows.append((rng.choice(["en", "en", "en", "fr", None]), rng.choice([" ", "  ", "\t"]).join(words)))
    rows += rows[:30] + rows[:30] + [("en", None), (None, ""), ("de", " \t\n.,"), ("de", "a b"), ("xx", "b a " * 400), ("yy", "same " * 700), ("en", rows[5][1] * 3)]
    return rows


@pytest.mark.parametrize("seed, least, top, bits", [(1, 5, 2000, 26), (2, 3, 12, 26), (3, 5, 2000, 7)])
def test_against_plain_counts(spark, monkeypatch, seed, least, top, bits):
    monkeypatch.setattr(collocations, "TABLE_BITS", bits)
    monkeypatch.setattr(collocations, "_FLUSH_BYTES", 3000)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, text string, n int, phrase string, f int").repartition(3)
    got = sorted(map(tuple, collocations.mined(docs, least=least, top=top).collect()))
    want = plain(rows, least, top)
    assert got == want
    assert len(want) > 30


def test_empty_table(spark):
    assert collocations.mined(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_large_counts_stay_exact(spark):
    """Products beyond 64 bits: counts near 10^13 in a dictionary of few chunks."""
    many = 9_999_999_999_977
    chunk = b"a b c . . . ."
    df = spark.createDataFrame([("en", bytearray(chunk), many)], "lang string, chunk binary, n long")
    counted = {(r.phrase, r.f) for r in collocations.phrase_counts(df, [2]).collect()}
    assert counted == {("a b", many), ("b c", many)}
    ratio = spark.sql(f"SELECT (CAST(2000000 AS DECIMAL(7,0)) * CAST({many} AS DECIMAL(20,0))) div (CAST({many} AS DECIMAL(20,0)) + CAST({many + 3} AS DECIMAL(20,0))) AS q")
    assert ratio.first().q == 2_000_000 * many // (2 * many + 3)


def test_parse_covers_every_token_once():
    rng = random.Random(4)
    tokens = [rng.choice([b"a", b"b", b"c", b"."]) for _ in range(5000)]
    cut = lambda *documents: [(i, c.split(b" ")) for i, c in collocations.parsed(documents)]
    both = cut([b"x", b"y"], tokens, [], tokens[1700:])
    parts = [p for i, p in both if i == 1]
    assert len(parts) > 50
    assert [t for p in parts for t in p[: -collocations.OVERLAP]] == tokens
    for a, b in zip(parts, parts[1:]):
        assert a[-collocations.OVERLAP :] == b[: collocations.OVERLAP]
    assert [p for i, p in both if i == 0] == [[b"x", b"y", *[b"."] * collocations.OVERLAP]]
    # the cuts follow the text, not its place
    again = [p for i, p in both if i == 3]
    assert again[1:] == parts[len(parts) - len(again) + 1 :]
    assert cut() == cut([]) == []
