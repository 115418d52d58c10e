import random
import re
from itertools import combinations

from pyspark.sql import functions as F

import duckdb
import pandas as pd

from natalis.llm import decontaminate as dc
from natalis.llm import oracle


def test_masks_find_every_window_with_two_substitutions():
    for gone in combinations(range(dc.WINDOW), dc.WINDOW - dc.MIN_EQUAL):
        clean = [not {s + at for at in m} & set(gone) for m in dc.MASKS for s in range(dc.WINDOW - m[-1])]
        assert any(clean)


def words(text):
    apart = re.sub("([\u3040-\u30ff\u4e00-\u9fff\u0e01-\u0e2e])", r" \1 ", (text or "").lower())
    return [w for w in re.split(r"[\W_]+", apart) if w]


def plain(docs, items):
    found = {}
    for d, text in docs:
        for i, passage in items:
            a, b = words(text), words(passage)
            if 1 <= len(b) < 12:
                for s in range(len(a) - len(b) + 1):
                    if a[s : s + len(b)] == b and (len(b) >= dc.LEAST_INSIDE or len(a) == len(b)):
                        found[d, i, s] = {(s, len(b), len(b))}
            for s in range(len(a) - 11):
                for t in range(len(b) - 11):
                    n = sum(x == y for x, y in zip(a[s : s + 12], b[t : t + 12]))
                    if n >= 10:
                        found.setdefault((d, i, s - t), set()).add((s, n, 12))
    return {(d, i, min(w)[0], max(s + size for s, _, size in w), len(w), max(n for _, n, _ in w)) for (d, i, _), w in found.items()}


def test_equals_all_windows(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["of", "the", "ou", "été", "x1"]) + rng.choice(["", "ing", "tion", "er"])
    text = lambda n: [word() for _ in range(n)]
    items = [(i, text(rng.randint(5, 40))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(20)]
    for k in range(60):
        part = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 5)):
            part[rng.randrange(len(part))] = word()
        docs.append((100 + k, text(rng.randint(0, 20)) + part + text(rng.randint(0, 20))))
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(t)) for i, t in docs] + [(7, None), (None, ""), (8, " . ")]
    docs += [(None, docs[-40][1]), (None, "a clean text under no id"), (100, "a clean text under the id of another")]
    docs.append((9, " ".join(["pad"] * 3000 + items[0][1] + ["pad"] * 3000)))
    items = [(i, " ".join(t).upper()) for i, t in items] + [(None, None), (50, "")]
    table = spark.createDataFrame([(*d, 0, 1) for d in docs], "doc_id int, text string, seed int, item_id int")
    bench = spark.createDataFrame([(*i, "") for i in items], "item_id int, text string, doc_id string")
    for bits in (dc.TABLE_BITS, 64):
        got = dc.overlaps(table, bench, bits=bits).collect()
        assert {(r.doc_id, r.item_id, r.doc_start, r.doc_end, r.n_windows, r.max_equal) for r in got} == plain(docs, items)
    kept = dc.without_overlaps(table, bench)
    assert kept.columns == table.columns
    bad = {r.doc_id for r in got}
    overlapping = {i for i, d in enumerate(docs) if plain([d], items)}
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(d) for i, d in enumerate(docs) if i not in overlapping)
    assert len(bad) > 20
    assert dc.overlaps(table.filter(F.lit(False)), bench).count() == 0
    assert dc.overlaps(table, bench.filter(F.lit(False))).count() == 0


def test_short_items_and_scripts_without_blanks(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdef") + rng.choice("xyz")
    short = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 1, 2, 3, 4, 4, 5, 5, 6, 8, 9, 10, 11, 11])]
    items = [*short, (20, "日本語の文章には空白がありません。だから文字を語とする"), (21, "春はあけぼの"), (22, "กขคงจฉชซฌญฎฏฐฑ"), (23, None), (24, " ")]
    docs = [(k, t) for k, t in short] + [(100 + k, f"Pad, {t.upper()}! pad {t}") for k, t in short]
    docs += [(200 + k, " ".join(t.split()[:-1]) + " other") for k, t in short]  # one word is not the item's
    docs += [(300, "ここに日本語の文章には空白がありません、だから文字を言とするとある"), (301, "枕草子「春はあけぼの」"), (302, "春は、あけぼ")]
    docs += [(303, "xกขคงจฉชซฌญฎฏฐฑx"), (304, None), (None, short[-1][1]), (305, " ".join(["ax"] * 1_000) + " " + short[-2][1])]
    table = spark.createDataFrame(docs, "doc_id int, text string")
    bench = spark.createDataFrame(items, "item_id int, text string")
    wanted = plain(docs, items)
    assert {300, 301, 303, 305, None} <= {w[0] for w in wanted} and not {200, 206, 302} & {w[0] for w in wanted}
    fields = ["doc_id", "item_id", "doc_start", "doc_end", "n_windows", "max_equal"]
    for bits in (dc.TABLE_BITS, 64):
        assert {tuple(r[f] for f in fields) for r in dc.overlaps(table, bench, bits=bits).collect()} == wanted
    kept = {r.doc_id for r in dc.without_overlaps(table, bench).collect()}
    assert kept == {d for d, _ in docs} - {w[0] for w in wanted}

    con = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        con.register(f"{name}_rows", pd.DataFrame(rows, columns=[key, "text"]).astype({key: "Int32"}))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM {name}_rows")
    found = con.execute(f"SELECT {', '.join(fields)} FROM ({oracle.DECONTAMINATE})").fetchall()
    assert sorted(map(str, found)) == sorted(map(str, wanted))
