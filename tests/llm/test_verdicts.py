"""Quality scores and line rules against plain versions and held-out labels; the pipeline stage by stage."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from natalis.llm import golay, line_rules, quality
from tests.llm.test_decontaminate import plain as plain_overlaps
from tests.llm.test_golay import components, plain_print

BASE = "/root/testdata/sf0.01"


def log_density(x, mean, cov):
    d = x - mean
    return -0.5 * (d @ np.linalg.solve(cov, d) + np.linalg.slogdet(cov)[1])


def test_discriminant_is_the_density_ratio():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4)), rng.normal(size=(200, 4)) + 1]
    model = quality.fit_moments(
        np.array([80.0, 200.0]), np.array([a.sum(0) for a in x]), np.array([a.T @ a for a in x]), to_common=0.25, to_round=0.1
    )
    own = [np.cov(a.T, bias=True) for a in x]
    common = (80 * own[0] + 200 * own[1]) / 280
    scale = np.sqrt(np.diag(common))
    covs = []
    for cov in own:
        c = (0.75 * cov + 0.25 * common) / np.outer(scale, scale)
        covs.append((0.9 * c + 0.1 * np.trace(c) / 4 * np.eye(4)) * np.outer(scale, scale))
    rows = np.concatenate(x)[::7]
    logit = [log_density(r, x[1].mean(0), covs[1]) - log_density(r, x[0].mean(0), covs[0]) + np.log(201 / 81) for r in rows]
    assert model.scores(rows) == pytest.approx(1 / (1 + np.exp(-np.array(logit))), rel=1e-9, abs=1e-12)


def test_moments_are_added_over_all_labelled_rows(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    model = quality.fit(quality.features(docs), labels, train=quality.training_rows())
    pairs = docs.join(labels, "doc_id").select("doc_id", "text", "quality").toPandas()
    pairs = pairs[[zlib.crc32(str(i).encode()) % 5 != 0 for i in pairs.doc_id]]
    x, y = np.array([quality.statistics(t) for t in pairs.text]), pairs.quality.to_numpy()
    own = [x[y == k] for k in (0, 1)]
    plain = quality.fit_moments(
        np.array([len(a) for a in own], float), np.array([a.sum(0) for a in own]), np.array([a.T @ a for a in own])
    )
    assert model.scores(x) == pytest.approx(plain.scores(x), rel=1e-6, abs=1e-9)


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    got = quality.scored(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97
    kept = line_rules.judged(docs, labels).filter("not base_failed").join(labels, "doc_id").toPandas()
    held = kept[[zlib.crc32(str(i).encode()) % 5 == 0 for i in kept.doc_id]]
    assert (held.kept == (held.quality == 1)).mean() > 0.97


ODD = [None, "", " \n\n\t", "word", "Ä ö\n\nÄ ö\n", "a b c d e f g h i j k\x0bl\x0cm\n" * 4, "#*$%&|<> !! || 12", "one line " * 30_000, "x\n" * 3000, "tie", "tie"]


def odd_documents(spark, more=()):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(None, "null id", None, None, None), *more]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars int")


def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = {}
    for w in windows:
        count[w] = count.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_rules_equal_plain_counts(spark):
    rng = random.Random(0)
    more = [(50 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))).replace(" b b", " b\nb"), "", "", i) for i in range(60)]
    docs = odd_documents(spark, more)
    labels = spark.createDataFrame([(3, 1), (4, 0), (50, 0), (51, 1), (51, 0), (None, 1), (52, None)], "doc_id int, quality int")
    for known in (labels, labels.filter(F.lit(False))):
        got = line_rules.judged(docs, known).collect()
        assert len(got) == docs.count()
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in got:
            want = plain_rules(texts[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
            assert r.kept == (not r.base_failed and r.content_share >= 0.5)
    assert line_rules.judged(docs.limit(0), labels).count() == 0
    assert line_rules.keep_content(docs, labels).columns == docs.columns


def test_scores_of_odd_texts(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(3, 1), (4, 0), (7, 1), (None, 1), (8, None)], "doc_id int, quality int")
    for known in (labels, labels.filter("quality = 1"), labels.filter(F.lit(False))):
        got = quality.scored(docs, known).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert {r.score for r in got} == {0.5}
    assert quality.scored(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        x, field = rng.normal(size=(n, 3)), line_rules.LineField(rng.normal(size=3), rng.normal(size=(2, 2)))
        u = x @ field.weights

        def value(path, u=u, field=field):
            return sum(a * s for a, s in zip(u, path)) + sum(field.moves[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert value(tuple(field.decode(x).tolist())) == pytest.approx(value(best))


def test_field_gradient_is_zero_at_the_fit():
    """Expected feature sums over all paths, listed one by one, equal those of the marked lines."""
    rng = np.random.default_rng(3)
    d = len(line_rules.LINE_FEATURES)
    documents = [rng.normal(size=(int(rng.integers(1, 5)), d)) for _ in range(30)]
    states = [(x[:, 0] + rng.normal(size=len(x)) > 0).astype(np.int64) for x in documents]
    field = line_rules.fit_field(documents, states, steps=3000, rate=0.01, ridge=1.0)
    gap = -np.concatenate((field.weights, field.moves.ravel()))
    for x, s in zip(documents, states):
        paths = [np.array(p) for p in itertools.product((0, 1), repeat=len(x))]
        sums = [np.concatenate((p @ x, np.bincount(2 * p[:-1] + p[1:], minlength=4))) for p in paths]
        scores = np.array([v @ np.concatenate((field.weights, field.moves.ravel())) for v in sums])
        chance = np.exp(scores - np.logaddexp.reduce(scores))
        gap += np.concatenate((s @ x, np.bincount(2 * s[:-1] + s[1:], minlength=4))) - chance @ np.array(sums)
    assert np.abs(gap).max() < 1e-2


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").filter("n_chars < 3000")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    bench = spark.read.parquet(f"{BASE}/benchmark.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "rules", "near_duplicates", "decontamination", "packing"]
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    good = steps["quality"](spark, docs, BASE)
    assert good.columns == docs.columns
    assert ids(good) == ids(quality.scored(docs, labels).filter("predicted = 1"))
    clean = steps["rules"](spark, good, BASE)
    judged = line_rules.judged(spark.read.parquet(f"{BASE}/documents.parquet"), labels).filter("kept")
    assert ids(clean) == ids(judged.join(good.select("doc_id"), "doc_id", "left_semi"))
    rows = sorted(clean.select("doc_id", "text").collect())
    prints = [plain_print(r.text) for r in rows]
    near = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= golay.MAX_BITS]
    root = components(near, range(len(rows)))
    single = steps["near_duplicates"](spark, clean, BASE)
    assert single.columns == docs.columns
    assert ids(single) == [rows[i].doc_id for i in range(len(rows)) if root[i] == i]
    some = bench.limit(20)
    leaks = {d for d, *_ in plain_overlaps([tuple(r) for r in single.select("doc_id", "text").collect()], [tuple(r) for r in some.collect()])}
    free = steps["decontamination"](spark, single, BASE)
    assert free.columns == docs.columns and not leaks & set(ids(free))
    pieces = steps["packing"](spark, free, BASE).toPandas()
    assert sorted(set(pieces.doc_id)) == ids(free)
    per_doc = pieces.groupby("doc_id").agg({"length": "sum", "doc_tokens": "first"})
    assert (per_doc.length == per_doc.doc_tokens).all()


def test_stages_take_odd_tables(spark):
    docs = odd_documents(spark, [(5, "again", "", "", 1)] * 2)
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, BASE)
            assert name == "packing" or out.columns == docs.columns
            given, rows = table.select("doc_id", "text").collect(), out.collect()
            if name == "packing":
                assert {r.doc_id for r in rows} == {r.doc_id for r in given}
            else:
                left = Counter(map(tuple, given))
                left.subtract((r.doc_id, r.text) for r in rows)
                assert min(left.values(), default=0) >= 0
            if name == "decontamination":
                assert len(rows) == len(given)  # none of these texts is of the benchmark
            if name == "near_duplicates":
                prints = sorted({plain_print(r.text) for r in given})
                near = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= golay.MAX_BITS]
                root = components(near, range(len(prints)))
                groups = {}
                for r in given:
                    groups.setdefault(root[prints.index(plain_print(r.text))], []).append((r.doc_id is None, r.doc_id))
                assert len(rows) == len(groups)
                want = sorted(min(g, key=lambda t: (t[0], t[1] or 0)) for g in groups.values() if not all(none for none, _ in g))
                assert sorted((False, r.doc_id) for r in rows if r.doc_id is not None) == want


def test_line_rules_stage_has_the_verdicts_of_the_whole_table(spark):
    """Rows that the quality stage has kept are judged as among all rows, and planted boilerplate is rejected."""
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    labels = spark.read.parquet(f"{BASE}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    whole = line_rules.judged(docs, labels)
    good = labels.filter("quality = 1").select("doc_id")
    bad = whole.join(labels.filter("quality = 0"), "doc_id").filter("not base_failed and not kept").select("doc_id")
    assert bad.count() > 0
    kept = steps["rules"](spark, docs.join(good, "doc_id", "left_semi"), BASE)
    want = whole.join(good, "doc_id", "left_semi").filter("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in want.collect())
    # boilerplate under ids without a label, among good rows only
    planted = docs.join(bad, "doc_id", "left_semi").withColumn("doc_id", -1 - F.col("doc_id")).select(*docs.columns)
    mixed = docs.join(good, "doc_id", "left_semi").select(*docs.columns).unionByName(planted)
    assert steps["rules"](spark, mixed, BASE).filter("doc_id < 0").count() == 0
