import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from natalis.functions import tails
from natalis.operators import correlate, describe, features, hypothesis, metrics
from natalis.operators.ordering import number_rows, running_totals


def test_tail_values():
    # standard table values
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert tails.t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-10)
    assert tails.t_two_sided(12.706204736432095, 1) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_upper(14.067140449340169, 7) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_upper(2.0, 2) == pytest.approx(math.exp(-1.0), abs=1e-12)
    assert tails.chi2_upper(400.0, 3) == pytest.approx(0.0, abs=1e-30)
    assert tails.t_quantile(0.975, 299) == pytest.approx(1.967930, abs=1e-5)
    assert tails.t_upper(-1.0, 5) == pytest.approx(1 - tails.t_upper(1.0, 5))


def test_worked_paired_example(spark):
    sd = -51.19333 / -41.468 * math.sqrt(300)
    stats = spark.createDataFrame([(300, -51.19333, sd)], "n long, mean double, sd double")
    row = hypothesis.add_paired_test(stats).first()
    assert row["t"] == pytest.approx(-41.468, abs=1e-3) and row["df"] == 299
    assert (round(row["ci_low"], 2), round(row["ci_high"], 2)) == (-53.62, -48.76)
    assert row["p_value"] < 2.2e-16


# published log-odds of the exposure, models 1 and 2
REPORTED_LOG_ODDS = {
    "Postpartum Depression (COVID)": (0.558, 0.2673),
    "C-section": (0.7408, 0.3858),
    "(Pre)Eclampsia": (0.8857, 0.3883),
}


def test_reported_effect_sizes(spark):
    got = {(r["dv"], r["model"]): (round(r["odds_ratio"], 4), r["cohen_d"]) for r in hypothesis.effect_sizes(spark, REPORTED_LOG_ODDS).collect()}
    assert got == {
        ("Postpartum Depression (COVID)", "Model 1"): (1.7472, 0.308),
        ("Postpartum Depression (COVID)", "Model 2"): (1.3064, 0.148),
        ("C-section", "Model 1"): (2.0976, 0.409),
        ("C-section", "Model 2"): (1.4708, 0.213),
        ("(Pre)Eclampsia", "Model 1"): (2.4247, 0.489),
        ("(Pre)Eclampsia", "Model 2"): (1.4745, 0.215),
    }


def test_degenerate_tests(spark):
    same = spark.createDataFrame([(2, 1), (3, 2), (None, 1)], "a int, b int")
    row = hypothesis.t_paired(same, "a", "b").first()
    assert row["n"] == 2 and row["t"] == math.inf and row["p_value"] == 0.0
    flat = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    assert hypothesis.t_paired(flat, "a", "b").first()["t"] is None
    three = spark.createDataFrame([(0,), (1,), (2,)], "y int")
    assert hypothesis.chi_square_fit(three, "y").first()["chi_square"] is None
    with_null = spark.createDataFrame([(0,), (1,), (1,), (None,)], "y int")
    assert hypothesis.chi_square_fit(with_null, "y").first()["chi_square"] == pytest.approx(1 / 3)
    assert hypothesis.chi_square_fit(with_null, "y", keep_null=True).first()["chi_square"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_sum_against_pair_counts(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([5.0, 5.0, rng.random() * 10]), rng.randint(0, 1)) for _ in range(300)]
    zero, one = ([v for v, g in rows if g == k] for k in (0, 1))
    want = sum((a > b) + 0.5 * (a == b) for a in zero for b in one)
    df = spark.createDataFrame(rows, "v double, g int")
    assert hypothesis.rank_sum(df, "v", "g").first()["w"] == pytest.approx(want)
    assert hypothesis.rank_sum(df, "v", "g", edges=[5.0]).first()["w"] == pytest.approx(want)


@pytest.mark.parametrize("sizes", [(3, 4), (1, 6), (5, 5)])
def test_small_rank_sum_is_exact(spark, sizes):
    """Against all ways to choose the ranks of one group."""
    n = sum(sizes)
    every = sorted(sum(c) - sizes[0] * (sizes[0] - 1) // 2 for c in itertools.combinations(range(n), sizes[0]))
    for seed in range(4):
        ranks = random.Random(seed).sample(range(n), sizes[0])
        w = sum(ranks) - sizes[0] * (sizes[0] - 1) // 2
        below, above = sum(e <= w for e in every), sum(e >= w for e in every)
        df = spark.createDataFrame([(1.5 * i, int(i not in ranks)) for i in range(n)], "v double, g int")
        row = hypothesis.rank_sum(df, "v", "g").first()
        assert row["w"] == w and row["p_value"] == pytest.approx(min(1.0, 2 * min(below, above) / len(every)))


def test_rank_sum_is_approximate_with_ties_or_many_rows(spark):
    tied = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 0), (3.0, 1)], "v double, g int")
    many = spark.range(120).selectExpr("CAST(id AS DOUBLE) AS v", "CAST(id % 2 AS INT) AS g")
    for df in (tied, many):
        row = hypothesis.rank_sum(df, "v", "g").first()
        assert row["p_value"] == pytest.approx(tails.normal_two_sided(row["z"]))
    largest = hypothesis.rank_sum(many.filter("v < 98"), "v", "g").first()  # 49 rows each
    assert largest["p_value"] == pytest.approx(tails.normal_two_sided(largest["z"]), rel=0.02)


def test_fractions_converge_or_raise():
    assert tails.beta_inc(5e9, 0.5, 1 / (1 + 1.96**2 / 1e10)) == pytest.approx(tails.normal_two_sided(1.96), rel=1e-4)
    with pytest.raises(ArithmeticError):
        tails._fraction(lambda i: (1.0, 0.0), limit=100)


def test_running_totals_do_not_depend_on_edges(spark):
    rng = random.Random(7)
    rows = [(g, float(v), rng.randint(1, 5)) for g in "ab" for v in rng.sample(range(100), 40)]
    df = spark.createDataFrame(rows, "g string, v double, c long")
    want = {(g, v): sum(c2 for g2, v2, c2 in rows if g2 == g and v2 < v) for g, v, _ in rows}
    for edges in (None, [], [10.0, 11.0, 70.0], [500.0]):
        got = {(r["g"], r["v"]): r["s"] for r in running_totals(df, "v", {"s": "c"}, by=["g"], edges=edges).collect()}
        assert got == want


def test_number_rows_is_gap_free_and_layout_free(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50))
    one = {(r["g"], r["id"]): r["row_no"] for r in number_rows(df, "id", by=["g"]).collect()}
    two = {(r["g"], r["id"]): r["row_no"] for r in number_rows(df.repartition(13), "id", by=["g"]).collect()}
    assert one == two
    groups = {}
    for (g, _), n in one.items():
        groups.setdefault(g, []).append(n)
    assert all(sorted(v) == list(range(len(v))) for v in groups.values())


def test_quantiles_with_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 4), ("x", 10), ("x", None)], "g string, v int")
    got = {r["g"]: (r["count"], r["p25"], r["p50"], r["max"], r["std"]) for r in describe.describe_by_group(df, "g", "v").collect()}
    assert got[None][:4] == (2, 1.75, 2.5, 4.0)
    assert got["x"] == (1, 10.0, 10.0, 10.0, None)


def test_correlation_edge_cases(spark):
    df = spark.createDataFrame(
        [(1e9 + i, 2.0 * i, 7.0, None if i % 2 else float(-i)) for i in range(20)], "a double, b double, k double, m double"
    )
    got = {(r["feature_a"], r["feature_b"]): (r["n"], r["r"]) for r in correlate.correlations(df, ["a", "b", "k", "m"]).collect()}
    assert got["a", "b"][1] == pytest.approx(1.0, abs=1e-12)
    assert got["a", "k"] == (20, None)
    assert got["b", "m"][0] == 10 and got["b", "m"][1] == pytest.approx(-1.0, abs=1e-12)
    assert correlate.drop_correlated(df, ["a", "b", "k", "m"]).columns == ["a", "k"]


def test_correlation_by_tiles(spark):
    rng = np.random.default_rng(11)
    p = 11
    x = rng.normal(size=(900, p)) @ rng.normal(size=(p, p)) + 1e6 * np.arange(p)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:600, 9] = np.nan  # absent from the first slices, with a large mean
    x[:, 4], x[:, 7] = 3.0, np.nan  # constant, and never present
    names = [f"c{i}" for i in range(p)]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    frame = pd.DataFrame(x, columns=names)
    wanted = frame.corr()
    for tile, parts in ((1, 2), (4, 5), (4, 1), (11, 5), (512, 1)):
        got = correlate.correlations(df.coalesce(1) if parts == 1 else df.repartition(parts), names, tile=tile).collect()
        assert len({(r["feature_a"], r["feature_b"]) for r in got}) == len(got) == p * (p - 1) // 2
        for r in got:
            a, b = r["feature_a"], r["feature_b"]
            assert names.index(a) < names.index(b)
            assert r["n"] == int((frame[a].notna() & frame[b].notna()).sum())
            if {a, b} & {"c4", "c7"}:
                assert r["r"] is None
            else:
                assert r["r"] == pytest.approx(wanted.loc[a, b], abs=1e-9)
        assert correlate.correlations(df.limit(0), names, tile=tile).count() == 0


def test_scaling_and_selection(spark):
    df = spark.createDataFrame([(1, 5, 0), (3, 5, 1), (5, 5, 0)], "x int, k int, t int")
    scaled = features.zscore(df, ["x", "k"], ddof=0)
    assert [round(r["scaled_x"], 4) for r in scaled.orderBy("x").collect()] == [-1.2247, 0.0, 1.2247]
    assert {r["scaled_k"] for r in scaled.collect()} == {0.0}
    assert features.drop_quasi_constant(df).columns == ["x", "t"]
    assert features.drop_quasi_constant(df, protect=["k"]).columns == ["x", "k", "t"]


def test_level_discovery_is_bounded(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "s string, t string")
    assert features.discover_levels(df, ["s", "t"]) == {"s": ["a", "b"], "t": ["x"]}
    with pytest.raises(ValueError):
        features.discover_levels(spark.range(50), ["id"], limit=10)


def test_metrics_with_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "y int, y_pred int, score double")
    report = {r["label"]: (r["precision"], r["recall"], r["support"]) for r in metrics.classification_report(df).collect()}
    assert report["1"] == (0.0, 0.0, 0) and report["0"] == (1.0, 1.0, 2)
    assert metrics.auc(df).first()["auc"] is None
