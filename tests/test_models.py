import hashlib
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from natalis.operators import imbalance, matching, mitigate, mixed, models, neighbours, newton
from natalis.sources.store import read_node, write_node


@pytest.fixture(scope="module")
def patients(spark):
    rng = np.random.default_rng(5)
    n = 1500
    g = rng.integers(0, 12, n)
    x = rng.integers(18, 50, n)
    e = rng.integers(0, 2, n)
    u = rng.normal(0, 0.9, 12)
    y = (rng.random(n) < 1 / (1 + np.exp(-(-2 + 0.03 * x + 0.6 * e + u[g])))).astype(int)
    frame = pd.DataFrame({"id": np.arange(n), "g": g, "age": x, "e": e, "y": y})
    return frame, spark.createDataFrame(frame).cache()


def laplace(theta, frame):
    """Row-level Laplace log-likelihood, computed on its own."""
    g, y = frame["g"].to_numpy(), frame["y"].to_numpy()
    x = np.column_stack([np.ones(len(y)), frame["e"], frame["age"]])
    s, k = math.exp(theta[3]), g.max() + 1
    eta0, u = x @ theta[:3], np.zeros(k)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(eta0 + u[g])))
        u += (np.bincount(g, y - p, k) - u / s**2) / (np.bincount(g, p * (1 - p), k) + 1 / s**2)
    eta = eta0 + u[g]
    p = 1 / (1 + np.exp(-eta))
    w = np.bincount(g, p * (1 - p), k)
    return (y * eta - np.logaddexp(0, eta)).sum() - (u**2).sum() / (2 * s * s) - 0.5 * np.log1p(s * s * w).sum()


def test_mixed_model_is_the_likelihood_maximum(spark, patients):
    frame, df = patients
    fit = mixed.fit_mixed(df, "y", ["e", "age"], group="g")
    theta = np.r_[fit.beta, math.log(fit.sigma)]
    assert fit.converged and fit.loglik == pytest.approx(laplace(theta, frame), abs=1e-6)
    step = np.array([1e-3, 1e-3, 1e-5, 1e-3])
    eye = np.diag(step)
    slope = [(laplace(theta + e, frame) - laplace(theta - e, frame)) / (2 * h) for e, h in zip(eye, step)]
    assert np.max(np.abs(np.array(slope) * step)) < 1e-6
    eye = eye * 3
    hess = np.array(
        [
            [
                (laplace(theta + a + b, frame) - laplace(theta + a - b, frame) - laplace(theta - a + b, frame) + laplace(theta - a - b, frame))
                / (4 * a.sum() * b.sum())
                for b in eye
            ]
            for a in eye
        ]
    )
    errors = np.sqrt(np.diag(np.linalg.inv(-hess)))[:3]
    assert np.sqrt(np.diag(fit.vcov)) == pytest.approx(errors, rel=1e-3)
    curve = mixed.predicted_curve(df, mixed.fit_mixed(df, "y", ["e*age"], group="g"), "age", "e").toPandas()
    assert len(curve) == 2 * frame["age"].nunique()
    assert ((curve.conf_low < curve.predicted) & (curve.predicted < curve.conf_high)).all()


def test_equal_clusters_give_plain_logistic_regression(spark, patients):
    _, df = patients
    same = df.withColumn("site", F.explode(F.array(*[F.lit(i) for i in range(5)])))
    fit = mixed.fit_mixed(same, "y", ["e", "age"], group="site")
    assert fit.sigma == 0.0 and fit.converged
    plain = models.binomial_glm(same, ["e", "age"], "y")
    assert fit.beta == pytest.approx([plain.intercept, *plain.weights.values()], abs=1e-5)


def test_clusters_larger_than_a_block(spark, patients, monkeypatch):
    """Modes in a Spark table give what modes inside a block give."""
    _, df = patients
    whole = mixed.fit_mixed(df, "y", ["e", "age"], group="g")
    monkeypatch.setattr(mixed, "BLOCK_PATTERNS", 20)
    monkeypatch.setattr(mixed, "MOST_PATTERNS", 59)
    point = [(np.array([-1.0, 0.4, 0.02]), 0.7)]
    spread = mixed.log_likelihoods([mixed.Model(df, "y", ["e", "age"])], point, group="g")
    monkeypatch.setattr(mixed, "MOST_PATTERNS", 10**6)
    assert spread == pytest.approx(mixed.log_likelihoods([mixed.Model(df, "y", ["e", "age"])], point, group="g"), abs=1e-8)
    small_blocks = mixed.fit_mixed(df, "y", ["e", "age"], group="g")
    assert small_blocks.beta == pytest.approx(whole.beta, abs=1e-7) and small_blocks.n_groups == whole.n_groups == 12
    assert small_blocks.loglik == pytest.approx(whole.loglik, abs=1e-8) and small_blocks.sigma == pytest.approx(whole.sigma, abs=1e-6)


def test_fit_with_spread_clusters(spark, patients, monkeypatch):
    frame, df = patients
    few = df.filter("age < 30")
    whole = mixed.fit_mixed(few, "y", ["e"], group="g")
    monkeypatch.setattr(mixed, "MOST_PATTERNS", 1)
    spread = mixed.fit_mixed(few.filter("g < 3 OR e = 0"), "y", ["e"], group="g", max_iter=3)
    assert spread.n_groups == 12 and spread.passes > 5
    monkeypatch.setattr(mixed, "MOST_PATTERNS", 10**6)
    again = mixed.fit_mixed(few.filter("g < 3 OR e = 0"), "y", ["e"], group="g", max_iter=3)
    assert spread.beta == pytest.approx(again.beta, abs=1e-6) and spread.loglik == pytest.approx(again.loglik, abs=1e-7)
    assert whole.n_rows == int((frame["age"] < 30).sum())


def test_many_clusters(spark):
    """Clusters of three rows; the driver holds sums only, and the fit is the maximum of an independent likelihood."""
    rng = np.random.default_rng(11)
    k = 30_000
    g = np.repeat(np.arange(k), 3)
    frame = pd.DataFrame({"g": g, "e": rng.integers(0, 2, 3 * k), "age": rng.integers(20, 24, 3 * k)})
    eta = -1 + 0.5 * frame["e"] + 0.05 * (frame["age"] - 20) + rng.normal(0, 1.2, k)[g]
    frame["y"] = (rng.random(3 * k) < 1 / (1 + np.exp(-eta))).astype(int)
    fit = mixed.fit_mixed(spark.createDataFrame(frame), "y", ["e", "age"], group="g")
    assert fit.converged and fit.n_groups == k and fit.sigma > 0.5
    theta = np.r_[fit.beta, math.log(fit.sigma)]
    best = laplace(theta, frame)
    assert fit.loglik == pytest.approx(best, abs=1e-4)
    for i, h in enumerate((0.02, 0.02, 0.001, 0.02)):
        assert all(laplace(theta + sign * h * np.eye(4)[i], frame) < best for sign in (1, -1))


def test_models_fitted_together_equal_models_fitted_alone(spark, patients):
    _, df = patients
    other = df.withColumn("z", (F.col("y") + F.col("e")) % 2)
    together = mixed.fit_models([mixed.Model(df, "y", ["e"]), mixed.Model(other, "z", ["e", "age"])], group="g")
    for fit, alone in zip(together, (mixed.fit_mixed(df, "y", ["e"], group="g"), mixed.fit_mixed(other, "z", ["e", "age"], group="g"))):
        assert fit.beta == pytest.approx(alone.beta, abs=1e-8) and fit.loglik == pytest.approx(alone.loglik, abs=1e-8)
    wanted = [mixed.Model(df, "y", ["e"]), mixed.Model(other, "z", ["e", "age"])]
    observed = other.agg(F.sum("y").alias("y"), F.sum(F.col("y") * F.col("e")).alias("ye"), F.sum(F.col("z") * F.col("age")).alias("za")).first()
    one, two = mixed.score_moments(wanted, together, group="g")
    assert (one[mixed.INTERCEPT], one["e"], two["age"]) == pytest.approx((observed["y"], observed["ye"], observed["za"]), abs=0.02)
    with pytest.raises(ValueError, match="does not vary"):
        mixed.fit_mixed(df.withColumn("y", F.lit(0)), "y", ["e"], group="g")


def test_nested_comparison(spark, patients):
    _, df = patients
    row = mixed.compare_nested(df, {"outcome": "y"}, ["e"], ["e", "age"], group="g").first()
    assert row["df_diff"] == 1 and row["chi_sq"] > 0 and row["p_val_str"]


def test_newton_equals_mllib(spark, patients):
    _, df = patients
    scaled = df.withColumn("age", (F.col("age") - 34) / 10.0)
    fast = models.ridge_logistic(scaled, ["e", "age"], "y")
    slow = models.ridge_logistic(scaled, ["e", "age"], "y", solver="lbfgs", tol=1e-10)
    assert fast.intercept == pytest.approx(slow.intercept, abs=1e-5)
    assert list(fast.weights.values()) == pytest.approx(list(slow.weights.values()), abs=1e-5)
    constant = newton.ridge_grid(
        scaled.select("e", "age", F.col("y").alias("cell"), F.lit(1.0).alias("n")), ["e", "age"], np.ones((1, 2)), np.ones((1, 2))
    )[0]
    assert constant.intercept > 0 and set(constant.weights.values()) == {0.0}


def test_folds_share_passes_and_equal_mllib(spark, patients):
    from pyspark.ml.classification import LogisticRegression

    _, df = patients
    found = models.fit_folds(df, ["e", "age"], "y", "id", (0.0, 0.1))
    marked = models.assemble(df.withColumn("fold", models.fold_of("id", 3)), ["e", "age"])
    areas = {0.0: [], 0.1: []}
    for (penalty, fold), fit in found.fits.items():
        train = marked.filter(F.col("fold") != fold)
        mllib = LogisticRegression(featuresCol=models.FEATURES, labelCol="y", regParam=penalty, tol=1e-10).fit(train)
        assert list(fit.weights.values()) == pytest.approx(mllib.coefficients.toArray(), rel=0.03)
        held = fit.transform(marked.filter(F.col("fold") == fold))
        areas[penalty].append(models.auc(held, y="y").first()["auc"])
    got = {r["penalty"]: r["mean_auc"] for r in models.cross_validate(df, ["e", "age"], "y", "id", (0.0, 0.1)).collect()}
    assert got == pytest.approx({p: sum(a) / 3 for p, a in areas.items()})


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(2000)
    one = {r["id"]: r["split"] for r in models.with_split(df, "id").collect()}
    two = {r["id"]: r["split"] for r in models.with_split(df.repartition(17), "id").collect()}
    assert one == two and 0.76 < sum(v == "train" for v in one.values()) / 2000 < 0.84


def greedy(units):
    """Row by row: treated from the highest score, nearest free control, the lower one on a tie."""
    treated = sorted([s for s, t in units if t], reverse=True)
    free = sorted(s for s, t in units if not t)
    pairs = {}
    for s in treated:
        if not free:
            break
        best = min(free, key=lambda c: (abs(c - s), c))
        free.remove(best)
        pairs[s, best] = pairs.get((s, best), 0) + 1
    return pairs


@pytest.mark.parametrize("seed", range(200))
def test_range_wise_allocation_is_greedy(seed):
    import random

    rng = random.Random(seed)
    p, width = rng.choice([0.2, 0.5, 0.7]), rng.choice([5, 20, 100])
    units = [(float(rng.randint(0, width)), rng.random() < p) for _ in range(rng.randint(2, 60))]
    scores = sorted({s for s, _ in units})
    t = [sum(1 for s, k in units if s == v and k) for v in scores]
    c = [sum(1 for s, k in units if s == v and not k) for v in scores]
    starts, reach = sorted({0, *(rng.randrange(len(scores)) for _ in range(6))}), 1
    while True:
        marks, got = [], {}
        for k, a in enumerate(starts):
            b = starts[k + 1] if k + 1 < len(starts) else len(scores)
            rows, left, right = matching.allocate_range(scores[a:b], t[a:b], c[a:b], k == 0, k == len(starts) - 1)
            marks += [(k, left, right)] if left or right else []
            for ts, cs, _, _, n in rows:
                got[ts, cs] = got.get((ts, cs), 0) + n
        if not marks:
            break
        starts = matching._merge(starts, marks, reach)
        reach *= 2
    assert got == greedy(units)


def test_matching_end_to_end(spark):
    rng = np.random.default_rng(2)
    n = 900
    # one score value holds a third of all units
    score = np.where(rng.random(n) < 0.33, 40, rng.integers(0, 90, n)).astype(float)
    treated = (rng.random(n) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "t": treated, "s": score}))
    pairs = matching.match_pairs(df, "id", "t", "s", parts=6).toPandas()
    want = greedy(list(zip(score.tolist(), treated.tolist())))
    got = pairs.groupby(["treated_score", "control_score"]).size().to_dict()
    assert got == want
    assert pairs["treated_id"].is_unique and pairs["control_id"].is_unique
    assert (treated[pairs["treated_id"]] == 1).all() and (treated[pairs["control_id"]] == 0).all()
    matched = matching.matched_data(df, matching.match_pairs(df, "id", "t", "s", parts=6), "id")
    assert matched.count() == 2 * len(pairs)


@pytest.mark.parametrize("block", [8, 150])
def test_neighbours_of_groups_in_one_tree(spark, monkeypatch, block):
    """Groups of very different sizes, some of one point, split over several levels."""
    monkeypatch.setattr(neighbours, "_BLOCK", block)
    monkeypatch.setattr(neighbours, "_FAN", 4)
    rng = np.random.default_rng(block)
    rows = []
    for group, size in enumerate([1, 2, 5, 700, 40, 90]):
        x = np.unique(np.r_[rng.integers(0, 30, (size, 3)), rng.integers(0, 3, (size // 3, 3))], axis=0).astype(float)
        rows += [(f"g{group % 3}", group, i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "node string, d int, pid long, x array<double>")
    found = neighbours.nearest(df, 4, by=["node", "d"]).collect()
    got = {(r["d"], r["pid"], r["rank"]): r["nid"] for r in found}
    assert len(got) == len(found)
    for group in range(6):
        x = np.array([r[3] for r in rows if r[1] == group])
        for i in range(len(x)):
            distance = ((x - x[i]) ** 2).sum(axis=1)
            distance[i] = np.inf
            want = np.argsort(distance, kind="stable")[: min(4, len(x) - 1)].tolist()
            assert [got.pop((group, i, j + 1)) for j in range(len(want))] == want
    assert not got


def test_smote_of_many_classes_is_one_plan(spark):
    """The number of Spark jobs does not depend on the number of classes."""
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for classes in (3, 1000):
        rows = spark.range(4 * classes).selectExpr(
            f"CAST(id % {classes} AS INT) AS y", "CAST(id AS DOUBLE) AS a", "CAST(pmod(hash(id), 97) AS DOUBLE) AS b"
        ).filter("y <> 1 OR a > 3")
        spark.sparkContext.setJobGroup(f"smote-{classes}", "")
        made = imbalance.smote(rows, ["a", "b"], "y")
        sizes = {r["y"]: r["count"] for r in made.groupBy("y").count().collect()}
        jobs.append(len(tracker.getJobIdsForGroup(f"smote-{classes}")))
        assert sizes == dict.fromkeys(range(classes), 4)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] <= jobs[0] + 10


@pytest.mark.parametrize("n", [60, 2600])
def test_neighbours_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, 40, (n, 3)), axis=0).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"pid": np.arange(len(x)), "x": [v.tolist() for v in x]}), "pid long, x array<double>")
    got = {(r["pid"], r["rank"]): r["nid"] for r in neighbours.nearest(df, 4).collect()}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert [got[i, j + 1] for j in range(4)] == np.argsort(d, kind="stable")[:4].tolist()


def test_smote_points_lie_between_neighbours(spark):
    rng = np.random.default_rng(9)
    minor = np.r_[rng.normal(size=(30, 2)), np.repeat([[3.0, 3.0]], 20, axis=0)]
    major = rng.normal(size=(130, 2)) + 8
    rows = [(float(a), float(b), 1) for a, b in minor] + [(float(a), float(b), 0) for a, b in major]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    made = imbalance.smote(df, ["a", "b"], "y").toPandas()
    assert made.groupby("y").size().to_dict() == {0: 130, 1: 130}
    again = imbalance.smote(df.repartition(5), ["a", "b"], "y").toPandas()
    key = lambda f: sorted(map(tuple, f[["a", "b", "y"]].round(9).to_numpy()))
    assert key(made) == key(again)
    for point in made[made.synthetic][["a", "b"]].to_numpy():
        assert any(on_segment(point, p, q) for p in minor for q in minor)


def on_segment(z, p, q):
    along, gap = q - p, z - p
    t = 0.0 if not along.any() else np.clip(gap @ along / (along @ along), 0, 1)
    return np.abs(gap - t * along).max() < 1e-7


def test_equal_odds_on_the_training_rows(spark):
    rng = np.random.default_rng(4)
    n = 1500
    g = rng.integers(0, 3, n)
    y = rng.integers(0, 2, n)
    s = np.round(1 / (1 + np.exp(-(rng.normal(size=n) + y * (0.4 + 0.6 * g)))), 2)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "g": g, "y": y, "s": s}))
    rule = mitigate.equalized_odds_rule(df, "y", "s", "g")
    rates = df.withColumn("p", rule.probability("s")).groupBy("g", "y").agg(F.avg("p").alias("p")).toPandas()
    for level, want in ((0, rule.fpr), (1, rule.tpr)):
        assert rates[rates.y == level]["p"].to_numpy() == pytest.approx(np.full(3, want), abs=1e-9)
    single = df.filter((F.col("g") != 1) | (F.col("y") == 1))
    with pytest.raises(ValueError):
        mitigate.equalized_odds_rule(single, "y", "s", "g")


def test_reweighting_lowers_the_violation(spark):
    rng = np.random.default_rng(8)
    n = 2000
    g = rng.integers(0, 2, n)
    x = np.round(rng.normal(size=n) + g, 2)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x - 0.5)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x, "y": y}))
    fit = mitigate.reweighted_logistic(df, ["x", "g"], "y", ["g"], grid_limit=0.5, constraint_weight=0.9)
    table = fit.table.toPandas()
    plain = table[table.multipliers.map(lambda m: m[0] == 0.0)].iloc[0]
    best = table.loc[table.loss.idxmin()]
    assert len(table) >= 10 and best.violation < plain.violation
    assert fit.multipliers == tuple(best.multipliers)


def test_multiplier_lattice():
    assert len(mitigate.multiplier_grid(3, 10)) == 25
    assert len(mitigate.multiplier_grid(1, 10)) == 11
    assert len(mitigate.multiplier_grid(29, 10)) == 59
    assert all(sum(map(abs, z)) <= 2.0 + 1e-12 for z in mitigate.multiplier_grid(3, 10))


def test_node_round_trip(spark, tmp_path, patients):
    _, df = patients
    path = write_node(df, str(tmp_path / "node"), partition_by=["g"])
    back = read_node(spark, path)
    assert back.select(*df.columns).exceptAll(df.select(*df.columns)).count() == 0 and back.count() == df.count()


def test_permutation_importance_of_any_model(spark):
    rng = random.Random(17)
    rows = [(i, rng.randint(0, 6), rng.randint(0, 1), 5, None if i % 50 == 0 else rng.randint(0, 9)) for i in range(400)]
    rows = [(*r, int(r[1] + 2 * r[2] > 4)) for r in rows]
    df = spark.createDataFrame(rows, "id int, a int, b int, k int, other int, y int").repartition(4)
    linear = models.LinearFit(-4.5, {"a": 1.0, "b": 2.0, "k": 0.0})

    class AsModel:
        """The same score as a model that is known by its columns only."""

        features = ["a", "b", "k"]
        transform = staticmethod(linear.transform)

    one = {r["feature"]: r["importance"] for r in models.permutation_importance(df, linear, "y", "id").collect()}
    two = {r["feature"]: r["importance"] for r in models.permutation_importance(df, AsModel(), "y", "id").collect()}
    order = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|42".encode()).hexdigest())
    wanted = {}
    for at, name in ((1, "a"), (2, "b"), (3, "k")):
        hits = 0
        for before, row in zip([order[-1], *order], order):
            x = [before[c] if c == at else row[c] for c in (1, 2, 3)]
            hits += int(x[0] + 2 * x[1] > 4) == row[5]
        wanted[name] = 1.0 - hits / len(rows)
    assert one == pytest.approx(wanted) and two == pytest.approx(wanted)
    assert wanted["k"] == 0 and wanted["a"] > wanted["b"] > 0
    forest = models.random_forest(df, ["a", "b", "k"], "y", trees=10, depth=4)
    found = {r["feature"]: r["importance"] for r in models.permutation_importance(df, forest, "y", "id", ["b", "a"]).collect()}
    assert set(found) == {"a", "b"} and found["a"] > 0.1
