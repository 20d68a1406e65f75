import json

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from growthlab.operators import boosting as B
from growthlab.operators import ml as M
from growthlab.operators import trees as T

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"user_id": range(900), "a": rng.normal(size=900), "b": rng.normal(size=900), "noise": rng.normal(size=900)})
    pdf["flag"] = (rng.random(900) < 1 / (1 + np.exp(-3 * pdf["a"] + pdf["b"]))).astype(int)
    return pdf, spark.createDataFrame(pdf).repartition(2).cache()


def walk(tree, x):
    at = 0
    while tree["feature"][at] >= 0:
        v = x[tree["feature"][at]]
        at = tree["left"][at] if v is None or v != v or v < tree["cut"][at] else tree["right"][at]
    return tree["value"][at]


def test_leaves_by_hand(spark):
    # two rows left of 2 (y = 0, 0), three right of it (y = 1, 1, 0); p = 1/2, weight of a positive row 3 / 2
    rows = [(1.0, 0), (1.5, 0), (2.0, 1), (3.0, 1), (4.0, 0)]
    df = spark.createDataFrame(rows, "x double, flag int")
    model = B.fit_newton(df, ["x"], rounds=1, rate=1.0, depth=1, l2=10.0, least_hessian=0.1)
    (tree,) = model.trees
    assert tree["feature"] == [0, -1, -1] and tree["cut"][0] == 2.0
    left, right = -(0.5 + 0.5) / (0.5 + 10), -(-0.75 - 0.75 + 0.5) / (0.375 * 2 + 0.25 + 10)
    assert tree["value"][1:] == pytest.approx([left, right])
    free = B.fit_newton(df, ["x"], rounds=1, rate=0.5, depth=1, l2=0.0, least_hessian=0.1, positive_weight=1.0).trees[0]
    assert free["value"][1:] == pytest.approx([0.5 * -1 / 0.5, 0.5 * 0.5 / 0.75])
    assert B.fit_newton(df, ["x"], rounds=1, depth=1, least_hessian=9.0).trees[0]["feature"] == [-1]


def test_best_split_against_all_splits():
    rng = np.random.default_rng(1)
    grads, hessians = rng.normal(size=(3, 2, 5)), rng.random((3, 2, 5))
    grads[:, 1] *= grads[:, :1].sum(2) / grads[:, 1:].sum(2)
    hessians[:, 1] *= hessians[:, :1].sum(2) / hessians[:, 1:].sum(2)
    gains, features, cuts, left = B.best_splits(grads, hessians, 10.0, 0.5)
    for k in range(3):
        best = (0.0, None)
        for f in range(2):
            for c in range(1, 5):
                g, h = grads[k, f, :c].sum(), hessians[k, f, :c].sum()
                g2, h2 = grads[k, f, c:].sum(), hessians[k, f, c:].sum()
                if min(h, h2) >= 0.5:
                    gain = g * g / (h + 10) + g2 * g2 / (h2 + 10) - (g + g2) ** 2 / (h + h2 + 10)
                    best = max(best, (gain, (f, c, g, h)), key=lambda x: x[0])
        assert gains[k] == pytest.approx(best[0])
        assert (features[k], cuts[k], *left[k]) == pytest.approx(best[1])


def test_newton_learns_and_stops(noisy):
    pdf, df = noisy
    model = B.fit_newton(df, [*NAMES, "noise"], validation=F.col("user_id") % 5 == 0, rounds=40, rate=0.3, depth=3, patience=3)
    assert len(model.losses) < 40 and len(model.trees) == 1 + int(np.argmin(model.losses)) == len(model.losses) - 3
    assert model.losses[0] < np.log(2) and model.gains["a"] > model.gains["b"] > model.gains["noise"]
    out = M.score(model, df).toPandas().sort_values("user_id")
    margin = [sum(walk(t, x) for t in model.trees) for x in pdf[[*NAMES, "noise"]].to_numpy()]
    np.testing.assert_allclose(out["probability_positive_class"], 1 / (1 + np.exp(-np.array(margin))), atol=1e-12)
    held = pdf["user_id"] % 5 == 0
    y, p = pdf["flag"][held], 1 / (1 + np.exp(-np.array(margin)))[held]
    assert -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() == pytest.approx(min(model.losses))
    assert ((p >= 0.5) == y).mean() > 0.8


def test_missing_values_go_left_and_repeated_rows_count(spark):
    rows = [(None, 0), (float("nan"), 0), (5.0, 1), (5.0, 1), (5.0, 1), (None, 0), (6.0, None)] * 5
    df = spark.createDataFrame(rows, "x double, flag int")
    model = B.fit_newton(df, ["x"], rounds=2, rate=1.0, depth=2, l2=1.0)
    got = {str(r.x): r.probability_positive_class for r in M.score(model, df).collect()}
    assert got["None"] == got["nan"] < 0.5 < got["5.0"]


def test_boosted_classifier_as_flat_trees(spark, noisy, tmp_path):
    _, df = noisy
    frame = VectorAssembler(inputCols=NAMES, outputCol="v").transform(df)
    fitted = GBTClassifier(featuresCol="v", labelCol="flag", maxIter=7, maxDepth=4, seed=1).fit(frame)
    flat = T.of_gbt(spark, fitted, NAMES, str(tmp_path / "gbt"))
    assert len(flat.trees) == 7 and flat.depth <= 4 and flat.gains["a"] > flat.gains["b"] > 0
    both = M.score(flat, fitted.transform(frame), "p").select("p", vector_to_array("probability")[1].alias("q")).toPandas()
    np.testing.assert_allclose(both["p"], both["q"], atol=1e-12)
    assert M.score(flat.first(3), df).count() == 900 and len(flat.first(3).trees) == 3
    T.save(spark, {"x": flat}, str(tmp_path / "flat"))
    assert T.load(spark, str(tmp_path / "flat")) == {"x": flat}
    json.loads(json.dumps(flat.trees))


def test_gradient_boosting_is_that_of_spark(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"user_id": range(1200), "a": rng.integers(0, 12, 1200) / 2, "b": rng.integers(-4, 9, 1200), "c": (rng.random(1200) < 0.01) * 1.0})
    chance = 1 / (1 + np.exp(2 - pdf["a"] + pdf["b"] / 3 - 4 * pdf["c"] + rng.normal(size=1200)))
    pdf["flag"] = (chance > 0.5).astype(int)
    df = spark.createDataFrame(pdf).repartition(3).cache()
    names, held = ["a", "b", "c"], F.col("user_id") % 4 == 0
    train = VectorAssembler(inputCols=names, outputCol="v").transform(M._with_weights(df.where(~held), "flag"))
    spark_model = GBTClassifier(featuresCol="v", labelCol="flag", weightCol="weight", maxIter=30, stepSize=0.1, maxDepth=4, seed=1).fit(train)
    mine = M.fit_boosted(df, names, validation=held, iterations=30, rate=0.1, depth=4)
    all_rounds = B.fit_gradient(df.where(~held), names, {r.flag: r.weight for r in train.select("flag", "weight").distinct().collect()}, rounds=30, rate=0.1, depth=4)
    both = M.score(all_rounds, spark_model.transform(train), "p").select("p", vector_to_array("probability")[1].alias("q")).toPandas()
    np.testing.assert_allclose(both["p"], both["q"], atol=1e-9)
    weighted = M._with_weights(df.where(~held), "flag").select("flag", "weight").distinct()
    losses = spark_model.evaluateEachIteration(VectorAssembler(inputCols=names, outputCol="v").transform(df.where(held).join(weighted, "flag")))
    np.testing.assert_allclose(mine.losses, losses, rtol=1e-9)
    assert len(mine.trees) == 1 + int(np.argmin(losses))
    want = spark_model.featureImportances.toArray()  # of trees as shares, so only the order is alike
    assert sorted(names, key=all_rounds.gains.get) == [names[k] for k in np.argsort(want)]


def test_rounds_cost_one_small_job_a_level(spark, noisy):
    """Ten rounds of a table whose tasks hold a few blocks; plans of whole tables took seconds a round."""
    import time

    _, df = noisy
    many = df.crossJoin(spark.range(100)).selectExpr("a + id / 1000 AS a", "b", "noise", "flag", "id % 5 = 0 AS held").cache()
    assert many.count() == 90_000
    for fit in (
        lambda n: B.fit_newton(many, [*NAMES, "noise"], validation=F.col("held"), rounds=n, patience=n),
        lambda n: M.fit_boosted(many, [*NAMES, "noise"], validation=F.col("held"), iterations=n),
    ):
        fit(2)
        start = time.perf_counter()
        few = fit(2)
        base = time.perf_counter() - start
        start = time.perf_counter()
        more = fit(32)  # past the round from which margins are made anew
        assert (time.perf_counter() - start - base) / 30 < 1.5
        assert len(more.losses) == 32 and few.losses == pytest.approx(more.losses[:2]) and more.losses[-1] < more.losses[0]


def test_windows_of_every_kind_in_one_read(noisy):
    pdf, df = noisy
    df = df.withColumn("window_number", (F.col("user_id") % 4).cast("int"))
    models = {
        0: M.fit_logistic(df.where("window_number = 0"), NAMES, iterations=20),
        1: B.fit_newton(df.where("window_number = 1"), NAMES, rounds=2, rate=0.5, depth=2),
        2: M.fit_boosted(df.where("window_number = 2"), NAMES, iterations=2, rate=0.5, depth=2),
    }
    out = M.score_by_window(df, models, 0.5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") + plan.count("LogicalRDD") == 1 and "Union" not in plan
    for w, model in models.items():
        mine = out.where(f"window_number = {w}").orderBy("user_id").toPandas()["probability_positive_class"]
        alone = M.score(model, df.where(f"window_number = {w}")).orderBy("user_id").toPandas()["probability_positive_class"]
        np.testing.assert_allclose(mine, alone)
    none = out.where("window_number = 3").toPandas()
    assert (none["probability_positive_class"] == 0).all() and none["window"].isna().all()


def test_permutation_importance_against_loops(noisy, spark):
    pdf, df = noisy
    out = M.permutation_importance(
        df, "user_id", [*NAMES, "noise"], "flag", lambda x: f"1 / (1 + exp(-3 * get({x}, 0) + get({x}, 1)))", seed=7
    )
    got = {r.feature: (r.loss, r.loss_increase) for r in out.collect()}
    import hashlib

    def order(tag):
        return sorted(pdf["user_id"], key=lambda u: (hashlib.md5(f"7-{tag}-{u}".encode()).hexdigest(), u))

    partner = dict(zip(order("rows"), order("values")))
    rows = pdf.set_index("user_id")

    def loss(frame):
        p = 1 / (1 + np.exp(-3 * frame["a"] + frame["b"]))
        return -(frame["flag"] * np.log(p) + (1 - frame["flag"]) * np.log(1 - p)).mean()

    for name in [*NAMES, "noise"]:
        swapped = rows.assign(**{name: rows[name].loc[[partner[u] for u in rows.index]].to_numpy()})
        assert got[name] == pytest.approx((loss(swapped), loss(swapped) - loss(rows)))
    assert got["a"][1] > got["b"][1] > got["noise"][1] == pytest.approx(0)


def test_moments_with_gaps_against_pandas(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(500, 6)), columns=list("abcdef"))
    pdf["b"] = pdf["a"] * 1e6 + 1e9 + pdf["b"]
    pdf["c"] = 5.0
    pdf.loc[::3, "d"] = None
    pdf.loc[1::2, "e"] = None
    pdf.loc[2:, "f"] = None
    got = {(r.a, r.b): r.r for r in M.correlations(spark.createDataFrame(pdf).repartition(5), list("abcdef")).collect()}
    want = pdf.corr(min_periods=2)
    assert len(got) == 15
    for (x, y), r in got.items():
        w = want.loc[x, y]
        assert (r is None) if np.isnan(w) or "c" in (x, y) else r == pytest.approx(w, abs=1e-9)
    assert M.correlations(spark.createDataFrame(pdf).limit(0), list("ab")).collect() == []
