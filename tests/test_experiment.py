from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from growthlab.operators import experiment as X
from growthlab.operators import ml as M
from growthlab.plans import vip as V


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"u": range(503), "s": rng.integers(0, 4, 503), "x": rng.gamma(1, 80, 503).round(2)})
    return pdf, spark.createDataFrame(pdf)


def test_blocks_are_balanced(people):
    pdf, df = people
    assigned, stats = X.block_randomize(df, "u", ["s"], 3, seed=7)
    assert assigned.count() == len(pdf)
    for r in stats.collect():
        arms = [r["group_0"], r["group_1"], r["group_2"]]
        assert max(arms) - min(arms) <= 1
    again, _ = X.block_randomize(df.repartition(5), "u", ["s"], 3, seed=7)
    assert assigned.join(again, ["u", "group"]).count() == len(pdf)
    other, _ = X.block_randomize(df, "u", ["s"], 3, seed=8)
    assert assigned.join(other, ["u", "group"]).count() < len(pdf)


def test_unequal_shares(people):
    pdf, df = people
    shares = [Fraction(1, 2), Fraction(1, 4), Fraction(1, 4)]
    assert X.arm_pattern(3, shares) == [0, 0, 1, 2]
    _, stats = X.block_randomize(df, "u", ["s"], 3, shares, seed=1)
    for r in stats.collect():
        n = (pdf["s"] == r["s"]).sum()
        assert abs(r["group_0"] - n / 2) <= 2 and abs(r["group_1"] - n / 4) <= 1
    with pytest.raises(ValueError):
        X.arm_pattern(2, [Fraction(1, 2), Fraction(1, 3)])
    with pytest.raises(ValueError):
        X.block_randomize(df.withColumn("group", F.lit(1)), "u", ["s"])


def test_halves(people):
    pdf, df = people
    picked = X.random_half(df, "u", F.col("x") >= 50, 42, "hit").toPandas()
    n = (pdf["x"] >= 50).sum()
    assert picked["hit"].sum() == n // 2
    assert picked.loc[picked["hit"] == 1, "x"].min() >= 50
    withnull = df.withColumn("x", F.when(F.col("u") % 10 != 0, F.col("x")))
    split = X.half_per_band(withnull, "u", "x", 42, "hit").toPandas()
    bands = pd.cut(split["x"], [-1, 14.999, 74.999, 124.999, 1e9], labels=False)
    for _, part in split.groupby(bands):
        assert part["hit"].sum() == len(part) // 2
    assert split.loc[split["x"].isna(), "hit"].sum() == 0


def test_percentile_band(people):
    pdf, df = people
    got = X.percentile_band(df, "x").toPandas().sort_values("u")
    cuts = np.quantile(pdf["x"], [p / 100 for p in X.LEVELS])
    want = [X.LEVELS[min(int(np.searchsorted(cuts, v)), len(cuts) - 1)] for v in pdf["x"]]
    assert got["percentile"].tolist() == want

    def cat(p):
        for c, limit in X.CATEGORY_LIMITS:
            if p <= limit:
                return c
        return 6

    assert got["category"].tolist() == [cat(p) for p in want]


def test_split_and_weights(people):
    pdf, df = people
    parts = X.stratified_split(df, "s", "u").groupBy("s", "part").count().toPandas()
    for s, part in parts.groupby("s"):
        n = part["count"].sum()
        by = dict(zip(part["part"], part["count"]))
        assert by["test"] == int(np.ceil(n * 0.2))
        assert by["val"] == int(np.ceil((n - by["test"]) * 0.2))
    weights = {r["s"]: r["weight"] for r in X.class_weights(df, "s").collect()}
    for s, n in pdf["s"].value_counts().items():
        assert weights[s] == pytest.approx(len(pdf) / (pdf["s"].nunique() * n))


def test_next_run(spark):
    hist = spark.createDataFrame([(3,), (8,)], "c int")
    one = spark.range(1)
    assert one.select(X.next_run(hist, "c").alias("n")).collect()[0]["n"] == 9
    assert one.select(X.next_run(hist.where("c > 100"), "c").alias("n")).collect()[0]["n"] == 2


def test_sweep_matches_counts(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"m": "a", "p": np.round(rng.random(400), 2), "y": rng.integers(0, 2, 400)})
    out = M.threshold_sweep(spark.createDataFrame(pdf), "p", "y", ["m"]).toPandas().sort_values("threshold")
    assert len(out) == 51
    for r in out.itertuples():
        hit = pdf["p"] >= round(r.threshold, 2)
        tp = (hit & (pdf["y"] == 1)).sum()
        prec = tp / hit.sum() if hit.sum() else 0.0
        assert r.precision == pytest.approx(prec)
        assert r.recall == pytest.approx(tp / (pdf["y"] == 1).sum())
        assert r.accuracy == pytest.approx((hit == (pdf["y"] == 1)).mean())


def test_clip_and_prune(people, spark):
    pdf, df = people
    out = M.clip_quantiles(df, ["x"]).toPandas().sort_values("u")
    np.testing.assert_allclose(out["x"], pdf["x"].clip(*np.quantile(pdf["x"], [0.01, 0.99])))
    two = df.withColumn("x2", F.col("x") * 2 + F.col("u") / 1e4)
    assert M.prune_correlated(two, ["x", "x2", "s"]) == ["x", "s"]


def test_models_route_save_and_load(spark, tmp_path):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"user_id": range(600), "a": rng.normal(size=600), "b": rng.normal(size=600),
                        "window_number": rng.integers(0, 4, 600)})
    pdf["flag"] = ((pdf["a"] + 0.3 * pdf["b"]) > 0.5).astype(int)
    df = spark.createDataFrame(pdf)
    models = {w: M.fit_logistic(df.where(f"window_number = {w}"), ["a", "b"], iterations=20) for w in (0, 1)}
    models[2] = M.fit_boosted(
        df.where("window_number = 2"), ["a", "b"], validation=F.col("user_id") % 5 == 0, iterations=5, rate=0.3, depth=3
    )
    M.save_models(spark, models, str(tmp_path / "m"))
    loaded = M.load_models(spark, str(tmp_path / "m"), [0, 1, 2])
    assert loaded[2] == models[2]
    assert [M.logistic_terms(loaded[w], ["a", "b"]) for w in (0, 1)] == [M.logistic_terms(models[w], ["a", "b"]) for w in (0, 1)]
    out = M.score_by_window(df, loaded, 0.5).toPandas()
    assert len(out) == 600
    none = out[out["window_number"] == 3]
    assert none["window"].isna().all() and (none["probability_positive_class"] == 0).all()
    assert (none["potential_vip_ind"] == 0).all()
    rest = out[out["window_number"] < 3]
    assert (rest["potential_vip_ind"] == rest["flag"]).mean() > 0.85
    table = loaded[2].importance(spark).collect()
    assert table[0]["feature"] == "a" and sum(r["importance"] for r in table) == pytest.approx(100)
    with pytest.raises(ValueError):
        M.fit_logistic(df, ["missing"])


def vip_row(u, **kw):
    row = {c: None for c in V.SUM_COLS + V.EXTREME_COLS + V.AVERAGE_COLS}
    row.update(user_id=u, firebase_user_id=f"F{u}", signup_date="2024-01-01", first_purchase_date="2024-01-01",
               email=None, full_name="N", channel=None, signup_email_domain="Gmail.com", signup_platform="Web",
               window_number=1, first_purchase_amt=5.0, total_purchase_amount=10.0)
    row.update(kw)
    return row


def test_vip_features(spark):
    rows = [vip_row(1, ggr_amt=-3.0), vip_row(2, sum_amt_total=-5.0), vip_row(3, channel="Google", window_number=4)]
    types = {c: "double" for c in V.SUM_COLS + V.EXTREME_COLS + V.AVERAGE_COLS + ["first_purchase_amt", "total_purchase_amount"]}
    types |= {"user_id": "long", "window_number": "int"}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in rows[0])
    out = V.prepare(spark.createDataFrame([tuple(r.values()) for r in rows], schema))
    assert set(V.MODEL_FEATURES) <= set(out.columns)
    got = {r["user_id"]: r for r in out.collect()}
    assert set(got) == {1, 3}  # a negative sum has no logarithm
    assert got[1]["ggr_amt_log"] == pytest.approx(-np.log1p(3)) and got[1]["avg_spin_amt_is_missing"] == 1
    assert got[1]["channel_other"] == 1 and got[3]["channel_google"] == 1
    assert got[1]["signup_email_domain_gmail.com"] == 1 and got[3]["window_4"] == 1 and got[1]["window_1"] == 1


def test_dotted_features_train(spark):
    df = spark.createDataFrame([(i, float(i % 7), int(i % 7 > 3)) for i in range(70)], "u int, `x.com` double, flag int")
    scored = M.score(M.fit_logistic(df, ["x.com"], iterations=10), df)
    assert scored.columns == ["u", "x.com", "flag", "probability_positive_class"]


def test_new_customers(spark):
    scored = spark.createDataFrame(
        [(i, 0.99 if i % 2 else 0.1, int(i % 2), 0, "2024-01-01", "2024-01-01") for i in range(20)],
        "user_id int, probability_positive_class double, potential_vip_ind int, window int, signup_date string, first_purchase_date string",
    )
    amounts = spark.createDataFrame(
        [(i, 100.5, None, 1600.0 if i == 4 else 10.0, 1) for i in range(20)],
        "user_id int, sum_amt_total double, sum_redeem_amt double, total_purchase_amount double, cnt_txn_total int",
    )
    known = spark.createDataFrame([(1,), (3,)], "user_id int")
    worth = spark.createDataFrame([(i, 20.0) for i in range(20) if i != 5], "user_id int, enp double")
    fresh = V.new_customers(scored, amounts, known, worth, 42)
    out = V.output_rows(fresh, "2024-06-01 10:11:12").toPandas()
    assert set(out["user_id"]) == {4, 5, 7, 9, 11, 13, 15, 17, 19}
    assert out["vip_mentioned"].sum() == 4 and out.set_index("user_id").loc[5, "vip_mentioned"] == 0
    assert (out["total_purchase_amt"] == 100).all() and (out["total_redeem_amt"] == 0).all()
    assert str(out["updated_at"].iloc[0]) == "2024-06-01 10:11:00"
    published = V.output_rows(fresh, "2024-06-01 10:11:12")
    rows = V.experiment_rows(published, "2024-06-06").collect()
    assert len(rows) == 4 and rows[0]["experiment_id"] == 1090 and rows[0]["experiment_group"] == "B"
    assert V.experiment_rows(published, "2024-06-07").count() == 0
    numbered = V.same_day_rows(published, spark.createDataFrame([(6,)], "con_current int"))
    assert {r["con_current"] for r in numbered.collect()} == {7}


def test_boosted_rounds_keep_improving(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"user_id": range(1500), "a": rng.normal(size=1500), "b": rng.normal(size=1500)})
    pdf["flag"] = (rng.random(1500) < 1 / (1 + np.exp(-2 * pdf["a"] + pdf["b"]))).astype(int)
    df = spark.createDataFrame(pdf).repartition(1).cache()
    model = M.fit_boosted(df, ["a", "b"], validation=F.col("user_id") % 5 == 0, iterations=130, rate=0.01, depth=3)
    assert len(model.trees) > 100
    assert model.losses[-1] < model.losses[60] < model.losses[0]
    scored = M.score(model, df)
    assert scored.columns == ["user_id", "a", "b", "flag", "probability_positive_class"]


def test_terms_score_like_the_models(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.normal(size=300), "x.com": rng.normal(size=300), "window_number": rng.integers(0, 3, 300)})
    pdf["flag"] = (pdf["a"] + rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame(pdf)
    names = ["a", "x.com"]
    models = {w: M.fit_logistic(df.where(f"window_number = {w}"), names) for w in (0, 1)}
    out = M.score_by_window(df, models, 0.5).toPandas()
    two = M.score_by_terms(df, {w: M.logistic_terms(m, names) for w, m in models.items()}, 0.5).toPandas()
    for w, model in models.items():
        part = df.where(f"window_number = {w}")
        own = model.transform(part.withColumnRenamed("x.com", "x_dot_com")).select("a", vector_to_array("probability")[1].alias("p"))
        own = own.toPandas().sort_values("a")["p"]
        for got in (out, two):
            mine = got[got["window"] == w].sort_values("a")
            np.testing.assert_allclose(mine["probability_positive_class"], own, atol=1e-12)
            assert (mine["potential_vip_ind"] == (mine["probability_positive_class"] >= 0.5)).all()
    assert out[out["window_number"] == 2]["window"].isna().all()
