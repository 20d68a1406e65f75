import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from growthlab.operators import joins as J
from growthlab.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows belong to one key; values repeat."""
    rng = np.random.default_rng(1)
    n = 4000
    key = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame(
        {"k": key, "t": rng.integers(0, 50, n), "id": np.arange(n), "v": rng.integers(0, 30, n).astype(float)}
    )
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_running_sum_matches_window_and_splits_hot_key(skewed):
    pdf, df = skewed
    out = O.running_sum(df, ["k"], ["t", "id"], "v", "run", slices=8).toPandas().sort_values("id")
    want = pdf.sort_values(["k", "t", "id"]).assign(run=lambda x: x.groupby("k")["v"].cumsum())
    assert len(out) == len(pdf)
    np.testing.assert_allclose(out["run"].values, want.sort_values("id")["run"].values)
    slices = O.sliced(df, ["k"], ["t", "id"], slices=8).where("k = 0").groupBy("_slice").count().collect()
    assert len(slices) > 2
    assert max(r["count"] for r in slices) < 0.6 * (pdf["k"] == 0).sum()


def test_exact_quantiles(skewed):
    pdf, df = skewed
    levels = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["k"]: r["quantiles"] for r in O.exact_quantiles(df, ["k"], "v", levels, slices=8).collect()}
    for k, part in pdf.groupby("k"):
        np.testing.assert_allclose(got[k], np.quantile(part["v"], levels))


def test_quantiles_skip_nulls_and_single_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", 5.0)], "g string, x double")
    got = {r["g"]: r["quantiles"] for r in O.exact_quantiles(df, ["g"], "x", [0.5]).collect()}
    assert got == {"a": [2.0], "b": [5.0]}


def test_draw_rank_is_a_permutation(skewed):
    pdf, df = skewed
    ranked = O.draw_rank(df, ["k"], "id", 42).toPandas()
    for k, part in ranked.groupby("k"):
        assert sorted(part["_rank"]) == list(range(len(part)))
        assert (part["_size"] == len(part)).all()
    again = O.draw_rank(df.repartition(3), ["k"], "id", 42).toPandas()
    merged = ranked.merge(again, on="id")
    assert (merged["_rank_x"] == merged["_rank_y"]).all()


def test_draw_rank_keeps_null_strata(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, s string")
    assert sorted(O.draw_rank(df, ["s"], "id", 1).select("_rank").toPandas()["_rank"]) == [0, 0, 1]


def test_null_safe_full_join(spark):
    a = spark.createDataFrame([("x", None, 1), (None, None, 2)], "p string, q string, a int")
    b = spark.createDataFrame([("x", None, 10), ("y", "z", 20)], "p string, q string, b int")
    got = {(r["p"], r["q"], r["a"], r["b"]) for r in J.null_safe_join(a, b, ["p", "q"], "full").collect()}
    assert got == {("x", None, 1, 10), (None, None, 2, None), ("y", "z", None, 20)}


def test_id_filters_and_lookup(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "u int")
    ids = spark.createDataFrame([(2,), (None,)], "u int")
    assert [r[0] for r in J.keep_ids(df, ids, "u").collect()] == [2]
    assert sorted(r[0] for r in J.drop_ids(df, ids, "u").collect()) == [1, 3]
    coded = J.lookup(df, "u", {1: "one"}, "name", "many").orderBy("u")
    assert [r["name"] for r in coded.collect()] == ["one", "many", "many"]
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "k string, t string")
    assert [r["k"] for r in J.mixed_pairs(pairs, ["k"], "t").collect()] == ["a"]


def test_four_week_bucket(spark):
    import datetime as dt

    weeks = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in (0, 1, 3, 4, 9, 10)]
    df = spark.createDataFrame([(w,) for w in weeks for _ in range(2)], "su_week date")
    got = {(r["su_week"], r["month_group"]) for r in O.four_week_bucket(df).collect()}
    assert got == {(w, weeks[0] if i < 4 else weeks[4]) for i, w in enumerate(weeks)}


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(9)] + [("b", 1)], "g string, x int")
    got = O.top_per_group(df, ["g"], [F.desc("x")], 2, "rk").collect()
    assert {(r["g"], r["x"], r["rk"]) for r in got} == {("a", 8, 1), ("a", 7, 2), ("b", 1, 1)}
