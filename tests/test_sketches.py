import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from growthlab.operators import experiment as X
from growthlab.operators import ml as M
from growthlab.operators import sketches as SK
from growthlab.operators import timeseries as TS


def test_distinct_counts_merge_within_their_bound(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("day"), (F.col("id") * 7919 % 23_000).alias("user"))
    rows = rows.unionByName(spark.createDataFrame([(0, None)], "day long, user long"))
    daily = SK.distinct_sketches(rows, ["day"], "user")
    whole = SK.distinct_estimates(SK.merge_distinct(daily, [])).first()["distinct"]
    assert abs(whole - 23_000) <= 23_000 * SK.distinct_error()
    exact = {r.day: r.n for r in rows.groupBy("day").agg(F.countDistinct("user").alias("n")).collect()}
    for r in SK.distinct_estimates(daily).collect():
        assert abs(r["distinct"] - exact[r.day]) <= exact[r.day] * SK.distinct_error()
    small = SK.distinct_estimates(SK.distinct_sketches(spark.range(40), [], "id")).first()["distinct"]
    assert small == 40


@pytest.mark.parametrize("shape", ["normal", "ties", "sorted"])
def test_quantile_ranks_within_their_bound(spark, shape):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(size=40_000), "ties": rng.integers(0, 9, 40_000) * 1.0, "sorted": np.arange(40_000) * 1.0}[shape]
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(40_000) % 2, "x": x})).repartition(6)
    levels = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    for r in SK.sketch_quantiles(df, ["g"], "x", levels).collect():
        own = x[np.arange(40_000) % 2 == r.g]
        for p, q in zip(levels, r.quantiles):
            assert (own < q).mean() <= p + 2 * SK.rank_error() and (own <= q).mean() >= p - 2 * SK.rank_error()


def test_sketches_serve_clipping_and_bands(spark):
    df = spark.createDataFrame([(float(k),) for k in range(5000)], "v double")
    out = M.clip_quantiles(df, ["v"], quantiles=SK.sketch_quantiles).agg(F.min("v"), F.max("v")).first()
    assert out[0] == pytest.approx(50, abs=75) and out[1] == pytest.approx(4950, abs=75)
    exact, near = (X.percentile_band(df, "v", quantiles=q).agg(F.avg("percentile")).first()[0] for q in (X.O.exact_quantiles, SK.sketch_quantiles))
    assert near == pytest.approx(exact, abs=2)


def test_frames_by_time_equal_rows_without_gaps_and_differ_with_them(spark):
    rng = np.random.default_rng(5)
    hours = pd.date_range("2024-01-01", periods=900, freq="h")
    total = rng.poisson(30, 900)
    pdf = pd.DataFrame({"platform": "p", "hour": hours, "approved": rng.binomial(total, 0.8), "total": total})
    whole = spark.createDataFrame(pdf)
    clock = TS.Clock(3600, coverage=0.0)
    rows = TS.rolling_features(whole, clean=False).orderBy("hour").toPandas()
    timed = TS.rolling_features(whole, clean=False, clock=clock).orderBy("hour").toPandas()
    # the same hour seven times is seven weeks in both
    for c in TS.FEATURES:
        np.testing.assert_allclose(rows[c].astype(float), timed[c].astype(float), atol=1e-9, err_msg=c)
    gaps = spark.createDataFrame(pdf.drop(index=[700, 701, 702, 850]))
    rows = TS.rolling_features(gaps, clean=False).orderBy("hour").toPandas().set_index("hour")
    timed = TS.rolling_features(gaps, clean=False, clock=TS.Clock(3600, coverage=0.75)).orderBy("hour").toPandas().set_index("hour")
    at = hours[703]
    rate = pdf["approved"] / pdf["total"]
    assert rows.loc[at, "success_ma_3h"] == pytest.approx(rate[[*range(689, 700), 703]].mean())
    assert timed.loc[at, "success_ma_3h"] == pytest.approx(rate[[*range(692, 700), 703]].mean())
    assert timed.loc[hours[702 + 2], "success_vs_1h_avg"] == 1.0  # two of four buckets are too few
    assert timed.loc[hours[704], "volume_momentum_1h"] == 0.0 and rows.loc[hours[704], "volume_momentum_1h"] != 0.0
    assert timed.loc[hours[850 + 168], "success_vs_7days_ago"] == 1.0 if 850 + 168 < 900 else True
