import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from growthlab.operators import forest as IF
from growthlab.operators import timeseries as TS
from growthlab.plans import anomaly as AN


def make_series(n, seed, platform, step=15):
    rng = np.random.default_rng(seed)
    total = rng.poisson(40, n)
    total[5] = 0
    approved = rng.binomial(total, 0.75)
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=step * i) for i in range(n)]
    return pd.DataFrame({"platform": platform, "hour": hours, "approved": approved, "total": total})


@pytest.fixture(scope="module")
def series(spark):
    pdf = pd.concat([make_series(700, 1, "WEB_NUVEI"), make_series(400, 2, "NUVEI_CARD")])
    return pdf, spark.createDataFrame(pdf)


def expected(pdf):
    """Straight per-platform evaluation with array slices."""
    d = pdf.sort_values("hour").iloc[:-1].reset_index(drop=True)
    sr = (d["approved"] / d["total"].replace(0, 1)).to_numpy(float)
    tot = d["total"].to_numpy(float)
    app = d["approved"].to_numpy(float)
    how = (d["hour"].dt.dayofweek * 24 + d["hour"].dt.hour).to_numpy()
    last = slice(max(0, len(d) - 336), len(d))
    out = []

    def nz(x, y):
        return y if x == 0 else x

    sr4s = []
    for i in range(len(d)):
        four, twelve, week = (slice(max(0, i - k), i + 1) for k in (3, 11, 167))
        t4 = tot[four].sum()
        sr4 = app[four].sum() / nz(t4, 1)
        sr4s.append(sr4)
        same = np.flatnonzero(how[: i + 1] == how[i])[-7:]
        seen = how[last] == how[i]
        fs = np.clip(sr[last][seen].mean() / sr[last].mean(), 0.3, 3) if seen.any() else 1.0
        fv = np.clip(tot[last][seen].mean() / tot[last].mean(), 0.3, 3) if seen.any() else 1.0
        enough = i + 1 >= 24
        r7s, r7v = (sr[week].mean(), tot[week].mean()) if enough else (np.nan, np.nan)
        rhs, rhv = (sr[same].mean(), tot[same].mean()) if len(same) >= 2 else (r7s, r7v)
        x = np.arange(len(sr[twelve]))
        out.append([
            np.clip(sr4 / nz(rhs * fs, 0.5), 0.1, 5), np.clip(t4 / nz(rhv * fv * 4, 10), 0.1, 5),
            np.clip(sr[i] / nz(r7s, 0.5), 0.1, 5), np.clip(tot[i] / nz(r7v, 10), 0.1, 5),
            sr[i] / nz(sr[four].mean(), 1), tot[i] / nz(tot[twelve].mean(), 1), sr[twelve].mean(),
            sr4 / nz(sr4s[i - 168], 1) if i >= 168 else 1.0,
            sr[twelve].std(ddof=1) if i >= 1 else 0.0, tot[twelve].std(ddof=1) if i >= 1 else 0.0,
            np.polyfit(x, sr[twelve], 1)[0] if i >= 2 else 0.0,
            0.0 if i < 4 else (tot[i] / tot[i - 4] - 1 if tot[i - 4] else 1.0),
        ])
    frame = pd.DataFrame(out, columns=TS.FEATURES)
    for c in frame:
        med = frame[c].median()
        frame[c] = frame[c].fillna(med if med > 0 else 1.0)
    return frame


def test_features_match_direct_evaluation(series):
    pdf, df = series
    got = TS.rolling_features(TS.complete_rows(df)).toPandas()
    for platform, part in pdf.groupby("platform"):
        mine = got[got["platform"] == platform].sort_values("hour")
        want = expected(part)
        for c in TS.FEATURES:
            np.testing.assert_allclose(mine[c].to_numpy(float), want[c], atol=1e-8, err_msg=c)


def test_causal_factors_ignore_the_future(series):
    _, df = series
    rows = TS.complete_rows(df).where("platform = 'WEB_NUVEI'")
    cut = F.lit("2024-01-04").cast("timestamp")
    full = TS.rolling_features(rows, causal=True, clean=False).where(F.col("hour") < cut)
    part = TS.rolling_features(rows.where(F.col("hour") < cut), causal=True, clean=False)
    cols = ["hour", "success_factor", "volume_factor"]
    assert full.select(cols).exceptAll(part.select(cols)).count() == 0


def test_standardise(series):
    _, df = series
    rows = TS.with_rate(df).withColumn("flat", F.lit(3.0))
    out = TS.standardise(rows, ["success_rate", "flat"]).groupBy("platform").agg(
        F.avg("success_rate").alias("a"), F.stddev_pop("success_rate").alias("s"), F.max("flat").alias("f")
    )
    for r in out.collect():
        assert r["a"] == pytest.approx(0, abs=1e-9) and r["s"] == pytest.approx(1) and r["f"] == 0


def test_tree_paths_isolate_outliers():
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(size=(255, 3)), [[12.0, 12.0, 12.0]]])
    trees = [IF.grow(points, np.random.default_rng(i)) for i in range(50)]
    depth = np.mean([IF.path_lengths(points, t) for t in trees], axis=0)
    assert depth.argmin() == 255
    flat = IF.grow(np.ones((10, 2)), rng)
    assert flat["feature"] == [-1] and flat["depth"][0] == pytest.approx(IF.path_norm(10))


def test_expression_scores_equal_array_walks(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"platform": ["a"] * 300 + ["b"] * 40, "hour": pd.date_range("2024-01-01", periods=340, freq="h"),
                        "x": rng.normal(size=340), "y": rng.normal(size=340), "z": 1.0})
    df = spark.createDataFrame(pdf)
    names = ["x", "y", "z"]
    forest = IF.fit_forest(df, names, trees=12, sample=64)
    got = IF.raw_scores(df.withColumn("_slice", F.dayofweek("hour")), forest, names).toPandas().set_index("hour")["score"]
    for r in forest.collect():
        rows = pdf[pdf["platform"] == r.platform]
        depth = np.mean([IF.path_lengths(rows[names].to_numpy(), t.asDict()) for t in r.forest], axis=0)
        assert r.sample_rows == min(64, len(rows)) and len(r.forest) == 12
        np.testing.assert_allclose(got[rows["hour"]], -np.exp2(-depth / IF.path_norm(r.sample_rows)), atol=1e-12)
    lone = IF.raw_scores(df.withColumn("_slice", F.lit(1)), forest.where("platform = 'a'"), names)
    assert lone.where("platform = 'b' AND score IS NOT NULL").count() == 0


def test_detector_flags_about_the_contaminated_share(series, tmp_path, spark):
    pdf, df = series
    short = spark.createDataFrame(make_series(50, 3, "PAYSAFE_CARD"))
    both = df.unionByName(short)
    detector = AN.fit(both, trees=25)
    early = AN.score_history(both, detector).select("platform", "hour", "is_anomaly", *TS.FEATURES).toPandas()
    part = both.where(F.col("hour") < F.lit(pdf["hour"].max() - pd.Timedelta(days=1)))
    before = AN.score_history(part, detector).select("platform", "hour", *TS.FEATURES).toPandas()
    same = before.merge(early, on=["platform", "hour"], suffixes=("", "_all"))
    assert len(same) == len(before) and np.allclose(same[TS.FEATURES], same[[f"{c}_all" for c in TS.FEATURES]])
    history = AN.score_history(both, detector, causal=False).toPandas()
    for platform, part in history.groupby("platform"):
        rate = TS.CONTAMINATION[platform]
        assert len(part) == (pdf["platform"] == platform).sum() - 1
        assert abs(part["is_anomaly"].mean() - rate) <= 1.5 / len(part) + 1e-9
        assert (part["confidence"] == part["anomaly_score"].abs()).all()
    detector.save(str(tmp_path / "d"))
    again = AN.Detector.load(spark, str(tmp_path / "d"))
    records = {r["platform"]: r for r in AN.latest_records(both, again).collect()}
    assert records["PAYSAFE_CARD"]["status"] == "insufficient data"
    assert records["PAYSAFE_CARD"]["records_analyzed"] == 49
    ok = records["WEB_NUVEI"]
    newest = history[history["platform"] == "WEB_NUVEI"].sort_values("hour").iloc[-1]
    assert ok["status"] == "ok" and ok["anomaly_score"] == pytest.approx(newest["anomaly_score"])
    assert ok["prediction_timestamp"] == newest["hour"].to_pydatetime()
    assert set(ok["rolling_feature_values"]) == set(TS.FEATURES) and ok["features_count"] == 12
    assert ok["contamination_rate"] == 0.008 and ok["rolling_context"]["hour_of_week"] < 168


def test_spike_is_found(spark):
    calm = make_series(600, 5, "WEB_NUVEI")
    calm.loc[400, ["approved", "total"]] = [2, 160]
    df = spark.createDataFrame(calm)
    scored = AN.score_history(df, AN.fit(df, trees=50)).orderBy("anomaly_score").limit(15).toPandas()
    assert calm.loc[400, "hour"] in set(scored["hour"])
