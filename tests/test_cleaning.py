import datetime as dt

import pytest
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.functions import sums as A
from growthlab.functions.channels import CORE_CHANNELS, WIDE_CHANNELS, channel_group
from growthlab.operators import cleaning as C


def values(df, col):
    return [r[col] for r in df.collect()]


def test_channel_group(spark):
    cases = {
        "google_paid search": "google_paid_search",
        "facebook_app": "facebook_app",
        "My Affiliate deal": "affiliates",
        "SOCIAL TRAFFIC_x": "affiliates",
        "a content creator": "affiliates",
        "Invite Friend": "invite_friend",
        "new_tiktok_app_2": "tiktok_app",
        "x unityads_int_app": "other",
        "organic": "other",
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r["c"]: r["g"] for r in df.withColumn("g", channel_group(F.col("c"), CORE_CHANNELS)).collect()}
    assert got == cases
    wide = df.withColumn("g", channel_group(F.col("c"), WIDE_CHANNELS)).where("c like '%unity%'")
    assert values(wide, "g") == ["unityads_int_app"]


def test_rounding_and_division(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    assert values(df.select(S.half_even(F.col("x")).alias("r")), "r") == [2.0, 4.0, -2.0]
    assert values(df.select(S.half_up(F.col("x")).alias("r")), "r") == [3.0, 4.0, -3.0]
    noisy = spark.createDataFrame([(67.99249999999999,)], "x double")
    assert values(noisy.select(S.half_up(F.col("x"), 3).alias("r")), "r") == [67.993]
    assert values(df.select(S.safe_div(F.col("x"), F.lit(0)).alias("r")), "r") == [None] * 3


def test_text_scalars(spark):
    df = spark.createDataFrame([("a@b.com",), ("plain",)], "e string")
    assert values(df.select(S.email_domain(F.col("e")).alias("d")), "d") == ["b.com", "plain"]
    rows = [("App", "g", None), ("Web", None, "x"), (None, "g", "t")]
    t = spark.createDataFrame(rows, "p string, c string, k string")
    labels = t.select(S.channel_label(F.col("p"), F.col("c"), F.col("k")).alias("l"))
    assert values(labels, "l") == ["g", "unknown-x", "g-t"]
    keys = t.select(S.spend_key(F.col("p"), F.col("c"), F.col("k")).alias("l"))
    assert values(keys, "l") == ["g_app", None, "g_t"]


def test_time_scalars(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 59, 59))], "a timestamp, b timestamp"
    )
    row = df.select(
        S.whole_hours(F.col("a"), F.col("b")).alias("h"),
        S.whole_hours(F.col("b"), F.col("a")).alias("back"),
        S.hour_of_week(F.col("a")).alias("w"),
        S.hour_of_week(F.expr("timestamp'2024-01-07 23:00:00'")).alias("s"),
    ).collect()[0]
    assert row.asDict() == {"h": 0, "back": 0, "w": 0, "s": 167}


def test_finite_or(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    assert values(df.select(S.finite_or(F.col("x"), 1.0).alias("y")), "y") == [1.0, 1.0, 1.0, 1.0, 2.0]


def test_sum_variants(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0)], "k string, x double"
    )
    one = df.groupBy("k").agg(
        A.sum_zero(F.col("x")).alias("z"), A.sum_null(F.col("x")).alias("n"), A.sum_strict(F.col("x")).alias("s")
    )
    got = {r["k"]: (r["z"], r["n"], r["s"]) for r in one.collect()}
    assert got == {"a": (1.0, 1.0, None), "b": (0.0, None, None), "c": (5.0, 5.0, 5.0)}
    for how, pos in (("zero", 0), ("null", 1), ("strict", 2)):
        many = {r["k"]: r["x"] for r in df.groupBy("k").agg(*A.sums(["x"], how)).collect()}
        assert many == {k: v[pos] for k, v in got.items()}


def test_dummies(spark):
    df = spark.createDataFrame([("Gmail.com",), ("other",), ("x.org",), (None,)], "d string")
    out = C.fixed_dummies(df, "d", ["other", "gmail.com"])
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 0), (0, 1), (0, 1), (0, 1)]
    legacy = C.fixed_dummies(df, "d", ["other", "gmail.com"], "legacy_zero")
    assert values(legacy, "d_other") == [0, 0, 0, 0]
    top = C.top_values(df.union(df.where("d = 'x.org'")), "d", 1)
    assert top == ["x.org"]
    wide = C.topk_dummies(df, "d", top)
    assert set(wide.columns) == {"d_x", "d_other"}
    assert values(wide, "d_x") == [0, 0, 1, 0]


def test_limit_hours(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [
        (1, base, base + dt.timedelta(hours=24), None),
        (2, base, base + dt.timedelta(hours=30), base + dt.timedelta(hours=40)),
        (3, base, None, None),
    ]
    df = spark.createDataFrame(rows, "u int, s timestamp, a timestamp, b timestamp")
    out = C.limit_hours(df, "s", ["a", "b"], [24, 48])
    assert sorted((r["u"], r["limit_h"]) for r in out.collect()) == [(1, 24), (1, 48), (2, 48)]
    frames = C.limit_frames(df, "s", ["a", "b"], [24, 48])
    assert {k: f.count() for k, f in frames.items()} == {"24h": 1, "48h": 2}


def test_guards_and_names(spark):
    df = spark.createDataFrame([(1, "X")], "`A b` int, c string")
    out = C.normalise_names(df)
    assert out.columns == ["a_b", "c"]
    with pytest.raises(ValueError, match="zz"):
        C.require_columns(out, ["zz"])
    assert C.add_missing(out, ["zz"]).columns == ["a_b", "c", "zz"]
    assert C.place_column(C.add_missing(out, ["zz"]), "zz", 1).columns == ["a_b", "zz", "c"]
    assert values(C.lower_text(out), "c") == ["x"]
    assert C.rename_like(out, "a_", "q_").columns == ["q_b", "c"]


def test_completed_weeks_and_audit(spark):
    days = [dt.date(2024, 5, 27), dt.date(2024, 6, 3), dt.date(2024, 6, 10)]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "su_week date")
    # run on Thursday 2024-06-20: Monday 17th minus 14 days
    assert values(C.completed_weeks(df, "2024-06-20"), "su_week") == days[:2]
    audit = C.null_audit(df, ["su_week"]).collect()[0]
    assert (audit["rows"], audit["nulls"], audit["has_nulls"]) == (4, 1, 1)


def test_logs_and_missing(spark):
    df = spark.createDataFrame([(0.0, None), (-1.0, 2.0)], "x double, y double")
    logged = C.log_features(df.select("x"), ["x"])
    got = values(logged, "ln_x")
    assert got[0] == pytest.approx(-23.02585) and got[1] is None
    flags = C.missing_flags(df, ["y"]).collect()
    assert [(r["y"], r["y_is_missing"]) for r in flags] == [(0.0, 1), (2.0, 0)]
    assert values(C.fill_with_max(df, "y"), "y") == [2.0, 2.0]
