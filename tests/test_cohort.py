import datetime as dt

import pytest
from pyspark.sql import functions as F

from growthlab.operators import cohort as H


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour, minutes=minute)


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (1, 10, at(0, 10), 100.0),
        (1, 11, at(0, 10), 5.0),
        (1, 12, at(0, 21, 59), 7.4),
        (1, 13, at(0, 22), 1.0),
        (1, 14, at(31, 5, 59), 2.0),
        (1, 15, at(31, 6), 900.0),
        (2, 20, at(3, 1), 40.0),
    ]
    return spark.createDataFrame(
        rows, "user_id long, transaction_id long, purchase_time timestamp, purchase_amount double"
    )


def test_first_purchase_cumsum(facts):
    out = H.first_purchase_cumsum(facts, "2023-12-01", "2024-01-06").orderBy(
        "user_id", "days_since_first_purchase"
    )
    got = [
        (r["user_id"], r["first_purchase_amt"], r["days_since_first_purchase"], r["daily_total"], r["cum_sum"])
        for r in out.collect()
    ]
    # 11h59 rounds to day 0, 12h to day 1 (half away), 739h to day 31, 740h is outside
    assert got == [
        (1, 100.0, 0, 112.0, 112.0),
        (1, 100.0, 1, 1.0, 113.0),
        (1, 100.0, 31, 2.0, 115.0),
        (2, 40.0, 0, 40.0, 40.0),
    ]


def test_user_running_sum(facts):
    got = {r["transaction_id"]: r["cumulative_amount"] for r in H.user_running_sum(facts).collect()}
    assert got[10] == 100.0 and got[11] == 105.0 and got[15] == pytest.approx(1015.4) and got[20] == 40.0


def test_densify_and_label(spark):
    df = spark.createDataFrame(
        [(1, 0, 500.0), (1, 3, 1500.0), (2, 1, 10.0), (3, 31, 5000.0)],
        "user_id int, days_since_first_purchase int, cum_sum double",
    )
    dense = H.densify(df, "user_id", "days_since_first_purchase", 50, ["cum_sum"])
    assert dense.count() == 153
    labels = {r["user_id"]: tuple(r)[1:] for r in H.label_first_exceed(dense).collect()}
    assert labels == {1: (3, 1500.0, 1), 2: (30, 10.0, 0), 3: (30, None, 0)}


@pytest.fixture(scope="module")
def signed(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        (1, 0, 40.0), (1, 5, 400.0), (1, 10, 1700.0), (1, 70, 2000.0),
        (2, 0, 60.0), (2, 20, 2100.0),
        (3, 30, 3500.0),
        (4, 1, 20.0),
    ]
    return spark.createDataFrame(
        [(u, day, day + dt.timedelta(days=d), d, a) for u, d, a in rows],
        "user_id int, signup_date date, purchase_date date, days_since_signup int, amount double",
    )


def test_tiers(signed):
    tier = {
        (r["user_id"], r["days_since_signup"]): r["tier"] for r in H.vip_tiers(signed).collect()
    }
    assert tier[(1, 0)] == "Irrelevant" and tier[(1, 10)] == "1" and tier[(1, 70)] == "3"
    assert tier[(2, 20)] == "2" and tier[(3, 30)] == "3" and tier[(4, 1)] == "Irrelevant"
    coded = {
        (r["user_id"], r["days_since_signup"]): r["b_vip_current"]
        for r in H.vip_tiers(signed, tier_b="coded").collect()
    }
    assert coded[(1, 0)] == 1 and coded[(3, 30)] == 1 and coded[(4, 1)] == 0


def test_share_exceed_compare(signed):
    flags = H.ever_reached(H.cumulative_days(signed))
    share = H.share_by_month(flags).collect()[0]
    assert share["pct_vip_1000"] == 0.75 and share["pct_vip_3000"] == 0.5 and share["pct_vip_8000"] == 0.0
    series = H.age_series(signed, 60)
    table = {
        r["threshold"]: (r["count_exceeding"], r["percentage_exceeding"])
        for r in H.exceedance(series.where("days_since_signup = 30")).collect()
    }
    assert table[100] == (3, 0.75) and table[3000] == (1, 0.25) and table[5000] == (0, 0.0)
    pairs = {r["user_id"]: (r["diff_30d_60d"], r["bins"]) for r in H.age_compare(series).collect()}
    assert pairs == {1: (0.0, "0-10"), 2: (0.0, "0-10"), 3: (0.0, "0-10")}


def test_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], "p int, y int")
    row = H.confusion(df, "p", "y").collect()[0]
    assert tuple(row)[:4] == (1, 1, 1, 2)
    assert row["accuracy"] == pytest.approx(0.6) and row["recall"] == 0.5


def test_kpi_window_includes_part_hour_before(spark):
    rows = [(1, at(0, h), at(0, 0), at(0, 10, 30), "App", "g", "u@Gmail.com", None, 2.0, 1) for h in (9, 10, 11)]
    schema = (
        "h_user_id int, hour timestamp, signup_date timestamp, first_purchase_date timestamp, signup_platform string,"
        "channel string, email string, first_geo_region string, m double, n int"
    )
    money = ["sc_total_bet_amount", "sc_total_win_amount", "cc_total_win_amount", "purchase_amount",
             "redeem_amount", "eod_sc_balance", "bonus_wheel", "bonus_plinko", "offer_purchases_amount",
             "bonus_amount", "daily_mission_reward", "leaderboard_reward"]
    counts = ["sc_total_bet_transactions", "redeem_transactions", "total_transactions", "purchase_sc_coin",
              "did_sc_spin", "did_cc_spin"]
    df = spark.createDataFrame(rows, schema)
    df = df.withColumns({c: F.col("m") for c in money} | {c: F.col("n") for c in counts})
    row = H.kpi_first_hours(df, "2023-01-01", "2025-01-01").collect()[0]
    # hour 9 is over an hour before the purchase, hour 10 only half an hour
    assert row["logins_first_96h"] == 2 and row["total_bet_amt"] == 4.0 and row["avg_spin_amt"] == 2.0
    assert row["sum_sc_coin_total"] == 2 and row["sum_spin_cc"] == 2 and row["sum_bonus_amt"] == 4.0
