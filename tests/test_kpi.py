import datetime as dt

import pytest

from growthlab.operators import kpi as K
from growthlab.operators import triangle as R
from growthlab.plans import marketing_report as MR


def pay(spark, rows):
    return spark.createDataFrame(rows, "day date, provider string, status int, amount double, threeds_type string")


def test_month_after_a_gap_has_no_change(spark):
    days = [dt.date(1995, m, 3) for m in (1, 2, 4, 5)]
    rows = [(d, "a", 1 if k % (i + 2) else 6, 10.0, "Y") for i, d in enumerate(days) for k in range(60)]
    got = {r["period"].month: r for r in K.period_change(pay(spark, rows), "month").collect()}
    assert got[1]["rate_change"] is None and got[4]["rate_change"] is None and got[4]["revenue_change_pct"] is None
    assert got[2]["rate_change"] == pytest.approx(got[2]["success_rate"] - got[1]["success_rate"])
    assert got[5]["rate_change"] == pytest.approx(got[5]["success_rate"] - got[4]["success_rate"])


def test_months_with_chargebacks_only(spark):
    payments = pay(spark, [(dt.date(1995, 1, 1), "a", 1, 10.0, "Y")] * 50).withColumnRenamed("day", "period")
    back = spark.createDataFrame(
        [(dt.date(1995, 1, 1), "a", 10.0), (dt.date(1995, 2, 1), "a", 7.0), (dt.date(1995, 2, 1), None, 3.0)],
        "period date, provider string, amount double",
    )
    got = {(r.provider, r.period.month): r for r in K.chargeback_ratio(payments, back, ["provider", "period"]).collect()}
    assert got["a", 1].chargeback_ratio == pytest.approx(2.0) and got["a", 1].alert == "concerning"
    for key in (("a", 2), (None, 2)):
        assert got[key].transactions == 0 and got[key].chargeback_ratio is None and got[key].alert == "critical"
        assert got[key].investigation == 1


def test_published_exposure_and_group_numbers(spark):
    """Cells of 50 users are open, of 51 shown; of 30 groups the 21 with most rows stay."""
    rows = [(k % 30, k) for k in range(30 * 31 // 2)] + [(g, 0) for g in range(30) for _ in range(g)]
    tri = spark.createDataFrame([(f"g{g:02}", 10.0) for g, _ in rows], "group string, total_users double")
    kept = sorted(r["group"] for r in R.frequent_groups(tri, 21).select("group").distinct().collect())
    assert kept == [f"g{g:02}" for g in range(9, 30)]


def test_funnel_equals_its_two_sides(spark):
    day = dt.date(1995, 6, 1)
    profile = spark.createDataFrame(
        [(u, day if u % 2 else day - dt.timedelta(days=1), day if u % 3 == 0 else None) for u in range(40)],
        "user_id long, signup_date date, first_purchase_date date",
    )
    touches = spark.createDataFrame(
        [(u, [None, "Google", "Meta"][u % 3], "cpc" if u % 5 else None, ["Web", "App", None][u % 3]) for u in range(35)],
        "user_id long, channel string, channel_type string, platform string",
    )
    days = spark.createDataFrame([(u, day, 1 + u % 4, 2.5 * u) for u in range(0, 40, 3)], "user_id long, purchase_date date, purchases long, amount double")
    costs = spark.createDataFrame([(day, "Google", "cpc", "App", 12.0)], "day date, channel string, channel_type string, platform string, cost double")
    spend = MR.daily_costs(costs, "1995-06-05")
    args = (touches, "1995-06-05")
    two = MR.combined_daily_summary(MR.signup_conversion(profile, *args), MR.day0_roas(profile, days, *args), spend)
    one = MR.with_costs(MR.funnel(profile, days, *args), spend)
    assert one.columns == two.columns and one.count() > 5
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
