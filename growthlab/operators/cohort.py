"""User-level cohort operators: first purchase, bounded windows, calendars, labels, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.functions import sums as A
from growthlab.operators import joins as J
from growthlab.operators import ordered as O

# Published levels, days and bands.
VIP_LEVELS = [1000, 3000, 5000, 8000]
EXCEED_LEVELS = [100, 200, 500, 1000, 1500, 2000, 3000, 4000, 5000]
REVENUE_DAYS = [0, 3, 7, 10, 14, 21, 28, 35, 42, 49, 56, 63, 70, 77, 84, 91, 98]


# ---------------------------------------------------------------- first purchase


def first_purchase(facts: DataFrame) -> DataFrame:
    """First purchase per user; ties by transaction. min_by keeps map-side partial results."""
    key = F.struct("purchase_time", "transaction_id")
    return (
        facts.where(F.col("purchase_time").isNotNull())
        .groupBy("user_id")
        .agg(
            F.min("purchase_time").alias("first_purchase_time"),
            F.min_by("purchase_amount", key).alias("first_purchase_amt"),
        )
    )


def first_purchase_cumsum(
    facts: DataFrame,
    start: str,
    end: str,
    max_hours: int = 740,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Daily totals since the first purchase and their running sum, for users whose first
    purchase lies strictly between start and end.

    Facts are reduced to one row per (user, instant) first. The running window sees at most
    max_hours / 24 + 1 rows per user.
    """
    first = first_purchase(facts).where(
        (F.col("first_purchase_time") > F.lit(start).cast("timestamp"))
        & (F.col("first_purchase_time") < F.lit(end).cast("timestamp"))
    )
    instants = facts.groupBy("user_id", *carry, "purchase_time").agg(
        F.sum("purchase_amount").alias("_amount")
    )
    elapsed = S.whole_hours(F.col("first_purchase_time"), F.col("purchase_time"))
    daily = (
        instants.join(first, "user_id")
        .where(elapsed < max_hours)
        .groupBy(
            "user_id",
            *carry,
            "first_purchase_time",
            "first_purchase_amt",
            # the warehouse cast rounds to the nearest day
            F.round(elapsed / 24).cast("bigint").alias("days_since_first_purchase"),
        )
        .agg(S.half_up(F.sum("_amount")).alias("daily_total"))
    )
    by_day = W.partitionBy("user_id").orderBy("days_since_first_purchase")
    return daily.withColumn("cum_sum", F.round(F.sum("daily_total").over(by_day)))


def user_running_sum(facts: DataFrame) -> DataFrame:
    """Row-level cumulative amount per user by purchase time, safe for very busy users."""
    return O.running_sum(
        facts, ["user_id"], ["purchase_time", "transaction_id"], "purchase_amount",
        "cumulative_amount",
    )


# ---------------------------------------------------------------- bounded behaviour windows


def kpi_first_hours(kpi: DataFrame, start: str, end: str, hours: int = 96) -> DataFrame:
    """Behaviour aggregates over the first hours after the first purchase."""
    # the roll-up holds one row per user and hour, so a user's window is bounded by the calendar
    user = W.partitionBy("h_user_id")
    anchored = kpi.where(F.col("first_purchase_date").isNotNull()).withColumns(
        {
            "a_signup_date": F.max("signup_date").over(user),
            "a_first_purchase": F.max("first_purchase_date").over(user),
        }
    )
    bet, win = F.sum("sc_total_bet_amount"), F.sum("sc_total_win_amount")
    return (
        anchored.where(
            (F.col("a_first_purchase") > F.lit(start).cast("timestamp"))
            & (F.col("a_first_purchase") < F.lit(end).cast("timestamp"))
            & J.in_window(F.col("hour"), F.col("a_first_purchase"), hours)
        )
        .groupBy(
            F.col("h_user_id").alias("user_id"),
            F.col("a_signup_date").alias("signup_date"),
            F.col("a_first_purchase").alias("first_purchase_date"),
            "signup_platform",
            "first_geo_region",
        )
        .agg(
            S.half_up(bet).alias("total_bet_amt"),
            S.half_up(win).alias("total_win_amt_sc"),
            S.half_up(F.sum("cc_total_win_amount")).alias("total_win_amt_cc"),
            S.half_up(
                A.ratio(F.col("sc_total_bet_amount"), F.col("sc_total_bet_transactions")), 3
            ).alias("avg_spin_amt"),
            S.half_up(
                A.ratio(F.col("sc_total_win_amount"), F.col("sc_total_bet_amount")), 3
            ).alias("rtp_ratio"),
            S.half_up(win - bet).alias("ggr_amt"),
            F.min("channel").alias("channel"),
            F.min(S.email_domain(F.col("email"))).alias("signup_email_domain"),
            F.count("h_user_id").alias("logins_first_96h"),
            F.sum("sc_total_bet_transactions").alias("total_bet_txn"),
            F.max("purchase_amount").alias("max_purchase_amt_horly"),
            F.max("redeem_amount").alias("max_redeem_amt_hourly"),
            F.sum("redeem_amount").alias("sum_redeem_amt"),
            F.sum("redeem_transactions").alias("sum_redeem_txn"),
            F.sum("purchase_amount").alias("sum_amt_total"),
            F.sum("total_transactions").alias("cnt_txn_total"),
            F.sum("purchase_sc_coin").alias("sum_sc_coin_total"),
            F.sum("did_sc_spin").alias("sum_spin_sc"),
            F.sum("did_cc_spin").alias("sum_spin_cc"),
            F.max("eod_sc_balance").alias("max_eod_sc_balance"),
            F.sum("bonus_wheel").alias("sum_bonus_wheel"),
            F.sum("bonus_plinko").alias("sum_bonus_plinko"),
            F.sum("offer_purchases_amount").alias("sum_offer_amt"),
            S.half_up(F.sum("bonus_amount")).alias("sum_bonus_amt"),
            F.sum("daily_mission_reward").alias("sum_daily_mission"),
            F.sum("leaderboard_reward").alias("sum_leaderboard_reward"),
        )
    )


def bets_first_days(
    bets: DataFrame, kpi: DataFrame, floor_day: str, hours: int = 96, days: int = 4
) -> DataFrame:
    """Bet behaviour in the days around the first purchase."""
    start = F.col("first_purchase_date")
    active = (
        kpi.where(
            (F.col("hour") >= start)
            & (F.col("hour") < start + F.make_dt_interval(hours=F.lit(hours)))
        )
        .groupBy(F.col("h_user_id").alias("user_id"))
        .agg(
            F.max("first_bet_date").alias("first_bet_date"),
            F.max("first_purchase_date").alias("first_purchase_date"),
            F.count_distinct(F.to_date("hour")).alias("days_of_activity"),
        )
    )
    return (
        bets.where(F.col("day") >= F.lit(floor_day).cast("date"))
        .join(active, "user_id")
        .where(
            (F.col("day") >= F.to_date("first_purchase_date"))
            & (F.to_date("first_purchase_date") >= F.date_sub("day", days))
        )
        .groupBy("user_id")
        .agg(
            F.max("days_of_activity").alias("days_of_activity"),
            F.max("first_purchase_date").alias("first_purchase_date"),
            F.max("max_bet_amount").alias("max_bet_amt"),
            F.min("min_bet_amount").alias("min_bet_amount"),
            F.max("max_win_amount").alias("max_win_amt"),
            F.avg("rounds_bet").alias("avg_rounds_bet"),
            F.avg("bet_amount").alias("avg_bet_amt"),
            F.max("unique_games_day").alias("max_daily_games_unique"),
            F.sum("bonus_promotion_win_amount").alias("sum_bonus_promotion_bet_amount"),
        )
    )


# ---------------------------------------------------------------- calendars


def densify(
    df: DataFrame, key: str, day: str, last_day: int, carry: list[str], fill: dict | None = None
) -> DataFrame:
    """Every key on every day 0..last_day, carrying the last seen values forward.

    The input holds at most one row per key and day (day >= 0). Each row fills the days up to the
    key's next row and the first row also the empty days before it, so no grid is joined."""
    order = W.partitionBy(key).orderBy(day)
    seen = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    end = last_day + 1
    spans = df.select(
        key,
        day,
        *[F.last(c, ignorenulls=True).over(seen).alias(c) for c in carry],
        F.least(F.coalesce(F.lead(day).over(order), F.lit(end)), F.lit(end)).alias("_next"),
        F.row_number().over(order).alias("_rn"),
    )
    none = "cast(array() AS array<int>)"
    own = f"IF({day} < _next, sequence(cast({day} AS int), cast(_next AS int) - 1), {none})"
    lead_in = f"IF(_rn = 1 AND {day} > 0, sequence(0, cast(least({day}, {end}) AS int) - 1), {none})"
    cells = F.expr(
        f"explode(concat(transform({lead_in}, d -> struct(d AS d, false AS seen)),"
        f" transform({own}, d -> struct(d AS d, true AS seen))))"
    )
    dense = spans.withColumn("_cell", cells).select(
        key,
        F.col("_cell.d").alias(day),
        *[F.when(F.col("_cell.seen"), F.col(c)).alias(c) for c in carry],
    )
    return dense.fillna(fill) if fill else dense


def cumulative_days(signed_days: DataFrame) -> DataFrame:
    """Cumulative amount at each active day after signup, one row per (user, day offset).

    The window runs over the daily roll-up: its length is bounded by calendar days."""
    by_day = W.partitionBy("user_id").orderBy("purchase_date")
    return signed_days.select(
        "user_id",
        "signup_date",
        "purchase_date",
        "days_since_signup",
        "amount",
        F.sum("amount").over(by_day).alias("cumulative_amount"),
    )


def age_series(signed_days: DataFrame, last_day: int = 60) -> DataFrame:
    """Cumulative amount on each of days 0..last_day after signup (0 before the first purchase)."""
    daily = (
        cumulative_days(signed_days)
        .where(F.col("days_since_signup").between(0, last_day))
        .select("user_id", "days_since_signup", "cumulative_amount")
    )
    return densify(
        daily, "user_id", "days_since_signup", last_day, ["cumulative_amount"],
        {"cumulative_amount": 0.0},
    )


# ---------------------------------------------------------------- labels


def label_first_exceed(series: DataFrame, level: float = 1000.0, last_day: int = 30) -> DataFrame:
    """First day the cumulative sum exceeds the level, else the last day, with the flag."""
    day, cum = F.col("days_since_first_purchase"), F.col("cum_sum")
    over = cum > F.lit(level)
    picked = (
        series.where(day <= last_day)
        .groupBy("user_id")
        .agg(
            F.min(F.when(over, day)).alias("_hit"),
            F.min_by(cum, F.when(over, day)).alias("_hit_cum"),
            F.max(day).alias("_last"),
            F.max_by(cum, F.when(cum.isNotNull(), day)).alias("_last_cum"),
        )
    )
    return picked.select(
        "user_id",
        F.coalesce("_hit", "_last").alias("days_since_first_purchase"),
        F.when(F.col("_hit").isNotNull(), F.col("_hit_cum"))
        .otherwise(F.col("_last_cum"))
        .alias("cum_sum"),
        F.col("_hit").isNotNull().cast("int").alias("flag"),
    )


def ever_reached(cumulative: DataFrame, levels: list[int] = VIP_LEVELS) -> DataFrame:
    """One row per user: whether the cumulative amount ever reached each level."""
    top = F.max("cumulative_amount")
    return cumulative.groupBy("user_id").agg(
        F.min("signup_date").alias("signup_date"),
        *[(top >= lv).cast("int").alias(f"vip_{lv}") for lv in levels],
    )


def share_by_month(flags: DataFrame, levels: list[int] = VIP_LEVELS) -> DataFrame:
    """Share of each signup month's users reaching each level: one aggregate in place of a chain
    of outer joins."""
    return flags.groupBy(F.date_format("signup_date", "yyyy-MM").alias("signup_month")).agg(
        *[F.avg(f"vip_{lv}").alias(f"pct_vip_{lv}") for lv in levels]
    )


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


def vip_tiers(
    signed_days: DataFrame, tier_b: str = "stated", legacy_cumulative: bool = False
) -> DataFrame:
    """Tier flags per active day (the day-end total, which decides each user) and the stated label.

    First-day and first-week spend sum the purchases of those days (legacy_cumulative sums the
    running totals instead). tier_b='coded' joins its two clauses with OR."""
    rows = cumulative_days(signed_days)
    user = W.partitionBy("user_id")
    age = F.col("days_since_signup")
    spend = F.col("cumulative_amount") if legacy_cumulative else F.col("amount")
    rows = rows.withColumn(
        "first_day_purchase", F.sum(F.when(age == 0, spend)).over(user)
    ).withColumn("first_week_purchase", F.sum(F.when(age.between(0, 7), spend)).over(user))
    early = F.coalesce(
        (F.col("first_week_purchase") > 300) | (F.col("first_day_purchase") >= 50), F.lit(False)
    )
    big = F.col("cumulative_amount") >= 2000
    a = (age <= 14) & big & early
    b = ((age <= 60) & big) | early if tier_b == "coded" else (age <= 60) & big & early
    c_flag = F.col("cumulative_amount") > 3000
    c = F.col("cumulative_amount") >= 3000
    return rows.withColumns(
        {
            "a_vip_current": a.cast("int"),
            "b_vip_current": b.cast("int"),
            "c_vip_current": c_flag.cast("int"),
            "tier": F.when(a, "1").when(b, "2").when(c, "3").otherwise("Irrelevant"),
        }
    )


def exceedance(series_at_day: DataFrame, levels: list[int] = EXCEED_LEVELS) -> DataFrame:
    """Per level: users above it, their share of users and of the amount. One pass."""
    amt = F.col("cumulative_amount")
    wide = series_at_day.agg(
        F.count_distinct("user_id").alias("_users"),
        F.sum(amt).alias("_total"),
        *[F.count_if(amt > lv).alias(f"_n{lv}") for lv in levels],
        *[A.sum_where(amt > lv, amt).alias(f"_s{lv}") for lv in levels],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(lv).alias("threshold"),
                F.col(f"_n{lv}").alias("count_exceeding"),
                F.col(f"_s{lv}").alias("_sum"),
            )
            for lv in levels
        ]
    )
    return wide.select("_users", "_total", F.inline(rows)).select(
        "threshold",
        "count_exceeding",
        F.col("_users").alias("total_users"),
        F.coalesce(S.safe_div(F.col("count_exceeding"), F.col("_users")), F.lit(0.0)).alias(
            "percentage_exceeding"
        ),
        F.coalesce(S.safe_div(F.col("_sum"), F.col("_total")), F.lit(0.0)).alias(
            "percentage_cumulative_sum"
        ),
    )


# Edges and labels of the published gain bins.
GAIN_EDGES = [0, 10, 200, 400, 500, 1000, 1500, float("inf")]
GAIN_LABELS = ["0-10", "11-200", "201-400", "401-500", "501-1000", "1001-1500", "1500+"]


def age_compare(series: DataFrame, early: int = 30, late: int = 60, level: float = 1000) -> DataFrame:
    """Amounts at two ages for users at or above the level by the earlier one, gain binned."""
    day, amt = F.col("days_since_signup"), F.col("cumulative_amount")
    pair = series.groupBy("user_id").agg(
        F.max(F.when(day == early, amt)).alias(f"amount_after_{early}d"),
        F.max(F.when(day == late, amt)).alias(f"amount_after_{late}d"),
    )
    gain = F.col(f"amount_after_{late}d") - F.col(f"amount_after_{early}d")
    return (
        pair.where(F.col(f"amount_after_{early}d") >= level)
        .withColumn(f"diff_{early}d_{late}d", gain)
        .withColumn("bins", S.band(gain, GAIN_EDGES, GAIN_LABELS))
    )


def confusion(flags: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Counts of the four outcomes with accuracy and recall, one row."""
    p, y = F.col(predicted) == 1, F.col(actual) == 1
    out = flags.agg(
        F.count_if(p & y).alias("true_positives"),
        F.count_if(p & ~y).alias("false_positives"),
        F.count_if(~p & y).alias("false_negatives"),
        F.count_if(~p & ~y).alias("true_negatives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    return out.withColumn("accuracy", S.safe_div(tp + tn, tp + fp + fn + tn)).withColumn(
        "recall", S.safe_div(tp, tp + fn)
    )


# ---------------------------------------------------------------- revenue by day offset


def revenue_on_days(signed_days: DataFrame, days: list[int] = REVENUE_DAYS) -> DataFrame:
    """Revenue on exact day offsets per user (not cumulative)."""
    off = F.col("days_since_signup")
    return (
        signed_days.where(off.between(0, days[-1]))
        .groupBy("user_id", "signup_date")
        .agg(*[A.sum_where(off == d, F.col("amount")).alias(f"revenue_d{d}") for d in days])
    )


