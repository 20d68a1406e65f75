"""Potential-VIP pipeline: features, window-routed scores, new customers, experiment rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.operators import cleaning as C
from growthlab.operators import experiment as X
from growthlab.operators import joins as J
from growthlab.session import durable

# Column lists of the feature pipeline, in model order.
SUM_COLS = [
    "total_bet_amt", "total_win_amt_sc", "total_win_amt_cc", "sum_redeem_amt", "sum_amt_total",
    "cnt_txn_total", "sum_sc_coin_total", "sum_bonus_wheel", "sum_bonus_plinko", "sum_offer_amt",
    "sum_bonus_amt", "sum_daily_mission", "sum_leaderboard_reward", "sum_spin_sc", "sum_spin_cc",
    "logins", "total_bet_txn", "sum_bonus_promotion_bet_amount", "sum_redeem_txn",
]
EXTREME_COLS = [
    "max_purchase_amt_hourly", "max_redeem_amt_hourly", "max_eod_sc_balance",
    "max_daily_games_unique", "max_win_amt", "max_bet_amt", "min_bet_amount",
]
AVERAGE_COLS = ["avg_spin_amt", "rtp_ratio", "avg_rounds_bet", "avg_bet_amt", "ggr_amt"]
LOG_COLS = [
    "sum_amt_total", "total_bet_amt", "total_win_amt_sc", "total_win_amt_cc", "max_win_amt",
    "sum_redeem_amt", "max_redeem_amt_hourly", "sum_sc_coin_total", "max_eod_sc_balance",
    "sum_bonus_amt", "sum_offer_amt", "sum_bonus_promotion_bet_amount",
]
EMAIL_DOMAINS = [
    "other", "gmail.com", "yahoo.com", "privaterelay.appleid.com", "icloud.com", "hotmail.com",
]
CHANNELS = ["other", "app", "google", "invite friend", "facebook", "sidelines"]
PLATFORMS = ["web", "app"]
MODEL_FEATURES = [
    "avg_spin_amt", "rtp_ratio", "logins", "total_bet_txn", "max_purchase_amt_hourly",
    "sum_redeem_txn", "cnt_txn_total", "sum_spin_sc", "sum_spin_cc", "sum_bonus_wheel",
    "sum_bonus_plinko", "sum_daily_mission", "sum_leaderboard_reward", "first_purchase_amt",
    "max_bet_amt", "min_bet_amount", "avg_rounds_bet", "avg_bet_amt", "max_daily_games_unique",
    "avg_spin_amt_is_missing", "avg_rounds_bet_is_missing", "avg_bet_amt_is_missing",
    "ggr_amt_is_missing", "signup_email_domain_gmail.com", "signup_email_domain_yahoo.com",
    "signup_email_domain_privaterelay.appleid.com", "signup_email_domain_icloud.com",
    "signup_email_domain_hotmail.com", "channel_other", "channel_app", "channel_google",
    "channel_invite_friend", "channel_facebook", "channel_sidelines", "signup_platform_web",
    "signup_platform_app", "ln_sum_amt_total", "ln_total_win_amt_sc", "ln_total_win_amt_cc",
    "ln_sum_redeem_amt", "ln_max_eod_sc_balance", "ln_sum_bonus_amt", "ln_sum_offer_amt",
    "ln_sum_bonus_promotion_bet_amount", "ggr_amt_log",
]
# Vocabularies and logged columns of the first version.
V1_VOCABULARY = {
    "signup_email_domain": ["gmail.com", "yahoo.com", "privaterelay.appleid.com", "icloud.com"],
    "channel": ["google", "app", "facebook", "invite friend", "sidelines"],
    "first_geo_region": ["california", "texas", "florida", "illinois", "georgia"],
    "signup_platform": ["web", "app"],
}
V1_LOG_COLS = [
    "total_bet_amt", "total_win_amt_sc", "total_win_amt_cc", "sum_redeem_amt", "sum_amt_total",
    "sum_sc_coin_total",
]
PURCHASE_OVERRIDE = 1500
EXPERIMENT_ID = 1090
OUTPUT = [
    "user_id", "firebase_user_id", "signup_date", "first_purchase_date", "window_class",
    "total_purchase_amt", "split_metric", "total_redeem_amt", "email", "full_name",
    "probability_positive_class", "potential_vip_ind", "vip_mentioned",
]


def prepare(df: DataFrame, cut_dates: bool = True, other: str = "residual") -> DataFrame:
    """Raw window rows -> model features with the ids kept.

    Rows with any NULL left after the fills go before the 0/1 columns are added."""
    out = C.lower_text(df, keep=("firebase_user_id",))
    out = out.fillna("other", ["channel", "signup_email_domain", "email"])
    if cut_dates:
        out = out.withColumns({c: F.to_date(c) for c in ("signup_date", "first_purchase_date")})
    out = out.fillna(0, SUM_COLS + EXTREME_COLS)
    out = C.log_features(C.missing_flags(out, AVERAGE_COLS), LOG_COLS)
    out = (
        out.withColumn("window_number", F.col("window_number").cast("int"))
        .withColumn("ggr_amt_log", S.signed_log(F.col("ggr_amt")))
        .dropna()
    )
    out = C.fixed_dummies(out, "signup_email_domain", EMAIL_DOMAINS, other)
    out = C.fixed_dummies(out, "channel", CHANNELS, other)
    out = C.fixed_dummies(out, "signup_platform", PLATFORMS, other)
    return C.normalise_names(C.window_dummies(out, keep=True))


def prepare_v1(df: DataFrame) -> DataFrame:
    """First version: short labels from fixed vocabularies, logs, hours from signup to the first
    purchase under the feature's published name, zero for everything missing."""
    out = C.lower_text(df)
    for col, vocabulary in V1_VOCABULARY.items():
        out = C.topk_dummies(out, col, vocabulary)
    out = C.log_features(out, V1_LOG_COLS).withColumn(
        "time_diff_minutes",
        S.hours_to_first_purchase(F.col("signup_date"), F.col("first_purchase_date")),
    )
    return out.fillna(0)


def mark_v1(
    scored: DataFrame, seed: object, threshold: float = 0.9, prob: str = "probability_positive_class"
) -> DataFrame:
    """potential_vip_ind for a random exact half of the users at or above the threshold."""
    return X.random_half(scored, "user_id", F.col(prob) >= threshold, seed, "potential_vip_ind")


def new_customers(
    scored: DataFrame,
    amounts: DataFrame,
    existing: DataFrame,
    values: DataFrame,
    seed: object,
    override: float = PURCHASE_OVERRIDE,
) -> DataFrame:
    """Flagged users not yet known, with their value split into two halves per band."""
    joined = scored.join(
        amounts.select(
            "user_id", "sum_amt_total", "sum_redeem_amt", "total_purchase_amount", "cnt_txn_total"
        ),
        "user_id",
    )
    flagged = joined.withColumn(
        "potential_vip_ind",
        F.when(F.col("total_purchase_amount") >= override, 1).otherwise(
            F.col("potential_vip_ind")
        ),
    ).where(F.col("potential_vip_ind") == 1)
    fresh = J.drop_ids(flagged, existing, "user_id")
    valued = fresh.join(values.select("user_id", "enp"), "user_id", "left").withColumnsRenamed(
        {
            "sum_amt_total": "total_purchase_amt",
            "sum_redeem_amt": "total_redeem_amt",
            "window": "window_class",
            "total_purchase_amount": "total_purchase_amt_orig",
            "enp": "split_metric",
        }
    )
    # only newly flagged users are left; the rank reads them twice
    return X.half_per_band(durable(valued), "user_id", "split_metric", seed, "vip_mentioned")


def output_rows(df: DataFrame, as_of: str, version: str = "v2", shadow: bool = False) -> DataFrame:
    """Published columns with rounding (half to even) and the run stamp."""
    shaped = df.select(*[c for c in OUTPUT if c in df.columns]).withColumns(
        {
            "total_purchase_amt": S.half_even(F.coalesce("total_purchase_amt", F.lit(1.0))).cast("int"),
            "total_redeem_amt": S.half_even(F.coalesce("total_redeem_amt", F.lit(0.0))).cast("int"),
            "probability_positive_class": S.half_even(F.col("probability_positive_class"), 3),
            "split_metric": S.half_even(F.coalesce("split_metric", F.lit(0.0)), 2),
        }
    )
    return C.stamp(shaped, as_of, version=version, shadow_mode=shadow)


def same_day_rows(df: DataFrame, history: DataFrame, counter: str = "con_current", first: int = 1) -> DataFrame:
    """Same-day variant: first window only, purchase on the signup day, numbered run."""
    kept = C.same_day(df.where(F.col("window_class").isin(0)), "signup_date", "first_purchase_date")
    return kept.withColumn(counter, X.next_run(history, counter, first))


def experiment_rows(
    published: DataFrame, as_of: str, days: int = 5, experiment_id: int = EXPERIMENT_ID
) -> DataFrame:
    """Experiment membership of the mentioned users updated `days` days ago."""
    wanted = F.date_sub(F.lit(as_of).cast("date"), days)
    return published.where(
        (F.to_date("updated_at") == wanted) & (F.col("vip_mentioned") == 1)
    ).select(
        F.lit(experiment_id).alias("experiment_id"),
        "user_id",
        F.lit("B").alias("experiment_group"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    )
