"""Curated views: renamed and restricted columns of warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.operators.cleaning import require_columns

_UTM = ["utm_source", "utm_campaign", "utm_medium", "utm_content", "utm_term"]

# View -> (source table, kept columns, renamed columns).
SELECTED = {
    "marketing_user_billing": (
        "billing_detailed_data",
        ["date", "user_id", "cpa_cost", "cpa_plan", "channel_type", "channel", *_UTM, "click_id",
         "payment_method_threshold", "payment_method", "signup", "ftd", "qualify_billing"],
        {"channel": "channel_source"},
    ),
    "marketing_touches": (
        "fact_touches_segment",
        ["user_id", "transaction_timestamp", "client_first_session", "user_id_signup_session",
         "user_id_ftd_session", "purchase_ind", "first_purchase_date", "session_id", "page_url",
         "page_referrer", "referrer_domain", "landing_page", "platform", *_UTM, "utm_promo",
         "gclid", "fbclid", "ttclid", "click_id", "click_id_mapping", "channel_type", "channel",
         "touch_seq"],
        {"transaction_timestamp": "touch_timestamp", "channel": "channel_source"},
    ),
    "marketing_last_paid_before_su": (
        "full_attribution_last_paid_before_signup",
        ["user_id", "signup_date", "referrer_domain", *_UTM, "channel_type", "channel",
         "geo_region", "geo_country", "signup_platform", "geo_verified", "gclid", "fbclid",
         "ttclid", "click_id", "cpa_plan", "cpa_cost", "payment_method", "billing_date",
         "purchase_bucket_10"],
        {"channel": "channel_source", "purchase_bucket_10": "qualification_timestamp"},
    ),
    "marketing_costs": (
        "marketing_channels_cost",
        ["day", "channel_type", "channel", "country_code", "cost", "revshare_plan", "platform",
         *_UTM, "price_plan", "qualified_users"],
        {"channel": "channel_source"},
    ),
    "finance_daily_screenshot_metrics": (
        "daily_user_properties",
        ["inserted_time", "user_id", "cc_coin", "sc_coin", "bsc_coins", "usc_coins", "rsc_coins",
         "device_category", "device_operating_system", "geo_region", "geo_country", "city",
         "platform", "bonus_abuser_ind", "total_redeem_amount", "chb_score"],
        {"bsc_coins": "bsc_balance_sc_coins", "usc_coins": "usc_unredeemable_sc_coins",
         "rsc_coins": "rsc_redeemable_sc_coins"},
    ),
}

# View -> (source table, hidden columns).
HIDDEN = {
    "marketing_cohort_metrics_app": ("marketing_cohort_metrics_app", []),
    "marketing_cohort_metrics_web": ("marketing_cohort_metrics", []),
    "marketing_affiliate_performance": ("affiliate_preformance_by_billing_date", []),
    "finance_chargebacks": ("fact_chargebacks_transactions", []),
    "finance_token_redeem_grade": ("fact_payment_token", ["full_name", "payment_token_id"]),
    "finance_payment_transaction": ("fact_payment_transaction", ["email", "full_name"]),
    "finance_purchase_transaction": (
        "fact_purchase_transaction",
        ["purchase_transaction", "transaction_banking_id", "user_event_trigger_id"],
    ),
    "finance_redeem_data": ("fact_redeem", ["full_name", "email"]),
}


def selected_view(source: DataFrame, columns: list[str], renames: dict[str, str]) -> DataFrame:
    return require_columns(source, columns).select(*columns).withColumnsRenamed(renames)


def hidden_view(source: DataFrame, hidden: list[str]) -> DataFrame:
    return source.drop(*hidden)


def curated(name: str, source: DataFrame) -> DataFrame:
    """The named view over its source table."""
    if name in SELECTED:
        _, columns, renames = SELECTED[name]
        return selected_view(source, columns, renames)
    _, hidden = HIDDEN[name]
    view = hidden_view(source, hidden)
    if name == "marketing_cohort_metrics_web":
        view = view.where(F.lower("channel_type") != "app")
    return view


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create every view whose source table is given. The ROAS view is plans.cohort_roas."""
    made = []
    for name, (source, *_) in {**SELECTED, **HIDDEN}.items():
        if source in tables:
            curated(name, tables[source]).createOrReplaceTempView(name)
            made.append(name)
    return made
