"""Source views over the shared test tables.

Calendar time of the order tables is compressed ten to one so that signup cohorts are dense.
Raw facts keep one row per event; the *_days / *_hours roll-ups are what user-level operators
join on, so a very busy user is reduced by map-side aggregation before any shuffle by user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthlab.functions import scalars as S
from growthlab.operators import joins as J

EPOCH = "1995-01-01"
SIGNUP_LIMIT = "1995-06-20"
AS_OF = "1995-06-05"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A shared table; its schema is read from the footer once per path."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def compressed_day(ts: Column) -> Column:
    epoch = F.lit(EPOCH).cast("date")
    return F.date_add(epoch, F.floor(F.datediff(ts.cast("date"), epoch) / F.lit(10)).cast("int"))


def _order_time() -> Column:
    minutes = (F.col("o_orderkey") % 24) * 60 + F.col("o_orderkey") % 60
    return compressed_day(F.col("o_orderdate")).cast("timestamp") + F.make_dt_interval(
        mins=minutes.cast("int")
    )


# ---------------------------------------------------------------- users and purchases


def fact_purchase(spark: SparkSession, folder: str) -> DataFrame:
    """One row per settled order."""
    return (
        table(spark, folder, "orders")
        .where(F.col("o_orderstatus").isin("F", "P"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderkey").alias("transaction_id"),
            _order_time().alias("purchase_time"),
            (F.col("o_totalprice") / 1000).alias("purchase_amount"),
        )
    )


def purchase_days(spark: SparkSession, folder: str) -> DataFrame:
    """(user, day) roll-up: at most one row per user and calendar day."""
    return (
        fact_purchase(spark, folder)
        .groupBy("user_id", F.to_date("purchase_time").alias("purchase_date"))
        .agg(
            F.sum("purchase_amount").alias("amount"),
            F.count(F.lit(1)).alias("purchases"),
            F.min("purchase_time").alias("first_time"),
        )
    )


def user_days(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with a signup day and the ordered purchase days.

    The day list comes from the (user, day) roll-up, so its length is bounded by the calendar."""
    days = (
        purchase_days(spark, folder)
        .groupBy("user_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("purchase_date", "amount", "purchases", "first_time"))
            ).alias("days")
        )
    )
    limit = F.lit(SIGNUP_LIMIT).cast("date")
    last_early = F.array_max(
        F.transform(
            F.filter("days", lambda d: d["purchase_date"] < limit), lambda d: d["purchase_date"]
        )
    )
    spread = F.date_add(
        F.lit(EPOCH).cast("date"), ((F.col("user_id") * 11) % 168).cast("int")
    )
    return (
        table(spark, folder, "customer")
        .withColumnRenamed("c_custkey", "user_id")
        .join(days, "user_id", "left")
        .withColumn(
            "signup_date", F.coalesce(F.when(F.col("user_id") % 3 == 0, last_early), spread)
        )
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a signup day."""
    return user_days(spark, folder).drop("days")


def user_profile(spark: SparkSession, folder: str) -> DataFrame:
    """user_id, signup_date, first_purchase_date (first one on or after signup), enp."""
    later = F.filter("days", lambda d: d["purchase_date"] >= F.col("signup_date"))
    return user_days(spark, folder).select(
        "user_id",
        "signup_date",
        F.array_min(F.transform(later, lambda d: d["first_time"])).alias("first_purchase_date"),
        (F.col("c_acctbal") / 50).alias("enp"),
    )


def signed_purchase_days(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase days with the user's signup day and the day offset from it."""
    return (
        user_days(spark, folder)
        .select("user_id", "signup_date", F.inline("days"))
        .withColumn("days_since_signup", F.datediff("purchase_date", "signup_date"))
    )


def _segment_channel(segment: Column, key: Column) -> Column:
    return (
        F.when(segment == "AUTOMOBILE", F.lit("Google"))
        .when(segment == "BUILDING", F.lit("Facebook"))
        .when(segment == "FURNITURE", F.lit("TikTok"))
        .when(segment == "MACHINERY", F.lit("organic"))
        .when(key % 10 != 0, F.lit("Affiliate Net"))
    )


def attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Last paid touch before signup, one row per user; channel and type may be NULL."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    channel = _segment_channel(F.col("c_mktsegment"), key)
    return table(spark, folder, "customer").select(
        key.alias("user_id"),
        channel.alias("channel"),
        F.when(nation % 3 == 0, F.lit("Paid Search"))
        .when(nation % 3 == 1, F.lit("Paid Social"))
        .when(key % 7 != 0, F.lit("Content"))
        .alias("channel_type"),
        F.when(key % 2 == 0, F.lit("App")).when(key % 11 != 0, F.lit("Web")).alias("platform"),
        F.when(channel == "organic", F.lit("organic")).otherwise(F.lit("Paid")).alias(
            "traffic_type"
        ),
        (F.col("c_acctbal") / 100).alias("cpa_cost"),
    )


def channel_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Daily marketing spend lines."""
    by_supplier = F.col("l_suppkey") % 5
    by_part = F.col("l_partkey") % 3
    return table(spark, folder, "lineitem").select(
        compressed_day(F.col("l_shipdate")).alias("day"),
        F.when(by_supplier == 0, F.lit("Google"))
        .when(by_supplier == 1, F.lit("Facebook"))
        .when(by_supplier == 2, F.lit("TikTok"))
        .when(by_supplier == 3, F.lit("Affiliate Net"))
        .alias("channel"),
        F.when(by_part == 0, F.lit("Paid Search"))
        .when(by_part == 1, F.lit("Paid Social"))
        .otherwise(F.lit("Content"))
        .alias("channel_type"),
        F.when(F.col("l_orderkey") % 2 == 0, F.lit("App")).otherwise(F.lit("Web")).alias(
            "platform"
        ),
        (F.col("l_extendedprice") / 10000).alias("cost"),
    )


# ---------------------------------------------------------------- behaviour


def event_hours(spark: SparkSession, folder: str) -> DataFrame:
    """(user, hour) roll-up of behaviour events."""
    kind, value = F.col("event_type"), F.col("value")

    def total(name: str, only: Column | None = None) -> Column:
        wanted = kind == name if only is None else (kind == name) & only
        return F.coalesce(F.sum(F.when(wanted, value)), F.lit(0.0))

    third = F.floor(value) % 3

    return (
        table(spark, folder, "events")
        .groupBy(
            F.col("user_id").alias("h_user_id"),
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        )
        .agg(
            total("click").alias("sc_total_bet_amount"),
            total("view").alias("sc_total_win_amount"),
            total("error").alias("cc_total_win_amount"),
            F.count_if(kind == "click").alias("sc_total_bet_transactions"),
            total("purchase").alias("purchase_amount"),
            total("signup").alias("redeem_amount"),
            F.count_if(kind == "signup").alias("redeem_transactions"),
            F.count_if(kind == "purchase").alias("total_transactions"),
            F.max("value").alias("eod_sc_balance"),
            F.coalesce(F.sum(F.when(kind == "purchase", F.floor(value))), F.lit(0)).alias("purchase_sc_coin"),
            F.max((kind == "click").cast("long")).alias("did_sc_spin"),
            F.max((kind == "error").cast("long")).alias("did_cc_spin"),
            total("signup", third == 0).alias("bonus_wheel"),
            total("signup", third == 1).alias("bonus_plinko"),
            total("purchase", third == 0).alias("offer_purchases_amount"),
            total("view", third == 0).alias("bonus_amount"),
            total("view", third == 1).alias("daily_mission_reward"),
            total("view", third == 2).alias("leaderboard_reward"),
        )
    )


def event_users(spark: SparkSession, folder: str) -> DataFrame:
    """Per-user facts that every row of the hourly table repeats."""
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    uid = F.col("h_user_id")
    host = (
        F.when(uid % 4 == 0, F.lit("@gmail.com"))
        .when(uid % 4 == 1, F.lit("@Yahoo.com"))
        .when(uid % 4 == 2, F.lit("@icloud.com"))
        .otherwise(F.lit(""))
    )
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("h_user_id"))
        .agg(
            F.min(ts).alias("signup_date"),
            F.min(F.when(kind == "purchase", ts)).alias("first_purchase_date"),
            F.min(F.when(kind == "click", ts)).alias("first_bet_date"),
        )
        .withColumn("email", F.concat(F.lit("u"), uid.cast("string"), host))
        .withColumn(
            "channel",
            F.when(uid % 5 == 0, F.lit("google"))
            .when(uid % 5 == 1, F.lit("facebook"))
            .when(uid % 5 == 2, F.lit("invite friend"))
            .when(uid % 5 == 3, F.lit("podcast")),
        )
        .withColumn("signup_platform", F.when(uid % 2 == 0, F.lit("App")).otherwise(F.lit("Web")))
        .withColumn(
            "first_geo_region",
            F.when(uid % 3 == 0, F.lit("Texas")).when(uid % 3 == 1, F.lit("Ohio")),
        )
    )


def main_kpi(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly behaviour joined with the per-user facts."""
    return event_hours(spark, folder).join(event_users(spark, folder), "h_user_id")


def daily_bets(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy("user_id", F.to_date(F.col("ts").cast("timestamp")).alias("day"))
        .agg(
            F.sum("value").alias("bet_amount"),
            F.min("value").alias("min_bet_amount"),
            F.max("value").alias("max_bet_amount"),
            F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("max_win_amount"),
            F.count(F.lit(1)).alias("rounds_bet"),
            F.count_distinct("event_type").alias("unique_games_day"),
            F.coalesce(
                F.sum(F.when(F.col("event_type") == "signup", F.col("value"))), F.lit(0.0)
            ).alias("bonus_promotion_win_amount"),
        )
    )


# ---------------------------------------------------------------- payments


def payment_series(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly attempts and approvals for two payment platforms."""
    return (
        table(spark, folder, "events")
        .groupBy(
            platform_of(F.col("user_id")).alias("platform"),
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"),
        )
        .agg(
            F.count_if(F.col("event_type") != "error").alias("approved"),
            F.count(F.lit(1)).alias("total"),
        )
    )


def platform_of(user: Column) -> Column:
    return F.when(user % 2 == 0, F.lit("WEB_NUVEI")).otherwise(F.lit("NUVEI_CARD"))


def purchase_transaction(spark: SparkSession, folder: str) -> DataFrame:
    """Payment attempts: status 1 settled, 6 failed, 2 pending."""
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(status == "F", 1).when(status == "O", 6).otherwise(2).alias("status"),
        F.when(key % 3 == 0, F.lit("Y")).when(key % 3 == 1, F.lit("A")).otherwise(F.lit("N")).alias(
            "threeds_type"
        ),
        (F.col("o_totalprice") / 1000).alias("amount"),
        F.col("o_orderpriority").alias("provider"),
        compressed_day(F.col("o_orderdate")).alias("day"),
    )


def chargebacks(spark: SparkSession, folder: str) -> DataFrame:
    """Returned order lines with the paying order's provider."""
    lines = (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_linenumber").alias("line"),
            (F.col("l_extendedprice") / 1000).alias("amount"),
            compressed_day(F.col("l_shipdate")).alias("day"),
        )
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_orderpriority").alias("provider")
    )
    return lines.join(orders, "transaction_id").drop("line")


def redeem_grades(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(balance >= 0, F.col("c_nationkey") % 4 + 1).alias("grade"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("segment"),
    )


# ---------------------------------------------------------------- cohort triangle

AGES = list(range(7, 92, 7))
LONG_AGES = list(range(7, 141, 7))
COHORT_KEYS = ["su_week", "channel_type_con", "platform", "traffic_type"]


def _age_rows(days: Column, signup: Column, weeks: int) -> Column:
    """Ordered purchase days -> (age in weeks, amount) for the first ages."""
    inside = F.filter(
        days, lambda d: F.datediff(d["purchase_date"], signup).between(0, 7 * weeks - 1)
    )
    return F.transform(
        inside,
        lambda d: F.struct(
            F.floor(F.datediff(d["purchase_date"], signup) / 7).cast("int").alias("age"),
            d["amount"].alias("amount"),
        ),
    )


def cohort_ages(spark: SparkSession, folder: str, weeks: int) -> DataFrame:
    """(cohort, age in weeks) sums: revenue, users buying at that age, users buying first then.

    Each user's ordered days are cut into ages on the user row, so the only fact-sized shuffles
    are those of user_days. Users without purchases keep one row with a NULL age."""
    touches = attribution(spark, folder)
    rows = (
        user_days(spark, folder)
        .select(
            "user_id", "signup_date", _age_rows(F.col("days"), F.col("signup_date"), weeks).alias("_d")
        )
        .join(touches, "user_id")
        .select(
            S.week_monday(F.col("signup_date")).alias("su_week"),
            S.merge_restricted(
                S.spend_key(F.col("platform"), F.col("channel"), F.col("channel_type"))
            ).alias("channel_type_con"),
            F.lower("platform").alias("platform"),
            F.lower("traffic_type").alias("traffic_type"),
            "_d",
            F.posexplode_outer("_d").alias("_pos", "_one"),
        )
    )
    before = F.get(F.col("_d"), F.col("_pos") - 1)["age"]
    first = F.col("_pos") == 0
    return rows.groupBy(*COHORT_KEYS, F.col("_one.age").alias("age")).agg(
        F.coalesce(F.sum("_one.amount"), F.lit(0.0)).alias("revenue"),
        F.count_if(first | (before != F.col("_one.age"))).alias("buyers"),
        F.count_if(first).alias("first_buyers"),
        F.count_if(first | F.col("_pos").isNull()).alias("users"),
    )


def cohort_triangle(spark: SparkSession, folder: str, ages: list[int] = AGES) -> DataFrame:
    """Weekly signup cohorts by channel, platform and traffic with cumulative revenue per age, in
    the published wide shape."""
    per_age = F.struct("age", "revenue", "buyers", "first_buyers")
    cohorts = cohort_ages(spark, folder, len(ages)).groupBy(*COHORT_KEYS).agg(
        F.sum("users").alias("total_users"),
        F.sum("first_buyers").alias("total_paid"),
        F.collect_list(F.when(F.col("age").isNotNull(), per_age)).alias("_ages"),
    )

    def totals(field: str, zero: str, test: str) -> str:
        return (
            f"transform(sequence(0, {len(ages) - 1}), i -> aggregate("
            f"filter(_ages, s -> s.age {test} i), {zero}, (acc, s) -> acc + s.{field}))"
        )

    shaped = cohorts.selectExpr(
        *COHORT_KEYS,
        "total_users",
        "total_paid",
        totals("revenue", "0D", "<=") + " AS interval",
        totals("buyers", "0L", "=") + " AS users",
        totals("first_buyers", "0L", "<=") + " AS users_cum",
    )
    costs = (
        channel_costs(spark, folder)
        .groupBy(
            S.week_monday(F.col("day")).alias("su_week"),
            S.spend_key(F.col("platform"), F.col("channel"), F.col("channel_type")).alias(
                "channel_type_con"
            ),
            F.lower("platform").alias("platform"),
        )
        .agg(F.sum("cost").alias("total_costs"))
    )
    return shaped.join(costs, ["su_week", "channel_type_con", "platform"], "left").selectExpr(
        *COHORT_KEYS,
        "CASE WHEN traffic_type = 'organic' THEN 0D ELSE coalesce(total_costs, 0D) END AS total_costs",
        "total_users",
        "total_paid",
        *[
            f"get({name}, {i}) AS {name}_{a}d"
            for name in ("interval", "users", "users_cum")
            for i, a in enumerate(ages)
        ],
    )
