"""Named queries: each takes (spark, folder) and runs over the whole tables of that folder."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.functions import sums as A
from growthlab.functions.channels import channel_group, peer_class
from growthlab.operators import boosting as B
from growthlab.operators import cleaning as C
from growthlab.operators import cohort as H
from growthlab.operators import experiment as X
from growthlab.operators import forest as IF
from growthlab.operators import joins as J
from growthlab.operators import kpi as K
from growthlab.operators import ml as M
from growthlab.operators import ordered as O
from growthlab.operators import sketches as SK
from growthlab.operators import timeseries as TS
from growthlab.operators import trees as T
from growthlab.operators import triangle as R
from growthlab.plans import anomaly as AN
from growthlab.plans import cohort_roas as CR
from growthlab.plans import marketing_report as MR
from growthlab.plans import projection as PJ
from growthlab.plans import vip as V
from growthlab.session import durable, fresh_folder, plain_planning, tune
from growthlab.sources import readers, sinks, staging, views
from growthlab.streaming import history, payments

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

FIRST, LAST = "1995-01-05", "1995-07-01"
EVENT_FIRST, EVENT_LAST = "2023-11-01", "2024-08-20"
AS_OF = staging.AS_OF
PROJECTION_DAY = "1995-06-28"
DIGITS = 6
EXPOSED = 2
SEED = 42


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str, **settings) -> DataFrame:
        return fn(tune(spark), folder, **settings)

    _REGISTRY[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    return df.selectExpr(
        *[
            f"round(CAST(`{c}` AS DOUBLE), {digits}) AS `{c}`" if c in cols else f"`{c}`"
            for c in df.columns
        ]
    )


def as_long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def as_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def unpack_rounded(df: DataFrame, arr: str, prefix: str, ages: list[int]) -> DataFrame:
    wide = R.unpack(df, arr, prefix, ages)
    return rounded(wide, *[f"{prefix}{a}d" for a in ages])


# ---------------------------------------------------------------- sources and cleaning


@query
def first_purchase_cumsum(spark, folder):
    out = H.first_purchase_cumsum(staging.fact_purchase(spark, folder), FIRST, LAST)
    return rounded(
        out.withColumn("first_purchase_time", as_text(F.col("first_purchase_time"))),
        "first_purchase_amt",
    ).orderBy("user_id", "days_since_first_purchase")


@query
def scan_project_filter(spark, folder):
    statement = """SELECT c_custkey AS `User Id`, c_mktsegment AS Segment, c_acctbal AS Balance,
        c_nationkey AS nation FROM {src} WHERE c_acctbal BETWEEN :low AND :high"""
    df = spark.sql(
        statement, args={"low": 100.0, "high": 9000.0}, src=staging.table(spark, folder, "customer")
    )
    named = C.require_columns(C.normalise_names(df), ["user_id", "segment", "balance"])
    kept = C.lower_text(named).where(
        F.col("segment").isin("building", "machinery") | F.col("segment").like("%auto%")
    )
    size = F.when(F.col("balance") >= 5000, "high").when(F.col("balance") >= 1000, "mid")
    return (
        kept.withColumn("size", size.otherwise("low"))
        .withColumn("floor_balance", F.floor("balance").cast("bigint"))
        .withColumn("next_day", F.date_add(F.lit("1995-01-01").cast("date"), F.col("nation")))
        .dropna()
        .drop("nation")
        .orderBy("user_id")
    )


@query
def sql_file_scan(spark, folder):
    """A statement kept in a text file, with a named parameter."""
    where = fresh_folder(spark, "statement")
    staging.table(spark, folder, "orders").createOrReplaceTempView("growthlab_orders")
    text = """SELECT o_orderpriority, count(*) AS orders FROM growthlab_orders
              WHERE o_totalprice > :low GROUP BY o_orderpriority;"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(where)
    out = readers.sql_file(spark, where, {"low": 150000})
    spark.catalog.dropTempView("growthlab_orders")  # the plan has its tables by now
    return out


@query
def curated_view_columns(spark, folder):
    """Every curated view over customers' rows: its columns, rows, and the source column each shows."""
    customers = staging.table(spark, folder, "customer").select(F.col("c_custkey").alias("_k"))
    out = None
    for name in [*views.SELECTED, *views.HIDDEN]:
        columns = views.SELECTED[name][1] if name in views.SELECTED else views.HIDDEN[name][1]
        columns = dict.fromkeys([*columns, "user_id", "channel_type"])
        tag = F.concat(F.lit("-"), (F.col("_k") % 5).cast("string"))
        source = customers.select(
            *[
                F.when(F.col("_k") % 2 == 0, "App").otherwise("Search").alias(c)
                if c == "channel_type" else F.concat(F.lit(c), tag).alias(c)
                for c in columns
            ]
        )
        view = views.curated(name, source)
        wide = view.agg(F.count(F.lit(1)).alias("_rows"), *[F.max(c).alias(c) for c in view.columns])
        long = wide.unpivot("_rows", view.columns, "column", "top").select(
            F.lit(name).alias("view"), "column", F.col("_rows").alias("rows"), "top"
        )
        out = long if out is None else out.unionByName(long)
    return out


#: source columns of four views as columns of the given tables; the rest of a source's columns is the last one named
VIEW_SOURCES = {
    "marketing_user_billing": ("orders", {"date": "o_orderdate", "user_id": "o_custkey", "cpa_cost": "o_totalprice",
                                          "channel": "o_orderpriority", "*": "o_orderstatus"}),
    "marketing_touches": ("events", {"user_id": "user_id", "transaction_timestamp": "ts", "channel": "event_type", "*": "props"}),
    "marketing_costs": ("lineitem", {"day": "l_shipdate", "cost": "l_extendedprice", "channel": "l_returnflag",
                                     "country_code": "l_suppkey", "*": "l_linestatus"}),
    "finance_daily_screenshot_metrics": ("customer", {"user_id": "c_custkey", "bsc_coins": "c_acctbal", "platform": "c_mktsegment",
                                                      "*": "c_name"}),
}


@query
def curated_view_metrics(spark, folder):
    """Reports over four curated views, by the names that the views show: rows, distinct ids and amounts per channel."""
    shown = {
        "marketing_user_billing": ("channel_source", "user_id", "cpa_cost"),
        "marketing_touches": ("channel_source", "user_id", None),
        "marketing_costs": ("channel_source", "country_code", "cost"),
        "finance_daily_screenshot_metrics": ("platform", "user_id", "bsc_balance_sc_coins"),
    }
    out = None
    for name, (table, columns) in VIEW_SOURCES.items():
        wanted = views.SELECTED[name][1]
        rows = staging.table(spark, folder, table)
        source = rows.select(*[F.col(columns.get(c, columns["*"])).alias(c) for c in wanted], F.lit("x").alias("hidden"))
        key, user, amount = shown[name]
        part = views.curated(name, source).groupBy(F.col(key).alias("channel")).agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct(user).alias("ids"),
            (F.sum(amount) if amount else F.lit(0.0)).alias("amount"),
        ).withColumn("view", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return rounded(out, "amount", digits=2)


@query
def user_value_scan(spark, folder):
    out = readers.user_values(staging.user_profile(spark, folder), "1995-03-01")
    return rounded(out, "enp")


@query
def json_config_scan(spark, folder):
    """Payment series written as request documents and read back, with the configured rates."""
    where = fresh_folder(spark, "requests")
    series = staging.payment_series(spark, folder)
    # one document per platform and day: at most a day's buckets in one array
    day = F.to_date("hour")
    docs = series.groupBy(F.col("platform").alias("platform_provider"), day.alias("day")).agg(
        F.array_sort(
            F.collect_list(F.struct("approved", "total", "hour"))
        ).alias("instances")
    ).drop("day")
    docs.write.json(f"{where}/series")
    config = spark.createDataFrame(
        [(list(TS.CONTAMINATION), TS.CONTAMINATION, AN.MODEL_TYPE)],
        "platforms array<string>, contamination_rates map<string,double>, model_type string",
    )
    config.write.json(f"{where}/config")
    rates = readers.detector_config(spark, f"{where}/config")
    rows = readers.payment_requests(spark, f"{where}/series")
    return (
        rows.join(F.broadcast(rates), "platform")
        .groupBy("platform", "contamination_rate", "model_type")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("approved").alias("approved"),
            F.sum("total").alias("total"),
            as_text(F.max("hour")).alias("last_hour"),
        )
    )


@query
def sink_roundtrip(spark, folder):
    """Replace, append, key replacement, CSV and name-list sinks, read back."""
    where = fresh_folder(spark, "sinks")
    users = staging.redeem_grades(spark, folder).select("user_id", "segment", "grade")
    sinks.replace(users, f"{where}/t")
    sinks.append_if_any(users.where(F.col("grade").isNull()), f"{where}/t")
    sinks.append_if_any(users.where(F.col("user_id") < 0), f"{where}/t")
    member = users.select(F.lit(1090).alias("experiment_id"), "user_id", "segment")
    sinks.replace_key(member, f"{where}/x", "experiment_id", 1090)
    sinks.replace_key(member.withColumn("experiment_id", F.lit(7)), f"{where}/x", "experiment_id", 7)
    sinks.replace_key(
        member.where(F.col("segment") == "BUILDING"), f"{where}/x", "experiment_id", 1090
    )
    sinks.csv(users, f"{where}/csv")
    sinks.text_list(users, ["user_id", "segment", "grade"], f"{where}/names")
    names = readers.text_list(spark, f"{where}/names")
    back = readers.csv(spark, f"{where}/csv", "user_id bigint, segment string, grade int")
    parts = [
        readers.parquet(spark, f"{where}/t").select(F.lit("table").alias("sink"), "segment", "grade"),
        back.select(*names).select(F.lit("csv").alias("sink"), "segment", "grade"),
        spark.read.parquet(f"{where}/x").select(
            F.concat(F.lit("experiment "), F.col("experiment_id").cast("string")).alias("sink"),
            "segment",
            F.lit(None).cast("int").alias("grade"),
        ),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy("sink", "segment").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("grade").alias("grades")
    )


@query
def curated_view_chargebacks(spark, folder):
    source = staging.redeem_grades(spark, folder).withColumn("payment_token_id", F.col("user_id"))
    tokens = views.curated("finance_token_redeem_grade", source)
    backs = views.curated("finance_chargebacks", staging.chargebacks(spark, folder))
    payers = staging.purchase_transaction(spark, folder).select("transaction_id", "user_id")
    # one row per transaction before the joins
    per_payment = backs.groupBy("transaction_id", "provider").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount")
    )
    joined = per_payment.join(payers, "transaction_id").join(tokens, "user_id")
    out = joined.groupBy("segment", "provider").agg(
        F.sum("_n").alias("chargebacks"), F.sum("_amount").alias("amount")
    )
    return rounded(out, "amount")


@query
def basic_joins(spark, folder):
    """Inner and left joins, a dictionary look-up with default, suffixed collisions, same-row targets."""
    users = staging.users(spark, folder)
    days = staging.purchase_days(spark, folder)
    nation = staging.table(spark, folder, "nation")
    region = staging.table(spark, folder, "region")
    spend = days.groupBy("user_id").agg(F.sum("amount").alias("amount"), F.sum("purchases").alias("purchases"))
    joined = (
        users.join(spend, "user_id", "left")
        .join(F.broadcast(nation), users.c_nationkey == nation.n_nationkey)
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .withColumnsRenamed({"n_name": "name_x", "r_name": "name_y"})
    )
    coded = J.lookup(
        joined, "c_mktsegment", {"BUILDING": "house", "MACHINERY": "tools"}, "segment_label", "rest"
    )
    out = coded.groupBy("name_y", "segment_label").agg(
        F.count(F.lit(1)).alias("users"),
        F.count("amount").alias("buyers"),
        F.sum("purchases").alias("purchases"),
        F.sum("amount").alias("amount"),
        F.sum(F.col("amount") * F.lit(1.5)).alias("target"),
    )
    return rounded(out, "amount", "target")


@query
def limit_hours(spark, folder):
    """Purchases and redeems within 24/48/96 hours of signup, one pass over all limits."""
    days = staging.signed_purchase_days(spark, folder).where(F.col("days_since_signup") >= 0)
    timed = days.select(
        "user_id",
        "amount",
        F.col("signup_date").cast("timestamp").alias("signup_ts"),
        F.col("first_time").alias("transaction_date_time"),
        (F.col("purchase_date").cast("timestamp") + F.expr("INTERVAL 6 HOURS")).alias("redeem_time"),
    )
    tagged = C.limit_hours(
        timed, "signup_ts", ["redeem_time", "transaction_date_time"], [24, 48, 96]
    )
    out = tagged.groupBy("limit_h").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.sum("amount").alias("amount"),
    )
    return rounded(out, "amount")


@query
def completed_weeks(spark, folder):
    profile = C.same_day(
        staging.user_profile(spark, folder), "signup_date", "first_purchase_date"
    ).withColumn("su_week", S.week_monday(F.col("signup_date")))
    return C.completed_weeks(profile, AS_OF).groupBy("su_week").agg(
        F.count(F.lit(1)).alias("same_day_users")
    )


@query
def null_audit(spark, folder):
    touches = staging.attribution(spark, folder)
    return C.null_audit(touches, ["user_id", "channel", "channel_type", "platform", "traffic_type"])


@query
def missing_flags(spark, folder):
    kpi = H.kpi_first_hours(staging.main_kpi(spark, folder), EVENT_FIRST, EVENT_LAST)
    base = staging.event_users(spark, folder).select(
        F.col("h_user_id").alias("user_id"), "signup_date", "first_purchase_date", "channel"
    )
    joined = base.join(kpi.select("user_id", "avg_spin_amt", "rtp_ratio"), "user_id", "left")
    timed = joined.withColumn(
        "hours_to_first_purchase",
        S.hours_to_first_purchase(F.col("signup_date"), F.col("first_purchase_date")),
    )
    filled = C.fill_with_max(
        C.missing_flags(timed, ["avg_spin_amt", "rtp_ratio"]), "hours_to_first_purchase"
    )
    out = filled.withColumn("channel", F.coalesce("channel", F.lit("other"))).drop(
        "signup_date", "first_purchase_date"
    )
    return rounded(out, "hours_to_first_purchase", "avg_spin_amt", "rtp_ratio")


@query
def log_features(spark, folder):
    users = staging.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("balance"),
        F.greatest("c_acctbal", F.lit(0.0)).alias("positive"),
        F.col("c_acctbal").alias("ggr"),
    )
    logged = C.log_features(users, ["balance", "positive"]).withColumn(
        "ggr_log", S.signed_log(F.col("ggr"))
    )
    return rounded(logged.dropna().drop("ggr"), "ln_balance", "ln_positive", "ggr_log")


@query
def dummies_fixed(spark, folder):
    users = staging.event_users(spark, folder).select(
        F.col("h_user_id").alias("user_id"), S.email_domain(F.col("email")).alias("domain"),
        "channel", (F.col("h_user_id") % 5).alias("window_number"),
    )
    out = C.fixed_dummies(users, "domain", ["other", "gmail.com", "yahoo.com"])
    out = C.fixed_dummies(out, "channel", ["other", "google", "invite friend"], "legacy_zero")
    out = C.normalise_names(C.window_dummies(out)).drop("domain", "channel")
    return out.withColumnsRenamed(
        {"domain_gmail.com": "domain_gmail", "domain_yahoo.com": "domain_yahoo"}
    )


@query
def dummies_topk(spark, folder):
    users = staging.event_users(spark, folder).select(
        F.col("h_user_id").alias("user_id"),
        F.lower(S.email_domain(F.col("email"))).alias("domain"),
    )
    wide = C.topk_dummies(users, "domain", C.top_values(users, "domain", 2))
    flags = C.columns_like(wide, prefix="domain_")
    return H.melt(wide, ["user_id"], flags, "dummy", "flag").where(F.col("flag") == 1).drop("flag")


# ---------------------------------------------------------------- aggregates and ordered work


@query
def null_sum_variants(spark, folder):
    touches = staging.attribution(spark, folder)
    cost = F.when(F.col("channel_type").isNotNull(), F.col("cpa_cost"))
    out = touches.withColumn("c", cost).groupBy("channel", "platform").agg(
        A.sum_zero(F.col("c")).alias("zero_sum"),
        A.sum_null(F.col("c")).alias("null_sum"),
        A.sum_strict(F.col("c")).alias("strict_sum"),
        F.max("c").alias("top"),
        F.min("c").alias("low"),
        F.count("c").alias("n"),
    )
    return rounded(out, "zero_sum", "null_sum", "strict_sum")


@query
def dedupe_freq_topn(spark, folder):
    return _frequent(spark, folder, 5)


@query
def dedupe_freq_published(spark, folder):
    """The published 21 most frequent groups."""
    return _frequent(spark, folder, 21)


def _frequent(spark, folder, groups):
    tri = durable(PJ.classify(staging.cohort_triangle(spark, folder), PJ.CORE_CHANNELS))
    large = R.above_mean_rows(tri)
    kept = J.keep_ids(large, R.frequent_groups(large, groups), "group")
    return kept.groupBy("group").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("su_week").alias("weeks"),
        F.sum("total_users").alias("users"),
    )


@query
def signup_frequency(spark, folder):
    profile = staging.user_profile(spark, folder).dropDuplicates(["user_id", "signup_date"])
    counts = profile.groupBy("signup_date").agg(F.count(F.lit(1)).alias("signups"))
    return counts.orderBy(F.desc("signups"), "signup_date").limit(21)


@query
def user_running_sum(spark, folder):
    out = H.user_running_sum(staging.fact_purchase(spark, folder))
    return rounded(
        out.select("user_id", "transaction_id", "cumulative_amount"), "cumulative_amount"
    )


@query
def kpi_first_96h(spark, folder):
    out = H.kpi_first_hours(staging.main_kpi(spark, folder), EVENT_FIRST, EVENT_LAST)
    text = {c: as_text(F.col(c)) for c in ("signup_date", "first_purchase_date")}
    return rounded(
        out.withColumns(text), "max_purchase_amt_horly", "max_redeem_amt_hourly",
        "sum_redeem_amt", "sum_amt_total", "max_eod_sc_balance", "sum_bonus_wheel", "sum_bonus_plinko",
        "sum_offer_amt", "sum_daily_mission", "sum_leaderboard_reward",
    )


@query
def bets_first_4d(spark, folder):
    out = H.bets_first_days(
        staging.daily_bets(spark, folder), staging.main_kpi(spark, folder), "2023-10-01"
    )
    return rounded(
        out.withColumn("first_purchase_date", as_text(F.col("first_purchase_date"))),
        "avg_rounds_bet", "avg_bet_amt", "sum_bonus_promotion_bet_amount"
    )


@query
def calendar_ffill(spark, folder):
    daily = H.first_purchase_cumsum(staging.fact_purchase(spark, folder), FIRST, LAST)
    return H.densify(
        daily, "user_id", "days_since_first_purchase", 50, ["cum_sum", "daily_total"]
    )


@query
def label_first_exceed(spark, folder):
    daily = H.first_purchase_cumsum(staging.fact_purchase(spark, folder), FIRST, LAST)
    dense = H.densify(daily, "user_id", "days_since_first_purchase", 50, ["cum_sum"])
    return H.label_first_exceed(dense, 1000.0)


@query
def vip_share_by_month(spark, folder):
    cumulative = H.cumulative_days(staging.signed_purchase_days(spark, folder))
    out = H.share_by_month(H.ever_reached(cumulative))
    return rounded(out, *[f"pct_vip_{v}" for v in H.VIP_LEVELS])


@query
def melt_vip_share(spark, folder):
    cumulative = H.cumulative_days(staging.signed_purchase_days(spark, folder))
    share = H.share_by_month(H.ever_reached(cumulative))
    cols = [f"pct_vip_{v}" for v in H.VIP_LEVELS]
    return rounded(H.melt(share, ["signup_month"], cols, "vip_category", "percentage"), "percentage")


@query
def vip_tiers(spark, folder):
    tiers = H.vip_tiers(staging.signed_purchase_days(spark, folder))
    out = tiers.select(
        "user_id", "purchase_date", "a_vip_current", "b_vip_current", "c_vip_current", "tier",
        "first_day_purchase", "first_week_purchase", "cumulative_amount",
    )
    return rounded(out, "first_day_purchase", "first_week_purchase", "cumulative_amount")


@query
def rule_confusion(spark, folder):
    tiers = H.vip_tiers(staging.signed_purchase_days(spark, folder))
    flags = tiers.groupBy("user_id").agg(
        F.max("a_vip_current").alias("predicted"),
        F.max((F.col("cumulative_amount") >= 3000).cast("int")).alias("actual"),
    )
    return rounded(H.confusion(flags, "predicted", "actual"), "accuracy", "recall")


@query
def id_set_ops(spark, folder):
    """Intersection, both differences and the rest of two user sets."""
    cumulative = H.cumulative_days(staging.signed_purchase_days(spark, folder))
    flags = durable(H.ever_reached(cumulative, [1000, 2000]))
    every = flags.select("user_id")
    a = flags.where(F.col("vip_1000") == 1).select("user_id")
    b = durable(
        staging.user_profile(spark, folder)
        .where(F.to_date("first_purchase_date") == F.col("signup_date"))
        .select("user_id")
    )
    parts = {
        "both": J.keep_ids(a, b, "user_id"),
        "only_a": J.drop_ids(a, b, "user_id"),
        "only_b": J.drop_ids(b, a, "user_id"),
        "neither": J.drop_ids(J.drop_ids(every, a, "user_id"), b, "user_id"),
    }
    out = None
    for name, ids in parts.items():
        part = ids.select(F.lit(name).alias("part"), "user_id")
        out = part if out is None else out.unionByName(part)
    return out


@query
def threshold_exceedance(spark, folder):
    series = H.age_series(staging.signed_purchase_days(spark, folder), 60)
    out = H.exceedance(series.where(F.col("days_since_signup") == 30))
    return rounded(as_long(out, "threshold"), "percentage_exceeding", "percentage_cumulative_sum")


@query
def age30_vs_60_bins(spark, folder):
    series = H.age_series(staging.signed_purchase_days(spark, folder), 60)
    return H.age_compare(series).groupBy("bins").agg(F.count(F.lit(1)).alias("users"))


@query
def trim_quantile(spark, folder):
    users = staging.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_acctbal", F.col("c_nationkey").alias("nation")
    )
    out = M.clip_quantiles(users, ["c_acctbal", "nation"])
    return rounded(out, "c_acctbal", "nation")


@query
def order_value_quantiles(spark, folder):
    """Exact quantiles of order value per priority over all orders."""
    orders = staging.table(spark, folder, "orders")
    levels = [0.01, 0.25, 0.5, 0.75, 0.99]
    out = O.exact_quantiles(orders, ["o_orderpriority"], "o_totalprice", levels)
    names = ["q01", "q25", "q50", "q75", "q99"]
    wide = out.select(
        "o_orderpriority", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )
    return rounded(wide, *names)


@query
def corr_prune(spark, folder):
    lines = staging.table(spark, folder, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(M.correlations(lines, cols).drop("_i", "_j"), "r", digits=5)


@query
def corr_kept_columns(spark, folder):
    lines = staging.table(spark, folder, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _kept_means(lines, cols, 0.6)


@query
def corr_kept_published(spark, folder):
    lines = staging.table(spark, folder, "lineitem")
    return _kept_means(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 0.9)


def _kept_means(lines, cols, low):
    kept = M.prune_correlated(lines, cols, low=low)
    means = lines.agg(*[F.avg(c).cast("double").alias(c) for c in kept])
    return rounded(means.unpivot([], kept, "feature", "mean"), "mean")


# ---------------------------------------------------------------- marketing marts


def _report_inputs(spark, folder):
    return (
        staging.user_profile(spark, folder),
        staging.purchase_days(spark, folder),
        staging.attribution(spark, folder),
        staging.channel_costs(spark, folder),
    )


def _summary(spark, folder):
    profile, days, touches, costs = _report_inputs(spark, folder)
    spend = MR.daily_costs(costs, AS_OF)
    return MR.with_costs(MR.funnel(profile, days, touches, AS_OF), spend), spend


@query
def signup_conversion_daily(spark, folder):
    profile, _, touches, _ = _report_inputs(spark, folder)
    return MR.signup_conversion(profile, touches, AS_OF)


@query
def day0_roas_fanout(spark, folder):
    profile, days, touches, _ = _report_inputs(spark, folder)
    return rounded(MR.day0_roas(profile, days, touches, AS_OF), "d0_total_amount")


@query
def combined_daily_summary(spark, folder):
    """The two sides counted apart and joined, as published; the reports take both from one aggregate."""
    profile, days, touches, costs = _report_inputs(spark, folder)
    summary = MR.combined_daily_summary(
        MR.signup_conversion(profile, touches, AS_OF), MR.day0_roas(profile, days, touches, AS_OF), MR.daily_costs(costs, AS_OF)
    )
    return rounded(summary, "d0_total_amount", "total_cost", "roas_d0")


@query
def report_overall_platform(spark, folder):
    summary, spend = _summary(spark, folder)
    return rounded(MR.overall_platform_report(summary, spend, AS_OF), *MR.METRICS)


@query
def top_channels_by_platform(spark, folder):
    summary, _ = _summary(spark, folder)
    return MR.top_channels(summary, AS_OF, 8, 2, 12)


@query
def daily_marketing_report(spark, folder):
    report = MR.daily_marketing_report(*_report_inputs(spark, folder), AS_OF)
    return rounded(report, *MR.METRICS)


@query
def revenue_day_pivot(spark, folder):
    out = H.revenue_on_days(staging.signed_purchase_days(spark, folder))
    return rounded(out, *[f"revenue_d{d}" for d in H.REVENUE_DAYS])


def _cohort_roas(spark, folder, grain):
    cohorts = CR.daily_cohorts(
        staging.user_profile(spark, folder),
        staging.signed_purchase_days(spark, folder),
        staging.attribution(spark, folder),
    )
    return CR.cohort_roas(cohorts, staging.channel_costs(spark, folder), cost_grain=grain)


@query
def cohort_roas(spark, folder):
    return _cohort_roas(spark, folder, "month_start")


@query
def cohort_roas_daily_cost(spark, folder):
    return _cohort_roas(spark, folder, "day")


# ---------------------------------------------------------------- triangle


def _classified(spark, folder, ages=staging.AGES):
    merged = PJ.merge_traffic(staging.cohort_triangle(spark, folder, ages))
    return PJ.classify(merged, PJ.CORE_CHANNELS)


def _cohorts(spark, folder):
    """One row per cohort with value and cumulative-user arrays, checkpointed (calendar-sized)."""
    ages = staging.AGES
    cum = [f"users_cum_{a}d" for a in ages]
    rows = PJ.regroup(_classified(spark, folder), "zero", ["total_costs"] + cum, ages)
    return durable(R.pack(R.pack(rows, "interval_", ages, "values"), "users_cum_", ages, "users_cum"))


def _rates(spark, folder, cohorts=None):
    rows = R.mask_relative(_cohorts(spark, folder) if cohorts is None else cohorts)
    return rows.withColumn("values", R.growth(F.col("values")))


@query
def relabel_mixed_traffic(spark, folder):
    merged = PJ.merge_traffic(staging.cohort_triangle(spark, folder))
    cols = ["interval_7d", "interval_91d", "total_costs"]
    return rounded(
        merged.select("su_week", "channel_type_con", "platform", "traffic_type", "total_users", *cols)
        .withColumn("total_users", F.col("total_users").cast("bigint")),
        *cols,
    )


@query
def channel_classify(spark, folder):
    out = _classified(spark, folder)
    return rounded(
        out.select("su_week", "channel_type_con", "group", "platform", "traffic_type", "total_costs"),
        "total_costs",
    )


@query
def triangle_mask_relative(spark, folder):
    rows = R.mask_relative(_cohorts(spark, folder)).drop("users_cum", "total_costs")
    return unpack_rounded(rows, "values", "interval_", staging.AGES)


@query
def triangle_mask_asof(spark, folder):
    rows = R.mask_by_run_date(_cohorts(spark, folder), PROJECTION_DAY).drop("users_cum", "total_costs")
    return unpack_rounded(rows, "values", "interval_", staging.AGES)


@query
def triangle_mask_rank(spark, folder):
    rows = _cohorts(spark, folder).drop("users_cum", "total_costs")
    masked = R.mask_by_rank(rows, O.week_table(rows))
    return unpack_rounded(masked, "values", "interval_", staging.AGES)


@query
def triangle_growth(spark, folder):
    rows = _rates(spark, folder).drop("users_cum", "total_costs")
    return unpack_rounded(rows, "values", "interval_", staging.AGES)


@query
def triangle_dedupe(spark, folder):
    rows = _cohorts(spark, folder).withColumn("values", R.null_zeros(F.col("values")))
    rows = rows.withColumn(
        "values", R.drop_plateaus(F.transform("values", lambda x: F.round(x, DIGITS)))
    )
    return unpack_rounded(
        rows.drop("users_cum", "total_costs"), "values", "interval_", staging.AGES
    )


@query
def triangle_exposure(spark, folder):
    return _omitted(spark, folder, EXPOSED)


@query
def triangle_exposure_published(spark, folder):
    """The published exposure of 50 users."""
    return _omitted(spark, folder, PJ.PROD.exposure_users)


def _omitted(spark, folder, users):
    cohorts = _cohorts(spark, folder)
    exposed = R.exposure(R.mask_relative(cohorts, "users_cum"))
    rates = _rates(spark, folder, cohorts).drop("users_cum")
    cells = R.omitted_cells(rates, exposed, staging.AGES, users)
    return rounded(cells, "original_value", "users_count")


@query
def winsorise_group(spark, folder):
    rows = R.winsorise(_rates(spark, folder).drop("users_cum", "total_costs"))
    return unpack_rounded(rows, "values", "interval_", staging.AGES)


@query
def winsor_report(spark, folder):
    report = R.winsor_report(_rates(spark, folder).drop("users_cum", "total_costs"), staging.AGES)
    return rounded(
        report.drop("below_original", "above_original"), "lower_bound", "upper_bound"
    )


@query
def peer_fill(spark, folder):
    rows = R.peer_fill(
        _rates(spark, folder).drop("users_cum", "total_costs"), peer_class(F.col("group"))
    )
    return unpack_rounded(rows, "values", "interval_", staging.AGES)


@query
def recency_weighted(spark, folder):
    rates = _rates(spark, folder)
    last = R.recency_last(rates, PJ.depth_for(len(staging.AGES), PJ.PROD_DEPTH))
    every = R.recency_all(rates)
    return unpack_rounded(last, "values", "last_", staging.AGES).join(
        unpack_rounded(every, "values", "all_", staging.AGES), "group"
    )


@query
def multiplier_repair(spark, folder):
    table = PJ.multiplier_table(_rates(spark, folder), PJ.PROD)
    named = table.withColumn("group", F.coalesce("group", F.lit(R.OVERALL)))
    return unpack_rounded(named, "values", "interval_", staging.AGES)


@query
def four_week_bucket(spark, folder):
    profile = staging.user_profile(spark, folder).withColumn(
        "su_week", S.week_monday(F.col("signup_date"))
    )
    return O.four_week_bucket(profile).groupBy("su_week", "month_group").agg(
        F.count(F.lit(1)).alias("users")
    )


@query
def chain_ladder(spark, folder):
    """Masked cohorts completed with the last-k mean growth of their group or of all groups."""
    rows = R.mask_relative(_cohorts(spark, folder)).drop("users_cum")
    rates = rows.withColumn("values", R.growth(F.col("values")))
    table = R.with_overall(
        R.recency_last(rates, PJ.depth_for(len(staging.AGES), PJ.PROD_DEPTH)), len(staging.AGES)
    ).withColumn("values", R.to_multiplier(F.col("values")))
    out = rows.withColumn("_mult", R.pick(R.as_map(table), F.col("group"))).withColumn(
        "values", R.chain_ladder(F.col("values"), F.col("_mult"))
    )
    return unpack_rounded(out.drop("total_costs", "_mult"), "values", "interval_", staging.AGES)


@query
def breakeven_targets(spark, folder):
    cohorts = _cohorts(spark, folder)
    rows = cohorts.drop("users_cum", "values")
    rates = _rates(spark, folder, cohorts)
    table = R.as_map(
        R.with_overall(
            R.recency_last(rates, PJ.depth_for(len(staging.AGES), PJ.PROD_DEPTH)),
            len(staging.AGES),
        ).withColumn("values", R.to_multiplier(F.col("values")))
    )
    rows = rows.withColumn("_mult", R.pick(table, F.col("group")))
    targets = R.breakeven_targets("total_costs", "_mult", staging.AGES)
    names = {a: f"target_{a}d" for a in targets}
    wide = rows.withColumns({names[a]: c for a, c in targets.items()}).drop("_mult")
    return rounded(wide, "total_costs", *names.values())


_PROD = PJ.Variant(**{**PJ.PROD.__dict__, "exposure_users": EXPOSED})


@query
def projection_prod_published(spark, folder):
    """With the published exposure of 50 users, below which a cell is open."""
    out = PJ.project(staging.cohort_triangle(spark, folder), PJ.PROD, PROJECTION_DAY)
    return rounded(out, "total_costs")


@query
def projection_prod(spark, folder):
    out = PJ.project(staging.cohort_triangle(spark, folder), _PROD, PROJECTION_DAY)
    return rounded(out, "total_costs")


@query
def projection_v1(spark, folder):
    source = staging.cohort_triangle(spark, folder, staging.LONG_AGES)
    return rounded(PJ.project(source, PJ.V11, PROJECTION_DAY), "total_costs")


@query
def projection_v2(spark, folder):
    source = staging.cohort_triangle(spark, folder, staging.LONG_AGES)
    return rounded(PJ.project(source, PJ.V2, PROJECTION_DAY), "total_costs")


@query
def actuals(spark, folder):
    out = PJ.actuals(staging.cohort_triangle(spark, folder), staging.AGES, PROJECTION_DAY)
    return rounded(out, "total_costs", *[f"actual_{a}d" for a in staging.AGES])


# ---------------------------------------------------------------- payment series


@query
def how_factors(spark, folder):
    series = TS.complete_rows(staging.payment_series(spark, folder))
    out = TS.hour_factors(TS.with_rate(series))
    return rounded(as_long(out, "hour_of_week"), "success_factor", "volume_factor")


@query
def anomaly_features(spark, folder):
    series = TS.complete_rows(staging.payment_series(spark, folder))
    out = TS.rolling_features(series)
    return rounded(
        out.select("platform", as_text(F.col("hour")).alias("hour"), *TS.FEATURES),
        *TS.FEATURES, digits=7,
    )


@query
def anomaly_features_latest(spark, folder):
    series = TS.complete_rows(staging.payment_series(spark, folder))
    out = TS.latest(TS.rolling_features(series))
    return rounded(
        out.select("platform", as_text(F.col("hour")).alias("hour"), "records_analyzed", *TS.FEATURES),
        *TS.FEATURES, digits=7,
    )


@query
def anomaly_features_causal(spark, folder):
    """Features for scoring history: factors and fills look at earlier buckets only."""
    series = TS.complete_rows(staging.payment_series(spark, folder))
    out = TS.rolling_features(series, causal=True)
    return rounded(
        out.select("platform", as_text(F.col("hour")).alias("hour"), *TS.FEATURES),
        *TS.FEATURES,
    )


@query
def anomaly_features_by_time(spark, folder):
    """Features of quarter hours, some of which are missing, with frames by time instead of by rows."""
    counts = payments.bucket_counts(
        staging.table(spark, folder, "events"), staging.platform_of(F.col("user_id")), F.col("event_type") != "error"
    )
    out = TS.rolling_features(TS.complete_rows(counts), clean=False, clock=TS.Clock(900))
    return rounded(
        out.select("platform", as_text(F.col("hour")).alias("hour"), *TS.FEATURES), *TS.FEATURES, digits=7,
    )


@query
def distinct_sketch_rollup(spark, folder):
    """Distinct users per event type, week and month from sketches made once per day and stored, against exact counts."""
    events = staging.table(spark, folder, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    stored = fresh_folder(spark, "sketches")
    SK.distinct_sketches(events, ["event_type", "day"], "user_id").write.parquet(stored)
    daily = spark.read.parquet(stored)
    parts = []
    for grain in ("week", "month"):
        period = F.to_date(F.date_trunc(grain, "day"))
        merged = SK.merge_distinct(daily.withColumn("period", period), ["event_type", "period"])
        exact = events.groupBy("event_type", period.alias("period")).agg(F.countDistinct("user_id").alias("users"))
        both = SK.distinct_estimates(merged, "estimate").join(exact, ["event_type", "period"])
        off = F.abs(F.col("estimate") - F.col("users")) <= F.ceil(F.col("users") * SK.distinct_error())
        parts.append(both.select(F.lit(grain).alias("grain"), "event_type", F.col("period").cast("string").alias("period"), "users", off.alias("within_bound")))
    return parts[0].unionByName(parts[1])


@query
def quantile_sketch_ranks(spark, folder):
    """Order value quantiles per priority from sketches per month, merged: is each one's rank within the sketch's bound?"""
    levels = [0.01, 0.25, 0.5, 0.75, 0.99]
    orders = staging.table(spark, folder, "orders").select(
        "o_orderpriority", F.col("o_totalprice").cast("double").alias("x"), F.trunc("o_orderdate", "month").alias("month")
    )
    monthly = SK.quantile_sketches(orders, ["o_orderpriority", "month"], "x")
    merged = SK.merge_quantiles(monthly, ["o_orderpriority"])
    points = F.array(*[F.lit(p) for p in levels])
    found = merged.select("o_orderpriority", F.kll_sketch_get_quantile_double("sketch", points).alias("q"))
    # five rows of five numbers
    ranked = orders.join(F.broadcast(found), "o_orderpriority")
    below = [F.avg((F.col("x") < F.col("q")[k]).cast("double")).alias(f"lt{k}") for k in range(len(levels))]
    up_to = [F.avg((F.col("x") <= F.col("q")[k]).cast("double")).alias(f"le{k}") for k in range(len(levels))]
    shares = ranked.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"), *below, *up_to)
    bound = 2 * SK.rank_error()  # months are merged
    good = [(F.col(f"lt{k}") <= p + bound) & (F.col(f"le{k}") >= p - bound) for k, p in enumerate(levels)]
    return shares.select("o_orderpriority", "orders", *[g.alias(f"p{int(100 * p):02}_within") for g, p in zip(good, levels)])


@query
def scaled_features(spark, folder):
    series = TS.complete_rows(staging.payment_series(spark, folder))
    cols = ["success_ma_3h", "success_volatility_3h"]
    features = TS.rolling_features(series).select("platform", "hour", *cols)
    out = TS.standardise(features, cols)
    return rounded(out.withColumn("hour", as_text(F.col("hour"))), *cols, digits=7)


#: fixed forests: nodes of (feature, cut, left, right, path length), and the rows each tree was grown on
FIXED_FORESTS = {
    "WEB_NUVEI": (256, [
        [(1, 5.0, 1, 2, -1.0), (-1, 0.0, -1, -1, 2.0), (0, 8.0, 3, 4, -1.0), (-1, 0.0, -1, -1, 3.5), (-1, 0.0, -1, -1, 1.0)],
        [(0, 3.0, 1, 2, -1.0), (-1, 0.0, -1, -1, 1.5), (-1, 0.0, -1, -1, 4.0)],
    ]),
    "NUVEI_CARD": (1, [[(-1, 0.0, -1, -1, 0.5)]]),
}


@query
def forest_fixed_scores(spark, folder):
    """Scores of every bucket by fixed forests, walked by the expression that also scores grown ones."""
    names = ("feature", "cut", "left", "right", "depth")
    rows = [(p, n, [dict(zip(names, map(list, zip(*tree)))) for tree in trees]) for p, (n, trees) in FIXED_FORESTS.items()]
    fields = "feature: array<int>, cut: array<double>, left: array<int>, right: array<int>, depth: array<double>"
    forest = spark.createDataFrame(rows, f"platform string, sample_rows long, forest array<struct<{fields}>>")
    series = staging.payment_series(spark, folder).withColumn("_slice", F.date_format("hour", "yyyy-MM"))
    out = IF.raw_scores(series, forest, ["approved", "total"]).drop("_slice")
    return rounded(out.withColumn("hour", as_text(F.col("hour"))), "score", digits=9)


@query
def anomaly_scores(spark, folder):
    series = staging.payment_series(spark, folder)
    detector = AN.fit(series)
    scored = AN.score_history(series, detector)
    return scored.select(
        "platform", as_text(F.col("hour")).alias("hour"), "anomaly_score", "is_anomaly", "confidence"
    )


@query
def anomaly_records(spark, folder):
    series = staging.payment_series(spark, folder)
    return AN.latest_records(series, AN.fit(series))


@query
def anomaly_status(spark, folder):
    """What becomes of every platform asked for: users 0 and 1 modulo 5 pay on known ones, the last day and the last hour of
    the others are platforms of their own with too few buckets, and for one platform there is no model."""
    events = staging.table(spark, folder, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    hour = F.date_trunc("hour", "ts")
    newest = events.where("user_id % 5 > 1").agg(F.max(hour)).scalar()
    platform = (
        F.when(F.col("user_id") % 5 == 0, "WEB_NUVEI").when(F.col("user_id") % 5 == 1, "NUVEI_CARD")
        .when(hour == newest, "LAST_HOUR").when(hour >= newest - F.expr("INTERVAL 1 DAY"), "LAST_DAY").otherwise("UNKNOWN")
    )
    counts = events.groupBy(platform.alias("platform"), hour.alias("hour")).agg(
        F.count_if(F.col("event_type") != "error").alias("approved"), F.count(F.lit(1)).alias("total")
    )
    series = durable(counts)
    detector = AN.fit(series.where(F.col("platform") != "UNKNOWN"), trees=10)
    out = AN.latest_records(series, detector)
    return out.select(
        "platform", "status", "records_analyzed", as_text(F.col("max_hour_excluded")).alias("max_hour_excluded"),
        as_text(F.col("prediction_timestamp")).alias("prediction_timestamp"),
    )


@query
def stream_bucket_counts(spark, folder):
    """Streaming quarter-hour counts, run to completion and read back."""
    where = fresh_folder(spark, "stream")
    events = payments.read_events(spark, f"{folder}/events.parquet")
    counts = payments.bucket_counts(
        events, staging.platform_of(F.col("user_id")), F.col("event_type") != "error"
    )
    payments.write_counts(counts, f"{where}/table", f"{where}/state").awaitTermination()
    table = spark.read.schema(counts.schema).parquet(f"{where}/table")
    return table.select("platform", as_text(F.col("hour")).alias("bucket"), "approved", "total")


@query
def stream_newest_features(spark, folder):
    """Features of the newest complete bucket per platform, from a stream's bounded histories."""
    where = fresh_folder(spark, "features")
    counts = payments.bucket_counts(
        payments.read_events(spark, f"{folder}/events.parquet"),
        staging.platform_of(F.col("user_id")), F.col("event_type") != "error", "1 hour",
    )
    payments.write_counts(counts, f"{where}/buckets", f"{where}/state/counts").awaitTermination()
    fresh = spark.readStream.schema(counts.schema).parquet(f"{where}/buckets")
    payments.write_counts(history.newest_features(fresh), f"{where}/out", f"{where}/state/features").awaitTermination()
    out = spark.read.parquet(f"{where}/out").where("hour IS NOT NULL")
    return rounded(
        out.select("platform", as_text(F.col("hour")).alias("hour"), "records_analyzed", *TS.FEATURES),
        *TS.FEATURES, digits=7,
    )


@query
def stream_latest_scores(spark, folder):
    """The streaming front end to end: finished buckets, scores of the newest one per platform."""
    where = fresh_folder(spark, "scores")
    args = (staging.platform_of(F.col("user_id")), F.col("event_type") != "error", "1 hour")
    past = payments.bucket_counts(staging.table(spark, folder, "events"), *args)
    counts = payments.bucket_counts(payments.read_events(spark, f"{folder}/events.parquet"), *args)

    def sink(records: DataFrame, batch: int) -> None:
        flat = records.select(
            "platform", "status", "anomaly_score", "is_anomaly", "records_analyzed",
            as_text(F.col("prediction_timestamp")).alias("bucket"),
        )
        flat.write.mode("overwrite").parquet(f"{where}/out/batch={batch}")

    payments.score_batches(
        counts, f"{where}/buckets", AN.fit(past), sink, f"{where}/state"
    ).awaitTermination()
    return spark.read.parquet(f"{where}/out")


# ---------------------------------------------------------------- VIP and experiments


def _vip_dataset(spark, folder):
    """Behaviour of the first 96 hours in the shape of the scorer's input; measures the events do
    not have stay NULL."""
    main = staging.main_kpi(spark, folder)
    kpi = H.kpi_first_hours(main, EVENT_FIRST, EVENT_LAST).drop("first_geo_region")
    bets = H.bets_first_days(staging.daily_bets(spark, folder), main, "2023-10-01").drop(
        "first_purchase_date", "days_of_activity"
    )
    joined = kpi.withColumnsRenamed(
        {"logins_first_96h": "logins", "max_purchase_amt_horly": "max_purchase_amt_hourly"}
    ).join(bets, "user_id", "left")
    shaped = joined.withColumns(
        {
            "firebase_user_id": F.concat(F.lit("F"), F.col("user_id").cast("string")),
            "email": F.lit(None).cast("string"),
            "full_name": F.concat(F.lit("User "), F.col("user_id").cast("string")),
            "window_number": F.col("user_id") % 5,
            "first_purchase_amt": F.col("max_purchase_amt_hourly"),
        }
    )
    return C.add_missing(shaped, V.SUM_COLS + V.EXTREME_COLS, None).withColumns(
        {c: F.col(c).cast("double") for c in V.SUM_COLS + V.EXTREME_COLS if c not in shaped.columns}
    )


@query
def vip_v1_features(spark, folder):
    kpi = H.kpi_first_hours(staging.main_kpi(spark, folder), EVENT_FIRST, EVENT_LAST)
    out = V.prepare_v1(C.add_missing(kpi, ["sum_sc_coin_total"], 0.0))
    numbers = ["time_diff_minutes", "avg_spin_amt", "rtp_ratio", "ln_total_bet_amt", "ln_sum_amt_total"]
    flags = [c for c in C.normalise_names(out).columns if c.startswith(tuple(f"{v}_" for v in V.V1_VOCABULARY))]
    return rounded(C.normalise_names(out).select("user_id", *numbers, *flags), *numbers)


@query
def vip_features(spark, folder):
    out = V.prepare(_vip_dataset(spark, folder)).withColumnsRenamed(
        {f"signup_email_domain_{d}": "domain_" + d.split(".")[0] for d in V.EMAIL_DOMAINS}
    )
    numbers = [
        "avg_spin_amt", "rtp_ratio", "avg_bet_amt", "ggr_amt_log", "ln_sum_amt_total",
        "ln_total_bet_amt", "ln_max_win_amt", "ln_sum_bonus_amt", "min_bet_amount",
    ]
    flags = [
        "avg_spin_amt_is_missing", "avg_bet_amt_is_missing", "domain_gmail", "domain_yahoo",
        "domain_other", "channel_google", "channel_facebook", "channel_invite_friend",
        "channel_other", "signup_platform_web", "signup_platform_app",
        *[f"window_{i}" for i in range(5)],
    ]
    missing = [c for c in V.MODEL_FEATURES if c not in out.columns and "domain" not in c]
    C.require_columns(out, missing)
    return rounded(out.select("user_id", "firebase_user_id", "email", *numbers, *flags), *numbers)


def _labelled(spark, folder):
    """Customers with a few numeric features, a spending label and a window number."""
    known = staging.user_days(spark, folder).where(F.col("days").isNotNull())
    spend = known.selectExpr(
        "user_id",
        "signup_date",
        "c_acctbal AS balance",
        "aggregate(days, 0L, (acc, d) -> acc + d.purchases) AS cnt_txn_total",
        "array_max(transform(days, d -> d.amount)) AS max_day",
        "cast(size(days) AS bigint) AS active_days",
        "aggregate(days, 0D, (acc, d) -> acc + d.amount) AS sum_amt_total",
    )
    return spend.withColumn("window_number", (F.col("user_id") % 6).cast("int")).withColumn(
        "flag", (F.col("sum_amt_total") > 1200).cast("int")
    )


_FEATURES = ["balance", "cnt_txn_total", "max_day", "active_days"]


@query
def class_weights(spark, folder):
    return rounded(X.class_weights(_labelled(spark, folder), "flag"), "weight")


@query
def stratified_split(spark, folder):
    return X.stratified_split(_labelled(spark, folder), "flag", "user_id", SEED).select(
        "user_id", "flag", "part"
    )


@query
def time_split(spark, folder):
    out = M.time_split(_labelled(spark, folder), "signup_date", "1995-01-01", "1995-05-01")
    return out.groupBy("set_type", "flag").agg(F.count(F.lit(1)).alias("users"))


@query
def vip_window_scores(spark, folder):
    """Five window models; window 5 has none and scores 0."""
    # partitions sized by their bytes: each of the hundreds of training steps is a job over them
    rows = durable(_labelled(spark, folder).hint("rebalance"))
    models = M.fit_per_window(
        rows, list(range(5)), lambda part: M.fit_logistic(part, _FEATURES)
    )
    where = fresh_folder(spark, "models")
    M.save_models(spark, models, where)
    loaded = M.load_models(spark, where, list(models))
    table = {w: M.logistic_terms(model, _FEATURES) for w, model in loaded.items()}
    out = M.score_by_terms(rows, table, M.THRESHOLD_SAME_DAY)
    return out.select("user_id", "window", "probability_positive_class", "potential_vip_ind")


@query
def logistic_optimum(spark, folder):
    """A fitted, saved and loaded logistic model, term by term: is the gradient of the weighted loss zero there (of standardised
    features, as a mean), and did the term come back as it was?"""
    names = ["balance", "cnt_txn_total", "active_days"]
    rows = durable(_labelled(spark, folder).hint("rebalance"))
    where = fresh_folder(spark, "logistic")
    model = M.fit_logistic(rows, names)
    M.save_models(spark, {"m": model}, where)
    fitted, loaded = (M.logistic_terms(m, names) for m in (model, M.load_models(spark, where, ["m"])["m"]))
    weighted = rows.join(F.broadcast(X.class_weights(rows, "flag").select("flag", "weight")), "flag")
    off = F.col("weight") * (F.expr(M.linear_probability(*fitted)) - F.col("flag"))
    scale = rows.agg(*[F.stddev_pop(c).alias(c) for c in names], *[F.avg(c).alias(f"{c}_mean") for c in names])
    z = {"intercept": F.lit(1.0)} | {c: (F.col(c) - F.col(f"{c}_mean")) / F.col(f"{c}_sd") for c in names}
    scale = F.broadcast(scale.withColumnsRenamed({c: f"{c}_sd" for c in names}))  # one row
    gradient = weighted.join(scale).agg(*[(F.sum(off * x) / F.sum("weight")).alias(t) for t, x in z.items()])
    same = {"intercept": fitted[0] == loaded[0]} | {c: fitted[1][c] == loaded[1][c] for c in names}
    terms = [F.struct(F.lit(t).alias("term"), (F.abs(t) < 1e-4).alias("at_optimum"), F.lit(same[t]).alias("same_after_load")) for t in z]
    return gradient.select(F.inline(F.array(*terms)))


@query
def vip_fixed_window_scores(spark, folder):
    """The scoring expression with given terms; windows 3 to 5 have no model."""
    table = {
        0: (-3.0, {"sum_amt_total": 0.002}),
        1: (-2.0, {"cnt_txn_total": 0.1}),
        2: (0.5, {"balance": 0.0001}),
    }
    out = M.score_by_terms(_labelled(spark, folder), table, M.THRESHOLD_SAME_DAY)
    return rounded(
        out.select("user_id", "window", "probability_positive_class", "potential_vip_ind"),
        "probability_positive_class", digits=9,
    )


@query
def model_threshold_sweep(spark, folder, rounds=500):
    """Newton boosting, gradient boosting and a logistic model, compared on the test rows."""
    rows = durable(X.stratified_split(_labelled(spark, folder), "flag", "user_id", SEED).hint("rebalance"))
    fit_rows, test = rows.where(F.col("part") != "test"), rows.where(F.col("part") == "test")
    held = F.col("part") == "val"
    fits = {
        "newton": lambda: B.fit_newton(fit_rows, _FEATURES, validation=held, rounds=rounds),
        "boosted": lambda: M.fit_boosted(fit_rows, _FEATURES, validation=held, iterations=rounds),
        "logistic": lambda: M.fit_logistic(fit_rows.where(~held), _FEATURES),
    }
    with ThreadPool(len(fits)) as pool:  # side by side: each is a chain of small jobs
        models = pool.map(inheritable_thread_target(spark)(lambda name: fits[name]()), fits)
    scores = F.array(*[F.struct(F.lit(n).alias("model"), F.expr(M.probability(m)).alias("prob")) for n, m in zip(fits, models)])
    scored = test.select("flag", F.inline(scores))
    return M.threshold_sweep(scored, "prob", "flag", ["model"])


@query
def oot_predictions(spark, folder):
    """Model fitted on early signups, labels for the later ones, counted against the outcome."""
    rows = durable(
        M.time_split(_labelled(spark, folder), "signup_date", "1995-01-01", "1995-05-01")
    )
    model = M.fit_logistic(rows.where(F.col("set_type") == "model_set"), _FEATURES)
    labels = M.predict_labels(model, rows.where(F.col("set_type") == "oot_set"))
    return M.outcome_counts(labels, "predicted_label", "flag")


@query
def vip_end_to_end(spark, folder):
    """The published chain: 45 ordered features of the first 96 hours, one model per window trained on
    spending after them, override, known users out, halves per value band."""
    main = staging.main_kpi(spark, folder)
    after = F.col("hour") > F.col("first_purchase_date") + F.expr("INTERVAL 96 HOURS")
    later = main.where(after).groupBy(F.col("h_user_id").alias("user_id")).agg(F.sum("purchase_amount").alias("later"))
    spent = F.coalesce("later", F.lit(0.0))
    raw = durable(_vip_dataset(spark, folder))
    with plain_planning(spark):
        rows = durable(V.prepare(raw))
        rows = durable(rows.join(later, "user_id", "left").withColumn("flag", (spent > 100).cast("int")).drop("later"))
    models = M.fit_per_window(rows, list(range(5)), lambda part: M.fit_logistic(part, V.MODEL_FEATURES))
    terms = {w: M.logistic_terms(model, V.MODEL_FEATURES) for w, model in models.items()}
    scored = M.score_by_terms(rows, terms, M.THRESHOLD_V2).select(
        "user_id", "firebase_user_id", "signup_date", "first_purchase_date", "email", "full_name", "window",
        "probability_positive_class", "potential_vip_ind",
    )
    known = staging.redeem_grades(spark, folder).where(F.col("grade") == 4)
    amounts = raw.withColumn("total_purchase_amount", F.col("sum_amt_total"))
    fresh = V.new_customers(scored, amounts, known, staging.user_profile(spark, folder), SEED)
    return V.output_rows(fresh, f"{AS_OF} 10:20:30")


@query
def vip_same_day(spark, folder):
    """The same-day variant over the published rows: first window, purchase on the signup day, numbered run."""
    fresh = _published(spark, folder)
    first = staging.user_profile(spark, folder).select("user_id", "first_purchase_date")
    history = staging.table(spark, folder, "nation").select(F.col("n_nationkey").alias("con_current"))
    out = V.same_day_rows(fresh.drop("first_purchase_date").join(first, "user_id"), history)
    return out.select("user_id", "window_class", F.col("con_current").cast("bigint").alias("con_current"))


@query
def vip_v1_marks(spark, folder):
    scored, _ = _scored(spark, folder)
    return V.mark_v1(scored.select("user_id", "probability_positive_class"), SEED, M.THRESHOLD_V1)


@query
def feature_importance(spark, folder, rounds=500):
    model = M.fit_boosted(durable(_labelled(spark, folder).hint("rebalance")), _FEATURES, iterations=rounds)
    return model.importance(spark)


#: a fixed linear score, and two fixed ensembles
LINEAR = (-1.5, {"balance": 0.0001, "cnt_txn_total": 0.05, "max_day": 0.002, "active_days": 0.03})
FIXED_TREES = {
    0: T.Ensemble(_FEATURES, [
        {"feature": [3, -1, 2, -1, -1], "cut": [4.0, 0.0, 300.0, 0.0, 0.0], "left": [1, -1, 3, -1, -1],
         "right": [2, -1, 4, -1, -1], "value": [0.0, -1.25, 0.0, 0.5, 2.0]},
        {"feature": [0, -1, -1], "cut": [2500.0, 0.0, 0.0], "left": [1, -1, -1], "right": [2, -1, -1], "value": [0.0, 0.25, -0.5]},
    ], base=0.125),
    4: T.Ensemble(_FEATURES, [{"feature": [-1], "cut": [0.0], "left": [-1], "right": [-1], "value": [3.5]}]),
}


@query
def ensemble_window_scores(spark, folder):
    """Fixed trees for windows 0 and 4 and a fixed linear model for window 1, in one read; the others have no model."""
    rows = _labelled(spark, folder)
    scores = {w: m.probability(T.vector(m.features)) for w, m in FIXED_TREES.items()} | {1: M.linear_probability(*LINEAR)}
    out = M.score_by_sql(rows, scores, M.THRESHOLD_SAME_DAY)
    return rounded(
        out.select("user_id", "window", "probability_positive_class", "potential_vip_ind"),
        "probability_positive_class", digits=9,
    )


@query
def permutation_importance(spark, folder):
    """Loss increase of the fixed linear score when one feature's values are dealt anew among all customers."""
    rows = durable(_labelled(spark, folder))
    intercept, weights = LINEAR
    terms = " + ".join(f"{w!r}D * get(%s, {k})" for k, w in enumerate(weights.values()))
    chance = lambda x: f"1 / (1 + exp(-({intercept!r}D + {terms.replace('%s', x)})))"
    out = M.permutation_importance(rows, "user_id", list(weights), "flag", chance, SEED)
    return rounded(out, "loss", "loss_increase", digits=9)


@query
def score_threshold_sweep(spark, folder):
    """The sweep on the labels table: how well a text's length, as a score below 1, tells its quality."""
    docs = staging.table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = staging.table(spark, folder, "labels")
    scored = labels.join(docs, "doc_id").select(
        F.lit("length").alias("model"),
        (F.col("n_chars") / (F.col("n_chars") + 1500.0)).alias("prob"),
        "quality",
    )
    out = M.threshold_sweep(scored, "prob", "quality", ["model"])
    return rounded(out, "threshold", "accuracy", "precision", "recall", "f1")


def _scored(spark, folder):
    """Users with a deterministic score, shaped like the routed scorer's output."""
    rows = durable(_labelled(spark, folder))
    prob = F.round(F.col("sum_amt_total") / (F.col("sum_amt_total") + 150.0), 9)
    scored = rows.select(
        "user_id",
        "signup_date",
        F.col("window_number").alias("window"),
        prob.alias("probability_positive_class"),
        (prob >= M.THRESHOLD_V2).cast("int").alias("potential_vip_ind"),
    )
    amounts = rows.select(
        "user_id",
        "sum_amt_total",
        (F.col("max_day") / 2).alias("sum_redeem_amt"),
        F.col("sum_amt_total").alias("total_purchase_amount"),
        "cnt_txn_total",
    )
    return scored, amounts


def _published(spark, folder):
    scored, amounts = _scored(spark, folder)
    existing = staging.redeem_grades(spark, folder).where(F.col("grade") == 4)
    values = staging.user_profile(spark, folder)
    fresh = V.new_customers(scored, amounts, existing, values, SEED)
    return V.output_rows(fresh, f"{AS_OF} 10:20:30")


@query
def vip_new_customers(spark, folder):
    out = _published(spark, folder)
    return out.withColumn("updated_at", as_text(F.col("updated_at")))


@query
def experiment_refresh(spark, folder):
    rows = V.experiment_rows(_published(spark, folder), "1995-06-10")
    return rows.withColumn("created_at", as_text(F.col("created_at")))


@query
def run_counter(spark, folder):
    orders = staging.table(spark, folder, "orders")
    nations = staging.table(spark, folder, "nation").select("n_nationkey")
    return nations.withColumn(
        "con_current", X.next_run(orders, "o_orderkey").cast("bigint")
    ).withColumn("first_run", X.next_run(orders.where(F.col("o_orderkey") < 0), "o_orderkey").cast("bigint"))


@query
def random_half(spark, folder):
    scored, _ = _scored(spark, folder)
    out = X.random_half(
        scored.select("user_id", "probability_positive_class"),
        "user_id", F.col("probability_positive_class") >= M.THRESHOLD_OOT, SEED, "chosen",
    )
    return out.select("user_id", "chosen")


@query
def percentile_band(spark, folder):
    rows = _labelled(spark, folder).select(
        "user_id", F.round("sum_amt_total", DIGITS).alias("purchase_amount")
    )
    return X.percentile_band(rows, "purchase_amount")


@query
def block_randomize(spark, folder):
    rows = _labelled(spark, folder).select("user_id", "flag", "window_number")
    assigned, _ = X.block_randomize(rows, "user_id", ["flag", "window_number"], 3, seed=SEED)
    return assigned


@query
def crosstab_arms(spark, folder):
    rows = _labelled(spark, folder).select("user_id", "flag", "window_number")
    _, stats = X.block_randomize(rows, "user_id", ["flag", "window_number"], 3, seed=SEED)
    return stats


# ---------------------------------------------------------------- payment KPIs


@query
def payment_kpis(spark, folder):
    pay = staging.purchase_transaction(spark, folder).withColumn("period", F.trunc("day", "month"))
    out = K.payment_kpis(pay, ["provider", "period"])
    return rounded(out, "revenue", "avg_amount", "success_rate")


@query
def chargeback_ratio(spark, folder):
    pay = staging.purchase_transaction(spark, folder).withColumn("band", K.amount_band(F.col("amount")))
    back = staging.chargebacks(spark, folder).withColumn("band", K.amount_band(F.col("amount")))
    out = K.chargeback_ratio(pay, back, ["provider", "band"])
    return rounded(
        out, "volume", "chargeback_value", "chargeback_ratio", "value_share", 
    )


@query
def chargeback_periods(spark, folder):
    """Per provider and month; a month may have chargebacks only."""
    month = F.trunc("day", "month")
    pay = staging.purchase_transaction(spark, folder).withColumn("period", month)
    back = staging.chargebacks(spark, folder).withColumn("period", month)
    out = K.chargeback_ratio(pay, back, ["provider", "period"]).drop("volume", "value_share")
    return rounded(out, "chargeback_value", "chargeback_ratio")


@query
def grade_distribution(spark, folder):
    out = K.grade_distribution(staging.redeem_grades(spark, folder), ["segment"])
    return rounded(out, "share")


@query
def kpi_period_change(spark, folder):
    out = K.period_change(staging.purchase_transaction(spark, folder), "week")
    return rounded(
        out, "success_rate", "revenue", "rate_change", "revenue_change_pct", 
    )


@query
def kpi_month_change(spark, folder):
    out = K.period_change(staging.purchase_transaction(spark, folder), "month")
    return rounded(out, "success_rate", "revenue", "rate_change", "revenue_change_pct")


@query
def kpi_drilldown(spark, folder):
    pay = staging.purchase_transaction(spark, folder).withColumn("band", K.amount_band(F.col("amount")))
    out = K.drill_down(pay, ["provider", "band", "threeds_type"], "1995-04-01", 28)
    return rounded(out, "rate_before", "rate_after", "delta", "impact")
