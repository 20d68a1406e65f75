"""Plain SQL with the same result as each named query, over the same tables."""

from __future__ import annotations

from growthlab.catalog.views import AGES, LONG_AGES, with_views
from growthlab.sources.views import HIDDEN, SELECTED

FIRST, LAST = "1995-01-05", "1995-07-01"
AS_OF = "1995-06-05"
PROJECTION_DAY = "1995-06-28"
REVENUE_DAYS = [0, 3, 7, 10, 14, 21, 28, 35, 42, 49, 56, 63, 70, 77, 84, 91, 98]
VIP_LEVELS = [1000, 3000, 5000, 8000]
EXCEED_LEVELS = [100, 200, 500, 1000, 1500, 2000, 3000, 4000, 5000]
SLOTS = len(AGES)

_ORACLES: dict[str, str] = {}


def add(name: str, query: str, **parts: str) -> None:
    """Register a query; parts are its own named sub-queries, in order."""
    _ORACLES[name] = with_views(query, parts)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)


def r(expr: str, alias: str, digits: int = 6) -> str:
    # + 0.0 turns a negative zero into a plain one
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {alias}"


def half_up(expr: str, digits: int = 0) -> str:
    return f"round(round({expr}, {digits + 7}), {digits})"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(CAST({b} AS DOUBLE), 0))"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


# ---------------------------------------------------------------- sources and cleaning

FIRST_PARTS = dict(
    first_of_user=f"""SELECT user_id, purchase_time AS first_purchase_time, purchase_amount AS first_purchase_amt
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY purchase_time, transaction_id) AS rn
        FROM fact_purchase) WHERE rn = 1 AND purchase_time > TIMESTAMP '{FIRST}' AND purchase_time < TIMESTAMP '{LAST}'""",
    day_totals="""SELECT f.user_id, first_purchase_time, first_purchase_amt,
        CAST(round(date_sub('hour', first_purchase_time, purchase_time) / 24.0) AS BIGINT) AS days_since_first_purchase,
        round(round(sum(purchase_amount), 7)) AS daily_total
        FROM first_of_user f JOIN fact_purchase p ON p.user_id = f.user_id
        WHERE date_sub('hour', first_purchase_time, purchase_time) < 740 GROUP BY 1, 2, 3, 4""",
    first_cumsum="""SELECT *, round(sum(daily_total) OVER (PARTITION BY user_id ORDER BY days_since_first_purchase)) AS cum_sum
        FROM day_totals""",
)
add(
    "first_purchase_cumsum",
    f"""SELECT user_id, {ts_text('first_purchase_time')} AS first_purchase_time,
    {r('first_purchase_amt', 'first_purchase_amt')}, days_since_first_purchase, daily_total, cum_sum FROM first_cumsum""",
    **FIRST_PARTS,
)
add(
    "scan_project_filter",
    """SELECT c_custkey AS user_id, lower(c_mktsegment) AS segment, c_acctbal AS balance,
    CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 1000 THEN 'mid' ELSE 'low' END AS size,
    CAST(floor(c_acctbal) AS BIGINT) AS floor_balance, CAST(DATE '1995-01-01' + c_nationkey AS DATE) AS next_day
    FROM customer WHERE c_acctbal BETWEEN 100 AND 9000
    AND (c_mktsegment IN ('BUILDING', 'MACHINERY') OR lower(c_mktsegment) LIKE '%auto%')""",
)
add(
    "user_value_scan",
    f"SELECT user_id, {r('enp', 'enp')} FROM user_profile WHERE first_purchase_date > TIMESTAMP '1995-03-01'",
)
add(
    "json_config_scan",
    f"""SELECT platform, CASE platform WHEN 'WEB_NUVEI' THEN 0.008 ELSE 0.01 END::DOUBLE AS contamination_rate,
    'rolling_7day_hour_of_week' AS model_type, count(*) AS rows, CAST(sum(approved) AS BIGINT) AS approved,
    CAST(sum(total) AS BIGINT) AS total, {ts_text('max(hour)')} AS last_hour
    FROM payment_series GROUP BY platform""",
)
add("sql_file_scan", "SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 150000 GROUP BY 1")


def _view_columns() -> str:
    """Each view's columns under their published names, largest value of the column behind them."""
    parts = []
    for view in [*SELECTED, *HIDDEN]:
        if view in SELECTED:
            _, columns, renames = SELECTED[view]
            hidden = []
        else:
            columns, renames, hidden = ["user_id", "channel_type"], {}, HIDDEN[view][1]
        web = " WHERE c_custkey % 2 <> 0" if view == "marketing_cohort_metrics_web" else ""
        for c in dict.fromkeys(columns):
            value = "CASE WHEN c_custkey % 2 = 0 THEN 'App' ELSE 'Search' END" if c == "channel_type" else f"'{c}-' || c_custkey % 5"
            if c not in hidden:
                parts.append(f"""SELECT '{view}' AS "view", '{renames.get(c, c)}' AS "column", count(*) AS rows, max({value}) AS top FROM customer{web}""")
    return " UNION ALL ".join(parts)


add("curated_view_columns", _view_columns())
add(
    "curated_view_metrics",
    " UNION ALL ".join(
        f"SELECT '{view}' AS view, {key} AS channel, count(*) AS rows, count(DISTINCT {ids}) AS ids, {r(amount, 'amount', 2)} FROM {table} GROUP BY {key}"
        for view, table, key, ids, amount in (
            ("marketing_user_billing", "orders", "o_orderpriority", "o_custkey", "sum(o_totalprice)"),
            ("marketing_touches", "events", "event_type", "user_id", "0.0"),
            ("marketing_costs", "lineitem", "l_returnflag", "l_suppkey", "sum(l_extendedprice)"),
            ("finance_daily_screenshot_metrics", "customer", "c_mktsegment", "c_custkey", "sum(c_acctbal)"),
        )
    ),
)
add(
    "sink_roundtrip",
    """SELECT sink, segment, count(*) AS rows, CAST(sum(grade) AS BIGINT) AS grades FROM (
    SELECT 'table' AS sink, segment, grade FROM redeem_grades
    UNION ALL SELECT 'table', segment, grade FROM redeem_grades WHERE grade IS NULL
    UNION ALL SELECT 'csv', segment, grade FROM redeem_grades
    UNION ALL SELECT 'experiment 7', segment, NULL FROM redeem_grades
    UNION ALL SELECT 'experiment 1090', segment, NULL FROM redeem_grades WHERE segment = 'BUILDING') GROUP BY 1, 2""",
)
add(
    "curated_view_chargebacks",
    f"""SELECT g.segment, b.provider, count(*) AS chargebacks, {r('sum(b.amount)', 'amount')}
    FROM chargebacks b JOIN purchase_transaction p ON p.transaction_id = b.transaction_id
    JOIN redeem_grades g ON g.user_id = p.user_id GROUP BY 1, 2""",
)
add(
    "basic_joins",
    f"""SELECT r_name AS name_y, CASE c_mktsegment WHEN 'BUILDING' THEN 'house' WHEN 'MACHINERY' THEN 'tools' ELSE 'rest' END AS segment_label,
    count(*) AS users, count(s.amount) AS buyers, CAST(sum(s.purchases) AS BIGINT) AS purchases,
    {r('sum(s.amount)', 'amount')}, {r('sum(s.amount * 1.5)', 'target')}
    FROM customer c LEFT JOIN (SELECT user_id, sum(amount) AS amount, sum(purchases) AS purchases
    FROM purchase_days GROUP BY 1) s ON s.user_id = c.c_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""",
)
add(
    "limit_hours",
    f"""SELECT CAST(h AS INTEGER) AS limit_h, count(*) AS rows, count(DISTINCT user_id) AS users, {r('sum(amount)', 'amount')}
    FROM signed_purchase_days, (VALUES (24), (48), (96)) AS l(h)
    WHERE days_since_signup >= 0 AND (first_time - CAST(signup_date AS TIMESTAMP) <= to_hours(h)
    OR CAST(purchase_date AS TIMESTAMP) + INTERVAL 6 HOUR - CAST(signup_date AS TIMESTAMP) <= to_hours(h)) GROUP BY 1""",
)
add(
    "completed_weeks",
    f"""SELECT CAST(date_trunc('week', signup_date) AS DATE) AS su_week, count(*) AS same_day_users FROM user_profile
    WHERE signup_date = CAST(first_purchase_date AS DATE)
    AND CAST(date_trunc('week', signup_date) AS DATE) <= CAST(date_trunc('week', DATE '{AS_OF}') AS DATE) - 14 GROUP BY 1""",
)
add(
    "null_audit",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
        CAST(count(*) > count({c}) AS INTEGER) AS has_nulls FROM attribution"""
        for c in ("user_id", "channel", "channel_type", "platform", "traffic_type")
    ),
)
KPI = dict(
    anchor_hours="""SELECT *, max(signup_date) OVER u AS a_signup, max(first_purchase_date) OVER u AS a_first FROM main_kpi
        WHERE first_purchase_date IS NOT NULL WINDOW u AS (PARTITION BY h_user_id)""",
    kpi96=f"""SELECT h_user_id AS user_id, a_signup AS signup_date, a_first AS first_purchase_date, signup_platform, first_geo_region,
        {half_up('sum(sc_total_bet_amount)')} AS total_bet_amt, {half_up('sum(sc_total_win_amount)')} AS total_win_amt_sc,
        {half_up('sum(cc_total_win_amount)')} AS total_win_amt_cc,
        {half_up(div('sum(sc_total_bet_amount)', 'sum(sc_total_bet_transactions)'), 3)} AS avg_spin_amt,
        {half_up(div('sum(sc_total_win_amount)', 'sum(sc_total_bet_amount)'), 3)} AS rtp_ratio,
        {half_up('sum(sc_total_win_amount) - sum(sc_total_bet_amount)')} + 0.0 AS ggr_amt, min(channel) AS channel,
        min(substr(email, strpos(email, '@') + 1)) AS signup_email_domain, count(h_user_id) AS logins_first_96h,
        CAST(sum(sc_total_bet_transactions) AS BIGINT) AS total_bet_txn,
        {r('max(purchase_amount)', 'max_purchase_amt_horly')}, {r('max(redeem_amount)', 'max_redeem_amt_hourly')},
        {r('sum(redeem_amount)', 'sum_redeem_amt')}, CAST(sum(redeem_transactions) AS BIGINT) AS sum_redeem_txn,
        {r('sum(purchase_amount)', 'sum_amt_total')}, CAST(sum(total_transactions) AS BIGINT) AS cnt_txn_total,
        {r('max(eod_sc_balance)', 'max_eod_sc_balance')}, CAST(sum(purchase_sc_coin) AS BIGINT) AS sum_sc_coin_total,
        CAST(sum(did_sc_spin) AS BIGINT) AS sum_spin_sc, CAST(sum(did_cc_spin) AS BIGINT) AS sum_spin_cc,
        {r('sum(bonus_wheel)', 'sum_bonus_wheel')}, {r('sum(bonus_plinko)', 'sum_bonus_plinko')},
        {r('sum(offer_purchases_amount)', 'sum_offer_amt')}, {half_up('sum(bonus_amount)')} AS sum_bonus_amt,
        {r('sum(daily_mission_reward)', 'sum_daily_mission')}, {r('sum(leaderboard_reward)', 'sum_leaderboard_reward')}
        FROM anchor_hours WHERE date_sub('hour', a_first, hour) BETWEEN 0 AND 96 AND a_first > TIMESTAMP '2023-11-01' AND a_first < TIMESTAMP '2024-08-20'
        GROUP BY ALL""",
)
add(
    "kpi_first_96h",
    f"""SELECT * REPLACE ({ts_text('signup_date')} AS signup_date, {ts_text('first_purchase_date')} AS first_purchase_date) FROM kpi96""",
    **KPI,
)
add(
    "missing_flags",
    f"""SELECT u.h_user_id AS user_id, coalesce(u.channel, 'other') AS channel,
    {r('coalesce(k.avg_spin_amt, 0)', 'avg_spin_amt')}, {r('coalesce(k.rtp_ratio, 0)', 'rtp_ratio')},
    CAST(k.avg_spin_amt IS NULL AS INTEGER) AS avg_spin_amt_is_missing, CAST(k.rtp_ratio IS NULL AS INTEGER) AS rtp_ratio_is_missing,
    {r("coalesce(date_sub('second', u.signup_date, u.first_purchase_date) / 3600.0, max(date_sub('second', u.signup_date, u.first_purchase_date) / 3600.0) OVER ())", 'hours_to_first_purchase')}
    FROM event_users u LEFT JOIN kpi96 k ON k.user_id = u.h_user_id""",
    **KPI,
)
add(
    "log_features",
    f"""SELECT c_custkey AS user_id, {r('ln(c_acctbal + 1e-10)', 'ln_balance')}, {r('ln(greatest(c_acctbal, 0) + 1e-10)', 'ln_positive')},
    {r('sign(c_acctbal) * ln(1 + abs(c_acctbal))', 'ggr_log')} FROM customer WHERE c_acctbal > 0""",
)
add(
    "dummies_fixed",
    """SELECT user_id, CAST(dom = 'gmail.com' AS INTEGER) AS domain_gmail, CAST(dom = 'yahoo.com' AS INTEGER) AS domain_yahoo,
    CAST(dom NOT IN ('gmail.com', 'yahoo.com') AS INTEGER) AS domain_other,
    CAST(coalesce(channel = 'google', false) AS INTEGER) AS channel_google,
    CAST(coalesce(channel = 'invite friend', false) AS INTEGER) AS channel_invite_friend, 0 AS channel_other,
    CAST(w = 0 AS INTEGER) AS window_0, CAST(w = 1 AS INTEGER) AS window_1, CAST(w = 2 AS INTEGER) AS window_2,
    CAST(w = 3 AS INTEGER) AS window_3, CAST(w = 4 AS INTEGER) AS window_4
    FROM (SELECT h_user_id AS user_id, lower(substr(email, strpos(email, '@') + 1)) AS dom, channel, h_user_id % 5 AS w FROM event_users)""",
)
add(
    "dummies_topk",
    """SELECT user_id, 'domain_' || CASE WHEN domain IN (SELECT domain FROM user_domain GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2)
    THEN regexp_replace(domain, '\\..*', '') ELSE 'other' END AS dummy FROM user_domain""",
    user_domain="SELECT h_user_id AS user_id, lower(substr(email, strpos(email, '@') + 1)) AS domain FROM event_users",
)

# ---------------------------------------------------------------- aggregates and ordered work

add(
    "null_sum_variants",
    f"""SELECT channel, platform, {r('coalesce(sum(c), 0)', 'zero_sum')}, {r('sum(c)', 'null_sum')},
    {r('CASE WHEN count(c) = count(*) THEN sum(c) END', 'strict_sum')}, max(c) AS top, min(c) AS low, count(c) AS n
    FROM (SELECT *, CASE WHEN channel_type IS NOT NULL THEN cpa_cost END AS c FROM attribution) GROUP BY 1, 2""",
)
add(
    "signup_frequency",
    "SELECT signup_date, count(*) AS signups FROM user_profile GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 21",
)
add(
    "user_running_sum",
    f"""SELECT user_id, transaction_id, {r('sum(purchase_amount) OVER (PARTITION BY user_id ORDER BY purchase_time, transaction_id ROWS UNBOUNDED PRECEDING)', 'cumulative_amount')}
    FROM fact_purchase""",
)
add(
    "bets_first_4d",
    f"""SELECT b.user_id, max(days_of_activity) AS days_of_activity, {ts_text('max(first_purchase_date)')} AS first_purchase_date,
    max(max_bet_amount) AS max_bet_amt, min(min_bet_amount) AS min_bet_amount, max(max_win_amount) AS max_win_amt,
    {r('avg(rounds_bet)', 'avg_rounds_bet')}, {r('avg(bet_amount)', 'avg_bet_amt')},
    max(unique_games_day) AS max_daily_games_unique, {r('sum(bonus_promotion_win_amount)', 'sum_bonus_promotion_bet_amount')}
    FROM daily_bets b JOIN (SELECT h_user_id, max(first_purchase_date) AS first_purchase_date,
    count(DISTINCT CAST(hour AS DATE)) AS days_of_activity FROM main_kpi
    WHERE hour >= first_purchase_date AND hour < first_purchase_date + INTERVAL 96 HOUR GROUP BY 1) k ON k.h_user_id = b.user_id
    WHERE day >= CAST(first_purchase_date AS DATE) AND CAST(first_purchase_date AS DATE) >= day - 4 AND day >= DATE '2023-10-01'
    GROUP BY 1""",
)
GRID = dict(
    FIRST_PARTS,
    day_grid="""SELECT u.user_id, CAST(d AS INTEGER) AS days_since_first_purchase, t.cum_sum, t.daily_total
        FROM (SELECT DISTINCT user_id FROM first_cumsum) u CROSS JOIN range(0, 51) AS g(d)
        LEFT JOIN first_cumsum t ON t.user_id = u.user_id AND t.days_since_first_purchase = d""",
    day_filled="""SELECT user_id, days_since_first_purchase,
        last_value(cum_sum IGNORE NULLS) OVER w AS cum_sum, last_value(daily_total IGNORE NULLS) OVER w AS daily_total
        FROM day_grid WINDOW w AS (PARTITION BY user_id ORDER BY days_since_first_purchase ROWS UNBOUNDED PRECEDING)""",
)
add("calendar_ffill", "SELECT * FROM day_filled", **GRID)
add(
    "label_first_exceed",
    """SELECT user_id, coalesce(hit, 30) AS days_since_first_purchase,
    CASE WHEN hit IS NOT NULL THEN hit_cum ELSE last_cum END AS cum_sum, CAST(hit IS NOT NULL AS INTEGER) AS flag
    FROM (SELECT user_id, min(CASE WHEN cum_sum > 1000 THEN days_since_first_purchase END) AS hit,
    arg_min(cum_sum, days_since_first_purchase) FILTER (WHERE cum_sum > 1000) AS hit_cum,
    max(CASE WHEN days_since_first_purchase = 30 THEN cum_sum END) AS last_cum
    FROM day_filled WHERE days_since_first_purchase <= 30 GROUP BY 1)""",
    **GRID,
)
CUM = dict(
    cum_days="""SELECT user_id, signup_date, purchase_date, days_since_signup, amount,
        sum(amount) OVER (PARTITION BY user_id ORDER BY purchase_date) AS cumulative_amount FROM signed_purchase_days""",
)
SHARE = dict(
    CUM,
    month_share=f"""SELECT strftime(signup_date, '%Y-%m') AS signup_month,
        {', '.join(f"avg(CAST(top >= {v} AS INTEGER)) AS pct_vip_{v}" for v in VIP_LEVELS)}
        FROM (SELECT user_id, min(signup_date) AS signup_date, max(cumulative_amount) AS top FROM cum_days GROUP BY 1) GROUP BY 1""",
)
add(
    "vip_share_by_month",
    f"SELECT signup_month, {', '.join(r(f'pct_vip_{v}', f'pct_vip_{v}') for v in VIP_LEVELS)} FROM month_share",
    **SHARE,
)
add(
    "melt_vip_share",
    " UNION ALL ".join(
        f"SELECT signup_month, 'pct_vip_{v}' AS vip_category, {r(f'pct_vip_{v}', 'percentage')} FROM month_share"
        for v in VIP_LEVELS
    ),
    **SHARE,
)
TIERS = dict(
    CUM,
    tier_days="""SELECT *, sum(CASE WHEN days_since_signup = 0 THEN amount END) OVER (PARTITION BY user_id) AS first_day_purchase,
        sum(CASE WHEN days_since_signup BETWEEN 0 AND 7 THEN amount END) OVER (PARTITION BY user_id) AS first_week_purchase FROM cum_days""",
    tier_early="SELECT *, coalesce(first_week_purchase > 300 OR first_day_purchase >= 50, false) AS early FROM tier_days",
    tier_flags="""SELECT *, CAST(days_since_signup <= 14 AND cumulative_amount >= 2000 AND early AS INTEGER) AS a_vip_current,
        CAST(days_since_signup <= 60 AND cumulative_amount >= 2000 AND early AS INTEGER) AS b_vip_current,
        CAST(cumulative_amount > 3000 AS INTEGER) AS c_vip_current FROM tier_early""",
)
add(
    "vip_tiers",
    f"""SELECT user_id, purchase_date, a_vip_current, b_vip_current, c_vip_current,
    CASE WHEN a_vip_current = 1 THEN '1' WHEN b_vip_current = 1 THEN '2' WHEN cumulative_amount >= 3000 THEN '3' ELSE 'Irrelevant' END AS tier,
    {r('first_day_purchase', 'first_day_purchase')}, {r('first_week_purchase', 'first_week_purchase')},
    {r('cumulative_amount', 'cumulative_amount')} FROM tier_flags""",
    **TIERS,
)
add(
    "rule_confusion",
    f"""SELECT true_positives, false_positives, false_negatives, true_negatives,
    {r(div('true_positives + true_negatives', 'true_positives + false_positives + false_negatives + true_negatives'), 'accuracy')},
    {r(div('true_positives', 'true_positives + false_negatives'), 'recall')} FROM (
    SELECT count(*) FILTER (p = 1 AND y = 1) AS true_positives, count(*) FILTER (p = 1 AND y = 0) AS false_positives,
    count(*) FILTER (p = 0 AND y = 1) AS false_negatives, count(*) FILTER (p = 0 AND y = 0) AS true_negatives
    FROM (SELECT user_id, max(a_vip_current) AS p, max(CAST(cumulative_amount >= 3000 AS INTEGER)) AS y FROM tier_flags GROUP BY 1))""",
    **TIERS,
)
add(
    "id_set_ops",
    """SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'only_a' WHEN b THEN 'only_b' ELSE 'neither' END AS part, user_id
    FROM (SELECT p.user_id, coalesce(t.top >= 1000, false) AS a, coalesce(CAST(first_purchase_date AS DATE) = signup_date, false) AS b, t.top
    FROM user_profile p LEFT JOIN (SELECT user_id, max(cumulative_amount) AS top FROM cum_days GROUP BY 1) t ON t.user_id = p.user_id)
    WHERE top IS NOT NULL OR b""",
    **CUM,
)
AGE = dict(
    CUM,
    age_users="SELECT DISTINCT user_id FROM cum_days WHERE days_since_signup BETWEEN 0 AND 60",
    age_at="""SELECT u.user_id, a.d, coalesce(max(c.cumulative_amount), 0) AS amt
        FROM age_users u CROSS JOIN (VALUES (30), (60)) AS a(d)
        LEFT JOIN cum_days c ON c.user_id = u.user_id AND c.days_since_signup BETWEEN 0 AND a.d GROUP BY 1, 2""",
)
add(
    "threshold_exceedance",
    " UNION ALL ".join(
        f"""SELECT CAST({v} AS BIGINT) AS threshold, count(CASE WHEN amt > {v} THEN 1 END) AS count_exceeding, count(*) AS total_users,
        {r(div(f'count(CASE WHEN amt > {v} THEN 1 END)', 'count(*)'), 'percentage_exceeding')},
        {r(f'coalesce({div(f"coalesce(sum(CASE WHEN amt > {v} THEN amt END), 0)", "sum(amt)")}, 0)', 'percentage_cumulative_sum')}
        FROM age_at WHERE d = 30"""
        for v in EXCEED_LEVELS
    ),
    **AGE,
)
add(
    "age30_vs_60_bins",
    """SELECT CASE WHEN g < 10 THEN '0-10' WHEN g < 200 THEN '11-200' WHEN g < 400 THEN '201-400' WHEN g < 500 THEN '401-500'
    WHEN g < 1000 THEN '501-1000' WHEN g < 1500 THEN '1001-1500' ELSE '1500+' END AS bins, count(*) AS users
    FROM (SELECT a.user_id, b.amt - a.amt AS g FROM age_at a JOIN age_at b ON a.user_id = b.user_id AND a.d = 30 AND b.d = 60
    WHERE a.amt >= 1000) GROUP BY 1""",
    **AGE,
)
add(
    "trim_quantile",
    f"""SELECT c_custkey AS user_id, {r('greatest(least(c_acctbal, b99), b01)', 'c_acctbal')}, {r('greatest(least(c_nationkey, n99), n01)', 'nation')}
    FROM customer, (SELECT quantile_cont(c_acctbal, 0.01) AS b01, quantile_cont(c_acctbal, 0.99) AS b99,
    quantile_cont(CAST(c_nationkey AS DOUBLE), 0.01) AS n01, quantile_cont(CAST(c_nationkey AS DOUBLE), 0.99) AS n99 FROM customer)""",
)
add(
    "order_value_quantiles",
    "SELECT o_orderpriority, "
    + ", ".join(
        r(f"quantile_cont(o_totalprice, {p})", n)
        for p, n in ((0.01, "q01"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (0.99, "q99"))
    )
    + " FROM orders GROUP BY 1",
)
_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
add(
    "corr_prune",
    " UNION ALL ".join(
        f"SELECT '{_LINE[i]}' AS a, '{_LINE[j]}' AS b, {r(f'corr({_LINE[i]}, {_LINE[j]})', 'r', 5)} FROM lineitem"
        for i in range(4)
        for j in range(i + 1, 4)
    ),
)



def _kept(low: float) -> str:
    """The later column of a strong pair goes unless the earlier one has gone already."""
    strong = lambda a, b: f"(abs(corr({a}, {b})) > {low} AND abs(corr({a}, {b})) < 1)"
    qty, price, disc, tax = _LINE
    flags = f"""SELECT {strong(qty, price)} AS no_price, {strong(qty, disc)} OR (NOT {strong(qty, price)} AND {strong(price, disc)}) AS no_disc,
        {strong(qty, tax)} AS a, {strong(price, tax)} AS b, {strong(disc, tax)} AS c FROM lineitem"""
    gone = {qty: "false", price: "no_price", disc: "no_disc", tax: "a OR (NOT no_price AND b) OR (NOT no_disc AND c)"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'(SELECT avg({c}) FROM lineitem)', 'mean')} FROM ({flags}) WHERE NOT ({gone[c]})" for c in _LINE
    )


add("corr_kept_columns", _kept(0.6))
add("corr_kept_published", _kept(0.9))

# ---------------------------------------------------------------- marketing marts

_LABEL = """CASE WHEN lower(coalesce(platform, '')) = 'app' THEN coalesce(channel, 'unknown')
    ELSE coalesce(channel, 'unknown') || '-' || coalesce(channel_type, 'unknown') END"""
_RECENT = f"BETWEEN DATE '{AS_OF}' - 8 AND DATE '{AS_OF}' - 1"
_KEYS = "su_date, platform, channel, channel_type, channel_agg"
_DAY0 = "count(*) FILTER (first_day = su_date)"
REPORT = dict(
    recent=f"""SELECT p.user_id, signup_date AS su_date, CAST(first_purchase_date AS DATE) AS first_day, {_LABEL} AS channel_agg,
        lower(coalesce(platform, 'unknown')) AS platform, channel, channel_type
        FROM user_profile p LEFT JOIN attribution a ON a.user_id = p.user_id WHERE signup_date {_RECENT}""",
    signups=f"""SELECT {_KEYS}, count(*) AS total_signups, {_DAY0} AS day0_conversions,
        {half_up(div(_DAY0, 'count(*)') + ' * 100', 2)} AS conversion_rate FROM recent GROUP BY ALL""",
    day0=f"""SELECT {_KEYS}, count(*) AS total_users, count(transaction_id) AS paid_users,
        count(transaction_id) AS d0_purchase_count, sum(purchase_amount) AS d0_total_amount
        FROM recent r LEFT JOIN fact_purchase f ON f.user_id = r.user_id AND CAST(purchase_time AS DATE) = su_date GROUP BY ALL""",
    spend=f"""SELECT day, lower(coalesce(platform, 'unknown')) AS platform, {_LABEL} AS channel_agg,
        sum(cost) AS cost FROM channel_costs WHERE day {_RECENT} GROUP BY ALL""",
    # grouping treats NULL channels as equal, so stacking both sides stands in for the outer join
    stacked=f"""SELECT {_KEYS}, total_signups, day0_conversions, conversion_rate, 0 AS total_users, 0 AS paid_users,
        0 AS d0_purchase_count, NULL::DOUBLE AS raw_amount FROM signups
        UNION ALL SELECT {_KEYS}, 0, 0, 0.0, total_users, paid_users, d0_purchase_count, d0_total_amount FROM day0""",
    funnel=f"""SELECT {_KEYS}, CAST(sum(total_signups) AS BIGINT) AS total_signups, CAST(sum(day0_conversions) AS BIGINT) AS day0_conversions,
        max(conversion_rate) AS conversion_rate, CAST(sum(total_users) AS BIGINT) AS total_users, CAST(sum(paid_users) AS BIGINT) AS paid_users,
        CAST(sum(d0_purchase_count) AS BIGINT) AS d0_purchase_count, sum(raw_amount) AS raw_amount FROM stacked GROUP BY ALL""",
    summary="""SELECT f.* EXCLUDE (raw_amount), coalesce(raw_amount, 0) AS d0_total_amount, coalesce(s.cost, 0) AS total_cost,
        CASE WHEN s.cost > 0 THEN raw_amount / s.cost * 100 ELSE 0 END AS roas_d0
        FROM funnel f LEFT JOIN spend s ON s.day = f.su_date AND s.platform = f.platform AND s.channel_agg = f.channel_agg""",
)
METRICS = [
    "total_signups", "day0_conversions", "conversion_rate", "total_users", "paid_users",
    "d0_purchase_count", "d0_total_amount", "total_cost", "roas_d0",
]
COUNTS = ["total_signups", "day0_conversions", "total_users", "paid_users", "d0_purchase_count"]
add("signup_conversion_daily", "SELECT * FROM signups", **REPORT)
add(
    "day0_roas_fanout",
    f"SELECT su_date, platform, channel, channel_type, channel_agg, total_users, paid_users, d0_purchase_count, {r('d0_total_amount', 'd0_total_amount')} FROM day0",
    **REPORT,
)
add(
    "combined_daily_summary",
    f"""SELECT su_date, platform, channel, channel_type, channel_agg, {', '.join(COUNTS)},
    CAST(conversion_rate AS DOUBLE) AS conversion_rate, {r('d0_total_amount', 'd0_total_amount')}, {r('total_cost', 'total_cost')}, {r('roas_d0', 'roas_d0')} FROM summary""",
    **REPORT,
)


def _segment(name: str, keys: str) -> str:
    extra = ", s.platform" if keys else ""
    cost_keys = ", platform" if keys else ""
    on = " AND s.platform = k.platform" if keys else ""
    label = "s.platform" if keys else "''"
    return f"""SELECT s.su_date, '{name}' AS segment, {label} AS platform, '' AS channel_agg,
        {', '.join(f'sum({c}) AS {c}' for c in COUNTS)}, sum(d0_total_amount) AS d0_total_amount,
        {div('sum(day0_conversions)', 'sum(total_signups)')} * 100 AS rate, coalesce(k.cost, 0) AS total_cost,
        CASE WHEN k.cost > 0 THEN sum(d0_total_amount) / k.cost * 100 ELSE 0 END AS roas_d0
        FROM summary s LEFT JOIN (SELECT day{cost_keys}, sum(cost) AS cost FROM spend GROUP BY ALL) k
        ON k.day = s.su_date{on} GROUP BY s.su_date{extra}, k.cost"""


def _averages(source: str, keys: str) -> str:
    whole = COUNTS + ["d0_total_amount", "total_cost"]
    return f"""SELECT {keys}, {', '.join(f'{half_up(f"avg({c})")} AS {c}' for c in whole)},
        {half_up('avg(rate)', 2)} AS conversion_rate, {half_up('avg(roas_d0)', 3)} AS roas_d0 FROM {source} GROUP BY {keys}"""


def _report(source: str, period: str, segment: str) -> str:
    cols = ", ".join(r(f"coalesce({m}, 0)", m) for m in METRICS)
    return f"SELECT '{period}' AS period, {segment} AS segment, platform, channel_agg, {cols} FROM {source}"


REPORT_ALL = dict(
    REPORT,
    segment_days=_segment("Overall", "") + " UNION ALL " + _segment("Platform", "platform"),
    segment_yesterday=f"SELECT *, round(round(rate, 9), 2) AS conversion_rate FROM segment_days WHERE su_date = DATE '{AS_OF}' - 1",
    segment_past=f"SELECT * FROM segment_days WHERE su_date BETWEEN DATE '{AS_OF}' - 8 AND DATE '{AS_OF}' - 2",
    segment_week=_averages("segment_past", "segment, platform, channel_agg"),
    top_twelve=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY total_signups DESC, channel_agg,
        channel NULLS FIRST, channel_type NULLS FIRST) AS platform_rank FROM (SELECT platform, channel_agg, channel, channel_type,
        sum(total_signups) AS total_signups FROM summary WHERE su_date BETWEEN DATE '{AS_OF}' - 8 AND DATE '{AS_OF}' - 2
        AND channel_agg <> 'unknown' GROUP BY 1, 2, 3, 4)) WHERE platform_rank <= 12""",
    top_five=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform ORDER BY total_signups DESC, channel_agg,
        channel NULLS FIRST, channel_type NULLS FIRST) AS rn FROM summary WHERE su_date = DATE '{AS_OF}' - 1
        AND channel_agg <> 'unknown') WHERE rn <= 5""",
    top_days=f"""SELECT t.platform, t.channel_agg, {', '.join(f'd.{c}' for c in COUNTS)}, d.d0_total_amount, d.total_cost, d.roas_d0,
        {div('d.day0_conversions', 'd.total_signups')} * 100 AS rate
        FROM top_twelve t JOIN summary d ON t.platform = d.platform AND t.channel = d.channel
        AND coalesce(t.channel_type, '') = coalesce(d.channel_type, '')
        WHERE d.su_date BETWEEN DATE '{AS_OF}' - 8 AND DATE '{AS_OF}' - 2""",
    top_week=_averages("top_days", "platform, channel_agg"),
)
_SEGMENTS = (
    _report("segment_yesterday", "Yesterday", "segment")
    + " UNION ALL "
    + _report("segment_week", "7-Day Avg", "segment")
)
add("report_overall_platform", _SEGMENTS, **REPORT_ALL)
add(
    "top_channels_by_platform",
    """SELECT platform, channel_agg, channel, channel_type, CAST(total_signups AS BIGINT) AS total_signups,
    CAST(platform_rank AS INTEGER) AS platform_rank FROM top_twelve""",
    **REPORT_ALL,
)
add(
    "daily_marketing_report",
    _SEGMENTS
    + " UNION ALL "
    + _report("top_five", "Yesterday", "'Top 5 Channels'")
    + " UNION ALL "
    + _report("top_week", "7-Day Avg", "'Top 12 Channels'"),
    **REPORT_ALL,
)
REV = dict(
    day_revenue="SELECT user_id, signup_date, "
    + ", ".join(
        f"coalesce(sum(CASE WHEN days_since_signup = {d} THEN amount END), 0) AS revenue_d{d}"
        for d in REVENUE_DAYS
    )
    + " FROM signed_purchase_days WHERE days_since_signup BETWEEN 0 AND 98 GROUP BY 1, 2",
)
add(
    "revenue_day_pivot",
    "SELECT user_id, signup_date, "
    + ", ".join(r(f"revenue_d{d}", f"revenue_d{d}") for d in REVENUE_DAYS)
    + " FROM day_revenue",
    **REV,
)


def _roas(day: str) -> str:
    rev = ", ".join(f"c.revenue_d{d}" for d in REVENUE_DAYS)
    roas = ", ".join(
        f"CASE WHEN coalesce(k.cost, 0) > 0 THEN {half_up(f"c.revenue_d{d} / k.cost", 3)} ELSE 0 END AS roas_d{d}"
        for d in REVENUE_DAYS
    )
    return f"""SELECT c.cohort_date, coalesce(c.channel_type_con, 'organic') AS channel_type_con, c.platform, c.traffic_type,
        c.total_users, c.total_paid, round(coalesce(k.cost, 0)) AS daily_cost, {roas}, {rev}
        FROM day_cohorts c LEFT JOIN (SELECT {day} AS day, CASE WHEN lower(platform) LIKE '%app%' THEN lower(channel || '_app')
        ELSE lower(channel || '_' || channel_type) END AS key, lower(platform) AS platform, round(round(sum(cost), 7)) AS cost
        FROM channel_costs GROUP BY ALL) k
        ON k.day = c.cohort_date AND k.key = c.channel_type_con AND k.platform = c.platform AND c.traffic_type = 'paid'"""


COHORT = dict(
    REV,
    day_cohorts="""SELECT p.signup_date AS cohort_date, CASE WHEN a.key = 'restricted_app' THEN 'facebook_app' ELSE a.key END AS channel_type_con,
        a.platform, a.traffic_type, count(DISTINCT a.user_id) AS total_users,
        count(DISTINCT CASE WHEN p.first_purchase_date IS NOT NULL THEN p.user_id END) AS total_paid, """
    + ", ".join(f"round(round(sum(revenue_d{d}), 7)) AS revenue_d{d}" for d in REVENUE_DAYS)
    + """ FROM (SELECT DISTINCT user_id, lower(channel || '_' || channel_type) AS key,
        CASE WHEN channel = 'organic' THEN 'organic' ELSE lower(traffic_type) END AS traffic_type, lower(platform) AS platform FROM attribution) a
        LEFT JOIN user_profile p ON p.user_id = a.user_id LEFT JOIN day_revenue d ON d.user_id = p.user_id GROUP BY 1, 2, 3, 4""",
)
add("cohort_roas", _roas("CAST(date_trunc('month', day) AS DATE)"), **COHORT)
add("cohort_roas_daily_cost", _roas("day"), **COHORT)

# ---------------------------------------------------------------- triangle

_CORE = [
    "liftoff_int_app", "google_paid search", "facebook_app", "tiktok_app", "facebook_paid social",
    "apple_app", "moloco_app", "tiktok_paid social", "snapchat_paid social", "applovin_int_app",
    "snapchat_app", "bingsearch_paid search", "smadex_int_app",
]
_CLASS = {
    "network": ["applovin_int_app", "liftoff_int_app", "smadex_int_app", "moloco_app"],
    "paid_search": ["google_paid_search", "bingsearch_paid_search"],
    "paid_social": ["tiktok_paid_social", "snapchat_paid_social"],
    "social_app": ["tiktok_app", "snapchat_app", "facebook_app"],
}
KEY = "su_week, grp, platform, traffic_type"


def _group_case(col: str, keys: list[str] = _CORE) -> str:
    exact = " ".join(f"WHEN {col} = '{k}' THEN '{k.replace(' ', '_')}'" for k in keys)
    inside = " ".join(f"WHEN contains({col}, '{k}') THEN '{k.replace(' ', '_')}'" for k in keys)
    return f"""CASE {exact} WHEN regexp_matches({col}, 'affiliate|social traffic|content creator', 'i') THEN 'affiliates'
        WHEN regexp_matches({col}, 'invite friend', 'i') THEN 'invite_friend' {inside} ELSE 'other' END"""


_MEASURES = (
    ["total_costs", "total_users", "total_paid"]
    + [f"{p}{a}d" for p in ("interval_", "users_", "users_cum_") for a in AGES]
)


def _cells(source: str, prefix: str, out: str, ages: list[int] = AGES) -> str:
    """Wide -> long: one row per cohort and age number."""
    items = ", ".join(f"{{'i': {i}, 'v': CAST({prefix}{a}d AS DOUBLE)}}" for i, a in enumerate(ages))
    return f"""SELECT {KEY}, c.i AS i, c.v AS {out} FROM (SELECT {KEY}, unnest([{items}]) AS c FROM {source})"""


def _wide(source: str, keys: str, value: str, prefix: str, digits: int = 6) -> str:
    cols = ", ".join(
        r(f"max(CASE WHEN i = {i} THEN {value} END)", f"{prefix}{a}d", digits)
        for i, a in enumerate(AGES)
    )
    return f"SELECT {keys}, {cols} FROM {source} GROUP BY ALL"


OUT_KEY = 'su_week, grp AS "group", platform, traffic_type'
TRI = dict(
    merged="SELECT su_week, channel_type_con, platform, traffic, "
    + ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in _MEASURES)
    + """ FROM (SELECT t.*, CASE WHEN k.n = 2 THEN 'paid' ELSE t.traffic_type END AS traffic FROM triangle t
        JOIN (SELECT channel_type_con, count(DISTINCT traffic_type) AS n FROM triangle GROUP BY 1) k
        ON k.channel_type_con = t.channel_type_con)
        WHERE su_week IS NOT NULL AND platform IS NOT NULL AND traffic IS NOT NULL GROUP BY 1, 2, 3, 4""",
    named=f"""SELECT * REPLACE (CASE WHEN contains(grp, '_app') THEN 'app' ELSE platform END AS platform),
        CASE WHEN total_costs = 0 THEN 'organic' WHEN total_costs > 0 THEN 'paid' ELSE traffic END AS by_cost
        FROM (SELECT *, {_group_case('channel_type_con')} AS grp FROM merged)""",
    classed="""SELECT n.*, CASE WHEN k.n > 1 AND n.grp <> 'other' THEN 'paid' ELSE by_cost END AS traffic_type FROM named n
        JOIN (SELECT su_week, grp, count(DISTINCT by_cost) AS n FROM named GROUP BY 1, 2) k ON k.su_week = n.su_week AND k.grp = n.grp""",
    cohorts=f"SELECT {KEY}, coalesce(sum(total_costs), 0) AS total_costs, "
    + ", ".join(f"coalesce(sum({p}{a}d), 0) AS {p}{a}d" for p in ("interval_", "users_cum_") for a in AGES)
    + f" FROM classed WHERE platform IS NOT NULL GROUP BY {KEY}",
    cell=_cells("cohorts", "interval_", "v"),
    newest="SELECT max(su_week) AS top FROM cohorts",
    masked=f"SELECT {KEY}, i, CASE WHEN i < date_diff('day', su_week, top) // 7 + 1 THEN v END AS v FROM cell, newest",
    carried=f"""SELECT {KEY}, i, last_value(v IGNORE NULLS) OVER (PARTITION BY {KEY} ORDER BY i ROWS UNBOUNDED PRECEDING) AS v FROM masked""",
    rate=f"""SELECT {KEY}, i, nullif(v / nullif(lag(v) OVER (PARTITION BY {KEY} ORDER BY i), 0) - 1, 0) AS g FROM carried""",
    exposed=f"""SELECT su_week, grp, i, max(CASE WHEN i < date_diff('day', su_week, top) // 7 + 1 THEN n END) AS n
        FROM ({_cells('cohorts', 'users_cum_', 'n')}), newest GROUP BY 1, 2, 3""",
)
add(
    "relabel_mixed_traffic",
    f"""SELECT su_week, channel_type_con, platform, traffic AS traffic_type, CAST(total_users AS BIGINT) AS total_users,
    {r('interval_7d', 'interval_7d')}, {r('interval_91d', 'interval_91d')}, {r('total_costs', 'total_costs')} FROM merged""",
    **TRI,
)
add(
    "channel_classify",
    f"""SELECT su_week, channel_type_con, grp AS "group", platform, traffic_type, {r('total_costs', 'total_costs')} FROM classed""",
    **TRI,
)
add("triangle_mask_relative", _wide("masked", OUT_KEY, "v", "interval_"), **TRI)
add(
    "triangle_mask_asof",
    _wide(
        f"""(SELECT {KEY}, i, CASE WHEN i < CASE WHEN w < 3 THEN 2 WHEN w < 4 THEN 3 ELSE w END - 1 THEN v END AS v
        FROM (SELECT *, date_diff('day', su_week, DATE '{PROJECTION_DAY}') // 7 AS w FROM cell))""",
        OUT_KEY, "v", "interval_",
    ),
    **TRI,
)
add(
    "triangle_mask_rank",
    _wide(
        f"""(SELECT {KEY}, i, CASE WHEN i < back + 2 THEN v END AS v FROM cell JOIN (SELECT su_week AS w,
        row_number() OVER (ORDER BY su_week DESC) - 1 AS back FROM (SELECT DISTINCT su_week FROM cohorts)) k ON k.w = su_week)""",
        OUT_KEY, "v", "interval_",
    ),
    **TRI,
)
add("triangle_growth", _wide("rate", OUT_KEY, "g", "interval_"), **TRI)
add(
    "triangle_dedupe",
    _wide(
        f"""(SELECT {KEY}, i, CASE WHEN i = 0 OR row_number() OVER (PARTITION BY {KEY}, i > 0, v ORDER BY i) = 1 THEN v END AS v
        FROM (SELECT {KEY}, i, nullif(round(v, 6), 0) AS v FROM cell))""",
        OUT_KEY, "v", "interval_",
    ),
    **TRI,
)
for _name, _users in (("triangle_exposure", 2), ("triangle_exposure_published", 50)):
    add(
        _name,
        f"""SELECT r.su_week, r.grp AS "group", r.platform, r.traffic_type, CAST((r.i + 1) * 7 AS INTEGER) AS age,
        {r('r.g', 'original_value')}, {r('e.n', 'users_count')}
        FROM rate r JOIN exposed e ON e.su_week = r.su_week AND e.grp = r.grp AND e.i = r.i WHERE NOT coalesce(e.n > {_users}, false)""",
        **TRI,
    )


def _bounds(source: str, value: str, k: float = 1.0, least: int = 4) -> str:
    return f"""SELECT grp, i, q1 - {k} * (q3 - q1) AS low, q3 + {k} * (q3 - q1) AS high FROM (SELECT grp, i, count({value}) AS n,
        quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3 FROM {source} GROUP BY 1, 2) WHERE n >= {least}"""


def _winsor(source: str, value: str, k: float = 1.0, least: int = 4) -> str:
    return f"""SELECT {', '.join('s.' + k.strip() for k in KEY.split(','))}, s.i, CASE WHEN {value} < low THEN low
        WHEN {value} > high THEN high ELSE {value} END AS g FROM {source} s LEFT JOIN ({_bounds(source, value, k, least)}) b ON b.grp = s.grp AND b.i = s.i"""


def _class_case(col: str) -> str:
    return (
        "CASE "
        + " ".join(
            f"WHEN {col} IN ({', '.join(repr(m) for m in members)}) THEN '{name}'"
            for name, members in _CLASS.items()
        )
        + " END"
    )


def _peer(source: str) -> str:
    return f"""SELECT s.su_week, s.grp, s.platform, s.traffic_type, s.i, CASE WHEN s.cls IS NULL THEN s.g
        ELSE coalesce(s.g, near.m, far.m) END AS g FROM (SELECT *, {_class_case('grp')} AS cls FROM {source}) s
        LEFT JOIN (SELECT {_class_case('grp')} AS cls, su_week, i, avg(g) AS m FROM {source} GROUP BY 1, 2, 3) near
        ON near.cls = s.cls AND near.su_week = s.su_week AND near.i = s.i
        LEFT JOIN (SELECT su_week, i, avg(g) AS m FROM {source} GROUP BY 1, 2) far ON far.su_week = s.su_week AND far.i = s.i"""


_DEPTH = [3, 9, 8, 7, 6, 5, 5, 4, 4]
_DEPTH_V2 = [3, 10, 10, 8, 8, 6, 6, 4, 4]


def _last_mean(source: str, depths: list[int] = _DEPTH) -> str:
    depth = "CASE i " + " ".join(f"WHEN {i} THEN {d}" for i, d in enumerate(depths)) + " ELSE 3 END"
    return f"""SELECT k.grp, k.i, m.g FROM (SELECT DISTINCT grp, i FROM {source}) k LEFT JOIN (
        SELECT grp, i, sum(g * w) / sum(w) AS g FROM (SELECT grp, i, g,
        exp(CASE WHEN n > 1 THEN (n - back) / CAST(n - 1 AS DOUBLE) ELSE 0 END) AS w FROM (
        SELECT grp, i, g, back, least(cnt, {depth}) AS n FROM (SELECT *,
        row_number() OVER (PARTITION BY grp, i ORDER BY su_week DESC, platform DESC, traffic_type DESC) AS back,
        count(*) OVER (PARTITION BY grp, i) AS cnt FROM {source} WHERE g IS NOT NULL)) WHERE back <= n) GROUP BY 1, 2) m
        ON m.grp = k.grp AND m.i = k.i"""


def _all_mean(source: str) -> str:
    return f"""SELECT grp, i, coalesce(sum(g * w), 0) / sum(w) AS g FROM (SELECT grp, i, g,
        exp(CASE WHEN n > 1 THEN (place - 1) / CAST(n - 1 AS DOUBLE) ELSE 0 END) AS w FROM (SELECT *,
        row_number() OVER (PARTITION BY grp, i ORDER BY su_week, platform, traffic_type) AS place,
        count(*) OVER (PARTITION BY grp, i) AS n FROM {source})) GROUP BY 1, 2"""


add("winsorise_group", _wide(f"({_winsor('rate', 'g')})", OUT_KEY, "g", "interval_"), **TRI)
add(
    "winsor_report",
    f"""SELECT r.grp AS "group", {r('low', 'lower_bound')}, {r('high', 'upper_bound')}, count(CASE WHEN g < low THEN 1 END) AS below_count,
    count(CASE WHEN g > high THEN 1 END) AS above_count, count(CASE WHEN g < low OR g > high THEN 1 END) AS total_outliers,
    CAST((r.i + 1) * 7 AS INTEGER) AS age FROM rate r JOIN ({_bounds('rate', 'g')}) b ON b.grp = r.grp AND b.i = r.i
    GROUP BY r.grp, r.i, low, high HAVING count(CASE WHEN g < low OR g > high THEN 1 END) > 0""",
    **TRI,
)
add("peer_fill", _wide(f"({_peer('rate')})", OUT_KEY, "g", "interval_"), **TRI)
add(
    "recency_weighted",
    f"""SELECT a.*, b.* EXCLUDE ("group") FROM ({_wide('last_mean', 'grp AS "group"', 'g', 'last_')}) a
    JOIN ({_wide('all_mean', 'grp AS "group"', 'g', 'all_')}) b ON b."group" = a."group" """,
    **TRI, last_mean=_last_mean("rate"), all_mean=_all_mean("rate"),
)


def _cap_cols(source: str, start: int, out: str, slots: int = SLOTS) -> dict[str, str]:
    """Running cap over the age columns c0..cN, one sub-query per age."""
    parts, prev = {}, source
    for i in range(start + 1, slots):
        name = f"{out}_{i}"
        parts[name] = (
            f"SELECT * REPLACE (CASE WHEN c{i} > c{i - 1} THEN c{i - 1} ELSE c{i} END AS c{i}) FROM {prev}"
        )
        prev = name
    parts[out] = f"SELECT * FROM {prev}"
    return parts


def _columns(source: str, value: str = "g", slots: int = SLOTS) -> str:
    return (
        "SELECT grp, "
        + ", ".join(f"max(CASE WHEN i = {i} THEN {value} END) AS c{i}" for i in range(slots))
        + f" FROM {source} GROUP BY 1"
    )


def _multipliers(source: str) -> dict[str, str]:
    """Rates in `source` -> sub-query multiplier(grp, c0..), grp NULL for the overall row."""
    return dict(
        clipped=_winsor(source, "g"),
        filled=_peer("clipped"),
        group_mean=_last_mean("filled"),
        mean_cols=_columns("group_mean"),
        **_cap_cols("mean_cols", 2, "shaped"),
        **_repaired("shaped", SLOTS),
        **_cap_cols("mean_filled", 1, "multiplier"),
    )


def _repaired(source: str, slots: int) -> dict[str, str]:
    """Overall row, floor, +1, column-mean fill."""
    cols = range(slots)
    return dict(
        with_all=f"SELECT * FROM {source} UNION ALL SELECT NULL, "
        + ", ".join(f"avg(c{i})" for i in cols)
        + f" FROM {source}",
        repaired="SELECT grp, "
        + ", ".join(
            f"1 + CASE WHEN c{i} < 0.03 THEN avg(CASE WHEN c{i} >= 0.03 THEN c{i} END) OVER () ELSE c{i} END AS c{i}"
            for i in cols
        )
        + " FROM with_all",
        mean_filled="SELECT grp, "
        + ", ".join(f"coalesce(c{i}, avg(c{i}) OVER ()) AS c{i}" if i >= 2 else f"c{i}" for i in cols)
        + " FROM repaired",
    )


add(
    "multiplier_repair",
    "SELECT coalesce(grp, 'mean_overall') AS \"group\", "
    + ", ".join(r(f"c{i}", f"interval_{a}d") for i, a in enumerate(AGES))
    + " FROM multiplier",
    **TRI, **_multipliers("rate"),
)


def _ladder(source: str, slots: int = SLOTS) -> dict[str, str]:
    """values v0.. and multipliers c0.. -> completed v0.. ."""
    parts, prev = {}, source
    for i in range(1, slots):
        name = f"step_{i}"
        parts[name] = f"SELECT * REPLACE (coalesce(v{i}, v{i - 1} * c{i}) AS v{i}) FROM {prev}"
        prev = name
    parts["ladder"] = f"SELECT * FROM {prev}"
    return parts


def _values(slots: int = SLOTS) -> str:
    return ", ".join(f"max(CASE WHEN i = {i} THEN v END) AS v{i}" for i in range(slots))


def _with_multiplier(values: str, table: str, slots: int = SLOTS, own: str | None = None) -> str:
    """Values beside the group's multipliers, else the overall ones; own adds columns t0.. used
    for the targets ('none' without fallback, 'fill' with the overall value per age)."""
    picks = ", ".join(
        f"CASE WHEN m.grp IS NOT NULL THEN m.c{i} ELSE o.c{i} END AS c{i}" for i in range(slots)
    )
    if own:
        picks += ", " + ", ".join(
            f"coalesce(m.c{i}, o.c{i}) AS t{i}" if own == "fill" else f"m.c{i} AS t{i}"
            for i in range(slots)
        )
    return f"""SELECT v.*, {picks} FROM {values} v LEFT JOIN {table} m ON m.grp = v.grp, (SELECT * FROM {table} WHERE grp IS NULL) o"""


SIMPLE = dict(
    TRI,
    simple_mean=_last_mean("rate"),
    simple_cols=_columns("simple_mean", "g + 1"),
    simple_rates=_columns("simple_mean"),
    simple_table="SELECT grp, "
    + ", ".join(f"c{i}" for i in range(SLOTS))
    + " FROM simple_cols UNION ALL SELECT NULL, "
    + ", ".join(f"avg(c{i}) + 1" for i in range(SLOTS))
    + " FROM simple_rates",
    value_cols=f"SELECT {KEY}, {_values()} FROM masked GROUP BY ALL",
    start=_with_multiplier("value_cols", "simple_table"),
    **_ladder("start"),
)
add(
    "chain_ladder",
    f"SELECT {OUT_KEY}, " + ", ".join(r(f"v{i}", f"interval_{a}d") for i, a in enumerate(AGES)) + " FROM ladder",
    **SIMPLE,
)


def _target(i: int, col: str = "c") -> str:
    """Cost over the product of the multipliers between age number i and 63 days."""
    product = " * ".join(f"{col}{j}" for j in range(8, i, -1))
    return div("total_costs", product)


add(
    "breakeven_targets",
    f"SELECT {OUT_KEY}, {r('total_costs', 'total_costs')}, "
    + ", ".join(r(_target(i), f"target_{AGES[i]}d") for i in range(8))
    + f" FROM ({_with_multiplier('(SELECT ' + KEY + ', total_costs FROM cohorts)', 'simple_table')})",
    **SIMPLE,
)
add(
    "four_week_bucket",
    """SELECT su_week, min(su_week) OVER (PARTITION BY n // 4) AS month_group, users FROM (SELECT su_week,
    row_number() OVER (ORDER BY su_week) - 1 AS n, users FROM (SELECT CAST(date_trunc('week', signup_date) AS DATE) AS su_week,
    count(*) AS users FROM user_profile GROUP BY 1))""",
)
for _name, _groups in (("dedupe_freq_topn", 5), ("dedupe_freq_published", 21)):
    add(
        _name,
        f"""SELECT l.grp AS "group", count(*) AS rows, count(DISTINCT su_week) AS weeks, CAST(sum(total_users) AS BIGINT) AS users
        FROM large l WHERE grp IN (SELECT grp FROM large GROUP BY 1 ORDER BY count(*) DESC, grp LIMIT {_groups}) GROUP BY 1""",
        tri_named=f"SELECT *, {_group_case('channel_type_con')} AS grp FROM triangle WHERE channel_type_con IS NOT NULL",
        large="SELECT * FROM tri_named WHERE total_users > (SELECT avg(total_users) FROM tri_named)",
    )
_CUT = f"CAST(date_trunc('week', DATE '{PROJECTION_DAY}') AS DATE) - 14"
_PUBLISHED = AGES[:-1]
PROD = dict(
    TRI, named=TRI["named"].replace("FROM merged)", f"FROM merged WHERE su_week <= {_CUT})")
)
PROD.update(
    open_rate="""SELECT r.su_week, r.grp, r.platform, r.traffic_type, r.i, CASE WHEN e.n > 2 THEN r.g END AS g
        FROM rate r JOIN exposed e ON e.su_week = r.su_week AND e.grp = r.grp AND e.i = r.i""",
    **_multipliers("open_rate"),
    value_cols=f"SELECT {KEY}, {_values()} FROM masked GROUP BY ALL",
    start=_with_multiplier(
        f"(SELECT a.*, b.total_costs FROM value_cols a JOIN cohorts b USING ({KEY}))", "multiplier"
    ),
    **_ladder("start"),
    complete="SELECT * FROM ladder WHERE v0 <> 0 AND "
    + " AND ".join(f"v{i} IS NOT NULL" for i in range(len(_PUBLISHED))),
    bucket="""SELECT su_week AS w, min(su_week) OVER (PARTITION BY n // 4) AS month_group FROM (SELECT su_week,
        row_number() OVER (ORDER BY su_week) - 1 AS n FROM (SELECT DISTINCT su_week FROM complete))""",
)
_PROD_ROWS = (
    f"""SELECT grp AS channel_group, su_week, month_group, platform, traffic_type, {r('total_costs', 'total_costs')}, """
    + ", ".join(f"CAST(round_even({_target(i)}, 0) AS BIGINT) AS target_{AGES[i]}d" for i in range(8))
    + ", "
    + ", ".join(f"CAST(round_even(v{i}, 0) AS BIGINT) AS prediction_{a}d" for i, a in enumerate(_PUBLISHED))
    + f", '{PROJECTION_DAY} 00:00' AS updated_at FROM complete JOIN bucket ON w = su_week"
)
add("projection_prod", _PROD_ROWS, **PROD)
add("projection_prod_published", _PROD_ROWS, **{**PROD, "open_rate": PROD["open_rate"].replace("e.n > 2", "e.n > 50")})
_WIDE_KEYS = _CORE + ["ironsource_int_app", "unityads_int_app"]
_RUN_WEEKS = f"date_diff('day', su_week, DATE '{PROJECTION_DAY}') // 7"
_RUN_KEEP = f"CASE WHEN {_RUN_WEEKS} < 3 THEN 2 WHEN {_RUN_WEEKS} < 4 THEN 3 ELSE {_RUN_WEEKS} END - 1"


def _older_projection(mean: str, raise_then_cap: bool, own: str) -> dict[str, str]:
    """The versions that learn growth from large rows only and project de-duplicated values."""
    ages, slots = LONG_AGES, len(LONG_AGES)
    iv = [f"interval_{a}d" for a in ages]
    raised = "SELECT grp, " + ", ".join(
        f"CASE WHEN c{i + 1} > c{i} THEN c{i + 1} ELSE c{i} END AS c{i}" if i + 1 < slots else f"c{i}"
        for i in range(slots)
    )
    published = range(slots - 1)
    return dict(
        named=f"""SELECT * REPLACE (CASE WHEN contains(grp, '_app') THEN 'app' ELSE platform END AS platform),
            CASE WHEN total_costs = 0 THEN 'organic' WHEN total_costs > 0 THEN 'paid' ELSE traffic_type END AS by_cost
            FROM (SELECT *, {_group_case('channel_type_con', _WIDE_KEYS)} AS grp FROM long_triangle
            WHERE channel_type_con IS NOT NULL AND su_week <= {_CUT})""",
        classed="""SELECT n.* EXCLUDE (traffic_type), CASE WHEN k.n > 1 AND n.grp <> 'other' THEN 'paid' ELSE by_cost END AS traffic_type
            FROM named n JOIN (SELECT su_week, grp, count(DISTINCT by_cost) AS n FROM named GROUP BY 1, 2) k
            ON k.su_week = n.su_week AND k.grp = n.grp""",
        big="SELECT * FROM classed WHERE total_users > (SELECT avg(total_users) FROM classed)",
        basis=f"SELECT {KEY}, {', '.join(f'sum({c}) AS {c}' for c in iv)} FROM big WHERE platform IS NOT NULL "
        f"AND grp IN (SELECT grp FROM big GROUP BY 1 ORDER BY count(*) DESC, grp LIMIT 21) GROUP BY ALL",
        masked=f"SELECT {KEY}, i, CASE WHEN i < {_RUN_KEEP} THEN v END AS v FROM ({_cells('basis', 'interval_', 'v', ages)})",
        carried=TRI["carried"],
        rate=TRI["rate"],
        clipped=_winsor("rate", "g", 1.5, 1),
        group_mean=mean,
        mean_cols=_columns("group_mean", slots=slots),
        raised=raised + " FROM mean_cols",
        **_repaired("raised", slots),
        **(
            _cap_cols("mean_filled", 1, "multiplier", slots)
            if raise_then_cap
            else {"multiplier": "SELECT * FROM mean_filled"}
        ),
        rows_wide=f"""SELECT {KEY}, CASE WHEN count(total_costs) = count(*) THEN sum(total_costs) END AS total_costs,
            {', '.join(f'CASE WHEN count({c}) = count(*) THEN sum({c}) END AS {c}' for c in iv)}
            FROM classed WHERE platform IS NOT NULL GROUP BY {KEY}""",
        rows_cell=f"""SELECT {KEY}, i, CASE WHEN i < {_RUN_KEEP} AND (i = 0
            OR row_number() OVER (PARTITION BY {KEY}, i > 0, v ORDER BY i) = 1) THEN v END AS v
            FROM ({_cells('rows_wide', 'interval_', 'v', ages)})""",
        value_cols=f"SELECT {KEY}, {_values(slots)} FROM rows_cell GROUP BY ALL",
        start=_with_multiplier(
            f"(SELECT a.*, b.total_costs FROM value_cols a JOIN rows_wide b USING ({KEY}))",
            "multiplier", slots, own,
        ),
        **_ladder("start", slots),
        complete="SELECT * FROM ladder WHERE v0 <> 0 AND total_costs IS NOT NULL AND "
        + " AND ".join(f"v{i} IS NOT NULL" for i in published),
        bucket=PROD["bucket"],
    )


def _projected(ages: list[int], col: str) -> str:
    return (
        f"""SELECT grp AS channel_group, su_week, month_group, platform, traffic_type, {r('total_costs', 'total_costs')}, """
        + ", ".join(f"CAST(round_even({_target(i, col)}, 0) AS BIGINT) AS target_{ages[i]}d" for i in range(8))
        + ", "
        + ", ".join(
            f"CAST(round_even(v{i}, 0) AS BIGINT) AS prediction_{a}d" for i, a in enumerate(ages[:-1])
        )
        + f", '{PROJECTION_DAY} 00:00' AS updated_at FROM complete JOIN bucket ON w = su_week"
    )


add(
    "projection_v1",
    _projected(LONG_AGES, "t"),
    **_older_projection(_all_mean("clipped"), False, "fill"),
)
add(
    "projection_v2",
    _projected(LONG_AGES, "t"),
    **_older_projection(_last_mean("clipped", _DEPTH_V2), True, "none"),
)
add(
    "actuals",
    f"""SELECT grp AS channel_group, su_week, month_group, platform, traffic_type, {r('total_costs', 'total_costs')}, """
    + ", ".join(
        r(f"CASE WHEN {i} < back + 2 THEN interval_{a}d END", f"actual_{a}d") for i, a in enumerate(AGES)
    )
    + f""", '{PROJECTION_DAY} 00:00' AS updated_at FROM actual_rows JOIN (SELECT w, back, min(w) OVER (PARTITION BY n // 4) AS month_group
    FROM (SELECT su_week AS w, row_number() OVER (ORDER BY su_week) - 1 AS n, row_number() OVER (ORDER BY su_week DESC) - 1 AS back
    FROM (SELECT DISTINCT su_week FROM actual_rows))) k ON k.w = su_week""",
    **TRI,
    actual_rows=f"SELECT {KEY}, sum(total_costs) AS total_costs, "
    + ", ".join(f"sum(nullif(interval_{a}d, 0)) AS interval_{a}d" for a in AGES)
    + f" FROM classed WHERE platform IS NOT NULL GROUP BY {KEY}",
)

# ---------------------------------------------------------------- payment series

FEATURES = [
    "success_vs_rolling_expected", "volume_vs_rolling_expected", "success_vs_rolling_7day",
    "volume_vs_rolling_7day", "success_vs_1h_avg", "volume_vs_3h_avg", "success_ma_3h",
    "success_vs_7days_ago", "success_volatility_3h", "volume_volatility_3h", "success_trend_3h",
    "volume_momentum_1h",
]


def _z(expr: str, zero: str) -> str:
    return f"CASE WHEN ({expr}) = 0 THEN {zero} ELSE ({expr}) END"


def _clip(expr: str, low: str, high: str) -> str:
    return f"least(greatest({expr}, {low}), {high})"


SERIES = dict(
    series_top="SELECT *, max(hour) OVER (PARTITION BY platform) AS max_hour FROM payment_series",
    series="""SELECT platform, hour, approved, total, count(*) OVER (PARTITION BY platform) AS records_analyzed,
        approved / CAST(CASE WHEN total = 0 THEN 1 ELSE total END AS DOUBLE) AS sr,
        (isodow(hour) - 1) * 24 + hour(hour) AS how, row_number() OVER (PARTITION BY platform ORDER BY hour) AS rn
        FROM series_top WHERE hour < max_hour""",
    factor=f"""SELECT platform, how, {_clip('avg(sr) / any_value(o_sr)', '0.3', '3.0')} AS f_s, {_clip('avg(total) / any_value(o_v)', '0.3', '3.0')} AS f_v
        FROM (SELECT *, avg(sr) OVER (PARTITION BY platform) AS o_sr, avg(total) OVER (PARTITION BY platform) AS o_v FROM (
        SELECT *, row_number() OVER (PARTITION BY platform ORDER BY hour DESC) AS back FROM series) WHERE back <= 336) GROUP BY 1, 2""",
    rolled="""SELECT s.*, coalesce(f_s, 1.0) AS f_s, coalesce(f_v, 1.0) AS f_v,
        CASE WHEN count(*) OVER w168 >= 24 THEN avg(sr) OVER w168 END AS r7_s, CASE WHEN count(*) OVER w168 >= 24 THEN avg(total) OVER w168 END AS r7_v,
        CASE WHEN count(*) OVER wh >= 2 THEN avg(sr) OVER wh END AS rh_s, CASE WHEN count(*) OVER wh >= 2 THEN avg(total) OVER wh END AS rh_v,
        CAST(sum(total) OVER w4 AS DOUBLE) AS tot4, CAST(sum(approved) OVER w4 AS DOUBLE) AS ap4, avg(sr) OVER w4 AS ma1,
        avg(sr) OVER w12 AS success_ma_3h, avg(total) OVER w12 AS vma3, stddev_samp(sr) OVER w12 AS sd_s, stddev_samp(total) OVER w12 AS sd_v,
        CASE WHEN count(*) OVER w12 >= 3 THEN regr_slope(sr, s.rn) OVER w12 END AS slope, lag(total, 4) OVER o AS before4
        FROM series s LEFT JOIN factor f ON f.platform = s.platform AND f.how = s.how
        WINDOW o AS (PARTITION BY s.platform ORDER BY hour), w168 AS (PARTITION BY s.platform ORDER BY hour ROWS 167 PRECEDING),
        wh AS (PARTITION BY s.platform, s.how ORDER BY hour ROWS 6 PRECEDING), w4 AS (PARTITION BY s.platform ORDER BY hour ROWS 3 PRECEDING),
        w12 AS (PARTITION BY s.platform ORDER BY hour ROWS 11 PRECEDING)""",
    rolled4=f"SELECT *, ap4 / {_z('tot4', '1')} AS sr4 FROM rolled",
    raw_features=f"""SELECT platform, hour, records_analyzed,
        {_clip('sr4 / ' + _z('coalesce(rh_s, r7_s) * f_s', '0.5'), '0.1', '5.0')} AS success_vs_rolling_expected,
        {_clip('tot4 / ' + _z('coalesce(rh_v, r7_v) * f_v * 4', '10'), '0.1', '5.0')} AS volume_vs_rolling_expected,
        {_clip('sr / ' + _z('r7_s', '0.5'), '0.1', '5.0')} AS success_vs_rolling_7day,
        {_clip('total / ' + _z('r7_v', '10'), '0.1', '5.0')} AS volume_vs_rolling_7day,
        coalesce(sr / {_z('ma1', '1')}, 1) AS success_vs_1h_avg, coalesce(total / {_z('vma3', '1')}, 1) AS volume_vs_3h_avg,
        success_ma_3h, coalesce(sr4 / (CASE WHEN lag(sr4, 168) OVER o = 0 THEN 1 ELSE lag(sr4, 168) OVER o END), 1) AS success_vs_7days_ago,
        coalesce(sd_s, 0) AS success_volatility_3h, coalesce(sd_v, 0) AS volume_volatility_3h, coalesce(slope, 0) AS success_trend_3h,
        CASE WHEN before4 IS NULL THEN 0 WHEN before4 <> 0 THEN total / CAST(before4 AS DOUBLE) - 1 WHEN total > 0 THEN 1 ELSE 0 END AS volume_momentum_1h
        FROM rolled4 WINDOW o AS (PARTITION BY platform ORDER BY hour)""",
    # least/greatest skip NULL, so missing baselines are put back before the median fill
    open_features="""SELECT f.* REPLACE (CASE WHEN coalesce(r.rh_s, r.r7_s) IS NOT NULL THEN f.success_vs_rolling_expected END AS success_vs_rolling_expected,
        CASE WHEN coalesce(r.rh_v, r.r7_v) IS NOT NULL THEN f.volume_vs_rolling_expected END AS volume_vs_rolling_expected,
        CASE WHEN r.r7_s IS NOT NULL THEN f.success_vs_rolling_7day END AS success_vs_rolling_7day,
        CASE WHEN r.r7_v IS NOT NULL THEN f.volume_vs_rolling_7day END AS volume_vs_rolling_7day)
        FROM raw_features f JOIN rolled4 r ON r.platform = f.platform AND r.hour = f.hour""",
    median_of="SELECT platform, "
    + ", ".join(f"median({c}) AS {c}" for c in FEATURES)
    + " FROM open_features GROUP BY 1",
    features="SELECT f.platform, f.hour, f.records_analyzed, "
    + ", ".join(f"coalesce(f.{c}, CASE WHEN m.{c} > 0 THEN m.{c} ELSE 1 END) AS {c}" for c in FEATURES)
    + " FROM open_features f JOIN median_of m ON m.platform = f.platform",
)
add(
    "how_factors",
    f"SELECT platform, CAST(how AS BIGINT) AS hour_of_week, {r('f_s', 'success_factor')}, {r('f_v', 'volume_factor')} FROM factor",
    **SERIES,
)
_FEATURE_COLS = ", ".join(r(c, c, 7) for c in FEATURES)
add("anomaly_features", f"SELECT platform, {ts_text('hour')} AS hour, {_FEATURE_COLS} FROM features", **SERIES)
add(
    "anomaly_features_latest",
    f"""SELECT platform, {ts_text('hour')} AS hour, records_analyzed, {_FEATURE_COLS} FROM features f
    WHERE hour = (SELECT max(hour) FROM features g WHERE g.platform = f.platform)""",
    **SERIES,
)
add(
    "stream_newest_features",
    f"""SELECT platform, {ts_text('hour')} AS hour, records_analyzed, {_FEATURE_COLS} FROM features f
    WHERE hour = (SELECT max(hour) FROM features g WHERE g.platform = f.platform) AND records_analyzed >= 96""",
    finished="""SELECT * FROM payment_series WHERE hour + INTERVAL 1 HOUR <=
        (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 HOUR""",
    **{**SERIES, "series_top": SERIES["series_top"].replace("payment_series", "finished")},
)
_NORM_256 = "(2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0)"
_DEPTHS = "(CASE WHEN total < 5 THEN 2.0 WHEN approved < 8 THEN 3.5 ELSE 1.0 END) + (CASE WHEN approved < 3 THEN 1.5 ELSE 4.0 END)"
_FIXED = f"CASE platform WHEN 'NUVEI_CARD' THEN -pow(2, -0.5) ELSE -pow(2, -({_DEPTHS}) / 2 / {_NORM_256}) END"
add(
    "forest_fixed_scores",
    f"SELECT platform, {ts_text('hour')} AS hour, approved, total, {r(_FIXED, 'score', 9)} FROM payment_series",
)
add(
    "anomaly_status",
    f"""SELECT platform, CASE WHEN n = 0 THEN 'no data after excluding the newest hour' WHEN n < 96 THEN 'insufficient data'
        WHEN platform = 'UNKNOWN' THEN 'platform not available' ELSE 'ok' END AS status, n AS records_analyzed,
        {ts_text('newest')} AS max_hour_excluded,
        CASE WHEN n >= 96 AND platform <> 'UNKNOWN' THEN {ts_text('before')} END AS prediction_timestamp
        FROM (SELECT platform, count(*) - 1 AS n, max(hour) AS newest, max(hour) FILTER (hour < top) AS before
        FROM (SELECT *, max(hour) OVER (PARTITION BY platform) AS top FROM buckets) GROUP BY platform)""",
    newest_hour="SELECT date_trunc('hour', max(ts)) AS h FROM events WHERE user_id % 5 > 1",
    buckets="""SELECT DISTINCT CASE WHEN user_id % 5 = 0 THEN 'WEB_NUVEI' WHEN user_id % 5 = 1 THEN 'NUVEI_CARD'
        WHEN date_trunc('hour', ts) = h THEN 'LAST_HOUR' WHEN date_trunc('hour', ts) >= h - INTERVAL 1 DAY THEN 'LAST_DAY'
        ELSE 'UNKNOWN' END AS platform, date_trunc('hour', ts) AS hour FROM events, newest_hour""",
)
def _span(length: int) -> str:
    return f"RANGE BETWEEN {length * 900 - 1} PRECEDING AND CURRENT ROW"


def _enough(least: int, value: str, frame: str) -> str:
    return f"CASE WHEN count(*) OVER {frame} >= {least} THEN {value} OVER {frame} END"


BY_TIME = dict(
    SERIES,
    series_top="SELECT *, max(hour) OVER (PARTITION BY platform) AS max_hour FROM quarters",
    series=SERIES["series"].replace("SELECT platform, hour,", "SELECT platform, hour, CAST(epoch(hour) AS BIGINT) AS s,"),
    factor=SERIES["factor"].replace("row_number() OVER (PARTITION BY platform ORDER BY hour DESC) AS back", "max(s) OVER (PARTITION BY platform) AS top").replace(
        "back <= 336", "s > top - 336 * 900"),
    rolled=f"""SELECT s.*, coalesce(f_s, 1.0) AS f_s, coalesce(f_v, 1.0) AS f_v,
        {_enough(84, 'avg(sr)', 'w168')} AS r7_s, {_enough(84, 'avg(total)', 'w168')} AS r7_v,
        {_enough(2, 'avg(sr)', 'wh')} AS rh_s, {_enough(2, 'avg(total)', 'wh')} AS rh_v,
        CAST(sum(total) OVER w4 AS DOUBLE) AS tot4, CAST(sum(approved) OVER w4 AS DOUBLE) AS ap4, {_enough(2, 'avg(sr)', 'w4')} AS ma1,
        {_enough(6, 'avg(sr)', 'w12')} AS success_ma_3h, {_enough(6, 'avg(total)', 'w12')} AS vma3,
        {_enough(6, 'stddev_samp(sr)', 'w12')} AS sd_s, {_enough(6, 'stddev_samp(total)', 'w12')} AS sd_v,
        {_enough(6, 'regr_slope(sr, s.s / 900.0)', 'w12')} AS slope,
        max(total) OVER (PARTITION BY s.platform ORDER BY s RANGE BETWEEN 3600 PRECEDING AND 3600 PRECEDING) AS before4
        FROM series s LEFT JOIN factor f ON f.platform = s.platform AND f.how = s.how
        WINDOW w168 AS (PARTITION BY s.platform ORDER BY s {_span(168)}), wh AS (PARTITION BY s.platform, s.how ORDER BY s {_span(7 * 672)}),
        w4 AS (PARTITION BY s.platform ORDER BY s {_span(4)}), w12 AS (PARTITION BY s.platform ORDER BY s {_span(12)})""",
    raw_features=SERIES["raw_features"].replace("lag(sr4, 168) OVER o", "max(sr4) OVER o").replace(
        "WINDOW o AS (PARTITION BY platform ORDER BY hour)",
        "WINDOW o AS (PARTITION BY platform ORDER BY s RANGE BETWEEN 151200 PRECEDING AND 151200 PRECEDING)"),
)
for _part in ("median_of", "features"):
    BY_TIME.pop(_part)
add(
    "anomaly_features_by_time",
    f"SELECT platform, {ts_text('hour')} AS hour, {_FEATURE_COLS} FROM open_features",
    quarters="""SELECT CASE WHEN user_id % 2 = 0 THEN 'WEB_NUVEI' ELSE 'NUVEI_CARD' END AS platform, time_bucket(INTERVAL 15 MINUTE, ts) AS hour,
        count(CASE WHEN event_type <> 'error' THEN 1 END) AS approved, count(*) AS total FROM events GROUP BY 1, 2""",
    **BY_TIME,
)
add(
    "distinct_sketch_rollup",
    " UNION ALL ".join(
        f"""SELECT '{g}' AS grain, event_type, CAST(CAST(date_trunc('{g}', ts) AS DATE) AS VARCHAR) AS period, count(DISTINCT user_id) AS users,
        TRUE AS within_bound FROM events GROUP BY 2, 3"""
        for g in ("week", "month")
    ),
)
add(
    "quantile_sketch_ranks",
    "SELECT o_orderpriority, count(*) AS orders, "
    + ", ".join(f"TRUE AS p{p}_within" for p in ("01", "25", "50", "75", "99"))
    + " FROM orders GROUP BY 1",
)
add(
    "scaled_features",
    f"SELECT platform, {ts_text('hour')} AS hour, "
    + ", ".join(
        r(f"({c} - avg({c}) OVER p) / CASE WHEN stddev_pop({c}) OVER p = 0 THEN 1 ELSE stddev_pop({c}) OVER p END", c, 7)
        for c in ("success_ma_3h", "success_volatility_3h")
    )
    + " FROM features WINDOW p AS (PARTITION BY platform)",
    **SERIES,
)
_RECENT_ROWS = "BETWEEN 336 PRECEDING AND 1 PRECEDING"


def _causal_factor(col: str) -> str:
    ratio = f"avg({col}) OVER (PARTITION BY platform, how ORDER BY rn RANGE {_RECENT_ROWS}) / nullif(avg({col}) OVER (PARTITION BY platform ORDER BY rn ROWS {_RECENT_ROWS}), 0)"
    return f"CASE WHEN ({ratio}) IS NULL THEN 1.0 ELSE {_clip(ratio, '0.3', '3.0')} END"


CAUSAL = dict(
    SERIES,
    factor=f"SELECT platform, hour AS f_hour, {_causal_factor('sr')} AS f_s, {_causal_factor('total')} AS f_v FROM series",
    rolled=SERIES["rolled"].replace("f.how = s.how", "f.f_hour = s.hour"),
    features="SELECT platform, hour, records_analyzed, " + ", ".join(f"coalesce({c}, 1) AS {c}" for c in FEATURES) + " FROM open_features",
)
add(
    "anomaly_features_causal",
    f"SELECT platform, {ts_text('hour')} AS hour, {', '.join(r(c, c) for c in FEATURES)} FROM features",
    **CAUSAL,
)
add(
    "stream_bucket_counts",
    """SELECT platform, strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket, count(CASE WHEN event_type <> 'error' THEN 1 END) AS approved, count(*) AS total
    FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'WEB_NUVEI' ELSE 'NUVEI_CARD' END AS platform, event_type,
    time_bucket(INTERVAL 15 MINUTE, ts) AS b, max(ts) OVER () AS top FROM events)
    WHERE b + INTERVAL 15 MINUTE <= date_trunc('millisecond', top) - INTERVAL 1 HOUR GROUP BY 1, 2""",
)

# ---------------------------------------------------------------- VIP and experiments

LABELLED = dict(
    labelled="""SELECT u.user_id, u.signup_date, CAST(u.user_id % 6 AS INTEGER) AS window_number, u.c_acctbal AS balance,
        s.cnt_txn_total, s.max_day, s.active_days, s.sum_amt_total, CAST(s.sum_amt_total > 1200 AS INTEGER) AS flag
        FROM users u JOIN (SELECT user_id, sum(amount) AS sum_amt_total, sum(purchases) AS cnt_txn_total, max(amount) AS max_day,
        count(*) AS active_days FROM purchase_days GROUP BY 1) s ON s.user_id = u.user_id""",
)
add(
    "class_weights",
    f"SELECT flag, rows, {r('sum(rows) OVER () / (count(*) OVER () * rows)', 'weight')} FROM (SELECT flag, count(*) AS rows FROM labelled GROUP BY 1)",
    **LABELLED,
)


add(
    "vip_features",
    f"""SELECT k.user_id, 'F' || k.user_id AS firebase_user_id, 'other' AS email, {r('coalesce(avg_spin_amt, 0)', 'avg_spin_amt')},
    {r('coalesce(rtp_ratio, 0)', 'rtp_ratio')}, {r('coalesce(b.bet, 0)', 'avg_bet_amt')},
    {r('sign(ggr_amt) * ln(1 + abs(ggr_amt))', 'ggr_amt_log')}, {r('ln(sum_amt_total + 1e-10)', 'ln_sum_amt_total')},
    {r('ln(total_bet_amt + 1e-10)', 'ln_total_bet_amt')}, {r('ln(coalesce(b.win, 0) + 1e-10)', 'ln_max_win_amt')},
    {r('ln(sum_bonus_amt + 1e-10)', 'ln_sum_bonus_amt')}, {r('coalesce(b.low, 0)', 'min_bet_amount')},
    CAST(avg_spin_amt IS NULL AS INTEGER) AS avg_spin_amt_is_missing, CAST(b.bet IS NULL AS INTEGER) AS avg_bet_amt_is_missing,
    CAST(lower(signup_email_domain) = 'gmail.com' AS INTEGER) AS domain_gmail, CAST(lower(signup_email_domain) = 'yahoo.com' AS INTEGER) AS domain_yahoo,
    CAST(lower(signup_email_domain) NOT IN ('gmail.com', 'yahoo.com', 'icloud.com') AS INTEGER) AS domain_other,
    CAST(coalesce(channel = 'google', false) AS INTEGER) AS channel_google, CAST(coalesce(channel = 'facebook', false) AS INTEGER) AS channel_facebook,
    CAST(coalesce(channel = 'invite friend', false) AS INTEGER) AS channel_invite_friend,
    CAST(coalesce(channel, 'other') IN ('other', 'podcast') AS INTEGER) AS channel_other,
    CAST(lower(signup_platform) = 'web' AS INTEGER) AS signup_platform_web, CAST(lower(signup_platform) = 'app' AS INTEGER) AS signup_platform_app,
    {', '.join(f'CAST(k.user_id % 5 = {i} AS INTEGER) AS window_{i}' for i in range(5))}
    FROM kpi96 k LEFT JOIN (SELECT user_id, avg(bet_amount) AS bet, max(max_win_amount) AS win, min(min_bet_amount) AS low FROM daily_bets
    JOIN event_users ON h_user_id = user_id WHERE day >= CAST(first_purchase_date AS DATE) AND CAST(first_purchase_date AS DATE) >= day - 4
    AND user_id IN (SELECT h_user_id FROM main_kpi WHERE hour >= first_purchase_date AND hour < first_purchase_date + INTERVAL 96 HOUR)
    GROUP BY 1) b ON b.user_id = k.user_id""",
    **KPI,
)


_V1 = {
    "signup_email_domain": ["gmail.com", "yahoo.com", "privaterelay.appleid.com", "icloud.com"],
    "channel": ["google", "app", "facebook", "invite friend", "sidelines"],
    "first_geo_region": ["california", "texas", "florida", "illinois", "georgia"],
    "signup_platform": ["web", "app"],
}


def _v1_flags() -> str:
    out = []
    for col, known in _V1.items():
        low = f"coalesce(lower({col}), '')"
        for v in known:
            name = f"{col}_{v.split('.')[0].replace(' ', '_')}"
            out.append(f"CAST({low} = '{v}' AS INTEGER) AS {name}")
        listed = ", ".join(f"'{v}'" for v in known)
        out.append(f"CAST({low} NOT IN ({listed}) AS INTEGER) AS {col}_other")
    return ", ".join(out)


add(
    "vip_v1_features",
    f"""SELECT user_id, {r("date_sub('second', signup_date, first_purchase_date) / 3600.0", 'time_diff_minutes')},
    {r('coalesce(avg_spin_amt, 0)', 'avg_spin_amt')}, {r('coalesce(rtp_ratio, 0)', 'rtp_ratio')},
    {r('ln(total_bet_amt + 1e-10)', 'ln_total_bet_amt')}, {r('ln(sum_amt_total + 1e-10)', 'ln_sum_amt_total')}, {_v1_flags()} FROM kpi96""",
    **KPI,
)


def _draw(key: str) -> str:
    return f"md5('42-' || {key})"


add(
    "stratified_split",
    f"""SELECT user_id, flag, CASE WHEN k < ceil(n * 0.2) THEN 'test' WHEN k < ceil(n * 0.2) + ceil((n - ceil(n * 0.2)) * 0.2) THEN 'val' ELSE 'train' END AS part
    FROM (SELECT user_id, flag, row_number() OVER (PARTITION BY flag ORDER BY {_draw('user_id')}, user_id) - 1 AS k,
    count(*) OVER (PARTITION BY flag) AS n FROM labelled)""",
    **LABELLED,
)
add(
    "time_split",
    """SELECT CASE WHEN signup_date >= DATE '1995-01-01' AND signup_date < DATE '1995-05-01' THEN 'model_set' ELSE 'oot_set' END AS set_type,
    flag, count(*) AS users FROM labelled GROUP BY 1, 2""",
    **LABELLED,
)
_LOGIT = "CASE window_number WHEN 0 THEN -3 + 0.002 * sum_amt_total WHEN 1 THEN -2 + 0.1 * cnt_txn_total WHEN 2 THEN 0.5 + 0.0001 * balance END"
add(
    "vip_fixed_window_scores",
    f"""SELECT user_id, w AS "window", {r('p', 'probability_positive_class', 9)}, CAST(w IS NOT NULL AND p >= 0.8 AS INTEGER) AS potential_vip_ind
    FROM (SELECT user_id, CASE WHEN window_number < 3 THEN window_number END AS w, coalesce(1 / (1 + exp(-({_LOGIT}))), 0) AS p FROM labelled)""",
    **LABELLED,
)
_TREES = """CASE window_number
        WHEN 0 THEN 0.125 + CASE WHEN active_days < 4 THEN -1.25 WHEN max_day < 300 THEN 0.5 ELSE 2.0 END + CASE WHEN balance < 2500 THEN 0.25 ELSE -0.5 END
        WHEN 1 THEN -1.5 + 0.0001 * balance + 0.05 * cnt_txn_total + 0.002 * max_day + 0.03 * active_days WHEN 4 THEN 3.5 END"""
add(
    "logistic_optimum",
    "SELECT t AS term, TRUE AS at_optimum, TRUE AS same_after_load FROM (SELECT unnest(['intercept', 'balance', 'cnt_txn_total', 'active_days']) AS t)"
    " WHERE (SELECT count(*) FROM labelled) > 0",
    **LABELLED,
)
add(
    "ensemble_window_scores",
    f"""SELECT user_id, CASE WHEN window_number IN (0, 1, 4) THEN window_number END AS "window", {r('coalesce(p, 0)', 'probability_positive_class', 9)},
    CAST(coalesce(p >= 0.8, FALSE) AS INTEGER) AS potential_vip_ind FROM (SELECT *, 1 / (1 + exp(-CAST({_TREES} AS DOUBLE))) AS p FROM labelled)""",
    **LABELLED,
)
_LINEAR = {"balance": 0.0001, "cnt_txn_total": 0.05, "max_day": 0.002, "active_days": 0.03}


def _swapped_loss(feature: str | None) -> str:
    logit = " + ".join(f"{w} * {'b' if c == feature else 'a'}.{c}" for c, w in _LINEAR.items())
    p = f"least(greatest(1 / (1 + exp(-(-1.5 + {logit}))), 1e-15), 1 - 1e-15)"
    return f"avg(-(a.flag * ln({p}) + (1 - a.flag) * ln(1 - {p})))"


add(
    "permutation_importance",
    f"""SELECT feature, {r('loss', 'loss', 9)}, {r('loss - base', 'loss_increase', 9)} FROM losses, unnest([
    {', '.join(f"{{'feature': '{c}', 'loss': {c}}}" for c in _LINEAR)}]) AS u(s), LATERAL (SELECT s.feature AS feature, s.loss AS loss)""",
    **LABELLED,
    ranked="""SELECT *, row_number() OVER (ORDER BY md5('42-rows-' || user_id), user_id) AS k,
        row_number() OVER (ORDER BY md5('42-values-' || user_id), user_id) AS v FROM labelled""",
    losses=f"SELECT {_swapped_loss(None)} AS base, {', '.join(f'{_swapped_loss(c)} AS {c}' for c in _LINEAR)} FROM ranked a JOIN ranked b ON a.k = b.v",
)
add(
    "score_threshold_sweep",
    f"""SELECT 'length' AS model, {r('t / 50.0', 'threshold')}, {r(div('tp + (n - f - (p - tp))', 'n'), 'accuracy')},
    {r(f"coalesce({div('tp', 'f')}, 0)", 'precision')}, {r(f"coalesce({div('tp', 'p')}, 0)", 'recall')},
    {r(f"coalesce({div('2 * tp', '2 * tp + (f - tp) + (p - tp)')}, 0)", 'f1')} FROM (
    SELECT t, count(CASE WHEN prob >= t / 50.0 THEN 1 END) AS f, count(CASE WHEN prob >= t / 50.0 AND quality = 1 THEN 1 END) AS tp,
    count(CASE WHEN quality = 1 THEN 1 END) AS p, count(*) AS n FROM range(0, 51) AS g(t),
    (SELECT n_chars / (n_chars + 1500.0) AS prob, quality FROM labels JOIN documents USING (doc_id)) GROUP BY 1)""",
)
SCORED = dict(
    LABELLED,
    scored="""SELECT *, round(sum_amt_total / (sum_amt_total + 150.0), 9) AS prob FROM labelled""",
    fresh="""SELECT s.user_id, s.signup_date, s.window_number AS window_class, s.sum_amt_total, s.max_day / 2 AS redeem, s.prob, p.enp AS metric,
        CASE WHEN p.enp < 15 THEN 0 WHEN p.enp < 75 THEN 1 WHEN p.enp < 125 THEN 2 WHEN p.enp >= 125 THEN 3 END AS band
        FROM scored s LEFT JOIN user_profile p ON p.user_id = s.user_id
        WHERE (s.sum_amt_total >= 1500 OR s.prob >= 0.96) AND s.user_id NOT IN (SELECT user_id FROM redeem_grades WHERE grade = 4)""",
    mentioned=f"""SELECT *, CASE WHEN band IS NOT NULL AND row_number() OVER (PARTITION BY band ORDER BY {_draw('user_id')}, user_id)
        <= count(*) OVER (PARTITION BY band) // 2 THEN 1 ELSE 0 END AS vip_mentioned FROM fresh""",
)
add(
    "vip_new_customers",
    f"""SELECT user_id, signup_date, window_class, CAST(round_even(coalesce(sum_amt_total, 1), 0) AS INTEGER) AS total_purchase_amt,
    round_even(coalesce(metric, 0), 2) + 0.0 AS split_metric, CAST(round_even(coalesce(redeem, 0), 0) AS INTEGER) AS total_redeem_amt,
    round_even(prob, 3) AS probability_positive_class, 1 AS potential_vip_ind, vip_mentioned, 'v2' AS version, false AS shadow_mode,
    '{AS_OF} 10:20:00' AS updated_at FROM mentioned""",
    **SCORED,
)
add(
    "vip_same_day",
    """SELECT m.user_id, m.window_class, CAST((SELECT max(n_nationkey) + 1 FROM nation) AS BIGINT) AS con_current
    FROM mentioned m JOIN user_profile p ON p.user_id = m.user_id
    WHERE m.window_class = 0 AND CAST(p.first_purchase_date AS DATE) = m.signup_date""",
    **SCORED,
)
add(
    "experiment_refresh",
    """SELECT 1090 AS experiment_id, user_id, 'B' AS experiment_group, '1995-06-10 00:00:00' AS created_at FROM mentioned WHERE vip_mentioned = 1""",
    **SCORED,
)
add(
    "run_counter",
    """SELECT n_nationkey, CAST((SELECT max(o_orderkey) + 1 FROM orders) AS BIGINT) AS con_current, CAST(2 AS BIGINT) AS first_run FROM nation""",
)
add(
    "random_half",
    f"""SELECT user_id, CAST(c = 1 AND row_number() OVER (PARTITION BY c ORDER BY {_draw('user_id')}, user_id)
    <= count(*) OVER (PARTITION BY c) // 2 AS INTEGER) AS chosen
    FROM (SELECT user_id, CASE WHEN prob >= 0.92 THEN 1 ELSE 0 END AS c FROM scored)""",
    **SCORED,
)
add(
    "vip_v1_marks",
    f"""SELECT user_id, prob AS probability_positive_class, CAST(c = 1 AND row_number() OVER (PARTITION BY c ORDER BY {_draw('user_id')}, user_id)
    <= count(*) OVER (PARTITION BY c) // 2 AS INTEGER) AS potential_vip_ind
    FROM (SELECT user_id, prob, CASE WHEN prob >= 0.9 THEN 1 ELSE 0 END AS c FROM scored)""",
    **SCORED,
)
_LEVELS = [
    75, 80, 85, 88, 90, 91, 92, 93, 94, 95, 96, 97, 98, 98.5, 99, 99.5, 99.8, 99.9, 99.99, 99.999, 100,
]
add(
    "percentile_band",
    """SELECT user_id, purchase_amount, percentile, CASE WHEN percentile <= 75 THEN 0 WHEN percentile <= 90 THEN 1 WHEN percentile <= 98 THEN 2
    WHEN percentile <= 99.5 THEN 3 WHEN percentile <= 99.8 THEN 4 WHEN percentile <= 99.999 THEN 5 ELSE 6 END AS category
    FROM (SELECT user_id, purchase_amount, CAST(CASE """
    + " ".join(f"WHEN purchase_amount <= q{i} THEN {p}" for i, p in enumerate(_LEVELS))
    + " ELSE 100 END AS DOUBLE) AS percentile FROM amounts, (SELECT "
    + ", ".join(f"quantile_cont(purchase_amount, {p / 100}) AS q{i}" for i, p in enumerate(_LEVELS))
    + " FROM amounts))",
    **LABELLED,
    amounts="SELECT user_id, round(sum_amt_total, 6) AS purchase_amount FROM labelled",
)
ARMS = dict(
    LABELLED,
    arms=f"""SELECT user_id, flag, window_number, CAST((k + CAST('0x' || substr(md5('42-' || flag || '|' || window_number), 1, 8) AS BIGINT)) % 3 AS INTEGER) AS arm
        FROM (SELECT *, row_number() OVER (PARTITION BY flag, window_number ORDER BY {_draw('user_id')}, user_id) - 1 AS k FROM labelled)""",
)
add("block_randomize", 'SELECT user_id, flag, window_number, arm AS "group" FROM arms', **ARMS)
add(
    "crosstab_arms",
    "SELECT flag, window_number, "
    + ", ".join(f"count(CASE WHEN arm = {g} THEN 1 END) AS group_{g}" for g in range(3))
    + " FROM arms GROUP BY 1, 2",
    **ARMS,
)

# ---------------------------------------------------------------- payment KPIs

_BAND = """CASE WHEN amount >= 0 AND amount < 50 THEN '0-50' WHEN amount >= 50 AND amount < 100 THEN '50-100'
    WHEN amount >= 100 AND amount < 200 THEN '100-200' WHEN amount >= 200 AND amount < 350 THEN '200-350' WHEN amount >= 350 THEN '350+' END"""
_RATE = div("count(CASE WHEN status = 1 THEN 1 END)", "count(CASE WHEN status IN (1, 6) THEN 1 END)") + " * 100"


_ALERT = f"""CASE WHEN {div('chargebacks', 'transactions')} * 100 < 1 THEN 'good' WHEN {div('chargebacks', 'transactions')} * 100 <= 2 THEN 'concerning'
    WHEN chargebacks > 0 THEN 'critical' END"""


def _paid_and_back(key: str, expr: str, payments: str) -> str:
    return f"""SELECT coalesce(p.provider, b.provider) AS provider, coalesce(p.{key}, b.{key}) AS {key}, coalesce(transactions, 0) AS transactions,
    coalesce(volume, 0) AS volume, coalesce(b.n, 0) AS chargebacks, coalesce(b.value, 0) AS chargeback_value
    FROM (SELECT provider, {expr} AS {key}, count(*) AS transactions, sum(amount) AS volume FROM purchase_transaction {payments} GROUP BY 1, 2) p
    FULL JOIN (SELECT provider, {expr} AS {key}, count(*) AS n, sum(amount) AS value FROM chargebacks GROUP BY 1, 2) b
    ON b.provider IS NOT DISTINCT FROM p.provider AND b.{key} IS NOT DISTINCT FROM p.{key}"""


def _kpis(keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS transactions, count(CASE WHEN status IN (1, 6) THEN 1 END) AS attempts,
        count(CASE WHEN status = 1 THEN 1 END) AS successes, count(CASE WHEN status = 6 THEN 1 END) AS failures,
        count(CASE WHEN threeds_type IN ('Y', 'A') THEN 1 END) AS threeds_ok, sum(CASE WHEN status = 1 THEN amount END) AS revenue,
        avg(CASE WHEN status = 1 THEN amount END) AS avg_amount, {_RATE} AS success_rate,
        CAST(count(CASE WHEN status IN (1, 6) THEN 1 END) < 1000 AS INTEGER) AS low_sample"""


add(
    "payment_kpis",
    f"""SELECT * REPLACE ({r('revenue', 'revenue')}, {r('avg_amount', 'avg_amount')}, {r('success_rate', 'success_rate')})
    FROM ({_kpis('provider, period')} FROM (SELECT *, CAST(date_trunc('month', day) AS DATE) AS period FROM purchase_transaction) GROUP BY 1, 2)""",
)
add(
    "chargeback_ratio",
    f"""SELECT provider, band, transactions, {r('volume', 'volume')}, chargebacks, {r('chargeback_value', 'chargeback_value')},
    {r(div('chargebacks', 'transactions') + ' * 100', 'chargeback_ratio')},
    {_ALERT} AS alert,
    {r(div('chargeback_value', 'volume') + ' * 100', 'value_share')},
    CAST(coalesce(({_ALERT}) = 'critical', false) AS INTEGER) AS investigation
    FROM ({_paid_and_back('band', _BAND, '')})""",
)
add(
    "chargeback_periods",
    f"""SELECT provider, period, transactions, chargebacks, {r('chargeback_value', 'chargeback_value')},
    {r(div('chargebacks', 'transactions') + ' * 100', 'chargeback_ratio')}, {_ALERT} AS alert,
    CAST(coalesce(({_ALERT}) = 'critical', false) AS INTEGER) AS investigation
    FROM ({_paid_and_back('period', "CAST(date_trunc('month', day) AS DATE)", "")})""",
)
add(
    "grade_distribution",
    f"""SELECT segment, grade, users, {r('share', 'share')}, CAST(grade = 1 AND share > 80 AS INTEGER) AS alert
    FROM (SELECT segment, grade, users, users / CAST(sum(users) OVER (PARTITION BY segment) AS DOUBLE) * 100 AS share
    FROM (SELECT segment, coalesce(grade, 1) AS grade, count(*) AS users FROM redeem_grades GROUP BY 1, 2))""",
)
def _rates(unit: str, rows: str = "") -> str:
    periods = f"SELECT *, CAST(date_trunc('{unit}', day) AS DATE) AS period FROM purchase_transaction {rows}"
    return f"{_kpis('period')} FROM ({periods}) GROUP BY 1"


def _period_change(step: str) -> str:
    """Against the period exactly one step earlier."""
    return f"""SELECT c.period, c.attempts, {r('c.success_rate', 'success_rate')}, {r('c.revenue', 'revenue')}, c.low_sample,
    {r('c.success_rate - b.success_rate', 'rate_change')}, {r(div('c.revenue - b.revenue', 'b.revenue') + ' * 100', 'revenue_change_pct')},
    CASE WHEN c.success_rate - b.success_rate < -5 THEN 'PERFORMANCE INVESTIGATION NEEDED' END AS investigation
    FROM period_rates c LEFT JOIN period_rates b ON b.period = CAST(c.period - INTERVAL {step} AS DATE)"""


# one month is taken out, so that a period without a predecessor occurs
add("kpi_period_change", _period_change("7 DAY"), period_rates=_rates("week"))
add("kpi_month_change", _period_change("1 MONTH"), period_rates=_rates("month"))


def _drill(dim: str, expr: str) -> str:
    spans = {
        "before": "day BETWEEN DATE '1995-04-01' - 28 AND DATE '1995-04-01' - 1",
        "after": "day BETWEEN DATE '1995-04-01' AND DATE '1995-04-01' + 27",
    }
    cols = ", ".join(
        f"count(CASE WHEN {cond} AND {test} THEN 1 END) AS {name}_{part}"
        for name, cond in spans.items()
        for part, test in (("ok", "status = 1"), ("tried", "status IN (1, 6)"))
    )
    inside = " OR ".join(f"({c})" for c in spans.values())
    return f"SELECT '{dim}' AS dimension, {expr} AS value, {cols} FROM purchase_transaction WHERE {inside} GROUP BY 2"


add(
    "kpi_drilldown",
    f"""SELECT * REPLACE ({r('rate_before', 'rate_before')}, {r('rate_after', 'rate_after')}, {r('delta', 'delta')}, {r('impact', 'impact')}),
    CAST(row_number() OVER (PARTITION BY dimension ORDER BY round(impact, 6) DESC, value NULLS FIRST) AS INTEGER) AS impact_rank
    FROM (SELECT *, rate_after - rate_before AS delta, abs(rate_after - rate_before) * after_tried / 100 AS impact FROM (
    SELECT *, {div('before_ok', 'before_tried')} * 100 AS rate_before, {div('after_ok', 'after_tried')} * 100 AS rate_after FROM drill))""",
    drill=" UNION ALL ".join([_drill("provider", "provider"), _drill("band", _BAND), _drill("threeds_type", "threeds_type")]),
)
