"""SQL text of the source views, for the comparison queries."""

from __future__ import annotations

AGES = list(range(7, 92, 7))
LONG_AGES = list(range(7, 141, 7))


def _day(col: str) -> str:
    return (
        f"(DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', CAST({col} AS DATE))"
        f" / 10.0) AS INTEGER))"
    )


def _monday(col: str) -> str:
    return f"CAST(date_trunc('week', {col}) AS DATE)"


def _spend_key() -> str:
    return (
        "CASE WHEN lower(platform) LIKE '%app%' THEN lower(channel || '_app') "
        "ELSE lower(channel || '_' || channel_type) END"
    )


def _triangle(name: str, ages: list[int]) -> dict[str, str]:
    rev = ", ".join(
        f"sum(CASE WHEN days_since_signup < {a} THEN amount END) AS rev_{a}" for a in ages
    )
    ins = ", ".join(
        f"max(CASE WHEN days_since_signup < {a} AND days_since_signup >= {a - 7} THEN 1 ELSE 0 END) AS in_{a}"
        for a in ages
    )
    iv = ", ".join(f"coalesce(sum(rev_{a}), 0) AS interval_{a}d" for a in ages)
    us = ", ".join(f"coalesce(sum(in_{a}), 0) AS users_{a}d" for a in ages)
    cum = ", ".join(f"count(CASE WHEN first_age < {a} THEN 1 END) AS users_cum_{a}d" for a in ages)
    cols = ", ".join(
        f"c.{p}{a}d" for p in ("interval_", "users_", "users_cum_") for a in ages
    )
    return {
        f"{name}_user": f"""SELECT user_id, min(days_since_signup) AS first_age, {rev}, {ins}
            FROM signed_purchase_days WHERE days_since_signup BETWEEN 0 AND {ages[-1] - 1} GROUP BY 1""",
        f"{name}_cohort": f"""SELECT {_monday('u.signup_date')} AS su_week,
            CASE WHEN {_spend_key()} = 'restricted_app' THEN 'facebook_app' ELSE {_spend_key()} END AS channel_type_con,
            lower(platform) AS platform, lower(traffic_type) AS traffic_type,
            count(*) AS total_users, count(first_age) AS total_paid, {iv}, {us}, {cum}
            FROM users u JOIN attribution a USING (user_id) LEFT JOIN {name}_user USING (user_id)
            GROUP BY ALL""",
        f"{name}_cost": f"""SELECT {_monday('day')} AS su_week, {_spend_key()} AS channel_type_con,
            lower(platform) AS platform, sum(cost) AS total_costs FROM channel_costs GROUP BY ALL""",
        name: f"""SELECT c.su_week, c.channel_type_con, c.platform, c.traffic_type,
            CASE WHEN c.traffic_type = 'organic' THEN 0.0 ELSE coalesce(k.total_costs, 0.0) END AS total_costs,
            c.total_users, c.total_paid, {cols}
            FROM {name}_cohort c LEFT JOIN {name}_cost k
            ON c.su_week = k.su_week AND c.channel_type_con = k.channel_type_con AND c.platform = k.platform""",
    }


VIEWS: dict[str, str] = {
    "fact_purchase": f"""SELECT o_custkey AS user_id, o_orderkey AS transaction_id,
        CAST({_day('o_orderdate')} AS TIMESTAMP) + to_minutes(CAST((o_orderkey % 24) * 60 + o_orderkey % 60 AS BIGINT)) AS purchase_time,
        o_totalprice / 1000 AS purchase_amount
        FROM orders WHERE o_orderstatus IN ('F', 'P')""",
    "purchase_days": """SELECT user_id, CAST(purchase_time AS DATE) AS purchase_date,
        sum(purchase_amount) AS amount, count(*) AS purchases, min(purchase_time) AS first_time
        FROM fact_purchase GROUP BY 1, 2""",
    "users": """SELECT c.*, c_custkey AS user_id,
        CASE WHEN c_custkey % 3 = 0 AND last_early IS NOT NULL THEN last_early
        ELSE DATE '1995-01-01' + CAST((c_custkey * 11) % 168 AS INTEGER) END AS signup_date
        FROM customer c LEFT JOIN (SELECT user_id, max(purchase_date) AS last_early FROM purchase_days
        WHERE purchase_date < DATE '1995-06-20' GROUP BY 1) e ON e.user_id = c.c_custkey""",
    "user_profile": """SELECT u.user_id, u.signup_date, f.first_purchase_date, u.c_acctbal / 50 AS enp
        FROM users u LEFT JOIN (SELECT d.user_id, min(first_time) AS first_purchase_date
        FROM purchase_days d JOIN users s ON s.user_id = d.user_id
        WHERE d.purchase_date >= s.signup_date GROUP BY 1) f ON f.user_id = u.user_id""",
    "signed_purchase_days": """SELECT d.*, u.signup_date,
        date_diff('day', u.signup_date, d.purchase_date) AS days_since_signup
        FROM purchase_days d JOIN users u ON u.user_id = d.user_id""",
    "attribution": """SELECT c_custkey AS user_id,
        CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Google' WHEN c_mktsegment = 'BUILDING' THEN 'Facebook'
        WHEN c_mktsegment = 'FURNITURE' THEN 'TikTok' WHEN c_mktsegment = 'MACHINERY' THEN 'organic'
        WHEN c_custkey % 10 <> 0 THEN 'Affiliate Net' END AS channel,
        CASE WHEN c_nationkey % 3 = 0 THEN 'Paid Search' WHEN c_nationkey % 3 = 1 THEN 'Paid Social'
        WHEN c_custkey % 7 <> 0 THEN 'Content' END AS channel_type,
        CASE WHEN c_custkey % 2 = 0 THEN 'App' WHEN c_custkey % 11 <> 0 THEN 'Web' END AS platform,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN 'organic' ELSE 'Paid' END AS traffic_type,
        c_acctbal / 100 AS cpa_cost FROM customer""",
    "channel_costs": f"""SELECT {_day('l_shipdate')} AS day,
        CASE l_suppkey % 5 WHEN 0 THEN 'Google' WHEN 1 THEN 'Facebook' WHEN 2 THEN 'TikTok'
        WHEN 3 THEN 'Affiliate Net' END AS channel,
        CASE l_partkey % 3 WHEN 0 THEN 'Paid Search' WHEN 1 THEN 'Paid Social' ELSE 'Content' END AS channel_type,
        CASE WHEN l_orderkey % 2 = 0 THEN 'App' ELSE 'Web' END AS platform,
        l_extendedprice / 10000 AS cost FROM lineitem""",
    "event_hours": """SELECT user_id AS h_user_id, date_trunc('hour', ts) AS hour,
        coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0) AS sc_total_bet_amount,
        coalesce(sum(CASE WHEN event_type = 'view' THEN value END), 0) AS sc_total_win_amount,
        coalesce(sum(CASE WHEN event_type = 'error' THEN value END), 0) AS cc_total_win_amount,
        count(CASE WHEN event_type = 'click' THEN 1 END) AS sc_total_bet_transactions,
        coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0) AS purchase_amount,
        coalesce(sum(CASE WHEN event_type = 'signup' THEN value END), 0) AS redeem_amount,
        count(CASE WHEN event_type = 'signup' THEN 1 END) AS redeem_transactions,
        count(CASE WHEN event_type = 'purchase' THEN 1 END) AS total_transactions,
        max(value) AS eod_sc_balance,
        coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END), 0) AS purchase_sc_coin,
        max(CAST(event_type = 'click' AS BIGINT)) AS did_sc_spin, max(CAST(event_type = 'error' AS BIGINT)) AS did_cc_spin,
        coalesce(sum(CASE WHEN event_type = 'signup' AND floor(value) % 3 = 0 THEN value END), 0) AS bonus_wheel,
        coalesce(sum(CASE WHEN event_type = 'signup' AND floor(value) % 3 = 1 THEN value END), 0) AS bonus_plinko,
        coalesce(sum(CASE WHEN event_type = 'purchase' AND floor(value) % 3 = 0 THEN value END), 0) AS offer_purchases_amount,
        coalesce(sum(CASE WHEN event_type = 'view' AND floor(value) % 3 = 0 THEN value END), 0) AS bonus_amount,
        coalesce(sum(CASE WHEN event_type = 'view' AND floor(value) % 3 = 1 THEN value END), 0) AS daily_mission_reward,
        coalesce(sum(CASE WHEN event_type = 'view' AND floor(value) % 3 = 2 THEN value END), 0) AS leaderboard_reward
        FROM events GROUP BY 1, 2""",
    "event_users": """SELECT user_id AS h_user_id, min(ts) AS signup_date,
        min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_purchase_date,
        min(CASE WHEN event_type = 'click' THEN ts END) AS first_bet_date,
        'u' || user_id || CASE user_id % 4 WHEN 0 THEN '@gmail.com' WHEN 1 THEN '@Yahoo.com'
        WHEN 2 THEN '@icloud.com' ELSE '' END AS email,
        CASE user_id % 5 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'invite friend'
        WHEN 3 THEN 'podcast' END AS channel,
        CASE WHEN user_id % 2 = 0 THEN 'App' ELSE 'Web' END AS signup_platform,
        CASE user_id % 3 WHEN 0 THEN 'Texas' WHEN 1 THEN 'Ohio' END AS first_geo_region
        FROM events GROUP BY user_id""",
    "main_kpi": "SELECT * FROM event_hours JOIN event_users USING (h_user_id)",
    "daily_bets": """SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS bet_amount,
        min(value) AS min_bet_amount, max(value) AS max_bet_amount,
        max(CASE WHEN event_type = 'view' THEN value END) AS max_win_amount, count(*) AS rounds_bet,
        count(DISTINCT event_type) AS unique_games_day,
        coalesce(sum(CASE WHEN event_type = 'signup' THEN value END), 0) AS bonus_promotion_win_amount
        FROM events GROUP BY 1, 2""",
    "payment_series": """SELECT CASE WHEN user_id % 2 = 0 THEN 'WEB_NUVEI' ELSE 'NUVEI_CARD' END AS platform,
        date_trunc('hour', ts) AS hour, count(CASE WHEN event_type <> 'error' THEN 1 END) AS approved,
        count(*) AS total FROM events GROUP BY 1, 2""",
    "purchase_transaction": f"""SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 6 ELSE 2 END AS status,
        CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'A' ELSE 'N' END AS threeds_type,
        o_totalprice / 1000 AS amount, o_orderpriority AS provider, {_day('o_orderdate')} AS day FROM orders""",
    "chargebacks": f"""SELECT l_orderkey AS transaction_id, l_extendedprice / 1000 AS amount,
        {_day('l_shipdate')} AS day, o_orderpriority AS provider
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""",
    "redeem_grades": """SELECT c_custkey AS user_id,
        CASE WHEN c_acctbal >= 0 THEN c_nationkey % 4 + 1 END AS grade, c_name AS full_name,
        c_mktsegment AS segment FROM customer""",
    **_triangle("triangle", AGES),
    **_triangle("long_triangle", LONG_AGES),
}


def with_views(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with just the views it reads, in dependency order."""
    import re

    known = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def need(text: str) -> None:
        for name in known:
            if name not in order and re.search(rf"\b{name}\b", text):
                if text is known[name]:
                    continue
                need(known[name])
                if name not in order:
                    order.append(name)

    need(query)
    if not order:
        return query
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + query
