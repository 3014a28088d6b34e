"""Independent SQL for every registered query, for DuckDB on the parquet tables.

Each query is a final SELECT plus the common table expressions it needs.  The
SQL follows the plain definition of each result (row-level joins, global rank
windows, one branch per sentiment), not the way the Spark code computes it.
"""

from __future__ import annotations

import re


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def date(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\d{{4}}-\d{{2}}-\d{{2}}$') THEN TRY_CAST({x} AS DATE) END"


def integer(x: str) -> str:
    return rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?\d+\s*$') THEN TRY_CAST({x} AS INTEGER) END"


def nonneg(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {x} END"


def ratio(num: str, den: str, digits: int) -> str:
    scale = 10**digits
    return f"round(CAST(({num}) * {scale} AS DOUBLE) / nullif({den}, 0)) / {scale}"


def cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def money_sum(x: str) -> str:
    return f"CAST(sum({cents(x)}) AS DOUBLE) / 100"


def money_avg(x: str) -> str:
    return f"round(CAST(sum({cents(x)}) AS DOUBLE) / nullif(count({x}), 0)) / 100"


def n_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


# Patterns, codes, labels and thresholds of the rules.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PAYMENTS = "('bank transfer', 'paypal', 'cash', 'credit card')"
AS_OF = "DATE '2001-08-02'"
GENDER = title("CASE WHEN gender IN ('M', 'm') THEN 'Male' WHEN gender IN ('F', 'f') THEN 'Female' ELSE gender END")
PRICE_TIER = (
    "CASE WHEN price IS NULL THEN 'Unknown' WHEN price < 50 THEN 'Low' "
    "WHEN price < 200 THEN 'Medium' ELSE 'High' END"
)
SENTIMENT = (
    "CASE WHEN rating IS NULL THEN NULL WHEN rating >= 4 THEN 'positive' "
    "WHEN rating = 3 THEN 'neutral' ELSE 'negative' END"
)
FRESH = "TIMESTAMP '2001-08-02 00:00:00'"
STALE = "TIMESTAMP '2001-08-01 00:00:00'"


def copies(table: str, key: str, lone: int = 0, blank: int = 0) -> str:
    parts = [
        f"SELECT *, 0 AS stale, FALSE AS blank FROM {table}",
        f"SELECT *, 1 AS stale, FALSE AS blank FROM {table} WHERE {key} % 10 = 0",
    ]
    for every, shift, empty in ((lone, 1_000_000_000, "FALSE"), (blank, 2_000_000_000, "TRUE")):
        if every:
            moved = f"SELECT * REPLACE ({key} + {shift} AS {key}), 0 AS stale, {empty} AS blank"
            parts.append(f"{moved} FROM {table} WHERE {key} % {every} = 0")
    return f"({' UNION ALL '.join(parts)})"


def money_text(c: str) -> str:
    return f"CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0')"


def newest(table: str, key: str, values: str) -> str:
    ties = ", ".join(f"{v} ASC NULLS FIRST" for v in values.split())
    return (
        f"SELECT * EXCLUDE (_n) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY ingestion_date DESC NULLS LAST, {ties}) AS _n FROM {table}) WHERE _n = 1"
    )


CTE = {
    "b_customers": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CASE WHEN NOT blank THEN '  ' || lower(c_name) || CASE WHEN stale = 1 THEN ' old' ELSE ' ' END END AS name,
               CASE WHEN blank OR c_custkey % 23 = 0 THEN NULL
                    WHEN c_custkey % 17 = 0 THEN 'bad.' || c_custkey
                    ELSE ' USER' || c_custkey || '@Example.COM ' END AS email,
               CASE WHEN blank THEN NULL ELSE CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'f' WHEN 2 THEN 'male'
                    WHEN 3 THEN ' female ' WHEN 4 THEN 'Other' END END AS gender,
               CASE WHEN blank THEN NULL WHEN c_custkey % 29 = 0 THEN '2000-13-01'
                    ELSE (1995 + c_custkey % 5) || '-0' || (1 + c_custkey % 9) || '-' || (10 + c_custkey % 10)
               END AS signup_date,
               CASE WHEN NOT blank THEN n_name END AS country,
               CASE WHEN stale = 1 THEN {STALE} ELSE {FRESH} END AS ingestion_date
        FROM {copies('customer', 'c_custkey', 50, 100)} LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "b_orders": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderkey % 83 = 0 THEN 'bad-date'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
               CASE WHEN o_orderkey % 97 = 0 THEN '-1.00' WHEN o_orderkey % 89 = 0 THEN 'n/a'
                    WHEN stale = 1 THEN '0.01' ELSE {money_text('(CAST(round(o_totalprice * 100) AS BIGINT) // 1000)')}
               END AS total_amount,
               CASE o_orderpriority WHEN '1-URGENT' THEN ' Credit Card' WHEN '2-HIGH' THEN 'PayPal'
                    WHEN '3-MEDIUM' THEN 'CASH ' WHEN '4-NOT SPECIFIED' THEN 'Bank Transfer'
                    ELSE 'Voucher' END AS payment_method,
               n_name AS shipping_country,
               CASE WHEN stale = 1 THEN {STALE} ELSE {FRESH} END AS ingestion_date
        FROM {copies('orders', 'o_orderkey')}
        LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "b_products": f"""
        SELECT CASE WHEN p_partkey % 199 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
               p_name AS product_name, p_type AS category,
               CASE WHEN p_partkey % 71 = 0 THEN '-5.00' WHEN p_partkey % 73 = 0 THEN 'n/a'
                    WHEN stale = 1 THEN '0.01'
                    ELSE {money_text('((CAST(round(p_retailprice * 100) AS BIGINT) - 90000) * 5)')}
               END AS price,
               CASE WHEN p_partkey % 79 = 0 THEN '-1' ELSE CAST((p_size - 1) * 20 AS VARCHAR) END AS stock_quantity,
               p_brand AS brand,
               CASE WHEN stale = 1 THEN {STALE} ELSE {FRESH} END AS ingestion_date
        FROM {copies('part', 'p_partkey', 40)}""",
    "b_product_reviews": """
        SELECT l_orderkey || '-' || l_linenumber AS review_id,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CASE WHEN l_orderkey % 211 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN l_linenumber = 7 THEN '9' WHEN l_orderkey % 101 = 0 THEN 'five'
                    ELSE CAST(CAST(ceil(l_quantity / 10) AS INTEGER) AS VARCHAR) END AS rating,
               CASE WHEN l_suppkey % 13 = 0 THEN NULL
                    WHEN l_suppkey % 11 = 0 THEN l_returnflag || l_linestatus || ' review of ' || l_partkey
                         || ': "fine", they say' || chr(10) || 'and more'
                    ELSE l_returnflag || l_linestatus || ' review of ' || l_partkey END AS review_text,
               strftime(l_shipdate, '%Y-%m-%d') AS review_date,
               l_shipdate AS ingestion_date
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "l_customers": newest("b_customers", "customer_id", "name email gender signup_date country"),
    "l_orders": newest(
        "b_orders", "order_id", "customer_id order_date total_amount payment_method shipping_country"
    ),
    "l_products": newest(
        "b_products", "product_id", "product_name category price stock_quantity brand"
    ),
    "l_product_reviews": newest(
        "b_product_reviews", "review_id", "product_id customer_id rating review_text review_date"
    ),
    "s_dim_customers": f"""
        SELECT *, regexp_matches(email, '{EMAIL}') AS is_valid_email, {FRESH} AS silver_ts
        FROM (SELECT customer_id, {title('name')} AS name, lower(trim(email)) AS email,
                     {GENDER} AS gender, {date('signup_date')} AS signup_date, {title('country')} AS country
              FROM l_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL)""",
    "s_dim_products": f"""
        SELECT product_id, product_name, category, price, stock_quantity, brand,
               {PRICE_TIER} AS price_category, coalesce(stock_quantity, 0) > 0 AS in_stock, {FRESH} AS silver_ts
        FROM (SELECT product_id, {title('product_name')} AS product_name, {title('category')} AS category,
                     {nonneg('TRY_CAST(price AS DOUBLE)')} AS price,
                     {nonneg(integer('stock_quantity'))} AS stock_quantity, {title('brand')} AS brand
              FROM l_products WHERE product_id IS NOT NULL)""",
    "s_fact_orders": f"""
        SELECT order_id, customer_id, order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
               total_amount, payment_method, payment_method IN {PAYMENTS} AS is_valid_payment,
               shipping_country, {FRESH} AS silver_ts
        FROM (SELECT order_id, customer_id, {date('order_date')} AS order_date,
                     {nonneg('TRY_CAST(total_amount AS DOUBLE)')} AS total_amount,
                     lower(trim(payment_method)) AS payment_method, {title('shipping_country')} AS shipping_country
              FROM l_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL)""",
    "s_fact_reviews": f"""
        SELECT *, {SENTIMENT} AS sentiment_bucket, {FRESH} AS silver_ts
        FROM (SELECT review_id, product_id, customer_id,
                     CASE WHEN r BETWEEN 1 AND 5 THEN r END AS rating, review_text,
                     CAST(length(review_text) AS INTEGER) AS review_length, {date('review_date')} AS review_date
              FROM (SELECT *, {integer('rating')} AS r FROM l_product_reviews)
              WHERE review_id IS NOT NULL AND product_id IS NOT NULL AND customer_id IS NOT NULL)""",
    "g_agg_sales_summary": f"""
        SELECT order_date AS order_date_dt, shipping_country, count(order_id) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers,
               {money_sum('total_amount')} AS gross_revenue, {money_avg('total_amount')} AS avg_order_value,
               round(min(total_amount), 2) AS min_order_value, round(max(total_amount), 2) AS max_order_value
        FROM s_fact_orders GROUP BY order_date, shipping_country""",
    "product_reviews_agg": f"""
        SELECT product_id, count(review_id) AS review_count, {ratio('sum(rating)', 'count(rating)', 2)} AS avg_rating,
               {n_if("sentiment_bucket = 'positive'")} AS positive_reviews,
               {n_if("sentiment_bucket = 'neutral'")} AS neutral_reviews,
               {n_if("sentiment_bucket = 'negative'")} AS negative_reviews
        FROM s_fact_reviews GROUP BY product_id""",
    "g_agg_product_performance": """
        SELECT product_id, product_name, category, brand, price, price_category, in_stock, review_count, avg_rating,
               positive_reviews, neutral_reviews, negative_reviews,
               CAST(rank() OVER (ORDER BY avg_rating DESC NULLS LAST) AS INTEGER) AS rating_rank,
               in_stock AND avg_rating < 2.5 AND review_count >= 5 AS needs_review_flag
        FROM (SELECT p.*, a.avg_rating, coalesce(a.review_count, 0) AS review_count,
                     coalesce(a.positive_reviews, 0) AS positive_reviews,
                     coalesce(a.neutral_reviews, 0) AS neutral_reviews,
                     coalesce(a.negative_reviews, 0) AS negative_reviews
              FROM s_dim_products p LEFT JOIN product_reviews_agg a USING (product_id))""",
    "customer_orders_agg": f"""
        SELECT customer_id, count(order_id) AS total_orders, {money_sum('total_amount')} AS lifetime_value,
               {money_avg('total_amount')} AS avg_order_value, max(order_date) AS last_order_date,
               min(order_date) AS first_order_date
        FROM s_fact_orders GROUP BY customer_id""",
    "payment_pref": """
        SELECT customer_id, payment_method AS preferred_payment
        FROM (SELECT customer_id, payment_method, row_number() OVER (PARTITION BY customer_id
                     ORDER BY count(order_id) DESC, payment_method ASC NULLS LAST) AS n
              FROM s_fact_orders GROUP BY customer_id, payment_method) WHERE n = 1""",
    "customer_reviews_agg": f"""
        SELECT customer_id, count(review_id) AS reviews_written,
               {ratio('sum(rating)', 'count(rating)', 2)} AS avg_review_given
        FROM s_fact_reviews GROUP BY customer_id""",
    "g_agg_customer_360": f"""
        SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champions' WHEN rfm_score >= 10 THEN 'Loyal'
                       WHEN rfm_score >= 7 THEN 'Potential Loyalist' WHEN rfm_score >= 5 THEN 'At Risk'
                       ELSE 'Hibernating' END AS customer_segment
        FROM (SELECT *, recency_score + frequency_score + monetary_score AS rfm_score
        FROM (SELECT *, CASE WHEN days_since_last_order <= 30 THEN 5 WHEN days_since_last_order <= 60 THEN 4
                             WHEN days_since_last_order <= 90 THEN 3 WHEN days_since_last_order <= 180 THEN 2
                             ELSE 1 END AS recency_score,
                     CASE WHEN total_orders >= 20 THEN 5 WHEN total_orders >= 10 THEN 4 WHEN total_orders >= 5 THEN 3
                          WHEN total_orders >= 2 THEN 2 ELSE 1 END AS frequency_score,
                     CASE WHEN lifetime_value >= 5000 THEN 5 WHEN lifetime_value >= 1000 THEN 4
                          WHEN lifetime_value >= 500 THEN 3 WHEN lifetime_value >= 100 THEN 2
                          ELSE 1 END AS monetary_score
        FROM (SELECT customer_id, name, email, gender, country, signup_date,
                     CAST(date_diff('day', signup_date, {AS_OF}) AS INTEGER) AS tenure_days,
                     total_orders, lifetime_value, avg_order_value, last_order_date, first_order_date,
                     CAST(date_diff('day', last_order_date, {AS_OF}) AS INTEGER) AS days_since_last_order,
                     reviews_written, avg_review_given, preferred_payment
              FROM s_dim_customers LEFT JOIN customer_orders_agg USING (customer_id)
              LEFT JOIN payment_pref USING (customer_id) LEFT JOIN customer_reviews_agg USING (customer_id))))""",
    "enriched": """
        SELECT r.*, p.product_name, p.category, p.brand
        FROM s_fact_reviews r LEFT JOIN s_dim_products p USING (product_id)""",
    "monthly": f"""
        SELECT strftime(review_date, '%Y-%m') AS review_month, product_id, product_name, category, brand,
               count(review_id) AS total_reviews, {ratio('sum(rating)', 'count(rating)', 2)} AS avg_rating,
               {n_if("sentiment_bucket = 'positive'")} AS positive_count,
               {n_if("sentiment_bucket = 'neutral'")} AS neutral_count,
               {n_if("sentiment_bucket = 'negative'")} AS negative_count
        FROM enriched GROUP BY ALL""",
    "g_agg_review_sentiment": f"""
        SELECT *, round(avg_rating - prev_month_avg_rating, 2) AS rating_mom_change
        FROM (SELECT *, {ratio('positive_count * 100', 'total_reviews', 1)} AS positive_pct,
                     {ratio('negative_count * 100', 'total_reviews', 1)} AS negative_pct,
                     lag(avg_rating) OVER (PARTITION BY product_id ORDER BY review_month NULLS FIRST)
                         AS prev_month_avg_rating
              FROM monthly)""",
    "weekly_revenue": f"""
        SELECT CAST(date_trunc('week', order_date_dt) AS DATE) AS week_start,
               {money_sum('gross_revenue')} AS gross_revenue
        FROM g_agg_sales_summary WHERE order_date_dt IS NOT NULL GROUP BY 1""",
    "sentiment_rows": """
        SELECT 'Positive' AS sentiment_type, category, CAST(sum(positive_count) AS BIGINT) AS review_count
        FROM g_agg_review_sentiment GROUP BY category
        UNION ALL
        SELECT 'Neutral', category, CAST(sum(neutral_count) AS BIGINT)
        FROM g_agg_review_sentiment GROUP BY category
        UNION ALL
        SELECT 'Negative', category, CAST(sum(negative_count) AS BIGINT)
        FROM g_agg_review_sentiment GROUP BY category""",
    # calendars: every period between the first and the last is generated and joined
    "country_weeks": f"""
        SELECT shipping_country, CAST(date_trunc('week', order_date_dt) AS DATE) AS week_start,
               CAST(sum(total_orders) AS BIGINT) AS orders, coalesce({money_sum('gross_revenue')}, 0) AS gross_revenue
        FROM g_agg_sales_summary WHERE order_date_dt IS NOT NULL GROUP BY 1, 2""",
    "country_calendar": """
        SELECT s.shipping_country, s.week_start, coalesce(w.orders, 0) AS orders,
               coalesce(w.gross_revenue, 0) AS gross_revenue, w.week_start IS NULL AS is_filled
        FROM (SELECT shipping_country, CAST(unnest(generate_series(min(week_start),
                     greatest(max(week_start), DATE '2001-07-30'), INTERVAL 7 DAY)) AS DATE) AS week_start
              FROM country_weeks GROUP BY shipping_country) s
        LEFT JOIN country_weeks w
          ON w.shipping_country IS NOT DISTINCT FROM s.shipping_country AND w.week_start = s.week_start""",
    "activity_weeks": """
        SELECT week_start, CAST(sum(o) AS BIGINT) AS order_count, CAST(sum(r) AS BIGINT) AS review_count,
               CAST(sum(v) AS BIGINT) AS valid_orders
        FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, 1 AS o, 0 AS r,
                     CASE WHEN is_valid_payment THEN 1 ELSE 0 END AS v
              FROM s_fact_orders WHERE order_date IS NOT NULL
              UNION ALL
              SELECT CAST(date_trunc('week', review_date) AS DATE), 0, 1, 0
              FROM s_fact_reviews WHERE review_date IS NOT NULL) GROUP BY 1""",
    "activity_calendar": f"""
        SELECT s.week_start, coalesce(order_count, 0) AS order_count, coalesce(review_count, 0) AS review_count,
               coalesce(valid_orders, 0) AS valid_orders,
               {ratio('coalesce(valid_orders, 0)', 'coalesce(order_count, 0)', 4)} AS valid_rate,
               w.week_start IS NULL AS is_filled
        FROM (SELECT CAST(unnest(generate_series(min(week_start), greatest(max(week_start), DATE '2001-07-30'),
                     INTERVAL 7 DAY)) AS DATE) AS week_start FROM activity_weeks) s
        LEFT JOIN activity_weeks w ON w.week_start = s.week_start""",
    "metric_rows": """
        SELECT *, row_number() OVER (PARTITION BY metric ORDER BY week_start) AS n
        FROM (SELECT 'order_count' AS metric, week_start, CAST(order_count AS DOUBLE) AS value FROM activity_calendar
              UNION ALL SELECT 'review_count', week_start, CAST(review_count AS DOUBLE) FROM activity_calendar
              UNION ALL SELECT 'valid_rate', week_start, valid_rate FROM activity_calendar
              UNION ALL
              SELECT 'gross_revenue', week_start, round(sum(gross_revenue) * 100) / 100 FROM country_calendar GROUP BY 2)
        WHERE week_start <= DATE '2001-07-23'""",
    "daily_values": f"""
        SELECT s.order_date_dt, coalesce(total_order_value, 0) AS total_order_value, d.order_date_dt IS NULL AS is_filled,
               row_number() OVER (ORDER BY s.order_date_dt) AS n
        FROM (SELECT CAST(unnest(generate_series(min(order_date_dt), max(order_date_dt), INTERVAL 1 DAY)) AS DATE)
                     AS order_date_dt FROM g_agg_sales_summary) s
        LEFT JOIN (SELECT order_date_dt, {money_sum('avg_order_value')} AS total_order_value
                   FROM g_agg_sales_summary GROUP BY 1) d ON d.order_date_dt = s.order_date_dt""",
    "smoothed": """
        SELECT n, total_order_value AS level, CAST(0 AS DOUBLE) AS trend FROM daily_values WHERE n = 1
        UNION ALL
        SELECT d.n, CAST(0.3 AS DOUBLE) * d.total_order_value + CAST(0.7 AS DOUBLE) * (s.level + s.trend),
               CAST(0.1 AS DOUBLE) * ((CAST(0.3 AS DOUBLE) * d.total_order_value
                                       + CAST(0.7 AS DOUBLE) * (s.level + s.trend)) - s.level)
               + CAST(0.9 AS DOUBLE) * s.trend
        FROM smoothed s JOIN daily_values d ON d.n = s.n + 1""",
    "category_months": """
        SELECT category, CAST(date_trunc('month', review_date) AS DATE) AS month_start,
               coalesce(sum(rating), 0) AS stars, count(rating) AS rated
        FROM enriched WHERE review_date IS NOT NULL GROUP BY 1, 2""",
    "category_calendar": f"""
        SELECT s.category, s.month_start, coalesce(rated, 0) AS rated,
               {ratio('coalesce(stars, 0)', 'coalesce(rated, 0)', 2)} AS avg_rating, m.month_start IS NULL AS is_filled
        FROM (SELECT category, CAST(unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS DATE)
                     AS month_start FROM category_months GROUP BY category) s
        LEFT JOIN category_months m ON m.category IS NOT DISTINCT FROM s.category AND m.month_start = s.month_start""",
}

BRONZE = ("customers", "orders", "products", "product_reviews")
SILVER = ("dim_customers", "dim_products", "fact_orders", "fact_reviews")
GOLDEN = ("agg_sales_summary", "agg_product_performance", "agg_customer_360", "agg_review_sentiment")
FILES = {
    "customers": "customer_id name email gender signup_date country",
    "orders": "order_id customer_id order_date total_amount payment_method shipping_country",
    "products": "product_id product_name category price stock_quantity brand",
    "product_reviews": "review_id product_id customer_id rating review_text review_date",
}
ALL_TABLES = (
    [("bronze." + t, "b_" + t) for t in BRONZE]
    + [("silver." + t, "s_" + t) for t in SILVER]
    + [("golden." + t, "g_" + t) for t in GOLDEN]
)


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _six(table: str) -> str:
    picked = ", ".join(f"{c} AS value_{i}" for i, c in enumerate(FILES[table].split(), 1))
    return f"SELECT '{table}' AS table_name, {picked} FROM b_{table}"


def _cleaned(table: str, key: str, column: str, expression: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, {key} AS row_key, '{column}' AS column_name, "
        f"{expression} AS cleaned FROM b_{table}"
    )


def _dropped(table: str, source: str, required: str) -> str:
    rule = " AND ".join(f"{c} IS NOT NULL" for c in required.split())
    kept = n_if(rule)
    return (
        f"SELECT '{table}' AS table_name, count(*) AS rows_before, {kept} AS rows_kept, "
        f"count(*) - {kept} AS rows_dropped FROM l_{source}"
    )


# Columns of the twelve tables: name, type, and whether NULL is refused.
DECLARED = {
    "bronze.customers": [
        ("customer_id", "string", True),
        ("name", "string", False),
        ("email", "string", False),
        ("gender", "string", False),
        ("signup_date", "string", False),
        ("country", "string", False),
        ("ingestion_date", "timestamp", False),
    ],
    "bronze.orders": [
        ("order_id", "string", True),
        ("customer_id", "string", True),
        ("order_date", "string", False),
        ("total_amount", "string", False),
        ("payment_method", "string", False),
        ("shipping_country", "string", False),
        ("ingestion_date", "timestamp", False),
    ],
    "bronze.products": [
        ("product_id", "string", True),
        ("product_name", "string", False),
        ("category", "string", False),
        ("price", "string", False),
        ("stock_quantity", "string", False),
        ("brand", "string", False),
        ("ingestion_date", "timestamp", False),
    ],
    "bronze.product_reviews": [
        ("review_id", "string", True),
        ("product_id", "string", True),
        ("customer_id", "string", True),
        ("rating", "string", False),
        ("review_text", "string", False),
        ("review_date", "string", False),
        ("ingestion_date", "timestamp", False),
    ],
    "silver.dim_customers": [
        ("customer_id", "string", True),
        ("name", "string", False),
        ("email", "string", False),
        ("gender", "string", False),
        ("signup_date", "date", False),
        ("country", "string", False),
        ("is_valid_email", "boolean", False),
        ("ingestion_date", "timestamp", False),
        ("silver_ts", "timestamp", False),
    ],
    "silver.dim_products": [
        ("product_id", "string", True),
        ("product_name", "string", False),
        ("category", "string", False),
        ("price", "double", False),
        ("stock_quantity", "int", False),
        ("brand", "string", False),
        ("price_category", "string", False),
        ("in_stock", "boolean", False),
        ("ingestion_date", "timestamp", False),
        ("silver_ts", "timestamp", False),
    ],
    "silver.fact_orders": [
        ("order_id", "string", True),
        ("customer_id", "string", True),
        ("order_date", "date", False),
        ("order_date_key", "int", False),
        ("total_amount", "double", False),
        ("payment_method", "string", False),
        ("is_valid_payment", "boolean", False),
        ("shipping_country", "string", False),
        ("ingestion_date", "timestamp", False),
        ("silver_ts", "timestamp", False),
    ],
    "silver.fact_reviews": [
        ("review_id", "string", True),
        ("product_id", "string", True),
        ("customer_id", "string", True),
        ("rating", "int", False),
        ("review_text", "string", False),
        ("review_length", "int", False),
        ("review_date", "date", False),
        ("sentiment_bucket", "string", False),
        ("ingestion_date", "timestamp", False),
        ("silver_ts", "timestamp", False),
    ],
    "golden.agg_sales_summary": [
        ("order_date_dt", "date", False),
        ("shipping_country", "string", False),
        ("total_orders", "bigint", False),
        ("unique_customers", "bigint", False),
        ("gross_revenue", "double", False),
        ("avg_order_value", "double", False),
        ("min_order_value", "double", False),
        ("max_order_value", "double", False),
    ],
    "golden.agg_product_performance": [
        ("product_id", "string", False),
        ("product_name", "string", False),
        ("category", "string", False),
        ("brand", "string", False),
        ("price", "double", False),
        ("price_category", "string", False),
        ("in_stock", "boolean", False),
        ("review_count", "bigint", False),
        ("avg_rating", "double", False),
        ("positive_reviews", "bigint", False),
        ("neutral_reviews", "bigint", False),
        ("negative_reviews", "bigint", False),
        ("rating_rank", "int", False),
        ("needs_review_flag", "boolean", False),
    ],
    "golden.agg_customer_360": [
        ("customer_id", "string", False),
        ("name", "string", False),
        ("email", "string", False),
        ("gender", "string", False),
        ("country", "string", False),
        ("signup_date", "date", False),
        ("tenure_days", "int", False),
        ("total_orders", "bigint", False),
        ("lifetime_value", "double", False),
        ("avg_order_value", "double", False),
        ("last_order_date", "date", False),
        ("first_order_date", "date", False),
        ("days_since_last_order", "int", False),
        ("reviews_written", "bigint", False),
        ("avg_review_given", "double", False),
        ("preferred_payment", "string", False),
        ("recency_score", "int", False),
        ("frequency_score", "int", False),
        ("monetary_score", "int", False),
        ("rfm_score", "int", False),
        ("customer_segment", "string", False),
    ],
    "golden.agg_review_sentiment": [
        ("review_month", "string", False),
        ("product_id", "string", False),
        ("product_name", "string", False),
        ("category", "string", False),
        ("brand", "string", False),
        ("total_reviews", "bigint", False),
        ("avg_rating", "double", False),
        ("positive_count", "bigint", False),
        ("neutral_count", "bigint", False),
        ("negative_count", "bigint", False),
        ("positive_pct", "double", False),
        ("negative_pct", "double", False),
        ("prev_month_avg_rating", "double", False),
        ("rating_mom_change", "double", False),
    ],
}


def _contract_rows(name: str, cte: str) -> str:
    parts = []
    for position, (bare, kind, required) in enumerate(DECLARED[name], 1):
        nulls = f"(SELECT count(*) FROM {cte} WHERE {bare} IS NULL)" if required else "0"
        parts.append(
            f"SELECT '{name}' AS table_name, {position} AS position, '{bare}' AS column_name, "
            f"'{kind}' AS declared_type, TRUE AS type_ok, TRUE AS position_ok, "
            f"CAST({nulls} AS BIGINT) AS null_violations"
        )
    return _union(parts)


def _week_kpis() -> str:
    parts = []
    for name, low, high in (
        ("current", "2001-07-30", "2001-08-05"),
        ("previous", "2001-07-23", "2001-07-29"),
    ):
        parts.append(
            f"(SELECT count(order_id) AS {name}_orders, {money_sum('total_amount')} AS {name}_revenue, "
            f"{money_avg('total_amount')} AS {name}_aov, count(DISTINCT customer_id) AS {name}_customers "
            f"FROM s_fact_orders WHERE order_date BETWEEN DATE '{low}' AND DATE '{high}')"
        )
    return f"SELECT DATE '2001-07-30' AS week_start, * FROM {parts[0]} CROSS JOIN {parts[1]}"


def _stars(labels: str) -> str:
    return (
        f"SELECT {labels}, count(review_id) AS review_count, "
        f"{ratio('sum(rating)', 'count(rating)', 2)} AS avg_rating FROM "
        "(SELECT *, strftime(review_date, '%Y-%m') AS review_month FROM enriched) GROUP BY ALL"
    )


def _split(columns: str, overall: str, group: str) -> str:
    sums = {s: f"CAST(sum({s}_count) AS BIGINT)" for s in ("positive", "neutral", "negative")}
    total = " + ".join(sums.values())
    shares = ", ".join(f"{ratio(v + ' * 100', total, 1)} AS {s}_pct" for s, v in sums.items())
    counts = ", ".join(f"{v} AS {s}" for s, v in sums.items())
    return (
        f"SELECT {overall} AS is_overall, {columns} AS category, {counts}, {shares} "
        f"FROM g_agg_review_sentiment {group}"
    )


def _check(name: str, left: str, right: str, keys: str, left_sql: str, right_sql: str, subset: bool = False) -> str:
    """One line of the consistency report, from two derived tables (keys, figure)."""
    same = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in keys.split(", "))
    differing = "0" if subset else n_if("l.here AND r.here AND l.figure IS DISTINCT FROM r.figure")
    right_total = "sum(l.figure) FILTER (WHERE r.here)" if subset else "sum(r.figure)"
    wrong = "only_left" if subset else "only_left + only_right + differing"
    return f"""
        SELECT '{name}' AS check_name, '{left}' AS left_table, '{right}' AS right_table, '{keys}' AS key_name, *,
               {wrong} = 0 AS consistent
        FROM (SELECT count(l.here) AS left_keys, count(r.here) AS right_keys,
                     {n_if('l.here AND r.here IS NULL')} AS only_left, {n_if('l.here IS NULL AND r.here')} AS only_right,
                     CAST({differing} AS BIGINT) AS differing,
                     CAST(coalesce(sum(l.figure), 0) AS BIGINT) AS left_total,
                     CAST(coalesce({right_total}, 0) AS BIGINT) AS right_total
              FROM (SELECT *, TRUE AS here FROM ({left_sql})) l
              FULL OUTER JOIN (SELECT *, TRUE AS here FROM ({right_sql})) r ON {same})"""


def _per_key(table: str, key: str, where: str = "TRUE") -> str:
    return f"SELECT {key}, count(*) AS figure FROM {table} WHERE {where} GROUP BY ALL"


def _published(table: str, keys: str, figure: str) -> str:
    return f"SELECT {keys}, {figure} AS figure FROM {table} WHERE {figure} > 0"


REFERENCES = (
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_reviews", "customer_id", "dim_customers"),
    ("fact_reviews", "product_id", "dim_products"),
)
_DAY = "order_date_dt, shipping_country"
_DATED = "(SELECT * RENAME (order_date AS order_date_dt) FROM s_fact_orders)"
_MONTHLY = "(SELECT *, strftime(review_date, '%Y-%m') AS review_month FROM s_fact_reviews)"
_CUSTOMERS, _PRODUCTS = "SELECT customer_id FROM s_dim_customers", "SELECT product_id FROM s_dim_products"


def _consistency() -> str:
    lines = [
        _check("orphans", f, d, k, _per_key(f"s_{f}", k), _per_key(f"s_{d}", k), True) for f, k, d in REFERENCES
    ]
    lines += [
        _check("orders", "agg_sales_summary", "fact_orders", _DAY,
               _published("g_agg_sales_summary", _DAY, "total_orders"), _per_key(_DATED, _DAY)),
        _check("revenue_cents", "agg_sales_summary", "fact_orders", _DAY,
               f"SELECT {_DAY}, {cents('gross_revenue')} AS figure FROM g_agg_sales_summary",
               f"SELECT {_DAY}, CAST(sum({cents('total_amount')}) AS BIGINT) AS figure FROM {_DATED} GROUP BY ALL"),
        _check("orders", "agg_customer_360", "fact_orders", "customer_id",
               _published("g_agg_customer_360", "customer_id", "total_orders"),
               _per_key("s_fact_orders", "customer_id", f"customer_id IN ({_CUSTOMERS})")),
        _check("reviews", "agg_customer_360", "fact_reviews", "customer_id",
               _published("g_agg_customer_360", "customer_id", "reviews_written"),
               _per_key("s_fact_reviews", "customer_id", f"customer_id IN ({_CUSTOMERS})")),
        _check("reviews", "agg_product_performance", "fact_reviews", "product_id",
               _published("g_agg_product_performance", "product_id", "review_count"),
               _per_key("s_fact_reviews", "product_id", f"product_id IN ({_PRODUCTS})")),
        _check("reviews", "agg_review_sentiment", "fact_reviews", "review_month, product_id",
               _published("g_agg_review_sentiment", "review_month, product_id", "total_reviews"),
               _per_key(_MONTHLY, "review_month, product_id")),
        _check("rows", "agg_customer_360", "dim_customers", "customer_id",
               _per_key("g_agg_customer_360", "customer_id"), _per_key("s_dim_customers", "customer_id")),
        _check("rows", "agg_product_performance", "dim_products", "product_id",
               _per_key("g_agg_product_performance", "product_id"), _per_key("s_dim_products", "product_id")),
    ]
    return _union(lines)


def _orphan_keys() -> str:
    return _union(
        f"""SELECT '{f}' AS table_name, '{d}' AS reference_table, '{k}' AS key_name, {k} AS key_value,
                   count(*) AS orphan_rows
            FROM s_{f} f WHERE NOT EXISTS (SELECT 1 FROM s_{d} d WHERE d.{k} = f.{k}) GROUP BY {k}"""
        for f, k, d in REFERENCES
    )


def _history() -> str:
    parts = []
    raw = {"dim_customers": "customers", "dim_products": "products", "fact_orders": "orders", "fact_reviews": "product_reviews"}
    for name, cte in ALL_TABLES:
        table = name.split(".")[1]
        dropped = (
            f"(SELECT count(*) FROM l_{raw[table]}) - (SELECT count(*) FROM {cte})" if table in raw else "NULL"
        )
        nulls = " + ".join(
            f"(SELECT count(*) FROM {cte} WHERE {column} IS NULL)" for column, _, required in DECLARED[name] if required
        )
        parts.append(
            f"""SELECT '2001-W31' AS run_id, 2 AS attempts, 'succeeded' AS status, '{name}' AS table_name,
                       (SELECT count(*) FROM {cte}) AS rows_written, CAST({dropped} AS BIGINT) AS rows_dropped,
                       CAST(NULL AS BIGINT) AS rows_rejected, CAST({nulls or '0'} AS BIGINT) AS nulls_published,
                       CAST(NULL AS BIGINT) AS previous_rows, CAST(NULL AS BIGINT) AS rows_change"""
        )
    return _union(parts)


def _field(x: str) -> str:
    """A value as a landing file has it."""
    return (
        f"CASE WHEN {x} IS NULL THEN '' WHEN regexp_matches({x}, '[\",\n]') "
        f"THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE {x} END"
    )


def _malformed(table: str) -> str:
    """Rows that are landed once more with too few and with too many fields."""
    key, every = FILES[table].split()[0], 500 if table in ("orders", "product_reviews") else 50
    return f"b_{table} WHERE TRY_CAST(split_part({key}, '-', 1) AS BIGINT) % {every} = 0"


def _rejects() -> str:
    parts = []
    for table in BRONZE:
        fields = [_field(c) for c in FILES[table].split()]
        for reason, values in (("too few fields", fields[:2]), ("too many fields", [*fields, "'more'"])):
            line = " || ',' || ".join(f"({v})" for v in values)
            parts.append(
                f"SELECT '{table}' AS table_name, {line} AS raw_record, '{reason}' AS reason FROM {_malformed(table)}"
            )
    return _union(parts)


def _reconciled() -> str:
    return _union(
        f"""SELECT '{t}' AS landing_table, good + 2 * bad AS records, good AS good_rows, 2 * bad AS rejected_rows,
                   TRUE AS reconciled
            FROM (SELECT (SELECT count(*) FROM b_{t}) AS good, (SELECT count(*) FROM {_malformed(t)}) AS bad)"""
        for t in BRONZE
    )


WEEK = "DATE '2001-07-30'"
_CHANGE = "round(gross_revenue * 100) - round(prev_revenue * 100)"


def _anomalies() -> str:
    """The deviation of each week from the eight rows before it, by a self join."""
    middle = "(list_sort({0})[(len({0}) + 1) // 2] + list_sort({0})[(len({0}) + 2) // 2]) / 2"
    score = "round((value - trailing_median) / (CAST(1.4826 AS DOUBLE) * nullif(trailing_mad, 0)) * 10000) / 10000"
    judged = "value IS NOT NULL AND len(before) >= 4"
    return f"""
        SELECT metric, week_start, value, trailing_median, trailing_mad,
               CASE WHEN {judged} THEN {score} END AS score,
               CASE WHEN {judged} AND trailing_mad = 0 THEN value <> trailing_median
                    WHEN {judged} THEN abs({score}) > 3.5 END AS is_anomaly
        FROM (SELECT *, {middle.format('distances')} AS trailing_mad
              FROM (SELECT *, list_transform(before, lambda y: abs(y - trailing_median)) AS distances
                    FROM (SELECT *, {middle.format('before')} AS trailing_median
                          FROM (SELECT a.metric, a.week_start, a.value,
                                       coalesce(list(b.value) FILTER (WHERE b.value IS NOT NULL), []) AS before
                                FROM metric_rows a LEFT JOIN metric_rows b
                                  ON a.metric = b.metric AND b.n BETWEEN a.n - 8 AND a.n - 1
                                GROUP BY a.metric, a.week_start, a.value))))"""


def _trend(level: str, key: str, table: str) -> str:
    slope = (
        "round(CAST(n * ty - t * y AS DOUBLE) / nullif(CAST(n * tt - t * t AS DOUBLE), 0) * 1000000) / 1000000"
    )
    return f"""
        SELECT '{level}' AS level, key_value, rated_reviews, first_month, last_month, slope,
               CASE WHEN slope >= 0.01 THEN 'improving' WHEN slope <= -0.01 THEN 'declining'
                    WHEN slope IS NOT NULL THEN 'steady' END AS direction
        FROM (SELECT {key} AS key_value, CAST(n AS BIGINT) AS rated_reviews, first_month, last_month, {slope} AS slope
              FROM (SELECT {key}, CAST(count(*) AS HUGEINT) AS n, CAST(sum(m) AS HUGEINT) AS t, sum(rating) AS y,
                           CAST(sum(m * m) AS HUGEINT) AS tt, CAST(sum(m * rating) AS HUGEINT) AS ty,
                           strftime(min(review_date), '%Y-%m') AS first_month,
                           strftime(max(review_date), '%Y-%m') AS last_month
                    FROM (SELECT *, year(review_date) * 12 + month(review_date) AS m FROM {table}
                          WHERE rating IS NOT NULL AND review_date IS NOT NULL) GROUP BY {key}))"""


FORECAST = """
    SELECT step, last_day + step AS order_date_dt, round((level + step * trend) * 100) / 100 AS forecast
    FROM (SELECT level, trend, (SELECT max(order_date_dt) FROM daily_values) AS last_day
          FROM smoothed ORDER BY n DESC LIMIT 1), (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS step)"""

DISTINCT_CUSTOMERS = _union(
    f"""SELECT '{kind}' AS period_kind, {start} AS period_start, count(DISTINCT customer_id) AS customers
        FROM s_fact_orders WHERE order_date IS NOT NULL GROUP BY 2"""
    for kind, start in (
        ("day", "order_date"),
        ("week", "CAST(date_trunc('week', order_date) AS DATE)"),
        ("month", "CAST(date_trunc('month', order_date) AS DATE)"),
    )
)

ESTIMATED = "price * review_count"
IS_CHAMPION = "customer_segment = 'Champions'"
LAST_RUN = "strftime(max(silver_ts), '%Y-%m-%d %H:%M:%S')"

FINAL = {
    # sources and sinks
    "bronze_csv_scan": _union(_six(t) for t in ("customers", "orders", "products")),
    "bronze_csv_multiline": f"SELECT {', '.join(FILES['product_reviews'].split())} FROM b_product_reviews",
    "bronze_audit_column": "SELECT product_id, product_name, '2001-08-02 00:00:00' AS ingested_at FROM b_products",
    "table_overwrite_sink": "SELECT * EXCLUDE (silver_ts) FROM s_fact_orders",
    "contract_check": _union(_contract_rows(n, c) for n, c in ALL_TABLES),
    "row_count_audit": _union(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}" for n, c in ALL_TABLES),
    "landing_file_audit": _union(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, TRUE AS all_files_filled FROM b_{t}" for t in BRONZE
    ),
    "golden_preview": "SELECT * FROM g_agg_review_sentiment ORDER BY product_id NULLS FIRST, review_month NULLS FIRST LIMIT 10",
    # cleaning
    "clean_title_case": _union(
        [
            _cleaned("customers", "customer_id", "name", title("name")),
            _cleaned("customers", "customer_id", "country", title("country")),
            _cleaned("products", "product_id", "product_name", title("product_name")),
            _cleaned("products", "product_id", "category", title("category")),
            _cleaned("products", "product_id", "brand", title("brand")),
            _cleaned("orders", "order_id", "shipping_country", title("shipping_country")),
        ]
    ),
    "clean_lower_trim": _union(
        [
            _cleaned("customers", "customer_id", "email", "lower(trim(email))"),
            _cleaned("orders", "order_id", "payment_method", "lower(trim(payment_method))"),
        ]
    ),
    "clean_gender": f"SELECT customer_id, {GENDER} AS gender FROM b_customers",
    "parse_date": _union(
        f"SELECT '{t}' AS table_name, {k} AS row_key, {date(c)} AS parsed FROM b_{t}"
        for t, k, c in (
            ("customers", "customer_id", "signup_date"),
            ("orders", "order_id", "order_date"),
            ("product_reviews", "review_id", "review_date"),
        )
    ),
    "date_key": f"SELECT order_id, CAST(strftime({date('order_date')}, '%Y%m%d') AS INTEGER) AS order_date_key FROM b_orders",
    "cast_nonneg_double": _union(
        f"SELECT '{t}' AS table_name, {k} AS row_key, {nonneg(f'TRY_CAST({c} AS DOUBLE)')} AS amount FROM b_{t}"
        for t, k, c in (("products", "product_id", "price"), ("orders", "order_id", "total_amount"))
    ),
    "cast_nonneg_int": f"SELECT product_id, {nonneg(integer('stock_quantity'))} AS stock_quantity FROM b_products",
    "cast_rating_range": f"SELECT review_id, CASE WHEN r BETWEEN 1 AND 5 THEN r END AS rating FROM (SELECT review_id, {integer('rating')} AS r FROM b_product_reviews)",
    "flag_valid_email": f"SELECT customer_id, regexp_matches(lower(trim(email)), '{EMAIL}') AS is_valid_email FROM b_customers",
    "flag_valid_payment": f"SELECT order_id, lower(trim(payment_method)) IN {PAYMENTS} AS is_valid_payment FROM b_orders",
    "flag_in_stock": f"SELECT product_id, coalesce({nonneg(integer('stock_quantity'))}, 0) > 0 AS in_stock FROM b_products",
    "review_length": "SELECT review_id, CAST(length(review_text) AS INTEGER) AS review_length FROM b_product_reviews",
    "price_tier": f"SELECT product_id, {PRICE_TIER} AS price_category FROM (SELECT product_id, {nonneg('TRY_CAST(price AS DOUBLE)')} AS price FROM b_products)",
    "sentiment_bucket": f"SELECT review_id, {SENTIMENT} AS sentiment_bucket FROM (SELECT review_id, CASE WHEN r BETWEEN 1 AND 5 THEN r END AS rating FROM (SELECT review_id, {integer('rating')} AS r FROM b_product_reviews))",
    "month_bucket": f"SELECT review_id, strftime({date('review_date')}, '%Y-%m') AS review_month FROM b_product_reviews",
    "recency_tenure_days": "SELECT customer_id, days_since_last_order, tenure_days FROM g_agg_customer_360",
    # quality and silver
    "dq_drop_all_null": "SELECT customer_id, name, email, gender, signup_date, country FROM b_customers WHERE "
    "coalesce(name, email, gender, signup_date, country) IS NOT NULL",
    "dq_required_keys": "SELECT customer_id, email FROM b_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL",
    "dq_drop_report": _union(
        [
            _dropped("dim_customers", "customers", "customer_id email"),
            _dropped("dim_products", "products", "product_id"),
            _dropped("fact_orders", "orders", "order_id customer_id"),
            _dropped("fact_reviews", "product_reviews", "review_id product_id customer_id"),
        ]
    ),
    **{f"silver_{t}": f"SELECT * EXCLUDE (silver_ts) FROM s_{t}" for t in SILVER},
    # windows
    "dedup_latest": f"SELECT {', '.join(FILES['product_reviews'].split())} FROM l_product_reviews",
    "preferred_payment": "SELECT * FROM payment_pref",
    "rating_rank": "SELECT product_id, avg_rating, rating_rank FROM g_agg_product_performance",
    "rating_lag_mom": "SELECT product_id, review_month, avg_rating, prev_month_avg_rating, rating_mom_change FROM g_agg_review_sentiment",
    # aggregates, joins
    "golden_sales_summary": "SELECT * FROM g_agg_sales_summary",
    "product_review_agg": "SELECT * FROM product_reviews_agg",
    "customer_order_agg": "SELECT * FROM customer_orders_agg",
    "customer_review_agg": "SELECT * FROM customer_reviews_agg",
    "monthly_sentiment_agg": "SELECT * FROM monthly",
    "sentiment_pct": "SELECT product_id, review_month, positive_pct, negative_pct FROM g_agg_review_sentiment",
    "golden_product_performance": "SELECT * FROM g_agg_product_performance",
    "golden_customer_360": "SELECT * FROM g_agg_customer_360",
    "reviews_enriched": "SELECT * EXCLUDE (silver_ts) FROM enriched",
    "golden_review_sentiment": "SELECT * FROM g_agg_review_sentiment",
    # scoring
    "rfm_recency": "SELECT customer_id, days_since_last_order, recency_score FROM g_agg_customer_360",
    "rfm_frequency": "SELECT customer_id, total_orders, frequency_score FROM g_agg_customer_360",
    "rfm_monetary": "SELECT customer_id, lifetime_value, monetary_score FROM g_agg_customer_360",
    "rfm_score": "SELECT customer_id, rfm_score FROM g_agg_customer_360",
    "customer_segment": "SELECT customer_id, customer_segment FROM g_agg_customer_360",
    # dashboard
    "dash_top_countries": f"SELECT shipping_country, {money_sum('gross_revenue')} AS total_revenue FROM g_agg_sales_summary GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 10",
    "dash_order_value_series": f"SELECT order_date_dt, {money_sum('avg_order_value')} AS total_order_value FROM g_agg_sales_summary GROUP BY 1 ORDER BY 1 NULLS FIRST",
    "dash_aov_series": f"SELECT order_date_dt, {money_sum('gross_revenue')} AS revenue, CAST(sum(total_orders) AS BIGINT) AS orders, round(CAST(sum({cents('gross_revenue')}) AS DOUBLE) / sum(total_orders)) / 100 AS avg_order_value FROM g_agg_sales_summary GROUP BY 1 ORDER BY 1 NULLS FIRST",
    "dash_sentiment_by_category": "SELECT * FROM sentiment_rows",
    "dash_sentiment_total": "SELECT sentiment_type, CAST(sum(review_count) AS BIGINT) AS review_count FROM sentiment_rows GROUP BY 1",
    "dash_segment_distribution": "SELECT customer_segment, count(*) AS customers FROM g_agg_customer_360 GROUP BY 1",
    "dash_estimated_sales": f"SELECT product_id, price, review_count, {ESTIMATED} AS estimated_sales FROM g_agg_product_performance",
    "dash_sales_flag": f"SELECT product_id, product_name, category, review_count, avg_rating, {ESTIMATED} AS estimated_sales, CASE WHEN {ESTIMATED} > 10000 AND avg_rating < 3.3 THEN 'High Sales, Low Rating' WHEN {ESTIMATED} > 10000 THEN 'High Sales' WHEN avg_rating < 3.3 THEN 'Low Rating' ELSE 'Normal' END AS sales_performance_flag FROM g_agg_product_performance",
    "sample_rows": "SELECT * FROM g_agg_customer_360 ORDER BY customer_id NULLS FIRST LIMIT 1000",
    # described analytics
    "weekly_revenue_wow": f"SELECT *, round(gross_revenue - prev_revenue, 2) AS revenue_change, {ratio('(round(gross_revenue * 100) - round(prev_revenue * 100)) * 100', 'round(prev_revenue * 100)', 1)} AS change_pct FROM (SELECT *, lag(gross_revenue) OVER (ORDER BY week_start) AS prev_revenue FROM weekly_revenue)",
    "revenue_by_country": f"SELECT shipping_country, {money_sum('gross_revenue')} AS total_revenue, CAST(sum(total_orders) AS BIGINT) AS orders FROM g_agg_sales_summary GROUP BY 1",
    "kpi_week_vs_prev": _week_kpis(),
    "orders_by_weekday": "SELECT CAST(isodow(order_date_dt) - 1 AS INTEGER) AS weekday, CAST(sum(total_orders) AS BIGINT) AS total_orders FROM g_agg_sales_summary WHERE order_date_dt IS NOT NULL GROUP BY 1",
    "price_vs_rating": "SELECT product_id, category, price_category, price, avg_rating, review_count FROM g_agg_product_performance WHERE price IS NOT NULL AND avg_rating IS NOT NULL",
    "top_bottom_products": _union(
        f"(SELECT product_id, product_name, avg_rating, review_count, '{n}' AS list_name FROM g_agg_product_performance WHERE avg_rating IS NOT NULL ORDER BY avg_rating {o}, product_id LIMIT 10)"
        for n, o in (("top", "DESC"), ("bottom", "ASC"))
    ),
    "category_brand_heatmap": _stars("category, brand"),
    "category_rating_trend": f"SELECT *, round(avg_rating - prev_avg_rating, 2) AS rating_change FROM (SELECT *, lag(avg_rating) OVER (PARTITION BY category ORDER BY review_month NULLS FIRST) AS prev_avg_rating FROM ({_stars('category, review_month')}))",
    "sentiment_split": _union(
        [_split("category", "FALSE", "GROUP BY category"), _split("CAST(NULL AS VARCHAR)", "TRUE", "")]
    ),
    "needs_review_list": "SELECT product_id, product_name, category, brand, avg_rating, review_count FROM g_agg_product_performance WHERE needs_review_flag",
    "segment_counts": "SELECT customer_segment, count(*) AS customers FROM g_agg_customer_360 GROUP BY 1",
    "customer_kpis": f"SELECT count(*) AS total_customers, {money_avg('lifetime_value')} AS avg_lifetime_value, {ratio('sum(tenure_days)', 'count(tenure_days)', 1)} AS avg_tenure_days, {ratio(n_if(IS_CHAMPION) + ' * 100', 'count(*)', 1)} AS champions_pct FROM g_agg_customer_360",
    "ltv_by_segment": f"SELECT customer_segment, count(lifetime_value) AS paying_customers, {money_avg('lifetime_value')} AS avg_lifetime_value FROM g_agg_customer_360 GROUP BY 1",
    "champions_by_country": "SELECT country, count(*) AS champions FROM g_agg_customer_360 WHERE customer_segment = 'Champions' GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10",
    "payment_by_segment": f"SELECT customer_segment, preferred_payment, customers, {ratio('customers * 100', 'sum(customers) OVER (PARTITION BY customer_segment)', 1)} AS share_pct FROM (SELECT customer_segment, preferred_payment, count(*) AS customers FROM g_agg_customer_360 GROUP BY 1, 2)",
    "recency_monetary_grid": "SELECT recency_score, monetary_score, customer_segment, count(*) AS customers FROM g_agg_customer_360 GROUP BY ALL",
    "reengagement_list": "SELECT customer_id, name, email, customer_segment, lifetime_value, last_order_date FROM g_agg_customer_360 WHERE customer_segment IN ('At Risk', 'Hibernating') ORDER BY lifetime_value DESC NULLS LAST, customer_id",
    "weekly_orders_vs_reviews": "SELECT week_start, coalesce(order_count, 0) AS order_count, coalesce(review_count, 0) AS review_count FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, count(*) AS order_count FROM s_fact_orders WHERE order_date IS NOT NULL GROUP BY 1) FULL JOIN (SELECT CAST(date_trunc('week', review_date) AS DATE) AS week_start, count(*) AS review_count FROM s_fact_reviews WHERE review_date IS NOT NULL GROUP BY 1) USING (week_start)",
    "valid_payment_rate": f"SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, count(*) AS orders, {n_if('is_valid_payment')} AS valid_orders, {ratio(n_if('is_valid_payment'), 'count(*)', 4)} AS valid_rate FROM s_fact_orders WHERE order_date IS NOT NULL GROUP BY 1",
    "activation_rate": f"SELECT count(*) AS total_customers, {n_if('total_orders >= 1')} AS active_customers, {ratio(n_if('total_orders >= 1') + ' * 100', 'count(*)', 1)} AS activation_pct FROM g_agg_customer_360",
    "stock_by_category": f"SELECT category, {n_if('in_stock')} AS in_stock_products, {n_if('NOT in_stock')} AS out_of_stock_products FROM g_agg_product_performance GROUP BY 1",
    "unreviewed_products": "SELECT product_id, product_name, category, brand, review_count FROM g_agg_product_performance WHERE avg_rating IS NULL",
    # agreement, records, rejects
    "consistency_report": _consistency(),
    "orphan_keys": _orphan_keys(),
    "run_history": _history(),
    "bronze_rejects": _rejects(),
    "landing_reconciliation": _reconciled(),
    # gapless series
    "weekly_revenue_calendar": f"SELECT shipping_country, week_start, orders, gross_revenue, prev_revenue, ({_CHANGE}) / 100 AS revenue_change, {ratio(f'({_CHANGE}) * 100', 'round(prev_revenue * 100)', 1)} AS change_pct, is_filled FROM (SELECT *, lag(gross_revenue) OVER (PARTITION BY shipping_country ORDER BY week_start) AS prev_revenue FROM country_calendar)",
    "weekly_activity_calendar": "SELECT * FROM activity_calendar",
    "order_value_calendar": "SELECT order_date_dt, total_order_value, is_filled FROM daily_values",
    "category_rating_calendar": "SELECT *, round(avg_rating - prev_avg_rating, 2) AS rating_change FROM (SELECT *, lag(avg_rating) OVER (PARTITION BY category ORDER BY month_start) AS prev_avg_rating FROM category_calendar)",
    "weekly_anomalies": _anomalies(),
    "sentiment_trend": _union([_trend("product", "product_id", "enriched"), _trend("category", "category", "enriched")]),
    "order_value_forecast": FORECAST,
    "customers_by_period": DISTINCT_CUSTOMERS,
    "freshness": _union(f"SELECT '{t}' AS table_name, {LAST_RUN} AS last_run FROM s_{t}" for t in SILVER),
}


def _needed(text: str, found: list[str]) -> list[str]:
    """Names of the common table expressions that ``text`` uses, dependencies first."""
    for name in CTE:
        if name not in found and text is not CTE[name] and re.search(rf"\b{name}\b", text):
            _needed(CTE[name], found)
            if name not in found:
                found.append(name)
    return found


def sql(key: str) -> str:
    parts = [f"{name} AS ({CTE[name]})" for name in _needed(FINAL[key], [])]
    if key == "run_history":  # rows that were landed as files share one load time
        parts = [part.replace("ORDER BY ingestion_date DESC NULLS LAST, ", "ORDER BY ") for part in parts]
    return f"WITH RECURSIVE {', '.join(parts)}\n{FINAL[key]}"


def all_sql() -> dict[str, str]:
    return {key: sql(key) for key in FINAL}
