"""The same results in plain SQL over the test tables, for a second engine."""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"

ORDERS = """
r_orders AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS create_time,
         CAST(o_totalprice AS DECIMAL(12,2)) AS payment_amount,
         CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 1 ELSE 0 END AS order_status,
         CASE o_orderstatus WHEN 'O' THEN 0 ELSE 1 END AS payment_status,
         CASE o_orderkey % 4 WHEN 0 THEN 'alipay' WHEN 1 THEN 'wechat' WHEN 2 THEN 'card'
              ELSE 'points' END AS payment_method,
         CASE WHEN o_orderkey % 50 <> 0 THEN CAST(substr(o_orderpriority,1,1) AS INTEGER) END
           AS channel_id,
         CASE WHEN CAST(substr(o_orderpriority,1,1) AS INTEGER) <= 3 THEN 'online'
              ELSE 'offline' END AS order_source,
         CASE WHEN o_orderkey % 10 < 3 THEN o_orderkey % 5 + 1 END AS campaign_id
  FROM orders)"""

DETAILS = """
r_amounts AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS total_price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
           AS DECIMAL(12,2)) AS discount_price
  FROM lineitem),
r_details AS (
  SELECT *, CAST(total_price - discount_price AS DECIMAL(12,2)) AS actual_price
  FROM r_amounts)"""

GROSS = f"""{ORDERS},{DETAILS},
r_cuts AS (SELECT order_id, sum(discount_price) AS cut FROM r_details GROUP BY 1),
r_gross AS (
  SELECT o.*, coalesce(c.cut, 0) AS discount_amount,
         o.payment_amount + coalesce(c.cut, 0) AS total_amount
  FROM r_orders o LEFT JOIN r_cuts c ON c.order_id = o.id)"""

CHANNELS = """
r_channels(id, channel_name, channel_type) AS (
  VALUES (1,'Web','online'), (2,'App','online'), (3,'Mini','online'),
         (4,'Shop','offline'), (5,'Phone','offline'), (6,'Kiosk','offline'))"""

LEVELS = """
r_levels(id, level_name, low, high) AS (
  VALUES (1,'T1',0,1500000), (2,'T2',1500001,2500000), (3,'T3',2500001,3500000),
         (4,'T4',3500001,9999999), (5,'T5',10000000,99999999))"""

CATEGORIES = """
r_categories(id, category_name) AS (
  VALUES (1,'ECONOMY'), (2,'LARGE'), (3,'MEDIUM'), (4,'PROMO'), (5,'SMALL'), (6,'STANDARD'),
         (7,'CLEARANCE'))"""

PRODUCTS = f"""{CATEGORIES},
r_products AS (
  SELECT p_partkey AS id, p_name AS product_name,
         'P' || CASE WHEN p_partkey > 999999 THEN CAST(p_partkey AS VARCHAR)
                     ELSE lpad(CAST(p_partkey AS VARCHAR), 6, '0') END AS product_code,
         c.id AS category_id, p_type AS category_name,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part LEFT JOIN r_categories c ON c.category_name = p_type)"""

CATEGORY_SALES = f"""{DETAILS},{PRODUCTS},
r_category_sales AS (
  SELECT c.category_name, coalesce(sum(d.actual_price), 0) AS total_sales
  FROM r_categories c LEFT JOIN r_products p ON p.category_id = c.id
       LEFT JOIN r_details d ON d.product_id = p.id
  GROUP BY c.category_name)"""


def cents(total: str) -> str:
    return f"CAST({total} * 100 AS HUGEINT)"


def mean(total: str, count: str, digits: int = 2) -> str:
    """A sum of money over a whole count, rounded half up in integer arithmetic."""
    scale = 10 ** (digits - 2)
    return (f"CAST((2 * {scale} * {cents(total)} + {count}) // (2 * {count}) AS DOUBLE)"
            f" / {10**digits}.0")


def day(c: str) -> str:
    return f"strftime(CAST({c} AS DATE), '%Y-%m-%d')"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def history(series: str | None, orders: str = ORDERS, table: str = "r_orders") -> str:
    key = "'all'" if series is None else f"coalesce(CAST({series} AS VARCHAR), '(none)')"
    return f"""{orders},
r_daily AS (
  SELECT {key} AS series_key, CAST(create_time AS DATE) AS date, count(*) AS n,
         sum(payment_amount) AS amount
  FROM {table} WHERE create_time >= {AS_OF} - INTERVAL 90 DAY GROUP BY 1, 2),
r_span AS (
  SELECT series_key,
         CAST(unnest(generate_series(CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS date
  FROM r_daily GROUP BY series_key),
r_history AS (
  SELECT s.series_key, s.date, coalesce(d.n, 0) AS order_count,
         coalesce(d.amount, 0) AS total_amount
  FROM r_span s LEFT JOIN r_daily d USING (series_key, date))"""


CALENDAR = """CAST(isodow(date) - 1 AS INTEGER) AS dayofweek,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend"""

LAGS = ",\n  ".join(
    f"CAST(lag(total_amount, {i}) OVER w AS DOUBLE) AS lag_{i}" for i in range(1, 8)
)


def rolling(shift: int) -> str:
    def one(n: int) -> str:
        frame = f"ROWS BETWEEN {n - 1 + shift} PRECEDING AND " + (
            "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
        )
        over = f"OVER (PARTITION BY series_key ORDER BY date {frame})"
        return (f"CASE WHEN count(total_amount) {over} = {n} THEN "
                f"CAST(sum(total_amount) {over} AS DOUBLE) / {n}.0 END AS rolling_mean_{n}")

    return one(7) + ",\n  " + one(14)


WINDOW = "WINDOW w AS (PARTITION BY series_key ORDER BY date)"


def features(shift: int) -> str:
    return f"""
r_features AS (
  SELECT * FROM (
    SELECT series_key, date, order_count, total_amount, {CALENDAR}, {LAGS}, {rolling(shift)},
           count(*) OVER (PARTITION BY series_key) AS days
    FROM r_history {WINDOW})
  WHERE days >= 14 AND lag_7 IS NOT NULL AND rolling_mean_14 IS NOT NULL)"""


COLUMNS = (
    ["dayofweek", "month", "day", "is_weekend"]
    + [f"lag_{i}" for i in range(1, 8)]
    + ["rolling_mean_7", "rolling_mean_14"]
)


def feature_frame(shift: int) -> str:
    return f"""WITH {history('channel_id')},{features(shift)}
SELECT series_key, {day('date')} AS date, order_count,
       CAST(total_amount AS DOUBLE) AS total_amount, {', '.join(COLUMNS)}
FROM r_features"""


REPEAT = """
r_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS k,
         max(date) OVER (PARTITION BY series_key) AS newest,
         count(*) OVER (PARTITION BY series_key) AS days
  FROM r_history),
r_steps AS (
  SELECT CAST(i AS INTEGER) AS step, CASE WHEN i % 7 = 0 THEN 1 ELSE 7 - i % 7 END AS k
  FROM range(30) t(i)),
r_ahead AS (
  SELECT series_key, CAST(newest + (step + 1) AS DATE) AS date, step,
         greatest(0.0, CAST(total_amount AS DOUBLE)) AS predicted_amount
  FROM r_ranked JOIN r_steps USING (k) WHERE days >= 27)"""

# Rows of the fit twice over: all of them in sample, and the last 14 held out.
PARTS = """
r_parts AS (
  SELECT *, 'in_sample' AS part FROM r_features
  UNION ALL BY NAME
  SELECT * EXCLUDE (k), 'holdout' AS part FROM (
    SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS k FROM r_features)
  WHERE k <= 14)"""

CURVE = f"""
r_scale AS (
  SELECT series_key, max(date) AS newest, avg(CAST(total_amount AS DOUBLE)) AS centre,
         CASE WHEN stddev_pop(CAST(total_amount AS DOUBLE)) > 0 THEN stddev_pop(CAST(total_amount AS DOUBLE))
              ELSE 1.0 END AS spread
  FROM r_history GROUP BY 1 HAVING count(*) >= 14),
r_reach AS (
  SELECT min((CAST(total_amount AS DOUBLE) - centre) / spread) AS least,
         max((CAST(total_amount AS DOUBLE) - centre) / spread) AS most
  FROM r_features JOIN r_scale USING (series_key))
SELECT series_key, {day('date')} AS date, CAST(total_amount AS DOUBLE) AS historical,
       CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, CAST(NULL AS BOOLEAN) AS in_range,
       CAST(NULL AS DOUBLE) AS gap FROM r_history
UNION ALL
SELECT series_key, {day('CAST(newest + CAST(i + 1 AS INTEGER) AS DATE)')}, NULL,
       round(greatest(0.0, least * spread + centre), 2), round(greatest(0.0, most * spread + centre), 2),
       true, 0.0::DOUBLE
FROM r_scale, r_reach, range(30) t(i)"""

GROWTH = """
r_base AS (
  SELECT series_key, CAST(sum(CASE WHEN k <= 30 THEN total_amount END) AS DOUBLE) AS previous,
         count(*) AS history_days
  FROM r_ranked GROUP BY 1),
r_total AS (SELECT series_key, sum(predicted_amount) AS predicted_total FROM r_ahead GROUP BY 1),
r_growth AS (
  SELECT series_key, history_days, predicted_total,
         CASE WHEN predicted_total IS NULL THEN NULL
              WHEN history_days >= 30 AND previous > 0
              THEN (predicted_total - previous) / previous * 100 ELSE 0.0 END AS growth_rate
  FROM r_base LEFT JOIN r_total USING (series_key))"""

VERDICT = """CASE WHEN growth_rate IS NULL THEN '无法生成预测，请确保有足够的历史数据。'
  WHEN growth_rate > 10 THEN '预测未来30天销售额将显著增长，建议增加库存和营销投入。'
  WHEN growth_rate > 0 THEN '预测未来30天销售额将稳定增长，建议维持当前经营策略。'
  WHEN growth_rate > -10 THEN '预测未来30天销售额将略有下降，建议适当调整促销策略。'
  ELSE '预测未来30天销售额将显著下降，建议加大促销力度并分析下降原因。' END"""

NAIVE = f"""WITH {history('channel_id')},{features(1)},
r_metrics AS (
  SELECT series_key,
         sum(pow(CAST(total_amount AS DOUBLE) - lag_7, 2)) AS sse, count(*) AS n,
         var_pop(CAST(total_amount AS DOUBLE)) AS variance
  FROM r_features GROUP BY 1),
r_scores AS (
  SELECT series_key, sse / n AS mse, CASE WHEN variance > 0 THEN 1 - sse / (variance * n)
         WHEN sse = 0 THEN 1.0 ELSE 0.0 END AS r2_score
  FROM r_metrics)"""

USERS = """
r_users AS (
  SELECT c_custkey AS id, c_name AS username, c_mktsegment AS nickname, 'user' AS role
  FROM customer)"""

NEWCOMERS = f"""{USERS},
r_new AS (
  SELECT s_suppkey + 1000000000 AS id, s_name AS username, 'supplier' AS nickname FROM supplier
  UNION ALL
  SELECT c_custkey + 2000000000, c_name, 'again' FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT s_suppkey + 3000000000, s_name, 'twice' FROM supplier WHERE s_acctbal < 0)"""

GONE = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"

# A number in (0, 1) from a key and a seed.
UNIT = ("(CAST(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 12) AS BIGINT)"
        " AS DOUBLE) + 0.5) / 281474976710656.0")

RANKING = f"""WITH {ORDERS},{DETAILS},{PRODUCTS}
SELECT p.id AS product_id, p.product_name, p.product_code, c.category_name,
       CAST(sum(d.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(d.total_price) AS DOUBLE) AS total_sales,
       count(DISTINCT o.id) AS order_count,
       {mean('sum(d.total_price)', 'sum(d.quantity)')} AS avg_price
FROM r_details d JOIN r_orders o ON o.id = d.order_id JOIN r_products p ON p.id = d.product_id
     JOIN r_categories c ON c.id = p.category_id
WHERE o.order_status = 3 GROUP BY 1, 2, 3, 4"""

ORACLE: dict[str, str] = {
    # --- dashboard
    "sales_trend": f"""WITH {ORDERS}
SELECT {day('order_date')} AS order_date, CAST(sum(n) AS BIGINT) AS order_count,
       CAST(sum(amount) AS DOUBLE) AS total_amount
FROM (SELECT CAST(create_time AS DATE) AS order_date, 1 AS n, payment_amount AS amount
      FROM r_orders WHERE create_time >= {AS_OF} - INTERVAL 30 DAY
      UNION ALL
      SELECT CAST({AS_OF} - CAST(i AS INTEGER) AS DATE), 0, 0 FROM range(30) t(i))
GROUP BY 1""",
    "user_distribution": """
SELECT CASE WHEN right(n_name, 1) IN ('省', '市', '区')
            THEN regexp_replace(n_name, '[省市区自治]+$', '') ELSE n_name END AS name,
       value, greatest(1, max(value) OVER ()) AS max
FROM (SELECT n_name, count(DISTINCT c_custkey) AS value
      FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name)""",
    "category_sales": f"""WITH {CATEGORY_SALES}
SELECT category_name, CAST(total_sales AS DOUBLE) AS total_sales FROM r_category_sales""",
    "channel_analysis": f"""WITH {ORDERS},{CHANNELS}
SELECT c.channel_name, count(o.id) AS order_count,
       CAST(coalesce(sum(o.payment_amount), 0) AS DOUBLE) AS total_amount
FROM r_channels c LEFT JOIN r_orders o ON o.channel_id = c.id GROUP BY c.channel_name""",
    "user_behavior": """
SELECT CASE event_type WHEN 'view' THEN '浏览' WHEN 'search' THEN '搜索' WHEN 'cart' THEN '加购'
            WHEN 'purchase' THEN '购买' ELSE event_type END AS name, count(*) AS value
FROM events GROUP BY event_type""",
    "payment_methods": f"""WITH {ORDERS}
SELECT CASE payment_method WHEN 'alipay' THEN '支付宝' WHEN 'wechat' THEN '微信支付'
            WHEN 'card' THEN '银行卡' WHEN 'cash' THEN '现金' ELSE payment_method END AS name,
       count(*) AS value
FROM r_orders WHERE payment_status = 1 GROUP BY payment_method""",
    "hot_products": """
SELECT CAST(row_number() OVER (ORDER BY total_quantity DESC, product_name) AS INTEGER) AS rank,
       product_name,
       total_quantity
FROM (SELECT p_name AS product_name, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT)
               AS total_quantity
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_name)
ORDER BY total_quantity DESC, product_name LIMIT 10""",
    "member_consumption": f"""WITH {ORDERS},{LEVELS},
r_spend AS (SELECT user_id, sum(payment_amount) AS spent FROM r_orders
            WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 1)
SELECT level_name, count(user_id) AS user_count,
       CAST(coalesce(sum(spent), 0) AS DOUBLE) AS total_amount,
       coalesce({mean('sum(spent)', 'nullif(count(user_id), 0)', 6)}, 0) AS avg_amount
FROM r_levels LEFT JOIN r_spend ON spent BETWEEN low AND high GROUP BY level_name""",
    "member_consumption_half_open": f"""WITH {ORDERS},{LEVELS},
r_open AS (SELECT *, lead(low) OVER (ORDER BY low) AS following FROM r_levels),
r_spend AS (SELECT user_id, sum(payment_amount) AS spent FROM r_orders
            WHERE user_id IN (SELECT c_custkey FROM customer) GROUP BY 1)
SELECT level_name, count(user_id) AS user_count,
       CAST(coalesce(sum(spent), 0) AS DOUBLE) AS total_amount,
       coalesce({mean('sum(spent)', 'nullif(count(user_id), 0)', 6)}, 0) AS avg_amount
FROM r_open LEFT JOIN r_spend ON spent >= low AND (following IS NULL OR spent < following)
GROUP BY level_name""",
    "member_tier_lookup": f"""WITH {ORDERS},{LEVELS},
r_spend AS (
  SELECT user_id, CASE WHEN user_id % 3 = 0 THEN CAST(-0.001 - CAST(spent AS DECIMAL(24,3)) AS DECIMAL(38,3))
                       WHEN user_id % 5 = 0 THEN CAST(CAST(spent AS DECIMAL(24,2)) * 100000000000 AS DECIMAL(38,3))
                       ELSE CAST(spent AS DECIMAL(38,3)) END AS spent
  FROM (SELECT user_id, sum(payment_amount) AS spent FROM r_orders GROUP BY 1)),
r_every AS (
  SELECT level_name, CAST(low AS DECIMAL(38,3)) AS low, CAST(high AS DECIMAL(38,3)) AS high
  FROM r_levels
  UNION ALL SELECT 'owes ' || level_name, -high, -low FROM r_levels
  UNION ALL SELECT 'rich ' || level_name, low * CAST(100000000000 AS DECIMAL(38,0)),
                   high * CAST(100000000000 AS DECIMAL(38,0)) FROM r_levels WHERE low > 0)
SELECT user_id, CAST(spent AS DOUBLE) AS spent, level_name
FROM r_spend JOIN r_every ON spent BETWEEN low AND high""",
    "hot_products_by_id": """
SELECT CAST(row_number() OVER (ORDER BY total_quantity DESC, product_name, product_id)
            AS INTEGER) AS rank, product_id, product_name, total_quantity
FROM (SELECT p_partkey AS product_id, p_name AS product_name,
             CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
ORDER BY total_quantity DESC, product_name, product_id LIMIT 10""",
    "share_of_total": f"""WITH {CATEGORY_SALES},
r_total AS (SELECT CAST(sum(total_sales) AS DOUBLE) AS total FROM r_category_sales),
r_small AS (SELECT category_name, total_sales, total,
                   CAST(total_sales AS DOUBLE) / total <= 0.165 AS small
            FROM r_category_sales, r_total),
r_fold AS (SELECT *, small AND count(*) FILTER (small) OVER () > 1 AS folded FROM r_small)
SELECT CASE WHEN folded THEN 'Other' ELSE category_name END AS name,
       CAST(sum(total_sales) AS DOUBLE) AS value,
       CAST(sum(total_sales) AS DOUBLE) * 100 / min(total) AS percent
FROM r_fold GROUP BY 1, folded""",
    # --- marts
    "view_sales_summary": f"""WITH {GROSS},{CHANNELS}
SELECT {day('create_time')} AS sale_date, c.channel_type, c.channel_name,
       count(o.id) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_sales,
       CAST(sum(discount_amount) AS DOUBLE) AS total_discount,
       CAST(sum(payment_amount) AS DOUBLE) AS actual_sales,
       {mean('sum(payment_amount)', 'count(o.id)')} AS avg_order_value
FROM r_gross o LEFT JOIN r_channels c ON c.id = o.channel_id
WHERE order_status = 3 GROUP BY 1, 2, 3""",
    "view_product_sales_ranking": RANKING,
    "product_sales_top": f"""SELECT * FROM (
  SELECT *, CAST(rank() OVER (ORDER BY total_sales DESC) AS INTEGER) AS rank FROM ({RANKING})
) ORDER BY total_sales DESC, product_id LIMIT 100""",
    "view_online_offline_comparison": f"""WITH {ORDERS}
SELECT strftime(create_time, '%Y-%m') AS sale_month, order_source, count(id) AS order_count,
       CAST(sum(payment_amount) AS DOUBLE) AS sales_amount,
       count(DISTINCT user_id) AS customer_count,
       {mean('sum(payment_amount)', 'count(id)')} AS avg_order_value
FROM r_orders WHERE order_status = 3 GROUP BY 1, 2""",
    "view_user_purchase_behavior": f"""WITH {ORDERS},{CHANNELS},{USERS}
SELECT u.id AS user_id, u.username, u.nickname, count(o.id) AS order_count,
       CAST(sum(payment_amount) AS DOUBLE) AS total_spent,
       {stamp('max(create_time)')} AS last_purchase_date,
       CAST(date_diff('day', CAST(max(create_time) AS DATE), {AS_OF}) AS INTEGER)
         AS days_since_last_purchase,
       count(DISTINCT CAST(create_time AS DATE)) AS purchase_days,
       {mean('sum(payment_amount)', 'count(o.id)')} AS avg_order_value,
       string_agg(DISTINCT c.channel_name, ', ' ORDER BY c.channel_name) AS used_channels
FROM r_users u JOIN r_orders o ON o.user_id = u.id LEFT JOIN r_channels c ON c.id = o.channel_id
WHERE order_status = 3 GROUP BY 1, 2, 3""",
    "view_campaign_performance": f"""WITH {GROSS},
r_campaigns(id, campaign_name, campaign_type) AS (
  VALUES (1,'Summer','discount'), (2,'Welcome','coupon'), (3,'Members','discount'),
         (4,'Flash','flash_sale'), (5,'Birthday','gift'), (6,'Winter','discount'))
SELECT c.id AS campaign_id, c.campaign_name, c.campaign_type, count(o.id) AS order_count,
       CAST(sum(total_amount) AS DOUBLE) AS gross_sales,
       CAST(sum(discount_amount) AS DOUBLE) AS total_discount,
       CAST(sum(payment_amount) AS DOUBLE) AS net_sales,
       CAST((2 * 10000 * {cents('sum(discount_amount)')} + {cents('sum(total_amount)')})
            // (2 * {cents('sum(total_amount)')}) AS DOUBLE) / 100.0 AS discount_rate_percent,
       count(DISTINCT o.user_id) AS customer_count,
       {mean('sum(payment_amount)', 'nullif(count(o.id), 0)')} AS avg_order_value
FROM r_campaigns c LEFT JOIN r_gross o ON o.campaign_id = c.id AND o.order_status = 3
GROUP BY 1, 2, 3""",
    # --- forecast
    "daily_series": f"""WITH {history('channel_id')}
SELECT series_key, {day('date')} AS date, order_count,
       CAST(total_amount AS DOUBLE) AS total_amount FROM r_history""",
    "calendar_features": f"""WITH {history('channel_id')}
SELECT series_key, {day('date')} AS date, dayofweek, month, day, is_weekend
FROM (SELECT series_key, date, {CALENDAR} FROM r_history)""",
    "lag_features": f"""WITH {history('channel_id')}
SELECT series_key, {day('date')} AS date, {LAGS} FROM r_history {WINDOW}""",
    "rolling_features": f"""WITH {history('channel_id')}
SELECT series_key, {day('date')} AS date, {rolling(0)} FROM r_history""",
    "feature_frame_legacy": feature_frame(0),
    "feature_frame_clean": feature_frame(1),
    "standardise": f"""WITH {history('channel_id')},{features(1)}
SELECT series_key, {day('date')} AS date, """
    + ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER s > 0 THEN "
        f"round(({c} - avg({c}) OVER s) / stddev_pop({c}) OVER s, 6) ELSE 0.0 END AS {c}"
        for c in COLUMNS
    )
    + "\nFROM r_features WINDOW s AS (PARTITION BY series_key)",
    "fit_metrics": f"""{NAIVE},
r_mean AS (SELECT series_key, avg(CAST(total_amount AS DOUBLE)) AS mean FROM r_features GROUP BY 1)
SELECT series_key, round(mse / nullif(mean * mean, 0), 9) AS mse, round(r2_score, 9) AS r2_score
FROM r_scores JOIN r_mean USING (series_key)""",
    "daily_series_by_region": f"""WITH {history('n_name', ORDERS + """,
r_placed AS (
  SELECT o.*, n_name FROM r_orders o LEFT JOIN customer ON c_custkey = user_id
  LEFT JOIN nation ON n_nationkey = c_nationkey)""", 'r_placed')}
SELECT series_key, {day('date')} AS date, order_count, CAST(total_amount AS DOUBLE) AS total_amount FROM r_history""",
    "daily_series_by_category": f"""WITH {history('category_name', ORDERS + "," + DETAILS + "," + PRODUCTS + """,
r_sold AS (
  SELECT o.create_time, c.category_name, sum(actual_price) AS payment_amount
  FROM r_details d JOIN r_orders o ON o.id = d.order_id LEFT JOIN r_products p ON p.id = d.product_id
  LEFT JOIN r_categories c ON c.id = p.category_id
  GROUP BY o.id, o.create_time, c.category_name)""", 'r_sold')}
SELECT series_key, {day('date')} AS date, order_count, CAST(total_amount AS DOUBLE) AS total_amount FROM r_history""",
    "forecast_accuracy": f"""{NAIVE},
r_range AS (SELECT series_key, CAST(min(total_amount) AS DOUBLE) AS lowest,
                   CAST(max(total_amount) AS DOUBLE) AS highest FROM r_history GROUP BY 1)
SELECT series_key, round_even(greatest(0.0, least(100.0, CASE WHEN r2_score > 0
         THEN 100 * r2_score
         ELSE coalesce(100 * (1 - mse / nullif(pow(highest - lowest, 2), 0)), 0.0) END)), 2)
       AS accuracy
FROM r_scores JOIN r_range USING (series_key)""",
    "forecast_weekly_repeat": f"""WITH {history('channel_id')},{REPEAT}
SELECT series_key, {day('date')} AS date, step, predicted_amount FROM r_ahead""",
    "linear_forecast_legacy": f"""WITH {history('channel_id')},{REPEAT}
SELECT series_key, {day('date')} AS date, step, predicted_amount FROM r_ahead""",
    "linear_fit_legacy": f"""WITH {history('channel_id')},{features(0)},{PARTS}
SELECT series_key, {day('date')} AS date, part, CAST(total_amount AS DOUBLE) AS actual,
       CASE WHEN part = 'in_sample' THEN CAST(total_amount AS DOUBLE) END AS predicted
FROM r_parts""",
    "linear_fit": f"""WITH {history('channel_id')},{features(1)},{PARTS}
SELECT series_key, part, count(*) AS n, round(avg(CAST(total_amount AS DOUBLE)), 6) AS mean_actual,
       CASE WHEN part = 'in_sample' THEN 0.0::DOUBLE END AS gap,
       CASE WHEN part = 'in_sample' THEN 0.0::DOUBLE END AS lag_gap
FROM r_parts GROUP BY 1, 2""",
    "linear_forecast": f"""WITH {history('channel_id')},
r_newest AS (
  SELECT series_key, max(date) AS newest, count(*) AS days FROM r_history GROUP BY 1 HAVING count(*) >= 15)
SELECT series_key, {day('CAST(newest + CAST(i + 1 AS INTEGER) AS DATE)')} AS date,
       CAST(i AS INTEGER) AS step, CASE WHEN days > 44 THEN 0.0::DOUBLE END AS change
FROM r_newest, range(30) t(i)""",
    "sales_prediction": f"""WITH {history(None)},{features(0)},
r_fit AS (
  SELECT series_key, count(*) AS fit_days, avg(CAST(total_amount AS DOUBLE)) AS mean FROM r_features GROUP BY 1)
SELECT series_key, 'ok' AS status, count(*) AS prediction_start_index, 'Random Forest' AS model_type,
       any_value(fit_days) AS fit_days, round(any_value(mean), 4) AS mean_amount, 0.0::DOUBLE AS mse_gap,
       0.0::DOUBLE AS r2_gap, 0.0::DOUBLE AS accuracy_gap, true AS centred
FROM r_history JOIN r_fit USING (series_key) GROUP BY 1 HAVING count(*) >= 14""",
    "sales_prediction_curve": f"""WITH {history(None)},{features(0)},{CURVE}""",
    "sales_prediction_by_channel": f"""WITH {history('channel_id')},{features(0)},{CURVE}""",
    "forecast_growth": f"""WITH {history('channel_id')},{REPEAT},{GROWTH}
SELECT series_key, history_days, round(predicted_total, 2) AS predicted_total,
       round(growth_rate, 6) AS growth_rate, {VERDICT} AS conclusion FROM r_growth""",
    "forecast_points": f"""WITH {history(None)},{REPEAT}
SELECT series_key, {day('date')} AS date, CAST(total_amount AS DOUBLE) AS historical,
       CAST(NULL AS DOUBLE) AS predicted FROM r_history
UNION ALL
SELECT series_key, {day('date')}, NULL, predicted_amount FROM r_ahead""",
    "sales_prediction_linear": f"""WITH {history(None)},{REPEAT},{GROWTH}
SELECT series_key, 'ok' AS status, history_days AS prediction_start_index,
       'Linear Regression' AS model_type, 100.0::DOUBLE AS accuracy, 0.0::DOUBLE AS mse,
       1.0::DOUBLE AS r2_score, round_even(growth_rate, 2) AS growth_rate,
       round_even(predicted_total, 2) AS predicted_total, {VERDICT} AS conclusion
FROM r_growth""",
    # --- sources and sync
    "full_scan": f"""SELECT * REPLACE ({stamp('o_orderdate')} AS o_orderdate) FROM orders""",
    "incremental_scan": f"""SELECT * REPLACE ({stamp('o_orderdate')} AS o_orderdate)
FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01 00:00:00'""",
    "high_water_mark": f"SELECT {stamp('max(ts)')} AS high_water_mark FROM events",
    "export_roundtrip": "SELECT * FROM customer",
    "incremental_merge": f"""SELECT * REPLACE ({stamp('o_orderdate')} AS o_orderdate),
       CASE WHEN o_orderdate > DATE '2000-12-31' THEN 1 ELSE 0 END AS o_added FROM orders""",
    "sync_all": """
SELECT 'py_user' AS table_name, count(*) AS row_count, CAST(NULL AS VARCHAR) AS mark
FROM customer
UNION ALL SELECT 'sales_order', count(*), CAST(max(o_orderdate) AS VARCHAR) FROM orders
UNION ALL SELECT 'user_behavior', count(*), CAST(max(ts) AS VARCHAR) FROM events""",
    "bulk_insert": f"SELECT * REPLACE ({stamp('o_orderdate')} AS o_orderdate) FROM orders",
    "truncate_load": f"""SELECT * REPLACE ({stamp('ts')} AS ts) FROM events""",
    "watermark_columns": f"""WITH {ORDERS}
SELECT 'py_user' AS table_name, CAST(NULL AS VARCHAR) AS column_name, 0::BIGINT AS timed_rows
UNION ALL SELECT 'sales_order', 'create_time', count(create_time) FROM r_orders
UNION ALL SELECT 'user_behavior', 'create_time', count(ts) FROM events
UNION ALL SELECT 'sales_detail', NULL, 0""",
    "export_all": """
SELECT 'region' AS table_name, 'full' AS mode, count(*) AS row_count FROM region
UNION ALL SELECT 'nation', 'full', count(*) FROM nation
UNION ALL SELECT 'customer', 'full', count(*) FROM customer
UNION ALL SELECT 'orders', 'full', count(*) FROM orders""",
    "table_list": """
SELECT 'nation' AS table_name, count(*) AS row_count FROM nation
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders""",
    "run_modes": """
SELECT '' AS flag, 'incremental' AS mode, 0::BIGINT AS second_run_rows, count(*) AS held_rows FROM events
UNION ALL SELECT '--full', 'full', count(*), count(*) FROM events
UNION ALL SELECT '--hook', 'full', count(*), count(*) FROM events""",
    "type_mapping": f"""WITH {ORDERS}
SELECT id, 'NO' || id AS order_no, user_id, CAST(channel_id AS DOUBLE) AS channel_id,
       CAST(payment_amount AS DOUBLE) AS payment_amount, {stamp('create_time')} AS create_time,
       CAST(NULL AS DOUBLE) AS store_id,
       CASE WHEN channel_id IS NULL THEN 'channel_id' ELSE '' END AS invalid_columns
FROM r_orders""",
    "latest_version": f"""SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "compacted_merge": f"""SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "sketched_customers": f"""WITH {ORDERS},
r_months AS (SELECT *, strftime(create_time, '%Y-%m') AS month FROM r_orders WHERE create_time IS NOT NULL)
SELECT 'month' AS period, channel_id::DOUBLE AS channel_id, month, count(DISTINCT user_id) AS customer_count, true AS within_bound
FROM r_months GROUP BY 2, 3
UNION ALL
SELECT 'all', channel_id::DOUBLE, NULL, count(DISTINCT user_id), true FROM r_months GROUP BY 2
UNION ALL
SELECT 'all', NULL, NULL, count(DISTINCT user_id), true FROM r_months""",
    "landing_stream": f"""SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    # --- directory
    "user_search_page": f"""WITH {USERS},
r_found AS (SELECT * FROM r_users WHERE role = 'user' AND username ILIKE '%customer#0000001%'),
r_total AS (SELECT count(*) AS total FROM r_found)
SELECT id, username, nickname, role, total, (total + 19) // 20 AS pages
FROM r_found, r_total ORDER BY id DESC LIMIT 20 OFFSET 20""",
    "user_search_trigrams": """
SELECT needle, c_custkey AS id
FROM (VALUES ('MER#00000012'), ('00%77'), ('omer%0_9'), ('99')) n(needle) JOIN customer ON c_name ILIKE '%' || needle || '%'""",
    "user_search_after": f"""WITH {USERS}
SELECT id, username, nickname, role FROM r_users WHERE role = 'user' AND id < 1000
ORDER BY id DESC LIMIT 20""",
    "user_age": """SELECT o_custkey AS user_id, strftime(min(o_orderdate), '%Y-%m-%d') AS birthday,
       CAST(2001 - year(min(o_orderdate)) AS INTEGER) AS age FROM orders GROUP BY 1""",
    "user_by_id": f"WITH {USERS} SELECT id, username, nickname, role FROM r_users WHERE id = 42",
    "user_by_name": f"""WITH {USERS}
SELECT id, username, nickname, role FROM r_users WHERE username = 'Customer#000000042'""",
    "name_conflicts": f"""WITH {NEWCOMERS}
SELECT username, count(*) AS in_batch,
       username IN (SELECT username FROM r_users) AS is_taken
FROM r_new GROUP BY username
HAVING count(*) > 1 OR username IN (SELECT username FROM r_users)""",
    "registration_check": """
SELECT c_custkey AS id,
       CASE WHEN c_nationkey = 3 THEN '请填写所有必填字段'
            WHEN c_acctbal < 0 THEN '两次输入的密码不一致'
            WHEN c_custkey % 3 <> 0 THEN '该用户名已被注册' END AS reject_reason
FROM customer""",
    "apply_inserts": f"""WITH {NEWCOMERS}
SELECT id, username, nickname, role FROM r_users
UNION ALL
SELECT id, username, nickname, 'user' FROM r_new
WHERE username NOT IN (SELECT username FROM r_users)
QUALIFY row_number() OVER (PARTITION BY username ORDER BY id) = 1
UNION ALL
SELECT s_suppkey + 4000000000, NULL, 'nameless', 'user' FROM supplier""",
    "apply_updates": f"""WITH {USERS}
SELECT u.id, u.username,
       CASE WHEN u.nickname = 'MACHINERY'
            THEN CASE WHEN c.c_acctbal >= 0 THEN 'X' END ELSE u.nickname END AS nickname, u.role
FROM r_users u JOIN customer c ON c.c_custkey = u.id""",
    "apply_deletes": f"""WITH {USERS}
SELECT id, username, nickname, role FROM r_users WHERE id NOT IN ({GONE})""",
    "cascade_delete": f"""
WITH kept_orders AS (SELECT * FROM orders WHERE o_custkey NOT IN ({GONE}))
SELECT 'py_user' AS table_name, count(*) AS row_count, CAST(sum(c_custkey) AS BIGINT) AS key_sum
FROM customer WHERE c_custkey NOT IN ({GONE})
UNION ALL SELECT 'user_address', count(*), CAST(sum(c_custkey) AS BIGINT)
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey NOT IN ({GONE})
UNION ALL SELECT 'user_behavior', count(*), CAST(sum(event_id) AS BIGINT)
FROM events WHERE user_id NOT IN ({GONE})
UNION ALL SELECT 'sales_order', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM kept_orders
UNION ALL SELECT 'sales_detail', count(*), CAST(sum(l_orderkey) AS BIGINT)
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders
                                       WHERE o_custkey IN ({GONE}))""",
    "cascade_set_null": f"""WITH {ORDERS}
SELECT id, user_id,
       CAST(CASE WHEN channel_id <> 2 THEN channel_id END AS DOUBLE) AS channel_id
FROM r_orders""",
    # --- quality
    "orphans": f"""WITH {ORDERS},{DETAILS}
SELECT order_id, product_id, quantity, CAST(total_price AS DOUBLE) AS total_price,
       CAST(discount_price AS DOUBLE) AS discount_price,
       CAST(actual_price AS DOUBLE) AS actual_price
FROM (SELECT * REPLACE (CASE WHEN product_id % 7 = 0 THEN order_id + 1000000000 ELSE order_id END
                        AS order_id) FROM r_details)
WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT id FROM r_orders)""",
    "duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS copies
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "null_violations": f"""WITH {ORDERS}
SELECT 'channel_id' AS column_name, count(*) AS null_count FROM r_orders
WHERE channel_id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'campaign_id', count(*) FROM r_orders WHERE campaign_id IS NULL
HAVING count(*) > 0
UNION ALL SELECT 'id', count(*) FROM r_orders WHERE id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'user_id', count(*) FROM r_orders WHERE user_id IS NULL HAVING count(*) > 0
UNION ALL SELECT 'payment_amount', count(*) FROM r_orders WHERE payment_amount IS NULL
HAVING count(*) > 0""",
    "order_total_mismatch": f"""WITH {ORDERS},{DETAILS},
r_sums AS (SELECT order_id, sum(total_price) AS t, sum(discount_price) AS d,
                  sum(actual_price) AS p FROM r_details GROUP BY 1)
SELECT o.id AS order_id, CAST(o.payment_amount AS DOUBLE) AS total_amount,
       CAST(coalesce(t, 0) AS DOUBLE) AS expected_total, 0.0::DOUBLE AS discount_amount,
       CAST(coalesce(d, 0) AS DOUBLE) AS expected_discount,
       CAST(o.payment_amount AS DOUBLE) AS payment_amount,
       CAST(coalesce(p, 0) AS DOUBLE) AS expected_payment
FROM r_orders o LEFT JOIN r_sums s ON s.order_id = o.id
WHERE o.payment_amount <> coalesce(t, 0) OR 0 <> coalesce(d, 0)
   OR o.payment_amount <> coalesce(p, 0)""",
    # --- derived
    "order_totals": f"""WITH {ORDERS},{DETAILS}
SELECT d.order_id, CAST(sum(total_price) AS DOUBLE) AS total_amount,
       CAST(sum(discount_price) AS DOUBLE) AS discount_amount,
       CASE WHEN min(o.order_source) = 'online' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END AS shipping_amount,
       CAST(sum(actual_price) + CASE WHEN min(o.order_source) = 'online' THEN 10 ELSE 0 END
            AS DOUBLE) AS payment_amount
FROM r_details d JOIN r_orders o ON o.id = d.order_id GROUP BY d.order_id""",
    # Amounts in hundredths of a cent; ties go to the even cent.
    "line_amounts": f"""WITH {PRODUCTS},
r_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_rate,
         CASE WHEN l_orderkey % 10 < 3 THEN 1 END AS campaign_id, p.price AS unit_price,
         CAST(p.price * 100 AS BIGINT) * CAST(l_quantity AS BIGINT) AS total_cents,
         CASE WHEN l_orderkey % 10 < 3
              THEN CAST(p.price * 100 AS BIGINT) * CAST(l_quantity AS BIGINT)
                   * CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS BIGINT) ELSE 0 END AS cut
  FROM lineitem JOIN r_products p ON p.id = l_partkey),
r_cut AS (
  SELECT *, cut // 100 + CASE WHEN cut % 100 > 50 OR (cut % 100 = 50 AND (cut // 100) % 2 = 1)
                              THEN 1 ELSE 0 END AS cut_cents
  FROM r_lines)
SELECT order_id, line, product_id, quantity, CAST(discount_rate AS DOUBLE) AS discount_rate,
       CAST(campaign_id AS DOUBLE) AS campaign_id, CAST(unit_price AS DOUBLE) AS unit_price,
       total_cents / 100.0::DOUBLE AS total_price, cut_cents / 100.0::DOUBLE AS discount_price,
       (total_cents - cut_cents) / 100.0::DOUBLE AS actual_price
FROM r_cut""",
    "calendar_weights": f"""WITH {ORDERS},
r_holidays(m, d, w) AS (VALUES (1,1,5), (2,14,3), (5,1,4), (6,18,5), (10,1,5), (11,11,10),
                               (12,12,8), (12,25,3)),
r_days AS (SELECT CAST(create_time AS DATE) AS date, count(*) AS order_count
           FROM r_orders GROUP BY 1),
r_factor AS (
  SELECT date, product(CAST(w AS DOUBLE) / (abs(date_diff('day', make_date(2001, m, d), date)) + 1))
           AS factor
  FROM r_days JOIN r_holidays ON abs(date_diff('day', make_date(2001, m, d), date)) <= 3
  GROUP BY 1)
SELECT {day('date')} AS date, order_count,
       CASE WHEN isodow(date) >= 6 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
         * coalesce(factor, 1.0::DOUBLE) AS weight
FROM r_days LEFT JOIN r_factor USING (date)""",
    "order_lifecycle": f"""WITH {ORDERS}
SELECT id, order_status, CASE WHEN order_status = 0 THEN 0 ELSE 1 END AS payment_status,
       CASE WHEN order_status >= 3 THEN 2 WHEN order_status = 2 THEN 1 ELSE 0 END
         AS delivery_status,
       order_status <> 0 AS has_payment_time, order_status >= 2 AS has_delivery_time,
       order_status >= 3 AS has_complete_time
FROM r_orders""",
    "session_id": """SELECT event_id AS id,
  'SESSION_' || user_id || '_' || strftime(ts, '%Y%m%d') AS session_id FROM events""",
    "price_ladder": f"""WITH {PRODUCTS}
SELECT id, CAST(price AS DOUBLE) AS price,
       CAST(round(price * 0.7, 2) AS DOUBLE) AS cost_price,
       CAST(round(price * 1.2, 2) AS DOUBLE) AS market_price FROM r_products""",
    "product_code": """SELECT p_partkey AS id, substr(p_type, 1, 2) ||
  CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 6 THEN CAST(p_partkey AS VARCHAR)
       ELSE lpad(CAST(p_partkey AS VARCHAR), 6, '0') END AS product_code FROM part""",
    "order_no": """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') ||
  CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 6 THEN CAST(o_orderkey AS VARCHAR)
       ELSE lpad(CAST(o_orderkey AS VARCHAR), 6, '0') END AS order_no FROM orders""",
    "inventory_grid": f"""WITH {ORDERS}
SELECT DISTINCT l_partkey AS product_id, CAST(channel_id AS INTEGER) AS store_id
FROM lineitem JOIN r_orders ON r_orders.id = l_orderkey WHERE channel_id IS NOT NULL""",
    "default_address": """SELECT o_custkey AS user_id, o_orderkey AS id,
  CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END
    AS is_default
FROM orders""",
    "order_default_address": f"""WITH {ORDERS}
SELECT user_id, id, order_source,
       CAST(CASE WHEN order_source = 'online' THEN min(id) OVER (PARTITION BY user_id) END
            AS DOUBLE) AS address_id
FROM r_orders""",
    "weighted_pick": f"""
SELECT CASE WHEN u < 0.4 THEN 'alipay' WHEN u < 0.8 THEN 'wechat' WHEN u < 0.95 THEN 'card'
            ELSE 'cash' END AS payment_method, count(*) AS order_count
FROM (SELECT {UNIT.format(key='o_orderkey', seed=7)} AS u FROM orders) GROUP BY 1""",
    "weighted_sample": f"""
SELECT event_id AS id, user_id, event_type AS behavior_type, {stamp('ts')} AS create_time,
       {day('ts')} AS day
FROM (SELECT *, -ln({UNIT.format(key='event_id', seed=42)})
        / CASE event_type WHEN 'view' THEN 70 WHEN 'search' THEN 15 WHEN 'cart' THEN 10
               WHEN 'purchase' THEN 5 ELSE 1 END AS draw FROM events)
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY draw, event_id) <= 20""",
}

_SORTED = {
    "sales_trend": ("order_date", "order_date"), "user_distribution": ("name", "value DESC, name"),
    "category_sales": ("category_name", "total_sales DESC, category_name"),
    "channel_analysis": ("channel_name", "total_amount DESC, channel_name"),
    "payment_methods": ("name", "value DESC, name"),
    "hot_products": ("product_name", "total_quantity DESC, product_name"),
    "member_consumption": ("level_name", "level_name"),
}
ORACLE["report_order"] = " UNION ALL ".join(
    f"SELECT '{report}' AS report, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position,"
    f" {label} AS label FROM ({ORACLE[report]})"
    for report, (label, order) in _SORTED.items()
)
