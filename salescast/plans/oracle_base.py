"""SQL (DuckDB dialect) for the oracle: the same raw views, features and star
as ``sources.testviews`` + ``operators.star``, written independently as CTEs.

``with_base(select, ctes)`` prefixes a query with the base CTEs.
"""

from __future__ import annotations

from salescast.functions import fixed
from salescast.sources import testviews


def case_map(col: str, mapping: dict, default, cast: str | None = None) -> str:
    parts = []
    for k, v in mapping.items():
        key = "'" + str(k).replace("'", "''") + "'"
        val = f"CAST('{v}' AS {cast})" if cast else ("'" + str(v).replace("'", "''") + "'")
        parts.append(f"WHEN {key} THEN {val}")
    if default is None:
        els = ""
    else:
        els = f" ELSE CAST('{default}' AS {cast})" if cast else f" ELSE '{default}'"
    return f"(CASE {col} {' '.join(parts)}{els} END)"


FAM_CAT = testviews.test_family_to_category()
STATE_REGION = testviews.TEST_STATE_TO_REGION


def category_sql(col: str = "family") -> str:
    return case_map(col, FAM_CAT, fixed.DEFAULT_CATEGORY)


def price_sql(cat: str) -> str:
    return case_map(cat, fixed.AVG_PRICES, fixed.DEFAULT_PRICE, "DECIMAL(6,2)")


def rate_sql(cat: str) -> str:
    return case_map(cat, fixed.MARGIN_RATES, fixed.DEFAULT_MARGIN_RATE, "DECIMAL(6,2)")


def date_key_sql(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def calendar_sql(d: str) -> str:
    return f"""CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month,
      CAST(isodow({d}) - 1 AS INTEGER) AS day_of_week, CAST(day({d}) AS INTEGER) AS day_of_month,
      CAST(weekofyear({d}) AS INTEGER) AS week_of_year, CAST(quarter({d}) AS INTEGER) AS quarter,
      CAST(isodow({d}) >= 6 AS INTEGER) AS is_weekend,
      CAST(day({d}) = 15 OR day({d}) = day(last_day({d})) AS INTEGER) AS is_payday,
      CAST(day({d}) <= 5 AS INTEGER) AS is_month_start"""


def raw_forecast_sql() -> str:
    """The rule forecast before noise, clipping and rounding."""
    return f"""COALESCE({case_map('family', fixed.DEMO_FAMILY_BASE, fixed.DEMO_DEFAULT_BASE, 'DOUBLE')}, 50.0)
           * (CASE WHEN is_weekend = 1 THEN CAST(1.15 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)
           * (CAST(1.0 AS DOUBLE) + CAST(0.15 AS DOUBLE) * sin(CAST({2 * 3.141592653589793!r} AS DOUBLE) * (month - 3) / 12))
           * (CAST(0.8 AS DOUBLE) + CAST(0.4 AS DOUBLE) * (store_nbr % 10) / 10)"""


def forecast_chain(frame: str, p: str) -> str:
    """Rule forecast (noise 0) and forecast fact over a frame CTE."""
    ff = "fact_forecasts" if p == "fc" else "bt_forecasts"
    return f"""{p}_pred AS (
  SELECT *, round_even(greatest({raw_forecast_sql()}, CAST(0.0 AS DOUBLE)), 0) AS predicted_sales,
         {category_sql('family')} AS category
  FROM {frame}),
{p}1 AS (
  SELECT p.date, {date_key_sql('p.date')} AS date_key, p.store_nbr AS store_key, d.product_key,
         CAST(p.predicted_sales AS DOUBLE) AS predicted_sales,
         CAST(round_even(CAST(p.predicted_sales AS DECIMAL(18,4)) * {price_sql('p.category')}, 2) AS DECIMAL(18,4)) AS predicted_revenue,
         p.category,
         datediff('day', (SELECT MIN(date) FROM {p}_pred), p.date) AS days_ahead
  FROM {p}_pred p LEFT JOIN dim_product d ON p.family = d.family),
{ff} AS (
  SELECT date, date_key, store_key, product_key, predicted_sales, predicted_revenue,
         CAST(round_even(predicted_revenue * {rate_sql('category')}, 2) AS DECIMAL(18,4)) AS predicted_margin,
         CASE WHEN days_ahead > -1 AND days_ahead <= 30 THEN '30-Day'
              WHEN days_ahead > 30 AND days_ahead <= 60 THEN '60-Day'
              WHEN days_ahead > 60 AND days_ahead <= 90 THEN '90-Day' END AS forecast_horizon
  FROM {p}1)"""


FFILL = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

BASE = f"""
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_quantity, l.l_discount,
         CAST(o.o_orderdate AS DATE) AS date, s.s_nationkey AS store_nbr
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN supplier s ON l.l_suppkey = s.s_suppkey),
train_raw AS (
  SELECT date, store_nbr, p.p_brand AS family, SUM(l_quantity) AS sales,
         CAST(COUNT(*) FILTER (WHERE l_discount >= CAST({testviews.PROMO_DISCOUNT} AS DOUBLE)) AS INTEGER) AS onpromotion
  FROM lines JOIN part p ON lines.l_partkey = p.p_partkey
  GROUP BY date, store_nbr, p.p_brand),
train AS (
  SELECT date, store_nbr, family,
         CASE WHEN sales IS NULL THEN NULL ELSE greatest(sales, CAST(0.0 AS DOUBLE)) END AS sales, onpromotion
  FROM train_raw),
stores AS (
  SELECT CAST(n_nationkey AS INTEGER) AS store_nbr, n_name AS city, r_name AS state,
         (['A','B','C','D','E'])[n_nationkey % 5 + 1] AS type,
         CAST(n_regionkey + 1 AS INTEGER) AS cluster
  FROM nation JOIN region ON n_regionkey = r_regionkey),
oil_raw AS (
  SELECT CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) / CAST({testviews.OIL_SCALE} AS DOUBLE) AS dcoilwtico
  FROM orders WHERE isodow(CAST(o_orderdate AS DATE)) <= 5 GROUP BY 1),
oil_days AS (
  SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT MIN(date) AS lo, MAX(date) AS hi
        FROM (SELECT date FROM oil_raw UNION ALL SELECT date FROM train))),
oil_daily AS (
  SELECT d.date, r.dcoilwtico FROM oil_days d
  LEFT JOIN (SELECT date, MIN(dcoilwtico) AS dcoilwtico FROM oil_raw GROUP BY date) r ON d.date = r.date),
oil_ff AS (
  SELECT date, COALESCE(dcoilwtico, LAST_VALUE(dcoilwtico IGNORE NULLS) OVER (ORDER BY date {FFILL})) AS ff
  FROM oil_daily),
oil AS (
  SELECT date, COALESCE(ff, LAST_VALUE(ff IGNORE NULLS) OVER (ORDER BY date DESC {FFILL})) AS oil_price
  FROM oil_ff),
holidays AS (
  SELECT date, MAX(CAST(NOT transferred AS INTEGER)) AS is_holiday
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority = '5-LOW' AS transferred
        FROM orders
        WHERE day(o_orderdate) = 1 OR (month(o_orderdate) = 12 AND day(o_orderdate) = 25))
  GROUP BY date),
transactions AS (
  SELECT date, store_nbr, CAST(COUNT(DISTINCT l_orderkey) AS INTEGER) AS transactions
  FROM lines GROUP BY date, store_nbr),
feat0 AS (
  SELECT t.date, t.store_nbr, t.family, t.sales, t.onpromotion, s.city, s.state, s.type, s.cluster,
         o.oil_price, COALESCE(h.is_holiday, 0) AS is_holiday,
         COALESCE(CAST(x.transactions AS DOUBLE), 0.0) AS transactions,
         {calendar_sql('t.date')},
         LAG(o.oil_price, 7) OVER (PARTITION BY t.store_nbr, t.family ORDER BY t.date) AS lag7
  FROM train t
  LEFT JOIN stores s ON t.store_nbr = s.store_nbr
  LEFT JOIN oil o ON t.date = o.date
  LEFT JOIN holidays h ON t.date = h.date
  LEFT JOIN transactions x ON t.date = x.date AND t.store_nbr = x.store_nbr),
features AS (
  SELECT date, store_nbr, family, sales, onpromotion, city, state, type, cluster, oil_price,
         is_holiday, transactions, year, month, day_of_week, day_of_month, week_of_year, quarter,
         is_weekend, is_payday, is_month_start,
         COALESCE(lag7, LAST_VALUE(lag7 IGNORE NULLS) OVER (
             PARTITION BY store_nbr, family ORDER BY date DESC {FFILL})) AS oil_price_lag7
  FROM feat0),
dim_date AS (
  SELECT d AS date, {date_key_sql('d')} AS date_key, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
         CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
         CAST(year(d) AS INTEGER) AS fiscal_year, strftime(d, '%Y-%m') AS year_month,
         CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
         CAST(d IN (SELECT date FROM features WHERE is_holiday = 1) AS INTEGER) AS is_holiday
  FROM (SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT MIN(date) AS lo, MAX(date) AS hi FROM features))),
dim_store AS (
  SELECT DISTINCT store_nbr, city, state, type AS store_type, cluster, store_nbr AS store_key,
         {case_map('state', STATE_REGION, fixed.DEFAULT_REGION)} AS region
  FROM features),
dim_product AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY family) AS INTEGER) AS product_key, family,
         {category_sql('family')} AS category
  FROM (SELECT DISTINCT family FROM features)),
fs0 AS (
  SELECT f.date, f.sales, f.onpromotion, f.oil_price, f.is_holiday, f.transactions,
         {date_key_sql('f.date')} AS date_key, f.store_nbr AS store_key, p.product_key,
         CAST(CAST(f.sales AS DECIMAL(22,6)) * {price_sql(category_sql('f.family'))} AS DECIMAL(29,8)) AS revenue,
         {category_sql('f.family')} AS category
  FROM features f LEFT JOIN dim_product p ON f.family = p.family),
fact_sales AS (
  SELECT date, sales, onpromotion, oil_price, is_holiday, transactions, date_key, store_key,
         product_key, revenue, CAST(revenue * {rate_sql('category')} AS DECIMAL(36,10)) AS margin
  FROM fs0),
sales_star AS (
  SELECT f.*, p.family, p.category, s.city, s.state, s.store_type, s.region, s.cluster,
         d.year AS d_year, d.month AS d_month
  FROM fact_sales f LEFT JOIN dim_product p ON f.product_key = p.product_key
  LEFT JOIN dim_store s ON f.store_key = s.store_key
  LEFT JOIN dim_date d ON f.date_key = d.date_key),
fc_frame AS (
  SELECT g.store_nbr, g.family, g.date, s.store_key, s.city, s.state, s.store_type AS type, s.cluster,
         {calendar_sql('g.date')}
  FROM (SELECT store_nbr, family,
               CAST(UNNEST(generate_series(CAST(st AS TIMESTAMP), CAST(st + 89 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT DISTINCT store_nbr, family FROM features),
             (SELECT MAX(date) + 1 AS st FROM features)) g
  LEFT JOIN dim_store s ON g.store_nbr = s.store_key),
bt_frame AS (
  SELECT date, store_nbr, family, is_weekend, month FROM features
  WHERE date > (SELECT MAX(date) - 90 FROM features)),
{forecast_chain("fc_frame", "fc")},
{forecast_chain("bt_frame", "bt")},
fc_star AS (
  SELECT f.*, p.family, p.category, s.city, s.state, s.store_type, s.region
  FROM fact_forecasts f LEFT JOIN dim_product p ON f.product_key = p.product_key
  LEFT JOIN dim_store s ON f.store_key = s.store_key)
"""


def with_base(select: str, ctes: str = "") -> str:
    body = select.strip()
    if body[:4].upper() == "WITH":
        # the query's own CTEs follow the base ones
        body = ",\n" + body[4:].lstrip()
        return f"WITH {BASE}{(',' + ctes) if ctes.strip() else ''}{body}"
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {BASE}{extra}\n{body}"
