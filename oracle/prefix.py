"""DuckDB rendering of adapter → raw → CORE → 360, as a list of CTEs.

Written independently of the Spark code (window functions where Spark uses
``max_by``, NTILE where Spark uses the distributed rank), so agreement checks
both. Tables ``customer orders lineitem part nation region supplier events``
are the driver's pre-registered views.
"""

from __future__ import annotations

CTES = r"""
o_asof AS (SELECT MAX(o_orderdate) AS as_of FROM orders),
o_line AS (
  SELECT l.l_orderkey,
         ROUND(l.l_extendedprice * 100)::BIGINT AS cents,
         ROUND(l.l_discount * 100)::BIGINT AS disc_pct,
         l.l_quantity::BIGINT AS qty,
         l.l_returnflag = 'R' AS returned,
         split_part(p.p_type, ' ', 1) AS type_class
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
o_order AS (
  SELECT l_orderkey,
         COUNT(*) AS lines,
         COUNT(*) FILTER (WHERE type_class = 'ECONOMY') AS n_economy,
         COUNT(*) FILTER (WHERE type_class = 'LARGE') AS n_large,
         COUNT(*) FILTER (WHERE type_class = 'MEDIUM') AS n_medium,
         COUNT(*) FILTER (WHERE type_class = 'PROMO') AS n_promo,
         COUNT(*) FILTER (WHERE type_class = 'SMALL') AS n_small,
         COUNT(*) FILTER (WHERE type_class = 'STANDARD') AS n_standard,
         SUM(cents) AS gross_cents,
         SUM(CASE WHEN returned THEN cents ELSE 0 END) AS refund_cents,
         SUM(cents * (100 - disc_pct)) AS rev_e4,
         SUM(qty) AS qty,
         COUNT(*) FILTER (WHERE returned) AS returned_lines
  FROM o_line GROUP BY l_orderkey
),
o_ranked AS (
  SELECT o.*, ROW_NUMBER() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders o
),
o_cust AS (
  SELECT o.o_custkey,
         MIN(o.o_orderdate) AS first_order,
         MAX(o.o_orderdate) AS last_order,
         MAX(CASE WHEN o.rn = 1 THEN o.o_orderstatus END) AS last_status,
         MAX(CASE WHEN o.rn = 1 THEN o.o_orderpriority END) AS last_priority,
         SUM(x.lines) AS lines,
         SUM(x.n_economy) AS n_economy, SUM(x.n_large) AS n_large,
         SUM(x.n_medium) AS n_medium, SUM(x.n_promo) AS n_promo,
         SUM(x.n_small) AS n_small, SUM(x.n_standard) AS n_standard,
         SUM(x.gross_cents) AS gross_cents, SUM(x.refund_cents) AS refund_cents,
         SUM(x.rev_e4) AS rev_e4, SUM(x.qty) AS qty,
         SUM(x.returned_lines) AS returned_lines
  FROM o_ranked o LEFT JOIN o_order x ON o.o_orderkey = x.l_orderkey
  GROUP BY o.o_custkey
),
o_ev_ranked AS (
  SELECT e.*, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events e
),
o_user AS (
  SELECT user_id,
         COUNT(*) AS ev_n,
         MAX(CASE WHEN rn = 1 THEN event_type END) AS latest_event_type,
         COUNT(*) FILTER (WHERE event_type = 'click') AS n_click,
         COUNT(*) FILTER (WHERE event_type = 'error') AS n_error,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
         COUNT(*) FILTER (WHERE event_type = 'signup') AS n_signup,
         COUNT(*) FILTER (WHERE event_type = 'view') AS n_view
  FROM o_ev_ranked GROUP BY user_id
),
o_w0 AS (
  SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name,
         oc.*, u.*, a.as_of,
         (year(oc.last_order) * 12 + month(oc.last_order))
           - (year(oc.first_order) * 12 + month(oc.first_order)) AS tenure,
         date_diff('day', oc.last_order::DATE, a.as_of::DATE) AS days_since,
         (18 + (c.c_custkey * 37) % 65) AS age_v
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN o_cust oc ON c.c_custkey = oc.o_custkey
  LEFT JOIN o_user u ON c.c_custkey = u.user_id
  CROSS JOIN o_asof a
),
o_w1 AS (
  SELECT *,
         CASE WHEN tenure IS NULL THEN NULL WHEN tenure < 1 THEN 1 ELSE tenure END AS denom,
         (rev_e4 + 50) // 100 AS rev_cents,
         CASE WHEN last_order IS NULL THEN NULL WHEN days_since > 365 THEN 1 ELSE 0 END
           AS churn_v
  FROM o_w0
),
o_wide AS (
  SELECT
    c_custkey::VARCHAR AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    age_v::BIGINT AS age,
    CASE WHEN age_v < 30 THEN 'Yes' ELSE 'No' END AS under_30,
    CASE WHEN age_v >= 65 THEN 'Yes' ELSE 'No' END AS senior_citizen,
    n_name AS country, r_name AS state, c_nationkey::BIGINT AS zip_code,
    'Q' || quarter(as_of)::VARCHAR AS quarter,
    tenure::BIGINT AS tenure_in_months,
    NULLIF(last_status, 'O') AS offer,
    latest_event_type AS internet_type,
    (qty // denom)::BIGINT AS avg_monthly_gb_download,
    c_mktsegment AS contract,
    last_priority AS payment_method,
    CASE WHEN lines IS NULL THEN NULL WHEN n_economy * 5 >= lines THEN 'Yes' ELSE 'No' END AS phone_service,
    CASE WHEN lines IS NULL THEN NULL WHEN n_large * 5 >= lines THEN 'Yes' ELSE 'No' END AS multiple_lines,
    CASE WHEN lines IS NULL THEN NULL WHEN n_medium * 5 >= lines THEN 'Yes' ELSE 'No' END AS internet_service,
    CASE WHEN lines IS NULL THEN NULL WHEN n_promo * 5 >= lines THEN 'Yes' ELSE 'No' END AS online_security,
    CASE WHEN lines IS NULL THEN NULL WHEN n_small * 5 >= lines THEN 'Yes' ELSE 'No' END AS online_backup,
    CASE WHEN lines IS NULL THEN NULL WHEN n_standard * 5 >= lines THEN 'Yes' ELSE 'No' END AS device_protection_plan,
    CASE WHEN ev_n IS NULL THEN NULL WHEN n_click * 5 >= ev_n THEN 'Yes' ELSE 'No' END AS premium_tech_support,
    CASE WHEN ev_n IS NULL THEN NULL WHEN n_error * 5 >= ev_n THEN 'Yes' ELSE 'No' END AS streaming_tv,
    CASE WHEN ev_n IS NULL THEN NULL WHEN n_purchase * 5 >= ev_n THEN 'Yes' ELSE 'No' END AS streaming_movies,
    CASE WHEN ev_n IS NULL THEN NULL WHEN n_signup * 5 >= ev_n THEN 'Yes' ELSE 'No' END AS streaming_music,
    CASE WHEN ev_n IS NULL THEN NULL WHEN n_view * 5 >= ev_n THEN 'Yes' ELSE 'No' END AS unlimited_data,
    ((((rev_cents * 2 + denom) // (denom * 2)))::DECIMAL(18,0) * 0.01::DECIMAL(2,2))::DECIMAL(18,2) AS monthly_charge,
    (gross_cents::DECIMAL(18,0) * 0.01::DECIMAL(2,2))::DECIMAL(18,2) AS total_charges,
    (refund_cents::DECIMAL(18,0) * 0.01::DECIMAL(2,2))::DECIMAL(18,2) AS total_refunds,
    (rev_cents::DECIMAL(18,0) * 0.01::DECIMAL(2,2))::DECIMAL(18,2) AS total_revenue,
    CASE WHEN lines IS NULL OR lines = 0 THEN NULL
         ELSE (5 - LEAST(4, (returned_lines * 10) // lines))::BIGINT END AS satisfaction_score,
    CASE WHEN churn_v = 1 THEN 'Churned'
         WHEN first_order IS NULL THEN NULL
         WHEN (year(as_of) * 12 + month(as_of)) - (year(first_order) * 12 + month(first_order)) <= 60
           THEN 'Joined'
         ELSE 'Stayed' END AS customer_status,
    CASE WHEN churn_v = 1 THEN 'Yes' WHEN churn_v = 0 THEN 'No' END AS churn_label,
    churn_v::BIGINT AS churn_value,
    days_since::BIGINT AS churn_score,
    FLOOR(c_acctbal)::BIGINT AS cltv,
    CASE WHEN churn_v = 1 THEN last_status END AS churn_category,
    CASE WHEN churn_v = 1 THEN last_priority END AS churn_reason
  FROM o_w1
),
raw_demographics AS (
  SELECT customer_id, 1::BIGINT AS count, gender, age, under_30, senior_citizen,
         NULL::VARCHAR AS married, NULL::VARCHAR AS dependents,
         NULL::BIGINT AS number_of_dependents
  FROM o_wide
),
raw_location AS (
  SELECT customer_id, 1::BIGINT AS count, country, state, NULL::VARCHAR AS city, zip_code,
         NULL::VARCHAR AS lat_long, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude
  FROM o_wide
),
raw_population AS (
  SELECT s_nationkey::BIGINT AS id, s_nationkey::BIGINT AS zip_code,
         COUNT(*)::BIGINT AS population
  FROM supplier GROUP BY s_nationkey
),
raw_services AS (
  SELECT customer_id, 1::BIGINT AS count, quarter, NULL::VARCHAR AS referred_a_friend,
         NULL::BIGINT AS number_of_referrals, tenure_in_months, offer, phone_service,
         NULL::DECIMAL(18,2) AS avg_monthly_long_distance_charges, multiple_lines,
         internet_service, internet_type, avg_monthly_gb_download, online_security,
         online_backup, device_protection_plan, premium_tech_support, streaming_tv,
         streaming_movies, streaming_music, unlimited_data, contract,
         NULL::VARCHAR AS paperless_billing, payment_method, monthly_charge, total_charges,
         total_refunds, NULL::BIGINT AS total_extra_data_charges,
         NULL::DECIMAL(18,2) AS total_long_distance_charges, total_revenue
  FROM o_wide
),
raw_status AS (
  SELECT customer_id, 1::BIGINT AS count, quarter, satisfaction_score, customer_status,
         churn_label, churn_value, churn_score, cltv, churn_category, churn_reason
  FROM o_wide
),
core_profile AS (
  SELECT customer_id, gender, age, under_30, senior_citizen, married, dependents,
         number_of_dependents,
         CASE WHEN age < 30 THEN 'Under 30'
              WHEN age BETWEEN 30 AND 44 THEN '30-44'
              WHEN age BETWEEN 45 AND 59 THEN '45-59'
              WHEN age BETWEEN 60 AND 74 THEN '60-74'
              WHEN age >= 75 THEN '75+'
              ELSE 'Unknown' END AS age_band
  FROM raw_demographics
),
core_location AS (
  SELECT l.customer_id, l.country, l.state, l.city, l.zip_code, l.latitude, l.longitude,
         p.population
  FROM raw_location l LEFT JOIN raw_population p ON l.zip_code = p.zip_code
),
core_services AS (
  SELECT customer_id, referred_a_friend, number_of_referrals, offer, phone_service,
         multiple_lines, internet_service, internet_type, avg_monthly_long_distance_charges,
         avg_monthly_gb_download, online_security, online_backup, device_protection_plan,
         premium_tech_support, streaming_tv, streaming_movies, streaming_music, unlimited_data,
         contract, paperless_billing, payment_method, monthly_charge, total_charges,
         total_refunds, total_extra_data_charges, total_long_distance_charges, total_revenue,
         ((CASE WHEN phone_service = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN internet_service = 'Yes' THEN 1 ELSE 0 END))::INTEGER AS core_service_count,
         ((CASE WHEN multiple_lines = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN online_security = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN online_backup = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN device_protection_plan = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN premium_tech_support = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_tv = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_movies = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_music = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN unlimited_data = 'Yes' THEN 1 ELSE 0 END))::INTEGER AS add_on_service_count,
         ((CASE WHEN phone_service = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN internet_service = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN multiple_lines = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN online_security = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN online_backup = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN device_protection_plan = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN premium_tech_support = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_tv = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_movies = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN streaming_music = 'Yes' THEN 1 ELSE 0 END)
          + (CASE WHEN unlimited_data = 'Yes' THEN 1 ELSE 0 END))::INTEGER AS total_service_count
  FROM raw_services
),
core_snapshot AS (
  SELECT s.customer_id,
         s.quarter AS snapshot_quarter,
         sv.tenure_in_months,
         CASE WHEN sv.tenure_in_months <= 6 THEN '0-6 months'
              WHEN sv.tenure_in_months <= 12 THEN '7-12 months'
              WHEN sv.tenure_in_months <= 24 THEN '13-24 months'
              WHEN sv.tenure_in_months <= 48 THEN '25-48 months'
              WHEN sv.tenure_in_months <= 60 THEN '49-60 months'
              ELSE '61+ months' END AS tenure_band,
         s.customer_status, s.churn_label, s.churn_value,
         (CASE WHEN s.churn_value = 1 THEN 1 ELSE 0 END)::INTEGER AS churn_flag,
         s.churn_score, s.satisfaction_score,
         CASE WHEN s.satisfaction_score <= 2 THEN 'Low'
              WHEN s.satisfaction_score = 3 THEN 'Medium'
              WHEN s.satisfaction_score >= 4 THEN 'High'
              ELSE 'Unknown' END AS satisfaction_band,
         s.cltv,
         NTILE(4) OVER (ORDER BY s.cltv ASC NULLS LAST, s.customer_id ASC NULLS LAST)::INTEGER
           AS cltv_quartile,
         s.churn_category, s.churn_reason
  FROM raw_status s LEFT JOIN raw_services sv ON s.customer_id = sv.customer_id
),
core_snapshot2 AS (
  SELECT customer_id, snapshot_quarter, tenure_in_months, tenure_band, customer_status,
         churn_label, churn_value, churn_flag, churn_score, satisfaction_score,
         satisfaction_band, cltv, cltv_quartile,
         CASE WHEN cltv_quartile = 1 THEN 'Low Value'
              WHEN cltv_quartile = 2 THEN 'Mid-Low Value'
              WHEN cltv_quartile = 3 THEN 'Mid-High Value'
              WHEN cltv_quartile = 4 THEN 'High Value' END AS customer_value_segment,
         (CASE WHEN cltv_quartile = 4 THEN 1 ELSE 0 END)::INTEGER AS high_value_flag,
         churn_category, churn_reason
  FROM core_snapshot
),
c360 AS (
  SELECT p.customer_id,
         p.gender, p.age, p.age_band, p.under_30, p.senior_citizen, p.married, p.dependents,
         p.number_of_dependents,
         l.country, l.state, l.city, l.zip_code, l.latitude, l.longitude, l.population,
         sv.referred_a_friend, sv.number_of_referrals,
         sv.offer, sv.contract, sv.payment_method, sv.paperless_billing,
         sv.phone_service, sv.multiple_lines, sv.internet_service, sv.internet_type,
         sv.avg_monthly_long_distance_charges, sv.avg_monthly_gb_download,
         sv.online_security, sv.online_backup, sv.device_protection_plan,
         sv.premium_tech_support, sv.streaming_tv, sv.streaming_movies, sv.streaming_music,
         sv.unlimited_data,
         sv.core_service_count, sv.add_on_service_count, sv.total_service_count,
         sv.monthly_charge, sv.total_charges, sv.total_refunds, sv.total_extra_data_charges,
         sv.total_long_distance_charges, sv.total_revenue,
         sn.snapshot_quarter, sn.tenure_in_months, sn.tenure_band,
         sn.customer_status, sn.churn_label, sn.churn_value, sn.churn_flag, sn.churn_score,
         sn.satisfaction_score, sn.satisfaction_band,
         sn.cltv, sn.cltv_quartile, sn.customer_value_segment, sn.high_value_flag,
         sn.churn_category, sn.churn_reason
  FROM core_profile p
  JOIN core_location l ON p.customer_id = l.customer_id
  JOIN core_services sv ON p.customer_id = sv.customer_id
  JOIN core_snapshot2 sn ON p.customer_id = sn.customer_id
),
c360m AS (
  SELECT *,
         (monthly_charge * 100)::BIGINT AS mc_cents,
         (total_revenue * 100)::BIGINT AS rev_cents
  FROM c360
)"""


def with_prefix(body: str) -> str:
    """``body`` is either ``SELECT ...`` or ``name AS (...), ... SELECT ...`` continuing the CTEs."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {CTES}\n{body}"
    return f"WITH {CTES},\n{body}"


def rd(num: str, den: str, scale: int) -> str:
    """DuckDB twin of ``functions.exact.round_div_sql``: round(num/den, scale), half away from 0."""
    p = 10 ** scale
    n = f"(({num})::HUGEINT)"
    d = f"((NULLIF({den}, 0))::HUGEINT)"
    return (f"((CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * "
            f"((ABS({n}) * {2 * p} + {d}) // (2 * {d}))::DOUBLE / {p}::DOUBLE)")


def ratio4(num: str, den: str) -> str:
    return rd(num, den, 4)


def pct2(num: str, den: str) -> str:
    return rd(f"({num})::HUGEINT * 100", den, 2)


def avg2(total: str, count: str) -> str:
    return rd(total, count, 2)


def avg_money(total_cents: str, count: str) -> str:
    return f"({rd(total_cents, count, 0)} / 100::DOUBLE)"


def money(total_cents: str) -> str:
    return f"(({total_cents})::DOUBLE / 100::DOUBLE)"


def index2(a: str, b: str, big_a: str, big_b: str) -> str:
    return rd(f"({a})::HUGEINT * ({big_b})::HUGEINT", f"({b})::HUGEINT * ({big_a})::HUGEINT", 2)
