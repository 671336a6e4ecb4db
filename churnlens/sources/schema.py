"""Declared schemas of the five raw tables.

Column names are the reference's, lower-cased (Spark resolves names case
insensitively by default). Money columns, FLOAT in the warehouse DDL, are read as
``DECIMAL(18,2)`` so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, M = T.StringType(), T.LongType(), T.DoubleType(), T.DecimalType(18, 2)


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


DEMOGRAPHICS = _struct([
    ("customer_id", S), ("count", L), ("gender", S), ("age", L), ("under_30", S),
    ("senior_citizen", S), ("married", S), ("dependents", S), ("number_of_dependents", L),
])

LOCATION = _struct([
    ("customer_id", S), ("count", L), ("country", S), ("state", S), ("city", S),
    ("zip_code", L), ("lat_long", S), ("latitude", D), ("longitude", D),
])

POPULATION = _struct([("id", L), ("zip_code", L), ("population", L)])

SERVICES = _struct([
    ("customer_id", S), ("count", L), ("quarter", S), ("referred_a_friend", S),
    ("number_of_referrals", L), ("tenure_in_months", L), ("offer", S), ("phone_service", S),
    ("avg_monthly_long_distance_charges", M), ("multiple_lines", S), ("internet_service", S),
    ("internet_type", S), ("avg_monthly_gb_download", L), ("online_security", S),
    ("online_backup", S), ("device_protection_plan", S), ("premium_tech_support", S),
    ("streaming_tv", S), ("streaming_movies", S), ("streaming_music", S), ("unlimited_data", S),
    ("contract", S), ("paperless_billing", S), ("payment_method", S), ("monthly_charge", M),
    ("total_charges", M), ("total_refunds", M), ("total_extra_data_charges", L),
    ("total_long_distance_charges", M), ("total_revenue", M),
])

STATUS = _struct([
    ("customer_id", S), ("count", L), ("quarter", S), ("satisfaction_score", L),
    ("customer_status", S), ("churn_label", S), ("churn_value", L), ("churn_score", L),
    ("cltv", L), ("churn_category", S), ("churn_reason", S),
])

RAW_SCHEMAS = {
    "churn_demographics": DEMOGRAPHICS,
    "churn_location": LOCATION,
    "churn_population": POPULATION,
    "churn_services": SERVICES,
    "churn_status": STATUS,
}

# Tables keyed by customer (population is keyed by ZIP).
CUSTOMER_TABLES = ["churn_demographics", "churn_location", "churn_services", "churn_status"]

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "conversations"]
