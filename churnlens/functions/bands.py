"""Derived segment columns of the CORE layer.

All are built-in ``when`` chains, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's outputs.
AGE_BANDS = ["Under 30", "30-44", "45-59", "60-74", "75+", "Unknown"]
TENURE_BANDS = ["0-6 months", "7-12 months", "13-24 months", "25-48 months",
                "49-60 months", "61+ months"]
SATISFACTION_BANDS = ["Low", "Medium", "High", "Unknown"]
VALUE_SEGMENTS = ["Low Value", "Mid-Low Value", "Mid-High Value", "High Value"]
DEPTH_SEGMENTS = ["1-2 Services", "3-4 Services", "5-7 Services", "8+ Services"]
CORE_SERVICES = ["phone_service", "internet_service"]
ADD_ON_SERVICES = ["multiple_lines", "online_security", "online_backup",
                   "device_protection_plan", "premium_tech_support", "streaming_tv",
                   "streaming_movies", "streaming_music", "unlimited_data"]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_band(age: Column | str = "age") -> Column:
    a = _c(age)
    return (F.when(a < 30, "Under 30")
            .when(a.between(30, 44), "30-44")
            .when(a.between(45, 59), "45-59")
            .when(a.between(60, 74), "60-74")
            .when(a >= 75, "75+")
            .otherwise("Unknown"))


def tenure_band(tenure: Column | str = "tenure_in_months") -> Column:
    """NULL tenure falls through to '61+ months', as in the reference."""
    t = _c(tenure)
    return (F.when(t <= 6, "0-6 months")
            .when(t <= 12, "7-12 months")
            .when(t <= 24, "13-24 months")
            .when(t <= 48, "25-48 months")
            .when(t <= 60, "49-60 months")
            .otherwise("61+ months"))


def satisfaction_band(score: Column | str = "satisfaction_score") -> Column:
    s = _c(score)
    return (F.when(s <= 2, "Low")
            .when(s == 3, "Medium")
            .when(s >= 4, "High")
            .otherwise("Unknown"))


def churn_flag(churn_value: Column | str = "churn_value") -> Column:
    """1 iff churn_value = 1; NULL → 0."""
    return F.when(_c(churn_value) == 1, 1).otherwise(0).cast("int")


def yes_count(cols: list[str]) -> Column:
    """Number of columns equal to 'Yes' (NULL counts as 0)."""
    total = None
    for c in cols:
        term = F.when(F.col(c) == "Yes", 1).otherwise(0)
        total = term if total is None else total + term
    return total.cast("int")


def value_segment(quartile: Column | str = "cltv_quartile") -> Column:
    q = _c(quartile)
    return (F.when(q == 1, "Low Value")
            .when(q == 2, "Mid-Low Value")
            .when(q == 3, "Mid-High Value")
            .when(q == 4, "High Value"))


def high_value_flag(quartile: Column | str = "cltv_quartile") -> Column:
    return F.when(_c(quartile) == 4, 1).otherwise(0).cast("int")


def depth_segment(total_services: Column | str = "total_service_count") -> Column:
    """'1-2 Services' also holds customers with 0 services (trap 8)."""
    n = _c(total_services)
    return (F.when(n <= 2, "1-2 Services")
            .when(n <= 4, "3-4 Services")
            .when(n <= 7, "5-7 Services")
            .otherwise("8+ Services"))
