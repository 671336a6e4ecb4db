"""CORE projections and the customer 360.

Every function is DataFrame → DataFrame. Two ways to the 360:

* ``customer_360``: the reference's form — three inner joins of the four CORE
  tables on ``customer_id`` (raw files with arbitrary keys, duplicates fan out);
* ``customer_360_single``: one projection of one row per customer, used when the
  raw tables are projections of the same rows and ids are verified unique.

Both use the same column functions (``functions.bands``), and a test checks
they give identical rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions import bands
from churnlens.operators.ranking import ntile_by_boundaries, scalable_ntile
from churnlens.session import materialize

PROFILE_COLS = ["customer_id", "gender", "age", "under_30", "senior_citizen", "married",
                "dependents", "number_of_dependents"]
LOCATION_COLS = ["customer_id", "country", "state", "city", "zip_code", "latitude",
                 "longitude"]
SERVICES_COLS = [
    "customer_id", "referred_a_friend", "number_of_referrals", "offer", "phone_service",
    "multiple_lines", "internet_service", "internet_type",
    "avg_monthly_long_distance_charges", "avg_monthly_gb_download", "online_security",
    "online_backup", "device_protection_plan", "premium_tech_support", "streaming_tv",
    "streaming_movies", "streaming_music", "unlimited_data", "contract", "paperless_billing",
    "payment_method", "monthly_charge", "total_charges", "total_refunds",
    "total_extra_data_charges", "total_long_distance_charges", "total_revenue",
]

# Column order of the 360 (61 columns).
C360_COLS = [
    "customer_id",
    "gender", "age", "age_band", "under_30", "senior_citizen", "married", "dependents",
    "number_of_dependents",
    "country", "state", "city", "zip_code", "latitude", "longitude", "population",
    "referred_a_friend", "number_of_referrals",
    "offer", "contract", "payment_method", "paperless_billing",
    "phone_service", "multiple_lines", "internet_service", "internet_type",
    "avg_monthly_long_distance_charges", "avg_monthly_gb_download",
    "online_security", "online_backup", "device_protection_plan", "premium_tech_support",
    "streaming_tv", "streaming_movies", "streaming_music", "unlimited_data",
    "core_service_count", "add_on_service_count", "total_service_count",
    "monthly_charge", "total_charges", "total_refunds", "total_extra_data_charges",
    "total_long_distance_charges", "total_revenue",
    "snapshot_quarter", "tenure_in_months", "tenure_band",
    "customer_status", "churn_label", "churn_value", "churn_flag", "churn_score",
    "satisfaction_score", "satisfaction_band",
    "cltv", "cltv_quartile", "customer_value_segment", "high_value_flag",
    "churn_category", "churn_reason",
]


_UNIQUE = "_churnlens_unique_ids"


def mark_unique_ids(df: DataFrame, col: str = "customer_id") -> DataFrame:
    """Note on this very DataFrame object that ``col`` was verified unique and non-NULL.

    Set only after a check (``plans.layers`` does it once per build). Every operation
    (union, join, explode, filter, ...) returns a new object without the note, so
    whatever is derived counts distinct ids again unless it is checked anew.
    """
    setattr(df, _UNIQUE, col)
    return df


def ids_unique(df: DataFrame, col: str = "customer_id") -> bool:
    return df.__dict__.get(_UNIQUE) == col


def customer_count(df: DataFrame, col: str = "customer_id"):
    """COUNT(DISTINCT id), or COUNT(id) when ids are verified unique.

    Equal results; the plain count is a partial aggregation, whereas a distinct
    count shuffles every (group, id) pair — after an unpivot, 8-11 rows per
    customer.
    """
    return F.count(col) if ids_unique(df, col) else F.count_distinct(col)


def customer_profile(demographics: DataFrame) -> DataFrame:
    """Profile projection with the age band; ``count`` is dropped."""
    return demographics.select(*PROFILE_COLS, bands.age_band("age").alias("age_band"))


def customer_location(location: DataFrame, population: DataFrame) -> DataFrame:
    """LEFT JOIN on ZIP; unmatched ZIPs keep NULL population, duplicate ZIPs fan out.

    The population table is one row per ZIP (tens of thousands at most); AQE
    broadcasts it after measuring it, else a shuffle join is used.
    """
    pop = population.select("zip_code", "population")
    return location.select(*LOCATION_COLS).join(pop, "zip_code", "left").select(
        *LOCATION_COLS, "population")


def customer_services(services: DataFrame) -> DataFrame:
    """Services projection and the three service counts."""
    core = bands.yes_count(bands.CORE_SERVICES)
    add_on = bands.yes_count(bands.ADD_ON_SERVICES)
    return services.select(
        *SERVICES_COLS,
        core.alias("core_service_count"),
        add_on.alias("add_on_service_count"),
        bands.yes_count(bands.CORE_SERVICES + bands.ADD_ON_SERVICES).alias(
            "total_service_count"),
    )


def cltv_order():
    """Order of the value quartile: CLTV ascending, NULLs last, customer id as tie-break."""
    return [F.col("cltv").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]


def customer_snapshot(status: DataFrame, services: DataFrame, *,
                      partitions: int | None = None, unique_ids: bool = False) -> DataFrame:
    """Status LEFT JOIN services for tenure; bands, flag and value quartile.

    With ``unique_ids`` (status and services verified unique on customer_id, so
    (cltv, customer_id) is a unique key of the snapshot) the quartile ranks only
    the narrow key (``ntile_by_boundaries``); otherwise the whole rows are range
    partitioned and ranked (``scalable_ntile``), which splits exact ties like SQL.
    """
    s = status.alias("s")
    sv = services.select("customer_id", "tenure_in_months").alias("sv")
    base = s.join(sv, F.col("s.customer_id") == F.col("sv.customer_id"), "left").select(
        F.col("s.customer_id").alias("customer_id"),
        F.col("s.quarter").alias("snapshot_quarter"),
        F.col("sv.tenure_in_months").alias("tenure_in_months"),
        "s.customer_status", "s.churn_label", "s.churn_value", "s.churn_score",
        "s.satisfaction_score", "s.cltv", "s.churn_category", "s.churn_reason",
    )
    if unique_ids:
        ranked = ntile_by_boundaries(base, 4, ["cltv", "customer_id"], "cltv_quartile",
                                     partitions=partitions)
    else:
        ranked = scalable_ntile(base, 4, cltv_order(), "cltv_quartile", partitions=partitions)
    return ranked.select(
        "customer_id", "snapshot_quarter", "tenure_in_months",
        bands.tenure_band("tenure_in_months").alias("tenure_band"),
        "customer_status", "churn_label", "churn_value",
        bands.churn_flag("churn_value").alias("churn_flag"),
        "churn_score", "satisfaction_score",
        bands.satisfaction_band("satisfaction_score").alias("satisfaction_band"),
        "cltv", "cltv_quartile",
        bands.value_segment("cltv_quartile").alias("customer_value_segment"),
        bands.high_value_flag("cltv_quartile").alias("high_value_flag"),
        "churn_category", "churn_reason",
    )


SNAPSHOT_COLS = ["customer_id", "snapshot_quarter", "tenure_in_months", "tenure_band",
                 "customer_status", "churn_label", "churn_value", "churn_flag", "churn_score",
                 "satisfaction_score", "satisfaction_band", "cltv", "cltv_quartile",
                 "customer_value_segment", "high_value_flag", "churn_category", "churn_reason"]


def customer_360_single(flat: DataFrame, population: DataFrame) -> DataFrame:
    """C1-C15 as ONE projection when all raw tables are projections of one row per customer.

    With verified-unique, non-NULL customer ids and a population table unique
    on ZIP, the reference's three inner joins of four projections of the same
    row are the identity, and ``status LEFT JOIN services`` is that row too.
    So the 360 is the row itself plus the derived columns (the same column
    functions as the joined path). The value quartile uses
    ``ntile_by_boundaries``: only (cltv, customer_id) is ranked; the wide rows
    are never shuffled. The population join is a ZIP-sized table (AQE
    broadcasts it after measuring it).
    """
    # one row per ZIP, written once: keeps its aggregation out of every later read
    pop = materialize(population.select("zip_code", "population"),
                      f"population-{uuid.uuid4().hex[:12]}")
    j = flat.join(pop, "zip_code", "left").withColumnRenamed("quarter", "snapshot_quarter")
    ranked = ntile_by_boundaries(j, 4, ["cltv", "customer_id"], "cltv_quartile")
    derived = {
        "age_band": bands.age_band("age"),
        "core_service_count": bands.yes_count(bands.CORE_SERVICES),
        "add_on_service_count": bands.yes_count(bands.ADD_ON_SERVICES),
        "total_service_count": bands.yes_count(bands.CORE_SERVICES + bands.ADD_ON_SERVICES),
        "tenure_band": bands.tenure_band("tenure_in_months"),
        "churn_flag": bands.churn_flag("churn_value"),
        "satisfaction_band": bands.satisfaction_band("satisfaction_score"),
        "customer_value_segment": bands.value_segment("cltv_quartile"),
        "high_value_flag": bands.high_value_flag("cltv_quartile"),
    }
    return ranked.select(*[derived[c].alias(c) if c in derived else F.col(c)
                           for c in C360_COLS])


def customer_360(profile: DataFrame, location: DataFrame, services: DataFrame,
                 snapshot: DataFrame) -> DataFrame:
    """INNER JOIN of the four CORE tables on customer_id (61 columns)."""
    j = (profile.join(location, "customer_id", "inner")
         .join(services, "customer_id", "inner")
         .join(snapshot, "customer_id", "inner"))
    return j.select(*C360_COLS)


def with_depth_segment(c360: DataFrame) -> DataFrame:
    """Product depth segment from the total service count."""
    return c360.withColumn("product_depth_segment", bands.depth_segment("total_service_count"))
