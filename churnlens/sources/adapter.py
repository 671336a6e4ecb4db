"""Star schema → the five raw churn tables (S8, mapping in FIXTURES.md §2).

Shuffle budget (the adapter is the only step that touches line-level data):

1. lineitem ⋈ part on part key — AQE broadcasts ``part`` when its runtime
   size is under the threshold, otherwise a shuffle join; only
   (part key, type class) is read from ``part``.
2. group lines by order key (partial aggregation first), so the line-level
   relation shrinks to one row per order before it meets ``orders``.
3. orders ⋈ per-order sums on order key, then group by customer.
4. events grouped by user (partial aggregation; a hot user is absorbed by the
   map-side combine).
5. customer ⋈ per-customer results on the customer key; nation and region are
   25 and 5 rows and joined by AQE's size check.

The result is one wide row per customer; the five raw tables are
projections of it (population aside, which comes from ``supplier``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the mapping (FIXTURES.md §2).
PART_TYPE_SERVICES = [
    ("ECONOMY", "phone_service"),
    ("LARGE", "multiple_lines"),
    ("MEDIUM", "internet_service"),
    ("PROMO", "online_security"),
    ("SMALL", "online_backup"),
    ("STANDARD", "device_protection_plan"),
]
EVENT_TYPE_SERVICES = [
    ("click", "premium_tech_support"),
    ("error", "streaming_tv"),
    ("purchase", "streaming_movies"),
    ("signup", "streaming_music"),
    ("view", "unlimited_data"),
]
CHURN_AFTER_DAYS = 365
JOINED_WITHIN_MONTHS = 60
SERVICE_SHARE_FACTOR = 5  # 'Yes' when lines of the class × 5 ≥ all lines


def _months(ts):
    return F.year(ts) * 12 + F.month(ts)


def _per_order_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc_pct"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    cls = part.select("p_partkey", F.substring_index("p_type", " ", 1).alias("type_class"))
    joined = li.join(cls, li.l_partkey == cls.p_partkey, "left")
    aggs = [F.count(F.lit(1)).alias("lines")]
    for type_class, service in PART_TYPE_SERVICES:
        aggs.append(F.count_if(F.col("type_class") == type_class).alias(f"n_{service}"))
    aggs += [
        F.sum("cents").alias("gross_cents"),
        F.sum(F.when(F.col("returned"), F.col("cents")).otherwise(0)).alias("refund_cents"),
        F.sum(F.col("cents") * (100 - F.col("disc_pct"))).alias("rev_e4"),
        F.sum("qty").alias("qty"),
        F.count_if("returned").alias("returned_lines"),
    ]
    return joined.groupBy("l_orderkey").agg(*aggs)


def _per_customer_orders(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                      "o_orderdate")
    joined = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    last_key = F.struct("o_orderdate", "o_orderkey")
    sums = ["lines"] + [f"n_{s}" for _, s in PART_TYPE_SERVICES] + [
        "gross_cents", "refund_cents", "rev_e4", "qty", "returned_lines"]
    return joined.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.max_by("o_orderstatus", last_key).alias("last_status"),
        F.max_by("o_orderpriority", last_key).alias("last_priority"),
        *[F.sum(c).alias(c) for c in sums],
    )


def _per_user_events(events: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("ev_n"),
            F.max_by("event_type", F.struct("ts", "event_id")).alias("latest_event_type")]
    for etype, service in EVENT_TYPE_SERVICES:
        aggs.append(F.count_if(F.col("event_type") == etype).alias(f"n_{service}"))
    return events.groupBy("user_id").agg(*aggs)


def _share_rule(n_class: str, n_all: str):
    return (F.when(F.col(n_all).isNull(), F.lit(None).cast("string"))
            .when(F.col(n_class) * SERVICE_SHARE_FACTOR >= F.col(n_all), "Yes")
            .otherwise("No"))


def customer_wide(star: dict[str, DataFrame], partitions: int | None = None) -> DataFrame:
    """One row per customer with every raw column the star schema can supply."""
    orders, lineitem = star["orders"], star["lineitem"]
    per_order = _per_order_lines(lineitem, star["part"])
    per_cust = _per_customer_orders(orders, per_order)
    per_user = _per_user_events(star["events"])
    # One-row global aggregate; broadcasting a single row is size-proven.
    as_of = orders.agg(F.max("o_orderdate").alias("as_of"))

    geo = (star["nation"].select("n_nationkey", "n_name", "n_regionkey")
           .join(star["region"].select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    cust = star["customer"].select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    w = (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
         .join(per_cust, cust.c_custkey == per_cust.o_custkey, "left")
         .join(per_user, cust.c_custkey == per_user.user_id, "left")
         .crossJoin(F.broadcast(as_of)))

    tenure = (_months(F.col("last_order")) - _months(F.col("first_order"))).cast("bigint")
    denom = F.greatest(tenure, F.lit(1).cast("bigint"))
    rev_cents = F.expr("(rev_e4 + 50) DIV 100")  # rev_e4 ≥ 0: half up to whole cents
    days_since = F.datediff(F.to_date("as_of"), F.to_date("last_order")).cast("bigint")
    churn_value = (F.when(F.col("last_order").isNull(), F.lit(None))
                   .when(days_since > CHURN_AFTER_DAYS, 1).otherwise(0)).cast("bigint")
    age = (F.lit(18) + (F.col("c_custkey") * 37) % 65).cast("bigint")

    cols = [
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.lit(1).cast("bigint").alias("count"),
        # demographics (stand-ins: the star schema has no such fields)
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        age.alias("age"),
        F.when(age < 30, "Yes").otherwise("No").alias("under_30"),
        F.when(age >= 65, "Yes").otherwise("No").alias("senior_citizen"),
        # location
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.col("c_nationkey").cast("bigint").alias("zip_code"),
        # services
        F.concat(F.lit("Q"), F.quarter("as_of").cast("string")).alias("quarter"),
        tenure.alias("tenure_in_months"),
        F.nullif(F.col("last_status"), F.lit("O")).alias("offer"),
        F.col("latest_event_type").alias("internet_type"),
        F.expr("qty DIV _denom").alias("avg_monthly_gb_download"),
        F.col("c_mktsegment").alias("contract"),
        F.col("last_priority").alias("payment_method"),
    ]
    for _, service in PART_TYPE_SERVICES:
        cols.append(_share_rule(f"n_{service}", "lines").alias(service))
    for _, service in EVENT_TYPE_SERVICES:
        cols.append(_share_rule(f"{service}_ev", "ev_n").alias(service))

    w = w.select("*", rev_cents.alias("rev_cents"), tenure.alias("_tenure"),
                 denom.alias("_denom"), days_since.alias("days_since"),
                 churn_value.alias("_churn_value"),
                 *[F.col(f"n_{s}").alias(f"{s}_ev") for _, s in EVENT_TYPE_SERVICES])

    def money_from_cents(c):
        return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(18,2)")

    monthly_cents = F.expr("(rev_cents * 2 + _denom) DIV (_denom * 2)")
    joined_recent = ((_months(F.col("as_of")) - _months(F.col("first_order")))
                     <= JOINED_WITHIN_MONTHS)
    status = (F.when(F.col("_churn_value") == 1, "Churned")
              .when(F.col("first_order").isNull(), F.lit(None).cast("string"))
              .when(joined_recent, "Joined").otherwise("Stayed"))
    satisfaction = F.expr("CASE WHEN lines IS NULL OR lines = 0 THEN CAST(NULL AS BIGINT) "
                          "ELSE CAST(5 - LEAST(4, (returned_lines * 10) DIV lines) AS BIGINT) END")
    cols += [
        money_from_cents(monthly_cents).alias("monthly_charge"),
        money_from_cents(F.col("gross_cents")).alias("total_charges"),
        money_from_cents(F.col("refund_cents")).alias("total_refunds"),
        money_from_cents(F.col("rev_cents")).alias("total_revenue"),
        # status
        satisfaction.alias("satisfaction_score"),
        status.alias("customer_status"),
        F.when(F.col("_churn_value") == 1, "Yes")
        .when(F.col("_churn_value") == 0, "No").alias("churn_label"),
        F.col("_churn_value").alias("churn_value"),
        F.col("days_since").alias("churn_score"),
        F.floor("c_acctbal").cast("bigint").alias("cltv"),
        F.when(F.col("_churn_value") == 1, F.col("last_status")).alias("churn_category"),
        F.when(F.col("_churn_value") == 1, F.col("last_priority")).alias("churn_reason"),
    ]
    out = w.select(*cols)
    if partitions:
        # Only useful when the caller keeps the partitioning (a checkpoint drops it).
        out = out.repartition(partitions, "customer_id")
    return out


def _typed_null(dtype: str):
    return F.lit(None).cast(dtype)


# Raw columns the star schema has no source for: typed NULLs.
NULL_COLUMNS = {"married": "string", "dependents": "string", "number_of_dependents": "bigint",
                "city": "string", "lat_long": "string", "latitude": "double",
                "longitude": "double", "referred_a_friend": "string",
                "number_of_referrals": "bigint",
                "avg_monthly_long_distance_charges": "decimal(18,2)",
                "paperless_billing": "string", "total_extra_data_charges": "bigint",
                "total_long_distance_charges": "decimal(18,2)"}


def raw_flat(wide: DataFrame) -> DataFrame:
    """The wide rows with every column of every customer-keyed raw table, typed."""
    from churnlens.sources.schema import CUSTOMER_TABLES, RAW_SCHEMAS

    cols, seen = [], set()
    for table in CUSTOMER_TABLES:
        for field in RAW_SCHEMAS[table].fields:
            if field.name in seen:
                continue
            seen.add(field.name)
            if field.name in NULL_COLUMNS:
                cols.append(_typed_null(NULL_COLUMNS[field.name]).alias(field.name))
            else:
                cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return wide.select(*cols)


def raw_tables(flat: DataFrame, supplier: DataFrame) -> dict[str, DataFrame]:
    """Project the flat customer rows onto the reference's five raw tables."""
    from churnlens.sources.schema import CUSTOMER_TABLES, RAW_SCHEMAS

    out = {t: flat.select(*[f.name for f in RAW_SCHEMAS[t].fields]) for t in CUSTOMER_TABLES}
    pop = supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("population"))
    out["churn_population"] = pop.select(
        F.col("s_nationkey").cast("bigint").alias("id"),
        F.col("s_nationkey").cast("bigint").alias("zip_code"),
        F.col("population").cast("bigint"))
    return out
