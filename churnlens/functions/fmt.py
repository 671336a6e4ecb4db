"""Business formatting of result tables (B6) with column functions only.

Rates are shown as percentages with two decimals, counts with thousands
separators, money with '$' and two decimals, CLTV as a plain number (it is a
source-provided indicator, not currency). A value that is not numeric becomes
''. Unknown columns are left untouched.

Percentages are built from the rate's integer ten-thousandths, so the text is
exact (no float tie is ever formatted).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed display names of the reference's result tables (technical → business).
FRIENDLY_NAMES = {
    "segment_value": "Segment",
    "dimension_name": "Dimension",
    "total_customers": "Total Customers",
    "customers": "Customers",
    "churned_customers": "Churned Customers",
    "churn_rate": "Churn Rate",
    "churn_contribution": "Churn Contribution",
    "product_name": "Product",
    "adoption_status": "Adoption Status",
    "adopted_customers": "Adopted Customers",
    "adopted_churn_rate": "Adopted Churn Rate",
    "not_adopted_customers": "Non-Adopted Customers",
    "not_adopted_churn_rate": "Non-Adopted Churn Rate",
    "churn_rate_gap": "Churn Rate Gap",
    "customer_value_segment": "Customer Value Segment",
    "cltv": "CLTV",
    "avg_cltv": "Average CLTV",
    "min_cltv": "Minimum CLTV",
    "max_cltv": "Maximum CLTV",
    "monthly_charge": "Monthly Charge",
    "avg_monthly_charge": "Average Monthly Charge",
    "total_monthly_charges": "Total Monthly Charges",
    "churned_monthly_revenue": "Churned Monthly Charges",
    "total_historical_revenue": "Historical Revenue",
    "churned_historical_revenue": "Churned Historical Revenue",
    "avg_total_revenue": "Average Historical Revenue",
    "tenure_month": "Tenure Month",
    "tenure_in_months": "Tenure (Months)",
    "avg_tenure_months": "Average Tenure (Months)",
    "customers_reaching_tenure": "Customers Reaching Tenure",
    "churned_at_tenure": "Churned at Tenure",
    "churn_rate_at_tenure": "Observed Churn Rate at Tenure",
    "contract": "Contract",
    "contract_type": "Contract Type",
    "payment_method": "Payment Method",
    "offer": "Offer",
    "age_band": "Age Band",
    "satisfaction_score": "Satisfaction Score",
    "churn_category": "Reported Churn Category",
    "churn_reason": "Reported Churn Reason",
}
PERCENT = ["Churn Rate", "Churn Contribution", "Adopted Churn Rate", "Non-Adopted Churn Rate",
           "Churn Rate Gap", "Observed Churn Rate at Tenure"]
COUNTS = ["Total Customers", "Customers", "Churned Customers", "Adopted Customers",
          "Non-Adopted Customers", "Customers Reaching Tenure", "Churned at Tenure",
          "Tenure Month"]
MONEY = ["Monthly Charge", "Average Monthly Charge", "Total Monthly Charges",
         "Churned Monthly Charges", "Historical Revenue", "Churned Historical Revenue",
         "Average Historical Revenue"]
CLTV = ["CLTV", "Average CLTV", "Minimum CLTV", "Maximum CLTV"]


def _num(c: str) -> Column:
    n = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return F.when(F.abs(n) < 1e14, n)        # NaN and infinite values print as ''


def percent_text(c: str) -> Column:
    """0.4584 → '45.84%'; -0.0123 → '-1.23%'; non-numeric → ''."""
    e4 = F.round(_num(c) * 10000).cast("bigint")
    a = F.abs(e4)
    txt = F.concat(F.when(e4 < 0, "-").otherwise(""), (a / 100).cast("bigint").cast("string"),
                   F.lit("."), F.lpad((a % 100).cast("string"), 2, "0"), F.lit("%"))
    return F.when(e4.isNull(), "").otherwise(txt)


def count_text(c: str) -> Column:
    v = _num(c)
    return F.when(v.isNull(), "").otherwise(F.format_number(v, 0))


def money_text(c: str) -> Column:
    v = _num(c)
    return F.when(v.isNull(), "").otherwise(F.concat(F.lit("$"), F.format_number(v, 2)))


def cltv_text(c: str) -> Column:
    v = _num(c)
    return F.when(v.isNull(), "").otherwise(F.format_number(v, 2))


def business_format(df: DataFrame) -> DataFrame:
    """Rename known columns and format them; other columns pass through."""
    renamed = df.withColumnsRenamed({k: v for k, v in FRIENDLY_NAMES.items() if k in df.columns})
    out = []
    for c in renamed.columns:
        if c in PERCENT:
            out.append(percent_text(c).alias(c))
        elif c in COUNTS:
            out.append(count_text(c).alias(c))
        elif c in MONEY:
            out.append(money_text(c).alias(c))
        elif c in CLTV:
            out.append(cltv_text(c).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return renamed.select(*out)
