"""Temp views (S6) and written tables (S5) under the reference's object names.

``register_views(spark, layers)`` makes ``spark.sql`` see the raw tables, the
CORE tables, the 360 and the marts by the names the reference's queries and
dashboard use. Views are lazy: each is the DataFrame function above, planned
by Catalyst when queried; the 360 underneath is the materialised one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

import os

from churnlens.plans import lifecycle, marts
from churnlens.plans.layers import ChurnLayers
from churnlens.sources.readers import write_table


def _objects(layers: ChurnLayers) -> dict:
    c = layers.c360
    curve = lifecycle.churn_by_tenure(c)
    return {
        **layers.raw,
        "customer_profile": layers.profile,
        "customer_location": layers.location,
        "customer_services": layers.services,
        "customer_snapshot": layers.snapshot,
        "customer_360_view": c,
        "vw_executive_kpis": marts.executive_kpis(c),
        "vw_churn_segments": marts.churn_segments(c),
        "vw_product_adoption": marts.product_adoption(c),
        "vw_product_depth": marts.product_depth(c),
        "vw_customer_value": marts.customer_value(c),
        "vw_churn_reasons": marts.churn_reasons(c),
        "vw_churn_by_tenure": curve,
        "vw_churn_by_tenure_enhanced": lifecycle.churn_by_tenure_enhanced(curve),
        "vw_churn_by_tenure_segment": lifecycle.churn_by_tenure_segment(c),
    }


def register_views(spark: SparkSession, layers: ChurnLayers) -> list[str]:
    """Create or replace one temp view per raw table, CORE table, the 360 and every mart."""
    views = _objects(layers)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def write_marts(layers: ChurnLayers, folder: str, fmt: str = "parquet") -> list[str]:
    """Replace-semantics deployment (S5): ``<folder>/<name>`` per CORE table, 360 and mart.

    Each object is one job writing in parallel from the executors; the raw
    tables are skipped (they are the inputs).
    """
    names = []
    for name, df in _objects(layers).items():
        if name in layers.raw:
            continue
        write_table(df, os.path.join(folder, name), fmt=fmt)
        names.append(name)
    return names
