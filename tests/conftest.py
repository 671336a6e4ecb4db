import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from churnlens import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="churnlens-tests")
    yield s
    s.stop()


def c360_rows(spark, rows, **defaults):
    """A minimal 360 DataFrame from dicts (missing columns are NULL)."""
    from pyspark.sql import types as T

    from churnlens.plans.core import C360_COLS

    types = {
        "age": T.LongType(), "zip_code": T.LongType(), "latitude": T.DoubleType(),
        "longitude": T.DoubleType(), "population": T.LongType(),
        "number_of_referrals": T.LongType(), "number_of_dependents": T.LongType(),
        "avg_monthly_long_distance_charges": T.DecimalType(18, 2),
        "avg_monthly_gb_download": T.LongType(), "core_service_count": T.IntegerType(),
        "add_on_service_count": T.IntegerType(), "total_service_count": T.IntegerType(),
        "monthly_charge": T.DecimalType(18, 2), "total_charges": T.DecimalType(18, 2),
        "total_refunds": T.DecimalType(18, 2), "total_extra_data_charges": T.LongType(),
        "total_long_distance_charges": T.DecimalType(18, 2),
        "total_revenue": T.DecimalType(18, 2), "tenure_in_months": T.LongType(),
        "churn_value": T.LongType(), "churn_flag": T.IntegerType(), "churn_score": T.LongType(),
        "satisfaction_score": T.LongType(), "cltv": T.LongType(), "cltv_quartile": T.IntegerType(),
        "high_value_flag": T.IntegerType(),
    }
    schema = T.StructType([T.StructField(c, types.get(c, T.StringType()), True)
                           for c in C360_COLS])
    from decimal import Decimal
    data = []
    for r in rows:
        full = {**defaults, **r}
        vals = []
        for f in schema.fields:
            v = full.get(f.name)
            if v is not None and isinstance(f.dataType, T.DecimalType):
                v = Decimal(str(v))
            vals.append(v)
        data.append(tuple(vals))
    return spark.createDataFrame(data, schema)
