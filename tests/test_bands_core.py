"""CORE bands and counts on the hand-made edge rows of FIXTURES §3."""
from pyspark.sql import functions as F

from churnlens.functions import bands


def _one(spark, col_type, values, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {col_type}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_age_band_edges(spark):
    got = _one(spark, "long", [None, 29, 30, 44, 45, 59, 60, 74, 75], bands.age_band)
    assert got == ["Unknown", "Under 30", "30-44", "30-44", "45-59", "45-59", "60-74",
                   "60-74", "75+"]


def test_tenure_band_null_lands_in_61_plus(spark):
    got = _one(spark, "long", [None, 6, 7, 12, 13, 24, 25, 48, 49, 60, 61], bands.tenure_band)
    assert got == ["61+ months", "0-6 months", "7-12 months", "7-12 months", "13-24 months",
                   "13-24 months", "25-48 months", "25-48 months", "49-60 months",
                   "49-60 months", "61+ months"]


def test_satisfaction_and_flag(spark):
    assert _one(spark, "long", [None, 2, 3, 4], bands.satisfaction_band) == [
        "Unknown", "Low", "Medium", "High"]
    assert _one(spark, "long", [None, 0, 1], bands.churn_flag) == [0, 0, 1]


def test_depth_segment_holds_zero(spark):
    assert _one(spark, "int", [0, 2, 3, 4, 5, 7, 8, 11], bands.depth_segment) == [
        "1-2 Services", "1-2 Services", "3-4 Services", "3-4 Services", "5-7 Services",
        "5-7 Services", "8+ Services", "8+ Services"]


def test_all_services_null_count_zero(spark):
    from churnlens.plans.core import customer_services
    from churnlens.sources.schema import SERVICES
    row = tuple(["c1"] + [None] * (len(SERVICES.fields) - 1))
    df = spark.createDataFrame([row], SERVICES)
    r = customer_services(df).first()
    assert (r.core_service_count, r.add_on_service_count, r.total_service_count) == (0, 0, 0)
    seg = customer_services(df).select(bands.depth_segment("total_service_count")).first()[0]
    assert seg == "1-2 Services"


def test_snapshot_keeps_customer_missing_from_services_but_360_drops_it(spark):
    from churnlens.plans import core
    from churnlens.sources.schema import DEMOGRAPHICS, LOCATION, POPULATION, SERVICES, STATUS

    def rows(schema, data):
        return spark.createDataFrame(
            [tuple(d.get(f.name) for f in schema.fields) for d in data], schema)

    ids = ["a", "b"]
    demo = rows(DEMOGRAPHICS, [{"customer_id": i, "age": 40} for i in ids])
    loc = rows(LOCATION, [{"customer_id": i, "zip_code": 1} for i in ids])
    pop = rows(POPULATION, [{"id": 1, "zip_code": 1, "population": 10}])
    serv = rows(SERVICES, [{"customer_id": "a", "tenure_in_months": 5, "contract": "X"}])
    stat = rows(STATUS, [{"customer_id": i, "churn_value": 1, "cltv": 3} for i in ids])
    snap = core.customer_snapshot(stat, serv)
    assert sorted(r.customer_id for r in snap.collect()) == ["a", "b"]
    b = snap.filter(F.col("customer_id") == "b").first()
    assert b.tenure_in_months is None and b.tenure_band == "61+ months"
    c360 = core.customer_360(core.customer_profile(demo), core.customer_location(loc, pop),
                             core.customer_services(serv), snap)
    assert [r.customer_id for r in c360.collect()] == ["a"]
    assert len(c360.columns) == 61


def test_duplicate_status_row_fans_out_through_the_360(spark):
    from churnlens.plans import core, marts, quality
    from churnlens.plans.layers import ChurnLayers
    from churnlens.sources.schema import DEMOGRAPHICS, LOCATION, POPULATION, SERVICES, STATUS

    def rows(schema, data):
        return spark.createDataFrame(
            [tuple(d.get(f.name) for f in schema.fields) for d in data], schema)

    ids = ["a", "b", "c"]
    raw = {
        "churn_demographics": rows(DEMOGRAPHICS, [{"customer_id": i, "age": 40} for i in ids]),
        "churn_location": rows(LOCATION, [{"customer_id": i, "zip_code": 1} for i in ids]),
        "churn_population": rows(POPULATION, [{"id": 1, "zip_code": 1, "population": 9}]),
        "churn_services": rows(SERVICES, [{"customer_id": i, "tenure_in_months": 3,
                                           "contract": "M", "quarter": "Q3"} for i in ids]),
        "churn_status": rows(STATUS, [{"customer_id": "a", "churn_value": 1, "cltv": 5,
                                       "quarter": "Q3"},
                                      {"customer_id": "a", "churn_value": 1, "cltv": 6,
                                       "quarter": "Q3"},
                                      {"customer_id": "b", "churn_value": 0, "cltv": 7,
                                       "quarter": "Q3"},
                                      {"customer_id": "c", "churn_value": 0, "cltv": 8,
                                       "quarter": "Q3"}]),
    }
    d2 = {r.table_name: r.duplicate_rows
          for r in quality.uniqueness({"churn_status": raw["churn_status"]}).collect()}
    assert d2 == {"CHURN_STATUS": 1}
    layers = ChurnLayers.from_raw(raw)
    assert layers.c360.count() == 4                    # the duplicate fans out
    assert not core.ids_unique(layers.c360)            # so marts keep COUNT(DISTINCT)
    k = marts.executive_kpis(layers.c360).first()
    assert (k.total_customers, k.churned_customers, k.churn_rate) == (3, 2, 0.6667)
