"""Data-quality checks on raw fixture rows: duplicates, NULL ids, ZIP gaps and fan-out."""
from pyspark.sql import functions as F

from churnlens.plans import core, quality
from churnlens.sources.schema import LOCATION, POPULATION, STATUS


def _df(spark, schema, data):
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in data],
                                 schema)


def test_uniqueness_counts_null_ids_as_duplicates(spark):
    st = _df(spark, STATUS, [{"customer_id": "a"}, {"customer_id": "a"}, {"customer_id": None}])
    r = quality.uniqueness({"churn_status": st}).first()
    assert (r.total_rows, r.distinct_customers, r.duplicate_rows) == (3, 1, 2)
    assert quality.null_keys({"churn_status": st}).first().null_customer_ids == 1


def test_zip_gaps_and_duplicate_zip_fan_out(spark):
    loc = _df(spark, LOCATION, [{"customer_id": "a", "zip_code": 1},
                                {"customer_id": "b", "zip_code": 2}])
    pop = _df(spark, POPULATION, [{"id": 1, "zip_code": 1, "population": 5},
                                  {"id": 2, "zip_code": 1, "population": 6}])
    r = quality.zip_reconciliation(loc, pop).first()
    # customer a matches two population rows (fan-out), b none
    assert (r.customer_rows, r.customers_without_population_match) == (3, 1)
    cl = core.customer_location(loc, pop)
    assert cl.count() == 3
    assert cl.filter(F.col("customer_id") == "b").first().population is None


def test_completeness_and_distribution(spark):
    base = _df(spark, STATUS, [{"customer_id": c} for c in "abc"])
    other = _df(spark, STATUS, [{"customer_id": "a"}])
    r = quality.completeness(base, {"status": other}).first()
    assert (r.demographics_customers, r.missing_status) == (3, 2)
    st = _df(spark, STATUS, [{"customer_id": "a", "churn_label": "Yes", "churn_value": 1},
                             {"customer_id": "b", "churn_label": "No", "churn_value": 0},
                             {"customer_id": "c", "churn_label": "No", "churn_value": 0}])
    d = {(r.churn_label, r.churn_value): r.pct_customers
         for r in quality.distribution(st, ["churn_label", "churn_value"]).collect()}
    assert d == {("Yes", 1): 33.33, ("No", 0): 66.67}


def test_domains_report_out_of_domain_values(spark):
    st = _df(spark, STATUS, [{"customer_id": "a", "customer_status": "Gone", "quarter": "Q3"},
                             {"customer_id": "b", "customer_status": "Stayed", "quarter": "Q9"}])
    got = {r.column_name: (r.null_values, r.out_of_domain)
           for r in quality.domains({"churn_status": st}).collect()}
    assert got["customer_status"] == (0, 1) and got["quarter"] == (0, 1)
    assert got["churn_label"] == (2, 0)


def test_completeness_equals_the_joins_with_fan_out_and_null_keys(spark):
    base = _df(spark, STATUS, [{"customer_id": c} for c in ["a", "a", "b", "c", None]])
    loc = _df(spark, STATUS, [{"customer_id": c} for c in ["a", "a", "a", "c", None]])
    srv = _df(spark, STATUS, [{"customer_id": c} for c in ["b", "b"]])
    got = quality.completeness(base, {"location": loc, "services": srv}).first()
    b, l_, s_ = (x.selectExpr("customer_id AS k") for x in (base, loc, srv))
    j = (b.join(l_.withColumnRenamed("k", "lk"), F.col("k") == F.col("lk"), "left")
         .join(s_.withColumnRenamed("k", "sk"), F.col("k") == F.col("sk"), "left"))
    exp = j.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("lk").isNull()).alias("ml"),
                F.count_if(F.col("sk").isNull()).alias("ms")).first()
    assert (got.demographics_customers, got.missing_location, got.missing_services) == (
        exp.n, exp.ml, exp.ms)
    assert exp.n == 2 * 3 + 2 + 1 + 1   # 'a' fans out 2 × 3
