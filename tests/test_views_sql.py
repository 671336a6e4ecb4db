"""SQL over the registered views gives the same rows as the DataFrame functions."""
from churnlens.catalog import REGISTRY
from churnlens.plans.layers import layers_for
from churnlens.plans.views import register_views

SF = "/root/testdata/sf0.001"


def test_sql_on_views_matches_registered_queries(spark):
    names = register_views(spark, layers_for(spark, SF))
    assert "customer_360_view" in names and "vw_churn_by_tenure_segment" in names
    by_sql = spark.sql("""
        SELECT segment_value, total_customers, churned_customers, churn_rate, churn_contribution
        FROM vw_churn_segments WHERE dimension_name = 'Contract'""")
    by_df = REGISTRY["vq_contract_churn"](spark, SF)
    assert by_sql.exceptAll(by_df).count() == 0 and by_df.exceptAll(by_sql).count() == 0
    peak = spark.sql("""
        SELECT contract_type, tenure_month FROM (
          SELECT segment_value AS contract_type, tenure_month,
                 ROW_NUMBER() OVER (PARTITION BY segment_value
                                    ORDER BY churn_rate_at_tenure DESC, tenure_month) AS rn
          FROM vw_churn_by_tenure_segment WHERE dimension_name = 'Contract') WHERE rn = 1""")
    exp = REGISTRY["vq_peak_tenure"](spark, SF).select("contract_type", "tenure_month")
    assert peak.exceptAll(exp).count() == 0


def test_raw_csv_round_trip(spark):
    rep = {r.table_name: (r.row_count, r.type_failures)
           for r in REGISTRY["raw_load_counts"](spark, SF).collect()}
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert rep["CHURN_STATUS"] == (n, 0) and rep["CHURN_SERVICES"] == (n, 0)
    assert set(rep) == {"CHURN_DEMOGRAPHICS", "CHURN_LOCATION", "CHURN_POPULATION",
                        "CHURN_SERVICES", "CHURN_STATUS"}


def test_write_marts_replaces_tables(spark):
    import tempfile

    from churnlens.plans.views import write_marts
    layers = layers_for(spark, SF)
    folder = tempfile.mkdtemp(prefix="churnlens-marts-")
    names = write_marts(layers, folder)
    assert "vw_churn_segments" in names and "customer_360_view" in names
    write_marts(layers, folder)                       # replace, not append
    seg = spark.read.parquet(f"{folder}/vw_churn_segments")
    assert seg.count() == REGISTRY["churn_segments"](spark, SF).count()
