"""Plan shape of every registered query: no cartesian products, pruned scans of the 360."""
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

from plan_report import plans  # noqa: E402

SF = "/root/testdata/sf0.001"
MARTS = ["executive_kpis", "churn_segments", "product_adoption", "product_depth",
         "customer_value", "churn_reasons", "churn_by_tenure", "churn_by_tenure_segment"]


def test_no_cartesian_products_and_pruned_mart_scans(spark):
    res = plans(spark, SF)
    assert len(res) >= 70
    for key, (summary, _) in res.items():
        assert summary["cartesian"] == 0, key
        assert summary["range_exchanges"] == 0, key      # ranking happens once, in the build
    for key in MARTS:
        summary, plan = res[key]
        assert "FileScan parquet" in plan, key           # reads the materialised 360
        assert all(n < 20 for n in summary["scans"]), (key, summary["scans"])
