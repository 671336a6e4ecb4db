"""Typed CSV load with header normalisation and counted type failures."""
import os
import tempfile

from churnlens.sources.readers import load_report, normalize_header, read_raw


def test_normalize_header():
    assert normalize_header("Customer ID") == "customer_id"
    assert normalize_header("Lat Long") == "lat_long"
    assert normalize_header(" Under 30 ") == "under_30"


def test_read_raw_csv(spark):
    d = tempfile.mkdtemp(prefix="churnlens-csv-")
    with open(os.path.join(d, "churn_status.csv"), "w") as f:
        f.write("Customer ID,Count,Quarter,Satisfaction Score,Customer Status,Churn Label,"
                "Churn Value,Churn Score,CLTV,Churn Category,Churn Reason\n"
                "0002-ORFBO,1,Q3,3,Stayed,No,0,65,2205,,\n"
                "0003-MKNFE,1,Q3,five,Churned,Yes,1,71,5414,Competitor,Price\n")
    for t in ["churn_demographics", "churn_location", "churn_population", "churn_services"]:
        with open(os.path.join(d, f"{t}.csv"), "w") as f:
            f.write("Customer ID\n")
    raw = read_raw(spark, d, "csv", keep_failures=True)
    st = raw["churn_status"]
    rows = {r.customer_id: r for r in st.collect()}
    assert rows["0002-ORFBO"].cltv == 2205 and rows["0003-MKNFE"].satisfaction_score is None
    rep = {r.table_name: (r.row_count, r.type_failures) for r in load_report(raw).collect()}
    assert rep["CHURN_STATUS"] == (2, 1)
