"""Derived 360s count distinct ids; malformed CSV rows are reported; formats survive NaN."""

import pytest
from pyspark.sql import functions as F

from churnlens import session
from churnlens.functions import fmt
from churnlens.plans import core, marts
from churnlens.sources import readers
from tests.conftest import c360_rows


def _total(df):
    return marts.executive_kpis(df).first().total_customers


def test_derived_frames_lose_the_uniqueness_note(spark):
    rows = [dict(customer_id=str(i), quarter="Q3", churn_flag=i % 2, monthly_charge=10,
                 total_revenue=100, cltv=5000, churn_value=i % 2) for i in range(3)]
    df = core.mark_unique_ids(c360_rows(spark, rows))
    assert core.ids_unique(df)
    fan = spark.createDataFrame([("0",), ("0",), ("1",), ("2",)], "customer_id string")
    for derived in (df.union(df), df.join(fan, "customer_id"),
                    df.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))).drop("x"), df.select("*")):
        assert not core.ids_unique(derived)
        assert _total(derived) == 3
    assert _total(df) == 3


def test_malformed_csv_rows_are_counted(spark, tmp_path):
    (tmp_path / "churn_population.csv").write_text(
        "ID,Zip Code,Population\n1,90001,5.0\n2,90002,7,extra\n3,90003\n4,90004,x\n")
    df = readers.read_raw_table(spark, str(tmp_path / "churn_population.csv"), "churn_population",
                                keep_failures=True)
    got = {r.id: (r.population, r._type_failures) for r in df.collect()}
    assert got == {1: (5, 0), 2: (7, 1), 3: (None, 1), 4: (None, 1)}


def test_formats_print_nothing_for_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (0.4584,)], "r double")
    assert [r[0] for r in df.select(fmt.percent_text("r")).collect()] == ["", "", "45.84%"]


def test_a_cluster_needs_a_shared_checkpoint_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
