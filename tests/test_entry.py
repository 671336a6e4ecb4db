"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""
import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"dimension_name", "segment_value", "churn_rate"} <= set(df.columns)
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70


def test_entry_without_the_training_operators(monkeypatch):
    imported = E.importlib.import_module

    def missing(name, *more):
        if name.startswith("churnlens.llm"):
            raise ImportError("no such library")
        return imported(name, *more)

    monkeypatch.setattr(E.importlib, "import_module", missing)
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 70 and not any(k.startswith("op") or k == "pipeline" for k in qs)
    assert set(sql) <= set(qs)
