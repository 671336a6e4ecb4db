"""churnlens — customer churn analytics as Spark DataFrame functions.

Layers (each a module of DataFrame → DataFrame functions):

* ``sources``   typed readers for the five raw tables and the star-schema adapter
* ``functions`` column expressions: bands, exact rounding, business formatting
* ``operators`` reusable distributed building blocks (scalable NTILE, unpivot,
  tenure curve, customer-keyed aggregation, result comparison, JSON documents)
* ``plans``     CORE model, customer 360, quality checks, marts, metric layer,
  verified questions, dashboard tables, reconciliation, response logs, triage
* ``streaming`` the response-log analysis applied to files arriving over time
"""

from churnlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
