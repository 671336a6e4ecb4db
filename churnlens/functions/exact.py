"""Exact rounding on integers.

Floating ``ROUND(a / b, k)`` is not portable between engines (the last digit of
a tie-near value differs), so every rounded metric is computed from integer
numerators and denominators and rounded half away from zero with integral
division. The helpers take SQL expression text over column names (they are used
right after an aggregation, where names are at hand) and return ``Column``s.

Integers are widened to ``DECIMAL(38,0)`` before multiplication so that products
such as revenue-in-cents × 20000 cannot overflow ``BIGINT`` at large scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _wide(sql: str) -> str:
    return f"CAST(({sql}) AS DECIMAL(38,0))"


def round_div_sql(num: str, den: str, scale: int) -> str:
    """SQL text for round(num / den, scale) on integers, half away from zero.

    ``den`` must be positive or NULL/0 (then the result is NULL).
    """
    p = 10 ** scale
    n = _wide(num)
    d = _wide(f"NULLIF({den}, 0)")
    q = f"((ABS({n}) * {2 * p} + {d}) DIV (2 * {d}))"
    return (f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END) * CAST({q} AS DOUBLE) "
            f"/ CAST({p} AS DOUBLE)")


def round_div(num: str, den: str, scale: int) -> Column:
    return F.expr(round_div_sql(num, den, scale))


def ratio4(num: str, den: str) -> Column:
    """round(num / den, 4) — rates, shares, contributions."""
    return round_div(num, den, 4)


def pct2(num: str, den: str) -> Column:
    """round(num * 100 / den, 2) — percentages."""
    return F.expr(round_div_sql(f"CAST(({num}) AS DECIMAL(38,0)) * 100", den, 2))


def avg2(total: str, count: str) -> Column:
    """round(total / count, 2) for an integer sum (CLTV, tenure, satisfaction)."""
    return round_div(total, count, 2)


def avg_money(total_cents: str, count: str) -> Column:
    """Average of money given the sum in cents: rounded to whole cents, in units."""
    return F.expr(f"({round_div_sql(total_cents, count, 0)}) / CAST(100 AS DOUBLE)")


def money(total_cents: str) -> Column:
    """A sum of cents shown in money units."""
    return F.expr(f"CAST(({total_cents}) AS DOUBLE) / CAST(100 AS DOUBLE)")


def index2(a: str, b: str, big_a: str, big_b: str) -> Column:
    """round((a / b) / (A / B), 2) = round(a·B / (b·A), 2), as one integer ratio."""
    return round_div(f"{_wide(a)} * {_wide(big_b)}", f"{_wide(b)} * {_wide(big_a)}", 2)


def cents(col: Column | str) -> Column:
    """Money (DECIMAL(18,2)) → integer cents, exact."""
    c = F.col(col) if isinstance(col, str) else col
    return (c * F.lit(100)).cast("bigint")


def cents_to_money(col: Column | str) -> Column:
    """Integer cents → DECIMAL(18,2), exact (decimal multiplication, no double)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(18,2)")
