"""Sources and sinks.

* ``read_raw``       typed load of the five raw tables from header CSV or Parquet (S1)
* ``load_report``    per-table row counts plus type failures of a load (S2, D12)
* ``normalize_header`` 'Customer ID' → 'customer_id' (S3)
* ``load_star``      the driver's star-schema tables, read lazily (S4)
* ``write_table``    replace-semantics materialisation (S5)

CSV is read as text and every declared column is converted with ``try_cast``;
a value that is present but does not convert is counted, not silently lost, and
the load never fails half way (FAILFAST would stop a 100 TB job on one bad row).
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.sources.schema import RAW_SCHEMAS, STAR_TABLES


def normalize_header(name: str) -> str:
    """'Customer ID' → 'customer_id'; 'Lat Long' → 'lat_long'; 'Under 30' → 'under_30'."""
    s = re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_")
    return s.lower()


_CORRUPT = "_corrupt_record"


def _path(directory: str, table: str, fmt: str) -> str:
    return os.path.join(directory, f"{table}.{fmt}")


def read_raw_table(spark: SparkSession, path: str, table: str, fmt: str = "csv",
                   keep_failures: bool = False) -> DataFrame:
    schema = RAW_SCHEMAS[table]
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*header, _CORRUPT])
        # rows with too many or too few fields keep their text in the extra column
        text = (spark.read.option("header", True).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", _CORRUPT).schema(fields).csv(path))
    else:
        text = spark.read.format(fmt).load(path)
    text = text.toDF(*[c if c == _CORRUPT else normalize_header(c) for c in text.columns])
    cols, failures = [], []
    if _CORRUPT in text.columns:
        # names a data column too: the reader refuses to read the corrupt text alone
        first = F.coalesce(F.length(text.columns[0]), F.lit(0)) >= 0
        failures.append(F.when(F.col(_CORRUPT).isNotNull() & first, 1).otherwise(0))
    for field in schema.fields:
        if field.name in text.columns:
            raw = F.col(field.name)
            kind = field.dataType.simpleString()
            typed = F.expr(f"try_cast(`{field.name}` AS {kind})")
            if kind in ("int", "bigint"):       # 5.0: an integer column with gaps, as written
                whole = F.regexp_extract(F.trim(raw), r"^([+-]?[0-9]+)[.]0+$", 1)
                typed = F.coalesce(typed, whole.try_cast(kind))
            failures.append(F.when(raw.isNotNull() & typed.isNull(), 1).otherwise(0))
        else:
            typed = F.lit(None).cast(field.dataType)
        cols.append(typed.alias(field.name))
    if keep_failures and failures:
        total = failures[0]
        for f in failures[1:]:
            total = total + f
        cols.append(total.alias("_type_failures"))
    return text.select(*cols)


def read_raw(spark: SparkSession, directory: str, fmt: str = "csv",
             keep_failures: bool = False) -> dict[str, DataFrame]:
    """Typed load of the five raw tables ``<directory>/<table>.<fmt>``."""
    return {t: read_raw_table(spark, _path(directory, t, fmt), t, fmt, keep_failures)
            for t in RAW_SCHEMAS}


def load_report(raw: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows loaded and values that failed their declared type.

    One aggregation pass per table; the five one-row results are unioned.
    """
    parts = []
    for name, df in raw.items():
        fail = (F.sum("_type_failures") if "_type_failures" in df.columns
                else F.lit(0)).cast("bigint")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), fail.alias("type_failures"))
                     .select(F.lit(name.upper()).alias("table_name"), "row_count",
                             F.coalesce("type_failures", F.lit(0).cast("bigint"))
                             .alias("type_failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_star(spark: SparkSession, sf_dir: str, tables=None) -> dict[str, DataFrame]:
    """Lazily read the star-schema tables of one scale directory."""
    return {t: spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
            for t in (tables or STAR_TABLES)}


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """CTAS-like materialisation: the previous content is replaced."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def source_header(name: str) -> str:
    """'customer_id' → 'Customer ID': the spaced, capitalised headers of the source files."""
    return " ".join(w.upper() if w == "id" else w.capitalize() for w in name.split("_"))


def write_raw(raw: dict[str, DataFrame], directory: str, fmt: str = "csv") -> None:
    """Write the five raw tables as ``<directory>/<table>.<fmt>`` with source-style headers."""
    for t, df in raw.items():
        out = df.toDF(*[source_header(c) for c in df.columns]) if fmt == "csv" else df
        write_table(out, _path(directory, t, fmt), fmt=fmt)
