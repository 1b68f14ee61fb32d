"""Readers and writers: one table per dataset directory or file."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".orc": "orc"}


def read_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None) -> DataFrame:
    """Read one table; the format follows the suffix unless given."""
    if fmt is None:
        fmt = next((f for s, f in FORMATS.items() if path.lower().endswith(s)), "parquet")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.format(fmt).load(path)


def without_total_rows(df: DataFrame, keys) -> DataFrame:
    """A2: a sheet may end in sum rows; keep only rows whose key columns are
    all present (row positions do not exist in Spark)."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def totals_long(wide: DataFrame, indicators=("hhpop", "hh", "emp", "pop"), after_year: int | None = None
                ) -> DataFrame:
    """Regional totals ``(scenario?, year, <indicator>…)`` -> long
    ``(scenario, indicator, year, total)``; optionally only years after the base year."""
    cols = {c.lower(): c for c in wide.columns}
    vals = [cols[i] for i in indicators if i in cols]
    ids = [F.col(cols["year"]).cast("int").alias("year")]
    ids.append(F.col(cols["scenario"]).alias("scenario") if "scenario" in cols
               else F.lit("default").alias("scenario"))
    df = wide.select(*ids, *[F.col(v).cast("double").alias(v.lower()) for v in vals])
    long = df.unpivot(["scenario", "year"], [v.lower() for v in vals], "indicator", "total")
    if after_year is not None:
        long = long.where(F.col("year") > after_year)
    return long.select("scenario", "indicator", "year", "total")


FORECAST_LABELS = {  # fixed row labels of the wide forecast table
    "pop": ("X1", "Population"),
    "hhpop": ("X2", "Household Population"),
    "hh": ("X1", "Households"),
    "emp": ("X1", "Estimated Total Employment"),
}


def read_forecast(wide: DataFrame, years) -> DataFrame:
    """Wide forecast (label rows, ``<year>Q2`` columns) -> one row per
    year with ``pop, hhpop, hh, emp`` for the requested years.  Two rows with the
    same label are an error."""
    qcols = [c for c in wide.columns if re.fullmatch(r"\d{4}Q2", c)]
    wanted = [c for c in qcols if int(c[:4]) in set(years)]
    ids = [c for c in ("scenario", "X1", "X2") if c in wide.columns]
    long = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in wanted]) \
               .unpivot(ids, wanted, "col", "value") \
               .withColumn("year", F.substring("col", 1, 4).cast("int"))
    label = None
    for ind, (col, text) in FORECAST_LABELS.items():
        cond = F.col(col) == text
        label = F.when(cond, F.lit(ind)) if label is None else label.when(cond, F.lit(ind))
    long = long.withColumn("indicator", label).where(F.col("indicator").isNotNull())
    keys = [c for c in ("scenario",) if c in wide.columns] + ["year"]

    def only(ind):
        mine = F.col("indicator") == ind
        return (F.when(F.count_if(mine) > 1, F.raise_error(F.lit(f"several forecast rows for {ind}")))
                 .otherwise(F.max(F.when(mine, F.col("value")))).cast("double").alias(ind))

    return long.groupBy(*keys).agg(*[only(i) for i in FORECAST_LABELS])


def write_tables(tables: dict, out_dir: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by=("scenario", "scheme"), run_date: str | None = None) -> list:
    """One directory per table, partitioned by the run keys (and a
    ``run_date`` passed in, never read from the clock)."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        if run_date is not None:
            df = df.withColumn("run_date", F.lit(run_date))
        parts = [c for c in (*partition_by, *(["run_date"] if run_date else [])) if c in df.columns]
        w = df.write.mode(mode)
        if parts:
            # a run replaces its own partitions, never those of other runs
            w = w.partitionBy(*parts).option("partitionOverwriteMode", "dynamic")
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            w.option("header", True).csv(path)
        else:
            w.format(fmt).save(path)
        written.append(path)
    return written
