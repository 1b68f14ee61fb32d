"""Input schemas (FIXTURES §1, in this library's column names) and ingest checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

D, L, I, S = T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REF = _schema(("scenario", S), ("year", I), ("pop", D), ("hhpop", D), ("hh", D), ("emp", D))
RGS_COUNTY = _schema(("scenario", S), ("county", L), ("rgs_pop", D), ("rgs_emp", D),
                     ("gq_pct_target", D), ("pph_target", D))
RGS_RG = _schema(("scenario", S), ("county", L), ("rg_id", S), ("rgs_pop", D), ("rgs_emp", D),
                 ("gq_pct_target", D), ("pph_target", D))
CROSSWALK = _schema(("scheme", S), ("city_id", L), ("rg_id", S))
NAMES = _schema(("city_id", L), ("juris", S))
CITY_EMP = _schema(("city_id", L), ("county", L), ("emp_ref", D), ("emp_base", D), ("target", D),
                   ("cr_add", D), ("annex", D))
CITY_POP = _schema(("city_id", L), ("county", L), ("pop_ref", D), ("pop_base", D), ("target", D),
                   ("hhpop_ref", D), ("hhpop_base", D), ("hh_ref", D), ("hh_base", D), ("gq_pct", D),
                   ("gq_pct_target", D), ("pph_target", D), ("annex", D), ("pph", D))
TOTALS = _schema(("scenario", S), ("indicator", S), ("year", I), ("total", D))
TARGETS = _schema(("city_id", L), ("county", L), ("rg_id", S), ("juris", S),
                  ("emp_by", D), ("emp_base", D), ("emp_gro", D), ("emp_target", D),
                  ("pop_by", D), ("pop_base", D), ("pop_gro", D), ("pop_target", D),
                  ("hhpop_by", D), ("hhpop_base", D), ("hh_by", D), ("hh_base", D),
                  ("gq_pct_target", D), ("pph_target", D))


def conform(df: DataFrame, schema: T.StructType, required=None) -> DataFrame:
    """Cast to the schema's types; optional columns absent from ``df`` become NULL."""
    required = set(required or [])
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in required:
            raise ValueError(f"missing column {f.name}")
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def split_null_keys(df: DataFrame, keys, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a NULL key go to diagnostics (data.table would match NA to
    NA, SQL joins would not; rejecting them keeps both views equal)."""
    bad = None
    for k in keys:
        c = F.col(k).isNull()
        bad = c if bad is None else bad | c
    good = df.where(~bad)
    diag = df.where(bad).select(F.lit(table).alias("table"), F.lit("null key").alias("check"),
                                F.to_json(F.struct(*[F.col(k) for k in keys])).alias("key"))
    return good, diag


def require_unique(df: DataFrame, keys, table: str) -> DataFrame:
    """Lookup tables must have unique keys: fail the job on a duplicate
    (the reference silently lets the last row win)."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    msg = F.lit(f"duplicate key in {table}")
    return (df.join(n, list(keys), "left")
              .where(F.when(F.col("_n") > 1, F.raise_error(msg)).otherwise(F.lit(True)))
              .drop("_n"))
