"""Real input tables: declared column names, permissive reading, rejects and
measured key guarantees.

``load`` reads the files of a folder (CSV, JSON, Parquet or ORC, by suffix) by a
``TableSpec`` each and gives tables in the library's schemas, the rejected rows
and the measurements of every table:

* Text formats are read as strings, in permissive mode with the line of a
  malformed record, then parsed column by column (``try_cast``); blank and
  ``NA`` are NULL.  A row goes to the rejects with its reasons when its line is
  malformed, a value does not parse, a key is missing (``null key``), or all
  keys are (``total row``: a sheet's sums).  Nothing is dropped silently.
* The parsed rows are written once, in the folder ``spark.checkpoint.dir``
  names.  Rows and rejects are counted by an ``Observation`` of that write.
* A lookup table's rows are grouped by its key as they are written a second time
  (combined map-side, so a key that repeats many times is no hot spot) and the
  keys with more than one row counted by an ``Observation`` of that write: no
  join and no further job.  A repeated key stops the run with an example,
  before any result exists.

Column names match whatever their case.  A JSON mapping of the run may replace
names and files: ``{"city_emp": {"file": "jobs.csv", "columns": {"emp_ref":
"2010est"}}, "crosswalk": {"schemes": {"existing": "RGID_Existing"}}}``.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import scratch
from stratum.sources import io
from stratum.sources import mappings as M
from stratum.sources import schemas as SC

CORRUPT = "_corrupt_record"
REJECTS = "table string, reasons array<string>, row string, file string"
METRICS = "table string, rows long, kept long, rejected long, repeated_keys long"


class DuplicateKeys(ValueError):
    """A lookup table holds a key twice."""


@dataclass
class Inputs:
    tables: dict = field(default_factory=dict)
    rejected: list = field(default_factory=list)
    measured: list = field(default_factory=list)

    def rejects(self, spark: SparkSession) -> DataFrame:
        """``table, reasons, row`` (JSON of the input's columns), ``file``."""
        out = spark.createDataFrame([], REJECTS)
        for df in self.rejected:
            out = out.unionByName(df)
        return out

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``table, rows, kept, rejected, repeated_keys``: one row a table."""
        return spark.createDataFrame(self.measured, METRICS)


def read_raw(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """The file's columns; those of text formats as strings with the line of a
    malformed record in ``_corrupt_record``."""
    fmt = fmt or next((f for s, f in io.FORMATS.items() if path.lower().endswith(s)), "parquet")
    if fmt not in ("csv", "json"):
        return spark.read.format(fmt).load(path).withColumn(CORRUPT, F.lit(None).cast("string"))
    options = {"header": True} if fmt == "csv" else {"primitivesAsString": True}
    names = [c for c in spark.read.options(**options).format(fmt).load(path).columns if c != CORRUPT]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    return (spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False, columnPruning=False)
            .format(fmt).load(path))


def _parsed(value: Column, kind: T.DataType) -> Column:
    """The value in its type, NULL where it does not parse; whole numbers may
    be written with a decimal point."""
    if isinstance(kind, (T.LongType, T.IntegerType)):
        number = value.cast("string").try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        return F.coalesce(value.cast("string").try_cast(kind), whole)
    if isinstance(kind, T.DoubleType):
        number = value.try_cast(kind)
        return F.when(~F.isnan(number), number)
    return value.cast(kind)


def parse(raw: DataFrame, spec: M.TableSpec, table: str) -> DataFrame:
    """The columns of ``spec.schema``, and ``_reasons`` (NULL: the row is kept),
    ``_row``, ``_file``.  Missing optional columns are NULL, others an error."""
    held = {c.lower(): c for c in raw.columns}
    values, bad = {}, []
    for f in spec.schema.fields:
        source = held.get(spec.columns.get(f.name, f.name).lower())
        if source is None:
            if f.name not in spec.optional:
                raise ValueError(f"{table}: no column {spec.columns.get(f.name, f.name)!r} for {f.name}")
            values[f.name] = F.lit(None).cast(f.dataType)
            continue
        text = F.trim(F.col(f"`{source}`").cast("string"))
        given = F.when((text != "") & (F.upper(text) != "NA"), text)
        values[f.name] = _parsed(given, f.dataType)
        bad.append(F.when(given.isNotNull() & values[f.name].isNull(), F.lit(f"unparsable: {source}")))
    missing = [values[k].isNull() for k in spec.keys]
    total = F.lit(True)
    for m in missing:
        total = total & m
    keys = F.when(total, F.lit("total row")).when(F.exists(F.array(*missing), lambda m: m), F.lit(f"null key: {', '.join(spec.keys)}"))
    reasons = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit("malformed line"))).otherwise(F.array_compact(F.array(*bad, keys)))
    shown = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != CORRUPT])))
    return raw.select(*[v.alias(k) for k, v in values.items()], F.when(F.size(reasons) > 0, reasons).alias("_reasons"), shown.alias("_row"), F.input_file_name().alias("_file"))


def _write(df: DataFrame, name: str, metrics: dict) -> tuple[DataFrame, dict]:
    """``df`` written once in the shared folder, and its aggregates ``metrics``."""
    spark = df.sparkSession
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    path = scratch(spark, f"input-{name}")
    df.observe(seen, *[c.alias(k) for k, c in metrics.items()]).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def unique_rows(df: DataFrame, keys, table: str) -> DataFrame:
    """``df`` written once with its keys counted on the way; a repeated key
    raises ``DuplicateKeys``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    own = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    twice = F.col("_n") > 1
    staged, seen = _write(own, table, {"repeated": F.count_if(twice), "example": F.max(F.when(twice, F.to_json(F.struct(*keys))))})
    if seen["repeated"]:
        raise DuplicateKeys(f"duplicate key in {table}: {seen['repeated']} keys have several rows, such as {seen['example']}")
    return staged.select(*df.columns)


def ingest(raw: DataFrame, spec: M.TableSpec, table: str, into: Inputs, scenario: str | None = None) -> DataFrame:
    """Parse, stage and measure one table; its kept rows go to ``into``."""
    kept = F.col("_reasons").isNull()
    staged, seen = _write(parse(raw, spec, table), table, {"rows": F.count(F.lit(1)), "kept": F.count_if(kept)})
    good = staged.where(kept).drop("_reasons", "_row", "_file")
    if scenario is not None and "scenario" in good.columns:
        good = good.withColumn("scenario", F.coalesce("scenario", F.lit(scenario)))
    if spec.unique:
        good = unique_rows(good, spec.unique, table)
    into.rejected.append(staged.where(~kept).select(F.lit(table).alias("table"), F.col("_reasons").alias("reasons"), F.col("_row").alias("row"), F.col("_file").alias("file")))
    into.measured.append((table, seen["rows"], seen["kept"], seen["rows"] - seen["kept"], 0))
    into.tables[table] = good
    return good


def _long_spec(schema: T.StructType, keys, unique) -> M.TableSpec:
    return M.TableSpec(schema, {}, keys, unique)


def crosswalk_long(raw: DataFrame, schemes: dict | None = None, city: str = M.CROSSWALK_CITY) -> DataFrame:
    """The wide crosswalk as ``scheme, city_id, rg_id``: a row for each column of
    a scheme.  Without ``schemes`` (scheme -> column) these are the columns
    named after one."""
    if schemes is None:
        schemes = {m[1].lower(): c for c in raw.columns if (m := re.fullmatch(M.CROSSWALK_SCHEME, c, re.I))}
    if not schemes:
        raise ValueError("crosswalk: no column of a scheme")
    rows = F.array(*[F.struct(F.lit(s).alias("scheme"), F.col(f"`{c}`").cast("string").alias("rg_id")) for s, c in schemes.items()])
    return raw.select(F.inline(rows), F.col(f"`{city}`").alias("city_id"), CORRUPT)


def totals_rows(raw: DataFrame, after_year: int | None = None) -> DataFrame:
    """The wide totals as ``scenario, indicator, year, total`` strings: a row for
    each indicator's column that the table has."""
    held = {c.lower(): c for c in raw.columns}
    found = {i: held[c.lower()] for i, c in M.TOTALS_INDICATORS.items() if c.lower() in held}
    rows = F.array(*[F.struct(F.lit(i).alias("indicator"), F.col(f"`{c}`").cast("string").alias("total")) for i, c in found.items()])
    scenario = F.col(f"`{held['scenario']}`") if "scenario" in held else F.lit(None)
    out = raw.select(scenario.cast("string").alias("scenario"), F.col(f"`{held['year']}`").cast("string").alias("year"), F.inline(rows), CORRUPT)
    if after_year is not None:      # rows whose year does not parse stay, to be rejected
        out = out.where(F.coalesce(F.col("year").try_cast("double") > after_year, F.lit(True)))
    return out


def _path(folder: str, name: str, own: dict) -> str | None:
    """The table's file in the folder: as the mapping names it, else by suffix."""
    from stratum.sources.files import exists
    base = folder.rstrip("/")
    if "file" in own:
        return f"{base}/{own['file']}"
    return next((p for s in io.FORMATS if exists(p := f"{base}/{name}{s}")), None)


def load(spark: SparkSession, folder: str, method: str, scenario: str = "base", mapping: dict | str | None = None, after_year: int | None = None) -> Inputs:
    """All input tables of a method from the files of ``folder``: the tables of
    its specs, ``crosswalk`` (``scheme, city_id, rg_id``; optional for targets),
    ``names`` (from the crosswalk's names) and ``totals`` (optional, from
    ``regional_totals`` or the wide ``forecast`` sheet)."""
    if isinstance(mapping, str):
        with open(mapping, encoding="utf-8") as f:
            mapping = json.load(f)
    mapping, out = mapping or {}, Inputs()
    specs = M.TARGETS_TABLES if method == "targets" else M.HIER_TABLES

    def raw_of(table, file):
        path = _path(folder, file, mapping.get(table, {}))
        return path and read_raw(spark, path, mapping.get(table, {}).get("format"))

    for table, spec in specs.items():
        raw = raw_of(table, spec.file)
        if raw is None:
            raise ValueError(f"no file for {table} in {folder}")
        ingest(raw, replace(spec, columns={**spec.columns, **mapping.get(table, {}).get("columns", {})}), table, out, scenario)
    crosswalk = raw_of("crosswalk", "crosswalk")
    if crosswalk is not None:
        own = mapping.get("crosswalk", {})
        city, name = (own.get("columns", {}).get(k, v) for k, v in (("city_id", M.CROSSWALK_CITY), ("juris", M.CROSSWALK_NAME)))
        ingest(crosswalk_long(crosswalk, own.get("schemes"), city), _long_spec(SC.CROSSWALK, ("city_id", "rg_id"), ("scheme", "city_id")), "crosswalk", out)
        if name in crosswalk.columns:
            ingest(crosswalk, M.TableSpec(SC.NAMES, {"city_id": city, "juris": name}, ("city_id",), ("city_id",)), "names", out)
    elif method != "targets":
        raise ValueError(f"no file for crosswalk in {folder}")
    totals = raw_of("totals", "regional_totals")
    if totals is not None:
        ingest(totals_rows(totals, after_year), _long_spec(SC.TOTALS, ("indicator", "year"), ("scenario", "indicator", "year")), "totals", out, scenario)
    else:
        forecast = raw_of("forecast", "forecast")
        if forecast is not None:
            years = [int(c[:4]) for c in forecast.columns if re.fullmatch(r"\d{4}Q2", c)]
            wide = io.read_forecast(forecast.drop(CORRUPT), [y for y in years if after_year is None or y > after_year])
            ingest(totals_rows(wide.withColumn(CORRUPT, F.lit(None).cast("string"))), _long_spec(SC.TOTALS, ("indicator", "year"), ("scenario", "indicator", "year")),
                   "totals", out, scenario)
    return out
