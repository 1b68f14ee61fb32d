"""Published tables: names from column roles, layout by geography, and runs that
become visible together.

* **Names.** Report columns carry their role (measure, kind, years) as column
  metadata from the method to the sink, which makes the year-suffixed names of
  it; key columns get the method's names, the grouping column the caller's.
* **Layout.** Each table is range-partitioned by run keys and geography and
  sorted so inside each partition: files of a run partition follow the
  geography, whatever the cluster, and no sort gathers a table in one task.
* **Runs.** A run writes each table under
  ``<table>/scenario=…/scheme=…/run_date=…/attempt=<id>``, then adds one manifest
  that names the attempt of each partition.  Readers follow the newest manifest
  (``read_published``), so a run's tables change together, and a run that fails
  half-way changes nothing.  Attempts that no manifest named when a run
  started are removed once it has ended.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.sources import files

LABELS = {"pop": "Pop", "hhpop": "HHPop", "hh": "HH", "emp": "Emp"}
KEYS = {"hier": {"rg_id": "RGID", "county": "County", "city_id": "CityID", "juris": "Juris", "geo_id": "CityID"},
        "targets": {"rg_id": "RGID", "county": "county_id", "city_id": "control_id", "juris": "Juris", "geo_id": "control_id"}}
RUN_KEYS = ("scenario", "scheme")
GEOGRAPHY = ("city_id", "subreg_id", "geo_id", "rg_id", "year")
_ROLE = "role"


def role(measure: str, kind: str, *years: int) -> dict:
    """Column metadata of a measure: ``point`` (a year's value), ``short`` (the same
    with a two-digit year), ``growth`` or ``period`` (between two years)."""
    return {_ROLE: {"measure": measure, "kind": kind, "years": list(years)}}


def with_roles(df: DataFrame, roles: dict) -> DataFrame:
    """``df`` with roles (column -> metadata) on those columns that it has."""
    return df.select(*[F.col(c).alias(c, metadata=roles[c]) if c in roles else F.col(c) for c in df.columns])


def report_roles(tables: dict, ref: int, base: int, target: int) -> dict:
    """The method's report tables with the roles of their columns."""
    summary, city = {}, {}
    for m in LABELS:
        summary |= {f"{m}_long": role(m, "period", ref, target), f"{m}_gro": role(m, "period", base, target),
                    f"{m}_delta": role(m, "period", base, target), f"{m}_end": role(m, "short", target)}
        city |= {f"{m}_ref": role(m, "point", ref), f"{m}_by": role(m, "point", ref), f"{m}_base": role(m, "point", base),
                 f"{m}_gro": role(m, "growth", base, target), f"{m}_target": role(m, "point", target)}
    city["hhpop_ref"] = role("hhpop", "short", ref)
    of = {"rg_summary": summary, "people": city, "households": city, "jobs": city}
    return {k: with_roles(df, of[k]) if k in of else df for k, df in tables.items()}


def role_name(metadata: dict) -> str | None:
    """The published name of a column with a role."""
    r = metadata.get(_ROLE)
    if r is None:
        return None
    yy = "".join(f"{y % 100:02d}" for y in r["years"])
    return LABELS[r["measure"]] + {"point": str(r["years"][0]), "short": yy, "growth": f"Gro{yy}", "period": yy}[r["kind"]]


def named(df: DataFrame, method: str, rg_name: str | None = None) -> DataFrame:
    """The published names: of roles, of fitted years (``v_2020`` is ``2020``) and
    of keys, with the caller's name of the grouping column."""
    keys = KEYS["targets" if method == "targets" else "hier"] | ({"rg_id": rg_name} if rg_name else {})
    out = []
    for f in df.schema.fields:
        year = re.fullmatch(r"v_(\d{4})", f.name)
        out.append(F.col(f.name).alias(role_name(f.metadata) or (year[1] if year else keys.get(f.name, f.name))))
    return df.select(*out)


def indicator_tables(series: DataFrame, indicators) -> dict:
    """One wide table for each indicator, a column for each fitted year."""
    return {f"series_{i}": series.where(F.col("indicator") == i).drop("indicator") for i in indicators}


def laid_out(df: DataFrame, **constants: str) -> DataFrame:
    """Rows by run keys, then geography, in ranges that Spark samples, with
    the ``constants`` as columns that the writer partitions by.

    No column to partition by is a literal: the planner leaves literals out of
    a sort, and would then sort again, by those columns alone, to write."""
    first = [c for c in RUN_KEYS if c in df.columns]
    rest = [c for c in GEOGRAPHY if c in df.columns]
    if not rest:
        return df.withColumns({k: F.lit(v) for k, v in constants.items()})
    own = F.coalesce(F.col(rest[0]).cast("string"), F.lit(""))
    held = {c: F.substring(F.concat(v, own), F.lit(1), F.length(v)) for c, v in [*((c, F.col(c)) for c in first), *((k, F.lit(v)) for k, v in constants.items())]}
    return df.repartitionByRange(*first, *rest).withColumns(held).sortWithinPartitions(*held, *rest)


def manifests(out: str) -> list[str]:
    return files.listed(f"{out}/_manifest/*.json")


def newest(spark: SparkSession, out: str) -> dict:
    """The newest manifest: table -> run partition -> attempt."""
    found = manifests(out)
    return json.loads(spark.read.text(found[-1], wholetext=True).first()[0]) if found else {}


def _partition(path: str, table: str) -> tuple[str, str]:
    """(run partition, attempt) of an attempt's folder."""
    own = path.rsplit(f"/{table}/", 1)[1]
    part, attempt = own.rsplit("attempt=", 1)
    return part, attempt


def publish(spark: SparkSession, tables: dict, out: str, method: str, run_date: str, fmt: str = "parquet", rg_name: str | None = None) -> list[str]:
    """Write all tables, then make them visible together; their paths."""
    out, attempt = out.rstrip("/"), uuid.uuid4().hex
    before = {k: set(v.items()) for k, v in newest(spark, out).items()}
    stale = [p for k in tables for p in files.listed(f"{out}/{k}/scenario=*/scheme=*/run_date=*/attempt=*") + files.listed(f"{out}/{k}/run_date=*/attempt=*")
             if _partition(p, k) not in before.get(k, set())]
    for name, df in tables.items():
        df = named(laid_out(df, run_date=run_date, attempt=attempt), method, rg_name)
        parts = [c for c in (*RUN_KEYS, "run_date", "attempt") if c in df.columns]
        w = df.write.mode("append").partitionBy(*parts)
        (w.option("header", True) if fmt == "csv" else w).format(fmt).save(f"{out}/{name}")
    while True:                                  # another run may add a manifest meanwhile
        known = manifests(out)
        state = newest(spark, out)
        for name in tables:
            own = files.listed(f"{out}/{name}/scenario=*/scheme=*/run_date=*/attempt={attempt}") + files.listed(f"{out}/{name}/run_date=*/attempt={attempt}")
            state.setdefault(name, {}).update(_partition(p, name) for p in own)
        number = int(re.search(r"(\d+)\.json$", known[-1])[1]) + 1 if known else 0
        if files.create(f"{out}/_manifest/{number:08d}.json", json.dumps(state, indent=1, sort_keys=True)):
            break
    for path in stale:
        files.remove(path)
    return [f"{out}/{name}" for name in tables]


def read_published(spark: SparkSession, out: str, table: str, fmt: str = "parquet") -> DataFrame:
    """The rows of ``table`` that the newest manifest names."""
    out = out.rstrip("/")
    parts = newest(spark, out).get(table)
    if not parts:
        raise ValueError(f"no published table {table} in {out}")
    r = spark.read.option("basePath", f"{out}/{table}")
    r = r.option("header", True) if fmt == "csv" else r
    return r.format(fmt).load([f"{out}/{table}/{p}attempt={a}" for p, a in sorted(parts.items())]).drop("attempt")
