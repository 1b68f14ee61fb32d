"""Rows are dealt so that a task of an aggregation holds a bounded number of groups."""

import json

from pyspark.sql import functions as F

from stratum.operators import series as S
from stratum.plans import methods as M
from stratum.session import materialize
from stratum.sources import tpch

SF = "/root/testdata/sf0.001"


def test_deal_bounds_rows_of_a_task(spark):
    df = materialize(spark.range(5000).select((F.col("id") % 1000).alias("geo_id"), (F.col("id") % 5).cast("int").alias("year")))
    dealt = S.deal(df, ["geo_id"], 400)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5000 and len(sizes) == 13 and max(sizes) < 800
    assert S.deal(df.where("geo_id < 0"), ["geo_id"]).count() == 0
    nulls = materialize(df.withColumn("geo_id", F.when(F.col("geo_id") > 3, F.col("geo_id"))))
    assert S.deal(nulls, ["geo_id"], 400).where("geo_id is null").count() == 20


def test_targets_tables_aggregate_dealt_rows(spark, monkeypatch):
    t = tpch.targets(tpch.customer_base(spark, SF))
    both = tpch.totals(tpch.ref(spark, SF, ("base", "flat")), after_year=tpch.TARGETS.base_year)
    args = (t, both, tpch.TARGETS, ("base", "flat"), ("existing", "proposed"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    one = M.run_targets(*args, annual=False)["unrolled"]
    want, calls = rows(one), []
    deal = S.deal
    monkeypatch.setattr(S, "deal", lambda df, keys, rows=500: calls.append(df.count()) or deal(df, keys, 500))
    many = M.run_targets(*args, annual=False)["unrolled"]
    assert calls[0] == t.count() * 16 and calls[1] == calls[0] * len(tpch.TARGETS.years_to_fit)
    assert rows(many) == want
    plan = json.loads(many._jdf.queryExecution().optimizedPlan().toJSON())
    assert any("RepartitionByExpression" in node["class"] for node in plan)
