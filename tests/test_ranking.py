"""rank_in_groups: exact ranks and running sums when one group holds most rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stratum.operators.ranking import rank_in_groups


def test_hot_group_exact_rank_and_running_sum(spark):
    rng = np.random.default_rng(5)
    n_hot, rows = 20000, []
    for i in range(n_hot):                       # the hot group: 20k rows, many tied keys
        rows.append(("hot", int(rng.integers(0, 50)), i, float(rng.integers(0, 10))))
    for g in ("a", "b"):
        for i in range(300):
            rows.append((g, int(rng.integers(0, 1000)), i, 1.0))
    df = spark.createDataFrame(rows, "g string, k long, id long, w double").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = rank_in_groups(df, ["g"], [F.col("k").desc(), F.col("id")], running={"before": F.col("w")},
                             totals={"n": F.lit(1)}).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    pdf = pd.DataFrame(rows, columns=["g", "k", "id", "w"]).sort_values(["g", "k", "id"], ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("g").cumcount() + 1
    pdf["before"] = pdf.groupby("g").w.cumsum() - pdf.w
    m = out.merge(pdf, on=["g", "id"], suffixes=("", "_exp"))
    assert len(m) == len(rows)
    assert (m._rank == m["rank"]).all()
    assert np.allclose(m.before, m.before_exp)
    assert (m.n == m.g.map({"hot": n_hot, "a": 300, "b": 300})).all()
