"""End-to-end runs write one partitioned directory per table."""

import os
import tempfile

import pytest

from stratum.plans.run import TABLES, run

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("method", ["hier", "targets"])
def test_run_writes_tables(spark, method):
    out = tempfile.mkdtemp(prefix="stratum-run-", dir="/tmp")
    scen = ("base", "flat") if method == "hier" else ("base",)
    paths = run(spark, method, SF, out, "2026-12-03", scen, ("existing", "proposed") if method == "hier"
                else ("existing",))
    assert sorted(os.path.basename(p) for p in paths) == sorted(TABLES[method])
    unrolled = spark.read.parquet(os.path.join(out, "unrolled"))
    assert unrolled.count() > 0
    parts = {(r.scenario, r.scheme) for r in unrolled.select("scenario", "scheme").distinct().collect()}
    if method == "hier":
        assert parts == {(s, k) for s in scen for k in ("existing", "proposed")}
        assert os.path.isdir(os.path.join(out, "people", "scenario=flat", "scheme=proposed",
                                          "run_date=2026-12-03"))
