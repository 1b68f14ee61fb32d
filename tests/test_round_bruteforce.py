"""H4a against a brute-force largest-remainder on random groups, incl. all-tied weights."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest

from stratum.operators import series as S
from stratum.sources import schemas as SC

KEYS = ["scenario", "scheme", "indicator"]


def brute(df: pd.DataFrame, totals: dict) -> dict:
    out = {}
    for (ind, y), g in df.groupby(["indicator", "year"]):
        r = np.rint(g.value.to_numpy())
        w = np.where(r > 0, r, 0.0)
        ids = g.geo_id.to_numpy()
        t = totals.get((ind, y))
        if t is None or w.sum() == 0 or np.rint(t) - r.sum() == 0:
            out.update({(ind, y, i): v for i, v in zip(ids, r)})
            continue
        d = np.rint(t) - r.sum()
        q = abs(d) * w / w.sum()
        b = np.floor(q)
        frac = [Decimal(float(x)).quantize(Decimal("1e-10")) for x in q - b]
        m = int(abs(d) - b.sum())
        order = sorted(range(len(ids)), key=lambda k: (-frac[k], ids[k]))
        extra = np.zeros(len(ids))
        extra[order[:m]] = 1
        out.update({(ind, y, i): v for i, v in zip(ids, r + np.sign(d) * (b + extra))})
    return out


@pytest.mark.parametrize("tied", [False, True])
def test_largest_remainder_matches_brute_force(spark, tied):
    rng = np.random.default_rng(3)
    rows, totals = [], {}
    for ind in ("a", "b"):
        for y in (2020, 2030):
            n = 700
            vals = np.full(n, 7.0) if tied else rng.gamma(2.0, 30.0, n) * (rng.random(n) > 0.1)
            for i, v in enumerate(vals):
                rows.append(("s", "x", ind, i * 7 + 3, y, float(v)))
            totals[(ind, y)] = float(np.rint(vals).sum() + rng.integers(-150, 150))
    long = spark.createDataFrame(rows, "scenario string, scheme string, indicator string, geo_id long, "
                                       "year int, value double").repartition(5)
    tot = spark.createDataFrame([("s", i, y, t) for (i, y), t in totals.items()], SC.TOTALS)
    got = {(r.indicator, r.year, r.geo_id): r.value for r in S.round_to_total(long, KEYS, tot).collect()}
    exp = brute(pd.DataFrame(rows, columns=KEYS + ["geo_id", "year", "value"]), totals)
    assert got == exp
    for (ind, y), t in totals.items():
        assert sum(v for (i, yy, _), v in got.items() if i == ind and yy == y) == t


def test_no_residual_leaves_rounded_values(spark):
    long = spark.createDataFrame([("s", "x", "a", 1, 2020, 1.4), ("s", "x", "a", 2, 2020, 2.6)],
                                 "scenario string, scheme string, indicator string, geo_id long, "
                                 "year int, value double")
    tot = spark.createDataFrame([("s", "a", 2020, 4.0), ("s", "a", 2030, 9.0)], SC.TOTALS)
    got = {r.geo_id: r.value for r in S.round_to_total(long, KEYS, tot).collect()}
    assert got == {1: 1.0, 2: 3.0}
