"""q23 (seeded draw): its invariants on the driver tables."""

import numpy as np

from stratum.plans import queries as Q
from stratum.sources import tpch

SF = "/root/testdata/sf0.01"   # sf0.001 has zero-weight RGs: its series is NULL by design


def test_seeded_draw_meets_totals_and_repeats(spark):
    out = Q.q23_seeded_draw(spark, SF).toPandas()
    assert (out.value == out.value.round()).all()
    ref = tpch.ref(spark, SF).toPandas().set_index("year")
    sums = out.groupby(["indicator", "year"]).value.sum()
    for (ind, year), total in sums.items():
        assert total == np.rint(ref.loc[year, ind]), (ind, year)
    assert set(sums.index.get_level_values("year")) == {1997, 1998, 1999, 2000}
    again = Q.q23_seeded_draw(spark, SF).toPandas()
    key = ["indicator", "city_id", "year"]
    assert out.sort_values(key).value.tolist() == again.sort_values(key).value.tolist()
