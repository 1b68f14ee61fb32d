"""Worked examples of FIXTURES.md as small in-memory tables (test input only)."""

from stratum.plans.methods import HierInputs
from stratum.sources import schemas as SC


def hier_inputs(spark, annex=False):
    ref = spark.createDataFrame(
        [("s", 2000, 1000.0, 950.0, 400.0, 500.0), ("s", 2016, 1200.0, 1140.0, 480.0, 600.0),
         ("s", 2050, 2000.0, 1880.0, 800.0, 1000.0)], SC.REF)
    rgs_county = spark.createDataFrame(
        [("s", 33, .6, .7, .05, 2.4), ("s", 53, .4, .3, .06, 2.3)], SC.RGS_COUNTY)
    rgs_rg = spark.createDataFrame(
        [("s", 33, "1", .75, .8, .05, 2.4), ("s", 33, "2", .25, .2, .04, 2.6),
         ("s", 53, "1", 1.0, 1.0, .06, 2.3)], SC.RGS_RG)
    # city, county, rg, Emp2000, Emp2016, TargetEmp, CR_add, Pop2000, Pop2016, TargetPop,
    # HHPop00, HHPop16, HH2000, HH2016, GQpct, GQpct2050, PPH2050
    rows = [
        (1, 33, "1", 200, 250, 60, 0, 300, 360, 80, 290, 345, 120, 150, .04, .05, 2.4),
        (2, 33, "1", 100, 120, 30, 10, 200, 240, 40, 195, 232, 80, 95, .03, .04, 2.5),
        (3, 33, "2", 50, 60, 20, 0, 150, 180, 60, 145, 172, 60, 70, .02, .03, 2.7),
        (4, 53, "1", 100, 110, 40, 0, 200, 240, 50, 185, 225, 80, 95, .06, .07, 2.2),
        (5, 53, "1", 50, 60, 10, 0, 150, 180, 50, 135, 166, 60, 70, .05, .06, 2.3),
    ]
    emp = spark.createDataFrame(
        [(r[0], r[1], float(r[3]), float(r[4]), float(r[5]), float(r[6]), 0.0) for r in rows], SC.CITY_EMP)
    pop = spark.createDataFrame(
        [(r[0], r[1], float(r[7]), float(r[8]), float(r[9]), float(r[10]), float(r[11]), float(r[12]),
          float(r[13]), r[14], r[15], r[16], 0.0, r[16]) for r in rows], SC.CITY_POP)
    xwalk = spark.createDataFrame([("x", r[0], r[2]) for r in rows], SC.CROSSWALK)
    names = spark.createDataFrame([(r[0], f"City {r[0]}") for r in rows], SC.NAMES)
    return HierInputs(ref, rgs_county, rgs_rg, xwalk, names, emp, pop, None)


def series_anchors(spark):
    """FIXTURES §3: anchors 2018, 2020, 2050 for three geographies."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("scenario", T.StringType()), ("scheme", T.StringType()), ("indicator", T.StringType()),
        ("geo_id", T.LongType()), ("a_2018", T.DoubleType()), ("a_2020", T.DoubleType()),
        ("a_2050", T.DoubleType())]])
    return spark.createDataFrame([("s", "x", "pop", 1, 100.0, 110.0, 140.0),
                                  ("s", "x", "pop", 2, 50.0, 50.0, 80.0),
                                  ("s", "x", "pop", 3, 10.0, 8.0, 2.0)], schema)


def totals(spark, pairs, indicator="pop"):
    from stratum.sources import schemas as SC
    return spark.createDataFrame([("s", indicator, y, float(t)) for y, t in pairs], SC.TOTALS)
