"""Input files with the published column names through ``run``: worked values,
rejects, key guarantees, published names and layout, runs that become visible together."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stratum.plans import run as R
from stratum.sources import ingest, io, mappings, publish
from stratum.sources import schemas as SC

CITIES = """CityID,County,RG,Emp2000,Emp2016,TargetE,CR_add,2000est,2016est,Target,HHPop00,HHPop16,HH2000,HH2016,GQpct,GQpct2050,PPH2050
1,33,1,200,250,60,0,300,360,80,290,345,120,150,.04,.05,2.4
2,33,1,100,120,30,10,200,240,40,195,232,80,95,.03,.04,2.5
3,33,2,50,60,20,0,150,180,60,145,172,60,70,.02,.03,2.7
4,53,1,100,110,40,0,200,240,50,185,225,80,95,.06,.07,2.2
5,53,1,50,60,10,0,150,180,50,135,166,60,70,.05,.06,2.3"""
REF = "Year,Pop,HHPop,HH,Emp\n2000,1000,950,400,500\n2016,1200,1140,480,600\n2050,2000,1880,800,1000\n"
RGS_COUNTY = "County,RGSPop,RGSEmp,GQpct2050,PPH2050\n33,.6,.7,.05,2.4\n53,.4,.3,.06,2.3\n"
RGS_RG = "County,RG,RGSPop,RGSEmp,GQpct2050,PPH2050\n33,1,.75,.8,.05,2.4\n33,2,.25,.2,.04,2.6\n53,1,1,1,.06,2.3\n"


def folder(files):
    d = tempfile.mkdtemp(prefix="stratum-in-", dir="/tmp")
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    return d


def hier_files(emp_more="", pop_more="", crosswalk_more="", factor=False):
    rows = [r.split(",") for r in CITIES.splitlines()[1:]]
    annex = ",Annex" if factor else ""
    emp = f"CityID,County,2000est,2016est,Target,CR_add{annex}\n" + "".join(f"{','.join([*r[:2], *r[3:7]])}{',0' if factor else ''}\n" for r in rows) + emp_more
    pop = (f"CityID,County,2000est,2016est,Target,HHPop00,HHPop16,HH2000,HH2016,GQpct,GQpct2050,PPH2050{annex}{',PPH' if factor else ''}\n"
           + "".join(f"{','.join([*r[:2], *r[7:]])}{f',0,{r[-1]}' if factor else ''}\n" for r in rows) + pop_more)
    crosswalk = "CityID,Juris,RGID_Existing,RGID_Proposed\n" + "".join(f"{r[0]},City {r[0]},{r[2]},{r[2]}\n" for r in rows) + crosswalk_more
    return {"ref.csv": REF, "rgs_county.csv": RGS_COUNTY, "rgs_rg.csv": RGS_RG, "city_emp.csv": emp, "city_pop.csv": pop, "crosswalk.csv": crosswalk}


def out_dir():
    return tempfile.mkdtemp(prefix="stratum-out-", dir="/tmp")


def published(spark, out, table, scheme="existing"):
    df = publish.read_published(spark, out, table)
    return df.where(F.col("scheme") == scheme) if "scheme" in df.columns else df


def test_hier_files_give_the_worked_values(spark):
    bad = "\nTotal,,500,600,160,10\n,,500,600,160,10\n9,33,12x,5,1,0\n8,33,1\n,33,1,1,1,1\n"
    out = out_dir()
    R.run(spark, "hier", None, out, "2026-12-03", inputs=folder(hier_files(emp_more=bad)), rg_name="RGID_Existing")
    people = {r.CityID: r for r in published(spark, out, "people").collect()}
    households = {r.CityID: r for r in published(spark, out, "households").collect()}
    jobs = {r.CityID: r for r in published(spark, out, "jobs").collect()}
    want = {1: (134.4, 384.4, 240, 600, 230.4, 562.569040, 243.737671), 2: (89.6, 209.6, 120, 360, 116.4, 341.094492, 141.870718),
            3: (56.0, 116.0, 120, 300, 117.6, 285.367431, 112.404065), 4: (96.0, 206.0, 160, 400, 150.4, 371.660616, 165.764566),
            5: (24.0, 84.0, 160, 340, 152.0, 319.308422, 136.222980)}
    assert set(people) == set(want)
    for c, v in want.items():
        got = (jobs[c].EmpGro1650, jobs[c].Emp2050, people[c].PopGro1650, people[c].Pop2050, people[c].HHPopGro1650, people[c].HHPop2050, households[c].HH2050)
        assert got == pytest.approx(v, abs=1e-6)
    assert people[1].Juris == "City 1" and published(spark, out, "people", "proposed").count() == 5
    rejects = {r.row: r for r in published(spark, out, "rejects").collect()}
    reasons = sorted((r.table, tuple(r.reasons)) for r in rejects.values())
    assert reasons == sorted([("city_emp", ("unparsable: CityID", "total row")), ("city_emp", ("total row",)), ("city_emp", ("unparsable: 2000est",)),
                              ("city_emp", ("malformed line",)), ("city_emp", ("null key: city_id, county",))])
    assert any(r == "8,33,1" for r in rejects) and all(r.file.endswith("city_emp.csv") for r in rejects.values())
    metrics = {r.table: (r.rows, r.kept, r.rejected) for r in published(spark, out, "input_metrics").collect()}
    assert metrics["city_emp"] == (10, 5, 5) and metrics["crosswalk"] == (10, 10, 0) and metrics["ref"] == (3, 3, 0)


@pytest.mark.parametrize(("method", "want"), [
    ("factor_stock", {1: 240.923138, 2: 139.972542, 3: 107.610126, 4: 172.086266, 5: 139.407928}),
    ("factor_growth", {1: 245.830455, 2: 141.477771, 3: 113.478633, 4: 163.242900, 5: 135.970241})])
def test_factor_files_give_the_worked_values(spark, method, want):
    out = out_dir()
    R.run(spark, method, None, out, "2026-12-03", inputs=folder(hier_files(factor=True)))
    hh = {r.CityID: r.HH2050 for r in published(spark, out, "households").collect()}
    assert hh == pytest.approx(want, abs=1e-5)
    pop = {r.CityID: r.HHPop2050 for r in published(spark, out, "people").collect()}
    assert pop == pytest.approx({1: 567.347418, 2: 344.331768, 3: 285.489828, 4: 370.143453, 5: 312.687533}, abs=1e-5)
    # FIXTURES §5: the growth variant has one more column
    more = ["HHPop00"] if method == "factor_growth" else []
    assert list(pop_columns(spark, out)) == ["RGID", "County", "CityID", "Juris", "Pop2000", "Pop2016", "PopGro1650", "Pop2050", *more, "HHPop2016", "HHPopGro1650", "HHPop2050"]


def pop_columns(spark, out, table="people"):
    return [c for c in publish.read_published(spark, out, table).columns if c not in (*publish.RUN_KEYS, "run_date")]


TARGETS = ("county_id,RGID,control_id,name,Emp18,TotEmp20_wCRnoMil,TotEmpTrg_wCRnoMil,TotEmp50_wCRnoMil,Pop18,TotPop20,TotPopTrg,TotPop50,HHpop18,HHpop20,HH18,HH20,GQpct50,PPH50\n"
           "33,1,1,A,10,11,4,15,100,110,30,140,95,100,40,42,5,2.5\n33,1,2,B,20,21,4,25,50,50,30,80,48,49,20,21,5,2.5\n53,2,3,C,5,5,1,6,10,8,-6,2,10,8,4,3,0,2\n")
POP_TOTALS = "Year,Pop\n2018,161\n2025,180\n2030,190\n2035,200\n2040,340\n2044,215\n2050,230\n"


def test_targets_files_give_the_worked_values(spark):
    out = out_dir()
    R.run(spark, "targets", None, out, "2026-12-03", inputs=folder({"targets.csv": TARGETS, "regional_totals.csv": POP_TOTALS}))
    years = [2018, 2020, 2025, 2030, 2035, 2040, 2044, 2050]
    series = {r.control_id: [r[str(y)] for y in years] for r in publish.read_published(spark, out, "series_pop").collect()}
    assert series[1] == pytest.approx([100, 110, 116.666667, 122.222222, 127.777778, 205.555556, 136.111111, 144.444444], abs=1e-6)
    assert series[3] == pytest.approx([10, 8, 6.666667, 5.555556, 4.444444, 0, 2.777778, 1.111111], abs=1e-6)
    unrolled = {(r.subreg_id, r.year): r.total_pop for r in publish.read_published(spark, out, "unrolled").collect()}
    assert [unrolled[1, y] for y in years] == [100, 110, 116, 122, 128, 199, 136, 145]
    assert [unrolled[2, y] for y in years] == [50, 50, 57, 62, 68, 141, 76, 84]
    assert [unrolled[3, y] for y in years] == [10, 8, 7, 6, 4, 0, 3, 1]
    # FIXTURES §5
    lead = ["RGID", "county_id", "control_id", "Juris"]
    assert pop_columns(spark, out) == [*lead, "Pop2018", "Pop2020", "PopGro2050", "Pop2050", "HHPop2018", "HHPop2020", "HHPopGro2050", "HHPop2050"]
    assert pop_columns(spark, out, "jobs") == [*lead, "Emp2018", "Emp2020", "EmpGro2050", "Emp2050"]
    assert pop_columns(spark, out, "rg_summary") == ["county_id", "RGID", "Pop2050", "Pop50", "HH2050", "HH50", "Emp2050", "Emp50"]
    assert pop_columns(spark, out, "series_hh") == ["control_id", *map(str, years)]
    assert pop_columns(spark, out, "unrolled") == ["subreg_id", "year", "total_hhpop", "total_hh", "total_emp", "total_pop"]


def test_forecast_sheet_and_other_names(spark):
    """The wide forecast gives the totals; a mapping renames a column and a file."""
    forecast = "X1,X2,2020Q2,2025Q2,2050Q2\nPopulation,,168,180,230\n,Household Population,100,110,200\nHouseholds,,50,60,70\nEstimated Total Employment,,37,38,46\nOther,,1,x,1\n"
    d = folder({"t.csv": TARGETS.replace("name", "label"), "forecast.csv": forecast})
    given = ingest.load(spark, d, "targets", "base", {"targets": {"file": "t.csv", "columns": {"juris": "label"}}}, 2020)
    totals = {(r.indicator, r.year): r.total for r in given.tables["totals"].collect()}
    assert totals == {("pop", 2025): 180, ("pop", 2050): 230, ("hhpop", 2025): 110, ("hhpop", 2050): 200, ("hh", 2025): 60, ("hh", 2050): 70, ("emp", 2025): 38, ("emp", 2050): 46}
    assert sorted(r.juris for r in given.tables["targets"].collect()) == ["A", "B", "C"]
    path = os.path.join(folder({}), "m.json")
    with open(path, "w") as f:
        json.dump({"targets": {"file": "t.csv", "columns": {"juris": "nowhere"}}}, f)
    with pytest.raises(ValueError, match="no column 'nowhere' for juris"):
        ingest.load(spark, d, "targets", "base", path)


@pytest.mark.parametrize(("file", "more", "table"), [
    ("crosswalk.csv", "1,Again,2,2\n", "crosswalk"), ("rgs_county.csv", "33,.1,.1,.1,1\n", "rgs_county"), ("rgs_rg.csv", "33,2,.1,.1,.1,1\n", "rgs_rg"),
    ("ref.csv", "2016,1,1,1,1\n", "ref"), ("regional_totals.csv", "Year,HHPop,HH,Emp\n2020,1,1,1\n2020,1,1,1\n", "totals")])
def test_repeated_keys_stop_the_run_before_results(spark, file, more, table):
    files = hier_files()
    files[file] = files.get(file, "") + more
    out = out_dir()
    with pytest.raises(ingest.DuplicateKeys, match=f"duplicate key in {table}"):
        R.run(spark, "hier", None, out, "2026-12-03", inputs=folder(files))
    assert os.listdir(out) == []


def test_json_and_parquet_inputs(spark):
    d = folder({"ref.json": '{"Year": 2016, "Pop": 1.5, "HHPop": 1, "HH": 1, "Emp": "NA"}\n{"Year": "x", "Pop": 1}\n{broken\n'})
    spec, into = mappings.HIER_TABLES["ref"], ingest.Inputs()
    kept = ingest.ingest(ingest.read_raw(spark, f"{d}/ref.json"), spec, "ref", into, "s").collect()
    assert [tuple(r) for r in kept] == [("s", 2016, 1.5, 1.0, 1.0, None)]
    assert sorted(map(tuple, (r.reasons for r in into.rejects(spark).collect()))) == [("malformed line",), ("unparsable: Year", "total row")]
    spark.createDataFrame([(2016, 1.0, 1.0, 1.0, 2.0), (None, 1.0, 1.0, 1.0, 1.0)], "year int, pop double, hhpop double, hh double, emp double").write.parquet(f"{d}/p.parquet")
    into = ingest.Inputs()
    assert ingest.ingest(ingest.read_raw(spark, f"{d}/p.parquet"), spec, "ref", into, "s").count() == 1
    assert into.measured == [("ref", 2, 1, 1, 0)]


def test_a_hot_repeated_key_is_counted_map_side(spark):
    df = spark.range(20000).select((F.col("id") % 2 * 0 + F.when(F.col("id") < 12000, 1).otherwise(F.col("id"))).alias("city_id"), F.lit("a").alias("juris"))
    with pytest.raises(ingest.DuplicateKeys, match="1 keys have several rows, such as .*city_id.*1"):
        ingest.unique_rows(df, ("city_id",), "names")
    assert ingest.unique_rows(df.where("city_id > 1"), ("city_id",), "names").count() == 8000


def test_files_follow_the_geography(spark):
    """Each run partition's files, in name order, hold ascending ids."""
    out = out_dir()
    df = spark.range(5000).select(F.lit("base").alias("scenario"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("scheme"),
                                  F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("geo_id"), F.rand(1).alias("v_2020")).repartition(7)
    publish.publish(spark, {"series_hh": df}, out, "hier", "2026-12-03")
    for part, attempt in publish.newest(spark, out)["series_hh"].items():
        folder_ = f"{out}/series_hh/{part}attempt={attempt}"
        ids = [r.CityID for f in sorted(f for f in os.listdir(folder_) if f.startswith("part")) for r in spark.read.parquet(f"{folder_}/{f}").collect()]
        assert len(ids) > 1000 and ids == sorted(ids)


def test_a_failed_run_leaves_the_last_one_readable(spark):
    out = out_dir()
    tables = lambda v: {k: spark.createDataFrame([("base", "x", 1, v)], "scenario string, scheme string, city_id long, value double") for k in ("a", "b", "c")}
    read = lambda: {k: [r.value for r in publish.read_published(spark, out, k).collect()] for k in ("a", "b", "c")}
    publish.publish(spark, tables(1.0), out, "hier", "2026-12-03")
    broken = tables(2.0)
    broken["c"] = broken["c"].withColumn("value", F.raise_error(F.lit("third table")).cast("double"))
    with pytest.raises(Exception, match="third table"):
        publish.publish(spark, broken, out, "hier", "2026-12-03")
    assert read() == {"a": [1.0], "b": [1.0], "c": [1.0]}
    publish.publish(spark, tables(3.0), out, "hier", "2026-12-03")
    assert read() == {"a": [3.0], "b": [3.0], "c": [3.0]}
    publish.publish(spark, tables(4.0), out, "hier", "2026-12-04")          # another run date stands beside
    assert sorted(read()["a"]) == [3.0, 4.0]
    # what the failed run left is gone, the run before the last one as well by now
    assert len([p for p in publish.files.listed(f"{out}/a/*/*/*/attempt=*") if "2026-12-03" in p]) == 1


def test_schemas_are_conformed(spark):
    assert io.read_table(spark, f"{folder({'n.csv': 'city_id,juris\n1,a\n'})}/n.csv", SC.NAMES).schema == SC.NAMES
