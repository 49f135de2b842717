import gzip
import json

import pytest
from pyspark.sql import functions as F

from gridspark import vocab
from gridspark.operators import align, upsert
from gridspark.plans import load, matrix
from gridspark.sources import elec, listing, meter, series_json, sinks, warehouse, weather

DOCS = [
    {"series_id": "EBA.PGE-ALL.D.H", "name": "Demand for Portland General Electric Company (PGE), Hourly, UTC time",
     "f": "H", "data": [["20200102T03Z", 10], ["20200102T04Z", 0], ["20200102T05Z", None]]},
    {"series_id": "EBA.PGE-ALL.NG.COL.H", "name": "Net generation from coal for Portland General (PGE), Hourly, UTC time",
     "f": "H", "data": [["20200102T03Z", 1.5]]},
    {"series_id": "EBA.PGE-BPAT.ID.H",
     "name": "Actual Net Interchange for Portland General (PGE) to Bonneville Power, Inc. (BPAT), Hourly, UTC time",
     "f": "H", "data": [["20200102T03Z", -4]]},
    {"series_id": "EBA.PGE-ALL.D.HL", "name": "Demand for Portland General (PGE), Hourly, local time", "f": "HL",
     "data": [["20200219T03-08", 7]]},
    {"series_id": "EBA.BROKEN.D.H", "name": "Demand for nobody, UTC time", "f": "H", "data": [["x", "y"]]},
    {"category_id": "3389936", "name": "Portland General Electric Company (PGE)", "childseries": ["EBA.PGE-ALL.D.H"]},
    {"category_id": "3389937", "name": "Balancing authorities (all of them)", "childseries": []},
]


@pytest.fixture()
def eba_file(tmp_path):
    path = tmp_path / "EBA.txt"
    path.write_text("\n".join(json.dumps(d) for d in DOCS))
    return str(path)


def test_series_documents(spark, eba_file):
    docs = series_json.read_series(spark, eba_file)
    assert series_json.series_scan(docs, "demand FOR", 2).count() == 2
    assert {r.category_id for r in series_json.category_lines(docs).collect()} == {"3389936", "3389937"}
    assert series_json.name_and_id(docs).count() == 5
    names = {r.abbr: r.full_name for r in series_json.category_names(docs, F.col("category_id")).collect()}
    assert names == {"PGE": "Portland General Electric Company"}
    obs = series_json.explode_observations(docs).where("series_id = 'EBA.PGE-ALL.D.H'").orderBy("ts").collect()
    assert [(r.ts.hour, r.val) for r in obs] == [(3, 10.0), (4, 0.0), (5, None)]
    zero = series_json.explode_observations(docs, zero_as_null=True).where("series_id = 'EBA.PGE-ALL.D.H'")
    assert zero.where("val is null").count() == 2
    local = series_json.explode_observations(docs).where("series_id like '%HL'").collect()[0]
    assert local.ts.hour == 11  # 03:00 at -08
    bad = series_json.explode_observations(docs).where("series_id like '%BROKEN%'").collect()[0]
    assert (bad.ts, bad.source, bad.measure, bad.val) == (None, None, None, None)


def test_load_eba_job(spark, eba_file):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_eba")
    load.load_eba(spark, eba_file, "t_eba", drop=True)
    ids = {r.abbr: r.id for r in spark.table("t_eba.eba_meta").collect()}
    load.load_eba(spark, eba_file, "t_eba")  # a second run changes nothing
    assert {r.abbr: r.id for r in spark.table("t_eba.eba_meta").collect()} == ids and "BPAT" in ids
    assert [warehouse.count(spark, t, "t_eba") for t in ("eba", "eba_inter", "eba_rejects")] == [4, 1, 1]
    assert [(r.series_id, r.pair, r.reason) for r in spark.table("t_eba.eba_rejects").collect()] == [
        ("EBA.BROKEN.D.H", ["x", "y"], "series_id")]
    cut = warehouse.time_slice(spark, "eba", "2020-01-02 03:00:00", "2020-01-31", "t_eba")
    assert sorted(r.ts.hour for r in cut.collect()) == [4, 5]
    assert {(r.source, r.measure, r.val) for r in spark.table("t_eba.eba").collect()} == {
        ("PGE", "D", 10.0), ("PGE", "D", 0.0), ("PGE", "D", None), ("PGE", "NG-COL", 1.5)}
    inter = spark.table("t_eba.eba_inter").collect()
    assert [(r.source, r.dest, r.val) for r in inter] == [("PGE", "BPAT", -4.0)]
    assert warehouse.columns(spark, "eba_meta", "t_eba") == [("id", 1, "int"), ("full_name", 2, "string"),
                                                             ("abbr", 3, "string")]
    assert warehouse.count(spark, "eba_measure", "t_eba") == 14
    out = load.eba_with_ids(series_json.read_series(spark, eba_file))
    dims = {r.abbr: r.full_name for r in out["eba_meta"].collect()}
    assert dims["BPAT"] == "Bonneville Power, Inc." and dims["MEX"] == "Mexico (region)"
    assert out["unknown"].count() == 0
    assert [r.series_id for r in out["rejects"].collect()] == ["EBA.BROKEN.D.H"]
    assert out["eba"].where("source_id is null or measure_id is null").count() == 0
    wide = matrix.measure_record(out["eba"], out["eba_meta"], out["eba_measure"], "Demand", "2020-01-01", "2020-01-03",
                                 ["PGE"])
    assert [r.PGE for r in wide.orderBy("ts").collect()] == [10.0, 0.0]


def test_load_eba_updates_and_refuses(spark, eba_file, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_eba2")
    load.load_eba(spark, eba_file, "t_eba2", drop=True)
    ids = {r.abbr: r.id for r in spark.table("t_eba2.eba_meta").collect()}
    new = [{"series_id": "EBA.AAA-ALL.D.H", "name": "Demand for A new region (AAA), Hourly, UTC time",
            "data": [["20200102T03Z", 5], ["bad time", 6]]},
           {"series_id": "EBA.PGE-ALL.D.H", "name": "Demand for Portland General (PGE), Hourly, UTC time",
            "data": [["20200102T03Z", 11], ["20200302T03Z", 12]]}]
    path = tmp_path / "new.txt"
    path.write_text("\n".join(json.dumps(d) for d in new))
    for _ in range(2):
        load.load_eba(spark, str(path), "t_eba2")
    after = {r.abbr: r.id for r in spark.table("t_eba2.eba_meta").collect()}
    assert {k: after[k] for k in ids} == ids and after["AAA"] == max(ids.values()) + 1
    got = {(r.source, r.measure, r.ts.month, r.ts.hour): r.val for r in spark.table("t_eba2.eba").collect()}
    assert got == {("PGE", "D", 1, 3): 11.0, ("PGE", "D", 1, 4): 0.0, ("PGE", "D", 1, 5): None, ("PGE", "D", 3, 3): 12.0,
                   ("PGE", "NG-COL", 1, 3): 1.5, ("AAA", "D", 1, 3): 5.0}
    assert {(r.series_id, r.reason) for r in spark.table("t_eba2.eba_rejects").collect()} == {
        ("EBA.BROKEN.D.H", "series_id"), ("EBA.AAA-ALL.D.H", "time")}
    strange = [{"series_id": "EBA.ZZZ-ALL.XX.H", "name": "Something without a name, UTC time", "data": [["20200102T03Z", 5]]}]
    path.write_text("\n".join(json.dumps(d) for d in strange))
    with pytest.raises(load.UnknownKeys, match="measure XX, source ZZZ"):
        load.load_eba(spark, str(path), "t_eba2")
    assert warehouse.count(spark, "eba", "t_eba2") == len(got)


def test_warehouse_upsert_and_drop(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_wh")
    warehouse.drop_tables(spark, None, "t_wh", execute=True)
    warehouse.create_tables(spark, ["eba"], "t_wh")
    warehouse.create_tables(spark, ["eba"], "t_wh")
    rows = "ts timestamp, source string, measure string, val double"
    from datetime import datetime
    t = datetime(2020, 1, 1)
    warehouse.append(spark.createDataFrame([(t, "A", "D", 1.0), (t, "B", "D", 2.0), (t, "A", "NG", 3.0)], rows), "eba",
                     "t_wh", sort_by=["source", "ts"])
    new = spark.createDataFrame([(t, "A", "D", 9.0), (t, "C", "D", 4.0)], rows)
    for _ in range(2):  # applying an update twice changes nothing
        warehouse.upsert_table(new, "eba", ["ts", "source", "measure"], "val", "t_wh")
    got = {(r.source, r.measure): r.val for r in spark.table("t_wh.eba").collect()}
    assert got == {("A", "D"): 9.0, ("B", "D"): 2.0, ("C", "D"): 4.0, ("A", "NG"): 3.0}
    assert warehouse.preview(spark, "eba", 2, "t_wh").count() == 2
    assert warehouse.drop_tables(spark, ["eba"], "t_wh") == ["DROP TABLE IF EXISTS t_wh.eba"]
    assert spark.catalog.tableExists("t_wh.eba")
    warehouse.drop_tables(spark, ["eba"], "t_wh", execute=True)
    assert not spark.catalog.tableExists("t_wh.eba")


def test_upsert_order(spark):
    old = spark.createDataFrame([("k", 1.0)], "k string, val double")
    new = spark.createDataFrame([("k", 2.0, 5), ("k", 3.0, 7), ("j", 4.0, 1)], "k string, val double, o int")
    assert {r.k: r.val for r in upsert.upsert(old, new, ["k"], "val", "o").collect()} == {"k": 3.0, "j": 4.0}


@pytest.fixture()
def stations(spark):
    return spark.createDataFrame(
        [(0, "Portland Intl", "Portland", "OR", "KPDX", 726980, 24229, 45.6, -122.6),
         (1, "Short", "Salem", "OR", "KSLE", 726940, 42, 44.9, -123.0)],
        "id int, name string, city string, state string, callsign string, usaf int, wban int, lat double, lng double")


def test_isd_files(spark, tmp_path, stations):
    folder = tmp_path / "isd"
    folder.mkdir()
    lines = ["2016 01 02 03   -11   -50 10132   270    36     8    -9999 -9999",
             "2016 01 02 04     0 -9999 10130   -999    0     8       5 -9999"]
    with gzip.open(folder / "726980-24229-2016.gz", "wt") as fh:
        fh.write("\n".join(lines))
    (folder / "726940-00042-2016.gz").touch()
    wide = weather.read_isd(spark, str(folder)).orderBy("ts").collect()
    assert [(r.ts.hour, r.temp, r.dew_temp, r.wind_dir, r.precip_1hr) for r in wide] == [
        (3, -11, -50, 270, None), (4, 0, None, None, 5)]
    spark.sql("CREATE DATABASE IF NOT EXISTS t_isd")
    report = {r.callsign: (r.n_expected, r.n_found) for r in
              load.load_isd(spark, str(folder), stations, "t_isd", drop=True).collect()}
    assert report == {"KPDX": (9, 1), "KSLE": (9, 0)}
    got = {(r.ts.hour, r.measure): r.val for r in spark.table("t_isd.isd").collect()}
    assert got[(3, "temp")] == -11.0 and got[(4, "temp")] == 0.0 and len(got) == 6
    load.load_isd(spark, str(folder), stations, "t_isd")  # a second run changes nothing
    assert [warehouse.count(spark, t, "t_isd") for t in ("isd", "isd_meta", "isd_rejects")] == [6, 2, 0]
    have = listing.existing_files(weather.with_file_names(stations), listing.list_files(spark, str(folder)))
    assert [r.file_name for r in have.collect()] == ["726980-24229-2016.gz"]
    framed = weather.station_frame(weather.read_isd(spark, str(folder)).withColumn("callsign", F.lit("KPDX")), stations)
    assert {r.city_state + "|" + r.region for r in framed.collect()} == {"Portland, OR|Northwest"}


def test_station_history_and_airports(spark, tmp_path):
    row = "{:6} {:5} {:29} {:4} {:2} {:5} {:7} {:8} {:7} {:8} {:8}"
    (tmp_path / "history.txt").write_text("\n".join(
        ["Integrated Surface Database Station History", "", "USAF   WBAN  STATION NAME    CTRY ST CALL  LAT"] + [
            row.format("726980", "24229", "PORTLAND INTL", "US", "OR", "KPDX", "+45.596", "-122.609", "+0005.8",
                       "19730101", "20230301"),
            row.format("726981", "99999", "PORTLAND OLD", "US", "OR", "KPDX", "+45.5", "-122.6", "+0005.8",
                       "19730101", "20230301"),
            row.format("A00001", "24230", "CLOSED", "US", "OR", "KOLD", "+45.5", "-122.6", "+0005.8",
                       "19730101", "19990301")]))
    history = weather.read_station_history(spark, str(tmp_path / "history.txt"))
    assert {(r.USAF, r.CALL, r.ST) for r in history.collect()} == {("726980", "KPDX", "OR"), ("726981", "KPDX", "OR")}
    assert history.where("USAF = '726980'").collect()[0].LON == -122.609
    (tmp_path / "air.csv").write_text(
        "id,ident,type,name,iso_country,municipality\n1,KPDX,large_airport,Portland Intl,US,Portland\n"
        "2,KXXX,heliport,Roof,US,Portland\n3,EGLL,large_airport,Heathrow,GB,London\n")
    air = weather.airport_filter(weather.read_airports(spark, str(tmp_path / "air.csv")))
    assert [tuple(r) for r in air.collect()] == [("Portland Intl", "Portland", "KPDX")]
    merged = weather.merge_stations(air, history, ["USAF"]).collect()
    assert len(merged) == 1 and (merged[0].USAF, merged[0].WBAN) == ("726980", "24229")


def test_lists_and_sinks(spark, tmp_path, stations):
    (tmp_path / "signs.csv").write_text("PPIZ\n\n PAFA \n")
    assert sorted(r.name for r in weather.read_lines(spark, str(tmp_path / "signs.csv")).collect()) == ["PAFA", "PPIZ"]
    assert [r.callsign for r in weather.sorted_callsigns(stations).collect()] == ["KPDX", "KSLE"]
    sinks.write_csv(stations, str(tmp_path / "st"))
    assert list((tmp_path / "st").glob("*.csv.gz"))
    assert spark.read.option("header", True).csv(str(tmp_path / "st")).count() == 2
    sinks.write_name_map(stations, str(tmp_path / "map"), "callsign", "name")
    assert {r.value for r in spark.read.text(str(tmp_path / "map")).collect()} == {
        '{"KPDX":"Portland Intl"}', '{"KSLE":"Short"}'}
    sinks.write_json(stations, str(tmp_path / "js"))
    assert spark.read.json(str(tmp_path / "js")).count() == 2


def test_meter(spark, tmp_path):
    (tmp_path / "meter.csv").write_text("Extra,ID,LocalDateTime,kWh\nx,7,01JAN11:00:15:00,0.25\nx,7,31Dec12:23:45:00,bad\n")
    rows = meter.meter_series(meter.read_meter(spark, str(tmp_path / "meter.csv"))).orderBy("ts").collect()
    assert [(r.ID, str(r.ts), r.kWh) for r in rows] == [("7", "2011-01-01 00:15:00", 0.25), ("7", "2012-12-31 23:45:00", None)]
    assert meter.read_meter(spark, str(tmp_path / "meter.csv"), nrows=1).count() == 1


def test_elec_chunks_and_periods(spark, tmp_path):
    (tmp_path / "c0").write_text(json.dumps({"name": "a : b : c", "f": "M", "data": [["201603", 1.5], ["201604", None]]}))
    (tmp_path / "c1").write_text(json.dumps({"name": "p", "f": "Q", "childseries": ["x"], "data": [["2016Q3", 2]]}))
    rows = elec.read_elec(spark, [str(tmp_path / "c0"), str(tmp_path / "c1")])
    assert set(rows.columns) == {"name", "f", "data", "childseries"}
    assert {r.childseries for r in rows.collect()} == {None, '["x"]'}
    out = {(r.name, str(r.obs_date)): r.obs_val for r in elec.period_explode(rows, ["name"]).collect()}
    assert out == {("a : b : c", "2016-03-01"): 1.5, ("a : b : c", "2016-04-01"): None, ("p", "2016-07-01"): 2.0}
    bad = spark.createDataFrame([("z", "A", "not json"), ("y", "M", '[["201699","1"]]')], "name string, f string, data string")
    assert [(r.name, r.obs_date) for r in elec.period_explode(bad, ["name"]).collect()] == [("y", None)]


def test_dim_enrich_reports_unknown(spark):
    dim = spark.createDataFrame([(5, "Known", "K")], "id int, full_name string, abbr string")
    facts = spark.createDataFrame([("K",), ("N",), ("?",)], "abbr string")
    titles = spark.createDataFrame([("N", "New One")], "abbr string, full_name string")
    out, unknown = align.dim_enrich(facts, dim, titles)
    assert {(r.id, r.abbr) for r in out.collect()} == {(5, "K"), (6, "N")}
    assert [r.abbr for r in unknown.collect()] == ["?"]


def test_vocabulary(spark):
    assert vocab.measure_dim(spark).count() == 14
    assert vocab.region_dim(spark).count() == 50 and vocab.state_dim(spark).count() == 50
    assert vocab.city_dim(spark).count() == 150
    assert vocab.literal_table(spark, [("it's", 1.5)], ["a", "b"]).collect()[0].a == "it's"


def test_the_last_value_of_a_key_counts(spark, tmp_path):
    import os

    def line(values):
        return ('{"series_id":"EBA.PACE-ALL.D.H","name":"Demand for PacifiCorp East (PACE), Hourly, UTC time","f":"H","data":'
                + str([[h, v] for h, v in values]).replace("'", '"') + "}\n")

    folder = tmp_path / "eba"
    folder.mkdir()
    (folder / "b.txt").write_text(line([("20240101T00Z", 9.0), ("20240101T01Z", 9.0)]))
    (folder / "a.txt").write_text(line([("20240101T00Z", 5.0), ("20240101T00Z", 3.0)]))
    os.utime(folder / "b.txt", (1, 1))
    load.load_eba(spark, str(folder), drop=True)
    got = {r.ts.hour: r.val for r in spark.table("eba").collect()}
    assert got == {0: 3.0, 1: 9.0}


def test_elec_table_grows(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_grow")
    (tmp_path / "c0").write_text(json.dumps({"name": "a", "f": "M", "data": [["201603", 1.5]]}) + "\n" + json.dumps({"name": "b"}))
    (tmp_path / "c1").write_text(json.dumps({"name": "p", "childseries": ["x"], "odd name": 1}))
    assert load.load_elec(spark, [str(tmp_path / "c0")], database="t_grow", drop=True) == ["data", "f", "name"]
    for _ in range(2):  # a repeated load adds neither columns nor rows
        added = load.load_elec(spark, [str(tmp_path / "c1")], database="t_grow")
    assert added == []
    assert warehouse.columns(spark, "elec", "t_grow")[3:] == [("childseries", 4, "string"), ("odd name", 5, "string")]
    got = {r.name: (r.f, r.childseries, r["odd name"]) for r in spark.table("t_grow.elec").collect()}
    assert got == {"a": ("M", None, None), "b": (None, None, None), "p": (None, '["x"]', "1")}
    assert warehouse.count(spark, "elec", "t_grow") == 3
    assert load.load_elec(spark, [str(tmp_path / "c1")], database="t_grow", drop=True) == ["childseries", "name", "odd name"]


def test_files_of_a_month_are_cut_by_source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_sorted")
    warehouse.drop_tables(spark, ["eba"], "t_sorted", execute=True)
    warehouse.create_tables(spark, ["eba"], "t_sorted")
    rows = spark.range(48 * 744).select(
        (F.lit("2020-01-01").cast("timestamp") + F.make_dt_interval(hours=F.expr("int(id % 744)"))).alias("ts"),
        F.format_string("S%02d", F.expr("int(id / 744)")).alias("source"), F.lit("D").alias("measure"), F.col("id").cast("double").alias("val"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        warehouse.replace_partitions(warehouse.shaped(rows, "eba", "t_sorted"), "eba", "t_sorted", ["measure", "month", "source", "ts"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    table = spark.table("t_sorted.eba")
    files = table.select(F.input_file_name().alias("file"), "source").groupBy("file").agg(
        F.min("source").alias("lo"), F.max("source").alias("hi")).collect()
    wanted = [f for f in files if f.lo <= "S17" <= f.hi]
    assert table.count() == 48 * 744 and len(files) >= 30 and len(wanted) < len(files) / 10
    got = warehouse.time_slice(spark, "eba", "2020-01-05", "2020-01-06", "t_sorted").where("source = 'S17'")
    assert got.count() == 24
    warehouse.drop_tables(spark, ["eba"], "t_sorted", execute=True)
