from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import types as T

from dockcast.config import EngineConfig
from dockcast.sources import files


def _write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_columns_are_matched_by_name(spark, tmp_path):
    _write(tmp_path, "a.csv", "x,y,z\n1,10,p\n2,20,NaN\n")
    _write(tmp_path, "b.csv", 'y,x\n30,3\n')
    _write(tmp_path, "c.txt", "x,y\n9,9\n")
    _write(tmp_path / "deeper", "d.csv", "x,y\n8,8\n")
    got = files.read_csv_folder(spark, str(tmp_path)).orderBy("x").collect()
    assert [(int(r.x), int(r.y), r.z) for r in got] == [(1, 10, "p"), (2, 20, None), (3, 30, None)]


def test_empty_folder_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_csv_folder(spark, str(tmp_path))


TRIP_HEADER = (
    "trip_id,starttime,stoptime,bikeid,tripduration,from_station_id,from_station_name,"
    "to_station_id,to_station_name,usertype,gender,birthyear\n"
)


@pytest.fixture
def data_folder(tmp_path):
    base = tmp_path / "data"
    _write(
        base / "station",
        files.STATION_FILE,
        "staID,tripCt,ctPopn,avgMedianIncome,numBiz,numBSS,totalCap,numSchool,numPark,totalParkArea\n"
        "1,5,6,7.5,8,9,10,11,12,1.5\n2,5,6,7.5,8,9,10,11,12,NaN\n",
    )
    weather = "datetime,tempi,dewpti,hum,wspdi,wdird,visi,pressurei,precipi,fog,rain,snow,hail,thunder,tornado,tempm\n"
    _write(base / "weather", "w.csv", weather + "2016-07-01 01:00:00,70,50,40,5,180,10,30,-9999,0,1,0,0,0,0,21\n")
    _write(base / "trip", "q1.csv", TRIP_HEADER + "1,7/1/2016 0:00:00,7/1/2016 0:09:00,3,540,1,A,2,B,Subscriber,Male,1980\n")
    _write(base / "trip", "q2.csv", TRIP_HEADER + '2,7/2/2016 9:30,7/2/2016 9:40,3,600,2,"B, north",1,A,Customer,,\n')
    return str(base)


def test_load_tables(spark, data_folder):
    tables = files.load_tables(spark, data_folder)
    assert tables.station.columns[:3] == ["sta_id", "trip_ct", "ct_popn"]
    assert tables.station.filter("total_park_area IS NULL").count() == 1
    assert tables.trip.count() == 2 and tables.weather.count() == 1
    assert tables.trip.filter("trip_id = 2").first().from_station_name == "B, north"
    with pytest.raises(ValueError):
        files.load_tables(spark, data_folder, "xml")


def test_prepare_saves_and_reuses(spark, data_folder, tmp_path):
    config = EngineConfig(data_path=data_folder, prepared_path=str(tmp_path / "saved"))
    built = files.prepare(spark, config)
    assert files.is_prepared(spark, config.prepared_path)
    assert {(r.date, r.hour_period, r.gender, r.birthyear) for r in built.trip.collect()} == {
        (date(2016, 7, 1), "6,21-24", "Male", 1980.0),
        (date(2016, 7, 2), "3,9-12", "U", 1980.0),
    }
    assert built.weather_period.first().precipi_min == 0.0
    gone = replace(config, data_path=str(tmp_path / "nowhere"))
    assert files.prepare(spark, gone).trip.count() == 2
    with pytest.raises(Exception):
        files.prepare(spark, gone, reuse=False)


def test_changed_inputs_make_a_new_snapshot(spark, data_folder, tmp_path):
    """Only tables whose files changed are built again; an interrupted save changes nothing; readers keep theirs."""
    config = EngineConfig(data_path=data_folder, prepared_path=str(tmp_path / "saved"))
    first = files.prepare(spark, config)
    before = files._current(spark, config.prepared_path)["tables"]
    files.prepare(spark, config)
    assert files._manifests(spark, config.prepared_path) == ["manifest-000001.json"]

    trip = sorted(Path(data_folder, "trip").glob("*.csv"))[0]
    more = trip.with_name("more.csv")
    head, *lines = trip.read_text().splitlines()
    more.write_text("\n".join([head, *lines]) + "\n")
    commit = files._commit
    files._commit = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            files.prepare(spark, config)
    finally:
        files._commit = commit
    assert files.load_prepared(spark, config.prepared_path).trip.count() == 2

    again = files.prepare(spark, config)
    after = files._current(spark, config.prepared_path)["tables"]
    assert again.trip.count() > 2 and first.trip.count() == 2
    assert after["trip"] != before["trip"] and {n: after[n] for n in ("station", "weather_period")} == {n: before[n] for n in ("station", "weather_period")}
    files.drop_snapshots(spark, config.prepared_path, keep=1)
    assert files.load_prepared(spark, config.prepared_path).trip.count() > 2
    assert len(list(Path(config.prepared_path).glob("data-*"))) == 2  # the first still holds two of the tables


def test_parquet_bundle(spark, data_folder, tmp_path):
    tables = files.load_tables(spark, data_folder)
    for name, df in zip(("station", "weather", "trip"), tables):
        df.write.parquet(f"{tmp_path}/bundle/{name}")
    again = files.load_tables(spark, f"{tmp_path}/bundle", "parquet")
    assert [t.count() for t in again] == [2, 1, 2]


LONGS = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.DoubleType())])


def test_cells_are_converted_by_rule(spark, tmp_path):
    _write(tmp_path, "a.csv", "x,y\n35.0,1\n 7 ,2.5\n12.,NA\n,\n9\n")
    _write(tmp_path, ".hidden.csv", "x,y\n1,1\n")
    got = files.read_csv_folder(spark, str(tmp_path), LONGS).collect()
    assert {(r.x, r.y) for r in got} == {(35, 1.0), (7, 2.5), (12, None), (None, None), (9, None)}


@pytest.mark.parametrize("line", ["abc,1", "35.5,1", "1,x", "1,2,3"])
def test_a_cell_that_cannot_be_read_raises(spark, tmp_path, line):
    _write(tmp_path, "a.csv", f"x,y\n1,1\n{line}\n")
    with pytest.raises(Exception, match="a.csv"):
        files.read_csv_folder(spark, str(tmp_path), LONGS).collect()


def test_underscore_files_are_not_lost_silently(spark, tmp_path):
    _write(tmp_path, "_b.csv", "x,y\n1,1\n")
    with pytest.raises(ValueError, match="_b.csv"):
        files.read_csv_folder(spark, str(tmp_path), LONGS)


def test_headers_need_no_jobs(spark, tmp_path):
    for n in range(200):
        _write(tmp_path, f"{n}.csv", f"x,y\n{n},1\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    frame = files.read_csv_folder(spark, str(tmp_path), LONGS)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 1  # listing many paths is a job
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert frame.count() == 200
