"""CSV folders, the table bundle, and the prepared tables on disk."""

from __future__ import annotations

import csv
import json
import uuid
from multiprocessing.pool import ThreadPool
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.config import EngineConfig
from dockcast.operators.cleaning import missing_text_to_null, nan_to_null
from dockcast.plans.trips import build_trips
from dockcast.plans.weather import build_weather
from dockcast.schemas import MISSING_TEXT, STATION, STATION_NAMES, TRIP, WEATHER

# Fixed value: name of the station file in a data folder.
STATION_FILE = "station_geo&econ_data_Chicago.csv"


class Tables(NamedTuple):
    station: DataFrame
    weather: DataFrame
    trip: DataFrame


class Prepared(NamedTuple):
    station: DataFrame
    weather_period: DataFrame
    trip: DataFrame


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_csv(spark: SparkSession, path: str) -> list[str]:
    """The ``*.csv`` files directly in a folder, on any file system Spark can read.

    Dot files are left out. Spark hides names with a leading underscore, so such a file is
    an error rather than a loss.
    """
    target, fs = _folder(spark, path)
    if not fs.exists(target):
        return []
    found = [s.getPath() for s in fs.listStatus(target) if s.isFile()]
    found = [p for p in found if p.getName().endswith(".csv") and not p.getName().startswith(".")]
    for p in found:
        if p.getName().startswith("_"):
            raise ValueError(f"rename {p.toString()}: Spark doesn't read files whose name begins with an underscore")
    return sorted(p.toString() for p in found)


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _folder(spark, path)
    return fs.exists(target)


def read_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names of a CSV file; reads its first line through the file system, without a job."""
    target, fs = _folder(spark, file)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(fs.open(target), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    if line is None:
        raise ValueError(f"no header in {file}")
    return tuple(next(csv.reader([line.lstrip("\ufeff")])))


# A line with more cells than the header leaves something in the first.
SURPLUS, SOURCE = "_surplus", "_source"


def _converted(name: str, kind: T.DataType) -> Column:
    """A text cell as its type. A cell that says it is missing is null; any other that isn't of
    the type raises. A whole number may be written with a zero fraction."""
    cell = F.trim(F.col(f"`{name}`"))
    if isinstance(kind, T.StringType):
        return F.col(f"`{name}`")
    if isinstance(kind, (T.LongType, T.IntegerType)):
        cast = F.regexp_replace(cell, r"\.0*$", "").try_cast(kind)
    else:
        cast = cell.try_cast(kind)
    said = F.concat(F.lit(f"column {name} can't be {kind.simpleString()}: "), cell, F.lit(" in "), F.col(SOURCE))
    return F.when(cell.isNull() | cell.isin(MISSING_TEXT), None).otherwise(F.coalesce(cast, F.raise_error(said).cast(kind)))


def _read_group(spark: SparkSession, files: list[str], header: tuple[str, ...], schema) -> DataFrame:
    """Files of one header. With a schema, cells are read as text and converted by rule, so none
    is lost; a line with too many cells raises, one with too few has nulls at its end."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(files)
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*header, SURPLUS)])
    rows = reader.schema(text).csv(files).withColumn(SOURCE, F.input_file_name())
    said = F.concat(F.lit("a line has more cells than the header: "), F.col(SOURCE))
    rows = rows.where(F.col(SURPLUS).isNull() | F.raise_error(said).cast("boolean"))
    known = {f.name: f.dataType for f in schema}
    return rows.select(*[_converted(n, known.get(n, T.StringType())).alias(n) for n in header])


def read_csv_folder(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All ``*.csv`` files of a folder stacked by column name.

    Spark matches CSV columns by position within one read, so files are grouped by their
    header, each group is one scan, and the groups are united by name with nulls for
    absent columns. Only headers are read up front. Raises on a folder without files.
    """
    files = list_csv(spark, path)
    if not files:
        raise FileNotFoundError(f"no CSV file in {path}")
    with ThreadPool(min(16, len(files))) as pool:
        headers = pool.map(lambda f: read_header(spark, f), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        groups.setdefault(header, []).append(file)
    parts = [_read_group(spark, members, header, schema) for header, members in groups.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return nan_to_null(missing_text_to_null(stacked))


def read_station_csv(spark: SparkSession, file: str) -> DataFrame:
    raw = _read_group(spark, [file], read_header(spark, file), STATION)
    return station_names(nan_to_null(missing_text_to_null(raw)))


def station_names(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({k: v for k, v in STATION_NAMES.items() if k in raw.columns})


def load_tables(spark: SparkSession, base: str, fmt: str = "csv") -> Tables:
    """Station, weather and trip tables from the three sub-folders of ``base``."""
    if fmt == "csv":
        return Tables(
            read_station_csv(spark, f"{base}/station/{STATION_FILE}"),
            read_csv_folder(spark, f"{base}/weather", WEATHER),
            read_csv_folder(spark, f"{base}/trip", TRIP),
        )
    if fmt == "parquet":
        read = [nan_to_null(spark.read.parquet(f"{base}/{name}")) for name in ("station", "weather", "trip")]
        return Tables(station_names(read[0]), read[1], read[2])
    raise ValueError(f"unknown format {fmt!r}")


# --- snapshots of prepared tables --------------------------------------------------------
#
# A snapshot is a manifest, ``manifest-000001.json`` and so on; the one with the highest number counts. It
# names the folder of each table and the input files the table was made from. Tables are written
# to folders of their own first, and the rename of the manifest to its name is what makes them the
# snapshot. So a save that is interrupted leaves the old snapshot as it was, and a reader has
# the tables of one snapshot, whatever is saved meanwhile.

TABLES = ("station", "weather_period", "trip")


def _manifests(spark: SparkSession, path: str) -> list[str]:
    target, fs = _folder(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(n for n in names if n.startswith("manifest-") and n.endswith(".json"))


def _current(spark: SparkSession, path: str) -> dict | None:
    found = _manifests(spark, path)
    if not found:
        return None
    file, fs = _folder(spark, f"{path}/{found[-1]}")
    stream = fs.open(file)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    found = _manifests(spark, path)
    number = int(found[-1][len("manifest-") : -len(".json")]) + 1 if found else 1
    draft, fs = _folder(spark, f"{path}/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(manifest, indent=1).encode()))
    stream.close()
    final, _ = _folder(spark, f"{path}/manifest-{number:06d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another save of {path} came first")


def save_prepared(prepared: Prepared, path: str, inputs: dict | None = None, only: tuple[str, ...] = TABLES) -> None:
    """A new snapshot in Parquet; trips are laid out by date, with large dates split over several files.

    ``inputs`` are the input files by table. With ``only`` the other tables stay those of the
    snapshot before, without being written again.
    """
    spark = prepared.trip.sparkSession
    before = _current(spark, path) or {"tables": {}, "inputs": {}}
    folder = f"data-{uuid.uuid4().hex}"
    for name in only:
        table = getattr(prepared, name)
        if name == "trip":
            table.hint("rebalance", "date").write.partitionBy("date").parquet(f"{path}/{folder}/trip")
        else:
            table.write.parquet(f"{path}/{folder}/{name}")
    tables = before["tables"] | {name: f"{folder}/{name}" for name in only}
    known = before["inputs"] | {name: (inputs or {}).get(name) for name in only}
    _commit(spark, path, {"tables": tables, "inputs": known})


def load_prepared(spark: SparkSession, path: str) -> Prepared:
    """The tables of the newest snapshot."""
    manifest = _current(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no snapshot in {path}")
    return Prepared(*[spark.read.parquet(f"{path}/{manifest['tables'][name]}") for name in TABLES])


def is_prepared(spark: SparkSession, path: str) -> bool:
    manifest = _current(spark, path)
    return manifest is not None and all(exists(spark, f"{path}/{manifest['tables'][name]}/_SUCCESS") for name in TABLES)


def drop_snapshots(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the newest manifests, and the tables that none of the others names.

    Not while another run saves: its tables have no manifest yet.
    """
    found = _manifests(spark, path)
    named = set()
    for name in found[-keep:]:
        file, fs = _folder(spark, f"{path}/{name}")
        stream = fs.open(file)
        named |= {t.split("/")[0] for t in json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["tables"].values()}
        stream.close()
    target, fs = _folder(spark, path)
    for status in fs.listStatus(target) if found else []:
        name = status.getPath().getName()
        if name in found[:-keep] or (name.startswith("data-") and name not in named):
            fs.delete(status.getPath(), True)


def input_files(spark: SparkSession, base: str, fmt: str = "csv") -> dict[str, list] | None:
    """Name, size and time of the files each prepared table is made from; None without the data folder."""
    target, fs = _folder(spark, base)
    if not fs.exists(target):
        return None
    out = {}
    for name, folder in zip(TABLES, ("station", "weather", "trip"), strict=True):
        place, fs = _folder(spark, f"{base}/{folder}")
        listed = [s for s in fs.listStatus(place) if s.isFile()] if fs.exists(place) else []
        out[name] = sorted([s.getPath().getName(), s.getLen(), s.getModificationTime()] for s in listed if not s.getPath().getName().startswith((".", "_")))
    return out


def prepare_tables(tables: Tables) -> Prepared:
    return Prepared(tables.station, build_weather(tables.weather).period, build_trips(tables.trip))


def prepare(spark: SparkSession, config: EngineConfig, reuse: bool | None = None, fmt: str = "csv") -> Prepared:
    """Prepared tables: those of the newest snapshot as far as their input files haven't changed.

    Tables whose files are new, gone or changed are built and saved as a new snapshot. (The trips
    all together: the mean that fills missing birth years is theirs.) Without the data folder, or
    for tables saved without a list of files, the snapshot is taken as it is.
    """
    path = config.prepared_path
    wanted = config.reuse_prepared if reuse is None else reuse
    now = input_files(spark, config.data_path, fmt)
    stale = TABLES
    if wanted and is_prepared(spark, path):
        known = _current(spark, path)["inputs"]
        stale = tuple(n for n in TABLES if now is not None and known.get(n) is not None and known[n] != now[n])
    if stale:
        save_prepared(prepare_tables(load_tables(spark, config.data_path, fmt)), path, now, stale)
    return load_prepared(spark, path)
