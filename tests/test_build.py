import datetime as dt
import glob
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fixtures import write_master, write_snapshot
from stationday.errors import DataQualityError, MissingRawObjects, VerificationError
from stationday.operators.joins import raise_if_any
from stationday.plans.build import Warehouse, build, published_files, rebuild
from stationday.schemas import CONDITIONS_SCHEMA, LANDING_SCHEMA
from stationday.sources.chunks import chunk_lines, chunk_rows, verify_chunks, write_chunks
from stationday.sources.landing import day_folders, landing_rows, read_landing, require_landable, write_landing
from stationday.sources.published import read_published
from stationday.sources.rawcsv import file_payloads

DAY, NEXT = dt.date(2025, 11, 2), dt.date(2025, 11, 3)
STATIONS = {"20711": "47519", "53026": "47741", "99999": ""}
MASTER = [["20711", "霧ヶ峰", "36", "12.6", "138", "9.0"], ["53026", "長浜②", "33", "22.8", "135", "30.0"]]


REORDERED = {"precipitation": [3, 10, 9, 0, 1, 2, 4, 5, 6, 7, 8]}


def published(spark, warehouse):
    rows = read_published(spark, warehouse.conditions).orderBy("date", "station_id").collect()
    return [row.asDict(recursive=True) for row in rows]


@pytest.fixture(scope="module")
def master(tmp_path_factory):
    return write_master(str(tmp_path_factory.mktemp("master") / "master.csv"), MASTER)


@pytest.fixture(scope="module")
def incoming(tmp_path_factory):
    """Two days; on the second the columns stand in another order and stations in the reverse."""
    root = str(tmp_path_factory.mktemp("incoming"))
    write_snapshot(root, DAY, STATIONS, hours={"min_temperature": "13"})
    write_snapshot(root, NEXT, dict(list(STATIONS.items())[::-1]), orders=REORDERED, base=5.0)
    return root


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory, incoming, master):
    warehouse = Warehouse(str(tmp_path_factory.mktemp("both")))
    return warehouse, build(spark, warehouse, incoming, master, [DAY, NEXT])


def test_build_publishes_one_row_per_station_and_day(spark, both):
    warehouse, report = both
    rows = published(spark, warehouse)
    assert report.rows == 4 and report.dates == [DAY, NEXT] and report.duplicate_stations == []
    assert [(r["date"], r["station_id"]) for r in rows] == [(d, s) for d in (DAY, NEXT) for s in ("20711", "53026")]
    first = rows[0]
    assert list(first) == CONDITIONS_SCHEMA.fieldNames()
    assert first["station_name"] == "霧ヶ峰" and first["latitude"] == pytest.approx(36.21)
    assert first["precipitation_mm"] == 20.0 and first["max_gust_direction"] == "北北西"
    assert first["tree_info"] == {
        "value": 3,
        "plants": [{"code": "BIRCH", "value": 3}, {"code": "OAK", "value": 1}],
    }
    assert first["grass_info"] is None
    hour = read_published(spark, warehouse.conditions).where(F.col("date") == F.lit(DAY))
    assert hour.select(F.date_format("observed_at", "HH:mm")).first()[0] == "04:00"  # 13:00 in Japan
    assert read_landing(spark, warehouse.landing).count() == 12
    assert {f.day for f in published_files(spark, warehouse).collect()} == {"2025-11-02", "2025-11-03"}


def test_build_writes_a_document_per_day(spark, both):
    warehouse, _ = both
    (part,) = glob.glob(f"{warehouse.geojson}/date=2025-11-02/part-*.txt")
    document = json.loads(open(part, encoding="utf-8").read())
    assert [f["properties"]["station_id"] for f in document["features"]] == ["20711", "53026"]
    latitude = published(spark, warehouse)[1]["latitude"]
    assert document["features"][1]["geometry"] == {"type": "Point", "coordinates": [135.5, latitude]}


def test_build_records_metrics(spark, both):
    warehouse, report = both
    rows = spark.read.parquet(warehouse.metrics).where(F.col("snapshot_date") == F.lit(DAY)).collect()
    metrics = {(r.table_name, r.metric): r.value for r in rows}
    assert {r.run_id for r in rows} == {report.run_id}
    assert metrics["cleaned.precipitation", "row_count"] == "3"
    assert metrics["cleaned.max_gust", "null_count"] == "0"
    assert metrics["daily_weather", "observed_at"] == "2025-11-02T13:00:00+09:00"
    assert metrics["daily_weather", "differs"] == "true"
    assert metrics["pollen_cleaned", "observation_date"] == "2025-11-02"
    assert metrics["daily_weather_conditions", "column_count"] == str(len(CONDITIONS_SCHEMA))
    written = {name.split(".")[0] for name, metric in metrics if metric == "sha256"}
    assert written == {"daily_weather_conditions", "daily_weather_conditions_geojson"}
    assert metrics["pollen_cleaned", "null_grass_info_count"] == "2"


def test_many_days_equal_single_day_runs(spark, tmp_path, both, incoming, master):
    one, two = Warehouse(str(tmp_path / "one")), Warehouse(str(tmp_path / "two"))
    build(spark, one, incoming, master, [DAY])
    build(spark, two, incoming, master, [NEXT])
    assert published(spark, both[0]) == published(spark, one) + published(spark, two)

    # a rebuild reads what is landed; measurements may also be read in place
    before = published(spark, one)
    rebuild(spark, one, master, [DAY], measurements=incoming)
    assert published(spark, one) == before

    # a day built again replaces itself
    changed = write_snapshot(str(tmp_path / "in"), DAY, STATIONS, base=1.0)
    build(spark, one, changed, master, [DAY])
    after = published(spark, one)
    assert len(after) == 2 and after[0]["precipitation_mm"] == 1.0


def test_rebuild_needs_no_incoming_files(spark, both, master):
    warehouse, _ = both
    before = published(spark, warehouse)
    rebuild(spark, warehouse, master, [NEXT])
    assert published(spark, warehouse) == before


@pytest.mark.parametrize("lacking", ["max_wind.csv", "pollen.json"])
def test_missing_object_stops_the_build(spark, tmp_path, master, lacking):
    incoming = write_snapshot(str(tmp_path / "in"), DAY, STATIONS, skip=(lacking,))
    warehouse = Warehouse(str(tmp_path / "out"))
    with pytest.raises(MissingRawObjects, match=f"20251102/{lacking}"):
        build(spark, warehouse, incoming, master, [DAY])
    assert not glob.glob(f"{warehouse.conditions}*") and not glob.glob(f"{warehouse.cleaned}*")


def test_failed_check_blocks_but_keeps_the_cleaned_table(spark, tmp_path, master):
    incoming = write_snapshot(str(tmp_path / "in"), DAY, STATIONS)
    path = f"{incoming}/20251102/max_gust.csv"
    text = open(path, "rb").read()
    with open(path, "ab") as file:
        file.write(text.split(b"\r\n")[1] + b"\r\n")
    warehouse = Warehouse(str(tmp_path / "out"))

    with pytest.raises(DataQualityError, match="valid_daily_weather_key") as caught:
        build(spark, warehouse, incoming, master, [DAY])

    assert [(f["source"], f["duplicate_key_count"]) for f in caught.value.failures] == [("max_gust", 1)]
    assert spark.read.parquet(warehouse.cleaned).where("source = 'max_gust'").count() == 4
    assert not glob.glob(f"{warehouse.pollen}*") and not glob.glob(f"{warehouse.conditions}*")


def test_station_without_pollen_blocks_publishing(spark, tmp_path, master):
    incoming = write_snapshot(str(tmp_path / "in"), DAY, STATIONS)
    only_one = write_snapshot(str(tmp_path / "other"), DAY, {"20711": "47519"})
    with open(f"{only_one}/20251102/pollen.json", "rb") as source, open(
        f"{incoming}/20251102/pollen.json", "wb"
    ) as target:
        target.write(source.read())
    warehouse = Warehouse(str(tmp_path / "out"))
    with pytest.raises(DataQualityError, match="do not match.*53026"):
        build(spark, warehouse, incoming, master, [DAY])
    assert not glob.glob(f"{warehouse.conditions}*")


def test_large_pollen_envelopes_are_not_landed(spark, incoming):
    files = file_payloads(spark, incoming)
    require_landable(files)
    with pytest.raises(ValueError, match="cannot be landed.*pollen"):
        require_landable(files, max_bytes=10)


@pytest.mark.parametrize("end", [b"", b"\n", b"\r\n", b"\r\n\r\n"])
def test_chunks_keep_every_byte(spark, tmp_path, end):
    folder = tmp_path / "in" / "20251102"
    folder.mkdir(parents=True)
    content = b"\r\n".join(b"%d,\x81\x41,\"a\nb\"" % i + b"x" * (i % 90) for i in range(3000)) + end
    (folder / "max_wind.csv").write_bytes(content)
    (folder / "max_gust.csv").write_bytes(b"small")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = chunk_rows(spark, [str(folder)], 100, chunk_bytes=5000)
        path = str(tmp_path / "chunks")
        sent = write_chunks(rows, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.object_key, r.size) for r in sent] == [("20251102/max_wind.csv", len(content))] and sent[0].chunks > 10
    stored = spark.read.parquet(f"{path}/chunks").orderBy("offset").collect()
    assert b"".join(bytes(r["content"]) for r in stored) == content
    lines = [bytes(r.raw) for r in chunk_lines(spark, path, F.lit(True)).orderBy("block_start", "seq").collect()]
    assert [x for x in lines if x] == [x for x in content.replace(b"\r", b"\n").split(b"\n") if x]

    # a chunk that is lost, and one that is changed
    whole = spark.createDataFrame(stored, spark.read.parquet(f"{path}/chunks").schema)
    keep = whole.columns
    for spoil in (whole.where(f"offset <> {stored[3].offset}"), whole.withColumn("content", F.expr(f"IF(offset = {stored[2].offset}, X'00', content)"))):
        spoil.select(*keep).write.mode("overwrite").partitionBy("snapshot_date", "filename").parquet(f"{path}/chunks")
        with pytest.raises(VerificationError, match="20251102/max_wind.csv"):
            verify_chunks(spark, path)


def test_a_build_with_objects_in_chunks_is_the_same(spark, tmp_path, both, incoming, master):
    warehouse = Warehouse(str(tmp_path / "out"))
    build(spark, warehouse, incoming, master, [DAY], max_bytes=250)
    assert published(spark, warehouse) == published(spark, both[0])[:2]
    assert spark.read.parquet(f"{warehouse.chunks}/manifest").count() == 5
    assert read_landing(spark, warehouse.landing).count() == 1


def test_duplicates_and_failures_are_reported_whole(spark):
    ids = [f"{i:03d}" for i in range(60)]
    rows = spark.createDataFrame([(i,) for i in ids], "station_id string")
    with pytest.raises(DataQualityError, match="60 in all") as caught:
        raise_if_any(rows, "station_id", "Bad")
    assert caught.value.total == 60 and caught.value.failures == ids[:20]


def test_a_lost_part_is_noticed(spark, tmp_path):
    """Two parts under one key: what is stored is compared with what was sent, part by part."""
    content = [b"first", b"second"]
    rows = spark.createDataFrame(
        [(f"{DAY:%Y%m%d}/pollen.json", None, "application/json", None, len(c), hashlib.sha256(c).hexdigest(), c, DAY, "pollen.json") for c in content],
        LANDING_SCHEMA,
    )
    stored = write_landing(rows, str(tmp_path / "landing"))
    assert stored.count() == 2
    lossy = write_landing.__globals__["read_landing"]
    write_landing.__globals__["read_landing"] = lambda *a: lossy(*a).where(f"sha256 = '{hashlib.sha256(b'first').hexdigest()}'")
    try:
        with pytest.raises(VerificationError, match="not landed whole"):
            write_landing(rows, str(tmp_path / "again"))
    finally:
        write_landing.__globals__["read_landing"] = lossy


def test_other_days_are_not_read(spark, tmp_path):
    for name in ("20251102", "20251103"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "pollen.json").write_bytes(b"{}")
    folders = day_folders(spark, str(tmp_path), [dt.date(2025, 11, 2), dt.date(2025, 11, 20)])
    assert folders == [f"{tmp_path}/20251102"]
    assert [str(r["snapshot_date"]) for r in landing_rows(spark, folders).select("snapshot_date").collect()] == ["2025-11-02"]
    with pytest.raises(MissingRawObjects):
        day_folders(spark, str(tmp_path), [dt.date(2025, 11, 20)])
