"""Declared schemas and the fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Time zone, text encodings, object names and header texts of the raw files.
JAPAN_TIME = "Asia/Tokyo"
MEASUREMENT_CHARSET = "Shift_JIS"
STATION_MASTER_CHARSET = "windows-31j"
POLLEN_FILE = "pollen.json"
STATION_ID_HEADER = "観測所番号"
WMO_ID_HEADER = "国際地点番号"
TIME_HEADERS = {
    "year": "現在時刻(年)",
    "month": "現在時刻(月)",
    "day": "現在時刻(日)",
    "hour": "現在時刻(時)",
    "minute": "現在時刻(分)",
}
STATION_MASTER_HEADERS = {
    "station_id": "観測所番号",
    "station_name": "観測所名",
    "latitude_degrees": "緯度(度)",
    "latitude_minutes": "緯度(分)",
    "longitude_degrees": "経度(度)",
    "longitude_minutes": "経度(分)",
}

# Where each raw file is published by the weather service.
SOURCE_URLS = {
    "precipitation.csv": "https://www.data.jma.go.jp/stats/data/mdrr/pre_rct/alltable/predaily00_rct.csv",
    "max_temperature.csv": "https://www.data.jma.go.jp/stats/data/mdrr/tem_rct/alltable/mxtemsadext00_rct.csv",
    "min_temperature.csv": "https://www.data.jma.go.jp/stats/data/mdrr/tem_rct/alltable/mntemsadext00_rct.csv",
    "max_wind.csv": "https://www.data.jma.go.jp/stats/data/mdrr/wind_rct/alltable/mxwsp00_rct.csv",
    "max_gust.csv": "https://www.data.jma.go.jp/stats/data/mdrr/wind_rct/alltable/gust00_rct.csv",
}

# Pollen type codes with their output columns, and plant codes.
POLLEN_COLUMNS = {"GRASS": "grass_info", "TREE": "tree_info", "WEED": "weed_info"}
PLANT_CODES = (
    "ALDER",
    "ASH",
    "BIRCH",
    "COTTONWOOD",
    "ELM",
    "MAPLE",
    "OLIVE",
    "JUNIPER",
    "OAK",
    "PINE",
    "CYPRESS_PINE",
    "HAZEL",
    "GRAMINALES",
    "RAGWEED",
    "MUGWORT",
)
POLLEN_INDEX_RANGE = (0, 5)


@dataclass(frozen=True)
class Measure:
    """One measurement column: the header it is read from, its name and type.

    Headers carry the day of the month, so ``header`` is a regular expression that
    has to match a whole header.
    """

    header: str
    name: str
    type: T.DataType


@dataclass(frozen=True)
class Measurement:
    """One raw measurement file and the columns taken from it."""

    name: str
    measures: tuple[Measure, ...]

    @property
    def filename(self) -> str:
        return f"{self.name}.csv"

    @property
    def value(self) -> str:
        return self.measures[0].name


DOUBLE, LONG, STRING = T.DoubleType(), T.LongType(), T.StringType()


def _wind(name: str) -> Measurement:
    # Header patterns shared by the two wind files.
    return Measurement(
        name,
        (
            Measure(r"\d{1,2}日の最大値\(m/s\)", f"{name}_speed_ms", DOUBLE),
            Measure(r"\d{1,2}日の最大値の品質情報", f"{name}_quality", LONG),
            Measure(r"\d{1,2}日の最大値観測時の風向", f"{name}_direction", STRING),
            Measure(r"\d{1,2}日の最大値観測時の風向の品質情報", f"{name}_direction_quality", LONG),
        ),
    )


# Header patterns of the measurement files.
MEASUREMENTS = (
    Measurement(
        "precipitation",
        (
            Measure(r"\d{1,2}日の値\(mm\)", "precipitation_mm", DOUBLE),
            Measure(r"\d{1,2}日の値の品質情報", "precipitation_quality", LONG),
        ),
    ),
    Measurement(
        "max_temperature",
        (
            Measure(r"\d{1,2}日の最高気温\(℃\)", "max_temperature_c", DOUBLE),
            Measure(r"\d{1,2}日の最高気温の品質情報", "max_temperature_quality", LONG),
        ),
    ),
    Measurement(
        "min_temperature",
        (
            Measure(r"\d{1,2}日の最低気温\(℃\)", "min_temperature_c", DOUBLE),
            Measure(r"\d{1,2}日の最低気温の品質情報", "min_temperature_quality", LONG),
        ),
    ),
    _wind("max_wind"),
    _wind("max_gust"),
)
MEASUREMENT_BY_NAME = {m.name: m for m in MEASUREMENTS}
MEASUREMENT_FILES = tuple(m.filename for m in MEASUREMENTS)
RAW_FILENAMES = (*MEASUREMENT_FILES, POLLEN_FILE)

COMMON_FIELDS = (
    T.StructField("station_id", STRING),
    T.StructField("wmo_station_id", STRING),
    T.StructField("date", T.DateType()),
    T.StructField("observed_at", T.TimestampType()),
)
MEASURE_FIELDS = tuple(
    T.StructField(measure.name, measure.type) for m in MEASUREMENTS for measure in m.measures
)
MEASURE_COLUMNS = tuple(f.name for f in MEASURE_FIELDS)

# In the long table all measurements share these columns; a measurement fills the first of them.
SLOTS = {"value": DOUBLE, "quality": LONG, "direction": STRING, "direction_quality": LONG}
LONG_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("source", STRING),
        *COMMON_FIELDS,
        *(T.StructField(name, dtype) for name, dtype in SLOTS.items()),
        T.StructField("observed_text", STRING),
    ]
)

CLEANED_SCHEMAS = {
    m.name: T.StructType(
        [*COMMON_FIELDS, *(T.StructField(measure.name, measure.type) for measure in m.measures)]
    )
    for m in MEASUREMENTS
}
DAILY_WEATHER_SCHEMA = T.StructType([*COMMON_FIELDS, *MEASURE_FIELDS])

PLANT_TYPE = T.StructType([T.StructField("code", STRING), T.StructField("value", LONG)])
POLLEN_INFO_TYPE = T.StructType(
    [T.StructField("value", LONG), T.StructField("plants", T.ArrayType(PLANT_TYPE))]
)
POLLEN_FIELDS = tuple(T.StructField(name, POLLEN_INFO_TYPE) for name in POLLEN_COLUMNS.values())
POLLEN_SCHEMA = T.StructType(
    [T.StructField("station_id", STRING), T.StructField("date", T.DateType()), *POLLEN_FIELDS]
)

STATION_SCHEMA = T.StructType(
    [
        T.StructField("station_id", STRING),
        T.StructField("wmo_station_id", STRING),
        T.StructField("station_name", STRING),
        T.StructField("latitude", DOUBLE),
        T.StructField("longitude", DOUBLE),
    ]
)
CONDITIONS_SCHEMA = T.StructType(
    [
        T.StructField("station_id", STRING),
        T.StructField("date", T.DateType()),
        T.StructField("observed_at", T.TimestampType()),
        T.StructField("station_name", STRING),
        T.StructField("latitude", DOUBLE),
        T.StructField("longitude", DOUBLE),
        *MEASURE_FIELDS,
        *POLLEN_FIELDS,
    ]
)

LANDING_SCHEMA = T.StructType(
    [
        T.StructField("object_key", STRING),
        T.StructField("source_url", STRING),
        T.StructField("content_type", STRING),
        T.StructField("downloaded_at", T.TimestampType()),
        T.StructField("size", LONG),
        T.StructField("sha256", STRING),
        T.StructField("content", T.BinaryType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("filename", STRING),
    ]
)

# The parts of a pollen response that are read; other members of the document are ignored.
POLLEN_RESPONSE_DDL = (
    "struct<dailyInfo: array<struct<"
    "date: struct<year: int, month: int, day: int>, "
    "pollenTypeInfo: array<struct<code: string, indexInfo: struct<value: bigint>>>, "
    "plantInfo: array<struct<code: string, indexInfo: struct<value: bigint>, "
    "plantDescription: struct<type: string>>>>>>"
)
POLLEN_RESULT_DDL = f"struct<station_id: string, response: {POLLEN_RESPONSE_DDL}>"
POLLEN_ENVELOPE_DDL = f"struct<results: array<{POLLEN_RESULT_DDL}>>"
