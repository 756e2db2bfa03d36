"""Reader of hourly weather JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citytrips import schemas
from citytrips.sources.columns import conform
from citytrips.sources.months import validate_months
from citytrips.sources.report import Entry
from citytrips.sources.tables import exists

WEATHER_FILE = "weather_{year}-{month:02d}.json"

# Raw column → name of the array in the payload.
PAYLOAD_FIELDS = {
    "timestamp": "time",
    "temp": "temperature_2m",
    "feels_like": "apparent_temperature",
    "humidity": "relative_humidity_2m",
    "dew_point": "dew_point_2m",
    "precipitation": "precipitation",
    "rain": "rain",
    "snowfall": "snowfall",
    "cloud_cover": "cloud_cover",
    "pressure": "pressure_msl",
    "wind_speed": "wind_speed_10m",
    "wind_direction": "wind_direction_10m",
}
_ARRAYS = ", ".join(
    f"{name}: array<{'string' if name == 'time' else 'double'}>"
    for name in PAYLOAD_FIELDS.values()
)
PAYLOAD_SCHEMA = f"hourly struct<{_ARRAYS}>"


def parse_payload(text: DataFrame, column: str = "value") -> DataFrame:
    """JSON documents → one row per hour; documents without hours give none."""
    hourly = F.from_json(column, PAYLOAD_SCHEMA)["hourly"]
    zipped = F.arrays_zip(*[F.col("h")[n].alias(n) for n in PAYLOAD_FIELDS.values()])
    rows = (
        text.select(hourly.alias("h"))
        .filter(F.size(F.col("h")["time"]) > 0)
        .select(F.inline(zipped))
    )
    return rows.select(*[F.col(old).alias(new) for new, old in PAYLOAD_FIELDS.items()])


def load_weather(spark: SparkSession, root: str, year: int,
                 months: Sequence[int]) -> tuple[DataFrame | None, list[Entry]]:
    """Weather months; a file without ``hourly`` or with an empty ``time`` fails its month."""
    names = {m: WEATHER_FILE.format(year=year, month=m) for m in validate_months(months)}
    paths = {m: f"{root.rstrip('/')}/{name}" for m, name in names.items()}
    problems = {m: "PATH_NOT_FOUND" for m, path in paths.items() if not exists(spark, path)}
    landed = {m: path for m, path in paths.items() if m not in problems}
    if landed:
        # one pass tells which documents hold hours; a row per file reaches the driver
        text = spark.read.option("wholetext", "true").text(list(landed.values()))
        hours = F.size(F.from_json("value", PAYLOAD_SCHEMA)["hourly"]["time"])
        files = text.select(F.input_file_name().alias("file"), hours.alias("hours")).filter("hours > 0")
        full = [row["file"] for row in files.select("file").distinct().collect()]
        problems |= {m: "no hourly data" for m in landed if not any(f"/{names[m]}" in f for f in full)}
    good = [path for m, path in landed.items() if m not in problems]
    entries = [Entry(year, m, "hourly_weather", "failed" if m in problems else "success", problems.get(m))
               for m in paths]
    if not good:
        return None, entries
    text = spark.read.option("wholetext", "true").text(good)
    return conform(parse_payload(text), schemas.RAW_WEATHER), entries


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly rows of one JSON file, or of all files in a folder."""
    text = spark.read.option("wholetext", "true").text(path)
    return conform(parse_payload(text), schemas.RAW_WEATHER)
