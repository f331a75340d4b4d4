"""Fixed vocabulary of the station records and the table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES -- must equal the published station-file conventions for the
# results to be right. Kept together, in natural order.
# ---------------------------------------------------------------------------

# Raw measurement code -> semantic column name.
MEASUREMENT_NAMES: dict[str, str] = {
    "WDIR": "wind_direction",
    "WSPD": "wind_speed",
    "GST": "gust",
    "WVHT": "significant_wave_height",
    "DPD": "dominant_wave_period",
    "APD": "average_wave_period",
    "MWD": "mean_wave_direction",
    "PRES": "pressure",
    "ATMP": "air_temperature",
    "WTMP": "sea_surface_temperature",
    "DEWP": "dew_point_temperature",
    "VIS": "visibility",
    "PTDY": "pressure_tendency",
    "TIDE": "tide",
}

# Missing-value marker per semantic column (never a blanket replace).
SENTINELS: dict[str, tuple[float, ...]] = {
    "wind_direction": (999.0,),
    "wind_speed": (99.0,),
    "gust": (99.0,),
    "significant_wave_height": (99.0,),
    "dominant_wave_period": (99.0,),
    "average_wave_period": (99.0,),
    "mean_wave_direction": (999.0,),
    "pressure": (9999.0,),
    "air_temperature": (999.0,),
    "sea_surface_temperature": (999.0,),
    "dew_point_temperature": (999.0,),
    "visibility": (99.0,),
    "pressure_tendency": (99.0,),
    "tide": (99.0,),
}

# Year header spellings, in priority order.
YEAR_HEADERS: tuple[str, ...] = ("#YY", "YYYY", "YY")

# Two-digit years below this pivot are 20xx, the rest 19xx.
YEAR_PIVOT = 50

# Health thresholds (hours); the tests are strictly greater-than.
MAX_AGE_HOURS = 36.0
STALE_RUN_HOURS = 12.0

# Error text kept in the run log.
ERROR_CLIP_CHARS = 4000

# Run states.
RUN_STATUSES: tuple[str, ...] = ("running", "ok", "failed")

# Pipeline stages watched by the health report.
STAGES: tuple[str, ...] = ("scrape", "silver")

# Tokens the whitespace decoder reads as missing (pandas' default NA set).
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Station file name and link shapes.
FILENAME_YEAR_PATTERN = r"h(\d{4})\.txt"
FILENAME_SUFFIX_PATTERN = r"\.txt\.gz$"
COORDINATE_PATTERN = r"(\d+\.\d+)\s*([NSEW])"
DOWNLOAD_PATH_TOKEN = "download_data"
TEXT_VIEW_PATH_TOKEN = "view_text_file"
STATION_PAGE_URL = "https://www.ndbc.noaa.gov/station_page.php?station="
# Bold items of the station metadata paragraph tried for a position, in order.
POSITION_ITEM_ORDER: tuple[int, ...] = (4, 3, 2, 5)
# ---------------------------------------------------------------------------

# Structural header names and the bronze column each one lands in. Bronze
# keeps every token as text; ``MM`` (month) and ``mm`` (minute) differ only in
# case, so they get distinct column names here.
STRUCTURAL_COLUMNS: dict[str, str] = {
    "#YY": "yy_hash",
    "YYYY": "yyyy",
    "YY": "yy",
    "MM": "month_raw",
    "DD": "day_raw",
    "hh": "hour_raw",
    "mm": "minute_raw",
}

OBSERVATION_COLUMNS: list[str] = ["buoy_id", "datetime", *MEASUREMENT_NAMES.values()]
COORDINATE_COLUMNS: list[str] = ["buoy_id", "latitude", "longitude"]

BRONZE_VALUE_COLUMNS: list[str] = [*STRUCTURAL_COLUMNS.values(), *MEASUREMENT_NAMES.keys()]

# Bronze observations: one row per line of a landed file (header = line 0).
# ``year`` and ``batch`` are directory keys; the rest are data columns.
BRONZE_OBSERVATIONS = T.StructType(
    [
        T.StructField("buoy_id", T.StringType()),
        T.StructField("source_stem", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in BRONZE_VALUE_COLUMNS],
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
        T.StructField("decode_error", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

BRONZE_COORDINATES = T.StructType(
    [
        T.StructField("buoy_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

SILVER_OBSERVATIONS = T.StructType(
    [
        T.StructField("buoy_id", T.StringType(), False),
        T.StructField("datetime", T.TimestampNTZType(), False),
        *[T.StructField(c, T.DoubleType()) for c in MEASUREMENT_NAMES.values()],
    ]
)

SILVER_COORDINATES = T.StructType(
    [
        T.StructField("buoy_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("bronze_fingerprint", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_flagged", T.LongType()),
        T.StructField("max_datetime", T.TimestampNTZType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("path", T.StringType()),
        T.StructField("run_token", T.StringType()),
        T.StructField("dataset", T.StringType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_token", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("years_loaded", T.IntegerType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("stats", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)
