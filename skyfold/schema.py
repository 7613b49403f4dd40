"""Types and fixed values of the observation format."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: results depend on these exact names, offsets and numbers ---

# Header of a yearly observation file, in file order.
RAW_HEADER = [
    "ID",
    "DATE",
    "ELEMENT",
    "DATA_VALUE",
    "M_FLAG",
    "Q_FLAG",
    "S_FLAG",
    "OBS_TIME",
]

# Header name -> stored name.
STORED_NAME = {
    "ID": "id",
    "DATE": "date",
    "ELEMENT": "meteorological_element",
    "DATA_VALUE": "data_value",
    "M_FLAG": "flag_m",
    "Q_FLAG": "flag_q",
    "S_FLAG": "flag_s",
    "OBS_TIME": "observation_time",
}

# Fixed-width files: column -> [start, end), counted from 0.
STATION_OFFSETS = {
    "id": (0, 11),
    "latitude": (12, 20),
    "longitude": (21, 30),
    "elevation": (31, 37),
    "state": (38, 40),
    "name": (41, 71),
    "gsn_flag": (72, 75),
    "hcn_crn_flag": (76, 79),
    "wmo_id": (80, 85),
}
COUNTRY_OFFSETS = {"code": (0, 2), "name": (3, 50)}

# Element code -> column of the wide view.
ELEMENT_COLUMN = {
    "TMAX": "temp_max",
    "TMIN": "temp_min",
    "TAVG": "temp_avg",
    "PRCP": "precipitation",
}

DATE_FORMAT = "yyyyMMdd"
TENTHS_PER_UNIT = 10
RAIN_THRESHOLD = 1  # a row counts as rain when strictly above this many units
MAX_DAYS_PER_MONTH = 31
SAMPLE_ROWS = 500
RUN_ID_FORMAT = "%Y%m%d-%H%M%S"

# --- End of fixed values ---

NUMERIC = T.DecimalType(38, 9)

_RAW_TYPE = {
    "DATE": T.DateType(),
    "DATA_VALUE": T.IntegerType(),
    "OBS_TIME": T.IntegerType(),
}

# Read schema of a yearly file: stored names in file order, bound by position.
CSV_SCHEMA = T.StructType(
    [T.StructField(STORED_NAME[h], _RAW_TYPE.get(h, T.StringType())) for h in RAW_HEADER]
)

# The same under the header names, which Spark compares with the header of every part.
HEADER_SCHEMA = T.StructType([T.StructField(h, _RAW_TYPE.get(h, T.StringType())) for h in RAW_HEADER])

# Stored order: the parsed date comes last.
OBSERVATION_COLUMNS = [f.name for f in CSV_SCHEMA if f.name != "date"] + ["date"]
OBSERVATION_SCHEMA = T.StructType([CSV_SCHEMA[c] for c in OBSERVATION_COLUMNS])

# Text columns in which a blank field is stored as '' rather than NULL.
BLANK_TEXT_COLUMNS = ["meteorological_element", "flag_m", "flag_q", "flag_s"]

_MEASURED = {"latitude", "longitude", "elevation"}
STATION_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in _MEASURED else T.StringType())
        for c in STATION_OFFSETS
    ]
)
COUNTRY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COUNTRY_OFFSETS])
