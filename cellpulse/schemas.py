"""Column names and schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# The header of a daily activity file, in its usual order.
RAW_COLUMNS = (
    "datetime",
    "CellID",
    "countrycode",
    "smsin",
    "smsout",
    "callin",
    "callout",
    "internet",
)

# Raw name -> working name.
RENAMES = {
    "datetime": "timestamp",
    "CellID": "grid_id",
    "countrycode": "country_code",
    "smsin": "sms_in",
    "smsout": "sms_out",
    "callin": "call_in",
    "callout": "call_out",
    "internet": "internet_activity",
}

RAW_MEASURES = RAW_COLUMNS[3:]
MEASURES = tuple(RENAMES[name] for name in RAW_MEASURES)

# `country_code` may be absent: the hourly tables do not need it.
REQUIRED_COLUMNS = ("timestamp", "grid_id", *MEASURES)

SOURCE_COLUMN = "_source_file"

# The columns of the hourly table, in order.
HOURLY_COLUMNS = (
    "timestamp",
    "grid_id",
    *MEASURES,
    "total_sms",
    "total_calls",
    "total_activity",
    "internet_share",
    "date",
)


def text_schema(names) -> T.StructType:
    """All-string, nullable schema: values are parsed by us, never inferred."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_SCHEMA = text_schema(RAW_COLUMNS)

# A geometry that covers an area: its kind, and polygons of rings of points.
AREA_TYPE = "struct<type: string, coordinates: array<array<array<array<double>>>>>"

# How deep the coordinates are nested depends on the kind, so a geometry is read as text first.
FEATURE_COLLECTION = (
    "type string, features array<struct<type: string, properties: struct<cellId: string>, geometry: string>>"
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
