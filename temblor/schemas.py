"""Fixed input schemas, as Spark DDL. Nothing is inferred on either path."""

from __future__ import annotations

# Column names, order and types of the raw CSV file.
RAW_CSV = (
    "time BIGINT, place STRING, status STRING, tsunami FLOAT, significance INT, "
    "data_type STRING, magnitudo FLOAT, state STRING, longitude FLOAT, latitude FLOAT, "
    "depth FLOAT, date TIMESTAMP"
)

# Fields of one stream message. `time` is epoch milliseconds on the wire.
MESSAGE = (
    "longitude DOUBLE, latitude DOUBLE, depth DOUBLE, location STRING, magnitude DOUBLE, "
    "time BIGINT, tsunami STRING, status STRING"
)

# The part of a GeoJSON FeatureCollection that is read.
GEOJSON = (
    "features ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<DOUBLE>>, "
    "properties: STRUCT<place: STRING, mag: DOUBLE, time: BIGINT, tsunami: STRING, "
    "status: STRING>>>"
)
