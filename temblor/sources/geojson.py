"""GeoJSON FeatureCollections as flat event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from temblor.schemas import GEOJSON

# Fixed value: how a feature begins in documents written without blanks.
FEATURE_OPENING = '{"type":"Feature",'


def read_geojson(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Documents in column `document`, one per line or one per file."""
    return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "document")


def read_geojson_features(spark: SparkSession, path: str, opening: str = FEATURE_OPENING) -> DataFrame:
    """The rows of `flatten_geojson` out of documents of any size, which many tasks share.

    Spark cuts the files into ranges, and a task reads on from its range to the next feature's
    `opening`: the text from its brace to the comma after its type, with the blanks the writer uses. In
    valid JSON it stands nowhere else, as quotes within a text are escaped, but in a Feature within
    the properties of another; such documents are for `read_geojson`.

    Nothing is lost if the opening is not met, only the cut: what precedes the first one is read as
    a document of its own, for which it has to be complete. A feature that breaks off gives no row.
    """
    # After an opening come the feature's other fields; before the first one, a document begins.
    body = F.regexp_replace("value", r"^[\s\uFEFF]+", "")
    pieces = spark.read.text(path, lineSep=opening).select(
        F.when(body.startswith("{"), body).alias("document"),
        F.when(~body.startswith("{"), F.concat(F.lit(opening), body)).alias("feature"),
    )
    cut = F.from_json("feature", _CHECKED_FEATURE, {"columnNameOfCorruptRecord": "broken"})
    parsed = pieces.select(F.from_json("document", GEOJSON)["features"].alias("features"), cut.alias("cut"))
    single = F.when(F.col("cut.broken").isNull(), F.array(F.struct("cut.geometry", "cut.properties")))
    features = F.when(F.col("cut").isNull(), F.col("features")).otherwise(single)
    return parsed.select(F.inline(F.transform(features, _message)))


def flatten_geojson(df: DataFrame) -> DataFrame:
    """One row per feature of the FeatureCollections in column `document`.

    The rows have the fields of a stream message, `time` in epoch milliseconds. A coordinate
    that is missing is NULL. A document without features gives no row.
    """
    features = F.from_json("document", GEOJSON)["features"]
    return df.select(F.inline(F.transform(features, _message)))


_FEATURE = GEOJSON.removeprefix("features ARRAY<").removesuffix(">")
_CHECKED_FEATURE = f"{_FEATURE.removesuffix('>')}, broken: STRING>"


def _message(feature: Column) -> Column:
    coordinates = feature["geometry"]["coordinates"]
    properties = feature["properties"]
    return F.struct(
        F.get(coordinates, F.lit(0)).alias("longitude"),
        F.get(coordinates, F.lit(1)).alias("latitude"),
        F.get(coordinates, F.lit(2)).alias("depth"),
        properties["place"].alias("location"),
        properties["mag"].alias("magnitude"),
        properties["time"].alias("time"),
        properties["tsunami"].alias("tsunami"),
        properties["status"].alias("status"),
    )
