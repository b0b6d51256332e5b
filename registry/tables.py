"""Event tables derived from the driver's `events` table, for Spark and (as SQL) for DuckDB.

Integer and dyadic arithmetic only, so both engines hold identical values and float sums do not
depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


PARTS = 6


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned-table columns, over the whole `events` table."""
    return _quakes(spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the raw file: state untrimmed, magnitude misspelt, date as text."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    q = _quakes(events)
    return q.select(
        F.unix_millis(q["date"].cast("timestamp")).alias("time"),
        "place",
        F.col("event_type").alias("status"),
        "tsunami",
        "significance",
        F.lit("earthquake").alias("data_type"),
        F.col("magnitude").alias("magnitudo"),
        F.col("raw_state").alias("state"),
        "longitude",
        "latitude",
        "depth",
        "date",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON document per event: the event itself, and its epicentre without a depth."""
    q = _quakes(spark.read.parquet(f"{sf_dir}/events.parquet"))
    properties = F.struct(
        F.col("place"),
        F.col("magnitude").alias("mag"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.col("tsunami"),
        F.col("event_type").alias("status"),
    )

    def feature(*coordinates: str) -> Column:
        return F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.array(*coordinates).alias("coordinates")).alias("geometry"),
            properties.alias("properties"),
        )

    body = F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.array(
            feature("longitude", "latitude", "depth"),
            feature("longitude", "latitude", F.lit(None).cast("double")),
        ).alias("features"),
    )
    return q.select(F.to_json(body).alias("document"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a stream of JSON messages in a `value` column, its `ts` as event time."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # A pattern, because a file stream takes a folder or a pattern and the table may be one file.
    return _messages(spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a bounded table."""
    return _messages(spark.read.parquet(f"{sf_dir}/events.parquet"))


def replay_delay(spark: SparkSession, sf_dir: str) -> str:
    """A watermark delay longer than the table's whole time span.

    The files of a table are replayed in no particular order; with this no row comes too late.
    """
    ts = F.col("ts").cast("timestamp")
    span = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .agg((F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))).alias("span"))
        .first()["span"]
    )
    return f"{(span or 0) + 3600} seconds"


def replay_span(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last `ts` in milliseconds."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    row = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.min(ms), F.max(ms)).first()
    return (0, 0) if row[0] is None else (row[0], row[1])


def part_delay(spark: SparkSession, sf_dir: str) -> str:
    """A watermark delay of one of the spans that `write_in_order` cuts, and an hour."""
    low, high = replay_span(spark, sf_dir)
    return f"{(high - low) // 1000 // PARTS + 3600} seconds"


def write_in_order(spark: SparkSession, sf_dir: str, path: str, late: bool) -> None:
    """All messages as text files in order of time: one write for each of PARTS equal spans.

    With `late`, a tenth of the first span's messages are written last.
    """
    low, high = replay_span(spark, sf_dir)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    part = F.floor((ms - low) * PARTS / (high - low + 1))
    if late:
        part = F.when((part == 0) & (F.col("event_id") % 10 == 0), PARTS).otherwise(part)
    events = _quakes(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn("part", part)
    for k in range(PARTS + late):
        messages = events.where(F.col("part") == k).select(F.to_json(F.struct(*_fields())).alias("value"))
        messages.write.mode("append").text(path)


def write_near_messages(spark: SparkSession, sf_dir: str, path: str, parts: range) -> None:
    """Messages whose location is shared by eight events each, dealt out to PARTS writes by event.

    Each write is one file, whatever the number of scan tasks: a stream that reads a file a batch
    then has PARTS batches at any size, and each batch grows with the input instead of their number.
    """
    events = _quakes(spark.read.parquet(f"{sf_dir}/events.parquet"))
    near = events.withColumn("place", F.expr("concat('AREA_', CAST(event_id DIV 8 AS STRING))"))
    for k in parts:
        part = near.where(F.col("event_id") % PARTS == k)
        messages = part.select(F.to_json(F.struct(*_fields())).alias("value"))
        messages.repartition(1).write.mode("append").text(path)


def quakes_by_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned-table columns with a stored column as `date`: limits on it reach the scan."""
    return quakes(spark, sf_dir).withColumn("date", F.col("ts"))


def float_quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as FLOAT in steps of 0.05: differences of 0.1 lie on both sides of it."""
    return quakes(spark, sf_dir).selectExpr(
        "event_id",
        "date",
        "CAST(floor(latitude) + (event_id % 5) * 0.05D AS FLOAT) AS latitude",
        "CAST(floor(longitude) + (event_id % 3) * 0.05D AS FLOAT) AS longitude",
    )


def _quakes(events: DataFrame) -> DataFrame:
    sites = events.selectExpr(
        "event_id",
        "ts",
        "event_type",
        "user_id * 17 % 40 AS site",
        "CASE WHEN user_id % 23 <> 0 THEN"
        " concat(' ', event_type, '_', CAST(user_id % 10 AS STRING), ' ') END AS raw_state",
    )
    return sites.selectExpr(
        "ts + make_dt_interval(CAST(site % 6 * 150 AS INT)) AS date",
        "concat('SITE_', CAST(site AS STRING)) AS place",
        "upper(trim(raw_state)) AS state",
        "CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS tsunami",
        "CAST(event_id % 1000 AS INT) AS significance",
        "CASE WHEN event_id % 97 <> 0 THEN CAST(event_id * 37 % 73 AS DOUBLE) / 8 END AS magnitude",
        "CAST(site * 4 - 80 AS DOUBLE) + CAST(event_id % 5 AS DOUBLE) / 16 AS latitude",
        "CAST(site * 9 - 180 AS DOUBLE) + CAST(event_id % 3 AS DOUBLE) / 16 AS longitude",
        "CASE WHEN event_id % 89 <> 0 THEN CAST(event_id % 700 AS DOUBLE) END AS depth",
        "event_id",
        "ts",
        "event_type",
        "raw_state",
    )


def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of the messages, not yet encoded, and the event's `moment`."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return _quakes(events).select(*_fields(), F.col("ts").alias("moment"))


def _messages(events: DataFrame) -> DataFrame:
    return _quakes(events).select(F.to_json(F.struct(*_fields())).alias("value"))


def _fields() -> list[Column]:
    return [
        F.col("longitude"),
        F.col("latitude"),
        F.col("depth"),
        F.col("place").alias("location"),
        F.col("magnitude"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.col("tsunami"),
        F.col("event_type").alias("status"),
    ]


QUAKES_SQL = """
sites as (select *, (user_id * 17) % 40 as p from events),
quakes as (
  select
    ts + to_days(cast(p % 6 * 150 as int)) as date,
    concat('SITE_', cast(p as varchar)) as place,
    case when user_id % 23 <> 0 then
      upper(trim(concat(' ', event_type, '_', cast(user_id % 10 as varchar), ' '))) end as state,
    case when event_id % 11 = 0 then 1 else 0 end as tsunami,
    cast(event_id % 1000 as int) as significance,
    case when event_id % 97 <> 0 then cast((event_id * 37) % 73 as double) / 8 end as magnitude,
    cast(p * 4 - 80 as double) + cast(event_id % 5 as double) / 16 as latitude,
    cast(p * 9 - 180 as double) + cast(event_id % 3 as double) / 16 as longitude,
    case when event_id % 89 <> 0 then cast(event_id % 700 as double) end as depth,
    event_id, ts, event_type
  from sites
),
float_quakes as (
  select event_id, date, cast(floor(latitude) + (event_id % 5) * 0.05::double as float) as latitude,
    cast(floor(longitude) + (event_id % 3) * 0.05::double as float) as longitude
  from quakes
),
near_messages as (
  select concat('AREA_', cast(event_id // 8 as varchar)) as location, magnitude, date_trunc('milliseconds', ts) as time
  from quakes
),
messages as (
  select longitude, latitude, depth, place as location, magnitude,
    date_trunc('milliseconds', ts) as time, cast(tsunami as varchar) as tsunami,
    event_type as status
  from quakes
)
"""
