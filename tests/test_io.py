"""Sources and sinks."""

from __future__ import annotations

import json
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.conf import RuntimeConfig
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.streaming import DataStreamReader

from temblor import config
from temblor.config import JdbcTarget, KafkaTopic, session_conf, shared_dir
from temblor.plans import preprocess_quakes
from temblor.sinks import jdbc_batch_sink, kafka_query, write_jdbc, write_kafka, write_table
from temblor.sinks.batch import json_values
from temblor.sources import (
    flatten_geojson,
    read_geojson,
    read_geojson_features,
    read_quake_stream,
    read_quakes_csv,
    read_table,
    replay_slices,
    write_slices,
)
from tests.conftest import rows

TARGET = JdbcTarget("jdbc:postgresql://db:5432/quakes", user="u", password="p", max_connections=4)
TOPIC = KafkaTopic("k1:9092,k2:9092", "quakes", {"startingOffsets": "earliest"})


def _put(folder: str, name: str, text: str) -> str:
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = Path(folder, name)
    path.write_text(text)
    return str(path)


def test_csv_binds_by_position_and_keeps_rows_with_bad_fields(spark, folder):
    path = _put(
        folder,
        "raw.csv",
        "a,b,c,d,e,f,g,h,i,j,k,l\n"
        '631153353990,"12 km NNW of Meadow Lakes, Alaska",reviewed,0,96,earthquake,2.5, Alaska,'
        "-149.6692,61.7302,30.1,1990-01-01 00:22:33.990\n"
        "x,P,reviewed,1,y,earthquake,z,,,,,1990-01-01T00:22:33.990Z\n",
    )
    df = preprocess_quakes(read_quakes_csv(spark, path))
    assert df.columns == [
        "time", "place", "status", "tsunami", "significance", "magnitude", "state", "longitude",
        "latitude", "depth", "date",
    ]
    first, second = df.orderBy(F.col("time").desc_nulls_last()).collect()
    moment = datetime(1990, 1, 1, 0, 22, 33, 990_000)
    assert (first["place"], first["state"]) == ("12 km NNW of Meadow Lakes, Alaska", "ALASKA")
    assert (first["magnitude"], first["significance"], first["date"]) == (2.5, 96, moment)
    assert second[:1] + second[4:10] == (None,) * 7
    assert (second["tsunami"], second["date"]) == (1.0, moment)


def test_csv_with_a_given_timestamp_format(spark, folder):
    row = "1,P,s,0,1,e,1,S,1,1,1,31/12/1999 23:59"
    path = _put(folder, "raw.csv", f"h\n{row}\n")
    df = read_quakes_csv(spark, path, "dd/MM/yyyy HH:mm")
    assert df.first()["date"] == datetime(1999, 12, 31, 23, 59)


def test_table_is_replaced_as_a_whole(spark, folder):
    write_table(spark.range(5), "replaced_quakes", folder)
    write_table(spark.range(2).withColumn("year", F.lit(2000)), "replaced_quakes", folder, ["year"])
    table = read_table(spark, "replaced_quakes")
    assert table.columns == ["id", "year"] and table.count() == 2
    assert spark.catalog.listTables(pattern="replaced_quakes")[0].tableType == "EXTERNAL"
    write_table(spark.range(3), "managed_quakes")
    assert spark.sql("SELECT * FROM managed_quakes").count() == 3
    detail = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED managed_quakes").collect()}
    assert (detail["Type"], detail["Provider"]) == ("MANAGED", "parquet")


def _feature(coordinates, **properties):
    return {"type": "Feature", "geometry": {"coordinates": coordinates}, "properties": properties}


def test_geojson_is_flattened(spark, folder):
    document = {
        "type": "FeatureCollection",
        "metadata": {"count": 3},
        "features": [
            _feature([-122.8, 38.8, 2.1], place="A", mag=1.2, time=1516492800123, tsunami=0,
                     status="reviewed", rms=0.1),
            _feature([1.0, 2.0], place="B"),
            {"type": "Feature", "geometry": None, "properties": {"place": "C"}},
        ],
    }
    lines = [json.dumps(document), '{"features": []}', "{oops"]
    path = _put(folder, "lines.json", "\n".join(lines))
    flat = flatten_geojson(read_geojson(spark, path))
    assert flat.columns == [
        "longitude", "latitude", "depth", "location", "magnitude", "time", "tsunami", "status",
    ]
    assert rows(flat) == [
        (-122.8, 38.8, 2.1, "A", 1.2, 1516492800123, "0", "reviewed"),
        (1.0, 2.0, None, "B", None, None, None, None),
        (None, None, None, "C", None, None, None, None),
    ]
    whole = _put(shared_dir(spark, "test"), "pretty.json", json.dumps(document, indent=2))
    assert flatten_geojson(read_geojson(spark, whole, one_per_file=True)).count() == 3


def _collection(n: int) -> dict:
    places = ["plain", 'a "quoted" {"type":"Feature", one', "]}\n{", "Zürich"]
    return {
        "type": "FeatureCollection",
        "metadata": {"count": n},
        "features": [
            {"type": "Feature"} | _feature([k / 8, 2.0, None], place=places[k % 4], mag=k % 9 / 8, time=k, tsunami=0, status="x")
            for k in range(n)
        ],
        "bbox": [0, 1],
    }


@pytest.mark.parametrize("blanks", [(",", ":"), (", ", ": ")])
def test_one_large_document_is_read_by_many_tasks(spark, folder, blanks):
    path = _put(folder, "large.json", json.dumps(_collection(20_000), separators=blanks))
    opening = json.dumps({"type": "Feature"}, separators=blanks)[:-1] + blanks[0].rstrip()
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "256k"}):
        cut = read_geojson_features(spark, path, opening)
        assert cut.rdd.getNumPartitions() >= 8
        busy = cut.groupBy(F.spark_partition_id().alias("task")).count()
        assert busy.count() >= 8 and busy.agg(F.max("count")).first()[0] < 5_000
        whole = flatten_geojson(read_geojson(spark, path, one_per_file=True))
        assert cut.columns == whole.columns
        assert cut.exceptAll(whole).count() == whole.exceptAll(cut).count() == 0 and cut.count() == 20_000


def test_documents_that_break_off_or_open_differently(spark, folder):
    text = json.dumps(_collection(6), separators=(",", ":"))
    last = text.rindex('{"type":"Feature",')
    cases = {
        "whole": (text, 6), "twice": (text + "\n" + text, 12), "mark": ("\ufeff" + text, 6),
        "indented": (json.dumps(_collection(6), indent=1), 6), "empty": ("", 0), "none": ('{"features":[]}', 0),
        "in the head": (text[:30], 0), "in a text": (text[: last + 60], 5), "unclosed": (text[: text.rindex("}],")], 5),
        "at an opening": (text[: last + 18], 5), "within an opening": (text[: last + 9], 5),
    }
    for name, (content, n) in cases.items():
        path = _put(shared_dir(spark, "test"), "doc.json", content)
        assert (name, read_geojson_features(spark, path).count()) == (name, n)


def test_replay_slices_are_half_open_and_written_as_messages(spark, quakes, folder):
    df = quakes(
        dict(place="a", date="2018-01-21 00:00:00"),
        dict(place="b", date="2018-01-21 00:14:59.999"),
        dict(place="c", date="2018-01-21 00:15:00"),
        dict(place="d", date="2018-01-21 05:00:00"),
        dict(place="e", date="2018-01-20 23:59:59.999"),
        dict(place="f", date=None),
    )
    t0 = datetime(2018, 1, 21)
    sliced = replay_slices(df, 15, t0)
    assert rows(sliced.select("place", "slice_id")) == [("a", 0), ("b", 0), ("c", 1), ("d", 20)]
    wide = replay_slices(df, 300, t0).select("place", "slice_id")
    assert rows(wide) == [("a", 0), ("b", 0), ("c", 0), ("d", 1)]
    # By default counting starts with the hour of the first event, here 23:00.
    first = replay_slices(df).groupBy().agg(F.min("slice_id"), F.count("*")).first()
    assert tuple(first) == (3, 5)
    assert replay_slices(df.where("false")).count() == 0

    write_slices(sliced.select("place", "slice_id"), folder)
    back = spark.read.text(folder)
    assert rows(back.where("slice_id = 0").select("value")) == [
        ('{"place":"a"}',), ('{"place":"b"}',),
    ]


@pytest.fixture
def saved(monkeypatch):
    """Catches writes instead of sending them anywhere."""
    calls, state = [], {}
    for method in ("format", "mode"):
        def record(self, value, _method=method, _real=getattr(DataFrameWriter, method)):
            state[_method] = value
            return _real(self, value)

        monkeypatch.setattr(DataFrameWriter, method, record)
    real_options = DataFrameWriter.options

    def options(self, **values):
        state["options"] = values
        return real_options(self, **values)

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(
        DataFrameWriter, "save", lambda self: calls.append((dict(state), self._df))
    )
    return calls


def test_jdbc_writes(spark, saved):
    write_jdbc(spark.range(1), TARGET, "results")
    state, _ = saved[0]
    assert (state["format"], state["mode"]) == ("jdbc", "overwrite")
    assert state["options"] == {
        "url": "jdbc:postgresql://db:5432/quakes",
        "driver": "org.postgresql.Driver",
        "dbtable": "results",
        "numPartitions": "4",
        "batchsize": "10000",
        "user": "u",
        "password": "p",
    }
    jdbc_batch_sink(TARGET, "log")(spark.range(1), 7)
    state, df = saved[1]
    assert state["mode"] == "append" and state["options"]["dbtable"] == "log"
    assert rows(df) == [(0, 7)]
    assert "password" not in JdbcTarget("jdbc:x").options("t")


def test_kafka_messages_and_options(spark, saved, monkeypatch):
    df = spark.createDataFrame([(1.5, None)], "magnitude DOUBLE, depth DOUBLE")
    assert rows(json_values(df)) == [('{"magnitude":1.5,"depth":null}',)]
    write_kafka(df, TOPIC)
    state, out = saved[0]
    assert state["format"] == "kafka" and out.columns == ["value"]
    assert state["options"]["topic"] == "quakes"

    seen = {}

    def options(self, **values):
        seen.update(values)
        return self

    stream = spark.readStream.format("rate").load()
    assert kafka_query(stream, TOPIC) is not None
    monkeypatch.setattr(DataStreamReader, "options", options)
    monkeypatch.setattr(DataStreamReader, "load", lambda self: "loaded")
    assert read_quake_stream(spark, TOPIC, max_offsets=1000) == "loaded"
    assert seen == {
        "kafka.bootstrap.servers": "k1:9092,k2:9092",
        "subscribe": "quakes",
        "startingOffsets": "earliest",
    }


def test_session_settings_are_put_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with session_conf(spark, config.STREAM_DEFAULTS):
        assert spark.conf.get(key) == config.ROCKSDB_STATE
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.no.such", None) is None
    with session_conf(spark, {"spark.no.such": "1"}):
        pass
    assert spark.conf.get("spark.no.such", None) is None


def test_shared_dir_follows_the_cluster_setting(spark, monkeypatch):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    settings = {"spark.checkpoint.dir": "s3a://bucket/scratch/"}
    monkeypatch.setattr(RuntimeConfig, "get", lambda self, key, default=None: settings.get(key))
    assert shared_dir(spark, "x").startswith("s3a://bucket/scratch/x-")
    settings.clear()
    assert shared_dir(spark, "x").startswith(tempfile.gettempdir())
    monkeypatch.setattr(spark.sparkContext, "master", "spark://master:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(spark, "x")
