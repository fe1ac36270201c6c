"""Sources and sinks: files, generators, database, injected stores, topic options."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.sinks import files as file_sinks
from rivulet.sinks import stores
from rivulet.sources import files, streams
from rivulet.streaming import run

# Nine readings of three sensors, one per second.
IDS = ["sensor_1"] * 4 + ["sensor_2", "sensor_3", "sensor_2", "sensor_2", "sensor_3"]
SENSORS = [(k, 1549044122 + i, 10 * (i + 1)) for i, k in enumerate(IDS)]


def lines_of(folder):
    parts = sorted(pathlib.Path(folder).glob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]


def test_delimited_sinks(spark, tmp_path):
    df = files.from_elements(spark, SENSORS, schemas.SENSOR).coalesce(1)
    one = str(tmp_path / "one")
    file_sinks.write_delimited(df.where("id = 'sensor_1'"), one, "|")
    assert lines_of(one) == [f"sensor_1|{1549044122 + i}|{10 * (i + 1)}" for i in range(4)]
    every = str(tmp_path / "all")
    file_sinks.write_delimited(df.select("id", "vc", "ts"), every, "-")
    assert lines_of(every) == [f"{k}-{vc}-{ts}" for k, ts, vc in SENSORS]
    back = files.delimited_table(spark, every, "id string, v int, t long", "-", name="back")
    assert spark.table("back").where("id = 'sensor_2'").count() == 3 and back.count() == 9


def test_insert_goes_by_position(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql(f"create table target (a string, b long) using csv location '{path}'")
    df = spark.createDataFrame([("x", 1)], "name string, n long")
    file_sinks.insert_into(df, "target")
    assert [tuple(r) for r in spark.table("target").collect()] == [("x", 1)]
    spark.sql("drop table target")


def test_empty_fields_stay_text(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("1,create,,10\n1,pay,t1,12")
    df = files.delimited_table(spark, str(path), schemas.ORDER_EVENT)
    assert [r["tx_id"] for r in df.orderBy("ts").collect()] == ["", "t1"]


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,1,2\nb,x,3")
    with pytest.raises(Exception):
        files.delimited_table(spark, str(path), schemas.SENSOR).collect()
    out = files.with_quarantine(spark, str(path), schemas.SENSOR)
    assert [r["id"] for r in out["rows"].collect()] == ["a"]
    assert [r["value"] for r in out["bad"].collect()] == ["b,x,3"]
    lines = files.text_lines(spark, str(path))
    with pytest.raises(Exception):
        files.parse_delimited(lines, schemas.SENSOR).collect()


def test_text_stream_and_formats(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("hello you\nhello")
    stream = files.text_line_stream(spark, str(folder))
    words = stream.select(F.explode(F.split("value", " ")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    log = run.collect_stream(spark, counts, "words", "update")
    assert {r["word"]: r["n"] for r in run.latest(log, ["word"]).collect()} == {"hello": 2, "you": 1}
    spark.range(3).write.json(str(tmp_path / "j"))
    assert files.read_format(spark, "json", str(tmp_path / "j"), "id long").count() == 3


def test_access_log(spark):
    line = "1.2.3.4 u1 - 17/05/2015:10:05:03 +0000 GET /a b"
    row = files.parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert (row["ip"], row["user_id"], row["method"], row["url"]) == ("1.2.3.4", "u1", "GET", "/a")
    assert row["event_time"].second == 3


def test_generators(spark):
    numbered = spark.range(3000).select(
        F.col("id").alias("value"), F.timestamp_seconds("id").alias("timestamp")
    )
    sensors = streams.sensor_rows(numbered)
    assert {r["id"] for r in sensors.select("id").distinct().collect()} == {
        "sensor_0", "sensor_1", "sensor_2",
    }
    low, high = sensors.agg(F.min("vc"), F.max("vc")).first()
    assert (low, high) == (40, 48)
    marketing = streams.marketing_rows(numbered)
    assert marketing.select("behavior", "channel").distinct().count() == 16
    stream = streams.sensor_rows(streams.numbers(spark))
    assert stream.isStreaming and stream.columns == ["id", "ts", "vc"]


def test_topic_options():
    options = streams.topic_options("h:9092", "sensor", "group")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "sensor"


def test_keyed_upsert_keeps_the_last(spark, tmp_path):
    folder = tmp_path / "store"
    folder.mkdir()

    def connect():
        def put(key, value):
            (folder / key).write_text(value)

        return put

    rows = [("a", 1, 0), ("b", 5, 1), ("a", 2, 2)]
    df = spark.createDataFrame(rows, "k string, v long, seq long")
    stores.upsert_keyed(df, "k", "v", "seq", connect)
    assert {p.name: p.read_text() for p in folder.iterdir()} == {"a": "2", "b": "5"}


def test_documents_in_bulks(spark, tmp_path):
    folder = tmp_path / "index"
    folder.mkdir()

    def connect():
        import uuid

        def bulk(documents):
            (folder / uuid.uuid4().hex).write_text("\n".join(documents))

        return bulk

    df = spark.range(5).select(F.col("id").alias("data")).coalesce(1)
    stores.index_documents(df, connect, max_actions=2)
    bulks = [p.read_text().splitlines() for p in folder.iterdir()]
    assert sorted(len(b) for b in bulks) == [1, 2, 2]
    assert sorted(json.loads(d)["data"] for b in bulks for d in b) == list(range(5))


def test_database_append(spark):
    """An embedded in-memory database inside Spark's own process."""
    url = "jdbc:derby:memory:rivulet;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame(SENSORS, schemas.SENSOR)
    stores.append_jdbc(df, url, "sensor", **driver)
    stores.jdbc_sink(url, "sensor", **driver)(df.limit(1), 0)
    assert spark.read.jdbc(url, "sensor", properties=driver).count() == 10


def test_explain_and_settings(spark, capsys):
    from rivulet.session import STATE_STORE, rows_per_chunk, stream_options

    spark.range(1).explain("formatted")
    assert "Physical Plan" in capsys.readouterr().out
    assert "RocksDB" in spark.conf.get(STATE_STORE)
    assert rows_per_chunk(spark) > 0
    assert stream_options("c", "3 seconds")["trigger"] == {"processingTime": "3 seconds"}
    assert stream_options("c")["trigger"] == {"availableNow": True}
