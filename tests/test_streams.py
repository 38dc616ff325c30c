from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs.operators import merge
from lakejobs.operators.contract import EXAMPLE
from lakejobs.sinks import lake as sink
from lakejobs.sources.jsonl import stream_events, stream_lines
from lakejobs.sources.tables import stream_table
from lakejobs.streaming import flows
from lakejobs.streaming.monitor import BatchLog, is_slow
from test_merge import latest, log

T0 = datetime(2024, 1, 1)


def events(spark, minutes):
    return spark.createDataFrame(
        [(f"e{m}", T0 + timedelta(minutes=m)) for m in minutes], "id string, ts timestamp_ntz"
    )


def test_dedup_stream_over_restarts(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    schema = events(spark, [0]).schema
    for minutes in ([0, 5, 5, 10], [10, 10, 20, 0], [20, 60, 5]):
        events(spark, minutes).write.mode("append").parquet(src)
        kept = flows.dedup_stream(stream_table(spark, src, schema), ["id"], "ts", salts=3)
        flows.append_stream(kept, out, cp).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [
        "e0", "e10", "e20", "e5", "e60",
    ]


def test_kpi_stream_matches_batch_up_to_the_watermark(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    data = events(spark, range(0, 300, 7))
    data.write.parquet(src)
    stream = stream_table(spark, src, data.schema)
    kpis = flows.kpi_stream(stream, "ts", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    flows.append_stream(kpis, out, str(tmp_path / "cp")).awaitTermination()
    got = {r["window_start"]: r["n"] for r in spark.read.parquet(out).collect()}
    newest = max(r["ts"] for r in data.collect())
    want = {}
    for r in data.collect():
        hour = r["ts"].replace(minute=0)
        if hour + timedelta(hours=1) <= newest - timedelta(minutes=15):
            want[hour] = want.get(hour, 0) + 1
    assert got == want and len(want) == 4


def test_streams_equal_batch(spark, tmp_path):
    changes = log(spark)
    src, silver = str(tmp_path / "src"), str(tmp_path / "silver")
    changes.repartition(3, "source_pos").write.parquet(src)
    stream = stream_table(spark, src, changes.schema, max_files=1)
    bronze = str(tmp_path / "bronze")
    flows.bronze_stream(stream, bronze, str(tmp_path / "cp1"), by="hour").awaitTermination()
    assert rows(spark.read.parquet(bronze).select(*changes.columns)) == rows(changes)
    flows.silver_stream(
        stream, silver, str(tmp_path / "cp2"), ["source_pk"], buckets=4
    ).awaitTermination()
    state = sink.KeyedTable(silver, ["source_pk"], buckets=4).read(spark)
    assert rows(state) == latest(changes.collect())
    assert state.where("op = 'd'").count() > 0
    assert merge.live(state).count() == state.where("op <> 'd'").count()


def test_json_stream_and_timings(spark, tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    for i in range(3):
        good = json.dumps({**EXAMPLE, "event_id": f"{i:016d}"})
        (src / f"f{i}.jsonl").write_text(good + "\n\noops\n")
    out = str(tmp_path / "out")
    batches = BatchLog(spark, str(tmp_path / "batches"), threshold_ms=0)
    spark.streams.addListener(batches)
    query = flows.append_stream(
        stream_events(spark, str(src), max_files=1), out, str(tmp_path / "cp")
    )
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    stats = batches.stats(query)
    spark.streams.removeListener(batches)
    timings = batches.timings(query).orderBy("batch_id").collect()
    assert [t.batch_id for t in timings] == [0, 1, 2] and all(t.slow for t in timings)
    assert (stats.batches, stats.errors) == (3, 0)
    assert is_slow(1001) and not is_slow(1000)


def test_handler_error_stops_the_stream(spark, tmp_path):
    events(spark, [1]).write.parquet(str(tmp_path / "src"))

    def broken(df, batch_id):
        raise RuntimeError("sink is down")

    stream = stream_table(spark, str(tmp_path / "src"), events(spark, [1]).schema)
    batches = BatchLog(spark, str(tmp_path / "batches"))
    spark.streams.addListener(batches)
    query = flows.batch_stream(stream, broken, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()
    assert "sink is down" in batches.stats(query).first_error
    spark.streams.removeListener(batches)


def test_landing_stream_keeps_rejects(spark, tmp_path):
    src, out = tmp_path / "landing", str(tmp_path / "out")
    src.mkdir()
    good = json.dumps(EXAMPLE)
    (src / "f.jsonl").write_text(good + "\n\noops\n" + json.dumps({**EXAMPLE, "vin": "x"}) + "\n")
    flows.land_stream(stream_lines(spark, str(src)), out, str(tmp_path / "cp")).awaitTermination()
    got = {r["verdict"]: (r["reason"], r["raw_line"]) for r in spark.read.parquet(out).collect()}
    assert got["accepted"] == (None, None) and got["undecodable"] == ("not_json", "oops")
    assert got["invalid"][0] == "vin"


def test_stop_cleanly(spark, tmp_path):
    events(spark, [1]).write.parquet(str(tmp_path / "src"))
    stream = stream_table(spark, str(tmp_path / "src"), events(spark, [1]).schema)
    query = flows.append_stream(
        stream, str(tmp_path / "out"), str(tmp_path / "cp"), every="1 second"
    )
    assert flows.stop_cleanly(query, 2) is False
    assert not query.isActive
