from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import Observation, functions as F

from lakejobs.functions.keys import with_bucket
from lakejobs.operators import audit, merge, upkeep
from lakejobs.plans import lake, marts
from lakejobs.sinks import lake as sink
from lakejobs.sources.tables import from_bus, read_table
from test_merge import SCHEMA, at, latest, log

T0 = datetime(2024, 1, 1)


def daily(spark, n=90):
    return spark.range(n).select(
        F.concat(F.lit("k"), F.col("id") % 7).alias("source_pk"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias(
            "ts_event"
        ),
        F.col("id").alias("source_pos"),
    )


def test_bronze_appends_and_prunes_by_day(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sink.write_bronze(daily(spark), path, buckets=4)
    sink.write_bronze(daily(spark), path, buckets=4)
    assert spark.read.parquet(path).count() == 180
    found = read_table(spark, path, T0 + timedelta(days=1), T0 + timedelta(days=2, hours=3))
    assert found.count() == 2 * 27
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def table_at(tmp_path, buckets=16):
    return sink.KeyedTable(str(tmp_path / "silver"), ["source_pk"], buckets=buckets)


def test_silver_replays_and_touched_buckets(spark, tmp_path):
    silver = table_at(tmp_path)
    changes = log(spark)
    first, second = changes.where("source_pos < 60"), changes.where("source_pos >= 60")
    assert silver.read(spark) is None and not silver.fold(spark, 1)
    assert silver.append(first, "q", 0)
    assert rows(silver.read(spark)) == latest(first.collect())
    for n in range(2):
        assert silver.append(second, "q", 1) == (n == 0)
        assert rows(silver.read(spark)) == latest(changes.collect())
    one = spark.createDataFrame([("a", at(99), 999, "u", 5)], SCHEMA)
    silver.append(one, "q", 2)
    want = latest([*changes.collect(), one.first()])
    assert rows(silver.read(spark)) == want
    assert not silver.fold(spark, 9) and len(silver.batches(spark)) == 3
    assert silver.fold(spark, 1) and silver.batches(spark) == []
    assert rows(silver.read(spark)) == want
    # An older change, and a batch that was folded already, change nothing.
    silver.append(spark.createDataFrame([("a", at(1), 1, "u", 1)], SCHEMA), "q", 3)
    silver.append(second, "q", 1)
    assert rows(silver.read(spark)) == want
    some = [0, 3, 5]
    picked = silver.read(spark, some)
    placed = with_bucket(silver.read(spark), ["source_pk"], 16).where(F.col("bucket").isin(some))
    assert rows(picked) == rows(placed.drop("bucket"))


def test_reading_takes_as_many_scans_however_many_batches(spark, tmp_path):
    silver = table_at(tmp_path)
    changes = log(spark)
    silver.append(changes.where("source_pos < 10"), "q", 0)
    silver.fold(spark)
    for n in range(1, 8):
        silver.append(changes.where(F.floor(F.col("source_pos") / 10) == n), "q", n)
    plan = silver.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 3
    assert rows(silver.read(spark)) == latest(changes.where("source_pos < 80").collect())


def test_an_empty_batch_and_an_emptied_table(spark, tmp_path):
    silver = table_at(tmp_path)
    changes = log(spark)
    silver.append(changes.limit(0), "q", 0)
    assert silver.read(spark) is None
    silver.append(changes, "q", 1)
    silver.replace(changes.limit(0))
    assert silver.read(spark) is None
    silver.append(changes, "q", 2)
    assert rows(silver.read(spark)) == latest(changes.collect())


def test_a_new_checkpoint_counts_its_batches_again(spark, tmp_path):
    silver = table_at(tmp_path)
    changes = log(spark)
    silver.append(changes.where("source_pos < 60"), "first query", 0)
    silver.append(changes.where("source_pos >= 60"), "second query", 0)
    assert rows(silver.read(spark)) == latest(changes.collect())


def test_a_batch_without_a_column_keeps_it(spark, tmp_path):
    silver = table_at(tmp_path)
    wide = log(spark).withColumn("extra", F.lit("kept"))
    silver.append(wide, "q", 0)
    one = spark.createDataFrame([("zz", at(99), 999, "u", 5)], SCHEMA)
    silver.append(one, "q", 1)
    silver.fold(spark)
    got = {r["source_pk"]: r["extra"] for r in silver.read(spark).collect()}
    assert got.pop("zz") is None and set(got.values()) == {"kept"}


def test_a_failed_write_leaves_no_trace(spark, tmp_path):
    silver = table_at(tmp_path)
    changes = log(spark)
    silver.append(changes.where("source_pos < 60"), "q", 0)
    before = rows(silver.read(spark))
    broken = changes.withColumn(
        "value", F.expr("if(source_pos = 100, raise_error('lost'), value)")
    )
    with pytest.raises(Exception, match="lost"):
        silver.append(broken, "q", 1)
    # Half of a write that was not completed.
    left = str(tmp_path / "silver" / "epoch=0" / "batch=q-2")
    changes.withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(left)
    os.remove(f"{left}/_SUCCESS")
    assert rows(silver.read(spark)) == before
    silver.append(changes, "q", 1)
    assert rows(silver.read(spark)) == latest(changes.collect())
    silver.fold(spark)
    assert silver.remove_superseded(spark, timedelta(days=1)) == []
    assert silver.remove_superseded(spark, timedelta(0)) == ["epoch=0"]
    assert rows(silver.read(spark)) == latest(changes.collect())


def test_publish_upsert_is_idempotent(spark, tmp_path):
    hot = sink.KeyedTable(str(tmp_path / "hot"), ["source_pk"], buckets=4)
    staged = log(spark)
    sink.publish_upsert(hot, staged)
    once = rows(sink.hot_rows(spark, hot))
    sink.publish_upsert(hot, staged)
    assert rows(sink.hot_rows(spark, hot)) == once
    assert "op" not in sink.hot_rows(spark, hot).columns


def test_publish_replace_keeps_readers_safe(spark, tmp_path):
    path = str(tmp_path / "hot")
    sink.publish_replace(spark.range(5), path)
    reader = sink.read_hot(spark, path)
    sink.publish_replace(spark.range(2), path)
    assert reader.count() == 5 and sink.read_hot(spark, path).count() == 2
    sink.publish_replace(spark.range(1), path)
    assert len(sink.publications(spark, path)) == 2


def test_handler_is_closed_after_success_only(spark):
    class Sink:
        def __init__(self, error):
            self.error, self.closed = error, False

        def __call__(self, df, batch_id):
            if self.error:
                raise RuntimeError("no")

        def close(self):
            self.closed = True

    good, bad = Sink(False), Sink(True)
    sink.run_handler(spark.range(1), good)
    with pytest.raises(RuntimeError):
        sink.run_handler(spark.range(1), bad)
    assert good.closed and not bad.closed


def test_publish_table(spark):
    sink.publish_table(spark.range(3), "hot_numbers")
    sink.publish_table(spark.range(2), "hot_numbers")
    assert spark.table("hot_numbers").count() == 2
    spark.sql("DROP TABLE hot_numbers")


def test_compaction_keeps_rows_and_limits_files(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    # Identical rows fill half of the table.
    same = spark.range(2000).select(
        F.lit("k").alias("k"), F.lit("x" * 50).alias("v"), F.lit("2024-01-01").alias("event_date")
    )
    other = spark.range(2000).select(
        F.col("id").cast("string").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit("2024-01-02").alias("event_date"),
    )
    same.unionByName(other).repartition(9).write.partitionBy("event_date").parquet(source)
    before = upkeep.file_health(spark, source, ["event_date"])
    assert before.agg(F.sum("n_rows")).first()[0] == 4000
    assert before.agg(F.min("small_share")).first()[0] == 1.0
    check = upkeep.compact(spark, source, target, ["event_date"], target_mb=0.05).first()
    assert check["same"] and check["rows_after"] == 4000
    after = {str(r["event_date"]): r for r in upkeep.file_health(spark, target, ["event_date"]).collect()}
    wanted = {str(r["event_date"]): r for r in before.collect()}
    for day, row in after.items():
        files = -(-wanted[day]["total_bytes"] // int(0.05 * 1024 * 1024))
        assert 1 <= row["n_files"] <= files + 1
    assert after["2024-01-02"]["n_files"] > 1


def test_same_rows_sees_a_changed_copy(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    assert upkeep.same_rows(a, a.repartition(3)).first()["same"]
    assert not upkeep.same_rows(a, b).first()["same"]


def test_relayout(spark, tmp_path):
    target = str(tmp_path / "hourly")
    check = upkeep.relayout(daily(spark), target, "ts_event", "hour", ["source_pk"], 4).first()
    assert check["same"] and check["rows_after"] == 90
    assert {"event_date", "event_hour", "bucket"} <= set(spark.read.parquet(target).columns)


def test_compaction_in_place_leaves_healthy_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = daily(spark, 72).withColumn("event_date", F.to_date("ts_event"))
    day = F.col("event_date") == "2024-01-02"
    df.where(day).repartition(5).write.partitionBy("event_date").parquet(path)
    df.where(~day).repartition(1).write.mode("append").partitionBy("event_date").parquet(path)
    before = set(spark.read.parquet(path).inputFiles())
    assert upkeep.compact_partitions(spark, path, ["event_date"]) == 1
    after = set(spark.read.parquet(path).inputFiles())
    assert {f for f in before if "2024-01-02" not in f} < after
    assert len([f for f in after if "2024-01-02" in f]) == 1
    assert rows(spark.read.parquet(path).select(*df.columns)) == rows(df)
    assert upkeep.compact_partitions(spark, path, ["event_date"]) == 0


def test_retention_removes_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.write_bronze(daily(spark), path)
    want = rows(upkeep.retain(spark.read.parquet(path), "ts_event", 2))
    assert upkeep.retain_partitions(spark, path, 2) == 2
    assert rows(spark.read.parquet(path)) == want
    assert upkeep.retain_partitions(spark, str(tmp_path / "none"), 2) == 0


def test_retain_cuts_whole_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.write_bronze(daily(spark), path)
    kept = upkeep.retain(spark.read.parquet(path), "ts_event", 2)
    assert kept.agg(F.min("ts_event")).first()[0] == datetime(2024, 1, 3)
    assert kept.count() == 90 - 48


def test_audit_and_observation(spark, tmp_path):
    seen = Observation()
    df = audit.observed(
        spark.range(10), seen, events=F.count(F.lit(1)), errors=F.count_if(F.col("id") > 7)
    )
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"events": 10, "errors": 2}
    path = str(tmp_path / "audit")
    for batch, ms in ((0, 1000), (1, 1001)):
        row = audit.audit_row(
            spark, "s", "silver", batch, 100, 90, 10, ms, datetime(2024, 1, 1), "w1",
            datetime(2024, 1, 1, 0, 1),
        )
        audit.append_audit(row, path)
    got = audit.ops_metrics(spark.read.parquet(path)).first()
    assert (got["runs"], got["error_rate"], got["slow_runs"], got["lag_sec"]) == (2, 0.1, 1, 60)
    assert got["rows_per_sec"] == pytest.approx(200 / 2.001)


def test_a_batch_that_fails_the_gate_is_held(spark, tmp_path):
    mart = lake.Mart("n", lambda s: s.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "hot"))
    rowwise = lake.Mart("rows", lambda s: s, str(tmp_path / "keyed"), ["source_pk"])
    verdicts = {"open": True}

    def gate(batch):
        return spark.createDataFrame([(verdicts["open"],)], "passed boolean")

    job = lake.SilverJob(
        "s", str(tmp_path / "silver"), ["source_pk"], buckets=4, gate=gate,
        marts=[mart, rowwise], audit_path=str(tmp_path / "audit"),
    )

    def change(key, pos, op="c"):
        return spark.createDataFrame([(key, at(pos), pos, op, 1)], SCHEMA)

    def published():
        keys = sorted(r["source_pk"] for r in rowwise.rows(spark).collect())
        return mart.rows(spark).first()["n"], keys

    job(change("a", 1), 0)
    verdicts["open"] = False
    job(change("b", 2), 1)
    assert published() == (1, ["a"])
    verdicts["open"] = True
    job(change("c", 3), 2)
    job(change("c", 3), 2)
    assert published() == (2, ["a", "c"])
    assert [r["source_pk"] for r in job.state(spark).orderBy("source_pk").collect()] == ["a", "c"]
    assert job.held(spark) == [("none", 1)]
    job.release(spark, "none", 1)
    assert published() == (3, ["a", "b", "c"]) and job.held(spark) == []
    job(change("a", 4, "d"), 3)
    assert published() == (2, ["b", "c"])
    stages = [r["stage"] for r in audit.read_audit(spark, job.audit_path).collect()]
    assert sorted(stages) == ["silver", "silver", "silver", "silver (held)"]
    job.rebuild(change("a", 1).unionByName(change("b", 2)))
    assert mart.rows(spark).first()["n"] == 2


def test_batch_runs_are_sources_of_their_own(spark, tmp_path):
    verdicts = {"open": True}

    def gate(batch):
        return spark.createDataFrame([(verdicts["open"],)], "passed boolean")

    job = lake.SilverJob("s", str(tmp_path / "silver"), ["source_pk"], buckets=4, gate=gate)

    def take(key, pos, run_id=None):
        sink.run_handler(spark.createDataFrame([(key, at(pos), pos, "c", 1)], SCHEMA), job, run_id)

    def state():
        return sorted(r["source_pk"] for r in job.state(spark).collect())

    take("a", 1)
    take("b", 2)
    assert state() == ["a", "b"]
    take("c", 3, "load 3")
    known = job.table.batches(spark)
    take("c", 3, "load 3")
    assert state() == ["a", "b", "c"] and job.table.batches(spark) == known
    verdicts["open"] = False
    take("d", 4)
    take("e", 5)
    held = job.held(spark)
    assert len(held) == 2 and {n for _, n in held} == {0}
    for source, number in held:
        job.release(spark, source, number)
    assert state() == ["a", "b", "c", "d", "e"]


def test_bus_records_decode(spark):
    records = spark.createDataFrame(
        [(b"k", b'{"v": 7}', "t", 0, 5, T0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    )
    from pyspark.sql import types as T

    row = from_bus(records, T.StructType([T.StructField("v", T.IntegerType())])).first()
    assert (row["source_pk"], row["source_pos"], row["payload"]["v"]) == ("k", 5, 7)
    bad = spark.createDataFrame(
        [(b"k", v, "t", 0, n, T0) for n, v in enumerate([None, b"", b"oops", b'{"v": "x"}', b"null"])],
        records.schema,
    )
    got = from_bus(bad, T.StructType([T.StructField("v", T.IntegerType())])).orderBy("source_pos")
    out = [(r["reason"], r["payload"]) for r in got.collect()]
    assert out == [
        ("tombstone", None), ("empty_record", None), ("not_json", None), ("wrong_type", None),
        ("empty_record", None),
    ]


def test_trip_summary_and_grid(spark):
    df = spark.createDataFrame(
        [("v", "t", T0, 10.0, 50.0, True, 37.7749, -122.4194),
         ("v", "t", T0 + timedelta(minutes=1), 11.5, 70.0, False, 37.7749, -122.4194)],
        "vin string, trip_id string, event_ts timestamp, odometer_km double, speed_kph double, "
        "brake_active boolean, latitude double, longitude double",
    )
    trip = marts.trip_summary(df).first()
    assert (trip["n_events"], trip["distance_km"], trip["brake_share"]) == (2, 1.5, 0.5)
    assert tuple(marts.geo_grid(df, 5).first()) == ("9q8yy", 2, 1, 60.0)
