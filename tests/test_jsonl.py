from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lakejobs.operators.batches import batch_summary, with_batches
from lakejobs.operators.contract import EVENT_FIELDS, EXAMPLE
from lakejobs.plans import lake, queries
from lakejobs.sinks.jsonl import write_jsonl, write_lines
from lakejobs.sources.jsonl import (
    MAX_LINE_BYTES,
    LineError,
    parse_lines,
    read_events,
    read_lines,
)


def record(**changes):
    out = {**EXAMPLE, **changes}
    return {k: v for k, v in out.items() if v is not ...}


def line(**changes):
    return json.dumps(record(**changes))


def reasons(spark, tmp_path, lines, strict=True):
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    parsed = parse_lines(read_lines(spark, str(path)), strict=strict)
    return [r["bad_reason"] for r in parsed.orderBy("block_start", "line_seq").collect()]


def test_single_file_any_extension(spark, tmp_path):
    path = tmp_path / "events.log"
    path.write_text(line() + "\n" + line(vin="VIN2") + "\n")
    events = read_events(spark, str(path), "fail").events.collect()
    assert [e["vin"] for e in events] == [EXAMPLE["vin"], "VIN2"]
    assert all(e["event_id"] for e in events)


def test_directory_is_walked_for_jsonl_only(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "one.jsonl").write_text(line(vin="A"))
    (tmp_path / "a" / "b" / "two.jsonl").write_text(line(vin="B"))
    (tmp_path / "a" / "skip.json").write_text("not read")
    events = read_events(spark, str(tmp_path), "fail").events
    assert sorted(r["vin"] for r in events.collect()) == ["A", "B"]


def test_missing_path_and_empty_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_lines(spark, str(tmp_path / "nowhere"))
    with pytest.raises(ValueError):
        read_lines(spark, "")


def test_empty_file(spark, tmp_path):
    path = tmp_path / "empty.jsonl"
    path.write_bytes(b"")
    assert read_events(spark, str(path), "fail").events.count() == 0


def test_batches_do_not_span_files(spark, tmp_path):
    for name, n in (("a", 5), ("b", 3)):
        lines = [line(event_id=str(i), vin=f"VIN{i}") for i in range(1, n + 1)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines))
    events = read_events(spark, str(tmp_path), "fail").events
    order = ["block_start", "line_seq"]
    batched = with_batches(events, "file", order, 2)
    summary = batch_summary(batched, "file", order, "vin").orderBy("file", "batch_no").collect()
    assert [r["n_events"] for r in summary] == [2, 2, 1, 2, 1]
    assert [(r["first_label"], r["last_label"]) for r in summary[:3]] == [
        ("VIN1", "VIN2"), ("VIN3", "VIN4"), ("VIN5", "VIN5"),
    ]


def test_decode_table(spark, tmp_path):
    good = line()
    cases = [
        (good, None),
        ("not json", "not_json"),
        ("[" + good + "]", "not_json"),
        ("null", "empty_record"),
        (good + " trailing", "not_json"),
        (good + good, "not_json"),
        (good + ',"k":{}', "not_json"),
        (good + "," + good, "not_json"),
        (good + "}", "not_json"),
        (line(vin=123), "wrong_type"),
        (line(engine_rpm=5.0), "wrong_type"),
        (line(engine_rpm=True), "wrong_type"),
        (line(throttle_pct="38.5"), "wrong_type"),
        (good.replace("52.0907", "NaN"), "not_json"),
        (good.replace("52.0907", "1e999"), "wrong_type"),
        (line(event_ts="2024-03-18T16:07:26+02:00"), None),
        (line(event_ts="2024-03-18 14:07:26"), "bad_time"),
        (line(event_ts="soon"), "bad_time"),
        (line(tire_pressure_kpa={"fl": "bad"}), "wrong_type"),
        (line(extra={"x": 1}), None),
        ('{"event_id": "1", "vin": "VIN1"}', None),
        ("   ", "not_json"),
    ]
    assert reasons(spark, tmp_path, [c for c, _ in cases]) == [r for _, r in cases]


def test_key_case_matters(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(json.dumps({"event_id": "1", "VIN": "X"}))
    row = parse_lines(read_lines(spark, str(path))).first()
    assert row["record"]["vin"] is None and "VIN" in row["record_keys"]


def test_blank_lines_and_long_lines(spark, tmp_path):
    short = line(vin="x" * 10)
    longest = line(vin="x" * (MAX_LINE_BYTES - 1 - len(short) + 10))
    assert len(longest) == MAX_LINE_BYTES - 1
    too_long = line(vin="x" * (MAX_LINE_BYTES - len(short) + 10))
    assert reasons(spark, tmp_path, ["", short, "", longest, too_long, ""]) == [
        None, None, "too_long",
    ]


def test_carriage_returns_are_not_part_of_the_line(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_bytes((line() + "\r\n\r\n" + line(vin="B")).encode())
    assert read_events(spark, str(path), "fail").events.count() == 2


def test_time_is_an_instant_in_milliseconds(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text(line(event_ts="2024-03-18T16:07:26.123987+02:00"))
    events = read_events(spark, str(path), "fail").events
    shown = events.select(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert shown == "2024-03-18 14:07:26.123000"


def test_fail_names_file_and_line(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join([line(), "", line(), "oops", line(), "[]"]))
    (tmp_path / "b.jsonl").write_text("worse")
    out = str(tmp_path / "out")
    with pytest.raises(LineError, match=r"a\.jsonl: line 4: not_json"):
        lake.ingest(spark, str(tmp_path), lambda df, _: df.write.parquet(out))


def test_handler_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(line())

    def broken(df, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(RuntimeError, match="sink is down"):
        lake.ingest(spark, str(tmp_path), broken)
    with pytest.raises(ValueError):
        lake.ingest(spark, str(tmp_path), None)


def test_ingest_totals(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(line() for _ in range(5)))
    (tmp_path / "b.jsonl").write_text("\n".join([line(), "bad", line(), line()]))
    seen = []
    stats = lake.ingest(
        spark,
        str(tmp_path),
        lambda df, i: seen.append((i, df.count(), tuple(df.columns))),
        batch_size=2,
        on_error="quarantine",
    )
    assert seen == [(0, 8, EVENT_FIELDS)]
    assert (stats.events, stats.batches, stats.errors) == (8, 5, 1)
    assert stats.first_error == "not_json"
    (tmp_path / "b.jsonl").write_text(line())
    clean = lake.ingest(spark, str(tmp_path), lambda df, i: df.count(), batch_size=0)
    assert (clean.events, clean.batches, clean.errors) == (6, 2, 0)


def test_land_splits_by_verdict(spark, tmp_path):
    source, target = tmp_path / "in.jsonl", str(tmp_path / "landed")
    lines = [line(), "oops", line(vin="short"), line(speed_kph=...), line(event_ts=None)]
    source.write_text("\n".join(lines))
    stats = lake.land(spark, str(source), target)
    assert (stats.events, stats.errors) == (1, 4)
    got = spark.read.parquet(target).select("verdict", "reason", "raw_line").collect()
    assert sorted((r["verdict"], r["reason"]) for r in got if r["verdict"] != "accepted") == [
        ("invalid", "event_ts"),
        ("invalid", "missing speed_kph"),
        ("invalid", "vin"),
        ("undecodable", "not_json"),
    ]
    assert {r["raw_line"] for r in got if r["verdict"] != "accepted"} == set(lines[1:])
    assert lake.landed(spark, target).count() == 1


def test_sink_writes_contract_order_and_zeros(spark, tmp_path):
    source, target = tmp_path / "in.jsonl", tmp_path / "out"
    source.write_text('{"event_id": "1", "vin": "V", "tire_pressure_kpa": {"fl": 2}}')
    write_jsonl(read_events(spark, str(source), "fail").events, str(target))
    text = "".join(p.read_text() for p in target.glob("part-*"))
    found = json.loads(text)
    assert tuple(found) == EVENT_FIELDS
    assert found["tire_pressure_kpa"] == {"fl": 2.0, "fr": 0.0, "rl": 0.0, "rr": 0.0}
    assert found["speed_kph"] == 0 and found["trip_id"] == "" and found["brake_active"] is False
    assert found["event_ts"].startswith("0001-01-01T00:00:00")


def test_rotation(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x") for i in range(6)], "b int, a string").coalesce(1)
    out = tmp_path / "rotated"
    write_lines(rows, str(out), per_file=2)
    files = sorted(out.glob("*.jsonl"))
    assert len(files) == 3
    assert [len(p.read_text().splitlines()) for p in files] == [2, 2, 2]
    assert files[0].read_text().splitlines()[0] == '{"a":"x","b":0}'
    write_lines(rows, str(out))
    assert read_lines(spark, str(out)).count() == 12


def test_lines_keep_awkward_text(spark, tmp_path):
    texts = ['say "hi"', "a,b\\c", " lead and trail ", "tab\tnew\nline", "#x", "", "\u0001\u0002é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = str(tmp_path / "awkward")
    write_lines(df, out)
    back = read_lines(spark, out).select(F.from_json("value", "t string")["t"]).collect()
    assert sorted(r[0] for r in back) == sorted(texts)


def test_lines_are_made_after_events_are_dealt(spark, tmp_path, monkeypatch):
    """Events, not the long lines, are shuffled, to as many files as lines ask for."""
    spark.range(300).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-05 00:00:00' AS ts", "id % 7 AS user_id",
        "'click' AS event_type", "double(id) AS value", "'{\"k\": 3}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "LINES_A_FILE", 20)
    lines = queries._event_lines(spark, str(tmp_path))
    assert lines.select(F.spark_partition_id()).distinct().count() > 8
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    after, before = plan.split("RepartitionByExpression")
    assert "StructsToJson" in after and "md5" in after and "md5" not in before
    assert lines.select("seq").distinct().count() == 300


def test_keys_are_read_only_where_asked_for(spark, tmp_path):
    """The keys are no part of the step that parses every line."""
    path = tmp_path / "in.jsonl"
    path.write_text(line())
    parsed = parse_lines(read_lines(spark, str(path))).select("record.*")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "jsonObjectKeys" not in plan


def test_white_space_around_records(spark, tmp_path):
    good = line()
    cases = [
        (good + "\r", None),
        (" \t" + good + " \r\r", None),
        (good + "\r\r", None),
        (" " + good, None),
        (good + " ", "not_json"),
        ("\x0b" + good, "not_json"),
        (" null\t", "empty_record"),
        ("\r", "not_json"),
        ("{", "not_json"),
        ("}", "not_json"),
        ("{} {}", "not_json"),
        ("{}", "empty_record"),
        ('{"event_id": "1"}, {"vin": "2"}', "not_json"),
        ("{'event_id': 'a'}", "not_json"),
    ]
    found = reasons(spark, tmp_path, [c for c, _ in cases])
    # A line that is empty without its carriage return is left out.
    assert found == [r for c, r in cases if c != "\r"]
