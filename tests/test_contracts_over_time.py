"""Contract versions, sketches, watermarks per source and fences, on odd rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from lakejobs.operators import fencing, sketches, versions
from lakejobs.streaming.marks import SourceMarks

T0 = datetime(2024, 1, 1)


def ddl(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("old, new, kind", [
    ("a int", "a int", "full"),
    ("a int", "a int, b string", "full"),
    ("a int", "a int, b string NOT NULL", "forward"),
    ("a int, b string", "a int", "full"),
    ("a int, b string NOT NULL", "a int", "backward"),
    ("a int", "a bigint", "backward"),
    ("a bigint", "a int", "forward"),
    ("a int", "a string", "broken"),
    ("a int", "a int NOT NULL", "forward"),
    ("a int NOT NULL", "a int", "backward"),
    ("s struct<x: int>", "s struct<x: bigint, y: string>", "backward"),
    ("s struct<x: int, y: string>", "s struct<x: int>", "full"),
    ("s array<struct<x: int>>", "s array<struct<x: string>>", "broken"),
    ("s map<string, int>", "s map<string, bigint>", "backward"),
    ("a int, b bigint", "a bigint, b int", "broken"),
    ("a decimal(10,2)", "a decimal(12,2)", "backward"),
    ("s struct<x: int>", "s int", "broken"),
])
def test_kinds_of_changes(spark, old, new, kind):
    assert versions.compatibility(ddl(old), ddl(new)) == kind


def test_a_chain_is_more_than_its_steps(spark):
    contract = versions.Contract([("1", ddl("a int, b int")), ("2", ddl("a int")), ("3", ddl("a int, b string"))])
    assert [k for *_, k in contract.steps()] == ["full", "full"] and contract.chain() == "broken"
    assert {(r.field, r.change) for r in contract.history(spark).collect()} == {("b", "removed"), ("b", "added")}
    one = versions.Contract([("1", ddl("a int"))])
    assert one.steps() == [] and one.chain() == "full"
    with pytest.raises(ValueError, match="cannot read rows of 1: b"):
        contract.read({"1": spark.createDataFrame([(1, 2)], "a int, b int")})


def test_nested_values_are_read_by_name(spark):
    contract = versions.Contract([
        ("1", ddl("l array<struct<x: int>>, m map<string, struct<v: int>>, gone string")),
        ("2", ddl("l array<struct<y: string, x: bigint>>, m map<string, struct<v: bigint, w: int>>, n int NOT NULL")),
    ])
    rows = spark.createDataFrame([([(1,), None], {"k": (5,)}, "g"), (None, None, None)], contract.versions[0][1])
    got = [tuple(r) for r in contract.read({"1": rows}, {"n": 7}).collect()]
    assert got[0][1][0].asDict() == {"y": None, "x": 1} and got[0][1][1] is None
    assert got[0][2]["k"].asDict() == {"v": 5, "w": None} and got[0][3] == 7
    assert got[1][1:] == (None, None, 7)
    with pytest.raises(ValueError, match="n"):
        contract.read({"1": rows})


def test_sketches_add_up(spark):
    rows = spark.range(30_000).select((F.col("id") % 9000).alias("v"), (F.col("id") % 5).alias("p"))
    stored = sketches.sketches(rows, ["p"], "v")
    whole = sketches.estimated(sketches.merged(stored)).first()
    assert whole["n_rows"] == 30_000
    assert abs(whole["approx_distinct"] - 9000) <= 3 * sketches.ERROR * 9000
    nulls = spark.createDataFrame([(None,), (None,)], "v long")
    got = sketches.estimated(sketches.sketches(nulls.withColumn("p", F.lit(1)), ["p"], "v")).first()
    assert (got["approx_distinct"], got["n_rows"]) == (0, 2)
    assert sketches.sketches(rows.limit(0), ["p"], "v").count() == 0


def events(spark, rows):
    return spark.createDataFrame(
        [(s, None if m is None else T0 + timedelta(minutes=m)) for s, m in rows], "s string, ts timestamp"
    )


def test_marks_of_sources(spark, tmp_path):
    marks = SourceMarks(str(tmp_path / "marks"), ["s"])

    def take(rows, query, batch_id, judge="own"):
        df = events(spark, rows)
        old = marks.before(spark, query, batch_id)
        out = {(r.s, r.ts): r.late for r in marks.flagged(df, old, "ts", "10 minutes", judge).collect()}
        marks.store(df, "ts", query, batch_id, old)
        return [out[s, None if m is None else T0 + timedelta(minutes=m)] for s, m in rows]

    assert take([("fast", 100), ("slow", 5), (None, 50)], "q", 0) == [False] * 3
    batch = [("fast", 80), ("fast", 95), ("slow", 1), (None, 10), ("new", 0), ("fast", None)]
    assert take(batch, "q", 1) == [True, False, False, True, False, False]
    # A batch that is repeated is judged by the marks from before it.
    assert take(batch, "q", 1) == [True, False, False, True, False, False]
    # A restarted query goes on with the marks, and by the least mark little is late.
    assert take([("fast", 80), ("slow", 0)], "another", 0, "least") == [False, False]
    left = marks.before(spark, "x", 0).collect()
    newest = {r.s: r.newest for r in left}
    assert newest["fast"] == T0 + timedelta(minutes=100) and newest["new"] == T0
    assert len(list((tmp_path / "marks").glob("n=*"))) <= 3
    with pytest.raises(ValueError, match="judge"):
        marks.flagged(events(spark, []), None, "ts", "1 minute", "both")


@pytest.mark.parametrize("max_rows", [5, 5_000_000])
def test_fences_against_every_range(spark, max_rows):
    rng = random.Random(max_rows)
    at = lambda m: T0 + timedelta(minutes=m)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 6000, 7)]), k) for k in range(150)]
    fences = [("a", 10, 20), ("b", 15, 3000), ("a", 2990, 4500), ("c", 4400, 4400), ("a", None, 5), ("b", 5000, None)]
    fences += [(rng.choice("ab"), m, m + rng.randint(0, 90)) for m in rng.choices(range(6000), k=40)]

    def times(x):
        return None if x is None else at(x)

    df = spark.createDataFrame(
        [(w, times(m), k) for w, m, k in rows], "writer_id string, ts_event timestamp_ntz, k int"
    )
    ranges = spark.createDataFrame(
        [(w, times(a), times(b)) for w, a, b in fences],
        "writer_id string, from_ts timestamp_ntz, to_ts timestamp_ntz",
    )
    want = []
    for w, m, k in rows:
        owners = {o for o, a, b in fences if m is not None and (a is None or a <= m) and (b is None or m < b)}
        if not owners or w in owners:
            want.append(k)
    got = sorted(r.k for r in fencing.fence(df, ranges, max_rows=max_rows).collect())
    assert got == sorted(want)


def test_spans_are_united(spark):
    rows = [("p", 1, 5), ("p", 5, 6), ("p", 2, 3), ("p", 8, 9), ("p", 9, 9), ("q", 1, 2), (None, 0, 1)]
    df = spark.createDataFrame(rows, "p string, low int, high int")
    got = {tuple(r) for r in fencing.united(df, ["p"], "low", "high").collect()}
    assert got == {("p", 1, 6), ("p", 8, 9), ("q", 1, 2), (None, 0, 1)}
