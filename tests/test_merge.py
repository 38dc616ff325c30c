from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs.operators import fencing, history, merge
from lakejobs.operators.dedup import dedup_latest
from lakejobs.operators.enrich import enrich, unmatched

SCHEMA = "source_pk string, ts_event timestamp_ntz, source_pos bigint, op string, value int"
T0 = datetime(2024, 1, 1)


def at(minute):
    return T0 + timedelta(minutes=minute)


def log(spark, n=120, seed=1):
    """Changes in random order: late ones, equal times, replays, one busy key, null keys."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "busy" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        op = rng.choice(["c", "u", "u", "r", "d"])
        data.append((key, at(rng.randint(0, 25)), i, op, rng.randint(0, 3)))
    data += rng.sample(data, min(15, n))
    rng.shuffle(data)
    return spark.createDataFrame(data, SCHEMA)


def latest(data):
    best = {}
    for r in data:
        if r[0] not in best or (r[1], r[2]) > (best[r[0]][1], best[r[0]][2]):
            best[r[0]] = tuple(r)
    return sorted(best.values(), key=repr)


def split(df, seed):
    mark = F.pmod(F.xxhash64("source_pos", F.lit(seed)), F.lit(2))
    return df.where(mark == 0), df.where(mark == 1)


def test_dedup_keeps_one_deterministic_row(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", {"p": "1"}), ("a", 1, "y", {"p": "2"}), ("a", 0, "z", None), (None, 1, "n", None)],
        "k string, v int, w string, m map<string,string>",
    )
    for order in (df, df.orderBy("w"), df.orderBy(F.desc("w")).repartition(5)):
        assert [r[2] for r in rows(dedup_latest(order, ["k"], ["v"]))] == ["y", "n"]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = dedup_latest(log(spark), ["source_pk"], ["ts_event"])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_merge_properties(spark):
    changes = log(spark)
    whole = latest(changes.collect())
    once = merge.merge_current(None, changes, ["source_pk"])
    assert rows(once) == whole
    again = merge.merge_current(once, changes, ["source_pk"])
    assert rows(again) == whole
    for seed in (1, 2):
        a, b = split(changes, seed)
        for first, second in ((a, b), (b, a)):
            state = merge.merge_current(None, first, ["source_pk"])
            assert rows(merge.merge_current(state, second, ["source_pk"])) == whole


def test_chained_merges_grow_by_one_scan_a_call(spark, tmp_path):
    log(spark).write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    state, since, scans = None, None, []
    for upto in (20, 50, 80, 200):
        state, since = merge.merge_incremental(
            stored.where(F.col("source_pos") < upto), state, ["source_pk"], since
        )
        plan = state._jdf.queryExecution().optimizedPlan().toString()
        scans.append(plan.count("Relation ["))
    assert scans == [1, 2, 3, 4]
    assert rows(state) == latest(log(spark).collect())


def test_cursor_per_partition(spark):
    df = spark.createDataFrame(
        [(0, 100), (0, 101), (1, 5), (None, 7)], "part int, pos int"
    )
    first, cursors = merge.read_since_by(df.where("part = 0"), ["part"], ["pos"], None)
    assert first.count() == 2
    more = df.unionByName(spark.createDataFrame([(0, 102), (1, 6)], df.schema))
    fresh, cursors = merge.read_since_by(more, ["part"], ["pos"], cursors)
    assert rows(fresh) == rows(more.where("pos < 100 OR pos = 102"))
    assert rows(cursors) == sorted([(0, 102), (1, 6), (None, 7)], key=repr)
    none, same = merge.read_since_by(more, ["part"], ["pos"], cursors)
    assert none.count() == 0 and rows(same) == rows(cursors)


def test_late_update_does_not_revive_a_deleted_key(spark):
    rows_in = [("a", at(5), 2, "d", None), ("a", at(3), 9, "u", 1), ("b", at(1), 1, "c", 1)]
    df = spark.createDataFrame(rows_in, SCHEMA)
    state = merge.merge_current(None, df.where("source_pos = 2"), ["source_pk"])
    state = merge.merge_current(state, df, ["source_pk"])
    assert [r[0] for r in rows(merge.live(state))] == ["b"]
    assert state.count() == 2


def test_incremental_is_idempotent_and_may_step_back(spark):
    changes = log(spark)
    state, since = merge.merge_incremental(changes.where("source_pos < 60"), None, ["source_pk"], None)
    assert since == 59
    state, upto = merge.merge_incremental(changes, state, ["source_pk"], since)
    assert upto == 119 and rows(state) == latest(changes.collect())
    back, _ = merge.merge_incremental(changes, state, ["source_pk"], 20)
    assert rows(back) == rows(state)
    same, kept = merge.merge_incremental(changes, state, ["source_pk"], upto)
    assert kept == upto and rows(same) == rows(state)


def test_snapshot_diff_turns_old_into_new(spark):
    schema = "k string, v int, m map<string,string>"
    old = spark.createDataFrame(
        [("a", 1, {"x": "1"}), ("b", 2, None), ("c", None, None), (None, 1, None), ("z", None, None)],
        schema,
    )
    new = spark.createDataFrame(
        [("a", 1, {"x": "2"}), ("b", 2, None), ("d", 4, None), (None, 2, None), ("z", None, None)],
        schema,
    )
    got = {(r["change"], r["k"], r["v"]) for r in merge.snapshot_diff(old, new, ["k"]).collect()}
    assert got == {("update", "a", 1), ("delete", "c", None), ("insert", "d", 4), ("update", None, 2)}


def test_apply_deletes_matches_null_keys(spark):
    current = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    deletes = spark.createDataFrame([(None,), ("b",), ("b",)], "k string")
    assert rows(merge.apply_deletes(current, deletes, ["k"])) == [("a", 1)]


def test_backfill_equals_rebuild(spark):
    changes = log(spark)
    hole = (F.col("ts_event") >= F.lit(at(8))) & (F.col("ts_event") < F.lit(at(16)))
    state = merge.merge_current(None, changes.where(~hole), ["source_pk"])
    whole = rows(merge.rebuild(changes, ["source_pk"]))
    fixed = merge.backfill(state, changes, ["source_pk"], at(8), at(16))
    assert rows(fixed) == whole
    with pytest.raises(ValueError, match="differs"):
        merge.backfill(state, changes.drop("value"), ["source_pk"], at(8), at(16))
    text = changes.withColumn("value", F.col("value").cast("string"))
    with pytest.raises(ValueError, match="narrowed"):
        merge.backfill(state, text, ["source_pk"], at(8), at(16))


def test_fence(spark):
    df = spark.createDataFrame(
        [(w, at(m)) for m in (0, 10, 1500, 2999, 3000) for w in ("live", "fix", "other")],
        "writer_id string, ts_event timestamp_ntz",
    )
    fences = spark.createDataFrame(
        [("fix", at(10), at(3000)), ("live", at(1500), at(1501)), ("gone", at(5), at(5))],
        "writer_id string, from_ts timestamp_ntz, to_ts timestamp_ntz",
    )
    got = rows(fencing.fence(df, fences))
    want = [(w, at(m)) for m in (0, 3000) for w in ("live", "fix", "other")]
    want += [("fix", at(10)), ("fix", at(1500)), ("live", at(1500)), ("fix", at(2999))]
    assert got == sorted(want, key=repr)
    open_ended = spark.createDataFrame([("fix", at(1500), None), ("live", None, at(10))], fences.schema)
    got = rows(fencing.fence(df, open_ended))
    want = [("live", at(0)), ("fix", at(1500)), ("fix", at(2999)), ("fix", at(3000))]
    want += [(w, at(10)) for w in ("live", "fix", "other")]
    assert got == sorted(want, key=repr)
    assert fencing.fence(df.limit(0), fences).count() == 0


def intervals(data, tracked=False):
    """Brute-force history per key."""
    by_key, out = {}, []
    for r in data:
        slot = by_key.setdefault(r[0], {})
        if r[1] not in slot or r[2] > slot[r[1]][2]:
            slot[r[1]] = tuple(r)
    for versions in by_key.values():
        kept = []
        for ts in sorted(versions):
            v = versions[ts]
            mark = ("gone",) if v[3] == "d" else ("live", v[4])
            if tracked:
                mark = (v[3] == "d", v[4])
                if kept and kept[-1][1] == mark:
                    continue
            kept.append((v, mark))
        for i, (v, _) in enumerate(kept):
            end = kept[i + 1][0][1] if i + 1 < len(kept) else None
            if v[3] != "d":
                out.append((*v, v[1], end, end is None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_rows", [1_000_000, 9])
def test_scd2_against_brute_force(spark, max_rows):
    changes = log(spark)
    data = changes.collect()
    plain = history.scd2(changes, ["source_pk"], max_rows=max_rows)
    assert rows(plain) == intervals(data)
    folded = history.scd2(changes, ["source_pk"], tracked=["value"], max_rows=max_rows)
    assert rows(folded) == intervals(data, tracked=True)
    ordered = sorted(plain.collect(), key=lambda r: (str(r[0]), r["valid_from"]))
    for a, b in zip(ordered, ordered[1:]):
        if a[0] == b[0]:
            assert a["valid_to"] is not None and a["valid_to"] <= b["valid_from"]


@pytest.mark.parametrize("max_rows", [1_000_000, 9])
def test_scd2_merge_equals_one_pass(spark, max_rows):
    changes = log(spark)
    whole = history.history_log(changes, ["source_pk"])
    for seed in (1, 2):
        a, b = split(changes, seed)
        stored = history.history_log(a, ["source_pk"])
        merged = history.scd2_merge(stored, b, ["source_pk"], max_rows=max_rows)
        assert rows(merged) == rows(whole)
    view = history.history_view(merged, ["source_pk"], ["value"], max_rows=max_rows)
    assert rows(view) == intervals(changes.collect(), tracked=True)


def test_enrich_keeps_and_counts_unmatched(spark):
    events = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, d string")
    dim = spark.createDataFrame([("a", "A")], "d string, name string")
    out = enrich(events, [(dim, "d", "d")])
    assert sorted(out.columns) == ["d", "i", "matched_d", "name"]
    assert {(r["i"], r["name"], r["matched_d"]) for r in out.collect()} == {
        (1, "A", True), (2, None, False), (3, None, False),
    }
    assert tuple(unmatched(out).first()) == (3, 2)
