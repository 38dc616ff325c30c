"""Ledgers, expiring tombstones, offset ranges, packing and lineage against plain versions."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from lakejobs.operators import expiry, lineage, offsets, packing
from lakejobs.plans import lake
from lakejobs.plans.state_oracle import state_sql
from lakejobs.session import delete_path, new_path
from lakejobs.sources.ledger import FileLedger, batch_of, files_in


# --- processed files ---------------------------------------------------------


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))


def raw_lines(spark, target, ledger):
    return sorted(r.raw_line for r in lake.landed_new(spark, target, ledger).collect())


def test_files_are_landed_once(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    ledger = FileLedger(str(tmp_path / "ledger"))
    put(folder, "a.jsonl", ["a1", "a2"])
    put(f"{folder}/sub dir", "b.jsonl", ["b1"])
    put(folder, "_hidden.jsonl", ["h"])
    put(folder, "empty.jsonl", [])
    assert sum(s.errors for s in lake.land_new(spark, folder, target, ledger, max_files=1)) == 3
    assert lake.land_new(spark, folder, target, ledger) == []
    put(folder, "c.jsonl", ["c1"])
    assert [s.errors for s in lake.land_new(spark, folder, target, ledger)] == [1]
    assert raw_lines(spark, target, ledger) == ["a1", "a2", "b1", "c1"]
    assert ledger.entries(spark).count() == 3  # a file without a byte has nothing to land


def test_failed_attempts_and_changed_files(spark, tmp_path):
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    ledger = FileLedger(str(tmp_path / "ledger"))
    put(folder, "a.jsonl", ["a1"])
    files = ledger.next_files(spark, folder, 9)
    # The rows were written, the entry was not; more files arrive before the next attempt.
    lake.land(spark, [f["path"] for f in files], f"{target}/batch={batch_of(files)}")
    put(folder, "b.jsonl", ["b1"])
    lake.land_new(spark, folder, target, ledger)
    assert raw_lines(spark, target, ledger) == ["a1", "b1"]
    # A file that grew counts with its new content only.
    put(folder, "a.jsonl", ["a1", "a2"])
    os.utime(f"{folder}/a.jsonl", (2_000_000_000, 2_000_000_000))
    lake.land_new(spark, folder, target, ledger)
    assert raw_lines(spark, target, ledger) == ["a1", "a2", "b1"]


def test_ingest_takes_files_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    ledger = FileLedger(str(tmp_path / "ledger"))
    put(folder, "a.jsonl", ["not json"])
    taken = []

    def sink(df, batch_id):
        taken.append(df.count())
        if len(taken) == 1:
            raise RuntimeError("sink is away")

    with pytest.raises(RuntimeError):
        lake.ingest_new(spark, folder, sink, ledger, on_error="quarantine")
    assert ledger.entries(spark).count() == 0
    assert [s.errors for s in lake.ingest_new(spark, folder, sink, ledger, on_error="quarantine")] == [1]
    assert lake.ingest_new(spark, folder, sink, ledger, on_error="quarantine") == []
    assert len(taken) == 2


# --- tombstones --------------------------------------------------------------


def changes(spark, rows):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(k, op, start + timedelta(days=d), pos) for pos, (k, op, d) in enumerate(rows)],
        "source_pk string, op string, ts_event timestamp_ntz, source_pos long",
    )


def state_of(merged):
    return {(r.source_pk, r.op) for r in merged.state.collect()}


def test_tombstones_expire(spark):
    how = dict(keys=["source_pk"], keep="3 days", buckets=1)
    one = expiry.merge_expiring(None, None, changes(spark, [("a", "c", 1), ("a", "d", 2), ("b", "c", 2)]), **how)
    assert state_of(one) == {("a", "d"), ("b", "c")}
    # Before it expires, the tombstone keeps an older update away.
    two = expiry.merge_expiring(one.state, one.marks, changes(spark, [("a", "u", 1.5)]), **how)
    assert state_of(two) == {("a", "d"), ("b", "c")} and two.too_late.count() == 0
    # The watermark passes it: the state is smaller.
    three = expiry.merge_expiring(two.state, two.marks, changes(spark, [("c", "c", 9)]), **how)
    assert state_of(three) == {("b", "c"), ("c", "c")}
    # After that an older update is set aside; an older one of a known key loses or wins by version.
    late = changes(spark, [("a", "u", 1.5), ("b", "u", 3), ("b", "u", 1), ("a", "c", 8), (None, "c", 9)])
    four = expiry.merge_expiring(three.state, three.marks, late, **how)
    assert {r.source_pk for r in four.too_late.collect()} == {"a"} and four.too_late.count() == 1
    assert state_of(four) == {("a", "c"), ("b", "u"), ("c", "c"), (None, "c")}
    # The same batch again changes nothing.
    again = expiry.merge_expiring(four.state, four.marks, late, **how)
    assert state_of(again) == state_of(four)
    assert again.marks.collect() == four.marks.collect()


def test_deletes_do_not_pile_up(spark):
    """A thousand keys come and go; the state holds the tombstones of the delay only."""
    state = marks = None
    for day in range(0, 30, 3):
        rows = [(f"{day}-{k}", op, day + (op == "d")) for k in range(100) for op in "cd"]
        got = expiry.merge_expiring(state, marks, changes(spark, rows), ["source_pk"], keep="4 days", buckets=4)
        state = spark.createDataFrame(got.state.collect(), got.state.schema)
        marks = spark.createDataFrame(got.marks.collect(), got.marks.schema)
    assert state.count() <= 300


def test_the_query_meets_both_cases():
    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.01/events.parquet'")
    sql = state_sql({"land_files": "", "scd2": ""})["tombstone_expiry"]
    late = con.sql(f"SELECT count(*) FROM ({sql}) WHERE kind = 'too late'").fetchall()[0][0]
    dead = con.sql(f"SELECT count(*) FROM ({sql}) WHERE n = 3 AND op = 'd'").fetchall()[0][0]
    assert late > 0 and dead > 0


# --- offsets -----------------------------------------------------------------


def plain_ranges(positions):
    out = []
    for p in sorted(positions):
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("block, max_rows", [(10, 7), (1_000_000, 5_000_000)])
def test_ranges_against_sets(spark, block, max_rows):
    rng = random.Random(3)
    parts = ["a", "b", None]
    batches = [
        [(rng.choice(parts), rng.choice([None, rng.randint(-30, 120)])) for _ in range(150)] for _ in range(3)
    ]
    seen, known = None, {p: set() for p in parts}
    for rows in batches:
        df = spark.createDataFrame(rows, "p string, pos long")
        if seen is not None:
            again = offsets.repeated(df, seen, ["p"], "pos").collect()
            want = [(p, x) for p, x in rows if x is not None and x in known[p]]
            assert sorted(map(repr, map(tuple, again))) == sorted(map(repr, want))
        new = offsets.offset_ranges(df, ["p"], "pos", block, max_rows)
        seen = new if seen is None else offsets.unite(seen.unionByName(new), ["p"], max_rows)
        seen = spark.createDataFrame(seen.collect(), "p string, lo long, hi long")
        for p, x in rows:
            if x is not None:
                known[p].add(x)
        for p in parts:
            got = sorted((r.lo, r.hi) for r in seen.where(F.col("p").eqNullSafe(F.lit(p))).collect())
            assert got == plain_ranges(known[p])
        gaps = offsets.holes(seen, ["p"], max_rows).collect()
        missing = {(r.p, x) for r in gaps for x in range(r.lo, r.hi + 1)}
        assert missing == {
            (p, x) for p in parts if known[p] for x in range(min(known[p]), max(known[p])) if x not in known[p]
        }


def test_ranges_that_overlap_and_hold_each_other(spark):
    rows = [("p", 1, 9), ("p", 2, 3), ("p", 4, 5), ("p", 11, 12), ("p", 10, 10), ("p", 20, 30), ("p", 20, 30)]
    got = offsets.unite(spark.createDataFrame(rows, "p string, lo long, hi long"), ["p"])
    assert sorted(map(tuple, got.collect())) == [("p", 1, 12), ("p", 20, 30)]
    empty = spark.createDataFrame([], "p string, pos long")
    assert offsets.add_offsets(None, empty, ["p"], "pos").count() == 0


# --- packing -----------------------------------------------------------------


def small_table(spark, root, days=3, files=5):
    for n in range(files):
        spark.range(40).select(
            (F.col("id") + 100 * n).alias("id"), (F.col("id") % days).alias("day")
        ).coalesce(1).write.mode("append").partitionBy("day").parquet(root)


def test_packing_keeps_rows_and_good_files(spark, tmp_path):
    root = str(tmp_path / "t")
    small_table(spark, root)
    spark.range(200_000).select((F.rand(1) * 1e18).cast("long").alias("id"), F.lit(0).alias("day")).coalesce(
        1
    ).write.mode("append").partitionBy("day").parquet(root)
    before = {r["path"]: r["bytes"] for r in files_in(spark, root, "*.parquet").collect()}
    large = max(before, key=before.get)
    want = sorted(map(tuple, spark.read.parquet(root).collect()))
    packed = packing.pack_small(spark, root, str(tmp_path / "w"), target_mb=0.5)
    replaced = {r["path"] for r in spark.read.schema(packing.JOURNAL).parquet(packed.journal).collect()}
    assert replaced == before.keys() - {large} and packed.n_bins == 3
    view = packing.packed_rows(spark, packed)
    assert sorted(map(tuple, view.drop("packed").select("id", "day").collect())) == want
    # A swap that stops after the first deletions is repeated.
    delete_path(spark, sorted(replaced)[0])
    packing.swap_packed(spark, packed)
    packing.swap_packed(spark, packed)
    assert sorted(map(tuple, spark.read.parquet(root).select("id", "day").collect())) == want
    after = {r["path"] for r in files_in(spark, root, "*.parquet").collect()}
    assert large in after and len(after) == 4


def test_packing_in_turns(spark, tmp_path):
    root = str(tmp_path / "t")
    small_table(spark, root, days=4, files=6)
    want = sorted(map(tuple, spark.read.parquet(root).collect()))
    assert packing.pack_table(spark, root, str(tmp_path / "w"), 64, max_files=7) == 24
    assert sorted(map(tuple, spark.read.parquet(root).collect())) == want
    assert files_in(spark, root, "*.parquet").count() == 4
    assert packing.pack_table(spark, root, str(tmp_path / "w2"), 64) == 0


def test_bins_hold_about_the_target(spark):
    rng = random.Random(1)
    files = [(f"t/day={d}/f{n:03}", f"f{d}-{n}", rng.randint(1, 120)) for d in range(3) for n in range(50)]
    got = packing.bins(spark.createDataFrame(files, "path string, file string, bytes long"), 100).collect()
    sums = {}
    for r in got:
        sums.setdefault((r.folder, r.bin), []).append(r.bytes)
    assert all(len(v) > 1 and sum(v) < 175 and max(v) < 75 for v in sums.values())


def test_packing_without_partitions(spark, tmp_path):
    root = str(tmp_path / "flat")
    for n in range(4):
        spark.range(10).coalesce(1).write.mode("append").parquet(root)
    assert packing.pack_table(spark, root, str(tmp_path / "w"), 64) == 4
    assert spark.read.parquet(root).count() == 40 and files_in(spark, root, "*.parquet").count() == 1


# --- lineage -----------------------------------------------------------------


def test_versions_rest_on_all_before_them(spark):
    edges = None
    for v in range(1, 14):
        new = lineage.version_edges(spark, "t", v, [f"b{v}", f"c{v}"] if v % 5 else [])
        edges = new if edges is None else edges.unionByName(new)
    edges = edges.unionByName(lineage.edges_of(spark, [("file", "f3")], ("bronze", "b3")))
    targets = spark.createDataFrame([("state", f"t/{v}") for v in range(1, 14)], "kind string, name string")
    found = lineage.closure(edges, targets).collect()
    for v in range(1, 14):
        at = {r.at_name for r in found if r.name == f"t/{v}" and r.at_kind == "bronze"}
        assert at == {f"{x}{n}" for n in range(1, v + 1) if n % 5 for x in "bc"}
    down = lineage.closure(edges, spark.createDataFrame([("file", "f3")], "kind string, name string"), up=False)
    states = {r.at_name for r in down.collect() if r.at_kind == "state"}
    assert states == {f"t/{v}" for v in range(3, 14)}


def test_closure_of_cycles_and_nothing(spark):
    edges = lineage.edges_of(spark, [("x", "b")], ("x", "a")).unionByName(
        lineage.edges_of(spark, [("x", "a")], ("x", "b"))
    )
    targets = spark.createDataFrame([("x", "a"), ("x", "lone")], "kind string, name string")
    got = {(r.name, r.at_name) for r in lineage.closure(edges, targets).collect()}
    assert got == {("a", "a"), ("a", "b"), ("lone", "lone")}
    assert lineage.closure(lineage.read_edges(spark, new_path(spark, "none")), targets.limit(0)).count() == 0


# --- history in regions ------------------------------------------------------


def version_rows(spark, rows):
    return spark.createDataFrame(
        [(k, datetime(2024, 1, 1) + timedelta(days=d), pos, op, pos) for pos, (k, d, op) in enumerate(rows)],
        "source_pk string, ts_event timestamp_ntz, source_pos long, op string, value long",
    )


def history_of(df):
    return sorted(map(repr, map(tuple, df.select(sorted(df.columns)).collect())))


def test_history_in_regions_equals_one_log(spark, tmp_path):
    from lakejobs.operators.history import history_log
    from lakejobs.operators.history_regions import HistoryTable

    rng = random.Random(5)
    data = [(rng.choice("abcdefg"), rng.randint(0, 200), rng.choice("cuud")) for _ in range(250)]
    rng.shuffle(data)
    rows = version_rows(spark, data)
    table = HistoryTable(str(tmp_path / "h"), ["source_pk"], buckets=4)
    assert table.read(spark) is None
    for low in range(0, 250, 50):
        batch = rows.where(f"source_pos >= {low} AND source_pos < {low + 50}")
        table.merge(spark, batch)
        want = history_log(rows.where(f"source_pos < {low + 50}"), ["source_pk"])
        assert history_of(table.read(spark)) == history_of(want)
    before = history_of(table.read(spark))
    table.merge(spark, rows.where("source_pos < 50"))
    assert history_of(table.read(spark)) == before
    table.merge(spark, rows.limit(0))
    assert history_of(table.read(spark)) == before


def test_a_merge_reads_what_it_can_reopen(spark, tmp_path):
    from lakejobs.operators.history_regions import HistoryTable

    table = HistoryTable(str(tmp_path / "h"), ["source_pk"], buckets=4)
    table.merge(spark, version_rows(spark, [(k, d, "u") for k in "abcdefgh" for d in range(0, 300, 5)]))
    new = version_rows(spark, [("a", 280, "u")])
    affected = table.affected(spark, new)
    plan = affected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "region#" in plan.split("PartitionFilters: [")[1]
    regions = {r.region for r in affected.select("region").distinct().collect()}
    assert regions == {"open", "2024-10"} and affected.select("bucket").distinct().count() == 1
    replaced = table.merge(spark, new)
    assert {p.split("/")[0] for p in replaced} == {"region=open", "region=2024-10"}


def test_a_broken_swap_is_finished(spark, tmp_path, monkeypatch):
    from lakejobs.operators import history_regions as regions
    from lakejobs.operators.history import history_log

    table = regions.HistoryTable(str(tmp_path / "h"), ["source_pk"], buckets=2)
    rows = version_rows(spark, [(k, d, "u") for k in "abcd" for d in range(0, 100, 9)])
    table.merge(spark, rows.where("source_pos % 2 = 0"))
    deleted = []

    def fails(session, path):
        if len(deleted) == 2:
            raise OSError("the store is away")
        deleted.append(path)
        delete_path(session, path)

    with monkeypatch.context() as broken:
        broken.setattr(regions, "delete_path", fails)
        with pytest.raises(OSError):
            table.merge(spark, rows.where("source_pos % 2 = 1"))
    table.recover(spark)
    assert history_of(table.read(spark)) == history_of(history_log(rows, ["source_pk"]))
