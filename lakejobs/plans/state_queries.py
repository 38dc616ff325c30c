"""Queries over what jobs keep between runs: ledgers, watermarks, ranges, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakejobs.functions.keys import with_partitions
from lakejobs.operators import expiry, lineage, offsets, packing, sketches, versions
from lakejobs.operators.history_regions import HistoryTable
from lakejobs.plans import lake
from lakejobs.plans.queries import (
    FIRST_CUT,
    HISTORY_COLUMNS,
    SECOND_CUT,
    _before,
    _event_lines,
    _from,
    _lit_ts,
    query,
)
from lakejobs.plans.tables import KEYS, VERSION, change_log, table
from lakejobs.session import materialize, new_path
from lakejobs.sinks.jsonl import write_text
from lakejobs.sources.ledger import FileLedger, files_in


@query
def land_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder landed three times while files arrive, one attempt of it failed half way."""
    folder, target = new_path(spark, "arriving"), new_path(spark, "landed")
    ledger = FileLedger(new_path(spark, "ledger"))
    lines = _event_lines(spark, sf_dir)
    write_text(lines.where(F.col("seq") % 2 == 0).select("value"), f"{folder}/a")
    lake.land_new(spark, folder, target, ledger, max_files=3)
    write_text(lines.where(F.col("seq") % 2 == 1).select("value"), f"{folder}/b")
    # An attempt that wrote its rows but was not entered.
    some = [r["path"] for r in ledger.next_files(spark, folder, 2)]
    lake.land(spark, some, f"{target}/batch=failed")
    lake.land_new(spark, folder, target, ledger)
    lake.land_new(spark, folder, target, ledger)
    landed = lake.landed_new(spark, target, ledger)
    return landed.groupBy("verdict", F.coalesce("reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def tombstone_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches; old updates come again before and after their tombstones expire."""
    # Keys with few changes each, so that many stay deleted.
    entity = ((F.col("source_pk") % 40) * 100 + F.col("k")).cast("long")
    log = change_log(spark, sf_dir).withColumn("source_pk", entity)
    early = F.col("ts_event") < _lit_ts(FIRST_CUT)
    middle = (F.col("ts_event") < _lit_ts(SECOND_CUT)) & ~early
    last = F.col("ts_event") >= _lit_ts(SECOND_CUT)
    again = early & (F.col("op") != "d")
    batches = [early, middle | (again & (F.col("source_pos") % 5 == 0)),
               last | (again & (F.col("source_pos") % 7 == 0))]
    state = marks = None
    out = None
    columns = ["n", "kind", *KEYS, "op", "ts_event", "source_pos"]
    for n, rows in enumerate(batches, 1):
        got = expiry.merge_expiring(
            state, marks, log.where(rows), KEYS, VERSION, keep="3 days", buckets=8
        )
        late = got.too_late.select(
            F.lit(n).alias("n"), F.lit("too late").alias("kind"), *columns[2:]
        )
        out = late if out is None else out.unionByName(late)
        state, marks = materialize(got.state, "state"), materialize(got.marks, "marks")
        kept = state.select(F.lit(n).alias("n"), F.lit("state").alias("kind"), *columns[2:])
        out = out.unionByName(kept)
    return out


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as positions of four source partitions, without holes when all are there."""
    return table(spark, sf_dir, "events").select(
        (F.col("event_id") % 4).alias("source_partition"),
        F.floor(F.col("event_id") / 4).alias("pos"),
        "event_id",
        F.col("ts").alias("ts_event"),
    )


@query
def offset_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes after each of three batches: withheld positions come late or never, some twice."""
    rows = _positions(spark, sf_dir)
    e = F.col("event_id")
    part = ["source_partition"]
    first = _before(rows, "ts_event", FIRST_CUT).where(e % 11 != 0)
    second = _before(rows, "ts_event", SECOND_CUT).where(e % 22 != 0)
    third = _from(rows, "ts_event", SECOND_CUT).where(e % 13 != 0).unionByName(
        rows.where(e % 33 == 0)
    )
    seen, out = None, None
    for n, batch in enumerate((first, second, third), 1):
        seen = materialize(offsets.add_offsets(seen, batch, part, "pos"), "ranges")
        now = offsets.holes(seen, part).withColumn("after_batch", F.lit(n))
        out = now if out is None else out.unionByName(now)
    return out


@query
def offset_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a batch that overlaps what was seen, the rows that are new."""
    rows = _positions(spark, sf_dir)
    seen = offsets.add_offsets(
        None, _before(rows, "ts_event", SECOND_CUT), ["source_partition"], "pos"
    )
    seen = materialize(seen, "ranges")
    batch = _from(rows, "ts_event", FIRST_CUT)
    again = offsets.repeated(batch, seen, ["source_partition"], "pos")
    return batch.join(again.select("event_id"), "event_id", "left_anti").select("event_id", "pos")


@query
def pack_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with one large file and many small ones: rows, and whether theirs was packed."""
    root, work = new_path(spark, "mixed"), new_path(spark, "packing")
    log = with_partitions(
        change_log(spark, sf_dir).select("source_pos", "ts_event", "op", "value"), "ts_event"
    )
    kind = F.col("source_pos") % 10
    noise = F.concat(*[F.sha2(F.concat_ws("/", F.lit(n), "source_pos"), 512) for n in range(8)])
    filled = log.withColumn("filling", F.when(kind < 7, noise))
    # One file for each day and part: a large one of seven kinds, small ones of one.
    for part in (kind < 7, kind == 7, kind == 8, kind == 9):
        one = filled.where(part).repartition("event_date")
        one.write.mode("append").partitionBy("event_date").parquet(root)
    # The day's large file is to count as good, whatever the size of the data.
    holders = spark.read.parquet(root).where("filling IS NOT NULL")
    sizes = holders.select(F.col("_metadata.file_size").alias("s")).agg(F.min("s"), F.max("s")).first()
    packed = packing.pack_small(spark, root, work, sizes[0] / 1024 / 1024)
    found = packing.packed_rows(spark, packed)
    return found.select("source_pos", "op", "value", F.col("event_date").cast("string"), "packed")


@query
def pack_and_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of small files packed in place, some files at a time; files left per day."""
    root, work = new_path(spark, "small"), new_path(spark, "packing")
    log = with_partitions(
        change_log(spark, sf_dir).select("source_pos", "ts_event", "op", "value"), "ts_event"
    )
    for n in range(3):
        one = log.where(F.col("source_pos") % 3 == n).repartition("event_date")
        one.write.mode("append").partitionBy("event_date").parquet(root)
    packing.pack_table(spark, root, work, target_mb=64, max_files=20)
    files = files_in(spark, root, "*.parquet")
    day = F.regexp_extract("path", "event_date=([0-9-]+)", 1)
    n_files = files.groupBy(day.alias("event_date")).agg(F.count(F.lit(1)).alias("n_files"))
    rows = spark.read.parquet(root).withColumn("event_date", F.col("event_date").cast("string"))
    return rows.join(n_files, "event_date").select(
        "source_pos", "ts_event", "op", "value", "event_date", "n_files"
    )


@query
def lineage_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five landings, versions and publications: how many lines each publication rests on."""
    folder, target = new_path(spark, "arriving"), new_path(spark, "landed")
    ledger, edges = FileLedger(new_path(spark, "ledger")), new_path(spark, "edges")
    lines = _event_lines(spark, sf_dir)
    for version in range(1, 6):
        part = lines.where(F.col("seq") % 5 == version - 1).select("value")
        write_text(part, f"{folder}/{version}")
        before = {r["batch"] for r in ledger.entries(spark).select("batch").distinct().collect()}
        lake.land_new(spark, folder, target, ledger)
        batches = [r["batch"] for r in ledger.entries(spark).select("batch").distinct().collect()]
        new = [b for b in batches if b not in before]
        lineage.append_edges(lineage.version_edges(spark, "silver", version, new), edges)
        made = lineage.edges_of(
            spark, [("state", f"silver/{version}")], ("mart", f"vehicles/{version}")
        )
        lineage.append_edges(made, edges)
    known = lineage.read_edges(spark, edges).unionByName(lineage.landing_edges(spark, ledger))
    marts = known.where("to_kind = 'mart'").select(
        F.col("to_kind").alias("kind"), F.col("to_name").alias("name")
    )
    rests = lineage.closure(known, marts).where("at_kind = 'file'")
    per_file = lake.landed_new(spark, target, ledger).groupBy("file").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        rests.join(per_file, rests["at_name"] == per_file["file"])
        .groupBy(F.col("name").alias("publication"))
        .agg(F.sum("n").alias("n_lines"))
    )


@query
def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users by day, by type and over all, from one stored table of sketches."""
    path = new_path(spark, "sketches")
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts").cast("string"))
    sketches.sketches(events, ["day", "event_type"], "event_id").write.parquet(path)
    stored = spark.read.parquet(path)
    out = None
    for scope in ("day", "event_type", None):
        name = F.col(scope) if scope else F.lit("all")
        approx = sketches.estimated(sketches.merged(stored.withColumn("scope", name), ["scope"]))
        exact = events.withColumn("scope", name).groupBy("scope").agg(
            F.count_distinct("event_id").alias("n_distinct")
        )
        got = sketches.checked(approx, exact, ["scope"], 3 * sketches.ERROR)
        some = got.select("scope", "n_rows", "n_distinct", "in_bound")
        out = some if out is None else out.unionByName(some)
    return out


def _event_versions() -> versions.Contract:
    """Three versions: a nested field comes, types grow, a field goes and another comes."""
    first = T.StructType.fromDDL("event_id bigint NOT NULL, user int, note string, body struct<k: int>")
    second = T.StructType.fromDDL(
        "event_id bigint NOT NULL, user bigint, note string, body struct<k: int, kind: string>"
    )
    third = T.StructType.fromDDL(
        "event_id bigint NOT NULL, user bigint, body struct<k: bigint, kind: string, tags: array<string>>, "
        "origin string"
    )
    return versions.Contract([("v1", first), ("v2", second), ("v3", third)])


@query
def contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written under three versions, read under the newest, with the kind of the chain."""
    contract = _event_versions()
    log = change_log(spark, sf_dir)
    values = {
        "event_id": F.col("source_pos"), "user": F.col("source_pk"), "note": F.col("op"),
        "origin": F.lit("web"),
    }
    parts = {"k": F.col("k"), "kind": F.col("event_type"), "tags": F.array("op", "event_type")}
    tables = {}
    for n, (name, schema) in enumerate(contract.versions):
        path = new_path(spark, f"rows-{name}")
        body = F.struct(*[parts[f.name].cast(f.dataType).alias(f.name) for f in schema["body"].dataType])
        cols = [
            (body if f.name == "body" else values[f.name].cast(f.dataType)).alias(f.name) for f in schema
        ]
        log.where(F.col("source_pos") % 3 == n).select(*cols).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    rows = contract.read(tables, {"origin": "unknown"})
    return rows.select(
        "version", "event_id", "user", "body.k", "body.kind",
        F.concat_ws(",", "body.tags").alias("tags"), "origin", F.lit(contract.chain()).alias("chain"),
    )


@query
def history_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history after three merges, the last with late changes of the first days."""
    log = change_log(spark, sf_dir)
    late = F.col("source_pos") % 9 == 0
    first = F.col("ts_event") < _lit_ts(FIRST_CUT)
    last = (F.col("ts_event") >= _lit_ts(SECOND_CUT)) | late
    stored = HistoryTable(new_path(spark, "history"), KEYS, VERSION, 8)
    for rows in (first & ~late, ~first & ~last, last):
        stored.merge(spark, materialize(log.where(rows), "changes"))
    return stored.read(spark).where("op <> 'd'").select(*HISTORY_COLUMNS)
