"""End-to-end jobs: land files into Bronze, promote Bronze to Silver and Gold."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakejobs.functions.keys import with_bucket
from lakejobs.functions.rules import Rule, validate
from lakejobs.operators.audit import RunStats, append_audit, audit_row
from lakejobs.operators.batches import DEFAULT_BATCH
from lakejobs.operators.contract import CONTRACT_RULES, EVENT_FIELDS, typed
from lakejobs.operators.merge import live, rebuild
from lakejobs.operators.quality import may_publish
from lakejobs.operators.sizing import keep_matching
from lakejobs.session import delete_path, listed, new_path
from lakejobs.sinks.lake import (
    RUN_ID,
    Handler,
    KeyedTable,
    hot_rows,
    publish_replace,
    publish_upsert,
    read_hot,
    run_handler,
)
from lakejobs.sources.jsonl import first_bad_line, parse_lines, read_lines
from lakejobs.sources.ledger import FileLedger, batch_of


def ingest(
    spark: SparkSession,
    path: str | Sequence[str],
    handler: Handler,
    batch_size: int = DEFAULT_BATCH,
    on_error: str = "fail",
    strict: bool = True,
    run_id: str | None = None,
) -> RunStats:
    """Read a file or folder of event lines and hand the events to a sink.

    on_error='fail' raises LineError for the first bad line in file order.
    Files are read in parallel; batch_size only decides how many batches per
    file are counted, not what the sink receives at once. A retry of a run that
    must not count twice gives the run's id again.
    """
    if handler is None:
        raise ValueError("an output handler is required")
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error {on_error!r}")
    size = batch_size if batch_size > 0 else DEFAULT_BATCH
    lines = read_lines(spark, path)
    # Every line is parsed once; its verdict goes to the table with it.
    target = new_path(spark, "ingest")
    parsed = parse_lines(lines, strict=strict).withColumn(
        "rejected", F.col("bad_reason").isNotNull()
    )
    judged = parsed.drop("value")
    judged.write.partitionBy("rejected").parquet(target)
    try:
        marks = spark.read.schema(judged.schema).parquet(target)
        at = F.struct("file", "block_start", "line_seq")
        per_file = marks.groupBy("file").agg(
            F.count_if(F.col("bad_reason").isNull()).alias("good"),
            F.count("bad_reason").alias("bad"),
            F.min_by("bad_reason", F.when(F.col("rejected"), at)).alias("first_bad"),
        )
        totals = per_file.agg(
            F.coalesce(F.sum("good"), F.lit(0)).alias("events"),
            F.coalesce(F.sum(F.ceil(F.col("good") / F.lit(size))), F.lit(0)).alias("batches"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("errors"),
            F.min_by("first_bad", F.when(F.col("bad") > 0, F.col("file"))).alias("first_error"),
        ).first()
        if on_error == "fail" and totals["errors"]:
            raise first_bad_line(lines, strict)
        good = marks.where(~F.col("rejected")).select("record.*", "record_keys")
        run_handler(typed(good).select(*EVENT_FIELDS), handler, run_id)
    finally:
        delete_path(spark, target)
    return RunStats(
        totals["events"], int(totals["batches"]), totals["errors"], totals["first_error"]
    )


def judged_lines(
    lines: DataFrame, rules: Sequence[Rule] = CONTRACT_RULES, strict: bool = True
) -> DataFrame:
    """Contract columns plus verdict and reason for every line.

    verdict is 'accepted', 'undecodable' (reason: why) or 'invalid' (reason:
    the missing fields or the first failing one). The text is kept for rejects.
    """
    parsed = parse_lines(lines, strict=strict)
    keep = [c for c in ("file", "block_start", "line_seq") if c in parsed.columns]
    # As generator output, the keys are read once for all rules.
    keys = F.inline(F.array(F.struct("record_keys")))
    flat = parsed.select("record.*", keys, "bad_reason", "value", *keep)
    checked = validate(flat, rules, "record_keys")
    reason = F.coalesce(
        F.col("bad_reason"),
        F.when(F.size("missing") > 0, F.concat(F.lit("missing "), F.concat_ws(",", "missing"))),
        F.col("first_error.field"),
    )
    verdict = (
        F.when(F.col("bad_reason").isNotNull(), "undecodable")
        .when(~F.col("is_valid"), "invalid")
        .otherwise("accepted")
    )
    out = checked.select(
        *EVENT_FIELDS,
        verdict.alias("verdict"),
        reason.alias("reason"),
        F.when(verdict != "accepted", F.col("value")).alias("raw_line"),
        *keep,
    )
    return typed(out)


def land(
    spark: SparkSession,
    path: str | Sequence[str],
    target: str,
    rules: Sequence[Rule] = CONTRACT_RULES,
    strict: bool = True,
    mode: str = "append",
) -> RunStats:
    """Judge event files and append them to a table split by verdict and day.

    Accepted rows and rejects leave in one pass over the input; read the
    accepted ones with `landed`. Totals are observed during the write.
    """
    judged = judged_lines(read_lines(spark, path), rules, strict)
    seen = Observation()
    bad = F.col("verdict") != "accepted"
    at = F.struct("file", "block_start", "line_seq")
    dated = judged.withColumn("event_date", F.to_date("event_ts"))
    # Observed above the shuffle, so a map stage that runs again counts once.
    out = dated.hint("rebalance", "verdict", "event_date").observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bad).alias("errors"),
        F.min_by(F.when(bad, F.col("reason")), F.when(bad, at)).alias("first_error"),
    )
    out.write.mode(mode).partitionBy("verdict", "event_date").parquet(target)
    got = seen.get
    return RunStats(got["rows"] - got["errors"], 1, got["errors"], got["first_error"])


def land_new(
    spark: SparkSession,
    folder: str,
    target: str,
    ledger: FileLedger,
    rules: Sequence[Rule] = CONTRACT_RULES,
    strict: bool = True,
    max_files: int = 10_000,
) -> list[RunStats]:
    """Land the files of a folder that no earlier call has taken; totals of each batch.

    A batch takes at most max_files files, the oldest first, writes its rows to
    target/batch=... and is entered in the ledger last. A call that failed half
    way is repeated without doubling a row. Read the rows with `landed_new`.
    """
    done = []
    while files := ledger.next_files(spark, folder, max_files):
        batch = batch_of(files)
        paths = [f["path"] for f in files]
        done.append(land(spark, paths, f"{target}/batch={batch}", rules, strict, "overwrite"))
        ledger.enter(spark, files, batch)
    return done


def landed_new(
    spark: SparkSession, target: str, ledger: FileLedger, verdict: str | None = None
) -> DataFrame:
    """Rows that `land_new` landed and that count, of one verdict or all."""
    rows = ledger.rows(spark, spark.read.parquet(target))
    return rows if verdict is None else rows.where(F.col("verdict") == verdict)


def ingest_new(
    spark: SparkSession,
    folder: str,
    handler: Handler,
    ledger: FileLedger,
    max_files: int = 10_000,
    **how,
) -> list[RunStats]:
    """`ingest` for the files that no earlier call has taken, in batches of max_files.

    A batch's name is the run's id, so a sink that knows its runs, such as
    SilverJob, takes a repeated batch once.
    """
    done = []
    while files := ledger.next_files(spark, folder, max_files):
        batch = batch_of(files)
        done.append(ingest(spark, [f["path"] for f in files], handler, run_id=batch, **how))
        ledger.enter(spark, files, batch)
    return done


def landed(spark: SparkSession, target: str, verdict: str = "accepted") -> DataFrame:
    """Rows of one verdict; other verdicts' directories are not read."""
    return spark.read.parquet(target).where(F.col("verdict") == verdict).drop("verdict")


@dataclass(frozen=True)
class Mart:
    """A hot table: a query over the live Silver rows and where it is published.

    With keys, the mart has one row per key and build works row by row: it gets
    the state rows of the keys a batch has touched, tombstones included, and
    keeps keys, version and op; only those rows are upserted.
    """

    name: str
    build: Callable[[DataFrame], DataFrame]
    path: str
    keys: Sequence[str] = ()
    order: Sequence[str] = ("ts_event", "source_pos")

    def table(self) -> KeyedTable:
        return KeyedTable(self.path, tuple(self.keys), tuple(self.order))

    def rows(self, spark: SparkSession) -> DataFrame:
        return hot_rows(spark, self.table()) if self.keys else read_hot(spark, self.path)


@dataclass(frozen=True)
class SilverJob:
    """One entity: change batches in; Silver, gate, marts and audit out.

    The gate judges a batch before it is merged. A batch that fails is held
    aside and reaches neither Silver nor a mart until it is released.
    """

    source: str
    silver_path: str
    keys: Sequence[str]
    order: Sequence[str] = ("ts_event", "source_pos")
    buckets: int = 64
    gate: Callable[[DataFrame], DataFrame] | None = None
    marts: Sequence[Mart] = field(default_factory=tuple)
    audit_path: str | None = None
    fold_after: int = 16

    @property
    def table(self) -> KeyedTable:
        return KeyedTable(self.silver_path, tuple(self.keys), tuple(self.order), self.buckets)

    def state(self, spark: SparkSession) -> DataFrame | None:
        return self.table.read(spark)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Take one batch; usable with foreachBatch and safe to run again.

        A batch is known by its stream or, outside one, by its run (`run_handler`),
        and its number. Called directly, the number alone names it.

        The batch is kept while it is read several times, and read again from its
        source where an executor is lost.
        """
        batch.persist()
        try:
            self._run(batch, batch_id)
        finally:
            batch.unpersist()

    def _run(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = spark.sparkContext.getLocalProperty
        run = known("sql.streaming.queryId") or known(RUN_ID) or ""
        totals = batch.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct(*self.keys).alias("n_keys"),
            F.max(self.order[0]).alias("newest"),
        ).first()
        if totals["n"] == 0:
            return
        passed = self.gate is None or may_publish(self.gate(batch))
        if passed:
            self.table.append(batch, run, batch_id)
            self.publish(batch)
            self.table.fold(spark, self.fold_after)
        else:
            held = f"{self.silver_path}/held/source={run or 'none'}/batch_id={batch_id}"
            batch.write.mode("overwrite").parquet(held)
        if self.audit_path:
            row = audit_row(
                spark,
                self.source,
                "silver" if passed else "silver (held)",
                batch_id,
                totals["n"],
                totals["n_keys"],
                watermark=totals["newest"],
                writer_id=run,
            )
            append_audit(row, self.audit_path)

    def publish(self, changes: DataFrame) -> None:
        """Bring the marts up to date: keyed ones by the changed keys, others whole."""
        spark = changes.sparkSession
        keyed = [m for m in self.marts if m.keys]
        if keyed:
            placed = with_bucket(changes.select(*self.keys), self.keys, self.buckets)
            only = [r["bucket"] for r in placed.select("bucket").distinct().collect()]
            state = self.table.read(spark, only)
            touched = keep_matching(state, changes, self.keys)
            for mart in keyed:
                publish_upsert(mart.table(), mart.build(touched), self.fold_after)
        for mart in self.marts:
            if not mart.keys:
                publish_replace(mart.build(live(self.state(spark))), mart.path)

    def held(self, spark: SparkSession) -> list[tuple[str, int]]:
        """Source and number of every batch that is held."""
        top = f"{self.silver_path}/held"
        return [
            (s.split("=", 1)[1], int(b.split("=", 1)[1]))
            for s, _ in listed(spark, top)
            for b, _ in listed(spark, f"{top}/{s}")
        ]

    def release(self, spark: SparkSession, source: str, batch_id: int) -> None:
        """Merge and publish a held batch after all."""
        path = f"{self.silver_path}/held/source={source}/batch_id={batch_id}"
        batch = spark.read.parquet(path)
        self.table.append(batch, f"released {source}", batch_id)
        self.publish(batch)
        delete_path(spark, path)

    def rebuild(self, bronze: DataFrame) -> None:
        """Silver and marts again from the whole change log."""
        self.table.replace(rebuild(bronze, self.keys, self.order))
        self.publish(bronze)


def watermark_of(df: DataFrame, ts: str, delay: str) -> Column | None:
    """Newest event time minus the delay, as a literal; None without rows."""
    newest = df.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"]
    return None if newest is None else F.lit(newest)
