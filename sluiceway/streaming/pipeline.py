"""The whole path of a message as a stream: parse once, judge, break the circuit, write, count and report.

A micro-batch writes, in this order, below ``root``:

- ``events``: the records by route, with the true causes in ``failure_reasons``;
- ``state``: the breaker's counters of the keys that the batch has touched;
- ``intervals``: additive counters per interval of event time;
- ``latency``: histograms of ingest delay per interval;
- ``incidents`` and ``open_incidents``: incidents that the batch has opened or closed, and those still open after it;
- ``commits``: one row, which says that the batch is complete.

Each starts from what the batches before it have left and replaces its own folder, so a batch that runs again gives the
same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.histogram import merged
from sluiceway.functions.json_text import annotate_document, flag_document, with_variant
from sluiceway.operators.breaker import ORDER, circuit_breaker, transitions
from sluiceway.operators.incidents import breaker_incidents
from sluiceway.operators.metrics import COUNTERS, interval_counters, latency_histogram, latency_windows, seconds
from sluiceway.operators.rules import checkout_rules, judge
from sluiceway.operators.running import ROWS_PER_SLICE, running_sums
from sluiceway.schema import DLQ_TABLE, ERROR_THRESHOLD, MINIMUM_RECORDS
from sluiceway.session import configure, shared_folder
from sluiceway.sources.writers import write_routed
from sluiceway.streaming.tables import BatchTable, latest_by

#: What the rules look at and the counters need, read from the parsed document.
FIELDS = {"order_id": "string", "amount": "decimal(18,2)", "tax_amount": "decimal(18,2)", "currency": "string", "country": "string",
          "payment_method": "string"}
INCIDENT = ("incident_id string, opened_at timestamp, severity string, rule_violated string, affected_node string, message string, "
            "resolved boolean, resolved_at timestamp")
COMMIT = "batch_id bigint, records_added bigint, main_records bigint, dlq_records bigint, late_records bigint, committed_at timestamp, watermark timestamp"


@dataclass(frozen=True)
class Pipeline:
    """Where a pipeline writes and how it judges. ``key_schema`` and ``order_schema`` declare the key and order columns in SQL."""

    root: str
    key_schema: str = ""
    order_schema: str = "event_ts timestamp, event_id bigint"
    probe: str = "tax_amount"
    threshold: float = ERROR_THRESHOLD
    min_records: int = MINIMUM_RECORDS
    rows_per_slice: int = ROWS_PER_SLICE
    interval: str = "1 minute"
    lateness: str = "10 minutes"
    ts: str = "event_ts"
    ingest: str = "ingest_ts"
    fold_every: int = 32

    @property
    def key(self) -> list[str]:
        return [c.split()[0] for c in self.key_schema.split(",") if c.strip()]

    @property
    def order(self) -> list[str]:
        return [c.split()[0] for c in self.order_schema.split(",") if c.strip()]

    def _schema(self, *parts: str) -> str:
        return ", ".join(filter(None, [self.key_schema, *parts]))

    def state(self) -> BatchTable:
        """Counters only grow, so the largest total of a key is its newest."""
        fold = latest_by(self.key, ["total", "failed"], "total")
        return BatchTable(f"{self.root}/state", self._schema("total bigint, failed bigint"), fold)

    def intervals(self) -> BatchTable:
        def fold(rows: DataFrame) -> DataFrame:
            return rows.groupBy("interval_start").agg(*[F.sum(c).alias(c) for c in COUNTERS], F.sum("bad_count").alias("bad_count"),
                                                      F.max("last").alias("last"))
        counters = ", ".join(f"{c} bigint" for c in (*COUNTERS, "bad_count"))
        return BatchTable(f"{self.root}/intervals", f"interval_start timestamp, {counters}, last struct<total:bigint,breaker_open:boolean>", fold)

    def latency(self) -> BatchTable:
        """Histograms add up, so a fold has at most as many rows as there are intervals and buckets."""
        return BatchTable(f"{self.root}/latency", "slice_start timestamp, bucket bigint, n bigint, total bigint, low bigint, high bigint",
                          lambda rows: rows.groupBy("slice_start", "bucket").agg(*merged()))

    def incidents(self) -> BatchTable:
        """What is resolved comes after what is not."""
        columns = [c.split()[0] for c in INCIDENT.split(", ")]
        fold = latest_by([*self.key, "incident_id"], columns[1:], "resolved")
        return BatchTable(f"{self.root}/incidents", self._schema(INCIDENT), fold)

    def open_incidents(self) -> BatchTable:
        return BatchTable(f"{self.root}/open_incidents", self._schema(self.order_schema))

    def commits(self) -> BatchTable:
        return BatchTable(f"{self.root}/commits", COMMIT, lambda rows: rows)


def typed(parsed: DataFrame, fields: dict[str, str] = FIELDS, doc: str = "doc") -> DataFrame:
    """The fields of the parsed document as columns; null where the key is absent or the value does not convert."""
    return parsed.withColumns({n: F.try_variant_get(doc, f"$['{n}']", kind) for n, kind in fields.items()})


def parse_messages(messages: DataFrame, settings: Pipeline) -> DataFrame:
    """The only place where text is parsed: adds the document ``doc`` and the anomaly flag ``bad``."""
    return with_variant(messages, "value", "doc").withColumn("bad", flag_document(F.col("doc"), F.col("value"), settings.probe))


def route_parsed(parsed: DataFrame, settings: Pipeline, carry=None, rules=None) -> DataFrame:
    """Parsed messages with route, counters, ``failure_reasons`` and, where diverted, the diversion keys in their text.

    The document goes through the breaker's shuffle beside its text; typed columns, rules and diversion keys read it there.
    """
    routed = circuit_breaker(parsed, order=settings.order, key=settings.key, threshold=settings.threshold,
                             min_records=settings.min_records, carry=carry, rows_per_slice=settings.rows_per_slice)
    judged = judge(typed(routed), checkout_rules() if rules is None else rules)
    text = F.when(F.col("breaker_open"), annotate_document(F.col("doc"), F.col("value"), F.col("error_rate"))).otherwise(F.col("value"))
    return judged.withColumn("value", text).drop("doc")


def _carried(batch: DataFrame, settings: Pipeline, batch_id: int) -> DataFrame:
    """Counters of the keys that occur in the batch; without a key one row, or none before the first batch."""
    state = settings.state().unmerged(batch.sparkSession, batch_id)
    if not settings.key:
        return settings.state().fold(state).where(F.col("total").isNotNull())
    here = batch.select(*[F.col(k).alias(f"__{k}") for k in settings.key]).distinct()
    match = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in settings.key]
    return settings.state().fold(state.join(here, match, "left_semi"))


def run_message_batch(messages: DataFrame, batch_id: int, settings: Pipeline, persist: bool = True) -> None:
    """One micro-batch of messages: key and order columns, ``value``, event and ingest time.

    The breaker looks at a batch several times; ``persist`` keeps the parsed messages for that, so each is read and parsed once.
    """
    spark, key = messages.sparkSession, settings.key
    shared_folder(spark)  # checkpoint() below needs one
    for table in (settings.state(), settings.intervals(), settings.latency(), settings.incidents(), settings.commits()):
        table.compact(spark, batch_id, settings.fold_every)
    parsed = parse_messages(messages, settings)
    if persist:
        parsed = parsed.persist()
    try:
        carried = _carried(parsed, settings, batch_id)
        carry = carried if key else next((r.asDict() for r in carried.collect()), {})
        write_routed(route_parsed(parsed, settings, carry), settings.root, batch_id)
        _write_state(carried, settings, batch_id)
    finally:
        if persist:
            parsed.unpersist()
    written = read_records(spark, settings, batch_id)
    settings.intervals().write(_interval_rows(written, settings), batch_id)
    settings.latency().write(latency_histogram(written, settings.interval, settings.ts, settings.ingest), batch_id)
    _write_incidents(written, settings, batch_id)
    settings.commits().write(_commit_row(written, settings, batch_id), batch_id)


def _write_state(carried: DataFrame, settings: Pipeline, batch_id: int) -> None:
    """A row for each key that the batch has touched: what was carried and what has been written since."""
    key, written = settings.key, read_records(carried.sparkSession, settings, batch_id)
    added = written.select(*key, F.lit(1).cast("bigint").alias("total"), F.col("bad").cast("bigint").alias("failed"))
    after = carried.unionByName(added).groupBy(*key).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"))
    settings.state().write(after, batch_id)


def read_records(spark: SparkSession, settings: Pipeline, batch_id: int | None = None) -> DataFrame:
    """The written records, of one batch or of all complete ones."""
    columns = ", ".join(filter(None, [settings.key_schema, settings.order_schema, f"{settings.ingest} timestamp, value string, bad boolean, total bigint, "
                        "failed bigint, error_rate double, breaker_open boolean, amount decimal(18,2), tax_amount decimal(18,2), "
                        "failure_reasons array<string>, route string"]))
    if batch_id is not None:
        return spark.read.schema(columns).parquet(f"{settings.root}/events/batch_id={batch_id}")
    rows = spark.read.schema(f"{columns}, batch_id bigint").parquet(f"{settings.root}/events")
    return rows.join(settings.commits().read(spark).select("batch_id"), "batch_id", "left_semi")


def _interval_rows(written: DataFrame, settings: Pipeline) -> DataFrame:
    last = F.max(F.struct("total", "breaker_open")).alias("last")
    return written.groupBy(F.window(settings.ts, settings.interval).alias("w")).agg(*interval_counters(), F.count_if("bad").alias("bad_count"), last).select(
        F.col("w.start").alias("interval_start"), *COUNTERS, "bad_count", "last")


def _write_incidents(written: DataFrame, settings: Pipeline, batch_id: int) -> None:
    """Open incidents come in as the openings they were; whatever the batch adds is paired with them."""
    spark, key, order = written.sparkSession, settings.key, settings.order
    still = settings.open_incidents()
    before = still._read(spark, [f"{still.path}/batches/batch_id={batch_id - 1}"] if batch_id else [])
    changes = transitions(written, threshold=settings.threshold, min_records=settings.min_records).select(*key, *order, "opened").checkpoint()
    opened = before.withColumn("opened", F.lit(True))
    found = breaker_incidents(opened.unionByName(changes), order, key, threshold=settings.threshold, at_column="at").checkpoint()
    old = before.select(*key, F.struct(*order).alias("at"))
    match = [F.col(f"found.{k}").eqNullSafe(F.col(f"old.{k}")) for k in (*key, "at")]
    changed = found.alias("found").where("resolved").unionByName(
        found.where("NOT resolved").alias("found").join(old.alias("old"), match, "left_anti"))
    settings.incidents().write(changed.drop("at"), batch_id)
    still.write(found.where("NOT resolved").select(*key, "at.*"), batch_id)


def _watermark(spark: SparkSession, settings: Pipeline, before: int | None) -> Column:
    """How far event time has come, less ``lateness``, in the commits of the batches before."""
    return settings.commits().unmerged(spark, before).agg(F.max("watermark")).scalar()


def _commit_row(written: DataFrame, settings: Pipeline, batch_id: int) -> DataFrame:
    passed = settings.commits().unmerged(written.sparkSession, batch_id).agg(F.max("watermark")).first()[0]
    due = F.window(settings.ts, settings.interval)["end"] <= F.lit(passed).cast("timestamp")
    return written.withColumn("due", due).agg(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.count(F.lit(1)).alias("records_added"),
        F.count_if(F.col("route") != DLQ_TABLE).alias("main_records"), F.count_if(F.col("route") == DLQ_TABLE).alias("dlq_records"),
        F.count_if("due").alias("late_records"), F.max(settings.ingest).alias("committed_at"),
        (F.max(settings.ts) - F.expr(f"INTERVAL {settings.lateness}")).alias("watermark"))


def read_intervals(spark: SparkSession, settings: Pipeline) -> DataFrame:
    """One row per interval over all batches, as ``metrics_by_interval`` gives it, with ``final``: the watermark has passed it.

    No record is left out: one that comes late changes the row of its interval, and is counted in its batch's commit.
    """
    rows = settings.intervals().read(spark)
    width = F.expr(f"INTERVAL {settings.interval}")
    return rows.select(
        "interval_start", *COUNTERS, (F.col("incoming") / seconds(settings.interval)).alias("throughput"),
        (F.col("invalid_events") * 100.0 / F.col("incoming")).alias("error_rate"), F.col("last.breaker_open").alias("breaker_open"),
        F.coalesce(F.col("interval_start") + width <= _watermark(spark, settings, None), F.lit(False)).alias("final"))


def read_windows(spark: SparkSession, settings: Pipeline, width: str = "5 minutes") -> DataFrame:
    """Sliding windows of ``width``, one per interval, out of the intervals' counters."""
    rows = settings.intervals().read(spark)
    return (
        rows.groupBy(F.window("interval_start", width, settings.interval).alias("w")).agg(*[F.sum(c).alias(c) for c in COUNTERS])
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *COUNTERS,
                F.coalesce(F.col("w.end") <= _watermark(spark, settings, None), F.lit(False)).alias("final"))
    )


def read_latency(
    spark: SparkSession, settings: Pipeline, width: str = "5 minutes", quantiles: Sequence[float] = (0.5, 0.95, 0.99),
) -> DataFrame:
    """Mean, maximum and quantiles of ingest delay in sliding windows of ``width``, one per interval, over all batches."""
    return latency_windows(settings.latency().read(spark), width, settings.interval, quantiles)


def read_commits(spark: SparkSession, settings: Pipeline) -> DataFrame:
    """The snapshot log from the commit rows alone: what each batch added, running total, and which one is current."""
    commits = settings.commits().read(spark)
    counted = running_sums(commits, {"total_records": F.col("records_added"), "commit_count": F.lit(1)}, ["batch_id"])
    return counted.select(
        F.concat(F.lit("snap-"), F.col("batch_id").cast("string")).alias("snapshot_id"),
        (F.col("batch_id") == commits.agg(F.max("batch_id")).scalar()).alias("current"), F.lit("append").alias("operation"),
        "records_added", "total_records", "main_records", "dlq_records", "late_records", "committed_at", "commit_count")


def start_pipeline(messages: DataFrame, settings: Pipeline, checkpoint: str, available_now: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """Run the pipeline on a stream of messages; progress and restarts are kept in ``checkpoint``."""
    configure(messages.sparkSession)
    writer = messages.writeStream.foreachBatch(lambda df, n: run_message_batch(df, n, settings)).option("checkpointLocation", checkpoint)
    return writer.trigger(**({"availableNow": True} if available_now else {"processingTime": interval})).start()
