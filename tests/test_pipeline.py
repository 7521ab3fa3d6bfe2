"""The message pipeline: replays, incidents across batches, small state, folded tables, late records."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.plans.checkout import checkout_events
from sluiceway.streaming import pipeline
from sluiceway.streaming.pipeline import Pipeline
from sluiceway.streaming.tables import BatchTable, latest_by

SF_DIR = "/root/testdata/sf0.001"
MESSAGE = "event_id bigint, event_ts timestamp, ingest_ts timestamp, user_id bigint, value string"


def messages(spark):
    return checkout_events(spark, SF_DIR).select(
        "event_id", F.col("event_ts").cast("timestamp"), F.col("ingest_ts").cast("timestamp"), F.col("user_id").cast("bigint"), "value")


def made(spark, rows):
    """(event_id, minute, user, good) as messages; ``ingest`` is a second later."""
    out = [(i, 1_700_000_040 + 60 * m, u, '{"amount":1.00,"tax_amount":0.08}' if good else '{"amount":1.00,"tax_amount":null}') for i, m, u, good in rows]
    plain = spark.createDataFrame(out, "event_id bigint, at bigint, user_id bigint, value string")
    return plain.select("event_id", F.timestamp_seconds("at").alias("event_ts"), F.timestamp_seconds(F.col("at") + 1).alias("ingest_ts"), "user_id", "value")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def snapshot(spark, settings):
    return [rows(f) for f in (pipeline.read_records(spark, settings).select("event_id", "total", "failed", "route", "value", "failure_reasons", "batch_id"),
                              settings.state().unmerged(spark), pipeline.read_intervals(spark, settings), settings.incidents().read(spark),
                              pipeline.read_commits(spark, settings))]


def test_replays_and_empty_batches_leave_the_same_tables(spark, folder):
    settings = Pipeline(folder, fold_every=2)
    parts = [messages(spark).where("event_id < 0"), *(messages(spark).where(f"event_id >= {a} AND event_id < {b}") for a, b in ((0, 300), (300, 301), (301, 301), (301, 1000)))]
    for n, part in enumerate(parts):
        pipeline.run_message_batch(part, n, settings)
        if n in (2, 4):
            before = snapshot(spark, settings)
            pipeline.run_message_batch(part, n, settings, persist=n == 2)
            assert snapshot(spark, settings) == before
    whole = Pipeline(f"{folder}/whole")
    pipeline.run_message_batch(messages(spark), 0, whole)
    columns = ["event_id", "total", "failed", "route", "value", "failure_reasons"]
    assert rows(pipeline.read_records(spark, settings).select(*columns)) == rows(pipeline.read_records(spark, whole).select(*columns))
    assert rows(pipeline.read_intervals(spark, settings)) == rows(pipeline.read_intervals(spark, whole))
    assert rows(settings.incidents().read(spark)) == rows(whole.incidents().read(spark))
    assert settings.state().read(spark).collect()[0][:] == (1000, 22)
    assert [(r.snapshot_id, r.records_added, r.total_records, r.current) for r in pipeline.read_commits(spark, settings).orderBy("commit_count").collect()] == [
        ("snap-0", 0, 0, False), ("snap-1", 300, 300, False), ("snap-2", 1, 301, False), ("snap-3", 0, 301, False), ("snap-4", 699, 1000, True)]


def test_an_unfinished_batch_is_not_read(spark, folder):
    settings = Pipeline(folder)
    pipeline.run_message_batch(messages(spark).where("event_id < 100"), 0, settings)
    pipeline.write_routed(pipeline.route_parsed(pipeline.parse_messages(messages(spark).where("event_id >= 100"), settings), settings), folder, 1)
    assert pipeline.read_records(spark, settings).count() == 100
    pipeline.run_message_batch(messages(spark).where("event_id >= 100"), 1, settings)
    assert pipeline.read_records(spark, settings).count() == 1000


def test_an_incident_opens_in_one_batch_and_closes_in_another(spark, folder):
    settings = Pipeline(folder, key_schema="user_id bigint", min_records=2, threshold=0.3)
    batches = [[(0, 0, 1, True), (1, 1, 1, False), (2, 1, 2, False), (3, 2, 2, False), (4, 2, None, False), (5, 3, None, False)],
               [(6, 4, 1, True)], [(7, 5, 1, True), (8, 6, 2, False)], [(9, 7, 1, True), (10, 8, 1, False)]]
    seen = []
    for n, batch in enumerate(batches):
        pipeline.run_message_batch(made(spark, batch), n, settings)
        seen.append(sorted((r.user_id or 0, r.resolved) for r in settings.incidents().read(spark).collect()))
    # User 1: 1/2 opens, 1/3 stays, 1/4 closes, 2/6 opens again.
    assert seen == [[(0, False), (1, False), (2, False)]] * 2 + [[(0, False), (1, True), (2, False)], [(0, False), (1, False), (1, True), (2, False)]]
    once = Pipeline(f"{folder}/once", key_schema="user_id bigint", min_records=2, threshold=0.3)
    pipeline.run_message_batch(made(spark, [r for b in batches for r in b]), 0, once)
    assert rows(settings.incidents().read(spark)) == rows(once.incidents().read(spark))


def test_three_records_write_three_rows_of_state(spark, folder):
    settings = Pipeline(folder, key_schema="user_id bigint")
    many = spark.range(100_000).select(F.col("id").alias("user_id"), F.lit(7).cast("bigint").alias("total"), F.lit(1).cast("bigint").alias("failed"))
    settings.state().write(many, 0)
    settings.open_incidents().write(spark.createDataFrame([], "user_id bigint, event_ts timestamp, event_id bigint"), 0)
    pipeline.run_message_batch(made(spark, [(1, 0, 5, True), (2, 0, 6, False), (3, 1, None, False)]), 1, settings)
    written = spark.read.parquet(f"{folder}/state/batches/batch_id=1")
    assert rows(written.select("user_id", "total", "failed")) == rows(spark.createDataFrame([(5, 8, 1), (6, 8, 2), (None, 1, 1)], "a long, b long, c long"))
    assert settings.state().read(spark).count() == 100_001


def test_late_records_change_their_interval_and_are_counted(spark, folder):
    settings = Pipeline(folder, lateness="2 minutes")
    pipeline.run_message_batch(made(spark, [(k, k, 1, True) for k in range(6)]), 0, settings)
    pipeline.run_message_batch(made(spark, [(10, 0, 1, False), (11, 5, 1, True), (12, 20, 1, True)]), 1, settings)
    got = {r.interval_start.minute: (r.incoming, r.null_tax_count, r.final) for r in pipeline.read_intervals(spark, settings).collect()}
    first = min(r.event_ts for r in made(spark, [(0, 0, 1, True)]).collect()).minute
    assert got[first] == (2, 1, True) and got[(first + 5) % 60] == (2, 0, True) and got[(first + 20) % 60] == (1, 0, False)
    assert [r.late_records for r in pipeline.read_commits(spark, settings).orderBy("commit_count").collect()] == [0, 1]
    assert pipeline.read_windows(spark, settings, "5 minutes").agg(F.sum("incoming")).first()[0] == 9 * 5


def test_the_text_is_parsed_once(spark, folder):
    settings = Pipeline(folder)
    parsed = pipeline.parse_messages(messages(spark), settings).persist()
    plan = pipeline.route_parsed(parsed, settings)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.replace("InMemoryRelation", "\x00").split("\x00")[0]
    assert "parse_json" not in above and "variant" in above.lower()
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation") == 1
    parsed.unpersist()


def test_folding_keeps_what_the_batch_before_has_read(spark, folder):
    table = BatchTable(f"{folder}/t", "k bigint, total bigint, failed bigint", latest_by(["k"], ["total", "failed"], "total"))
    for n in range(9):
        table.compact(spark, n, 2)
        first = rows(table.read(spark, n))
        table.write(spark.createDataFrame([(n % 3, n + 1, n)], "k bigint, total bigint, failed bigint"), n)
        table.compact(spark, n, 2)
        assert rows(table.read(spark, n)) == first
    assert rows(table.read(spark)) == [(0, 7, 6), (1, 8, 7), (2, 9, 8)]
    schema = T.StructType([T.StructField("k", T.LongType())])
    assert BatchTable(f"{folder}/none", schema.simpleString()[7:-1].replace(":", " ")).read(spark).collect() == []
