"""Sinks, replay, audit, alerts, models and streams."""

import collections
import datetime
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from logharbor.operators import alerts, audit, encryption, features, metrics, patterns, reports, sinks
from logharbor.specs import FIREWALL, AlertCondition
from logharbor.streaming import ingest
from logharbor.streaming.alerts import EVENTS, alert_events, alert_writer, append_alerts

START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


# ---- sinks ---------------------------------------------------------------------------------------


def routed(spark, n, day=0):
    rows = [(i, at(day * 86400 + i), f"10.0.0.{i % 9}") for i in range(n)]
    return spark.createDataFrame(rows, "n int, TimeGenerated timestamp, SourceIP string")


def test_routed_files_are_gzip_partitioned_and_bounded(spark, tmp_path):
    sinks.write_routed(routed(spark, 2500).coalesce(1), str(tmp_path), FIREWALL, rows_per_file=FIREWALL.batch_size)
    files = sorted(tmp_path.glob("table_name=Custom_Firewall_CL/day=2024-01-01/*.json.gz"))
    assert len(files) == 3
    assert spark.read.json(str(tmp_path)).count() == 2500


def test_rebalanced_write_makes_one_file_per_small_day(spark, tmp_path):
    rows = routed(spark, 50).unionByName(routed(spark, 50, 1)).repartition(8)
    sinks.write_routed(rows, str(tmp_path), FIREWALL, rebalance=True)
    assert len(list(tmp_path.glob("table_name=*/day=*/*.json.gz"))) == 2


def test_expired_days_are_removed(spark, tmp_path):
    for day in (0, 40, 100):
        sinks.write_routed(routed(spark, 3, day), str(tmp_path), FIREWALL)
    removed = sinks.expire_partitions(spark, str(tmp_path), "2024-04-20T00:00:00", 90)
    assert [r.rsplit("=", 1)[1] for r in removed] == ["2024-01-01"]
    assert spark.read.json(str(tmp_path)).count() == 6


def dead_rows(spark, n):
    rows = [("t", at(i), i, f"boom {i}", "validation_error", (i, "ok" if i % 3 else "bad", "a@b.co")) for i in range(n)]
    schema = (
        "table_name string, failed_at timestamp, id int, error string, error_category string, "
        "record struct<id:int,state:string,note:string>"
    )
    return spark.createDataFrame(rows, schema)


def test_dead_letters_are_batched_and_redacted(spark, small_groups):
    batches = sinks.dead_letter_batches(dead_rows(spark, 25), 10, ["failed_at", "id"], F.col("id").cast("string"))
    got = sorted(batches.collect(), key=lambda r: r.batch_no)
    assert [r.record_count for r in got] == [10, 10, 5]
    assert [d.id for r in got for d in r.data] == list(range(25))
    assert got[0].data[0].note == "[REDACTED:EMAIL]"
    assert got[0].batch_id == hashlib.md5(",".join(map(str, range(10))).encode()).hexdigest()


def test_replay_archives_what_passes(spark, tmp_path):
    batches = sinks.dead_letter_batches(dead_rows(spark, 9), 1, ["failed_at", "id"], F.col("id").cast("string"))
    batches.write.parquet(str(tmp_path / "dlq"))

    def reroute(records):
        rows = records.withColumn("TimeGenerated", F.lit(START).cast("timestamp"))
        return rows.withColumn("reason", F.when(F.col("state") == "bad", "still bad"))

    folders = [str(tmp_path / name) for name in ("dlq", "archive", "routed")]
    for _ in range(2):  # a repeated run changes nothing
        summary = sinks.replay_folder(spark, *folders, FIREWALL, reroute, "7")
        assert tuple(summary.first()) == (9, 6, 3)
        assert spark.read.parquet(str(tmp_path / "archive" / "batches")).count() == 6
        assert spark.read.parquet(str(tmp_path / "dlq_left")).count() == 3
        assert spark.read.json(str(tmp_path / "routed")).count() == 6


def test_backlog_of_nothing(spark):
    empty = spark.createDataFrame([], "failed_at timestamp")
    assert tuple(sinks.backlog(empty, "2024-01-01T00:00:00").first()) == (0, 0.0)


# ---- audit ---------------------------------------------------------------------------------------


def test_hash_is_that_of_the_sorted_json(spark):
    events = [
        ("2024-01-01T00:00:00", "login", "ünal ☃ \U0001f600", 'a"b\\c\td\x7f', "r/1", "success", {"z": "1", "a": "é"}, None),
        ("2024-01-01T00:00:01", "read", "bob", "", "r", "failure", {}, "10.0.0.1"),
    ]
    names = ["timestamp", "event_type", "user", "action", "resource", "status", "details", "source_ip"]
    schema = ", ".join(f"{n} {'map<string,string>' if n == 'details' else 'string'}" for n in names)
    stamped = audit.stamp(spark.createDataFrame(events, schema))
    for row in stamped.collect():
        event = {n: row[n] for n in names} | {"correlation_id": None}
        assert row.hash == hashlib.sha256(json.dumps(event, sort_keys=True).encode()).hexdigest()
    lines = stamped.select(audit.to_lines(stamped, F.col("timestamp")).alias("line"))
    assert audit.tampered_lines(lines).count() == 0
    assert audit.tampered_lines(lines.withColumn("line", F.replace("line", F.lit("bob"), F.lit("eve")))).count() == 1


# ---- alerts and metrics --------------------------------------------------------------------------

CONDITION = AlertCondition("hot", "load", 5.0, "gt", 60, "critical")


def samples(n=400, seed=5):
    rng = random.Random(seed)
    second, level, out = 0, 0, []
    for i in range(n):
        second += rng.choice([30, 31, 45, 90])
        if rng.random() < 0.2:
            level = rng.choice([0, 10])
        out.append((i, "s1", "load", at(second), float(level)))
    return out


def followed(rows):
    """Fired and resolved events by walking the samples."""
    since = fired = None
    events = []
    for _, _, _, ts, value in rows:
        if value > CONDITION.threshold:
            since = since or ts
            if fired is None and (ts - since).total_seconds() >= CONDITION.duration:
                fired = ts
                events.append(("fired", ts))
        else:
            if fired is not None:
                events.append(("resolved", ts))
            since = fired = None
    return sorted(events)


SAMPLES = "event_id long, series string, name string, ts timestamp, value double"


def test_episodes_follow_the_samples(spark, small_groups):
    judged = alerts.apply_conditions(spark.createDataFrame(samples(), SAMPLES), [CONDITION])
    got = alerts.alert_episodes(judged, ["series"], "event_id").collect()
    events = [("fired", r.fired_at) for r in got] + [("resolved", r.resolved_at) for r in got if r.resolved_at]
    assert sorted(events) == followed(samples())


def streamed(spark, path, rows, parts, **options):
    """Events of a stream over `parts` files, one micro-batch each."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        chunk = spark.createDataFrame(rows[k * size : k * size + size], SAMPLES).coalesce(1)
        chunk.write.mode("append").parquet(str(path / "in"))
    stream = spark.readStream.schema(SAMPLES).option("maxFilesPerTrigger", 1).parquet(str(path / "in"))

    def keep(df, epoch):
        append_alerts(df, epoch, str(path / "out"))

    query = (
        alert_events(stream, [CONDITION], "event_id", **options).writeStream.foreachBatch(keep)
        .option("checkpointLocation", str(path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return sorted((r.event, r.ts) for r in spark.read.parquet(str(path / "out")).collect()), dropped


def test_streamed_events_are_those_of_the_batch_job_in_spite_of_disorder(spark, tmp_path):
    rows = samples()
    rng = random.Random(2)
    # up to nine minutes out of place, over the files too; a last sample lets the watermark pass the others
    mixed = sorted(rows, key=lambda r: (r[3] + datetime.timedelta(seconds=rng.randrange(540)), r[0]))
    last = (9999, "s1", "other", rows[-1][3] + datetime.timedelta(hours=1), 0.0)
    assert mixed != rows
    flush = (10000, "s2", "load", last[3], 0.0)
    got, dropped = streamed(spark, tmp_path, [*mixed, last, flush], 5)
    assert got == followed(rows) and dropped == 0


def test_samples_behind_the_watermark_are_counted(spark, tmp_path):
    times = [(0, "s1", 9.0), (7200, "s1", 0.0), (7300, "s2", 0.0), (60, "s1", 9.0), (9000, "s2", 0.0)]
    rows = [(k, series, "load", at(second), value) for k, (second, series, value) in enumerate(times)]
    got, dropped = streamed(spark, tmp_path, rows, 5)
    assert got == [] and dropped == 1


def test_looking_once_per_interval_is_the_same_in_batch_and_stream(spark, tmp_path):
    rows = samples()
    frame = spark.createDataFrame(rows, SAMPLES)
    checked = alerts.last_per_check(frame, ["series", "name"], "event_id", "2 minutes")
    judged = alerts.apply_conditions(checked, [CONDITION])
    episodes = alerts.alert_episodes(judged, ["series"], "event_id").collect()
    want = [("fired", r.fired_at) for r in episodes] + [("resolved", r.resolved_at) for r in episodes if r.resolved_at]
    flush = (10000, "s1", "load", rows[-1][3] + datetime.timedelta(hours=1), float(rows[-1][4]))
    got, _ = streamed(spark, tmp_path, [*rows, flush], 3, check="2 minutes")
    assert got == sorted(want)


def test_notifications_repeat_no_sooner_than_two_hours(spark):
    rows = [("a", "high", at(s)) for s in (0, 60, 400, 7100, 7300, 9000, 20000)]
    df = spark.createDataFrame(rows, "alert string, severity string, ts timestamp")
    got = alerts.alert_notifications(df, ["alert", "severity"]).orderBy("notified_at").collect()
    assert [((r.notified_at - START).total_seconds(), r.alerts) for r in got] == [(0, 2), (7200, 1), (19800, 1)]


def test_notifications_of_a_long_history(spark):
    """Ten years of alerts every 65 minutes in one group, against a walk over them; a second group with gaps."""
    n = 10 * 365 * 86400 // 3900
    first = spark.range(n).select(F.lit("a").alias("g"), F.timestamp_seconds(F.lit(1_700_000_100) + F.col("id") * 3900).alias("ts"))
    second = spark.createDataFrame([(None, at(s)) for s in (0, 10, 7199, 7300, 14500, 90000)], "g string, ts timestamp")
    df = first.unionByName(second)
    got = {}
    for r in alerts.alert_notifications(df, ["g"]).collect():
        got.setdefault(r.g, []).append(r.notified_at)
    for group in ("a", None):
        ticks = sorted({r.ts.replace(minute=r.ts.minute // 5 * 5, second=0) for r in df.where(F.col("g").eqNullSafe(group)).collect()})
        want = []
        for tick in ticks:
            if not want or tick >= want[-1] + datetime.timedelta(hours=2):
                want.append(tick)
        assert sorted(got[group]) == want


def test_heavy_patterns_are_bounded(spark):
    """Many more patterns than counters: bounds hold, and no pattern above the share is missed."""
    rows = [f"p{k}" for k in range(30) for _ in range(3 * k)] + [f"rare{k}" for k in range(3000)]
    random.Random(4).shuffle(rows)
    exact = collections.Counter(rows)
    hashed = spark.createDataFrame([(p,) for p in [*rows, None]], "pattern string").repartition(5)
    summary = patterns.pattern_summary(hashed, counters=60)
    assert summary.count() <= 5 * 61
    slack = summary.where("pattern is null").agg(F.sum("slack"), F.sum("counted")).first()
    assert slack[0] <= len(rows) / 60 and slack[1] == len(rows)
    for share in (None, 0.015):
        bounds = {r.pattern: (r.at_least, r.at_most) for r in patterns.heavy_patterns(summary, share).collect()}
        assert all(low <= exact[p] <= high for p, (low, high) in bounds.items())
        assert all(p in bounds for p, count in exact.items() if count > (slack[0] if share is None else share * len(rows)))
    assert patterns.heavy_patterns(patterns.pattern_summary(hashed.limit(0))).count() == 0


def test_a_rotation_that_was_stopped_anywhere_is_repeated(spark, tmp_path):
    root, (old, new) = str(tmp_path / "t"), (F.unhex(F.sha2(F.lit(k), 256)) for k in "ab")
    plain = spark.createDataFrame([(i, f"v{i}" if i % 9 else None) for i in range(200)], "id int, secret string")
    encryption.create_versioned(plain, root, ["secret"], old, ["id"], parts=5)

    def opened(key):
        rows = encryption.decrypt_columns(encryption.read_versioned(spark, root), ["secret"], key).collect()
        return sorted((r.id, r.secret, r.key_version) for r in rows)

    want = sorted((r.id, r.secret) for r in plain.collect())
    assert not encryption.rotate_versioned(spark, root, ["secret"], old, new, at_once=2)
    # a part that was written but not noted is written again
    spark.createDataFrame([(1, "half", 2)], "id int, secret string, key_version int").write.parquet(f"{root}/data/version=2/part=4")
    assert opened(old) == [(*r, 1) for r in want]
    assert not encryption.rotate_versioned(spark, root, ["secret"], old, new, at_once=1)
    assert encryption.rotate_versioned(spark, root, ["secret"], old, new)
    assert encryption.current_version(spark, root) == 2 and opened(new) == [(*r, 2) for r in want]


def test_quantile_of_buckets(spark):
    values = [0.05, 0.3, 0.7, 1.5, 3.0, 4.0, 7.0, 8.0, 9.0, 50.0]
    df = spark.createDataFrame([("a", v) for v in values], "k string, value double")
    buckets = metrics.bucket_counts(df, ["k"])
    quantiles = {q: metrics.histogram_quantile(buckets, ["k"], q).first()["quantile"] for q in (0.5, 0.95)}
    assert quantiles == {0.5: 3.5, 0.95: 10.0}


def test_error_categories(spark):
    rows = [
        ("HttpResponseError", "x", 503, "azure_error:503"),
        ("AzureError", "x", None, "azure_error:unknown"),
        ("OSError", "read Timeout", None, "network_timeout"),
        ("ConnectionError", "x", None, "network_connection"),
        ("CircuitBreakerOpenError", "x", None, "circuit_breaker_open"),
        ("ValueError", "x", None, "validation_error"),
        ("KeyError", "x", None, "unknown_error:KeyError"),
    ]
    df = spark.createDataFrame(rows, "error_type string, message string, status_code int, want string")
    assert all(r.error_category == r.want for r in reports.categorise(df).collect())


# ---- features ------------------------------------------------------------------------------------


def test_features_of_a_row(spark):
    df = spark.createDataFrame([("2024-01-06T10:00:00", "disk is full", "error", "app", None)], "timestamp string, message string, level string, source string, type string")
    row = features.extract_features(df, features.default_extractors("2024-01-01T00:00:00"), []).first()
    assert (row.hour, row.day_of_week, row.is_weekend, row.is_business_hours) == (10.0, 5.0, 1.0, 1.0)
    assert (row.message_length, row.word_count, row.has_error_level) == (12.0, 3.0, 1.0)
    assert (row.level_score, row.source_length, row.type_length) == (3.0, 3.0, 7.0)


def test_constant_features_scale_to_zero_and_do_not_correlate(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.0)], "a double, b double, c double")
    scaled = features.scale(df, ["a", "b"], features.scaler_state(df, ["a", "b"])).orderBy("a").collect()
    assert [r.b for r in scaled] == [0.0, 0.0, 0.0] and abs(scaled[2].a - 1.224745) < 1e-6
    got = features.strong_correlations(df, ["a", "b", "c"]).collect()
    assert [(r.pair, round(r.correlation, 6)) for r in got] == [("a_c", 1.0)]


def test_repeating_sequences(spark, small_groups):
    rows = [(i, "k", at(i), "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, item string")
    got = patterns.repeat_sequences(df, ["k"], ["ts", "id"], F.col("item"), repeats=10).collect()
    # 36 windows alternate between two patterns; each is over the limit from its 11th occurrence on
    assert sorted((r.start_idx, r.frequency) for r in got) == [(i, i // 2 + 1) for i in range(20, 36)]


def test_triage_and_order(spark):
    rows = [(1, 0.9, False, 1), (2, 0.9, True, 0), (3, 0.5, False, 9), (4, 0.9, False, 3), (5, 0.9, False, 1)]
    df = spark.createDataFrame(rows, "id int, priority double, is_anomaly boolean, frequency int")
    assert [r.id for r in patterns.priority_order(df, ["id"]).collect()] == [2, 4, 1, 5, 3]
    got = {r.id: r.processing_priority for r in patterns.triage(df).collect()}
    assert got == {1: "high", 2: "critical", 3: "normal", 4: "high", 5: "high"}


# ---- streaming -----------------------------------------------------------------------------------


def test_a_repeated_epoch_is_written_once(spark, tmp_path):
    paths = ingest.IngestPaths.under(str(tmp_path))
    df = spark.createDataFrame([(1, None), (2, "bad")], "n int, reason string")
    for _ in range(2):
        ingest.route_batch(df, 0, paths, FIREWALL, ingest.default_category, ingest.write_batch)
    assert [r.n for r in ingest.read_routed(spark, paths).collect()] == [1]
    assert [r.n for r in ingest.read_routed(spark, paths, "quarantined").collect()] == [2]
    counts = {r["name"]: r.value for r in ingest.progress_metrics(spark, paths).collect()}
    assert (counts["input_rows"], counts["quarantined_rows"], counts["failed"]) == (2.0, 1.0, 0.0)


def test_a_failed_write_keeps_every_row_and_the_whole_error(spark, tmp_path):
    paths = ingest.IngestPaths.under(str(tmp_path))
    df = spark.createDataFrame([(1, at(0), None), (2, at(1), "bad")], "n int, ProcessingTime timestamp, reason string")

    def broken(rows, path):
        raise TimeoutError("x" * 900)

    ingest.route_batch(df, 3, paths, FIREWALL, ingest.default_category, broken)
    dead = spark.read.parquet(paths.dead_letters).first()
    assert (len(dead.error), dead.error_category, dead.record_count) == (900, "network_timeout", 1)
    assert [(r.n, r.reason) for r in spark.read.parquet(paths.quarantine).collect()] == [(2, "bad")]
    assert {r["name"]: r.value for r in ingest.progress_metrics(spark, paths).collect()}["failed"] == 1.0


def test_progress_covers_batches_that_spark_has_forgotten(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(6):
        (tmp_path / "in" / f"{k}.txt").write_text(f"{k}\n")
    paths = ingest.IngestPaths.under(str(tmp_path))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
        ingest.start_ingest(lines, lambda df: df.withColumn("reason", F.lit(None).cast("string")), FIREWALL, paths).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    rows = ingest.progress_metrics(spark, paths).where("name = 'input_rows'")
    assert (rows.count(), rows.agg(F.sum("value")).first()[0]) == (6, 6.0)


def test_ties_do_not_depend_on_the_order_of_the_input(spark):
    rows = [("a", at(0), 1.0, k) for k in range(6)] + [("b", at(0), 2.0, k) for k in range(9, 3, -1)]
    schema = "k string, ts timestamp, value double, tie int"
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, schema).withColumn("value", F.col("value") + F.col("tie"))
        assert {r.k: r.value for r in metrics.latest_metrics(frame, ["k"], "tie").collect()} == {"a": 6.0, "b": 11.0}
        labels = patterns.cluster_table(spark.createDataFrame(order, schema), ["k", "value"], "ts", "tie")
        assert {r.k: r.cluster for r in labels.collect()} == {"a": 0, "b": 1}


def test_alert_handlers_see_what_was_written_and_may_fail(spark, tmp_path):
    seen = []

    def count(rows):
        seen.append(rows.count())

    def broken(rows):
        raise RuntimeError("no route")

    events = spark.createDataFrame([("a", "s", "high", "fired", at(0), 1.0)], EVENTS)
    write = alert_writer(str(tmp_path / "alerts"), [broken, count])
    for _ in range(2):
        write(events, 4)
    assert seen == [1, 1] and spark.read.parquet(str(tmp_path / "alerts")).count() == 1
    errors = spark.read.parquet(str(tmp_path / "alerts_errors")).collect()
    assert [(r.handler, r.error_type, r.error) for r in errors] == [("broken", "RuntimeError", "no route")]


def test_fractional_features_are_not_clustered_by_equality(spark):
    frame = spark.createDataFrame([(1, at(0), 0.5)] * 6, "id int, ts timestamp, x double")
    with pytest.raises(ValueError, match="whole-numbered"):
        patterns.cluster_table(frame, ["x"], "ts", "id")
