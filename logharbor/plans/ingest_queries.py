"""Sources, routing and table maintenance over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from logharbor.functions.tagging import accepted, rejected
from logharbor.operators import routing, sinks
from logharbor.plans.fixtures import AS_OF, firewall_lines, table, view, with_views
from logharbor.plans.registry import query
from logharbor.session import scratch_dir
from logharbor.sources import delimited, firewall, json_logs, json_splits, manifest
from logharbor.specs import FIREWALL, FIREWALL_STRICT, VPN, TableSpec


# ---- sources -------------------------------------------------------------------------------------

LISTING = """listing as (
  select url as "Key", strlen(html) as Size,
    timestamp '2024-01-01 00:00:00' + to_minutes(cast(page_id % 1440 as int)) as LastModified from pages)"""


def page_listing(spark, sf_dir):
    """Pages seen as objects of a store: url, size in bytes, time."""
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("Key"),
        F.octet_length("html").cast("bigint").alias("Size"),
        F.timestamp_add(
            "MINUTE", (F.col("page_id") % 1440).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")
        ).alias("LastModified"),
    )


@query(
    "manifest_filter",
    f"""with {LISTING}
select "Key", cast(Size as bigint) as Size, LastModified from listing
where Size > 0 and LastModified > timestamp '2024-01-01 01:00:00'
  and (lower("Key") like '%.html' or lower("Key") like '%#top')
  and not (lower("Key") like '%spam%' or lower("Key") like '%pills%')""",
)
def _(spark, sf_dir):
    return manifest.select_objects(
        page_listing(spark, sf_dir),
        newer_than="2024-01-01T01:00:00",
        extensions=(".html", "#TOP"),
        excluded=("spam", "pills"),
    )


def tagged_firewall(spark, sf_dir):
    return firewall.parse_firewall_lines(firewall_lines(spark, sf_dir), AS_OF)


@query(
    "firewall_ingest",
    with_views(
        "fw",
        f"""
select event_id, TimeGenerated, SourceIP, DestinationIP, lower(Action) as FirewallAction, RuleName,
  upper(Protocol) as Protocol, SourcePort, DestinationPort, BytesTransferred, 'Firewall' as LogSource,
  timestamp '{AS_OF.replace("T", " ")}' as ProcessingTime
from fw where event_id % 17 <> 0 and event_id % 19 <> 0""",
    ),
)
def _(spark, sf_dir):
    return accepted(tagged_firewall(spark, sf_dir)).drop("line")


@query(
    "firewall_quarantine",
    with_views(
        "fw",
        """
select event_id, case when event_id % 17 = 0 then 'bad_timestamp' else 'bad_integer:DestinationPort' end as reason
from fw where event_id % 17 = 0 or event_id % 19 = 0""",
    ),
)
def _(spark, sf_dir):
    return rejected(tagged_firewall(spark, sf_dir)).select("event_id", "reason")


@query(
    "firewall_valid",
    with_views(
        "fw",
        "select event_id, lower(Action) in ('allow','deny','drop') as valid from fw",
    ),
)
def _(spark, sf_dir):
    fw = view(spark, sf_dir, "fw")
    return fw.select(
        "event_id", firewall.is_valid_firewall_row(actions=("allow", "deny", "drop")).alias("valid")
    )


@query(
    "file_outcomes",
    with_views(
        "fw",
        """
select concat('fw/', cast(cast(TimeGenerated as date) as varchar), '.log') as path, count(*) as rows,
  count(*) filter (event_id % 17 = 0 or event_id % 19 = 0) as bad_rows,
  case when count(*) filter (event_id % 17 = 0 or event_id % 19 = 0) = 0 then 'successful' else 'failed' end as status
from fw group by 1""",
    ),
)
def _(spark, sf_dir):
    fw = view(spark, sf_dir, "fw").select("event_id", F.to_date("TimeGenerated").alias("day"))
    lines = firewall_lines(spark, sf_dir).join(fw, "event_id")
    lines = lines.withColumn("path", F.concat(F.lit("fw/"), F.col("day").cast("string"), F.lit(".log")))
    lines = lines.withColumn("size", F.octet_length("line").cast("bigint"))
    tagged = firewall.parse_firewall_lines(lines, AS_OF)
    return manifest.file_outcomes(tagged).select("path", "rows", "bad_rows", "status")


@query(
    "object_times",
    "select cast(event_id % 7 as varchar) as path, count(*) as rows, true as timed from events group by 1",
)
def _(spark, sf_dir):
    """How long the rows of an object took, and its bytes per second."""
    rows = manifest.clocked(table(spark, sf_dir, "events").select((F.col("event_id") % 7).cast("string").alias("path"), F.octet_length("props").cast("bigint").alias("size")))
    found = manifest.file_outcomes(rows.withColumn("reason", F.lit(None).cast("string")))
    seconds, rate = F.col("duration_seconds"), F.col("bytes_per_second")
    timed = (seconds >= 0) & F.when(seconds == 0, rate.isNull()).otherwise(F.abs(rate * seconds - F.col("bytes")) < 1e-6)
    return found.select("path", "rows", timed.alias("timed"))


@query(
    "json_array_ingest",
    """
select user_id % 5 as bucket, cast(json_extract(props, '$.k') as bigint) as k, count(*) as records
from events group by 1, 2""",
)
def _(spark, sf_dir):
    """Arrays of two thousand events, a file each, that several tasks read a part of."""
    folder = scratch_dir(spark, "json_array_ingest")
    note = F.lit(', "note": "a } in \\"text\\" {", "props": ')
    record = F.concat(F.lit('{"b": '), (F.col("user_id") % 5).cast("string"), note, F.coalesce("props", F.lit("null")), F.lit("}"))
    arrays = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 2000).alias("file")).agg(F.collect_list(record).alias("records"))
    content = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("]"))
    arrays.select("file", content.alias("value")).write.partitionBy("file").text(folder)
    width = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(width)
    spark.conf.set(width, "64k")
    try:
        records = json_splits.read_json_objects(spark, folder, large=1)
    finally:
        spark.conf.set(width, before)
    kept = records.select(F.variant_get("record", "$.b", "bigint").alias("bucket"), F.try_variant_get("record", "$.props.k", "bigint").alias("k"))
    return kept.groupBy("bucket", "k").agg(F.count("*").alias("records"))


@query(
    "outcome_summary",
    with_views(
        "fw",
        """
with files as (select cast(TimeGenerated as date) as day, count(*) filter (event_id % 17 = 0) as bad from fw group by 1)
select count(*) as total_files, count(*) filter (bad = 0) as successful_files, count(*) filter (bad > 0) as failed_files,
  count(*) * 100 as total_bytes, count(*) filter (bad = 0)::double / count(*) as success_rate from files""",
    ),
)
def _(spark, sf_dir):
    """Totals over one object of a hundred bytes per day."""
    reason = F.when(F.col("event_id") % 17 == 0, F.lit("bad"))
    rows = view(spark, sf_dir, "fw").select(F.to_date("TimeGenerated").cast("string").alias("path"), F.lit(100).cast("bigint").alias("size"), reason.alias("reason"))
    return manifest.outcome_summary(manifest.file_outcomes(rows))


@query(
    "expired_partitions",
    with_views(
        "fw",
        "select cast(TimeGenerated as date) as day, count(*) as rows from fw where TimeGenerated >= timestamp '2024-01-11 00:00:00' group by 1",
    ),
)
def _(spark, sf_dir):
    """Days left of a routed table after those older than twenty days are deleted."""
    path = scratch_dir(spark, "expired_partitions")
    sinks.write_routed(view(spark, sf_dir, "fw").select("TimeGenerated", "event_id"), path, FIREWALL, fmt="parquet")
    sinks.expire_partitions(spark, path, AS_OF, 20)
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("rows"))


@query(
    "json_ingest",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
where json_extract(props, '$.k') is not null""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("line"))
    schema = json_logs.JsonSchema(("k",), {"k": "integer"})
    rows = accepted(json_logs.parse_json_lines(lines, schema))
    return rows.select("event_id", F.variant_get("record", "$.k", "bigint").alias("k"))


@query(
    "json_quarantine",
    """
with shaped as (
  select event_id, case event_type when 'error' then substr(props, 1, 5)
    when 'signup' then '{"other": 1}' when 'view' then '{"k": "text"}'
    when 'click' then concat('{"k": 1, "a": [[[[', props, ']]]]}') else props end as line from events)
select event_id, case when substr(line, 1, 5) = line then 'invalid_json' when line like '%other%' then 'missing_field:k'
  when line like '%text%' then 'wrong_type:k' else 'too_deep' end as reason
from shaped join events using (event_id) where event_type <> 'purchase'""",
)
def _(spark, sf_dir):
    props, kind = F.col("props"), F.col("event_type")
    line = (
        F.when(kind == "error", F.substring(props, 1, 5))
        .when(kind == "signup", F.lit('{"other": 1}'))
        .when(kind == "view", F.lit('{"k": "text"}'))
        .when(kind == "click", F.concat(F.lit('{"k": 1, "a": [[[['), props, F.lit("]]]]}")))
        .otherwise(props)
    )
    lines = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    schema = json_logs.JsonSchema(("k",), {"k": "integer"})
    tagged = json_logs.parse_json_lines(lines, schema, max_depth=6)
    return rejected(tagged).select("event_id", "reason")


@query(
    "json_multiform_ingest",
    """
select user_id, cast(json_extract(props, '$.k') as bigint) as k, count(*) as records
from events group by 1, 2""",
)
def _(spark, sf_dir):
    """Objects of three layouts made from the events: array, one value per line, single value.

    An object holds rows of one user and hour, 500 at most, as a rotated log file would.
    """
    events = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    chunk = F.floor(F.col("event_id") / 500)
    parts = events.groupBy("user_id", hour.alias("hour"), chunk).agg(F.collect_list("props").alias("parts"))
    content = (
        F.when(F.size("parts") == 1, F.get("parts", F.lit(0)))
        .when(F.col("user_id") % 2 == 0, F.concat(F.lit("["), F.array_join("parts", ", "), F.lit("]")))
        .otherwise(F.concat(F.array_join("parts", "\n"), F.lit("\n{broken\n")))
    )
    objects = parts.select("user_id", content.alias("content"))
    records = json_logs.explode_json_objects(objects)
    return records.groupBy("user_id", F.variant_get("record", "$.k", "bigint").alias("k")).agg(
        F.count("*").alias("records")
    )


@query(
    "delimited_ingest",
    with_views(
        "fw",
        "select event_id, SourceIP as src_ip, DestinationIP as dst_ip, Action as action from fw",
    ),
)
def _(spark, sf_dir):
    fw = view(spark, sf_dir, "fw")
    separator = F.when(F.col("event_id") % 3 == 0, " | ").when(F.col("event_id") % 3 == 1, ", ").otherwise("  ")
    line = F.concat(
        "SourceIP", separator, "DestinationIP", separator, "Action", separator, F.col("SourcePort").cast("string")
    )
    return delimited.parse_delimited_lines(fw.select("event_id", line.alias("line")), ["src_ip", "dst_ip", "action"])


# ---- routing -------------------------------------------------------------------------------------

RAW_LOG = """raw_log as (
  select event_id, event_type, case when user_id % 10 = 0 then null else SourceIP end as src_ip, DestinationIP,
    Action as FirewallAction, Protocol as proto,
    case when DestinationPort = 53 then 'n/a' else cast(DestinationPort as varchar) end as dst_port,
    cast(BytesTransferred as varchar) as bytes, TimeGenerated as event_time
  from fw join events using (event_id))"""


def raw_log(spark, sf_dir):
    """Firewall rows under source names, some without a source address, some with a bad port."""
    fw = view(spark, sf_dir, "fw")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    port = F.col("DestinationPort").cast("string")
    return fw.join(events, "event_id").select(
        "event_id",
        "event_type",
        F.when(F.col("user_id") % 10 != 0, F.col("SourceIP")).alias("src_ip"),
        "DestinationIP",
        F.col("Action").alias("FirewallAction"),
        F.col("Protocol").alias("proto"),
        F.when(F.col("DestinationPort") == 53, "n/a").otherwise(port).alias("dst_port"),
        F.col("BytesTransferred").cast("string").alias("bytes"),
        F.date_format("TimeGenerated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
    )


def prepared(spark, sf_dir):
    return routing.prepare_rows(raw_log(spark, sf_dir), FIREWALL, AS_OF, keep=["event_id"])


REASON_SQL = """case when dst_port = 'n/a' then 'preparation_error:ValueError'
    when src_ip is null then 'missing_fields:SourceIP' end"""


@query(
    "field_mapping",
    with_views(
        "fw",
        f"""with {RAW_LOG}
select event_id, event_time as TimeGenerated, src_ip as SourceIP, DestinationIP, FirewallAction as Action,
  proto as Protocol, cast(null as int) as SourcePort, cast(dst_port as int) as DestinationPort,
  cast(bytes as bigint) as BytesTransferred, cast(null as varchar) as RuleName,
  'standard' as DataClassification, '1.0' as SchemaVersion
from raw_log where {REASON_SQL} is null""",
    ),
)
def _(spark, sf_dir):
    return accepted(prepared(spark, sf_dir))


@query(
    "field_mapping_strict",
    with_views(
        "fw",
        f"""with {RAW_LOG}
select event_id, event_time as TimeGenerated, src_ip as SourceIP, DestinationIP, FirewallAction as Action,
  cast(bytes as bigint) as BytesTransferred, 'restricted' as DataClassification, '1.0' as SchemaVersion
from raw_log where src_ip is not null""",
    ),
)
def _(spark, sf_dir):
    rows = routing.prepare_rows(raw_log(spark, sf_dir), FIREWALL_STRICT, AS_OF, "restricted", ["event_id"])
    return accepted(rows)


@query(
    "event_time_fallback",
    f"""
select event_id, case event_type when 'click' then timestamp '{AS_OF.replace("T", " ")}'
  else date_trunc('second', ts) end as TimeGenerated from events""",
)
def _(spark, sf_dir):
    """Times under three names, or absent, in different notations."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    log = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.when(kind == "error", F.date_format(ts, "MMM d yyyy HH:mm:ss")).alias("time"),
        F.when(kind.isin("purchase", "signup"), F.date_format(ts, "yyyy/MM/dd HH:mm:ss")).alias("event_time"),
    )
    spec = TableSpec("plain", "plain", "1.0", 30, 1000, (FIREWALL.fields[0],))
    return accepted(routing.prepare_rows(log, spec, AS_OF, keep=["event_id"])).select("event_id", "TimeGenerated")


@query(
    "type_coercion",
    with_views(
        "fw",
        f"""with {RAW_LOG}
select event_id, dst_port = 'n/a' as conv_error,
  case when dst_port <> 'n/a' then cast(dst_port as int) end as DestinationPort,
  cast(bytes as bigint) as BytesTransferred from raw_log""",
    ),
)
def _(spark, sf_dir):
    rows = prepared(spark, sf_dir)
    failed = F.coalesce(F.col("reason").startswith("preparation_error"), F.lit(False))
    return rows.select("event_id", failed.alias("conv_error"), "DestinationPort", "BytesTransferred")


@query(
    "drop_reasons",
    with_views(
        "fw",
        f"""with {RAW_LOG}
select {REASON_SQL} as reason, count(*) as dropped from raw_log where {REASON_SQL} is not null group by 1""",
    ),
)
def _(spark, sf_dir):
    return routing.drop_reasons(prepared(spark, sf_dir))


@query(
    "drop_report",
    with_views(
        "fw",
        f"""with {RAW_LOG}, tagged as (select {REASON_SQL} as reason from raw_log),
totals as (select count(reason) as bad, count(*) as every from tagged)
select reason, count(*) as dropped, max(bad) as total_dropped, max(every - bad) as total_processed,
  round(max(bad) * 100.0::double / max(every), 2) as drop_rate_percent,
  case when reason like 'missing%' then 'Fix missing fields: SourceIP. Check log parser schema mapping.'
    else 'Fix preparation errors (ValueError). Check data type conversions and field mappings.' end as recommendation
from tagged, totals where reason is not null group by reason""",
    ),
)
def _(spark, sf_dir):
    return routing.drop_report(prepared(spark, sf_dir))


@query(
    "route_counts",
    with_views(
        "fw vpn",
        f"""with {RAW_LOG}
select 'Custom_Firewall_CL' as table_name, count(*) filter ({REASON_SQL} is null) as processed,
  count({REASON_SQL}) as dropped, cast(ceil(count(*) filter ({REASON_SQL} is null) / 1000.0) as bigint) as batch_count
from raw_log
union all select 'Custom_VPN_CL', count(*), 0, cast(ceil(count(*) / 500.0) as bigint) from vpn""",
    ),
)
def _(spark, sf_dir):
    fw = prepared(spark, sf_dir).withColumn("table_name", F.lit(FIREWALL.table_name))
    vpn = view(spark, sf_dir, "vpn").select(
        F.col("TimeGenerated").alias("timestamp"),
        F.col("UserPrincipalName").alias("user"),
        F.col("SessionID").alias("session"),
        F.col("ClientIP").alias("ip_address"),
        F.col("BytesIn").alias("bytes_received"),
    )
    vpn = routing.prepare_rows(vpn, VPN, AS_OF).withColumn("table_name", F.lit(VPN.table_name))
    both = fw.select("table_name", "reason").unionByName(vpn.select("table_name", "reason"))
    return sinks.with_batch_counts(routing.route_counts(both, ["table_name"]))


@query(
    "routing_allowed_values",
    with_views(
        "fw",
        f"""with {RAW_LOG}
select coalesce(case when dst_port = 'n/a' then 'preparation_error:ValueError' when src_ip is null then 'missing_fields:SourceIP'
    when lower(FirewallAction) not in ('allow', 'deny', 'drop') then 'bad_value:Action' end, 'accepted') as outcome, count(*) as rows
from raw_log group by 1""",
    ),
)
def _(spark, sf_dir):
    rows = routing.prepare_rows(raw_log(spark, sf_dir), FIREWALL, AS_OF, check_values=True)
    return rows.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("rows"))


@query(
    "routed_roundtrip",
    with_views(
        "fw",
        """select 'Custom_Firewall_CL' as table_name, cast(TimeGenerated as date) as day, count(*) as rows,
  cast(sum(BytesTransferred) as bigint) as bytes from fw where event_id % 17 <> 0 and event_id % 19 <> 0 group by 1, 2""",
    ),
)
def _(spark, sf_dir):
    """Accepted rows written as the routed table, by table and day, and read back."""
    path = scratch_dir(spark, "routed_roundtrip")
    sinks.write_routed(accepted(tagged_firewall(spark, sf_dir)), path, FIREWALL, fmt="parquet")
    return spark.read.parquet(path).groupBy("table_name", "day").agg(
        F.count("*").alias("rows"), F.sum("BytesTransferred").alias("bytes")
    )


@query(
    "route_lookup",
    """
with typed as (select event_id, case event_type when 'view' then 'vpn' when 'click' then 'firewall' else 'json' end as log_type from events)
select event_id, case log_type when 'vpn' then 'Custom_VPN_CL' when 'firewall' then 'Custom_Firewall_CL' end as table_name,
  case log_type when 'vpn' then '2.1' when 'firewall' then '1.0' end as schema_version from typed""",
)
def _(spark, sf_dir):
    return routing.lookup_route(typed_rows(spark, sf_dir)).select("event_id", "table_name", "schema_version")


def typed_rows(spark, sf_dir):
    kind = F.col("event_type")
    log_type = F.when(kind == "view", "vpn").when(kind == "click", "firewall").otherwise("json")
    return table(spark, sf_dir, "events").select("event_id", log_type.alias("log_type"))


@query(
    "unsupported_types",
    """select 'json' as log_type, count(*) as rows from events where event_type not in ('view','click')""",
)
def _(spark, sf_dir):
    return routing.unsupported_types(typed_rows(spark, sf_dir))


_SCHEMA_COLUMNS = [
    ("TimeGenerated", "timestamp", "timestamp"), ("SourceIP", "string", "string"), ("DestinationIP", "string", "string"),
    ("Action", "string", "string"), ("Protocol", "string", "string"), ("SourcePort", "int", "int"),
    ("DestinationPort", "int", "int"), ("BytesTransferred", "bigint", "bigint"), ("RuleName", "string", "string"),
    ("event_id", "bigint", None),
]


@query(
    "schema_conformance",
    with_views(
        "fw",
        " union all ".join(
            f"select '{name}' as column_name, '{found}' as found_type, {repr(declared) if declared else 'null'} as declared_type, "
            f"{str(found == declared).lower()} as conforms, count(*) as rows, count(*) - count({name}) as nulls from fw"
            for name, found, declared in _SCHEMA_COLUMNS
        ),
    ),
)
def _(spark, sf_dir):
    return routing.schema_report(view(spark, sf_dir, "fw"), FIREWALL)


# ---- sinks ---------------------------------------------------------------------------------------


@query(
    "retention_report",
    with_views(
        "fw vpn",
        """
select table_name, count(*) as examined, count(*) filter (expired) as expired,
  coalesce(cast(sum(size) filter (expired) as bigint), 0) as bytes_reclaimed
from (select 'Custom_Firewall_CL' as table_name, TimeGenerated < timestamp '2024-01-21 00:00:00' as expired,
        BytesTransferred as size from fw
      union all select 'Custom_VPN_CL', TimeGenerated < timestamp '2024-01-26 00:00:00', BytesIn from vpn) t
group by 1""",
    ),
)
def _(spark, sf_dir):
    fw = view(spark, sf_dir, "fw").select("TimeGenerated", F.col("BytesTransferred").alias("size"))
    vpn = view(spark, sf_dir, "vpn").select("TimeGenerated", F.col("BytesIn").alias("size"))
    reports = [
        sinks.retention_report(fw, AS_OF, 10, label=FIREWALL.table_name),
        sinks.retention_report(vpn, AS_OF, 5, label=VPN.table_name),
    ]
    return reports[0].unionByName(reports[1])


def failed_rows(spark, sf_dir):
    """Rejected firewall rows with the failure that a write of them would have reported."""
    lines = rejected(tagged_firewall(spark, sf_dir))
    times = view(spark, sf_dir, "fw").select("event_id", F.col("TimeGenerated").alias("failed_at"))
    return lines.join(times, "event_id").select(
        F.lit(FIREWALL.table_name).alias("table_name"),
        "failed_at",
        "event_id",
        F.col("reason").alias("error"),
        F.when(F.col("reason") == "bad_timestamp", "validation_error").otherwise("unknown_error:KeyError").alias("error_category"),
        F.struct("event_id", "line").alias("record"),
    )


DEAD_SQL = """dead as (
  select event_id, TimeGenerated as failed_at, cast(TimeGenerated as date) as day,
    case when event_id % 17 = 0 then 'validation_error' else 'unknown_error:KeyError' end as error_category
  from fw where event_id % 17 = 0 or event_id % 19 = 0),
numbered as (select *, (row_number() over (partition by error_category, day order by failed_at, event_id) - 1) // 20 as batch_no from dead)"""


@query(
    "dead_letter",
    with_views(
        "fw",
        f"""with {DEAD_SQL}
select 'Custom_Firewall_CL' as table_name, error_category, day, cast(batch_no as bigint) as batch_no,
  min(failed_at) as failed_at, cast(0 as int) as retry_count, count(*) as record_count,
  md5(string_agg(cast(event_id as varchar), ',' order by failed_at, event_id)) as batch_id
from numbered group by error_category, day, batch_no""",
    ),
)
def _(spark, sf_dir):
    batches = sinks.dead_letter_batches(
        failed_rows(spark, sf_dir), batch_size=20, order=["failed_at", "event_id"],
        identity=F.col("event_id").cast("string"),
    )
    return batches.select(
        "table_name", "error_category", "day", "batch_no", "failed_at", "retry_count", "record_count", "batch_id"
    )


@query(
    "dlq_backlog",
    with_views(
        "fw",
        f"""with {DEAD_SQL}, batches as (select min(failed_at) as first_at from numbered group by error_category, day, batch_no)
select count(*) as batches, round(max(epoch_us(timestamp '{AS_OF.replace("T", " ")}') - epoch_us(first_at)) / 1000000.0::double, 3) as oldest_age_seconds
from batches""",
    ),
)
def _(spark, sf_dir):
    batches = sinks.dead_letter_batches(
        failed_rows(spark, sf_dir), batch_size=20, order=["failed_at", "event_id"],
        identity=F.col("event_id").cast("string"),
    )
    return sinks.backlog(batches, AS_OF).withColumn("oldest_age_seconds", F.round("oldest_age_seconds", 3))


def _mended(records):
    mended = records.withColumn("line", F.regexp_replace("line", r"\|x\|", "|0|"))
    return firewall.parse_firewall_lines(mended, AS_OF)


@query(
    "dlq_replay_folder",
    with_views(
        "fw",
        f"""with {DEAD_SQL}, batches as (select error_category, day, batch_no, count(*) as n from numbered group by all)
select 'routed' as part, cast(sum(n) as bigint) as rows from batches where error_category <> 'validation_error'
union all select 'archived', count(*) from batches where error_category <> 'validation_error'
union all select 'left', count(*) from batches where error_category = 'validation_error'""",
    ),
)
def _(spark, sf_dir):
    """A dead-letter table on disk, replayed twice under one run: the same as replayed once."""
    root = scratch_dir(spark, "dlq_replay_folder")
    sinks.dead_letter_batches(
        failed_rows(spark, sf_dir), batch_size=20, order=["failed_at", "event_id"],
        identity=F.col("event_id").cast("string"), redact=False,
    ).write.parquet(f"{root}/dlq")
    for _ in range(2):
        sinks.replay_folder(spark, f"{root}/dlq", f"{root}/archive", f"{root}/routed", FIREWALL, _mended, "1")
    paths = {"routed": f"{root}/routed", "archived": f"{root}/archive/batches", "left": f"{root}/dlq_left"}
    parts = [
        (spark.read.json(path) if part == "routed" else spark.read.parquet(path)).agg(F.count("*").alias("rows")).select(F.lit(part).alias("part"), "rows")
        for part, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "dlq_replay",
    with_views(
        "fw",
        f"""with {DEAD_SQL}
select error_category, count(distinct concat(cast(day as varchar), '/', cast(batch_no as varchar))) as batches,
  count(*) as records, count(*) filter (error_category <> 'validation_error') as replayed_records
from numbered group by 1""",
    ),
)
def _(spark, sf_dir):
    """Bad ports are mended on replay and pass; bad times stay dead letters.

    The records are kept unredacted here: a redacted address would not parse again.
    """
    batches = sinks.dead_letter_batches(
        failed_rows(spark, sf_dir), batch_size=20, order=["failed_at", "event_id"],
        identity=F.col("event_id").cast("string"), redact=False,
    )

    outcome = sinks.replay(batches, _mended)
    return outcome.groupBy("error_category").agg(
        F.count("*").alias("batches"),
        F.sum("record_count").alias("records"),
        F.sum("replayed_records").alias("replayed_records"),
    )
