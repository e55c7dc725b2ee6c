"""Log-shaped views over the benchmark tables, in text that Spark SQL and DuckDB both accept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

AS_OF = "2024-01-31T00:00:00"
#: A range that covers every row of the benchmark's events.
WHOLE_RANGE = "3650 days"

# name -> (views it reads, select text). `events`, `documents` … are the given tables.
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fw": (
        ("events",),
        """
select event_id, cast(ts as timestamp) as TimeGenerated,
  concat('10.0.', cast(user_id % 8 as string), '.', cast(user_id % 50 as string)) as SourceIP,
  concat('192.168.1.', cast(event_id % 20 as string)) as DestinationIP,
  case event_type when 'error' then 'deny' when 'signup' then 'drop' when 'purchase' then 'RESET' else 'Allow' end as Action,
  case when event_id % 3 = 0 then 'udp' else 'tcp' end as Protocol,
  cast(1024 + event_id % 60000 as int) as SourcePort,
  cast(case event_id % 8 when 0 then 22 when 1 then 3389 when 2 then 23 when 3 then 5900
       when 4 then 443 when 5 then 80 when 6 then 53 else 21 end as int) as DestinationPort,
  cast(floor(value * 1000000) as bigint) as BytesTransferred,
  concat('rule-', event_type) as RuleName
from events""",
    ),
    "vpn": (
        ("events",),
        """
select event_id, cast(ts as timestamp) as TimeGenerated,
  concat('user', cast(user_id as string), '@example.com') as UserPrincipalName,
  concat('vpn-', cast(event_id as string)) as SessionID,
  concat('203.0.113.', cast(user_id % 200 as string)) as ClientIP,
  cast(floor(value * 10000) as bigint) as BytesIn, cast(floor(value * 5000) as bigint) as BytesOut,
  cast(event_id % 14400 as int) as ConnectionDuration
from events where event_type in ('view','click')""",
    ),
    "applog": (
        ("events",),
        """
select event_id, cast(ts as timestamp) as ts, user_id,
  case event_type when 'error' then 'ERROR' when 'signup' then 'WARNING' when 'view' then 'DEBUG' else 'INFO' end as level,
  concat('component-', cast(user_id % 5 as string)) as component, event_type as type,
  concat(event_type, ' by user ', cast(user_id as string), ' value ', props) as message, value
from events""",
    ),
    "metrics": (
        ("events",),
        """
select event_id, concat('m', cast(user_id % 5 as string)) as series, event_type as name,
  cast(ts as timestamp) as ts, value
from events""",
    ),
    "calls": (
        ("events",),
        """
select event_id, cast(ts as timestamp) as ts, concat('component-', cast(user_id % 5 as string)) as component,
  case when event_type in ('error','signup','purchase') then 1 else 0 end as failed
from events""",
    ),
    "users": (
        ("events",),
        """
select concat('user', cast(user_id as string)) as username,
  case when user_id % 3 = 0 then 'connector-admin' when user_id % 3 = 1 then 'connector-reader'
       else 'unknown-role' end as role,
  sum(value) > 10 and user_id % 7 <> 0 as active
from events group by user_id""",
    ),
    "tokens": (
        ("events",),
        """
select concat('jti-', cast(event_id as string)) as jti, concat('user', cast(user_id as string)) as username,
  cast(ts as timestamp) as issued_at, event_type, value
from events where event_type in ('view','click')""",
    ),
    "revoked": (
        ("events",),
        """
select concat('jti-', cast(event_id as string)) as jti, concat('user', cast(user_id as string)) as username,
  cast(ts as timestamp) + interval '1' day as expires_at
from events where event_type = 'click' and value > 80""",
    ),
    "user_cutoffs": (
        ("events",),
        """
select concat('user', cast(user_id as string)) as username, min(cast(ts as timestamp)) as revoked_at
from events where event_type = 'signup' group by user_id""",
    ),
    "access_log": (
        ("events",),
        """
select event_id, concat('user', cast(user_id as string)) as username,
  case event_type when 'view' then 'monitor:read' when 'click' then 'metrics:read'
    when 'purchase' then 'config:update' when 'signup' then 'credential:rotate'
    else 'failed_batches:read' end as permission
from events""",
    ),
    "failures": (
        ("events",),
        """
select event_id, cast(ts as timestamp) as ts, event_type as component,
  case event_type when 'error' then 'HttpResponseError' when 'signup' then 'ReadTimeoutError'
    when 'purchase' then 'ConnectionResetError' when 'click' then 'SchemaValidationError' else 'KeyError' end as error_type,
  case when value > 100 then 'request timeout after 30s' else 'batch rejected' end as message,
  case when event_type = 'error' and value > 20 then 503 when event_type = 'error' and value > 10 then 429 end as status_code,
  cast(floor(value) as bigint) as records
from events""",
    ),
}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a lazy frame over the given tables."""
    inputs, text = _VIEWS[name]
    return spark.sql(
        text.replace(f"from {inputs[0]}", f"from {{{inputs[0]}}}"),
        **{n: table(spark, sf_dir, n) for n in inputs},
    )


def stream_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same view over a stream of the files of its table."""
    inputs, text = _VIEWS[name]
    schema = table(spark, sf_dir, inputs[0]).schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", f"{inputs[0]}*.parquet").parquet(sf_dir)
    return spark.sql(text.replace(f"from {inputs[0]}", f"from {{{inputs[0]}}}"), **{inputs[0]: files})


def firewall_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pipe-delimited lines, some with a bad time or a bad port."""
    text = """
select event_id, concat_ws('|',
  case when event_id % 17 = 0 then 'not-a-time'
       else date_format(TimeGenerated, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") end,
  SourceIP, DestinationIP, Action, RuleName, Protocol, cast(SourcePort as string),
  case when event_id % 19 = 0 then 'x' else cast(DestinationPort as string) end,
  cast(BytesTransferred as string)) as line
from {fw}"""
    return spark.sql(text, fw=view(spark, sf_dir, "fw"))


def with_views(names: str | list[str], body: str) -> str:
    """Oracle text: the named views as common table expressions in front of `body`."""
    names = names.split() if isinstance(names, str) else names
    parts = [f"{name} as ({_VIEWS[name][1].strip()})" for name in names]
    body = body.strip()
    if not parts:
        return body
    for opening in ("with recursive ", "with "):
        if body.lower().startswith(opening):
            return opening + ",\n".join(parts) + ",\n" + body[len(opening) :]
    return "with " + ",\n".join(parts) + "\n" + body
