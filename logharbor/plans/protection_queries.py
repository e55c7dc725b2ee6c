"""Transforms, data quality, redaction, audit, encryption and access reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from logharbor.operators import access, audit, encryption, quality, redaction
from logharbor.operators.transform import Transform, transform_table
from logharbor.plans.fixtures import AS_OF, table, view, with_views
from logharbor.plans.registry import query
from logharbor.session import scratch_dir

# ---- transforms ----------------------------------------------------------------------------------


@query(
    "transform_job",
    """
select event_id,
  strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.%fZ') as event_time,
  case when event_type <> 'error' then concat('10.0.0.', cast(user_id % 250 as varchar)) end as ip,
  case when event_type <> 'error' then event_id end as number, value as amount,
  case event_type when 'view' then true when 'click' then false end as flag,
  concat('EVENT_', upper(event_type)) as label, cast(json_extract(props, '$.k') as bigint) as k,
  [event_type, cast(user_id as varchar)] as parts,
  case event_type when 'view' then 'V' when 'click' then 'C' else 'other' end as code,
  case when event_type = 'error' then 'Failed to transform field number_text' end as reason
from events""",
)
def _(spark, sf_dir):
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy/MM/dd HH:mm:ss").alias("time_text"),
        F.when(kind == "error", "10.0.0.999")
        .otherwise(F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")))
        .alias("ip"),
        F.when(kind == "error", "x").otherwise(F.col("event_id").cast("string")).alias("number_text"),
        F.col("value").cast("string").alias("amount"),
        F.when(kind == "view", "Yes").when(kind == "click", "OFF").otherwise("maybe").alias("flag"),
        F.concat(F.lit("  event "), kind, F.lit(" ")).alias("label"),
        "props",
        F.concat(kind, F.lit(" ; "), user).alias("parts"),
        kind.alias("code"),
    )
    rules = [
        Transform("time_text", "timestamp", "event_time", parameters={"input_formats": ["%Y/%m/%d %H:%M:%S"]}),
        Transform("ip", "ip"),
        Transform("number_text", "integer", "number", required=True),
        Transform("amount", "float"),
        Transform("flag", "boolean"),
        Transform("label", "string", parameters={"upper": True, "replace": {" ": "_"}}),
        Transform("props", "json"),
        Transform("parts", "list", parameters={"separator": ";"}),
        Transform("code", "map", parameters={"mapping": {"view": "V", "click": "C"}, "default": "other"}),
        Transform("absent", "integer"),
        Transform("code", "no such kind", "ignored"),
    ]
    out = transform_table(raw, rules, ["event_id"])
    return out.withColumn("k", F.variant_get("props", "$.k", "bigint")).drop("props")


@query(
    "transform_map",
    """select event_id, case event_type when 'view' then 'V' when 'click' then 'C' when 'error' then null else 'other' end as optional,
  case event_type when 'view' then 'V' when 'click' then 'C' else 'other' end as needed,
  case when event_type = 'error' then null when user_id < 300 then concat('u', cast(user_id as varchar)) else 'other' end as large
from events""",
)
def _(spark, sf_dir):
    """Lookups of two and of three hundred entries; an optional null stays null, a required one has the default."""
    kind = F.col("event_type")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind != "error", kind).alias("code"),
        F.when(kind != "error", F.col("user_id").cast("string")).alias("user"),
    )
    few = {"mapping": {"view": "V", "click": "C"}, "default": "other"}
    many = {"mapping": {str(k): f"u{k}" for k in range(300)}, "default": "other"}
    rules = [
        Transform("code", "map", "optional", parameters=few),
        Transform("code", "map", "needed", required=True, parameters=few),
        Transform("user", "map", "large", parameters=many),
    ]
    return transform_table(raw, rules, ["event_id"]).drop("reason")


# ---- data quality --------------------------------------------------------------------------------

DQ_RULES = [
    quality.Rule("src", "required"),
    quality.Rule("k", "type", {"type": "string"}),
    quality.Rule("RuleName", "regex", {"pattern": "rule-[a-p]"}, "odd rule name"),
    quality.Rule("DestinationPort", "range", {"min": 23, "max": 3389}),
    quality.Rule("Action", "enum", {"values": ["deny", "drop", "Allow"]}),
    quality.Rule("ip", "ip", {"version": 4}),
    quality.Rule("time_text", "timestamp"),
    quality.Rule("RuleName", "length", {"min": 9, "max": 11}),
    quality.Rule("src", "unknown kind"),
]

DQ_SQL = """
checked as (
  select fw.event_id, case when user_id % 10 = 0 then null when user_id % 10 = 1 then ' ' else SourceIP end as src,
    RuleName, DestinationPort, Action, event_type from fw join events using (event_id)),
bad as (
  select event_id, 0 as rule_no, 'src' as field, 'required' as rule_type, 'Field is required' as message
    from checked where src is null or trim(src) = ''
  union all select event_id, 1, 'k', 'type', 'Expected type string, got int' from checked
  union all select event_id, 2, 'RuleName', 'regex', 'odd rule name' from checked where not regexp_matches(RuleName, '^rule-[a-p]')
  union all select event_id, 3, 'DestinationPort', 'range', 'Value must be greater than or equal to 23' from checked where DestinationPort < 23
  union all select event_id, 3, 'DestinationPort', 'range', 'Value must be less than or equal to 3389' from checked where DestinationPort > 3389
  union all select event_id, 4, 'Action', 'enum', 'Value must be one of: deny, drop, Allow' from checked where Action = 'RESET'
  union all select event_id, 5, 'ip', 'ip', case event_type when 'error' then 'Invalid IP address' else 'Must be an IPv4 address' end
    from checked where event_type in ('error', 'view')
  union all select event_id, 6, 'time_text', 'timestamp', 'Invalid timestamp format' from checked where event_type = 'signup'
  union all select event_id, 7, 'RuleName', 'length', 'Length must be at least 9' from checked where length(RuleName) < 9
  union all select event_id, 7, 'RuleName', 'length', 'Length must be at most 11' from checked where length(RuleName) > 11)"""


def dq_input(spark, sf_dir):
    kind, user = F.col("event_type"), F.col("user_id")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "props")
    return view(spark, sf_dir, "fw").join(events, "event_id").select(
        "event_id",
        F.when(user % 10 == 1, " ").when(user % 10 != 0, F.col("SourceIP")).alias("src"),
        "RuleName",
        "DestinationPort",
        "Action",
        F.when(kind == "error", "300.1.1.1").when(kind == "view", "2001:db8::1").otherwise(F.col("SourceIP")).alias("ip"),
        F.when(kind == "signup", "soon")
        .otherwise(F.date_format("TimeGenerated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .alias("time_text"),
        F.variant_get(F.parse_json("props"), "$.k", "variant").alias("k"),
    )


@query("dq_violations", with_views("fw", f"with {DQ_SQL.strip()} select * from bad"))
def _(spark, sf_dir):
    return quality.violations(dq_input(spark, sf_dir), DQ_RULES, ["event_id"])


@query(
    "dq_summary",
    with_views(
        "fw",
        f"""with {DQ_SQL.strip()}
select rule_no, field, rule_type, (select count(*) from checked) as checked, count(*) as failed,
  round(1.0::double - count(*)::double / (select count(*) from checked), 9) as pass_rate
from bad group by 1, 2, 3""",
    ),
)
def _(spark, sf_dir):
    report = quality.summary(dq_input(spark, sf_dir), DQ_RULES)
    return report.withColumn("pass_rate", F.round("pass_rate", 9))


@query(
    "dq_clean_rows",
    with_views("fw", f"with {DQ_SQL.strip()} select event_id from checked where event_id not in (select event_id from bad where rule_no <> 1)"),
)
def _(spark, sf_dir):
    rules = [rule for rule in DQ_RULES if rule.kind != "type"]
    return quality.split(dq_input(spark, sf_dir), rules)[0].select("event_id")


@query(
    "dq_custom",
    "select event_id, 'value' as field, 'value is over 100' as message from events where value > 100",
)
def _(spark, sf_dir):
    rule = quality.Rule("value", "custom", {"function": lambda v: True if v <= 100 else "value is over 100"})
    found = quality.violations(table(spark, sf_dir, "events"), [rule], ["event_id"])
    return found.select("event_id", "field", "message")


@query(
    "dq_preload",
    with_views(
        "fw",
        f"""with {DQ_SQL.strip()}
select event_id, 'src' as field, 'Missing required field ''src''' as message from bad where rule_no = 0
union all select event_id, 'time_text', 'Invalid time_text format' from bad where rule_no = 6""",
    ),
)
def _(spark, sf_dir):
    rules = quality.preload_rules(["src", "Action"], time="time_text")
    return quality.violations(dq_input(spark, sf_dir), rules, ["event_id"]).select("event_id", "field", "message")


_HITS = " + ".join(
    f"cast(regexp_matches(lower({{c}}), '{word}') as int)" for word in ("password", "secret", "key", "token", "credential")
)


@query(
    "sensitive_scan",
    f"""select * from (
  select doc_id, 'text' as path, {_HITS.format(c="text")} as warnings from documents
  union all select doc_id, 'source', {_HITS.format(c="source")} from documents) t where warnings > 0""",
)
def _(spark, sf_dir):
    return quality.sensitive_columns(table(spark, sf_dir, "documents"), ["doc_id"], ["text", "source"])


@query(
    "sensitive_scan_json",
    """
select event_id, 'a.note' as path, concat('my ', event_type, ' key') as value, 1 as warnings from events
union all select event_id, 'list[0].v', 'TOKEN or password', 2 from events
union all select event_id, 'list[1]', 'secret', 1 from events where event_type = 'error'""",
)
def _(spark, sf_dir):
    kind = F.col("event_type")
    listed = F.when(kind == "error", '"secret"').otherwise('"keyvault:secret"')
    text = F.concat(
        F.lit('{"a": {"note": "my '), kind, F.lit(' key", "n": 1}, "list": [{"v": "TOKEN or password"}, '),
        listed, F.lit(', ["key"], 5], "props": '), F.col("props"), F.lit("}"),
    )
    logs = table(spark, sf_dir, "events").select("event_id", text.alias("doc"))
    return quality.sensitive_values(logs, ["event_id"], "doc")


@query(
    "sensitive_scan_deep",
    "select event_id, 'a.b.c.d.e.f.g.h.i.j.k.note' as path, concat('password of ', event_type) as value, 1 as warnings from events where event_id % 3 = 0",
)
def _(spark, sf_dir):
    """A secret twelve levels down, in every third text."""
    text = F.concat(F.lit('{"note": "password of '), "event_type", F.lit('"}'))
    for name in "kjihgfedcba":
        text = F.concat(F.lit(f'{{"{name}": '), text, F.lit("}"))
    text = F.when(F.col("event_id") % 3 == 0, text).otherwise(F.lit('{"note": "nothing"}'))
    logs = table(spark, sf_dir, "events").select("event_id", text.alias("doc"))
    return quality.sensitive_values(logs, ["event_id"], "doc")


# ---- redaction -----------------------------------------------------------------------------------


def _redacted_sql(column: str) -> str:
    for kind, pattern in redaction.PII_PATTERNS.items():
        column = f"regexp_replace({column}, '{pattern}', '{redaction.marker(kind)}', 'g')"
    return column


@query("pii_redact", f"select doc_id, {_redacted_sql('text')} as text from documents")
def _(spark, sf_dir):
    return redaction.redact_frame(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _masked(name: str) -> str:
    return f"'{redaction.marker(name)}'"


@query(
    "pii_redact_maps",
    f"""select event_id, 'by {redaction.marker("email")}' as nested_note, {_masked("email")} as nested_email,
  ['{redaction.marker("email")}', 'fine'] as listed, {_masked("phone")} as phone, cast(event_id % 7 as varchar) as amount
from events""",
)
def _(spark, sf_dir):
    """Values of maps are entered like members of structs: structs, lists, and numbers under a personal name."""
    mail = F.concat(F.lit("a"), F.col("user_id").cast("string"), F.lit("@b.co"))
    member = F.struct(F.concat(F.lit("by "), mail).alias("note"), mail.alias("email"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(F.lit("who"), member).alias("members"),
        F.create_map(F.lit("who"), F.array(mail, F.lit("fine"))).alias("lists"),
        F.create_map(F.lit("phone"), F.col("event_id"), F.lit("amount"), F.col("event_id") % 7).alias("numbers"),
    )
    out = redaction.redact_frame(rows, ["members", "lists", "numbers"])
    return out.select(
        "event_id",
        F.col("members.who.note").alias("nested_note"),
        F.col("members.who.email").alias("nested_email"),
        F.col("lists.who").alias("listed"),
        F.col("numbers.phone").alias("phone"),
        F.col("numbers.amount").alias("amount"),
    )


@query(
    "pii_redact_conversations",
    f"select conv_id, turn, role, {_redacted_sql('text')} as text from conversations",
)
def _(spark, sf_dir):
    return redaction.redact_frame(table(spark, sf_dir, "conversations"))


@query(
    "pii_redact_fields",
    """
select c_custkey, '[REDACTED:USERNAME]' as username, '[REDACTED:SESSION_BALANCE]' as session_balance,
  c_mktsegment as segment, 'call [REDACTED:PHONE]' as contact from customer""",
)
def _(spark, sf_dir):
    number = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("username"),
        F.col("c_acctbal").alias("session_balance"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("call 555-"), number).alias("contact"),
    )
    return redaction.redact_frame(people)


@query(
    "pii_redact_json",
    """
select event_id, concat('{"user": {"email": "[REDACTED:EMAIL]", "seen": "from [REDACTED:IPV4]"}, "tokens": ["[REDACTED:EMAIL]", 5], "kind": "',
  event_type, '", "props": ', props, '}') as record from events""",
)
def _(spark, sf_dir):
    user = F.col("user_id").cast("string")
    record = F.concat(
        F.lit('{"user": {"email": "user'), user, F.lit('", "seen": "from 10.0.0.'), user, F.lit('"}, "tokens": ["u'),
        user, F.lit('@example.com", 5], "kind": "'), F.col("event_type"), F.lit('", "props": '), F.col("props"), F.lit("}"),
    )
    return table(spark, sf_dir, "events").select("event_id", redaction.redact_json(record).alias("record"))


@query(
    "pii_report",
    "\nunion all ".join(
        f"""select '{kind}' as pattern, count(*) filter (regexp_matches(text, '{p}')) as rows_hit,
  coalesce(cast(sum(len(regexp_extract_all(text, '{p}'))) as bigint), 0) as matches from documents"""
        for kind, p in redaction.PII_PATTERNS.items()
    ),
)
def _(spark, sf_dir):
    return redaction.pii_report(table(spark, sf_dir, "documents"), "text")


# ---- audit and encryption ------------------------------------------------------------------------


def audit_events(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        kind.alias("event_type"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user"),
        F.lit('say "hi"\n').alias("action"),
        F.lit("é/table").alias("resource"),
        F.when(kind == "error", "failure").otherwise("success").alias("status"),
        F.create_map(F.lit("props"), F.col("props"), F.lit("a"), F.col("value").cast("int").cast("string")).alias("details"),
        F.when(kind != "view", "10.0.0.1").alias("source_ip"),
    )


@query(
    "audit_hash",
    r"""
select event_id, sha256(concat('{"action": "say \"hi\"\n", "correlation_id": null, "details": {"a": "',
  cast(cast(trunc(value) as int) as varchar), '", "props": "', replace(props, '"', '\"'), '"}, "event_type": "', event_type,
  '", "resource": "\u00e9/table", "source_ip": ', case when event_type = 'view' then 'null' else '"10.0.0.1"' end,
  ', "status": "', case event_type when 'error' then 'failure' else 'success' end, '", "timestamp": "',
  strftime(ts, '%Y-%m-%dT%H:%M:%S'), '", "user": "user', cast(user_id as varchar), '"}')) as hash from events""",
)
def _(spark, sf_dir):
    return audit.stamp(audit_events(spark, sf_dir)).select("event_id", "hash")


@query(
    "audit_tampered",
    """
select event_id, case event_type when 'error' then 'tampered' when 'signup' then 'unhashed' else 'unreadable' end as finding
from events where event_type in ('error', 'signup', 'purchase')""",
)
def _(spark, sf_dir):
    stamped = audit.stamp(audit_events(spark, sf_dir))
    kind, line = F.col("event_type"), audit.to_lines(stamped, F.col("timestamp"))
    lines = stamped.select("event_id", "event_type", line.alias("line"))
    lines = lines.withColumn(
        "line",
        F.when(kind == "error", F.replace("line", F.lit('"failure"'), F.lit('"success"')))
        .when(kind == "signup", F.regexp_replace("line", r', "hash": "[0-9a-f]+"', ""))
        .when(kind == "purchase", F.substring("line", 1, 60))
        .otherwise(F.col("line")),
    )
    return audit.tampered_lines(lines).select("event_id", "finding")


@query(
    "column_encrypt_roundtrip",
    "select c_custkey, c_name, c_mktsegment, true as hidden, true as rotated, true as old_key_fails from customer",
)
def _(spark, sf_dir):
    old, new = (F.unhex(F.sha2(F.lit(name), 256)) for name in ("first key", "second key"))
    columns = ["c_name", "c_mktsegment"]
    plain = table(spark, sf_dir, "customer").select("c_custkey", *columns, F.col("c_name").alias("_plain"))
    sealed = encryption.encrypt_columns(plain, columns, old).withColumn("_sealed", F.col("c_name"))
    turned = encryption.rotate_columns(sealed, columns, old, new).withColumn("_turned", F.col("c_name"))
    stale = encryption.decrypt_columns(turned, ["c_name"], old).select("c_custkey", F.col("c_name").alias("_stale"))
    opened = encryption.decrypt_columns(turned, columns, new).join(stale, "c_custkey")
    return opened.select(
        "c_custkey",
        *columns,
        (F.col("_sealed") != F.col("_plain")).alias("hidden"),
        (F.col("_turned") != F.col("_sealed")).alias("rotated"),
        F.col("_stale").isNull().alias("old_key_fails"),
    )


@query("table_key_rotation", "select c_custkey, c_name, c_mktsegment from customer")
def _(spark, sf_dir):
    """An encrypted table rewritten under a new key and opened with it."""
    old, new = (F.unhex(F.sha2(F.lit(name), 256)) for name in ("first key", "second key"))
    columns, root = ["c_name", "c_mktsegment"], scratch_dir(spark, "table_key_rotation")
    plain = table(spark, sf_dir, "customer").select("c_custkey", *columns)
    encryption.encrypt_columns(plain, columns, old).write.parquet(f"{root}/old")
    encryption.rotate_table(spark, f"{root}/old", f"{root}/new", columns, old, new)
    return encryption.decrypt_columns(spark.read.parquet(f"{root}/new"), columns, new)


@query("table_key_rotation_resumed", "select c_custkey, c_name, c_mktsegment, 2 as key_version from customer")
def _(spark, sf_dir):
    """A rotation that stops after three of its parts, is read meanwhile, and goes on."""
    old, new = (F.unhex(F.sha2(F.lit(name), 256)) for name in ("first key", "second key"))
    columns, root = ["c_name", "c_mktsegment"], scratch_dir(spark, "table_key_rotation_resumed")
    plain = table(spark, sf_dir, "customer").select("c_custkey", *columns)
    encryption.create_versioned(plain, root, columns, old, ["c_custkey"], parts=8)
    if encryption.rotate_versioned(spark, root, columns, old, new, at_once=3):
        raise RuntimeError("three of eight parts are not all")
    meanwhile = encryption.decrypt_columns(encryption.read_versioned(spark, root), columns, old)
    if not meanwhile.exceptAll(plain.withColumn("key_version", F.lit(1))).isEmpty():
        raise RuntimeError("readers must see the old version until all parts are staged")
    encryption.rotate_versioned(spark, root, columns, old, new)
    return encryption.decrypt_columns(encryption.read_versioned(spark, root), columns, new)


# ---- access --------------------------------------------------------------------------------------

GRANTS_SQL = "grants as (select * from (values {}) g(role, permission))".format(
    ", ".join(f"('{role}', '{p}')" for role, granted in access.ROLES.items() for p in granted)
)


def users(spark, sf_dir):
    return view(spark, sf_dir, "users").withColumn("roles", F.array("role"))


@query(
    "effective_permissions",
    with_views("users", f"with {GRANTS_SQL} select distinct username, permission from users join grants using (role) where active"),
)
def _(spark, sf_dir):
    return access.effective_permissions(users(spark, sf_dir))


@query(
    "unauthorised_access",
    with_views(
        "users access_log",
        f"""with {GRANTS_SQL}
select event_id, username, permission from access_log a where not exists (
  select 1 from users u join grants g using (role) where u.active and u.username = a.username and g.permission = a.permission)""",
    ),
)
def _(spark, sf_dir):
    return access.unauthorised_access(view(spark, sf_dir, "access_log"), users(spark, sf_dir), ["event_id"])


@query(
    "revoked_tokens",
    with_views(
        "users tokens revoked user_cutoffs",
        """
select t.jti, t.username, t.issued_at, case when not coalesce(u.active, false) then 'invalid_user'
  when r.jti is not null then 'token_revoked' when date_trunc('second', t.issued_at) < c.revoked_at then 'user_revoked' else 'valid' end as verdict
from tokens t left join users u on u.username = t.username left join revoked r on r.jti = t.jti
left join user_cutoffs c on c.username = t.username""",
    ),
)
def _(spark, sf_dir):
    frames = {n: view(spark, sf_dir, n) for n in ("tokens", "revoked", "user_cutoffs")}
    return access.token_report(
        frames["tokens"], users(spark, sf_dir), frames["revoked"], frames["user_cutoffs"], ["jti"]
    )


@query(
    "revocation_stats",
    with_views(
        "revoked user_cutoffs",
        """
select count(*) as total_revoked_tokens, count(expires_at) as tracked_expiries,
  count(*) filter (expires_at < timestamp '2024-01-16 00:00:00') as expired_revocations,
  (select count(*) from user_cutoffs) as users_with_revocations from revoked""",
    ),
)
def _(spark, sf_dir):
    cutoffs = view(spark, sf_dir, "user_cutoffs")
    return access.revocation_stats(view(spark, sf_dir, "revoked"), cutoffs, "2024-01-16T00:00:00")


@query(
    "expired_revocations",
    with_views("revoked", f"select * from revoked where expires_at < timestamp '{AS_OF.replace('T', ' ')}'"),
)
def _(spark, sf_dir):
    return access.expired_revocations(view(spark, sf_dir, "revoked"), AS_OF)
