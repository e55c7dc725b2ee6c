"""Sources, routing, transforms, quality rules and redaction on small vectors."""

import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from logharbor.functions.tagging import accepted, rejected
from logharbor.functions.variants import json_depth
from logharbor.operators import quality, redaction, routing
from logharbor.operators.transform import Transform, transform_table
from logharbor.sources import delimited, json_logs, lines, manifest, registry
from logharbor.specs import FIREWALL, FIREWALL_STRICT, VPN

AS_OF = "2024-03-01T00:00:00"


def frame(spark, column, values, dtype="string"):
    return spark.createDataFrame(list(enumerate(values)), f"n int, {column} {dtype}")


# ---- sources -------------------------------------------------------------------------------------


def test_json_schema_limits_and_trailing_text(spark):
    payloads = [
        '{"timestamp": "t", "event_type": "login", "n": 5}',
        '["open", {',
        '{"timestamp": "t"}',
        '{"timestamp": 5, "event_type": "x"}',
        '{"timestamp": "t", "event_type": "x"} trailing',
        '{"timestamp": "t", "event_type": "x", "deep": {"a": {"b": {"c": 1}}}}',
        json.dumps({"timestamp": "t", "event_type": "x" * 300}),
        '{"timestamp": "t", "event_type": "x", "n": true}',
        '{"timestamp": "t", "event_type": "x", "n": 1.5}',
    ]
    schema = json_logs.JsonSchema(
        ("timestamp", "event_type"), {"timestamp": "string", "event_type": "string", "n": "integer"}
    )
    tagged = json_logs.parse_json_lines(frame(spark, "line", payloads), schema, max_bytes=200, max_depth=4)
    assert {r.n: r.reason for r in tagged.select("n", "reason").collect()} == {
        0: None, 1: "invalid_json", 2: "missing_field:event_type", 3: "wrong_type:timestamp",
        4: "invalid_json", 5: "too_deep", 6: "too_large", 7: None, 8: "wrong_type:n",
    }


def depth(value, level=1):
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return max([level, *(depth(v, level + 1) for v in inner)])


def test_json_depth(spark):
    texts = [
        "{}", "[]", "5", '{"a": 1}', '{"a": {}}', '[[], [1, [false]]]', '{"a": "{[\\"[["}',
        '{"s": {"false": [null, -1.5e3, "x"]}}',
    ]
    got = frame(spark, "t", texts).select("n", json_depth(F.col("t")).alias("d")).collect()
    assert {r.n: r.d for r in got} == {i: depth(json.loads(t)) for i, t in enumerate(texts)}


def test_json_object_layouts(spark):
    contents = ['[{"a": 1}, {"a": 2}]', '{"a": 3}', '{"a": 4}\n\n{"a": 5}\nnot json\n', "", "[]"]
    got = json_logs.explode_json_objects(frame(spark, "content", contents))
    rows = got.select("n", F.variant_get("record", "$.a", "int").alias("a")).collect()
    assert sorted((r.n, r.a) for r in rows) == [(0, 1), (0, 2), (1, 3), (2, 4), (2, 5)]


def test_delimiters(spark):
    df = frame(spark, "line", ["a | b|c", "a, b ,c|", "a,b", "  a   b ", "   "])
    got = delimited.parse_delimited_lines(df, ["x", "y"]).collect()
    assert {r.n: (r.x, r.y) for r in got} == {0: ("a", "b"), 1: ("a, b ,c", ""), 2: ("a", "b"), 3: ("a", "b")}


def test_files_gzip_and_bad_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.log").write_bytes(b"good\nbad\xff\xfe\n")
    (tmp_path / "sub" / "b.log.gz").write_bytes(gzip.compress(b"zipped\n"))
    (tmp_path / "c.tmp").write_bytes(b"skipped\n")
    (tmp_path / "empty.log").write_bytes(b"")
    read = lines.read_lines(spark, str(tmp_path), glob="*.{log,gz}")
    assert sorted(r.line for r in read.collect()) == ["bad��", "good", "zipped"]
    keys = manifest.select_objects(manifest.list_folder(spark, str(tmp_path)))
    assert sorted(r.Key.rsplit("/", 1)[1] for r in keys.collect()) == ["a.log", "b.log.gz"]
    whole = lines.read_objects(spark, str(tmp_path), glob="a.log").collect()
    assert whole[0].content.startswith("good\nbad")


def test_object_names(spark):
    names = ["a.LOG", "x/temp/a.log", "template.json", "a.csv", "a_tmp.txt", "a.parquet", "Partial.gz"]
    got = frame(spark, "key", names).where(manifest.is_log_key(F.col("key"))).collect()
    assert [r.key for r in got] == ["a.LOG", "a.csv"]


def test_file_outcomes(spark):
    rows = [("f1", 10, None), ("f1", 10, "bad"), ("f2", 20, None)]
    outcomes = manifest.file_outcomes(spark.createDataFrame(rows, "path string, size long, reason string"))
    (total,) = manifest.outcome_summary(outcomes).collect()
    assert tuple(total) == (2, 1, 1, 30, 0.5)


def test_parser_registry():
    assert registry.parser_for("firewall")
    with pytest.raises(ValueError, match="Unsupported log type"):
        registry.parser_for("nope")


# ---- routing -------------------------------------------------------------------------------------


def test_mapping_fallback_conversion_and_missing(spark):
    rows = [
        ("1.1.1.1", None, "2.2.2.2", "allow", "5", "2024-02-20T12:00:00Z"),
        (None, "3.3.3.3", "2.2.2.2", "deny", None, None),
        (None, None, None, "deny", "7", None),
        (None, None, "2.2.2.2", "deny", "x", None),
    ]
    schema = "src_ip string, SourceIP string, dst_ip string, FirewallAction string, bytes string, timestamp string"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, " + schema)
    got = {r.n: r for r in routing.prepare_rows(df, FIREWALL, AS_OF, "restricted", ["n"]).collect()}
    assert [got[i].reason for i in range(4)] == [
        None, None, "missing_fields:SourceIP,DestinationIP", "preparation_error:ValueError",
    ]
    assert (got[0].SourceIP, got[0].Action, got[0].BytesTransferred) == ("1.1.1.1", "allow", 5)
    assert got[0].TimeGenerated == datetime.datetime(2024, 2, 20, 12)
    assert (got[1].SourceIP, got[1].TimeGenerated) == ("3.3.3.3", datetime.datetime(2024, 3, 1))
    assert (got[0].DataClassification, got[0].SchemaVersion) == ("restricted", "1.0")


def test_strict_preset_and_schema_report(spark):
    df = spark.createDataFrame([("a", "b", "allow", "TCP")], "src_ip string, dst_ip string, action string, proto string")
    rows = accepted(routing.prepare_rows(df, FIREWALL_STRICT, AS_OF))
    assert "Protocol" not in rows.columns
    report = {r.column_name: r.conforms for r in routing.schema_report(rows, FIREWALL).collect()}
    assert report["SourceIP"] and not report["Protocol"] and not report["SchemaVersion"]
    assert VPN.required == ["TimeGenerated", "UserPrincipalName", "SessionID", "ClientIP"]


def test_route_lookup(spark):
    df = frame(spark, "log_type", ["firewall", "json", None])
    assert [r.table_name for r in routing.lookup_route(df).orderBy("n").collect()] == ["Custom_Firewall_CL", None, None]
    assert {(r.log_type, r["rows"]) for r in routing.unsupported_types(df).collect()} == {("json", 1), (None, 1)}


# ---- transforms ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("kind", "parameters", "value", "expected"),
    [
        ("timestamp", {}, "2024-01-02 03:04:05", "2024-01-02T03:04:05.000000Z"),
        ("timestamp", {"output_format": "%d/%m/%Y"}, "Jan 2 2024 03:04:05", "02/01/2024"),
        ("timestamp", {}, "nonsense", None),
        ("ip", {}, "2001:0DB8::1", "2001:db8::1"),
        ("ip", {}, "999.1.1.1", None),
        ("integer", {}, " 42 ", 42),
        ("integer", {}, "4.2", None),
        ("float", {}, "4.2", 4.2),
        ("boolean", {}, "YES", True),
        ("boolean", {"false_values": ["nah"]}, "nah", False),
        ("boolean", {}, "perhaps", None),
        ("string", {}, "  a b ", "a b"),
        ("string", {"strip": False, "upper": True}, " a", " A"),
        ("string", {"lower": True, "replace": {"a": "b", "b": "c"}}, "A", "c"),
        ("list", {}, "a, b,c ", ["a", "b", "c"]),
        ("list", {"separator": "|"}, "a|b", ["a", "b"]),
        ("map", {"mapping": {"a": "x"}, "default": "?"}, "a", "x"),
        ("map", {"mapping": {"a": "x"}, "default": "?"}, "z", "?"),
        ("map", {"mapping": {f"k{i}": f"v{i}" for i in range(300)}, "default": "?"}, "k299", "v299"),
    ],
)
def test_transform_kinds(spark, kind, parameters, value, expected):
    df = spark.createDataFrame([(value,)], "f string")
    (row,) = transform_table(df, [Transform("f", kind, "out", parameters=parameters)]).collect()
    assert row.out == expected and row.reason is None


def test_required_and_optional_failures(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    (row,) = transform_table(df, [Transform("a", "integer"), Transform("b", "float", required=True)]).collect()
    assert row.a is None and row.reason == "Failed to transform field b"


# ---- quality -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("dtype", "value", "kind", "parameters", "message"),
    [
        ("string", "  ", "required", {}, "Field is required"),
        ("string", "x", "required", {}, None),
        ("string", "x", "type", {"type": "integer"}, "Expected type integer, got str"),
        ("boolean", True, "type", {"type": "integer"}, None),
        ("string", None, "type", {"type": "integer"}, None),
        ("string", "abc", "regex", {"pattern": "b"}, "Value does not match required pattern"),
        ("string", "abc", "regex", {"pattern": "a"}, None),
        ("string", "", "regex", {"pattern": "a"}, None),
        ("string", "7", "range", {"min": 8}, "Value must be greater than or equal to 8"),
        ("double", 9.5, "range", {"max": 9}, "Value must be less than or equal to 9"),
        ("string", "x", "range", {"max": 9}, "Value must be numeric"),
        ("string", "c", "enum", {"values": ["a", "b"]}, "Value must be one of: a, b"),
        ("string", "1.2.3.4", "ip", {"version": 6}, "Must be an IPv6 address"),
        ("string", "::1", "ip", {"version": 6}, None),
        ("string", "x", "ip", {}, "Invalid IP address"),
        ("string", "2024-01-01", "timestamp", {}, "Invalid timestamp format"),
        ("string", "2024-01-01", "timestamp", {"formats": ["%Y-%m-%d"]}, None),
        ("string", "ab", "length", {"min": 3}, "Length must be at least 3"),
        ("array<int>", [1, 2, 3], "length", {"max": 2}, "Length must be at most 2"),
        ("int", 5, "length", {"max": 2}, "Value must have a length"),
        ("int", 5, "custom", {"function": lambda v: v > 5}, "Custom validation failed"),
        ("int", 5, "custom", {"function": lambda v: 1 / 0}, "Custom validation error: division by zero"),
    ],
)
def test_rules(spark, dtype, value, kind, parameters, message):
    df = spark.createDataFrame([(value,)], f"f {dtype}")
    got = quality.violations(df, [quality.Rule("f", kind, parameters)], []).collect()
    assert [r.message for r in got] == ([] if message is None else [message])


def test_secret_store_references_are_exempt(spark):
    texts = ["my Password", "keyvault:db-password", "https://v.vault.azure.net/secrets/token", "plain"]
    got = frame(spark, "t", texts).select("n", quality.is_sensitive(F.col("t")).alias("s")).collect()
    assert {r.n: r.s for r in got} == {0: True, 1: False, 2: False, 3: False}


def test_sensitive_values_at_any_depth(spark):
    """A thousand levels take the time of ten; lists inside lists are not entered."""
    import time

    def nested(levels):
        return '{"a": ' * (levels - 1) + '{"note": "my secret", "list": [{"v": "token"}, ["key"], "password"], "n": 1}' + "}" * (levels - 1)

    texts = [nested(1), nested(10), nested(900), nested(1200), '["secret"]', '"secret"', "secret", None, '{"s\\u0065cret": "x"}', '{"k": "keyvault:secret"}', '{"": {"a": "secret"}}']
    df = frame(spark, "t", texts)
    got = {}
    for r in quality.sensitive_values(df, ["n"], "t").collect():
        got.setdefault(r.n, {})[r.path] = (r.value, r.warnings)
    found = {"note": ("my secret", 1), "list[0].v": ("token", 1), "list[2]": ("password", 1)}
    for n, levels in ((0, 1), (1, 10), (2, 900)):
        assert got.pop(n) == {"a." * (levels - 1) + path: hit for path, hit in found.items()}
    assert got == {10: {"a": ("secret", 1)}}
    times = []
    for levels in (10, 900):
        began = time.monotonic()
        assert quality.sensitive_values(frame(spark, "t", [nested(levels)] * 50), ["n"], "t").count() == 150
        times.append(time.monotonic() - began)
    assert times[1] < 10 * times[0] + 5


# ---- redaction -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Write to jo.doe+x@mail.example.net today", "Write to [REDACTED:EMAIL] today"),
        ("212-867-5309", "[REDACTED:PHONE]"),
        ("dial 2128675309, else 867-5309", "dial [REDACTED:PHONE], else [REDACTED:PHONE]"),
        ("number 219-09-9999 of the form", "number [REDACTED:SSN] of the form"),
        ("6011-0009-9013-9424", "[REDACTED:CREDIT_CARD]"),
        ("6011000990139424", "[REDACTED:CREDIT_CARD]"),
        ("10.20.30.40", "[REDACTED:IPV4]"),
        ("b7" * 20, "[REDACTED:API_KEY]"),
        ("plain words", "plain words"),
    ],
)
def test_patterns(spark, text, expected):
    (row,) = frame(spark, "t", [text]).select(redaction.redact_text(F.col("t")).alias("r")).collect()
    assert row.r == expected


def test_nested_fields_and_names(spark):
    schema = (
        "user struct<email:string, phone:string, address:struct<street:string,zip:int>>, tags array<string>, "
        "people array<struct<password:string,note:string>>, grid array<array<string>>, api_token string, "
        "author int, note string, extra map<string,string>"
    )
    value = (
        ("u@v.io", "867-5309", ("9 Quay", 5)), ["w@v.io", "ok"], [("open", "10.0.0.1")], [["u@v.io"]],
        None, 7, "form 219-09-9999", {"my_secret": "v", "m": "dial 212-867-5309"},
    )
    (row,) = redaction.redact_frame(spark.createDataFrame([value], schema)).collect()
    assert row.user.email == "[REDACTED:EMAIL]" and row.user.address.street == "[REDACTED:STREET]"
    assert row.user.address.zip == 5
    assert row.tags == ["[REDACTED:EMAIL]", "ok"]
    assert tuple(row.people[0]) == ("[REDACTED:PASSWORD]", "[REDACTED:IPV4]")
    assert row.grid == [["u@v.io"]]
    assert row.api_token == "[REDACTED:API_TOKEN]" and row.author == "[REDACTED:AUTHOR]"
    assert row.note == "form [REDACTED:SSN]"
    assert row.extra == {"my_secret": "[REDACTED:MY_SECRET]", "m": "dial [REDACTED:PHONE]"}


def test_rejected_rows_keep_their_reason(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "n int, reason string")
    assert [r.n for r in accepted(df).collect()] == [1]
    assert [(r.n, r.reason) for r in rejected(df).collect()] == [(2, "bad")]


# ---- objects in pieces ---------------------------------------------------------------------------


def odd_objects():
    """Arrays with braces, brackets, quotes and escapes in strings, nested and scalar elements, and broken ones."""
    import json
    import random

    draw = random.Random(8)

    def value(depth=0):
        kind = draw.randrange(7 if depth < 3 else 4)
        if kind < 2:
            return draw.choice(['a}b', 'x]{["', 'tail\\', 'é "q" \\" {', "", "},{", '\\\\"', "\n}"])
        if kind < 4:
            return draw.choice([1, -2.5, True, None])
        if kind == 4:
            return [value(depth + 1) for _ in range(draw.randrange(3))]
        return {draw.choice(["k", "}", '"', "m]"]) + str(n): value(depth + 1) for n in range(draw.randrange(4))}

    texts = []
    for n in range(40):
        items = [draw.choice([value(1), {"n": n, "v": value()}]) for _ in range(draw.randrange(8))]
        texts.append(json.dumps(items, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 1, 2])) + draw.choice(["", "\n", "  \n"]))
    texts += ["[]", " [ ] ", "[1, 2]", '[{"a": 1}]', '\n[\n{"a": {}},\n{}]\n']
    lines = ['{"a": 1}\n{"b": "}"}\n\n{"c": [1]}', '{"a": 1}\n{broken\n{"b": 2}\n', "1\n2"]
    bad = ['[{"a": 1},]', '[{"a": 1}{"b": 2}]', '[{"a": 1}', '[{"a": 1}] x', '[{"a": 1}]\n[{"b": 2}]', '[,{"a": 1}]', '[{"a": 1},,{"b": 1}]', '[{"a": 1}]]', '{"a": 1}]', "[{'a': 1}]", '[{"a": 1}, {"b": "x]']
    return texts + lines + bad


def test_arrays_in_pieces_are_those_of_the_whole_object(spark, tmp_path):
    from logharbor.sources import json_splits
    from logharbor.session import SLICE_ROWS_KEY

    for n, text in enumerate(odd_objects()):
        (tmp_path / f"{n:03d}.json").write_text(text, encoding="utf-8", newline="")
    conf = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", SLICE_ROWS_KEY: "5"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        pieces, whole = (
            json_splits.read_json_objects(spark, str(tmp_path), large=large).selectExpr("path", "to_json(record) as r").groupBy("path").agg(F.sort_array(F.collect_list("r")).alias("r")).collect()
            for large in (0, 1 << 20)
        )
        splits = json_splits.read_pieces(spark, str(tmp_path)).groupBy("path").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0]
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert splits > 5
    names = lambda rows: {r.path.rsplit("/", 1)[1]: r.r for r in rows}
    assert names(pieces) == names(whole)
    assert len(names(pieces)) > 40
