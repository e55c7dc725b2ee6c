"""Declared table schemas, rules and conditions that the jobs compile into column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

#: Declared type names and the Spark types they stand for.
SPARK_TYPES = {
    "datetime": T.TimestampType(),
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str
    required: bool = False
    allowed: tuple[str, ...] = ()

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class TableSpec:
    """One destination table: its columns, the source names mapped onto them, and write limits."""

    log_type: str
    table_name: str
    schema_version: str
    retention_days: int
    batch_size: int
    fields: tuple[FieldSpec, ...]
    mapping: dict[str, str] = field(default_factory=dict)
    #: further source names tried after the mapped and the same-named column
    fallbacks: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, not f.required) for f in self.fields])

    def sources_of(self, target: str) -> list[str]:
        mapped = [source for source, mapped_to in self.mapping.items() if mapped_to == target]
        return mapped + [target, *self.fallbacks.get(target, ())]


# Destination tables, versions, limits, column types and source field names.
FIREWALL = TableSpec(
    log_type="firewall",
    table_name="Custom_Firewall_CL",
    schema_version="1.0",
    retention_days=90,
    batch_size=1000,
    fields=(
        FieldSpec("TimeGenerated", "datetime", True),
        FieldSpec("SourceIP", "string", True),
        FieldSpec("DestinationIP", "string", True),
        FieldSpec("Action", "string", True, ("allow", "deny", "drop")),
        FieldSpec("Protocol", "string"),
        FieldSpec("SourcePort", "integer"),
        FieldSpec("DestinationPort", "integer"),
        FieldSpec("BytesTransferred", "long"),
        FieldSpec("RuleName", "string"),
    ),
    mapping={
        "src_ip": "SourceIP",
        "dst_ip": "DestinationIP",
        "action": "Action",
        "proto": "Protocol",
        "src_port": "SourcePort",
        "dst_port": "DestinationPort",
        "bytes": "BytesTransferred",
        "rule_name": "RuleName",
    },
    fallbacks={"Action": ("FirewallAction",)},
)

VPN = TableSpec(
    log_type="vpn",
    table_name="Custom_VPN_CL",
    schema_version="2.1",
    retention_days=30,
    batch_size=500,
    fields=(
        FieldSpec("TimeGenerated", "datetime", True),
        FieldSpec("UserPrincipalName", "string", True),
        FieldSpec("SessionID", "string", True),
        FieldSpec("ClientIP", "string", True),
        FieldSpec("BytesIn", "long"),
        FieldSpec("BytesOut", "long"),
        FieldSpec("ConnectionDuration", "integer"),
    ),
    mapping={
        "user": "UserPrincipalName",
        "session": "SessionID",
        "ip_address": "ClientIP",
        "bytes_received": "BytesIn",
        "bytes_sent": "BytesOut",
        "duration": "ConnectionDuration",
    },
)


def narrowed(spec: TableSpec, names: list[str], required: list[str] | None = None) -> TableSpec:
    """The same table kept to fewer columns, with the required set restated."""
    needed = set(spec.required if required is None else required)
    return replace(
        spec,
        fields=tuple(replace(f, required=f.name in needed) for f in spec.fields if f.name in names),
        mapping={s: t for s, t in spec.mapping.items() if t in names},
    )


#: The narrower projection that keeps only mapped, required and typed columns.
FIREWALL_STRICT = narrowed(
    FIREWALL, ["TimeGenerated", "SourceIP", "DestinationIP", "Action", "BytesTransferred"]
)
VPN_STRICT = narrowed(
    VPN,
    ["TimeGenerated", "UserPrincipalName", "SessionID", "ClientIP", "BytesIn", "BytesOut"],
    ["TimeGenerated", "UserPrincipalName", "SessionID"],
)

TABLES = {spec.log_type: spec for spec in (FIREWALL, VPN)}


@dataclass(frozen=True)
class AlertCondition:
    """A metric condition that must hold for `duration` seconds before it fires."""

    name: str
    metric_name: str
    threshold: float
    operator: str = "gt"
    duration: int = 60
    severity: str = "warning"
