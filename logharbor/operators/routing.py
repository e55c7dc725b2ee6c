"""Mapping log rows onto destination tables, with the reason for every row left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logharbor.functions.tagging import REASON, computed_once, first_reason, missing_names
from logharbor.functions.timestamps import LOG_FORMATS, as_timestamp, parse_timestamp
from logharbor.specs import TABLES, FieldSpec, TableSpec

# Columns that may hold the event time, and the words for true and false.
TIME_CANDIDATES = ("timestamp", "time", "datetime", "event_time")
TRUE_WORDS = ("true", "1", "yes", "on")
FALSE_WORDS = ("false", "0", "no", "off")


def mapped_column(df: DataFrame, spec: TableSpec, target: str) -> Column:
    """Mapped source first, then the column of the target's own name, then fallbacks."""
    present = [F.col(f"`{name}`") for name in spec.sources_of(target) if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None)


def to_type(value: Column, found: T.DataType, wanted: FieldSpec) -> Column:
    """Value in the declared type; null where it does not convert."""
    if wanted.type == "datetime":
        if isinstance(found, T.StringType):
            return F.coalesce(parse_timestamp(value, LOG_FORMATS), value.try_cast("timestamp"))
        return value.cast("timestamp")
    if wanted.type == "boolean" and isinstance(found, T.StringType):
        word = F.lower(value)
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    return value.try_cast(wanted.spark_type)


def prepare_rows(
    df: DataFrame,
    spec: TableSpec,
    as_of,
    classification: str = "standard",
    keep: list[str] = (),
    check_values: bool = False,
) -> DataFrame:
    """The table's columns plus `reason` in one narrow pass; conversion is judged before absence.

    With `check_values`, a value outside the allowed ones of its column (in any case) is a reason too,
    judged last.

    A missing event time becomes `as_of`; a time that does not convert is a conversion failure.
    """
    raw = {f"_{f.name}": mapped_column(df, spec, f.name) for f in spec.fields}
    staged = df.select(*keep, "*", *[c.alias(n) for n, c in raw.items()])
    time = spec.fields[0].name
    times = [n for n in TIME_CANDIDATES if n in df.columns and n not in spec.mapping]
    if times:
        first = F.coalesce(F.col(f"_{time}").cast("string"), *[F.col(n).cast("string") for n in times])
        staged = staged.withColumn(f"_{time}", first)

    typed = staged.withColumns(
        {f"__{f.name}": to_type(F.col(f"_{f.name}"), staged.schema[f"_{f.name}"].dataType, f) for f in spec.fields}
    )
    failed = [F.col(f"_{f.name}").isNotNull() & F.col(f"__{f.name}").isNull() for f in spec.fields]
    any_failed = failed[0]
    for condition in failed[1:]:
        any_failed = any_failed | condition

    final = typed.select(
        *keep,
        *[
            (F.coalesce(F.col(f"__{f.name}"), as_timestamp(as_of)) if f.name == time else F.col(f"__{f.name}")).alias(f.name)
            for f in spec.fields
        ],
        any_failed.alias("_failed"),
    )
    missing = missing_names(spec.required)
    reason = first_reason(
        (F.col("_failed"), "preparation_error:ValueError"),
        (missing != "", F.concat(F.lit("missing_fields:"), missing)),
        *[
            (~F.lower(F.col(f.name)).isin(*f.allowed), f"bad_value:{f.name}")
            for f in spec.fields
            if check_values and f.allowed
        ],
    )
    return computed_once(
        final,
        *keep,
        *[f.name for f in spec.fields],
        F.lit(classification).alias("DataClassification"),
        F.lit(spec.schema_version).alias("SchemaVersion"),
        reason.alias(REASON),
    )


def spec_table(df: DataFrame, specs: dict[str, TableSpec] | None = None) -> DataFrame:
    """The declared tables as a small frame, one row per log type."""
    rows = [
        (s.log_type, s.table_name, s.schema_version, s.retention_days, s.batch_size)
        for s in (specs or TABLES).values()
    ]
    schema = "log_type string, table_name string, schema_version string, retention_days int, batch_size int"
    return df.sparkSession.createDataFrame(rows, schema)


def lookup_route(df: DataFrame, log_type: str = "log_type", specs=None) -> DataFrame:
    """Adds the destination of each row; `table_name` is null for an unsupported log type."""
    specs = specs or TABLES
    routed = df
    for name in ("table_name", "schema_version", "retention_days", "batch_size"):
        value = F.lit(None)
        for spec in specs.values():
            value = F.when(F.col(log_type) == spec.log_type, F.lit(getattr(spec, name))).otherwise(value)
        routed = routed.withColumn(name, value)
    return routed


def unsupported_types(df: DataFrame, log_type: str = "log_type", specs=None) -> DataFrame:
    """Log types without a table, with their row counts."""
    known = list(specs or TABLES)
    return (
        df.where(F.col(log_type).isNull() | ~F.col(log_type).isin(*known))
        .groupBy(log_type)
        .agg(F.count("*").alias("rows"))
    )


def route_counts(tagged: DataFrame, by: list[str] = ()) -> DataFrame:
    """Rows accepted and dropped, per destination."""
    return tagged.groupBy(*by).agg(
        F.count_if(F.col(REASON).isNull()).alias("processed"), F.count(REASON).alias("dropped")
    )


def drop_reasons(tagged: DataFrame, by: list[str] = ()) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull()).groupBy(*by, REASON).agg(F.count("*").alias("dropped"))


def drop_recommendation(reason: Column) -> Column:
    detail = F.substring_index(reason, ":", -1)
    # Advice texts.
    return F.when(
        reason.contains("missing_fields"),
        F.concat(F.lit("Fix missing fields: "), detail, F.lit(". Check log parser schema mapping.")),
    ).when(
        reason.contains("preparation_error"),
        F.concat(
            F.lit("Fix preparation errors ("),
            detail,
            F.lit("). Check data type conversions and field mappings."),
        ),
    )


def drop_totals(tagged: DataFrame) -> DataFrame:
    """One row: rows processed, rows dropped and the dropped share in percent."""
    dropped, total = F.count(REASON), F.count("*")
    rate = F.coalesce(F.try_divide(dropped * 100.0, total), F.lit(0.0))
    return tagged.agg(
        dropped.alias("total_dropped"),
        (total - dropped).alias("total_processed"),
        F.round(rate, 2).alias("drop_rate_percent"),
    )


def drop_report(tagged: DataFrame) -> DataFrame:
    """Per reason: count and advice, next to the totals; the input is read once.

    The reasons form a small table bounded by the spec, so the totals come from a window over it.
    """
    whole = Window.partitionBy()
    per_reason = tagged.groupBy(REASON).agg(F.count("*").alias("dropped"))
    lost = F.sum(F.when(F.col(REASON).isNotNull(), F.col("dropped"))).over(whole)
    every = F.sum("dropped").over(whole)
    return (
        per_reason.select(
            REASON,
            "dropped",
            F.coalesce(lost, F.lit(0)).alias("total_dropped"),
            (every - F.coalesce(lost, F.lit(0))).alias("total_processed"),
            F.round(F.coalesce(lost, F.lit(0)) * 100.0 / every, 2).alias("drop_rate_percent"),
            drop_recommendation(F.col(REASON)).alias("recommendation"),
        )
        .where(F.col(REASON).isNotNull())
    )


def schema_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns found against columns declared, whether they agree, and the nulls each one holds.

    A declared column that is absent counts as null in every row.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = {f.name: f.spark_type.simpleString() for f in spec.fields}
    names = [*declared, *(n for n in found if n not in declared)]
    totals = df.agg(
        F.count("*").alias("_rows"),
        *[(F.count(f"`{n}`") if n in found else F.lit(0)).alias(f"_n{i}") for i, n in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(found.get(n)).cast("string").alias("found_type"),
            F.lit(declared.get(n)).cast("string").alias("declared_type"),
            F.lit(found.get(n) == declared.get(n)).alias("conforms"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
        )
        for i, n in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*lines)))
