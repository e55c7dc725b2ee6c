"""Numeric features of log rows, their scaling, and the anomaly and priority scores on top."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.timestamps import as_timestamp

# Level scores, working hours, the anomaly threshold and default scores.
LEVEL_SCORES = {"ERROR": 3.0, "WARNING": 2.0, "INFO": 1.0, "DEBUG": 0.0}
FIRST_HOUR, LAST_HOUR = 9, 17
ANOMALY_THRESHOLD = 0.95
DEFAULT_PRIORITY = 1.0
MISSING_PRIORITY = 0.5

Extractor = Callable[[DataFrame], dict[str, Column]]


def _text(df: DataFrame, name: str, default: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in df.columns else F.lit(default)


def temporal_features(df: DataFrame, as_of=None) -> dict[str, Column]:
    """Hour and weekday (Monday = 0); an absent time counts as `as_of`."""
    times = [F.col(n).try_cast("timestamp") for n in ("timestamp", "ts", "TimeGenerated") if n in df.columns]
    fallback = as_timestamp(as_of) if as_of is not None else F.current_timestamp()
    ts = F.coalesce(*times, fallback)
    hour, day = F.hour(ts), F.weekday(ts)
    return {
        "hour": hour,
        "day_of_week": day,
        "is_weekend": day >= 5,
        "is_business_hours": hour.between(FIRST_HOUR, LAST_HOUR),
    }


def textual_features(df: DataFrame) -> dict[str, Column]:
    message = _text(df, "message", "")
    words = F.filter(F.split(message, r"\s+"), lambda w: w != "")
    return {"message_length": F.length(message), "word_count": F.size(words)}


def embedding_features(embedding: Column) -> dict[str, Column]:
    """Mean and population deviation of a vector."""
    n = F.size(embedding).cast("double")
    total = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + x)
    mean = F.try_divide(total, n)
    squares = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    return {"text_embedding_mean": mean, "text_embedding_std": F.sqrt(F.try_divide(squares, n))}


def numerical_features(df: DataFrame, record: list[str] | None = None) -> dict[str, Column]:
    """Size of the record as JSON text, and level flags."""
    level = F.upper(_text(df, "level", ""))
    columns = df.columns if record is None else record
    return {
        "log_size": F.length(F.to_json(F.struct(*columns))),
        "has_error_level": level == "ERROR",
        "has_warning_level": level == "WARNING",
    }


def categorical_features(df: DataFrame) -> dict[str, Column]:
    level = F.upper(_text(df, "level", "UNKNOWN"))
    score = F.lit(0.0)
    for name, value in LEVEL_SCORES.items():
        score = F.when(level == name, value).otherwise(score)
    return {
        "level_score": score,
        "source_length": F.length(_text(df, "source", "UNKNOWN")),
        "type_length": F.length(_text(df, "type", "UNKNOWN")),
    }


def default_extractors(as_of, record: list[str] | None = None) -> dict[str, Extractor]:
    return {
        "temporal": lambda df: temporal_features(df, as_of),
        "textual": textual_features,
        "numerical": lambda df: numerical_features(df, record),
        "categorical": categorical_features,
    }


def extract_features(df: DataFrame, extractors: dict[str, Extractor], keep: list[str]) -> DataFrame:
    """`keep` plus all features as doubles, missing ones 0, in one projection."""
    features: dict[str, Column] = {}
    for extractor in extractors.values():
        features.update(extractor(df))
    return df.select(
        *keep, *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in features.items()]
    )


FEATURES = (
    "hour", "day_of_week", "is_weekend", "is_business_hours", "message_length", "word_count",
    "log_size", "has_error_level", "has_warning_level", "level_score", "source_length", "type_length",
)


def scaler_state(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per feature: rows, mean and sum of squared deviations. Small, storable, mergeable."""
    totals = df.agg(
        F.count("*").alias("_n"),
        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(c).alias(f"_v{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col("_n").alias("n"),
            F.col(f"_m{i}").alias("mean"),
            (F.col(f"_v{i}") * F.col("_n")).alias("squares"),
        )
        for i, c in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*rows)))


def merge_states(*states: DataFrame) -> DataFrame:
    """State of the rows of all given states together; refreshing a scaler is merging one more."""
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    grouped = union.groupBy("feature").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum(F.col("squares") + F.col("n") * F.col("mean") * F.col("mean")).alias("_raw"),
    )
    squares = F.greatest(F.col("_raw") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    return grouped.select("feature", "n", "mean", squares.alias("squares"))


def scale(df: DataFrame, columns: list[str], state: DataFrame) -> DataFrame:
    """Columns centred and divided by their deviation (1 where it is 0); the state is a subquery."""
    deviation = F.sqrt(F.col("squares") / F.col("n"))

    def entry(c: str) -> Column:
        of_c = F.col("feature") == c
        mean, spread = F.max(F.when(of_c, F.col("mean"))), F.max(F.when(of_c & (deviation > 0), deviation))
        return F.struct(mean.alias("mean"), F.coalesce(spread, F.lit(1.0)).alias("deviation")).alias(c)

    lookup = state.agg(F.struct(*[entry(c) for c in columns]).alias("s")).scalar()
    staged = df.withColumn("_scaler", lookup)
    scaled = {c: (F.col(c) - F.col(f"_scaler.{c}.mean")) / F.col(f"_scaler.{c}.deviation") for c in columns}
    return staged.withColumns(scaled).drop("_scaler")


def anomaly_score(scaled: list[str]) -> Column:
    """Distance of scaled features from their mean, mapped to [0, 1)."""
    distance = F.lit(0.0)
    for c in scaled:
        distance = distance + F.col(c) * F.col(c)
    return F.lit(1.0) - F.exp(-distance / F.lit(float(len(scaled))) / F.lit(2.0))


def flag_anomalies(scaled: DataFrame, columns: list[str], threshold: float = ANOMALY_THRESHOLD) -> DataFrame:
    """Adds `anomaly_score` and `is_anomaly`."""
    scored = scaled.withColumn("anomaly_score", anomaly_score(columns))
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > threshold)


def strong_correlations(df: DataFrame, columns: list[str], limit: float = 0.7) -> DataFrame:
    """Pairs of features with |Pearson| over the limit; constants are left out.

    The means come first, as a scalar subquery; then one aggregation sums the products of the centred
    values, in plain sums that stay inside generated code. Features are expected to be filled.
    """
    mean = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("m")).scalar()
    centred = df.select(*columns).withColumn("_m", mean).select(*[(F.col(c) - F.col(f"_m.{c}")).alias(c) for c in columns])
    pairs = [(a, b) for a in columns for b in columns if a < b]
    totals = centred.agg(
        *[F.sum(F.col(c) * F.col(c)).alias(f"_d_{c}") for c in columns],
        *[F.sum(F.col(a) * F.col(b)).alias(f"_c_{a}_{b}") for a, b in pairs],
    )
    rows = [
        F.struct(
            F.lit(f"{a}_{b}").alias("pair"),
            F.try_divide(F.col(f"_c_{a}_{b}"), F.sqrt(F.col(f"_d_{a}")) * F.sqrt(F.col(f"_d_{b}"))).alias("correlation"),
        )
        for a, b in pairs
    ]
    return totals.select(F.inline(F.array(*rows))).where(F.abs("correlation") > limit)
