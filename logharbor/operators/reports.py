"""Reports on failed write batches and the health verdict drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Error types raised by the log service client and by an open breaker, limits in percent.
SERVICE_ERRORS = ("AzureError", "HttpResponseError", "ServiceRequestError", "ClientAuthenticationError")
BREAKER_ERROR = "CircuitBreakerOpenError"
VALUE_ERROR = "ValueError"
FAILURE_LIMIT = 5.0
DROP_LIMIT = 10.0


def error_category(error_type: Column, message: Column, status_code: Column) -> Column:
    """Category of a failure; the first that applies wins."""
    kind = F.lower(error_type)
    status = F.coalesce(status_code.cast("string"), F.lit("unknown"))
    return (
        F.when(error_type.isin(*SERVICE_ERRORS), F.concat(F.lit("azure_error:"), status))
        .when(kind.contains("timeout") | F.lower(message).contains("timeout"), "network_timeout")
        .when(kind.contains("connection"), "network_connection")
        .when(error_type == BREAKER_ERROR, "circuit_breaker_open")
        .when(kind.contains("validation") | (error_type == VALUE_ERROR), "validation_error")
        .otherwise(F.concat(F.lit("unknown_error:"), error_type))
    )


def categorise(failures: DataFrame) -> DataFrame:
    category = error_category(F.col("error_type"), F.col("message"), F.col("status_code"))
    return failures.withColumn("error_category", category)


def advice(category: Column, count: Column) -> Column:
    detail = F.substring_index(category, ":", -1)
    times = count.cast("string")
    # Advice texts.
    return (
        F.when(
            category.contains("azure_error"),
            F.concat(
                F.lit("Azure API errors ("), detail, F.lit("): "), times,
                F.lit(" occurrences. Check Azure Sentinel service health and DCR endpoint configuration."),
            ),
        )
        .when(
            category.contains("network"),
            F.concat(
                F.lit("Network issues ("), category, F.lit("): "), times,
                F.lit(" occurrences. Check network connectivity and firewall rules."),
            ),
        )
        .when(
            category.contains("circuit_breaker_open"),
            F.concat(
                F.lit("Circuit breaker protection triggered: "), times,
                F.lit(" occurrences. Underlying service is experiencing issues - investigate root cause."),
            ),
        )
        .when(
            category.contains("validation_error"),
            F.concat(
                F.lit("Validation errors: "), times,
                F.lit(" occurrences. Check log schema compatibility with Sentinel table definitions."),
            ),
        )
    )


def failed_batch_report(outcomes: DataFrame) -> DataFrame:
    """Per error category: batches, records, advice, next to the totals over all batches.

    Input: one row per batch with `failed`, error_type, message, status_code and records. All batches
    are counted in the rate. The categories are few, so totals come from a window over them.
    """
    grouped = (
        categorise(outcomes)
        .groupBy(F.when(F.col("failed"), F.col("error_category")).alias("error_category"))
        .agg(F.count("*").alias("failed_batches"), F.sum("records").alias("failed_records"))
    )
    whole = Window.partitionBy()
    bad = F.coalesce(F.sum(F.when(F.col("error_category").isNotNull(), F.col("failed_batches"))).over(whole), F.lit(0))
    every = F.sum("failed_batches").over(whole)
    return grouped.select(
        "error_category",
        "failed_batches",
        "failed_records",
        bad.alias("total_failed_batches"),
        every.alias("total_batches"),
        F.round(bad * F.lit(100.0) / every, 2).alias("failure_rate_percent"),
        advice(F.col("error_category"), F.col("failed_batches")).alias("recommendation"),
    ).where(F.col("error_category").isNotNull())


def top_failure_reasons(outcomes: DataFrame, n: int = 3) -> DataFrame:
    """The most frequent categories among failed batches."""
    return (
        categorise(outcomes.where("failed"))
        .groupBy("error_category")
        .agg(F.count("*").alias("failed_batches"))
        .orderBy(F.desc("failed_batches"), "error_category")
        .limit(n)
    )


def health_verdict(totals: DataFrame) -> DataFrame:
    """Adds both rates in percent and the status.

    Input: batches, failed_batches, rows, dropped_rows, failed_records and breaker_open.
    """
    failure = F.round(F.coalesce(F.try_divide(F.col("failed_batches") * 100.0, "batches"), F.lit(0.0)), 2)
    drop = F.round(F.coalesce(F.try_divide(F.col("dropped_rows") * 100.0, "rows"), F.lit(0.0)), 2)
    degraded = (
        F.col("breaker_open") | (failure > FAILURE_LIMIT) | (drop > DROP_LIMIT) | (F.col("failed_records") > 0)
    )
    return totals.withColumns(
        {
            "failure_rate_percent": failure,
            "drop_rate_percent": drop,
            "status": F.when(degraded, "degraded").otherwise("healthy"),
        }
    )
