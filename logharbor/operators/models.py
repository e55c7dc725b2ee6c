"""Priority models: fitting on labelled rows, scoring, storing and refreshing."""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.operators.features import DEFAULT_PRIORITY

#: Fixed value: fewest new rows that justify a refresh.
REFRESH_ROWS = 1000


def fit_priority_model(labelled: DataFrame, columns: list[str], label: str = "label") -> PipelineModel:
    """Scaling and logistic regression over the features; the fit is a distributed job."""
    stages = [
        VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep"),
        StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_scaled", labelCol=label, maxIter=20, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(labelled)


def score_priority(rows: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Adds `priority_score`: the model's probability of the positive class, 1.0 without a model."""
    if model is None:
        return rows.withColumn("priority_score", F.lit(DEFAULT_PRIORITY))
    scored = model.transform(rows)
    return scored.withColumn("priority_score", vector_to_array("probability")[1]).select(
        *rows.columns, "priority_score"
    )


def score_with(rows: DataFrame, columns: list[str], model: Any) -> DataFrame:
    """Adds `priority_score` from a model of the user's own, an object with `predict` over a table of features.

    The object is sent to the workers and sees one Arrow batch at a time.
    """

    @F.pandas_udf("double")
    def scores(features: pd.DataFrame) -> pd.Series:
        return pd.Series(model.predict(features[columns])).astype("float64")

    return rows.withColumn("priority_score", scores(F.struct(*columns)))


def refresh_model(
    labelled: DataFrame, columns: list[str], path: str | None = None, min_rows: int = REFRESH_ROWS, label: str = "label"
) -> PipelineModel | None:
    """Fit again and store when there are enough labelled rows, else None.

    The count stops at `min_rows`, so it does not read the whole table to decide.
    """
    if labelled.limit(min_rows).count() < min_rows:
        return None
    model = fit_priority_model(labelled, columns, label)
    if path is not None:
        model.write().overwrite().save(path)
    return model


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_weights(df: DataFrame, model: PipelineModel, columns: list[str]) -> DataFrame:
    """The fitted weight of each feature, as a small frame."""
    weights = model.stages[-1].coefficients.toArray()
    rows = [(name, float(w)) for name, w in zip(columns, weights, strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double")
