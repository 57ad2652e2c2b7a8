"""Model evaluation."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse(predictions: DataFrame, label: str = "relevance", prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName="rmse").evaluate(predictions)


def rmse_column(label: str = "relevance", prediction: str = "prediction") -> Column:
    """RMSE as an aggregate expression (one distributed pass)."""
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))


def label_std(df: DataFrame, label: str = "relevance") -> float:
    """Population standard deviation: the RMSE of always predicting the mean."""
    return df.agg(F.stddev_pop(label)).first()[0]
