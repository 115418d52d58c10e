"""A fitted linear classifier as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.functions.columns import linear, logistic


@dataclass
class LinearFit:
    """A fitted linear classifier that scores rows by a generated expression, without vectors."""

    intercept: float
    weights: Mapping[str, float]
    std_errors: Mapping[str, float] = field(default_factory=dict)

    def eta(self) -> Column:
        return linear(self.weights, self.intercept)

    def probability(self) -> Column:
        return logistic(self.eta())

    def transform(self, df: DataFrame, prediction: str = "y_pred", probability: str | None = "score") -> DataFrame:
        """Add the predicted class (probability above one half) and the probability."""
        columns = {prediction: F.when(self.eta() > 0, 1).when(self.eta() <= 0, 0)}
        if probability:
            columns[probability] = self.probability()
        return df.withColumns(columns)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [("(Intercept)", self.intercept, self.std_errors.get("(Intercept)"))]
        rows += [(k, v, self.std_errors.get(k)) for k, v in self.weights.items()]
        rows = [(k, float(v), None if s is None else float(s)) for k, v, s in rows]
        return spark.createDataFrame(rows, "term string, estimate double, std_error double")
