"""Class-weighted logistic regression: MLlib solver, and plain gradient descent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.scalars import sigmoid
from sensorloom.models.matrix import guard_features, with_vector
from sensorloom.operators.evaluate import with_class_weight

# Fixed values
ITERATIONS = 220
LEARNING_RATE = 0.08
L2 = 0.001


@dataclass(frozen=True)
class LinearModel:
    columns: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]

    def score(self) -> Column:
        """Probability of the positive class as one expression; null where a feature is null."""
        terms = [F.col(c) * F.lit(w) for c, w in zip(self.columns, self.weights, strict=True)]
        return sigmoid(sum(terms, F.lit(self.intercept)))

    def scored(self, df: DataFrame, into: str = "score") -> DataFrame:
        return df.withColumn(into, self.score())


def fit_logistic(train: DataFrame, columns: Sequence[str], label: str, cap: float | None = 30.0) -> LinearModel:
    """L-BFGS on the weighted, L2-regularised log loss; columns are already standardised."""
    guard_features(columns)
    weighted = with_class_weight(train, label, cap)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    solver = LogisticRegression(
        labelCol=label, weightCol="class_weight", maxIter=ITERATIONS, regParam=L2, standardization=False
    )
    found = solver.fit(assembler.transform(weighted))
    return LinearModel(tuple(columns), float(found.intercept), tuple(float(w) for w in found.coefficients.toArray()))


def fit_gradient(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    iterations: int = ITERATIONS,
    rate: float = LEARNING_RATE,
    l2: float = L2,
    cap: float = 30.0,
) -> LinearModel:
    """Full-batch gradient descent; each step is one distributed sum over all rows.

    Tasks turn a batch of rows into one partial gradient, Spark adds the partials, and
    only the summed gradient (one number per feature) reaches the driver.
    """
    weighted = with_class_weight(with_vector(train, columns), label, cap)
    rows = weighted.select("features", F.col(label).cast("double").alias("y"), "class_weight").persist()
    try:
        total_weight = rows.agg(F.sum("class_weight")).first()[0]
        coef = np.zeros(len(columns) + 1)
        for _ in range(iterations):
            gradient = _gradient(rows, coef) / total_weight
            gradient[1:] += l2 * coef[1:]
            coef = coef - rate * gradient
    finally:
        rows.unpersist()
    return LinearModel(tuple(columns), float(coef[0]), tuple(float(c) for c in coef[1:]))


def _gradient(rows: DataFrame, coef: np.ndarray) -> np.ndarray:
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(coef))
        for batch in batches:
            if len(batch):
                x = np.stack(batch["features"].to_numpy())
                z = np.clip(coef[0] + x @ coef[1:], -35, 35)
                error = (1.0 / (1.0 + np.exp(-z)) - batch["y"].to_numpy()) * batch["class_weight"].to_numpy()
                total[0] += error.sum()
                total[1:] += x.T @ error
        yield pd.DataFrame({"place": np.arange(len(coef)), "part": total})

    summed = rows.mapInPandas(partial, "place int, part double").groupBy("place").agg(F.sum("part").alias("part"))
    out = np.zeros(len(coef))
    for row in summed.collect():  # one row per feature
        out[row["place"]] = row["part"]
    return out
