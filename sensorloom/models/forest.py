"""Balanced random forest: grown by MLlib, kept as node arrays, scored over Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.models.matrix import guard_features, with_vector
from sensorloom.operators.evaluate import with_class_weight
from sensorloom.session import scratch_path


@dataclass(frozen=True)
class Tree:
    """Nodes by number; ``feature`` is -1 at a leaf, ``share`` the weighted share of positives there."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            node = at[moving]
            below = x[moving, self.feature[node]] <= self.threshold[node]
            at[moving] = np.where(below, self.left[node], self.right[node])
            moving = moving[self.feature[at[moving]] >= 0]
        return self.share[at]


@dataclass(frozen=True)
class ForestModel:
    columns: tuple[str, ...]
    trees: tuple[Tree, ...]
    importances: tuple[float, ...]

    def scored(self, df: DataFrame, into: str = "score") -> DataFrame:
        """Mean share of positives over the trees; null where a feature is null."""
        shared = df.sparkSession.sparkContext.broadcast(self.trees)  # at most trees * 2^(depth + 1) nodes

        @F.pandas_udf("double")
        def share_of_positives(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=float)
            x = np.stack(features.to_numpy()).astype(float)
            total = sum(tree.shares(x) for tree in shared.value) / len(shared.value)
            return pd.Series(np.where(np.isnan(x).any(axis=1), np.nan, total))

        scored = with_vector(df, self.columns, "_vector").withColumn(into, share_of_positives("_vector"))
        return scored.withColumn(into, F.when(~F.isnan(into), F.col(into))).drop("_vector")


def fit_forest(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    trees: int = 120,
    depth: int = 10,
    leaf: int = 20,
    seed: int = 42,
) -> ForestModel:
    """Grow the forest on weighted classes.

    Its nodes are read from the model's saved table, whose size is bounded by trees and depth, so scoring needs nothing
    of the trainer in its plan.
    """
    guard_features(columns)
    weighted = with_class_weight(train, label, None)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    grower = RandomForestClassifier(
        labelCol=label,
        weightCol="class_weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=leaf,
        seed=seed,
    )
    found = grower.fit(assembler.transform(weighted))
    path = scratch_path(train.sparkSession, "forest")
    found.write().save(path)
    nodes = train.sparkSession.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.impurityStats").alias("stats"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", 0).alias("threshold"),
    )
    grown = [_tree(rows) for _, rows in nodes.toPandas().sort_values(["tree", "node"]).groupby("tree")]
    return ForestModel(tuple(columns), tuple(grown), tuple(float(w) for w in found.featureImportances.toArray()))


def _tree(rows: pd.DataFrame) -> Tree:
    stats = np.array([list(s) + [0.0] * (2 - len(s)) for s in rows["stats"]], float)
    inner = rows["left"].to_numpy() >= 0
    return Tree(
        np.where(inner, rows["feature"].to_numpy(), -1).astype(np.int64),
        np.where(inner, rows["threshold"].to_numpy(float), 0.0),
        rows["left"].to_numpy(np.int64),
        rows["right"].to_numpy(np.int64),
        stats[:, 1] / np.maximum(stats.sum(axis=1), 1e-300),
    )
