"""Isolation forest: trees grown in parallel on small samples, scored by a pandas UDF."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.models.matrix import with_vector

# Fixed values
TREES = 120
SAMPLE = 256
OFFSET = 0.5
_SPARE = 4  # candidates kept per tree, as a multiple of the sample size

_NODES = "tree int, node int, feature int, split double, left int, right int, depth double"


def _mean_depth(size: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful search in a tree of that many rows."""
    n = np.asarray(size, dtype=float)
    safe = np.maximum(n, 2.0)
    length = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, length))


def _grow(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """Random splits until single rows or the height limit; leaves carry their depth."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list[float]] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, level, parent, side = todo.pop()
        place = len(nodes)
        if parent >= 0:
            nodes[parent][side] = place
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else np.array([], int)
        if level >= limit or not len(spread):
            nodes.append([tree, place, -1, 0.0, -1, -1, level + float(_mean_depth(len(rows)))])
            continue
        feature = int(rng.choice(spread))
        low, high = part[:, feature].min(), part[:, feature].max()
        split = float(rng.uniform(low, high))
        nodes.append([tree, place, feature, split, -1, -1, 0.0])
        below = part[:, feature] <= split
        todo.append((rows[~below], level + 1, place, 5))
        todo.append((rows[below], level + 1, place, 4))
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in _NODES.split(", ")])


@dataclass(frozen=True)
class IsolationModel:
    columns: tuple[str, ...]
    nodes: pd.DataFrame
    sample: int

    def score(self, df: DataFrame, into: str = "score") -> DataFrame:
        """Higher is more anomalous; 0 is the usual border."""
        trees = [
            {k: t[k].to_numpy() for k in ("feature", "split", "left", "right", "depth")}
            for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree")
        ]
        shared = df.sparkSession.sparkContext.broadcast(trees)  # at most TREES * 2 * SAMPLE nodes
        scale = float(_mean_depth(self.sample))

        @F.pandas_udf("double")
        def isolation_score(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=float)
            x = np.stack(features.to_numpy())
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for t in shared.value:
                at = np.zeros(len(x), dtype=int)
                while True:
                    inner = t["feature"][at] >= 0
                    if not inner.any():
                        break
                    node = at[inner]
                    goes_left = x[rows[inner], t["feature"][node]] <= t["split"][node]
                    at[inner] = np.where(goes_left, t["left"][node], t["right"][node])
                total += t["depth"][at]
            return pd.Series(np.power(2.0, -total / len(shared.value) / scale) - OFFSET)

        scored = with_vector(df, self.columns, "_vector")
        return scored.withColumn(into, isolation_score(F.col("_vector"))).drop("_vector")


def _draw(rows: DataFrame, row_id: str, trees: int, share: float, seed: int) -> DataFrame:
    """Rows tagged with the trees that draw them, each with probability ``share``.

    One hash decides how many trees a row serves (a binomial number, as if every tree drew by
    itself), another one which; so rows that serve none cost one hash, and a retry draws the
    same rows.
    """
    span = 1 << 40
    at_most, borders = 0.0, []
    for k in range(trees):
        at_most += math.comb(trees, k) * share**k * (1 - share) ** (trees - k)
        if at_most >= 1 - 1e-12:
            break
        borders.append(int(at_most * span))
    if not borders:
        return rows.limit(0).select(row_id, "x", F.lit(0).alias("tree"))
    number = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(span))
    served = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in borders]), lambda b: number >= b))
    kept = rows.filter(number >= borders[0])
    # steps that share no factor with the number of trees meet each tree once
    step = next(s for s in range(max(1, round(trees * 0.618)), 2 * trees + 2) if math.gcd(s, trees) == 1)
    first = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed + 1)), F.lit(trees))
    counted = kept.select(row_id, "x", served.alias("_n"), first.alias("_first"))
    picks = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda j: F.pmod(F.col("_first") + j * step, F.lit(trees)).cast("int"))
    return counted.filter("_n > 0").select(row_id, "x", F.explode(picks).alias("tree"))


def fit_isolation(
    normal: DataFrame,
    columns: Sequence[str],
    row_id: str,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = 42,
) -> IsolationModel:
    """Grow each tree on about ``sample`` rows drawn by hash.

    Only the drawn rows are shuffled: a few hundred per tree whatever the input size.
    """
    total = normal.agg(F.count("*")).first()[0]
    size = min(sample, total)
    share = min(1.0, _SPARE * size / max(total, 1))
    drawn = with_vector(normal, columns, "x").select(row_id, "x")
    chosen = _draw(drawn, row_id, trees, share, seed)

    def grow(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, int(key[0]), 1])
        ordered = batch.sort_values(row_id, kind="stable")
        keep = rng.permutation(len(ordered))[:size]
        return _grow(int(key[0]), np.stack(ordered["x"].to_numpy()[keep]), seed)

    nodes = chosen.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
    return IsolationModel(tuple(columns), nodes, size)
