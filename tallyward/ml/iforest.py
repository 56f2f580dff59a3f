"""Distributed isolation forest (Liu, Ting and Zhou, 2008).

Each tree sees a hash-chosen sample of ``psi`` rows, so trees grow independently in a grouped
map of at most ``psi`` rows per group. The forest is a small node table: at most
``trees * (2 * psi - 1)`` rows whatever the size of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EULER = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, cut double, n_left int, n_right int, size int, depth int"


@dataclass
class IsolationForest:
    """Node table plus the offset that puts ``contamination`` of the training rows below 0."""

    nodes: pd.DataFrame
    features: list[str]
    trees: int
    psi: int
    offset: float

    def save(self, spark, path: str) -> None:
        meta = pd.DataFrame({"features": [",".join(self.features)], "trees": [self.trees],
                             "psi": [self.psi], "offset": [float(self.offset)]})
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(meta).write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForest":
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # bounded by trees * 2 * psi
        return cls(nodes, meta["features"].split(","), meta["trees"], meta["psi"], meta["offset"])


def path_normal(n):
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Random splits until a node holds one distinct row or the depth limit is reached."""
    nodes, stack = [], [(0, np.arange(len(x)), 0)]
    reserved = 1
    while stack:
        me, rows, depth = stack.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((me, -1, 0.0, -1, -1, len(rows), depth))
            continue
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        if cut >= high[f]:  # keeps at least one row on each side
            cut = float(low[f])
        goes_left = part[:, f] <= cut
        left, right = reserved, reserved + 1
        reserved += 2
        nodes.append((me, f, cut, left, right, len(rows), depth))
        stack += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def sample_rows(matrix: DataFrame, key: str, trees: int, psi: int, seed: int) -> DataFrame:
    """``psi`` rows per tree (all rows, if there are fewer), chosen by hash.

    One hash per row picks a pool some four times the rows all trees need together; only pool
    rows are then drawn for single trees. Ordering by the hash makes the draw repeatable.
    """
    n = matrix.count()
    span = 1 << 30
    pool_share = min(1.0, 4.0 * trees * psi / max(n, 1))
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(span))
    pool = matrix.filter(u < F.lit(int(pool_share * span)))
    expected = n * pool_share
    tree_share = min(1.0, 3.0 * psi / max(expected, 1.0))
    bound = int(tree_share * span)
    draws = F.expr(
        f"filter(transform(sequence(0, {trees - 1}), t -> named_struct('tree', t, 'h', "
        f"pmod(xxhash64({key}, t, {seed}L), {span}L))), x -> x.h < {bound})")
    drawn = pool.withColumn("d", F.explode(draws)).select("*", "d.tree", "d.h").drop("d")
    w = Window.partitionBy("tree").orderBy("h", key)
    return drawn.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= psi).drop("_rank")


def grow_trees(sample: DataFrame, features: list[str], psi: int, seed: int) -> DataFrame:
    limit = int(np.ceil(np.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("h", kind="stable")[features].to_numpy(dtype=float)
        rows = _grow(x, np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(rows, columns=["node", "feature", "cut", "n_left", "n_right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "n_left": "int32",
                           "n_right": "int32", "size": "int32", "depth": "int32"})

    columns = ["tree", "h", *features]
    return sample.select(*columns).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def _layout(forest: IsolationForest):
    """Node arrays indexed [tree, node]; leaves point to themselves."""
    t = forest.nodes
    width = int(t["node"].max()) + 1
    shape = (forest.trees, width)
    feature, cut = np.zeros(shape, np.int32), np.full(shape, np.inf)
    left, right = np.tile(np.arange(width, dtype=np.int32), (forest.trees, 1)), None
    right = left.copy()
    length = np.zeros(shape)
    i, j = t["tree"].to_numpy(), t["node"].to_numpy()
    inner = t["feature"].to_numpy() >= 0
    feature[i[inner], j[inner]] = t["feature"].to_numpy()[inner]
    cut[i[inner], j[inner]] = t["cut"].to_numpy()[inner]
    left[i[inner], j[inner]] = t["n_left"].to_numpy()[inner]
    right[i[inner], j[inner]] = t["n_right"].to_numpy()[inner]
    length[i, j] = t["depth"].to_numpy() + path_normal(t["size"].to_numpy())
    return feature, cut, left, right, length, int(t["depth"].max())


def anomaly_scores(x: np.ndarray, layout, psi: int) -> np.ndarray:
    """Negated anomaly score of each row, in [-1, 0]; lower is stranger."""
    feature, cut, left, right, length, depth = layout
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in range(feature.shape[0]):
        at = np.zeros(len(x), np.int32)
        for _ in range(depth):
            goes_left = x[rows, feature[t][at]] <= cut[t][at]
            at = np.where(goes_left, left[t][at], right[t][at])
        total += length[t][at]
    return -np.power(2.0, -(total / feature.shape[0]) / float(path_normal(psi)))


def with_anomaly(df: DataFrame, forest: IsolationForest, out: str = "anomaly") -> DataFrame:
    """Append the negated anomaly score, in Arrow batches against a broadcast forest."""
    shared = df.sparkSession.sparkContext.broadcast((_layout(forest), forest.psi))

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        layout, psi = shared.value
        if len(vectors) == 0:
            return pd.Series([], dtype=float)
        return pd.Series(anomaly_scores(np.stack(vectors.to_numpy()), layout, psi))

    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in forest.features])
    return df.withColumn(out, score(vector))


def train_iforest(matrix: DataFrame, features: list[str], key: str = "transaction_id",
                  trees: int = 200, psi: int = 256, contamination: float = 0.05,
                  seed: int = 42) -> IsolationForest:
    sample = sample_rows(matrix, key, trees, psi, seed)
    nodes = grow_trees(sample, features, psi, seed).toPandas()  # at most trees * 2 * psi rows
    used = int(nodes.loc[nodes["node"] == 0, "size"].max())
    forest = IsolationForest(nodes, list(features), trees, used, 0.0)
    scored = with_anomaly(matrix, forest)
    cut = scored.agg(F.percentile_approx("anomaly", contamination, 100000)).first()[0]
    forest.offset = float(cut)
    return forest


def score_iforest(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """``raw_score`` = clamp(0.5 - decision) and ``is_outlier`` = decision below 0."""
    decision = F.col("_anomaly") - F.lit(forest.offset)
    scored = with_anomaly(df, forest, "_anomaly")
    return scored.withColumns({
        "raw_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.5) - decision)),
        "is_outlier": decision < 0,
    }).drop("_anomaly")
