"""Isolation forest (Liu, Ting, Zhou 2008) per platform.

Each tree is grown in its own task on a few hundred rows picked by hash from all rows, so training parallelism
is platforms x trees. A platform's forest is one row of bounded arrays; scoring walks them in an expression over
slices of that platform's rows, so no task holds a whole platform.
"""

from __future__ import annotations

import math
import sys
import zlib

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.operators.trees import total

# executors need not have this package installed: ship its few functions with the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rows per tree, a parameter of the published algorithm
SAMPLE = 256
TREES = 100
EULER = 0.5772156649015329

TREE_SCHEMA = (
    "platform string, tree int, feature array<int>, cut array<double>, "
    "left array<int>, right array<int>, depth array<double>"
)


def path_norm(n: float) -> float:
    """Average depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grow(points: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """One tree as parallel node lists; depth holds the leaf's path length, inner nodes -1."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "cut", "left", "right", "depth")}

    def node(feature: int, cut: float, depth: float) -> int:
        for k, v in zip(("feature", "cut", "left", "right", "depth"), (feature, cut, -1, -1, depth)):
            nodes[k].append(v)
        return len(nodes["feature"]) - 1

    def split(rows: np.ndarray, level: int) -> int:
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if level >= limit or len(rows) <= 1 or usable.size == 0:
            return node(-1, 0.0, level + path_norm(len(rows)))
        f = int(rng.choice(usable))
        cut = float(rng.uniform(low[f], high[f]))
        here = node(f, cut, -1.0)
        goes_left = rows[:, f] < cut
        if not goes_left.any() or goes_left.all():
            goes_left = rows[:, f] <= low[f]
            nodes["cut"][here] = float(np.nextafter(low[f], high[f]))
        nodes["left"][here] = split(rows[goes_left], level + 1)
        nodes["right"][here] = split(rows[~goes_left], level + 1)
        return here

    split(points, 0)
    return nodes


def path_lengths(points: np.ndarray, tree: dict) -> np.ndarray:
    """Leaf path length of every point in one tree."""
    feature, cut = np.asarray(tree["feature"]), np.asarray(tree["cut"])
    left, right = np.asarray(tree["left"]), np.asarray(tree["right"])
    at = np.zeros(len(points), dtype=int)
    rows = np.arange(len(points))
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return np.asarray(tree["depth"])[at]
        f = np.where(inner, feature[at], 0)
        step = np.where(points[rows, f] < cut[at], left[at], right[at])
        at = np.where(inner, step, at)


def fit_forest(
    df: DataFrame,
    features: list[str],
    key: str = "hour",
    seed: object = 42,
    trees: int = TREES,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per platform: its trees as an array of node arrays, and the rows per tree.

    Each tree takes the `sample` rows of its platform whose hashes are smallest. A row is only copied for the trees
    for which its hash is below a limit that leaves room for ten standard deviations more than `sample` rows, so about
    `sample` rows per tree are shuffled however many there are."""
    known = df.where(F.col(key).isNotNull()).select("platform", key, *features)
    limits = known.groupBy("platform").agg(
        F.least(F.lit(1.0), F.lit(sample + 10 * math.sqrt(sample) + 20) / F.count("*")).alias("_share")
    )
    # 53 bits of a 64-bit hash, as a number in [0, 1)
    draw = lambda t: F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), t, F.col(key)), 11) / float(1 << 53)
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    drawn = F.filter(F.transform(numbers, lambda t: F.struct(t.alias("tree"), draw(t).alias("d"))), lambda x: x["d"] < F.col("_share"))
    pool = known.join(limits, "platform").select("platform", key, *features, F.inline(drawn))
    per_tree = W.partitionBy("platform", "tree").orderBy("d", key)
    picked = pool.withColumn("_r", F.row_number().over(per_tree)).where(F.col("_r") <= sample)

    def build(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        platform, tree = keys
        points = rows.sort_values("_r")[features].to_numpy(dtype=float)
        start = [zlib.crc32(f"{seed}-{platform}".encode()), int(tree), len(points)]
        grown = grow(points, np.random.default_rng(start))
        return pd.DataFrame([{"platform": platform, "tree": tree, **grown}])

    grown = picked.groupBy("platform", "tree").applyInPandas(build, TREE_SCHEMA)
    sizes = picked.where(F.col("tree") == 0).groupBy("platform").agg(
        F.count(F.lit(1)).alias("sample_rows")
    )
    packed = grown.groupBy("platform").agg(
        F.collect_list(F.struct("feature", "cut", "left", "right", "depth")).alias("forest")
    )
    return packed.join(sizes, "platform")


def _path_norm(n: Column) -> Column:
    """path_norm of a count column; 1 where that is zero."""
    deep = 2 * (F.ln(n - 1) + EULER) - 2 * (n - 1) / n
    return F.when(n <= 2, F.lit(1.0)).otherwise(deep)


def raw_scores(
    df: DataFrame, forest: DataFrame, features: list[str], slice_col: str = "_slice"
) -> DataFrame:
    """score_samples per row: minus the anomaly score, lower is stranger; NULL without a forest.

    The rows of a (platform, slice) meet their platform's trees once, as an array, and each walks them in an expression;
    the caller's slices bound such an array."""
    names = df.columns
    groups = df.groupBy("platform", slice_col).agg(F.collect_list(F.struct(*names)).alias("_rows"))
    met = groups.join(forest, "platform", "left").withColumn("_n", F.col("sample_rows").cast("double"))
    met = met.withColumn("_norm", _path_norm(F.col("_n"))).withColumn(
        "_limit", F.greatest(F.ceil(F.log2(F.greatest("_n", F.lit(2.0)))), F.lit(1)).cast("int")
    )
    x = f"array({', '.join(f'CAST(r.`{c}` AS DOUBLE)' for c in features)})"
    score = f"-power(2D, -{total('forest', x, '_limit', 'depth')} / size(forest) / _norm)"
    fields = ", ".join(f"'{c}', r.`{c}`" for c in names)
    return met.select(F.expr(f"inline(transform(_rows, r -> named_struct({fields}, 'score', {score})))"))
