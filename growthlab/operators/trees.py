"""Tree ensembles as flat node arrays, walked by expressions: no Python in tasks, no branch per model.

A tree is a struct of parallel arrays, one entry a node: feature (-1 at a leaf), cut, left, right and value. A row goes left
where its feature is below the cut or missing. Node 0 is the root."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TREE = "struct<feature: array<int>, cut: array<double>, left: array<int>, right: array<int>, value: array<double>>"


def number(x: float) -> str:
    """SQL of a double, infinities included (a logistic model of one class has such an intercept)."""
    return f"{float(x)!r}D" if math.isfinite(x) else f"CAST('{float(x)}' AS DOUBLE)"


def vector(columns: list[str]) -> str:
    """Features in model order as one array."""
    return f"array({', '.join(f'CAST(`{c}` AS DOUBLE)' for c in columns)})"


def leaf(tree: str, x: str, depth: int | str) -> str:
    """SQL of the leaf where x ends, after at most `depth` steps."""
    if depth == 0:
        return "0"
    here = f"get({x}, get({tree}.feature, at))"
    left = f"{here} IS NULL OR isnan({here}) OR {here} < get({tree}.cut, at)"
    step = f"CASE WHEN get({tree}.feature, at) < 0 THEN at WHEN {left} THEN get({tree}.left, at) ELSE get({tree}.right, at) END"
    return f"aggregate(sequence(1, {depth}), 0, (at, _step) -> {step})"


def total(trees: str, x: str, depth: int | str, value: str = "value") -> str:
    """SQL of the sum of all trees' leaf values; x is made once a row."""
    walked = f"aggregate({trees}, 0D, (acc, t) -> acc + get(t.{value}, {leaf('t', 'v', depth)}))"
    return f"get(transform(array({x}), v -> {walked}), 0)"


@dataclass
class Ensemble:
    """margin = base + sum of leaf values; probability = 1 / (1 + exp(-margin))."""

    features: list[str]
    trees: list[dict[str, list]]
    base: float = 0.0
    #: validation loss after each round, and gain per feature, where training kept them
    losses: list[float] = field(default_factory=list)
    gains: dict[str, float] = field(default_factory=dict)

    @property
    def depth(self) -> int:
        return max((_depth(t) for t in self.trees), default=0)

    def constant(self) -> str:
        """SQL of the trees as one constant, folded once when the plan is optimised."""
        return f"from_json('{json.dumps(self.trees)}', 'array<{TREE}>')"

    def margin(self, x: str) -> str:
        return f"({number(self.base)} + {total(self.constant(), x, self.depth)})" if self.trees else number(self.base)

    def probability(self, x: str) -> str:
        return f"1 / (1 + exp(-{self.margin(x)}))"

    def first(self, rounds: int) -> Ensemble:
        return Ensemble(self.features, self.trees[:rounds], self.base, self.losses[:rounds], self.gains)

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): share of the split gain in percent."""
        whole = sum(self.gains.values()) or 1.0
        rows = [(f, 100.0 * self.gains.get(f, 0.0) / whole) for f in self.features]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _depth(tree: dict[str, list]) -> int:
    level, deepest = {0: 0}, 0
    for at in range(len(tree["feature"])):  # children follow their parents
        if tree["feature"][at] >= 0:
            for child in (tree["left"][at], tree["right"][at]):
                level[child] = level[at] + 1
                deepest = max(deepest, level[child])
    return deepest


# ---------------------------------------------------------------- models stored as tables


_MODEL = f"features array<string>, base double, trees array<{TREE}>, losses array<double>, gains map<string, double>"


def save(spark: SparkSession, models: dict[object, Ensemble], folder: str) -> None:
    rows = [(str(k), m.features, m.base, m.trees, m.losses, m.gains) for k, m in models.items()]
    spark.createDataFrame(rows, "key string, " + _MODEL).coalesce(1).write.mode("overwrite").parquet(folder)


def load(spark: SparkSession, folder: str, key_type: type = str) -> dict[object, Ensemble]:
    """Bounded by the models' own size: trees x nodes."""
    out = {}
    for r in spark.read.parquet(folder).collect():
        trees = [{k: list(v) for k, v in t.asDict().items()} for t in r.trees]
        out[key_type(r.key)] = Ensemble(list(r.features), trees, r.base, list(r.losses), dict(r.gains))
    return out


def of_gbt(spark: SparkSession, model: GBTClassificationModel, features: list[str], folder: str) -> Ensemble:
    """A Spark ML boosted classifier as a flat ensemble, read from the form in which Spark stores it. Its margin counts
    twice, and its rows go left up to and with the threshold."""
    model.write().overwrite().save(folder)
    data = spark.read.parquet(f"{folder}/data")
    weights = model.treeWeights
    node = F.struct(
        F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
        (F.col("nodeData.gain") * F.col("nodeData.rawCount")).alias("gain"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"),
    )
    stored = {r.treeID: r.nodes for r in data.groupBy("treeID").agg(F.array_sort(F.collect_list(node)).alias("nodes")).collect()}
    trees, gains = [], dict.fromkeys(features, 0.0)
    for number in sorted(stored):
        nodes, tree = stored[number], {k: [] for k in ("feature", "cut", "left", "right", "value")}
        for n in nodes:
            inner = n.left >= 0
            values = (
                n.feature if inner else -1, math.nextafter(n.cut, math.inf) if inner else 0.0, n.left if inner else -1,
                n.right if inner else -1, 0.0 if inner else 2.0 * weights[number] * n.value,
            )
            for k, v in zip(tree, values):
                tree[k].append(v)
            if inner:
                gains[features[n.feature]] += n.gain
        trees.append(tree)
    return Ensemble(features, trees, gains=gains)
