"""Boosting of log-loss: Newton steps with an L2 penalty on leaf values, and gradient boosting by variance.

Features are cut into quantile bins once, and rows of equal bins are counted as one cell. A level of a tree is grown from
one small job: gradient and Hessian sums per (node, feature, bin), added up in each task over its blocks of cells, so what
reaches the driver is bounded by nodes x features x bins a task, whatever the number of rows. The same job at the root gives the
validation loss of the round before."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlab.operators import trees as T
from growthlab.operators.cleaning import require_columns
from growthlab.operators.histograms import Cells
from growthlab.session import durable

BINS = 64


def quantile_cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Up to bins - 1 cut points per feature, values of the feature; approximate ranks from one pass."""
    levels = [k / bins for k in range(1, bins)]
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), levels, 10_000).alias(f"c{i}") for i, c in enumerate(features)])
    return [sorted({x for x in cuts or [] if not math.isnan(x)}) for cuts in found.first()]


def value_cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[list[float]]:
    """Cuts between all values of the features that have at most `bins` of them, quantile cuts of the others."""
    known = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in features}
    about = df.agg(*[F.approx_count_distinct(x).alias(f"c{i}") for i, x in enumerate(known.values())]).first()
    few = [c for c, n in zip(features, about) if n <= 2 * bins]  # the estimate is within 5 %, mostly
    sets = df.agg(*[F.sort_array(F.collect_set(known[c])) for c in few]).first() if few else []
    exact = {c: v for c, v in zip(few, sets) if len(v) <= bins}
    between = {c: [math.nextafter((x + y) / 2, math.inf) for x, y in zip(v, v[1:])] for c, v in exact.items()}
    many = [c for c in features if c not in exact]
    return [{**between, **dict(zip(many, quantile_cuts(df, many, bins) if many else []))}[c] for c in features]


def _binned(df: DataFrame, features: list[str], cuts: list[list[float]]) -> Column:
    """Number of cuts at or below each value; missing values have none."""

    def place(name: str, points: list[float]) -> Column:
        x = F.col(f"`{name}`").cast("double")
        known = x.isNotNull() & ~F.isnan(x)
        table = F.array(*[F.lit(p) for p in points]).cast("array<double>")
        return F.when(known, F.size(F.filter(table, lambda c: c <= x))).otherwise(0)

    return F.array(*[place(c, points) for c, points in zip(features, cuts)])


def leaf_value(g: float, h: float, l2: float) -> float:
    """Newton step of a leaf with gradient sum g and Hessian sum h."""
    return -g / (h + l2)


def best_splits(
    grads: np.ndarray, hessians: np.ndarray, l2: float, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """grads and hessians: nodes x features x bins. Per node: gain, feature and bin of the best split (rows of smaller
    bins go left), and the gradient and Hessian sums left of it. No split: gain 0."""
    left_g, left_h = grads.cumsum(axis=2)[:, :, :-1], hessians.cumsum(axis=2)[:, :, :-1]
    all_g, all_h = grads[:, :1].sum(axis=2, keepdims=True), hessians[:, :1].sum(axis=2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    with np.errstate(divide="ignore", invalid="ignore"):  # empty sides without a penalty
        gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
    gain = np.where((left_h >= least) & (right_h >= least), np.nan_to_num(gain), 0.0)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    rows = np.arange(len(gain))
    feature, cut = np.divmod(at, gain.shape[2])
    sums = np.stack([left_g[rows, feature, cut], left_h[rows, feature, cut]], axis=1)
    return flat[rows, at], feature, cut + 1, sums


def fit_newton(
    df: DataFrame,
    features: list[str],
    label: str = "flag",
    validation: Column | None = None,
    rounds: int = 500,
    rate: float = 0.01,
    depth: int = 5,
    l2: float = 10.0,
    least_hessian: float = 1.0,
    patience: int = 10,
    positive_weight: float | None = None,
    bins: int = BINS,
) -> T.Ensemble:
    """Trees of the training rows. Positive rows weigh `positive_weight`, by default the ratio of negative to positive
    training rows. With a validation flag training ends after `patience` rounds without a smaller validation
    loss (unweighted log-loss), and the model keeps the rounds up to the best one. Missing values go left; a leaf's
    value is -G / (H + l2) times the rate. Rows of a NULL label are left out."""
    require_columns(df, features)
    rows = _parted(df, label, validation)
    cuts = quantile_cuts(rows.where("_train"), features, bins)
    cells = _cells(rows, features, cuts)
    if positive_weight is None:
        seen = cells.where("_train").agg(F.sum(F.col("_y") * F.col("_n")), F.sum("_n")).first()
        positive_weight = (seen[1] - (seen[0] or 0.0)) / seen[0] if seen[0] else 1.0

    def slope(y: np.ndarray, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        w = n * np.where(y > 0, positive_weight, 1.0)
        return w * (p - y), w * p * (1 - p)

    def loss(y: np.ndarray, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return n * (np.logaddexp(0, margin) - y * margin), n

    watch = None if validation is None else loss
    return _boost(cells, features, cuts, lambda number: (slope, rate), watch, rounds, depth, l2, least_hessian, patience)


def fit_gradient(
    df: DataFrame,
    features: list[str],
    weights: dict[float, float],
    label: str = "flag",
    validation: Column | None = None,
    rounds: int = 500,
    rate: float = 0.01,
    depth: int = 5,
    bins: int = BINS,
) -> T.Ensemble:
    """Gradient boosting of log-loss as Spark's GBTClassifier does it, with rows weighted by label: regression trees that split
    by variance, the first of labels -1 and 1 at full rate, the others of 4 (y - p); a margin is twice the sum of the trees.
    Cuts are read off all training rows. With a validation flag the weighted loss after each round is kept and the model ends
    at the least one, after all rounds are trained. Gains are those of the split, times the rows of its node."""
    require_columns(df, features)
    rows = _parted(df, label, validation)
    cuts = value_cuts(rows.where("_train"), features, bins)
    cells = _cells(rows, features, cuts)
    negative, positive = weights.get(0, 1.0), weights.get(1, 1.0)

    def first(y: np.ndarray, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = n * np.where(y > 0, positive, negative)
        return 2 * w * (1 - 2 * y), w

    def slope(y: np.ndarray, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = n * np.where(y > 0, positive, negative)
        return 8 * w * (1 / (1 + np.exp(-margin)) - y), w

    def loss(y: np.ndarray, margin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = n * np.where(y > 0, positive, negative)
        return 2 * w * (np.logaddexp(0, margin) - y * margin), w

    watch = None if validation is None else loss
    least = min(negative, positive) / 2  # a row on either side
    step = lambda number: (slope, rate) if number else (first, 1.0)
    return _boost(cells, features, cuts, step, watch, rounds, depth, 0.0, least, None, by_rows=True)


def _parted(df: DataFrame, label: str, validation: Column | None) -> DataFrame:
    held = F.coalesce(validation, F.lit(False)) if validation is not None else F.lit(False)
    return df.where(F.col(label).isNotNull()).withColumns({"_train": ~held, "_y": F.col(label).cast("double")})


def _cells(rows: DataFrame, features: list[str], cuts: list[list[float]]) -> DataFrame:
    """Rows of equal bins, label and part as one, counted."""
    binned = rows.select("_train", "_y", _binned(rows, features, cuts).alias("_bins"))
    return durable(binned.groupBy("_train", "_y", "_bins").agg(F.count(F.lit(1)).alias("_n")))


def _boost(
    frame: DataFrame,
    features: list[str],
    cuts: list[list[float]],
    step: Callable[[int], tuple[Callable, float]],
    loss: Callable | None,
    rounds: int,
    depth: int,
    l2: float,
    least: float,
    patience: int | None,
    by_rows: bool = False,
) -> T.Ensemble:
    """Trees grown round by round; step(round) gives gradients and rate, `loss` is that of the validation rows, if any."""
    cells = Cells(frame, len(features), max(map(len, cuts)) + 1, depth)
    grown: list[dict[str, list]] = []  # cuts are bin numbers until the end
    losses: list[float] = []
    gains = dict.fromkeys(features, 0.0)
    for number in range(rounds + (loss is not None)):
        slope, rate = step(number)
        grow = _Growing(cells, slope, features, l2, least, rate, gains, by_rows)
        *root, (lost, weight) = cells.sums({k: [-1] for k in _NODE}, [0], 0, slope, loss)
        if loss is not None and number:
            losses.append(float(lost / weight) if weight else 0.0)
            if patience is not None and number - 1 - losses.index(min(losses)) >= patience:
                break
        if number < rounds:
            grown.append(grow.tree(depth, *root))
            cells.move(grown[-1])
    cells.close()
    kept = grown[: losses.index(min(losses)) + 1] if losses else grown
    for tree in kept:
        tree["cut"] = [cuts[f][int(b) - 1] if f >= 0 else 0.0 for f, b in zip(tree["feature"], tree["cut"])]
    return T.Ensemble(features, kept, losses=losses, gains=gains)


_NODE = ("feature", "cut", "left", "right", "value")


class _Growing:
    """One tree, a level at a time, from cells and their gradients; its cuts are bin numbers."""

    def __init__(
        self, cells: Cells, slope: Callable, features: list[str], l2: float, least: float, rate: float, gains: dict[str, float],
        by_rows: bool,
    ) -> None:
        self.cells, self.slope, self.features = cells, slope, features
        self.l2, self.least, self.rate, self.gains, self.by_rows = l2, least, rate, gains, by_rows
        self.nodes: dict[str, list] = {k: [] for k in _NODE}

    def add(self, g: float, h: float) -> int:
        value = self.rate * leaf_value(float(g), float(h), self.l2) if h + self.l2 else 0.0
        for name, x in zip(_NODE, (-1, 0.0, -1, -1, value)):
            self.nodes[name].append(x)
        return len(self.nodes["value"]) - 1

    def tree(self, depth: int, grads: np.ndarray, hessians: np.ndarray, rows: np.ndarray) -> dict[str, list]:
        """`grads`, `hessians` and `rows`: the root's sums."""
        leaves = [self.add(grads[0, 0].sum(), hessians[0, 0].sum())]
        for level in range(depth):
            if level:
                grads, hessians, rows, _ = self.cells.sums(self.nodes, leaves, level, self.slope)
            leaves = self.split(leaves, grads, hessians, rows)
            if not leaves:
                break
        return self.nodes

    def split(self, leaves: list[int], grads: np.ndarray, hessians: np.ndarray, rows: np.ndarray) -> list[int]:
        """Split the leaves that gain by it; the new leaves."""
        gains, features, cuts, left = best_splits(grads, hessians, self.l2, self.least)
        whole = np.stack([grads[:, 0].sum(axis=1), hessians[:, 0].sum(axis=1)], axis=1)
        fresh = []
        for k, at in enumerate(leaves):
            if gains[k] <= 1e-12:
                continue
            feature = int(features[k])
            self.gains[self.features[feature]] += float(gains[k]) * (float(rows[k] / whole[k, 1]) / 4 if self.by_rows else 1.0)
            sides = [self.add(*left[k]), self.add(*(whole[k] - left[k]))]
            for name, x in (("feature", feature), ("cut", float(cuts[k])), ("left", sides[0]), ("right", sides[1]), ("value", 0.0)):
                self.nodes[name][at] = x
            fresh += sides
        return fresh
