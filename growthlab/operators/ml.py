"""Model training, scoring and evaluation on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from growthlab.functions import scalars as S
from growthlab.operators import boosting as B
from growthlab.operators import trees as T
from growthlab.operators.cleaning import require_columns
from growthlab.operators.experiment import class_weights
from growthlab.operators.ordered import draw_rank, exact_quantiles

Model = PipelineModel | T.Ensemble

# Decision thresholds of the published scorers.
THRESHOLD_V1 = 0.90
THRESHOLD_OOT = 0.92
THRESHOLD_V2 = 0.96
THRESHOLD_V2_STRICT = 0.98
THRESHOLD_SAME_DAY = 0.80
SWEEP = 50


# ---------------------------------------------------------------- feature selection


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for every column pair i < j over the rows in which both are present, of values less
    their column's mean. One pass for the means and one for the pairs: a task multiplies its rows as matrices,
    block by block, and what is shuffled is one row per pair and task."""
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    means = [m or 0.0 for m in numbers.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))) for c in numbers.columns]).first()]
    first, second = np.triu_indices(len(cols), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(cols), len(cols)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - means
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            parts = (there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x)
            sums += np.stack(parts)
        columns = [pa.array(first), pa.array(second), *[pa.array(s[first, second]) for s in sums]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", *_MOMENTS])

    fields = "i long, j long, " + ", ".join(f"{m} double" for m in _MOMENTS)
    parts = numbers.mapInArrow(run, fields)
    return parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in _MOMENTS])


_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over its complete rows, one row per pair; NULL where a column is constant
    there or fewer than two rows are complete."""
    table = moments(df, cols)
    n = F.col("n")
    xx, yy = (F.col(f"s{a}{a}") - F.col(f"s{a}") ** 2 / n for a in "xy")
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    # what rounding leaves of a constant column is no spread
    spread = lambda own, square: own > square * 1e-13
    known = (n >= 2) & spread(xx, F.col("sxx")) & spread(yy, F.col("syy"))
    r = F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), xy / F.sqrt(xx) / F.sqrt(yy))))
    names = F.array(*[F.lit(c) for c in cols])
    return table.select(
        F.get(names, F.col("i").cast("int")).alias("a"), F.get(names, F.col("j").cast("int")).alias("b"),
        F.col("i").alias("_i"), F.col("j").alias("_j"), r.alias("r"),
    )


def prune_correlated(df: DataFrame, cols: list[str], low: float = 0.9) -> list[str]:
    """Columns left after greedily dropping the later one of each pair with low < |r| < 1.

    Only the columns x columns table reaches the driver."""
    strong = (
        correlations(df, cols)
        .where((F.abs("r") > low) & (F.abs("r") < 1))
        .orderBy("_i", "_j")
        .collect()
    )
    dropped: set[str] = set()
    for row in strong:
        if row["a"] not in dropped and row["b"] not in dropped:
            dropped.add(row["b"])
    return [c for c in cols if c not in dropped]


def clip_quantiles(
    df: DataFrame, cols: list[str], low: float = 0.01, high: float = 0.99, quantiles: Callable = exact_quantiles
) -> DataFrame:
    """Clip each column to its own quantiles, exact at any size; `sketches.sketch_quantiles` gives them from one pass."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "feature", "value"
    )
    limits = quantiles(long, ["feature"], "value", [low, high])
    # one entry per feature column
    table = limits.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "quantiles"))).alias("m")
    ).scalar()

    def clipped(c: str) -> Column:
        cut = F.try_element_at(table, F.lit(c))
        x = F.col(c).cast("double")
        return F.when(x < F.get(cut, F.lit(0)), F.get(cut, F.lit(0))).when(
            x > F.get(cut, F.lit(1)), F.get(cut, F.lit(1))
        ).otherwise(x)

    return df.withColumns({c: clipped(c) for c in cols})


def time_split(df: DataFrame, day: str, start: str, oot_start: str) -> DataFrame:
    """set_type: model_set inside [start, oot_start), oot_set otherwise."""
    inside = (F.col(day) >= F.lit(start).cast("date")) & (
        F.col(day) < F.lit(oot_start).cast("date")
    )
    return df.withColumn(
        "set_type", F.when(inside, F.lit("model_set")).otherwise(F.lit("oot_set"))
    )


# ---------------------------------------------------------------- training


def _with_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced class weights."""
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def _plain(name: str) -> str:
    """Spark ML reads a dot as a struct field, so 'gmail.com' columns are renamed around it."""
    return name.replace(".", "_dot_")


def _plain_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: _plain(c) for c in df.columns if "." in c})


def _assembler(df: DataFrame, features: list[str]) -> VectorAssembler:
    require_columns(df, features)
    return VectorAssembler(
        inputCols=[_plain(c) for c in features], outputCol="_features", handleInvalid="error"
    )


def fit_logistic(df: DataFrame, features: list[str], label: str = "flag", iterations: int = 500) -> PipelineModel:
    learner = LogisticRegression(
        featuresCol="_features", labelCol=label, weightCol="weight", maxIter=iterations,
    )
    return Pipeline(stages=[_assembler(df, features), learner]).fit(
        _plain_names(_with_weights(df, label))
    )


def fit_boosted(
    df: DataFrame,
    features: list[str],
    label: str = "flag",
    validation: Column | None = None,
    iterations: int = 500,
    rate: float = 0.01,
    depth: int = 5,
) -> T.Ensemble:
    """Gradient-boosted trees. With a validation flag all rounds are trained on the other rows, and the model
    is cut at the round of least validation loss; class weights come from the training rows alone. Rows of a NULL label are
    left out; missing values go left."""
    known = df.where(F.col(label).isNotNull())
    train = known if validation is None else known.where(~F.coalesce(validation, F.lit(False)))
    weights = {r[label]: r["weight"] for r in class_weights(train, label).collect()}  # one row per class
    return B.fit_gradient(known, features, weights, label, validation, iterations, rate, depth)


def fit_per_window(
    df: DataFrame,
    windows: list[int],
    fit: Callable[[DataFrame], PipelineModel],
    window: str = "window_number",
    parallel: int = 8,
) -> dict[int, PipelineModel]:
    """One model per window; the fits are submitted side by side, as cross-validation does."""

    def one(w: int) -> PipelineModel:
        return fit(df.where(F.col(window) == w))

    with ThreadPool(min(parallel, len(windows))) as pool:
        models = pool.map(inheritable_thread_target(df.sparkSession)(one), windows)
    return dict(zip(windows, models))


def score(model: Model, df: DataFrame, out: str = "probability_positive_class") -> DataFrame:
    return df.withColumn(out, F.expr(probability(model)))


def probability(model: Model) -> str:
    """SQL of a model's probability over the columns of its features."""
    if isinstance(model, T.Ensemble):
        return model.probability(T.vector(model.features))
    names = [c.replace("_dot_", ".") for c in model.stages[0].getInputCols()]
    return linear_probability(*logistic_terms(model, names))


def linear_probability(intercept: float, weights: dict[str, float]) -> str:
    terms = [T.number(intercept), *[f"{T.number(w)} * CAST(`{c}` AS DOUBLE)" for c, w in weights.items()]]
    return f"1 / (1 + exp(-({' + '.join(terms)})))"


def predict_labels(
    model: Model, df: DataFrame, threshold: float = THRESHOLD_OOT, out: str = "predicted_label"
) -> DataFrame:
    """Probability and the 0/1 label at a threshold, for rows the model has not seen."""
    scored = score(model, df)
    return scored.withColumn(out, (F.col("probability_positive_class") >= threshold).cast("int"))


def score_by_window(
    df: DataFrame,
    models: dict[int, Model],
    threshold: float = THRESHOLD_V2,
    window: str = "window_number",
) -> DataFrame:
    """Each row by the model of its window, as one expression over one read of the rows, whatever the kinds of the models;
    rows without a model get probability 0, flag 0."""
    return score_by_sql(df, {w: probability(m) for w, m in models.items()}, threshold, window)


def score_by_sql(df: DataFrame, scores: dict[int, str], threshold: float, window: str = "window_number") -> DataFrame:
    """score_by_window for models given by the SQL of their probability."""
    known, prob = F.lit(None).cast("int"), F.lit(None).cast("double")
    for w, sql in scores.items():
        known = F.when(F.col(window) == w, F.lit(w)).otherwise(known)
        prob = F.when(F.col(window) == w, F.expr(sql)).otherwise(prob)
    scored = df.withColumn("window", known).withColumn("probability_positive_class", F.coalesce(prob, F.lit(0.0)))
    hit = F.col("window").isNotNull() & (F.col("probability_positive_class") >= threshold)
    return scored.withColumn("potential_vip_ind", hit.cast("int"))


def logistic_terms(model: PipelineModel, features: list[str]) -> tuple[float, dict[str, float]]:
    """Intercept and weight per feature of a fitted logistic model."""
    fitted = model.stages[-1]
    return float(fitted.intercept), dict(zip(features, map(float, fitted.coefficients.toArray())))


def score_by_terms(
    df: DataFrame,
    table: dict[int, tuple[float, dict[str, float]]],
    threshold: float = THRESHOLD_V2,
    window: str = "window_number",
) -> DataFrame:
    """score_by_window for logistic models given by a window's intercept and weights."""
    return score_by_sql(df, {w: linear_probability(*terms) for w, terms in table.items()}, threshold, window)


def save_models(spark: SparkSession, models: dict[object, Model], folder: str) -> None:
    """Ensembles as one table, other models each in Spark's own form."""
    T.save(spark, {k: m for k, m in models.items() if isinstance(m, T.Ensemble)}, f"{folder}/ensembles")
    for key, model in models.items():
        if not isinstance(model, T.Ensemble):
            model.write().overwrite().save(f"{folder}/{key}")


def load_models(spark: SparkSession, folder: str, keys: list) -> dict[object, Model]:
    trees = T.load(spark, f"{folder}/ensembles")
    return {k: trees[str(k)] if str(k) in trees else PipelineModel.load(f"{folder}/{k}") for k in keys}


def permutation_importance(
    df: DataFrame, key: str, features: list[str], label: str, chance: Callable[[str], str], seed: object = 42
) -> DataFrame:
    """(feature, loss, loss_increase): mean log-loss with one feature's values dealt anew among the rows, and by how much
    it exceeds the loss of the rows as they are.

    `chance` gives the SQL of the probability for the SQL of a feature array. The k-th row in one random order gets the value
    of the k-th in another (md5 of seed and key, which must tell rows apart), so two rankings and one join serve all
    features, and every feature is scored in one pass."""
    rows = df.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"), F.expr(T.vector(features)).alias("_x"))
    rank = lambda frame, tag: draw_rank(frame, [], "_key", f"{seed}-{tag}").drop("_size")
    other = rank(rows.select("_key", F.col("_x").alias("_other")), "values").select("_rank", "_other")
    paired = rank(rows, "rows").join(other, "_rank")
    p = f"least(greatest({chance('v')}, 1e-15D), 1 - 1e-15D)"
    loss = f"-(_y * ln({p}) + (1 - _y) * ln(1 - {p}))"
    swapped = "transform(_x, (v, i) -> if(i = j, get(_other, j), v))"
    # place -1 swaps nothing
    each = f"transform(sequence(-1, {len(features) - 1}), j -> struct(j, get(transform(array({swapped}), v -> {loss}), 0) AS loss))"
    table = paired.selectExpr(f"inline({each}) AS (j, loss)").groupBy("j").agg(F.avg("loss").alias("loss"))
    base = F.max(F.when(F.col("j") == -1, F.col("loss"))).over(W.partitionBy())  # a row per feature
    name = F.get(F.array(*[F.lit(c) for c in features]), F.col("j"))
    out = table.select("j", name.alias("feature"), "loss", (F.col("loss") - base).alias("loss_increase"))
    return out.where("j >= 0").drop("j")


# ---------------------------------------------------------------- evaluation


def threshold_sweep(df: DataFrame, prob: str, label: str, keys: list[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 at 0.00, 0.02 ... 1.00 per model.

    Scores are counted into 51 cells first; the reverse running sums see 51 rows per model."""
    cell = F.floor(F.col(prob) * SWEEP)
    # a score equal to the next threshold belongs to it even when the product falls just short
    cell = F.when(F.col(prob) >= (cell + 1) / SWEEP, cell + 1).otherwise(cell).cast("int")
    counts = df.groupBy(*keys, cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_pos")
    )
    grid = counts.select(*keys).distinct().withColumn(
        "_cell", F.explode(F.sequence(F.lit(0), F.lit(SWEEP)))
    )
    dense = grid.join(counts, keys + ["_cell"], "left").fillna(0, ["_n", "_pos"])
    model = W.partitionBy(*keys)
    above = model.orderBy(F.desc("_cell")).rowsBetween(W.unboundedPreceding, W.currentRow)
    flagged = dense.select(
        *keys,
        (F.col("_cell") / SWEEP).alias("threshold"),
        F.sum("_pos").over(above).alias("tp"),
        F.sum("_n").over(above).alias("_flagged"),
        F.sum("_pos").over(model).alias("_p"),
        F.sum("_n").over(model).alias("_all"),
    )
    tp, fp = F.col("tp"), F.col("_flagged") - F.col("tp")
    fn = F.col("_p") - F.col("tp")
    tn = F.col("_all") - F.col("_flagged") - fn
    zero = F.lit(0.0)
    return flagged.select(
        *keys,
        "threshold",
        S.safe_div(tp + tn, F.col("_all")).alias("accuracy"),
        F.coalesce(S.safe_div(tp, F.col("_flagged")), zero).alias("precision"),
        F.coalesce(S.safe_div(tp, F.col("_p")), zero).alias("recall"),
        F.coalesce(S.safe_div(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )


def outcome_counts(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    return df.groupBy(predicted, actual).agg(F.count(F.lit(1)).alias("rows"))
