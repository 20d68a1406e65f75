"""Column and row hygiene: names, guards, filters, dummies, transforms, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthlab.functions import scalars as S

# ---------------------------------------------------------------- columns


def columns_like(df: DataFrame, text: str = "", prefix: str = "") -> list[str]:
    return [c for c in df.columns if text in c and c.startswith(prefix)]


def rename_like(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.replace(old, new) for c in df.columns if old in c})


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def lower_text(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    text = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in keep
    ]
    return df.withColumns({c: F.lower(c) for c in text})


def place_column(df: DataFrame, name: str, position: int) -> DataFrame:
    rest = [c for c in df.columns if c != name]
    return df.select(*rest[:position], name, *rest[position:])


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def add_missing(df: DataFrame, needed: list[str], value: object = 0) -> DataFrame:
    gone = {c: F.lit(value) for c in needed if c not in df.columns}
    return df.withColumns(gone) if gone else df


def stamp(df: DataFrame, as_of: str, **constants: object) -> DataFrame:
    """Run constants plus updated_at cut to the minute."""
    cols = {k: F.lit(v) for k, v in constants.items()}
    cols["updated_at"] = F.date_trunc("minute", F.lit(as_of).cast("timestamp"))
    return df.withColumns(cols)


# ---------------------------------------------------------------- row filters


def completed_weeks(df: DataFrame, as_of: str, week: str = "su_week", lag_days: int = 14) -> DataFrame:
    """Cohort weeks up to the Monday of the run day minus two weeks."""
    cutoff = F.date_sub(S.week_monday(F.lit(as_of).cast("date")), lag_days)
    return df.where(F.col(week) <= cutoff)


def trailing(day: Column, as_of: str, first: int, last: int) -> Column:
    """day between as_of - first and as_of - last days."""
    anchor = F.lit(as_of).cast("date")
    return day.between(F.date_sub(anchor, first), F.date_sub(anchor, last))


def limit_hours(
    df: DataFrame, anchor: str, times: list[str], limits: list[int], out: str = "limit_h"
) -> DataFrame:
    """Rows with any of the times within h hours of the anchor, once per limit h, in one pass."""

    def close(h: Column) -> Column:
        span = F.make_dt_interval(hours=h)
        cond = F.lit(False)
        for t in times:
            cond = cond | F.coalesce(F.col(t) - F.col(anchor) <= span, F.lit(False))
        return cond

    offered = F.array(*[F.lit(h) for h in limits])
    return df.withColumn(out, F.explode(F.filter(offered, close)))


def limit_frames(df: DataFrame, anchor: str, times: list[str], limits: list[int]) -> dict[str, DataFrame]:
    """The same as one frame per limit, keyed '24h' and so on."""
    tagged = limit_hours(df, anchor, times, limits)
    return {f"{h}h": tagged.where(F.col("limit_h") == h).drop("limit_h") for h in limits}


def same_day(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.to_date(a) == F.to_date(b))


# ---------------------------------------------------------------- dummies


def fixed_dummies(df: DataFrame, col: str, values: list[str], other: str = "residual") -> DataFrame:
    """0/1 column per listed value plus <col>_other.

    other='residual' marks rows matching none of the real values; 'legacy_zero' repeats the
    published pipeline, where listing 'other' among the values turned that column to 0 for all."""
    text = F.lower(F.col(col))
    real = [v.lower() for v in values if v.lower() != "other"]
    flags = {f"{col}_{v}": F.coalesce((text == v).cast("int"), F.lit(0)) for v in real}
    if other == "legacy_zero" and len(real) < len(values):
        flags[f"{col}_other"] = F.lit(0)
    else:
        flags[f"{col}_other"] = 1 - F.coalesce(text.isin(real).cast("int"), F.lit(0))
    return df.withColumns(flags)


def top_values(df: DataFrame, col: str, k: int) -> list[str]:
    """The k most frequent values (k small), ties by name."""
    rows = (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .count()
        .orderBy(F.desc("count"), F.asc(col))
        .limit(k)
        .collect()
    )
    return [r[0] for r in rows]


def topk_label(df: DataFrame, col: str, vocabulary: list[str]) -> DataFrame:
    """Value cut at its first dot when it is in the vocabulary, else 'other'."""
    kept = F.col(col).isin(vocabulary)
    return df.withColumn(
        col, F.when(kept, S.first_label(F.col(col))).otherwise(F.lit("other"))
    )


def topk_dummies(df: DataFrame, col: str, vocabulary: list[str]) -> DataFrame:
    labelled = topk_label(df, col, vocabulary)
    names = sorted({v.split(".")[0] for v in vocabulary} | {"other"})
    return labelled.withColumns(
        {f"{col}_{n}": (F.col(col) == n).cast("int") for n in names}
    ).drop(col)


def window_dummies(
    df: DataFrame, col: str = "window_number", count: int = 5, keep: bool = False
) -> DataFrame:
    """window_0 ... flags; `keep` leaves the number itself for model routing."""
    flags = {
        f"window_{i}": F.coalesce((F.col(col) == i).cast("int"), F.lit(0)) for i in range(count)
    }
    out = df.withColumns(flags)
    return out if keep else out.drop(col)


# ---------------------------------------------------------------- values


def log_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """ln_<c> replaces each column."""
    require_columns(df, cols)
    return df.withColumns({f"ln_{c}": S.log_eps(F.col(c)) for c in cols}).drop(*cols)


def missing_flags(df: DataFrame, cols: list[str], fill: float = 0.0) -> DataFrame:
    flags = {f"{c}_is_missing": F.col(c).isNull().cast("int") for c in cols}
    return df.withColumns(flags).withColumns({c: F.coalesce(c, F.lit(fill)) for c in cols})


def fill_with_max(df: DataFrame, col: str) -> DataFrame:
    top = df.agg(F.max(col).alias("m")).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), top))


def null_audit(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: rows, NULLs and whether any NULL occurs."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    return counts.select(
        "_rows",
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in cols])
        ),
    ).select(
        "column",
        F.col("_rows").alias("rows"),
        "nulls",
        (F.col("nulls") > 0).cast("int").alias("has_nulls"),
    )


