"""Scalar expressions: dates, text keys, safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOG_EPSILON = 1e-10


def safe_div(num: Column, den: Column) -> Column:
    """a / b as a double, NULL where b is zero or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def swap_value(col: Column, old: float, new: float) -> Column:
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def clip(col: Column, low: float, high: float) -> Column:
    """Bounds keep NULL as NULL (greatest/least alone would skip it)."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def finite_or(col: Column, default: float) -> Column:
    """NaN, infinity and NULL become the default."""
    bad = col.isNull() | F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
    return F.when(bad, F.lit(default)).otherwise(col)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def half_even(col: Column, digits: int = 0) -> Column:
    """Half-to-even on the scaled binary value, as array libraries round."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale if digits else F.rint(col)


def half_up(col: Column, digits: int = 0) -> Column:
    """Half away from zero. The last bits of a float sum depend on the order of addition, so they
    are dropped first; otherwise exact halves would round at random."""
    return F.round(F.round(col, digits + 7), digits)


def log_eps(col: Column) -> Column:
    """ln(x + 1e-10); NULL for negative input."""
    return F.ln(col + F.lit(LOG_EPSILON))


def signed_log(col: Column) -> Column:
    return F.signum(col) * F.log1p(F.abs(col))


def email_domain(col: Column) -> Column:
    """Text after the first @, or the whole text when there is none."""
    return F.substr(col, F.instr(col, "@") + F.lit(1))


def first_label(col: Column) -> Column:
    """'gmail.com' -> 'gmail'."""
    return F.regexp_replace(col, r"\..*", "")


def hour_of_week(ts: Column) -> Column:
    """0 = Monday 00h ... 167 = Sunday 23h."""
    return F.weekday(ts) * F.lit(24) + F.hour(ts)


def whole_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("HOUR", start, end)


def hours_to_first_purchase(signup: Column, first: Column) -> Column:
    """Fractional hours (the feature's legacy name is time_diff_minutes)."""
    return F.timestamp_diff("SECOND", signup, first) / F.lit(3600.0)


def week_monday(day: Column) -> Column:
    return F.to_date(F.date_trunc("week", day))


def channel_label(platform: Column, channel: Column, channel_type: Column) -> Column:
    """App traffic is named by channel alone, everything else by channel-type."""
    name = F.coalesce(channel, F.lit("unknown"))
    kind = F.coalesce(channel_type, F.lit("unknown"))
    return F.when(F.lower(F.coalesce(platform, F.lit(""))) == "app", name).otherwise(
        F.concat(name, F.lit("-"), kind)
    )


def spend_key(platform: Column, channel: Column, channel_type: Column) -> Column:
    """Key of the cost tables: channel_app, or channel_type of channel, in lower case."""
    return F.when(
        F.lower(platform).like("%app%"), F.lower(F.concat(channel, F.lit("_app")))
    ).otherwise(F.lower(F.concat(channel, F.lit("_"), channel_type)))


def merge_restricted(col: Column) -> Column:
    return F.when(col == "restricted_app", F.lit("facebook_app")).otherwise(col)


def band(col: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-open bins; edges has one entry more than labels, the last may be infinite."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (col >= low) if high == float("inf") else (col >= low) & (col < high)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def draw(seed: object, *keys: Column) -> Column:
    """Reproducible random text: md5 of the seed and the key."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def draw_int(seed: object, *keys: Column) -> Column:
    """First 32 bits of draw() as a number."""
    return F.conv(F.substring(draw(seed, *keys), 1, 8), 16, 10).cast("bigint")
