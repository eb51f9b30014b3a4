"""Number, money, band and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import clean, col

#: Fixed values of the capacity bands: lower edges, each band reaches to the next; the last is open.
BANDS = (0, 5, 10, 15, 25, 40, 62, 75, 100, 125, 175, 225, 350, 500)
#: Seconds of a day, days of a mean month.
DAY, MONTH_DAYS = 86400.0, 30.4375


def number(c: str | Column) -> Column:
    """A finite number from text with signs of money and thousands; null otherwise."""
    x = F.regexp_replace(clean(c), "[$,\\s]", "").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def money(c: str | Column) -> Column:
    """12K, $1.5m or a plain number; null if anything else stands there (an open end such as 150K+ too)."""
    text = F.lower(F.regexp_replace(clean(c), "[$,\\s]", ""))
    x = F.regexp_extract(text, "^(-?[0-9]+(\\.[0-9]+)?)([km]?)$", 1).try_cast("double")
    unit = F.regexp_extract(text, "([km])$", 1)
    return x * F.when(unit == "k", 1000.0).when(unit == "m", 1000000.0).otherwise(1.0)


def money_range(c: str | Column) -> tuple[Column, Column]:
    """Both ends of a range with any dash; one value is both."""
    parts = F.split(clean(c), "\\s*[-–—]\\s*")
    return money(F.get(parts, F.lit(0))), money(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))


def band(c: str | Column, edges: tuple[float, ...], above: float | None = None, step: float = 0) -> Column:
    """Lower edge of the half-open band that holds the value, steps of equal width from `above` on; null below the first."""
    x, out = col(c), F.lit(None).cast("double")
    for e in edges:
        out = F.when(x >= e, F.lit(float(e))).otherwise(out)
    return F.when(x >= above, above + F.floor((x - above) / step) * step).otherwise(out) if above is not None else out


def bucket(c: str | Column, edges: tuple[float, ...]) -> Column:
    """Number of the interval [edge, next edge); values outside are in the last."""
    x, out = col(c), F.lit(len(edges) - 2)
    for k in range(len(edges) - 1):
        out = F.when((x >= edges[k]) & (x < edges[k + 1]), F.lit(k)).otherwise(out)
    return out


def in_range(x: Column, low: Column, high: Column) -> Column:
    return F.coalesce((low > 0) & (low <= x) & (x <= high), F.lit(False))


def ratio_class(sales: Column, model: Column) -> Column:
    """How far a sales estimate is from the model's: by ratio and difference, the strongest first."""
    r, d = F.try_divide(sales, model), sales - model
    return (
        F.when(r.isNull(), F.lit("no_model")).when((r >= 3) & (d >= 100), "severe_over").when((r >= 2) & (d >= 50), "over")
        .when((r <= 1 / 3) & (d <= -100), "severe_under").when((r <= 0.5) & (d <= -50), "under")
        .when(F.abs(d) <= F.greatest(F.lit(5.0), F.abs(model) * 0.05), "echo").otherwise("aligned")
    )


def shrunk(local: Column, prior: Column, n: Column, strength: float = 8.0) -> Column:
    """The local value drawn to the prior as far as it rests on few rows."""
    w = n / (n + F.lit(strength))
    return w * local + (1 - w) * prior


def moment(c: str | Column) -> Column:
    """A timestamp from lenient ISO text: Z, a space, or the date alone; null otherwise."""
    text = clean(c)
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(F.left(text, F.lit(10)), F.lit("yyyy-MM-dd")))


def age_days(at: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / (DAY * 1e6)


def recency(age: Column, half_life: float = 365.0) -> Column:
    return F.pow(F.lit(2.0), -age / half_life)


def fresh(age: Column, days: float = 90.0) -> Column:
    return F.coalesce((age >= 0) & (age <= days), F.lit(False))


def age_months(at: Column, as_of: Column) -> Column:
    return F.round(age_days(at, as_of) / MONTH_DAYS, 1)


def cohort_ceiling(p90: Column, legal: Column) -> Column:
    """Three times the cohort's 90 % point, within the lane's limits (fixed values)."""
    limit = lambda low, high: F.least(F.greatest(3 * p90, F.lit(low)), F.lit(high))
    return F.when(legal, limit(250.0, 1000.0)).otherwise(limit(750.0, 2500.0))
