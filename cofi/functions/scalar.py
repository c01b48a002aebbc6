"""Column expressions shared by every operator. All are built-in expressions (no UDF),
so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating scale of the reference (1 to 5 stars).
RATING_LO = 1.0
RATING_HI = 5.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def scale(x, avg, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """Distance from ``avg`` to the end of the scale that ``x`` lies towards; 1 when x == avg."""
    x, avg = _c(x), _c(avg)
    return (F.when(x > avg, F.lit(hi) - avg)
             .when(x < avg, avg - F.lit(lo))
             .otherwise(F.lit(1.0)))


def normalized_deviation(rating, avg, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """(r - avg) / scale(r, avg); the denominator is non-zero for ratings inside [lo, hi]."""
    rating, avg = _c(rating), _c(avg)
    return (rating - avg) / scale(rating, avg, lo, hi)


def denormalize(avg, dev, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """avg + dev * scale(avg + dev, avg): maps a deviation back onto the rating scale."""
    avg, dev = _c(avg), _c(dev)
    return avg + dev * scale(avg + dev, avg, lo, hi)


def weighted_deviation(weighted_sum, weight_sum) -> Column:
    """sum(s * dev) / sum(|s|), 0 when no weight (or no neighbour) contributes."""
    return F.coalesce(F.try_divide(_c(weighted_sum), _c(weight_sum)), F.lit(0.0))


def safe_int(s) -> Column:
    """64-bit integer parse that yields NULL instead of failing."""
    return _c(s).try_cast("bigint")


def in_range(x, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    return _c(x).between(lo, hi)


def checked_rating(x, lo: float = RATING_LO, hi: float = RATING_HI) -> Column:
    """The rating, or an error that names it: a missing one, or one outside [lo, hi], would
    later divide by zero or bend every average of its user."""
    x = _c(x)
    return (F.when(x.isNull(), F.raise_error(F.lit("a rating is missing; load with null_ratings='drop' to leave it out")))
             .when(~in_range(x, lo, hi), F.raise_error(F.concat(
                 F.lit("rating outside the scale: "), x.cast("string"))))
             .otherwise(x))


def mean_or_zero(x) -> Column:
    """Aggregate: mean, 0.0 for an empty input."""
    return F.coalesce(F.avg(_c(x)), F.lit(0.0))


def std_or_zero(x) -> Column:
    """Aggregate: population standard deviation, 0.0 for an empty input."""
    return F.coalesce(F.stddev_pop(_c(x)), F.lit(0.0))


def round_key(x, digits: int) -> Column:
    """floor(x * 10^digits + 0.5): x in units of 10^-digits, rounded half up.

    Plain IEEE double arithmetic (one multiply, one add, floor): every step is exactly
    rounded, so any engine computing it from the same double gets the same result, and it
    stays inside generated code (unlike decimal rounding, which allocates per row).
    """
    return F.floor(_c(x) * F.lit(10.0 ** digits) + F.lit(0.5))


def round_out(x, digits: int = 6) -> Column:
    """x rounded half up to ``digits`` decimals, as a double (see ``round_key``)."""
    return round_key(x, digits) / F.lit(10.0 ** digits)
