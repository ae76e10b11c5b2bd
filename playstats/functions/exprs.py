"""Column-expression helpers.

Everything here returns a ``Column`` built from Spark built-ins, so it stays inside
whole-stage codegen. No Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "num_round", "int_div", "month_name_padded", "year_month",
    "month_start", "affinity_tier", "skip_behavior", "listening_pattern",
    "one_hot", "seconds_between", "ntz_literal", "AFFINITY_LABELS", "SKIP_LABELS", "PATTERN_LABELS", "col_or_name",
]

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")

# Tier labels and thresholds used by the feature views.
AFFINITY_LABELS = ("loved", "liked", "casual fan", "tried")  # >=20, >=10, >=3, else
SKIP_LABELS = ("high skip", "moderate skip", "never skipped", "low skip")  # >50, >30, =0, else
PATTERN_LABELS = ("long term", "regular", "occasional", "rare")  # >50, >20, >10, else


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num_round(c, digits: int) -> Column:
    """``round(x::numeric, d)`` of PostgreSQL: decimal rounding, half away from zero.

    The double is first fixed to 10 decimals so last-bit noise from summation
    order cannot move a value across a rounding boundary, then rounded and
    returned as double.
    """
    return F.round(col_or_name(c).cast("decimal(38,10)"), digits).cast("double")


def int_div(a: str, b: str) -> Column:
    """Integer division (``/`` on two integers in PostgreSQL), truncating toward zero.

    Arguments are SQL expression strings; Spark's ``div`` operator is exact on longs.
    """
    return F.expr(f"({a}) div ({b})")


def ntz_literal(value) -> Column:
    """A timestamp_ntz literal from a datetime/date, independent of any time zone.

    ``F.lit(datetime)`` would make a zoned timestamp through the Python process's
    local zone; going through text keeps the wall-clock value exactly.
    """
    return F.lit(value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()) \
        .cast("timestamp_ntz")


def seconds_between(start: str, end: str) -> Column:
    """Whole seconds from ``start`` to ``end`` (``extract(epoch from end - start)``)."""
    return F.expr(f"timestampdiff(SECOND, {start}, {end})")


def month_start(ts) -> Column:
    """``date_trunc('month', ts)`` of a timestamp_ntz, by way of a date (no time zone)."""
    return F.trunc(col_or_name(ts).cast("date"), "month").cast("timestamp_ntz")


def month_name_padded(ts) -> Column:
    """``to_char(ts, 'Month')``: English month name blank-padded to 9 characters."""
    months = F.array(*[F.lit(m.ljust(9)) for m in MONTHS])
    day = col_or_name(ts).cast("date")
    return F.when(day.isNotNull(), F.element_at(months, F.month(day)))


def year_month(ts) -> Column:
    """``to_char(ts, 'YYYY-MM')``."""
    return F.substring(col_or_name(ts).cast("date").cast("string"), 1, 7)


def affinity_tier(total_plays) -> Column:
    p = col_or_name(total_plays)
    return (F.when(p >= 20, F.lit(AFFINITY_LABELS[0]))
            .when(p >= 10, F.lit(AFFINITY_LABELS[1]))
            .when(p >= 3, F.lit(AFFINITY_LABELS[2]))
            .otherwise(F.lit(AFFINITY_LABELS[3])))


def skip_behavior(skip_rate) -> Column:
    s = col_or_name(skip_rate)
    return (F.when(s > 50, F.lit(SKIP_LABELS[0]))
            .when(s > 30, F.lit(SKIP_LABELS[1]))
            .when(s == 0, F.lit(SKIP_LABELS[2]))
            .otherwise(F.lit(SKIP_LABELS[3])))


def listening_pattern(days_played) -> Column:
    d = col_or_name(days_played)
    return (F.when(d > 50, F.lit(PATTERN_LABELS[0]))
            .when(d > 20, F.lit(PATTERN_LABELS[1]))
            .when(d > 10, F.lit(PATTERN_LABELS[2]))
            .otherwise(F.lit(PATTERN_LABELS[3])))


def one_hot(predicate: Column) -> Column:
    """``CASE WHEN pred THEN 1 ELSE 0 END``: NULL predicates give 0."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))
