"""Calendar columns and holiday tables."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the short pi of the feature set "short".
SHORT_PI = 3.14159

# Fixed-date public holidays, (month, day, flag name), per country.
FIXED_HOLIDAYS = {
    "FR": (
        (1, 1, "is_new_year"),
        (5, 1, "is_labor_day"),
        (5, 8, "is_victory_day"),
        (7, 14, "is_bastille_day"),
        (8, 15, "is_assumption_day"),
        (11, 1, "is_all_saints_day"),
        (11, 11, "is_armistice_day"),
        (12, 25, "is_christmas_day"),
    ),
}

# Dated holidays (UK) and promotion days of the simulated calendar.
UK_HOLIDAYS = (
    "2010-01-01", "2010-04-02", "2010-04-05", "2010-05-03", "2010-05-31",
    "2010-08-30", "2010-12-25", "2010-12-26", "2010-12-27", "2010-12-28",
    "2011-01-01", "2011-04-22", "2011-04-25", "2011-05-02", "2011-05-30",
    "2011-08-29", "2011-12-25", "2011-12-26", "2011-12-27",
)
PROMO_DAYS = (
    "2010-11-26", "2010-12-26", "2011-01-01", "2011-07-01", "2011-11-25", "2011-12-26",
)

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def cyclic(value: Column, period: int, pi: float = math.pi) -> tuple[Column, Column]:
    """Sine and cosine of a cyclic value."""
    angle = F.lit(2 * pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_columns(date: Column, pi: float = math.pi, full: bool = True) -> dict[str, Column]:
    """Day-of-week (1 = Sunday), month, weekend flag and cyclic pairs; more when ``full``."""
    weekday, month = F.dayofweek(date), F.month(date)
    week_sin, week_cos = cyclic(weekday, 7, pi)
    month_sin, month_cos = cyclic(month, 12, pi)
    columns = {"day_of_week": weekday}
    if full:
        columns["day_of_month"] = F.dayofmonth(date)
    columns["month"] = month
    if full:
        columns["quarter"] = F.quarter(date)
        columns["year"] = F.year(date)
    columns["is_weekend"] = flag(weekday.isin(1, 7))
    columns["day_of_week_sin"] = week_sin
    columns["day_of_week_cos"] = week_cos
    columns["month_sin"] = month_sin
    columns["month_cos"] = month_cos
    return columns


def on_dates(date: Column, days: tuple[str, ...]) -> Column:
    """1 on the listed days, else 0."""
    return flag(date.isin(*[F.to_date(F.lit(day)) for day in days]))
