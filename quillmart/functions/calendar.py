"""Calendar expressions for the date dimension and fact date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmart.functions.fixed_values import FIXED_HOLIDAYS


def date_key(c) -> Column:
    """YYYYMMDD as int (NULL stays NULL)."""
    d = F.col(c) if isinstance(c, str) else c
    return F.date_format(d, "yyyyMMdd").cast("int")


def holiday_name(d: Column) -> Column:
    expr = F.lit(None).cast("string")
    for month, day, name in reversed(FIXED_HOLIDAYS):
        expr = F.when((F.month(d) == month) & (F.dayofmonth(d) == day), F.lit(name)).otherwise(expr)
    return expr


def calendar_columns(d: Column) -> list[Column]:
    """Day, names, ISO weekday (Mon=1), ISO week, month, quarter, year, flags."""
    dow = F.weekday(d) + 1
    return [
        date_key(d).alias("date_sk"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        (dow >= 6).alias("is_weekend"),
        holiday_name(d).isNotNull().alias("is_holiday"),
        holiday_name(d).alias("holiday_name"),
    ]
