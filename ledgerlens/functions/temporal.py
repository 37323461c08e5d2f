"""Calendar features as Spark column expressions (DT1-DT17).

All are built-in, codegen'd expressions. Flags follow pandas: a NULL date gives 0, not NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col, fmt: str | None = None) -> Column:
    """DT1: text -> date, unparseable -> NULL."""
    text = _c(col).cast("string")
    ts = F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)
    return F.to_date(ts)


def day_of_week(d) -> Column:
    """Monday = 0 ... Sunday = 6 (``weekday``; ``dayofweek`` would start on Sunday = 1)."""
    return F.weekday(_c(d))


def date_parts(d) -> dict[str, Column]:
    """DT2: year, month, day."""
    d = _c(d)
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def calendar_columns(d) -> dict[str, Column]:
    """DT3-DT11 and the cyclic encodings DT14-DT16."""
    d = _c(d)
    dow = day_of_week(d)
    month = F.month(d)
    doy = F.dayofyear(d)
    q_start = F.trunc(d, "quarter")

    def flag(cond: Column) -> Column:
        return F.coalesce(cond.cast("int"), F.lit(0))

    return {
        "quarter": F.quarter(d),
        "day_of_week": dow,
        "week_of_year": F.weekofyear(d),
        "day_of_year": doy,
        "is_weekend": flag(dow >= 5),
        "is_month_start": flag(F.dayofmonth(d) == 1),
        "is_month_end": flag(d == F.last_day(d)),
        "is_quarter_start": flag(d == q_start),
        "is_quarter_end": flag(d == F.last_day(F.add_months(q_start, 2))),
        "month_sin": F.sin(F.lit(TWO_PI) * month / 12.0),
        "month_cos": F.cos(F.lit(TWO_PI) * month / 12.0),
        "day_of_week_sin": F.sin(F.lit(TWO_PI) * dow / 7.0),
        "day_of_week_cos": F.cos(F.lit(TWO_PI) * dow / 7.0),
        "day_of_year_sin": F.sin(F.lit(TWO_PI) * doy / 365.0),
        "day_of_year_cos": F.cos(F.lit(TWO_PI) * doy / 365.0),
    }


def elapsed_columns(d, first_day, last_day) -> dict[str, Column]:
    """DT12-DT13: days since the first date and until the last one (bounds fitted once)."""
    d = _c(d)
    return {
        "days_from_start": F.datediff(d, F.lit(first_day).cast("date")),
        "days_from_end": F.datediff(F.lit(last_day).cast("date"), d),
    }


def year_month_columns(d) -> dict[str, Column]:
    """DT17: year, month and the unpadded ``Y_M`` label."""
    d = _c(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "year_month": F.concat(F.year(d).cast("string"), F.lit("_"), F.month(d).cast("string")),
    }
