"""Column functions: calendar attributes and scalar helpers (all JVM-side).

Every function takes and returns a ``Column`` so it stays inside whole-stage
codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescast.functions import fixed


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# SC1 ------------------------------------------------------------------------
def year(d) -> Column:
    return F.year(_c(d))


def month(d) -> Column:
    return F.month(_c(d))


def quarter(d) -> Column:
    return F.quarter(_c(d))


def day_of_month(d) -> Column:
    return F.dayofmonth(_c(d))


# SC2: Monday = 0 .. Sunday = 6 (``weekday``; ``dayofweek`` is Sunday = 1)
def day_of_week(d) -> Column:
    return F.weekday(_c(d))


# SC3: ISO week number
def week_of_year(d) -> Column:
    return F.weekofyear(_c(d))


# SC4
def is_weekend(d) -> Column:
    return (F.weekday(_c(d)) >= 5).cast("int")


# SC5: 15th or last day of the month
def is_payday(d) -> Column:
    d = _c(d)
    dom = F.dayofmonth(d)
    return ((dom == 15) | (dom == F.dayofmonth(F.last_day(d)))).cast("int")


# SC6: first five days of the month
def is_month_start(d) -> Column:
    return (F.dayofmonth(_c(d)) <= 5).cast("int")


# SC7
def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def year_month(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def year_quarter(d) -> Column:
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def fiscal_year(d) -> Column:
    return F.year(_c(d))


# PR5: integer yyyymmdd key and its inverse
def date_key(d) -> Column:
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def from_date_key(k) -> Column:
    return F.to_date(_c(k).cast("string"), "yyyyMMdd")


# SC8: weekly bucket labelled by the Sunday that ends the week
def week_ending(d) -> Column:
    return F.date_add(F.date_trunc("week", _c(d)).cast("date"), 6)


# SC9
def days_between(end, start) -> Column:
    return F.datediff(_c(end), _c(start))


def calendar_features(d="date") -> dict[str, Column]:
    """The nine calendar feature columns the model uses, in order."""
    return {
        "year": year(d),
        "month": month(d),
        "day_of_week": day_of_week(d),
        "day_of_month": day_of_month(d),
        "week_of_year": week_of_year(d),
        "quarter": quarter(d),
        "is_weekend": is_weekend(d),
        "is_payday": is_payday(d),
        "is_month_start": is_month_start(d),
    }


# SC11: DIVIDE(a, b, BLANK()) -> NULL when b is 0 or NULL
def safe_divide(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


# PR1: clip at a lower bound, keeping NULL as NULL
def clip_lower(c, lower=0) -> Column:
    c = _c(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


# PR15: max(p, 0) rounded half-to-even to whole units
def post_process(p) -> Column:
    return F.bround(clip_lower(p, 0.0), 0)


# SC14: forecast horizon label from days ahead; NULL beyond the last bin
def horizon_label(days_ahead, bins=None) -> Column:
    days_ahead = _c(days_ahead)
    bins = bins or fixed.HORIZON_BINS
    expr = None
    for lo, hi, label in bins:
        cond = (days_ahead > lo) & (days_ahead <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


# SC12: display text for money and percentages
def money_text(c, scale: str = "M", digits: int = 1) -> Column:
    div = {"B": 1e9, "M": 1e6, "K": 1e3, "": 1.0}[scale]
    return F.concat(F.lit("$"), F.format_number(_c(c) / div, digits), F.lit(scale))


def percent_text(c, digits: int = 2) -> Column:
    return F.concat(F.format_number(_c(c) * 100, digits), F.lit("%"))


# SC13 helpers used by the formatting measures (ME16, ME17)
def yoy_colour(growth) -> Column:
    g = _c(growth)
    return (F.when(g > fixed.YOY_BAND, F.lit(fixed.YOY_GREEN))
            .when(g < -fixed.YOY_BAND, F.lit(fixed.YOY_RED))
            .otherwise(F.lit(fixed.YOY_GREY)))


def mape_status(mape, blank_as_zero: bool = False) -> Column:
    """MAPE band; a NULL MAPE gives NULL unless ``blank_as_zero`` (the BI
    tool compares BLANK as 0, so NULL then reads "Excellent")."""
    m = _c(mape)
    if blank_as_zero:
        m = F.coalesce(m, F.lit(0.0))
    expr = None
    for limit, label in fixed.MAPE_STATUS:
        expr = F.when(m <= limit, F.lit(label)) if expr is None else expr.when(m <= limit, F.lit(label))
    out = expr.otherwise(F.lit(fixed.MAPE_STATUS_ELSE))
    if not blank_as_zero:
        out = F.when(m.isNull(), F.lit(None).cast("string")).otherwise(out)
    return out
