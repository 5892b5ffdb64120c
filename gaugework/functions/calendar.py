"""Calendar and clock attributes as expressions over a date or a second-of-day column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .classes import first_band

# Calendar origin, shift limits in seconds, meal hours (inclusive, whole hours).
CALENDAR_START = "2000-01-01"
CALENDAR_DAYS = 7_305
DAY_SECONDS = 86_400
SHIFTS = ((28_800, "night"), (57_600, "day"))
MEALS = ((6, 10, "breakfast"), (11, 14, "lunch"))


def date_attributes(d: Column, start: str = CALENDAR_START) -> dict[str, Column]:
    """Attributes of the date dimension.

    Same-day pointers are surrogate keys of the dimension itself (day number + 1) and null where
    they would fall before its first day; the week number is the ISO week of the year.
    """
    day_no = F.datediff(d, F.lit(start).cast("date"))
    key = (day_no + 1).cast("long")
    quarter_seq = F.year(d) * 4 + F.quarter(d)
    flag = F.lit(False)

    def back(days: int) -> Column:
        return F.when(day_no >= days, (day_no + 1 - days)).cast("int")

    return {
        "d_date_sk": key,
        "d_date_id": F.date_format(d, "yyyyMMdd"),
        "d_date": d,
        "d_month_seq": F.year(d) * 12 + F.month(d),
        "d_week_seq": F.weekofyear(d),
        "d_quarter_seq": quarter_seq,
        "d_year": F.year(d),
        "d_dow": (F.dayofweek(d) - 1).cast("smallint"),
        "d_moy": F.month(d).cast("smallint"),
        "d_dom": F.dayofmonth(d).cast("smallint"),
        "d_qoy": F.quarter(d).cast("smallint"),
        "d_fy_year": F.year(d),
        "d_fy_quarter_seq": quarter_seq,
        "d_fy_week_seq": F.weekofyear(d),
        "d_day_name": F.date_format(d, "EEEE"),
        "d_quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "d_holiday": flag,
        "d_weekend": F.dayofweek(d).isin(1, 7),
        "d_following_holiday": flag,
        "d_first_dom": F.dayofmonth(F.trunc(d, "month")),
        "d_last_dom": F.dayofmonth(F.last_day(d)),
        "d_same_day_ly": back(364),
        "d_same_day_lq": back(90),
        "d_current_day": flag,
        "d_current_week": flag,
        "d_current_month": flag,
        "d_current_quarter": flag,
        "d_current_year": flag,
    }


def clock_attributes(sec: Column) -> dict[str, Column]:
    """Attributes of the time dimension; meals go by the whole hour, so 10:59:59 is breakfast."""
    hour = F.floor(sec / 3600)
    return {
        "t_time_sk": (sec + 1).cast("long"),
        "t_time_id": F.lpad(sec.cast("string"), 6, "0"),
        "t_time": sec.cast("int"),
        "t_hour": hour.cast("smallint"),
        "t_minute": F.floor(F.pmod(sec, F.lit(3600)) / 60).cast("smallint"),
        "t_second": F.pmod(sec, F.lit(60)).cast("smallint"),
        "t_am_pm": first_band([(sec < DAY_SECONDS // 2, "AM")], "PM"),
        "t_shift": first_band([(sec < limit, name) for limit, name in SHIFTS], "evening"),
        "t_sub_shift": F.lit("standard"),
        "t_meal_time": first_band([(hour.between(lo, hi), name) for lo, hi, name in MEALS], "other"),
    }


def as_columns(attributes: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in attributes.items()]


def date_dim(days: DataFrame) -> DataFrame:
    """Calendar rows for a DataFrame of distinct ``d_date`` values."""
    return days.select(*as_columns(date_attributes(F.col("d_date"))))


def time_dim(seconds: DataFrame) -> DataFrame:
    """Clock rows for a DataFrame of distinct ``second`` values of the day."""
    return seconds.select(*as_columns(clock_attributes(F.col("second"))))
