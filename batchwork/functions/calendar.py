"""Report calendar: the period a run date belongs to, as column expressions.

A month is cut into four reporting weeks that close on the 8th, 15th, 22nd and the
month end.  Every job derives its scalars (week number, first day of the week, the
previous week, the previous month with year wrap) from the report date; here those
scalars are columns, so a whole calendar table can be derived in one projection and
joined (broadcast, it is one row per day) where a job needs it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import _c

# Fixed values of the reporting calendar: week-closing day → (week no., first day of
# the week, previous week no.).  Any other closing day is week 4.
WEEK_CLOSE_DAYS = {8: ("1", 1, "4"), 15: ("2", 9, "1"), 22: ("3", 16, "2")}
LAST_WEEK = ("4", 23, "3")


def week_of(d) -> Column:
    day = F.dayofmonth(_c(d))
    out = F.lit(LAST_WEEK[0])
    for close, (wk, _, _) in sorted(WEEK_CLOSE_DAYS.items(), reverse=True):
        out = F.when(day == close, F.lit(wk)).otherwise(out)
    return out


def week_start_day(d) -> Column:
    day = F.dayofmonth(_c(d))
    out = F.lit(LAST_WEEK[1])
    for close, (_, sdd, _) in sorted(WEEK_CLOSE_DAYS.items(), reverse=True):
        out = F.when(day == close, F.lit(sdd)).otherwise(out)
    return out


def previous_week(d) -> Column:
    day = F.dayofmonth(_c(d))
    out = F.lit(LAST_WEEK[2])
    for close, (_, _, prev) in sorted(WEEK_CLOSE_DAYS.items(), reverse=True):
        out = F.when(day == close, F.lit(prev)).otherwise(out)
    return out


def previous_month_no(d) -> Column:
    """Month number before the report month, December after January."""
    m = F.month(_c(d))
    return F.when(m == 1, F.lit(12)).otherwise(m - 1)


def week_month_no(d) -> Column:
    """Month the previous week falls in: previous month in week 1, else this month."""
    return F.when(week_of(d) == "1", previous_month_no(d)).otherwise(F.month(_c(d)))


def report_period(d) -> dict[str, Column]:
    """All period scalars of a report date as named columns."""
    d = _c(d)
    return {
        "rept_week": week_of(d),
        "rept_prev_week": previous_week(d),
        "rept_month": F.lpad(F.month(d).cast("string"), 2, "0"),
        "rept_prev_month": F.lpad(previous_month_no(d).cast("string"), 2, "0"),
        "rept_week_month": F.lpad(week_month_no(d).cast("string"), 2, "0"),
        "rept_year2": F.substring(F.year(d).cast("string"), 3, 2),
        "rept_day": F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
        "week_start": F.make_date(F.year(d), F.month(d), week_start_day(d)),
        "month_start": F.trunc(d, "MM"),
        "prev_month_start": F.add_months(F.trunc(d, "MM"), -1),
    }


def period_end_of(run_date) -> Column:
    """Roll a run date back to the last closed reporting week end.

    Days 1-7 → previous month end; 8-14 → the 8th; 15-21 → the 15th; else the 22nd.
    """
    d = _c(run_date)
    day = F.dayofmonth(d)
    y, m = F.year(d), F.month(d)
    return (F.when(day < 8, F.date_sub(F.trunc(d, "MM"), 1))
            .when(day < 15, F.make_date(y, m, F.lit(8)))
            .when(day < 22, F.make_date(y, m, F.lit(15)))
            .otherwise(F.make_date(y, m, F.lit(22))))


def month_start(d) -> Column:
    return F.trunc(_c(d), "MM")


def prev_month_start(d) -> Column:
    return F.add_months(F.trunc(_c(d), "MM"), -1)
