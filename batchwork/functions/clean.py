"""Column -> Column functions: cleaning, decoding, null rules and money arithmetic.

All of these are native Spark expressions, so they stay inside whole-stage codegen.
Rules referenced (see README): R2 missing-low compare, R4 null-skipping row sum,
R6 try_* parsing under ANSI, R7 explicit century pivot, R10 half-up rounding.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- null rules
def lt_missing(x, v) -> Column:
    """R2: a missing value compares below every number (``x < v`` is TRUE for null)."""
    x = _c(x)
    return x.isNull() | (x < v)


def le_missing(x, v) -> Column:
    x = _c(x)
    return x.isNull() | (x <= v)


def row_sum(*cols) -> Column:
    """SUM(a, b, ...) skips missing values; missing only when all are missing."""
    cs = [_c(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cs])
    return F.when(F.coalesce(*cs).isNull(), F.lit(None)).otherwise(total)


def default_missing(x, value) -> Column:
    """``IF x = . THEN x = value``."""
    return F.coalesce(_c(x), F.lit(value))


def blank_to_null(x) -> Column:
    """Fixed-width text: trailing blanks are insignificant, an all-blank field is missing."""
    t = F.rtrim(_c(x))
    return F.when(t == "", F.lit(None)).otherwise(t)


def first_non_blank(*cols) -> Column:
    """First non-missing, non-blank text among ``cols`` (trimmed)."""
    return F.coalesce(*[F.nullif(F.trim(_c(c)), F.lit("")) for c in cols])


def first_non_zero(*cols) -> Column:
    return F.coalesce(*[F.nullif(_c(c), F.lit(0)) for c in cols])


def clamp(x, lo=None, hi=None) -> Column:
    """Bound ``x`` to [lo, hi]; a missing ``x`` stays missing (greatest/least skip nulls)."""
    x = _c(x)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def mask_when(flag, x) -> Column:
    """Blank a measure on flagged rows."""
    return F.when(_c(flag), F.lit(None)).otherwise(_c(x))


# ---------------------------------------------------------------- numbers
def to_money(x, precision: int = 18, scale: int = 2) -> Column:
    """Cast to decimal so sums do not depend on partitioning or order."""
    return _c(x).cast(f"decimal({precision},{scale})")


def round_half_up(x, digits: int = 2) -> Column:
    """ROUND(x, .01) rounds half away from zero; exact on decimals."""
    return F.round(_c(x).cast("decimal(38,10)"), digits)


def trunc_to(x, digits: int = 2) -> Column:
    """Truncate toward zero to ``digits`` decimals."""
    x = _c(x).cast("decimal(38,10)")
    f = 10 ** digits
    return F.signum(x) * F.floor(F.abs(x) * f) / f


def scale_minor_units(x, factor: int = 100, width: int = 17, divisor: Column | None = None) -> Column:
    """Implied decimals for extracts: money × 100 → ``decimal(width,0)``.

    A quotient is scaled before it is divided, so that it is rounded once only.
    """
    scaled = _c(x).cast("decimal(28,6)") * F.lit(factor).cast("decimal(10,0)")
    if divisor is not None:
        scaled = scaled / divisor
    return F.round(scaled, 0).cast(f"decimal({width},0)")


def parse_number(x) -> Column:
    """Text → number; bad text → NULL."""
    return F.trim(_c(x)).try_cast("double")


def parse_amount(x) -> Column:
    """``COMMA22.2``: ``1,234.56``, ``-5.00``, ``5.00-`` and blank → decimal(22,2)."""
    t = F.regexp_replace(F.trim(_c(x)), ",", "")
    neg = t.endswith("-")
    body = F.when(neg, F.regexp_replace(t, "-$", "")).otherwise(t)
    v = F.nullif(body, F.lit("")).try_cast("decimal(22,2)")
    return F.when(neg, -v).otherwise(v)


def digits_only(x) -> Column:
    return F.regexp_replace(_c(x), "[^0-9]", "")


def zero_pad(x, width: int) -> Column:
    """Z-format: integer text left-padded with zeros (caller checks the width first)."""
    return F.lpad(_c(x).cast("decimal(38,0)").cast("string"), width, "0")


def abs_flip(x, flip) -> Column:
    """Make an amount positive and flip it where ``flip`` holds."""
    a = F.abs(_c(x))
    return F.when(_c(flip), -a).otherwise(a)


# ---------------------------------------------------------------- dates
def expand_year(yy, cutoff: int) -> Column:
    """Two-digit year with an explicit century pivot (SAS YEARCUTOFF)."""
    base = cutoff - cutoff % 100
    yy = _c(yy)
    return F.when(yy >= cutoff % 100, F.lit(base) + yy).otherwise(F.lit(base + 100) + yy)


def date_from_yymmdd(x, cutoff: int = 1950) -> Column:
    """6-digit YYMMDD number or text → date, century by ``cutoff``; bad → NULL."""
    s = F.lpad(_c(x).cast("string"), 6, "0")
    yy = F.substring(s, 1, 2).try_cast("int")
    y = expand_year(yy, cutoff)
    return try_date(F.concat(F.lpad(y.cast("string"), 4, "0"), F.substring(s, 3, 4)), "yyyyMMdd")


def date_from_mmddyyyy(x) -> Column:
    """11-digit number whose first 8 digits are MMDDYYYY (leading zero may be lost)."""
    s = F.lpad(_c(x).cast("decimal(20,0)").cast("string"), 11, "0")
    return try_date(F.substring(s, 1, 8), "MMddyyyy")


def date_from_day_number(n) -> Column:
    """Day count since 1960-01-01 → date."""
    return F.date_add(F.lit("1960-01-01").cast("date"), _c(n).cast("int"))


def day_number(d) -> Column:
    return F.datediff(_c(d), F.lit("1960-01-01").cast("date"))


def date_from_parts(y, m, d) -> Column:
    """MDY(m, d, y); an impossible date is NULL."""
    return try_date(F.concat(F.lpad(_c(y).cast("string"), 4, "0"), F.lpad(_c(m).cast("string"), 2, "0"),
                             F.lpad(_c(d).cast("string"), 2, "0")), "yyyyMMdd")


def try_date(s, fmt: str) -> Column:
    return F.try_to_date(_c(s), fmt)


def days_between(a, b) -> Column:
    return F.datediff(_c(b), _c(a))


def month_end_offset(d, n: int) -> Column:
    return F.last_day(F.add_months(_c(d), n))


def term_months(d1, d2) -> Column:
    """Months between the months of two dates: 12·Δy + Δm."""
    return (F.year(_c(d2)) - F.year(_c(d1))) * 12 + (F.month(_c(d2)) - F.month(_c(d1)))


def same_month(a, b) -> Column:
    return F.trunc(_c(a), "MM") == F.trunc(_c(b), "MM")


def remaining_months(expiry, rept) -> Column:
    """Months left to maturity, counted the way a month-stepping loop counts them.

    Closed form: 12·Δy + Δm, plus one when the maturity day lies beyond the report
    date's anniversary day in the maturity month, at least 1.  The anniversary day is
    the month's last day when the report day is ≥ 30 (≥ 29 in February), else the
    report day itself.  Maturity before the report date or missing → NULL (caller maps
    it to its own code); maturity on the report date counts as 1.
    """
    e, r = _c(expiry), _c(rept)
    base = term_months(r, e)
    rd = F.dayofmonth(r)
    end_of_e = F.dayofmonth(F.last_day(e))
    anniv = F.when(rd >= 30, end_of_e).otherwise(F.least(rd, end_of_e))
    n = base + F.when(F.dayofmonth(e) > anniv, 1).otherwise(0)
    return F.when(e.isNull() | r.isNull() | (e < r), F.lit(None)).otherwise(F.greatest(n, F.lit(1)))


def arrears_months(days) -> Column:
    """Months in arrears from overdue days: floor(days / 30.00050)."""
    return F.floor(_c(days).cast("decimal(12,2)") / F.lit(30.0005).cast("decimal(10,5)"))


def instalments_due(days) -> Column:
    return F.ceil(_c(days).cast("decimal(12,2)") / F.lit(30.0005).cast("decimal(10,5)"))


def short_term(a, b, limit: int = 366) -> Column:
    """Days between < limit → short term; a missing difference counts as short (R2)."""
    return lt_missing(days_between(a, b), limit)


def unearned_interest(n_left, n_total, interest) -> Column:
    """Sum-of-digits (rule of 78) unearned interest: n(n+1)·I / N(N+1)."""
    n, N, i = _c(n_left), _c(n_total), _c(interest)
    return F.when(N > 0, (n * (n + 1) * i) / (N * (N + 1)))


# ---------------------------------------------------------------- text
def strip_chars(x, chars: str) -> Column:
    """Strip any of ``chars`` from both ends."""
    return F.btrim(_c(x), F.lit(chars))


def remove_chars(x, chars: str) -> Column:
    """COMPRESS(x, chars): delete every listed character."""
    return F.translate(_c(x), chars, "")


def valid_length(x, n: int) -> Column:
    return F.length(F.rtrim(_c(x))) == n


def normalise_code(x, filler: str = "0") -> Column:
    """a code that starts with 0 gets a trailing filler."""
    x = _c(x)
    return F.when(x.startswith("0"), F.concat(F.rtrim(x), F.lit(filler))).otherwise(x)
