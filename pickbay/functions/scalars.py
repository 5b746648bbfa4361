"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Where Spark 4's ANSI mode would throw on dirty input (division by
zero, unparsable text) the ``try_`` variants return null instead, which is what
the reference's Hive semantics produced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null condition gives 0 (CASE WHEN semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def day_of(c) -> Column:
    """Calendar day of a timestamp, date or 'yyyy-MM-dd...' text; text that is
    not a date gives null (ANSI `to_date` would fail the job)."""
    return _col(c).try_cast("date")


def minute_text(c) -> Column:
    """First 16 characters of a time text: 'yyyy-MM-dd HH:mm'."""
    return F.substring(_col(c), 1, 16)


def text_to_int(c) -> Column:
    """Quantity text such as '23.0' to int, truncating; bad text gives null."""
    return _col(c).try_cast("double").try_cast("int")


def clamp_positive(c, upper: float | None = None) -> Column:
    """Keep a quantity when 0 < q (< upper), else 0."""
    c = _col(c)
    cond = c > 0
    if upper is not None:
        cond = cond & (c < upper)
    return F.when(cond, c).otherwise(F.lit(0))


def ratio_or_default(num, den, default, scale: int = 4) -> Column:
    """round(num / den, scale); a null or zero denominator falls back to `default`."""
    return F.coalesce(F.round(F.try_divide(_col(num), _col(den)), scale), _col(default))


def capped_share(ratio, bonus: float) -> Column:
    """Daily order share to cover: min(bonus + ratio, 1), exact to 2 decimals."""
    return F.least(F.lit(bonus) + _col(ratio), F.lit(1.0)).cast("decimal(4,2)")


def valid_after(check_tm, submit_tm) -> Column:
    """A check time counts only when it is not before the submit time."""
    return F.when(_col(check_tm) >= _col(submit_tm), minute_text(check_tm))


def latest_order_time(end_date_text: str, lead_days, default_days: int) -> Column:
    """'yyyy-MM-dd HH:mm' of end day 23:59 minus the lead time in days (the
    difference floored to whole seconds); wall-clock arithmetic, independent of the session zone."""
    lead = F.coalesce(_col(lead_days).cast("double"), F.lit(float(default_days)))
    back = F.ceil(F.lit(86400) * lead).cast("bigint")
    end = F.lit(f"{end_date_text} 23:59:00").cast("timestamp_ntz")
    return F.date_format(F.timestamp_add("SECOND", -back, end), "yyyy-MM-dd HH:mm")
