"""Column → Column scalar functions.

All are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F-1: zero-pad to 5 characters; lpad also truncates longer input.
def zip5(c: ColumnOrName) -> Column:
    return F.lpad(_c(c).cast("string"), 5, "0")


# F-2: date surrogate key yyyyMMdd (string).
def date_key(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyyMMdd")


# F-3: load stamp "yyyy-MM-dd hh:mm:ss AM/PM".  Not deterministic: never
# part of a value comparison.
def load_stamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd hh:mm:ss a")


# F-5
def month_name(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "MMMM")


def day_name(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "EEEE")


# F-6: Saturday/Sunday → 0, other days → 1.
def is_weekday(c: ColumnOrName) -> Column:
    return F.when(F.dayofweek(_c(c)).isin(1, 7), F.lit(0)).otherwise(F.lit(1))


# F-7: Monday = 0 … Sunday = 6.
def dow(c: ColumnOrName) -> Column:
    return F.weekday(_c(c))


# F-8: lenient timestamp parse ('' or garbage → NULL), wall-clock result.
# The default layout is parsed field by field into a TIMESTAMP_NTZ, so the
# result never depends on the session time zone (no DST gaps/overlaps).
def safe_ts(c: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    c = _c(c)
    if fmt == "yyyy-MM-dd HH:mm:ss":
        ok = c.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
        parts = [F.substring(c, a, n).try_cast("int") for a, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2))]
        secs = F.substring(c, 18, 2).try_cast("decimal(16,6)")
        return F.when(ok, F.try_make_timestamp_ntz(*parts, secs))
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


# F-11: month start of a timestamp/date, and its yyyy-MM text form.
def month_of(c: ColumnOrName) -> Column:
    return F.trunc(F.to_date(_c(c)), "month")


def year_month(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


# F-12: minutes between two wall-clock timestamps as DOUBLE: whole days
# between the dates plus the difference of the times of day, so no session
# time zone (and no DST shift) enters the result.
def _minute_of_day(c: Column) -> Column:
    return F.hour(c) * 60 + F.minute(c) + F.extract(F.lit("SECOND"), c).cast("double") / 60.0


def minutes_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    e, s = _c(end).cast("timestamp_ntz"), _c(start).cast("timestamp_ntz")
    return (F.datediff(F.to_date(e), F.to_date(s)) * 1440).cast("double") + (_minute_of_day(e) - _minute_of_day(s))


# F-13
def shift_days(c: ColumnOrName, n: int | Column) -> Column:
    return F.date_add(F.to_date(_c(c)), n if isinstance(n, Column) else F.lit(n))


def shift_years(c: ColumnOrName, n: int = 1) -> Column:
    return F.add_months(F.to_date(_c(c)), 12 * n)


# F-14: inclusive number of days between two dates.
def days_inclusive(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))) + 1


# Rounding of non-exact doubles: a tiny nudge makes both engines land on
# the same side of a half.
def round_nudged(c: ColumnOrName, digits: int) -> Column:
    return F.round(_c(c) + F.lit(1e-9), digits)


# Money: exact decimal inside, double at the edge.
def money(c: ColumnOrName) -> Column:
    return _c(c).cast("decimal(18,2)")


def money_out(c: ColumnOrName) -> Column:
    return F.round(_c(c), 2).cast("double")


# F-18: payment status, five exclusive rules, NULL default.  ``balance`` is
# items-with-freight minus payments, computed by the caller on decimals.
def payment_status(paid: ColumnOrName, amt: ColumnOrName, balance: ColumnOrName,
                   status: ColumnOrName) -> Column:
    paid, amt, balance, status = _c(paid), _c(amt), _c(balance), _c(status)
    both = (paid > 0) & (amt > 0)
    unpaid = paid.isNull() | (paid <= 0)
    return (
        F.when(both & (balance <= 0), "completed")
        .when(both & (balance > 0), "in progress")
        .when((paid > 0) & amt.isNull(), "order items not found")
        .when(status.isin("delivered", "shipped") & unpaid, "payments not found")
        .when(status.isin("canceled", "unavailable") & unpaid, "canceled")
    )


# F-19: 1 when the value is in the list, else 0.
def flag_in(c: ColumnOrName, values: Iterable) -> Column:
    return F.when(_c(c).isin(*list(values)), F.lit(1)).otherwise(F.lit(0))


# F-20: died = 0 for NULL or the sentinel, else 1 (NULL counts as alive).
def died_flag(c: ColumnOrName, sentinel: str = "9999-99-99") -> Column:
    c = _c(c)
    return F.when(c.isNull() | (c == sentinel), F.lit(0)).otherwise(F.lit(1))


# F-21: dictionary recode of one column; unmapped values are kept,
# values mapped to None become NULL.
def recode(c: ColumnOrName, mapping: Mapping) -> Column:
    c = _c(c)
    expr = None
    for src, dst in mapping.items():
        val = F.lit(dst)
        expr = F.when(c == src, val) if expr is None else expr.when(c == src, val)
    return c if expr is None else expr.otherwise(c)


# F-23: concatenate with NULL as '' and map an empty result to a label.
def joined_names(cols: Iterable[ColumnOrName], none: str = "None", sep: str = "") -> Column:
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    joined = F.concat_ws(sep, *parts)
    return F.when(joined == "", F.lit(none)).otherwise(joined)


# F-25: flag AND (any of the event columns is in a small eligible list).
def interaction_flag(flag: ColumnOrName, events: Iterable[ColumnOrName], eligible: Iterable[str]) -> Column:
    eligible = list(eligible)
    hit = None
    for e in events:
        h = F.coalesce(_c(e).isin(*eligible), F.lit(False))
        hit = h if hit is None else (hit | h)
    return F.when((_c(flag) == 1) & hit, F.lit(1)).otherwise(F.lit(0))


# P-11: case-insensitive substring test, NULL counts as no match.
def contains_ci(c: ColumnOrName, s: str) -> Column:
    return F.coalesce(F.lower(_c(c)).contains(s.lower()), F.lit(False))


# A-20 row-wise reductions.
def row_any_not_null(cols: Iterable[ColumnOrName]) -> Column:
    return F.coalesce(*[_c(c) for c in cols]).isNotNull()


def row_all_null(cols: Iterable[ColumnOrName]) -> Column:
    return F.coalesce(*[_c(c) for c in cols]).isNull()


def row_max(cols: Iterable[ColumnOrName]) -> Column:
    return F.greatest(*[_c(c) for c in cols])
