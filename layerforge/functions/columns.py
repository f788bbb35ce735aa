"""Column helpers (scalar expressions).

Every helper returns a ``Column`` built from Catalyst built-ins, so it stays
inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace trim of the warehouse: strips every leading/trailing whitespace
# character of Unicode (tab, newline, no-break and ideographic space, ...), not
# only blanks as Spark's ``trim`` does.
_EDGE_WS = r"(?U)^\s+|\s+$"

# A time of day that is followed by a zone: Z, UTC or an offset.
_ZONED = r"(?i):\d{2}(\.\d+)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)\s*$"

# Target types of the strict casts. Warehouse TIMESTAMP values are absolute
# UTC instants; they are kept as zone-free UTC wall-clock values so results
# do not depend on the session zone.
TYPES = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
}


def ntz_lit(value) -> Column:
    """Zone-free timestamp literal. A Python ``datetime`` (as collected from
    a ``timestamp_ntz`` column) is passed as text, because ``lit(datetime)``
    is read in the session time zone and would shift by its offset."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (datetime, date)):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) \
            else value.strftime("%Y-%m-%d")
        return F.lit(text).cast(T.TimestampNTZType())
    return F.lit(value).cast(T.TimestampNTZType())


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_col(c), _EDGE_WS, "")


def norm_lower(c: str | Column) -> Column:
    """Lower-case after a whitespace trim."""
    return F.lower(trim_ws(c))


def norm_upper(c: str | Column) -> Column:
    """Upper-case after a whitespace trim."""
    return F.upper(trim_ws(c))


def blank_to_null(c: str | Column) -> Column:
    """Trim, then an empty string becomes NULL."""
    return F.nullif(trim_ws(c), F.lit(""))


def to_type(name: str | T.DataType) -> T.DataType:
    return TYPES[name] if isinstance(name, str) else name


def cast_strict(c: str | Column, type_name: str | T.DataType) -> Column:
    """Strict cast; under ANSI mode a malformed value fails the job."""
    return _col(c).cast(to_type(type_name))


def cast_timestamp(df: DataFrame, c: str) -> Column:
    """P4 for timestamps: an absolute instant as UTC wall-clock time. Text with
    a zone is converted, text without one is UTC already. A column that is
    typed already is cast plainly, so filters on it still reach the scan."""
    plain = F.col(c).cast(T.TimestampNTZType())
    if not isinstance(df.schema[c].dataType, T.StringType):
        return plain
    micros = F.unix_micros(F.col(c).cast(T.TimestampType())).cast("decimal(20,0)")
    seconds = (micros / 1_000_000).cast("decimal(18,6)")
    utc = ntz_lit("1970-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.when(F.col(c).rlike(_ZONED), utc).otherwise(plain)


def cast_or_zero(c: str | Column, type_name: str | T.DataType) -> Column:
    """P5: strict cast with NULL replaced by zero of the target type."""
    t = to_type(type_name)
    zero = F.lit(0.0) if isinstance(t, (T.DoubleType, T.FloatType)) else F.lit(0)
    return F.coalesce(_col(c).cast(t), zero.cast(t))


def days_between_dates(end: str | Column, start: str | Column) -> Column:
    """Whole calendar days from ``start`` to ``end``; NULL when ``end`` is
    NULL. Dates, not 24-hour periods: 23:59 to 00:01 next day is one day."""
    end_c, start_c = _col(end), _col(start)
    return F.when(
        end_c.isNotNull(), F.datediff(F.to_date(end_c), F.to_date(start_c))
    ).cast(T.LongType())


def on_time(delivered: str | Column, estimated: str | Column) -> Column:
    """Three-valued on-time flag; NULL when either side is unknown."""
    d, e = _col(delivered), _col(estimated)
    return F.when(d.isNotNull() & e.isNotNull(), d <= e)


def sum_of(*cols: str | Column) -> Column:
    """Plain sum (callers default NULLs beforehand)."""
    out = _col(cols[0])
    for c in cols[1:]:
        out = out + _col(c)
    return out


def product_if_all(*cols: str | Column) -> Column:
    """P10: product of the columns, NULL as soon as one is NULL."""
    cond = None
    out = None
    for c in cols:
        cc = _col(c)
        cond = cc.isNotNull() if cond is None else cond & cc.isNotNull()
        out = cc if out is None else out * cc
    return F.when(cond, out)


def default_unknown(c: str | Column, value: str = "unknown") -> Column:
    """Lookup miss replaced by a fixed label."""
    return F.coalesce(_col(c), F.lit(value))


def in_range(c: str | Column, lo, hi) -> Column:
    """Inclusive range test; NULL is neither in nor out."""
    return _col(c).between(F.lit(lo), F.lit(hi))


def not_in_domain(c: str | Column, values: Iterable) -> Column:
    """Value outside a fixed catalog. NULL stays NULL (unknown), so a
    ``count_if`` over it does not count NULL values as violations."""
    return ~_col(c).isin(list(values))


def changed(target: str | Column, source: str | Column, null_safe: bool = False) -> Column:
    """P20: change test of an upsert. Default is the warehouse ``!=``, where a
    NULL on either side means "not changed"."""
    t, s = _col(target), _col(source)
    return ~t.eqNullSafe(s) if null_safe else (t != s)


def before(later: str | Column, earlier: str | Column) -> Column:
    """Row-level order violation: ``later`` present and < ``earlier``."""
    l_, e_ = _col(later), _col(earlier)
    return l_.isNotNull() & (l_ < e_)
