"""Date and timestamp parsing and range rules.

ANSI mode makes ``to_date``/``to_timestamp`` raise on a non-matching
pattern, so every cascade uses the ``try_`` variants: a miss is NULL and
the next format is tried.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: shape guards and formats,
# in the order the reference tries them.
_YMD = r"^\d{4}-\d{2}-\d{2}$"
_DMY_SLASH = r"^\d{2}/\d{2}/\d{4}$"
_MDY_DASH = r"^\d{2}-\d{2}-\d{4}$"
_YMD_SLASH_PREFIX = r"^\d{4}/\d{2}/\d{2}"
_YMD_HMS = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_DMY_SLASH_HMS = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}$"
_MDY_DASH_HMS = r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$"
_YMD_SLASH_HMS = r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$"

# Customer registration date: (guard, format, take the first 10 chars).
DATE_FORMATS = (
    (_YMD, "yyyy-MM-dd", False),
    (_DMY_SLASH, "dd/MM/yyyy", False),
    (_MDY_DASH, "MM-dd-yyyy", False),
    (_MDY_DASH, "dd-MM-yyyy", False),
    (_YMD_SLASH_PREFIX, "yyyy/MM/dd", True),
    (_YMD_HMS, "yyyy-MM-dd", True),
    (_DMY_SLASH_HMS, "dd/MM/yyyy", True),
    (_DMY_SLASH, "MM/dd/yyyy", False),
)

# Return timestamp: (guard, format).
TS_FORMATS = (
    (_YMD_HMS, "yyyy-MM-dd HH:mm:ss"),
    (_DMY_SLASH_HMS, "dd/MM/yyyy HH:mm:ss"),
    (_MDY_DASH_HMS, "MM-dd-yyyy HH:mm:ss"),
    (_YMD_SLASH_HMS, "yyyy/MM/dd HH:mm:ss"),
    (_YMD, "yyyy-MM-dd"),
    (_DMY_SLASH, "dd/MM/yyyy"),
    (_DMY_SLASH, "MM/dd/yyyy"),
    (_MDY_DASH, "MM-dd-yyyy"),
    (_MDY_DASH, "dd-MM-yyyy"),
)

# Sales timestamps: three formats, no shape guard in the reference.
TS_THREE_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss")

# A failed parse costs a thrown exception (several microseconds); a regex
# test costs a fraction of that. These shapes are necessary conditions for
# the formats above (two-digit fields are fixed width, the year has at
# least four digits), so testing them first never changes a result - it
# only skips parses that would fail.
_SHAPE_GUARDS = {
    "yyyy/MM/dd HH:mm:ss": r"^[+-]?\d{4,}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^[+-]?\d{4,}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "dd/MM/yyyy HH:mm:ss": r"^\d{2}/\d{2}/[+-]?\d{4,} \d{2}:\d{2}:\d{2}$",
}

# The three formats with a year of four digits, and nothing after them: no trailing
# line break, which a cast would drop and the formats refuse.
_USUAL_SHAPE = r"^(?:\d{4}(?:-\d{2}-|/\d{2}/)\d{2}|\d{2}/\d{2}/\d{4}) \d{2}:\d{2}:\d{2}\z"

DATE_LOWER = "1900-01-01"
TS_LOWER = "2000-01-01"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date_multi(col: Column | str) -> Column:
    """First matching date format after trim, else NULL."""
    t = F.trim(_c(col))
    branches = []
    for guard, fmt, prefix in DATE_FORMATS:
        src = F.substring(t, 1, 10) if prefix else t
        branches.append(F.when(t.rlike(guard), F.try_to_date(src, fmt)))
    return F.coalesce(*branches, F.lit(None).cast("date"))


def parse_ts_multi(col: Column | str) -> Column:
    """First matching timestamp format after trim, else NULL."""
    t = F.trim(_c(col))
    branches = [F.when(t.rlike(guard), F.try_to_timestamp(t, F.lit(fmt))) for guard, fmt in TS_FORMATS]
    return F.coalesce(*branches, F.lit(None).cast("timestamp"))


def parse_ts_three(col: Column | str) -> Column:
    """D3: three full date-time formats; date-only text is NULL.

    A text of the usual 19 characters can match only the format of its shape; it is put in
    ISO order and cast, which costs a fraction of a format's parser. Other texts (longer
    or signed years) go through the formats."""
    t = F.trim(_c(col))
    iso = (F.when(F.substring(t, 3, 1) == "/", F.concat(F.substring(t, 7, 4), F.lit("-"), F.substring(t, 4, 2), F.lit("-"),
                                                        F.substring(t, 1, 2), F.substring(t, 11, 9)))
            .when(F.substring(t, 5, 1) == "/", F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 6, 2), F.lit("-"),
                                                        F.substring(t, 9, 11)))
            .otherwise(t))
    formats = F.coalesce(*[F.when(t.rlike(_SHAPE_GUARDS[fmt]), F.try_to_timestamp(t, F.lit(fmt)))
                           for fmt in TS_THREE_FORMATS],
                         F.lit(None).cast("timestamp"))
    return F.when(t.rlike(_USUAL_SHAPE), iso.try_cast("timestamp")).otherwise(formats)


def as_of_timestamp(as_of) -> Column:
    """The load instant: ``current_timestamp()`` or a fixed value."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(as_of)).cast("timestamp")


def as_of_date(as_of) -> Column:
    """Today: ``current_date()`` or the date of a fixed as_of."""
    if as_of is None:
        return F.current_date()
    return F.to_date(as_of_timestamp(as_of))


def null_outside_date(col: Column | str, as_of=None, lower: str = DATE_LOWER) -> Column:
    """A date outside [lower, today] becomes NULL."""
    c = _c(col)
    return F.when((c >= F.lit(lower).cast("date")) & (c <= as_of_date(as_of)), c)


def null_outside_ts(col: Column | str, as_of=None, lower: str = TS_LOWER,
                    upper: str = "instant") -> Column:
    """A timestamp outside [lower, upper] becomes NULL.

    ``upper="instant"`` bounds by the load instant (sales);
    ``upper="date"`` bounds by today at 00:00 (returns).
    """
    c = _c(col)
    if upper == "instant":
        hi = as_of_timestamp(as_of)
    elif upper == "date":
        hi = as_of_date(as_of).cast("timestamp")
    else:
        raise ValueError(f"upper must be 'instant' or 'date', got {upper!r}")
    return F.when((c >= F.lit(lower).cast("timestamp")) & (c <= hi), c)


def month_key(col: Column | str) -> Column:
    """``yyyy-MM`` month key, NULL when the input is NULL. Years of four digits are put
    together from the date's parts, which costs a fraction of a formatter."""
    c = _c(col)
    parts = F.concat(F.year(c).cast("string"), F.when(F.month(c) < 10, "-0").otherwise("-"), F.month(c).cast("string"))
    return F.when(F.year(c).between(1000, 9999), parts).otherwise(F.date_format(c, "yyyy-MM"))


def calendar_columns(col: Column | str) -> dict[str, Column]:
    """Calendar parts of a date (Sunday = 1, English names)."""
    d = _c(col)
    return {
        "anio": F.year(d),
        "mes": F.month(d),
        "dia": F.dayofmonth(d),
        "anio_mes": F.date_format(d, "yyyy-MM"),
        "nombre_mes": F.date_format(d, "MMMM"),
        "dia_semana": F.dayofweek(d),
        "nombre_dia": F.date_format(d, "EEEE"),
        "trimestre": F.quarter(d),
    }
