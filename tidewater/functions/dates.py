"""Date and timestamp parsing / arithmetic as Column functions.

All parsed timestamps are zone-less (``timestamp_ntz``), like the source's
DATETIME. Parsing goes through ``try_cast`` (null on bad input, H14/H16) or
``cast`` (error on bad input under ANSI mode, H12).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._col import as_col

# A time of day as the source's conversions accept it (fractions
# of a second optional), and dates with one- or two-digit parts and any of the
# usual separators, day first ("style 105") or year first (the default).
_TIME = r"(?:[ T]+(\d{1,2}:\d{1,2})(?::(\d{1,2}(?:\.\d{1,6})?)\d*)?)?"
DAY_FIRST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _TIME + "$"
YEAR_FIRST = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TIME + "$"
#: Day first in the layout of most deliveries: two-digit parts, to the minute or without a time.
PLAIN_DAY_FIRST = r"^\d{2}[-/.]\d{2}[-/.]\d{4}(?: \d{2}:\d{2})?\z"


def _arranged(c: Column, shape: str, date: str) -> Column:
    """Text of the given shape as year-month-day and time, null for other text."""
    iso = F.regexp_replace(c, shape, f"{date} $4:$5")
    return F.when(c.rlike(shape), F.regexp_replace(iso, "[ :]+$", ""))


def _try_parse(c: Column, shape: str, date: str) -> Column:
    """Rearrange text of the given shape to year-month-day and cast it. The
    cast gives null for an impossible date (31-02) without raising an exception
    per row, as a failing format parse would; text of another shape is null."""
    return _arranged(c, shape, date).try_cast("timestamp_ntz")


def _try_day_first(c: Column) -> Column:
    """``_try_parse`` of day-first text. In the plain layout the parts are cut by place.
    Cast once: with five such columns the generated method must stay below 8000 bytes,
    beyond which the JVM doesn't compile it."""
    plain = F.concat(F.substring(c, 7, 4), F.lit("-"), F.substring(c, 4, 2), F.lit("-"),
                     F.left(c, F.lit(2)), F.substring(c, 11, 6))
    return (F.when(c.rlike(PLAIN_DAY_FIRST), plain).otherwise(_arranged(c, DAY_FIRST, "$3-$2-$1"))
            .try_cast("timestamp_ntz"))


# Month names, the time of day with an optional half, and the other
# styles that the source's conversions take. Groups: see ``_OTHER_STYLES``.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
_MONTH = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"
_CLOCK = r"(?:[ T]+(\d{1,2})(?::(\d{2})(?::(\d{2}(?:[.:]\d{1,6})?))?)?\d* *([ap]m)?)?"
#: (pattern, place of year, month and day among its groups); a time of day follows.
_OTHER_STYLES = (
    (r"^(\d{4})(\d{2})(\d{2})" + _CLOCK + "$", (1, 2, 3)),                      # 20170102
    (r"(?i)^" + _MONTH + r"\.? +(\d{1,2}),? +(\d{4}|\d{2})" + _CLOCK + "$", (3, 1, 2)),
    (r"(?i)^(\d{1,2})[ -]" + _MONTH + r"[ -](\d{4}|\d{2})" + _CLOCK + "$", (3, 2, 1)),
)
_YEAR_FIRST_HALF = (r"(?i)^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _CLOCK + "$", (1, 2, 3))
_DAY_FIRST_ANY = (r"(?i)^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + _CLOCK + "$", (3, 2, 1))
#: Two-digit years up to this one are of 2000, later ones of 1900.
TWO_DIGIT_CUTOFF = 49


def _styled(c: Column, pattern: str, places: tuple[int, int, int]) -> Column:
    """Text of one style as year-month-day and 24-hour time, cast once; null where the
    text is of another style or not a time."""
    def group(k: int) -> Column:
        return F.regexp_extract(c, pattern, k)

    year, month, day = (group(k) for k in places)
    year = F.when(F.length(year) == 2, F.concat(
        F.when(year.cast("int") <= TWO_DIGIT_CUTOFF, "20").otherwise("19"), year)).otherwise(year)
    # a month's first three letters stand at 3 * month - 2
    name = F.instr(F.lit("".join(m[:3] for m in MONTHS)), F.lower(F.left(month, F.lit(3))))
    month = F.when(month.rlike("^[A-Za-z]"), ((name + 2) / 3).cast("int").cast("string")).otherwise(month)
    hour, minute, second, half = (group(k) for k in range(4, 8))
    h = F.coalesce(hour.try_cast("int"), F.lit(0))
    plain = F.when(h < 24, h)
    h = (F.when(F.lower(half) == "pm", F.when(h.between(1, 12), h % 12 + 12))
         .when(F.lower(half) == "am", F.when(h.between(1, 12), h % 12)).otherwise(plain))
    bare = (hour != "") & (minute == "") & (half == "")      # '5' alone is no time of day
    text = F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), F.lit(" "),
                    F.lpad(h.cast("string"), 2, "0"), F.lit(":"),
                    F.when(minute == "", "00").otherwise(minute), F.lit(":"),
                    F.when(second == "", "00").otherwise(F.regexp_replace(second, ":", ".")))
    return F.when(c.rlike(pattern) & ~bare, text.try_cast("timestamp_ntz"))


def _any_style(c: Column, first: Column, *more: tuple[str, tuple[int, int, int]]) -> Column:
    """The common layout, and where that gives nothing the other styles."""
    return F.coalesce(first, *[_styled(c, *style) for style in (*more, *_OTHER_STYLES)])


def try_parse_any_day_first(c) -> Column:
    """``try_parse_day_first`` that also takes two-digit years, AM/PM, month names and
    compact text, as the source's conversion does (H14)."""
    c = F.trim(as_col(c))
    return _any_style(c, _try_parse(c, DAY_FIRST, "$3-$2-$1"), _DAY_FIRST_ANY)


def try_parse_any_timestamp(c) -> Column:
    """``try_parse_timestamp`` that also takes AM/PM, month names and compact text."""
    c = F.trim(as_col(c))
    return _any_style(c, _try_parse(c, YEAR_FIRST, "$1-$2-$3"), _YEAR_FIRST_HALF)


def try_parse_day_first(c) -> Column:
    """``TRY_CONVERT(DATETIME, s, 105)``: day-first text to timestamp, null when
    the text is not a valid date (H14). Columns that mix styles:
    ``try_parse_any_day_first``."""
    return _try_day_first(F.trim(as_col(c)))


def try_parse_day_first_date(c) -> Column:
    """``TRY_CONVERT(DATE, LEFT(s, 10), 105)``."""
    return _try_day_first(F.trim(F.left(as_col(c), F.lit(10)))).cast("date")


def try_parse_timestamp(c) -> Column:
    """``TRY_CONVERT(DATETIME, s)`` with the default layout."""
    return _try_parse(F.trim(as_col(c)), YEAR_FIRST, "$1-$2-$3")


def try_parse_date(c) -> Column:
    """``TRY_CONVERT(DATE, s)``."""
    return try_parse_timestamp(c).cast("date")


def strict_timestamp(c) -> Column:
    """``CAST(s AS DATETIME)``: fails the job on text that is not a timestamp
    under ANSI mode (H12)."""
    return as_col(c).cast("timestamp_ntz")


def strict_date(c) -> Column:
    """``CAST(s AS DATE)``."""
    return as_col(c).cast("date")


def day_diff(start, end) -> Column:
    """``DATEDIFF(DAY, start, end)``: midnights crossed from start to end.
    Note the argument order: start first, as in the source; Spark's own
    ``datediff`` takes (end, start)."""
    return F.datediff(as_col(end), as_col(start))
