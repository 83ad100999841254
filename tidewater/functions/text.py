"""Text cleaning as Column -> Column functions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._col import as_col


def sentence_case(c) -> Column:
    """First character upper, the rest lower (H21). Not ``initcap``: only the
    first letter of the whole value is raised. Null stays null."""
    c = as_col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def sentence_case_spaced(c) -> Column:
    """Sentence case with underscores turned into spaces."""
    return F.replace(sentence_case(c), F.lit("_"), F.lit(" "))


def strip_quotes(c) -> Column:
    """Remove every double quote (H7), no trimming."""
    return F.replace(as_col(c), F.lit('"'), F.lit(""))


def strip_quotes_trim(c) -> Column:
    """Remove double quotes, then trim blanks at both ends."""
    return F.trim(strip_quotes(c))


def trim_or_na(c, default: str = "n/a") -> Column:
    """Trim, and replace null by a default label (H8 + H10)."""
    return F.coalesce(F.trim(as_col(c)), F.lit(default))


def has_outer_whitespace(c) -> Column:
    """True when trimming changes the value (M5). Catches leading and trailing
    blanks alike (the reference's LEN() only sees leading ones, ledger L3)."""
    c = as_col(c)
    return F.length(c) != F.length(F.trim(c))


def has_quote(c) -> Column:
    """True when the value contains a double quote."""
    return as_col(c).contains('"')


def prefixed_key(prefix: str, c, width: int | None = None) -> Column:
    """``prefix + CAST(c AS VARCHAR)``: text key of the whole value, null when
    the value is null (H9, H13, L7). ``width`` cuts the value to that many
    characters, as a cast of the source's default length (30) does; two long
    values can then share a key, so it is an option for parity only."""
    value = as_col(c).cast("string")
    return F.concat(F.lit(prefix), value if width is None else F.substring(value, 1, width))
