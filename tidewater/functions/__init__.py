"""Column -> Column helpers. No Python UDFs: everything stays in codegen."""

from tidewater.functions.collation import (SOURCE_COLLATION, can_fold, collate, collated_columns, folded,
                                           is_collated, is_plain, spelling)
from tidewater.functions.dates import (day_diff, strict_date, strict_timestamp,
                                       try_parse_date, try_parse_day_first,
                                       try_parse_day_first_date, try_parse_timestamp)
from tidewater.functions.numeric import exact_avg, int_avg, pct, round_avg
from tidewater.functions.text import (has_outer_whitespace, has_quote, prefixed_key,
                                      sentence_case, sentence_case_spaced, strip_quotes,
                                      strip_quotes_trim, trim_or_na)

__all__ = [
    "SOURCE_COLLATION", "can_fold", "collate", "collated_columns", "folded", "is_collated", "is_plain", "spelling",
    "day_diff", "strict_date", "strict_timestamp", "try_parse_date", "try_parse_day_first",
    "try_parse_day_first_date", "try_parse_timestamp", "exact_avg", "int_avg", "pct", "round_avg",
    "has_outer_whitespace", "has_quote", "prefixed_key", "sentence_case",
    "sentence_case_spaced", "strip_quotes", "strip_quotes_trim", "trim_or_na",
]
