"""DataFrame -> DataFrame operators."""

from tidewater.operators.aggregates import group_by, percent_of_total
from tidewater.operators.dedupe import drop_exact_duplicates, keep_first, keep_first_window
from tidewater.operators.joins import (even_buckets, hot_keys, join_back, left_join_salted,
                                       left_join_split_hot_keys, left_join_spread_null_keys, spread_evenly)
from tidewater.operators.keys import extend_key_map, with_keys
from tidewater.operators.quantiles import bucket_bounds, quantile_buckets
from tidewater.operators.ranking import global_ntile, global_row_number, ntile_from_rank

__all__ = ["group_by", "percent_of_total", "drop_exact_duplicates", "keep_first", "keep_first_window",
           "left_join_spread_null_keys", "left_join_split_hot_keys", "hot_keys", "join_back", "spread_evenly",
           "even_buckets", "left_join_salted", "extend_key_map", "with_keys", "global_ntile", "global_row_number",
           "ntile_from_rank", "bucket_bounds", "quantile_buckets"]
