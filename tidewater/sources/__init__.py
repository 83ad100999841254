"""Sources, sinks and the load audit."""

from tidewater.sources.audit import LoadAudit
from tidewater.sources.files import (parse_geolocation_lines, parse_seller_lines, read_delimited,
                                     read_quoted_csv, read_raw_lines, write_delimited, write_lines)
from tidewater.sources.snapshots import Buckets, SnapshotTable, read_table

__all__ = ["LoadAudit", "Buckets", "SnapshotTable", "read_table", "parse_geolocation_lines", "parse_seller_lines", "read_delimited",
           "read_quoted_csv", "read_raw_lines", "write_delimited", "write_lines"]
