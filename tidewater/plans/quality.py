"""Declarative data-quality suite.

A check is data: (id, layer, table, kind, columns, argument, expect_zero).
``violations`` returns the offending rows of one check. ``run_suite`` reports
one row per check with its violation count and a pass flag; it scans each
table once for all row-level checks of that table (one aggregate with a
``count_if`` per check), and runs one grouped aggregate per duplicate /
profile / domain check. Nothing is collected to the driver.

Pass rule (M12): a check that guards a resolved issue passes with zero
violations; profiles of legitimate one-to-many relations, value domains,
drill-downs and cleaned-value listings are informational (never fail).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import (has_outer_whitespace, has_quote, strip_quotes_trim,
                                 try_parse_date, try_parse_day_first, try_parse_day_first_date,
                                 try_parse_timestamp)
from tidewater.operators import drop_exact_duplicates, group_by, join_back, spread_evenly
from tidewater.session import staging_path

ROW_KINDS = ("null", "whitespace", "quote", "quote_or_whitespace", "bad_date", "negative",
             "lookup", "cleaned")
GROUP_KINDS = ("duplicate", "duplicate_or_null", "profile", "domain")


@dataclass(frozen=True)
class Check:
    check_id: str
    layer: str
    table: str
    kind: str
    columns: tuple
    arg: str | None = None
    expect_zero: bool = True


def _c(check_id, layer, table, kind, cols, arg=None, expect_zero=None):
    informational = kind in ("profile", "domain", "lookup", "cleaned")
    return Check(check_id, layer, table, kind, tuple(cols.split()), arg,
                 (not informational) if expect_zero is None else expect_zero)


_CUST = "customer_id customer_unique_id customer_zip_code customer_city customer_state"
_REVIEW_ALL = ("review_id order_id review_score review_title review_message "
               "review_creation_date review_answer_date")
_PROD_MEASURES = ("product_name_length product_description_length product_photos_qty "
                  "product_weight_g product_length_cm product_height_cm product_width_cm")
_GEO_ALL = ("geolocation_zip_code_prefix geolocation_lat geolocation_lng geolocation_city "
            "geolocation_state")
_ITEM_KEY = "order_id product_id seller_id shipping_limit_date price freight_value"
_ORDER_TS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date")

B, S = "bronze", "silver"

# The reference's 77 checks: 58 on bronze, 19 on silver, in script order.
# Drill-down literals are keys of the derived test data.
CHECKS: tuple[Check, ...] = (
    _c("b01", B, "crm_cust_info", "duplicate", "customer_id"),
    *[_c(f"b{2 + i:02d}", B, "crm_cust_info", "null", col) for i, col in enumerate(_CUST.split())],
    *[_c(f"b{7 + i:02d}", B, "crm_cust_info", "whitespace", col) for i, col in enumerate(_CUST.split())],
    _c("b12", B, "crm_cust_reviews", "duplicate", "review_id"),
    _c("b13", B, "crm_cust_reviews", "lookup", "review_id", "r7-2"),
    _c("b14", B, "crm_cust_reviews", "profile", "order_id"),
    _c("b15", B, "crm_cust_reviews", "lookup", "order_id", "7"),
    _c("b16", B, "crm_cust_reviews", "duplicate", _REVIEW_ALL),
    *[_c(f"b{17 + i:02d}", B, "crm_cust_reviews", "whitespace", col)
      for i, col in enumerate("review_id order_id review_title review_message".split())],
    _c("b21", B, "crm_cust_reviews", "bad_date", "review_creation_date", "date"),
    _c("b22", B, "crm_cust_reviews", "bad_date", "review_answer_date", "timestamp"),
    _c("b23", B, "finance_ord_payments", "profile", "order_id"),
    _c("b24", B, "finance_ord_payments", "lookup", "order_id", '"30'),
    _c("b25", B, "finance_ord_payments", "domain", "payment_type"),
    _c("b26", B, "finance_ord_payments", "whitespace", "payment_type"),
    _c("b27", B, "finance_ord_payments", "quote_or_whitespace", "order_id"),
    _c("b28", B, "finance_ord_payments", "cleaned", "order_id", "strip_quotes"),
    _c("b29", B, "prd_item_details", "duplicate_or_null", "product_id"),
    _c("b30", B, "prd_item_details", "domain", "product_category_name"),
    _c("b31", B, "prd_item_details", "null", "product_category_name"),
    _c("b32", B, "prd_item_details", "null", _PROD_MEASURES),
    _c("b33", B, "prd_item_details", "negative", _PROD_MEASURES),
    _c("b34", B, "prd_seller_details", "duplicate", "seller_id"),
    _c("b35", B, "prd_seller_details", "null", "seller_id"),
    _c("b36", B, "prd_seller_details", "quote", "seller_id"),
    *[_c(f"b{37 + i:02d}", B, "prd_seller_details", "whitespace", col)
      for i, col in enumerate("seller_zip_code_prefix seller_city seller_state".split())],
    _c("b40", B, "prd_translations", "null", "product_category_name"),
    _c("b41", B, "prd_translations", "null", "product_category_name_english"),
    _c("b42", B, "prd_translations", "whitespace",
       "product_category_name product_category_name_english"),
    _c("b43", B, "reference_geolocation", "duplicate", _GEO_ALL),
    _c("b44", B, "reference_geolocation", "lookup", "geolocation_zip_code_prefix", '"00005'),
    _c("b45", B, "reference_geolocation", "null", _GEO_ALL),
    _c("b46", B, "sales_ord_items", "duplicate", _ITEM_KEY),
    _c("b47", B, "sales_ord_items", "lookup", "order_id", '"7'),
    _c("b48", B, "sales_ord_items", "quote", "order_id product_id seller_id"),
    _c("b49", B, "sales_ord_items", "bad_date", "shipping_limit_date", "timestamp"),
    _c("b50", B, "sales_ord_details", "duplicate", "order_id"),
    _c("b51", B, "sales_ord_details", "null", "order_id"),
    _c("b52", B, "sales_ord_details", "domain", "order_status"),
    _c("b53", B, "sales_ord_details", "null", "customer_id"),
    *[_c(f"b{54 + i:02d}", B, "sales_ord_details", "bad_date", col, "day_first")
      for i, col in enumerate(_ORDER_TS)],
    _c("b58", B, "sales_ord_details", "cleaned", "order_estimated_delivery_date", "day_first_date"),
    _c("s01", S, "crm_cust_info", "duplicate", "customer_id"),
    _c("s02", S, "crm_cust_info", "null", "customer_id customer_unique_id"),
    _c("s03", S, "crm_cust_reviews", "duplicate", "order_id"),
    _c("s04", S, "crm_cust_reviews", "duplicate", "review_id order_id"),
    _c("s05", S, "crm_cust_reviews", "null", "review_title review_message"),
    _c("s06", S, "finance_ord_payments", "profile", "order_id"),
    _c("s07", S, "finance_ord_payments", "quote", "order_id"),
    _c("s08", S, "prd_item_details", "null", "product_id"),
    _c("s09", S, "prd_item_details", "null", _PROD_MEASURES),
    _c("s10", S, "prd_seller_details", "quote", "seller_id seller_zip_code_prefix"),
    _c("s11", S, "prd_seller_details", "duplicate", "seller_id"),
    _c("s12", S, "reference_geolocation", "duplicate", _GEO_ALL),
    _c("s13", S, "reference_geolocation", "quote", "geolocation_zip_code_prefix"),
    _c("s14", S, "sales_ord_items", "duplicate", _ITEM_KEY),
    _c("s15", S, "sales_ord_items", "quote", "order_id product_id seller_id"),
    _c("s16", S, "sales_ord_details", "duplicate", "order_id"),
    _c("s17", S, "sales_ord_details", "null", "order_id customer_id"),
    _c("s18", S, "sales_ord_details", "domain", "order_status"),
    _c("s19", S, "sales_ord_details", "bad_date", "order_estimated_delivery_date", "date"),
)

_PARSERS = {
    "date": try_parse_date,
    "timestamp": try_parse_timestamp,
    "day_first": try_parse_day_first,
    "day_first_date": try_parse_day_first_date,
}


def _any(conds) -> Column:
    return reduce(or_, conds)


def row_condition(check: Check) -> Column:
    """The predicate that marks an offending row, for row-level kinds."""
    cols = [F.col(c) for c in check.columns]
    k = check.kind
    if k == "null":
        return _any([c.isNull() for c in cols])
    if k == "whitespace":
        return _any([has_outer_whitespace(c) for c in cols])
    if k == "quote":
        return _any([has_quote(c) for c in cols])
    if k == "quote_or_whitespace":
        return _any([has_quote(c) | has_outer_whitespace(c) for c in cols])
    if k == "negative":
        return _any([c < 0 for c in cols])
    if k == "bad_date":
        parse = _PARSERS[check.arg]
        return _any([parse(c.cast("string")).isNull() & c.isNotNull() for c in cols])
    if k == "lookup":
        return cols[0] == F.lit(check.arg)
    if k == "cleaned":
        c = cols[0]
        if check.arg == "strip_quotes":   # rows the cleaning changes
            return strip_quotes_trim(c) != c
        return _PARSERS[check.arg](c).isNull() & c.isNotNull()   # rows that stay unparsed
    raise ValueError(k)


def violations(check: Check, df: DataFrame) -> DataFrame:
    """Offending rows of one check (for group kinds: the offending groups)."""
    cols = list(check.columns)
    if check.kind in ("duplicate", "duplicate_or_null", "profile"):
        g = group_by(df, cols, F.count(F.lit(1)).alias("occurrence_count"))
        cond = F.col("occurrence_count") > 1
        if check.kind == "duplicate_or_null":
            cond = cond | _any([F.col(c).isNull() for c in cols])
        return g.where(cond)
    if check.kind == "domain":
        return drop_exact_duplicates(df.select(*cols)).orderBy(*cols)
    if check.kind == "cleaned":
        c = F.col(cols[0])
        if check.arg == "strip_quotes":
            return df.select(strip_quotes_trim(c).alias(f"cleaned_{cols[0]}"))
        return df.where(c.isNotNull()).select(c, F.left(c, F.lit(10)).alias("date_part"),
                         _PARSERS[check.arg](c).alias("converted_date"))
    return df.where(row_condition(check))


def _stack(counts: DataFrame, chs: list[Check]) -> DataFrame:
    """One-row frame of per-check counts -> one (check_id, violations) row each."""
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(ch.check_id).alias("check_id"), F.col(ch.check_id).cast("long")
                 .alias("violations")) for ch in chs])).alias("r")).select("r.check_id", "r.violations")


def _group_condition(check: Check) -> Column:
    """On a (group, _tw_n) row: does this group violate the check?"""
    if check.kind == "domain":
        return F.lit(True)
    cond = F.col("_tw_n") > 1
    if check.kind == "duplicate_or_null":
        cond = cond | _any([F.col(c).isNull() for c in check.columns])
    return cond


def _group_pass(df: DataFrame, group: Check) -> DataFrame:
    """One grouped aggregate for a group-level check, reading its columns only."""
    groups = df.groupBy(*group.columns).agg(F.count(F.lit(1)).alias("_tw_n"))
    return _stack(groups.agg(F.count_if(_group_condition(group)).alias(group.check_id)), [group])


def _row_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-level checks of a table in one plain aggregate: one row per task
    is shuffled, however many distinct keys the table has."""
    return _stack(df.agg(*[F.count_if(row_condition(ch)).alias(ch.check_id) for ch in checks]),
                  checks)


def run_suite(wh, checks=CHECKS, layers=("bronze", "silver")) -> DataFrame:
    """One row per check: check_id, layer, table_name, kind, columns,
    violations, expect_zero, passed. Per table: one grouped aggregate per
    group-level check (duplicates, profiles, domains) and one plain aggregate
    for all row-level checks (nulls, blanks, quotes, dates, ranges, lookups)."""
    parts: list[DataFrame] = []
    by_table: dict[tuple, tuple[list, list]] = {}
    for ch in checks:
        if ch.layer in layers:
            rows, groups = by_table.setdefault((ch.layer, ch.table), ([], []))
            (rows if ch.kind in ROW_KINDS else groups).append(ch)
    for (layer, table), (row_chs, group_chs) in by_table.items():
        df = getattr(wh, layer)(table)
        parts += [_group_pass(df, g) for g in group_chs]
        if row_chs:
            parts.append(_row_pass(df, row_chs))
    counts = reduce(DataFrame.unionByName, parts)
    meta = wh.spark.createDataFrame(
        [(c.check_id, c.layer, c.table, c.kind, ",".join(c.columns), c.expect_zero)
         for c in checks if c.layer in layers],
        "check_id string, layer string, table_name string, kind string, columns string, "
        "expect_zero boolean")
    out = F.broadcast(meta).join(counts, "check_id")
    return out.select("check_id", "layer", "table_name", "kind", "columns",
                      F.col("violations").cast("long").alias("violations"), "expect_zero",
                      ((~F.col("expect_zero")) | (F.col("violations") == 0)).alias("passed"))


# --- offending rows of every check ------------------------------------------------

#: What names a row of each table.
ROW_KEYS = {
    "crm_cust_info": ("customer_id",),
    "crm_cust_reviews": ("review_id", "order_id"),
    "finance_ord_payments": ("order_id", "payment_sequential"),
    "prd_seller_details": ("seller_id",),
    "prd_item_details": ("product_id",),
    "prd_translations": ("product_category_name", "product_category_name_english"),
    "reference_geolocation": tuple(_GEO_ALL.split()),
    "sales_ord_items": ("order_id", "order_item_id"),
    "sales_ord_details": ("order_id",),
}


def row_key(table: str) -> Column:
    """The key columns as text, nulls as nothing."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ROW_KEYS[table]])


def quarantine_table(table: str, df: DataFrame, checks: list[Check]) -> DataFrame:
    """(row_key, check_id, copies): the rows of one table that a check marks, with how
    often they occur. Row checks mark rows by themselves. Duplicate and profile
    checks mark all rows of an offending group; domain checks, which know no list
    of allowed values, mark rows without a value.

    Equal rows are counted first, over the columns that the checks read, so a row
    that occurs a million times is one row from there on. All row checks are one
    array expression. The distinct rows are staged, as each group check goes over them:
    they are dealt by the group once, where no group is hot (``spread_evenly``); otherwise
    the offending groups are joined back to the rows, hot ones in pieces (``join_back``)."""
    groups = [c for c in checks if c.kind in GROUP_KINDS and c.kind != "domain"]
    read = dict.fromkeys([*ROW_KEYS[table], *[c for ch in checks for c in ch.columns]])
    rows = df.groupBy(*read).agg(F.count(F.lit(1)).alias("_tw_n"))
    joined = [c for c in groups if set(c.columns) != set(read)]
    if joined:
        path = staging_path(df.sparkSession, f"quarantine-{table}")
        rows.write.option("compression", "zstd").parquet(path)
        rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    distinct, parts = rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*read)
    for ch in groups:
        if ch not in joined:    # a group is one distinct row: its count says it all
            rows = rows.withColumn(f"_tw_{ch.check_id}", F.col("_tw_n") > 1)
            continue
        if spread_evenly(distinct.select(F.xxhash64(*ch.columns).alias("_tw_h")), "_tw_h", parts):
            many = F.sum("_tw_n").over(Window.partitionBy(*ch.columns)) > 1
            if ch.kind == "duplicate_or_null":
                many = many | _any([F.col(c).isNull() for c in ch.columns])
            rows = rows.withColumn(f"_tw_{ch.check_id}", many)
            continue
        own = (distinct.groupBy(*ch.columns)
               .agg(F.sum("_tw_n").alias("_tw_all"), F.count(F.lit(1)).alias("_tw_rows")))
        cond = F.col("_tw_all") > 1
        if ch.kind == "duplicate_or_null":
            cond = cond | _any([F.col(c).isNull() for c in ch.columns])
        own = own.where(cond).select(*ch.columns, "_tw_rows", F.lit(True).alias(f"_tw_{ch.check_id}"))
        rows = join_back(rows, own, list(ch.columns), "_tw_rows", spread)

    def marked(ch: Check) -> Column:
        if ch.kind == "domain":
            return _any([F.col(c).isNull() for c in ch.columns])
        return F.col(f"_tw_{ch.check_id}") if ch.kind in GROUP_KINDS else row_condition(ch)

    failed = F.array_compact(F.array(*[F.when(marked(c), F.lit(c.check_id)) for c in checks]))
    out = rows.select(row_key(table).alias("row_key"), "_tw_n", F.explode(failed).alias("check_id"))
    return out.groupBy("row_key", "check_id").agg(F.sum("_tw_n").alias("copies"))


def quarantine(wh, checks=CHECKS, layers=("bronze", "silver")) -> DataFrame:
    """(layer, table_name, check_id, guards, row_key, copies): every row that a check
    marks, for all checks. ``guards`` is false for informational checks (profiles,
    domains, lookups, cleaned values)."""
    by_table: dict[tuple, list] = {}
    for ch in checks:
        if ch.layer in layers:
            by_table.setdefault((ch.layer, ch.table), []).append(ch)
    informational = [c.check_id for c in checks if not c.expect_zero]
    parts = [quarantine_table(table, getattr(wh, layer)(table), chs)
             .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "check_id",
                     (~F.col("check_id").isin(informational)).alias("guards"), "row_key", "copies")
             for (layer, table), chs in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


def quarantine_sql(layers=("bronze", "silver"), checks=CHECKS) -> str:
    """The SQL twin of ``quarantine``, check by check."""
    parts = []
    for ch in checks:
        if ch.layer not in layers:
            continue
        t = ("b_" if ch.layer == "bronze" else "s_") + ch.table
        key = " || '|' || ".join(f"coalesce(cast({c} AS VARCHAR), '')" for c in ROW_KEYS[ch.table])
        cols, nulls = ", ".join(ch.columns), " OR ".join(f"{c} IS NULL" for c in ch.columns)
        if ch.kind == "domain":
            found = f"SELECT * FROM {t} WHERE {nulls}"
        elif ch.kind in GROUP_KINDS:
            also = f" OR {nulls}" if ch.kind == "duplicate_or_null" else ""
            found = f"SELECT * FROM {t} QUALIFY count(*) OVER (PARTITION BY {cols}) > 1{also}"
        else:
            found = f"SELECT * FROM {t} WHERE {_sql_row_condition(ch)}"
        parts.append(f"SELECT '{ch.layer}' AS layer, '{ch.table}' AS table_name, '{ch.check_id}' AS check_id, "
                     f"{str(ch.expect_zero).upper()} AS guards, {key} AS row_key, count(*) AS copies "
                     f"FROM ({found}) f GROUP BY row_key")
    return " UNION ALL ".join(parts)


# --- the same checks as SQL, for the oracle -----------------------------------------

def _sql_parse(arg: str, c: str) -> str:
    t = f"trim(cast({c} AS VARCHAR))"
    if arg in ("date", "timestamp"):
        return (f"coalesce(try_strptime({t}, '%Y-%m-%d %H:%M:%S'), try_strptime({t}, '%Y-%m-%d %H:%M'), "
                f"try_strptime({t}, '%Y-%m-%d'))")
    if arg == "day_first":
        return (f"coalesce(try_strptime({t}, '%d-%m-%Y %H:%M:%S'), try_strptime({t}, '%d-%m-%Y %H:%M'), "
                f"try_strptime({t}, '%d-%m-%Y'))")
    if arg == "day_first_date":
        return f"try_strptime(left({c}, 10), '%d-%m-%Y')"
    raise ValueError(arg)


def _sql_row_condition(ch: Check) -> str:
    cs, k = ch.columns, ch.kind
    ws = "length({c}) <> length(trim({c}))"
    if k == "null":
        parts = [f"{c} IS NULL" for c in cs]
    elif k == "whitespace":
        parts = [ws.format(c=c) for c in cs]
    elif k == "quote":
        parts = [f"{c} LIKE '%\"%'" for c in cs]
    elif k == "quote_or_whitespace":
        parts = [f"({c} LIKE '%\"%' OR {ws.format(c=c)})" for c in cs]
    elif k == "negative":
        parts = [f"{c} < 0" for c in cs]
    elif k == "bad_date":
        parts = [f"({_sql_parse(ch.arg, c)} IS NULL AND {c} IS NOT NULL)" for c in cs]
    elif k == "lookup":
        lit = ch.arg.replace("'", "''")
        parts = [f"{cs[0]} = '{lit}'"]
    elif k == "cleaned":
        c = cs[0]
        parts = ([f"trim(replace({c}, '\"', '')) <> {c}"] if ch.arg == "strip_quotes"
                 else [f"({_sql_parse(ch.arg, c)} IS NULL AND {c} IS NOT NULL)"])
    else:
        raise ValueError(k)
    return " OR ".join(parts)


def check_sql(ch: Check) -> str:
    """SELECT of one check's violation count (DuckDB dialect)."""
    t = ("b_" if ch.layer == "bronze" else "s_") + ch.table
    cols = ", ".join(ch.columns)
    if ch.kind in ("duplicate", "profile"):
        body = f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1) x"
    elif ch.kind == "duplicate_or_null":
        nulls = " OR ".join(f"{c} IS NULL" for c in ch.columns)
        body = (f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} "
                f"HAVING count(*) > 1 OR {nulls}) x")
    elif ch.kind == "domain":
        body = f"SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {t}) x"
    else:
        body = f"SELECT count(*) FROM {t} WHERE {_sql_row_condition(ch)}"
    return (f"SELECT '{ch.check_id}' AS check_id, '{ch.layer}' AS layer, '{ch.table}' AS table_name, "
            f"'{ch.kind}' AS kind, '{','.join(ch.columns)}' AS columns, "
            f"cast(({body}) AS BIGINT) AS violations, {str(ch.expect_zero).upper()} AS expect_zero")


def suite_sql(layers=("bronze", "silver"), checks=CHECKS) -> str:
    rows = " UNION ALL ".join(check_sql(c) for c in checks if c.layer in layers)
    return f"SELECT *, (NOT expect_zero OR violations = 0) AS passed FROM ({rows}) suite"


def violations_sql(ch: Check) -> str:
    """SELECT of one check's offending rows (DuckDB dialect), the SQL twin of
    ``violations``."""
    t = ("b_" if ch.layer == "bronze" else "s_") + ch.table
    cols = ", ".join(ch.columns)
    if ch.kind in ("duplicate", "profile", "duplicate_or_null"):
        having = "count(*) > 1"
        if ch.kind == "duplicate_or_null":
            having += " OR " + " OR ".join(f"{c} IS NULL" for c in ch.columns)
        return (f"SELECT {cols}, count(*) AS occurrence_count FROM {t} GROUP BY {cols} "
                f"HAVING {having}")
    if ch.kind == "domain":
        return f"SELECT DISTINCT {cols} FROM {t} ORDER BY {cols}"
    if ch.kind == "cleaned":
        c = ch.columns[0]
        if ch.arg == "strip_quotes":
            return f"SELECT trim(replace({c}, '\"', '')) AS cleaned_{c} FROM {t}"
        return (f"SELECT {c}, left({c}, 10) AS date_part, "
                f"cast({_sql_parse(ch.arg, c)} AS DATE) AS converted_date FROM {t} WHERE {c} IS NOT NULL")
    return f"SELECT * FROM {t} WHERE {_sql_row_condition(ch)}"


def check(check_id: str) -> Check:
    return next(c for c in CHECKS if c.check_id == check_id)
