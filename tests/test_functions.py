import datetime as dt
import re

from pyspark.sql import functions as F

from tidewater.functions import (day_diff, has_outer_whitespace, int_avg, prefixed_key,
                                 sentence_case, sentence_case_spaced, strip_quotes,
                                 strip_quotes_trim, trim_or_na, try_parse_date,
                                 try_parse_day_first, try_parse_day_first_date,
                                 try_parse_timestamp)


def one(spark, col, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_sentence_case_is_not_initcap(spark):
    got = one(spark, sentence_case("s"), [("SAO PAULO",), ("rio de janeiro",), ("",), (None,)])
    assert got == ["Sao paulo", "Rio de janeiro", "", None]


def test_sentence_case_spaced(spark):
    assert one(spark, sentence_case_spaced("s"), [("credit_card",), ("BOLETO",)]) == \
        ["Credit card", "Boleto"]


def test_quotes_and_trim(spark):
    data = [('"3442',), (' "68903 ',), ("x",)]
    assert one(spark, strip_quotes_trim("s"), data) == ["3442", "68903", "x"]
    assert one(spark, strip_quotes("s"), data) == ["3442", " 68903 ", "x"]


def test_trim_or_na(spark):
    assert one(spark, trim_or_na("s"), [(" a ",), (None,)]) == ["a", "n/a"]


def test_whitespace_catches_both_ends(spark):
    assert one(spark, has_outer_whitespace("s"), [(" a",), ("a ",), ("a",)]) == [True, True, False]


def test_day_first_parse(spark):
    got = one(spark, try_parse_day_first("s"),
              [("02-10-2017 10:56",), ("31-02-2017 10:00",), ("02-10-2017",),
               ("02-10-2017 10:56:07",), ("2017-10-02",), (None,), ("junk",)])
    assert got == [dt.datetime(2017, 10, 2, 10, 56), None, dt.datetime(2017, 10, 2),
                   dt.datetime(2017, 10, 2, 10, 56, 7), None, None, None]


def test_day_first_date_uses_first_ten_chars(spark):
    got = one(spark, try_parse_day_first_date("s"), [("23-05-2018 00:00",), ("30-02-2018",)])
    assert got == [dt.date(2018, 5, 23), None]


def test_usual_forms_parse(spark):
    forms = ["2-10-2017 9:05", "02/10/2017 10:56", "02.10.2017 10:56:07.123", "2/1/2017",
             "31/02/2017 10:00", "02-10-2017 25:00", "x", ""]
    assert one(spark, try_parse_day_first("s"), [(f,) for f in forms]) == [
        dt.datetime(2017, 10, 2, 9, 5), dt.datetime(2017, 10, 2, 10, 56),
        dt.datetime(2017, 10, 2, 10, 56, 7, 123000), dt.datetime(2017, 1, 2), None, None, None, None]
    assert one(spark, try_parse_timestamp("s"), [("2017-10-02 10:56:07.000",), ("2017/1/2",),
                                                 ("2017-10-02T10:56",), ("2017-02-30",)]) == [
        dt.datetime(2017, 10, 2, 10, 56, 7), dt.datetime(2017, 1, 2),
        dt.datetime(2017, 10, 2, 10, 56), None]
    assert one(spark, try_parse_day_first_date("s"), [("2/1/2017",), ("02.10.2017 09:00",)]) == [
        dt.date(2017, 1, 2), dt.date(2017, 10, 2)]


def test_iso_parse(spark):
    assert one(spark, try_parse_timestamp("s"), [("2018-05-23 10:01:02",), ("23-05-2018",)]) == \
        [dt.datetime(2018, 5, 23, 10, 1, 2), None]
    assert one(spark, try_parse_date("s"), [("2018-05-23",)]) == [dt.date(2018, 5, 23)]


def test_int_avg_truncates_toward_zero(spark):
    df = spark.createDataFrame([(4,), (5,), (5,)], "x int")
    assert df.agg(int_avg("x")).first()[0] == 4
    neg = spark.createDataFrame([(-3,), (-4,)], "x int")
    assert neg.agg(int_avg("x")).first()[0] == -3
    empty = spark.createDataFrame([], "x int")
    assert empty.agg(int_avg("x")).first()[0] is None


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 1, 23, 59), dt.datetime(2017, 1, 2, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(day_diff("a", "b")).first()[0] == 1


def test_prefixed_key_null_and_width(spark):
    ids = [("a" * 30 + "bc",), ("a" * 30 + "de",), (None,)]
    assert one(spark, prefixed_key("PRD", F.col("s")), ids) == [
        "PRD" + "a" * 30 + "bc", "PRD" + "a" * 30 + "de", None]
    assert one(spark, prefixed_key("PRD", F.col("s"), width=30), ids)[0] == "PRD" + "a" * 30


def test_date_styles(spark):
    from tidewater.functions.dates import try_parse_any_day_first, try_parse_any_timestamp
    default = {"20170102": "2017-01-02 00:00:00", "Jan 2 2017 3:04PM": "2017-01-02 15:04:00",
               "2 january 2017 12:00 am": "2017-01-02 00:00:00", "02-Feb-50": "1950-02-02 00:00:00",
               "Sept 2 2017": None, "May 3, 49 12:30pm": "2049-05-03 12:30:00", "20170231": None,
               "2017-01-02 3:04:05 PM": "2017-01-02 15:04:05", "Jan 2 2017 13:00PM": None,
               "2017-01-02 5": None, "2017-01-02 5am": "2017-01-02 05:00:00", "x": None, "": None,
               "20170102 23:59:59.5": "2017-01-02 23:59:59.500000", "Jan 2 2017 25:00": None,
               "2017-01-02 10:11": "2017-01-02 10:11:00", None: None}
    first = {"3/4/17": "2017-04-03 00:00:00", "3-4-2017 1:02 pm": "2017-04-03 13:02:00",
             "31-02-2017": None, "03.04.99 10:00": "1999-04-03 10:00:00", "3 apr 2017": "2017-04-03 00:00:00"}
    for parse, cases in ((try_parse_any_timestamp, default), (try_parse_any_day_first, first)):
        df = spark.createDataFrame([(k, 1) for k in cases], "t string, n int")
        got = {r.t: None if r.p is None else str(r.p) for r in df.select("t", parse("t").alias("p")).collect()}
        assert got == cases


def test_dates_in_the_plain_layout_are_those_of_the_others(spark):
    """Cut by place or rearranged: the same dates, and null for the same text."""
    from tidewater.functions.dates import DAY_FIRST, _try_parse
    dates = ("02-10-2017", "31-02-2017", "29/02/2016", "29.02.2015", "02.10-2017", "2-1-2017", "01-13-2017",
             "00-00-0000", "2017-10-02", "02 10 2017", "02-10-17", "x")
    times = ("", " ", " 10:56", " 24:00", " 10:60", " 9:5", "T10:56", "  10:56", " 10:56:07.5", "\n", " 10:56\n", " 10")
    df = spark.createDataFrame([(d + t,) for d in dates for t in times] + [(None,)], "s string")
    slow = _try_parse(F.trim("s"), DAY_FIRST, "$3-$2-$1")
    got = df.select("s", try_parse_day_first("s").cast("string").alias("a"), slow.cast("string").alias("b"))
    assert got.where("NOT a <=> b").collect() == [] and got.where("a IS NOT NULL").count() > 30


def test_order_dates_are_compiled(spark):
    """The JVM leaves methods of 8000 bytes and more to its interpreter."""
    from tidewater.plans import silver
    from tidewater.schemas import BRONZE
    df = silver.orders(spark.createDataFrame([], BRONZE["sales_ord_details"]))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = df._jdf.queryExecution().explainString(mode)
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000
