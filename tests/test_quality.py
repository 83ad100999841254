"""The quality-check kinds on tiny tables, and the suite's pass rule."""

import pytest

from tidewater.plans.quality import Check, run_suite, violations


@pytest.fixture
def df(spark):
    return spark.createDataFrame([
        ("1", '"a', " x", "2018-01-01", "01-02-2018 10:00", 5),
        ("1", "b", "y ", "2018-02-30", "31-02-2018 10:00", -1),
        ("2", None, "z", None, "junk", 3),
    ], "id string, code string, txt string, d string, dd string, n int")


def count(spark, df, kind, cols, arg=None):
    return violations(Check("t", "bronze", "t", kind, tuple(cols.split()), arg), df).count()


def test_kinds(spark, df):
    assert count(spark, df, "duplicate", "id") == 1
    assert count(spark, df, "duplicate_or_null", "code") == 1        # the null group
    assert count(spark, df, "null", "code txt") == 1
    assert count(spark, df, "whitespace", "txt") == 2                # leading and trailing
    assert count(spark, df, "quote", "code") == 1
    assert count(spark, df, "quote_or_whitespace", "code txt") == 2
    assert count(spark, df, "negative", "n") == 1
    assert count(spark, df, "bad_date", "d", "date") == 1            # 30 Feb; null is not bad
    assert count(spark, df, "bad_date", "dd", "day_first") == 2      # 31 Feb and junk
    assert count(spark, df, "domain", "id") == 2
    assert count(spark, df, "lookup", "code", '"a') == 1
    assert count(spark, df, "cleaned", "code", "strip_quotes") == 3   # a listing of all rows


def test_suite_pass_rule(spark, df, stub):
    checks = (Check("c1", "bronze", "t", "duplicate", ("id",)),
              Check("c2", "bronze", "t", "profile", ("id",), expect_zero=False),
              Check("c3", "bronze", "t", "null", ("id",)),
              Check("c4", "bronze", "t", "whitespace", ("txt",)))
    out = {r.check_id: r for r in run_suite(stub(spark, {"t": df}), checks, ("bronze",)).collect()}
    assert (out["c1"].violations, out["c1"].passed) == (1, False)
    assert (out["c2"].violations, out["c2"].passed) == (1, True)     # informational
    assert (out["c3"].violations, out["c3"].passed) == (0, True)
    assert (out["c4"].violations, out["c4"].passed) == (2, False)


def test_quarantine_names_rows_and_counts_copies(spark, stub):
    from tidewater.plans.quality import _c, quarantine
    geo = spark.createDataFrame(
        [("01000", "-1", "-2", "x", "SP")] * 3 + [("01000", "-1", "-3", "x", None), ("2", None, "1", "y", "RJ")],
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string")
    checks = (_c("d", "bronze", "reference_geolocation", "duplicate", " ".join(geo.columns)),
              _c("p", "bronze", "reference_geolocation", "profile", "geolocation_zip_code_prefix"),
              _c("n", "bronze", "reference_geolocation", "null", "geolocation_lat geolocation_state"),
              _c("v", "bronze", "reference_geolocation", "domain", "geolocation_state"))
    got = {(r.check_id, r.row_key): (r.copies, r.guards)
           for r in quarantine(stub(spark, {"reference_geolocation": geo}), checks).collect()}
    assert got == {("d", "01000|-1|-2|x|SP"): (3, True),
                   ("p", "01000|-1|-2|x|SP"): (3, False), ("p", "01000|-1|-3|x|"): (1, False),
                   ("n", "01000|-1|-3|x|"): (1, True), ("n", "2||1|y|RJ"): (1, True),
                   ("v", "01000|-1|-3|x|"): (1, False)}


def test_quarantine_of_a_hot_group(spark, stub):
    from tidewater.plans.quality import _c, quarantine
    pay = spark.createDataFrame([("hot" if i % 2 else None, i, "boleto", 1, None) for i in range(400)]
                                + [("one", 1, "boleto", 1, None)],
                                "order_id string, payment_sequential int, payment_type string, "
                                "payment_installments int, payment_value decimal(10,2)")
    check = _c("p", "bronze", "finance_ord_payments", "duplicate", "order_id")
    got = quarantine(stub(spark, {"finance_ord_payments": pay}), (check,))
    assert got.count() == 400 and got.where("row_key LIKE '|%'").count() == 200


def test_quarantine_deals_rows_once_where_no_group_is_hot(spark, stub):
    from tidewater.plans.quality import _c, quarantine
    pay = spark.createDataFrame([(f"o{i // 2}", i % 2, "boleto", 1, None) for i in range(60)]
                                + [("o0", 0, "boleto", 1, None), (None, 1, "x", 1, None), ("p", 1, "x", 1, None)],
                                "order_id string, payment_sequential int, payment_type string, "
                                "payment_installments int, payment_value decimal(10,2)")
    checks = (_c("p", "bronze", "finance_ord_payments", "duplicate", "order_id"),
              _c("q", "bronze", "finance_ord_payments", "duplicate_or_null", "order_id payment_type"))
    got = quarantine(stub(spark, {"finance_ord_payments": pay}), checks)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = {(r.check_id, r.row_key): r.copies for r in got.collect()}
    assert len(rows) == 121 and rows["p", "o0|0"] == 2 and rows["q", "|1"] == 1
    assert not any(k in rows for k in (("p", "|1"), ("p", "p|1"), ("q", "p|1")))
