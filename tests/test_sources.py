import os
import tempfile

from tidewater.schemas import BRONZE
from tidewater.sources import (parse_geolocation_lines, parse_seller_lines, read_delimited,
                               read_quoted_csv, read_raw_lines)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_seller_line_keeps_comma_in_city(spark):
    parsed, rejects = parse_seller_lines(lines(spark, '"3442,13023,rio de janeiro, rj,SP',
                                               "1,2,city,ST", "too,short"))
    got = sorted(tuple(r) for r in parsed.collect())
    assert got == [('"3442', "13023", "rio de janeiro, rj", "SP"), ("1", "2", "city", "ST")]
    assert [r.value for r in rejects.collect()] == ["too,short"]


def test_geolocation_line(spark):
    parsed, rejects = parse_geolocation_lines(lines(spark, '"68903,-10.5,-40.25,sao paulo, sp,SP'))
    assert tuple(parsed.first()) == ('"68903', "-10.5", "-40.25", "sao paulo, sp", "SP")
    assert rejects.count() == 0


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_delimited_csv_bom_crlf_no_quotes(spark):
    root = tempfile.mkdtemp(prefix="tw-test-")
    _write(f"{root}/t/part.csv",
           "﻿product_category_name,product_category_name_english\r\n"
           'beleza_saude,health_beauty\r\n"x,y\r\ncama_mesa,bed_table'.encode("utf-8"))
    rows, rejects = read_delimited(spark, f"{root}/t", BRONZE["prd_translations"])
    got = sorted(tuple(r) for r in rows.collect())
    assert ("beleza_saude", "health_beauty") in got and ("cama_mesa", "bed_table") in got
    assert ('"x', "y") in got        # quoting is off: the quote stays in the value
    assert rejects.cache().count() == 0


def test_delimited_csv_rejects_bad_numbers(spark):
    root = tempfile.mkdtemp(prefix="tw-test-")
    _write(f"{root}/p/part.csv",
           b"order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
           b"a,1,boleto,1,10.50\nb,x,boleto,1,1.00\n")
    rows, rejects = read_delimited(spark, f"{root}/p", BRONZE["finance_ord_payments"])
    assert [r.order_id for r in rows.collect()] == ["a"]
    assert [r.order_id for r in rejects.cache().collect()] == ["b"]


def test_quoted_csv_with_commas_quotes_and_newlines(spark):
    root = tempfile.mkdtemp(prefix="tw-test-")
    _write(f"{root}/r/part.csv",
           b"review_id,order_id,review_score,review_title,review_message,review_creation_date,"
           b"review_answer_date\n"
           b'r1,o1,5,," good, ""very"" good\nreally",2018-01-01,2018-01-02 10:00:00\n')
    rows, _ = read_quoted_csv(spark, f"{root}/r", BRONZE["crm_cust_reviews"])
    r = rows.first()
    assert r.review_title is None
    assert r.review_message == ' good, "very" good\nreally'


def test_raw_lines_drop_header_by_text(spark):
    root = tempfile.mkdtemp(prefix="tw-test-")
    _write(f"{root}/s/part.txt", b"h1,h2\n1,2,c,S\n")
    assert [r.value for r in read_raw_lines(spark, f"{root}/s", header="h1,h2").collect()] == \
        ["1,2,c,S"]


def test_audit_records_then_raises_over_reject_limit(spark):
    import pytest
    from tidewater.sources.audit import LoadAudit, RejectLimitExceeded
    audit = LoadAudit()
    df = spark.createDataFrame([(1,)], "x int")
    audit.run("bronze", "ok_table", lambda: df, rejects=lambda n: 0, max_rejects=0)
    with pytest.raises(RejectLimitExceeded):
        audit.run("bronze", "bad_table", lambda: df, rejects=lambda n: 3, max_rejects=2)
    rows = {r.table_name: r for r in audit.to_df(spark).collect()}
    assert rows["ok_table"].status == "ok" and rows["bad_table"].status == "failed"
    assert "3 rejected" in rows["bad_table"].error
