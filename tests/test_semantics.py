"""Edge rows of the source semantics (ledger items), on tiny in-memory silver tables."""

import datetime as dt
from decimal import Decimal

import pytest

from tidewater.plans import advanced, eda, gold, silver
from tidewater.schemas import BRONZE, SILVER

D = dt.datetime


def frame(spark, table, rows, layer=SILVER):
    schema = layer[table]
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


@pytest.fixture
def wh(spark, stub):
    orders = [
        # delivered 09:00 on the estimated date
        dict(order_id="1", customer_id="c1", order_status="Delivered",
             order_purchase_timestamp=D(2017, 1, 3, 8), order_delivered_customer_date=D(2017, 1, 20, 9),
             order_estimated_delivery_date=dt.date(2017, 1, 20)),
        # no items, payments, review or customer row
        dict(order_id="2", customer_id="c-missing", order_status="Shipped",
             order_purchase_timestamp=D(2017, 2, 1), order_estimated_delivery_date=dt.date(2017, 2, 20)),
        dict(order_id="3", customer_id="c3", order_status="Delivered",
             order_purchase_timestamp=D(2017, 3, 1), order_delivered_customer_date=D(2017, 3, 2),
             order_estimated_delivery_date=dt.date(2017, 3, 20)),
    ]
    customers = [dict(customer_id="c1", customer_unique_id="u1", customer_state="SP"),
                 dict(customer_id="c3", customer_unique_id="u1", customer_state="SP")]
    items = [dict(order_id="1", order_item_id=1, product_id="p", seller_id="s",
                  shipping_limit_date=D(2017, 1, 5), price=Decimal("10.00"), freight_value=Decimal("1.00")),
             dict(order_id="3", order_item_id=1, product_id="p", seller_id="s",
                  shipping_limit_date=D(2017, 3, 5), price=Decimal("0.00"), freight_value=Decimal("0.00"))]
    payments = [dict(order_id="1", payment_sequential=1, payment_type="Voucher",
                     payment_installments=1, payment_value=Decimal("5.00")),
                dict(order_id="1", payment_sequential=2, payment_type="Voucher",
                     payment_installments=1, payment_value=Decimal("5.00"))]
    reviews = [dict(review_id="r1", order_id="1", review_score=4),
               dict(review_id="r3", order_id="3", review_score=5)]
    tables = {
        "sales_ord_details": frame(spark, "sales_ord_details", orders),
        "crm_cust_info": frame(spark, "crm_cust_info", customers),
        "sales_ord_items": frame(spark, "sales_ord_items", items),
        "finance_ord_payments": frame(spark, "finance_ord_payments", payments),
        "crm_cust_reviews": frame(spark, "crm_cust_reviews", reviews),
    }
    return stub(spark, tables)


def as_dict(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_late_means_two_things(wh):
    v6 = as_dict(advanced.delivery_status(wh), "delivery_status")
    assert v6["Late"]["total_orders"] == 1            # 09:00 > midnight of the estimate
    v7 = as_dict(advanced.delay_vs_review(wh), "delivery_category")
    assert v7["Delivered On Time"]["total_orders"] == 1   # zero whole days late


def test_order_without_children_gets_defaults(wh):
    f = as_dict(gold.fact_sales(wh, keyed=False), "order_id")["2"]
    assert (f["total_items"], f["total_price"], f["payment_count"], f["review_id"],
            f["review_score"], f["customer_unique_id"]) == (0, 0, None, "n/a", 0, None)


def test_two_one_shot_payments_count_as_installments(wh):
    v9 = as_dict(advanced.installment_analysis(wh), "payment_category")
    assert v9["Installment Payment"]["total_orders"] == 1
    assert v9["Single Payment"]["total_orders"] == 2      # null installments -> single


def test_missing_review_averages_in_as_zero(wh):
    assert eda.average_review_score(wh).first()[0] == 3   # (4 + 0 + 5) div 3


def test_null_customer_group_is_kept(wh):
    k8 = eda.customer_type_per_customer(wh).collect()
    assert sorted(r.customers for r in k8) == [1, 2]
    rfm = as_dict(advanced.rfm(wh), "customer_unique_id")
    assert None in rfm and rfm["u1"]["frequency"] == 2 and rfm["u1"]["recency"] == 0


def test_growth_is_null_after_zero_month(wh):
    v4 = {(r.order_year, r.order_month): r for r in
          advanced.monthly_revenue_growth(wh, start=D(2017, 1, 1)).collect()}
    assert v4[(2017, 2)].mom_growth_percentage == -100.0
    assert v4[(2017, 3)].previous_month_revenue == 0.0 and v4[(2017, 3)].mom_growth_percentage is None


def test_latest_review_wins(spark):
    b = frame(spark, "crm_cust_reviews", [
        dict(review_id="a", order_id="o", review_score=1, review_creation_date="2018-01-01",
             review_answer_date="2018-01-05 00:00:00", review_title=" t "),
        dict(review_id="b", order_id="o", review_score=5, review_creation_date="2018-01-02",
             review_answer_date="2018-01-03 00:00:00")], layer=BRONZE)
    got = silver.reviews(b).collect()
    assert len(got) == 1 and got[0].review_id == "b" and got[0].review_title == "n/a"


def test_same_product_twice_in_an_order_collapses(spark):
    row = dict(order_id='"o', product_id="p", seller_id="s", shipping_limit_date="2018-01-01 10:00:00",
               price=Decimal("1.00"), freight_value=Decimal("0.50"))
    b = frame(spark, "sales_ord_items", [dict(row, order_item_id=2), dict(row, order_item_id=1)],
              layer=BRONZE)
    got = silver.order_items(b).collect()
    assert [(r.order_id, r.order_item_id) for r in got] == [("o", 1)]


def test_order_status_and_dates_cleaned(spark):
    b = frame(spark, "sales_ord_details", [dict(
        order_id="1", customer_id="c", order_status="DELIVERED ",
        order_purchase_timestamp="02-10-2017 10:56", order_approved_at="31-02-2017 10:00",
        order_estimated_delivery_date="23-10-2017 00:00")], layer=BRONZE)
    r = silver.orders(b).first()
    assert (r.order_status, r.order_purchase_timestamp, r.order_approved_at,
            r.order_estimated_delivery_date) == ("Delivered", D(2017, 10, 2, 10, 56), None,
                                                 dt.date(2017, 10, 23))


def test_items_meet_their_orders_last(spark, stub):
    from tidewater.plans import gold
    dates = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date")
    wh = stub(spark, {
        "sales_ord_items": spark.createDataFrame(
            [("1", 1, "a", "s", None, None, None), ("1", 2, "b", "none", None, None, None),
             ("2", 1, "none", "s", None, None, None), (None, 1, "a", "s", None, None, None)],
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "shipping_limit_date timestamp, price decimal(10,2), freight_value decimal(10,2)"),
        "sales_ord_details": spark.createDataFrame(
            [("1", "c2", "Shipped", *[None] * 5), ("2", None, "Invoiced", *[None] * 5),
             ("2", "gone", "Delivered", *[None] * 5)],
            "order_id string, customer_id string, order_status string, "
            + ", ".join(f"{d} timestamp" for d in dates) + ", order_estimated_delivery_date date"),
        "crm_cust_info": spark.createDataFrame([("c1", "u1"), ("c2", "u2"), ("c3", "u2"), ("c4", None)],
                                               "customer_id string, customer_unique_id string"),
        "prd_item_details": spark.createDataFrame([("a",), ("b",)], "product_id string"),
        "prd_seller_details": spark.createDataFrame([("s",)], "seller_id string")})
    f = gold.fact_sales_items(wh, keyed=False)
    first = next(x for x in f._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x)
    assert "order_id" in first       # the outermost join: the others carry no columns of the orders
    got = {(r.order_id, r.order_item_id, r.order_status): (r.customer_key, r.product_key, r.seller_key)
           for r in f.collect()}
    assert got == {("1", 1, "Shipped"): ("CUST3", "PRDa", "Ss"), ("1", 2, "Shipped"): ("CUST3", "PRDb", None),
                   ("2", 1, "Invoiced"): (None, None, "Ss"), ("2", 1, "Delivered"): (None, None, "Ss"),
                   (None, 1, None): (None, "PRDa", "Ss")}
    keyed = gold.fact_sales_items(wh).collect()
    assert sorted(r.sales_key for r in keyed) == [1, 2, 3, 4, 5] and keyed[0].__fields__[0] == "sales_key"
