import datetime as dt
import random
from decimal import Decimal

from salesloom.operators.enrich import accepted_facts, enrich_transactions, fact_rejects
from salesloom.operators.fact import collapse_fact, fact_totals
from salesloom.plans.queries import q9_outlier_days
from salesloom.plans.star import Star

TXN = "orderID long, productID long, quantityOrdered int, customerID long, orderTS timestamp, timeID long, arrival long"


def masters(spark):
    staging = spark.createDataFrame(
        [(1, "A", Decimal("10.00"), 100, "Sup", 5, "Store"),
         (2, "B", Decimal("20.00"), 999, "Ghost", 5, "Store"),       # supplier not in dim
         (3, "C", Decimal("30.00"), 100, "Sup", 777, "Nowhere"),     # store not in dim
         (4, "D", Decimal("99999999.99"), 100, "Sup", 5, "Store"),   # overflows when x2
         (5, "E", None, 100, "Sup", 5, "Store")],                   # NULL price reads as 0
        "productID long, productName string, productPrice decimal(10,2), supplierID long, "
        "supplierName string, storeID long, storeName string")
    suppliers = spark.createDataFrame([(100, "Sup")], "supplierID long, supplierName string")
    stores = spark.createDataFrame([(5, "Store")], "storeID long, storeName string")
    customers = spark.createDataFrame([(50, "Ann", "F")], "customerID long, customerName string, gender string")
    return staging, suppliers, stores, customers


def ts(d):
    return dt.datetime(2019, 1, d)


def test_reject_reasons_in_order(spark):
    t = spark.createDataFrame([
        (1, 1, 2, 50, ts(1), 1, 0),     # ok: 2 x 10.00
        (2, 9, 1, 50, ts(1), 1, 1),     # product_not_found
        (3, 2, 1, 50, ts(1), 1, 2),     # invalid_supplier
        (4, 3, 1, 50, ts(1), 1, 3),     # invalid_store
        (5, 1, 1, 51, ts(1), 1, 4),     # customer_not_found
        (6, 4, 2, 50, ts(1), 1, 5),     # amount_overflow
        (7, 5, 3, 50, ts(1), 1, 6),     # NULL price -> 0.00
    ], TXN)
    e = enrich_transactions(t, *masters(spark))
    reasons = {r.orderID: r.reject_reason for r in e.collect()}
    assert reasons == {1: None, 2: "product_not_found", 3: "invalid_supplier", 4: "invalid_store",
                       5: "customer_not_found", 6: "amount_overflow", 7: None}
    ok = {r.orderID: r for r in accepted_facts(e).collect()}
    assert ok[1].totalSale == Decimal("20.00") and ok[1].supplierID == 100 and ok[1].storeID == 5
    assert ok[7].totalSale == Decimal("0.00")
    assert fact_rejects(e).count() == 5


def test_additive_upsert_keeps_first_arrival(spark):
    staging, suppliers, stores, customers = masters(spark)
    rows = [(1, 1, 1, 50, ts(3), 3, 2), (1, 1, 2, 50, ts(1), 1, 0), (1, 1, 4, 50, ts(2), 2, 1),
            (2, 1, 1, 50, ts(5), 5, 3)]
    random.Random(7).shuffle(rows)
    e = enrich_transactions(spark.createDataFrame(rows, TXN), staging, suppliers, stores, customers)
    f = {r.orderID: r for r in collapse_fact(accepted_facts(e)).collect()}
    assert f[1].quantityOrdered == 7 and f[1].totalSale == Decimal("70.00")
    assert f[1].orderDate == dt.date(2019, 1, 1) and f[1].timeID == 1   # arrival 0 wins
    assert f[2].quantityOrdered == 1


def test_collapse_is_batch_split_invariant(spark):
    staging, suppliers, stores, customers = masters(spark)
    rows = [(o % 3, 1, 1 + o % 2, 50, ts(1 + o % 4), o % 4, o) for o in range(12)]
    e = accepted_facts(enrich_transactions(spark.createDataFrame(rows, TXN), staging, suppliers,
                                           stores, customers))
    whole = sorted(tuple(r) for r in collapse_fact(e).collect())
    parts = e.where("arrival < 5").unionByName(e.where("arrival >= 5"))
    assert sorted(tuple(r) for r in collapse_fact(parts).collect()) == whole


def test_totals_dealt_to_tasks_sort_their_rows_behind_the_shuffle_only(spark):
    rows = spark.range(300).selectExpr("id % 100 AS orderID", "id % 10 AS productID", "id % 100 AS customerID", "id AS supplierID", "2L AS storeID",
                                       "DATE'2019-01-01' AS orderDate", "3L AS timeID", "1 AS quantityOrdered",
                                       "CAST(1.5 AS DECIMAL(10,2)) AS totalSale", "struct(300 - id AS pos) AS arrival")
    dealt = fact_totals(rows, tasks=3)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, fact_totals(rows).collect()))
    plan = fact_totals(rows, tasks=3)._jdf.queryExecution().executedPlan().toString()      # not run: the initial plan only
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan.split("Exchange hashpartitioning")[1]


def test_outlier_days_of_big_products_are_shuffled_by_product_once_after_the_join(spark):
    df = lambda rows, schema: spark.createDataFrame(rows, schema)     # noqa: E731
    day = [dt.date(2019, 1, d) for d in (1, 2, 3)]
    fact = df([(1, t, Decimal(v)) for t, v in ((1, 10), (2, 10), (3, 100))] + [(2, 1, Decimal(7))],
              "productID long, timeID long, totalSale decimal(10,2)")
    star = Star(fact=fact, time=df([(i + 1, d) for i, d in enumerate(day)], "timeID long, orderDate date"),
                product=df([(1, "A"), (2, "B")], "productID long, productName string"), supplier=None, store=None, customer=None,
                rows={"fact": 4, "time": 3, "product": 10 ** 10})
    got = q9_outlier_days(star)
    assert [(r.Product, r.SaleDate, r.Flag) for r in got.collect()] == [
        ("A", day[0], "Normal"), ("A", day[1], "Normal"), ("A", day[2], "Outlier"), ("B", day[0], "Normal")]
    assert "RepartitionByExpression [Product" in got._jdf.queryExecution().optimizedPlan().toString()
