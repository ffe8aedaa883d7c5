"""One row per key in every dimension; pairs of unknown products do not bound Q6."""

from decimal import Decimal

from salesloom.operators.dims import dim_product, dim_store, dim_supplier, one_per_key
from salesloom.plans import catalog
from salesloom.plans.queries import q6_product_affinity
from salesloom.plans.star import Star, read_star, write_warehouse_from
from salesloom.sources.transactions import parse_transactions

STAGING = ("productID long, productName string, productPrice decimal(10,2), supplierID long, supplierName string, "
           "storeID long, storeName string")


def test_repeated_ids_keep_one_row(spark):
    rows = [(1, "b", Decimal("2.00"), 7, "s2", 9, "t2"), (1, "a", Decimal("3.00"), 7, "s1", 9, "t1"),
            (None, "x", None, None, "y", None, "z")]
    staging = spark.createDataFrame(rows, STAGING)
    assert [tuple(r) for r in dim_product(staging).collect()] == [(1, "a", Decimal("3.00"))]
    assert [tuple(r) for r in dim_supplier(staging).collect()] == [(7, "s1")]
    assert [tuple(r) for r in dim_store(staging).collect()] == [(9, "t1")]
    customers = spark.createDataFrame([(1, "z", "f"), (1, "a", "m"), (2, "q", None)], "customerID long, customerName string, gender string")
    assert sorted(tuple(r) for r in one_per_key(customers, "customerID").collect()) == [(1, "a", "m"), (2, "q", None)]


def test_orphan_products_do_not_empty_the_report(spark):
    fact = [(o, p) for o in range(10) for p in (91, 92, 93, 94)] + [(o, p) for o in (20, 21) for p in (1, 2, 3, 4)]
    star = Star(fact=spark.createDataFrame(fact, "orderID long, productID long"), time=None, supplier=None, store=None,
                customer=None, product=spark.createDataFrame([(i, f"p{i}") for i in (1, 2, 3, 4)], "productID long, productName string"))
    want = [("p1", "p2", 2), ("p1", "p3", 2), ("p1", "p4", 2), ("p2", "p3", 2), ("p2", "p4", 2)]
    assert [tuple(r) for r in q6_product_affinity(star).collect()] == want


def test_rows_left_out_are_kept_and_reported(spark, tmp_dir, monkeypatch):
    rows = [(1, "b", Decimal("2.00"), 7, "s2", 9, "t"), (1, "a", Decimal("3.00"), 7, "s1", 9, "t"), (2, "c", None, None, "y", 9, "t"),
            (None, "x", Decimal("1.00"), 8, "s8", 9, "t")]
    customers = [(1, "z", "f"), (1, "a", "m"), (1, "a", "m"), (None, "n", "f"), (2, "q", None), (2, "q", None), (3, "q", "f")]
    csv = spark.createDataFrame([("no,number", "bad_csv_row", "no")], "raw string, reject_reason string, customerName string")
    lines = spark.createDataFrame([("1,1,2,1,1/4/2019,10:00 AM,1", 0)], "value string, arrival long")
    write_warehouse_from(spark, spark.createDataFrame(rows, STAGING),
                         spark.createDataFrame(customers, "customerID long, customerName string, gender string"),
                         parse_transactions(lines), f"{tmp_dir}/wh", extra={"customer_rejects": csv})
    star = read_star(spark, f"{tmp_dir}/wh")

    def left_out(dim):
        table = star.extra[f"{dim}_rejects"]
        return sorted((tuple(r) for r in table.select("reject_reason", *getattr(star, dim).columns).collect()), key=repr)

    assert left_out("product") == [("null_key", None, "x", Decimal("1.00")), ("repeated_key", 1, "b", Decimal("2.00"))]
    assert left_out("supplier") == [("null_key", None, "y"), ("repeated_key", 7, "s2")] and left_out("store") == []
    assert left_out("customer") == [("bad_csv_row", None, "no", None), ("null_key", None, "n", "f"), ("repeated_key", 1, "a", "m"),
                                    ("repeated_key", 1, "z", "f"), ("repeated_key", 2, "q", None)]
    assert star.product.count() == 2 and star.customer.count() == 3 and star.fact.count() == 1
    monkeypatch.setattr(catalog, "load_warehouse", lambda *_: star)
    got = sorted(tuple(r) for r in catalog.q_dim_key_violations(spark, "").collect())
    assert got == [("customerID", "1", 3), ("customerID", "2", 2), ("customerName", "a", 2), ("customerName", "q", 3),
                   ("productID", "1", 2), ("supplierID", "7", 2)]
