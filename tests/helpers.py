"""Tiny in-memory star for query tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesloom.plans.star import Star

D = Decimal


def make_star(spark, sales, products=None, stores=None, suppliers=None, customers=None):
    """``sales``: (orderID, productID, customerID, supplierID, storeID, date, qty, amount)."""
    rows = []
    for o, p, c, su, st, d, q, a in sales:
        tid = d.year * 10000 + d.month * 100 + d.day
        rows.append((o, p, c, su, st, d, tid, q, D(str(a))))
    fact = spark.createDataFrame(
        rows, "orderID long, productID long, customerID long, supplierID long, storeID long, "
              "orderDate date, timeID long, quantityOrdered int, totalSale decimal(10,2)")
    times = sorted({(r[6], r[5]) for r in rows})
    time = spark.createDataFrame(
        [(t, d, "00:00:00", d.day, d.month, (d.month - 1) // 3 + 1, d.year) for t, d in times],
        "timeID long, orderDate date, orderTime string, Day int, Month int, Quarter int, Year int")
    pids = sorted({r[1] for r in rows})
    products = products or [(p, f"P{p:03d}", D("1.00")) for p in pids]
    product = spark.createDataFrame(products, "productID long, productName string, productPrice decimal(10,2)")
    stores = stores or [(s, f"S{s}") for s in sorted({r[4] for r in rows})]
    store = spark.createDataFrame(stores, "storeID long, storeName string")
    suppliers = suppliers or [(s, f"U{s}") for s in sorted({r[3] for r in rows})]
    supplier = spark.createDataFrame(suppliers, "supplierID long, supplierName string")
    customers = customers or [(c, f"C{c}", "X") for c in sorted({r[2] for r in rows})]
    customer = spark.createDataFrame(customers, "customerID long, customerName string, gender string")
    return Star(fact=fact, time=time, product=product, supplier=supplier, store=store,
                customer=customer)


def day(y, m, d):
    return dt.date(y, m, d)


def collect(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]


__all__ = ["make_star", "day", "collect", "D", "F"]
