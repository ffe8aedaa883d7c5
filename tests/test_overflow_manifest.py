"""Totals that do not fit the fact, manifest versions, and appends that are seen."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.operators.fact import collapse_fact, fact_totals, overflowed_keys
from salesloom.plans import star as S
from salesloom.sources.transactions import parse_transactions
from tests.conftest import SF_SMALL

DAY = dt.date(2019, 1, 2)
SCHEMA = ("orderID bigint, productID bigint, customerID bigint, supplierID bigint, storeID bigint, "
          "orderDate date, timeID bigint, quantityOrdered int, totalSale decimal(10,2), arrival int")


def test_an_overflowing_key_leaves_the_others(spark):
    big = [(1, 1, 1, 5, 6, DAY, 7, 1, Decimal("50000000.00"), i) for i in range(3)]
    rows = spark.createDataFrame([*big, (2, 1, 1, 5, 6, DAY, 7, 2, Decimal("3.50"), 9)], SCHEMA)
    assert [(r.orderID, r.quantityOrdered, r.totalSale) for r in collapse_fact(rows).collect()] == [(2, 2, Decimal("3.50"))]
    over = overflowed_keys(fact_totals(rows)).collect()
    assert [(r.orderID, r.totalSale, r.reject_reason) for r in over] == [(1, Decimal("150000000.00"), "amount_overflow")]


def _line(spark, order, quantity):
    lines = spark.createDataFrame([(f"{order},1,{quantity},1,1/5/1998,10:30 AM,199801051030", 0)], "value string, arrival int")
    return parse_transactions(lines)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wh"))
    return path, S.load_warehouse(spark, SF_SMALL, path).fact.count()


def test_an_append_is_seen_and_a_failed_manifest_changes_nothing(spark, warehouse, monkeypatch):
    path, before = warehouse
    assert S.append_transactions(spark, path, _line(spark, 900001, 2)).fact.count() == before + 1
    assert S.load_warehouse(spark, SF_SMALL, path).fact.count() == before + 1

    # only a reject: the fact stays as it is
    star = S.append_transactions(spark, path, _line(spark, 900009, "x"))
    assert star.fact.count() == before + 1
    assert star.extra["fact_rejects"].where("reject_reason = 'bad_integer'").count() == 1

    def broken(named):
        return (spark.range(3).select(F.lit("fact").alias("source"),
                                      F.raise_error(F.lit("lost")).cast("bigint").alias("rows")))

    with monkeypatch.context() as m:
        m.setattr(S, "load_metrics", broken)
        with pytest.raises(Exception, match="lost"):
            S.append_transactions(spark, path, _line(spark, 900002, 2))
    assert S.load_warehouse(spark, SF_SMALL, path).fact.count() == before + 1


def test_an_appended_overflow_is_kept_with_its_total(spark, warehouse):
    path, _ = warehouse
    start = S.load_warehouse(spark, SF_SMALL, path).fact.count()
    price = S.load_warehouse(spark, SF_SMALL, path).product.where("productID = 1").first().productPrice
    most = int(Decimal("99999999.99") // price)
    for turn in range(2):
        star = S.append_transactions(spark, path, _line(spark, 900003, most))
        assert star.fact.count() == start + (1 - turn)
    (row,) = star.extra["fact_overflow"].collect()
    assert (row.orderID, row.totalSale, row.reject_reason) == (900003, 2 * most * price, "amount_overflow")
    star = S.append_transactions(spark, path, _line(spark, 900003, 1))
    assert star.extra["fact_overflow"].first().totalSale == (2 * most + 1) * price
    assert star.fact.count() == start


def test_input_key_follows_the_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    first = S._input_key(spark, str(tmp_path))
    assert first == S._input_key(spark, str(tmp_path))
    spark.range(4).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert first != S._input_key(spark, str(tmp_path))
