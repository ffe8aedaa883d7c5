import datetime as dt

from salesloom.plans import queries as Q
from salesloom.plans.star import load_files_warehouse, read_dims
from salesloom.sources.transactions import DEFAULT_HEADER

CUSTOMERS = """customerID,customerName,gender
1,Ann,Female
2,"Lee, Bo",Male
x,Broken,Male
"""
PRODUCTS = """productID,productName,productPrice,supplierID,supplierName,storeID,storeName
10,Ladle,50.00,7,"Birch, Sons & Co.",1,North
11,Stick,30.00,8,"Tidewater, Ltd.",2,South
12,Walnuts,3.50,35,Orchard,51,Orchard
"""
TXNS = [DEFAULT_HEADER,
        "1,10,2,1,1/4/2019,10:00 AM,1",      # Friday
        "1,10,1,1,1/4/2019,10:00 AM,1",      # same key: additive
        "2,11,3,2,4/8/2019,3:30 PM,2",
        "3,12,4,2,7/1/2019,9:15 AM,3",
        "4,99,1,1,7/1/2019,9:15 AM,3",       # unknown product
        "5,10,1,3,7/2/2019,9:15 AM,4",       # unknown customer; timeID 4 still defined
        "6,10,1,1,02/30/2019,9:15 AM,5",     # bad date
        "short,line"]


def test_file_based_warehouse(spark, tmp_dir):
    for name, text in (("c.csv", CUSTOMERS), ("p.csv", PRODUCTS), ("t.csv", "\n".join(TXNS) + "\n")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    star = load_files_warehouse(spark, f"{tmp_dir}/c.csv", f"{tmp_dir}/p.csv", f"{tmp_dir}/t.csv",
                                f"{tmp_dir}/wh")
    assert star.rows["fact"] == 3 and star.rows["customer"] == 2 and star.rows["customer_rejects"] == 1
    fact = {r.orderID: r for r in star.fact_rows().collect()}
    assert fact[1].quantityOrdered == 3 and float(fact[1].totalSale) == 150.0
    reasons = sorted(r.reject_reason for r in star.extra["fact_rejects"].collect())
    assert reasons == ["bad_arity", "bad_timestamp", "customer_not_found", "product_not_found"]
    times = {r.timeID: r for r in star.time.collect()}
    assert sorted(times) == [1, 2, 3, 4]
    assert times[2].orderTime == "15:30:00" and times[2].Quarter == 2
    q10 = [tuple(r) for r in Q.q10_store_quarterly_sales(star).collect()]
    assert q10 == [("North", 1, 2019, 150.0), ("Orchard", 3, 2019, 14.0), ("South", 2, 2019, 90.0)]
    q1 = Q.q1_top_products_daytype(star, 2019).first()
    assert (q1.Product, q1.DayType) == ("Ladle", "Weekend")
    assert set(read_dims(spark, f"{tmp_dir}/wh")) == {"customer", "product", "supplier", "store", "staging"}
    assert star.time.where("timeID = 1").first().orderDate == dt.date(2019, 1, 4)


def test_append_is_additive_and_keeps_stored_time_rows(spark, tmp_dir):
    from salesloom.plans.star import append_transactions
    from salesloom.sources.transactions import parse_transactions, read_transaction_lines
    for name, text in (("c.csv", CUSTOMERS), ("p.csv", PRODUCTS), ("t.csv", "\n".join(TXNS) + "\n")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    wh = f"{tmp_dir}/wh"
    load_files_warehouse(spark, f"{tmp_dir}/c.csv", f"{tmp_dir}/p.csv", f"{tmp_dir}/t.csv", wh)
    more = [DEFAULT_HEADER,
            "1,10,5,1,3/9/2019,11:00 AM,1",     # same key as order 1: added; timeID 1 already stored
            "9,11,1,1,3/9/2019,11:00 AM,9",     # new key, new timeID
            "10,77,1,1,3/9/2019,11:00 AM,9"]    # unknown product
    with open(f"{tmp_dir}/t2.csv", "w") as f:
        f.write("\n".join(more) + "\n")
    star = append_transactions(spark, wh, parse_transactions(read_transaction_lines(spark, f"{tmp_dir}/t2.csv")))
    fact = {r.orderID: r for r in star.fact_rows().collect()}
    assert fact[1].quantityOrdered == 8 and float(fact[1].totalSale) == 400.0
    assert fact[1].orderDate == dt.date(2019, 1, 4)           # stored row arrived first
    assert fact[9].quantityOrdered == 1 and star.rows["fact"] == 4
    times = {r.timeID: r for r in star.time.collect()}
    assert times[1].orderDate == dt.date(2019, 1, 4) and times[9].Month == 3
    reasons = sorted(r.reject_reason for r in star.extra["fact_rejects"].collect())
    assert reasons.count("product_not_found") == 2
    assert [tuple(r) for r in Q.q10_store_quarterly_sales(star).collect()][0] == ("North", 1, 2019, 400.0)


def test_appends_rewrite_only_touched_parts(spark, tmp_dir):
    from salesloom.plans.star import _fact_parts, append_transactions, table_locations
    from salesloom.sources.transactions import parse_transactions, read_transaction_lines
    runs = [[DEFAULT_HEADER, "1,10,1,1,6/4/2018,10:00 AM,1", "2,11,2,2,4/8/2019,3:30 PM,2"],
            [DEFAULT_HEADER, "2,11,1,2,5/8/2019,3:30 PM,3",       # existing 2019 key
             "3,12,1,1,1/2/2020,9:00 AM,4"],                       # new key in 2020
            [DEFAULT_HEADER, "1,10,4,1,7/7/2020,1:00 PM,5"]]       # existing 2018 key
    for name, text in (("c.csv", CUSTOMERS), ("p.csv", PRODUCTS)):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    for i, run in enumerate(runs):
        with open(f"{tmp_dir}/r{i}.csv", "w") as f:
            f.write("\n".join(run) + "\n")
    wh = f"{tmp_dir}/wh"
    load_files_warehouse(spark, f"{tmp_dir}/c.csv", f"{tmp_dir}/p.csv", f"{tmp_dir}/r0.csv", wh)
    first_build = table_locations(spark, wh)["fact"]
    lines = lambda i: parse_transactions(read_transaction_lines(spark, f"{tmp_dir}/r{i}.csv"))
    append_transactions(spark, wh, lines(1))
    parts = _fact_parts(spark, table_locations(spark, wh)["fact"])
    folders = lambda parts, year: {r.location for p, r in parts.items() if p[0] == year}
    assert folders(parts, 2018) == {first_build} and first_build not in folders(parts, 2019) | folders(parts, 2020)
    assert {r.version for p, r in parts.items() if p[0] == 2019} == {2} and folders(parts, 2020)
    star = append_transactions(spark, wh, lines(2))
    parts2 = _fact_parts(spark, table_locations(spark, wh)["fact"])
    assert folders(parts2, 2019) == folders(parts, 2019) and first_build not in folders(parts2, 2018)
    # same fact as one load of all runs together
    with open(f"{tmp_dir}/all.csv", "w") as f:
        f.write("\n".join([DEFAULT_HEADER] + [x for r in runs for x in r[1:]]) + "\n")
    whole = load_files_warehouse(spark, f"{tmp_dir}/c.csv", f"{tmp_dir}/p.csv",
                                 f"{tmp_dir}/all.csv", f"{tmp_dir}/wh_all")
    got = sorted(tuple(r) for r in star.fact.collect())
    want = sorted(tuple(r) for r in whole.fact.select(*star.fact.columns).collect())
    assert got == want and len(got) == 3
    assert star.fact_for_year(2018).count() == 1
