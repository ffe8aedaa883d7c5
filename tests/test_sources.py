from decimal import Decimal

from salesloom.operators.dims import dim_product, dim_store, dim_supplier
from salesloom.sources.seeds import accepted, csv_rejects, land, read_customers, read_products

PRODUCTS = '''productID,productName,productPrice,supplierID,supplierName,storeID,storeName
810,Oak Ladle,18.40,61,"Birch, Sons & Co.",5,Harbour
811,Copper Pan,31.25,62,"Tidewater, Ltd.",5,Harbour
812,Walnuts,2.75,63,Hillside,77,Hillside
813,Thyme,not-a-price,63,Hillside,77,Hillside
'''


def test_products_csv_quoted_commas_and_three_dims(spark, tmp_dir):
    p = f"{tmp_dir}/products.csv"
    with open(p, "w") as f:
        f.write(PRODUCTS)
    raw = land(read_products(spark, p), f"{tmp_dir}/landed")
    good = accepted(raw)
    names = sorted(r.supplierName for r in good.collect())
    assert names == ["Birch, Sons & Co.", "Hillside", "Tidewater, Ltd."]
    assert csv_rejects(raw).count() == 1
    assert dim_product(good).count() == 3
    assert sorted(tuple(r) for r in dim_supplier(good).collect()) == [
        (61, "Birch, Sons & Co."), (62, "Tidewater, Ltd."), (63, "Hillside")]
    assert sorted(tuple(r) for r in dim_store(good).collect()) == [(5, "Harbour"), (77, "Hillside")]
    price = {r.productID: r.productPrice for r in good.collect()}
    assert price[812] == Decimal("2.75")


def test_customers_csv(spark, tmp_dir):
    p = f"{tmp_dir}/customers.csv"
    with open(p, "w") as f:
        f.write("customerID,customerName,gender\n1,Ann,Female\n2,\"Lee, Bo\",Male\n")
    rows = sorted(tuple(r) for r in accepted(read_customers(spark, p)).collect())
    assert rows == [(1, "Ann", "Female"), (2, "Lee, Bo", "Male")]


def test_spread_only_few_split_scans(spark, tmp_dir):
    from salesloom.sources.tables import spread
    cores = spark.sparkContext.defaultParallelism
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_dir}/one")
    one = spark.read.parquet(f"{tmp_dir}/one")
    assert one.rdd.getNumPartitions() == 1
    assert spread(one).rdd.getNumPartitions() == cores
    many = spark.range(0, 1000, 1, cores * 2)
    assert spread(many).rdd.getNumPartitions() == cores * 2
    assert sorted(r.id for r in spread(one).collect()) == list(range(1000))
