"""Explicit schemas of the seed files and the star tables.

Identifiers are ``long``: the warehouse must hold more than 2^31 orders at
the target scale, and the provided tables already use 64-bit keys.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)          # DECIMAL(10,2) of the fact and product price
WIDE_MONEY = T.DecimalType(28, 2)     # sums of amounts before they are checked against MONEY

CUSTOMER_CSV = T.StructType([
    T.StructField("customerID", T.LongType()),
    T.StructField("customerName", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_CSV = T.StructType([
    T.StructField("productID", T.LongType()),
    T.StructField("productName", T.StringType()),
    T.StructField("productPrice", MONEY),
    T.StructField("supplierID", T.LongType()),
    T.StructField("supplierName", T.StringType()),
    T.StructField("storeID", T.LongType()),
    T.StructField("storeName", T.StringType()),
])

# typed transaction, as produced by the parser (and by the table mapping)
TRANSACTION = T.StructType([
    T.StructField("orderID", T.LongType()),
    T.StructField("productID", T.LongType()),
    T.StructField("quantityOrdered", T.IntegerType()),
    T.StructField("customerID", T.LongType()),
    T.StructField("orderTS", T.TimestampType()),
    T.StructField("timeID", T.LongType()),
])

FACT_COLUMNS = ["orderID", "productID", "customerID", "supplierID", "storeID",
                "orderDate", "timeID", "quantityOrdered", "totalSale"]

TIME_COLUMNS = ["timeID", "orderDate", "orderTime", "Day", "Month", "Quarter", "Year"]

# Fixed values of the transaction file layout: one header line, seven
# comma-separated fields in this order, date and time as below.
TRANSACTION_FIELDS = ["orderID", "productID", "quantityOrdered", "customerID",
                      "orderDate", "orderTime", "timeID"]
TRANSACTION_TS_FORMAT = "M/d/yyyy h:mm a"
