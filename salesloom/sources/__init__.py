"""Readers: seed CSVs, transaction text, and the provided test tables."""

from salesloom.sources.jdbc import read_jdbc_table, write_jdbc_table
from salesloom.sources.seeds import csv_rejects, land, read_customers, read_products
from salesloom.sources.tables import (customers_from_tables, product_staging_from_tables,
                                      transaction_lines, transactions_from_tables)
from salesloom.sources.transactions import (parse_transactions, read_transaction_lines,
                                            time_candidates, txn_rejects)

__all__ = ["read_jdbc_table", "write_jdbc_table", "csv_rejects", "land", "read_customers", "read_products", "customers_from_tables",
           "product_staging_from_tables", "transaction_lines", "transactions_from_tables",
           "parse_transactions", "read_transaction_lines", "time_candidates", "txn_rejects"]
