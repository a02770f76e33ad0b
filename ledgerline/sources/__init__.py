from ledgerline.sources.files import read_billing_csv, read_csv_table
from ledgerline.sources.jdbc import (
    count_billing_jdbc,
    count_jdbc_table,
    read_billing_jdbc,
    read_jdbc_table,
)

__all__ = [
    "count_billing_jdbc",
    "count_jdbc_table",
    "read_billing_csv",
    "read_billing_jdbc",
    "read_csv_table",
    "read_jdbc_table",
]
