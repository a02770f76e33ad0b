"""The billing contract: columns, types, keys and accepted labels of the raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the billing contract.
PLANS = ("starter", "growth", "scale")
SUBSCRIPTION_STATUSES = ("active", "cancelled", "paused")
INVOICE_STATUSES = ("paid", "open", "failed")
CURRENCIES = ("EUR", "SEK")
RATES_TO_EUR = {"EUR": "1.0000", "SEK": "0.0870"}

REPORTING_CURRENCY = "EUR"
UNKNOWN_COUNTRY = "UNKNOWN"

MONEY_IN = "decimal(10,2)"
MONEY_EUR = "decimal(18,2)"
RATE = "decimal(10,4)"

# Optional column added at ingest; identifies a raw row by its content.
ROW_ID = "_row_id"


@dataclass(frozen=True)
class RawTable:
    """One raw table. No column is declared NOT NULL and no key is enforced: defects must load."""

    name: str
    key: str
    schema: T.StructType
    blank_is_null: frozenset[str]

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _table(name: str, key: str, blank_is_null: set[str], **columns: T.DataType) -> RawTable:
    schema = T.StructType([T.StructField(c, t, True) for c, t in columns.items()])
    return RawTable(name, key, schema, frozenset(blank_is_null))


CUSTOMERS = _table(
    "customers",
    "customer_id",
    {"country"},
    customer_id=T.VarcharType(20),
    customer_name=T.VarcharType(255),
    email=T.VarcharType(255),
    country=T.VarcharType(10),
    created_at=T.DateType(),
)

SUBSCRIPTIONS = _table(
    "subscriptions",
    "subscription_id",
    {"end_date"},
    subscription_id=T.VarcharType(20),
    customer_id=T.VarcharType(20),
    plan_name=T.VarcharType(50),
    monthly_price=T.DecimalType(10, 2),
    start_date=T.DateType(),
    end_date=T.DateType(),
    status=T.VarcharType(50),
)

INVOICES = _table(
    "invoices",
    "invoice_id",
    {"amount"},
    invoice_id=T.VarcharType(20),
    subscription_id=T.VarcharType(20),
    invoice_date=T.DateType(),
    amount=T.DecimalType(10, 2),
    currency=T.VarcharType(10),
    status=T.VarcharType(50),
)

RAW_TABLES = {t.name: t for t in (CUSTOMERS, SUBSCRIPTIONS, INVOICES)}
