"""Rows of the billing tables for tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

CUSTOMERS = "customer_id string, customer_name string, email string, country string, created_at date"
SUBSCRIPTIONS = (
    "subscription_id string, customer_id string, plan_name string, monthly_price decimal(10,2),"
    " start_date date, end_date date, status string"
)
INVOICES = (
    "invoice_id string, subscription_id string, invoice_date date, amount decimal(10,2),"
    " currency string, status string"
)


def day(text: str | None) -> dt.date | None:
    return None if text is None else dt.date.fromisoformat(text)


def money(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def customer(key="C1", name="Ann", email="ann@example.com", country="SE", created="2024-01-01"):
    return (key, name, email, country, day(created))


def subscription(
    key="S1", owner="C1", plan="starter", price="29.00", start="2024-02-01", end=None, status="active"
):
    return (key, owner, plan, money(price), day(start), day(end), status)


def invoice(key="I1", sub="S1", on="2024-03-05", amount="29.00", currency="EUR", status="paid"):
    return (key, sub, day(on), money(amount), currency, status)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def one(df) -> dict:
    found = rows(df)
    assert len(found) == 1, found
    return found[0]
