"""Staging: one clean row per key. Dates and amounts pass through as they arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.functions import code, country_label, label, text_key
from ledgerline.operators import first_per_key


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return first_per_key(raw_customers, "customer_id").select(
        text_key("customer_id").alias("customer_id"),
        text_key("customer_name").alias("customer_name"),
        label("email").alias("email"),
        country_label("country").alias("country"),
        "created_at",
    )


def stg_subscriptions(raw_subscriptions: DataFrame) -> DataFrame:
    return clean_subscriptions(first_per_key(raw_subscriptions, "subscription_id")).select(
        "subscription_id",
        "customer_id",
        "plan_name",
        "status",
        "monthly_price",
        "start_date",
        "end_date",
    )


def clean_subscriptions(subscriptions: DataFrame) -> DataFrame:
    """Normalise the labels of a subscription frame, leaving its other columns alone."""
    return subscriptions.withColumns(
        {
            "subscription_id": text_key("subscription_id"),
            "customer_id": text_key("customer_id"),
            "plan_name": label("plan_name"),
            "status": label("status"),
        }
    )


def stg_invoices(raw_invoices: DataFrame) -> DataFrame:
    """Not deduplicated: invoice ids are unique at the source, and a raw check watches that."""
    return raw_invoices.select(
        text_key("invoice_id").alias("invoice_id"),
        text_key("subscription_id").alias("subscription_id"),
        "invoice_date",
        "amount",
        code("currency").alias("currency"),
        label("status").alias("status"),
    )
