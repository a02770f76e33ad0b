"""The three published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import as_of_date, month_of
from ledgerline.operators import current_status


def fct_mrr(paid_invoices: DataFrame) -> DataFrame:
    """Recognised revenue by month and plan. A month in which a plan sold nothing has no row."""
    return paid_invoices.groupBy("invoice_month", "plan_name").agg(
        F.count(F.lit(1)).alias("paid_invoices"),
        F.count_distinct("subscription_id").alias("paying_subscriptions"),
        F.count_distinct("customer_id").alias("paying_customers"),
        F.sum("amount_eur").alias("mrr_eur"),
    )


def customer_ltv(
    stg_customers: DataFrame, int_subscriptions: DataFrame, paid_invoices: DataFrame
) -> DataFrame:
    """Lifetime value of every customer, those who never paid included.

    Both other inputs are reduced to one row per customer before the joins.
    """
    revenue = paid_invoices.groupBy("customer_id").agg(
        F.sum("amount_eur").alias("total_revenue_eur"),
        F.count(F.lit(1)).alias("paid_invoices"),
        F.min("invoice_date").alias("first_paid_invoice_date"),
        F.max("invoice_date").alias("last_paid_invoice_date"),
    )
    holdings = int_subscriptions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        F.count_if(F.col("status") == "active").alias("active_subscriptions"),
        F.expr("listagg(DISTINCT plan_name, ', ') WITHIN GROUP (ORDER BY plan_name)").alias(
            "plan_mix"
        ),
        current_status().alias("current_subscription_status"),
    )

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return (
        stg_customers.join(revenue, "customer_id", "left")
        .join(holdings, "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "country",
            F.col("created_at").alias("customer_since"),
            or_zero("total_revenue_eur"),
            or_zero("paid_invoices"),
            "first_paid_invoice_date",
            "last_paid_invoice_date",
            or_zero("subscription_count"),
            or_zero("active_subscriptions"),
            "plan_mix",
            "current_subscription_status",
        )
    )


def subscription_churn(
    int_subscriptions: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """Cancellations and the monthly revenue they end, by month. Months ahead are kept and marked."""
    return (
        int_subscriptions.where("is_churn_eligible")
        .withColumn("churn_month", month_of("end_date"))
        .groupBy("churn_month")
        .agg(
            F.count(F.lit(1)).alias("cancelled_subscriptions"),
            F.count_distinct("customer_id").alias("churned_customers"),
            F.sum("monthly_price").alias("mrr_lost_eur"),
        )
        .withColumn("is_future_cancellation", F.col("churn_month") > as_of_date(as_of))
    )
