"""What each published table and column means; kept in the Parquet schema as column comments."""

from __future__ import annotations

from pyspark.sql import DataFrame

TABLES = {
    "customers": "One row per customer record the source sent, defects and repeats included.",
    "subscriptions": "One row per subscription record the source sent, defects and repeats included.",
    "invoices": "One row per invoice record the source sent, defects included.",
    "fct_mrr": "What paid invoices brought in, by invoice month and plan.",
    "customer_ltv": "What each customer has paid so far, what they hold, and how they stand.",
    "subscription_churn": "Subscriptions that ended, and the monthly price that went with them, by month.",
    "issues_customers": "Customer records with at least one defect, one flag per rule.",
    "issues_subscriptions": "Subscription records with at least one defect, one flag per rule.",
    "issues_invoices": "Invoice records with at least one defect, one flag per rule.",
}

COLUMNS = {
    "customers": {
        "customer_id": "Names a customer; nothing enforces that it does so once.",
        "email": "Mail address, unchecked.",
        "country": "ISO country code, or NULL.",
        "created_at": "Day the account was opened.",
    },
    "subscriptions": {
        "subscription_id": "Names a subscription; nothing enforces that it does so once.",
        "customer_id": "Who subscribes; the customer may be unknown.",
        "plan_name": "starter, growth or scale, in any spelling.",
        "monthly_price": "Euros a month.",
        "end_date": "Last day, for subscriptions that end.",
        "status": "active, cancelled or paused, in any spelling.",
    },
    "invoices": {
        "invoice_id": "Names an invoice.",
        "subscription_id": "What is billed; the subscription may be unknown.",
        "amount": "Billed amount in `currency`.",
        "currency": "EUR or SEK, in any spelling.",
        "status": "paid, open or failed, in any spelling.",
    },
    "fct_mrr": {
        "invoice_month": "Invoice date cut to its month.",
        "plan_name": "Plan of the billed subscription.",
        "paid_invoices": "How many invoices mrr_eur adds up.",
        "paying_subscriptions": "How many different subscriptions they bill.",
        "paying_customers": "How many different customers pay them.",
        "mrr_eur": "Their amounts in euros, each rounded to cents before adding.",
    },
    "customer_ltv": {
        "customer_id": "Unique here.",
        "customer_name": "Trimmed.",
        "country": "Upper case; UNKNOWN for NULL and blank.",
        "customer_since": "created_at of the raw record that was chosen.",
        "total_revenue_eur": "Paid euros up to now, 0 without any.",
        "paid_invoices": "How many invoices that is.",
        "first_paid_invoice_date": "Date of the first of them.",
        "last_paid_invoice_date": "Date of the last of them.",
        "subscription_count": "Subscriptions fit for use.",
        "active_subscriptions": "How many of those are active.",
        "plan_mix": "Their different plans, sorted and comma-separated.",
        "current_subscription_status": "active if one is; else the status of the youngest.",
    },
    "subscription_churn": {
        "churn_month": "End date cut to its month.",
        "cancelled_subscriptions": "How many subscriptions end in it, with a believable end date.",
        "churned_customers": "How many different customers held them.",
        "mrr_lost_eur": "Euros a month they paid together.",
        "is_future_cancellation": "Whether the month begins after the day of the run.",
    },
}


def with_comments(df: DataFrame, relation: str) -> DataFrame:
    for column, comment in COLUMNS.get(relation, {}).items():
        df = df.withMetadata(column, {"comment": comment})
    return df
