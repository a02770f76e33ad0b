"""The rules of this domain: warnings on raw, errors on the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.functions import as_of_date, is_blank, is_not_an_email, label
from ledgerline.models import Models
from ledgerline.operators import keyed, maybe_in
from ledgerline.quality.checks import (
    ERROR,
    WARN,
    Check,
    accepted_values,
    first_start_per_customer,
    frame_rule,
    not_null,
    relationships,
    row_rule,
    unique,
    unique_combination,
)
from ledgerline.schemas import CURRENCIES, INVOICE_STATUSES, PLANS, SUBSCRIPTION_STATUSES


def _not_positive(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) <= 0)


def country_present(customers: DataFrame) -> Check:
    return row_rule(
        "country_present",
        "customers",
        WARN,
        customers,
        is_blank("country"),
        ["customer_id", "customer_name", "country"],
    )


def email_valid(customers: DataFrame) -> Check:
    return row_rule(
        "email_valid",
        "customers",
        WARN,
        customers,
        is_not_an_email("email"),
        ["customer_id", "customer_name", "email"],
    )


def created_plausible(
    customers: DataFrame, subscriptions: DataFrame, as_of: dt.date | str | None = None
) -> Check:
    """Created neither in the future nor after the customer's own first subscription."""
    people = first_start_per_customer(customers, subscriptions)
    late = people.where(
        (F.col("created_at") > as_of_date(as_of))
        | (F.col("created_at") > F.col("earliest_subscription_start"))
    )
    return frame_rule("created_plausible", "customers", WARN, late)


def dates_chronological(subscriptions: DataFrame) -> Check:
    return row_rule(
        "dates_chronological",
        "subscriptions",
        WARN,
        subscriptions,
        F.col("end_date").isNotNull() & (F.col("end_date") < F.col("start_date")),
        ["subscription_id", "customer_id", "start_date", "end_date", "status"],
    )


def price_positive(subscriptions: DataFrame) -> Check:
    return row_rule(
        "price_positive",
        "subscriptions",
        WARN,
        subscriptions,
        _not_positive("monthly_price"),
        ["subscription_id", "customer_id", "plan_name", "monthly_price"],
    )


def paid_amount_valid(invoices: DataFrame) -> Check:
    return row_rule(
        "paid_amount_valid",
        "invoices",
        WARN,
        invoices,
        (label("status") == "paid") & _not_positive("amount"),
        ["invoice_id", "subscription_id", "invoice_date", "status", "amount", "currency"],
    )


def mart_non_negative(fct_mrr: DataFrame, customer_ltv: DataFrame, churn: DataFrame) -> Check:
    """No published figure below zero; a cancellation month must lose something."""

    def probe(model: str, frame: DataFrame, key: str, value: str, bad: Column) -> DataFrame:
        return frame.where(bad).select(
            F.lit(model).alias("model"),
            F.col(key).cast("string").alias("key"),
            F.col(value).alias("value"),
        )

    rows = (
        probe("fct_mrr", fct_mrr, "invoice_month", "mrr_eur", F.col("mrr_eur") < 0)
        .unionByName(
            probe(
                "customer_ltv",
                customer_ltv,
                "customer_id",
                "total_revenue_eur",
                F.col("total_revenue_eur") < 0,
            )
        )
        .unionByName(
            probe(
                "subscription_churn", churn, "churn_month", "mrr_lost_eur", F.col("mrr_lost_eur") <= 0
            )
        )
    )
    return frame_rule("mart_non_negative", "marts", ERROR, rows)


def revenue_totals(fct_mrr: DataFrame, customer_ltv: DataFrame) -> DataFrame:
    """Both marts' total revenue side by side: two one-row frames."""
    mrr = fct_mrr.agg(F.round(F.sum("mrr_eur"), 2).alias("fct_mrr_total_eur"))
    ltv = customer_ltv.agg(F.round(F.sum("total_revenue_eur"), 2).alias("customer_ltv_total_eur"))
    return mrr.crossJoin(ltv).withColumn(
        "difference_eur", F.col("fct_mrr_total_eur") - F.col("customer_ltv_total_eur")
    )


def mrr_equals_ltv(fct_mrr: DataFrame, customer_ltv: DataFrame) -> Check:
    """Both marts sum the same invoices; a difference means that a join multiplied rows."""
    rows = revenue_totals(fct_mrr, customer_ltv).where(
        ~F.col("fct_mrr_total_eur").eqNullSafe(F.col("customer_ltv_total_eur"))
    )
    return frame_rule("mrr_equals_ltv", "marts", ERROR, rows)


def no_quarantined_revenue(paid_invoices: DataFrame, issues_invoices: DataFrame) -> Check:
    """Revenue rows whose invoice is withheld.

    Every offending pair counts, as several withheld rows may share an invoice id. Sound revenue is
    nearly all of it and stops at the scan, by a bitmap of the withheld ids; the join is for the rest.
    """
    withheld = issues_invoices.where("excluded_from_marts")
    counted = keyed(withheld, "invoice_id", F.count(F.lit(1)).alias("n_records"))
    revenue = paid_invoices.select("invoice_id", "subscription_id", "amount_eur")
    rows = maybe_in(revenue, "invoice_id", withheld).join(counted, "invoice_id")
    return Check(
        "no_quarantined_revenue",
        "int_paid_invoices_eur",
        ERROR,
        rows,
        F.coalesce(F.sum("n_records"), F.lit(0)),
    )


def raw_checks(raw: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> list[Check]:
    customers, subscriptions, invoices = raw["customers"], raw["subscriptions"], raw["invoices"]
    return [
        not_null("customers", WARN, customers, "customer_id"),
        unique("customers", WARN, customers, "customer_id"),
        not_null("subscriptions", WARN, subscriptions, "subscription_id"),
        unique("subscriptions", WARN, subscriptions, "subscription_id"),
        not_null("subscriptions", WARN, subscriptions, "customer_id"),
        relationships(
            "subscriptions", WARN, subscriptions, "customer_id", customers, "customer_id"
        ),
        accepted_values("subscriptions", WARN, subscriptions, "plan_name", PLANS),
        accepted_values("subscriptions", WARN, subscriptions, "status", SUBSCRIPTION_STATUSES),
        not_null("invoices", WARN, invoices, "invoice_id"),
        unique("invoices", WARN, invoices, "invoice_id"),
        not_null("invoices", WARN, invoices, "subscription_id"),
        relationships(
            "invoices", WARN, invoices, "subscription_id", subscriptions, "subscription_id"
        ),
        accepted_values("invoices", WARN, invoices, "status", INVOICE_STATUSES),
        accepted_values("invoices", WARN, invoices, "currency", CURRENCIES),
        country_present(customers),
        created_plausible(customers, subscriptions, as_of),
        email_valid(customers),
        paid_amount_valid(invoices),
        dates_chronological(subscriptions),
        price_positive(subscriptions),
    ]


# Columns of the marts that must never be NULL.
REQUIRED = {
    "fct_mrr": ["invoice_month", "plan_name", "mrr_eur", "paid_invoices"],
    "customer_ltv": ["customer_id", "country", "total_revenue_eur", "subscription_count"],
    "subscription_churn": [
        "churn_month",
        "cancelled_subscriptions",
        "mrr_lost_eur",
        "is_future_cancellation",
    ],
}


def mart_checks(
    marts: dict[str, DataFrame], paid_invoices: DataFrame, issues_invoices: DataFrame
) -> list[Check]:
    mrr, ltv, churn = marts["fct_mrr"], marts["customer_ltv"], marts["subscription_churn"]
    required = [
        not_null(name, ERROR, marts[name], column)
        for name, columns in REQUIRED.items()
        for column in columns
    ]
    return required + [
        accepted_values("fct_mrr", ERROR, mrr, "plan_name", PLANS),
        unique_combination("fct_mrr", ERROR, mrr, ["invoice_month", "plan_name"]),
        unique("customer_ltv", ERROR, ltv, "customer_id"),
        accepted_values(
            "customer_ltv", ERROR, ltv, "current_subscription_status", SUBSCRIPTION_STATUSES
        ),
        unique("subscription_churn", ERROR, churn, "churn_month"),
        mart_non_negative(mrr, ltv, churn),
        mrr_equals_ltv(mrr, ltv),
        no_quarantined_revenue(paid_invoices, issues_invoices),
    ]


def quarantine_has_ids(issues_invoices: DataFrame) -> Check:
    """A withheld invoice without an id would silently empty the revenue (NOT IN over a NULL)."""
    return not_null(
        "excluded_invoices",
        ERROR,
        issues_invoices.where("excluded_from_marts").select("invoice_id"),
        "invoice_id",
    )


def rate_checks(rates: DataFrame) -> list[Check]:
    """One rate per currency: a second one would count its revenue twice."""
    return [
        not_null("int_fx_rates", ERROR, rates, "currency"),
        not_null("int_fx_rates", ERROR, rates, "rate_to_eur"),
        unique("int_fx_rates", ERROR, rates, "currency"),
    ]


def all_checks(models: Models) -> list[Check]:
    """All rules of the domain; rates are judged where a caller brought their own."""
    checks = raw_checks(models.raw_as_read, models.as_of) + mart_checks(
        models.marts, models.int_paid_invoices_eur, models.issues_invoices
    )
    return checks + (rate_checks(models.rates) if models.rates is not None else [])
