"""Issue tables: rows of the raw tables that break a rule, one boolean per rule.

Everything here reads raw, before staging could hide a defect. `excluded_from_marts` separates rows
that cannot be used from rows that are only reported.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import as_of_date, code, is_blank, is_not_an_email, is_unnormalised, label
from ledgerline.operators import any_of, first_per_key, keyed, union_all
from ledgerline.operators.keys import COPIES
from ledgerline.schemas import RATES_TO_EUR

CUSTOMER_FLAGS = [
    "was_duplicated",
    "has_missing_country",
    "has_invalid_email",
    "is_future_created",
]
SUBSCRIPTION_FLAGS = [
    "was_duplicated",
    "has_orphan_customer",
    "has_unnormalized_status",
    "has_invalid_end_date",
    "has_invalid_price",
]
INVOICE_FLAGS = [
    "has_orphan_subscription",
    "has_null_paid_amount",
    "has_non_positive_amount",
    "has_unnormalized_status",
    "has_unsupported_currency",
    "has_excluded_subscription",
]
FLAGS = {
    "issues_customers": CUSTOMER_FLAGS,
    "issues_subscriptions": SUBSCRIPTION_FLAGS,
    "issues_invoices": INVOICE_FLAGS,
}


def issues_customers(raw_customers: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Every customer defect is reported; none is a reason to withhold the customer."""
    one = first_per_key(raw_customers, "customer_id")
    return (
        one.select(
            "customer_id",
            "customer_name",
            "email",
            "country",
            "created_at",
            (F.col(COPIES) > 1).alias("was_duplicated"),
            is_blank("country").alias("has_missing_country"),
            is_not_an_email("email").alias("has_invalid_email"),
            (F.col("created_at") > as_of_date(as_of)).alias("is_future_created"),
        )
        .where(any_of(CUSTOMER_FLAGS))
        .withColumn("excluded_from_marts", F.lit(False))
    )


def flagged_subscriptions(raw_subscriptions: DataFrame, raw_customers: DataFrame) -> DataFrame:
    """One row per raw subscription id, sound or not, with its flags.

    Duplicates are counted before the join, and the join's unique side cannot fan out.
    """
    known = keyed(raw_customers, "customer_id")
    one = first_per_key(raw_subscriptions, "subscription_id")
    return one.join(known, "customer_id", "left").select(
        "subscription_id",
        "customer_id",
        "plan_name",
        "monthly_price",
        "start_date",
        "end_date",
        "status",
        (F.col(COPIES) > 1).alias("was_duplicated"),
        F.col("_found").isNull().alias("has_orphan_customer"),
        is_unnormalised("status").alias("has_unnormalized_status"),
        (F.col("end_date").isNotNull() & (F.col("end_date") < F.col("start_date"))).alias(
            "has_invalid_end_date"
        ),
        (F.col("monthly_price").isNull() | (F.col("monthly_price") <= 0)).alias("has_invalid_price"),
    ).withColumn("excluded_from_marts", any_of(["has_orphan_customer", "has_invalid_price"]))


def issues_subscriptions(flagged_subscriptions: DataFrame) -> DataFrame:
    return flagged_subscriptions.where(any_of(SUBSCRIPTION_FLAGS))


def flagged_invoices(
    raw_invoices: DataFrame,
    raw_subscriptions: DataFrame,
    issues_subscriptions: DataFrame,
    int_fx_rates: DataFrame | None = None,
) -> DataFrame:
    """Every raw invoice row, sound or not, with its flags, those of a withheld subscription included.

    Known ids and withheld ids are folded into one lookup first, so the large table is shuffled once.
    A currency is supported if `int_fx_rates` has a rate for it; without the argument, if the
    built-in rates have. A NULL currency is neither.
    """
    sightings = raw_subscriptions.select(
        "subscription_id", F.lit(True).alias("known"), F.lit(False).alias("withheld")
    ).unionByName(
        issues_subscriptions.where("excluded_from_marts").select(
            "subscription_id", F.lit(False).alias("known"), F.lit(True).alias("withheld")
        )
    )
    lookup = keyed(
        sightings,
        "subscription_id",
        F.max("known").alias("_known"),
        F.max("withheld").alias("_withheld"),
    )
    unsupported = ~code("currency").isin(*RATES_TO_EUR)
    if int_fx_rates is not None:
        rated = keyed(
            int_fx_rates.where("rate_to_eur IS NOT NULL").select(F.col("currency").alias("_rated")),
            "_rated",
            F.lit(True).alias("_supported"),
        )
        raw_invoices = raw_invoices.join(rated, code("currency") == F.col("_rated"), "left")
        unsupported = F.when(code("currency").isNotNull(), F.col("_supported").isNull())
    return (
        raw_invoices.join(lookup, "subscription_id", "left")
        .select(
            "invoice_id",
            "subscription_id",
            "invoice_date",
            "amount",
            "currency",
            "status",
            (~F.coalesce("_known", F.lit(False))).alias("has_orphan_subscription"),
            ((label("status") == "paid") & F.col("amount").isNull()).alias("has_null_paid_amount"),
            F.coalesce(F.col("amount") <= 0, F.lit(False)).alias("has_non_positive_amount"),
            is_unnormalised("status").alias("has_unnormalized_status"),
            unsupported.alias("has_unsupported_currency"),
            F.coalesce("_withheld", F.lit(False)).alias("has_excluded_subscription"),
        )
    )


def issues_invoices(flagged_invoices: DataFrame) -> DataFrame:
    """Invoice defects, including those inherited from a withheld subscription."""
    return flagged_invoices.where(any_of(INVOICE_FLAGS)).withColumn(
        "excluded_from_marts",
        any_of([f for f in INVOICE_FLAGS if f != "has_unnormalized_status"]),
    )


def issue_summary(issues: dict[str, DataFrame]) -> DataFrame:
    """Flagged and withheld rows per issue table and per rule, one pass over each table."""
    parts = []
    for name, frame in issues.items():
        counts = [("flagged", F.lit(True)), ("excluded_from_marts", F.col("excluded_from_marts"))]
        counts += [(flag, F.col(flag)) for flag in FLAGS[name]]
        totals = frame.agg(
            F.array(
                *[F.struct(F.lit(m).alias("measure"), F.count_if(c).alias("n_rows")) for m, c in counts]
            ).alias("totals")
        )
        parts.append(totals.select(F.lit(name).alias("issue_table"), F.inline("totals")))
    return union_all(parts)
