"""What the marts share: exchange rates, usable subscriptions, paid revenue in EUR."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerline.functions import month_of, text_key, to_eur
from ledgerline.operators import sql_not_in
from ledgerline.plans.staging import clean_subscriptions
from ledgerline.schemas import RATE, RATES_TO_EUR


def int_fx_rates(spark: SparkSession) -> DataFrame:
    """The built-in, undated rates to EUR. Inline values, so the optimiser knows there are two rows."""
    rows = ", ".join(f"('{c}', CAST('{r}' AS {RATE}))" for c, r in RATES_TO_EUR.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS fx(currency, rate_to_eur)")


def int_subscriptions(flagged_subscriptions: DataFrame) -> DataFrame:
    """Subscriptions that can be attributed and priced.

    Flags belong to the raw id and are looked up by the cleaned id, so a padded copy of an id takes
    the flags of the unpadded row, if there is one, and not its own. Both come from the same frame,
    which makes the lookup a window over the few spellings of one id instead of a self-join.
    """
    clean_id = text_key("subscription_id")
    owner = F.col("subscription_id") == clean_id
    # Partitioned by the hash as well, so that a later join does its own exchange (see `keyed`).
    spellings = Window.partitionBy(clean_id, F.xxhash64(clean_id))

    def flag_of_clean_id(flag: str):
        return F.coalesce(F.max(F.when(owner, F.col(flag))).over(spellings), F.lit(False))

    usable = flagged_subscriptions.select(
        "*",
        flag_of_clean_id("excluded_from_marts").alias("_withheld"),
        flag_of_clean_id("has_invalid_end_date").alias("has_unreliable_end_date"),
    ).where(~F.col("_withheld"))
    return clean_subscriptions(usable).select(
        "subscription_id",
        "customer_id",
        "plan_name",
        "monthly_price",
        "start_date",
        "end_date",
        "status",
        "has_unreliable_end_date",
        (
            (F.col("status") == "cancelled")
            & F.col("end_date").isNotNull()
            & ~F.col("has_unreliable_end_date")
        ).alias("is_churn_eligible"),
    )


def int_paid_invoices_eur(
    stg_invoices: DataFrame,
    issues_invoices: DataFrame,
    int_subscriptions: DataFrame,
    int_fx_rates: DataFrame,
) -> DataFrame:
    """Paid invoices in EUR without the withheld ones.

    The rate join comes first: it drops unsupported currencies before anything is shuffled.
    """
    priced = (
        stg_invoices.where(F.col("status") == "paid")
        .join(int_fx_rates.select("currency", "rate_to_eur"), "currency")
        .withColumn("amount_eur", to_eur("amount", "rate_to_eur"))
    )
    withheld = issues_invoices.where("excluded_from_marts").select("invoice_id")
    owners = int_subscriptions.select("subscription_id", "customer_id", "plan_name")
    return (
        sql_not_in(priced, "invoice_id", withheld)
        .join(owners, "subscription_id")
        .select(
            "invoice_id",
            "subscription_id",
            "customer_id",
            "plan_name",
            "invoice_date",
            month_of("invoice_date").alias("invoice_month"),
            "amount",
            "currency",
            "amount_eur",
        )
    )
