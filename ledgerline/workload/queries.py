"""The registered queries: every relation, check and operator over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.functions import (
    code,
    country_label,
    is_not_an_email,
    is_unnormalised,
    label,
    month_of,
    text_key,
    to_eur,
)
from ledgerline.models import Models
from ledgerline.operators import (
    current_status,
    first_per_key,
    keyed,
    sql_not_in,
    with_row_id,
)
from ledgerline.operators import union_all as stacked
from ledgerline.operators.keys import COPIES
from ledgerline.plans.core import int_fx_rates
from ledgerline.plans.issues import flagged_subscriptions
from ledgerline.quality import checks, reconcile, rules
from ledgerline.schemas import CURRENCIES, INVOICE_STATUSES, PLANS, SUBSCRIPTION_STATUSES
from ledgerline.session import configure, materialise, shared_dir
from ledgerline.workload.projection import AS_OF, RawTables, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _models(spark: SparkSession, sf_dir: str, **options) -> Models:
    configure(spark)
    return Models(RawTables(spark, sf_dir), AS_OF, **options)


def _raw(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return _models(spark, sf_dir).raw


# --- relations -------------------------------------------------------------------------------


@query
def raw_customers(spark, sf_dir):
    return _raw(spark, sf_dir)["customers"]


@query
def raw_subscriptions(spark, sf_dir):
    return _raw(spark, sf_dir)["subscriptions"]


@query
def raw_invoices(spark, sf_dir):
    return _raw(spark, sf_dir)["invoices"]


@query
def stg_customers(spark, sf_dir):
    return _models(spark, sf_dir).stg_customers


@query
def stg_subscriptions(spark, sf_dir):
    return _models(spark, sf_dir).stg_subscriptions


@query
def stg_invoices(spark, sf_dir):
    return _models(spark, sf_dir).stg_invoices


@query
def issues_customers(spark, sf_dir):
    return _models(spark, sf_dir).issues_customers


@query
def issues_subscriptions(spark, sf_dir):
    return _models(spark, sf_dir).issues_subscriptions


@query
def issues_invoices(spark, sf_dir):
    return _models(spark, sf_dir).issues_invoices


@query
def issue_summary(spark, sf_dir):
    return _models(spark, sf_dir).issue_summary


@query
def usable_subscriptions(spark, sf_dir):
    return _models(spark, sf_dir).int_subscriptions


@query
def paid_invoices_eur(spark, sf_dir):
    return _models(spark, sf_dir).int_paid_invoices_eur


@query
def mrr_by_month_plan(spark, sf_dir):
    return _models(spark, sf_dir).fct_mrr


@query
def customer_ltv(spark, sf_dir):
    return _models(spark, sf_dir).customer_ltv


@query
def subscription_churn(spark, sf_dir):
    return _models(spark, sf_dir).subscription_churn


# --- generic checks --------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    columns = {
        "customers": ["customer_id", "email", "country"],
        "subscriptions": ["subscription_id", "customer_id", "monthly_price", "end_date"],
        "invoices": ["invoice_id", "subscription_id", "amount"],
    }
    return checks.summarise(
        [
            checks.not_null(name, checks.WARN, raw[name], column)
            for name, names in columns.items()
            for column in names
        ]
    )


@query
def dq_unique(spark, sf_dir):
    keys = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_id"}
    raw = _raw(spark, sf_dir)
    return stacked(
        [
            checks.unique(name, checks.WARN, raw[name], key).rows.select(
                F.lit(name).alias("relation"), F.col(key).alias("value"), "n_records"
            )
            for name, key in keys.items()
        ]
    )


@query
def dq_relationships(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    links = [
        ("subscriptions", "customer_id", "customers"),
        ("invoices", "subscription_id", "subscriptions"),
    ]
    return stacked(
        [
            checks.relationships(
                name, checks.WARN, raw[name], column, raw[parent], column
            ).rows.select(
                F.lit(name).alias("relation"), F.col(column).alias("value"), "n_records"
            )
            for name, column, parent in links
        ]
    )


@query
def dq_accepted_values(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    lists = [
        ("subscriptions", "plan_name", PLANS),
        ("subscriptions", "status", SUBSCRIPTION_STATUSES),
        ("invoices", "status", INVOICE_STATUSES),
        ("invoices", "currency", CURRENCIES),
    ]
    return stacked(
        [
            checks.accepted_values(name, checks.WARN, raw[name], column, values).rows.select(
                F.lit(name).alias("relation"),
                F.lit(column).alias("column_name"),
                F.col(column).alias("value"),
                "n_records",
            )
            for name, column, values in lists
        ]
    )


@query
def dq_unique_combination(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pair = ["l_orderkey", "l_linenumber"]
    return checks.unique_combination("lineitem", checks.WARN, lines, pair).rows


# --- rules of the domain ---------------------------------------------------------------------


@query
def dq_country_present(spark, sf_dir):
    return rules.country_present(_raw(spark, sf_dir)["customers"]).rows


@query
def dq_email_valid(spark, sf_dir):
    return rules.email_valid(_raw(spark, sf_dir)["customers"]).rows


@query
def dq_created_plausible(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return rules.created_plausible(raw["customers"], raw["subscriptions"], AS_OF).rows


@query
def dq_dates_chronological(spark, sf_dir):
    return rules.dates_chronological(_raw(spark, sf_dir)["subscriptions"]).rows


@query
def dq_price_positive(spark, sf_dir):
    return rules.price_positive(_raw(spark, sf_dir)["subscriptions"]).rows


@query
def dq_paid_amount_valid(spark, sf_dir):
    return rules.paid_amount_valid(_raw(spark, sf_dir)["invoices"]).rows


@query
def dq_mart_non_negative(spark, sf_dir):
    m = _kept_models(spark, sf_dir)
    return rules.mart_non_negative(m.fct_mrr, m.customer_ltv, m.subscription_churn).rows


@query
def dq_mart_non_negative_probe(spark, sf_dir):
    """The smallest figure each mart publishes, so that the empty check above can be believed."""
    m = _kept_models(spark, sf_dir)
    figures = [
        ("fct_mrr", m.fct_mrr, "mrr_eur"),
        ("customer_ltv", m.customer_ltv, "total_revenue_eur"),
        ("subscription_churn", m.subscription_churn, "mrr_lost_eur"),
    ]
    return stacked(
        [
            frame.agg(F.count(F.lit(1)).alias("n_rows"), F.min(value).alias("smallest")).select(
                F.lit(name).alias("model"),
                "n_rows",
                F.col("smallest").cast("decimal(28,2)").alias("smallest"),
            )
            for name, frame, value in figures
        ]
    )


@query
def dq_mrr_ltv_reconcile(spark, sf_dir):
    m = _kept_models(spark, sf_dir)
    return rules.mrr_equals_ltv(m.fct_mrr, m.customer_ltv).rows.select(*_totals(28))


@query
def dq_mrr_ltv_reconcile_probe(spark, sf_dir):
    """Both totals, equal or not."""
    m = _kept_models(spark, sf_dir)
    return rules.revenue_totals(m.fct_mrr, m.customer_ltv).select(*_totals(28))


def _totals(precision: int):
    names = ["fct_mrr_total_eur", "customer_ltv_total_eur", "difference_eur"]
    return [F.col(n).cast(f"decimal({precision},2)").alias(n) for n in names]


@query
def dq_no_quarantined_revenue(spark, sf_dir):
    m = _kept_models(spark, sf_dir)
    return rules.no_quarantined_revenue(m.int_paid_invoices_eur, m.issues_invoices).rows.select(
        "invoice_id", "subscription_id", "amount_eur", "n_records"
    )


@query
def dq_no_quarantined_revenue_probe(spark, sf_dir):
    """The same join before the quarantine is applied, over every invoice twice: what it keeps out."""
    m = _models(spark, sf_dir)
    paid = m.stg_invoices.where(F.col("status") == "paid").withColumn(
        "amount_eur", F.col("amount")
    )
    twice = stacked([paid, paid])
    caught = rules.no_quarantined_revenue(twice, m.issues_invoices).rows
    return caught.agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.sum("n_records").alias("n_pairs"),
        F.count_if(F.col("amount_eur").isNull()).alias("n_without_amount"),
    )


def _kept_models(spark: SparkSession, sf_dir: str) -> Models:
    """Models whose shared relations are written once, when a query first names them."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    return _models(
        spark, sf_dir, keep=lambda df, name: materialise(df, name, folder), reread_invoices=True
    )


@query
def dq_suite_report(spark, sf_dir):
    models = _kept_models(spark, sf_dir)
    models.build_together()
    return checks.summarise(rules.all_checks(models))


@query
def dq_suite_totals(spark, sf_dir):
    return checks.totals(dq_suite_report(spark, sf_dir))


# --- source against copy ---------------------------------------------------------------------


@query
def raw_reconciliation(spark, sf_dir):
    """Projected tables against the copy an ingest would keep."""
    raw = _raw(spark, sf_dir)
    keys = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_id"}
    return stacked(
        [
            reconcile.compare(name, key, raw[name], with_row_id(raw[name]))
            for name, key in keys.items()
        ]
    )


@query
def raw_reconciliation_deduplicated(spark, sf_dir):
    """The same against a copy that silently dropped duplicates; it must not count as faithful."""
    raw = _raw(spark, sf_dir)
    keys = {"customers": "customer_id", "subscriptions": "subscription_id"}
    return stacked(
        [
            reconcile.compare(name, key, raw[name], first_per_key(raw[name], key))
            for name, key in keys.items()
        ]
    )


@query
def row_identity(spark, sf_dir):
    """Content ids of the raw customers: exact duplicates share one."""
    ids = with_row_id(_raw(spark, sf_dir)["customers"])
    return ids.groupBy(F.lower(F.hex("_row_id")).alias("row_id")).agg(
        F.count(F.lit(1)).alias("n_records"), F.min("customer_id").alias("customer_id")
    )


# --- operators one by one --------------------------------------------------------------------


@query
def dedupe_row_number(spark, sf_dir):
    return first_per_key(_raw(spark, sf_dir)["customers"], "customer_id").drop(COPIES)


@query
def distinct_on(spark, sf_dir):
    one = first_per_key(_raw(spark, sf_dir)["subscriptions"], "subscription_id")
    return one.withColumn("was_duplicated", F.col(COPIES) > 1).drop(COPIES)


@query
def window_dup_count(spark, sf_dir):
    """Rows per key, as a count over the key's partition."""
    one = first_per_key(_raw(spark, sf_dir)["subscriptions"], "subscription_id")
    return one.select("subscription_id", F.col(COPIES).alias("n_records")).where("n_records > 1")


@query
def priority_pick(spark, sf_dir):
    subscriptions = _models(spark, sf_dir).stg_subscriptions
    return subscriptions.groupBy("customer_id").agg(current_status().alias("current_status"))


@query
def orphan_flag(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    known = keyed(raw["customers"], "customer_id")
    return raw["subscriptions"].join(known, "customer_id", "left").select(
        "subscription_id", "customer_id", F.col("_found").isNull().alias("has_orphan_customer")
    )


@query
def member_flag(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    flagged = flagged_subscriptions(raw["subscriptions"], raw["customers"])
    withheld = keyed(flagged.where("excluded_from_marts"), "subscription_id")
    return raw["invoices"].join(withheld, "subscription_id", "left").select(
        "invoice_id", F.col("_found").isNotNull().alias("has_excluded_subscription")
    )


@query
def left_join_chain(spark, sf_dir):
    """Customers with two pre-aggregated sides, each possibly missing."""
    m = _models(spark, sf_dir)
    held = m.stg_subscriptions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_subscriptions"), F.sum("monthly_price").alias("list_price")
    )
    ended = (
        m.stg_subscriptions.where(F.col("status") == "cancelled")
        .groupBy("customer_id")
        .agg(F.max("end_date").alias("last_end_date"))
    )
    return (
        m.stg_customers.join(held, "customer_id", "left")
        .join(ended, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce("n_subscriptions", F.lit(0)).alias("n_subscriptions"),
            F.coalesce("list_price", F.lit(0)).alias("list_price"),
            "last_end_date",
        )
    )


@query
def null_aware_anti(spark, sf_dir):
    """Customers whose e-mail is not among those of customers without a country.

    A missing e-mail on either side follows NOT IN: it can never be told apart.
    """
    customers = _raw(spark, sf_dir)["customers"]
    nowhere = customers.where(F.col("country").isNull() & F.col("email").isNotNull())
    return sql_not_in(customers, "email", nowhere.select("email")).select("customer_id", "email")


@query
def null_aware_anti_with_null(spark, sf_dir):
    """One NULL in the excluded set leaves nothing."""
    customers = _raw(spark, sf_dir)["customers"]
    return sql_not_in(customers, "country", customers.select("country")).select("customer_id")


@query
def broadcast_fx(spark, sf_dir):
    invoices = _models(spark, sf_dir).stg_invoices
    rates = F.broadcast(int_fx_rates(spark))
    return (
        invoices.join(rates, "currency")
        .groupBy("currency")
        .agg(
            F.count(F.lit(1)).alias("n_invoices"),
            F.sum("amount").cast("decimal(28,2)").alias("amount"),
            F.sum(to_eur("amount", "rate_to_eur")).alias("amount_eur"),
        )
    )


@query
def fx_round(spark, sf_dir):
    invoices = _models(spark, sf_dir).stg_invoices
    return invoices.join(F.broadcast(int_fx_rates(spark)), "currency").select(
        "invoice_id", "currency", "amount", to_eur("amount", "rate_to_eur").alias("amount_eur")
    )


@query
def cross_totals(spark, sf_dir):
    """Two one-row totals side by side."""
    raw = _raw(spark, sf_dir)
    prices = raw["subscriptions"].agg(F.sum("monthly_price").alias("price_total"))
    people = raw["customers"].agg(F.count_distinct("customer_id").alias("n_customers"))
    return prices.crossJoin(people)


@query
def agg_before_left_join(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return checks.first_start_per_customer(raw["customers"], raw["subscriptions"])


@query
def multi_count_distinct(spark, sf_dir):
    invoices = _models(spark, sf_dir).stg_invoices
    return invoices.groupBy("currency", "status").agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.count_distinct("subscription_id").alias("n_subscriptions"),
        F.count_distinct("invoice_date").alias("n_days"),
    )


@query
def filtered_count(spark, sf_dir):
    subscriptions = _models(spark, sf_dir).stg_subscriptions
    return subscriptions.groupBy("plan_name").agg(
        F.count(F.lit(1)).alias("n_subscriptions"),
        F.count_if(F.col("status") == "active").alias("n_active"),
        F.count_if(F.col("monthly_price").isNull()).alias("n_without_price"),
    )


@query
def ordered_distinct_string_agg(spark, sf_dir):
    subscriptions = _models(spark, sf_dir).stg_subscriptions
    mix = "listagg(DISTINCT plan_name, ', ') WITHIN GROUP (ORDER BY plan_name)"
    return subscriptions.groupBy("customer_id").agg(F.expr(mix).alias("plan_mix"))


@query
def having(spark, sf_dir):
    """Customers holding more than 14 subscriptions, the first of them from before March 1995."""
    subscriptions = _models(spark, sf_dir).stg_subscriptions
    return (
        subscriptions.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("start_date").alias("first_start"))
        .where((F.col("n") > 14) & (F.col("first_start") < F.lit("1995-03-01").cast("date")))
    )


@query
def union_all(spark, sf_dir):
    """Non-positive figures of two tables as (source, key, value, day)."""
    raw = _raw(spark, sf_dir)
    return (
        raw["subscriptions"]
        .where(F.col("monthly_price") <= 0)
        .select(
            F.lit("subscriptions").alias("source"),
            F.col("subscription_id").alias("key"),
            F.col("monthly_price").cast("decimal(18,2)").alias("value"),
            F.col("start_date").cast("string").alias("day"),
        )
        .unionByName(
            raw["invoices"]
            .where(F.col("amount") <= 0)
            .select(
                F.lit("invoices").alias("source"),
                F.col("invoice_id").alias("key"),
                F.col("amount").cast("decimal(18,2)").alias("value"),
                F.col("invoice_date").cast("string").alias("day"),
            )
        )
    )


@query
def month_trunc(spark, sf_dir):
    invoices = _models(spark, sf_dir).stg_invoices
    return (
        invoices.withColumn("invoice_month", month_of("invoice_date"))
        .groupBy("invoice_month")
        .agg(
            F.count(F.lit(1)).alias("n_invoices"),
            F.min("invoice_date").alias("first_day"),
            F.max("invoice_date").alias("last_day"),
        )
    )


@query
def label_repair(spark, sf_dir):
    return _raw(spark, sf_dir)["customers"].select(
        "customer_id",
        country_label("country").alias("country"),
        text_key("customer_name").alias("customer_name"),
        label("email").alias("email"),
    )


@query
def email_regex(spark, sf_dir):
    return _raw(spark, sf_dir)["customers"].select(
        "customer_id", "email", is_not_an_email("email").alias("has_invalid_email")
    )


@query
def distinct_from(spark, sf_dir):
    """Values that cleaning changes; NULL and a repaired NULL count as different."""
    customers = _raw(spark, sf_dir)["customers"]
    return customers.where(
        ~F.col("country").eqNullSafe(country_label("country"))
        | ~F.col("customer_name").eqNullSafe(text_key("customer_name"))
    ).select("customer_id", "customer_name", "country")


@query
def null_logic(spark, sf_dir):
    """AND, OR and NOT over nullable flags, and how many rows show each combination."""
    invoices = _raw(spark, sf_dir)["invoices"]
    low, dirty = F.col("amount") <= 0, is_unnormalised("status")
    foreign = ~code("currency").isin(*CURRENCIES)
    return (
        invoices.select(
            low.alias("is_low"),
            dirty.alias("is_dirty"),
            foreign.alias("is_foreign"),
            (low | dirty).alias("low_or_dirty"),
            (low & dirty).alias("low_and_dirty"),
            (~low).alias("not_low"),
        )
        .groupBy("is_low", "is_dirty", "is_foreign", "low_or_dirty", "low_and_dirty", "not_low")
        .agg(F.count(F.lit(1)).alias("n_invoices"))
    )


@query
def global_totals(spark, sf_dir):
    invoices = _raw(spark, sf_dir)["invoices"]
    return invoices.agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.count_distinct("invoice_id").alias("n_keys"),
        F.sum("amount").cast("decimal(28,2)").alias("amount"),
        F.min("invoice_date").alias("first_day"),
        F.max("invoice_date").alias("last_day"),
    )
