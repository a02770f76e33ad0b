"""All relations of a run, wired from the three raw tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ledgerline.functions import text_key
from ledgerline.plans import core, issues, marts, staging
from ledgerline.schemas import RAW_TABLES

KEY_COLUMNS = {
    "customers": ("customer_id",),
    "subscriptions": ("subscription_id", "customer_id"),
    "invoices": ("invoice_id", "subscription_id"),
}
MARTS = ("fct_mrr", "customer_ltv", "subscription_churn")
# What `build_together` builds at the same time, in order. `issues_invoices` brings `issues_subscriptions`
# and `flagged_invoices`.
WAVES = (
    ("flagged_subscriptions", "issues_customers"),
    ("int_subscriptions", "issues_invoices"),
    ("int_paid_invoices_eur", "subscription_churn"),
    ("fct_mrr", "customer_ltv"),
)


# What several marts and checks read.
SHARED = ("flagged_subscriptions", "issues_invoices", "int_subscriptions", "int_paid_invoices_eur")


class SharedRelations:
    """A `keep` under which the separate queries of a session compute what they share once.

    Spark knows a kept relation by what it computes, not by the frame it came from: another `Models` over
    the same tables, with the same options, reads it too. The rows are on the executors' disks, and those of
    a lost executor are computed again. The end of the `with` block lets go of all of them.
    """

    def __init__(self):
        self._kept: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        if name in SHARED:
            self._kept.append(df.persist(StorageLevel.DISK_ONLY))
        return df

    def __enter__(self) -> SharedRelations:
        return self

    def __exit__(self, *failure) -> None:
        while self._kept:
            self._kept.pop().unpersist()


class Models:
    """Lazy relations over `raw`; nothing runs until one is acted on.

    `keep` is applied to the marts, the issue tables and whatever several others read: the identity
    in a single query, a write to shared storage in a refresh, `SharedRelations` in a session of queries. With `normalize_keys` ids are trimmed before anything else;
    by default ids are compared as they arrived, and a padded id is an id of its own.

    With `reread_invoices` the flagged invoices are kept as well, and whatever reads raw invoices takes
    them from there. That pays where `raw` derives its invoices and `keep` writes: they are derived once.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        as_of: dt.date | str | None = None,
        *,
        rates: DataFrame | None = None,
        normalize_keys: bool = False,
        keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
        reread_invoices: bool = False,
    ):
        if normalize_keys:
            raw = {
                name: df.withColumns({c: text_key(c) for c in KEY_COLUMNS[name]})
                for name, df in raw.items()
            }
        self.raw, self.as_of, self.rates, self.keep = raw, as_of, rates, keep
        self.reread_invoices = reread_invoices

    @property
    def raw_as_read(self) -> Mapping[str, DataFrame]:
        """The rows of `raw`, the invoices from where they are kept."""
        if not self.reread_invoices:
            return self.raw
        invoices = self.flagged_invoices.select(*RAW_TABLES["invoices"].columns)
        return {name: invoices if name == "invoices" else self.raw[name] for name in self.raw}

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_subscriptions(self) -> DataFrame:
        return staging.stg_subscriptions(self.raw["subscriptions"])

    @cached_property
    def stg_invoices(self) -> DataFrame:
        return staging.stg_invoices(self.raw_as_read["invoices"])

    @cached_property
    def issues_customers(self) -> DataFrame:
        frame = issues.issues_customers(self.raw["customers"], self.as_of)
        return self.keep(frame, "issues_customers")

    @cached_property
    def flagged_subscriptions(self) -> DataFrame:
        frame = issues.flagged_subscriptions(self.raw["subscriptions"], self.raw["customers"])
        return self.keep(frame, "flagged_subscriptions")

    @cached_property
    def issues_subscriptions(self) -> DataFrame:
        frame = issues.issues_subscriptions(self.flagged_subscriptions)
        return self.keep(frame, "issues_subscriptions")

    @cached_property
    def flagged_invoices(self) -> DataFrame:
        frame = issues.flagged_invoices(
            self.raw["invoices"], self.raw["subscriptions"], self.issues_subscriptions, self.rates
        )
        return self.keep(frame, "flagged_invoices") if self.reread_invoices else frame

    @cached_property
    def issues_invoices(self) -> DataFrame:
        return self.keep(issues.issues_invoices(self.flagged_invoices), "issues_invoices")

    @cached_property
    def int_fx_rates(self) -> DataFrame:
        """The caller's rates, or the built-in two rows, which alone are broadcast by hint."""
        if self.rates is not None:
            return self.rates.select("currency", "rate_to_eur")
        return F.broadcast(core.int_fx_rates(self.raw["invoices"].sparkSession))

    @cached_property
    def int_subscriptions(self) -> DataFrame:
        frame = core.int_subscriptions(self.flagged_subscriptions)
        return self.keep(frame, "int_subscriptions")

    @cached_property
    def int_paid_invoices_eur(self) -> DataFrame:
        frame = core.int_paid_invoices_eur(
            self.stg_invoices, self.issues_invoices, self.int_subscriptions, self.int_fx_rates
        )
        return self.keep(frame, "int_paid_invoices_eur")

    @cached_property
    def fct_mrr(self) -> DataFrame:
        return self.keep(marts.fct_mrr(self.int_paid_invoices_eur), "fct_mrr")

    @cached_property
    def customer_ltv(self) -> DataFrame:
        frame = marts.customer_ltv(
            self.stg_customers, self.int_subscriptions, self.int_paid_invoices_eur
        )
        return self.keep(frame, "customer_ltv")

    @cached_property
    def subscription_churn(self) -> DataFrame:
        frame = marts.subscription_churn(self.int_subscriptions, self.as_of)
        return self.keep(frame, "subscription_churn")

    @property
    def issue_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in issues.FLAGS}

    @property
    def issue_summary(self) -> DataFrame:
        return issues.issue_summary(self.issue_tables)

    @property
    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MARTS}

    def build_together(self) -> None:
        """Act on all relations in waves, those of a wave at the same time.

        A relation is in the first wave whose predecessors hold all it reads, so it only reads what is
        written by then, and no two threads build the same one. Overlapping them fills the cluster
        while one is down to its last tasks.
        """
        build = inheritable_thread_target(self.raw["invoices"].sparkSession)(
            lambda name: getattr(self, name)
        )
        for wave in WAVES:
            with ThreadPoolExecutor(len(wave)) as pool:
                list(pool.map(build, wave))
