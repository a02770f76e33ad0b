"""Rules that the generated tables do not reach: NULLs, padded keys, ties, rounding."""

from decimal import Decimal

from billing import customer, day, invoice, one, rows, subscription
from pyspark.sql import functions as F


def test_null_currency_is_not_flagged_and_earns_nothing(models):
    m = models([customer()], [subscription()], [invoice(currency=None)])
    assert rows(m.issues_invoices) == []
    assert rows(m.int_paid_invoices_eur) == []


def test_null_status_is_not_flagged_and_never_churns(models):
    m = models([customer()], [subscription(end="2024-05-01", status=None)], [invoice(status=None)])
    assert rows(m.issues_subscriptions) == [] and rows(m.issues_invoices) == []
    assert one(m.int_subscriptions)["is_churn_eligible"] is None
    assert rows(m.subscription_churn) == []


def test_prices_and_amounts_that_withhold(models):
    m = models(
        [customer()],
        [subscription("S1"), subscription("S2", price=None), subscription("S3", price="0.00")],
        [
            invoice("I1", amount="0.00", status="open"),
            invoice("I2", amount=None, status="open"),
            invoice("I3", amount=None, status="PAID "),
            invoice("I4", sub="S2"),
            invoice("I5", amount="-5.00", status="failed"),
        ],
    )
    assert {r["subscription_id"] for r in rows(m.issues_subscriptions)} == {"S2", "S3"}
    found = {r["invoice_id"]: r for r in rows(m.issues_invoices)}
    assert set(found) == {"I1", "I3", "I4", "I5"}  # a missing amount matters only once paid
    assert all(r["excluded_from_marts"] for r in found.values())
    assert found["I3"]["has_null_paid_amount"] and found["I3"]["has_unnormalized_status"]
    assert found["I4"]["has_excluded_subscription"] and not found["I4"]["has_orphan_subscription"]


def test_null_foreign_key_is_an_orphan(models):
    m = models([customer()], [subscription("S1", owner=None)], [invoice("I1", sub=None)])
    assert one(m.issues_subscriptions)["has_orphan_customer"] is True
    assert one(m.issues_invoices)["has_orphan_subscription"] is True


def test_a_null_customer_key_does_not_adopt_null_owners(models):
    m = models([customer(key=None)], [subscription("S1", owner=None)])
    assert one(m.issues_subscriptions)["has_orphan_customer"] is True


def test_end_without_start_is_trusted(models):
    m = models(
        [customer()], [subscription(start=None, end="2024-05-01", status="cancelled")]
    )
    row = one(m.int_subscriptions)
    assert row["has_unreliable_end_date"] is False and row["is_churn_eligible"] is True


def test_end_before_start_leaves_churn_only(models):
    m = models(
        [customer()],
        [subscription(start="2024-05-01", end="2024-04-01", status="cancelled")],
        [invoice()],
    )
    assert rows(m.subscription_churn) == []
    assert one(m.fct_mrr)["mrr_eur"] == Decimal("29.00")
    assert one(m.issues_subscriptions)["excluded_from_marts"] is False


def test_not_in_over_an_excluded_null_keeps_nothing(models):
    m = models(
        [customer()], [subscription()], [invoice("I1"), invoice(None, amount="-1.00")]
    )
    assert rows(m.int_paid_invoices_eur) == []


def test_a_null_invoice_id_stays_only_while_nothing_is_excluded(models):
    clean = models([customer()], [subscription()], [invoice("I1"), invoice(None)])
    assert len(rows(clean.int_paid_invoices_eur)) == 2
    mixed = models(
        [customer()], [subscription()], [invoice("I1"), invoice(None), invoice("I2", amount="-1.00")]
    )
    assert [r["invoice_id"] for r in rows(mixed.int_paid_invoices_eur)] == ["I1"]


def test_null_keys_collapse_to_one_row(models):
    m = models(
        [customer(key=None, name="A"), customer(key=None, name="B"), customer("C1")],
        [subscription(None), subscription(None, plan="growth")],
    )
    assert len(rows(m.stg_customers)) == 2
    assert len(rows(m.stg_subscriptions)) == 1
    assert one(m.issues_subscriptions)["was_duplicated"] is True


def test_padded_labels_other_than_status_are_repaired_silently(models):
    m = models([customer()], [subscription(plan=" Growth ")], [invoice(currency=" sek ")])
    assert rows(m.issues_subscriptions) == [] and rows(m.issues_invoices) == []
    row = one(m.int_paid_invoices_eur)
    assert (row["plan_name"], row["currency"], row["amount_eur"]) == ("growth", "SEK", Decimal("2.52"))


def test_email_is_judged_as_it_arrived(models):
    mails = [" a@b.c", "a@b.c", "a@b", "a@b.c\n", "a b@c.d", "a@@b.c", None, ""]
    m = models([customer(f"C{i}", email=e) for i, e in enumerate(mails)])
    assert {r["customer_id"] for r in rows(m.issues_customers)} == {f"C{i}" for i in range(8)} - {"C1"}
    clean = {r["customer_id"]: r["email"] for r in rows(m.stg_customers)}
    assert clean["C0"] == "a@b.c"


def test_blank_country_is_labelled_and_flagged(models):
    m = models([customer("C1", country=""), customer("C2", country="  "), customer("C3", country=None),
                customer("C4", country=" se")])
    assert {r["customer_id"]: r["country"] for r in rows(m.stg_customers)} == {
        "C1": "UNKNOWN", "C2": "UNKNOWN", "C3": "UNKNOWN", "C4": "SE"}
    assert {r["customer_id"] for r in rows(m.issues_customers)} == {"C1", "C2", "C3"}


def test_future_customer_is_flagged_but_kept(models):
    m = models([customer(created="2026-09-02")], as_of="2026-09-01")
    flagged = one(m.issues_customers)
    assert flagged["is_future_created"] and flagged["excluded_from_marts"] is False
    assert one(m.customer_ltv)["total_revenue_eur"] == 0


def test_a_padded_id_escapes_quarantine_unless_keys_are_normalised(models):
    data = dict(
        customers=[customer()],
        subscriptions=[subscription("S1 ", price="-1.00")],
        invoices=[invoice("I1", sub="S1")],
    )
    # The flags sit under 'S1 ', the staged row looks for 'S1'.
    assert len(rows(models(**data).int_subscriptions)) == 1
    assert rows(models(**data, normalize_keys=True).int_subscriptions) == []


def test_a_padded_copy_shares_the_fate_of_the_plain_id(models):
    m = models([customer()], [subscription("S1", price="-1.00"), subscription("S1 ", plan="scale")])
    assert rows(m.int_subscriptions) == []
    assert len(rows(m.stg_subscriptions)) == 2


def test_rounding_is_half_up_per_invoice(models):
    m = models(
        [customer()],
        [subscription()],
        # 0.50 SEK = 0.0435, 50.00 SEK = 4.35; 12.50 SEK = 1.0875 -> 1.09; 2.70115 -> 2.70
        [
            invoice("I1", amount="12.50", currency="SEK"),
            invoice("I2", amount="12.50", currency="SEK"),
            invoice("I3", amount="0.50", currency="SEK"),
        ],
    )
    assert one(m.fct_mrr)["mrr_eur"] == Decimal("2.22")  # 1.09 + 1.09 + 0.04, not round(2.2185)


def test_the_same_invoice_id_twice_counts_twice_and_goes_together(models):
    both = models([customer()], [subscription()], [invoice("I1"), invoice("I1", on="2024-04-05")])
    assert sum(r["paid_invoices"] for r in rows(both.fct_mrr)) == 2
    one_bad = models([customer()], [subscription()], [invoice("I1"), invoice("I1", amount="-1.00")])
    assert rows(one_bad.int_paid_invoices_eur) == []


def test_mrr_counts(models):
    m = models(
        [customer("C1"), customer("C2")],
        [subscription("S1"), subscription("S2"), subscription("S3", owner="C2")],
        [invoice("I1", "S1"), invoice("I2", "S1", on="2024-03-31"), invoice("I3", "S2"),
         invoice("I4", "S3"), invoice("I5", "S3", status="open"), invoice("I6", "S3", on="2024-04-01")],
    )
    march, april = sorted(rows(m.fct_mrr), key=lambda r: r["invoice_month"])
    assert march == {
        "invoice_month": day("2024-03-01"), "plan_name": "starter", "paid_invoices": 4,
        "paying_subscriptions": 3, "paying_customers": 2, "mrr_eur": Decimal("116.00")}
    assert april["paid_invoices"] == 1


def test_current_status_priorities(models):
    def pick(*subscriptions):
        return one(models([customer()], subscriptions).customer_ltv)["current_subscription_status"]

    assert pick(subscription("S1", start="2026-01-01", status="paused"),
                subscription("S2", start="2024-01-01")) == "active"
    assert pick(subscription("S1", start="2024-01-01", status="paused"),
                subscription("S2", start="2024-01-02", status="cancelled")) == "cancelled"
    assert pick(subscription("S2", status="paused"), subscription("S1", status="cancelled")) == "cancelled"
    assert pick(subscription("S1", status="paused"),
                subscription("S2", start=None, status="cancelled")) == "cancelled"
    assert pick(subscription("S1"), subscription("S2", status=None)) is None


def test_customer_without_subscription(models):
    row = one(models([customer()]).customer_ltv)
    assert row["total_revenue_eur"] == 0 and row["subscription_count"] == 0
    assert row["plan_mix"] is None and row["current_subscription_status"] is None


def test_plan_mix_is_sorted_and_distinct(models):
    m = models([customer()], [subscription("S1"), subscription("S2", plan="growth"),
                              subscription("S3", plan="STARTER"), subscription("S4", plan=None)])
    assert one(m.customer_ltv)["plan_mix"] == "growth, starter"
    empty = models([customer()], [subscription("S1", plan=None)])
    assert one(empty.customer_ltv)["plan_mix"] is None


def test_churn_of_the_running_month_is_not_future(models):
    m = models(
        [customer("C1"), customer("C2")],
        [subscription("S1", end="2026-09-30", status="cancelled"),
         subscription("S2", owner="C2", price="99.00", end="2026-09-01", status="Cancelled"),
         subscription("S3", end="2026-10-01", status="cancelled"),
         subscription("S4", end="2026-10-01")],
        as_of="2026-09-15",
    )
    september, october = sorted(rows(m.subscription_churn), key=lambda r: r["churn_month"])
    assert september == {
        "churn_month": day("2026-09-01"), "cancelled_subscriptions": 2, "churned_customers": 2,
        "mrr_lost_eur": Decimal("128.00"), "is_future_cancellation": False}
    assert october["is_future_cancellation"] and october["cancelled_subscriptions"] == 1


def test_callers_own_rates(models, spark):
    rates = spark.sql("SELECT 'EUR' AS currency, CAST(2 AS DECIMAL(10,4)) AS rate_to_eur")
    m = models([customer()], [subscription()], [invoice(amount="10.00")], rates=rates)
    assert one(m.fct_mrr)["mrr_eur"] == Decimal("20.00")


def test_survivor_of_a_dedupe_does_not_depend_on_order(models):
    a, b = subscription("S1", plan="scale"), subscription("S1", plan="growth")
    picks = [one(models([customer()], order).stg_subscriptions)["plan_name"] for order in ([a, b], [b, a])]
    assert picks == ["growth", "growth"]


def test_flagged_contains_excluded_and_every_customer_has_a_value(models):
    m = models([customer("C1"), customer("C1"), customer("C2")], [subscription(owner="C9")], [invoice()])
    assert m.issues_invoices.where("excluded_from_marts").count() == 1
    assert m.customer_ltv.count() == m.stg_customers.count() == 2
    assert m.int_paid_invoices_eur.where(F.lit(True)).count() == 0
