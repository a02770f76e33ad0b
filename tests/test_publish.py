"""A refresh end to end: the planted defects of a small seed, and what stops a publication."""

from decimal import Decimal

import pytest
from billing import customer, invoice, rows, subscription
from pyspark.sql import functions as F

from ledgerline.errors import IngestError, MartContractError, RawValidationError
from ledgerline.publish import load_raw, refresh, resolve_target
from ledgerline.publish.versions import Versions
from ledgerline.quality import checks, reconcile

# One row per defect class.
CUSTOMERS = [
    customer("C1"),
    customer("C2"),
    customer("C2"),
    customer("C3", country=None),
    customer("C4", email="not-an-email"),
    customer("C5", created="2027-01-01"),
]
SUBSCRIPTIONS = [
    subscription("S1"),
    subscription("S2", "C2", plan="growth", price="99.00"),
    subscription("S2", "C2", plan="growth", price="99.00"),
    subscription("S3", "C9"),
    subscription("S4", "C3", status="ACTIVE"),
    subscription("S5", "C4", start="2024-06-01", end="2024-05-01", status="cancelled"),
    subscription("S6", "C4", price="-99.00"),
    subscription("S7", "C5", end="2027-01-15", status="cancelled", start="2027-01-02"),
]
INVOICES = [
    invoice("I1", "S1"),
    invoice("I2", "S2", amount="99.00", status="PAID "),
    invoice("I3", "S9"),
    invoice("I4", "S1", amount=None),
    invoice("I5", "S6", amount="-99.00"),
    invoice("I6", "S4", amount="299.00", currency="SEK"),
    invoice("I7", "S5", status="open"),
    invoice("I8", "S1", on="2024-04-05", status="failed"),
]


@pytest.fixture
def sources(raw):
    return raw(CUSTOMERS, SUBSCRIPTIONS, INVOICES)


def test_refresh(spark, raw, tmp_path):
    base, sources = str(tmp_path), raw(CUSTOMERS, SUBSCRIPTIONS, INVOICES)
    done = refresh(spark, sources, base, as_of="2026-09-01", run_id="one",
                   expected_rows={"customers": 6, "subscriptions": 8, "invoices": 8})

    summary = {r["check_name"]: r for r in rows(done.checks)}
    outcome = {name: r["outcome"] for name, r in summary.items()}
    assert sorted(n for n, o in outcome.items() if o == "warn") == sorted([
        "unique_customers_customer_id", "unique_subscriptions_subscription_id",
        "relationships_subscriptions_customer_id", "relationships_invoices_subscription_id",
        "accepted_values_subscriptions_status", "accepted_values_invoices_status",
        "country_present", "created_plausible", "email_valid", "paid_amount_valid",
        "dates_chronological", "price_positive"])
    assert list(outcome.values()).count("pass") == 29  # 28 and the guard on the quarantine
    assert "error" not in outcome.values()

    versions = Versions(spark, f"{base}/dev")
    mrr = rows(versions.read("fct_mrr"))
    assert sum(r["mrr_eur"] for r in mrr) == Decimal("29.00") + Decimal("99.00") + Decimal("26.01")
    assert {r["customer_id"] for r in rows(versions.read("issues_customers"))} == {"C2", "C3", "C4", "C5"}
    assert {r["subscription_id"] for r in rows(versions.read("issues_subscriptions")) if r["excluded_from_marts"]} == {"S3", "S6"}
    assert rows(spark.table("billing_dev.subscription_churn"))[0]["is_future_cancellation"] is True
    comment = versions.read("customer_ltv").schema["country"].metadata["comment"]
    assert "UNKNOWN" in comment
    described = rows(spark.sql("DESCRIBE TABLE EXTENDED billing_dev.customer_ltv"))
    assert {r["col_name"]: r["comment"] for r in described}["country"] == comment
    assert any("has paid so far" in (r["data_type"] or "") for r in described)
    assert done.raw_counts["customers"]["n_duplicates"] == 1

    # Again, under a new id: the same state.
    refresh(spark, sources, base, as_of="2026-09-01", run_id="two")
    assert run_of(versions, "fct_mrr") == "two"
    assert sorted(map(str, rows(versions.read("fct_mrr")))) == sorted(map(str, mrr))
    assert Versions(spark, f"{base}/raw").read("customers").count() == 6

    # A broken contract leaves the previous version in place; so does a NULL in the quarantine.
    bad_plan = raw(CUSTOMERS, [subscription("S1", plan="platinum")], [invoice()])
    with pytest.raises(MartContractError, match=r"accepted_values_fct_mrr_plan_name \(1\)"):
        refresh(spark, bad_plan, base, as_of="2026-09-01", run_id="three")
    assert run_of(versions, "fct_mrr") == "two"

    # The same under the id that is published: neither the log nor the view moves.
    with pytest.raises(MartContractError, match="accepted_values_fct_mrr_plan_name"):
        refresh(spark, bad_plan, base, as_of="2026-09-01", run_id="two")
    for frame in (versions.read("fct_mrr"), spark.table("billing_dev.fct_mrr")):
        assert sorted(map(str, rows(frame))) == sorted(map(str, mrr))
    raw_versions = Versions(spark, f"{base}/raw")
    before = raw_versions.current()
    nameless = {**sources, "customers": sources["customers"].withColumn("customer_id", F.lit(None).cast("string"))}
    with pytest.raises(RawValidationError):
        load_raw(spark, nameless, base, "two")
    assert raw_versions.current() == before and raw_versions.read("subscriptions").count() == 1


def run_of(versions, relation):
    return versions.current()[relation].split("/")[-2].split("-")[0]


def test_interleaved_refreshes_read_their_own_raw(spark, raw, tmp_path, monkeypatch):
    """While one run builds its marts, another replaces raw; the first must not see it."""
    import sys

    module = sys.modules["ledgerline.publish.refresh"]
    base, other = str(tmp_path), raw([customer("C9")], [subscription("S9", "C9")], [invoice("I9", "S9", amount="1.00")])
    load = module.load_raw

    def load_and_be_overtaken(*args):
        loaded = load(*args)
        load(spark, other, base, "overtaking")
        return loaded

    monkeypatch.setattr(module, "load_raw", load_and_be_overtaken)
    refresh(spark, raw([customer()], [subscription()], [invoice()]), base, as_of="2026-09-01")
    assert [r["mrr_eur"] for r in rows(Versions(spark, f"{base}/dev").read("fct_mrr"))] == [Decimal("29.00")]
    assert run_of(Versions(spark, f"{base}/raw"), "customers") == "overtaking"


def test_a_slow_run_keeps_its_raw_copy(spark, raw, tmp_path, monkeypatch):
    """While one run builds its marts, three others load, publish and clean up with keep_runs=1."""
    import os
    import sys

    module = sys.modules["ledgerline.publish.refresh"]
    base, other = str(tmp_path), raw([customer("C9")], [subscription("S9", "C9")], [invoice("I9", "S9", amount="1.00")])
    load, run = module.load_raw, module.refresh
    overtaken = []

    def load_and_be_overtaken(*args):
        loaded = load(*args)
        if not overtaken:
            overtaken.append(args[3])
            for k in range(3):
                run(spark, other, base, target="prod", as_of="2026-09-01", run_id=f"fast{k}", keep_runs=1)
        return loaded

    monkeypatch.setattr(module, "load_raw", load_and_be_overtaken)
    refresh(spark, raw([customer()], [subscription()], [invoice()]), base, as_of="2026-09-01", run_id="slow", keep_runs=1)
    assert overtaken == ["slow"]
    assert [r["mrr_eur"] for r in rows(Versions(spark, f"{base}/dev").read("fct_mrr"))] == [Decimal("29.00")]
    assert [r["mrr_eur"] for r in rows(Versions(spark, f"{base}/prod").read("fct_mrr"))] == [Decimal("1.00")]
    # With its lease the slow run's raw copy went, too.
    left = [d for d in os.listdir(f"{base}/raw/_runs") if not d.startswith(".")]
    assert len(left) == 1 and left[0].startswith("fast2-")


def test_leases_end_by_themselves(spark, tmp_path):
    import time

    from ledgerline.publish.leases import Lease, held

    folder = f"{tmp_path}/_leases"
    with Lease(spark, folder, "a", renew_every=0.2), Lease(spark, folder, "a", renew_every=60):
        time.sleep(1.2)
        # The first is renewed, whatever the age of the other.
        assert held(spark, folder, lease_for=1.0) == {"a"}
    assert held(spark, folder, lease_for=60) == set()
    crashed = Lease(spark, folder, "b", renew_every=60)
    crashed.storage.touch(crashed.path)
    assert held(spark, folder, lease_for=60) == {"b"}
    time.sleep(1.2)
    assert held(spark, folder, lease_for=1.0) == set()


def test_readers_stay_with_one_run(spark, raw, tmp_path):
    base = str(tmp_path)
    one = raw([customer()], [subscription()], [invoice()])
    two = raw([customer("C2")], [subscription("S2", "C2")], [invoice("I2", "S2", amount="7.00")])
    refresh(spark, one, base, as_of="2026-09-01", run_id="one", keep_runs=1)
    versions = Versions(spark, f"{base}/dev")
    pointer = rows(spark.table("billing_dev.current_run"))
    assert [r["run_id"] for r in pointer] == ["one"]
    database = pointer[0]["database_name"]

    with versions.reading() as tables:
        first = rows(tables["fct_mrr"])
        refresh(spark, two, base, as_of="2026-09-01", run_id="two", keep_runs=1)
        # A loop over the tables, by paths or by the database it was given, sees the first run to its end.
        assert [r["mrr_eur"] for r in first] == [Decimal("29.00")]
        assert [r["customer_id"] for r in rows(tables["customer_ltv"])] == ["C1"]
        assert [r["customer_id"] for r in rows(spark.table(f"{database}.customer_ltv"))] == ["C1"]
        assert [r["mrr_eur"] for r in rows(spark.table(f"{database}.fct_mrr"))] == [Decimal("29.00")]
    assert [r["run_id"] for r in rows(spark.table("billing_dev.current_run"))] == ["two"]
    assert [r["customer_id"] for r in rows(spark.table("billing_dev.customer_ltv"))] == ["C2"]

    # Without a reader, the next run clears the first one away, in the catalog as well.
    refresh(spark, two, base, as_of="2026-09-01", run_id="three", keep_runs=1)
    left = [r[0] for r in spark.sql("SHOW DATABASES LIKE 'billing_dev__*'").collect()]
    assert len(left) == 1 and left[0].startswith("billing_dev__three_")


def test_revenue_is_stored_by_month(spark, raw, tmp_path):
    import os

    months = [f"2024-{m:02}-05" for m in range(1, 7)]
    subscriptions = [subscription(f"S{k}", plan=p) for k, p in enumerate(("starter", "growth", "scale"))]
    invoices = [invoice(f"I{m}-{k}", f"S{k % 3}", on=day) for m, day in enumerate(months) for k in range(30)]
    base = str(tmp_path)
    refresh(spark, raw([customer()], subscriptions, invoices), base, as_of="2026-09-01")
    versions = Versions(spark, f"{base}/dev")
    folder = versions.current()["fct_mrr"]
    by_month = {d: [f for f in os.listdir(f"{folder}/{d}") if f.endswith(".parquet")] for d in os.listdir(folder) if "=" in d}
    assert len(by_month) == 6 and {len(files) for files in by_month.values()} == {1}

    for march in (versions.read("fct_mrr"), spark.table("billing_dev.fct_mrr")):
        assert march.columns[0] == "invoice_month" and march.schema["invoice_month"].metadata["comment"]
        march = march.where("invoice_month = DATE '2024-03-01'")
        assert march.count() == 3 and march.agg(F.sum("paid_invoices")).first()[0] == 30
        plan = march._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(invoice_month" in plan, plan
        scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
        assert "2024-03-01" in scan or "19783" in scan


def test_a_hot_month_is_written_by_several_tasks(spark, tmp_path):
    import os

    names = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        paid = spark.range(60_000).repartition(6).selectExpr(
            "uuid() AS invoice_id", "add_months(DATE '2024-01-01', IF(id % 3 = 0, 5, CAST(id % 12 AS INT))) AS invoice_month"
        )
        paid = paid.unionByName(spark.range(1000).selectExpr("uuid() AS invoice_id", "CAST(NULL AS DATE) AS invoice_month"))
        versions = Versions(spark, str(tmp_path))
        stored = versions.stage(paid, "a", "int_paid_invoices_eur")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    files = {d: [f for f in os.listdir(f"{tmp_path}/_runs/a/int_paid_invoices_eur/{d}") if f.endswith(".parquet")]
             for d in os.listdir(f"{tmp_path}/_runs/a/int_paid_invoices_eur") if "=" in d}
    hot = "invoice_month=2024-06-01"
    assert len(files) == 9 and len(files[hot]) >= 4
    assert stored.where("invoice_month IS NULL").count() == 1000
    assert stored.count() == 61_000 and stored.columns == ["invoice_id", "invoice_month"]


def test_an_empty_mart_can_be_read(spark, raw, tmp_path):
    versions = Versions(spark, f"{tmp_path}/x")
    empty = spark.createDataFrame(
        [],
        "invoice_month date, plan_name string, paid_invoices long, paying_subscriptions long,"
        " paying_customers long, mrr_eur decimal(28,2)",
    )
    versions.stage(empty, "a", "fct_mrr")
    versions.publish("r", "a", ["fct_mrr"])
    versions.create_views("billing_empty")
    for frame in (Versions(spark, f"{tmp_path}/x").read("fct_mrr"), spark.table("billing_empty.fct_mrr")):
        assert frame.columns == empty.columns and frame.count() == 0


def test_a_source_that_loses_rows_between_count_and_extract_is_caught(spark, sources, tmp_path):
    """The copy is a faithful one of what was read, but not of what the source had counted."""
    base = str(tmp_path)
    counts = {"invoices": spark.createDataFrame([(9, 9)], "n_rows long, n_keys long")}
    with pytest.raises(RawValidationError, match=r"invoices\[source n_rows\]: counted 9, read 8"):
        load_raw(spark, sources, base, "a", source_counts=counts)
    assert Versions(spark, f"{base}/raw").current() == {}
    counts = {"invoices": spark.createDataFrame([(8, 8)], "n_rows long, n_keys long")}
    load_raw(spark, sources, base, "b", source_counts=counts)

    # The same for a source that only Spark can count: a file that goes after the count.
    import os

    path = f"{base}/invoices"
    sources["invoices"].repartition(4, "invoice_id").write.parquet(path)
    shrinking = spark.read.schema(sources["invoices"].schema).option("ignoreMissingFiles", True).parquet(path)
    plain = reconcile.profile

    def profile(df, key):
        row = plain(df, key).collect()
        if key == "invoice_id":
            lost = next(f for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
            os.remove(f"{path}/{lost}")
        return spark.createDataFrame(row, "n_rows long, n_keys long, n_null_keys long")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(reconcile, "profile", profile)
        with pytest.raises(RawValidationError, match=r"invoices\[source n_rows\]: counted 8, read"):
            load_raw(spark, {**sources, "invoices": shrinking}, base, "c")


def test_only_the_kept_runs_remain(spark, raw, tmp_path):
    import os

    base, data = str(tmp_path), raw([customer()], [subscription()], [invoice()])
    for k in range(3):
        refresh(spark, data, base, as_of="2026-09-01", run_id=f"r{k}", keep_runs=1)
    for place in ("dev", "raw"):
        left = [d for d in os.listdir(f"{base}/{place}/_runs") if not d.startswith(".")]
        assert len(left) == 1 and left[0].startswith("r2-")
        assert len([d for d in os.listdir(f"{base}/{place}/_versions") if not d.startswith(".")]) == 1
    assert "flagged_subscriptions" not in os.listdir(f"{base}/dev/_runs/{os.listdir(f'{base}/dev/_runs')[0]}")
    assert spark.table("billing_dev.fct_mrr").count() == 1
    with pytest.raises(MartContractError):
        refresh(spark, raw([customer()], [subscription(plan="platinum")], [invoice()]), base, keep_runs=1)
    assert len(os.listdir(f"{base}/dev/_runs")) == 1


def rates_of(spark, *rows_):
    return spark.createDataFrame([(c, Decimal(r) if r else None) for c, r in rows_], "currency string, rate_to_eur decimal(10,4)")


def test_rates_are_one_checked_relation(spark, raw, tmp_path):
    data = raw([customer()], [subscription()], [invoice("I1"), invoice("I2", amount="10.00", currency="USD")])
    new = rates_of(spark, ("EUR", "1.0000"), ("USD", "0.5000"))
    base = str(tmp_path)
    refresh(spark, data, base, as_of="2026-09-01", rates=new)
    versions = Versions(spark, f"{base}/dev")
    assert [r["mrr_eur"] for r in rows(versions.read("fct_mrr"))] == [Decimal("34.00")]
    assert rows(versions.read("issues_invoices")) == []
    double = rates_of(spark, ("EUR", "1.0000"), ("EUR", "1.0000"))
    with pytest.raises(MartContractError, match=r"unique_int_fx_rates_currency \(1\)"):
        refresh(spark, data, base, as_of="2026-09-01", rates=double)
    for broken in (rates_of(spark, ("EUR", None)), rates_of(spark, ("EUR", "1.0000"), (None, "2.0000"))):
        with pytest.raises(MartContractError, match="not_null_int_fx_rates"):
            refresh(spark, data, base, as_of="2026-09-01", rates=broken)
    assert [r["mrr_eur"] for r in rows(versions.read("fct_mrr"))] == [Decimal("34.00")]


def test_sources_are_held_to_the_contract(spark, sources, tmp_path):
    wrong = {**sources, "invoices": sources["invoices"].withColumn("amount", F.col("amount").cast("double")).drop("status")}
    with pytest.raises(IngestError, match="amount is double and not decimal.10,2., status is missing"):
        load_raw(spark, wrong, str(tmp_path), "a")
    long = {**sources, "invoices": sources["invoices"].withColumn("currency", F.lit("x" * 11))}
    with pytest.raises(IngestError, match="invoices: cannot be loaded") as e:
        load_raw(spark, long, str(tmp_path), "a")
    assert "longer than 10" in str(e.value.__cause__)
    assert Versions(spark, f"{tmp_path}/raw").current() == {}


def test_nothing_paid_fails_the_reconciliation(raw, spark, tmp_path):
    unpaid = raw([customer()], [subscription()], [invoice(status="open")])
    with pytest.raises(MartContractError, match="mrr_equals_ltv"):
        refresh(spark, unpaid, str(tmp_path), as_of="2026-09-01")


def test_load_is_all_or_nothing(spark, sources, tmp_path):
    base = str(tmp_path)
    with pytest.raises(IngestError, match="no source"):
        load_raw(spark, {"customers": sources["customers"]}, base, "a")
    with pytest.raises(IngestError, match="invoices: expected 9 rows, found 8"):
        load_raw(spark, sources, base, "b", {"invoices": 9})
    nameless = {**sources, "customers": sources["customers"].withColumn("customer_id", F.lit(None).cast("string"))}
    with pytest.raises(RawValidationError, match="customers.keyless.: 6 without customer_id"):
        load_raw(spark, nameless, base, "c")
    assert Versions(spark, f"{base}/raw").current() == {}
    counts, copy = load_raw(spark, sources, base, "d")
    assert counts["subscriptions"]["n_duplicates"] == 1 and copy["customers"].count() == 6
    loaded = Versions(spark, f"{base}/raw").read("invoices")
    assert loaded.where("status = 'PAID '").count() == 1


def test_reconciliation_catches_deduplication_and_unreadable_copies(spark, sources):
    copies = {"customers": sources["customers"].distinct(), "invoices": sources["invoices"].limit(8)}

    def read_copy(name):
        return copies[name] if name in copies else spark.read.parquet("/nowhere/at/all")

    keys = {"customers": "customer_id", "subscriptions": "subscription_id", "invoices": "invoice_id"}
    observed = {
        n: f.agg(*[c.alias(m) for m, c in reconcile.fingerprint(keys[n]).items()]).first().asDict()
        for n, f in sources.items()
    }
    report, counts = reconcile.differences(observed, read_copy)
    assert [r.split(":")[0] for r in report] == ["customers[rows]", "customers[keys]", "subscriptions[unreadable]"]
    assert report[0] == "customers[rows]: written 6, read 5"
    assert counts["invoices"] == {"n_rows": 8, "n_keys": 8, "n_null_keys": 0, "n_duplicates": 0}
    compared = reconcile.compare("customers", "customer_id", sources["customers"], copies["customers"])
    assert compared.first()["is_faithful"] is False


def test_row_ids_follow_content(spark, sources, tmp_path):
    load_raw(spark, sources, str(tmp_path), "a")
    kept = Versions(spark, f"{tmp_path}/raw").read("customers")
    assert kept.select("_row_id").distinct().count() == 5


def test_checks_have_thresholds(spark):
    frame = spark.range(3).toDF("id")
    rule = checks.row_rule("few", "t", checks.ERROR, frame, F.col("id") > 0)
    lenient = checks.Check("lenient", "t", checks.ERROR, rule.rows, rule.failures, tolerated=2)
    assert {r["check_name"]: (r["failures"], r["outcome"]) for r in rows(checks.summarise([rule, lenient]))} == {
        "few": (2, "error"), "lenient": (2, "pass")}


def test_null_is_no_value_for_the_generic_checks(spark):
    frame = spark.createDataFrame([("a", None), ("a", "x"), (None, None), (None, "y")], "k string, v string")
    assert [tuple(r) for r in checks.unique("t", "warn", frame, "k").rows.collect()] == [("a", 2)]
    assert checks.unique("t", "warn", frame, "v").rows.count() == 0
    assert [tuple(r) for r in checks.accepted_values("t", "warn", frame, "v", ["x"]).rows.collect()] == [("y", 1)]
    parent = spark.createDataFrame([("x",), (None,)], "p string")
    assert [tuple(r) for r in checks.relationships("t", "warn", frame, "v", parent, "p").rows.collect()] == [("y", 1)]


def test_target():
    assert resolve_target("prod", {}, {}) == "prod"
    assert resolve_target(None, {"target": "prod"}, {"LEDGERLINE_TARGET": "dev"}) == "prod"
    assert resolve_target("production", {"target": "x"}, {"LEDGERLINE_TARGET": "prod"}) == "prod"
    assert resolve_target(None, None, {"LEDGERLINE_TARGET": "staging"}) == "dev"
