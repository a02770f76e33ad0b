"""What the physical plans must look like, and that a hot key changes no result.

The thresholds are lowered so that a local table counts as skewed; the data flow is the real one.
"""

import pytest
from billing import customer, rows, subscription
from pyspark.sql import functions as F

from ledgerline.models import Models, SharedRelations
from ledgerline.operators import first_per_key, keyed, maybe_in, sql_not_in
from ledgerline.quality.rules import mrr_equals_ltv, no_quarantined_revenue

N = 120_000


@pytest.fixture
def no_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        # A local table has few map tasks to split between; keep those it has.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the invoices on one subscription, a third of the subscriptions on one customer and
    a third of the raw customers under one key."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    third = F.col("id") % 3 == 0
    customers = spark.range(3000).select(
        F.when(third, "C1").otherwise(F.concat(F.lit("C"), F.col("id"))).alias("customer_id"),
        F.lit("Ann").alias("customer_name"),
        F.lit("a@b.c").alias("email"),
        F.lit("SE").alias("country"),
        F.lit("2024-01-01").cast("date").alias("created_at"),
    )
    subscriptions = spark.range(30000).select(
        F.concat(F.lit("S"), F.col("id")).alias("subscription_id"),
        F.when(third, "C1")
        .otherwise(F.concat(F.lit("C"), F.col("id") % 1000 * 3 + 1))
        .alias("customer_id"),
        F.lit("starter").alias("plan_name"),
        F.lit(29).cast("decimal(10,2)").alias("monthly_price"),
        F.lit("2024-01-01").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit("active").alias("status"),
    )
    invoices = spark.range(N).select(
        F.concat(F.lit("I"), F.col("id")).alias("invoice_id"),
        F.when(third, "S1")
        .otherwise(F.concat(F.lit("S"), F.col("id") % 29000 + 500))
        .alias("subscription_id"),
        F.lit("2024-03-01").cast("date").alias("invoice_date"),
        F.when(F.col("id") % 10 == 0, -1)
        .otherwise(F.col("id") % 997 + 1)
        .cast("decimal(10,2)")
        .alias("amount"),
        F.lit("EUR").alias("currency"),
        F.lit("paid").alias("status"),
    )
    frames = {"customers": customers, "subscriptions": subscriptions, "invoices": invoices}
    for name, frame in frames.items():
        frame.repartition(8).write.parquet(f"{folder}/{name}")
    return lambda: {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def final_plan(df) -> str:
    """What ran, its subqueries included; only the outermost initial plan is cut off."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_a_hot_subscription_is_split_between_tasks(spark, skewed, no_broadcast):
    paid = Models(skewed(), "2024-06-01").int_paid_invoices_eur
    totals = paid.groupBy().agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("subscription_id") == "S1").alias("hot"),
        F.sum("amount_eur").alias("eur"),
    )
    totals.collect()
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("skew=true") >= 2, plan  # the lookup of owners and that of issues
    (found,) = rows(totals)
    assert found["n"] == N - N // 10
    assert found["eur"] == sum(i % 997 + 1 for i in range(N) if i % 10)
    assert found["hot"] == N // 3 - N // 30


def test_a_hot_customer_is_split_between_tasks(spark, skewed, no_broadcast):
    flagged = Models(skewed(), "2024-06-01").flagged_subscriptions
    totals = flagged.groupBy().agg(
        F.count_if("has_orphan_customer").alias("orphans"), F.max("subscription_id").alias("last")
    )
    assert "skew=true" in final_plan(totals)
    assert rows(totals) == [{"orphans": 0, "last": "S9999"}]


def test_dedupe_reduces_a_hot_key_before_the_shuffle(spark, skewed):
    one = first_per_key(skewed()["customers"], "customer_id")
    assert one.where("customer_id = 'C1'").first()["_copies"] == 1001
    plan = final_plan(one)
    # An aggregate on each side of the only exchange, and no window.
    assert plan.count("Exchange") == 1 and "Window" not in plan
    assert plan.count("partial_min") == 1


def test_not_in_does_not_broadcast_what_it_excludes(spark, skewed, no_broadcast):
    ids = skewed()["invoices"].select("invoice_id")
    plan = final_plan(sql_not_in(ids, "invoice_id", ids.where("invoice_id > 'I5'")))
    # All that is broadcast is the one row of facts about the excluded keys, after the anti join.
    assert plan.count("BroadcastExchange") == 1 and plan.count("BroadcastNestedLoopJoin") == 1
    anti = plan.index("SortMergeJoin")
    assert "LeftAnti" in plan[anti:].split("\n")[0] and plan.index("BroadcastNestedLoopJoin") < anti
    assert "HashAggregate(keys=[]" in plan[plan.index("BroadcastExchange") :].split("keys=[_key")[0]


def test_only_the_columns_a_mart_needs_are_read(spark, skewed):
    churn = Models(skewed(), "2024-06-01").subscription_churn
    plan = churn._jdf.queryExecution().executedPlan().toString()
    assert "invoices" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "/customers" in line]
    assert scans and all("ReadSchema: struct<customer_id:string>" in line for line in scans)


def scans(plan: str, table: str) -> int:
    """Scans of a table that ran; a reused exchange repeats none, an initial plan is not what ran."""
    n, skipped = 0, None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if "== Initial Plan ==" in line else None
        n += "FileScan" in line and table in line
    return n


def test_excluded_ids_are_grouped_once(spark, skewed, no_broadcast):
    """The NULL test shares the stage that groups the excluded invoices with the anti join."""
    paid = Models(skewed(), "2024-06-01").int_paid_invoices_eur
    plan = final_plan(paid.agg(F.count(F.lit(1))))
    assert "ReusedExchange" in plan
    assert scans(plan, "/invoices") == 2, plan


def test_lineitem_is_read_twice_for_the_revenue(spark):
    from ledgerline.workload.queries import QUERIES

    plan = final_plan(QUERIES["paid_invoices_eur"](spark, "/root/testdata/sf0.001"))
    assert scans(plan, "lineitem.parquet") <= 2, plan


def test_a_hot_withheld_invoice_is_split_between_tasks(spark, no_broadcast, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, "I0").otherwise(F.concat(F.lit("I"), F.col("id")))
    invoice = spark.range(N).select(
        hot.alias("invoice_id"), F.lit("S1").alias("subscription_id"), F.xxhash64("id").alias("amount_eur")
    )
    invoice.repartition(8).write.parquet(f"{tmp_path}/paid")
    withheld = spark.range(N).select(hot.alias("invoice_id"), F.lit(True).alias("excluded_from_marts"))
    check = no_quarantined_revenue(spark.read.parquet(f"{tmp_path}/paid"), withheld)
    found = check.rows.agg(check.failures.alias("n"), F.max("amount_eur"))  # the column travels
    assert "skew=true" in final_plan(found)
    assert found.first()["n"] == (N // 3) ** 2 + N - N // 3


def test_stored_raw_is_read_for_used_columns_only(spark, raw, tmp_path):
    from ledgerline.publish import load_raw

    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # show whole paths
    _, kept = load_raw(spark, raw([customer()], [subscription()], []), str(tmp_path), "a")
    m = Models(kept, "2024-06-01")
    for frame, table, unread in ((m.subscription_churn, "/subscriptions", "plan_name"), (m.customer_ltv, "/customers", "email")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        lines = [x for x in plan.splitlines() if "FileScan" in x and table in x]
        assert lines and all(unread not in x.split("ReadSchema")[1] for x in lines), lines


def test_keyed_is_one_row_per_key(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, v int")
    found = keyed(frame, "k", F.sum("v").alias("v"))
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 3), (None, 7)]


def test_hot_null_references_are_kept(spark, raw):
    data = raw([customer()], [subscription("S1", owner=None), subscription("S2", owner=None)])
    assert Models(data, "2024-06-01").flagged_subscriptions.where("has_orphan_customer").count() == 2


def test_the_suite_reads_each_table_a_few_times(spark, skewed):
    """Rules about keys share one scan of each table and one aggregation."""
    from ledgerline.quality import checks, rules

    raw = skewed()
    suite = rules.raw_checks(raw, "2024-06-01")
    plan = checks.summarise(suite)._jdf.queryExecution().executedPlan().toString()
    scans = {name: plan.count(f"/{name}]") for name in raw}
    assert scans["invoices"] <= 3 and scans["subscriptions"] <= 4 and scans["customers"] <= 3, scans
    about_keys = [c for c in suite if c.stacked is not None]
    assert len(about_keys) == 5
    plan = checks.summarise(about_keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("Exchange hashpartitioning") == 1
    failures = {r["check_name"]: r["failures"] for r in rows(checks.summarise(suite))}
    for check in suite:
        assert failures[check.name] == check.rows.agg(check.failures.alias("n")).first()["n"]


def test_keys_are_stacked_once_for_all_rules_about_them(spark, skewed):
    """A parent's keys serve its own uniqueness and every rule that looks keys up in them."""
    from ledgerline.quality import checks, rules

    about_keys = [c for c in rules.raw_checks(skewed(), "2024-06-01") if c.stacked is not None]
    plan = checks.summarise(about_keys)._jdf.queryExecution().optimizedPlan().toString()
    assert len(about_keys) == 5 and plan.count("struct(of") == 5, plan


def test_rules_that_share_keys_keep_their_counts(spark):
    from ledgerline.quality import checks

    parent = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "k string, n int")
    first = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    second = spark.createDataFrame([("y", "1"), ("b", "9"), ("y", None)], "k string, n string")
    suite = [
        checks.relationships("first", checks.WARN, first, "k", parent, "k"),
        checks.unique("parent", checks.WARN, parent, "k"),
        checks.relationships("second", checks.WARN, second, "k", parent, "k"),
        checks.relationships("second", checks.WARN, second, "n", parent, "n"),
        checks.relationships("parent", checks.WARN, parent, "k", first, "k"),
        checks.unique("first", checks.WARN, first, "k"),
        checks.unique("parent", checks.WARN, parent, "n"),
        checks.unique_combination("parent", checks.WARN, parent, ["k", "n"]),
    ]
    found = {r["check_name"]: r["failures"] for r in rows(checks.summarise(suite))}
    assert found == {c.name: c.rows.agg(c.failures.alias("n")).first()["n"] for c in suite}
    assert list(found.values()).count(0) == 0 and found["relationships_first_k"] == 2


def test_amounts_of_a_pair_are_summed_as_numbers(spark, tmp_path):
    """Exactly as decimals, each price rounded half up first, but with no object per line."""
    from ledgerline.workload.projection import invoices

    prices = [(1, 0.005), (1, 0.1), (1, 0.2), (2, 1.005), (2, -1.005), (2, None), (3, None), (4, 99999999.99), (4, 0.01)]
    spark.createDataFrame(prices, "l_orderkey long, l_extendedprice double").selectExpr(
        "*", "1 AS l_linenumber", "1L AS l_suppkey", "'A' AS l_returnflag", "timestamp '1995-01-01' AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = invoices(spark, str(tmp_path))
    amounts = {r["invoice_id"]: r["amount"] for r in rows(found)}
    assert {k[9]: None if v is None else str(v) for k, v in amounts.items()} == {
        "1": "0.31", "2": "0.00", "3": None, "4": "100000000.00",
    }
    assert found.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "sum(cast((cast(l_extendedprice" in plan, plan


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Tables for the billing projection: lines that repeat or have no order, others without a key."""
    folder = str(tmp_path_factory.mktemp("star"))
    key = F.when(F.col("id") % 97 > 0, F.col("id"))
    tables = {
        "nation": spark.createDataFrame([(0, "FRANCE")], "n_nationkey int, n_name string"),
        "customer": spark.range(300).select(
            key.alias("c_custkey"),
            F.concat(F.lit("Customer#"), "id").alias("c_name"),
            F.lit(0).alias("c_nationkey"),
        ),
        "orders": spark.range(2000).select(
            key.alias("o_orderkey"),
            (F.col("id") % 310).alias("o_custkey"),
            F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("o_orderstatus"),
            F.lit("3-MEDIUM").alias("o_orderpriority"),
            F.lit("1995-01-01").cast("timestamp").alias("o_orderdate"),
        ),
        "lineitem": spark.range(6000).select(
            (F.col("id") * 11 % 2100).alias("l_orderkey"),
            (F.col("id") % 3).cast("int").alias("l_linenumber"),
            (F.col("id") % 100).alias("l_suppkey"),
            (F.col("id") % 9 * 10.5).alias("l_extendedprice"),
            F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
            F.lit("1995-02-01").cast("timestamp").alias("l_shipdate"),
        ),
    }
    for name, frame in tables.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_the_suite_derives_invoices_once(spark, star):
    """Whatever follows the flagged invoices reads them, and no line item a second time."""
    from ledgerline.workload.queries import QUERIES

    read = QUERIES["dq_suite_report"](spark, star).inputFiles()
    assert any("flagged_invoices" in path for path in read)
    assert not [path for path in read if "lineitem.parquet" in path]


def test_kept_invoices_are_the_raw_ones(spark, star):
    from ledgerline.quality import checks, rules
    from ledgerline.workload.queries import _kept_models, _models

    plain, kept = _models(spark, star), _kept_models(spark, star)
    assert kept.raw_as_read["invoices"].columns == plain.raw["invoices"].columns
    invoices = [sorted(map(str, m.raw_as_read["invoices"].collect())) for m in (plain, kept)]
    assert invoices[0] == invoices[1] and len(invoices[0]) > 2000
    suites = [sorted(map(str, checks.summarise(rules.all_checks(m)).collect())) for m in (plain, kept)]
    assert suites[0] == suites[1] and len(suites[0]) == 40
    for name, mart in plain.marts.items():
        expected = sorted(map(str, mart.collect()))
        assert expected and sorted(map(str, kept.marts[name].collect())) == expected


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 15, 1 << 22])
def test_a_key_bitmap_loses_no_match(spark, bits):
    """Whatever its size, also when it holds too many keys to tell any apart, and with NULL keys."""
    ids = F.when(F.col("id") % 7 > 0, F.concat(F.lit("I"), "id")).alias("k")
    left, right = spark.range(20_000).select(ids), spark.range(0, 20_000, 50).select(ids, "id")
    kept = maybe_in(left, "k", right, bits)
    assert kept.columns == ["k"]
    joined = sorted(r["k"] for r in left.join(right, "k").collect())
    assert sorted(r["k"] for r in kept.join(right, "k").collect()) == joined and len(joined) == 342
    n = kept.count()
    assert n == 20_000 if bits <= 1 << 10 else 342 <= n < 1000


def test_a_key_bitmap_of_nothing(spark):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    assert maybe_in(left, "k", left.limit(0)).where("k IS NOT NULL").count() == 0
    assert maybe_in(left.limit(0), "k", left).count() == 0


def test_sound_revenue_stops_at_the_scan(spark, no_broadcast, tmp_path):
    """Of all paid invoices, those that may be withheld are shuffled, and the check still finds them."""
    invoice = spark.range(N).selectExpr("concat('I', id) AS invoice_id", "'S1' AS subscription_id", "id AS amount_eur")
    invoice.repartition(8).write.parquet(f"{tmp_path}/paid")
    withheld = spark.range(0, 2 * N, 1000).selectExpr("concat('I', id) AS invoice_id", "true AS excluded_from_marts")
    check = no_quarantined_revenue(spark.read.parquet(f"{tmp_path}/paid"), withheld)
    plan = final_plan(check.rows)
    assert check.rows.agg(check.failures.alias("n")).first()["n"] == N // 1000
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    (scan,) = [k for k, line in enumerate(lines) if "FileScan" in line and "/paid" in line]
    assert "getbit" in lines[scan].split("DataFilters")[1].split("Format")[0], plan
    # The exchange of the join only gets what the filter right above the scan lets through.
    test = max(k for k in range(scan) if "Filter (" in lines[k] and "getbit" in lines[k] and depth[k] < depth[scan])
    above = [lines[k] for k in range(test) if depth[k] < depth[test]]
    assert "Exchange hashpartitioning(invoice_id" in above[-1], plan


def leaves(frame) -> list:
    found = frame._jdf.queryExecution().withCachedData().collectLeaves()
    return [found.apply(k) for k in range(found.size())]


def test_separate_queries_share_relations(spark, skewed):
    """Each query has models of its own; the marts and a check of them read the revenue that the first kept."""

    def queries(**options):
        new = lambda: Models(skewed(), "2024-06-01", **options)
        totals = mrr_equals_ltv(new().fct_mrr, new().customer_ltv).rows
        return [new().fct_mrr, new().customer_ltv, no_quarantined_revenue(new().int_paid_invoices_eur, new().issues_invoices).rows, totals]

    plain = [sorted(map(str, q.collect())) for q in queries()]
    with SharedRelations() as keep:
        got = queries(keep=keep)
        assert [sorted(map(str, q.collect())) for q in got] == plain
        built = set()
        for query in got:
            kept = [x for x in leaves(query) if x.nodeName() == "InMemoryRelation"]
            assert kept and all(x.cacheBuilder().isCachedColumnBuffersLoaded() for x in kept)
            revenue = [x for x in kept if "invoice_month" in x.output().mkString()]
            built |= {x.cacheBuilder().hashCode() for x in revenue}
            # Nothing but raw customers is read beside what is kept.
            other = [x.toString() for x in leaves(query) if x.nodeName() not in ("InMemoryRelation", "Range")]
            assert all("customer_name" in x for x in other), other
        assert len(built) == 1
    assert not [x for x in leaves(queries()[0]) if x.nodeName() == "InMemoryRelation"]
