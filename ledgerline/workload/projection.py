"""Billing-shaped views over the TPC-H-like driver tables, with every defect class planted by rule.

Nothing is written and no row is invented beyond the planted exact duplicates; see FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return rows.selectExpr(
        "'C' || lpad(cast(c_custkey as string), 9, '0') AS customer_id",
        "if(c_custkey % 37 = 0, '  ' || c_name || ' ', c_name) AS customer_name",
        """CASE WHEN c_custkey % 53 = 0 THEN 'not-an-email'
                WHEN c_custkey % 59 = 0 THEN NULL
                ELSE replace(lower(c_name), '#', '.') || '@example.com' END AS email""",
        """CASE WHEN c_custkey % 41 = 0 THEN ''
                WHEN c_custkey % 43 = 0 THEN NULL
                WHEN c_custkey % 47 = 0 THEN lower(n_name) || ' '
                ELSE n_name END AS country""",
        """if(c_custkey % 61 = 0, date '2001-06-01',
              date_add(date '1994-01-01', cast(c_custkey % 365 AS int))) AS created_at""",
        "explode(if(c_custkey % 71 = 0, array(1, 2), array(1))) AS copy",
    ).drop("copy")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'scale'
                   WHEN o_orderpriority = '3-MEDIUM' THEN 'growth' ELSE 'starter' END"""
    status = """CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'paused'
                     ELSE 'active' END"""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k",
        "o_custkey",
        "o_orderstatus",
        f"{plan} AS p",
        f"{status} AS st",
        "cast(o_orderdate AS date) AS start_date",
    )
    return rows.selectExpr(
        "'S' || lpad(cast(k AS string), 9, '0') AS subscription_id",
        """if(k % 89 = 0, 'C-ORPHAN',
              'C' || lpad(cast(o_custkey AS string), 9, '0')) AS customer_id""",
        "if(k % 73 = 0, upper(p) || ' ', p) AS plan_name",
        """cast(CASE WHEN k % 83 = 0 THEN NULL WHEN k % 79 = 0 THEN -99
                     WHEN p = 'scale' THEN 299 WHEN p = 'growth' THEN 99 ELSE 29 END
                AS decimal(10,2)) AS monthly_price""",
        "start_date",
        """if(o_orderstatus = 'F', date_add(start_date, cast(k % 400 - 20 AS int)),
              NULL) AS end_date""",
        "if(k % 67 = 0, upper(st) || ' ', st) AS status",
        "explode(if(k % 97 = 0, array(1, 2), array(1))) AS copy",
    ).drop("copy")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per (order, line). The stored table repeats such pairs, hence the grouping.

    The amount is wider than the contract's, so that no pile-up of rows on one pair can overflow it.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_suppkey").alias("s"),
            # Cents, as a sum of decimals this wide would be an object per row.
            F.sum((F.col("l_extendedprice").cast("decimal(10,2)") * 100).cast("bigint")).alias("cents"),
            F.min("l_shipdate").cast("date").alias("invoice_date"),
            # One letter, so its code orders alike; a number keeps the aggregation hash-based.
            F.min(F.ascii("l_returnflag")).alias("flag"),
        )
        .selectExpr(
            "*",
            "l_orderkey * 10 + l_linenumber AS k",
            "cast(cents * 0.01BD AS decimal(18,2)) AS a",
            """CASE flag WHEN ascii('A') THEN 'paid' WHEN ascii('N') THEN 'open'
                         WHEN ascii('R') THEN 'failed' END AS st""",
        )
    )
    return lines.selectExpr(
        """'I' || lpad(cast(l_orderkey AS string), 9, '0') || '-' ||
              cast(l_linenumber AS string) AS invoice_id""",
        """if(k % 101 = 0, 'S-ORPHAN',
              'S' || lpad(cast(l_orderkey AS string), 9, '0')) AS subscription_id""",
        "invoice_date",
        "CASE WHEN k % 103 = 0 THEN NULL WHEN k % 107 = 0 THEN -a ELSE a END AS amount",
        """CASE WHEN s % 20 = 0 THEN 'SEK' WHEN s % 31 = 0 THEN 'eur '
                WHEN s % 97 = 0 THEN 'USD' ELSE 'EUR' END AS currency""",
        "if(k % 109 = 0, upper(st) || ' ', st) AS status",
    )


class RawTables(Mapping):
    """The three projected tables by name; a table nobody asks for is never opened."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.frames = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            self.frames[name] = PROJECTIONS[name](self.spark, self.sf_dir)
        return self.frames[name]

    def __iter__(self):
        return iter(PROJECTIONS)

    def __len__(self):
        return len(PROJECTIONS)


PROJECTIONS = {"customers": customers, "subscriptions": subscriptions, "invoices": invoices}
