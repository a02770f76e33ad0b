from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from billing import CUSTOMERS, INVOICES, SUBSCRIPTIONS  # noqa: E402
from ledgerline.models import Models  # noqa: E402
from ledgerline.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.warehouse.dir", "/tmp/ledgerline-warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def raw(spark):
    def build(customers=(), subscriptions=(), invoices=()):
        return {
            "customers": spark.createDataFrame(list(customers), CUSTOMERS),
            "subscriptions": spark.createDataFrame(list(subscriptions), SUBSCRIPTIONS),
            "invoices": spark.createDataFrame(list(invoices), INVOICES),
        }

    return build


@pytest.fixture
def models(raw):
    def build(customers=(), subscriptions=(), invoices=(), as_of="2026-09-01", **options):
        return Models(raw(customers, subscriptions, invoices), as_of, **options)

    return build
