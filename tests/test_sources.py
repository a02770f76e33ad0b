"""CSV extracts: by name, verbatim, strictly typed."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pytest
from billing import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.errors import IngestError
from ledgerline.schemas import CUSTOMERS, INVOICES, SUBSCRIPTIONS
from ledgerline.sources import read_billing_csv, read_csv_table
from ledgerline.sources.jdbc import (
    count_jdbc_table,
    depth_predicates,
    read_billing_jdbc,
    read_jdbc_table,
)

INVOICE_HEADER = "invoice_id,subscription_id,invoice_date,amount,currency,status\n"


@pytest.fixture
def csv(tmp_path):
    def write(text, name="t.csv"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def read(spark, path, table=INVOICES, **options):
    return rows(read_csv_table(spark, path, table, **options))


def test_columns_are_found_by_name_and_extras_ignored(spark, csv):
    path = csv("note,status,currency,amount,invoice_date,subscription_id,invoice_id\nx,paid,EUR,29,2024-01-31,S1,I1\n")
    frame = read_csv_table(spark, path, INVOICES)
    assert frame.columns == INVOICES.columns
    row = rows(frame)[0]
    assert row["invoice_id"] == "I1" and str(row["amount"]) == "29.00"
    assert dict(frame.dtypes)["amount"] == "decimal(10,2)" and dict(frame.dtypes)["invoice_date"] == "date"


def test_missing_columns_are_named(spark, csv):
    with pytest.raises(IngestError, match=r"\['amount', 'status'\]"):
        read_csv_table(spark, csv("invoice_id,subscription_id,invoice_date,currency\n"), INVOICES)


def test_values_stay_verbatim_and_only_declared_blanks_become_null(spark, csv):
    found = read(
        spark, csv(INVOICE_HEADER + 'I1,S1,2024-01-31,,EUR,PAID \nI2,"",2024-01-31,"  ",,"a ""b"", c\\d"\n')
    )
    assert found[0]["status"] == "PAID " and found[0]["amount"] is None
    assert found[1]["amount"] is None
    assert found[1]["subscription_id"] == "" and found[1]["currency"] == ""
    assert found[1]["status"] == 'a "b", c\\d'


def test_blank_country_is_null_but_blank_name_is_not(spark, csv):
    path = csv("customer_id,customer_name,email,country,created_at\nC1,,a@b.c,\" \",2024-01-01\n")
    row = read(spark, path, CUSTOMERS)[0]
    assert row["country"] is None and row["customer_name"] == ""


@pytest.mark.parametrize(
    "line",
    [
        "I1,S1,2024-01-31,twelve,EUR,paid",
        "I1,S1,2024-01-31,123456789.00,EUR,paid",
        "I1,S1,2024-02-31,1,EUR,paid",
        "I1,S1,2024,1,EUR,paid",
        "I1,S1,,1,EUR,paid",
        "I1,S1,2024-01-31,1,TOOLONGFORIT,paid",
        "I1,S1,2024-01-31,1",
    ],
)
def test_a_value_that_does_not_fit_fails_the_load(spark, csv, line):
    with pytest.raises((PySparkException, Py4JJavaError), match="does not fit|MALFORMED"):
        read(spark, csv(INVOICE_HEADER + line + "\n"))


def test_quoted_line_breaks_need_multiline_and_fail_without_it(spark, csv):
    path = csv(INVOICE_HEADER + 'I1,S1,2024-01-31,1,EUR,"pa\nid"\n')
    assert read(spark, path, multiline=True)[0]["status"] == "pa\nid"
    with pytest.raises((PySparkException, Py4JJavaError), match="does not fit|MALFORMED"):
        read(spark, path)


def test_all_missing_inputs_are_reported_at_once(spark, csv, tmp_path):
    good = csv(INVOICE_HEADER)
    with pytest.raises(IngestError) as e:
        read_billing_csv(spark, {"invoices": good, "customers": str(tmp_path / "absent.csv")})
    assert "customers" in str(e.value) and "subscriptions" in str(e.value)


def test_several_files_of_one_table(spark, csv, tmp_path):
    header = ",".join(SUBSCRIPTIONS.columns) + "\n"
    csv(header + "S1,C1,starter,29.0,2024-01-01,,active\n", "a.csv")
    csv(header + "S2,C1,scale,299.0,2024-01-01,2024-02-01,cancelled\n", "b.csv")
    found = read(spark, str(tmp_path), SUBSCRIPTIONS)
    assert {r["subscription_id"]: str(r["end_date"]) for r in found} == {"S1": "None", "S2": "2024-02-01"}


class FakeReader:
    """Stands in for a database: records how the table would be cut."""

    def __init__(self, frame):
        self.frame, self.calls = frame, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append(options | {"table": table})
        if " GROUP BY d) " in table:
            return self.frame.groupBy(F.col("d").alias("day")).agg(F.count("*").alias("n"))
        if table.startswith("(SELECT COUNT("):
            return self.frame.agg(F.count("*").alias("n_rows"), F.count_distinct("k").alias("n_keys"))
        return self.frame


def test_jdbc_parts_follow_the_rows_per_day(spark):
    """Half the rows are on one day, which half of the parts read."""
    days = "SELECT id AS k, CASE WHEN id < 50 THEN DATE '2024-06-01' ELSE date_add(DATE '2024-05-08', CAST(id - 50 AS INT)) END AS d FROM range(100)"
    reader = FakeReader(spark.sql(days))
    read_jdbc_table(reader, "jdbc:x", "invoices", key="k", split_by="d", partitions=4)
    assert reader.calls[0]["table"] == "(SELECT d AS day, COUNT(*) AS n FROM invoices GROUP BY d) depths"
    assert reader.calls[-1]["predicates"] == [
        "d < DATE '2024-06-01'",
        "d = DATE '2024-06-01' AND (MOD(CRC32(k), 3) = 0 OR k IS NULL)",
        "d = DATE '2024-06-01' AND (MOD(CRC32(k), 3) = 1)",
        "d = DATE '2024-06-01' AND (MOD(CRC32(k), 3) = 2)",
        "d > DATE '2024-06-01'",
        "d IS NULL",
    ]
    halves = ["d < '2024-06-01'", "d >= '2024-06-01' OR d IS NULL"]
    read_jdbc_table(reader, "jdbc:x", "invoices", key="k", split_by="d", predicates=halves)
    assert reader.calls[-1]["predicates"] == halves and len(reader.calls) == 3


@pytest.mark.parametrize("seed", range(12))
def test_jdbc_parts_are_disjoint_cover_the_table_and_are_even(seed):
    rng = random.Random(seed)
    weights = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60)), rng.choice((1, 2, 30, 200))) for _ in range(20)]
    weights += [(None, rng.choice((0, 5, 400)))]
    rows_ = [(f"k{j}" if j % 17 else None, day) for j, day in enumerate(d for d, n in weights for _ in range(n))]
    depths = Counter(day for _, day in rows_)
    parts = rng.choice((1, 3, 8, 40))
    cuts = depth_predicates("d", "k", depths.items(), parts, "CASE WHEN {key} IS NOT NULL THEN hash({key}) % {n} END")
    # Rows that come after counting: earlier, later, in between and without a day.
    late = [("x", dt.date(2023, 1, 1)), ("y", dt.date(2030, 1, 1)), ("z", None)]
    late += [(f"l{j}", dt.date(2024, 1, 1) + dt.timedelta(days=j)) for j in range(60)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, d DATE, late BOOLEAN)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(*r, False) for r in rows_] + [(*r, True) for r in late])
    counts = [con.execute(f"SELECT count(*), count(k) FILTER (NOT late) FROM t WHERE {c}").fetchone() for c in cuts]
    assert sum(all_ for all_, _ in counts) == len(rows_) + len(late)
    full = -(-len(rows_) // parts)
    assert len(cuts) <= 3 * parts + 2
    assert max(n for _, n in counts) <= 1.5 * full + 10


def test_jdbc_counts_its_own_rows(spark):
    reader = FakeReader(spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), (NULL) AS t(k)"))
    (row,) = count_jdbc_table(reader, "jdbc:x", "invoices", key="k").collect()
    assert reader.calls[0]["table"] == "(SELECT COUNT(*) AS n_rows, COUNT(DISTINCT k) AS n_keys FROM invoices) counts"
    assert (row["n_rows"], row["n_keys"]) == (4, 2)


@pytest.mark.parametrize("rows_", ["SELECT DATE '2024-01-01' AS d WHERE FALSE", "SELECT TIMESTAMP '2024-01-01 10:00:00' AS d", None])
def test_jdbc_without_days_is_cut_by_the_key(spark, rows_):
    reader = FakeReader(spark.sql(rows_ or "SELECT 1 AS d"))
    read_jdbc_table(reader, "jdbc:x", "invoices", key="k", split_by="d" if rows_ else None, partitions=3)
    assert reader.calls[-1]["predicates"] == [
        "MOD(CRC32(k), 3) = 0 OR k IS NULL", "MOD(CRC32(k), 3) = 1", "MOD(CRC32(k), 3) = 2"]


def test_jdbc_tables_are_held_to_the_contract(spark):
    frame = spark.createDataFrame([], "customer_id string, customer_name string, email string, country string, created_at string")
    with pytest.raises(IngestError, match="created_at is string and not date"):
        read_billing_jdbc(FakeReader(frame), "jdbc:x", predicates={"customers": ["1 = 1"]})
