"""All models on random small tables, against SQL over the same rows.

The domains are tiny on purpose, so that padded keys, NULLs, duplicates, orphans and ties all meet.
"""

import random

import duckdb
import pytest
from billing import CUSTOMERS, INVOICES, SUBSCRIPTIONS, day, money

from ledgerline.models import Models
from ledgerline.workload.oracle import with_views
from ledgerline.workload.projection import AS_OF

RELATIONS = {
    "stg_customers": "stg_customers",
    "stg_subscriptions": "stg_subscriptions",
    "issues_customers": "issues_customers",
    "issues_subscriptions": "issues_subscriptions",
    "issues_invoices": "issues_invoices",
    "int_subscriptions": "usable_subscriptions",
    "int_paid_invoices_eur": "paid_invoices_eur",
    "fct_mrr": "mrr_by_month_plan",
    "customer_ltv": "customer_ltv",
    "subscription_churn": "subscription_churn",
}
RAW = {"customers": CUSTOMERS, "subscriptions": SUBSCRIPTIONS, "invoices": INVOICES}


def random_tables(seed: int, null_ids: bool):
    r = random.Random(seed)
    pick = r.choice
    customer_ids = ["C1", "C1 ", "C2", " C2", "C3", "C4", "C5", None]
    subscription_ids = [f"S{i}" for i in range(12)] + ["S1 ", " S2", "S3  ", None]
    days = [day(f"200{y}-0{m}-1{d}") for y in (0, 1) for m in (1, 2) for d in (1, 2)] + [None]
    invoice_ids = [f"I{i}" for i in range(40)] + ["I1 "] + ([None] if null_ids else [])
    return {
        "customers": [
            (pick(customer_ids), pick(["Ann", " Bo "]), pick(["a@b.c", " a@b.c", "x", None, "A@B.C"]),
             pick(["SE", " se", "", "  ", None]), pick(days))
            for _ in range(14)
        ],
        "subscriptions": [
            (pick(subscription_ids), pick(customer_ids[:7] * 3 + [None, "C9"]),
             pick(["starter", " Growth", "scale", None]),
             pick([money("29.00")] * 8 + [money("99.00"), money("-1.00"), money("0.00"), None]),
             pick(days), pick([*days, None, None]),
             pick(["active", "ACTIVE", "cancelled", "cancelled ", "paused", None]))
            for _ in range(30)
        ],
        "invoices": [
            (pick(invoice_ids), pick([*subscription_ids, "S99"]), pick(days),
             pick([money("29.00")] * 5 + [money("12.50"), money("0.50"), money("-3.00"), money("0.00"), None]),
             pick(["EUR", "EUR", "sek ", "SEK", "USD", None]), pick(["paid", "paid", "paid", " PAID", "open", None]))
            for _ in range(60)
        ],
    }


def duckdb_with(tables):
    con = duckdb.connect()
    types = {"string": "VARCHAR", "date": "DATE", "decimal(10,2)": "DECIMAL(10,2)"}
    for name, ddl in RAW.items():
        columns = [c.strip().rsplit(" ", 1) for c in ddl.split(", ")]
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {types[t]}' for c, t in columns)})")
        con.executemany(f"INSERT INTO {name} VALUES ({','.join('?' * len(columns))})", tables[name])
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


@pytest.mark.parametrize("seed,null_ids", [(1, False), (2, False), (3, True)])
def test_models_match_sql(spark, seed, null_ids):
    tables = random_tables(seed, null_ids)
    con = duckdb_with(tables)
    raw = {name: spark.createDataFrame(tables[name], ddl) for name, ddl in RAW.items()}
    models = Models(raw, AS_OF)
    for relation, view in RELATIONS.items():
        frame = getattr(models, relation)
        cursor = con.execute(with_views(f"SELECT * FROM {view}", given=tuple(RAW)))
        expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
        assert canonical(frame.columns, frame.collect()) == expected, relation
        assert expected or null_ids, f"{relation} is empty, so the comparison says nothing"


