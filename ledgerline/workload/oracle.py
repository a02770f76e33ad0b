"""DuckDB SQL for the registered queries, over the same driver tables.

Written from the rules and not from the Spark plans: windows where those aggregate, a literal NOT IN
where those join, one statement per check. Each statement carries only the views it refers to.
"""

from __future__ import annotations

import re

from ledgerline.workload.projection import AS_OF

AS_OF_DATE = f"DATE '{AS_OF}'"

EMAIL_TEST = r"regexp_matches(email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')"

COPY_ROWS = "JOIN (VALUES (1), (2)) AS c(copy) ON c.copy = 1 OR"


def _smallest_first(columns: str) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns.split())


VIEWS = {
    # The billing-shaped projection.
    "customers": f"""
        SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id,
               CASE WHEN c_custkey % 37 = 0 THEN '  ' || c_name || ' ' ELSE c_name END
                   AS customer_name,
               CASE WHEN c_custkey % 53 = 0 THEN 'not-an-email'
                    WHEN c_custkey % 59 = 0 THEN NULL
                    ELSE replace(lower(c_name), '#', '.') || '@example.com' END AS email,
               CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 43 = 0 THEN NULL
                    WHEN c_custkey % 47 = 0 THEN lower(n_name) || ' ' ELSE n_name END AS country,
               CASE WHEN c_custkey % 61 = 0 THEN DATE '2001-06-01'
                    ELSE DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) END AS created_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        {COPY_ROWS} c_custkey % 71 = 0""",
    "order_labels": """
        SELECT o_orderkey AS k, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS started,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'scale' WHEN '2-HIGH' THEN 'scale'
                    WHEN '3-MEDIUM' THEN 'growth' ELSE 'starter' END AS p,
               CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'paused'
                    ELSE 'active' END AS st
        FROM orders""",
    "subscriptions": f"""
        SELECT 'S' || lpad(CAST(k AS VARCHAR), 9, '0') AS subscription_id,
               CASE WHEN k % 89 = 0 THEN 'C-ORPHAN'
                    ELSE 'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_id,
               CASE WHEN k % 73 = 0 THEN upper(p) || ' ' ELSE p END AS plan_name,
               CAST(CASE WHEN k % 83 = 0 THEN NULL WHEN k % 79 = 0 THEN -99
                         WHEN p = 'scale' THEN 299 WHEN p = 'growth' THEN 99 ELSE 29 END
                    AS DECIMAL(10,2)) AS monthly_price,
               started AS start_date,
               CASE WHEN o_orderstatus = 'F' THEN started + CAST(k % 400 - 20 AS INT) END
                   AS end_date,
               CASE WHEN k % 67 = 0 THEN upper(st) || ' ' ELSE st END AS status
        FROM order_labels {COPY_ROWS} k % 97 = 0""",
    "invoice_lines": """
        SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS k, min(l_suppkey) AS s,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS a,
               CAST(min(l_shipdate) AS DATE) AS invoice_date,
               CASE min(l_returnflag) WHEN 'A' THEN 'paid' WHEN 'N' THEN 'open'
                    WHEN 'R' THEN 'failed' END AS st
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "invoices": """
        SELECT 'I' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') || '-'
                   || CAST(l_linenumber AS VARCHAR) AS invoice_id,
               CASE WHEN k % 101 = 0 THEN 'S-ORPHAN'
                    ELSE 'S' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0') END AS subscription_id,
               invoice_date,
               CASE WHEN k % 103 = 0 THEN NULL WHEN k % 107 = 0 THEN -a ELSE a END AS amount,
               CASE WHEN s % 20 = 0 THEN 'SEK' WHEN s % 31 = 0 THEN 'eur '
                    WHEN s % 97 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
               CASE WHEN k % 109 = 0 THEN upper(st) || ' ' ELSE st END AS status
        FROM invoice_lines""",
    # One row per key.
    "one_customer": f"""
        SELECT *, count(*) OVER (PARTITION BY customer_id) AS copies FROM customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
            {_smallest_first("customer_name email country created_at")}) = 1""",
    "one_subscription": f"""
        SELECT *, count(*) OVER (PARTITION BY subscription_id) AS copies FROM subscriptions
        QUALIFY row_number() OVER (PARTITION BY subscription_id ORDER BY
            {_smallest_first("customer_id plan_name monthly_price start_date end_date status")}
            ) = 1""",
    "stg_customers": """
        SELECT trim(customer_id) AS customer_id, trim(customer_name) AS customer_name,
               lower(trim(email)) AS email,
               CASE WHEN country IS NULL OR trim(country) = '' THEN 'UNKNOWN'
                    ELSE upper(trim(country)) END AS country,
               created_at
        FROM one_customer""",
    "stg_subscriptions": """
        SELECT trim(subscription_id) AS subscription_id, trim(customer_id) AS customer_id,
               lower(trim(plan_name)) AS plan_name, lower(trim(status)) AS status,
               monthly_price, start_date, end_date
        FROM one_subscription""",
    "stg_invoices": """
        SELECT trim(invoice_id) AS invoice_id, trim(subscription_id) AS subscription_id,
               invoice_date, amount, upper(trim(currency)) AS currency,
               lower(trim(status)) AS status
        FROM invoices""",
    # Issues.
    "issues_customers": f"""
        SELECT * FROM (
            SELECT customer_id, customer_name, email, country, created_at,
                   copies > 1 AS was_duplicated,
                   country IS NULL OR trim(country) = '' AS has_missing_country,
                   email IS NULL OR NOT {EMAIL_TEST} AS has_invalid_email,
                   created_at > {AS_OF_DATE} AS is_future_created,
                   FALSE AS excluded_from_marts
            FROM one_customer)
        WHERE was_duplicated OR has_missing_country OR has_invalid_email OR is_future_created""",
    "judged_subscriptions": """
        SELECT subscription_id, customer_id, plan_name, monthly_price, start_date, end_date, status,
               copies > 1 AS was_duplicated,
               NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = o.customer_id)
                   AS has_orphan_customer,
               status <> lower(trim(status)) AS has_unnormalized_status,
               end_date IS NOT NULL AND end_date < start_date AS has_invalid_end_date,
               monthly_price IS NULL OR monthly_price <= 0 AS has_invalid_price
        FROM one_subscription o""",
    "issues_subscriptions": """
        SELECT *, has_orphan_customer OR has_invalid_price AS excluded_from_marts
        FROM judged_subscriptions
        WHERE was_duplicated OR has_orphan_customer OR has_unnormalized_status
           OR has_invalid_end_date OR has_invalid_price""",
    "judged_invoices": """
        SELECT invoice_id, subscription_id, invoice_date, amount, currency, status,
               NOT EXISTS (SELECT 1 FROM subscriptions s
                           WHERE s.subscription_id = i.subscription_id)
                   AS has_orphan_subscription,
               lower(trim(status)) = 'paid' AND amount IS NULL AS has_null_paid_amount,
               amount IS NOT NULL AND amount <= 0 AS has_non_positive_amount,
               status <> lower(trim(status)) AS has_unnormalized_status,
               upper(trim(currency)) NOT IN ('EUR', 'SEK') AS has_unsupported_currency,
               EXISTS (SELECT 1 FROM issues_subscriptions q
                       WHERE q.excluded_from_marts AND q.subscription_id = i.subscription_id)
                   AS has_excluded_subscription
        FROM invoices i""",
    "issues_invoices": """
        SELECT *, has_orphan_subscription OR has_null_paid_amount OR has_non_positive_amount
               OR has_unsupported_currency OR has_excluded_subscription AS excluded_from_marts
        FROM judged_invoices
        WHERE has_unnormalized_status OR has_orphan_subscription OR has_null_paid_amount
           OR has_non_positive_amount OR has_unsupported_currency OR has_excluded_subscription""",
    # Shared base of the marts.
    "fx": """
        SELECT * FROM (VALUES ('EUR', CAST(1.0 AS DECIMAL(10,4))),
                              ('SEK', CAST(0.087 AS DECIMAL(10,4)))) AS t(currency, rate)""",
    "usable_subscriptions": """
        SELECT *, status = 'cancelled' AND end_date IS NOT NULL AND NOT has_unreliable_end_date
                   AS is_churn_eligible
        FROM (
            SELECT s.*, EXISTS (SELECT 1 FROM issues_subscriptions i
                                WHERE i.subscription_id = s.subscription_id AND i.has_invalid_end_date)
                       AS has_unreliable_end_date
            FROM stg_subscriptions s
            WHERE NOT EXISTS (SELECT 1 FROM issues_subscriptions i
                              WHERE i.subscription_id = s.subscription_id AND i.excluded_from_marts))""",
    "paid_invoices_eur": """
        SELECT invoice_id, i.subscription_id, customer_id, plan_name, invoice_date,
               CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
               amount, i.currency, CAST(round(amount * rate, 2) AS DECIMAL(18,2)) AS amount_eur
        FROM stg_invoices i, usable_subscriptions u, fx
        WHERE i.status = 'paid' AND u.subscription_id = i.subscription_id
          AND fx.currency = i.currency
          AND invoice_id NOT IN (SELECT q.invoice_id FROM issues_invoices q
                                 WHERE q.excluded_from_marts)""",
    "mrr_by_month_plan": """
        SELECT invoice_month, plan_name, count(*) AS paid_invoices,
               count(DISTINCT subscription_id) AS paying_subscriptions,
               count(DISTINCT customer_id) AS paying_customers,
               CAST(sum(amount_eur) AS DECIMAL(28,2)) AS mrr_eur
        FROM paid_invoices_eur GROUP BY ALL""",
    "customer_revenue": """
        SELECT customer_id, sum(amount_eur) AS revenue, count(*) AS n,
               min(invoice_date) AS first_day, max(invoice_date) AS last_day
        FROM paid_invoices_eur GROUP BY customer_id""",
    "customer_holdings": """
        SELECT customer_id, count(*) AS n, count(*) FILTER (status = 'active') AS n_active,
               string_agg(DISTINCT plan_name, ', ' ORDER BY plan_name) AS mix
        FROM usable_subscriptions GROUP BY customer_id""",
    "customer_status": """
        SELECT customer_id, status FROM usable_subscriptions
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
            (status = 'active') DESC NULLS FIRST, start_date DESC NULLS FIRST,
            subscription_id NULLS LAST, status NULLS FIRST) = 1""",
    "customer_ltv": """
        SELECT c.customer_id, c.customer_name, c.country, c.created_at AS customer_since,
               CAST(ifnull(r.revenue, 0) AS DECIMAL(28,2)) AS total_revenue_eur,
               ifnull(r.n, 0) AS paid_invoices,
               r.first_day AS first_paid_invoice_date, r.last_day AS last_paid_invoice_date,
               ifnull(h.n, 0) AS subscription_count, ifnull(h.n_active, 0) AS active_subscriptions,
               h.mix AS plan_mix, t.status AS current_subscription_status
        FROM stg_customers c
        LEFT JOIN customer_revenue r USING (customer_id)
        LEFT JOIN customer_holdings h USING (customer_id)
        LEFT JOIN customer_status t USING (customer_id)""",
    "subscription_churn": f"""
        SELECT CAST(date_trunc('month', end_date) AS DATE) AS churn_month,
               count(*) AS cancelled_subscriptions,
               count(DISTINCT customer_id) AS churned_customers,
               CAST(sum(monthly_price) AS DECIMAL(20,2)) AS mrr_lost_eur,
               CAST(date_trunc('month', end_date) AS DATE) > {AS_OF_DATE}
                   AS is_future_cancellation
        FROM usable_subscriptions WHERE is_churn_eligible GROUP BY ALL""",
    # Checks that several statements need.
    "withheld_ids": """
        SELECT invoice_id, count(*) AS n_records FROM issues_invoices WHERE excluded_from_marts
        GROUP BY invoice_id""",
    "customer_starts": """
        SELECT customer_id, customer_name, created_at,
               (SELECT min(start_date) FROM subscriptions s WHERE s.customer_id = c.customer_id)
                   AS earliest_subscription_start
        FROM (SELECT DISTINCT customer_id, customer_name, created_at FROM customers) c""",
    "implausible_customers": f"""
        SELECT * FROM customer_starts
        WHERE least(earliest_subscription_start, {AS_OF_DATE}) < created_at""",
    "negative_figures": """
        SELECT 'fct_mrr' AS model, CAST(invoice_month AS VARCHAR) AS key, mrr_eur AS value
        FROM mrr_by_month_plan WHERE mrr_eur < 0
        UNION ALL
        SELECT 'customer_ltv', customer_id, total_revenue_eur
        FROM customer_ltv WHERE total_revenue_eur < 0
        UNION ALL
        SELECT 'subscription_churn', CAST(churn_month AS VARCHAR), mrr_lost_eur
        FROM subscription_churn WHERE mrr_lost_eur <= 0""",
    "revenue_totals": """
        SELECT CAST(m.total AS DECIMAL(28,2)) AS fct_mrr_total_eur,
               CAST(l.total AS DECIMAL(28,2)) AS customer_ltv_total_eur,
               CAST(m.total - l.total AS DECIMAL(28,2)) AS difference_eur
        FROM (SELECT sum(mrr_eur) AS total FROM mrr_by_month_plan) m,
             (SELECT sum(total_revenue_eur) AS total FROM customer_ltv) l""",
    "quarantined_revenue": """
        SELECT invoice_id, subscription_id, amount_eur, n_records FROM paid_invoices_eur
        NATURAL JOIN withheld_ids""",
}

RAW_KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "invoices": "invoice_id",
}
PLANS = "('starter', 'growth', 'scale')"
SUBSCRIPTION_STATUSES = "('active', 'cancelled', 'paused')"
INVOICE_STATUSES = "('paid', 'open', 'failed')"
CURRENCIES = "('EUR', 'SEK')"


def with_views(sql: str, given: tuple[str, ...] = ()) -> str:
    """Prefix a statement with the views it names, directly or through another view.

    Names in `given` are taken to exist already.
    """
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and name not in given and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    views = ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    return f"WITH {views}\n{sql}" if views else sql


def _issue_summary() -> str:
    flags = {
        "issues_customers": "was_duplicated has_missing_country has_invalid_email"
        " is_future_created",
        "issues_subscriptions": "was_duplicated has_orphan_customer has_unnormalized_status"
        " has_invalid_end_date has_invalid_price",
        "issues_invoices": "has_orphan_subscription has_null_paid_amount has_non_positive_amount"
        " has_unnormalized_status has_unsupported_currency has_excluded_subscription",
    }
    return " UNION ALL ".join(
        f"SELECT '{t}' AS issue_table, '{m}' AS measure, count(*) FILTER ({c}) AS n_rows FROM {t}"
        for t, names in flags.items()
        for m, c in [("flagged", "TRUE")]
        + [(n, n) for n in ["excluded_from_marts", *names.split()]]
    )


def _results(counts: list[tuple[str, str, str, str]]) -> str:
    """One result row per check from (name, relation, severity, SQL that counts failures)."""
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, '{relation}' AS relation, '{severity}' AS severity,
            CAST(n AS BIGINT) AS failures,
            CASE WHEN n > 0 THEN '{severity}' ELSE 'pass' END AS outcome FROM ({sql}) AS t(n)"""
        for name, relation, severity, sql in counts
    )


def _null_count(relation: str, severity: str, column: str, source: str | None = None):
    return (
        f"not_null_{relation}_{column}",
        relation,
        severity,
        f"SELECT count(*) FROM {source or relation} WHERE {column} IS NULL",
    )


def _repeat_count(relation: str, severity: str, column: str, source: str | None = None):
    return (
        f"unique_{relation}_{column}",
        relation,
        severity,
        f"""SELECT count(*) FROM (SELECT {column} FROM {source or relation}
            WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)""",
    )


def _foreign_value_count(relation, severity, column, values, source=None):
    return (
        f"accepted_values_{relation}_{column}",
        relation,
        severity,
        f"""SELECT count(DISTINCT {column}) FROM {source or relation}
            WHERE {column} NOT IN {values}""",
    )


def _dangling_count(relation, column, parent):
    return (
        f"relationships_{relation}_{column}",
        relation,
        "warn",
        f"""SELECT count(*) FROM {relation} x WHERE {column} IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = x.{column})""",
    )


RULES = {
    "country_present": ("customers", "country IS NULL OR trim(country) = ''"),
    "email_valid": ("customers", f"email IS NULL OR NOT {EMAIL_TEST}"),
    "paid_amount_valid": (
        "invoices",
        "lower(trim(status)) = 'paid' AND (amount IS NULL OR amount <= 0)",
    ),
    "dates_chronological": ("subscriptions", "end_date < start_date"),
    "price_positive": ("subscriptions", "monthly_price IS NULL OR monthly_price <= 0"),
}

RULE_COLUMNS = {
    "country_present": "customer_id, customer_name, country",
    "email_valid": "customer_id, customer_name, email",
    "paid_amount_valid": "invoice_id, subscription_id, invoice_date, status, amount, currency",
    "dates_chronological": "subscription_id, customer_id, start_date, end_date, status",
    "price_positive": "subscription_id, customer_id, plan_name, monthly_price",
}


def _rule_rows(name: str) -> str:
    relation, predicate = RULES[name]
    return f"SELECT {RULE_COLUMNS[name]} FROM {relation} WHERE {predicate}"


def _suite() -> str:
    warn, error = "warn", "error"
    counts = [
        *[_repeat_count(t, warn, k) for t, k in RAW_KEYS.items()],
        *[_null_count(t, warn, k) for t, k in RAW_KEYS.items()],
        _null_count("subscriptions", warn, "customer_id"),
        _null_count("invoices", warn, "subscription_id"),
        _dangling_count("subscriptions", "customer_id", "customers"),
        _dangling_count("invoices", "subscription_id", "subscriptions"),
        _foreign_value_count("subscriptions", warn, "plan_name", PLANS),
        _foreign_value_count("subscriptions", warn, "status", SUBSCRIPTION_STATUSES),
        _foreign_value_count("invoices", warn, "status", INVOICE_STATUSES),
        _foreign_value_count("invoices", warn, "currency", CURRENCIES),
        *[
            (name, relation, warn, f"SELECT count(*) FROM {relation} WHERE {predicate}")
            for name, (relation, predicate) in RULES.items()
        ],
        ("created_plausible", "customers", warn, "SELECT count(*) FROM implausible_customers"),
    ]
    marts = {
        "fct_mrr": ("mrr_by_month_plan", "invoice_month plan_name mrr_eur paid_invoices"),
        "customer_ltv": (
            "customer_ltv",
            "customer_id country total_revenue_eur subscription_count",
        ),
        "subscription_churn": (
            "subscription_churn",
            "churn_month cancelled_subscriptions mrr_lost_eur is_future_cancellation",
        ),
    }
    for mart, (source, columns) in marts.items():
        counts += [_null_count(mart, error, c, source) for c in columns.split()]
    counts += [
        _foreign_value_count("fct_mrr", error, "plan_name", PLANS, "mrr_by_month_plan"),
        _foreign_value_count(
            "customer_ltv", error, "current_subscription_status", SUBSCRIPTION_STATUSES
        ),
        _repeat_count("customer_ltv", error, "customer_id"),
        _repeat_count("subscription_churn", error, "churn_month"),
        (
            "unique_combination_fct_mrr_invoice_month_plan_name",
            "fct_mrr",
            error,
            """SELECT count(*) FROM (SELECT 1 FROM mrr_by_month_plan
               GROUP BY invoice_month, plan_name HAVING count(*) > 1)""",
        ),
        ("mart_non_negative", "marts", error, "SELECT count(*) FROM negative_figures"),
        (
            "mrr_equals_ltv",
            "marts",
            error,
            "SELECT count(*) FROM revenue_totals"
            " WHERE fct_mrr_total_eur IS DISTINCT FROM customer_ltv_total_eur",
        ),
        (
            "no_quarantined_revenue",
            "int_paid_invoices_eur",
            error,
            "SELECT coalesce(sum(n_records), 0) FROM quarantined_revenue",
        ),
    ]
    return _results(counts)


def _reconciliation(copies: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, a.r AS source_rows, a.k AS source_keys, b.r AS n_rows,
            b.k AS n_keys, b.z AS n_null_keys, b.r - b.k AS n_duplicates,
            a.r = b.r AND a.k = b.k AND b.z = 0 AS is_faithful
            FROM (SELECT count(*) AS r, count(DISTINCT {RAW_KEYS[t]}) AS k FROM {t}) a,
                 (SELECT count(*) AS r, count(DISTINCT {RAW_KEYS[t]}) AS k,
                         count(*) FILTER ({RAW_KEYS[t]} IS NULL) AS z FROM {copy}) b"""
        for t, copy in copies.items()
    )


def _hashed(columns: str) -> str:
    parts = " || ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')"
        for c in columns.split()
    )
    return f"sha256({parts})"


QUERIES = {
    **{
        name: f"SELECT * FROM {name}"
        for name in """stg_customers stg_subscriptions stg_invoices issues_customers
            issues_subscriptions issues_invoices usable_subscriptions paid_invoices_eur
            mrr_by_month_plan customer_ltv subscription_churn""".split()
    },
    **{f"raw_{name}": f"SELECT * FROM {name}" for name in RAW_KEYS},
    "issue_summary": _issue_summary(),
    "dq_not_null": _results(
        [
            _null_count(t, "warn", c)
            for t, names in {
                "customers": "customer_id email country",
                "subscriptions": "subscription_id customer_id monthly_price end_date",
                "invoices": "invoice_id subscription_id amount",
            }.items()
            for c in names.split()
        ]
    ),
    "dq_unique": " UNION ALL ".join(
        f"""SELECT '{t}' AS relation, {k} AS value, count(*) AS n_records FROM {t}
            WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1"""
        for t, k in RAW_KEYS.items()
    ),
    "dq_relationships": " UNION ALL ".join(
        f"""SELECT '{t}' AS relation, {c} AS value, count(*) AS n_records FROM {t} x
            WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{c} = x.{c})
            GROUP BY {c}"""
        for t, c, p in [
            ("subscriptions", "customer_id", "customers"),
            ("invoices", "subscription_id", "subscriptions"),
        ]
    ),
    "dq_accepted_values": " UNION ALL ".join(
        f"""SELECT '{t}' AS relation, '{c}' AS column_name, {c} AS value, count(*) AS n_records
            FROM {t} WHERE {c} NOT IN {values} GROUP BY {c}"""
        for t, c, values in [
            ("subscriptions", "plan_name", PLANS),
            ("subscriptions", "status", SUBSCRIPTION_STATUSES),
            ("invoices", "status", INVOICE_STATUSES),
            ("invoices", "currency", CURRENCIES),
        ]
    ),
    "dq_unique_combination": """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    **{f"dq_{name}": _rule_rows(name) for name in RULES},
    "dq_created_plausible": "SELECT * FROM implausible_customers",
    "dq_mart_non_negative": "SELECT * FROM negative_figures",
    "dq_mart_non_negative_probe": " UNION ALL ".join(
        f"""SELECT '{model}' AS model, count(*) AS n_rows,
            CAST(min({value}) AS DECIMAL(28,2)) AS smallest FROM {source}"""
        for model, source, value in [
            ("fct_mrr", "mrr_by_month_plan", "mrr_eur"),
            ("customer_ltv", "customer_ltv", "total_revenue_eur"),
            ("subscription_churn", "subscription_churn", "mrr_lost_eur"),
        ]
    ),
    "dq_mrr_ltv_reconcile": """SELECT * FROM revenue_totals
        WHERE fct_mrr_total_eur IS DISTINCT FROM customer_ltv_total_eur""",
    "dq_mrr_ltv_reconcile_probe": "SELECT * FROM revenue_totals",
    "dq_no_quarantined_revenue": "SELECT * FROM quarantined_revenue",
    "dq_no_quarantined_revenue_probe": """
        SELECT count(*) AS n_invoices, CAST(sum(n_records) AS BIGINT) AS n_pairs,
               count(*) FILTER (amount IS NULL) AS n_without_amount
        FROM (FROM stg_invoices UNION ALL FROM stg_invoices) NATURAL JOIN withheld_ids
        WHERE status = 'paid'
        """,
    "dq_suite_report": _suite(),
    "dq_suite_totals": f"""SELECT outcome, count(*) AS checks FROM ({_suite()}) AS s
        GROUP BY outcome""",
    "raw_reconciliation": _reconciliation({t: t for t in RAW_KEYS}),
    "raw_reconciliation_deduplicated": _reconciliation(
        {"customers": "one_customer", "subscriptions": "one_subscription"}
    ),
    "row_identity": f"""
        SELECT {_hashed("customer_id customer_name email country created_at")} AS row_id,
               count(*) AS n_records, min(customer_id) AS customer_id
        FROM customers GROUP BY 1""",
    "dedupe_row_number": "SELECT * EXCLUDE (copies) FROM one_customer",
    "distinct_on": "SELECT * EXCLUDE (copies), copies > 1 AS was_duplicated FROM one_subscription",
    "window_dup_count": """
        SELECT DISTINCT subscription_id, n_records FROM (
            SELECT subscription_id, count(*) OVER (PARTITION BY subscription_id) AS n_records
            FROM subscriptions) WHERE n_records > 1""",
    "priority_pick": """
        SELECT customer_id, status AS current_status FROM stg_subscriptions
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
            (status = 'active') DESC NULLS FIRST, start_date DESC NULLS FIRST,
            subscription_id NULLS LAST, status NULLS FIRST) = 1""",
    "orphan_flag": """
        SELECT s.subscription_id, s.customer_id, c.customer_id IS NULL AS has_orphan_customer
        FROM subscriptions s LEFT JOIN (SELECT DISTINCT customer_id FROM customers) c
             ON c.customer_id = s.customer_id""",
    "member_flag": """
        SELECT i.invoice_id, q.subscription_id IS NOT NULL AS has_excluded_subscription
        FROM invoices i
        LEFT JOIN (SELECT subscription_id FROM issues_subscriptions WHERE excluded_from_marts) q
             ON q.subscription_id = i.subscription_id""",
    "left_join_chain": """
        SELECT c.customer_id, ifnull(h.n, 0) AS n_subscriptions,
               CAST(ifnull(h.price, 0) AS DECIMAL(20,2)) AS list_price, e.last_end_date
        FROM stg_customers c
        LEFT JOIN (SELECT customer_id, count(*) AS n, sum(monthly_price) AS price
                   FROM stg_subscriptions GROUP BY customer_id) h USING (customer_id)
        LEFT JOIN (SELECT customer_id, max(end_date) AS last_end_date FROM stg_subscriptions
                   WHERE status = 'cancelled' GROUP BY customer_id) e USING (customer_id)""",
    "null_aware_anti": """
        SELECT customer_id, email FROM customers WHERE email NOT IN
            (SELECT email FROM customers WHERE country IS NULL AND email IS NOT NULL)""",
    "null_aware_anti_with_null": """
        SELECT customer_id FROM customers WHERE country NOT IN (SELECT country FROM customers)""",
    "broadcast_fx": """
        SELECT currency, count(*) AS n_invoices, CAST(sum(amount) AS DECIMAL(28,2)) AS amount,
               CAST(sum(round(amount * rate, 2)) AS DECIMAL(28,2)) AS amount_eur
        FROM stg_invoices JOIN fx USING (currency) GROUP BY currency""",
    "fx_round": """
        SELECT invoice_id, currency, amount,
               CAST(round(amount * rate, 2) AS DECIMAL(18,2)) AS amount_eur
        FROM stg_invoices JOIN fx USING (currency)""",
    "cross_totals": """
        SELECT CAST(p.t AS DECIMAL(20,2)) AS price_total, c.n AS n_customers
        FROM (SELECT sum(monthly_price) AS t FROM subscriptions) p
        CROSS JOIN (SELECT count(DISTINCT customer_id) AS n FROM customers) c""",
    "agg_before_left_join": "SELECT * FROM customer_starts",
    "multi_count_distinct": """
        SELECT currency, status, count(*) AS n_invoices,
               count(DISTINCT subscription_id) AS n_subscriptions,
               count(DISTINCT invoice_date) AS n_days
        FROM stg_invoices GROUP BY ALL""",
    "filtered_count": """
        SELECT plan_name, count(*) AS n_subscriptions,
               count(*) FILTER (status = 'active') AS n_active,
               count(*) FILTER (monthly_price IS NULL) AS n_without_price
        FROM stg_subscriptions GROUP BY plan_name""",
    "ordered_distinct_string_agg": """
        SELECT customer_id, string_agg(DISTINCT plan_name, ', ' ORDER BY plan_name) AS plan_mix
        FROM stg_subscriptions GROUP BY customer_id""",
    "having": """
        SELECT customer_id, count(*) AS n, min(start_date) AS first_start
        FROM stg_subscriptions GROUP BY customer_id
        HAVING count(*) > 14 AND min(start_date) < DATE '1995-03-01'""",
    "union_all": """
        SELECT 'subscriptions' AS source, subscription_id AS key,
               CAST(monthly_price AS DECIMAL(18,2)) AS value, CAST(start_date AS VARCHAR) AS day
        FROM subscriptions WHERE monthly_price <= 0
        UNION ALL
        SELECT 'invoices', invoice_id, CAST(amount AS DECIMAL(18,2)), CAST(invoice_date AS VARCHAR)
        FROM invoices WHERE amount <= 0""",
    "month_trunc": """
        SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS invoice_month,
               count(*) AS n_invoices, min(invoice_date) AS first_day, max(invoice_date) AS last_day
        FROM stg_invoices GROUP BY 1""",
    "label_repair": """
        SELECT customer_id,
               CASE WHEN country IS NULL OR trim(country) = '' THEN 'UNKNOWN'
                    ELSE upper(trim(country)) END AS country,
               trim(customer_name) AS customer_name, lower(trim(email)) AS email
        FROM customers""",
    "email_regex": f"""
        SELECT customer_id, email, email IS NULL OR NOT {EMAIL_TEST} AS has_invalid_email
        FROM customers""",
    "distinct_from": """
        SELECT customer_id, customer_name, country FROM customers
        WHERE customer_name IS DISTINCT FROM trim(customer_name)
           OR country IS DISTINCT FROM CASE WHEN country IS NULL OR trim(country) = ''
                                            THEN 'UNKNOWN' ELSE upper(trim(country)) END""",
    "null_logic": """
        SELECT is_low, is_dirty, is_foreign, is_low OR is_dirty AS low_or_dirty,
               is_low AND is_dirty AS low_and_dirty, NOT is_low AS not_low, count(*) AS n_invoices
        FROM (SELECT amount <= 0 AS is_low, status <> lower(trim(status)) AS is_dirty,
                     upper(trim(currency)) NOT IN ('EUR', 'SEK') AS is_foreign
              FROM invoices) AS t
        GROUP BY ALL""",
    "global_totals": """
        SELECT count(*) AS n_invoices, count(DISTINCT invoice_id) AS n_keys,
               CAST(sum(amount) AS DECIMAL(28,2)) AS amount,
               min(invoice_date) AS first_day, max(invoice_date) AS last_day
        FROM invoices""",
}

ORACLE_SQL = {name: with_views(sql) for name, sql in QUERIES.items()}
