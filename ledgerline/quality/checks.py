"""Data-quality checks: a check is a frame of offending rows and a severity.

No offending row is a pass. A warning reports, an error stops publication.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.operators import keyed, union_all

WARN, ERROR, PASS = "warn", "error", "pass"


@dataclass(frozen=True)
class Check:
    """One rule on one relation.

    `rows` are the offending rows. `failures` aggregates them to the number reported. A rule whose
    number can be had from its `frame` directly also gives that as `counted`, so that a suite counts
    all such rules of a frame in one pass. The check takes its severity above `tolerated` failures.
    """

    name: str
    relation: str
    severity: str
    rows: DataFrame
    failures: Column
    frame: DataFrame | None = None
    counted: Column | None = None
    tolerated: int = 0
    stacked: Keys | None = None


@dataclass(frozen=True)
class Keys:
    """The keys a rule compares: those of `frame`, and those of `parent` if it asks for a parent."""

    frame: DataFrame
    columns: tuple[str, ...]
    parent: DataFrame | None = None
    field: str | None = None


def row_rule(
    name: str,
    relation: str,
    severity: str,
    frame: DataFrame,
    predicate: Column,
    columns: list[str] | None = None,
) -> Check:
    """Rows for which the predicate is true."""
    offending = frame.where(predicate)
    return Check(
        name,
        relation,
        severity,
        offending.select(*columns) if columns else offending,
        F.count(F.lit(1)),
        frame,
        F.count_if(predicate),
    )


def frame_rule(name: str, relation: str, severity: str, rows: DataFrame) -> Check:
    """Rows some query found."""
    return Check(name, relation, severity, rows, F.count(F.lit(1)))


def not_null(relation: str, severity: str, frame: DataFrame, column: str) -> Check:
    name = f"not_null_{relation}_{column}"
    return row_rule(name, relation, severity, frame, F.col(column).isNull())


def unique(relation: str, severity: str, frame: DataFrame, column: str) -> Check:
    return unique_combination(relation, severity, frame, [column], f"unique_{relation}_{column}")


def unique_combination(
    relation: str, severity: str, frame: DataFrame, columns: list[str], name: str | None = None
) -> Check:
    """Key values carried by several rows. A lone NULL key is no value; within a tuple it is one."""
    keyed_rows = frame.dropna(subset=columns) if len(columns) == 1 else frame
    repeated = (
        keyed_rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    )
    name = name or f"unique_combination_{relation}_{'_'.join(columns)}"
    keys = Keys(frame, tuple(columns))
    return Check(name, relation, severity, repeated, F.count(F.lit(1)), stacked=keys)


def accepted_values(
    relation: str, severity: str, frame: DataFrame, column: str, values: Iterable[str]
) -> Check:
    """Values outside the list with their row counts; NULL is not a value."""
    is_foreign = ~F.col(column).isin(*values)
    foreign = frame.where(is_foreign).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    name = f"accepted_values_{relation}_{column}"
    found = F.count_distinct(F.when(is_foreign, F.col(column)))
    return Check(name, relation, severity, foreign, F.count(F.lit(1)), frame, found)


def relationships(
    relation: str, severity: str, frame: DataFrame, column: str, parent: DataFrame, field: str
) -> Check:
    """Foreign keys without a parent, with the rows that carry them; a NULL refers to nothing.

    The child is counted per key before the join, so a key that fills a third of the table arrives
    there as one row.
    """
    references = (
        frame.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(field).alias(column)).distinct()
    dangling = references.join(parents, column, "left_anti")
    name = f"relationships_{relation}_{column}"
    failures = F.coalesce(F.sum("n_records"), F.lit(0))
    keys = Keys(frame, (column,), parent, field)
    return Check(name, relation, severity, dangling, failures, stacked=keys)


def summarise(checks: list[Check]) -> DataFrame:
    """One row per check: failures and outcome.

    Rules that can be counted on their frame share one scan of it, and all rules about keys share one
    scan of each frame and one aggregation; every other check is an aggregation of its own.
    """
    shared: dict[int, list[Check]] = {}
    about_keys, parts = [], []
    for check in checks:
        if check.counted is not None:
            shared.setdefault(id(check.frame), []).append(check)
        elif check.stacked is not None:
            about_keys.append(check)
        else:
            parts.append(
                check.rows.agg(F.array(_result(check, check.failures)).alias("results"))
            )
    for group in shared.values():
        results = [_result(c, c.counted) for c in group]
        parts.append(group[0].frame.agg(F.array(*results).alias("results")))
    if about_keys:
        parts.append(_count_keys(about_keys))
    counted = union_all(parts).select(F.inline("results"))
    return counted.withColumn(
        "outcome", F.when(F.col("failures") > F.col("tolerated"), F.col("severity")).otherwise(PASS)
    ).drop("tolerated")


def _count_keys(checks: list[Check]) -> DataFrame:
    """The results of all rules about keys, from one aggregation over rows (relation's keys, key, role).

    Every row of a frame is read once. Its keys are stacked once for all rules about them, in role 0, and
    once for each rule that looks them up in a parent's, in a role of its own there. Each task counts its
    own rows per key first, so a key that fills a third of a table is sent once per task.
    """
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    numbers: dict[tuple[int, tuple[str, ...]], int] = {}
    roles: list[int] = []  # By number of the keys, the roles given out.

    def stack(number: int, role: int, frame: DataFrame, columns: tuple[str, ...]) -> None:
        # A lone NULL is no value; within several columns it is one, spelled apart from every text.
        texts = [F.col(c).cast("string") for c in columns]
        spelled = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("~")) for t in texts]
        row = F.struct(
            F.lit(number).alias("of"),
            (texts[0] if len(texts) == 1 else F.concat(*spelled)).alias("key"),
            F.lit(role).alias("role"),
        )
        frames.setdefault(id(frame), (frame, []))[1].append(row)

    def own(frame: DataFrame, columns: tuple[str, ...]) -> int:
        if (at := (id(frame), columns)) not in numbers:
            numbers[at] = len(roles)
            roles.append(1)
            stack(numbers[at], 0, frame, columns)
        return numbers[at]

    def failures(check: Check) -> Column:
        keys = check.stacked
        if keys.parent is None:
            return F.count_if((F.col("of") == own(keys.frame, keys.columns)) & (F.col("n_0") > 1))
        number = own(keys.parent, (keys.field,))
        role, roles[number] = roles[number], roles[number] + 1
        stack(number, role, keys.frame, keys.columns)
        dangling = (F.col("of") == number) & (F.col("n_0") == 0)
        return F.coalesce(F.sum(F.when(dangling, F.col(f"n_{role}"))), F.lit(0))

    results = [_result(c, failures(c)) for c in checks]
    rows = union_all(
        [frame.select(F.inline(F.array(*stacked))) for frame, stacked in frames.values()]
    ).where("key IS NOT NULL")
    each = rows.groupBy("of", "key").agg(
        *[F.count_if(F.col("role") == k).alias(f"n_{k}") for k in range(max(roles))]
    )
    return each.agg(F.array(*results).alias("results"))


def totals(summary: DataFrame) -> DataFrame:
    """How many checks passed, warned and failed."""
    return summary.groupBy("outcome").agg(F.count(F.lit(1)).alias("checks"))


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.relation).alias("relation"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        F.lit(check.tolerated).alias("tolerated"),
    )


def first_start_per_customer(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Distinct customers with the start of their earliest subscription, if they have one.

    Subscriptions are reduced to one row per customer before the join.
    """
    starts = keyed(
        subscriptions, "customer_id", F.min("start_date").alias("earliest_subscription_start")
    )
    people = customers.select("customer_id", "customer_name", "created_at").distinct()
    return people.join(starts, "customer_id", "left")
