"""The billing tables from an operational database, in parallel parts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType

from ledgerline.schemas import RAW_TABLES
from ledgerline.sources.contract import conform

# The date each table is cut by. Keys are text, which JDBC ranges cannot cut.
SPLIT_COLUMNS = {
    "customers": "created_at",
    "subscriptions": "start_date",
    "invoices": "invoice_date",
}
FETCH_SIZE = "10000"
# A number from 0 to n - 1 for a text key, in the database's own dialect.
HASH_SQL = "MOD(CRC32({key}), {n})"


def hash_predicates(key: str, n: int, hash_sql: str = HASH_SQL) -> list[str]:
    """Disjoint conditions that cover a table; the first also takes the rows without a key."""
    part = hash_sql.format(key=key, n=n)
    return [f"{part} = {k}" + (f" OR {key} IS NULL" if k == 0 else "") for k in range(n)]


def depth_predicates(
    split_by: str,
    key: str,
    depths: Iterable[tuple[dt.date | None, int]],
    partitions: int,
    hash_sql: str = HASH_SQL,
) -> list[str]:
    """Disjoint conditions that cover a table, each with about as many rows as any other.

    `depths` are the rows per value of `split_by`, NULL among them. Neighbouring values share a part
    until it is full. A value with more rows than a part should have is divided by the key's hash. The
    first and the last range are open, and a range begins where the one before ends, so rows that were
    added after counting are in exactly one part, whatever their value.
    """
    counted = dict(depths)
    nulls = counted.pop(None, 0)
    full = max(1, -(-(sum(counted.values()) + nulls) // partitions))

    def divided(condition: str, rows: int) -> list[str]:
        n = -(-rows // full)
        if n <= 1:
            return [condition]
        return [f"{condition} AND ({part})" for part in hash_predicates(key, n, hash_sql)]

    out, low, held, hot = [], "", 0, None
    for value in sorted(counted):
        at, rows = f"DATE '{value.isoformat()}'", counted[value]
        next_day = hot is not None and value - hot == dt.timedelta(days=1) and not held
        if rows > full and not next_day or held and held + rows > full:
            # Before a large value also if the range is empty so far: rows may be added there.
            out.append(_between(split_by, low, f"{split_by} < {at}"))
            low, held = f"{split_by} >= {at}", 0
        if rows > full:
            out += divided(f"{split_by} = {at}", rows)
            low, hot = f"{split_by} > {at}", value
        else:
            held += rows
    out.append(_between(split_by, low, ""))
    return out + divided(f"{split_by} IS NULL", nulls)


def _between(column: str, *bounds: str) -> str:
    return " AND ".join(b for b in bounds if b) or f"{column} IS NOT NULL"


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    split_by: str | None = None,
    partitions: int = 16,
    predicates: list[str] | None = None,
    hash_sql: str = HASH_SQL,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """One table with the schema the database reports, in about `partitions` parts of like size.

    Parts are the caller's `predicates`; else they follow the rows per day of `split_by`, a date, which
    the database counts, so a day with half the table is read in half of the parts; else, without a
    date to cut by or without rows, hash parts of the key. The counts are one row per day.
    """
    props = {"fetchsize": FETCH_SIZE, **(properties or {})}
    if predicates is None and split_by is not None:
        histogram = f"(SELECT {split_by} AS day, COUNT(*) AS n FROM {table} GROUP BY {split_by}) depths"
        counts = spark.read.jdbc(url, histogram, properties=props)
        depths = [(r["day"], r["n"]) for r in counts.collect()]
        if depths and isinstance(counts.schema["day"].dataType, DateType):
            predicates = depth_predicates(split_by, key, depths, partitions, hash_sql)
    parts = predicates or hash_predicates(key, partitions, hash_sql)
    return spark.read.jdbc(url, table, predicates=parts, properties=props)


def count_jdbc_table(
    spark: SparkSession, url: str, table: str, *, key: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """Rows and distinct keys of a table, one row that the database itself computes."""
    counts = f"(SELECT COUNT(*) AS n_rows, COUNT(DISTINCT {key}) AS n_keys FROM {table}) counts"
    return spark.read.jdbc(url, counts, properties=properties or {})


def count_billing_jdbc(
    spark: SparkSession, url: str, *, properties: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """What `refresh` holds its copy of the three raw tables against; see `source_counts` there."""
    return {
        name: count_jdbc_table(spark, url, name, key=table.key, properties=properties)
        for name, table in RAW_TABLES.items()
    }


def read_billing_jdbc(
    spark: SparkSession,
    url: str,
    *,
    partitions: int = 16,
    predicates: Mapping[str, list[str]] | None = None,
    hash_sql: str = HASH_SQL,
    properties: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The three raw tables, held to the contract; `predicates` cut single tables by hand."""
    return {
        name: conform(
            read_jdbc_table(
                spark,
                url,
                name,
                key=table.key,
                split_by=SPLIT_COLUMNS[name],
                partitions=partitions,
                predicates=(predicates or {}).get(name),
                hash_sql=hash_sql,
                properties=properties,
            ),
            table,
        )
        for name, table in RAW_TABLES.items()
    }
