"""Does a copy hold what its source holds? Row, key and NULL-key counts per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.schemas import RAW_TABLES


def profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and NULL keys in one pass; keys are combined in each task first."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(F.col(key).isNull()).alias("n_null_keys"),
    )


def compare(name: str, key: str, source: DataFrame, copy: DataFrame) -> DataFrame:
    """One row: both profiles and whether they agree.

    Distinct keys are what a silently deduplicating load changes least visibly, so they are compared
    as well as rows. `n_duplicates` are the repeated keys the copy preserved.
    """
    left = profile(source, key).toDF("source_rows", "source_keys", "source_null_keys")
    right = profile(copy, key)
    return left.crossJoin(right).select(
        F.lit(name).alias("table_name"),
        "source_rows",
        "source_keys",
        "n_rows",
        "n_keys",
        "n_null_keys",
        (F.col("n_rows") - F.col("n_keys")).alias("n_duplicates"),
        (
            (F.col("source_rows") == F.col("n_rows"))
            & (F.col("source_keys") == F.col("n_keys"))
            & (F.col("n_null_keys") == 0)
        ).alias("is_faithful"),
    )


def fingerprint(key: str) -> dict[str, Column]:
    """What a write can observe of the rows that pass, and a reader can repeat.

    The key sum is the same for the same keys with the same multiplicities, in any order.
    """
    return {
        "rows": F.count(F.lit(1)),
        "keys": F.sum(F.xxhash64(key).cast("decimal(38,0)")),
        "keyless": F.count_if(F.col(key).isNull()),
    }


def differences(
    observed: Mapping[str, Mapping],
    read_copy: Callable[[str], DataFrame],
    counted: Mapping[str, Mapping] | None = None,
) -> tuple[list[str], dict[str, dict]]:
    """Read every copy anew and hold it against what its write observed, and what its source counted.

    A write sees only the rows that reach it; `counted`, the rows and distinct keys that the source
    itself reported beforehand, tells of rows that were lost on the way or changed in between.

    Every table is looked at, whatever the others are like; the report has an entry per difference.
    Only one row of counts per table reaches the driver.
    """
    report, counts = [], {}
    for name, source in observed.items():
        key = RAW_TABLES[name].key
        try:
            copy = read_copy(name)
            row = copy.agg(
                *[c.alias(m) for m, c in fingerprint(key).items()],
                F.count_distinct(key).alias("distinct"),
            ).first().asDict()
        except (PySparkException, Py4JJavaError) as e:
            condition = e.getCondition() if isinstance(e, PySparkException) else e.java_exception
            report.append(f"{name}[unreadable]: {condition}")
            continue
        counts[name] = {
            "n_rows": row["rows"],
            "n_keys": row["distinct"],
            "n_null_keys": row["keyless"],
            "n_duplicates": row["rows"] - row["distinct"],
        }
        report += [
            f"{name}[{measure}]: written {source[measure]}, read {row[measure]}"
            for measure in source
            if source[measure] != row[measure]
        ]
        report += [
            f"{name}[source {measure}]: counted {expected}, read {counts[name][measure]}"
            for measure, expected in (counted or {}).get(name, {}).items()
            if expected != counts[name][measure]
        ]
        if row["keyless"]:
            report.append(f"{name}[keyless]: {row['keyless']} without {key}, none allowed")
    return report, counts
