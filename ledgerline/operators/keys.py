"""Operators on business keys that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.schemas import ROW_ID

COPIES = "_copies"


def with_row_id(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add a row id hashed from the row's content, 32 bytes.

    Two rows share an id only if they are equal, and then it does not matter which one survives a
    dedupe. The id does not depend on file order, task order or retries.
    """
    names = columns or df.columns
    # Each value is preceded by its length, so no two rows spell the same text; NULL has none.
    texts = [F.col(c).cast("string") for c in names]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("~")) for t in texts]
    return df.withColumn(ROW_ID, F.unhex(F.sha2(F.concat(*parts), 256)))


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key value, NULL included, with the number of rows that shared it.

    The survivor is the row with the smallest row id if the frame has one, else the smallest row by
    its columns from left to right (NULLs first). It is an aggregate and not a window: each task
    sends at most one row per key over the network, so a key with a third of all rows costs its
    reducer no more than any other. With a row id, every column is an aggregate of its own, so those
    that no later step uses are not read.
    """
    payload = [c for c in df.columns if c != key]
    count = F.count(F.lit(1)).alias(COPIES)
    if ROW_ID in payload:
        return df.groupBy(key).agg(*[F.min_by(c, ROW_ID).alias(c) for c in payload], count)
    rows = df.groupBy(key).agg(F.min(F.struct(*payload)).alias("_row"), count)
    return rows.select(key, "_row.*", COPIES)


def keyed(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Aggregate to one row per key, for use as the unique side of a join on that key.

    Grouping also by a hash of the key gives the same groups, but the result is no longer laid out
    by the key alone, so the join does an exchange of its own on both sides. AQE splits a skewed
    partition only between two such exchanges; over a reused layout it would leave the other side's
    hot key in one task. The extra exchange carries one short row per key.
    """
    grouped = df.groupBy(F.col(key), F.xxhash64(key).alias("_spread"))
    return grouped.agg(*(aggregates or (F.lit(True).alias("_found"),))).drop("_spread")


def sql_not_in(df: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """`key NOT IN (SELECT key FROM excluded)` with SQL's NULL rules, as a join that can shuffle.

    One NULL among the excluded keys keeps no row at all; else a NULL key is kept only if nothing is
    excluded. Both facts and the anti join read the same grouped keys, and neither puts a filter
    below the grouping, so its exchange runs once. The join is null-safe for that reason alone: an
    ordinary one would have the optimiser drop NULLs on one of the two paths. A literal NOT IN would
    instead have to broadcast the excluded keys whole, whatever their number.

    The facts are one row, joined after the anti join and not asked for before it: so `df` is read
    and shuffled while the excluded keys are still being found.
    """
    keys = keyed(excluded.select(F.col(key).alias("_key")), "_key").select("_key")
    facts = keys.agg(
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(F.max(F.col("_key").isNull()), F.lit(False)).alias("_has_null"),
    )
    possible = (F.col("_n") == 0) | (~F.col("_has_null") & F.col(key).isNotNull())
    kept = df.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    # A global aggregate has exactly one row.
    return kept.join(F.broadcast(facts), possible).select(*[F.col(f"`{c}`") for c in df.columns])


def any_of(flags: list[str]) -> Column:
    """OR over nullable flags."""
    return F.expr(" OR ".join(flags))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name, paired up so that no plan is analysed once per frame after it."""
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]
