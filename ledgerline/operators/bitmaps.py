"""A bitmap of join keys that is tested at the scan, before the other side of a join is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2^22 bits, 512 KB, whatever the number of keys.
BITS = 1 << 22
WORD = 64
# A map past this share of set bits lets so much through that it is left out.
MOST_SET = 0.25


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """The word of a key's bit, and the bit's place in it."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.shiftright(slot, WORD.bit_length() - 1), (slot % WORD).cast("int")


def bitmap(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """One row: the bits of all keys as an array of 64-bit words; NULL if too many of them are set.

    Every word is there, so that its place is its number. Words of the keys are combined where the keys
    are; what meets in the end is `bits` bits, not the keys. A NULL key joins with nothing and sets no bit.
    """
    spark = keys.sparkSession
    word, bit = _place(F.col(key), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = keys.where(F.col(key).isNotNull()).select(word.alias("word"), one.alias("bits"))
    words = words.unionByName(
        spark.range(bits // WORD).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    )
    words = words.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    placed = F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"]
    full = F.sum(F.bit_count("bits")) > F.lit(int(bits * MOST_SET))
    return words.agg(F.when(~full, placed).alias("words"))


def maybe_in(df: DataFrame, key: str, keys: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of `df` whose key may be among `keys`, which has a column of that name.

    No row that joins is lost; a few others stay, so a join by the key has to follow. With more keys than
    the map can tell apart every row stays, and that join does all the work, as without the map.

    The test is a filter on a scalar subquery: the optimiser takes it down to the scan of `df`, which
    waits for the keys. That pays where few rows match, as in a rule whose breach is the exception.
    """
    words = bitmap(keys.select(key), key, bits).scalar()
    word, bit = _place(F.col(key), bits)
    found = F.getbit(F.element_at(words, word.cast("int") + 1), bit)
    return df.where(F.coalesce(found, F.lit(1).cast("tinyint")) == 1)
