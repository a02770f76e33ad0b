"""Mixing sources to target weights by pivotal dependent rounding, on a distributed reduction tree.

A source's target divided by its size says how often each of its documents is to be copied. The whole
part is certain. The fractions are made 0 or 1 by pairing: mass moves between two documents, at random
but without bias, until one of them is integral, and measured in words the sum stays what it was. The
one left over meets the next. Groups of a source's documents are reduced in parallel; what each group
leaves over meets in the next level, until one document per source is left, which is rounded to the
nearer side. So a source misses its target by at most half the size of one document.

Defined cases: a null text has size 0; rows of size 0 are taken 0 times; a null source is a source of
its own, the last one; repeated rows are separate documents. Documents of size 0 cannot change any sum.
Without words there are no targets to meet: they are 0. Chance is a hash of the seed, the level, the
group and the place within it, so a rerun, or the loss of an executor, repeats every choice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.frames import stored, whole_rows

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
# Documents that one group pairs, on average; and groups whose remainders meet in the next level.
GROUP_ROWS = 2_000
SEED = 20_241


def words_in(column: str = "text") -> Column:
    """Number of words: places where a character that is no white space follows none."""
    return F.coalesce(
        F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long")
    )


def targets(sizes: dict, share: float = SHARE, weights: tuple = WEIGHTS) -> dict:
    """Words to take of each source: by weight, at most MOST_COPIES times its size, the excess reshared."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = share * sum(sizes.values())
    full: dict = {}
    open_ = list(names)
    while open_:
        left = total - sum(full.values())
        base = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / base > MOST_COPIES * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / base for s in open_}
        full |= {s: float(MOST_COPIES * sizes[s]) for s in over}
        open_ = [s for s in open_ if s not in full]
    return full


def _chance(place: tuple[int, ...], n: int) -> np.ndarray:
    return np.random.default_rng(list(place)).random(n)


def round_pairs(size: np.ndarray, part: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, int]:
    """Make all but one of the fractions integral; returns them and the place of the one left, or -1.

    When a and b meet, either a rises and b falls until one hits a bound, or the reverse. Moves are in
    words, so the sum of size * fraction is kept, and the chances make the expected move 0.
    """
    part = part.copy()
    left = -1
    for k in range(len(part)):
        if not 0 < part[k] < 1:
            continue
        if left < 0:
            left = k
            continue
        a, b = left, k
        mass_a, mass_b = size[a] * part[a], size[b] * part[b]
        up = min(size[a] - mass_a, mass_b)
        down = min(mass_a, size[b] - mass_b)
        if chance[k] * (up + down) < down:
            hits_a, hits_b = up == size[a] - mass_a, up == mass_b
            part[a] = 1.0 if hits_a else (mass_a + up) / size[a]
            part[b] = 0.0 if hits_b else (mass_b - up) / size[b]
        else:
            hits_a, hits_b = down == mass_a, down == size[b] - mass_b
            part[a] = 0.0 if hits_a else (mass_a - down) / size[a]
            part[b] = 1.0 if hits_b else (mass_b + down) / size[b]
        left = a if 0 < part[a] < 1 else b if 0 < part[b] < 1 else -1
    return part, left


_ROW = "doc_id long, key long, size long, source_no int, part double, grp long"


def _reduce(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level: rows of a group meet; in the last level what is left of a source is rounded."""

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("size", "doc_id", "key", "part")])
        # Large documents meet first: what is left over tends to be small.
        table = table.take(pa.array(np.arange(table.num_rows)[::-1].copy()))
        size = table.column("size").to_numpy().astype(float)
        part = table.column("part").to_numpy()
        source, group = table.column("source_no")[0].as_py(), table.column("grp")[0].as_py()
        chance = _chance((seed, level, source, group), len(size))
        part, left = round_pairs(size, part, chance)
        if last and left >= 0:
            part[left] = float(part[left] >= 0.5)
        at = table.column_names.index("part")
        return table.set_column(at, "part", pa.array(part))

    return rows.groupBy("source_no", "grp").applyInArrow(meet, _ROW)


def copies(docs: DataFrame, key: Column | None = None, seed: int = SEED) -> DataFrame:
    """Every row with its size, its source's size and target, and how often the mix takes it.

    `key` tells rows apart; rows that share it must share doc_id, source and size.
    """
    spark = docs.sparkSession
    if key is None:
        key = F.xxhash64("doc_id", "source", "text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        key.alias("key"),
        F.col("source").cast("string").alias("source"),
        words_in().alias("size"),
    )
    # Equal rows are numbered, so that a group of any number of them can be cut.
    rows = rows.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("n"))
    nth = F.explode(F.sequence(F.lit(1).cast("long"), "n"))
    sized = stored(rows.withColumn("nth", nth).drop("n"), "sizes")
    # A row per source; weights go by the order of the names, so all names are needed at once.
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()
    sizes = {r["source"]: r["n"] for r in found}
    goal = targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    n_rows = {r["source"]: r["rows"] for r in found}
    plan = []
    for number, s in enumerate(names):
        times = goal[s] / sizes[s] if sizes[s] else 0.0
        whole = min(int(times), MOST_COPIES)
        plan.append((s, number, sizes[s], float(goal[s]), whole, times - whole, -(-n_rows[s] // GROUP_ROWS)))
    of_source = spark.createDataFrame(
        plan,
        "source string, source_no int, source_size long, target double, whole long,"
        " fraction double, groups long",
    )
    known = sized.join(F.broadcast(of_source), sized["source"].eqNullSafe(of_source["source"])).drop(
        of_source["source"]
    )
    known = known.withColumn("whole", F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0)))

    # Groups are cut by a hash of the row: a source of any number of rows has groups of like size.
    live = known.where((F.col("size") > 0) & (F.col("fraction") > 0)).select(
        "doc_id",
        "key",
        "size",
        "source_no",
        F.col("fraction").alias("part"),
        F.pmod(F.xxhash64("key", "doc_id", "nth"), F.col("groups")).alias("grp"),
    )
    most, level, done = max([p[-1] for p in plan], default=1), 0, []
    while True:
        last = most <= 1
        live = stored(_reduce(live, level, last, seed), f"mix{level}")
        done.append(live if last else live.where("part IN (0, 1)"))
        if last:
            break
        live = live.where("part > 0 AND part < 1").withColumn(
            "grp", F.floor(F.col("grp") / F.lit(GROUP_ROWS)).cast("long")
        )
        most, level = -(-most // GROUP_ROWS), level + 1
    extra = done[0]
    for more in done[1:]:
        extra = extra.unionByName(more)
    fixed = known.where((F.col("size") == 0) | (F.col("fraction") <= 0)).select(
        "doc_id", "key", "size", "source_no", F.lit(0.0).alias("part"), F.lit(0).cast("long").alias("grp")
    )
    facts = F.broadcast(of_source.drop("groups", "fraction"))
    out = extra.unionByName(fixed).join(facts, "source_no")
    whole = F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0))
    return out.select(
        "doc_id",
        "key",
        "size",
        "source",
        "source_size",
        "target",
        (whole + F.col("part").cast("long")).alias("copies"),
    )


def report(docs: DataFrame) -> DataFrame:
    return copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, all columns as they came.

    Equal rows share the copies that any of them got.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*columns, *[c.isNull() for c in columns])
    taken = copies(docs, key).groupBy("key").agg(F.sum("copies").alias("n")).where("n > 0")
    once = whole_rows(docs, key.alias("key")).dropDuplicates(["key"])
    spread = F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("nth")
    return once.join(taken, "key").select("row", spread).select("row.*")
