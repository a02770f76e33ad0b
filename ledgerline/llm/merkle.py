"""Merkle manifest of a data set: a tree per source, a tree over their roots, and inclusion proofs.

Nodes of a level are rows (group, index, digest). The index gives the slot within a run of `fan`
neighbours, and by shifting it the indices of a node's siblings: index XOR 1 in a binary tree, index
minus slot otherwise, which is the sibling in slot zero. Every level is a self-join on such computed
indices; the rows in slot zero then hold the digests of their run and emit the parents. Nothing is ever
grouped by source: a join key is one run of at most `fan` nodes, however hot a source is.

Proofs come down the tree. A parent's row knows its run of children and the runs above it, and each of
at most `fan` children joins it by its own shifted index; so the long part of a proof travels once per
run and not once per document.

Leaves are numbered by a range partitioning on (source, doc_id, digest): each partition numbers its own
rows, and only one count per partition and source is summed up.

Defined cases: a null in any column reads `-`; a null source is the first one; null ids come first
within a source; rows that share source and id ascend by their digests, and equal rows are leaves of
their own, one after the other. A lone leaf is its source's root, a lone source's root is the root.
Empty tables give no rows. Extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.frames import crc_of_id, stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Tampering is tried on the documents whose id's checksum this divides.
TAMPERED = 5

_POSITION = (1 << 33) - 1


def _spelled(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a row of documents, by default with its own text."""
    own = F.col("text") if text is None else text
    return F.sha2(F.concat(*[_spelled(own if c == "text" else F.col(c)) for c in FIELDS]), 256)


def digest_of(children: Column) -> Column:
    """Digest of a run of digests: their hex texts one after the other."""
    return F.sha2(F.array_join(children, ""), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Add `idx`, a row's place within its group from 0, and `size`, the group's rows; gathers no group.

    The rows are cut into ranges of (group, order) and each range is written in order; the place in a
    range and the counts of the ranges before it give the index. A range and group make one count.
    """
    cut = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
    cut = stored(cut.select("*", F.spark_partition_id().alias("_range"), position.alias("_at")), "ranges")
    counts = cut.groupBy(group, "_range").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    # A window holds as many rows as there are ranges.
    ranges = Window.partitionBy(group)
    earlier = F.sum("n").over(ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select(
        group,
        "_range",
        (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(ranges).alias("size"),
    )
    return (
        cut.join(begins, [group, "_range"])
        .withColumn("idx", (F.col("_at") + F.col("_shift")).cast("long"))
        .drop("_range", "_at", "_shift")
    )


def _first_sibling(fan: int) -> Column:
    """Index of the sibling in slot zero, for a node in another slot."""
    if fan == 2:
        return F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
    return F.col("idx") - F.pmod("idx", F.lit(fan))


def _slot(fan: int) -> Column:
    return F.pmod("idx", F.lit(fan)).cast("int")


def _up(fan: int) -> Column:
    """Index of the parent of a node."""
    return F.expr(f"idx div {fan}")


def _parents(nodes: DataFrame, fan: int) -> DataFrame:
    """The next level: slot-zero rows meet their siblings by shifted indices and emit parents."""
    child = F.struct(_slot(fan).alias("slot"), F.col("digest").alias("digest"))
    shifted = nodes.where(_slot(fan) > 0).select(
        "grp", _first_sibling(fan).alias("idx"), child.alias("child")
    )
    zero = nodes.where(_slot(fan) == 0).select("grp", "idx", "size", F.col("digest").alias("own"))
    # The join is laid out by (grp, idx), so grouping by it moves nothing.
    met = zero.join(shifted, ["grp", "idx"], "left").groupBy("grp", "idx", "size", "own")
    met = met.agg(F.array_sort(F.collect_list("child")).alias("others"))
    children = F.concat(F.array("own"), F.col("others.digest"))
    return met.select(
        "grp",
        _up(fan).alias("idx"),
        F.expr(f"(size + {fan - 1}) div {fan}").alias("size"),
        digest_of(children).alias("digest"),
        children.alias("children"),
    )


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The levels above leaves (grp, idx, size, digest), lowest first. A group ends where its size is 1."""
    most = leaves.agg(F.max("size")).first()[0] or 0
    out, nodes = [], leaves
    while most > 1:
        out.append(stored(_parents(nodes.where("size > 1"), fan), f"level{len(out)}"))
        nodes, most = out[-1], -(-most // fan)
    return out


def roots(leaves: DataFrame, above: list[DataFrame]) -> DataFrame:
    """The root of each group, (grp, digest)."""
    ends = [level.where("size = 1").select("grp", "digest") for level in (leaves, *above)]
    return reduce(DataFrame.unionByName, ends)


def paths(leaves: DataFrame, above: list[DataFrame], top: DataFrame, fan: int = FAN) -> DataFrame:
    """Add `path` to the leaves: per level from the bottom the leaf's slot and the run it stands in.

    `top` has for each group the `path` above its root, and facts to hand down.
    """
    facts = [c for c in top.columns if c not in ("grp", "path")]
    known = None
    for k, nodes in reversed(list(enumerate([leaves, *above]))):
        own = nodes.columns
        here = nodes.where("size = 1").join(top, "grp").select(*own, "path", *facts)
        if known is not None:
            # At most `fan` children meet one parent.
            parent = known.select(
                "grp", F.col("idx").alias("up"), F.col("children").alias("run"), "path", *facts
            )
            below = nodes.where("size > 1").withColumn("up", _up(fan))
            step = F.struct(_slot(fan).alias("slot"), F.col("run").alias("run"))
            below = below.join(parent, ["grp", "up"]).select(
                *own, F.concat(F.array(step), F.col("path")).alias("path"), *facts
            )
            here = here.unionByName(below)
        known = stored(here, f"paths{k}") if k else here
    return known


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def step(digest: Column, level: Column) -> Column:
        run = F.transform(level["run"], lambda d, k: F.when(k == level["slot"], digest).otherwise(d))
        return digest_of(run)

    return F.aggregate(path, leaf, step)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""

    def siblings(level: Column) -> Column:
        return F.array_join(F.filter(level["run"], lambda d, k: k != level["slot"]), "")

    return F.sha2(F.array_join(F.transform(path, siblings), ""), 256)


def manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """Every document's leaf with its source's root, the root and the path between them.

    `tampered` is the leaf of the text with A-Z lowered where tampering is tried, else null.
    """
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tried = crc_of_id() % F.lit(TAMPERED) == 0
    source = F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # Null first, then the names by their bytes.
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("grp"),
        leaf_digest().alias("digest"),
        F.when(tried, leaf_digest(lowered)).alias("tampered"),
    )
    # Equal rows are counted and numbered, so that a range of any number of them can be cut.
    rows = rows.groupBy("doc_id", "grp", "digest", "tampered").agg(F.count("*").alias("n"))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    leaves = stored(numbered(rows, "grp", "doc_id", "digest", "nth").drop("nth"), "leaves")

    above = levels(leaves, fan)
    subroots = roots(leaves, above).select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    tops = stored(numbered(subroots, "grp", "of"), "tops")
    above_tops = levels(tops, fan)
    no_path = F.array().cast("array<struct<slot:int,run:array<string>>>")
    end = roots(tops, above_tops).select("grp", F.col("digest").alias("root"), no_path.alias("path"))
    top = stored(paths(tops, above_tops, end, fan), "top").select(
        F.col("of").alias("grp"), F.col("digest").alias("subroot"), "root", "path"
    )
    return paths(leaves, above, top, fan)


def report(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """Per document its leaf, the roots, the proof's digest, and the root that its proof folds to."""
    proven = manifest(docs, fan).withColumn(
        "folded_root", folded(F.coalesce("tampered", "digest"), F.col("path"))
    )
    return proven.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
