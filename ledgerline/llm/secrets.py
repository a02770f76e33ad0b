"""Secret scan with corpus-wide ownership of each candidate, in DataFrame operations only.

Candidates are what the patterns find, and long runs of mixed letters and digits. A candidate's value is
counted by the distinct owners, and repositories of owners, whose texts hold it: what WIDE or more of
either hold is a copied example, and a random-looking value that a single repository of a single owner
holds looks live. Live values add spans of kind `live` to those of the patterns; no span of a pattern
is taken away.

Places come from the pieces between matches: a match begins where the pieces and matches before it
end. They count code points, ends are exclusive, and a pattern's span is its whole match.

Defined cases: a null or empty text holds nothing. A null owner or repository is one of its own. Rows
equal in all columns that are used count once for ownership, and each gets the same result. Extra
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.llm.frames import row_key, stored
from ledgerline.operators import keyed

ASSIGN, ACCESS, HEX, MIXED, LIVE = "assign", "access", "hex", "mixed", "live"

# The patterns. Letters of the keywords stand in either case, in ASCII only.
PATTERNS = {
    ASSIGN: r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    ACCESS: r"AKIA[A-Z0-9]+",
    # Runs are maximal, so the shortest length can be part of the pattern.
    HEX: r"[0-9a-f]{16,}",
    MIXED: r"[A-Za-z0-9_-]{20,}",
}
SHORTEST = {ASSIGN: 12, ACCESS: 18, HEX: 16, MIXED: 20}
KINDS = (ASSIGN, ACCESS, HEX, MIXED, LIVE)
BASE = KINDS[:3]

# Owners or repositories from which on a value is a copied example, and distinct characters of a
# random-looking one.
WIDE = 3
DIVERSE = 8


def candidates(docs: DataFrame, owner: str = "source", repository: str = "lang") -> DataFrame:
    """One row per match: the row it is in, kind, place of the match, value, and place of the value."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *_key(owner, repository),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        text.alias("text"),
    )

    def found(kind: str) -> Column:
        pattern = F.lit(PATTERNS[kind])
        matches = F.regexp_extract_all("text", pattern, F.lit(0))
        # The pieces between matches; most texts have none, and are read once.
        return F.when(
            F.col("text").rlike(PATTERNS[kind]),
            F.transform(
                F.arrays_zip(
                    matches.alias("m"), F.split("text", PATTERNS[kind], -1).alias("gap")
                ),
                lambda x: F.struct(x["m"].alias("m"), F.length(x["gap"]).alias("gap")),
            ),
        )

    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), found(k).alias("found")) for k in PATTERNS]
    )
    each = rows.select("a", "b", "owner", "repository", F.explode(kinds).alias("k"))
    each = each.where("k.found IS NOT NULL").select(
        "a", "b", "owner", "repository", F.col("k.kind").alias("kind"), F.posexplode("k.found")
    )
    # One piece more than matches; and equal rows are scanned as one.
    each = each.where("col.m IS NOT NULL").select(
        "a", "b", "owner", "repository", "kind", "pos", "col.m", "col.gap"
    ).distinct()
    before = Window.partitionBy("a", "b", "kind").orderBy("pos")
    start = F.sum("gap").over(before) + F.sum(F.length("m")).over(before) - F.length("m")
    placed = each.withColumn("start", start.cast("long"))
    placed = placed.withColumn("end", F.col("start") + F.length("m"))
    value = F.when(
        F.col("kind") == ASSIGN, F.regexp_extract("m", PATTERNS[ASSIGN], 2)
    ).otherwise(F.col("m"))
    placed = placed.withColumn("value", value)
    shortest = F.create_map(*[F.lit(x) for pair in SHORTEST.items() for x in pair])
    return placed.where(F.length("value") >= shortest[F.col("kind")]).select(
        "a",
        "b",
        "owner",
        "repository",
        "kind",
        "start",
        "end",
        "value",
        (F.col("end") - F.length("value")).alias("value_start"),
    )


def _key(owner: str = "source", repository: str = "lang") -> list[Column]:
    key = row_key("doc_id", "text", owner, repository)
    return [key["a"].alias("a"), key["b"].alias("b")]


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value; a popular value is reduced step by step.

    One row per value, for use as the unique side of a join that splits a popular value between tasks.
    """
    of_owner = (
        found.groupBy("value", "owner", "repository")
        .agg(F.count("*").alias("uses"))
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    )
    return keyed(
        of_owner,
        "value",
        F.count("*").alias("n_owners"),
        F.sum("repositories").alias("n_repositories"),
        F.sum("uses").alias("n_uses"),
    )


def judged(found: DataFrame) -> DataFrame:
    """Candidates with their ownership, and whether they look live or are copied examples.

    Repositories are counted over all owners, so there are at least as many as owners.
    """
    random = (
        F.col("value").rlike("[0-9]")
        & F.col("value").rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split("value", ""))) >= DIVERSE)
    )
    return found.join(ownership(found), "value").withColumns(
        {"live": random & (F.col("n_repositories") == 1), "example": F.col("n_repositories") >= WIDE}
    )


def _listed(spans: Column) -> Column:
    number = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (k, kind)])
    return F.array_join(
        F.transform(
            F.array_sort(F.array_distinct(spans)),
            lambda s: F.concat_ws(":", number[s["kind"]], s["start"], s["end"]),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Per row the counts of the patterns, the digest of their spans, all spans, and the widest value.

    `n_owners` and `n_repositories` are the largest counts of any value in the row.
    """
    found = judged(stored(candidates(docs), "candidates"))

    def span(kind: int | Column, start: str) -> Column:
        kind = F.lit(kind) if isinstance(kind, int) else kind
        return F.struct(
            F.col(start).alias("start"), kind.alias("kind"), F.col("end").alias("end")
        )

    number = F.create_map(*[F.lit(x) for k, kind in enumerate(KINDS) for x in (kind, k)])
    base = F.when(F.col("kind").isin(*BASE), span(number[F.col("kind")], "start"))
    live = F.when(F.col("live"), span(KINDS.index(LIVE), "value_start"))
    count = lambda test: F.count_if(test).alias
    of_row = found.groupBy("a", "b").agg(
        *[count(F.col("kind") == k)(f"n_{k}") for k in BASE],
        F.collect_list(base).alias("base"),
        F.collect_list(live).alias("live"),
        count(F.col("example"))("n_example"),
        F.max("n_owners").alias("n_owners"),
        F.max("n_repositories").alias("n_repositories"),
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_key())
    out = rows.join(of_row, ["a", "b"], "left")
    nothing = F.lit("")
    zero = F.lit(0).cast("long")
    listed = F.coalesce(_listed(F.col("base")), nothing)
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in BASE],
        F.sha2(listed, 256).alias("base_sha256"),
        F.coalesce(_listed(F.concat("base", "live")), nothing).alias("spans"),
        F.coalesce(F.size(F.array_distinct("live")).cast("long"), zero).alias("n_live"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_example", "n_owners", "n_repositories")],
    )
