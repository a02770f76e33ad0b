"""Multi-party dialogues from every participant's point of view.

For each participant of a conversation the whole dialogue is rendered with that speaker as the
assistant and all others as named users; the training mask covers what the assistant says. The result
has one row per perspective and turn: the segment, where it begins in the rendering, and the masked
range, in code points. The segments of a perspective in order are its rendering, byte for byte, so no
conversation, however long, has to be gathered into one string. Running sums go by parts of neighbouring
turn numbers, each in one task; turns that share a number, or have none, are in one part.

Defined cases: turns are ordered by number, nulls first, then by speaker and text. A null speaker is
the participant `unknown`, a null text an empty one, and a null conv_id a conversation of its own.
Speakers in `system` set the scene: they are rendered as system in every perspective and get none.
Repeated turns are kept. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SYSTEM = ("system",)
UNKNOWN = "unknown"
# The text around a segment.
OPEN, NAMED, CLOSE, END = "<|", ":", "|>\n", "<|end|>\n"
# Neighbouring turn numbers summed in one group; groups of a long conversation run in parallel.
TURNS_AT_ONCE = 1_000


def participants(turns: DataFrame, system: tuple[str, ...] = SYSTEM) -> DataFrame:
    speakers = turns.select("conv_id", "speaker").distinct()
    return speakers.where(~F.col("speaker").isin(*system)).withColumnRenamed(
        "speaker", "perspective"
    )


def rotate(turns: DataFrame, system: tuple[str, ...] = SYSTEM) -> DataFrame:
    """Segments of every perspective: conv_id, perspective, turn, segment, start, mask_start, mask_end."""
    said = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    views = participants(said, system).withColumnRenamed("conv_id", "_conv")
    rows = said.join(views, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = F.col("speaker") == F.col("perspective")
    label = (
        F.when(own, F.lit("assistant"))
        .when(F.col("speaker").isin(*system), F.lit("system"))
        .otherwise(F.concat(F.lit(f"user{NAMED}"), F.col("speaker")))
    )
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), label, F.lit(CLOSE)))
    rows = rows.withColumn("segment", F.concat("head", "text", F.lit(END)))
    rows = rows.withColumn("part", F.floor(F.col("turn") / F.lit(TURNS_AT_ONCE)).cast("long"))

    # A running sum in two steps: within each part of a conversation, and over the parts' totals.
    view = ("conv_id", "perspective")
    inside = Window.partitionBy(*view, "part").orderBy(F.asc_nulls_first("turn"), "speaker", "text")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("segment")
    rows = rows.withColumn("within", F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    parts = rows.groupBy(*view, "part").agg(F.sum(size).alias("size"))
    before = Window.partitionBy(*view).orderBy(F.asc_nulls_first("part"))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("conv_id").alias("_conv"),
        F.col("perspective").alias("_view"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
    )
    out = rows.join(
        parts,
        F.col("conv_id").eqNullSafe(F.col("_conv"))
        & (F.col("perspective") == F.col("_view"))
        & F.col("part").eqNullSafe(F.col("_part")),
    )
    start = (F.col("offset") + F.col("within")).cast("long")
    masked = start + F.length("head")
    return out.select(
        "conv_id",
        "perspective",
        "turn",
        "segment",
        start.alias("start"),
        F.when(own, masked).alias("mask_start"),
        F.when(own, masked + F.length("text") + F.lit(len(END))).alias("mask_end"),
    )


ORACLE_SQL = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS text
    FROM conversations
), views AS (
    SELECT DISTINCT conv_id AS c, speaker AS perspective FROM said WHERE speaker <> 'system'
), rows AS (
    SELECT *, '{OPEN}' || CASE WHEN speaker = perspective THEN 'assistant'
        WHEN speaker = 'system' THEN 'system' ELSE 'user{NAMED}' || speaker END || '|>' || chr(10)
        AS head
    FROM said JOIN views ON conv_id IS NOT DISTINCT FROM c
), placed AS (
    SELECT *, head || text || '<|end|>' || chr(10) AS segment,
        coalesce(sum(length(head) + length(text) + {len(END)}) OVER (
            PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM rows
)
SELECT conv_id, perspective, turn, segment, start,
    CASE WHEN speaker = perspective THEN start + length(head) END AS mask_start,
    CASE WHEN speaker = perspective THEN start + length(head) + length(text) + {len(END)} END
        AS mask_end
FROM placed"""
