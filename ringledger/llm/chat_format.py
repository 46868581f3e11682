"""Multi-party chat rendering with rotated perspectives; built-ins only.

For every participant of a conversation the whole dialogue is rendered with that participant
as the assistant, everyone else as named users, and a mask over the participant's own turns.
The result has one segment per perspective and turn, with the character range of the segment
and of its trained part inside the whole rendering, so a conversation of any length is never
gathered in one row. Ranges come from running sums within blocks of turns and from the sums of
the blocks, so even one huge conversation spreads over tasks.

Defined results: an empty or null text is an empty turn; a null or blank role is the
participant ``unknown``; turns are ordered by turn (nulls first), role and text, and fully
equal rows are rendered as often as they occur. A null conversation id is a conversation of its
own. Roles in ``context_roles`` are shown to all and take no perspective; a conversation of
such roles only gives no rows. Other columns are ignored, whatever their names.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTEXT_ROLES = ("system", "tool")
BLOCK_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(text: Column) -> Column:
    """Control markers inside a text are broken up, so they can't end a segment."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame, context_roles: Sequence[str] = CONTEXT_ROLES,
                 block_turns: int = BLOCK_TURNS) -> DataFrame:
    """``conv_id, perspective, turn, role, segment, char_start, char_end, trained, mask_start,
    mask_end``; ranges are half open and count characters of the whole rendering."""
    name = F.regexp_replace(F.coalesce("role", F.lit("")), r"[\x20\x09-\x0D]+", "_")
    spoken = turns.select(
        "conv_id", "turn", F.when(name.isin("", "_"), F.lit("unknown")).otherwise(name).alias("role"),
        _safe(F.col("text")).alias("said"),
    )
    speakers = spoken.where(~F.col("role").isin(*context_roles)).select(
        F.col("conv_id").alias("whose"), F.col("role").alias("perspective")
    ).distinct()
    rotated = spoken.join(speakers, F.col("conv_id").eqNullSafe(F.col("whose"))).drop("whose")
    own = F.col("role") == F.col("perspective")
    head = (
        F.when(own, F.lit("assistant"))
        .when(F.col("role").isin(*context_roles), F.col("role"))
        .otherwise(F.concat(F.lit("user name="), F.col("role")))
    )
    shown = rotated.select(
        "conv_id", "perspective", "turn", "role", own.alias("trained"),
        F.concat(F.lit(OPEN), head, F.lit("\n"), "said", F.lit(f"{CLOSE}\n")).alias("segment"),
        F.floor(F.col("turn") / block_turns).alias("block"),
    )
    keys = ["conv_id", "perspective", "block"]
    order = [F.col("turn").asc_nulls_first(), "role", "segment"]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = shown.withColumn("length", F.char_length("segment").cast("long"))
    local = counted.withColumn("local_end", F.sum("length").over(within))
    blocks = counted.groupBy(*keys).agg(F.sum("length").alias("block_length"))
    across = Window.partitionBy("conv_id", "perspective").orderBy(
        F.col("block").asc_nulls_first()
    ).rowsBetween(Window.unboundedPreceding, 0)
    offsets = blocks.select(
        *[F.col(key).alias(f"of_{key}") for key in keys],
        (F.sum("block_length").over(across) - F.col("block_length")).alias("offset"),
    )
    same = [F.col(key).eqNullSafe(F.col(f"of_{key}")) for key in keys]
    placed = local.join(offsets, same).withColumn("char_end", F.col("offset") + F.col("local_end"))
    start = F.col("char_end") - F.col("length")
    return placed.select(
        "conv_id", "perspective", "turn", "role", "segment", start.alias("char_start"), "char_end",
        "trained",
        F.when(F.col("trained"), start + len(f"{OPEN}assistant\n")).alias("mask_start"),
        # The closing marker is learnt, the line feed behind it is not.
        F.when(F.col("trained"), F.col("char_end") - 1).alias("mask_end"),
    )


ORACLE = f"""
WITH spoken AS (
  SELECT conv_id, turn,
         CASE WHEN regexp_replace(coalesce(role, ''), '[\\x20\\x09-\\x0D]+', '_', 'g') IN ('', '_')
              THEN 'unknown'
              ELSE regexp_replace(coalesce(role, ''), '[\\x20\\x09-\\x0D]+', '_', 'g') END AS role,
         replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id, role AS perspective FROM spoken WHERE role NOT IN ('system', 'tool')
), shown AS (
  SELECT s.conv_id, p.perspective, s.turn, s.role, s.role = p.perspective AS trained,
         '{OPEN}' || CASE WHEN s.role = p.perspective THEN 'assistant'
                          WHEN s.role IN ('system', 'tool') THEN s.role
                          ELSE 'user name=' || s.role END
         || chr(10) || s.said || '{CLOSE}' || chr(10) AS segment
  FROM spoken s JOIN speakers p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, CAST(sum(length(segment)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, segment
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS char_end
  FROM shown
)
SELECT conv_id, perspective, turn, role, segment, char_end - length(segment) AS char_start,
       char_end, trained,
       CASE WHEN trained THEN char_end - length(segment) + {len(OPEN) + len("assistant") + 1} END
         AS mask_start,
       CASE WHEN trained THEN char_end - 1 END AS mask_end
FROM placed
"""
