"""Multi-party perspective rotation: a dialogue rendered once for each of its speakers as the assistant.

Only DataFrame functions run here. The dialogue's segments are rows, not one string: a conversation of any
length is dealt out in blocks of turns. A segment's place in its rendering is the sum of the lengths before
it in its block plus a base that comes from sums per (conversation, block, speaker).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in one block.
BLOCK = 256
#: The rendering's markers.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def rotate(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each turn and perspective: conv_id, perspective, turn, role, name, segment, start, end, mask_start, mask_end.

    turns has conv_id, turn, role, text. Every distinct role of a conversation but the system is a speaker and
    gets a perspective; a conversation that has only system turns has none. The speaker's own turns become the
    assistant's and are trained on: [mask_start, mask_end) covers their text and closing marker, in characters
    from the rendering's start; for other turns both are null. Others' turns become a user's with the speaker's
    name. Segments join in the order of (turn, speaker, text), nulls first; rows that repeat stay. A null role
    is the speaker "unknown", a null text empty, null conversations form one group, other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit("unknown")).alias("speaker"), text.alias("text"))
    t = t.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(2**62))))
    fixed = F.length("text") + F.lit(len(OPEN) + 1 + len(CLOSE))
    plain = F.when(F.col("speaker") == SYSTEM, fixed + len(SYSTEM)).otherwise(fixed + F.length("speaker") + len("user name="))
    gain = F.when(F.col("speaker") == SYSTEM, 0).otherwise(F.lit(len("assistant") - len("user name=")) - F.length("speaker"))
    # Lengths per block: one row for each speaker in it, combined before the shuffle.
    sums = t.groupBy("conv_id", "block", "speaker").agg(F.sum(plain).alias("plain"), F.sum(gain).alias("gain"))
    blocks = sums.groupBy("conv_id", "block").agg(F.sum("plain").alias("plain"), F.map_from_entries(F.collect_list(F.struct("speaker", "gain"))).alias("gains"))
    speakers = sums.where(F.col("speaker") != SYSTEM).groupBy("conv_id").agg(F.collect_set("speaker").alias("speakers"))
    b = blocks.alias("b").join(speakers.alias("s"), F.col("b.conv_id").eqNullSafe(F.col("s.conv_id"))).select("b.*", F.explode("s.speakers").alias("perspective"))
    length = F.col("plain") + F.coalesce(F.element_at("gains", F.col("perspective")), F.lit(0))
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("base", F.coalesce(F.sum(length).over(before), F.lit(0)))
    b = b.groupBy("conv_id", "block").agg(F.collect_list(F.struct("perspective", "base")).alias("views"))
    out = t.alias("t").join(b.alias("b"), F.col("t.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("t.block") == F.col("b.block")))
    out = out.select("t.*", F.explode("b.views").alias("view")).select("conv_id", "block", "turn", "speaker", "text", "view.perspective", "view.base")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when((F.col("speaker") != SYSTEM) & ~own, F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    out = out.select("conv_id", "block", "perspective", "turn", "speaker", "text", "base", role.alias("role"), name.alias("name"), F.concat(head, "text", F.lit(CLOSE)).alias("segment"), F.length(head).cast("long").alias("skip"))
    size = F.length("segment").cast("long")
    earlier = Window.partitionBy("conv_id", "block", "perspective").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("start", F.col("base") + F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    end = F.col("start") + size
    trained = F.col("role") == "assistant"
    return out.select("conv_id", "perspective", "turn", "role", "name", "segment", "start", end.alias("end"), F.when(trained, F.col("start") + F.col("skip")).alias("mask_start"), F.when(trained, end).alias("mask_end"))


def renderings(rotated: DataFrame) -> DataFrame:
    """(conv_id, perspective, rendering, masks) of what `rotate` returns: the segments joined in their places, and the trained ranges in order.

    One row holds one conversation, so this is for conversations that fit in a row; `rotate` itself has no such bound.
    """
    parts = F.array_sort(F.collect_list(F.struct("start", "segment", "mask_start", "mask_end")))
    out = rotated.groupBy("conv_id", "perspective").agg(parts.alias("parts"))
    trained = F.filter("parts", lambda p: p["mask_start"].isNotNull())
    masks = F.transform(trained, lambda p: F.struct(p["mask_start"].alias("start"), p["mask_end"].alias("end")))
    return out.select("conv_id", "perspective", F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("rendering"), masks.alias("masks"))


ORACLE = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
    CASE WHEN speaker <> 'system' AND speaker <> perspective THEN speaker END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM r),
s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING)::BIGINT AS "end" FROM s)
SELECT conv_id, perspective, turn, role, name, segment, "end" - length(segment) AS start, "end",
  CASE WHEN role = 'assistant' THEN "end" - length(segment) + length(head) END AS mask_start,
  CASE WHEN role = 'assistant' THEN "end" END AS mask_end
FROM e"""
