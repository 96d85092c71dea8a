"""Multi-party perspective rotation (operator 7), in DataFrame functions
only.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant, the other speakers as named users and system
messages as they are; the mask holds the character ranges the model is to
learn: the assistant's messages with their end marks.

Messages are ranked within their conversation, whatever their turn numbers,
and a conversation of more than ``SEGMENT`` messages is rendered in segments
of so many, so no task collects more than a bounded number.  Every message
is in one segment of each perspective; later segments begin with the
conversation's opening, the system messages before anyone else speaks (the
first ``OPENING`` of them), so each is a dialogue under the same
instructions.

Ranks come from one sort of all messages by range: a conversation that
holds a third of them is spread over many tasks, each ranks its part, and
the parts' sizes give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from segmentflow.llm.common import staged

SEGMENT = 256
OPENING = 16
SYSTEM = "system"
UNKNOWN = "unknown"
END = "<|end|>"


def _head(role: Column, speaker: Column) -> Column:
    name = F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == speaker, F.lit("assistant")).otherwise(F.concat(F.lit("user:"), role))
    return F.concat(F.lit("<|"), name, F.lit("|>\n"))


def ranked(messages: DataFrame) -> DataFrame:
    """Messages with ``rank``, from 1, within ``conv`` by turn, role, text."""
    keys = ["conv", "turn", "role", "text"]
    parts = messages.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    parts = staged(parts, "ranked-messages")
    before = F.sum("k").over(W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = parts.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("k"))
    offsets = offsets.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("offset"))
    rows = parts.withColumn("rank", F.row_number().over(W.partitionBy("conv", "part").orderBy("turn", "role", "text")))
    rows = rows.join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return rows.select(*keys, (F.col("rank") + F.col("offset")).alias("rank"))


def rotate(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation, ``speaker`` and ``segment`` (from 0):
    ``text``, ``mask`` (array of start and end, code points, end exclusive),
    ``n_messages``.

    Messages go by turn, then role, then text; repeated rows count once.  A
    null text is empty, a null role is ``unknown``, a null turn comes first,
    null conversation ids are one conversation.  ``<|`` in a message becomes
    ``<\\|``, so no message can forge a mark.  A conversation of system
    messages alone has no perspective.  An empty table gives an empty one;
    other columns are not read."""
    messages = df.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(UNKNOWN)).alias("role"),
        F.replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit("<|"), F.lit("<\\|")).alias("text"),
    ).distinct()
    segment = F.floor((F.col("rank") - 1) / SEGMENT).alias("segment")
    placed = staged(ranked(messages).select("conv", segment, "rank", "role", F.struct("rank", "role", "text").alias("m")), "placed-messages")
    speakers = placed.where(F.col("role") != SYSTEM).select(F.col("conv").alias("of"), F.col("role").alias("speaker")).distinct()
    # Openings of the conversations with several segments, for each later one.
    spans = placed.groupBy("conv").agg(F.max("segment").alias("last"), F.min(F.when(F.col("role") != SYSTEM, F.col("rank"))).alias("first"))
    spans = spans.where("last > 0").withColumnRenamed("conv", "c")
    opening = placed.where((F.col("rank") <= OPENING) & (F.col("role") == SYSTEM)).join(spans, F.col("conv").eqNullSafe(F.col("c")) & (F.col("rank") < F.col("first")))
    opening = opening.select("conv", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("segment"), "m")
    segments = placed.select("conv", "segment", "m").union(opening)
    segments = segments.groupBy("conv", "segment").agg(F.sort_array(F.collect_list("m")).alias("messages"))
    views = segments.join(speakers, F.col("conv").eqNullSafe(F.col("of")))

    rendered = F.transform("messages", lambda m: F.struct(_head(m["role"], F.col("speaker")).alias("head"), F.concat(m["text"], F.lit(END)).alias("body"), (m["role"] == F.col("speaker")).alias("own")))
    views = views.select("conv", "speaker", "segment", rendered.alias("r"))
    # Running position over at most a segment's messages.
    size = lambda m: F.length(m["head"]) + F.length(m["body"]) + 1
    before = lambda i: F.aggregate(F.slice("r", F.lit(1), i), F.lit(0), lambda a, m: a + size(m))
    spans = F.transform("r", lambda m, i: F.struct(m["own"].alias("own"), (before(i) + F.length(m["head"])).alias("start"), (before(i) + F.length(m["head"]) + F.length(m["body"])).alias("end")))
    own = F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"], s["end"]))
    return views.select(
        F.col("conv").alias(conv_col),
        "speaker",
        "segment",
        F.array_join(F.transform("r", lambda m: F.concat(m["head"], m["body"], F.lit("\n"))), "").alias("text"),
        own.alias("mask"),
        F.size("r").cast("long").alias("n_messages"),
    )
