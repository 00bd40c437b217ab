"""Flow assembly: records of one 5-tuple merged until the tuple is idle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from flowlantern.functions.measures import MICROS, aligned
from flowlantern.session import stored

FIVE_TUPLE = ("src_ip", "dest_ip", "src_port", "dest_port", "proto")
IDLE_SECONDS = 5  # fixed value: the sensor's idle timers and flow lifetime
LIFE_SLICES = 256  # slices of a flow's longest life in which its records are sorted
SUMS = ("packets", "bytes", "records")


def _next_cuts(moments: DataFrame, life: int, width: int) -> DataFrame:
    """key, stretch, at, jump: where the flow after one that starts ``at`` would start; none for the last.

    A range lookup without a range join: each moment asks for the first one more than ``life`` later. Questions and
    moments meet in slices of ``width``; what a slice cannot answer is the first moment of the next slice that has any.
    """
    place = ["key", "stretch", "slice"]
    ask = F.array(
        F.struct(F.col("at").alias("t"), F.lit(None).cast("long").alias("asked")),
        F.struct((F.col("at") + life + 1).alias("t"), F.col("at").alias("asked")),
    )
    both = moments.select("key", "stretch", F.inline(ask)).withColumn("slice", aligned(F.col("t"), width))
    moment = F.when(F.col("asked").isNull(), F.col("t"))
    # backwards in time, with equal times seen together, the least moment so far is the next one
    ahead = Window.partitionBy(*place).orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = both.withColumn("inside", F.min(moment).over(ahead))
    later = Window.partitionBy("key", "stretch").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = both.groupBy(*place).agg(F.min(moment).alias("first")).withColumn("later", F.min("first").over(later))
    found = inside.where(F.col("asked").isNotNull()).join(firsts.drop("first"), place)
    found = found.select("key", "stretch", F.col("asked").alias("at"), F.coalesce("inside", "later").alias("jump"))
    return found.where(F.col("jump").isNotNull())


def _true_cuts(moments: DataFrame, jumps: DataFrame, longest: int) -> DataFrame:
    """key, stretch, cut: the starts of the flows of each stretch, of which there are at most ``longest`` + 1.

    Which moment is a cut depends on the cut before. Jumps are composed with themselves until one spans the
    longest stretch; from the starts, taking or leaving the jump of each length reaches all cuts.
    """
    levels = [jumps]
    while 2 ** len(levels) <= longest:
        second = levels[-1].select("key", "stretch", F.col("at").alias("jump"), F.col("jump").alias("beyond"))
        doubled = levels[-1].join(second, ["key", "stretch", "jump"]).select("key", "stretch", "at", F.col("beyond").alias("jump"))
        levels.append(stored(doubled, "jumps"))
    cuts = moments.select("key", "stretch", F.col("stretch").alias("at")).distinct()
    for level in levels:
        step = cuts.join(level, ["key", "stretch", "at"], "left")
        cuts = step.select("key", "stretch", F.explode(F.array_compact(F.array("at", "jump"))).alias("at"))
    return cuts.withColumnRenamed("at", "cut")


def _cut_by_life(records: DataFrame, slots: DataFrame, key: Sequence[str], idle: int, life: int, time: str) -> DataFrame:
    """Flows that also end at the first record more than ``life`` after their start.

    ``slots`` are the numbered time slots of ``assemble_flows``. Only stretches without idle time that last longer need
    cuts. Their records are summed per moment; joins and windows work on key, stretch *and* slice or moment, so no
    task holds a whole 5-tuple. What is sorted per stretch are slices, which its time span bounds.
    """
    width = max(1, life // LIFE_SLICES)
    text = F.to_json(F.struct(*key)).alias("key")  # keeps the types and NULLs of the parts
    stretches = slots.groupBy(*key, "number").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *[F.sum(c).alias(c) for c in SUMS]
    )
    long = F.coalesce(F.col("last_at") - F.col("first_at") > life, F.lit(False))
    stretches = stored(stretches.select(text, "number", "first_at", "last_at", *SUMS, long.alias("long")), "stretches")
    short = stretches.where(~F.col("long")).select("key", "first_at", "last_at", *SUMS)
    cut = stretches.where("long").select("key", "number", F.col("first_at").alias("stretch"), "last_at")

    at = F.unix_micros(time)
    named = slots.select(text, "number", "slot").join(cut.select("key", "number", "stretch"), ["key", "number"])
    rows = records.select(text, at.alias("at"), aligned(at, idle).alias("slot"), "packets", "bytes")
    moments = rows.groupBy("key", "slot", "at").agg(
        F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("records")
    )
    moments = moments.join(named.select("key", "slot", "stretch"), ["key", "slot"]).drop("slot")
    moments = stored(moments.withColumn("slice", aligned(F.col("at"), width)), "moments")

    spans = cut.agg(F.max((F.col("last_at") - F.col("stretch")) / (life + 1))).first()[0]
    cuts = _true_cuts(moments, stored(_next_cuts(moments, life, width), "jumps"), int(spans or 0))
    # cuts are more than a life apart, so a slice has one at most
    cuts = cuts.select("key", "stretch", aligned(F.col("cut"), width).alias("slice"), "cut")
    place = ["key", "stretch", "slice"]
    slices = moments.select(*place).distinct().join(cuts, place, "left")
    earlier = Window.partitionBy("key", "stretch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.max("cut").over(earlier))
    start = F.when(F.col("at") >= F.col("cut"), F.col("cut")).otherwise(F.col("before"))
    flows = moments.join(slices, place).groupBy("key", start.alias("first_at"))
    flows = flows.agg(F.max("at").alias("last_at"), *[F.sum(c).alias(c) for c in SUMS])
    parts = T.StructType([T.StructField(name, records.schema[name].dataType, True) for name in key])
    return short.unionByName(flows).select(F.inline(F.array(F.from_json("key", parts))), "first_at", "last_at", *SUMS)


def assemble_flows(
    records: DataFrame,
    idle: int = IDLE_SECONDS,
    key: Sequence[str] = FIVE_TUPLE,
    time: str = "event_time",
    max_life: int | None = None,
) -> DataFrame:
    """Flows of a batch: a record joins when it starts at most ``idle`` seconds after the one before and, with
    ``max_life``, at most that after the flow's start.

    Records (``key``, ``time``, ``packets``, ``bytes``) that share a time slot of ``idle`` seconds belong
    together anyway, so they are summed up per slot first, before and after a shuffle on key *and* slot.
    What is then sorted per key is bounded by the time span, not by the traffic of a hot key. Records without time
    are one flow of their key without times.
    """
    width = idle * MICROS
    at = F.unix_micros(time)
    slots = (
        records.select(*key, at.alias("at"), aligned(at, width).alias("slot"), "packets", "bytes")
        .groupBy(*key, "slot")
        .agg(
            F.min("at").alias("first_at"),
            F.max("at").alias("last_at"),
            F.sum("packets").alias("packets"),
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("records"),
        )
    )
    in_time = Window.partitionBy(*key).orderBy("slot")
    gap = F.col("first_at") - F.lag("last_at").over(in_time)
    starts = slots.withColumn("starts", F.when(gap <= width, 0).otherwise(1))
    numbered = starts.withColumn("number", F.sum("starts").over(in_time))
    if max_life is None:
        flows = numbered.groupBy(*key, "number").agg(
            F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *[F.sum(c).alias(c) for c in SUMS]
        )
    else:
        flows = _cut_by_life(records, stored(numbered, "slots"), key, width, max_life * MICROS, time)
    return flows.select(
        *key,
        F.timestamp_micros("first_at").alias("start_time"),
        F.timestamp_micros("last_at").alias("end_time"),
        "packets",
        "bytes",
        "records",
    )
