"""Mixing sources to target weights with a time-varying curriculum (DataFrame functions only).

Each source demands ``target`` words over training time 0 to 1. Its weight may rise or fall over that time
(a ramp from ``w (1 - a)`` to ``w (1 + a)``); the integral of the schedule is its cumulative demand. A
document's cumulative place among its source's words, inverted through that demand, is the time at which
it is read, and the mix is sorted by that position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import WORD, global_row_number, running_sums, staged, unused, whole_text

WEIGHTS = (3.0, 1.0, 2.0)
RAMPS = (0.5, -0.5, 0.0)
SHARE = 1.5
CAP = 2.0


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, ramps=RAMPS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Target words of each source: ``src, unnamed, source_size, target, ramp``, one staged row per source.

    ``sizes`` has ``src, unnamed, source_size``. Sources take the weights in turn, by code point of the
    name, null last. They share ``share`` times all words by weight; a target stops at ``cap`` times its
    source and the excess is shared again by weight until no target is above. Every round is one
    aggregate of two sums over the sources.
    """
    turn = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("_turn") % len(values) + 1).cast("int"))
    ranked = staged(
        global_row_number(sizes, ["unnamed", "src"], "_turn").select(
            "src", "unnamed", "source_size", turn(weights).alias("w"), turn(ramps).alias("ramp"), (F.col("source_size") * F.lit(float(cap))).alias("most")
        ),
        "sources",
    )
    level, full = None, -1
    everything = ranked.agg(F.sum("source_size").alias("s"), F.sum("w").alias("w")).first()
    wanted = (everything.s or 0) * share
    level = wanted / everything.w if everything.w else 0.0
    while True:
        over = F.col("w") * F.lit(level) > F.col("most")
        row = ranked.agg(
            F.sum(F.when(over, F.col("most"))).alias("held"), F.sum(F.when(~over, F.col("w"))).alias("w"), F.count(F.when(over, 1)).alias("n")
        ).first()
        if row.n == full or not row.w:
            break
        full = row.n
        level = (wanted - (row.held or 0.0)) / row.w
    return ranked.select(
        "src", "unnamed", "source_size", F.least(F.col("w") * F.lit(level), F.col("most")).alias("target"), "ramp"
    )


def position(done: Column, ramp: Column) -> Column:
    """The time at which a share ``done`` of a source's demand is used up, for the ramp of its weight."""
    rest = F.lit(1.0) - ramp
    return F.round(F.lit(2.0) * done / (rest + F.sqrt(rest * rest + F.lit(4.0) * ramp * done)), 9)


def plan_mix(docs: DataFrame, weights=WEIGHTS, ramps=RAMPS, share: float = SHARE, cap: float = CAP, seed: str = "mix", cell_rows: int = 1024) -> DataFrame:
    """How often and when each document is read: one row per row of ``docs`` (``doc_id, text, source``).

    Returns ``doc_id, source, text_hash, size, source_size, target, copies, taken, start, ramp``. ``start``
    is the number of words of the source before the document in the source's fixed random order (by MD5
    of seed and id, ties by text hash). Every document is read ``floor(target / source_size)`` times and
    the first ones in that order once more, to the nearest document. Null texts have size 0, a null source
    is a source of its own, after the others. Documents without words take nothing from the target. Repeated
    rows are each mixed. An empty table gives no rows.
    """
    text = whole_text()
    rows = staged(
        docs.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("src"),
            F.col("source").isNull().alias("unnamed"),
            word_count(text).alias("size"),
            F.xxhash64(text).alias("text_hash"),
            F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("turn"),
        ),
        "mix",
    )
    sizes = rows.groupBy("src", "unnamed").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, ramps, share, cap)
    cells = max(16, rows.count() // cell_rows)
    cell = F.floor(F.conv(F.substring("turn", 1, 8), 16, 10).cast("long") * F.lit(cells) / F.lit(1 << 32)).cast("int")
    placed = running_sums(rows.withColumn("cell", cell), ["src", "unnamed"], "cell", ["turn", "text_hash"], {"start": "size"})
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    again = F.when((F.col("size") > 0) & (F.col("start") + F.col("size") / F.lit(2.0) < rest), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return (
        placed.join(goals, ["src", "unnamed"])
        .withColumn("whole", whole)
        .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + again).otherwise(F.lit(0).cast("long")))
        .select(
            "doc_id",
            F.when(~F.col("unnamed"), F.col("src")).alias("source"),
            "text_hash",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
            "start",
            "ramp",
        )
    )


def position_of_copy(copy: Column) -> Column:
    """Training position of the copy numbered from 0, null for a document that is not read."""
    done = (copy * F.col("source_size") + F.col("start") + F.col("size") / F.lit(2.0)) / F.col("target")
    return F.when(F.col("copies") > 0, position(F.least(done, F.lit(1.0)), F.col("ramp")))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` as they are read in training: copies as planned, range-sorted by position; same columns.

    Documents without words weigh nothing and are read once, at the start. Settings are those of ``plan_mix``.
    """
    id_, unknown, hash_, reads, times, at = (unused(docs, f"_mix_{n}") for n in ("id", "unknown", "hash", "reads", "times", "position"))
    positions = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("copies"), F.lit(1)) - 1), position_of_copy)
    plan = (
        plan_mix(docs, **settings)
        .where("copies > 0 OR size = 0")
        .select(
            F.coalesce("doc_id", F.lit(0)).alias(id_),
            F.col("doc_id").isNull().alias(unknown),
            F.col("text_hash").alias(hash_),
            F.struct("start", F.transform(positions, lambda t: F.coalesce(t, F.lit(0.0))).alias("times")).alias("read"),
        )
        .groupBy(id_, unknown, hash_)
        .agg(F.sort_array(F.collect_list("read")).alias(reads))
    )
    keys = {id_: F.coalesce("doc_id", F.lit(0)), unknown: F.col("doc_id").isNull(), hash_: F.xxhash64(whole_text())}
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(hash_))  # rows repeated as a whole take one entry each
    return (
        docs.withColumns(keys)
        .join(plan, list(keys))
        .withColumn(times, F.get(F.col(reads), nth - 1)["times"])
        .select(*[F.col(c) for c in docs.columns], F.explode(times).alias(at))
        .orderBy(at)
        .select(*docs.columns)
    )
